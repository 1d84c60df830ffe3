"""Small generators for repeated DuckDB oracle fragments (test side only)."""

from __future__ import annotations

PCTS = [("perc50", 0.5), ("perc75", 0.75), ("perc90", 0.9), ("perc95", 0.95), ("perc100", 1.0)]


def delta_sql(value: str, part: str, order: str = "snap_id", alias: str | None = None) -> str:
    lag = f"lag({value}) over (partition by {part} order by {order})"
    return (f"coalesce(case when {value} >= coalesce({lag}, 0) then {value} - {lag} else 0 end, 0)"
            f" as {alias or value + '_delta'}")


def mode_cte(src: str, keys: list[str], value: str, name: str = "__mode") -> str:
    k = ", ".join(keys)
    return f"""{name} as (
  select {k}, min(v) as mode_v from (
    select {k}, v, c, max(c) over (partition by {k}) as mc from (
      select {k}, {value} as v, count(*) as c from {src} where {value} is not null group by {k}, {value}) a) b
  where c = mc group by {k})"""


def pct_expr(lst: str, p: float) -> str:
    """Exact percentile with linear interpolation written out over a sorted list, using the
    same floating-point steps as the Spark ``percentile`` aggregate (and the Oracle
    definition): pos = (n-1)*p; (ceil-pos)*lo + (pos-floor)*hi."""
    pos = f"((len({lst}) - 1) * cast({p} as double))"
    fl, ce = f"floor({pos})", f"ceil({pos})"
    lo = f"{lst}[cast({fl} as bigint) + 1]"
    hi = f"{lst}[cast({ce} as bigint) + 1]"
    return (f"(case when len({lst}) = 0 then null when {fl} = {ce} or {lo} = {hi} then cast({lo} as double) "
            f"else ({ce} - {pos}) * {lo} + ({pos} - {fl}) * {hi} end)")


def sorted_list(v: str) -> str:
    return f"list_sort(list({v}) filter (where {v} is not null))"


def profile_sql(src: str, keys: list[str], value: str, hour_expr: str = "strftime(begin_ts, '%H')",
                hour_name: str = "hour", int_sum: bool = True) -> str:
    """Oracle of ``hourly_profile``: count, avg, mode (smallest of the most frequent),
    median, min, max, sum, P50..P100, each rounded."""
    gk = keys + [hour_name]
    k = ", ".join(gk)
    on = " and ".join(f"p.{c} = m.{c}" for c in gk)
    pcts = ",\n  ".join(f"round({pct_expr('p.__l', pp)}) as {n}" for n, pp in PCTS)
    return f"""with __src as (select *, {hour_expr} as {hour_name}, {value} as __v from {src}),
{mode_cte('__src', gk, '__v')},
__agg as (select {k}, count(*) as cnt, round(avg(__v)) as avg_value, {sorted_list('__v')} as __l,
  round(min(__v)) as min_value, round(max(__v)) as max_value, {'cast(round(sum(__v)) as bigint)' if int_sum else 'round(sum(__v))'} as sum_value
  from __src group by {k})
select {', '.join('p.' + c for c in gk)}, p.cnt, p.avg_value, p.min_value, p.max_value, p.sum_value,
  round({pct_expr('p.__l', 0.5)}) as median_value,
  {pcts},
  round(m.mode_v) as mode_value from __agg p left join __mode m on {on}"""
