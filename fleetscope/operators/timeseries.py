"""Performance time series: counter deltas, hourly percentile profiles and the
snapshot-based summaries built on them (survey section C).

Scale notes
-----------
* ``previous_values`` is the lag kernel.  A plain ``lag`` window puts every row of
  one (database, instance, statistic) key into one task; a key can hold a third
  of all rows.  The kernel therefore splits each key into ranges of the ordering
  column (``bucket_width``), takes the lag inside each range, and stitches range
  boundaries with a per-range ``max_by`` aggregate (map-side combined) shifted by
  one range.  The result is exact and no task sees more than one range.
* Profiles are a single ``groupBy`` with exact ``percentile`` (one shared buffer
  for all percentages), ``mode`` and min/max/sum; partial aggregation runs before
  the shuffle.
* Dimension joins carry no broadcast hints: literal dimensions are tiny local relations
  the planner broadcasts on its own, and AQE turns small runtime sides into broadcast
  joins with sort-merge as the fallback.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.functions.expressions import hour_of, micros, safe_ratio

COUNTER_KEYS = ["pkey", "dbid", "instance_number", "stat_name"]
PROFILE_PERCENTILES = {"perc50": 0.5, "perc75": 0.75, "perc90": 0.9, "perc95": 0.95, "perc100": 1.0}

# fixed values: OS statistics that are cumulative counters (all others are gauges)
OS_COUNTER_STATS = ["IDLE_TIME", "BUSY_TIME", "USER_TIME", "SYS_TIME", "IOWAIT_TIME", "NICE_TIME",
                    "RSRC_MGR_CPU_WAIT_TIME", "VM_IN_BYTES", "VM_OUT_BYTES"]
# fixed values: wait classes kept by the I/O event profile
IO_WAIT_CLASSES = ["User I/O", "System I/O", "Commit"]


# ---------------------------------------------------------------------------
# C1 kernel
# ---------------------------------------------------------------------------

def previous_values(df: DataFrame, keys, order: str, values, bucket_width: int | None = 1 << 16,
                    prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<v>`` (value of the previous row per key by ``order``) and ``has_prev``.

    ``bucket_width`` splits a key into ranges of ``order`` so that no single task
    holds a whole key; ``None`` uses one plain window per key.
    """
    keys = list(keys)
    values = list(values)
    if bucket_width is None:
        w = Window.partitionBy(*keys).orderBy(order)
        out = df
        for v in values:
            out = out.withColumn(prefix + v, F.lag(v).over(w))
        return out.withColumn("has_prev", F.row_number().over(w) > 1)

    bucket = "__bucket"
    staged = df.withColumn(bucket, F.floor(F.col(order) / F.lit(bucket_width)))
    w = Window.partitionBy(*keys, bucket).orderBy(order)
    inner = staged.withColumn("__first", F.row_number().over(w) == 1)
    for v in values:
        inner = inner.withColumn("__lag_" + v, F.lag(v).over(w))

    # last row of each range, then the previous non-empty range of the same key
    last = (staged.groupBy(*keys, bucket)
            .agg(F.max_by(F.struct(*[F.col(v).alias(v) for v in values]), F.col(order)).alias("__last")))
    wb = Window.partitionBy(*keys).orderBy(bucket)
    carry = (last.withColumn("__carry", F.lag("__last").over(wb))
             .where(F.col("__carry").isNotNull())
             .select(*keys, bucket, "__carry"))

    joined = inner.join(carry, on=[*keys, bucket], how="left")
    out = joined
    for v in values:
        out = out.withColumn(prefix + v, F.when(F.col("__first"), F.col("__carry")[v]).otherwise(F.col("__lag_" + v)))
    has_prev = F.when(F.col("__first"), F.col("__carry").isNotNull()).otherwise(F.lit(True))
    out = out.withColumn("has_prev", has_prev)
    return out.drop(bucket, "__first", "__carry", *["__lag_" + v for v in values])


def delta_expr(value: str, prev: str) -> Column:
    """``nvl(decode(greatest(v, nvl(lag,0)), v, v - lag, 0), 0)``: first row and resets give 0."""
    v, p = F.col(value), F.col(prev)
    return F.coalesce(F.when(v >= F.coalesce(p, F.lit(0)), v - p).otherwise(F.lit(0)), F.lit(0))


def counter_delta(df: DataFrame, keys=COUNTER_KEYS, order: str = "snap_id", values=("value",),
                  lo=None, hi=None, bound: str = "before", bucket_width: int | None = 1 << 16,
                  suffix: str = "_delta") -> DataFrame:
    """Per-key counter deltas ordered by ``order``.

    ``bound="before"`` restricts rows to ``lo <= order <= hi`` before the lag (the
    first in-window row gets 0); ``"after"`` takes the lag over all history and
    filters afterwards (the first in-window row gets a real delta).
    """
    values = list(values)

    def in_window(frame):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col(order) >= F.lit(lo))
        if hi is not None:
            cond = cond & (F.col(order) <= F.lit(hi))
        return frame.where(cond)

    src = in_window(df) if bound == "before" else df
    out = previous_values(src, keys, order, values, bucket_width=bucket_width)
    for v in values:
        out = out.withColumn(v + suffix, delta_expr(v, "prev_" + v))
    if bound == "after":
        out = in_window(out)
    return out.drop("has_prev", *["prev_" + v for v in values])


def counter_or_gauge(df: DataFrame, counter_names=OS_COUNTER_STATS, keys=COUNTER_KEYS, order="snap_id",
                     value="value", drop_first: bool = False, bucket_width: int | None = 1 << 16) -> DataFrame:
    """``delta_value`` is the C1 delta for the named cumulative statistics and the raw
    value for gauges.  ``drop_first=True`` is the second variant: C1 for every statistic
    and rows without a previous sample dropped."""
    out = previous_values(df, keys, order, [value], bucket_width=bucket_width)
    delta = delta_expr(value, "prev_" + value)
    if drop_first:
        out = out.where(F.col("has_prev")).withColumn("delta_value", delta)
    else:
        out = out.withColumn("delta_value", F.when(F.col("stat_name").isin(*counter_names), delta)
                             .otherwise(F.col(value)))
    return out.drop("prev_" + value, "has_prev")


# ---------------------------------------------------------------------------
# Snapshot windows and joins
# ---------------------------------------------------------------------------

def snapshot_window(snaps: DataFrame, days: int, as_of, keys=("dbid",), ts="begin_ts",
                    snap_col="snap_id") -> DataFrame:
    """C4: min / max snapshot id and time within the last ``days`` days before ``as_of``."""
    start = F.to_timestamp(F.lit(as_of)) - F.expr(f"make_interval(0, 0, 0, {int(days)})")
    return (snaps.where((F.col(ts) >= start) & (F.col(ts) <= F.to_timestamp(F.lit(as_of))))
            .groupBy(*keys)
            .agg(F.min(snap_col).alias("min_snap_id"), F.max(snap_col).alias("max_snap_id"),
                 F.min(ts).alias("min_begin_ts"), F.max(ts).alias("max_begin_ts")))


def join_snapshots(facts: DataFrame, snaps: DataFrame, on, lo=None, hi=None, snap_col="snap_id",
                   bounds: DataFrame | None = None, bound_keys=("dbid",)) -> DataFrame:
    """Equi-join facts to snapshots, restricted to ``lo <= snap_id <= hi``.  The range
    filter is applied to the snapshot side so it reaches the scan.  ``bounds`` (C4 output:
    per-database ``min_snap_id`` / ``max_snap_id``) restricts each database to its own window
    with an equi-join on the database key plus a range filter (no range join)."""
    if bounds is not None:
        b = bounds.select(*bound_keys, "min_snap_id", "max_snap_id")
        snaps = (snaps.join(b, on=list(bound_keys), how="inner")
                 .where(F.col(snap_col).between(F.col("min_snap_id"), F.col("max_snap_id")))
                 .drop("min_snap_id", "max_snap_id"))
    if lo is not None:
        snaps = snaps.where(F.col(snap_col) >= F.lit(lo))
    if hi is not None:
        snaps = snaps.where(F.col(snap_col) <= F.lit(hi))
    return facts.join(snaps, on=on, how="inner")


def snapshots_as_of(facts: DataFrame, snaps: DataFrame, keys, fact_ts: str, snap_ts: str = "begin_ts",
                    snap_col: str = "snap_id", bucket_seconds: int = 86400) -> DataFrame:
    """C3 time variant: each fact row gets the last snapshot starting at or before it (an
    as-of join, written without a range join).

    Facts and snapshots are cut into time buckets per key.  Inside a bucket the last
    snapshot so far is carried forward over the time-ordered union; the snapshot that
    precedes the bucket comes from a per-bucket ``max_by`` aggregate carried over the
    (small) per-key sequence of buckets.  No task ever holds a whole key."""
    keys = list(keys)
    width = F.lit(bucket_seconds * 1_000_000)
    s = snaps.select(*keys, micros(snap_ts).alias("__t"), F.col(snap_col).alias("__sid"))
    s = s.withColumn("__b", F.floor(F.col("__t") / width))
    f = facts.withColumn("__t", micros(fact_ts)).withColumn("__b", F.floor(F.col("__t") / width))
    both = (f.withColumn("__sid", F.lit(None).cast("long")).withColumn("__kind", F.lit(1))
            .unionByName(s.withColumn("__kind", F.lit(0)), allowMissingColumns=True))
    w = Window.partitionBy(*keys, "__b").orderBy("__t", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    inner = both.withColumn("__in", F.last("__sid", ignorenulls=True).over(w)).where(F.col("__kind") == 1)
    last = s.groupBy(*keys, "__b").agg(F.max_by("__sid", F.struct("__t", "__sid")).alias("__last"))
    # buckets that only hold facts need the carry too: take it from the closest earlier snapshot bucket
    fb = f.select(*keys, "__b").distinct()
    allb = fb.unionByName(last.select(*keys, "__b")).distinct()
    wc = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    prev = (allb.join(last, [*keys, "__b"], "left")
            .withColumn("__carry", F.last("__last", ignorenulls=True).over(wc)).select(*keys, "__b", "__carry"))
    out = inner.join(prev, [*keys, "__b"], "left")
    return (out.withColumn(snap_col, F.coalesce(F.col("__in"), F.col("__carry")))
            .drop("__t", "__b", "__sid", "__kind", "__in", "__carry"))


# ---------------------------------------------------------------------------
# Profiles
# ---------------------------------------------------------------------------

VALUE_BUCKETS = 1024


def value_bucket(value: Column) -> Column:
    """A number's place on a log-linear scale, ``VALUE_BUCKETS`` places for each doubling; it
    never falls as the value grows, so buckets can be ranked one after another."""
    size = F.abs(value.cast("double"))
    power = F.floor(F.log2(size))
    place = power * VALUE_BUCKETS + F.floor((size / F.pow(F.lit(2.0), power) - 1) * VALUE_BUCKETS) + 2048 * VALUE_BUCKETS
    return F.when(value.isNull(), None).when(size == 0, F.lit(0)).otherwise(F.signum(value.cast("double")) * place).cast("long")


def value_profile(df: DataFrame, group, value: str, percentages: dict, sums: dict | None = None) -> DataFrame:
    """Exact statistics of ``value`` per group from one (group, value, count) relation, one plan
    at every size.  Output: group, ``__cnt`` (all rows), ``__n`` (rows with a value), ``__min``,
    ``__max``, ``__sum``, ``__mode`` (smallest of the most frequent), a double per percentage
    (interpolated as Spark's ``percentile`` does) and a sum per expression of ``sums``.

    Rows are counted by group *and* value before anything else (partial aggregate), so equal
    values of a hot group are one row.  Ranks come in two steps: running counts over a group's
    value buckets, then over the values inside one bucket; no task orders a whole group."""
    group, sums = list(group), sums or {}
    counts = (df.groupBy(*group, F.col(value).alias("__v"))
              .agg(F.count(F.lit(1)).alias("__c"), F.sum(value).alias("__s"), *[F.sum(e).alias(n) for n, e in sums.items()])
              .withColumn("__b", value_bucket(F.col("__v"))))
    over = Window.partitionBy(*[f"__k{i}" for i in range(len(group))])
    # no filter and no narrower columns here: both uses of ``counts`` then share one shuffle
    totals = ["__s", *sums]
    buckets = (counts.groupBy(*[F.col(g).alias(f"__k{i}") for i, g in enumerate(group)], F.col("__b").alias("__kb"))
               .agg(F.sum(F.when(F.col("__v").isNotNull(), F.col("__c")).otherwise(0)).alias("__bc"),
                    *[F.sum(t).alias(f"__t_{t}") for t in totals])
               .withColumn("__start", F.sum("__bc").over(over.orderBy("__kb").rowsBetween(Window.unboundedPreceding, 0))
                           - F.col("__bc"))
               .withColumns({"__n": F.sum("__bc").over(over)} | {f"__t_{t}": F.sum(f"__t_{t}").over(over) for t in totals})
               .drop("__bc"))
    same = F.col("__b") == F.col("__kb")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__k{i}"))
    inside = Window.partitionBy(*group, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (counts.join(buckets, same, "left")
              .withColumn("__to", F.col("__start") + F.sum("__c").over(inside))
              .withColumn("__from", F.col("__to") - F.col("__c")))

    def position(p):
        return (F.col("__n") - 1).cast("double") * F.lit(float(p))

    def at(rank):
        return F.max(F.when((F.col("__from") <= rank) & (rank < F.col("__to")), F.col("__v")))

    def total(t):  # of the group, from its buckets; groups of nulls alone meet no bucket
        return F.coalesce(F.max(f"__t_{t}"), F.sum(t))

    picks = [a for n, p in percentages.items()
             for a in (at(F.floor(position(p))).alias(f"__lo_{n}"), at(F.ceil(position(p))).alias(f"__hi_{n}"))]
    out = ranked.groupBy(*group).agg(
        F.sum("__c").alias("__cnt"), F.max("__n").alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"),
        total("__s").alias("__sum"),
        F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(F.col("__c"), -F.col("__v")))).alias("__mode"),
        *picks, *[total(n).alias(n) for n in sums])
    cells = []
    for n, p in percentages.items():
        lo, hi = F.col(f"__lo_{n}").cast("double"), F.col(f"__hi_{n}").cast("double")
        lower, upper = F.floor(position(p)).cast("double"), F.ceil(position(p)).cast("double")
        cells.append(F.when((lower == upper) | (lo == hi), lo)
                     .otherwise((upper - position(p)) * lo + (position(p) - lower) * hi).alias(n))
    return out.select(*group, "__cnt", "__n", "__min", "__max", "__sum", "__mode", *cells, *sums)


def hourly_profile(df: DataFrame, keys=COUNTER_KEYS, value: str = "value_delta", ts: str = "begin_ts") -> DataFrame:
    """Per hour of day and key - count, avg, mode, median, min, max, sum and
    P50/75/90/95/100, each rounded half away from zero."""
    group = [*keys, "hour"]
    p = value_profile(df.withColumn("hour", hour_of(ts)), group, value, PROFILE_PERCENTILES)
    return p.select(*group, F.col("__cnt").alias("cnt"), F.round(F.col("__sum") / F.col("__n")).alias("avg_value"),
                    F.round("__mode").alias("mode_value"), F.round("perc50").alias("median_value"),
                    F.round("__min").alias("min_value"), F.round("__max").alias("max_value"),
                    F.round("__sum").alias("sum_value"), *[F.round(n).alias(n) for n in PROFILE_PERCENTILES])


def os_stat_profile(df: DataFrame, keys=COUNTER_KEYS, ts: str = "begin_ts", end_ts: str = "end_ts",
                    counter_names=OS_COUNTER_STATS, bucket_width: int | None = 1 << 16) -> DataFrame:
    """C2 deltas, then per key and hour: total interval seconds, avg cumulative value and
    the C5 statistics.  The reference averages window percentiles over the same group,
    which equals the group percentile, so it is one aggregate here."""
    staged = counter_or_gauge(df, counter_names=counter_names, keys=keys, bucket_width=bucket_width)
    staged = staged.withColumn("__us", micros(end_ts) - micros(ts)).withColumn("hh24", hour_of(ts))
    group = [*keys, "hh24"]
    p = value_profile(staged, group, "delta_value", PROFILE_PERCENTILES, sums={
        "__secs": F.col("__us"), "__total": F.col("value"), "__values": F.when(F.col("value").isNotNull(), 1).otherwise(0)})
    return p.select(*group, F.round(F.col("__secs") / F.lit(1e6)).alias("hh24_total_secs"),
                    F.round(F.col("__total") / F.nullif("__values", F.lit(0))).alias("cumulative_value"),
                    F.round(F.col("__sum") / F.col("__n")).alias("avg_value"), F.round("__mode").alias("mode_value"),
                    F.round("perc50").alias("median_value"), *[F.round(n).alias(n) for n in PROFILE_PERCENTILES],
                    F.round("__min").alias("min_value"), F.round("__max").alias("max_value"),
                    F.round("__sum").alias("sum_value"), F.col("__cnt").alias("count"))


def peak_expr(avg="average", sd="standard_deviation", mn="minval", mx="maxval") -> Column:
    """C7 peak estimate: avg + 2 sigma, sigma treated as 0 when 0.999 < sigma < 1, min = 0
    and avg = max (a single-sample artefact)."""
    sigma = F.when((F.col(sd) > 0.999) & (F.col(sd) < 1) & (F.col(mn) == 0) & (F.col(avg) == F.col(mx)),
                   F.lit(0.0)).otherwise(F.col(sd))
    return F.col(avg) + F.lit(2) * sigma


def peak_metric_profile(df: DataFrame, keys=("pkey", "dbid", "instance_number", "metric_name"),
                        ts: str = "begin_ts") -> DataFrame:
    """C5 over the per-sample peak estimate."""
    return hourly_profile(df.withColumn("peak_value", peak_expr()), keys=list(keys), value="peak_value", ts=ts)


def peak_from_samples(df: DataFrame, keys=("pkey", "dbid", "instance_number", "metric_name"),
                      value: str = "value", ts: str = "begin_ts") -> DataFrame:
    """Avg and sigma are aggregates of the raw value over (keys, hour); the peak is then
    constant inside the group, so its profile collapses into one ``groupBy``."""
    g = (df.withColumn("hour", hour_of(ts)).groupBy(*keys, "hour")
         .agg(F.count(F.lit(1)).alias("cnt"), F.avg(value).alias("average"),
              F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("standard_deviation"),
              F.min(value).alias("minval"), F.max(value).alias("maxval")))
    peak = F.round(peak_expr())
    return g.select(*keys, "hour", "cnt",
                    peak.alias("avg_value"), peak.alias("mode_value"), peak.alias("median_value"),
                    peak.alias("min_value"), peak.alias("max_value"),
                    F.round(peak_expr() * F.col("cnt")).alias("sum_value"),
                    *[peak.alias(n) for n in PROFILE_PERCENTILES])


P95_P100 = {"p95": 0.95, "p100": 1.0}


def _counter_percentiles(df: DataFrame, group, counters) -> DataFrame:
    """P95 and P100 (not rounded) of each counter's delta per group: the counters as rows, one
    ``value_profile`` over all of them, and back to columns."""
    group = list(group)
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.col(c + "_delta").cast("double").alias("v"))
                                for i, c in enumerate(counters)])).alias("__cell")
    long = df.select(*group, cells).select(*group, F.col("__cell.which").alias("__which"), F.col("__cell.v").alias("__delta"))
    p = value_profile(long, [*group, "__which"], "__delta", P95_P100)
    return p.groupBy(*group).agg(*[F.max(F.when(F.col("__which") == i, F.col(q))).alias(f"{c}_{q}")
                                   for i, c in enumerate(counters) for q in P95_P100])


IO_EVENT_COUNTERS = ["total_waits", "total_timeouts", "time_waited_micro"]


def io_event_profile(df: DataFrame, keys=("pkey", "dbid", "instance_number", "wait_class", "event_name"),
                     order="snap_id", ts="begin_ts", counters=IO_EVENT_COUNTERS,
                     bucket_width: int | None = 1 << 16) -> DataFrame:
    """I/O wait classes only; deltas of the counters on one window; P95 and P100 per
    hour and event."""
    keys = list(keys)
    kept = df.where(F.col("wait_class").isin(*IO_WAIT_CLASSES))
    d = counter_delta(kept, keys=keys, order=order, values=counters, bucket_width=bucket_width)
    group = [*keys, "hour"]
    p = _counter_percentiles(d.withColumn("hour", hour_of(ts)), group, counters)
    return p.select(*group, *[F.round(f"{c}_{q}").alias(f"{c}_{q}") for c in counters for q in P95_P100])


IO_FUNCTION_COUNTERS = ["sm_read_bytes", "sm_write_bytes", "sm_read_reqs", "sm_write_reqs",
                        "lg_read_bytes", "lg_write_bytes", "lg_read_reqs", "lg_write_reqs",
                        "number_of_waits", "wait_time"]


def io_function_profile(df: DataFrame, keys=("pkey", "dbid", "instance_number", "function_name"),
                        order="snap_id", ts="begin_ts", counters=IO_FUNCTION_COUNTERS,
                        bucket_width: int | None = 1 << 16) -> DataFrame:
    """Deltas of 10 counters (one window); P95 / P100 each; totals small + large are
    the sum of the unrounded percentiles, rounded after adding."""
    keys = list(keys)
    d = counter_delta(df, keys=keys, order=order, values=counters, bucket_width=bucket_width)
    group = [*keys, "hour"]
    p = _counter_percentiles(d.withColumn("hour", hour_of(ts)), group, counters)
    totals = [F.round(F.col(f"sm_{kind}_{q}") + F.col(f"lg_{kind}_{q}")).alias(f"tot_{kind}_{q}")
              for kind in ("read_bytes", "write_bytes", "read_reqs", "write_reqs") for q in P95_P100]
    return p.select(*group, *[F.round(f"{c}_{q}").alias(f"{c}_{q}") for c in counters for q in P95_P100], *totals)


def snapshot_intervals(snaps: DataFrame, keys=("dbid",), order="snap_id", ts="begin_ts",
                       startup="startup_tag", form: str = "statspack", end_ts: str = "end_ts",
                       bucket_width: int | None = 1 << 16) -> DataFrame:
    """C11: seconds per snapshot; rows whose startup marker differs from the previous row of
    the key (restart, and the first row) are dropped; per hour: ids, times, count and
    statistics of the seconds.  ``form="awr"``: seconds = end - begin, times formatted
    ``yyyy-MM-dd HH:mm:ss``; ``form="statspack"``: seconds = this begin - previous begin
    (0 when none).  The lag uses the range-split kernel (no whole key in one task), the
    statistics ``value_profile``."""
    keys = list(keys)
    s = (snaps.withColumn("__tsu", micros(ts))
         .transform(lambda d: previous_values(d, keys, order, ["__tsu", startup], bucket_width=bucket_width)))
    if form == "awr":
        secs = (micros(end_ts) - micros(ts)) / F.lit(1e6)
    else:
        secs = F.coalesce(F.col("__tsu") - F.col("prev___tsu"), F.lit(0)) / F.lit(1e6)
    s = s.withColumn("secs", secs).where(F.col(startup) == F.col("prev_" + startup))
    def t(c):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss") if form == "awr" else c
    group = [*keys, "hour"]
    hours = s.withColumn("hour", hour_of(ts))
    ends = hours.groupBy(*group).agg(F.min(order).alias("min_snap_id"), F.max(order).alias("max_snap_id"),
                                     t(F.min(ts)).alias("min_begin_ts"), t(F.max(ts)).alias("max_begin_ts"))
    p = value_profile(hours, group, "secs", {"__median": 0.5})
    named = ends.select(*[F.col(g).alias(f"__e{i}") for i, g in enumerate(group)],
                        "min_snap_id", "max_snap_id", "min_begin_ts", "max_begin_ts")
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__e{i}")) for i, g in enumerate(group)])
    return p.join(named, same).select(
        *group, "min_snap_id", "max_snap_id", "min_begin_ts", "max_begin_ts", F.col("__cnt").alias("cnt"),
        F.round("__sum").alias("sum_secs"), F.round(F.col("__sum") / F.col("__n")).alias("avg_secs"),
        F.round("__median").alias("median_secs"), F.round("__mode").alias("mode_secs"),
        F.round("__min").alias("min_secs"), F.round("__max").alias("max_secs"))


SNAPSHOT_KEYS = ["dbid", "instance_number", "snap_id"]
COMMAND_MEASURES = ["buffer_gets", "elapsed_time", "rows_processed", "executions", "cpu_time", "iowait", "clwait",
                    "apwait", "ccwait", "plsexec_time"]


def command_profile(stats: DataFrame, text: DataFrame, snaps: DataFrame, names: DataFrame,
                    keys=("pkey",), ts="begin_ts") -> DataFrame:
    """Statements x statement text x snapshots of the same collection, database and
    instance (inner); per hour and command type: count and the rounded averages of 10 measures.
    Command names join (left) the aggregate, not the statements."""
    j = (stats.join(text, on=[*keys, "sql_id"], how="inner")
         .join(snaps.select(*keys, *SNAPSHOT_KEYS, ts), on=[*keys, *SNAPSHOT_KEYS], how="inner"))
    aggs = [F.count(F.lit(1)).alias("cnt")] + [F.round(F.avg(m)).alias("avg_" + m) for m in COMMAND_MEASURES]
    return (j.withColumn("hh24", hour_of(ts)).groupBy(*keys, "hh24", "command_type").agg(*aggs)
            .join(names, on="command_type", how="left"))


def source_connections(sessions: DataFrame, snaps: DataFrame, commands: DataFrame, keys=("pkey",),
                       ts="begin_ts") -> DataFrame:
    """Foreground sessions joined to the snapshots of the same collection, database and
    instance; count per hour, database, instance, program, module, machine and command (``|`` in
    the text columns replaced by ``_``).  The command table joins (inner) the aggregate; names
    that several command types share are added up."""
    j = (sessions.where(F.col("session_type") == "FOREGROUND")
         .join(snaps.select(*keys, *SNAPSHOT_KEYS, ts), on=[*keys, *SNAPSHOT_KEYS], how="inner"))
    group = [*keys, "dbid", "instance_number", "hour", "program", "module", "machine"]
    clean = {c: F.replace(F.col(c), F.lit("|"), F.lit("_")) for c in ("program", "module", "machine")}
    return (j.withColumn("hour", hour_of(ts)).withColumns(clean)
            .groupBy(*group, "command_type").agg(F.count(F.lit(1)).alias("cnt"))
            .join(commands, on="command_type", how="inner")
            .groupBy(*group, "command_name").agg(F.sum("cnt").alias("cnt")))


def top_statements(stats: DataFrame, n: int = 299, keys=("pkey",), byte_columns=(),
                   bytes_unavailable: bool = False) -> DataFrame:
    """C14: per statement signature: ``min(sql_id)``, sums and truncated per-execution
    ratios; the ``n`` largest by total elapsed per database (``row_number``; Spark pushes
    the rank limit below the shuffle, so each task keeps only its local top ``n``).
    ``byte_columns`` are summed into ``<col>_total``; the 11.1 form has no byte counters and
    reports -1 for them (``bytes_unavailable``)."""
    keys = list(keys)
    extra = [(F.lit(-1).cast("long") if bytes_unavailable else F.round(F.sum(c)).cast("long")).alias(c + "_total")
             for c in byte_columns]
    g = (stats.groupBy(*keys, "signature")
         .agg(F.min("sql_id").alias("sql_id"), F.sum("executions").alias("executions"),
              F.sum("elapsed").alias("elapsed"), F.sum("rows_processed").alias("rows_processed"), *extra))
    g = (g.withColumn("elapsed_per_exec", safe_ratio("elapsed", "executions"))
         .withColumn("rows_per_exec", safe_ratio("rows_processed", "executions")))
    w = Window.partitionBy(*keys).orderBy(F.col("elapsed").desc(), F.col("signature"))
    return g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


# output column -> counter summed over the statement's snapshots
STATEMENT_TOTALS = {
    "total_executions": "executions_delta", "total_px_servers_execs": "px_servers_execs_delta",
    "elapsed_time_total": "elapsed_time_total", "disk_reads_total": "disk_reads_delta",
    "physical_read_bytes_total": "physical_read_bytes_delta", "physical_write_bytes_total": "physical_write_bytes_delta",
    "io_offload_elig_bytes_total": "io_offload_elig_bytes_delta",
    "io_interconnect_bytes_total": "io_interconnect_bytes_delta",
    "optimized_physical_reads_total": "optimized_physical_reads_delta",
    "cell_uncompressed_bytes_total": "cell_uncompressed_bytes_delta",
    "io_offload_return_bytes_total": "io_offload_return_bytes_delta", "direct_writes_total": "direct_writes_delta",
}
# output column -> counter averaged over executions
STATEMENT_AVERAGES = {
    "avg_rows": "rows_processed_delta", "avg_disk_reads": "disk_reads_delta", "avg_buffer_gets": "buffer_gets_delta",
    "avg_cpu_time_us": "cpu_time_delta", "avg_elapsed_us": "elapsed_time_delta", "avg_iowait_us": "iowait_delta",
    "avg_clwait_us": "clwait_delta", "avg_apwait_us": "apwait_delta", "avg_ccwait_us": "ccwait_delta",
    "avg_plsexec_us": "plsexec_time_delta", "avg_javexec_us": "javexec_time_delta",
}


def statement_profile(stats: DataFrame, snapshots: DataFrame, lo: int, hi: int, n: int = 299) -> DataFrame:
    """C14 in full: statements of the snapshots ``lo`` to ``hi`` per database, instance and
    signature, with all totals and averages per execution; the ``n`` of largest elapsed time for
    each collection (ties: instance, then signature).

    Snapshots outside the bounds are cut at both scans, and counters are summed per snapshot
    before the join, so a hot statement meets its snapshots as one row each.  Averages are
    truncated and 0 where nothing ran.  A counter that the collected version lacks gives -1
    as total and null as average."""
    key = ["pkey", "con_id", "dbid", "instance_number", "force_matching_signature"]
    per = ["pkey", "dbid", "instance_number", "snap_id"]
    counters = list(dict.fromkeys([*STATEMENT_TOTALS.values(), *STATEMENT_AVERAGES.values(), "end_of_fetch_count_delta"]))
    held = [c for c in counters if c in stats.columns]
    inside = F.col("snap_id").between(lo, hi)
    summed = stats.where(inside).groupBy(*key, "snap_id").agg(F.min("sql_id").alias("sql_id"), *[F.sum(c).alias(c) for c in held])
    g = (summed.join(snapshots.where(inside).select(*per).distinct(), per).groupBy(*key)
         .agg(F.min("sql_id").alias("sql_id"), *[F.sum(c).alias(c) for c in held]))
    runs = F.col("executions_delta")

    def per_run(c, factor=1) -> Column:
        if c not in held:
            return F.lit(None).cast("long")
        return F.when(runs == 0, F.lit(0)).otherwise(F.col(c) * factor / runs).cast("long")

    out = g.select(*key, "sql_id",
                   *[(F.round(c).cast("long") if c in held else F.lit(-1).cast("long")).alias(name)
                     for name, c in STATEMENT_TOTALS.items()],
                   per_run("end_of_fetch_count_delta", 100).alias("perc_exec_finished"),
                   *[per_run(c).alias(name) for name, c in STATEMENT_AVERAGES.items()])
    w = Window.partitionBy("pkey").orderBy(F.desc_nulls_last("elapsed_time_total"), "con_id", "dbid", "instance_number",
                                           "force_matching_signature")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def _since(df: DataFrame, ts: str, as_of, days):
    """Rows with ``ts >= trunc(as_of) - days`` (the extracts' history window)."""
    if days is None:
        return df
    return df.where(F.col(ts) >= F.date_sub(F.to_date(F.lit(as_of)), int(days)).cast("timestamp_ntz"))


def log_volume(logs: DataFrame, keys=("pkey",), ts="first_time", as_of=None, days: int | None = None) -> DataFrame:
    """Per day, hour, thread and destination: log count and MB =
    round(sum(blocks * block_size) / 2^20)."""
    return (_since(logs, ts, as_of, days)
            .withColumn("log_start_date", F.to_date(ts)).withColumn("hour", hour_of(ts))
            .groupBy(*keys, "log_start_date", "hour", F.col("thread").alias("thread_num"), "dest_id")
            .agg(F.count(F.lit(1)).alias("cnt"),
                 F.round(F.sum(F.col("blocks") * F.col("block_size")) / F.lit(1048576.0)).alias("mbytes")))


def backup_volume(jobs: DataFrame, keys=("pkey",), ts="start_time", as_of=None, days: int | None = None) -> DataFrame:
    """Per day and input type: seconds, MB in, MB out (each rounded)."""
    return (_since(jobs, ts, as_of, days)
            .withColumn("backup_start_date", F.to_date(ts)).groupBy(*keys, "backup_start_date", "input_type")
            .agg(F.round(F.sum("elapsed_seconds")).alias("elapsed_seconds"),
                 F.round(F.sum("input_bytes") / F.lit(1048576.0)).alias("mbytes_in"),
                 F.round(F.sum("output_bytes") / F.lit(1048576.0)).alias("mbytes_out")))


def hour_matrix(events: DataFrame, keys=("pkey",), ts="ts", size_col: str | None = None, as_of=None) -> DataFrame:
    """C17: one row per day (``MM/dd/yyyy`` and day of month) with 24 hour columns.
    Count form: total_logs_generated, h0_count..h23_count, avg_per_hour = count div 24
    (integer division before the ceiling).  Size form: hN_size_in_mb cells sum
    ceil(bytes / 2^20), total = ceil(round(sum)), avg_mb_per_hour = ceil(round(sum / 24)).
    Rows at or after ``as_of`` are left out."""
    hour = F.hour(ts)
    e = events if as_of is None else events.where(F.col(ts) < F.to_timestamp(F.lit(as_of)))
    e = e.withColumn("collection_date", F.date_format(ts, "MM/dd/yyyy")).withColumn("day_of_month", F.dayofmonth(ts))
    g = [*keys, "collection_date", "day_of_month"]
    if size_col is None:
        cells = [F.sum(F.when(hour == h, 1).otherwise(0)).alias(f"h{h}_count") for h in range(24)]
        return (e.groupBy(*g).agg(F.count(F.lit(1)).alias("total_logs_generated"), *cells)
                .withColumn("avg_per_hour", F.expr("total_logs_generated div 24")))
    mb = F.ceil(F.col(size_col) / F.lit(1048576.0))
    cells = [F.sum(F.when(hour == h, mb).otherwise(0)).alias(f"h{h}_size_in_mb") for h in range(24)]
    total_mb = F.sum(F.col(size_col) / F.lit(1048576.0))
    return e.groupBy(*g).agg(F.ceil(F.round(total_mb)).alias("total_logs_generated_in_mb"), *cells,
                             F.ceil(F.round(total_mb / F.lit(24.0))).alias("avg_mb_per_hour"))


def counter_pivot(counters: DataFrame, names, keys=("pkey",), name_col="counter_name", value="value",
                  ratio=None, digits: int | None = None) -> DataFrame:
    """Long counters -> one wide row per key (pivot over a fixed name list, avg);
    ``ratio=(out, num, den)`` adds round(100 * num / den), 0 when den is 0; ``digits``
    rounds the averages for reporting."""
    wide = counters.groupBy(*keys).pivot(name_col, list(names)).agg(F.avg(value))
    if digits is not None:
        wide = wide.select(*keys, *[F.round(F.col(n), digits).alias(n) for n in names])
    if ratio:
        out, num, den = ratio
        wide = wide.withColumn(out, F.round(F.when(F.col(den) == 0, F.lit(0.0))
                                            .otherwise(F.lit(100.0) * F.col(num) / F.col(den))))
    return wide


_HEALTH = "Record/SchedulerMonitorEvent/SystemHealth/"
HEALTH_PATHS = {"record_id": "Record/@id", "idle": _HEALTH + "SystemIdle", "sql_cpu": _HEALTH + "ProcessUtilization",
                "user_mode_time": _HEALTH + "UserModeTime", "kernel_mode_time": _HEALTH + "KernelModeTime",
                "memory_utilization": _HEALTH + "MemoryUtilization"}


def health_samples(records: DataFrame, now_col="now_ts", ticks_now_col="ms_ticks", record_col="record",
                   stamp_col="timestamp_ms") -> DataFrame:
    """Ring-buffer XML record -> six numbers; idle 0 becomes 100 - process use;
    event time = now - (ticks_now - stamp) ms.

    A record is parsed once: one XPath writes all numbers into one text, which is then cut up.
    Numbers are XPath's as ``xpath_long`` returns them: 0 where an element is missing or no number,
    without fraction, the nearest long beyond the longs."""
    all_numbers = "concat(" + ", ' ', ".join(f"number({p})" for p in HEALTH_PATHS.values()) + ")"
    parsed = records.withColumn("__n", F.split(F.xpath_string(F.col(record_col), F.lit(all_numbers)), " "))

    def num(name):
        d = F.get("__n", F.lit(list(HEALTH_PATHS).index(name))).cast("double")
        return (F.when(F.isnan(d), F.lit(0).cast("long")).when(d >= F.lit(2.0 ** 63), F.lit((1 << 63) - 1))
                .when(d <= F.lit(-2.0 ** 63), F.lit(-1 << 63)).otherwise(d.cast("long")))

    numbers = parsed.select("pkey", *[num(n).alias(n) for n in HEALTH_PATHS], now_col, ticks_now_col, stamp_col)
    idle, proc = F.col("idle"), F.col("sql_cpu")
    return numbers.select(
        "pkey", "record_id", F.when(idle == 0, F.lit(100) - proc).otherwise(idle).alias("system_idle"), "sql_cpu",
        "user_mode_time", "kernel_mode_time", "memory_utilization",
        (F.col(now_col) - F.make_dt_interval(secs=(F.col(ticks_now_col) - F.col(stamp_col)) / F.lit(1000.0)))
        .alias("event_time"),
    )


def file_io_summary(stats: DataFrame, keys=("pkey",)) -> DataFrame:
    """C20: per database: summed reads, writes, stalls, bytes and sample times; bytes/op, ms/op
    and ops/s with zero guards."""
    g = stats.groupBy(*keys).agg(
        F.sum("num_of_reads").alias("reads"), F.sum("num_of_writes").alias("writes"),
        F.sum("io_stall_read_ms").alias("read_stall_ms"), F.sum("io_stall_write_ms").alias("write_stall_ms"),
        F.sum("bytes_read").alias("bytes_read"), F.sum("bytes_written").alias("bytes_written"),
        F.sum("sample_ms").alias("sample_ms"))
    ops = F.col("reads") + F.col("writes")
    return g.select(*keys, "reads", "writes", "read_stall_ms", "write_stall_ms", "bytes_read", "bytes_written",
                    F.round(safe_ratio("bytes_read", "reads", truncate=False), 2).alias("bytes_per_read"),
                    F.round(safe_ratio("bytes_written", "writes", truncate=False), 2).alias("bytes_per_write"),
                    F.round(safe_ratio("read_stall_ms", "reads", truncate=False), 2).alias("ms_per_read"),
                    F.round(safe_ratio("write_stall_ms", "writes", truncate=False), 2).alias("ms_per_write"),
                    F.round(safe_ratio(ops, F.col("sample_ms") / F.lit(1000.0), truncate=False), 2)
                    .alias("ops_per_sec"))


def snapshot_coverage(collections: DataFrame, snaps: DataFrame, as_of, keys=("pkey",), ts="begin_ts",
                      min_days: int = 7, min_per_day: int = 20) -> DataFrame:
    """Whole days spanned and snapshots per day up to the start of the day ``as_of``; FAILED
    for collections without snapshots or without a whole day of them, WARNING when the span or
    the rate is short, else SUCCESS."""
    g = snaps.where(F.col(ts) <= F.lit(as_of).cast("timestamp")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("snap_count"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    g = collections.select(*keys).distinct().join(g, on=list(keys), how="left").fillna(0, ["snap_count"])
    g = g.withColumn("days", F.floor((micros("last_ts") - micros("first_ts")) / F.lit(86400e6)).cast("long"))
    g = g.withColumn("snaps_per_day", F.round(F.col("snap_count") / F.nullif("days", F.lit(0)), 2))
    status = (F.when((F.col("snap_count") == 0) | (F.col("days") == 0), F.lit("FAILED"))
              .when((F.col("days") < min_days) | (F.col("snaps_per_day") < min_per_day), F.lit("WARNING"))
              .otherwise(F.lit("SUCCESS")))
    return g.withColumn("status", status)


def redo_per_day(history: DataFrame, logs: DataFrame, as_of, keys=("pkey",), ts="first_time") -> DataFrame:
    """round(avg(log switches per day) * avg(log bytes) / 2^30), today excluded.
    Both sides are aggregated per database first, then joined on the key."""
    keys = list(keys)
    per_day = (history.where(F.to_date(ts) < F.to_date(F.lit(as_of)))
               .groupBy(*keys, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("switches"))
               .groupBy(*keys).agg(F.avg("switches").alias("avg_switches")))
    size = logs.groupBy(*keys).agg(F.avg("bytes").alias("avg_log_bytes"))
    return per_day.join(size, on=keys, how="inner").select(
        *keys, F.round(F.col("avg_switches") * F.col("avg_log_bytes") / F.lit(1073741824.0)).alias("redo_gb_per_day"))
