"""Column expressions shared by the jobs (all JVM-side built-ins, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num, den, truncate: bool = True) -> Column:
    """``decode(den, 0, 0, num/den)`` truncated toward zero; null stays null."""
    num, den = col(num), col(den)
    ratio = F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))
    if truncate:
        ratio = F.signum(ratio) * F.floor(F.abs(ratio))
    return ratio


def line_count(c, dialect: str = "pg") -> Column:
    """Lines of a text.  ``pg``: len + 1 - len(without LF);
    ``mssql``: len - len(without LF) where LEN ignores trailing spaces, null -> 0."""
    c = col(c)
    if dialect == "pg":
        return F.length(c) + 1 - F.length(F.regexp_replace(c, "\n", ""))
    trimmed = F.rtrim(c)
    return F.coalesce(F.length(trimmed) - F.length(F.regexp_replace(trimmed, "\n", "")), F.lit(0))


def normalize_data_type(c) -> Column:
    """A single-digit precision ``(n)`` becomes ``(x)``."""
    return F.regexp_replace(col(c), r"\([0-9]\)", "(x)")


def sanitize_text(c, length: int | None = None, replacement: str = " ") -> Column:
    """Truncate first, then delimiter, quote, CR, LF -> replacement."""
    c = col(c)
    if length is not None:
        c = F.substring(c, 1, length)
    return F.translate(c, '|"\r\n', replacement * 4)


def classify_trigger(tgtype) -> Column:
    """Trigger type bitmask -> ``<TIMING>_<EVENTS>_TRIGGER``: ``& 66`` gives BEFORE (2),
    INSTEAD_OF (64) or AFTER (anything else); ``& 28`` gives the event combination; an
    unknown combination makes the whole label null."""
    t = col(tgtype)
    timing = (F.when(t.bitwiseAND(66) == 2, F.lit("BEFORE")).when(t.bitwiseAND(66) == 64, F.lit("INSTEAD_OF"))
              .otherwise(F.lit("AFTER")))
    ev = t.bitwiseAND(28)
    # fixed values: event bit combinations (4 insert, 8 delete, 16 update)
    events = (F.when(ev == 16, F.lit("UPDATE")).when(ev == 8, F.lit("DELETE")).when(ev == 4, F.lit("INSERT"))
              .when(ev == 20, F.lit("INSERT_UPDATE")).when(ev == 28, F.lit("INSERT_UPDATE_DELETE"))
              .when(ev == 24, F.lit("UPDATE_DELETE")).when(ev == 12, F.lit("INSERT_DELETE")))
    return F.concat(timing, F.lit("_"), events, F.lit("_TRIGGER"))


def normalize_timestamp(c) -> Column:
    """``dd.mm.yyyy`` and ``mm-dd-yyyy`` get ``/`` separators; ``yyyy-mm-dd`` becomes
    ``mm/dd/yyyy`` with ``.000`` appended when milliseconds are absent; others unchanged."""
    c = col(c)
    dotted = r"^(\d{2})\.(\d{2})\.(\d{4})(.*)$"
    dashed = r"^(\d{2})-(\d{2})-(\d{4})(.*)$"
    iso = r"^(\d{4})-(\d{2})-(\d{2})(.*)$"
    iso_fmt = F.regexp_replace(c, iso, "$2/$3/$1$4")
    return (F.when(c.rlike(dotted), F.regexp_replace(c, dotted, "$1/$2/$3$4"))
            .when(c.rlike(dashed), F.regexp_replace(c, dashed, "$1/$2/$3$4"))
            .when(c.rlike(iso), F.when(c.rlike(r"\.\d+$"), iso_fmt).otherwise(F.concat(iso_fmt, F.lit(".000"))))
            .otherwise(c))


def major_version(c, family: str = "9") -> Column:
    """A10 major: text before ``beta`` plus ``.0`` when ``beta`` occurs; versions starting with the
    family digit (9 for Postgres, 5 for MySQL) keep two dotted parts, others one; unparsable -> -1.0."""
    c = col(c)
    cut = F.when(F.instr(c, "beta") > 0, F.concat(F.substring_index(c, "beta", 1), F.lit(".0"))).otherwise(c)
    parts = F.split(cut, r"\.")
    picked = F.when(cut.startswith(family), F.concat_ws(".", F.slice(parts, 1, 2))).otherwise(parts.getItem(0))
    return F.coalesce(picked.try_cast("double"), F.lit(-1.0))


def minor_version(c, family: str = "9") -> Column:
    """A10 minor: leading ``\\d+\\.\\d+(\\.\\d+)?``; third part for the two-part family, else
    second; no match or no such part -> -1."""
    c = col(c)
    m = F.regexp_extract(c, r"^(\d+\.\d+(\.\d+)?)", 1)
    parts = F.split(m, r"\.")
    picked = F.when(c.startswith(family), F.get(parts, 2)).otherwise(F.get(parts, 1))
    return F.when(m == "", F.lit(-1)).otherwise(F.coalesce(picked.try_cast("int"), F.lit(-1)))


def hour_of(ts) -> Column:
    """``to_char(ts, 'hh24')``."""
    return F.date_format(col(ts), "HH")


def micros(ts) -> Column:
    """Microseconds since the epoch of a zone-less or zoned timestamp (UTC session)."""
    return F.unix_micros(col(ts).cast("timestamp"))
