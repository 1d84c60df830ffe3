"""Findings whose text is a list of any length.

A collection may have a million tables without a primary key, so no finding's text is built
from one collected list.  Items get their place in the text from running lengths: rows are
range-partitioned in text order, each (list, database, partition) adds up its own lengths,
those few sums are accumulated, and every item then knows the character at which it starts.
Items that start in the same ``PART_CHARS`` characters form one finding row; ``part`` numbers
the rows of a list, and their texts put together in that order are the whole text.

Item frames have ``ITEM_COLS``: ``migration_target`` is null where the finding holds for
every target, ``opening`` and ``closing`` enclose a database's items, ``ord`` and ``item``
order them.  Equal items are all kept.  Null items, openings and closings count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.session import ensure_checkpoint_dir

PART_CHARS = 1 << 20
LIST = ["pkey", "migration_target", "rule_code", "severity"]
ITEM_COLS = [*LIST, "database_name", "opening", "ord", "item", "closing"]


def items_of(frame: DataFrame, rule_code: str, severity: str, item, ord=0, opening="", closing="",
             target=None) -> DataFrame:
    """Rows of ``frame`` (pkey, database_name) as items of one list; strings are literal texts."""
    def text(v) -> Column:
        return F.coalesce(v if isinstance(v, Column) else F.lit(v), F.lit(""))

    return frame.select(
        "pkey", (F.lit(None).cast("string") if target is None else F.col(target)).alias("migration_target"),
        F.lit(rule_code).alias("rule_code"), F.lit(severity).alias("severity"), "database_name",
        text(opening).alias("opening"), (ord if isinstance(ord, Column) else F.lit(ord)).cast("int").alias("ord"),
        text(item).alias("item"), text(closing).alias("closing"))


def _per_list(formats: dict, position: int) -> Column:
    """The text at ``position`` of the row's list format, as one literal map."""
    cells = [F.lit(x) for (rule, severity), f in formats.items() for x in (f"{rule}|{severity}", f[position])]
    return F.create_map(*cells)[F.concat("rule_code", F.lit("|"), "severity")]


def placed_items(items: DataFrame, formats: dict) -> DataFrame:
    """Every item with its ``text`` (separators and enclosing texts included) and ``start``, the
    character of the list's text at which it begins.

    ``formats`` maps (rule, severity) to (prefix, separator of items, separator of databases,
    suffix)."""
    ensure_checkpoint_dir(items.sparkSession)
    db = [*LIST, "database_name"]
    # the partition number is part of the data from here on: stored once, never computed anew
    rows = (items.select(*ITEM_COLS).repartitionByRange(*db, "ord", "item")
            .withColumn("__p", F.spark_partition_id()).checkpoint())
    sums = rows.groupBy(*db, "__p").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("item")).alias("chars"),
                                        F.max(F.length("opening")).alias("o"), F.max(F.length("closing")).alias("c"))
    in_db = Window.partitionBy(*db).orderBy("__p")
    in_list = Window.partitionBy(*LIST).orderBy("database_name", "__p")
    back = Window.partitionBy(*LIST).orderBy(F.desc("database_name"), F.desc("__p"))
    db_back = Window.partitionBy(*db).orderBy(F.desc("__p"))
    prefix, between, db_between, suffix = (_per_list(formats, i) for i in range(4))
    sums = (sums.withColumn("opens", F.row_number().over(in_db) == 1)
            .withColumn("closes", F.row_number().over(db_back) == 1)
            .withColumn("first", F.row_number().over(in_list) == 1)
            .withColumn("last", F.row_number().over(back) == 1))
    lead = F.when(F.col("first"), F.length(prefix)).when(F.col("opens"), F.length(db_between)).otherwise(0)
    chars = (F.col("chars") + lead + (F.col("n") - F.col("opens").cast("int")) * F.length(between)
             + F.when(F.col("opens"), F.col("o")).otherwise(0) + F.when(F.col("closes"), F.col("c")).otherwise(0)
             + F.when(F.col("last"), F.length(suffix)).otherwise(0))
    sums = sums.withColumn("chars", chars).withColumn("base", F.sum("chars").over(in_list) - F.col("chars"))
    sums = sums.select(*db, "__p", "n", "opens", "closes", "first", "last", "base").alias("s")

    here = Window.partitionBy(*db, "__p").orderBy("ord", "item")
    same = F.lit(True)
    for c in [*db, "__p"]:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
    placed = (rows.withColumn("__n", F.row_number().over(here)).alias("r").join(sums, same)
              .select("r.*", "s.n", "s.opens", "s.closes", "s.first", "s.last", "s.base"))
    at_start, at_end = F.col("__n") == 1, F.col("__n") == F.col("n")
    text = F.concat(
        F.when(at_start & F.col("first"), prefix).when(at_start & F.col("opens"), db_between).otherwise(between),
        F.when(at_start & F.col("opens"), F.col("opening")).otherwise(""), F.col("item"),
        F.when(at_end & F.col("closes"), F.col("closing")).otherwise(""),
        F.when(at_end & F.col("last"), suffix).otherwise(""))
    so_far = F.sum(F.length("text")).over(Window.partitionBy(*db, "__p").orderBy("__n"))
    return (placed.withColumn("text", text).withColumn("start", F.col("base") + so_far - F.length("text"))
            .select(*db, "ord", "item", "__n", "text", "start"))


def list_findings(items: DataFrame, formats: dict, targets, part_chars: int = PART_CHARS) -> DataFrame:
    """Findings (with ``part``, from 0) of the lists in ``items``.  A part holds the items that
    start within its ``part_chars`` characters, so it is longer by less than one item; parts
    inside a longer item do not exist.  An empty frame gives none."""
    parts = (placed_items(items, formats)
             .groupBy(*LIST, F.floor(F.col("start") / part_chars).cast("int").alias("part"))
             .agg(F.expr("listagg(text, '') within group (order by start)").alias("info")))
    named = F.array(*[F.lit(t["target"]) for t in targets])
    each = F.when(F.col("migration_target").isNull(), named).otherwise(F.array("migration_target"))
    return (parts.withColumn("__each", each)
            .select("pkey", F.explode("__each").alias("migration_target"), "rule_code", "severity", "info", "part"))
