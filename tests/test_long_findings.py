"""Lists of findings: parts put together equal the joined text, whatever the partitioning."""

import random

import pytest
from pyspark.sql import functions as F

from fleetscope.plans import long_findings as L

FORMATS = {("R", "W"): ("begin: ", ", ", "; ", "."), ("S", "W"): ("", "", ",", "")}
TARGETS = [{"target": "A"}, {"target": "B"}]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "pkey string, database_name string, item string")


def _whole(findings):
    texts = {}
    for r in sorted(findings.collect(), key=lambda r: r.part):
        texts.setdefault((r.pkey, r.migration_target, r.rule_code), []).append(r.info)
    return {k: "".join(v) for k, v in texts.items()}, max((len(v) for v in texts.values()), default=0)


@pytest.mark.parametrize("part_chars", [7, 64, 1 << 20])
def test_parts_are_the_joined_text(spark, part_chars):
    rnd = random.Random(5)
    rows = [(f"k{rnd.choice('0000012')}", f"db{rnd.choice('00001234')}", "t" * rnd.randrange(12) + str(rnd.randrange(50)))
            for _ in range(900)] + [("k0", "db0", "same")] * 40 + [("k3", None, None), ("k3", "x", "")]
    frame = _frame(spark, rows).repartition(6)
    items = (L.items_of(frame, "R", "W", F.col("item"), opening=F.concat(F.lit("<"), F.col("database_name"), F.lit(" ")),
                        closing=">")
             .unionByName(L.items_of(frame.select("pkey", "database_name").distinct(), "S", "W", F.col("database_name"))))
    got, most = _whole(L.list_findings(items, FORMATS, TARGETS, part_chars))
    assert (most > 1) == (part_chars < 1 << 20)
    want = {}
    for k in {r[0] for r in rows}:
        dbs = sorted({r[1] for r in rows if r[0] == k}, key=lambda d: (d is not None, d or ""))
        lists = [("" if d is None else f"<{d} ") + ", ".join(sorted(r[2] or "" for r in rows if r[:2] == (k, d))) + ">"
                 for d in dbs]
        for t in "AB":
            want[k, t, "R"] = "begin: " + "; ".join(lists) + "."
            want[k, t, "S"] = ",".join(d or "" for d in dbs)
    assert got == want


def test_million_tables_of_one_database(spark):
    n = 1_000_000
    items = L.items_of(spark.range(n).select(F.lit("k").alias("pkey"), F.lit("db").alias("database_name"),
                                             F.format_string("s.t%07d", "id").alias("item")), "R", "W", F.col("item"))
    out = L.list_findings(items, FORMATS, TARGETS[:1], 1 << 16).select("part", "info").collect()
    assert max(len(r.info) for r in out) < (1 << 16) + 16
    text = "".join(r.info for r in sorted(out, key=lambda r: r.part))
    assert text == "begin: " + ", ".join(f"s.t{i:07d}" for i in range(n)) + "."


def test_target_of_its_own_and_no_items(spark):
    frame = _frame(spark, [("k", "db", "i")]).withColumn("t", F.lit("B"))
    got, _ = _whole(L.list_findings(L.items_of(frame, "R", "W", F.col("item"), target="t"), FORMATS, TARGETS))
    assert got == {("k", "B", "R"): "begin: i."}
    assert L.list_findings(L.items_of(_frame(spark, []), "R", "W", F.col("item")), FORMATS, TARGETS).count() == 0
