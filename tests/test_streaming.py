"""Streaming forms: the stateful counter delta over several micro-batches equals the batch C1
for any order of arrival."""

import os
import tempfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fleetscope.operators import timeseries as ts
from fleetscope.sources.fixtures import estate
from fleetscope.streaming import streams as S

KEYS = ("pkey", "dbid", "instance_number", "stat_name")


COLS = ["pkey", "instance_number", "stat_name", "snap_id", "value_delta"]


def _folders(name):
    base = tempfile.mkdtemp(prefix=f"fs-{name}-")
    return [os.path.join(base, x) for x in ("src", "sink", "ckpt")]


def test_counter_delta_of_any_arrival_order(spark, sf_small):
    """Files in falling order of time, ranges of 64 snapshots: nearly every sample is corrected."""
    c = estate(spark, sf_small, "est_counters")
    src, sink, ckpt = _folders("stream")
    days = [r.d for r in c.select(F.to_date("begin_ts").alias("d")).distinct().orderBy("d").collect()][:6]
    for d in reversed(days):
        c.where(F.to_date("begin_ts") == F.lit(d)).coalesce(1).write.parquet(os.path.join(src, f"day={d}"))
    S.stream_counter_delta(spark, src, c.schema, sink, ckpt, keys=KEYS, watermark="60 days", range_width=64,
                           max_files_per_trigger=2)
    assert spark.read.parquet(sink).select("batch_id").distinct().count() >= 3
    got = S.latest_deltas(spark, sink, c.schema, KEYS)
    assert got.schema["value"].dataType == c.schema["value"].dataType
    want = ts.counter_delta(c.where(F.to_date("begin_ts") <= F.lit(days[-1])))
    assert sorted(got.select(*COLS).collect()) == sorted(want.select(*COLS).collect())


SAMPLES = ("pkey string, dbid int, instance_number int, stat_name string, snap_id long, begin_ts timestamp_ntz, "
           "value long")


def _arrivals(spark, batches, range_width=4, watermark="1 day"):
    """One file a batch of (snap, day, value); deltas per snapshot and the batches' row counts."""
    src, sink, ckpt = _folders("arrive")
    schema = spark.createDataFrame([], SAMPLES).schema
    os.makedirs(src)
    for i, rows in enumerate(batches):
        frame = spark.createDataFrame([("k", 1, 1, "s", s, datetime(2026, 1, 1) + timedelta(days=d), v)
                                       for s, d, v in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(src)
        S.stream_counter_delta(spark, src, schema, sink, ckpt, keys=KEYS, watermark=watermark, range_width=range_width)
    return {r.snap_id: r.value_delta for r in S.latest_deltas(spark, sink, schema, KEYS).collect()}


def test_counter_delta_of_restarts_repeats_resets_and_large_values(spark):
    big = (1 << 53) + 1
    # one run a file: state comes back from the checkpoint; 2 arrives after 3, 9 twice, 11 has no value
    got = _arrivals(spark, [[(1, 0, big), (3, 0, big + 9)], [(2, 0, big + 3), (9, 1, 50)],
                            [(9, 1, 40), (10, 1, 60), (11, 1, None), (12, 1, 70)]])
    assert got == {1: 0, 2: 3, 3: 6, 9: 0, 10: 10, 11: 0, 12: 0}


def test_counter_delta_keeps_the_neighbour_behind_the_watermark(spark):
    # the timer drops snapshots 1 and 2 but 2's value still counts for 3; the sample of day 0 that
    # comes after the watermark has passed is dropped
    got = _arrivals(spark, [[(1, 0, 5), (2, 1, 7)], [(40, 30, 100)], [(41, 30, 101)], [(0, 0, 1), (3, 30, 20)]])
    assert got == {1: 0, 2: 2, 3: 13, 40: 80, 41: 1}


def test_landing_is_exactly_once(spark, sf_small):
    c = estate(spark, sf_small, "est_counters")
    base = tempfile.mkdtemp(prefix="fs-land-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("src", "sink", "ckpt"))
    S.land_by_day(c, src, fmt="csv")
    S.stream_landing(spark, src, c.schema, sink, ckpt, max_files_per_trigger=4)
    S.stream_landing(spark, src, c.schema, sink, ckpt, max_files_per_trigger=4)   # rerun: nothing new
    assert spark.read.parquet(sink).count() == c.count()


def test_counter_delta_of_odd_keys_and_rows_handed_over_in_frames(spark):
    """Null and odd keys, null values beside large ones; samples reach Python as frames, not row by row."""
    import inspect
    src, sink, ckpt = _folders("odd")
    schema = spark.createDataFrame([], SAMPLES).schema
    keys = [(None, None, 1, "s"), ("null", 1, None, None), ('a"\\|\u00fc\n', 1, 1, ""), ("k", 2, 1, "s")]
    rows = [(*k, s, datetime(2026, 1, 1), v) for k in keys for s, v in ((1, (1 << 62) + 1), (2, None), (3, 5), (5, (1 << 53) + 1), (6, (1 << 53) + 2))]
    for part in (rows[::2], rows[1::2]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        S.stream_counter_delta(spark, src, schema, sink, ckpt, keys=KEYS, range_width=4)
    got = {(*r[:4], r.snap_id): (r.value, r.value_delta) for r in S.latest_deltas(spark, sink, schema, KEYS).collect()}
    want = {1: ((1 << 62) + 1, 0), 2: (None, 0), 3: (5, 0), 5: ((1 << 53) + 1, (1 << 53) - 4), 6: ((1 << 53) + 2, 1)}
    assert got == {(*k, s): w for k in keys for s, w in want.items()}
    assert "transformWithStateInPandas(" in inspect.getsource(S.stream_counter_delta)
