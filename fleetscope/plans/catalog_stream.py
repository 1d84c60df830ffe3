"""Registered streaming jobs (survey section I).  Each callable lands the events as one file
per day, drains the stream with ``availableNow`` and returns the sink read back as a batch.
Multi-batch arrival in time order (state carried between micro-batches) is covered by
``tests/test_streaming.py``."""

from __future__ import annotations

import os
import uuid

from fleetscope.plans.catalog_perf import C1_SQL
from fleetscope.plans.spec import Spec
from fleetscope.session import checkpoint_path
from fleetscope.streaming import streams as S

KEYS = ("pkey", "dbid", "instance_number", "stat_name")
COUNTERS = "select * from est_counters"


def _dirs(spark, name):
    base = checkpoint_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    return os.path.join(base, "src"), os.path.join(base, "sink"), os.path.join(base, "checkpoint")


def _i1(spark, counters):
    src, sink, ckpt = _dirs(spark, "landing")
    S.land_by_day(counters, src, fmt="csv")
    S.stream_landing(spark, src, counters.schema, sink, ckpt, max_files_per_trigger=8)   # order-free
    return spark.read.schema(counters.schema).parquet(sink).select(*counters.columns)


def _i2(spark, counters):
    src, sink, ckpt = _dirs(spark, "profile")
    S.land_by_day(counters, src)
    # one backlog drain: the day files of a single write job carry no arrival order
    S.stream_interval_profile(spark, src, counters.schema, sink, ckpt, keys=KEYS)
    return S.latest_windows(spark, sink, KEYS)


def _i3(spark, counters):
    src, sink, ckpt = _dirs(spark, "delta")
    # every micro-batch holds rows of all days, so each changes neighbours of earlier ones
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    S.land_mixed(counters, src, files)
    S.stream_counter_delta(spark, src, counters.schema, sink, ckpt, keys=KEYS, watermark="3650 days",
                           max_files_per_trigger=-(-files // 3))
    return S.latest_deltas(spark, sink, counters.schema, KEYS)


SPECS: dict[str, Spec] = {
    "i1_stream_landing": Spec(build=_i1, inputs={"counters": COUNTERS}, oracle="select * from counters",
                              needs_spark=True),
    "i2_stream_interval_profile": Spec(
        build=_i2, inputs={"counters": COUNTERS}, needs_spark=True,
        # percentile_approx returns the smallest value with at least 95% of the values at or below it;
        # with accuracy 10000 it is exact for groups of this size
        oracle="""select date_trunc('hour', begin_ts) as window_start, date_trunc('hour', begin_ts) + interval 1 hour
  as window_end, pkey, dbid, instance_number, stat_name, count(*) as cnt, round(avg(value), 4) as avg_value,
  min(value) as min_value, max(value) as max_value,
  list_sort(list(value))[cast(greatest(1, ceil(0.95 * count(*))) as bigint)] as p95_value
from counters group by date_trunc('hour', begin_ts), pkey, dbid, instance_number, stat_name"""),
    "i3_stream_counter_delta": Spec(build=_i3, inputs={"counters": COUNTERS}, oracle=C1_SQL, needs_spark=True),
}
