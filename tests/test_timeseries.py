"""Counter deltas and profiles: the range-split lag equals a plain window, window bounds
before / after the lag, resets and first samples."""

from pyspark.sql import functions as F

from fleetscope.operators import timeseries as ts
from fleetscope.sources.fixtures import estate

SCHEMA = "pkey string, dbid int, instance_number int, stat_name string, snap_id long, begin_ts timestamp, value long"


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_split_lag_equals_plain_window(spark, sf_small):
    c = estate(spark, sf_small, "est_counters")
    cols = ["pkey", "instance_number", "stat_name", "snap_id", "value_delta"]
    plain = ts.counter_delta(c, bucket_width=None)
    for width in (1, 7, 64, 1 << 16):
        assert _rows(ts.counter_delta(c, bucket_width=width), cols) == _rows(plain, cols)


def test_reset_and_first_sample(spark):
    rows = [("p", 1, 1, "s", i, None, v) for i, v in enumerate([10, 15, 15, 3, 8, None, 9])]
    df = spark.createDataFrame(rows, SCHEMA)
    out = [r.value_delta for r in ts.counter_delta(df, bucket_width=2).orderBy("snap_id").collect()]
    assert out == [0, 5, 0, 0, 5, 0, 0]


def test_bound_before_and_after(spark):
    rows = [("p", 1, 1, "s", i, None, 10 * i) for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    before = ts.counter_delta(df, lo=4, hi=6, bound="before").orderBy("snap_id").collect()
    after = ts.counter_delta(df, lo=4, hi=6, bound="after").orderBy("snap_id").collect()
    assert [r.value_delta for r in before] == [0, 10, 10]
    assert [r.value_delta for r in after] == [10, 10, 10]


def test_drop_first_variant(spark):
    rows = [("p", 1, 1, "s", i, None, 10 * i) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = ts.counter_or_gauge(df, drop_first=True, bucket_width=2)
    assert out.count() == 4 and {r.delta_value for r in out.collect()} == {10}


def test_hourly_profile_percentiles(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1, 5, 0, 0)
    rows = [("p", 1, 1, "s", i, base + dt.timedelta(minutes=i), v) for i, v in enumerate([1, 2, 2, 3, 10])]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("value", "v")
    r = ts.hourly_profile(df, value="v").first()
    assert (r.cnt, r.hour, r.mode_value, r.median_value, r.min_value, r.max_value, r.sum_value) == (5, "05", 2, 2.0, 1, 10, 18)
    assert r.perc95 == round(3 + 0.8 * 7) and r.perc100 == 10.0


def test_top_statements_limit(spark, sf_small):
    st = estate(spark, sf_small, "est_statements")
    out = ts.top_statements(st, n=5)
    per = {r.pkey: r["count"] for r in out.groupBy("pkey").count().collect()}
    assert per and all(v == 5 for v in per.values())
    assert out.where(F.col("rank") > 5).count() == 0


def test_as_of_join_bucket_widths(spark, sf_small):
    facts = estate(spark, sf_small, "est_counters").selectExpr("pkey", "dbid", "snap_id as sample_id",
                                                               "begin_ts as sample_ts")
    snaps = estate(spark, sf_small, "est_snapshots").where("extract(hour from begin_ts) % 5 <> 0") \
        .select("dbid", "begin_ts", "snap_id")
    cols = ["sample_id", "snap_id"]
    # brute force: latest snapshot at or before each sample
    brute = (facts.join(snaps, (facts.dbid == snaps.dbid) & (snaps.begin_ts <= facts.sample_ts), "left")
             .groupBy("sample_id").agg(F.max_by("snap_id", "begin_ts").alias("snap_id")))
    expected = _rows(brute, cols)
    for width in (600, 3600, 86400, 7 * 86400):
        got = ts.snapshots_as_of(facts, snaps, keys=["dbid"], fact_ts="sample_ts", bucket_seconds=width)
        assert _rows(got, cols) == expected


def test_snapshot_intervals_split_equals_plain(spark, sf_small):
    snaps = estate(spark, sf_small, "est_snapshots")
    a = ts.snapshot_intervals(snaps, bucket_width=None).orderBy("hour").collect()
    b = ts.snapshot_intervals(snaps, bucket_width=5).orderBy("hour").collect()
    assert a == b and len(a) > 0


def test_value_profile_equals_plain_aggregates(spark):
    import random
    r = random.Random(4)
    values = [None] * 5 + [0, -3, 7, 7, 1 << 40] + [r.randint(-50, 50) for _ in range(300)] + [5] * 400
    values += [r.randint(0, 10 ** 12) for _ in range(300)]
    rows = [(r.choice(["a", "b", None]), v) for v in values] + [("nulls", None), ("one", 3)]
    for kind in ("long", "double"):
        df = spark.createDataFrame(rows, "g string, v long").select("g", F.col("v").cast(kind).alias("v"))
        got = {x["g"]: x for x in ts.value_profile(df, ["g"], "v", ts.PROFILE_PERCENTILES, {"twice": F.col("v") * 2}).collect()}
        pct = [F.percentile("v", F.lit(p)).alias(n) for n, p in ts.PROFILE_PERCENTILES.items()]
        plain = df.groupBy("g").agg(F.count(F.lit(1)).alias("__cnt"), F.min("v").alias("__min"), F.max("v").alias("__max"),
                                    F.sum("v").alias("__sum"), F.mode("v", deterministic=True).alias("__mode"),
                                    F.sum(F.col("v") * 2).alias("twice"), *pct)
        for x in plain.collect():
            assert {c: got[x["g"]][c] for c in plain.columns} == x.asDict()
        assert len(got) == 5


def test_value_bucket_never_falls(spark):
    df = spark.range(0, 200_000).select((F.pow(F.lit(1.0005), F.col("id") % 40_000) * F.when(F.col("id") % 2 == 0, 1).otherwise(-1))
                                        .alias("v")).union(spark.sql("select explode(transform(sequence(0, 60), i -> power(2D, i)))"))
    pairs = df.select("v", ts.value_bucket(F.col("v")).alias("b")).orderBy("v").collect()
    assert all(x["b"] <= y["b"] for x, y in zip(pairs, pairs[1:]))


def test_health_record_is_parsed_once_and_odd_numbers_are_xpaths(spark):
    from datetime import datetime

    def record(i, idle, proc, rest=""):
        return (f'<Record id="{i}"><SchedulerMonitorEvent><SystemHealth>{idle}<ProcessUtilization>{proc}</ProcessUtilization>{rest}'
                '</SystemHealth></SchedulerMonitorEvent></Record>')
    texts = [record(1, "<SystemIdle>0</SystemIdle>", 30), record(2, "", " 7.9 "), record(3, "<SystemIdle>x</SystemIdle>", "-2"),
             record(4, "<SystemIdle>5</SystemIdle><SystemIdle>6</SystemIdle>", "1" * 25), record("9007199254740993", "", "", "<UserModeTime>1e3</UserModeTime>"),
             "<Other/>", "", None, record(5, "", "9" * 400, "<KernelModeTime>-" + "9" * 30 + "</KernelModeTime>")]
    df = spark.createDataFrame([("k", t, datetime(2024, 2, 1), 5000, 1500) for t in texts],
                               "pkey string, record string, now_ts timestamp_ntz, ms_ticks long, timestamp_ms long")
    out = ts.health_samples(df)
    assert out._jdf.queryExecution().optimizedPlan().toString().lower().count("xpath") == 1
    paths = {"record_id": "Record/@id", "sql_cpu": "ProcessUtilization", "user_mode_time": "UserModeTime",
             "kernel_mode_time": "KernelModeTime", "memory_utilization": "MemoryUtilization"}
    one = df.select(*[F.xpath_long("record", F.lit(p if "/" in p else f"Record/SchedulerMonitorEvent/SystemHealth/{p}")).alias(n)
                      for n, p in paths.items()]).collect()
    got = out.collect()
    assert [tuple(r[n] for n in paths) for r in got] == [tuple(r) for r in one]
    assert [r.system_idle for r in got][:4] == [70, 93, 102, 5] and got[6].system_idle is None
    assert got[0].event_time == datetime(2024, 1, 31, 23, 59, 56, 500000)
