"""Streaming forms (survey section I) of jobs whose inputs arrive over time.

* ``stream_landing`` (I1): new extract files -> canonical Parquet, each file once
  (file source + checkpoint), ``availableNow`` so a scheduled run drains the
  backlog and stops.
* ``stream_interval_profile`` (I2): tumbling-window metric profile with a
  watermark (late rows dropped); approximate P95.
* ``stream_counter_delta`` (I3): C1 with the samples of a key's open ranges held in
  streaming state (``transformWithStateInPandas``); equals batch C1 for any order of arrival
  within the watermark, corrections included (``latest_deltas``).

Sinks are written through ``foreachBatch`` into ``batch_id=<n>`` folders with
overwrite, so a retried micro-batch replaces its own output (idempotent), and
the checkpoint lives in the session's shared checkpoint directory.
"""

from __future__ import annotations

import os
from array import array
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from fleetscope.sources.extracts import CSV_OPTIONS, TS_NTZ_FORMAT, conform

# The state function runs in Python workers.  Pickle this module's functions by value so
# workers need not import the package (no --py-files / PYTHONPATH set-up required).
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without by-value registration
    pass


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DELTA_RANGE = 1 << 16   # snapshots of one key in one state value of I3 (1.6 MB at most), as in C1


def _batch_writer(path: str, partition_by=()):
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(os.path.join(path, f"batch_id={batch_id}"))
    return write


def stream_landing(spark: SparkSession, src: str, schema: StructType, sink: str, checkpoint: str,
                   max_files_per_trigger: int | None = None) -> None:
    """Pipe-delimited extract files -> canonical Parquet (append, partitioned by pkey)."""
    reader = spark.readStream.options(**CSV_OPTIONS).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (conform(reader.csv(src).select(*schema.names), schema).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).option("path", sink)
         .partitionBy("pkey").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def stream_interval_profile(spark: SparkSession, src: str, schema: StructType, sink: str, checkpoint: str,
                            keys=("pkey", "dbid", "instance_number", "stat_name"), ts="begin_ts", value="value",
                            window="1 hour", watermark="2 hours", max_files_per_trigger: int | None = None) -> None:
    """Per tumbling window and key - count, avg, min, max and approximate P95.  Rows
    later than the watermark are dropped.  Update mode through ``foreachBatch``: each batch
    writes the windows it changed; ``latest_windows`` reads back the final value."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # event time must be a zoned timestamp for watermarks (UTC session, same wall clock)
    s = (reader.parquet(src).select(*schema.names).withColumn(ts, F.col(ts).cast("timestamp"))
         .withWatermark(ts, watermark))
    agg = (s.groupBy(F.window(ts, window).alias("w"), *keys)
           .agg(F.count(F.lit(1)).alias("cnt"), F.round(F.avg(value), 4).alias("avg_value"),
                F.min(value).alias("min_value"),
                F.max(value).alias("max_value"), F.percentile_approx(value, 0.95, 10000).alias("p95_value"))
           .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "cnt",
                   "avg_value", "min_value", "max_value", "p95_value"))
    q = (agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(_batch_writer(sink)).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_windows(spark: SparkSession, sink: str, keys) -> DataFrame:
    """Final value per window and key: the row of the highest batch id (grouped ``max_by``)."""
    df = spark.read.parquet(sink)
    k = ["window_start", "window_end", *keys]
    vals = [c for c in df.columns if c not in k and c != "batch_id"]
    latest = df.groupBy(*k).agg(F.max_by(F.struct(*vals), "batch_id").alias("__v"))
    return latest.select(*k, *[F.col("__v")[c].alias(c) for c in vals])


class RangeDeltas(StatefulProcessor):
    """Samples of one key and one range of snapshots, in snapshot order (``transformWithStateInPandas``).

    A batch's rows are merged into the range; what goes out is every new sample with the value
    before it, and again each older sample whose predecessor has changed.  Times behind the
    watermark can gain no neighbour any more, so a timer drops them, all but the last, which
    is the predecessor of the range's next sample.

    Rows come in as frames, for rows one by one cost more than all else.  So that no frame turns a
    null into a float, keys come as one text and null values as 0 with a mark.  A range's samples
    are held as one binary value (snapshots, values and times as 64-bit integers, then a byte for
    each null value) and go out as one row of arrays."""

    def __init__(self, fields):
        self.fields = fields

    def init(self, handle) -> None:
        self.handle = handle
        self.samples = handle.getValueState("samples", "packed binary")

    def _load(self) -> dict:
        held = self.samples.get()
        if held is None:
            return {}
        data, n = held[0], len(held[0]) // 25
        numbers = array("q", data[:24 * n]).tolist()
        vals = [None if gone else v for v, gone in zip(numbers[n:2 * n], data[24 * n:])]
        return dict(zip(numbers[:n], zip(vals, numbers[2 * n:])))

    def _store(self, known: dict) -> None:
        snaps = sorted(known)
        samples = [known[s] for s in snaps]
        numbers = array("q", [*snaps, *[v or 0 for v, _ in samples], *[t for _, t in samples]])
        self.samples.update((numbers.tobytes() + bytes([v is None for v, _ in samples]),))

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        known, changed = self._load(), set()
        for frame in rows:
            columns = (frame[c].tolist() for c in ("snap", "number", "gone", "micros"))
            for snap, value, gone, time in zip(*columns):
                sample = (None if gone else value, time)
                old = known.get(snap)
                # a repeated snapshot counts once, whatever the order of arrival: its largest value stays
                if old is None or (not gone and (old[0] is None or sample > old)):
                    known[snap] = sample
                    changed.add(snap)
        self._store(known)
        self.handle.registerTimer(max(t for _, t in known.values()) // 1000 + 1)
        out, before = [], None
        for snap in sorted(known):
            if snap in changed or before in changed:
                value, time = known[snap]
                out.append((snap, time, value, None if before is None else known[before][0], before is None))
            before = snap
        if out:
            yield pd.DataFrame({n: [v] for n, v in zip(self.fields, (*key, *map(list, zip(*out))))})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        known = self._load()
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        last = max(known)
        self._store({s: x for s, x in known.items() if s == last or x[1] >= passed})
        return iter(())

    def close(self) -> None:
        pass


def stream_counter_delta(spark: SparkSession, src: str, schema: StructType, sink: str, checkpoint: str,
                         keys=("pkey", "dbid", "instance_number", "stat_name"), order: str = "snap_id",
                         ts: str = "begin_ts", value: str = "value", watermark: str = "2 days",
                         range_width: int = DELTA_RANGE, max_files_per_trigger: int | None = None) -> None:
    """C1 over samples that arrive in any order within ``watermark`` (later ones are dropped).

    State is held per key *and* range of ``range_width`` snapshots, so a hot key is spread over
    tasks and no task or state value holds more than one range.  The sink receives versions:
    (keys, snapshot, time, value, value before it in its range); ``latest_deltas`` reads the
    last version of each sample and takes the values before the first samples of the ranges
    from the ranges before them.  ``order`` must not fall while ``ts`` rises (as snapshots
    do).  Null values, first samples and resets give 0, as in C1; rows without snapshot or
    time are left out; an empty input gives an empty sink."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    texts = F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)]))
    number = F.col(value).cast("long")
    moved = (reader.parquet(src).where(F.col(order).isNotNull() & F.col(ts).isNotNull())
             .withColumn("__event", F.col(ts).cast("timestamp")).withWatermark("__event", watermark)
             .select(texts.alias("__key"), F.floor(F.col(order) / range_width).alias("__range"), "__event",
                     F.col(order).cast("long").alias("snap"), F.coalesce(number, F.lit(0)).alias("number"),
                     number.isNull().alias("gone"), F.unix_micros("__event").alias("micros")))
    parts = {order: LongType(), "__time": LongType(), value: LongType(), "__before": LongType(), "__first": BooleanType()}
    out = StructType([StructField("__key", StringType()), StructField("__range", LongType()),
                      *[StructField(n, ArrayType(t)) for n, t in parts.items()]])
    ranges = moved.groupBy("__key", "__range").transformWithStateInPandas(
        statefulProcessor=RangeDeltas(out.names), outputStructType=out, outputMode="append", timeMode="EventTime")
    own_keys = F.from_json("__key", ", ".join(f"k{i} string" for i in range(len(keys))))
    versions = (ranges.withColumn("__keys", own_keys)
                .select(*[F.col(f"__keys.k{i}").cast(schema[k].dataType).alias(k) for i, k in enumerate(keys)], "__range",
                        F.inline(F.arrays_zip(*parts))))
    # keyed state with timers in RocksDB, a checkpoint of what changed; timers that fall due wait
    # for the next batch with rows instead of starting one of their own
    own = {STATE_STORE: ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
           "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {c: spark.conf.get(c, None) for c in own}
    for c, v in own.items():
        spark.conf.set(c, v)
    try:
        q = (versions.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
             .foreachBatch(_batch_writer(sink)).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def latest_deltas(spark: SparkSession, sink: str, schema: StructType,
                  keys=("pkey", "dbid", "instance_number", "stat_name"), order: str = "snap_id",
                  ts: str = "begin_ts", value: str = "value") -> DataFrame:
    """Keys, snapshot, time, value and ``value_delta`` of every sample in the sink of
    ``stream_counter_delta``.  Only the ranges' first samples meet another range."""
    k = list(keys)
    rows = (spark.read.parquet(sink).groupBy(*k, "__range", order)
            .agg(F.max_by(F.struct("__time", value, "__before", "__first"), "batch_id").alias("__v"))
            .select(*k, "__range", order, "__v.*"))
    last = rows.groupBy(*k, "__range").agg(F.max_by(F.struct(value), order).alias("__last"))
    carried = (last.withColumn("__carry", F.lag("__last").over(Window.partitionBy(*k).orderBy("__range")))
               .where(F.col("__carry").isNotNull()).select(*k, "__range", F.lit(True).alias("__first"),
                                                           F.col("__carry")[value].alias("__carry")))
    on = reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in [*k, "__range", "__first"]])
    joined = rows.alias("r").join(carried.alias("c"), on, "left")
    prior = F.coalesce("__before", "__carry")
    delta = F.when(F.col(value) >= prior, F.col(value) - prior).otherwise(F.lit(0))
    stamp = F.timestamp_micros("__time").cast(schema[ts].dataType)
    return joined.select(*[F.col(f"r.{c}") for c in k], F.col(order).cast(schema[order].dataType), stamp.alias(ts),
                         F.col(value).cast(schema[value].dataType), delta.alias("value_delta"))


def land_mixed(df: DataFrame, path: str, files: int) -> str:
    """A table as ``files`` Parquet files of equal size, each with rows of all keys and times:
    an arrival order that no consumer can rely on."""
    df.repartition(files).write.mode("overwrite").parquet(path)
    return path


def land_by_day(df: DataFrame, path: str, ts: str = "begin_ts", fmt: str = "parquet") -> str:
    """Split a table into one folder (and one file) per day in a single write job: rows are
    hash-partitioned by day, so each day folder is written by one task."""
    day = F.to_date(ts)
    w = df.withColumn("day", day).repartition("day").write.mode("overwrite").partitionBy("day")
    if fmt == "parquet":
        w.parquet(path)
    else:
        w.option("sep", "|").option("header", "true").option("timestampNTZFormat", TS_NTZ_FORMAT).csv(path)
    return path
