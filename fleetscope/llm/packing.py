"""Operator 7 - best-fit packing planned on the histogram of lengths.

Packing depends only on how many pieces have each length, and lengths are bounded by the
capacity.  The driver therefore plans over at most ``capacity`` (length, count) rows: best fit,
longest lengths first, on groups of equally filled sequences instead of single ones.  The plan
says where the pieces of a length go by their rank; pieces then take their slots by a join on
length and rank.  Ranks within a length are made in two steps (rank within a bucket of the
length, plus the buckets before), so a length held by a third of all pieces is not ordered in
one task.

Cases: null text = the end id alone; documents longer than the capacity are cut into
full pieces and a rest; repeated rows get places of their own; an empty table gives an empty
result; other columns, also clashing ones, are dropped by ``pieces`` and kept by ``pack``
(``sequence_id`` and ``offset`` of the input are replaced).
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.common import byte_slices, cut, ship
from fleetscope.llm.encoding import encoder

RANK_BUCKETS = 256
BROADCAST_PLAN_ROWS = 200_000


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """Encode every text, append ``end_id`` and cut at ``capacity``: (id, piece, start, length,
    ids_crc32, ids).  Without ``with_ids`` the ids column is left out."""
    ship(docs.sparkSession)
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        enc = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for part in byte_slices(batch, text_col, 4 << 20):
                rows, piece, start, length, crc, flat = [], [], [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    data = enc.encode(text) + end
                    for k, at in enumerate(range(0, len(data), 4 * capacity)):
                        own = data[at:at + 4 * capacity]
                        rows.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        if with_ids:
                            flat.append(own)
                columns = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    values = np.frombuffer(b"".join(flat), dtype="<u4").astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
                yield pa.RecordBatch.from_arrays(columns, names=names)
        enc.cache.rest()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts, longest lengths first.

    Rows ``(length, rank_from, rank_to, per_sequence, first_sequence, offset)``: the pieces of
    ``length`` with rank in [rank_from, rank_to) go ``per_sequence`` at a time into the sequences
    from ``first_sequence`` on, at ``offset`` and following."""
    out = []
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free places -> (first sequence, how many)
    free: list[int] = []  # the keys of groups, ascending
    sequences = 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in groups:
                bisect.insort(free, room)
            groups[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
        left, rank = histogram[length], 0
        while left:
            k = bisect.bisect_left(free, length)
            if k < len(free):  # the fullest sequences that still have room
                room = free[k]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], free[k]
            else:
                room, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            each = room // length
            whole = min(n, left // each)
            if whole:
                out.append((length, rank, rank + whole * each, each, first, capacity - room))
                put(room - each * length, first, whole)
                rank, left = rank + whole * each, left - whole * each
            if whole < n and left:  # fewer than ``each`` are left: they share one sequence
                out.append((length, rank, rank + left, left, first + whole, capacity - room))
                put(room - left * length, first + whole, 1)
                whole, left = whole + 1, 0
            put(room, first + whole, n - whole)
    return out


def pack(items: DataFrame, capacity: int, length_col: str = "length", order_cols: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Give every row of ``items`` a ``sequence_id`` and an ``offset``.  ``items`` is read several
    times and must be stable: hand in a checkpoint or a written table."""
    spark = items.sparkSession
    items = items.drop("sequence_id", "offset")
    bucket = F.pmod(F.xxhash64(*order_cols), F.lit(RANK_BUCKETS))
    work = items.withColumn("__b", bucket)
    # at most capacity * RANK_BUCKETS small rows, whatever the input
    sizes = cut(work.groupBy(F.col(length_col).alias("__l"), F.col("__b").alias("__k")).agg(F.count("*").alias("__n")))
    histogram = {r["__l"]: r["n"] for r in sizes.groupBy("__l").agg(F.sum("__n").alias("n")).collect()}
    rows = plan(histogram, capacity)
    planned = spark.createDataFrame(rows, "__pl long, __from long, __to long, __each long, __first long, __off long")
    if len(rows) <= BROADCAST_PLAN_ROWS:  # some rows for each length; a longer plan is joined by a shuffle
        planned = F.broadcast(planned)
    before = sizes.select("__l", "__k", F.coalesce(F.sum("__n").over(
        Window.partitionBy("__l").orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy(length_col, "__b").orderBy(*order_cols)) - 1
    ranked = (work.withColumn("__r", within)
              .join(before, (F.col(length_col) == F.col("__l")) & (F.col("__b") == F.col("__k")))
              .withColumn("__rank", F.col("__r") + F.col("__before")))
    slot = F.col("__rank") - F.col("__from")
    return (ranked.join(planned, (F.col(length_col) == F.col("__pl")) & (F.col("__rank") >= F.col("__from"))
                        & (F.col("__rank") < F.col("__to")))
            .select(*[F.col(f"`{c}`") for c in items.columns],
                    (F.col("__first") + F.floor(slot / F.col("__each"))).cast("long").alias("sequence_id"),
                    (F.col("__off") + F.pmod(slot, F.col("__each")) * F.col(length_col)).cast("long").alias("offset")))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids) from rows with ``offset`` and ``ids``.
    A group holds at most the capacity in tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids")))


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    return pack(cut(pieces(docs, tokenizer, end_id, capacity, with_ids=with_ids)), capacity)
