"""Operator 6 - approximate nearest neighbours with an inverted multi-index.

Vectors are cut in two halves, each half quantised by its own centroids (k-means on a bounded,
hash-chosen sample); a vector's cell is its pair of centroids.  A query scores the centroids of
both halves and takes the pairs in order of their summed score from a heap until the cells seen
hold the candidates it may look at; every vector of those cells is then scored exactly.

The number of candidates is calibrated: a bounded sample of queries is scored against all
vectors, and the budget is where ``RECALL_TARGET`` of their true neighbours have been met.  It
follows the data: well clustered vectors need a small share, vectors without structure a large one.

Cells are laid out on shards of about ``SHARD_ROWS`` vectors; a cell larger than that (a third
of all vectors may be equal) is spread over several shards by the hash of the id, and all of
them are searched, so no cell is cut short.  A query goes once to each shard it needs and brings
back at most k rows, and none below its k-th best score among the sample's vectors in the cells
it visits: those are candidates too, so the final k lie at or above it.  The driver sees the
sample, the centroids and the counts of at most ``MOST_CENTROIDS`` squared cells.

Nearness is the inner product in double precision.  Cases: vectors that are null, empty, zero,
hold null or non-finite components, have no id or not the most frequent length take no part;
rows with a query's own id are not its neighbours; a repeated query is answered once, repeated
candidates count each; ties go to the smaller id; fewer candidates than k = all of them; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.common import cut, ship

SAMPLE_ROWS = 20_000
MOST_CENTROIDS = 1_024
SHARD_ROWS = 4_096
#: Queries that one task leads through the cells.
TASK_QUERIES = 256
CALIBRATION_QUERIES = 64
RECALL_TARGET = 0.97
#: Equal vectors may differ by rounding in a matrix product; they are scored again, row by row.
ROUNDING = 1e-9


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>, h): the vectors that take part; h is the hash that samples go by."""
    v = F.col(vector_col).cast("array<double>")
    fine = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
        & F.exists("v", lambda x: x != 0))
    width = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fine.where(F.size("v") == (width["n"] if width else 0)).withColumn("h", F.xxhash64("id"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an Arrow list column as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def nearest_centroid(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(axis=1) - 2 * (x @ c.T), axis=1)


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = nearest_centroid(x, c)
        for i in range(len(c)):
            if (own == i).any():
                c[i] = x[own == i].mean(axis=0)
    return c


class Quantiser:
    def __init__(self, sample: np.ndarray, rows: int):
        self.cut = sample.shape[1] // 2
        k = int(min(max(round(4 * rows ** 0.25), 8), MOST_CENTROIDS))
        self.first, self.second = k_means(sample[:, :self.cut], k), k_means(sample[:, self.cut:], k)
        self.width = len(self.second)
        self.cells = len(self.first) * self.width

    def cell(self, x: np.ndarray) -> np.ndarray:
        return nearest_centroid(x[:, :self.cut], self.first) * self.width + nearest_centroid(x[:, self.cut:], self.second)

    def traverse(self, q: np.ndarray):
        """Cells by falling sum of the halves' scores, from a heap."""
        a, b = self.first @ q[:self.cut], self.second @ q[self.cut:]
        rows, columns = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        a, b, rows, columns = a[rows].tolist(), b[columns].tolist(), rows.tolist(), columns.tolist()
        heap, width = [(-(a[0] + b[0]), 0, 0)], self.width
        while heap:
            _, i, j = heapq.heappop(heap)
            yield rows[i] * width + columns[j]
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def layout(counts: np.ndarray, shard_rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(first shard, number of shards) of each cell, and the number of shards."""
    first, parts = np.zeros(len(counts), dtype=np.int32), np.ones(len(counts), dtype=np.int32)
    shard, held = 0, 0
    for c in range(len(counts)):
        n = int(counts[c])
        if n > shard_rows:
            shard += held > 0
            first[c], parts[c] = shard, -(-n // shard_rows)
            shard, held = shard + int(parts[c]), 0
            continue
        if held and held + n > shard_rows:
            shard, held = shard + 1, 0
        first[c], held = shard, held + n
    return first, parts, shard + 1


def kth_best(scores: np.ndarray, k: int) -> float:
    """The k-th largest score; minus infinity if there are fewer."""
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -np.inf


def best(scores: np.ndarray, ids: np.ndarray, own: int, x: np.ndarray, q: np.ndarray, k: int, floor: float = -np.inf):
    """Rows of the k best by exact score, ties to the smaller id, without the query's own id and
    without what lies below ``floor``."""
    scores = np.where(ids == own, -np.inf, scores)
    at = np.flatnonzero((scores >= max(kth_best(scores, k), floor) - ROUNDING) & (scores > -np.inf))
    exact = (x[at] * q).sum(axis=1)
    order = np.lexsort((ids[at], -exact))[:k]
    return at[order], exact[order]


RESULT = "query_id long, vec_id long, score double, cell int"


def result_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int32()))],
        names=["query_id", "vec_id", "score", "cell"])


def top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           recall_target: float = RECALL_TARGET, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best vectors found for each of ``queries``."""
    spark = vectors.sparkSession
    ship(spark)
    points = cut(usable(vectors, id_col, vector_col))
    asked = cut(usable(queries, id_col, vector_col).dropDuplicates(["id"]))
    rows = points.count()
    sample = points.orderBy("h", "id").limit(SAMPLE_ROWS).select("id", "v").toArrow()
    if not rows or asked.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample_ids, sample_x = sample.column("id").to_numpy(), matrix(sample.column("v"))
    quantiser = Quantiser(sample_x, rows)
    sample_cells = quantiser.cell(sample_x)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                cells = quantiser.cell(matrix(batch.column(1))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells)], names=["id", "v", "cell"])

    indexed = cut(points.select("id", "v").mapInArrow(assign, "id long, v array<double>, cell int"))
    counts = np.zeros(quantiser.cells, dtype=np.int64)
    for r in indexed.groupBy("cell").count().collect():  # at most MOST_CENTROIDS squared rows
        counts[r["cell"]] = r["count"]
    budget = calibrate(indexed, asked, quantiser, counts, k, recall_target)
    first, parts, shards = layout(counts, shard_rows)

    def plan(batches):
        sizes, starts, spread = counts.tolist(), first.tolist(), parts.tolist()
        for batch in batches:
            asking = matrix(batch.column(1))
            for own, q in zip(batch.column(0).to_pylist(), asking):
                seen, wanted, visited = 0, {}, np.zeros(len(counts), dtype=bool)
                for cell in quantiser.traverse(q):
                    if not sizes[cell]:
                        continue
                    visited[cell] = True
                    for s in range(starts[cell], starts[cell] + spread[cell]):
                        wanted.setdefault(s, []).append(cell)
                    seen += sizes[cell]
                    if seen >= budget:
                        break
                floor = kth_best(sample_x[visited[sample_cells] & (sample_ids != own)] @ q, k)
                n = len(wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(wanted), pa.int32()), pa.array([own] * n, pa.int64()), pa.array([q] * n, pa.list_(pa.float64())),
                     pa.array([floor] * n, pa.float64()), pa.array(list(wanted.values()), pa.list_(pa.int32()))],
                    names=["shard", "id", "v", "floor", "cells"])

    def place(batches):
        for batch in batches:
            cells, h = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            shard = first[cells] + (h.view(np.uint64) % parts[cells].astype(np.uint64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns[:3]], names=["shard", "id", "v", "cell"])

    def scan(key, entries: pa.Table, wanted: pa.Table) -> pa.Table:
        if not entries.num_rows or not wanted.num_rows:
            return pa.Table.from_batches([result_batch([])])
        cell = entries.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        cell, x, ids = cell[order], matrix(entries.column("v"))[order], entries.column("id").to_numpy()[order]
        names, starts = np.unique(cell, return_index=True)
        ends = dict(zip(names.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(cell)])))
        q, own, lists = matrix(wanted.column("v")), wanted.column("id").to_numpy(), wanted.column("cells").to_pylist()
        floors = wanted.column("floor").to_numpy()
        out = []
        for at in range(0, len(q), 256):
            visits: dict[int, list[int]] = {}
            for i, cells in enumerate(lists[at:at + 256]):
                for c in cells:
                    if c in ends:
                        visits.setdefault(c, []).append(i)
            scores = np.full((min(256, len(q) - at), len(x)), -np.inf)
            for c, who in visits.items():
                a, b = ends[c]
                scores[who, a:b] = q[at:at + 256][who] @ x[a:b].T
            for i in range(len(scores)):
                rows_, exact = best(scores[i], ids, own[at + i], x, q[at + i], k, floors[at + i])
                out += [(own[at + i], ids[r], s, cell[r]) for r, s in zip(rows_, exact)]
        return pa.Table.from_batches([result_batch(out)])

    entries = indexed.withColumn("h", F.xxhash64("id")).mapInArrow(place, "shard int, id long, v array<double>, cell int")
    tasks = -(-asked.count() // TASK_QUERIES)
    routed = asked.select("id", "v").repartition(tasks).mapInArrow(
        plan, "shard int, id long, v array<double>, floor double, cells array<int>")
    found = entries.groupBy("shard").cogroup(routed.groupBy("shard")).applyInArrow(scan, RESULT)
    return top(found, k).select("query_id", "rank", "vec_id", "score")


def brute_force(indexed: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """The true k best of a bounded set of queries over all vectors, a block of rows at a time."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                own, x, cell = batch.column(0).to_numpy(), matrix(batch.column(1)), batch.column(2).to_numpy()
                scores = q @ x.T
                out = []
                for i in range(len(q)):
                    rows, exact = best(scores[i], own, ids[i], x, q[i], k)
                    out += [(ids[i], own[r], s, cell[r]) for r, s in zip(rows, exact)]
                yield result_batch(out)

    return top(indexed.select("id", "v", "cell").mapInArrow(run, RESULT), k)


def calibrate(indexed: DataFrame, asked: DataFrame, quantiser: Quantiser, counts: np.ndarray, k: int, target: float) -> int:
    """The number of candidates within which ``target`` of the true neighbours of a sample of
    queries lie."""
    chosen = asked.orderBy("h", "id").limit(CALIBRATION_QUERIES).select("id", "v").toArrow()
    ids, q = chosen.column("id").to_numpy(), matrix(chosen.column("v"))
    true: dict[int, list[int]] = {}
    for r in brute_force(indexed, ids, q, k).select("query_id", "cell").collect():
        true.setdefault(r["query_id"], []).append(r["cell"])
    depth = []
    for own, x in zip(ids.tolist(), q):
        met = {}
        seen = 0
        for cell in quantiser.traverse(x):
            seen += int(counts[cell])
            met[cell] = seen
        depth += [met[c] for c in true.get(own, [])]
    return max(int(np.quantile(depth, target)) if depth else 0, k + 1)
