"""SimHash components, nearest neighbours and the whole pipeline against brute force."""

import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from fleetscope.llm import multi_index, simhash, stages
from fleetscope.llm.queries import QUERIES

import corpus_pipeline


def slow_fingerprint(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] if word else words, ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    h = [xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def parts(points, radius):
    """Least index of each point's component."""
    points = np.asarray(points, dtype=np.uint64)
    label = list(range(len(points)))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1:] ^ points[i]) <= radius) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            label[b] = a
    return [find(i) for i in range(len(points))]


TEXTS = [None, "", " \n", "one", "One two", "one TWO three", "ÄÖ ü\u00a0x y", "a b c d " * 50, "word " * 20_000]


def test_fingerprints():
    for t in TEXTS[:-1]:
        assert simhash.fingerprint(t, 3) == slow_fingerprint(t)
    assert simhash.fingerprint(TEXTS[-1], 3) == simhash.fingerprint("word word word", 3)


def clustered(n, seed):
    r = random.Random(seed)
    out = []
    while len(out) < n:
        centre = r.getrandbits(64)
        for _ in range(r.choice([1, 1, 1, 2, 5, 40])):
            out.append(centre)
            for _ in range(r.randint(1, 3)):
                centre ^= 1 << r.randrange(64)  # chains of near fingerprints
    return out[:n]


@pytest.mark.parametrize("shard_rows,leaf", [(16, 8), (64, 16), (10_000, 32)])
def test_tree_meets_every_pair(monkeypatch, shard_rows, leaf):
    monkeypatch.setattr(simhash, "LEAF_ROWS", leaf)
    points = np.unique(np.array(clustered(1500, 4) + [0, 1, 3, 7], dtype=np.uint64))
    tree, shards = simhash.grow(points, len(points), shard_rows, 2)
    at, shard, home = simhash.route(points, tree, 2)
    assert np.bincount(at[home], minlength=len(points)).tolist() == [1] * len(points)  # one home each
    links = [x for s in range(shards) for x in simhash.shard_links(points[at[shard == s]], home[shard == s], 2)]
    index = {int(p): i for i, p in enumerate(points)}
    label = list(range(len(points)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        x, y = sorted((find(index[a]), find(index[b])))
        label[y] = x
    assert [find(i) for i in range(len(points))] == parts(points, 2)
    if shard_rows == 16:
        assert shards > 4


def test_dense_group_is_not_all_pairs():
    centre = 0x0123456789ABCDEF
    points = np.unique(np.array([centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)], dtype=np.uint64))
    links = simhash.shard_links(points, np.ones(len(points), dtype=bool), 2)
    assert len(points) - 1 <= len(links) < 4 * len(points)


def test_components_operator(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 32)
    r = random.Random(9)
    base = [" ".join(r.choice("alpha beta gamma delta rho tau".split()) + str(r.randrange(60)) for _ in range(r.randint(1, 120)))
            for _ in range(120)]
    texts = TEXTS[:-1] + [t for b in base for t in (b, b, b.upper(), b + " extra")]
    rows = [(i if i % 37 else None, t, "x", "y") for i, t in enumerate(texts)] + [(4, texts[4], "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id string")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fps = [slow_fingerprint(t) for _, t, *_ in rows]
    label = parts(fps, 2)
    least = {}
    for (doc_id, *_), k in zip(rows, label):
        if doc_id is not None:
            least[k] = min(least.get(k, doc_id), doc_id)
    want = sorted(((d, f, least.get(k)) for (d, *_), f, k in zip(rows, fps, label)), key=str)
    assert sorted(((x["doc_id"], x["fp"] % (1 << 64), x["component_id"]) for x in got), key=str) == want
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_connected_joins_long_chains(spark):
    n = 300
    links = [(i, i + 1) for i in range(n)] + [(1000, 1001), (1002, 1001), (5000, 5000)]
    random.Random(2).shuffle(links)
    got = {r["node"]: r["root"] for r in simhash.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000, 1002: 1000}


def test_op5_whole_table(spark, sf_small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = sorted(QUERIES["op5_simhash"](spark, sf_small).collect(), key=lambda r: r["doc_id"])
    fps = [slow_fingerprint(texts[d]) for d in sorted(texts)]
    assert [int(r["fingerprint"], 16) for r in got] == fps and all(len(r["fingerprint"]) == 16 for r in got)
    ids = sorted(texts)
    assert [r["component_id"] for r in got] == [ids[k] for k in parts(fps, 2)]


def brute(rows, k):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, v in good:
        if q % 20 == 0:
            scored = sorted(((-float((x * v).sum()), i) for i, x in good if i != q))[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


def test_neighbours_small_table_is_exact(spark):
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=6).round(2).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(50)]  # equal vectors: ties to the smaller id
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (204, [float("nan")] + [1.0] * 5),
             (220, [float("inf")] + [1.0] * 5), (205, [1.0, 2.0]), (None, [9.0] * 6)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as score", "1 as rank")
    usable = [x for x in rows if x[0] != 205]
    for k, shard in ((5, 8), (500, 2048)):
        got = {}
        for x in multi_index.search(vectors, vectors.where("vec_id % 20 = 0"), k, recall_target=1.0, shard_rows=shard).collect():
            got.setdefault(x["query_id"], {})[x["rank"]] = (x["vec_id"], x["score"])
        want = brute(usable, k)
        assert got.keys() == want.keys()
        hits = total = 0
        for q, rank in got.items():
            found = [rank[i + 1] for i in range(len(rank))]
            assert found == sorted(found, key=lambda f: (-f[1], f[0]))
            assert len(found) == min(k, len(want[q]))
            hits += len({i for i, _ in found} & {i for i, _ in want[q]})
            total += len(want[q])
        assert hits / total >= (1.0 if k == 500 else 0.9)
    assert multi_index.search(vectors.where("false"), vectors.where("false")).count() == 0


def test_layout_spreads_large_cells():
    first, parts_, shards = multi_index.layout(np.array([3, 0, 100, 5, 6]), 10)
    assert first.tolist() == [0, 0, 1, 11, 12] and parts_.tolist() == [1, 1, 10, 1, 1] and shards == 13


def test_heap_takes_cells_in_order():
    r = np.random.default_rng(0)
    q = multi_index.Quantiser(r.normal(size=(300, 8)), 300)
    x = r.normal(size=8)
    sums = (q.first @ x[:4])[:, None] + (q.second @ x[4:])[None, :]
    cells = list(q.traverse(x))
    assert sorted(cells) == list(range(q.cells))
    got = sums.ravel()[cells]
    assert (np.diff(got) <= 1e-12).all()


def test_op6_recall(spark, sf_small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    want = brute(rows, 20)
    got = {}
    for r in QUERIES["op6_neighbours"](spark, sf_small).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    hits = 0
    for q, own in got.items():
        assert [x[0] for x in sorted(own)] == list(range(1, 21))
        hits += len({x[1] for x in own} & {i for i, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)


def test_pipeline_against_its_operators(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_duplicates", "personal_data", "packing"]
    rejected = {r["doc_id"] for r in QUERIES["op9_language_id"](spark, sf_small).where("rejected").collect()}
    one = stages.language_id(spark, docs, sf_small)
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == rows.keys() - rejected
    two = stages.quality_rules(spark, one, sf_small).cache()
    kept = sorted(r["doc_id"] for r in two.collect())
    three = stages.near_duplicates(spark, two, sf_small).cache()
    label = parts([slow_fingerprint(rows[d]["text"]) for d in kept], 2)
    assert sorted(r["doc_id"] for r in three.collect()) == sorted({kept[k] for k in label})
    four = stages.personal_data(spark, three, sf_small)
    assert four.columns == docs.columns and all(r["n_chars"] == len(r["text"]) for r in four.collect())
    last = corpus_pipeline.run(spark, sf_small)
    assert {r["doc_id"] for r in last.collect()} == {kept[k] for k in label}


def test_stages_take_empty_and_odd_tables(spark, sf_small):
    schema = spark.read.parquet(f"{sf_small}/documents.parquet").schema
    empty = spark.createDataFrame([], schema)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0)], schema)
    for d in (empty, odd):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, d, sf_small).count() >= 0


@pytest.mark.parametrize("parts_of", [1, 3, 8])
def test_texts_under_one_id_stay_apart(spark, parts_of):
    def text(k):
        return " ".join(f"word{k}x{i}" for i in range(60))
    rows = [(3, text(1), "a"), (5, text(1), "b"), (5, text(2), "c"), (5, text(3), "d"), (5, text(3), "d"), (7, text(3), "e"),
            (None, text(4), "f"), (None, text(4), "f"), (None, text(1), "g"), (9, None, "h"), (9, "", "i"), (9, text(5), "j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts_of)
    kept = stages.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert len([r for r in got if not r[1]]) == 1  # null and empty text are copies of each other
    assert sorted((r for r in got if r[1]), key=str) == sorted(
        [(3, text(1), "a"), (5, text(2), "c"), (5, text(3), "d"), (None, text(4), "f"), (9, text(5), "j")], key=str)
