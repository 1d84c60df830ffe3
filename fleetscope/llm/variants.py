"""Operator 11 - spelling variants through a dictionary of trie-node pairs.

Words are counted over all documents.  A word of L code points passes L + 1 nodes of the forward
trie (its prefixes) and L + 1 of the reversed trie (its suffixes).  With numbered nodes, pair
(prefix node i, suffix node i) is the whole word at a place, pair (prefix node i, suffix node
i + 1) the word with its code point i skipped.  Two words that differ by one replaced code point
share one skipped pair; a word with one more code point shares a skipped pair with a whole pair
of the shorter one.  Equal pairs are joined by partitioning on (prefix node, suffix node): exact
neighbours, no candidates to verify.  Of a run of equal code points only the first skipped place
meets whole pairs, so every link is found exactly once.

A partition of equal pairs has at most one whole pair and one skipped pair per code point of
the alphabet.  Links are counted there and the most frequent neighbour is taken from the group's
two best, so pairs of words are never emitted; sums and least values per word follow.

Nodes: up to ``PACKED`` code points deep the number is packed from the code points (these nodes
hold many words); deeper ones are numbered by a dictionary of the nodes that at least two words
pass (the others cannot have neighbours), keyed by the prefix itself up to 15 bytes, beyond that
by a 128-bit digest made along the word, so long words cost linear space.  Word numbers follow
code-point order.  Forms point to words at least ``RATIO`` times as frequent, so they form
trees of logarithmic depth, which pointer doubling climbs.

Cases: null and empty texts have no words; a null id counts as empty text in front of the colon;
equal rows are counted each; ties go to the smaller word; words of any length take part; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.common import ascii_lower, numbered, ship, stored

#: Maximal runs of these, after A-Z is in lower case, are words.
WORD = "[a-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
PACKED = 3
#: One run in this many loses a code point before counting (the contract's planted misspellings).
MUTATE = 97
_RAW = 15
_BATCH = 1 << 16


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run): every run of letters of every text, A-Z in lower case."""
    found = F.regexp_extract_all(ascii_lower(F.col(f"`{text_col}`")), F.lit(WORD), F.lit(0))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.explode_outer(found).alias("run")).where("run is not null")


def mutated(found: DataFrame, one_in: int = MUTATE) -> DataFrame:
    """(word): the runs, where ``one_in`` divides the CRC-32 of ``<id>:<run>`` without one code point."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    cut = found.select("run", h.alias("h")).withColumn("at", F.expr("cast(h % length(run) as int)"))
    return cut.select(F.expr(f"case when h % {one_in} = 0 then concat(substr(run, 1, at), substr(run, at + 2)) else run end").alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n, wid): distinct words of enough length and count; wid ascends in code-point order."""
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    kept = stored(counted.where(F.col("n") >= least_count), "variants-words")
    return stored(numbered(kept, [F.col("word")], "wid"), "variants-vocabulary")


def _chain(points: list[int]):
    """For every prefix of ``points``, from the empty one: (packed number, None) or (None, key)."""
    packed, raw, digest = 0, b"", None
    yield 0, None
    for depth, p in enumerate(points, 1):
        code = chr(p).encode("utf-8", "surrogatepass")
        if depth <= PACKED:
            packed = packed << 21 | p
            raw += code
            yield packed, None
            continue
        if digest is None and len(raw) + len(code) <= _RAW:
            raw += code
            yield None, raw
            continue
        if digest is None:
            digest = hashlib.blake2b(raw, digest_size=16)
        digest.update(code)
        yield None, digest.digest()


def _places(wid: int, n: int, word: str):
    """Columns of the word's places: (wid, n, place, first of a run, prefix, suffix from the place, suffix behind it)."""
    points = [ord(c) for c in word]
    before = list(_chain(points))
    behind = list(_chain(points[::-1]))[::-1]  # behind[i]: suffix from place i on
    last = len(points)
    for i in range(last + 1):
        skipped = behind[i + 1] if i < last else (None, None)
        yield (wid, n, i < last, i < last and (i == 0 or points[i] != points[i - 1]), *before[i], *behind[i], *skipped)


_PLACES = pa.schema([("wid", pa.int64()), ("n", pa.int64()), ("skips", pa.bool_()), ("leads", pa.bool_()),
                     ("p", pa.int64()), ("pkey", pa.binary()), ("s", pa.int64()), ("skey", pa.binary()),
                     ("t", pa.int64()), ("tkey", pa.binary())])


def places(vocab: DataFrame) -> DataFrame:
    """One row for every place of every word with the nodes before, from and behind it: packed
    numbers p, s, t or keys pkey, skey, tkey."""
    ship(vocab.sparkSession)

    def run(batches):
        rows = []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PLACES)], schema=_PLACES)
        for batch in batches:
            for wid, n, word in zip(*(c.to_pylist() for c in batch.columns)):
                for row in _places(wid, n, word):
                    rows.append(row)
                    if len(rows) == _BATCH:
                        yield flush()
                        rows = []
        if rows:
            yield flush()

    return vocab.select("wid", "n", "word").mapInArrow(run, ("wid long, n long, skips boolean, leads boolean, p long, "
                                                             "pkey binary, s long, skey binary, t long, tkey binary"))


def _number(rows: DataFrame, number: str, key: str, name: str) -> DataFrame:
    """``rows`` with ``number`` filled from a dictionary of the keys that two words or more have;
    rows of other keys go.  Packed numbers are not negative, dictionary numbers are."""
    shared = rows.where(f"{key} is not null").groupBy(key).agg(F.min("wid").alias("lo"), F.max("wid").alias("hi")).where("lo < hi")
    numbers = stored(shared.select(key, (-1 - F.monotonically_increasing_id()).alias("_num")), f"variants-{name}")
    deep = rows.where(f"{key} is not null").drop(number).join(numbers, key).withColumnRenamed("_num", number)
    packed = rows.where(f"{key} is null")
    return packed.select(*rows.columns).unionByName(deep.select(*rows.columns)).drop(key)


def pairs(vocab: DataFrame) -> DataFrame:
    """(p, s, wid, n, kind): the dictionary of node pairs.  Kind 0 is a whole word at a place, 1 a
    skipped place, 2 a skipped place that leads its run of equal code points."""
    rows = stored(places(vocab), "variants-places")
    rows = stored(_number(rows, "p", "pkey", "prefixes"), "variants-numbered")
    whole = F.struct(F.lit(0).alias("kind"), "s", "skey")
    skip = F.struct(F.when(F.col("leads"), 2).otherwise(1).alias("kind"), F.col("t").alias("s"), F.col("tkey").alias("skey"))
    both = rows.select("wid", "n", "p", F.explode(F.when(F.col("skips"), F.array(whole, skip)).otherwise(F.array(whole))).alias("e"))
    both = stored(both.select("wid", "n", "p", "e.*"), "variants-pairs")
    return _number(both, "s", "skey", "suffixes")


def neighbours(vocab: DataFrame) -> DataFrame:
    """(wid, n_near, best): how many words are one edit away, and the most frequent of them as a
    struct (count negated, wid), the smaller word on ties.  Words without neighbours are left out."""
    group = Window.partitionBy("p", "s")
    me = F.struct((-F.col("n")).alias("c"), F.col("wid").alias("w"))
    rows = pairs(vocab).withColumn("me", me)

    def least(condition):
        return F.min(F.when(condition, F.col("me"))).over(group)

    def count(condition):
        return F.sum(F.when(condition, 1).otherwise(0)).over(group)

    kind = F.col("kind")
    rows = (rows.withColumn("skipped", count(kind > 0)).withColumn("leading", count(kind == 2)).withColumn("wholes", count(kind == 0))
            .withColumn("first", least(kind > 0)).withColumn("lead", least(kind == 2)).withColumn("whole", least(kind == 0))
            .withColumn("second", least((kind > 0) & (F.col("me") != F.col("first")))))
    other = F.when(F.col("first") == F.col("me"), F.col("second")).otherwise(F.col("first"))
    shorter = F.when(kind == 2, F.col("whole"))
    near = F.when(kind == 0, F.col("leading")).otherwise(F.col("skipped") - 1 + F.when(kind == 2, F.col("wholes")).otherwise(0))
    best = F.when(kind == 0, F.col("lead")).otherwise(F.coalesce(F.least(other, shorter), other, shorter))
    rows = rows.select("wid", near.alias("near"), best.alias("best")).where("near > 0")
    return rows.groupBy("wid").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(wid, root) for ``links`` (wid, form), whose chains end: pointers are doubled until none moves."""
    now = stored(links.select("wid", F.col("form").alias("root")), "variants-roots")
    while True:
        ahead = now.select(F.col("wid").alias("w"), F.col("root").alias("further"))
        after = now.join(ahead, now.root == F.col("w"), "left").select(
            "wid", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        after = stored(after, "variants-roots")
        now = after.select("wid", "root")
        if after.where("moved").isEmpty():
            return now


def group_variants(vocab: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``vocab`` (word, n, wid)."""
    found = vocab.join(neighbours(vocab), "wid", "left")
    takes = -F.col("best.c") >= ratio * F.col("n")
    found = stored(found.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(takes, F.col("best.w")).alias("form"), F.when(takes, -F.col("best.c")).alias("form_n")), "variants-found")
    ends = roots(found.where("form is not null").select("wid", "form"))
    forms = vocab.select(F.col("wid").alias("fw"), F.col("word").alias("form_word"))
    tops = vocab.select(F.col("wid").alias("rw"), F.col("word").alias("root_word"))
    linked = (found.where("form is not null").join(ends, "wid").join(forms, F.col("form") == F.col("fw")).join(tops, F.col("root") == F.col("rw"))
              .select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n"))
    alone = found.where("form is null").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return linked.unionByName(alone)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = MUTATE) -> DataFrame:
    """Spelling variants of all words of all texts."""
    return group_variants(vocabulary(mutated(runs(docs, id_col, text_col), one_in)))
