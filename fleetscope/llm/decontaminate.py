"""Operator 13 - benchmark decontamination by winnowing, with DataFrame functions only.

Words: A-Z is lower-cased, other ASCII signs than letters and digits part words.  Every item's
window is ``window`` consecutive words, or the whole item if it has fewer.  Of the hashes of all
``gram``-word sequences, the least (rightmost if several) in every ``window - gram + 1``
consecutive ones is kept.  A window occurring in a document holds exactly that many sequences,
so both sides keep the same one of them: every shared window meets in the join on the hash, at
about 2 / (window - gram + 2) fingerprints a word.  Each meeting is then extended word by word to
both sides; ``window`` or more equal words in a row are a hit, all else is dropped, so hash
collisions never count.  Items shorter than ``window`` are looked for with the same rule at
their own length (at most ``window - 1`` further lengths, and only those that occur).

Documents are read once: a document's row goes along its fingerprints as a marker.  A kept
fingerprint carries the ``window`` words around it, never its document.  On the benchmark's side
equal contexts are one row, so a passage of many items is compared once.  That side is written
first, its size is known, and Spark broadcasts it only below the session's threshold; beyond it
the join is shuffled by hash and hot hashes are split by adaptive execution.

Cases: null, empty or wordless texts have no words and no hits; wordless items never occur; equal
rows are counted each; benchmark rows with one item_id are one item; items without an id mark
words but are neither counted nor listed; a very long word or text is treated like any other;
empty tables give no hits or an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import ascii_lower, stored

#: What parts words, after A-Z is in lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
#: Places count downwards in the low half of a key, so the least key is the rightmost least hash.
_LAST = (1 << 31) - 1


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def fingerprints(w: Column, window: int, gram: int) -> Column:
    """The kept fingerprints of the words ``w``: structs of the window's length m, hash, place of
    the first word (from 0) and up to m - gram words before and m words from it on."""
    gram = min(gram, window)
    wide = window - gram + 1

    def key(i):
        h = F.xxhash64(*[F.get(w, i + o) for o in range(gram)])
        return F.shiftleft(h.bitwiseAND(F.lit(_LAST)), 32).bitwiseOR(F.lit(_LAST) - i)

    def least(keys):
        def at(i):
            found = [F.get(keys, i + o) for o in range(wide)]
            return F.least(*found) if wide > 1 else found[0]
        return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - window), at))

    def context(k):
        place = (F.lit(_LAST) - k.bitwiseAND(F.lit(_LAST))).cast("int")
        before = F.lit(window - gram)
        around = F.slice(w, F.greatest(place - before + 1, F.lit(1)), F.least(place, before) + window)
        return F.struct(F.lit(window).alias("m"), F.shiftright(k, 32).alias("hash"), place.alias("place"), around.alias("around"))

    keys = F.transform(F.sequence(F.lit(0), F.size(w) - gram), lambda i: key(i.cast("long")))
    kept = bound(keys, least)
    return F.when(F.size(w) >= window, F.transform(kept, context)).otherwise(F.array().cast(
        "array<struct<m:int,hash:bigint,place:int,around:array<string>>>"))


def bound(value: Column, use) -> Column:
    """The array ``use(value)``; ``value`` is evaluated once a row however often ``use`` names it.
    (Explode it with explode_outer: plain explode adds a filter that evaluates all of it again.)"""
    return F.flatten(F.transform(F.array(value), use))


def benchmark_contexts(benchmark: DataFrame, window: int, gram: int, id_col: str, text_col: str):
    """(contexts, items): the distinct fingerprints of all items with their surrounding words
    and a number, and which items have them."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("item"), words(F.col(f"`{text_col}`")).alias("w")).where("size(w) > 0")
    items = stored(items.withColumn("need", F.least(F.size("w"), F.lit(window))), "benchmark-words")
    lengths = sorted(r[0] for r in items.select("need").distinct().collect())  # at most ``window`` values

    def of_length(m):
        prints = bound(F.col("w"), lambda w: fingerprints(w, m, gram))
        return items.where(F.col("need") == m).select("item", F.explode_outer(prints).alias("f")).where("f is not null")

    found = reduce(DataFrame.unionByName, [of_length(m) for m in lengths or [window]]).select("item", "f.*")
    found = found.withColumn("lead", F.least("place", F.col("m") - F.least("m", F.lit(gram)))).select("item", "m", "hash", "lead", "around").distinct()
    found = stored(found.withColumn("context", F.sha2(F.to_json(F.struct("m", "lead", "around")), 256)), "benchmark-contexts")
    contexts = found.groupBy("context").agg(*[F.first(c).alias(c) for c in ("m", "hash", "lead", "around")])
    return stored(contexts, "benchmark-distinct"), found.select("context", "item").distinct(), lengths


def _same(a: str, b: str) -> str:
    """SQL: how many words two arrays share from their start on."""
    return f"coalesce(array_max(filter(sequence(0, least(size({a}), size({b}))), c -> slice({a}, 1, c) = slice({b}, 1, c))), 0)"


def _halves(around: str, lead: str) -> tuple[str, str]:
    """SQL: the words before the fingerprint, nearest first, and those from it on."""
    return f"reverse(slice({around}, 1, {lead}))", f"slice({around}, {lead} + 1, m)"


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, items).  ``rows`` has for every row of ``docs`` one marker (its columns, ``row``, n_words;
    null context) and one row for each hit: ``row``, first and last word (from 0), context;
    ``items`` names the items of a context.  Stored once."""
    contexts, items, lengths = benchmark_contexts(benchmark, window, gram, item_col, item_text)
    own = [c for c in docs.columns if c != text_col]

    def prints(w):  # the marker has the number of words and its row in the place of a hash, which no fingerprint of length 0 meets
        marker = F.struct(F.lit(0).alias("m"), F.col("_row").alias("hash"), F.size(w).alias("place"),
                          F.array().cast("array<string>").alias("around"))
        return F.concat(F.array(marker), *[fingerprints(w, m, gram) for m in lengths])

    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_doc"), F.monotonically_increasing_id().alias("_row"), F.col(f"`{text_col}`").alias("_t"))
    rows = base.select("_doc", "_row", F.explode_outer(bound(words(F.col("_t")), prints)).alias("_f"))
    rows = rows.select(F.when(F.col("_f.m") == 0, F.col("_doc")).alias("_doc"), "_row", "_f.*")
    c = contexts.select("context", F.col("m").alias("cm"), F.col("hash").alias("ch"), F.col("lead").alias("cl"), F.col("around").alias("ca"))
    met = rows.join(c, (F.col("m") == F.col("cm")) & (F.col("hash") == F.col("ch")), "left").where("m = 0 or context is not null")
    met = met.withColumn("_l", F.least("place", F.col("m") - F.least("m", F.lit(gram))))
    # guarded by the context: shared subexpressions are evaluated for every row, met or not
    (here, on), (there, further) = _halves("around", "_l"), _halves("ca", "cl")
    met = met.selectExpr("*", f"case when context is not null then {_same(here, there)} end as _a",
                         f"case when context is not null then {_same(on, further)} end as _b")
    hits = met.where(f"m = 0 or (_b >= least(m, {gram}) and _a + _b >= m)").select(
        "_doc", F.col("_row").alias("row"), F.when(F.col("m") == 0, F.col("place").cast("long")).alias("n_words"),
        (F.col("place") - F.col("_a")).alias("first"), (F.col("place") + F.col("_b") - 1).alias("last"), "context")
    return stored(hits, "benchmark-hits"), items


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Every row of ``docs`` (without its text and columns of the result's names) with n_words,
    n_hit, n_items, items (the ids as text, sorted, comma-joined)."""
    rows, items = matches(docs, benchmark, window, gram, text_col, item_col, item_text)
    found = rows.where("context is not null")
    hit = (found.select("row", "first", "last").distinct().select("row", F.explode(F.sequence("first", "last")).alias("at"))
           .distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit")))
    named = (found.select("row", "context").distinct().join(items, "context").where("item is not null")
             .select("row", F.col("item").cast("string").alias("item")).distinct()
             .groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items")))
    out = rows.where("context is null").select("_doc", "row", "n_words").join(hit, "row", "left").join(named, "row", "left")
    counts = ("n_words", "n_hit", "n_items", "items")
    own = [c for c in docs.columns if c != text_col and c not in counts]
    return out.select(*[F.col("_doc").getField(c).alias(c) for c in own], "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                      F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items", F.lit("")).alias("items"))
