"""Operator 1 - quality rules with adaptive thresholds (DataFrame and SQL functions only).

``measure`` counts on whole texts, ``sketch`` builds mergeable quantile sketches for each
language and source, ``thresholds`` turns them into fences and ``judge`` joins them back.

The sketch of a measure is a table of counts over log-linear buckets (exact below 128, then 64
buckets for each doubling, so a quantile is off by less than 1/64 of its value).  Sketches merge
by adding counts: the partial aggregate of each task, the sketches of a language's sources, and
those of all languages.  A hot source is therefore summed before it is shuffled and its sketch
has no more rows than any other.  A fence is ``middle + spread_factor * spread + slack`` with
middle and spread from the group's own quantiles; it follows the group instead of a fixed
cutoff, and never removes a fixed share of it.  Groups of fewer than ``MIN_ROWS`` documents use
their language's sketch, languages with fewer the sketch of all.

Cases: null and empty texts have no words, fail the base rules and are not kept; null language
or source is a group of its own; repeated rows count each; ties in a bucket share it; an empty
table gives an empty result; other columns, also clashing ones, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.common import SPACES, cut, stored

WINDOW_WORDS = 8
MIN_WORDS = 20
MOST_REPEATED_PERCENT = 30
MIN_ROWS = 100

#: measure, side, quantiles of middle and spread (spread = |middle - other|), factor, slack.
#: Rates are in ten-thousandths, word length in thousandths of a character.
RULES = [
    ("symbol_rate", "high", 0.5, 0.25, 6, 200),
    ("dup_rate", "high", 0.5, 0.25, 6, 7000),
    ("word_length", "high", 0.5, 0.75, 6, 1500),
    ("word_length", "low", 0.5, 0.25, 6, 1500),
]
MEASURES = sorted({r[0] for r in RULES})


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeated_words(words: str) -> str:
    """SQL: words of the array ``words`` that lie in a window found at least twice in it.

    Windows are hashed; only those whose hash occurs twice are compared word by word."""
    k = WINDOW_WORDS
    neighbour = "filter({s}, (e, j) -> get({s}, j - 1).key = e.key or get({s}, j + 1).key = e.key)"
    same_hash = _let("sort_array(transform(h, (x, i) -> named_struct('key', x, 'at', i)))", "s", neighbour.format(s="s"))
    exact = _let(f"sort_array(transform(c, e -> named_struct('key', slice({words}, e.at + 1, {k}), 'at', e.at)))", "t",
                 neighbour.format(s="t"))
    covered = _let(f"sort_array(transform({exact}, e -> e.at))", "p",
                   f"aggregate(transform(p, (x, j) -> coalesce(least({k}, get(p, j + 1) - x), {k})), 0L, (a, x) -> a + x)")
    hashes = f"transform(sequence(0, size({words}) - {k}), i -> xxhash64(slice({words}, i + 1, {k})))"
    return (f"if(size({words}) <= {k}, 0L, "
            + _let(hashes, "h", f"if(size(array_distinct(h)) = size(h), 0L, {_let(same_hash, 'c', covered)})") + ")")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source", whole_rows: bool = False) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, one column for each measure of ``RULES``); with ``whole_rows`` the first column
    is ``row``, a struct of all columns of ``docs``, instead of doc_id."""
    first = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row") if whole_rows else F.col(id_col).alias("doc_id")
    key = "row" if whole_rows else "doc_id"
    texts = docs.select(first, F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = f"array_remove(split(text, r'{SPACES}+'), '')"
    lines = f"filter(split(text, '\\n'), l -> l rlike r'{SPACES.replace('[', '[^')}')"
    of_words = _let(words, "w", "named_struct('n_words', cast(size(w) as long), "
                    "'word_chars', aggregate(w, 0L, (a, x) -> a + length(x)), "
                    f"'n_repeat_words', {_repeated_words('w')})")
    of_lines = _let(lines, "ls", "named_struct('n_lines', cast(size(ls) as long), "
                    "'n_dup_lines', cast(size(ls) - size(array_distinct(ls)) as long))")
    counted = texts.select(key, "lang", "source", F.expr(of_words).alias("w"), F.expr(of_lines).alias("l"),
                           F.expr("cast(regexp_count(text, '[#*$%&|<>]') as long)").alias("n_symbols"))
    flat = counted.select(key, "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines",
                          "w.n_repeat_words", "l.n_lines")
    return flat.select(
        *[c for c in flat.columns if c != "n_lines"],
        F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words").alias("base_failed"),
        F.expr("n_symbols * 10000 div greatest(word_chars, 1L)").alias("symbol_rate"),
        F.expr("n_dup_lines * 10000 div greatest(n_lines, 1L)").alias("dup_rate"),
        F.expr("word_chars * 1000 div greatest(n_words, 1L)").alias("word_length"))


def bucket(value: Column) -> Column:
    """Lower end of the sketch bucket of a non-negative integer: its highest 7 bits."""
    step = F.expr("1L").cast("long") * F.pow(F.lit(2.0), F.greatest(F.length(F.bin(value)) - 7, F.lit(0))).cast("long")
    return value - value % step


def sketch(measured: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, bucket, n) over the documents that pass the base rules."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MEASURES]))
    return (measured.where("not base_failed").select(*keys, pairs.alias("p"))
            .groupBy(*keys, "p.measure", "p.bucket").agg(F.count("*").alias("n")))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows, one column low_/high_ for each rule) from merged sketches."""
    group = Window.partitionBy(*keys, "measure")
    ranked = (sketches.withColumn("upto", F.sum("n").over(group.orderBy("bucket")))
              .withColumn("total", F.sum("n").over(group)))

    def quantile(m: str, q: float) -> Column:  # the first bucket that reaches the rank
        hit = (F.col("measure") == m) & (F.col("upto") >= F.ceil(F.col("total") * q))
        return F.min(F.when(hit, F.col("bucket")))

    out = []
    for m, side, middle, other, factor, slack in RULES:
        mid, far = quantile(m, middle), quantile(m, other)
        if side == "high":
            out.append((mid + factor * F.abs(mid - far) + slack).alias(f"high_{m}"))
        else:
            out.append((mid - factor * F.abs(mid - far) - slack).alias(f"low_{m}"))
    return ranked.groupBy(*keys).agg(F.max("total").alias("rows"), *out)


def thresholds(measured: DataFrame) -> DataFrame:
    """(lang, source, fences): for each group the fences of the smallest of group, language and
    everything that has ``MIN_ROWS`` documents (everything also with fewer)."""
    names = [f"{r[1]}_{r[0]}" for r in RULES]
    base = cut(sketch(measured, ["lang", "source"]))
    own = fences(base, ["lang", "source"])
    by_lang = fences(merge(base, ["lang"]), ["lang"])
    # one row: the fences of everything
    overall = fences(merge(base.select("*", F.lit(0).alias("one")), ["one"]), ["one"]).first()
    groups = measured.select("lang", "source").distinct()
    rename = lambda df, tag: df.select(*[F.col(c).alias(f"{tag}_{c}") for c in df.columns])
    o, b = rename(own, "o"), rename(by_lang, "b")
    joined = (groups.join(o, groups.lang.eqNullSafe(o.o_lang) & groups.source.eqNullSafe(o.o_source), "left")
              .join(b, groups.lang.eqNullSafe(b.b_lang), "left"))
    pick = lambda c: F.when(F.col("o_rows") >= MIN_ROWS, F.col(f"o_{c}")).when(
        F.col("b_rows") >= MIN_ROWS, F.col(f"b_{c}")).otherwise(F.lit(overall and overall[c]).cast("long"))
    return joined.select("lang", "source", *[pick(n).alias(n) for n in names])


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` with ``kept``.  ``limits`` has one row for each group, so the planner may
    broadcast it where its size allows; else AQE splits a hot group's side of the join."""
    lim = limits.withColumnRenamed("lang", "t_lang").withColumnRenamed("source", "t_source")
    joined = measured.join(lim, measured.lang.eqNullSafe(lim.t_lang) & measured.source.eqNullSafe(lim.t_source), "left")
    tests = [~F.col("base_failed")]
    for m, side, *_ in RULES:
        limit = F.col(f"{side}_{m}")
        tests.append(F.coalesce(F.col(m) <= limit if side == "high" else F.col(m) >= limit, F.lit(True)))
    # as one value: a filter on it is not split and pushed below the join, where texts would be measured twice
    return joined.select(*measured.columns, F.forall(F.array(*tests), lambda x: x).alias("kept"))


def quality(docs: DataFrame, **columns: str) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every row of ``docs``."""
    measured = cut(measure(docs, **columns))
    return judge(measured, stored(thresholds(measured), "quality-thresholds"))


def keep_good(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were.  Texts are measured again on
    the way out instead of being shuffled to meet their verdicts."""
    limits = stored(thresholds(cut(measure(docs, **columns))), "quality-thresholds")
    return judge(measure(docs, whole_rows=True, **columns), limits).where("kept").select("row.*")
