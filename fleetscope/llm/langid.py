"""Operator 9 - language ID by nearest centroid.

Texts become normalised TF-IDF vectors of hashed character 1- to 3-grams (whole texts; words
lower-cased, everything but letters is one space).  Each language has up to ``CENTROIDS``
centroids, found by spherical k-means; the language of the centroid with the largest cosine
wins.  A text is rejected if it is farther from its centroid than texts of its length may be.
Those limits are the largest distances seen in training, for each doubling of the number of
n-grams; the first few words of each training text stand for short texts.  The longest training
texts, ``LEAST_SUPPORT`` of them at least, share one limit, which holds for all longer texts too.

The model is fitted on a bounded sample: ``PER_LANGUAGE`` labelled rows of each of the
``MOST_LANGUAGES`` most frequent languages, chosen by the hash of their id.  Only the
hashed counts of these texts and snippets (at most ``DIMS`` numbers each) reach the driver.

Cases: null text, or text without a letter = ``und``, score 0, rejected; null labels teach
nothing; ties go to the first language in order; with no labelled row at all every text is
``und``; repeated rows get equal answers; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.common import byte_slices, ship

DIMS = 1 << 14
PER_LANGUAGE = 400
MOST_LANGUAGES = 200
OVERSAMPLE = 4
CENTROIDS = 4
CHUNK = 1 << 20
#: Words of the snippets that stand for short texts when limits are set.
SNIPPETS = (1, 2, 4, 8, 16, 32, 64)
#: What is added to the largest distance seen, and the largest limit there can be.
MARGIN, MOST_DISTANCE = 0.05, 0.98
#: Training texts that a limit rests on at least.
LEAST_SUPPORT = 20
LENGTHS = 64
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point whether it is a letter (made once in a worker)."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def counts(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None if it has no letter."""
    if not text:
        return None
    total, carry, any_letter = np.zeros(DIMS, dtype=np.int64), np.array([32], dtype=np.uint32), False
    for at in range(0, len(text), CHUNK):
        cp = np.frombuffer(text[at:at + CHUNK].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        known = letters()[cp]
        any_letter |= bool(known.any())
        cp = np.concatenate([carry, np.where(known, cp, 32).astype(np.uint32)])
        if at + CHUNK >= len(text):
            cp = np.append(cp, np.uint32(32))
        space = cp == 32
        keep = ~(space & np.concatenate([[False], space[:-1]]))  # one space between words
        keep[:len(carry)] = True
        cp = cp[keep]
        done = len(carry) - 1 if at else 0  # n-grams that end in the carry are counted
        a, b, c = (cp * np.uint32(m) for m in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35))
        for gram in (a[max(done + 1, 1) if at else 1:], a[1:] ^ b[:-1], a[2:] ^ b[1:-1] ^ c[:-2]):
            total += np.bincount((gram ^ (gram >> np.uint32(15))) % np.uint32(DIMS), minlength=DIMS)
        carry = cp[-2:]
        if at + CHUNK < len(text):  # the bigram inside the carry is counted again with the next chunk
            if len(carry) == 2:
                a, b = carry[1:] * np.uint32(0x9E3779B1), carry[:1] * np.uint32(0x85EBCA6B)
                g = a ^ b
                total -= np.bincount((g ^ (g >> np.uint32(15))) % np.uint32(DIMS), minlength=DIMS)
    return total if any_letter else None


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # centroids x DIMS, unit length
    limits: dict[str, np.ndarray]  # largest accepted distance by the length's power of two
    idf: np.ndarray

    def weights(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Unit TF-IDF weights of the dimensions ``at`` with counts ``n``."""
        v = np.sqrt(n) * self.idf[at]
        return (v / np.linalg.norm(v)).astype(np.float32)

    def nearest(self, at: np.ndarray, n: np.ndarray) -> tuple[str, float]:
        cosine = self.centroids[:, at] @ self.weights(at, n)
        k = int(np.argmax(cosine))
        return self.languages[k], min(max(float(cosine[k]), 0.0), 1.0)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected)."""
        n = counts(text)
        if n is None or not len(self.languages):
            return UNKNOWN, 0.0, True
        at = np.flatnonzero(n)
        lang, score = self.nearest(at, n[at])
        return lang, score, bool(1 - score > self.limits[lang][length_class(n)])


def length_class(n: np.ndarray) -> int:
    return int(n.sum()).bit_length()


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to ``k`` unit centroids of unit rows: farthest-first start, then Lloyd rounds by cosine."""
    first = x.mean(axis=0)
    chosen = [int(np.argmax(x @ first))]
    nearest = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        # among the farther half the middle one: outliers make poor centres
        order = np.argsort(nearest, kind="stable")
        chosen.append(int(order[len(order) // 4]))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    c = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.array([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.linalg.norm(c, axis=1, keepdims=True)
    return c


Row = tuple[str, np.ndarray, np.ndarray]  # language, dimensions, their counts


def train(rows: list[Row], snippets: list[Row] = ()) -> Model:
    """A model from whole texts; ``snippets`` only widen the limits.  At most one language's
    rows are dense at a time."""
    df = np.zeros(DIMS)
    for _, at, _ in rows:
        df[at] += 1
    model = Model([], np.zeros((0, DIMS), np.float32), {}, np.log((1 + len(rows)) / (1 + df)) + 1)
    centres, support = [], {}
    for lang in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == lang]
        dense = np.zeros((len(own), DIMS), dtype=np.float32)
        for x, (_, at, n) in zip(dense, own):
            x[at] = model.weights(at, n)
        c = k_means(dense, CENTROIDS)
        centres += list(c)
        model.languages += [lang] * len(c)
        model.limits[lang] = np.zeros(LENGTHS)
        support[lang] = np.zeros(LENGTHS, dtype=np.int64)
    if centres:
        model.centroids = np.array(centres, dtype=np.float32)
    for own, at, n in [*rows, *snippets]:
        lang, score = model.nearest(at, n)
        if lang == own:
            size = length_class(n)
            model.limits[lang][size] = max(model.limits[lang][size], 1 - score)
            support[lang][size] += 1
    for lang, far in model.limits.items():
        model.limits[lang] = limits_from(far, support[lang])
    return model


def limits_from(far: np.ndarray, support: np.ndarray) -> np.ndarray:
    """Limits by length class from the largest distance and the number of texts seen in each."""
    far = np.maximum.accumulate(far[::-1])[::-1]  # a shorter text may be as far as any longer one
    upward = np.cumsum(support[::-1])[::-1]  # texts of this class and longer
    if not upward[0]:  # nothing seen, nothing to reject by
        return np.full(len(far), MOST_DISTANCE)
    longest = np.flatnonzero(upward >= min(LEAST_SUPPORT, upward[0]))[-1]
    far[longest:] = far[longest]
    return np.minimum(far + MARGIN, MOST_DISTANCE)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on a bounded, hash-chosen sample of ``labelled``."""
    ship(labelled.sparkSession)
    usable = labelled.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    ids = usable.select(F.col(lang_col).alias("l"), F.col(id_col).alias("i"), F.xxhash64(F.col(id_col)).alias("h"))
    sizes = ids.groupBy("l").count().orderBy(F.desc("count"), "l").limit(MOST_LANGUAGES).collect()
    if not sizes:
        return train([])
    # a hash share that holds a few times the rows wanted, so that little is shuffled and ranked
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["l"]), F.lit(min(1.0, OVERSAMPLE * PER_LANGUAGE / r["count"])))])
    some = ids.where(F.pmod("h", F.lit(1 << 20)) < F.coalesce(F.element_at(share, F.col("l")), F.lit(0.0)) * (1 << 20))
    top = some.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h", "i"))).where(f"r <= {PER_LANGUAGE}")
    chosen = top.select("l", "i").distinct()

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "t"):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    some = (text or "").split(None, SNIPPETS[-1])[:SNIPPETS[-1]]
                    for words in (0, *(k for k in SNIPPETS if k < len(some))):
                        n = counts(" ".join(some[:words]) if words else text)
                        if n is not None:
                            at = np.flatnonzero(n)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([lang]), pa.array([words == 0]), pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
                                 pa.array([n[at]], pa.list_(pa.int64()))], names=["l", "whole", "at", "n"])

    texts = usable.select(F.col(id_col).alias("i"), F.col(lang_col).alias("l"), F.col(text_col).alias("t"))
    # at most PER_LANGUAGE * MOST_LANGUAGES ids
    sample = texts.join(F.broadcast(chosen), ["l", "i"], "left_semi").select("l", "t").mapInArrow(
        run, "l string, whole boolean, at array<int>, n array<bigint>").toArrow()
    rows, snippets = [], []
    for lang, whole, at, n in zip(*(sample.column(c) for c in ("l", "whole", "at", "n"))):
        (rows if whole.as_py() else snippets).append((lang.as_py(), at.values.to_numpy(), n.values.to_numpy()))
    rows.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))  # the same model whatever order the rows came in
    return train(rows, snippets)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) for every row."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, text_col):
                found = [model.predict(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                    names=[id_col, "lang_pred", "score", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the model does not reject, all columns as they were."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, text_col):
                yield part.filter(pa.array([not model.predict(t)[2] for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
