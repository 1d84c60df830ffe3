"""Operator 3 - BPE encoding and decoding with a pair-occurrence index.

All distinct words of a slice of a partition lie one after another in one linked list of
symbols.  The index maps each pair's rank to the positions of all its occurrences; active ranks
are taken in ascending order from a heap, every occurrence of a rank is merged from left to
right, and the neighbouring pairs' lists are updated.  A word's merges do not touch another
word, so this equals merging each word alone, lowest rank first, leftmost first.  Should a
merge bring up a pair of a lower rank than its own, the rank's other positions go back to the
index and the lower rank is applied first.

Encoded words are kept for the worker's next slices (bounded, see ``encoding.Cache``).
Cases: null or empty text = no ids, decoded to an empty text; ids null or unknown to the
vocabulary decode to nothing; repeated rows are encoded alike; other columns, also one named ``ids`` or
``decoded``, are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import byte_slices, ship
from fleetscope.llm.encoding import CACHE_CHARS, Cache
from fleetscope.llm.pretokens import Pretokenizer, read_spec

CACHE_ENTRIES = 300_000
#: Text bytes whose new words are indexed together; a word's parts, places and ids take some hundred bytes until then.
SLICE_BYTES = 1 << 20

_CODECS: dict[str, "PairIndexEncoder"] = {}
_DECODERS: dict[str, "Decoder"] = {}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: the byte's
    own if it is printable in Latin-1, else the next free one from U+0100 on."""
    out, free = [], 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


class PairIndexEncoder:
    def __init__(self, path: str):
        spec = read_spec(path)
        self.pre = Pretokenizer(path, spec)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges") \
                or model.get("continuing_subword_prefix"):
            raise ValueError(f"{path}: not a plain BPE file")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.border = max(vocab.values()) + 1  # stands between words and in merged places; no pair has it
        self.size = self.border + 1
        self.rank, self.made = {}, []
        for r, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.rank.setdefault(vocab[a] * self.size + vocab[b], r)
            self.made.append(vocab[a + b])
        chars = byte_characters()
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + suffix] for c in chars]
        self.cache = Cache(lambda w: np.array(self.encode_words([w])[0], dtype="<u4").tobytes(), CACHE_ENTRIES)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, by one pair-occurrence index over all of them."""
        rank, size, made, border = self.rank.get, self.size, self.made, self.border
        inner, last = self.inner.__getitem__, self.last
        symbol, starts = [border], []
        for w in words:
            data = w.encode("utf-8")
            starts.append(len(symbol))
            symbol.extend(map(inner, data))
            symbol[-1] = last[data[-1]]
            symbol.append(border)
        place = list(range(-1, len(symbol) + 1))  # both lists share its numbers
        follow, before = place[2:], place[:-2]
        places: dict[int, list[int]] = {}
        for p in place[1:-2]:
            r = rank(symbol[p] * size + symbol[p + 1])
            if r is not None:
                if r in places:
                    places[r].append(p)
                else:
                    places[r] = [p]
        active = list(places)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            todo = places.pop(r)
            todo.sort()
            new = made[r]
            for n, p in enumerate(todo):
                q = follow[p]
                if rank(symbol[p] * size + symbol[q]) != r:
                    continue  # an earlier merge took one of the two
                symbol[p], symbol[q] = new, border
                after = follow[p] = follow[q]
                before[after] = p
                lower = False
                left = before[p]
                for at, key in ((left, symbol[left] * size + new), (p, new * size + symbol[after])):
                    x = rank(key)
                    if x is not None:
                        if x in places:
                            places[x].append(at)
                        else:
                            places[x] = [at]
                            heapq.heappush(active, x)
                        lower |= x < r
                if lower:  # the rest of this rank waits for the lower one
                    if r not in places:
                        places[r] = []
                        heapq.heappush(active, r)
                    places[r] += todo[n + 1:]
                    break
        out = []
        for p in starts:
            ids = []
            while symbol[p] != border:
                ids.append(symbol[p])
                p = follow[p]
            out.append(ids)
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; the words not met before are indexed together."""
        parts = [list(self.pre.parts(t)) if t else [] for t in texts]
        new = set()
        for p in parts:
            for _, words in p:
                if words:
                    new.update(words)
        new = [w for w in new if len(w) <= CACHE_CHARS and not self.cache.knows(w)]
        for w, ids in zip(new, self.encode_words(new)):
            self.cache.put(w, np.array(ids, dtype="<u4").tobytes())
        get = self.cache.__getitem__
        return [np.frombuffer(b"".join(t.to_bytes(4, "little") if w is None else b"".join(map(get, w)) for t, w in p),
                              dtype="<u4") for p in parts]


class Decoder:
    def __init__(self, path: str):
        spec = read_spec(path)
        if spec["decoder"] is not None:
            raise ValueError(f"{path}: has a decoder of its own")
        named = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.tokens = [named.get(i) for i in range(max(named) + 1)]

    def token(self, i: Column) -> Column:
        """The token of an id as an expression, null if there is none.  The tokens are a constant array, which the
        optimizer splits once from one string at a character that no token has."""
        used = set().union(*(t for t in self.tokens if t is not None))
        mark, none = [c for c in map(chr, range(0xE000, 0xF900)) if c not in used][:2]
        found = F.get(F.split(F.lit(mark.join(none if t is None else t for t in self.tokens)), mark, -1), i)
        return F.nullif(found, F.lit(none)) if None in self.tokens else found

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by a space, as the library decodes files without a decoder."""
        try:
            return " ".join(map(self.tokens.__getitem__, ids.tolist()))
        except (IndexError, TypeError):  # ids out of range, or without a token
            known = (self.tokens[i] for i in ids.tolist() if 0 <= i < len(self.tokens))
            return " ".join([t for t in known if t is not None])


def codec(path: str) -> PairIndexEncoder:
    """The worker's codec for a tokenizer file."""
    if path not in _CODECS:
        _CODECS[path] = PairIndexEncoder(path)
    return _CODECS[path]


def decoder(path: str) -> Decoder:
    """The worker's decoder for a tokenizer file."""
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(path)
    return _DECODERS[path]


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row."""
    ship(docs.sparkSession)

    def run(batches):
        code = codec(tokenizer)
        for batch in batches:
            for part in byte_slices(batch, text_col, SLICE_BYTES):
                ids = code.encode(part.column(1).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate([np.empty(0, "<u4"), *ids]).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[id_col, "ids"])
        code.cache.rest()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded) for every row with an ``ids`` array; null ids decode to an empty text.

    An expression of Spark's: a second Python stage would double an executor's Python workers, and as Spark
    hands any idle worker to either stage, each of them would come to hold the encoder and its words too."""
    token = decoder(tokenizer).token
    rows = encoded.select(id_col, F.coalesce(F.col("ids"), F.array().cast("array<int>")).alias("ids"))
    return rows.withColumn("decoded", F.array_join(F.transform("ids", token), " "))
