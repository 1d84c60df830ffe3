"""Token files, BPE and packing against the tokenizers library and exact round trips."""

import hashlib
import io
import random
import tempfile
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetscope.llm import bpe, encoding, packing, token_files
from fleetscope.llm.queries import QUERIES, WORD_BPE

DOCS = "doc_id long, text string, ids string, decoded string, sequence_id string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


def odd_texts():
    r = random.Random(11)
    pool = [chr(c) for c in range(1, 0x600)] + ["'s", "'re", " ", "<|endoftext|>", "<|startoftext|>", "ΑΣ ", "İ", "Ⱥ", "½", "\x1c",
                                                "\x85", "你", "한", "😀", "ﬁ", "é", "J̌", "\n"]
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 14))) for _ in range(4000)]
    return texts + ["", " ", "a" * 50_000, "th" * 30_000, "word " * 30_000, "<|endoftext|>" * 3]


def docs(spark):
    rows = [(3, "The of and THE <|endoftext|> über", "x", "y", "z"), (1, None, None, None, None), (2, "", "", "", ""),
            (None, "no id", "a", "b", "c"), (3, "The of and THE <|endoftext|> über", "x", "y", "z"),
            (5, "long word " * 3000 + "q" * 5000, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def test_encoders_equal_library(library):
    texts = odd_texts()
    expected = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    own, index = encoding.encoder(WORD_BPE), bpe.codec(WORD_BPE)
    assert [np.frombuffer(own.encode(t), "<u4").tolist() for t in texts] == expected
    assert [x.tolist() for x in index.encode(texts)] == expected
    decode = bpe.decoder(WORD_BPE).decode
    assert all(decode(np.array(e)) == library.decode(e, skip_special_tokens=False) for e in expected)


def test_cache_keeps_answers_when_it_turns_over(library):
    cache = encoding.Cache(lambda w: w.encode(), most=3)
    words = [random.Random(i).choice("abcdefgh") for i in range(200)] + ["long" * 40]
    assert [cache[w] for w in words] == [w.encode() for w in words]
    assert len(cache) <= 3 and "long" * 40 not in cache


def test_lower_rank_inside_a_rank_goes_first():
    # merging b+c brings up a+bc of a lower rank: it must be applied before the other b+c
    e = bpe.PairIndexEncoder.__new__(bpe.PairIndexEncoder)
    vocab = {"a": 0, "b": 1, "c": 2, "bc": 3, "abc": 4, "cb": 5}
    e.border, e.size = 6, 7
    e.rank = {0 * 7 + 3: 0, 1 * 7 + 2: 1}
    e.made = [4, 3]
    e.inner = [0] * 256
    for name in "abc":
        e.inner[ord(name)] = vocab[name]
    e.last = e.inner
    assert e.encode_words(["abcbc", "bcabc", "c"]) == [[4, 3], [3, 4], [2]]


def test_encode_decode_operator(spark, library):
    got = bpe.decode(bpe.encode(docs(spark), WORD_BPE), WORD_BPE).collect()
    assert got[0].asDict().keys() == {"doc_id", "ids", "decoded"} and len(got) == 6
    for row, source in zip(got, docs(spark).collect()):
        ids = library.encode(source["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["decoded"] == library.decode(ids, skip_special_tokens=False)
    strange = spark.createDataFrame([(1, [5, None, 999_999, -4]), (2, None)], "doc_id long, ids array<int>")
    texts = [r["decoded"] for r in bpe.decode(strange, WORD_BPE).collect()]
    assert texts == [library.id_to_token(5), ""]
    empty = spark.createDataFrame([], DOCS)
    assert bpe.decode(bpe.encode(empty, WORD_BPE), WORD_BPE).count() == 0


def test_bpe_takes_one_python_stage_and_small_slices(spark, sf_small, capsys):
    # each Python stage has workers of its own in an executor, and any of them may come to hold the encoder
    QUERIES["op3_bpe"](spark, sf_small).explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    e, words = bpe.codec(WORD_BPE), [f"{i:06d}" * 5 for i in range(2000)]
    tracemalloc.start()
    e.encode_words(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 90 * len("".join(words)) and bpe.SLICE_BYTES <= 1 << 20


def test_decode_with_ids_without_tokens(spark, capsys):
    d = bpe.Decoder.__new__(bpe.Decoder)
    d.tokens = ["a", None, "b c", "", "\ue000", None]
    rows = [(1, [0, 1, 2, 3, 4, 5, 6, -1, None]), (2, [1]), (3, []), (4, [3, 3])]
    got = spark.createDataFrame(rows, "k int, ids array<int>").select(
        F.array_join(F.transform("ids", d.token), " ").alias("decoded"), "ids")
    got.explain()
    assert "split(" not in capsys.readouterr().out  # the list of tokens is made once, not for each id
    assert [r[0] for r in got.collect()] == ["a b c  \ue000", "", "", " "]
    assert all(r[0] == d.decode(np.array([-1 if i is None else i for i in r[1]], int)) for r in got.collect())


def test_token_file_round_trip(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 7)
    sink = io.BytesIO()
    out = token_files.TokenFileWriter(sink, 2)
    docs_ = [(4, np.arange(20, dtype="<u4")), (None, np.array([], "<u4")), (9, np.array([1], "<u4"))]
    for doc_id, ids in docs_:
        out.add(doc_id, ids)
    out.finish()

    class Source(io.BytesIO):
        reads: list = []

        def size(self):
            return len(self.getvalue())

        def read(self, n):
            self.reads.append((self.tell(), n))
            return super().read(n)

    source = Source(sink.getvalue())
    reader = token_files.TokenFileReader(source)
    assert [int(f) for f in reader.docs["frames"]] == [3, 0, 1] and reader.docs["null"].tolist() == [0, 1, 0]
    for k, (_, ids) in enumerate(docs_):
        assert np.concatenate([np.empty(0, "<u4"), *reader.frames_of(k)]).tolist() == ids.tolist()
    source.reads.clear()
    list(reader.frames_of(2))
    assert len(source.reads) == 1 and source.reads[0][0] == int(reader.starts[3])  # nothing else is read
    spoilt = bytearray(sink.getvalue())
    spoilt[int(reader.starts[3]) + 8] ^= 1
    with pytest.raises(Exception):
        list(token_files.TokenFileReader(Source(bytes(spoilt))).frames_of(2))
    with pytest.raises(ValueError):
        token_files.TokenFileReader(Source(sink.getvalue()[:-3]))


def test_token_files_operator(spark, library):
    folder = "file://" + tempfile.mkdtemp(prefix="token-files-") + "/f"
    manifest = token_files.write_token_files(docs(spark), folder, WORD_BPE, end_id=1)
    assert manifest.agg({"n_docs": "sum"}).first()[0] == 6
    got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids[0] is None and ids[1:] == [1, 2, 3, 3, 5]
    at = 0
    texts = {None: "no id", 1: "", 2: "", 3: "The of and THE <|endoftext|> über", 5: "long word " * 3000 + "q" * 5000}
    for r in got:
        own = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [1]
        assert (r["start"], r["n_tokens"]) == (at, len(own))
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        at += len(own)
    one = manifest.orderBy("first_id").first()
    assert len(token_files.read_documents(one["file"], [0])) == 1
    empty = "file://" + tempfile.mkdtemp(prefix="token-files-") + "/e"
    token_files.write_token_files(spark.createDataFrame([], DOCS), empty, WORD_BPE, end_id=1)
    assert token_files.read_token_files(spark, empty).count() == 0


@pytest.mark.parametrize("name", ["op2_token_files", "op3_bpe", "op7_packing"])
def test_queries_against_library(spark, sf_small, library, name):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    ids = {d: library.encode(t, add_special_tokens=False).ids for d, t in texts.items()}
    got = QUERIES[name](spark, sf_small).collect()
    if name == "op3_bpe":
        assert len(got) == len(texts)
        for r in got:
            own = ids[r["doc_id"]]
            assert r["n_tokens"] == len(own)
            assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest()
            decoded = library.decode(own, skip_special_tokens=False)
            assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    elif name == "op2_token_files":
        at = 0
        for r in sorted(got, key=lambda r: r["doc_id"]):
            own = ids[r["doc_id"]] + [1]
            assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
            at += len(own)
        assert len(got) == len(texts)
    else:
        check_places(got, {d: len(i) + 1 for d, i in ids.items()}, 2048)
        for r in got:
            own = (ids[r["doc_id"]] + [0])[r["start"]:r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())


def check_places(rows, lengths, capacity):
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert {d: sum(p[2] for p in ps) for d, ps in pieces.items()} == lengths
    for ps in pieces.values():
        for k, (piece, start, length) in enumerate(sorted(ps)):
            assert piece == k and start == k * capacity and (length == capacity or k == len(ps) - 1)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_plan_equals_best_fit_on_single_pieces():
    r = random.Random(3)
    for _ in range(150):
        capacity = r.randint(1, 40)
        lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 120))]
        histogram = {n: lengths.count(n) for n in set(lengths)}
        used = {}
        for length, a, b, each, first, offset in packing.plan(histogram, capacity):
            for rank in range(a, b):
                used.setdefault(first + (rank - a) // each, []).append((offset + (rank - a) % each * length, length))
        assert sum(map(len, used.values())) == len(lengths)
        for own in used.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(used) == best_fit_decreasing(lengths, capacity)
    with pytest.raises(ValueError):
        packing.plan({5: 1}, 4)


def test_packing_operator(spark, library):
    packed = packing.packed_documents(docs(spark), WORD_BPE, end_id=0, capacity=64, with_ids=True).cache()
    rows = [r for r in packed.collect() if r["doc_id"] == 5]
    own = library.encode("long word " * 3000 + "q" * 5000, add_special_tokens=False).ids + [0]
    assert [i for r in sorted(rows, key=lambda r: r["piece"]) for i in r["ids"]] == own
    assert packed.count() == len(rows) + 5
    for r in packing.sequences(packed).collect():
        assert 0 < len(r["ids"]) <= 64
    # one length held by most rows, and clashing columns
    items = spark.range(3000).selectExpr("id as doc_id", "0 as piece", "if(id < 2500, 30L, id % 64 + 1) as length",
                                         "'x' as sequence_id", "'y' as offset")
    got = packing.pack(items, 64)
    assert got.columns == ["doc_id", "piece", "length", "sequence_id", "offset"] and got.count() == 3000
    ends = got.groupBy("sequence_id").agg({"length": "sum"}).agg({"sum(length)": "max"}).first()[0]
    assert ends <= 64
    assert packing.packed_documents(spark.createDataFrame([], DOCS), WORD_BPE, 0, 64).count() == 0
