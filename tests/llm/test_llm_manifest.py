"""Spelling variants, Merkle audit and decontamination against brute force on small rows."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from fleetscope.llm import decontaminate, merkle, variants
from fleetscope.llm.common import ascii_lower

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, word string, n_words long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None if i is None or i % 3 == 0 else "en", s, None if t is None else len(t), "r", "w", 5)
                                  for i, t, s in rows], DOCS)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(hashes):
    ways, level, members = [[] for _ in hashes], list(hashes), [[i] for i in range(len(hashes))]
    while len(level) > 1:
        above, below = [], []
        for at in range(0, len(level), 16):
            run = level[at:at + 16]
            for j in range(len(run)):
                for i in members[at + j]:
                    ways[i].append((j, run))
            above.append(digest(*run))
            below.append(sum(members[at:at + 16], []))
        level, members = above, below
    return level[0], ways


def brute_audit(rows):
    def leaf(r):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below = []
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        below.append(tree([leaf(r) for r in groups[g]]))
    root, top = tree([b[0] for b in below])
    out = []
    for g, (subroot, ways), over in zip(names, below, top):
        for r, way in zip(groups[g], ways):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            got = leaf(r[:4] + (r[4].translate(LOWER),) if changed else r)
            for j, run in way + over:
                got = digest(*run[:j], got, *run[j + 1:])
            out.append((r[0], leaf(r), subroot, root, digest(*(h for j, run in way + over for k, h in enumerate(run) if k != j)), got, got == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17, None: 1}, {f"s{i:02d}": 1 for i in range(18)},
                                   {"hot": 300, "b": 2, None: 33, "Ünï": 1, "": 5}])
def test_merkle_equals_brute_force(spark, sizes):
    texts = [None, "", "Some TEXT", "ÄÖÜ Ünï", "x" * 200_000, "same", "same"]
    rows, n = [], 0
    for source, k in sizes.items():
        for j in range(k):
            rows.append((None if j % 40 == 3 else n // 2 * 2 if source == "hot" else n, texts[n % 7], source))
            n += 1
    docs = documents(spark, rows).repartition(5)
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = merkle.audit(docs, {"text": F.when(changed, ascii_lower(F.col("text"))).otherwise(F.col("text"))})
    got = sorted((tuple(r) for r in found.collect()), key=str)
    expected = brute_audit([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()])
    assert got == expected
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000000"  # the session's own bound is back


def test_nodes_stored_in_shares_give_the_same(spark, monkeypatch):
    docs = documents(spark, [(i, f"Text {i}", "hot" if i % 3 else f"s{i % 60}") for i in range(700)])
    once = sorted(tuple(r) for r in merkle.audit(docs).collect())
    monkeypatch.setattr(merkle, "SHARE", 2)
    monkeypatch.setattr(merkle, "_SINGLE", 1)
    _, nodes, _ = merkle.build(docs)
    assert nodes.agg(F.max("share")).first()[0] > 3
    assert sorted(tuple(r) for r in merkle.audit(docs).collect()) == once and all(r[-1] for r in once)


def test_merkle_of_an_empty_table(spark):
    assert merkle.audit(documents(spark, [])).count() == 0


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_contamination(docs, items, window=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words_of(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[i:i + m])].add(item)
    out = []
    for i, text in docs:
        w, hit, found = words_of(text), set(), set()
        for m in {len(k) for k in windows}:
            for at in range(len(w) - m + 1):
                if tuple(w[at:at + m]) in windows:
                    hit |= set(range(at, at + m))
                    found |= windows[tuple(w[at:at + m])]
        found = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(found), ",".join(found)))
    return sorted(out, key=str)


def contaminated(spark, docs, items, **kw):
    d = documents(spark, [(i, t, "s") for i, t in docs])
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1)).withColumn("m", F.lit(2))
    out = decontaminate.contamination(d.repartition(3), b, **kw)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "row", "word", "n_words", "n_hit", "n_items", "items"]
    return sorted((tuple(r) for r in out.select("doc_id", "n_words", "n_hit", "n_items", "items").collect()), key=str)


def test_contamination_equals_brute_force(spark):
    r = random.Random(3)
    def text(n, words=4):
        return " ".join(f"w{r.randrange(words)}" for _ in range(n))
    items = [(i, text(r.randrange(1, 25), r.choice([2, 4, 50]))) for i in range(60)]
    items += [(60, items[0][1]), (0, text(14, 50)), (None, text(12, 50)), (61, None), (62, "—"), (63, "  "), (64, "Ä a" * 1), (65, "x " * 40)]
    shared = text(30, 60)
    items += [(100 + i, shared) for i in range(30)] + [(200, shared.upper()), (201, shared.replace(" ", "--"))]
    docs = [(i, text(r.randrange(0, 60), r.choice([2, 4, 50]))) for i in range(60)]
    docs += [(70, None), (71, ""), (72, "!!!"), (73, f"{text(5)} {shared} {text(5)}"), (73, shared), (73, shared), (None, shared),
             (74, " ".join(shared.split()[:9])), (75, " ".join(shared.split()[3:13])), (76, "x " * 3000), (77, "y" * 300_000 + " " + shared),
             (78, "ÄÖ. ä a, Ä A b")]
    expected = brute_contamination(docs, items)
    assert any(e[2] and e[2] < e[1] for e in expected)
    assert contaminated(spark, docs, items) == expected


@pytest.mark.parametrize("window,gram", [(3, 5), (6, 2), (12, 12), (1, 1)])
def test_contamination_at_other_widths(spark, window, gram):
    r = random.Random(window)
    rows = [(i, " ".join(r.choice("abcd") for _ in range(r.randrange(30)))) for i in range(30)]
    items = [(i, " ".join(r.choice("abcd") for _ in range(r.randrange(20)))) for i in range(12)]
    assert contaminated(spark, rows, items, window=window, gram=gram) == brute_contamination(rows, items, window)


def test_contamination_of_empty_tables(spark):
    assert contaminated(spark, [], [(1, "a b")]) == []
    assert contaminated(spark, [(1, "a b")], []) == [(1, 2, 0, 0, "")]


def brute_variants(docs):
    counts = collections.Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            counts[w[:h % len(w)] + w[h % len(w) + 1:] if h % 97 == 0 else w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    forms, out = {}, {}
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 2 * n else None
        out[w] = (forms[w], n, len(close), words[best] if forms[w] else None)
    def root(w):
        return root(forms[w]) if forms[w] else w
    return sorted((w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items())


def test_variants_equal_brute_force(spark):
    r = random.Random(5)
    base = ["spelling", "spellings", "speling", "aaaaa", "aaaaaa", "aabaa", "baaaa", "éàüöß", "éàüöss", "abcdefghijklmnopqrstuvwxyz",
            "ÀÉabcde", "z" * 40, "z" * 41, "z" * 39 + "y", "ÿ" * 20, "ÿ" * 19, "ÿ" * 21, "abcd", "q" * 3000, "q" * 3001, "q" * 1500 + "r" + "q" * 1499]
    alphabet = [w for w in base] + [base[0][:i] + c + base[0][i + 1:] for i in range(8) for c in "xyz"] \
        + ["".join(r.choice("ab") for _ in range(r.randrange(5, 8))) for _ in range(40)] + ["hotpre" + c + d for c in "abcdefgh" for d in "ijkl"]
    docs = []
    for i in range(120):
        picked = [r.choice(alphabet[:r.choice([3, 20, len(alphabet)])]) for _ in range(40)]
        docs.append((None if i % 30 == 7 else i, r.choice([" ", "-", "1", "×"]).join(w.title() if r.random() < .2 else w for w in picked)))
    docs += [(500, None), (501, ""), (502, "12 34"), (5, docs[5][1]), (5, docs[5][1])]
    expected = brute_variants(docs)
    assert any(e[1] for e in expected) and any(e[1] and e[1] != e[2] for e in expected)
    got = variants.variants(documents(spark, [(i, t, "s") for i, t in docs]).repartition(3))
    assert sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()) == expected


def test_variants_of_an_empty_table(spark):
    assert variants.variants(documents(spark, [(1, None, "s")])).count() == 0


def test_long_chains_of_forms_end_at_one_root(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(1000 + i, 70) for i in range(50)], "wid long, form long")
    assert {(r.wid, r.root) for r in variants.roots(links).collect()} == {(i, 70) for i in range(70)} | {(1000 + i, 70) for i in range(50)}
