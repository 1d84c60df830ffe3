"""Operator 10 - main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score positive and tags negative, with weights
learned from labelled pages (pages whose main part is marked by one ``article`` element): a
word's weight is the log-odds of its context (enclosing section and element) to lie in the main
part, a tag's weight is always below zero.  The ``article`` element itself is in no context and
weighs nothing, so weights say the same of pages that do not mark their main part.  One linear scan finds the contiguous region with the
largest sum.  Elements inside the region that are boilerplate by kind (scripts, menus, forms,
adverts, comments ...) are left out; what remains becomes one line for each block.  A class, role
or id makes an element boilerplate only as a whole name (``related``, ``cookie-notice``,
``share-buttons``, not ``share-prices``); a name that merely holds such a word halves the weight
of the words in it.  Ids of headings and sections are slugs of their titles and say nothing.

The weights come from a bounded sample of pages (``SAMPLE_PAGES``, by hash of the id); only
counts for each context, at most ``MOST_CONTEXTS`` of them, reach the driver.

Work is linear in the length of a page however deep its elements nest: places of open elements are
kept by name, and an element is pushed and popped once.

Cases: null or empty html and pages without text give an empty text; markup cut off in the
middle is read up to its end; repeated rows get equal texts; ties between regions go to the
first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import byte_slices, ship

SAMPLE_PAGES = 1000
MOST_CONTEXTS = 10_000
LEAST_SEEN = 20
#: Weights of contexts and tags that the labelled pages do not show.
UNSEEN_WORD, UNSEEN_TAG = 1.0, -0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-z][a-z0-9:-]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.I | re.S)
_LABEL = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)

BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre "
                   "section select summary table tbody td tfoot th thead tr ul".split())
SECTIONS = frozenset("aside body dialog div fieldset footer form header main menu nav section table".split())
#: Sections that an open paragraph outside of them does not end at.
ENCLOSING = SECTIONS - {"body"} | {"article"}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements and class, id or role words of boilerplate.
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog select button".split())
BOILERPLATE_WORDS = frozenset("ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments "
                              "cookie cookies consent footer menu modal nav navbar navigation newsletter notice notices popup "
                              "promo promoted promotion related search share sharing sidebar social sponsor sponsored "
                              "subscribe toolbar widget".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
#: Words that stand beside those in names of page parts.
FORM_WORDS = frozenset("area article articles bar block body bottom box button buttons container content desktop entries footer "
                       "form global group header icon icons inner input item items left link links list main mobile outer overlay "
                       "page panel post posts primary right row secondary section sections site slot small sticky thread title "
                       "toggle top unit wrap wrapper".split())
#: Elements whose id is a slug of their title.
TITLED = frozenset("h1 h2 h3 h4 h5 h6 section".split())
#: What is left of a positive weight in elements whose names hold a boilerplate word among others.
DOUBT = 0.5


def names(element: str, attrs: str) -> list[list[str]]:
    """The words of each class, role and id of an element."""
    out = []
    for kind, value in _LABEL.findall(attrs):
        if kind.lower() != "id" or element not in TITLED:
            out += [words for n in value.strip("\"'").lower().split() if (words := [w for w in re.split(r"[^a-z0-9]+", n) if w])]
    return out


def names_part(words: list[str], parts: frozenset) -> bool:
    """Whether a whole name says that its element is one of ``parts``."""
    return not parts.isdisjoint(words) and all(
        w in parts or w in BOILERPLATE_WORDS or w in FORM_WORDS or re.fullmatch(r"\d+(x\d+)?", w) for w in words)


class Page:
    """Tokens of a page: ``kind`` 't' (words) or 'b' (block border), 'i' (inline tag); parallel
    lists of weight key, text and whether the token lies in boilerplate, in the label element or in
    an element that may be boilerplate."""

    def __init__(self, source: str | None):
        self.kind, self.key, self.value, self.junk, self.marked, self.doubt = [], [], [], [], [], []
        self.articles = 0
        stack: list[tuple[str, str, str, bool, bool]] = []  # name, section and leaf outside, boilerplate, doubtful
        places: dict[str, list[int]] = {}  # where each name is open, so that no tag looks through the stack
        section, leaf, junk, inside, doubt = "body", "body", 0, 0, 0

        def last(names) -> int:
            return max((places[n][-1] for n in names if places.get(n)), default=-1)

        def pop_to(name: str) -> None:
            nonlocal section, leaf, junk, inside, doubt
            k = last((name,))
            while -1 < k < len(stack):
                n, section, leaf, bad, unsure = stack.pop()
                places[n].pop()
                junk -= bad
                doubt -= unsure
                inside -= n == "article"

        for m in _TOKEN.finditer(source or ""):
            text = m["text"]
            if text is not None:
                words = html.unescape(text)
                if words.strip():
                    self._add("t", f"{section}|{leaf}", words, junk > 0, inside > 0, doubt > 0)
                elif words:
                    self._add("s", "", " ", junk > 0, inside > 0)
                continue
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                continue
            closing, attrs = bool(m["close"] or m["close2"]), m["attrs"] or m["attrs2"] or ""
            border = "b" if name in BLOCKS else "i"
            if closing:
                self._add(border, "" if name == "article" else f"/{name}", "", junk > 0, inside > 0)
                pop_to(name)
                continue
            if name in BLOCKS and last(("p",)) > last(ENCLOSING):
                pop_to("p")
            if name == "li" and last(("li",)) > last(("ul", "ol", "menu")):
                pop_to("li")
            own = names(name, attrs) if attrs else []
            bad = name in BOILERPLATE_TAGS or any(names_part(n, BOILERPLATE_WORDS) for n in own)
            if not inside and (name == "header" or any(names_part(n, HEADER_WORDS) for n in own)):
                bad = True
            unsure = not bad and any(not (BOILERPLATE_WORDS if inside else BOILERPLATE_WORDS | HEADER_WORDS).isdisjoint(n) for n in own)
            if name in ("html", "body", "main", "article"):
                bad = unsure = False
            if name in VOID or attrs.endswith("/"):
                self._add(border if name != "br" else "s", f"<{name}", " " if name == "br" else "", junk > 0, inside > 0)
                continue
            if name == "article":
                self.articles += 1
            self._add(border, "" if name == "article" else f"<{name}", "", junk > 0 or bad, inside > 0)
            places.setdefault(name, []).append(len(stack))
            stack.append((name, section, leaf, bad, unsure))
            junk += bad
            doubt += unsure
            inside += name == "article"
            if name in SECTIONS:
                section = ".".join([name, *(own[0][:1] if own else [])])
            if name in BLOCKS or name == "a":
                leaf = name

    def _add(self, kind, key, value, junk, marked, doubt=False) -> None:
        self.kind.append(kind)
        self.key.append(key)
        self.value.append(value)
        self.junk.append(junk)
        self.marked.append(marked)
        self.doubt.append(doubt)

    def counts(self) -> dict[str, list[int]]:
        """key -> [inside, outside] occurrences: words of text contexts, single tags.  Words of
        boilerplate count as outside, wherever they lie: they show in which contexts menus and
        adverts are.  Its tags do not count, as lists and links are in main parts too."""
        out: dict[str, list[int]] = {}
        for kind, key, value, junk, marked in zip(self.kind, self.key, self.value, self.junk, self.marked):
            if key and (kind == "t" or not junk):
                out.setdefault(key, [0, 0])[junk or not marked] += len(value.split()) if kind == "t" else 1
        return out

    def region(self, weights: dict[str, float]) -> tuple[int, int]:
        """First and one past the last token of the best contiguous region; (0, 0) if none is positive."""
        best, best_at, total, start = 0.0, (0, 0), 0.0, 0
        for i, (kind, key) in enumerate(zip(self.kind, self.key)):
            if self.junk[i]:
                continue  # left out in any case: it neither joins nor parts what is around it
            if kind == "t":
                weight = weights.get(key, UNSEEN_WORD)
                total += weight * (DOUBT if self.doubt[i] and weight > 0 else 1) * len(self.value[i].split())
            elif key:
                total += weights.get(key, UNSEEN_TAG)
            if total <= 0:
                total, start = 0.0, i + 1
            elif total > best and kind == "t":
                best, best_at = total, (start, i + 1)
        return best_at

    def text(self, weights: dict[str, float]) -> str:
        first, last = self.region(weights)
        lines, line = [], []

        def flush():
            words = " ".join("".join(line).split())
            if words:
                lines.append(words)
            line.clear()

        for i in range(first, last):
            if self.kind[i] == "b":
                flush()
            elif not self.junk[i]:
                line.append(self.value[i])
        flush()
        return "\n".join(lines)


def weights_from(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Weights of contexts and tags from [inside, outside] counts over labelled pages."""
    out = {}
    for key, (inside, outside) in counts.items():
        if inside + outside < LEAST_SEEN:
            continue
        odds = math.log((inside + 1) / (outside + 1))
        if key[0] in "</":
            out[key] = -min(max(1 - odds, 0.05), 6.0)
        else:
            out[key] = min(max(odds, -3.0), 3.0)
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> dict[str, float]:
    """Weights from a bounded sample of the pages that mark their main part by one ``article``."""
    ship(pages.sparkSession)
    marked = pages.where(F.lower(html_col).contains("<article") & F.col(id_col).isNotNull())
    ids = marked.select(F.col(id_col).alias("i")).orderBy(F.xxhash64("i"), "i").limit(SAMPLE_PAGES).distinct()

    def run(batches):
        for batch in batches:
            for source in batch.column(0).to_pylist():
                page = Page(source)
                if page.articles == 1:
                    c = page.counts()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), pa.string()), pa.array([v[0] for v in c.values()], pa.int64()),
                         pa.array([v[1] for v in c.values()], pa.int64())], names=["key", "inside", "outside"])

    sample = marked.select(F.col(id_col).alias("i"), F.col(html_col).alias("h")).join(F.broadcast(ids), "i", "left_semi")
    counted = (sample.select("h").mapInArrow(run, "key string, inside long, outside long").groupBy("key")
               .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
               .where(F.col("inside") + F.col("outside") >= LEAST_SEEN)
               .orderBy(F.desc(F.col("inside") + F.col("outside")), "key").limit(MOST_CONTEXTS))
    return weights_from({r["key"]: (r["inside"], r["outside"]) for r in counted.collect()})


def main_text(pages: DataFrame, weights: dict[str, float], id_col: str = "page_id", html_col: str = "html",
              url_col: str = "url") -> DataFrame:
    """(id, url, text) for every page."""
    ship(pages.sparkSession)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, html_col):
                texts = [Page(h).text(weights) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 names=[id_col, url_col, "text"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return pages.select(id_col, url_col, html_col).mapInArrow(
        run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string")
