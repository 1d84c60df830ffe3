"""Operator 8 - personal data replaced by keyed surrogates.

Every detected entity (e-mail, IPv4, payment card, phone, social security number, IBAN, access
key, assigned secret, titled person name) is replaced by a surrogate of its own type and format:
same separators, digits for digits, letters for letters of the same case, valid check digits
(cards, IBAN) and octets (IP); names keep script and the gender their title tells.  The
surrogate is a keyed function (HMAC) of the type and the entity's canonical value, so every
mention of an entity in any document gets the same one (coreference) on any partition.

Names are keyed word by word and without the title, so surnames agree.  Within a document all
mentions of a titled name's words are replaced, also without a title or shortened; a word that
the document also has in lower case only where it cannot be the first of a sentence.  A given
name's ending tells the gender that any mention in the document tells; across documents only
the ending may differ (where one has no title with a gender; after a collision of one form
also the rest).  A Cyrillic or Greek surname's
ending follows its own form, a Latin surname has no gender.  Names in capitals only, inflected
forms and names that no title in the document introduces are not found.

Two entities might get equal surrogates, or a surrogate might be another document's real value.
All distinct entities of the corpus are therefore checked; the entities in collision get a
further attempt until none collides, and only those few exceptions are joined back to the
documents that hold them (broadcast if their written size allows, else by a shuffle).  After some
attempts surrogates grow (names by a syllable, others by a digit or letter), so that any number of
entities settles; IP addresses cannot grow: of those at most half the address space may be real.

Cases: null text stays null; texts without entities are returned unchanged; repeated rows get
equal texts; null doc_ids keep their row; other columns are kept, ``n_entities`` and
``entity_types`` of the input are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import hmac
import itertools
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.llm.common import byte_slices, cut, ship, stored

#: Attempts after which a surrogate is one syllable, for other types one character, longer.
GROW_NAMES, GROW_OTHERS = 4, 16
IP_ADDRESSES = 254 ** 4

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_UPPER, _LOWER = "A-ZÀ-ÖØ-ÞŒŠŽА-ЯЁΑ-Ω", "a-zß-öø-ÿœšžа-яёά-ώ"
_NAME = rf"(?:(?:[{_UPPER}][{_LOWER}'’-]{{1,40}}){{1,4}})"  # also McDonald, O'Brien, Meyer-Landrut
#: Titles that tell a gender; None tells none.
TITLES = {"Mr.": "m", "Mister": "m", "Mrs.": "f", "Ms.": "f", "Miss": "f", "Herr": "m", "Herrn": "m", "Frau": "f",
          "Monsieur": "m", "Madame": "f", "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f", "Señorita": "f",
          "Sr.": "m", "Sra.": "f", "Dr.": None, "Prof.": None, "господин": "m", "госпожа": "f", "Κύριος": "m", "Κυρία": "f"}
_TITLES = "|".join(map(re.escape, TITLES))
#: type, pattern (the entity is group 1), what must be in a text for the pattern to be tried.
PATTERNS = [
    ("secret", r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?((?=[+/_.~-]*(?-i:[A-Za-z0-9]))[A-Za-z0-9+/_.~-]{6,})", "=:"),
    ("access_key", r"\b((?:AKIA|ASIA)[0-9A-Z]{16})\b", "IA"),
    ("email", r"(?<![\w.+%-])([A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})(?![\w-])", "@"),
    ("ip", rf"(?<![\w.])({_OCTET}(?:\.{_OCTET}){{3}})(?!\.?\w)", "."),
    ("iban", r"\b([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b", ""),
    ("card", r"(?<![\w.-])(\d(?:[ -]?\d){12,18})(?![\w-])", ""),
    ("ssn", r"(?<![\w-])(\d{3}-\d{2}-\d{4})(?![\w-])", "-"),
    ("phone", r"(?<![\w.+])(\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])", ""),
    ("name", rf"\b(?:{_TITLES})(?:\s(?:{_TITLES}))*\s((?!(?:{_TITLES})\s){_NAME}(?: (?!(?:{_TITLES})\s){_NAME}){{0,2}})", None),
]
_COMPILED = [(kind, re.compile(p), need) for kind, p, need in PATTERNS]
_DIGIT = re.compile(r"\d")
_TITLE = re.compile(_TITLES)
_TITLE_BEFORE = re.compile(rf"({_TITLES})(?=\s)")
_POSSESSIVE = re.compile(r"['’-]+s?(?= |$)")
_WORD = re.compile(rf"(?<!\w){_NAME}")
_PART = re.compile("[^'’-]+")
_SMALL_WORD = re.compile(rf"(?<!\w)[{_LOWER}]{{2,}}(?!\w)")
_MID_SENTENCE = re.compile(rf"[{_LOWER},;]\s")


@dataclass(frozen=True)
class Entity:
    start: int
    end: int
    kind: str  # type, for names with gender: name, name-m, name-f
    value: str
    #: (kind, word) of each word of a name
    words: tuple[tuple[str, str], ...] = ()

    @property
    def units(self) -> tuple[tuple[str, str], ...]:
        """What gets surrogates of its own: (kind, canonical) of the entity or of a name's words."""
        return self.words or ((self.kind, self.canonical),)

    @property
    def canonical(self) -> str:
        """What all mentions of the entity have in common."""
        if self.kind == "email":
            return self.value.lower()
        if self.kind in ("card", "phone", "ssn"):
            return re.sub(r"\D", "", self.value)
        if self.kind == "iban":
            return self.value.replace(" ", "")
        return self.value


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def detect(text: str | None) -> list[Entity]:
    """Entities of a whole text in order; where two overlap the earlier pattern's stays."""
    if not text:
        return []
    digits, title = _DIGIT.search(text) is not None, _TITLE.search(text) is not None
    if not digits and not title and "=" not in text and ":" not in text and "@" not in text:
        return []
    found: list[Entity] = []
    for kind, pattern, need in _COMPILED:
        if need is None:
            if not title:
                continue
        elif kind in ("ip", "iban", "card", "ssn", "phone"):
            if not digits or need and need not in text:
                continue
        elif not any(c in text for c in need):
            continue
        for m in pattern.finditer(text):
            start, end = m.span(1)
            value, own = m[1], kind
            if any(e.start < end and start < e.end for e in found):
                continue
            if kind == "card" and not luhn_ok(re.sub(r"\D", "", value)):
                continue
            if kind == "iban":
                plain = value.replace(" ", "")
                if not 15 <= len(plain) <= 34 or iban_check(plain[:2], plain[4:]) != plain[2:4]:
                    continue
            if kind == "name":
                value = _POSSESSIVE.split(value, maxsplit=1)[0]
                end = start + len(value)
                own = _name_kind(next((g for t in _TITLE_BEFORE.findall(text[m.start():start]) if (g := TITLES[t])), None))
            found.append(Entity(start, end, own, value))
    found.sort(key=lambda e: e.start)
    return _linked(text, found) if title else found


def _name_kind(gender: str | None) -> str:
    return f"name-{gender}" if gender else "name"


def _surname_gender(word: str) -> str | None:
    """The gender that the form of a surname tells."""
    last = word[-1].lower()
    if script(word) == "cyrillic":
        return "f" if last in "ая" else None if last in "еёиоуыэю" else "m"
    if script(word) == "greek":
        return "m" if last in "ςσ" else "f"
    return None


def _linked(text: str, found: list[Entity]) -> list[Entity]:
    """``found`` with the words of its names and with the mentions of these words elsewhere."""
    titled = [e for e in found if e.kind.startswith("name")]
    if not titled:
        return found
    given: dict[str, set[str]] = {}  # given names and the genders told of them
    persons: dict[str, set[str]] = {}  # kinds of the titled mentions that hold a word
    for e in titled:
        words = e.value.split(" ")
        for w in words:
            persons.setdefault(w, set()).add(e.kind)
        for w in words[:-1]:
            given.setdefault(w, set()).update(e.kind[5:])
    for e in titled:  # a title before a given name alone
        if e.value in given:
            given[e.value].update(e.kind[5:])

    def unit(word: str, own: str) -> tuple[str, str]:
        told = given.get(word)
        if told is None:
            return _name_kind(_surname_gender(word)), word
        return _name_kind(own[5:] or min(told, default=None)), word

    def with_words(e: Entity) -> Entity:
        return Entity(e.start, e.end, e.kind, e.value, tuple(unit(w, e.kind) for w in e.value.split(" ")))

    small = set(_SMALL_WORD.findall(text))
    out = [with_words(e) if e.kind.startswith("name") else e for e in found]
    mentions: list[tuple[int, int]] = []
    k = 0
    for m in _WORD.finditer(text):
        whole = _POSSESSIVE.split(m[0], maxsplit=1)[0]
        parts = [(m.start(), whole)] if whole in persons else [(m.start() + p.start(), p[0]) for p in _PART.finditer(m[0])]
        for start, word in parts:
            end = start + len(word)
            while k < len(found) and found[k].end <= start:
                k += 1
            if word not in persons or len(word) < 2 or text[end:end + 1].isalnum() or k < len(found) and found[k].start < end:
                continue
            if mentions and mentions[-1][1] + 1 == start and text[start - 1] == " ":
                mentions[-1] = (mentions[-1][0], end)
            elif word.lower() not in small or _MID_SENTENCE.fullmatch(text[max(0, start - 2):start]):
                mentions.append((start, end))
    for start, end in mentions:
        kinds = set.intersection(*(persons[w] for w in text[start:end].split(" "))) or persons[text[start:end].split(" ")[0]]
        out.append(with_words(Entity(start, end, next(iter(kinds)) if len(kinds) == 1 else "name", text[start:end])))
    return sorted(out, key=lambda e: e.start)


class Stream:
    """Numbers from HMAC-SHA256 blocks of a key and a label."""

    def __init__(self, key: bytes, *label: object):
        self._key, self._label, self._n, self._block = key, "\x1f".join(map(str, label)).encode(), 0, b""

    def below(self, n: int) -> int:
        while len(self._block) < 4:
            self._block += hmac.new(self._key, self._label + self._n.to_bytes(4, "big"), hashlib.sha256).digest()
            self._n += 1
        word, self._block = self._block[:4], self._block[4:]
        return int.from_bytes(word, "big") % n


#: Syllables names are made from, by script, and the endings that mark the gender.
_SYLLABLES = {"latin": "ba be da do fa ga ka la li lo ma mi mo na ne no ra re ri ro sa se ta te ti to va vi zo".split(),
              "cyrillic": "ба бо да до ка ла ли ло ма ми мо на не но ра ре ри ро са се та те ти то ва ви зо".split(),
              "greek": "βα βο δα δο κα λα λι λο μα μι μο να νε νο ρα ρε ρι ρο σα σε τα τε τι το ζο".split()}
_ENDINGS = {"latin": {"m": "n", "f": "na", None: "l"}, "cyrillic": {"m": "н", "f": "на", None: "ль"},
            "greek": {"m": "ς", "f": "να", None: "λ"}}


def script(value: str) -> str:
    c = next((c for c in value if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def _like(value: str, draw: Stream) -> str:
    """Digits for digits, letters for letters of the same case; hexadecimal stays hexadecimal."""
    hexadecimal = re.fullmatch("[0-9a-f]+|[0-9A-F]+", value) is not None and len(value) >= 8 and not value.isdigit()
    out = []
    for c in value:
        if hexadecimal:
            d = "0123456789abcdef"[draw.below(16)]
            out.append(d.upper() if value.upper() == value else d)
        elif c.isdigit():
            out.append(str(draw.below(10)))
        elif "a" <= c <= "z":
            out.append(chr(97 + draw.below(26)))
        elif "A" <= c <= "Z":
            out.append(chr(65 + draw.below(26)))
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, canonical: str, attempt: int, key: bytes) -> str:
    """The surrogate's canonical form; never the value itself.  Names come word by word; their
    kind's gender decides on the ending only."""
    label = "name" if kind.startswith("name") else kind
    for again in itertools.count():  # ends: what cannot change grows
        more = (attempt + again) // (GROW_NAMES if kind.startswith("name") else GROW_OTHERS)
        out = _surrogate(kind, canonical, Stream(key, label, canonical, attempt, again), more)
        if out != canonical:
            return out


def _surrogate(kind: str, value: str, draw: Stream, more: int) -> str:
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        return f"{_like(local + 'x' * more, draw)}@{'.'.join([_like(x, draw) for x in labels[:-1]] + labels[-1:])}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "access_key":
        return value[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[draw.below(32)] for _ in value[4:])
    if kind == "card":
        body = value[0] + "".join(str(draw.below(10)) for _ in value[2:] + "0" * more)
        return next(body + d for d in "0123456789" if luhn_ok(body + d))
    if kind == "iban":
        rest = _like(value[4:] + "0" * more, draw)
        return value[:2] + iban_check(value[:2], rest) + rest
    if kind == "phone":
        keep = 1 if len(value) > 10 else 0
        return value[:keep] + "".join(str(draw.below(10)) for _ in value[keep:] + "0" * more)
    if kind.startswith("name"):
        s = script(value)
        word = "".join(_SYLLABLES[s][draw.below(len(_SYLLABLES[s]))] for _ in range(3 + more))
        return (word + _ENDINGS[s][kind[5:] or None]).capitalize()
    return _like(value + ("0" if kind == "ssn" else "x") * more, draw)


def shaped(entity: Entity, canonical: str) -> str:
    """A surrogate in the form of this mention: its separators, its letter case."""
    if entity.kind in ("card", "phone", "ssn", "iban"):
        rest = iter(canonical)
        return "".join([next(rest) if c.isalnum() else c for c in entity.value] + list(rest))
    if entity.kind == "email":
        more = len(canonical) - len(entity.value)  # a grown surrogate has them before its @
        like = entity.value.replace("@", "x" * more + "@")
        return "".join(n.upper() if o.isupper() else n for o, n in zip(like, canonical))
    return canonical


def rewrite(text: str | None, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str | None, list[Entity]]:
    found = detect(text)
    if not found:
        return text, found
    out, at = [], 0
    for e in found:
        new = " ".join(surrogate(k, v, attempts.get((k, v), 0), key) for k, v in e.units)
        out += [text[at:e.start], shaped(e, new)]
        at = e.end
    return "".join([*out, text[at:]]), found


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kind, canonical), each entity (names: each word) once for a document."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, text_col):
                rows, kinds, values = [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    for kind, value in sorted({u for e in detect(text) for u in e.units}):
                        rows.append(i)
                        kinds.append(kind)
                        values.append(value)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), pa.array(kinds, pa.string()),
                                                  pa.array(values, pa.string())], names=[id_col, "kind", "canonical"])

    t = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {t}, kind string, canonical string")


def assign(distinct: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, attempt, surrogate) without collisions: within a type no two entities
    share a surrogate and no surrogate is a real entity."""
    spark = distinct.sparkSession
    ship(spark)

    def run(batches):
        for batch in batches:
            kinds, values, attempts = (batch.column(i).to_pylist() for i in range(3))
            made = [surrogate(k, v, a, key) for k, v, a in zip(kinds, values, attempts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())],
                                             names=["kind", "canonical", "attempt", "surrogate"])

    schema = "kind string, canonical string, attempt int, surrogate string"
    # names of any gender are one type when it comes to collisions
    family = F.substring_index("kind", "-", 1)
    real = distinct.select(family.alias("rf"), F.col("canonical").alias("rc")).distinct()
    settled = cut(distinct.select("kind", "canonical", F.lit(0).alias("attempt")).mapInArrow(run, schema))
    for attempt in itertools.count(1):
        marked = settled.withColumn("family", family)
        first = marked.groupBy("family", "surrogate").agg(F.min(F.struct("attempt", "kind", "canonical")).alias("keep"))
        marked = marked.join(first, ["family", "surrogate"]).join(
            real, (F.col("family") == F.col("rf")) & (F.col("surrogate") == F.col("rc")), "left")
        fine = F.col("rc").isNull() & (F.col("keep.kind") == F.col("kind")) & (F.col("keep.canonical") == F.col("canonical"))
        marked = cut(marked.select("kind", "canonical", "attempt", "surrogate", fine.alias("fine")))
        if marked.where("not fine").isEmpty():
            return settled
        if attempt == GROW_OTHERS and 2 * real.where("rf = 'ip'").count() > IP_ADDRESSES:
            raise RuntimeError("more than half of all IP addresses are real ones: there are too few surrogates")
        again = marked.where("not fine").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        settled = cut(marked.where("fine").drop("fine").unionByName(again.mapInArrow(run, schema)))


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in its text, plus ``n_entities`` and ``entity_types``."""
    docs = docs.drop("n_entities", "entity_types")
    pairs = cut(entities(docs, id_col, text_col))
    table = assign(pairs.select("kind", "canonical").distinct(), key)
    exceptions = table.where("attempt > 0").select("kind", "canonical", "attempt")
    held = (pairs.join(exceptions, ["kind", "canonical"]).groupBy(F.col(id_col).alias("__id"))
            .agg(F.collect_set(F.struct("kind", "canonical", "attempt")).alias("__attempts")))
    held = stored(held, "pii-exceptions")
    columns = docs.columns
    joined = docs.join(held, docs[id_col].eqNullSafe(held["__id"]), "left").select(*[docs[c] for c in columns], "__attempts")
    at = columns.index(text_col)
    out = T.StructType([*docs.schema.fields, T.StructField("n_entities", T.LongType()), T.StructField("entity_types", T.StringType())])

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, text_col):
                texts, n, kinds = [], [], []
                for text, attempts in zip(part.column(at).to_pylist(), part.column(len(columns)).to_pylist()):
                    new, found = rewrite(text, key, {(a["kind"], a["canonical"]): a["attempt"] for a in attempts or ()})
                    texts.append(new)
                    n.append(len(found))
                    kinds.append(",".join(sorted({e.kind for e in found})))
                own = [pa.array(texts, pa.string()) if i == at else part.column(i) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(n, pa.int64()), pa.array(kinds, pa.string())], names=out.names)

    return joined.mapInArrow(run, out)


def session_key(spark: SparkSession) -> bytes:
    """The secret of a deployment from ``spark.fleetscope.surrogate.key``; a fixed one in tests."""
    return spark.conf.get("spark.fleetscope.surrogate.key", "fleetscope-test-key").encode()
