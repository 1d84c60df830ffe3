"""Normalisation and pre-tokenisation of the public word-level BPE files.

``Pretokenizer`` reads a ``tokenizers`` JSON file of the shape NFC / white space / lower case,
then a regular expression whose matches are the pre-tokens, then bytes written as characters.
Added tokens are found first, on the raw text.  Texts whose characters all lie in ranges that
every Unicode version treats alike go through ``regex`` (the fast path); all others through the
library's own normaliser and splitter, so both paths give the library's pre-tokens.
"""

from __future__ import annotations

import json
import re
import unicodedata

import regex
from tokenizers import Regex, Tokenizer, pre_tokenizers

#: Characters outside these long-settled ranges take the library's path.
_UNSETTLED = re.compile("[^\u0000-\u0377\u0391-\u03A1\u03A3-\u052F\u1E00-\u1EFF\u2000-\u2064\u20A0-\u20C0"
                        "\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3]")


#: Beyond this character the explicit classes of ``latin_pattern`` do not hold.
_BEYOND_LATIN = re.compile("[^\u0000-\u024F]")


def latin_pattern(pattern: str) -> str:
    """``pattern`` for ``re`` and texts up to U+024F: its Unicode classes as explicit ranges,
    which scan twice as fast."""
    def ranges(inside) -> str:
        out, first = [], None
        for c in range(0x251):
            if c < 0x250 and inside(chr(c)):
                first = c if first is None else first
            elif first is not None:
                out.append(f"\\u{first:04x}-\\u{c - 1:04x}")
                first = None
        return "".join(out)

    for name, inside in ((r"\p{L}", lambda c: unicodedata.category(c)[0] == "L"),
                         (r"\p{N}", lambda c: unicodedata.category(c)[0] == "N"),
                         (r"\s", lambda c: c.isspace() and not "\x1c" <= c <= "\x1f")):
        pattern = pattern.replace(name, ranges(inside))
    if "\\p" in pattern:
        raise ValueError(f"a class that is not known here: {pattern}")
    return pattern


def read_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class Pretokenizer:
    def __init__(self, path: str, spec: dict | None = None):
        if spec is None:
            spec = read_spec(path)
        steps = spec["pre_tokenizer"].get("pretokenizers", [])
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"] \
                or not steps[0]["invert"] or steps[0]["behavior"] != "Removed" or steps[1]["use_regex"]:
            raise ValueError(f"{path}: not a word-level BPE file of the supported shape")
        self._path, self._pattern = path, steps[0]["pattern"]["Regex"]
        self._find = regex.compile(self._pattern).findall
        self._find_latin = re.compile(latin_pattern(self._pattern)).findall
        self._library = None
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.largest_id = max([*spec["model"]["vocab"].values(), *self.added.values()])
        self._added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") \
            if self.added else None

    def library_words(self, text: str) -> list[str]:
        """Pre-tokens by the library's own normaliser and splitter (loaded when first needed)."""
        if self._library is None:
            self._library = (Tokenizer.from_file(self._path).normalizer.normalize_str,
                             pre_tokenizers.Split(Regex(self._pattern), "removed", invert=True).pre_tokenize_str)
        normalize, split = self._library
        return [w for w, _ in split(normalize(text))]

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text without added tokens."""
        if text.isascii():
            return self._find_latin(text.lower())
        if _UNSETTLED.search(text):
            return self.library_words(text)
        # str.lower() looks at the word around a capital sigma; the library does not
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return (self._find if _BEYOND_LATIN.search(text) else self._find_latin)(text)

    def parts(self, text: str):
        """``(added token id, None)`` or ``(None, words)``, in order."""
        if self._added is None or not self._added.search(text):
            yield None, self.words(text)
            return
        for piece in self._added.split(text):
            if piece in self.added:
                yield self.added[piece], None
            elif piece:
                yield None, self.words(piece)
