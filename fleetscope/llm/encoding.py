"""Token ids by the ``tokenizers`` library, with one library call for each distinct word.

BPE never merges across pre-tokens, so a text's ids are its words' ids in order.  The library's
BPE model encodes a word the first time a Python worker meets it; the worker keeps the ids of
a bounded number of words, so memory stays bounded for any vocabulary.
"""

from __future__ import annotations

from array import array

from tokenizers import Tokenizer

from fleetscope.llm.pretokens import Pretokenizer

CACHE_ENTRIES = 200_000
#: Longer words are encoded but not kept.
CACHE_CHARS = 64

_ENCODERS: dict[tuple[str, int], "Encoder"] = {}


class Cache(dict):
    """word -> little-endian unsigned 32-bit ids, made by ``encode`` on a miss.

    Two generations: when the young one is full it becomes the old one, and what is asked for
    again moves back, so frequent words stay and the rest is forgotten."""

    def __init__(self, encode, most: int = CACHE_ENTRIES):
        super().__init__()
        self._encode, self._most, self._old = encode, most, {}

    def put(self, word: str, ids: bytes) -> None:
        if len(self) >= self._most:
            self._old = dict(self)
            self.clear()
        self[word] = ids

    def rest(self) -> None:
        """At a task's end: keep the young generation for the worker's next task only."""
        self._old = {}

    def knows(self, word: str) -> bool:
        return word in self or word in self._old

    def __missing__(self, word: str) -> bytes:
        ids = self._old.get(word)
        if ids is None:
            ids = self._encode(word)
            if len(word) > CACHE_CHARS:
                return ids
        self.put(word, ids)
        return ids


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes a byte: printable Latin-1 signs stand
    for themselves, the others for U+0100 and on in their order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(0x100 + i) for i, b in enumerate(others)}


class Encoder:
    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        self.pre = Pretokenizer(path)
        model, letters = Tokenizer.from_file(path).model, byte_letters()

        def encode(word: str) -> bytes:
            """The library's model on one word as bytes written in letters: no Encoding is built."""
            if not (word.isascii() and word.isprintable()):  # else every byte is its own letter
                word = word.encode().decode("latin-1").translate(letters)
            return array("I", [t.id for t in model.tokenize(word)]).tobytes()

        self.cache = Cache(encode, entries)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; null counts as empty."""
        if not text:
            return b""
        get = self.cache.__getitem__
        return b"".join(token.to_bytes(4, "little") if words is None else b"".join(map(get, words))
                        for token, words in self.pre.parts(text))


def encoder(path: str, entries: int = CACHE_ENTRIES) -> Encoder:
    """The worker's encoder for a tokenizer file, with ``entries`` words in a cache generation."""
    if (path, entries) not in _ENCODERS:
        _ENCODERS[path, entries] = Encoder(path, entries)
    return _ENCODERS[path, entries]
