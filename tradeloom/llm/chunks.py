"""Cutting text at single spaces, where a byte-level BPE never joins what stands on both sides.

A space between two characters that are no white space always begins a pre-token of the byte-level
pattern. Tokens of a text are therefore those of its chunks one after another, and a chunk that was
seen before need not be tokenized again.
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

_SAFE = re.compile(r" (?<=\S )(?=\S)")
#: The byte-level pattern that splits text before the merges (fixed value of the public vocabulary).
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Pre-tokens that a counting worker remembers, the first it meets; longer ones are not remembered.
REMEMBERED = 120_000
#: Chunks that an encoding worker remembers unless told otherwise, and a third as many pre-tokens.
#: Half of them are remembered when they are first met, the others when they are met again.
ENCODED = 250_000
#: Places of the marks of what was met once (a power of two); of two that share a place, one passes for met before.
PLACES = 1 << 22
#: Letters below this one are white space, letters, digits or marks by every version of the pattern's tables.
SETTLED = "\u0250"
LONG = 48
#: Marks that make one pre-token behind a word, as many as there are.
MARKS = ".,;:!?"
#: Texts whose chunks are looked up together, and characters at most unless one text has more.
TOGETHER, CHARACTERS = 3000, 10_000_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one past 255."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def cut(text: str) -> list[str]:
    """Chunks of a text; all but the first had a space before them. Spaces beside white space are no cuts."""
    return _SAFE.split(text)


def ragged(chunk: str) -> bool:
    """Whether a piece between two spaces shows that one of them is no cut."""
    return not chunk or chunk[0].isspace() or chunk[-1].isspace()


def pieces(text: str, wrong: set[str]) -> tuple[str, list[str]]:
    """The first chunk and those after a space. ``wrong``: pieces that show that a space is no cut."""
    first, *rest = text.split(" ")
    if rest and ((first and first[-1].isspace()) or (wrong and not wrong.isdisjoint(rest))):
        first, *rest = cut(text)
    return first, rest


def distinct(texts: list[str]) -> tuple[set[str], set[str]]:
    """The different chunks after a space, and those of them that begin or end in white space or are empty."""
    after: set[str] = set()
    for text in texts:
        after.update(text.split(" ")[1:])
    wrong, again = {c for c in after if ragged(c)}, set()
    for text in texts:
        first, *rest = text.split(" ", 1)
        if rest and ((first and first[-1].isspace()) or (wrong and not wrong.isdisjoint(text.split(" ")[1:]))):
            again.update(cut(text)[1:])
    return after | again if again else after, wrong | {c for c in again if ragged(c)}


def split_chunks(chunks: list[str]) -> list[list[str]]:
    """Pre-tokens of each chunk with its space. Chunks with white space at an end must not come here.

    A line separator before each chunk comes out of the pattern alone and shows where the chunk begins.
    """
    joined = "".join([f"\u2028 {c}" for c in chunks]) + "\u2028"
    if joined.count("\u2028") > len(chunks) + 1:
        return [PATTERN.findall(" " + c) for c in chunks]
    parts = PATTERN.findall(joined)
    marks = [i for i, p in enumerate(parts) if p == "\u2028"]
    return [parts[a + 1: b] for a, b in zip(marks, marks[1:], strict=False)]


@contextmanager
def no_collector() -> Iterator[None]:
    """Without Python's cycle collector, which would walk all the chunks again and again; none of them make cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def groups_of(texts: Iterable[str], together: int = TOGETHER, characters: int = CHARACTERS) -> Iterator[list[str]]:
    """Texts by the ``together``, fewer where they have more than so many characters."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if len(group) == together or size > characters:
            yield group
            group, size = [], 0
    if group:
        yield group


class Encoder:
    """Ids of texts by the tokenizers library, as its ``encode(text, add_special_tokens=False)`` gives them.

    Chunks not met before are split into pre-tokens, which go through the library's model; chunks and
    pre-tokens that come again are remembered for all later texts, ``most`` chunks. A tokenizer that is no
    plain byte-level BPE encodes whole texts.
    """

    def __init__(self, path: str, most: int | None = None):
        from tokenizers import Tokenizer

        most = most or ENCODED
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        said = json.loads(self.tokenizer.to_str())
        pre = said["pre_tokenizer"] or {}
        self.special = [t["content"] for t in said["added_tokens"]]
        self.cuts = (
            said["normalizer"] is None and said["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel"
            and pre.get("use_regex") and not pre.get("add_prefix_space") and said["model"].get("dropout") is None
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]
                        for t in said["added_tokens"]))
        self.letters = {b: c for b, c in enumerate(byte_letters()) if chr(b) != c}
        self.parts = Remembered(self._part, max(1, most // 3))
        self.chunks = Remembered(self._chunk, most)
        #: No special token is made of ASCII letters and marks alone.
        self.plain = not any(t.isascii() and all(c.isalpha() or c in MARKS for c in t) for t in self.special)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _made(self, letters: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _part(self, part: str) -> bytes:
        """Ids of a pre-token."""
        return self._made(part.encode().decode("latin-1").translate(self.letters))

    def _parts(self, text: str) -> bytes:
        """Ids of a first chunk, or of a later one with its space."""
        for special in self.special:
            if special in text:
                return self.whole(text)
        return b"".join(map(self.parts.__getitem__, PATTERN.findall(text)))

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk after a space: most are one word with marks behind it at most, two pre-tokens."""
        word = chunk.rstrip(MARKS)
        if word.isalpha() and self.plain and (word.isascii() or max(word) < SETTLED):
            if word == chunk:
                return self._part(" " + word) if not word.isascii() else self._made("\u0120" + word)
            return self.chunks[word] + self.parts[chunk[len(word):]]
        if ragged(chunk):
            raise NoCut
        return self._parts(" " + chunk)

    @no_collector()
    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.cuts:
            return [self.whole(t) for t in texts]
        return [self._text(t) for t in texts]

    @no_collector()
    def stream(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of a column's texts (null: empty) one after another, ``end`` behind each, and how many each has.

        They are those of :meth:`encode`; texts are cut and put together by Arrow, a chunk is looked up once for all.
        """
        if not self.cuts:
            made = [self.whole(t) + end for t in texts_of(texts)]
            return np.frombuffer(b"".join(made), dtype="<u4"), np.array([len(x) // 4 for x in made], dtype=np.int64)
        split = pc.split_pattern(pc.fill_null(texts, ""), " ")
        n, begins, chunks = len(split), split.offsets.to_numpy(), split.values
        later = np.ones(len(chunks), dtype=bool)
        later[begins[:-1]] = False
        own = chunks.filter(pa.array(later)).dictionary_encode()
        firsts = chunks.take(pa.array(begins[:-1])).to_pylist()
        distinct = own.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist
        ids, wrong = list(map(self.chunks.get, distinct)), []
        for i in [i for i, x in enumerate(ids) if x is None]:
            try:
                ids[i] = self.chunks[distinct[i]]
            except NoCut:
                wrong.append(i)
                ids[i] = b""
        number, known = own.indices.to_numpy(), len(ids)
        uncut = {i for i, first in enumerate(firsts) if first and first[-1].isspace() and begins[i + 1] > begins[i] + 1}
        if wrong:
            where = np.flatnonzero(later)[np.isin(number, wrong)]
            uncut.update((np.searchsorted(begins, where, side="right") - 1).tolist())
        # After the chunks' ids come those of each text's beginning, the end and nothing.
        ids += [b"" if i in uncut else self._parts(first) for i, first in enumerate(firsts)]
        ids += [end, b""]
        bounds = begins.astype(np.int64) + np.arange(n + 1)
        which = np.empty(len(chunks) + n, dtype=np.int64)
        which[np.flatnonzero(later) + np.repeat(np.arange(n), np.diff(begins) - 1)] = number
        which[bounds[:-1]] = known + np.arange(n)
        which[bounds[1:] - 1] = known + n
        for i in uncut:
            ids[known + i] = self._cut(texts[i].as_py())
            which[bounds[i] + 1: bounds[i + 1] - 1] = known + n + 1
        found = pa.array(ids, pa.large_binary()).take(pa.array(which))
        upto = np.frombuffer(found.buffers()[1], dtype=np.int64)[: len(which) + 1][bounds]
        raw = found.buffers()[2]
        stream = np.frombuffer(raw, dtype="<u4", count=int(upto[-1]) // 4) if upto[-1] else np.zeros(0, dtype="<u4")
        return stream, np.diff(upto) // 4

    def _text(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if rest and first and first[-1].isspace():
            return self._cut(text)
        try:
            return self._parts(first) + b"".join(map(self.chunks.__getitem__, rest))
        except NoCut:
            return self._cut(text)

    def _cut(self, text: str) -> bytes:
        """The ids of a text with spaces beside white space."""
        first, *rest = cut(text)
        return self._parts(first) + b"".join(
            [self.whole(" " + c) if ragged(c) else self.chunks[c] for c in rest])


class NoCut(Exception):
    """A space that is no cut."""


class Remembered(dict):
    """Ids of chunks or pre-tokens; those not known are worked out, and up to ``most`` are kept."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most, self.at_once = make, most, -(-most // 2)
        self.met = bytearray(PLACES)

    def __missing__(self, key: str) -> bytes:
        ids, known = self.make(key), len(self)
        if known < self.most and len(key) <= LONG:
            place = hash(key) & (PLACES - 1)
            if known < self.at_once or self.met[place]:
                self[key] = ids
            else:
                self.met[place] = 1
        return ids


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, most: int = ENCODED) -> Encoder:
    """The worker's encoder for a tokenizer file; it lives as long as the worker, or until :func:`forget`."""
    if (path, most) not in _ENCODERS:
        forget()
        _ENCODERS[path, most] = Encoder(path, most)
    return _ENCODERS[path, most]


def forget() -> None:
    """Lets go of this worker's encoders: a worker outlives its stage, and other work needs the memory."""
    _ENCODERS.clear()


def texts_of(column) -> Iterator[str]:
    """An Arrow column's texts one by one; null is empty."""
    for at in range(0, len(column), 500):
        for value in column.slice(at, 500).to_pylist():
            yield value or ""
