"""Fill-in-the-middle: each text cut at two line boundaries into prefix, middle and suffix, then reordered.

A text is a sequence of lines, ``[^\\n]*\\n|[^\\n]+`` matched left to right over code points. Its
characters are coded by class (line feed, other white space, ASCII letter or digit, anything
else) and held in a wavelet matrix: one bit vector per bit of the class code, each level a
stable partition of the one above, with running sums of its ones. ``rank(c, i)``, the number of
class ``c`` among the first ``i`` characters, walks the levels in constant time a level; the
number of lines is the rank of line feeds at the end plus an unterminated last line; the place
after ``k`` lines is found by bisection on ranks (``select``). Texts are cut in tasks, one at a
time, so no text is held twice and a text of any length is cut whole.

The cuts come from the digest of ``"7:" + doc_id`` (decimal; a null doc_id is hashed as ``"7:"``).
Rows are handled one by one: null texts are empty (and plain), repeated rows and ties give equal
results, an empty table gives an empty result, and other columns, whatever their names, are not
read: the result has ``doc_id`` and the columns below only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.chunks import texts_of

# Fixed values of the format: the three markers and the seed of the cut digest.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7

NEWLINE, SPACE, WORD, OTHER = 0, 1, 2, 3
LEVELS = 2
_ASCII = np.full(128, OTHER, dtype=np.uint8)
_ASCII[[9, 11, 12, 13, 32]] = SPACE
_ASCII[10] = NEWLINE
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    _ASCII[_lo:_hi] = WORD


class WaveletMatrix:
    """Rank and select over the character classes of one text."""

    def __init__(self, codes: np.ndarray):
        self.size = len(codes)
        self.zeros: list[int] = []
        self.ones: list[np.ndarray] = []
        for level in range(LEVELS):
            bits = (codes >> (LEVELS - 1 - level)) & 1
            ones = np.zeros(self.size + 1, dtype=np.int64)
            np.cumsum(bits, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(self.size - int(ones[-1]))
            codes = np.concatenate([codes[bits == 0], codes[bits == 1]])

    def rank(self, symbol: int, end: int) -> int:
        """Occurrences of ``symbol`` among the first ``end`` characters."""
        lo, hi = 0, end
        for level in range(LEVELS):
            ones = self.ones[level]
            if (symbol >> (LEVELS - 1 - level)) & 1:
                lo, hi = self.zeros[level] + int(ones[lo]), self.zeros[level] + int(ones[hi])
            else:
                lo, hi = lo - int(ones[lo]), hi - int(ones[hi])
        return hi - lo

    def select(self, symbol: int, k: int) -> int:
        """Place of the ``k``-th occurrence (from 1) of ``symbol``: the smallest end whose rank is ``k``, less one."""
        lo, hi = 1, self.size
        while lo < hi:
            mid = (lo + hi) // 2
            if self.rank(symbol, mid) >= k:
                hi = mid
            else:
                lo = mid + 1
        return lo - 1


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(points < 128, _ASCII[np.minimum(points, 127)], OTHER).astype(np.uint8)


def lines_and_cut(text: str):
    """``(n, cut)``: the number of lines and a function from a number of lines to the place after them."""
    matrix = WaveletMatrix(classes(text))
    ended = matrix.rank(NEWLINE, matrix.size)
    n = ended + (1 if matrix.size and text[-1] != "\n" else 0)

    def cut(k: int) -> int:
        if k == 0:
            return 0
        return matrix.select(NEWLINE, k) + 1 if k <= ended else matrix.size

    return n, cut


def arrange(text: str, h: tuple[int, int, int, int], percent: int, spm_percent: int):
    """``(n, form, prefix_chars, middle_chars, output)`` of one text and its four hash numbers."""
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= percent:
        n = lines_and_cut(text)[0] if text else 0
        return n, "plain", None, None, text
    n, cut = lines_and_cut(text)
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = cut(first), cut(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text an output was made of."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    at = output.index(second, len(first))
    end = output.index(MIDDLE, at + len(second))
    one, two, middle = output[len(first):at], output[at + len(second):end], output[end + len(MIDDLE):]
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


def hash_numbers(doc_id: Column, seed: int = SEED) -> list[Column]:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:doc_id``, as unsigned numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"_h{i + 1}") for i in range(4)]


RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType()),
])


def fill_in_middle(docs: DataFrame, percent: int = 100, spm_percent: int = 50, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, n, form, prefix_chars, middle_chars, output`` (see the module's text).

    ``percent`` of the texts (by the third hash number) are transformed, ``spm_percent`` of those
    (by the fourth) in suffix-prefix-middle order, the rest prefix-suffix-middle.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"),
                       *hash_numbers(F.col("doc_id"), seed))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                hashes = list(zip(*(part.column(f"_h{i}").to_pylist() for i in range(1, 5))))
                made = [arrange(t, h, percent, spm_percent) for t, h in zip(texts_of(part.column("_text")), hashes)]
                columns = list(zip(*made)) if made else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, type=f.type) for c, f in zip(columns, list(RESULT_ARROW)[1:]))],
                    schema=RESULT_ARROW)

    return rows.mapInArrow(cut, RESULT)


RESULT_ARROW = pa.schema([
    pa.field("doc_id", pa.int64()), pa.field("n", pa.int64()), pa.field("form", pa.string()),
    pa.field("prefix_chars", pa.int64()), pa.field("middle_chars", pa.int64()), pa.field("output", pa.large_string()),
])


def restored(output: Column, form: Column) -> Column:
    """The text rebuilt from an output column and its form, with Spark's own string functions."""

    def find(mark: str, start) -> Column:
        return F.call_function("locate", F.lit(mark), output, start if isinstance(start, Column) else F.lit(start))

    def part(start: Column, length: Column | None = None) -> Column:
        return F.call_function("substring", output, start, *([] if length is None else [length]))

    def rebuilt(first: str, second: str, spm: bool) -> Column:
        at = find(second, len(first) + 1)
        end = find(MIDDLE, at + len(second))
        one = part(F.lit(len(first) + 1), at - len(first) - 1)
        two = part(at + len(second), end - at - len(second))
        middle = part(end + len(MIDDLE))
        return F.concat(two, middle, one) if spm else F.concat(one, middle, two)

    return (F.when(form == "psm", rebuilt(PREFIX, SUFFIX, False))
            .when(form == "spm", rebuilt(SUFFIX, PREFIX, True)).otherwise(output))
