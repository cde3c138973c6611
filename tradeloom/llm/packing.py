"""Best-fit packing of documents into sequences, after Martello and Toth's dominance reduction.

What has to be packed depends on lengths alone, of which there are no more than a sequence has
tokens. So the corpus is reduced to a count by length; the plan is made for whole classes of equal
lengths at once and its size depends on the sequence length, not on the number of documents.
Every piece then finds its place from its rank within its length. Ranks are counted within tasks
and added up per length, so a length that a third of all pieces share is no group of its own.

A document longer than a sequence is cut: the first piece takes what is over, the others fill
sequences alone. Null texts are the end id alone; repeated rows are packed as often as they occur;
null ids are packed like any other; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import keep
from tradeloom.llm.token_files import END_ID, encoded

CAPACITY = 2048
#: A kind of sequence: (length, how many of it) pairs; and how many such sequences.
Pattern = tuple[tuple[tuple[int, int], ...], int]


class _Stock:
    """Counts by length with the lengths that are left in order."""

    def __init__(self, counts: Mapping[int, int]):
        self.left = Counter({w: n for w, n in counts.items() if n > 0})
        self.sizes = sorted(self.left)

    def take(self, need: Counter) -> int:
        """Takes the set as often as it can be taken."""
        times = min(self.left[w] // n for w, n in need.items())
        for w, n in need.items():
            self.left[w] -= n * times
            if not self.left[w]:
                self.sizes.pop(bisect_left(self.sizes, w))
        return times

    def largest(self, most: int, without: Counter) -> int | None:
        """The largest length up to ``most`` of which more is left than ``without`` has."""
        i = bisect_right(self.sizes, most) - 1
        while i >= 0 and self.left[self.sizes[i]] <= without[self.sizes[i]]:
            i -= 1
        return self.sizes[i] if i >= 0 else None

    def smallest(self, number: int, without: Counter) -> list[int]:
        found: list[int] = []
        for w in self.sizes:
            found += [w] * min(number - len(found), self.left[w] - without[w])
            if len(found) == number:
                break
        return found


def _dominating(stock: _Stock, w: int, capacity: int) -> Counter | None:
    """A set with ``w`` and at most two more that dominates every other set with ``w``, if one can be shown."""
    own = Counter([w])
    room = capacity - w
    large = stock.largest(room, own)
    if large is None:
        return own
    least = stock.smallest(3, own)
    if large == room or len(least) < 2 or least[0] + least[1] > room:
        return own + Counter([large])  # nothing fits better, or only one more fits
    if len(least) == 3 and sum(least) <= room:
        return None
    # At most two more fit. Any pair's smaller part is at most `half`.
    i = bisect_right(stock.sizes, room // 2) - 1
    half = 0
    while i >= 0 and not half:
        y = stock.sizes[i]
        spare = stock.left[y] - own[y]
        if spare >= 2 or (spare == 1 and i + 1 < len(stock.sizes) and any(
                stock.left[x] > own[x] for x in stock.sizes[i + 1: i + 3] if x + y <= room)):
            half = y
        i -= 1
    best = stock.largest(room - large, own + Counter([large]))
    if best is not None and best >= half:
        return own + Counter([large, best])
    pairs = max((x + y for x in stock.sizes if (y := stock.largest(min(room - x, x), own + Counter([x]))) is not None
                 and stock.left[x] > own[x]), default=0)
    return own + Counter([large]) if large >= pairs else None


def reduce_instance(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[list[Pattern], dict[int, int]]:
    """Sets that some best packing contains, and what is left to pack.

    From the largest length down, a set that dominates all others with that length is fixed as often as
    the stock allows; this repeats until nothing more can be fixed.
    """
    stock, fixed, changed = _Stock(counts), [], True
    while changed:
        changed = False
        for w in sorted(stock.sizes, reverse=True):
            while stock.left[w] and (need := _dominating(stock, w, capacity)):
                fixed.append((tuple(sorted(need.items(), reverse=True)), stock.take(need)))
                changed = True
    return fixed, {w: n for w, n in stock.left.items() if n}


def best_fit(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Best-fit decreasing for whole classes: bins of the same content move together."""
    open_bins: dict[int, list[tuple[tuple, int]]] = {}
    rooms: list[int] = []

    def put(room: int, content: tuple, number: int) -> None:
        if number:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append((content, number))

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            i = bisect_left(rooms, w)
            if i < len(rooms):
                room = rooms[i]
                content, bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[i]
            else:
                room, content, bins = capacity, (), n
            each = room // w
            filled = min(bins, n // each)
            put(room - each * w, (*content, (w, each)), filled)
            n, bins = n - filled * each, bins - filled
            if bins and n and n < each:
                put(room - n * w, (*content, (w, n)), 1)
                n, bins = 0, bins - 1
            if content:
                put(room, content, bins)
    return [pattern for found in open_bins.values() for pattern in found]


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that together hold every piece once."""
    fixed, left = reduce_instance(counts, capacity)
    return [*fixed, *best_fit(left, capacity)]


def _runs(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For each length, which ranks go to which sequences: arrays sorted by length and first rank."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for content, number in patterns:
        at = 0
        for w, each in content:
            rows.append((w, used[w], each, sequence, at))
            used[w] += each * number
            at += w * each
        sequence += number
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "each", "sequence", "offset"), table.T, strict=True))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids), with the task and the rank within task and length."""
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
    names = [f.split()[0] for f in fields.split(", ")] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, task = Counter(), TaskContext.get().partitionId()
        for batch, found in encoded(batches, tokenizer, END_ID):
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                n = len(ids) // 4
                stops = [*range(n % capacity or capacity, n, capacity), n] if n > capacity else [n]
                start = 0
                for i, stop in enumerate(stops):
                    own = ids[4 * start: 4 * stop]
                    rows.append((doc_id, i, start, stop - start, zlib.crc32(own), task, seen[stop - start], own))
                    seen[stop - start] += 1
                    start = stop
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)][: len(names)], names=names)

    # Encoded and cut in one: with two Python stages each task has two workers, and all come to hold an encoder.
    return docs.select("doc_id", "text").mapInArrow(cut, fields + ", ids binary" * with_ids)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    made = keep(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    by_task = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    by_task = keep(by_task.withColumn("before", F.coalesce(before, F.lit(0))), "ranks")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = _runs(plan(counts, capacity))  # bounded by the capacity

    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    more = ["ids"] * with_ids
    names = [f.split()[0] for f in fields.split(", ")] + more

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins = {w: i for i, w in reversed(list(enumerate(runs["length"].tolist())))}
        stops = {w: i + 1 for i, w in enumerate(runs["length"].tolist())}
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            run = np.empty(len(length), dtype=np.int64)
            for w in np.unique(length).tolist():
                rows = length == w
                own = runs["first"][begins[w]: stops[w]]
                run[rows] = begins[w] + np.searchsorted(own, rank[rows], side="right") - 1
            over = rank - runs["first"][run]
            each = runs["each"][run]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(runs["sequence"][run] + over // each),
                 pa.array(runs["offset"][run] + over % each * length), *batch.columns[6:]], names=names)

    ranked = made.join(by_task.drop("n"), ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"), *more)
    return ranked.mapInArrow(placed, fields + ", ids binary" * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of each sequence; from :func:`pack` with ids. No group exceeds a sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("p")).select(
        "sequence_id", "n_tokens", F.unhex(F.array_join(F.col("p.ids"), "")).alias("ids"))
