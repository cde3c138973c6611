"""Periodic runs of words: maximal repetitions found from Lyndon roots with suffix-tree LCE queries.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal)
that no neighbouring word extends with period ``q``. By the runs theorem every run of exponent two
or more holds a Lyndon root, a piece of length ``q`` that is the longest Lyndon word starting at its
place under one of the two orders of the alphabet. So for each word ``i`` and both orders the
longest Lyndon word ``[i, i + p)`` is a candidate, extended forwards by the longest common extension
of the suffixes at ``i`` and ``i + p`` and backwards by that of the reversed prefixes; a stretch
of at least ``2p`` words is a run of period ``p``.

Longest common extensions come from Ukkonen suffix trees of the word ids and of their reversal
(each with an end mark): the string depth of the lowest common ancestor of two leaves. The LCA is
the shallowest node between the leaves' first visits in an Euler tour, found in constant time
from minima of fixed blocks and a sparse table over the blocks. Lyndon words come from the same
tree: a depth-first walk with children in either order gives the suffix ranks, and the longest
Lyndon word at ``i`` ends at the next suffix of smaller rank.

Only runs of at least six words and four periods count, and each of their words stands in them four
times. So a document is first cut at every word that stands less often in the stretch around it, again
and again; both trees are built for each stretch that is left. No run that counts is lost or shortened.

Documents are worked on one at a time in tasks. Words are runs of anything but ASCII white space;
a null text has none, repeated rows and ties give equal results, an empty table an empty result,
and no other input column is read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.chunks import texts_of

END = -1
BLOCK = 32


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of ids ending in a unique end mark."""

    def __init__(self, s: list[int]):
        n = len(s)
        start, stop, link, child = [0], [0], [0], [{}]
        node, edge, length, remaining = 0, 0, 0, 0
        for i, c in enumerate(s):
            remaining += 1
            pending = -1
            while remaining:
                if length == 0:
                    edge = i
                a = s[edge]
                nxt = child[node].get(a)
                if nxt is None:
                    start.append(i), stop.append(n), link.append(0), child.append({})
                    child[node][a] = len(start) - 1
                    if pending != -1:
                        link[pending] = node
                        pending = -1
                else:
                    span = min(stop[nxt], i + 1) - start[nxt]
                    if length >= span:
                        edge += span
                        length -= span
                        node = nxt
                        continue
                    if s[start[nxt] + length] == c:
                        if pending != -1 and node != 0:
                            link[pending] = node
                        length += 1
                        break
                    split = len(start)
                    start.append(start[nxt]), stop.append(start[nxt] + length), link.append(0), child.append({})
                    child[node][a] = split
                    start.append(i), stop.append(n), link.append(0), child.append({})
                    child[split][c] = split + 1
                    start[nxt] += length
                    child[split][s[start[nxt]]] = nxt
                    if pending != -1:
                        link[pending] = split
                    pending = split
                remaining -= 1
                if node == 0 and length > 0:
                    length -= 1
                    edge = i - remaining + 1
                elif node != 0:
                    node = link[node]
        self.n, self.start, self.stop, self.child = n, start, stop, child

    def walk(self, descending: bool = False, tour: bool = False):
        """Leaves (suffix starts) in the order of a walk with children by symbol, the end mark first.

        With ``tour``, also the Euler tour (nodes), the tree depth and string depth of each node and
        the first visit of each suffix's leaf.
        """
        n, start, stop, child = self.n, self.start, self.stop, self.child
        depth = [0] * len(start)
        order: list[int] = []
        euler: list[int] = []
        level: list[int] = []
        first = [0] * n

        def key(c: int):
            return (c != END, -c if descending else c)

        stack = [(0, 0, 0)]
        while stack:
            v, d, state = stack.pop()
            if tour:
                euler.append(v)
                level.append(d)
            if state:
                continue
            kids = child[v]
            if not kids:
                suffix = n - depth[v]
                order.append(suffix)
                if tour:
                    first[suffix] = len(euler) - 1
                continue
            for c in sorted(kids, key=key, reverse=True):
                u = kids[c]
                depth[u] = depth[v] + min(stop[u], n) - start[u]
                if tour:
                    stack.append((v, d, 1))
                stack.append((u, d + 1, 0))
        if not tour:
            return order
        return order, np.array(euler, dtype=np.int64), np.array(level, dtype=np.int64), np.array(depth), \
            np.array(first, dtype=np.int64)


class Extension:
    """Longest common extensions of suffixes: string depth of the LCA by Euler tour and block minima."""

    def __init__(self, tree: SuffixTree):
        order, euler, level, depth, first = tree.walk(tour=True)
        self.order, self.depth, self.first = order, depth, first
        self.euler, self.level = euler, level
        key = level << 32 | np.arange(len(level))
        size = len(key)
        blocks = (size + BLOCK - 1) // BLOCK
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max, dtype=np.int64)
        padded[:size] = key
        shaped = padded.reshape(blocks, BLOCK)
        self.prefix = np.minimum.accumulate(shaped, axis=1).ravel()
        self.suffix = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1].ravel()
        self.key = padded
        table = [shaped.min(axis=1)]
        while 2 ** len(table) <= blocks:
            half = 2 ** (len(table) - 1)
            last = table[-1]
            table.append(np.minimum(last[:-half], last[half:]))
        self.table = table

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common length of the suffixes at ``i`` and ``j`` (arrays of equal length, ``i != j``)."""
        a, b = self.first[i], self.first[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        bl, bh = lo // BLOCK, hi // BLOCK
        best = np.minimum(self.suffix[lo], self.prefix[hi])
        inner = bh - bl - 1
        wide = inner > 0
        if wide.any():
            span = inner[wide]
            k = np.floor(np.log2(span)).astype(np.int64)
            low, high = bl[wide] + 1, bh[wide] - (1 << k)
            got = np.empty(len(span), dtype=np.int64)
            for level in np.unique(k):
                take = k == level
                got[take] = np.minimum(self.table[level][low[take]], self.table[level][high[take]])
            best[wide] = np.minimum(best[wide], got)
        same = bl == bh
        for at in np.flatnonzero(same):
            best[at] = self.key[lo[at]:hi[at] + 1].min()
        return self.depth[self.euler[best & 0xFFFFFFFF]]


def lyndon_lengths(order: list[int], n: int) -> np.ndarray:
    """Length of the longest Lyndon word at each place: distance to the next suffix of smaller rank."""
    rank = np.empty(n + 1, dtype=np.int64)
    rank[np.array(order)] = np.arange(n + 1)
    smaller = np.empty(n, dtype=np.int64)
    stack = [n]
    ranks = rank.tolist()
    for i in range(n - 1, -1, -1):
        r = ranks[i]
        while ranks[stack[-1]] > r:
            stack.pop()
        smaller[i] = stack[-1]
        stack.append(i)
    return smaller - np.arange(n)


def find_runs(ids: list[int]) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of exponent two or more, sorted."""
    n = len(ids)
    if n < 2:
        return []
    tree = SuffixTree(ids + [END])
    forward = Extension(tree)
    backward = Extension(SuffixTree(ids[::-1] + [END]))
    tree_orders = (forward.order, tree.walk(descending=True))
    found: set[tuple[int, int, int]] = set()
    for order in tree_orders:
        period = lyndon_lengths(order, n)
        i = np.arange(n)
        ok = i + period < n
        i, p = i[ok], period[ok]
        if not len(i):
            continue
        ahead = forward.lce(i, i + p)
        back = np.zeros(len(i), dtype=np.int64)
        inside = i > 0
        back[inside] = backward.lce(n - i[inside], n - i[inside] - p[inside])
        begin = i - back
        length = i + p + ahead - begin
        keep = length >= 2 * p
        found.update(zip(begin[keep].tolist(), length[keep].tolist(), p[keep].tolist()))
    return sorted(found)


#: A run that counts has at least so many words and so many times its period.
WORDS, TIMES = 6, 4


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches ``[start, stop)`` outside which no run of ``WORDS`` words and ``TIMES`` periods can reach.

    Each word of such a run stands in it at least ``TIMES`` times, so a word that a stretch holds less often is
    in none and cuts the stretch; the parts are cut again until nothing changes. Nor does a cutting word extend a
    run found beside it, as it would then stand ``TIMES`` times in the stretch that it cut.
    """
    found, open_ = [], [(0, ids)]
    while open_:
        at, own = open_.pop()
        if len(own) < WORDS:
            continue
        _, number, counts = np.unique(own, return_inverse=True, return_counts=True)
        rare = np.flatnonzero(counts[number] < TIMES)
        if not len(rare):
            found.append((at, at + len(own)))
            continue
        begins, ends = np.concatenate([[0], rare + 1]), np.concatenate([rare, [len(own)]])
        for k in np.flatnonzero(ends - begins >= WORDS).tolist():
            open_.append((at + int(begins[k]), own[begins[k]: ends[k]]))
    return sorted(found)


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the planted repetition of ``doc_id``'s hash, if its hash plants one."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def analyse(text: str, doc_id: int | None):
    """``(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, runs)`` of one text."""
    words = planted(text.encode("utf-8", "surrogatepass").split(), doc_id)
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    runs = [(at + s, length, p) for at, stop in stretches(np.array(ids, dtype=np.int64))
            for s, length, p in find_runs(ids[at:stop]) if length >= max(WORDS, TIMES * p)]
    runs.sort(key=lambda r: (r[0], r[2]))
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    gone = np.cumsum(dropped)[:len(words)] > 0
    collapsed = b" ".join(w for w, out in zip(words, gone.tolist()) if not out)
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    head = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *head, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest(), runs)


RESULT_ARROW = pa.schema([
    pa.field("doc_id", pa.int64()), pa.field("n_runs", pa.int64()), pa.field("start", pa.int64()),
    pa.field("length", pa.int64()), pa.field("period", pa.int64()), pa.field("exponent_milli", pa.int64()),
    pa.field("runs_sha256", pa.string()), pa.field("collapsed_sha256", pa.string()),
    pa.field("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
])
RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_runs", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("period", T.LongType()),
    T.StructField("exponent_milli", T.LongType()), T.StructField("runs_sha256", T.StringType()),
    T.StructField("collapsed_sha256", T.StringType()),
    T.StructField("runs", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("period", T.LongType())]))),
])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: run count, longest run, digests of the run list and of the collapsed words, all runs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))

    def analysed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                made = [analyse(t, d) for t, d in zip(texts_of(part.column("_text")), part.column("doc_id").to_pylist())]
                columns = list(zip(*made)) if made else [[]] * 8
                runs = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in columns[7]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns[:7], list(RESULT_ARROW)[1:8])),
                     pa.array(runs, RESULT_ARROW.field("runs").type)], schema=RESULT_ARROW)

    return rows.mapInArrow(analysed, RESULT)
