"""Substring de-duplication: words under a window of words that starts anywhere else are removed.

Windows are dealt out as super-k-mers: consecutive windows of a text whose smallest run of ``MINIMISER``
words is the same travel as one packed string to that minimiser's bucket. Equal windows have equal
minimisers, so they meet in one bucket, where sorting brings them together; neighbours of equal
fingerprint are compared word by word, so the count is exact.

Within a batch, equal super-k-mers are sent once, marked as repeated; their own windows are known to
repeat and are reported without a detour. A passage that a third of all rows share so comes to its
bucket once a batch of texts, and there it is held once. At its edges, and around a frequent phrase,
super-k-mers reach into each text's own words and differ. So the bytes that come to each bucket are
counted first; a bucket above ``HOT`` times the average is dealt by the fingerprints of single windows
to as many buckets as these fill. Equal windows still meet, and no bucket grows with one minimiser.
Buckets follow from the corpus's size in bytes; a batch packs a bucket's strings as one compressed row.
Reported ranges are merged per document, and each text is rebuilt once.

Null texts have no words. Rows that repeat id and text are told apart: each is another place of
the same windows. Texts shorter than a window are left as they are. An empty table gives an empty
result; other columns are ignored by :func:`repeated_ranges` and kept by :func:`remove_repeats`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.chunks import groups_of, texts_of
from tradeloom.llm.common import keep, text_of

WINDOW = 35
MINIMISER = 5
#: Packed bytes a bucket holds on average.
BUCKET_BYTES = 6 << 20
#: A bucket with so many times these bytes is dealt by single windows.
HOT = 4
#: Characters of the texts whose words are hashed together, unless one text has more: the arrays take many times that.
HASHED = 1_000_000
#: Packed rows that are opened together.
OPENED = 100

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base ** 2 and so on, modulo 2 ** 64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Fingerprints of stretches of an array, many at once by running sums; powers are kept between calls."""

    def __init__(self, span: int = 1 << 19):
        self.span = span
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def stretches(self, values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Equal stretches get equal numbers, wherever they stand. Starts and stops must ascend."""
        out, done = np.empty(len(starts), dtype=np.uint64), 0
        while done < len(starts):
            low = starts[done]
            upto = int(np.searchsorted(starts, low + self.span))
            own = values[low: stops[upto - 1]]
            n = len(own) + 1
            if len(self.up) < n:
                self.up, self.down = _powers(_ODD, n), _powers(_INVERSE, n)
            sums = np.zeros(n, dtype=np.uint64)
            np.cumsum((own.astype(np.uint64) + np.uint64(1)) * self.up[: n - 1], out=sums[1:])
            a, b = starts[done:upto] - low, stops[done:upto] - low
            out[done:upto] = mixed((sums[b] - sums[a]) * self.down[a])
            done = upto
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finaliser of MurmurHash3)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """Words of several texts in one buffer: one space after each word, a line end after the last of a text."""

    def __init__(self, texts: list[bytes], hasher: Hasher):
        self.raw = b"\n".join(texts) + b"\n"
        buffer = np.frombuffer(self.raw, dtype=np.uint8)
        ends = np.flatnonzero((buffer == 32) | (buffer == 10))
        starts = np.concatenate([[0], ends[:-1] + 1])
        real = ends > starts
        self.starts, self.ends = starts[real], ends[real]
        last = np.flatnonzero(buffer == 10)
        #: Number of the first word of each text, and of the word past the last.
        self.stop = np.searchsorted(self.starts, last)
        self.start = np.concatenate([[0], self.stop[:-1]])
        self.hash = hasher.stretches(buffer, self.starts, self.ends)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows, and the text of each."""
        n = np.maximum(0, self.stop - self.start - size + 1)
        text = np.repeat(np.arange(len(n)), n)
        return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.start, n), text


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values in a row, by doubling."""
    out, span = values, 1
    while 2 * span <= width:
        out, span = np.minimum(out[: len(out) - span], out[span:]), 2 * span
    return np.minimum(out[: len(values) - width + 1], out[width - span: width - span + len(values) - width + 1])


def _super_kmers(words: Words, hasher: Hasher, window: int, minimiser: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, text and minimiser of each run of windows with one minimiser."""
    at, text = words.windows(window)
    if not len(at):
        return at, at, text, at.astype(np.uint64)
    runs = len(words.hash) - minimiser + 1
    places = np.arange(runs)
    low = _lowest(hasher.stretches(words.hash, places, places + minimiser), window - minimiser + 1)[at]
    new = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (text[1:] != text[:-1])]))
    return at[new], np.diff(np.append(new, len(at))), text[new], low[new]


def _hashed(group: list[str], hasher: Hasher, window: int, minimiser: int) -> Iterator[tuple]:
    """Number of the first text, the words and the super-k-mers of a few texts of a group at a time."""
    at = 0
    for some in groups_of(group, len(group), HASHED):
        words = Words([b" ".join(t.encode().split()) for t in some], hasher)
        yield at, words, *_super_kmers(words, hasher, window, minimiser)
        at += len(some)


def _loads(docs: DataFrame, buckets: int, window: int, minimiser: int) -> DataFrame:
    """Bytes that come to each bucket: bucket, ``held`` as super-k-mers, ``apart`` as single windows."""
    def loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, apart = Hasher(), np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for group in groups_of(texts_of(batch.column(0))):
                found = []
                for _, words, first, count, _, low in _hashed(group, hasher, window, minimiser):
                    last = first + count + window - 1
                    found.append((hasher.stretches(words.hash, first, last), words.ends[last - 1] - words.starts[first],
                                  (mixed(low) % np.uint64(buckets)).astype(np.int64), count))
                key, size, bucket, n = (np.concatenate(c) for c in zip(*found, strict=True))
                sole = np.unique(key, return_index=True)[1]
                size, bucket, n = size[sole], bucket[sole], n[sole]
                np.add.at(held, bucket, size)
                np.add.at(apart, bucket, size * n * window // (n + window - 1))
        own = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int64()), pa.array(held[own]), pa.array(apart[own])], names=["bucket", "held", "apart"])

    counted = docs.select("text").mapInArrow(loaded, "bucket long, held long, apart long")
    return counted.groupBy("bucket").agg(F.sum("held").alias("held"), F.sum("apart").alias("apart"))


def _apart(docs: DataFrame, buckets: int, window: int, minimiser: int,
           bucket_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bucket the first of the buckets that its windows are dealt to, and how many; none if it is not hot."""
    begin, ways, upto = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64), buckets
    hot = _loads(docs, buckets, window, minimiser).where(F.col("held") > HOT * bucket_bytes)
    for r in sorted(hot.collect()):  # fewer rows than buckets
        begin[r["bucket"]], ways[r["bucket"]] = upto, -(-r["apart"] // bucket_bytes)
        upto += int(ways[r["bucket"]])
    return begin, ways


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_ROW = "part long, bucket long, texts binary, docs binary, starts binary, repeated binary, from_word int, to_word int"


def _ranges_in(strings: list[bytes], sole: np.ndarray, hasher: Hasher, window: int) -> Iterator[tuple[int, int, int]]:
    """(string, first window, windows) of the windows that occur again. ``sole``: the string stands for one place."""
    if not strings:
        return
    words = Words(strings, hasher)
    at, text = words.windows(window)
    key = hasher.stretches(words.hash, at, at + window)
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = np.concatenate([[False], key[1:] == key[:-1]])
    hit = same | np.append(same[1:], False)
    found = np.zeros(len(at), dtype=bool)
    # Exact comparison of the neighbours; all of one fingerprint are nearly always one window.
    groups = np.cumsum(~same)[hit] if len(at) else at
    alike: dict[tuple[int, bytes], int] = {}
    for group, i in zip(groups.tolist(), order[hit].tolist(), strict=True):
        said = (group, words.raw[words.starts[at[i]]: words.ends[at[i] + window - 1]])
        if said in alike:
            found[i] = found[alike[said]] = True
        else:
            alike[said] = i
    found |= ~sole[text]
    marked = np.flatnonzero(found)
    if len(marked):
        new = np.concatenate([[True], (marked[1:] != marked[:-1] + 1) | (text[marked[1:]] != text[marked[:-1]])])
        firsts = np.flatnonzero(new)
        for f, n in zip(marked[firsts].tolist(), np.diff(np.append(firsts, len(marked))).tolist(), strict=True):
            yield int(text[f]), int(at[f] - words.start[text[f]]), n


def _packed(docs: DataFrame, window: int, minimiser: int, bucket_bytes: int) -> DataFrame:
    """The packed strings of each batch and bucket, a bucket's rows in one partition and together."""
    spark = docs.sparkSession
    read = docs.select("doc_id", F.xxhash64(text_of()).alias("text_key"), "text")
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).head()[0] or 0
    # Super-k-mers take about three times the text.
    buckets = max(1, -(-3 * total // bucket_bytes))
    begin, ways = _apart(docs, buckets, window, minimiser, bucket_bytes)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (buckets + int(ways.sum())) // 8)
    names = [f.split()[0] for f in _ROW.split(", ")]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, pack = Hasher(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            done = 0
            for group in groups_of(texts_of(batch.column(2))):
                own = keys[done: done + len(group)]
                done += len(group)
                #: Of each string its bucket and the text, first word and end of its places.
                seen: dict[bytes, tuple[int, list[tuple[int, int, int]]]] = {}
                for before, words, first, count, text, low in _hashed(group, hasher, window, minimiser):
                    bucket = (mixed(low) % np.uint64(buckets)).astype(np.int64)
                    hot = ways[bucket] > 0
                    if hot.any():
                        n = count[hot]
                        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[hot], n)
                        own_begin, own_ways = np.repeat(begin[bucket[hot]], n), np.repeat(ways[bucket[hot]], n)
                        salt = mixed(hasher.stretches(words.hash, at, at + window)) % own_ways.astype(np.uint64)
                        bucket = np.concatenate([bucket[~hot], own_begin + salt.astype(np.int64)])
                        first, text = np.concatenate([first[~hot], at]), np.concatenate([text[~hot], np.repeat(text[hot], n)])
                        count = np.concatenate([count[~hot], np.ones_like(at)])
                    last = first + count + window - 2
                    place = first - words.start[text]
                    members = zip((text + before).tolist(), place.tolist(), (place + count + window - 1).tolist(), strict=True)
                    for x, y, number, member in zip(
                            words.starts[first].tolist(), words.ends[last].tolist(), bucket.tolist(), members, strict=True):
                        seen.setdefault(words.raw[x:y], (number, []))[1].append(member)
                by_bucket: dict[int, tuple[list, list]] = {}
                local: dict[int, list[tuple[int, int]]] = {}
                for string, (number, members) in seen.items():
                    into = by_bucket.setdefault(number, ([], []))
                    into[0].append(string)
                    into[1].append(members[0] if len(members) == 1 else None)
                    if len(members) > 1:
                        for t, a, b in members:
                            local.setdefault(t, []).append((a, b))
                rows = []
                for number, (strings, members) in by_bucket.items():
                    ids = [own[m[0]] if m else (0, 0) for m in members]
                    rows.append((
                        number % parts, number, pack.compress(b"\n".join(strings)),
                        np.array([(d or 0, k, d is None) for d, k in ids], dtype=np.int64).tobytes(),
                        np.array([m[1] if m else 0 for m in members], dtype=np.int32).tobytes(),
                        np.array([m is None for m in members]).tobytes(), None, None))
                for t, ranges in local.items():
                    d, k = own[t]
                    key = np.array([(d or 0, k, d is None)], dtype=np.int64).tobytes()
                    rows += [(k % parts, -1, None, key, None, None, x, y) for x, y in _merged(ranges)]
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32())
                columns = list(zip(*rows, strict=True)) if rows else [()] * 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)

    return read.mapInArrow(dealt, _ROW).repartition(parts, "part").sortWithinPartitions("bucket")


def repeated_ranges(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Ranges of words to remove: doc_id, text_key (xxhash64 of the text), from_word, to_word (exclusive); may overlap."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, unpack = Hasher(), zstandard.ZstdDecompressor()

        def out(keys: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0], pa.int64(), mask=keys[:, 2] != 0), pa.array(keys[:, 1], pa.int64()),
                 pa.array(starts, pa.int32()), pa.array(stops, pa.int32())],
                names=["doc_id", "text_key", "from_word", "to_word"])

        def finish() -> Iterator[pa.RecordBatch]:
            strings = list(places)
            sole = np.array([p is not None for p in places.values()])
            found = [(*places[strings[t]], a, n) for t, a, n in _ranges_in(strings, sole, hasher, window) if sole[t]]
            if found:
                table = np.array([(*key, place + a, place + a + n + window - 1) for key, place, a, n in found], np.int64)
                yield out(table[:, :3], table[:, 3], table[:, 4])

        #: Of the bucket at hand: each string's only place so far, or None if it has several.
        places: dict[bytes, tuple | None] = {}
        bucket = None
        for batch in batches:
            known = batch.filter(pc.equal(batch.column(1), -1))
            if known.num_rows:
                keys = np.frombuffer(b"".join(known.column(3).to_pylist()), dtype=np.int64).reshape(-1, 3)
                yield out(keys, known.column(6).to_numpy(), known.column(7).to_numpy())
            held = batch.filter(pc.not_equal(batch.column(1), -1))
            for row in (r for at in range(0, held.num_rows, OPENED) for r in held.slice(at, OPENED).to_pylist()):
                if row["bucket"] != bucket:
                    yield from finish()
                    places, bucket = {}, row["bucket"]
                whole = []
                for string, key, place, several in zip(
                        unpack.decompress(row["texts"]).split(b"\n"),
                        map(tuple, np.frombuffer(row["docs"], dtype=np.int64).reshape(-1, 3).tolist()),
                        np.frombuffer(row["starts"], dtype=np.int32).tolist(),
                        np.frombuffer(row["repeated"], dtype=bool).tolist(), strict=True):
                    if string in places:
                        n = string.count(b" ") + 1
                        whole += [(*k, p, p + n) for k, p in (places[string] or (None, 0), (None if several else key, place))
                                  if k is not None]
                        places[string] = None
                    else:
                        places[string] = None if several else (key, place)
                if whole:
                    table = np.array(whole, dtype=np.int64)
                    yield out(table[:, :3], table[:, 3], table[:, 4])
        yield from finish()

    packed = _packed(docs, window, minimiser, bucket_bytes)
    return packed.mapInArrow(counted, "doc_id long, text_key long, from_word int, to_word int")


def _rebuilt(text: str | None, ranges: list[dict] | None) -> tuple[int, int, bytes]:
    words = (text or "").encode().split()
    n, removed = len(words), 0
    for a, b in reversed(_merged([(r["a"], r["b"]) for r in ranges or []])):
        del words[a:b]
        removed += b - a
    return n, removed, b" ".join(words)


def remove_repeats(docs: DataFrame, window: int = WINDOW, **how) -> DataFrame:
    """Every row with n_words, n_removed and ``kept``, the words that stay joined by one space; other columns stay."""
    ranges = keep(repeated_ranges(docs, window, **how), "ranges")
    ranges = ranges.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct(F.col("from_word").alias("a"), F.col("to_word").alias("b"))).alias("_ranges"))
    others = [c for c in docs.columns if c not in ("text", "n_words", "n_removed", "kept")]
    read = docs.select(*[F.col(f"`{c}`") for c in others], "text", F.xxhash64(text_of()).alias("_key"))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("text_key"))
    joined = read.join(ranges.withColumnRenamed("doc_id", "_id"), on, "left").select(*others, "text", "_ranges")
    schema = joined.select(*others, F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
                           F.lit("").alias("kept")).schema

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_rebuilt(t, r) for t, r in zip(
                batch.column(len(others)).to_pylist(), batch.column(len(others) + 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(others)], pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2].decode() for r in rows], pa.string())],
                names=schema.names)

    return joined.mapInArrow(rebuilt, schema)
