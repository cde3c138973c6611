"""Token ids of documents in compressed files: canonical, length-limited Huffman codes.

Writing: ids are made once and kept, counted as they are made; one global count gives code lengths
(package-merge), so every file shares one code table. Each document becomes a row whose bits start at a byte, with a bit
offset every ``BLOCK`` ids; a reader can decode each block alone. Rows lie in files by ascending
doc_id. Reading decodes many blocks in step, one table look-up a code.

``write_token_files`` makes a folder of three Parquet tables: ``code`` (id, length), ``ids`` (the
coded documents) and ``about`` (one row; written last, so a folder without it is unfinished). Spark's
writer commits each table's files under temporary names, so lost executors leave no half files.

Null texts are empty and give the end id alone; null doc_ids come first; repeated rows are coded
like any other, side by side; an empty table gives empty files; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.chunks import ENCODED, encoder, groups_of, texts_of
from tradeloom.llm.common import keep, settled, stamped

BLOCK = 512
#: Longest code, raised only where the number of different ids needs more; a decoding table has two to this entries.
LONGEST = 18
END_ID = 0
#: Ids coded, and ids decoded together, unless one document has more.
TOGETHER, DECODED_TOGETHER = 60_000, 600_000
#: Chunks that a worker remembers while token files are written.
REMEMBERED = 700_000
#: Bytes of a document's bits by which rows are dealt, and by which equal keys are told apart.
DEALT_BY = 32
#: Texts encoded together, and characters at most unless one text has more: few, for a worker's memory.
ENCODED_TOGETHER = 300, 1_000_000
#: Bytes of the texts whose chunks are looked up together while token files are written, unless one text has more.
STREAMED_TOGETHER = 8_000_000


def slices(counts: np.ndarray, together: int) -> Iterator[tuple[int, int]]:
    """First row and number of rows of stretches with few ids in all."""
    upto, at = np.cumsum(counts), 0
    while at < len(counts):
        before = upto[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(upto, before + together, side="right")))
        yield at, stop - at
        at = stop


def encoded(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int | None = END_ID,
            most: int = ENCODED) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Few rows at a time with the ids of each one's text (second column) as little-endian unsigned 32-bit integers."""
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    own = encoder(tokenizer, most)
    for batch in batches:
        at = 0
        for group in groups_of(texts_of(batch.column(1)), *ENCODED_TOGETHER):
            yield batch.slice(at, len(group)), [x + end for x in own.encode(group)]
            at += len(group)


def narrowed(ids: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The ids of each document, in 16 bits each if they all fit, and how often each id occurs."""
    found, counts = halved(np.frombuffer(b"".join(ids), dtype="<u4"), np.array([len(x) // 4 for x in ids], dtype=np.int64))
    return found.to_pylist(), counts


def halved(stream: np.ndarray, n_tokens: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """:func:`narrowed` of documents whose ids follow one another; ``n_tokens`` has how many each has."""
    counts = np.bincount(stream)
    raw = stream.astype("<u4" if len(counts) > 1 << 16 else "<u2")
    stops = np.cumsum(np.concatenate([[0], n_tokens])) * raw.itemsize
    ids = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(n_tokens), [None, pa.py_buffer(stops.astype(np.int64)), pa.py_buffer(raw)])
    return ids.cast(pa.binary()), counts


def widened(ids: list[bytes], counts: np.ndarray) -> np.ndarray:
    """The ids of documents one after another; ``counts`` has how many each has, in 16 or 32 bits each."""
    raw, n = b"".join(ids), int(counts.sum())
    if len(raw) in (2 * n, 4 * n):
        return np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * n else "<u4")
    return np.concatenate([np.frombuffer(x, dtype="<u2" if len(x) == 2 * k else "<u4")
                           for x, k in zip(ids, counts.tolist(), strict=True)])


def _counted(docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """doc_id, n_tokens, ids (:func:`halved`); each task's last row has ``counts`` alone, how often it met each id."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_tokens", "ids", "counts"]
        total = np.zeros(0, dtype=np.int64)
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        own = encoder(tokenizer, REMEMBERED)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64) + 1
            for at, rows in slices(sizes, STREAMED_TOGETHER):
                stream, n_tokens = own.stream(batch.column(1).slice(at, rows), end)
                ids, counts = halved(stream, n_tokens)
                total = np.pad(total, (0, max(0, len(counts) - len(total))))
                total[: len(counts)] += counts
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows), pa.array(n_tokens, pa.int64()), ids, pa.nulls(rows, pa.binary())],
                    names=names)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
             pa.array([total.tobytes()], pa.binary())], names=names)

    return docs.select("doc_id", "text").mapInArrow(counted, "doc_id long, n_tokens long, ids binary, counts binary")


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits for positive counts, by package-merge."""
    n = len(counts)
    if n < 2:
        return np.ones(n, dtype=np.uint8)
    longest = max(longest, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    merged, levels = leaves, [np.ones(n, dtype=bool)]
    for _ in range(longest - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        rank = np.argsort(both, kind="stable")
        merged, is_leaf = both[rank], rank < n
        levels.append(is_leaf)
    lengths, taken = np.zeros(n, dtype=np.uint8), 2 * n - 2
    for is_leaf in reversed(levels):
        own = int(is_leaf[:taken].sum())
        lengths[order[:own]] += 1
        taken = 2 * (taken - own)
    return lengths


class CodeTable:
    """Canonical codes: by length, then by id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        rank = np.lexsort((ids, lengths))
        self.ids, lengths = ids[rank].astype(np.uint32), lengths[rank].astype(np.int64)
        self.bits = int(lengths[-1]) if len(lengths) else 1
        spans = np.left_shift(1, self.bits - lengths)
        firsts = np.cumsum(spans) - spans
        top = int(self.ids.max()) + 1 if len(ids) else 1
        self.length, self.code = np.zeros(top, dtype=np.int64), np.zeros(top, dtype=np.uint64)
        self.length[self.ids] = lengths
        self.code[self.ids] = (firsts >> (self.bits - lengths)).astype(np.uint64)
        self.entry = np.zeros(1 << self.bits, dtype=np.uint32)
        self.entry[: spans.sum()] = np.repeat(self.ids, spans)

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
        """Bits and block offsets of documents whose ids follow one another."""
        if not len(ids):
            return [b""] * len(counts), [np.zeros(0, np.int32)] * len(counts)
        lengths = self.length[ids]
        upto = np.cumsum(lengths)
        stops = np.cumsum(counts)
        starts = stops - counts
        total = np.concatenate([[0], upto])
        bits = total[stops] - total[starts]
        words = (bits + 31) // 32
        first = np.cumsum(words) - words
        # place of each code: its document begins at a 32-bit word
        at = upto - lengths + np.repeat(first * 32 - total[starts], counts)
        word = at >> 5
        shifted = self.code[ids] << (64 - (at & 31) - lengths).astype(np.uint64)
        begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        sums = np.add.reduceat(shifted, begins)
        out = np.zeros(int(words.sum()) + 1, dtype=np.uint32)
        out[word[begins]] += (sums >> np.uint64(32)).astype(np.uint32)
        out[word[begins] + 1] += (sums & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        raw = out.astype(">u4").tobytes()
        payloads = [raw[4 * f: 4 * f + (b + 7) // 8] for f, b in zip(first.tolist(), bits.tolist(), strict=True)]
        offsets = [(at[s:e:BLOCK] - 32 * f).astype(np.int32)
                   for s, e, f in zip(starts.tolist(), stops.tolist(), first.tolist(), strict=True)]
        return payloads, offsets

    def decode(self, payloads: list[bytes], counts: np.ndarray, offsets: list[np.ndarray]) -> list[np.ndarray]:
        """The documents' ids; all blocks advance together, one code a step."""
        bases = np.cumsum([0, *map(len, payloads)])
        raw = np.frombuffer(b"".join(payloads) + bytes(8), dtype=np.uint8)
        blocks = np.array([len(o) for o in offsets], dtype=np.int64)
        if not blocks.sum():
            return [np.zeros(0, np.uint32)] * len(payloads)
        doc = np.repeat(np.arange(len(payloads)), blocks)
        place = np.concatenate(offsets).astype(np.int64) + 8 * bases[doc]
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        left = np.minimum(BLOCK, counts[doc] - BLOCK * nth)
        begin = np.cumsum(left) - left
        order = np.argsort(-left, kind="stable")
        place, left, to = place[order], left[order], begin[order]
        out = np.empty(int(left.sum()), dtype=np.uint32)
        peek = raw[:-3].astype(np.uint32)
        for i in (1, 2, 3):
            peek = (peek << np.uint32(8)) | raw[i: len(raw) - 3 + i]
        high, mask = 32 - self.bits, np.uint32((1 << self.bits) - 1)
        for step in range(int(left[0])):
            live = int(np.searchsorted(-left, -step))
            place, to = place[:live], to[:live]
            seen = (peek[place >> 3] >> (high - (place & 7)).astype(np.uint32)) & mask
            ids = self.entry[seen]
            out[to + step] = ids
            place = place + self.length[ids]
        return np.split(out, np.cumsum(counts)[:-1])


def _counts(made: DataFrame) -> DataFrame:
    """How often each id occurs; as many rows as different ids."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in batch.column(0).to_pylist():
                total = np.frombuffer(counts, dtype=np.int64)
                seen = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["id", "n"])

    rows = made.where("counts is not null").select("counts")
    return rows.mapInArrow(opened, "id long, n long").groupBy("id").agg({"n": "sum"}).toDF("id", "n")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = END_ID) -> None:
    spark = docs.sparkSession
    made = keep(_counted(docs, tokenizer, end_id), "ids")
    counts = _counts(made).toPandas().sort_values("id")  # bounded by the vocabulary
    ids = counts["id"].to_numpy(dtype=np.int64)
    lengths = code_lengths(counts["n"].to_numpy(dtype=np.int64))
    spark.createDataFrame(
        pa.table({"id": pa.array(ids, pa.int64()), "length": pa.array(lengths.astype(np.int64), pa.int64())})
    ).coalesce(1).write.parquet(f"{folder}/code")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = CodeTable(ids, lengths)
        for batch in batches:
            counts = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, rows in slices(counts, TOGETHER):
                part, n = batch.slice(at, rows), counts[at: at + rows]
                payloads, offsets = table.encode(widened(part.column(2).to_pylist(), n), n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(payloads, pa.binary()),
                     pa.array(offsets, pa.list_(pa.int32()))], names=["doc_id", "n_tokens", "bits", "blocks"])

    rows = made.where("counts is null").select("doc_id", "n_tokens", "ids").mapInArrow(
        coded, "doc_id long, n_tokens long, bits binary, blocks array<int>")
    # Stored, for Spark draws the bounds of the ranges in a run of its own; keys of few bytes, for those go to the driver.
    stamped(keep(rows, "coded"), ["doc_id", "n_tokens", "bits"], "n_tokens", "start",
            ["doc_id", "n_tokens", F.substring("bits", 1, DEALT_BY)]).write.parquet(f"{folder}/ids")
    spark.createDataFrame([(1, BLOCK)], "version int, block int").coalesce(1).write.parquet(f"{folder}/about")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ``ids`` (little-endian unsigned 32-bit)."""
    about = spark.read.parquet(f"{folder}/about").head()
    if about["version"] != 1 or about["block"] != BLOCK:
        raise ValueError("files of another version")
    code = spark.read.parquet(f"{folder}/code").toPandas()
    ids, lengths = code["id"].to_numpy(), code["length"].to_numpy()
    rows = settled(spark.read.parquet(f"{folder}/ids"), "n_tokens", "start")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = CodeTable(ids, lengths)
        for batch in batches:
            counts = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, rows in slices(counts, DECODED_TOGETHER):
                part = batch.slice(at, rows)
                found = table.decode(
                    part.column(3).to_pylist(), counts[at: at + rows],
                    [np.array(o, dtype=np.int64) for o in part.column(4).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([x.astype("<u4").tobytes() for x in found], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    return rows.select("doc_id", "start", "n_tokens", "bits", "blocks").mapInArrow(
        decoded, "doc_id long, start long, n_tokens long, ids binary")


def checksums(ids: DataFrame) -> DataFrame:
    """Rows of :func:`read_token_files` with the CRC-32 of the ids in their place.

    Spark's own function: a second Python stage would keep another worker beside each decoding one.
    """
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
