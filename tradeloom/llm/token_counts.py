"""Token counts by rank-synchronous merging of byte-pair arrays.

Texts are cut into chunks and pre-tokens; different pre-tokens of a batch lie one after another in a
ragged numpy array of symbols. In each round every sequence merges its own pair of lowest rank, all
sequences at once, until no sequence has a pair left; the symbols that survive are the tokens. The
vocabulary file gives the merges; the tokenizers library itself is not used.

Special tokens inside a text count as one token, as the library's default has it. Null texts are
empty and have no tokens; rows are counted one by one, so repeats and empty tables need no rule;
other columns are ignored. Texts are counted whole, also without any space in them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.chunks import LONG, PATTERN, REMEMBERED, byte_letters, distinct, groups_of, no_collector, pieces, split_chunks, texts_of

NONE = np.iinfo(np.int32).max
#: Pre-tokens merged together, in symbols.
SYMBOLS = 1_000_000


class Merges:
    """The merges of a byte-level BPE file: rank and result of each pair of symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        pre = said["pre_tokenizer"] or {}
        if said["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or said["normalizer"] is not None \
                or not pre.get("use_regex") or pre.get("add_prefix_space") \
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in said["added_tokens"]):
            raise ValueError(f"{path}: only plain byte-level BPE files are read")
        vocab = said["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in said["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        result = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.results = keys[order], order.astype(np.int32), result
        self.bytes = np.array([vocab[c] for c in byte_letters()], dtype=np.int32)
        special = sorted((t["content"] for t in said["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)

    def count(self, parts: list[bytes]) -> np.ndarray:
        """How many tokens each byte string (not empty) becomes."""
        counts = np.ones(len(parts), dtype=np.int64)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        symbols = self.bytes[np.frombuffer(b"".join(parts), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(parts)), sizes)
        rank = self._ranks(symbols, owner)
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(owner)))
            done = lowest == NONE
            if done.any():
                counts[owner[starts[done]]] = lengths[done]
                stay = np.repeat(~done, lengths)
                symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
                lowest, lengths = lowest[~done], lengths[~done]
                if not len(symbols):
                    break
            hit = rank == np.repeat(lowest, lengths)
            at = np.flatnonzero(hit)
            # of pairs that overlap, as in aaa, every second from the left is merged
            run = np.concatenate([[True], at[1:] != at[:-1] + 1])
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            symbols[at] = self.results[rank[at]]
            stay = np.ones(len(symbols), dtype=bool)
            stay[at + 1] = False
            place = np.cumsum(stay) - 1
            symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
            now = place[at]
            self._renew(symbols, owner, rank, np.concatenate([now, now[now > 0] - 1]))
        return counts

    def _ranks(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The rank of each symbol with the next one of its sequence."""
        rank = np.full(len(symbols), NONE, dtype=np.int32)
        if len(symbols) > 1:
            self._renew(symbols, owner, rank, np.arange(len(symbols)))
        return rank

    def _renew(self, symbols: np.ndarray, owner: np.ndarray, rank: np.ndarray, at: np.ndarray) -> None:
        rank[at] = NONE
        at = at[at + 1 < len(symbols)]
        at = at[owner[at] == owner[at + 1]]
        rank[at] = self.rank(symbols[at], symbols[at + 1])


class Counter:
    """Counts tokens of texts; remembers the first pre-tokens it meets."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.parts: dict[str, int] = {}

    def _parts(self, lists: list[list[str]]) -> list[int]:
        """Tokens of each list of pre-tokens."""
        known: dict[str, int] = {}
        new = []
        for part in set().union(*lists):
            found = self.parts.get(part)
            if found is None:
                new.append(part)
            else:
                known[part] = found
        new.sort(key=len)
        at, raw = 0, [p.encode() for p in new]
        while at < len(raw):
            stop, size = at, 0
            while stop < len(raw) and (size < SYMBOLS or stop == at):
                size += len(raw[stop])
                stop += 1
            for part, n in zip(new[at:stop], self.merges.count(raw[at:stop]).tolist(), strict=True):
                known[part] = n
                if len(self.parts) < REMEMBERED and len(part) <= LONG:
                    self.parts[part] = n
            at = stop
        return [sum(map(known.__getitem__, parts)) for parts in lists]

    def _split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and its special tokens."""
        between = self.merges.special.split(text)
        return [p for t in between for p in PATTERN.findall(t)], len(between) - 1

    def _texts(self, texts: list[str]) -> list[int]:
        split = [self._split(t) for t in texts]
        return [n + more for n, (_, more) in zip(self._parts([p for p, _ in split]), split, strict=True)]

    @no_collector()
    def count(self, texts: list[str]) -> list[int]:
        after, wrong = distinct(texts)
        odd = list(wrong)
        if any(self.merges.special.search(t) for t in texts):
            odd += [c for c in after - wrong if self.merges.special.search(c)]
        found = dict(zip(odd, self._texts([" " + c for c in odd]), strict=True))
        plain = [c for c in after if c not in found]
        for at in range(0, len(plain), 100_000):
            own = plain[at: at + 100_000]
            found.update(zip(own, self._parts(split_chunks(own)), strict=True))
        firsts, rests = [], []
        for text in texts:
            first, rest = pieces(text, wrong)
            firsts.append(first)
            rests.append(sum(map(found.__getitem__, rest)))
        return [a + b for a, b in zip(self._texts(firsts), rests, strict=True)]


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and whether n_tokens is over the limit."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _COUNTERS:
            _COUNTERS[tokenizer] = Counter(tokenizer)
        own = _COUNTERS[tokenizer]
        for batch in batches:
            tokens = [n for group in groups_of(texts_of(batch.column(1))) for n in own.count(group)]
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    made = docs.select("doc_id", "text").mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
