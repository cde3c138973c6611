"""MinHash near-de-duplication by a signature-coordinate inverted join.

Documents of one shingle set are one class. Every class has a signature of ``coordinates`` minima
and is posted under each (coordinate, value) pair. Two classes of the wanted similarity agree in at
least ``matches`` coordinates but for a chance of about one in a million, and two that agree in so
many share one of the ``coordinates - matches + 1`` pairs that are rarest in either: only this
prefix of a class is merged, its long lists are skipped and looked up in the signatures afterwards.

Lists are merged in rounds. The first pairs each member with its list's smallest member; pairs
that agree in enough coordinates are confirmed on the full shingle sets and joined into components.
HUB_ROUNDS more rounds pair the members with another member drawn by hash for each list, where the
two still lie in different components. The last round merges what the members of a list that lie in
different components have unlike the centre of their group: near copies just too far apart to link
have few of these differences in common, while a link needs many. A group of copies so costs some
pairs a member, not all pairs, and no link between components is lost.

Null texts and texts without a word have an empty set and are linked with nothing. A text with
fewer words than a shingle is one shingle. Null ids are no component's name unless it has no other
(then component_id is null). Repeated rows share a class. Empty tables give empty results; other
columns are ignored, and kept by :func:`drop_near_copies`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.chunks import forget, groups_of, texts_of
from tradeloom.llm.common import components, keep, text_of
from tradeloom.llm.substring_dedup import Hasher, Words, mixed

WORDS = 5
PERCENT = 80
COORDINATES = 48
#: Agreeing coordinates that a pair must have, by wanted similarity in percent: at 80, 85 and 90 a pair just
#: similar enough has fewer with a chance below 2.1e-6 (binomial), a closer pair with far less.
MATCHES = ((90, 32), (85, 28), (80, 24), (0, 1))
#: Keys that may be broadcast to pick candidates' texts; beyond that they are joined by shuffling.
KEYS = 1_000_000

#: Rounds with hubs drawn by hash.
HUB_ROUNDS = 2
#: Members from which a group has a centre.
LARGE = 16
#: Texts whose sets are made together, and characters at most unless one text has more: few, for a worker's memory.
TOGETHER = 500, 2_000_000
#: Documents for each file of a step's table: steps are many and their tables small, and a file costs its
#: executor more than the rows of a shuffle partition that is nearly empty.
A_FILE = 10_000

_SEEDS = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


#: Largest chance that a pair just similar enough agrees in fewer coordinates than asked.
MISS = 2.1e-6


def miss_chance(percent: float, matches: int, coordinates: int = COORDINATES) -> float:
    """Binomial chance that fewer than ``matches`` of ``coordinates`` agree at similarity ``percent``."""
    p = percent / 100
    return sum(math.comb(coordinates, k) * p**k * (1 - p) ** (coordinates - k) for k in range(matches))


def matches_for(percent: int) -> int:
    """Agreeing coordinates a candidate needs; raises ValueError where 48 coordinates miss too many pairs.

    Below 24 percent even one agreeing coordinate misses more than ``MISS`` of the pairs.
    """
    matches = next((m for least, m in MATCHES if percent >= least), 1)
    if not 0 <= percent <= 100 or miss_chance(percent, matches) > MISS:
        raise ValueError(f"{COORDINATES} coordinates cannot find pairs of {percent} percent with a miss chance"
                         f" below {MISS}")
    return matches


def _kept(frame: DataFrame, name: str, files: int) -> DataFrame:
    """The frame stored by as many tasks, and so in as many files; ``files`` grows with the documents."""
    return keep(frame.coalesce(files), name)


def _sets(texts: list[str], size: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, one after another and sorted within the text, and how many each has."""
    words = Words([b" ".join(t.encode().translate(_LOWER).split()) for t in texts], hasher)
    n = words.stop - words.start
    number = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), number)
    first = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + np.repeat(words.start, number)
    last = np.minimum(first + size, np.repeat(words.stop, number))
    shingle = hasher.stretches(words.hash, first, last)
    order = np.lexsort((shingle, text))
    shingle, text = shingle[order], text[order]
    new = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (text[1:] != text[:-1])])[: len(text)]
    return shingle[new], np.bincount(text[new], minlength=len(n))


def _signatures(shingle: np.ndarray, number: np.ndarray) -> np.ndarray:
    """A row of 32-bit minima for each set that is not empty."""
    starts = (np.cumsum(number) - number)[number > 0]
    out = np.empty((len(starts), COORDINATES), dtype=np.uint32)
    for i, seed in enumerate(_SEEDS):
        x = shingle * seed
        out[:, i] = np.minimum.reduceat((x ^ (x >> np.uint64(29))) * seed, starts) >> np.uint64(32)
    return out


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (digest of the set) and signature; the last two null for empty sets."""
    schema = "doc_id long, text_key long, n_shingles long, set_key binary, signature binary"

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hasher = Hasher()
        for batch in batches:
            done = 0
            for group in groups_of(texts_of(batch.column(2)), *TOGETHER):
                shingle, number = _sets(group, size, hasher)
                keys, signatures = [None] * len(group), [None] * len(group)
                full = np.flatnonzero(number).tolist()
                if full:
                    rows, raw = _signatures(shingle, number), shingle.tobytes()
                    ends = (8 * np.cumsum(number)).tolist()
                    for j, i in enumerate(full):
                        keys[i] = hashlib.md5(raw[ends[i] - 8 * int(number[i]): ends[i]]).digest()
                        signatures[i] = rows[j].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(group)), batch.column(1).slice(done, len(group)),
                     pa.array(number, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
                    names=["doc_id", "text_key", "n_shingles", "set_key", "signature"])
                done += len(group)

    return docs.select("doc_id", F.xxhash64(text_of()).alias("text_key"), "text").mapInArrow(signed, schema)


def _postings(classes: DataFrame) -> DataFrame:
    """node and item, one row for each coordinate of each class; items tell coordinate and value."""

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.arange(COORDINATES, dtype=np.int64) << 32
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)
            node = np.repeat(batch.column(0).to_numpy(), COORDINATES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array((values.astype(np.int64) | bits).ravel())], names=["node", "item"])

    return classes.select("node", "signature").mapInArrow(posted, "node long, item long")


def _agreeing(pairs: DataFrame, classes: DataFrame, percent: int, matches: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity and whose signatures agree in enough coordinates."""
    sides = [classes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"),
                            F.col("signature").alias(f"s_{s}")) for s in "ab"]
    joined = pairs.join(sides[0], "a").join(sides[1], "b").where(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b", "s_a", "s_b")

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint32)
                        .reshape(-1, COORDINATES) for i in (2, 3))
                yield batch.filter(pa.array((x == y).sum(axis=1) >= matches)).select(["a", "b"])

    return joined.mapInArrow(agreeing, "a long, b long")


def _full_sets(
    nodes: DataFrame, docs: DataFrame, classes: DataFrame, size: int, name: str, files: int
) -> DataFrame:
    """node and ``shingles``, its full set as sorted 64-bit numbers, made anew from one text of each class."""
    wanted = _kept(nodes.join(classes, "node").select("node", "rep_id", "rep_key"), f"{name}-wanted", files)
    if wanted.limit(KEYS + 1).count() <= KEYS:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", F.xxhash64(text_of()).alias("text_key"), "text").join(
        wanted, (F.col("text_key") == F.col("rep_key")) & F.col("doc_id").eqNullSafe(F.col("rep_id")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hasher = Hasher()
        for batch in batches:
            done = 0
            for group in groups_of(texts_of(batch.column(1)), *TOGETHER):
                shingle, number = _sets(group, size, hasher)
                ends = (8 * np.cumsum(number)).tolist()
                raw = shingle.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(group)),
                     pa.array([raw[e - 8 * int(n): e] for e, n in zip(ends, number, strict=True)], pa.binary())],
                    names=["node", "shingles"])
                done += len(group)

    # A row that repeats id and text makes the same set again; one of them is enough.
    made = texts.select("node", "text").mapInArrow(sets, "node long, shingles binary")
    return _kept(made.groupBy("node").agg(F.first("shingles").alias("shingles")), f"{name}-sets", files)


def _confirmed(pairs: DataFrame, made: DataFrame, percent: int, name: str, files: int) -> DataFrame:
    """The pairs whose full shingle sets, given in ``made``, are similar enough."""
    joined = pairs.join(made.withColumnsRenamed({"node": "a", "shingles": "s_a"}), "a").join(
        made.withColumnsRenamed({"node": "b", "shingles": "s_b"}), "b").select("a", "b", "s_a", "s_b")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_py(), dtype=np.uint64) for c in (2, 3))
                both = len(x) + len(y) - len(np.union1d(x, y))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    return _kept(joined.mapInArrow(similar, "a long, b long"), f"{name}-links", files)


def _opened(sets: DataFrame, column: str, more: str = "") -> DataFrame:
    """A row for each number in ``column``, named item, with node and the columns ``more`` (all long)."""
    names = ["node", *more.split()]

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(len(names)).to_pylist()
            times = [len(x) // 8 for x in found]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.repeat(batch.column(i).to_numpy(), times)) for i in range(len(names))),
                 pa.array(np.frombuffer(b"".join(found), dtype=np.int64))], names=[*names, "item"])

    return sets.select(*names, column).mapInArrow(opened, "".join(f"{n} long, " for n in names) + "item long")


def _differences(members: DataFrame, sets: DataFrame, percent: int, files: int) -> DataFrame:
    """Members of groups with ``differences``, the shingles that just one of their set and their group's centre has.

    The centre of a group of LARGE members or more is what more than half of them have; smaller groups have
    an empty one. Also ``excess``, (100 + percent) * number of differences - (100 - percent) * n_shingles: two
    members are similar enough just if the differences both have, 2 * (100 + percent) times, come up to the sum
    of their excesses.
    """
    large = members.groupBy("grp").agg(F.count("*").alias("members")).where(F.col("members") >= LARGE)
    each = _opened(members.join(large, "grp").join(sets, "node"), "shingles", "grp")
    common = each.groupBy("grp", "item").agg(F.count("*").alias("n")).join(large, "grp").where("2 * n > members")
    # No centre has more than twice the shingles of its members' average set.
    centres = _kept(common.groupBy("grp").agg(F.array_sort(F.collect_list("item")).alias("centre")), "centres", files)
    joined = members.join(sets, "node").join(centres, "grp", "left").select(
        "node", "root", "grp", "n_shingles", "shingles", "centre")

    def differing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for i in range(batch.num_rows):
                own = batch.column(4)[i].as_py()
                if batch.column(5)[i].is_valid:
                    own = np.setxor1d(np.frombuffer(own, dtype=np.int64), batch.column(5)[i].values.to_numpy(),
                                      assume_unique=True).tobytes()
                found.append(own)
                sizes.append(len(own) // 8)
            excess = (100 + percent) * np.array(sizes, dtype=np.int64) - (100 - percent) * batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(excess, pa.int64()),
                 pa.array(found, pa.binary())], names=["node", "root", "grp", "size", "excess", "differences"])

    return _kept(joined.mapInArrow(
        differing, "node long, root long, grp long, size long, excess long, differences binary"), "differences", files)


def _apart(placed: DataFrame, files: int) -> DataFrame:
    """Members of the lists in which more than one component is left."""
    apart = placed.groupBy("item").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return _kept(placed.join(apart.select("item"), "item"), "placed", files)


def _last_pairs(placed: DataFrame, sets: DataFrame, classes: DataFrame, percent: int, files: int) -> DataFrame:
    """Pairs (a, b) of different components among which is every link still missing between members of one list.

    Lists with members in common make a group. Two members of a group are similar enough just if they have
    enough differences from its centre in common (:func:`_differences`). Of those that need none, all are linked
    with the member of least excess. Of the others, the rarest differences are merged: two members that need
    ``o`` in common share one that is among the first ``size - o + 1`` of both.
    """
    each = _opened(sets, "shingles")
    shared = each.groupBy("item").agg(F.count("*").alias("n")).where("n > 1").select("item")
    able = each.join(shared, "item").groupBy("node").agg(F.count("*").alias("common")).join(
        classes.select("node", "n_shingles"), "node").where(100 * F.col("common") >= percent * F.col("n_shingles"))
    placed = _apart(placed.join(_kept(able.select("node", "n_shingles"), "able", files), "node"), files)
    groups = components(placed.select(F.col("hub").alias("a"), F.col("node").alias("b")), "groups", files)
    members = _kept(placed.select("node", "root", "n_shingles").distinct().join(
        groups.withColumnRenamed("root", "grp"), "node"), "members", files)
    found = _differences(members, sets, percent, files)

    best = found.groupBy("grp").agg(F.min(F.struct("excess", "node", "root")).alias("best"))
    best = best.select("grp", F.col("best.excess").alias("least"), F.col("best.node").alias("a"),
                       F.col("best.root").alias("best_root"))
    found = _kept(found.join(best, "grp").withColumn("near", F.col("excess") + F.col("least") <= 0), "found", files)
    near = found.where("near and root <> best_root").select("a", F.col("node").alias("b"))

    # Pairs of two that are near their centre are settled; the others' excesses sum up to more than 0.
    least = found.groupBy("grp").agg(F.min(F.when(~F.col("near"), F.col("excess"))).alias("least_far"))
    step = 2 * (100 + percent)
    items = _opened(found, "differences", "grp")
    often = items.groupBy("grp", "item").agg(F.count("*").alias("n")).where("n > 1")
    ranked = items.join(often, ["grp", "item"]).groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("n", "item"))).alias("items"))
    ranked = found.drop("a", "best_root", "differences").join(least.where("least_far is not null"), "grp").join(ranked, "node")
    # Differences that no other member has come first and are not sent.
    alone = F.col("size") - F.size("items")
    other = F.when(F.col("near"), F.col("least_far")).otherwise(F.col("least"))
    first = F.greatest(F.lit(0), F.col("size") - F.ceil((F.col("excess") + other) / step) + 1 - alone).cast("int")
    sent = _kept(ranked.where(first > 0).select(
        "node", "root", "grp", "near", "size", "excess", alone.alias("alone"),
        F.posexplode(F.slice("items", F.lit(1), first)).alias("place", "i")).select(
        "node", "root", "grp", "near", "excess", "size", F.col("i.item").alias("item"),
        (F.col("alone") + F.col("place") + 1).alias("place")), "sent", files)
    a, b = (sent.select("grp", "item", *[F.col(c).alias(f"{s}_{c}") for c in (
        "node", "root", "near", "excess", "size", "place")]) for s in "ab")
    need = F.ceil((F.col("a_excess") + F.col("b_excess")) / step)
    far = a.where("not a_near").join(b, ["grp", "item"]).where(
        (F.col("a_root") != F.col("b_root")) & (F.col("b_near") | (F.col("a_node") < F.col("b_node")))
        & (need <= F.col("a_size") - F.col("a_place") + 1) & (need <= F.col("b_size") - F.col("b_place") + 1))
    return near.union(far.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))


def near_components(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component (any number, null if alone), component_id.

    component_id is the smallest doc_id of the documents reachable over links, its own included.
    """
    matches = matches_for(percent)
    signed = keep(_signed(docs, size), "signed")
    files = max(docs.sparkSession.sparkContext.defaultParallelism, -(-signed.count() // A_FILE))
    known = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = signed.where("set_key is not null").groupBy("set_key").agg(
        F.min(known).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    classes = _kept(classes.select(
        F.monotonically_increasing_id().alias("node"), "set_key", "n_shingles", "signature",
        F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key")), "classes", files)

    # Only pairs that two classes share are merged; what a class has alone still counts in its prefix.
    posted = _postings(classes)
    shared = posted.groupBy("item").agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1")
    items = F.array_sort(F.collect_list(F.struct("n", "item", "hub")))
    lists = posted.join(shared, "item").groupBy("node").agg(items.alias("items"))
    prefix = F.size("items") - (matches - 1)
    lists = _kept(lists.where(prefix > 0).select(
        "node", F.inline(F.slice("items", F.lit(1), prefix))), "lists", files)
    first = lists.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    agreed = _kept(_agreeing(first, classes, percent, matches), "agreed", files)

    def sets_of(pairs: DataFrame, name: str) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        return _full_sets(nodes, docs, classes, size, name, files)

    links = _confirmed(agreed, sets_of(agreed, "first"), percent, "first", files)
    roots = components(links, "first", files)

    def still_apart(roots: DataFrame) -> DataFrame:
        return _apart(lists.select("node", "item", "hub").join(roots, "node", "left").select(
            "node", "item", "hub", F.coalesce("root", "node").alias("root")), files)

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def linked(more: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
        links = _kept(links.union(more), "links", files)
        return links, components(links, "all", files)

    for turn in range(HUB_ROUNDS):
        placed = still_apart(roots)
        drawn = placed.groupBy("item").agg(F.min(F.struct(
            F.xxhash64(F.lit(turn), "item", "node").alias("draw"), "node", "root")).alias("h")).select(
            "item", F.col("h.node").alias("b"), F.col("h.root").alias("root_b"))
        pairs = placed.join(drawn, "item").where("root <> root_b").select(F.col("node").alias("a"), "b")
        agreed = _kept(_agreeing(ordered(pairs), classes, percent, matches), "agreed", files)
        if agreed.limit(1).count():
            links, roots = linked(_confirmed(agreed, sets_of(agreed, "more"), percent, "more", files), links)

    placed = still_apart(roots)
    if placed.limit(1).count():
        sets = _full_sets(placed.select("node").distinct(), docs, classes, size, "last", files)
        pairs = _kept(ordered(_last_pairs(placed, sets, classes, percent, files)), "pairs", files)
        links, roots = linked(_confirmed(pairs, sets, percent, "last", files), links)

    named = signed.join(classes.select("set_key", "node"), "set_key", "left").join(roots, "node", "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("root", "node").alias("component"))
    smallest = _kept(named.where("component is not null").groupBy("component").agg(
        F.min("doc_id").alias("component_id")), "smallest", files)
    return named.join(smallest, "component", "left").select(
        "doc_id", "text_key", "n_shingles", "component",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group, that with the smallest doc_id, and all that have no near copy; columns as they are."""
    found = near_components(docs, size, percent)
    known = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    best = found.where("component is not null").groupBy("component").agg(F.min(known).alias("best"))
    best = keep(best.select(F.col("best.doc_id").alias("_id"), F.col("best.text_key").alias("_key"), "component"), "best")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_d"),
                        F.xxhash64(text_of()).alias("_k"), (F.length(F.regexp_replace(
                            text_of(), r"[\x20\x09-\x0D]+", "")) == 0).alias("_empty"))
    joined = whole.join(best, (F.col("_k") == F.col("_key")) & F.col("_d").eqNullSafe(F.col("_id")), "left")
    stay = joined.where("_empty or component is not null")
    repeated = docs.groupBy("doc_id", F.xxhash64(text_of())).count().where("count > 1").limit(1).count()
    if repeated:
        return stay.where("_empty").select("_row.*").union(
            stay.where("not _empty").groupBy("component").agg(F.first("_row").alias("_row")).select("_row.*"))
    return stay.select("_row.*")
