"""Helpers of several operators: words, shared files, running sums, connected components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.stored import keep, new_folder, shared_folder  # noqa: F401

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.filter(F.split(text, SPACE, -1), lambda w: w != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, also where ``use`` names it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, whatever folder they start in."""
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if top not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, top]))


def small(frame: DataFrame, most: int) -> bool:
    """Whether a stored frame has at most so many rows, so that it may be broadcast."""
    return frame.limit(most + 1).count() <= most


def stamped(
    frame: DataFrame, order: list[str], size: str, before: str, ranges: list[str | Column] | None = None
) -> DataFrame:
    """Rows dealt by ranges of ``order`` and sorted, with ``_part`` and in ``before`` the sum of ``size`` so far in it.

    ``ranges`` are shorter keys to deal by, in the same order. Nulls come first; equal keys get distinct,
    adjoining places. Store it before use, so that the sums belong to one dealing of the rows, and read
    it through :func:`settled`.
    """
    dealt = frame.repartitionByRange(*(ranges or order)).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    schema = T.StructType([*dealt.schema.fields, T.StructField(before, T.LongType())])
    place = dealt.columns.index(size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            if batch.num_rows:
                sizes = batch.column(place).cast(pa.int64())
                upto = pc.add(pc.cumulative_sum(sizes), total)
                yield pa.RecordBatch.from_arrays([*batch.columns, pc.subtract(upto, sizes)], names=schema.names)
                total = upto[-1].as_py()

    return dealt.mapInArrow(sums, schema)


def settled(stored: DataFrame, size: str, before: str) -> DataFrame:
    """Stored rows of :func:`stamped` with ``before`` counted from the first row of all; one total per task is fetched."""
    totals = stored.groupBy("_part").agg(F.max(F.col(before) + F.col(size)).alias("n")).orderBy("_part").collect()
    at, starts = 0, []
    for row in totals:
        starts.append((row["_part"], at))
        at += row["n"]
    offsets = stored.sparkSession.createDataFrame(starts, "_part int, _start long")
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(before, F.col(before) + F.col("_start")).drop("_part", "_start")
    )


def components(edges: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, root), root the smallest node; only nodes with an edge.

    Each round hooks every node to its smallest neighbour, jumps pointers to the roots and contracts
    the edges, so at least half of the nodes go in each round. Hot nodes are merged map-side.
    ``files`` bounds the tasks that store a step, and so its files; it must grow with the edges.
    """
    spark = edges.sparkSession

    def kept(frame: DataFrame, step: str) -> DataFrame:
        return keep(frame.coalesce(files) if files else frame, f"{name}-{step}")

    edges = kept(edges.select("a", "b").where("a <> b").distinct(), "edges")
    roots = None
    while edges.limit(1).count():
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("root"))
        hooks = kept(hooks, "hooks")
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("upper"))
            jumped = kept(hooks.join(up, "root", "left").select(
                "node", F.coalesce("upper", "root").alias("root"), (F.col("upper") < F.col("root")).alias("moved")),
                "jumped")
            moved = jumped.where("moved").limit(1).count()
            hooks = jumped.drop("moved")
            if not moved:
                break
        if roots is None:
            roots = hooks
        else:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("upper"))
            roots = kept(roots.join(up, "root", "left").select("node", F.coalesce("upper", "root").alias("root")),
                         "roots")
        to = hooks.select(F.col("node"), F.col("root"))
        edges = kept(
            edges.join(to.withColumnsRenamed({"node": "a", "root": "ra"}), "a")
            .join(to.withColumnsRenamed({"node": "b", "root": "rb"}), "b")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).where("a <> b").distinct(),
            "edges")
    return roots if roots is not None else spark.createDataFrame([], "node long, root long")
