"""Mixing sources to target weights.

Sizes (words) are summed per source. The budget, a share of all sizes, is dealt out by weight; a
source's target stops at ``most`` times its size and the excess is dealt again among the others.
Target over size is the source's repetition rate: each document is taken floor(rate) times, and
once more with the fraction as probability, drawn from a hash of seed, id and text, so that reruns
agree. Sums per source are merged map-side; only the small source table is joined.

Null texts have no words; a null source is a source of its own, last in order; sources without
words have rate 0; equal rows draw alike; an empty table gives an empty result. Extra columns of
any name are kept by :func:`emit` and ignored by :func:`plan_mix`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import WORD, keep, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = 20260101


def source_rates(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                 most: float = MOST) -> DataFrame:
    """Rows (source, source_size, target, rate), one per source of ``sizes(source, size)``.

    Weights go to the sources by code point, null last, over and over. The windows see one row per
    source. A source is capped if the budget fills all sources to the level at which it is full.
    """
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(float(w)) for w in weights])
    table = table.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.get(listed, F.col("place") % len(weights)))
    everything = Window.partitionBy()
    full = F.col("source_size") * F.lit(most)
    by_level = Window.orderBy(full / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, 0)
    table = table.withColumns({
        "full": full, "budget": F.sum("source_size").over(everything) * F.lit(share),
        "full_upto": F.sum(full).over(by_level),
        "weight_after": F.sum("weight").over(everything) - F.sum("weight").over(by_level)})
    table = table.withColumn(
        "capped", F.col("full_upto") + F.col("full") / F.col("weight") * F.col("weight_after") <= F.col("budget"))
    spent = F.sum(F.when(F.col("capped"), F.col("full")).otherwise(0.0)).over(everything)
    left = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    dealt = (F.col("budget") - spent) * F.col("weight") / F.nullif(left, F.lit(0.0))
    target = F.when(F.col("capped"), F.col("full")).otherwise(F.least("full", dealt))
    return table.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("target") / F.col("source_size")))
        .otherwise(0.0))


def size_of() -> Column:
    """Words of the text."""
    return F.regexp_count(text_of(), F.lit(WORD)).cast("long")


def plan_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST,
             seed: int = SEED, row: Column | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies (and ``row`` as ``_row``)."""
    more = [] if row is None else [row.alias("_row")]
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", text_of()), F.lit(1 << 53)) / F.lit(float(1 << 53))
    read = docs.select("doc_id", "source", size_of().alias("size"), draw.alias("draw"), *more)
    rates = keep(source_rates(docs.select("source", size_of().alias("size")), weights, share, most), "rates")
    rates = rates.withColumnRenamed("source", "_source")
    joined = read.join(rates, F.col("source").eqNullSafe(F.col("_source")))
    copies = F.floor("rate") + (F.col("draw") < F.col("rate") - F.floor("rate")).cast("long")
    return joined.select("doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"),
                         *[F.col("_row") for _ in more])


def emit(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns as they are."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    planned = plan_mix(docs, row=whole, **how).where("copies > 0")
    return planned.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
