"""Exact de-duplication against a persistent index of digests.

The index is a table bucketed and sorted by SHA-256 digest, one row per text ever seen: digest,
keep_id, group_size. New documents are reduced to one row per digest, joined against the index by a
sort-merge anti-join that needs no shuffle of the index, and what is new is appended. Texts never
leave their rows; only ids and digests move. Only built-in functions run.

Null texts count as empty. Of equal texts in one batch the row with the largest doc_id stays; null
ids count as smallest. Rows that repeat id and text share the verdict of their group;
:func:`drop_copies` leaves one of them. A text that an earlier batch brought keeps that batch's
row. An empty batch appends nothing. Extra columns of any name are left alone.

Each index row carries the batch that brought it, so a batch that is run again (a job restarted after
its append) counts its own rows as new and gets the verdicts of its first run; nothing is appended twice.
A batch is named by the caller or, by default, by a fingerprint of its (doc_id, digest) rows: equal
batches share a name whatever their order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import keep, text_of

#: Groups of so many rows are joined by broadcast: of n rows at most n / HOT groups are so large, and at most
#: HOT_GROUPS of them are broadcast; beyond that all groups take the shuffled join.
HOT = 100_000
HOT_GROUPS = 200_000


class DigestIndex:
    """A bucketed digest table, created on first use and reopened by name and folder later."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = 64, folder: str | None = None):
        """``folder`` is where the table's files lie; the warehouse if not given."""
        self.spark, self.name, self.buckets = spark, name, buckets
        place = f" LOCATION '{folder}'" if folder else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest STRING, keep_id BIGINT, group_size BIGINT, batch STRING)"
            " USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS{place}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, groups: DataFrame, batch: str) -> None:
        """Appends the groups (digest, keep_id, group_size) that the index lacks, marked with ``batch``."""
        fresh = groups.hint("merge").join(self.rows(), "digest", "left_anti").withColumn("batch", F.lit(batch))
        (fresh.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the text's SHA-256 in lower-case hexadecimal."""
    return docs.select("doc_id", F.sha2(text_of(), 256).alias("digest"))


def batch_name(read: DataFrame) -> str:
    """A name for a batch of (doc_id, digest) rows: row count and an exact sum of 64-bit row hashes."""
    row = read.agg(F.count("*").alias("n"),
                   F.sum(F.xxhash64("doc_id", "digest").cast("decimal(38,0)")).alias("total")).first()
    return f"batch-{row['n']}-{row['total'] or 0}"


def ingest(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """Adds a batch to the index; one row per document of the batch.

    Columns: doc_id, keep_id and group_size of its text's row in the index, digest, and ``kept``.
    ``batch`` names the batch (default: :func:`batch_name` of its rows); rerunning a batch under the
    same name gives the same rows and leaves the index as it is.
    """
    read = keep(digests(docs), "digests")
    batch = batch or batch_name(read)
    groups = read.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    earlier = index.rows().where(F.col("batch") != batch).select("digest")
    seen = keep(groups.join(earlier, "digest", "left_semi"), "seen")
    index.add(groups, batch)
    found = index.rows()
    large = found.where(F.col("group_size") >= HOT)
    if large.limit(HOT_GROUPS + 1).count() <= HOT_GROUPS:
        joined = read.join(F.broadcast(large), "digest").unionByName(
            read.join(F.broadcast(large.select("digest")), "digest", "left_anti")
            .join(found.where(F.col("group_size") < HOT), "digest"))
    else:
        joined = read.join(found, "digest")
    if seen.limit(1).count():
        joined = joined.join(seen.select("digest", F.lit(True).alias("known")), "digest", "left")
        mine = F.col("known").isNull()
    else:
        mine = F.lit(True)
    return joined.select("doc_id", "keep_id", "group_size",
                         (mine & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "digest")


def new_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index under a name of its own."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", buckets)


def drop_copies(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """The documents of the batch that stay, one for each text that is new to the index; all columns as they are.

    Run twice on the same batch, it returns the same rows (see :func:`ingest`).
    """
    names = [f"`{c}`" for c in docs.columns]
    verdict = keep(ingest(docs, index, batch).where("kept").groupBy("digest", "doc_id").agg(F.count("*").alias("rows")), "kept")
    whole = docs.select(F.struct(*names).alias("_row"), F.col("doc_id").alias("_id"),
                        F.sha2(text_of(), 256).alias("_digest"))
    on = (F.col("_digest") == F.col("digest")) & F.col("_id").eqNullSafe(F.col("doc_id"))
    stay = whole.join(verdict, on, "left_semi")
    if verdict.where("rows > 1").limit(1).count():
        stay = stay.groupBy("_digest").agg(F.first("_row").alias("_row"))
    return stay.select("_row.*")
