"""What a report call returns: named lazy frames with a title and criteria."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# One row per committed write of a report folder.
MANIFEST = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("criteria", T.StringType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("committed_at", T.LongType()),
    T.StructField("frames", T.ArrayType(T.StringType())),
])


def as_on(date1: dt.date, date2: dt.date) -> str:
    return f"@As On Dated : {date1:%m-%d-%Y} - {date2:%m-%d-%Y}"


def date_range(date1: dt.date, date2: dt.date) -> str:
    return f"Date Range From : {date1:%m-%d-%Y} - {date2:%m-%d-%Y}"


@dataclass(frozen=True)
class Report:
    name: str
    criteria: str
    frames: Mapping[str, DataFrame]

    def __getitem__(self, frame: str) -> DataFrame:
        return self.frames[frame]

    def write(self, folder: str, mode: str = "error") -> str:
        """Commit the report to ``folder``; returns the attempt's name.

        Each frame is written as Parquet under ``folder/<attempt>/<frame>``,
        a folder no reader looks at until a manifest names it.  The manifest
        (name, criteria, attempt, frames in order) is written last, as one
        JSON row under ``folder/_manifest/<attempt>``; Spark's commit makes it
        appear whole or not at all.  An interrupted write therefore leaves no
        report, or the one committed before.  ``mode`` "error" refuses a
        folder that holds a committed report; "overwrite" commits a new
        attempt that readers take instead (earlier attempts stay on disk).
        A report without frames commits a manifest with an empty list.
        """
        if mode not in ("error", "overwrite"):
            raise ValueError(f"mode must be 'error' or 'overwrite', not {mode!r}")
        root = folder.rstrip("/")
        spark = SparkSession.active()
        if mode == "error" and _manifests(spark, root):
            raise FileExistsError(f"{root} already holds a committed report")
        attempt = f"attempt-{uuid.uuid4().hex}"
        for frame, df in self.frames.items():
            df.write.mode("error").parquet(f"{root}/{attempt}/{frame}")
        manifest = [(self.name, self.criteria, attempt, time.time_ns(), list(self.frames))]
        spark.createDataFrame(manifest, MANIFEST).coalesce(1).write.mode("error").json(f"{root}/_manifest/{attempt}")
        return attempt


def _manifests(spark: SparkSession, root: str) -> list:
    """The committed manifests of a folder (one small row per write)."""
    try:
        found = spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").json(f"{root}/_manifest")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition() or error):
            return []
        raise
    return found.collect()


def read_report(spark: SparkSession, folder: str) -> Report:
    """The report last committed to ``folder`` by ``Report.write``.

    Frames are read lazily from the attempt the newest manifest names
    (ties of the clock: the larger attempt name).  Raises
    ``FileNotFoundError`` where no write was committed.
    """
    root = folder.rstrip("/")
    committed = _manifests(spark, root)
    if not committed:
        raise FileNotFoundError(f"{root} holds no committed report")
    last = max(committed, key=lambda row: (row["committed_at"], row["attempt"]))
    frames = {frame: spark.read.parquet(f"{root}/{last['attempt']}/{frame}") for frame in last["frames"]}
    return Report(last["name"], last["criteria"], frames)
