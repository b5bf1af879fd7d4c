"""Incremental runs: new files of a tree are taken once, with the place kept in a checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import paths as P

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """A stream of (path, length) of the files below root."""
    raw = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return raw.select("path", "length", "modificationTime")


def registered(files: DataFrame, cfg: Settings) -> DataFrame:
    """Path features of a stream (or table) of supported files; stateless."""
    path = F.regexp_replace("path", "^file:/*(?=/)", "")
    rows = files.withColumn("path", path).filter(P.is_supported(F.col("path")))
    return rows.select(*(c.alias(n) for n, c in P.features(F.col("path"), F.col("length"), cfg).items()), "modificationTime").withColumns(P.group_ids())


def run_once(df: DataFrame, out: str, checkpoint: str) -> None:
    """Takes all that is new, writes it and ends."""
    df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def daily_counts(files: DataFrame, lateness: str = "7 days") -> DataFrame:
    """Files and kilobytes by day of change; later rows than the watermark allows are left out."""
    return files.withWatermark("modificationTime", lateness).groupBy(F.window("modificationTime", "1 day")).agg(F.count(F.lit(1)).alias("files"), F.sum(F.col("length") / 1024).alias("kb"))
