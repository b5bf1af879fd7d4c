"""Readers with declared schemas. A missing path gives an empty table of its schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _or_empty(spark: SparkSession, read, schema: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of every file below root; contents are not read."""
    raw = _or_empty(spark, lambda: spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root), "path string, modificationTime timestamp, length bigint, content binary")
    return raw.select(F.regexp_replace("path", "^file:/*(?=/)", "").alias("path"), "length")


def contents(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, content) of every file below root."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return raw.select(F.regexp_replace("path", "^file:/*(?=/)", "").alias("path"), "length", "content")


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Rows of JSON lines; blank lines are none. A line that cannot be read ends the job where strict, and is dropped otherwise."""
    return _or_empty(spark, lambda: spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path), schema)


def broken_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """(path, n) of what json_lines or json_documents leave out: lines, or whole files, that are no JSON."""
    raw = _or_empty(spark, lambda: spark.read.option("wholetext", multi_line).text(path).select("value", F.col("_metadata.file_path").alias("path")), "value string, path string")
    bad = F.from_json("value", "_bad string", {"columnNameOfCorruptRecord": "_bad"})["_bad"]
    return raw.filter("trim(value) <> ''").filter(bad.isNotNull()).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


def json_documents(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """One row for each JSON file of a pattern; files that cannot be read are dropped (broken_json counts them)."""
    return _or_empty(spark, lambda: spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(pattern), schema)


def rebuilt_word(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """parsed_word from the files of each variant (<variant>.json), in the order of variants."""
    return json_documents(spark, f"{folder}/*.json", schema).orderBy("variant_id")


def rebuilt_docling(spark: SparkSession, folder: str, assets: str, schema: str, manifest_schema: str) -> tuple[DataFrame, DataFrame]:
    """(parsed_docling, visual_manifest) from <folder>/<variant>/parsed.json and <assets>/<variant>/visual_manifest.jsonl; manifests of
    variants without a record are left out."""
    rows = json_documents(spark, f"{folder}/*/parsed.json", schema).orderBy("variant_id")
    manifest = json_lines(spark, f"{assets}/*/visual_manifest.jsonl", manifest_schema)
    return rows, manifest.join(rows.select("variant_id").distinct(), "variant_id", "left_semi").select(*manifest.columns)


def first_filled(primary: DataFrame, other: DataFrame) -> DataFrame:
    """The first table, or the other where the first is empty."""
    return other if primary.isEmpty() else primary


def validation_source(spark: SparkSession, raw: str, cleaned: str, prefer_cleaned: bool = False) -> DataFrame:
    """The merged table at `raw`, or the cleaned one where it is preferred and exists."""
    if prefer_cleaned:
        try:
            return spark.read.parquet(cleaned)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    return spark.read.parquet(raw)


def csv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a CSV file with a header and an optional byte order mark, cast to the schema; values that do not fit are null."""
    types = [f.strip().split(" ", 1) for f in schema.split(",")]

    def read() -> DataFrame:
        raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        raw = raw.toDF(*(c.lstrip("﻿") for c in raw.columns))
        return raw.select(*((F.expr(f"try_cast(`{n}` as {t})") if n in raw.columns else F.lit(None).cast(t)).alias(n) for n, t in types))

    return _or_empty(spark, read, schema)


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores: a table of one or two files is dealt out, others are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df
