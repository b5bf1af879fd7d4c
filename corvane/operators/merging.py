"""Merged rows of the extraction results.

Texts are cleaned once; missing languages and codes are taken from the text; empty texts, zeros and empty arrays count as
missing where a value is chosen. Rows delivered twice stay two rows unless `latest` is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.barrier import once
from ..functions.text import clean, filled

PASSED = "variant_id disease_class_id clinical_doc_group_id specialty disease_path doc_type".split()
PATHS = "markdown_path agentic_json_path raw_docling_dir visual_manifest_path visual_assets_dir".split()
COUNTS = "pending_visual_count visual_asset_count docling_batch_count docling_batch_failed_count page_count".split()


def latest(rows: DataFrame, key: str = "variant_id", *order: str) -> DataFrame:
    """The last delivery of each key (nulls of the order come first), by partial aggregation."""
    rest = [c for c in rows.columns if c != key]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return last.select(*(F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in rows.columns))


def merged(parsed: DataFrame, *keep: str) -> DataFrame:
    """Canonical rows; `keep` names further columns that are passed through."""
    text = F.col("_text")
    rows = once(once(parsed, _text=clean(F.col("raw_text"))), _lang=F.coalesce(filled(F.col("detected_language")), X.language_by_markers(F.col("_text"))))
    lang = F.col("_lang")
    rows = once(rows, _codes=F.when(F.size("icd_codes_detected") > 0, F.col("icd_codes_detected")).otherwise(X.codes(text)))
    flags = F.concat(
        F.coalesce("quality_flags", F.array().cast("array<string>")), X.quality_flags(text, lang),
        X.compact(F.when(F.coalesce("pending_visual_count", F.lit(0)) > 0, F.lit("pending_visual_assets")), F.when(F.coalesce("docling_batch_failed_count", F.lit(0)) > 0, F.lit("docling_batch_errors"))),
    )
    codes = F.col("_codes")
    return rows.select(
        *keep, *PASSED, F.coalesce(*(filled(F.col(c)) for c in ("source_path", "original_source_path", "ocr_input_path"))).alias("source_path"),
        F.lit("pdf").alias("source_format"), F.lit(".pdf").alias("source_extension"), "filename", "size_kb", F.coalesce("language_hint", F.lit("unknown")).alias("language_hint"),
        lang.alias("detected_language"), F.when(lang != "unknown", lang).otherwise(F.coalesce("language_hint", F.lit("unknown"))).alias("final_language"),
        F.lit("pdf_agentic_docling_surya").alias("extraction_source"), "extraction_method", F.length(text).alias("char_count"), F.array_sort(F.array_distinct(flags)).alias("quality_flags"),
        *PATHS, *(F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS), codes.alias("icd_codes_detected"), F.size(codes).alias("icd_code_count"),
        "elapsed_seconds", "ocr_reason", "ocr_input_path", text.alias("raw_text"),
    )


def missing(rows: DataFrame, min_chars: int) -> DataFrame:
    """Rows with too little text."""
    return rows.filter(F.col("char_count") < min_chars).select("variant_id", "source_path", F.lit("low_char_count").alias("reason"), "char_count")


GROUP_FIELDS = "variant_id source_path source_format language_hint detected_language final_language extraction_source extraction_method char_count quality_flags icd_codes_detected markdown_path agentic_json_path raw_docling_dir visual_manifest_path pending_visual_count".split()


def grouped(rows: DataFrame, order: str) -> DataFrame:
    """One row a document with its variants by language; other columns come from the last row in `order`."""
    key = ["disease_class_id", "doc_type"]
    lang = F.coalesce(filled(F.col("final_language")), F.lit("unknown"))
    per = rows.withColumn("_l", lang).groupBy(*key, "_l").agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("seq"), *GROUP_FIELDS))).alias("rows"), F.max(F.struct(F.col(order).alias("seq"), "clinical_doc_group_id", "specialty", "disease_path")).alias("g")
    )
    out = per.groupBy(*key).agg(F.max("g").alias("g"), F.sort_array(F.collect_list("_l")).alias("available_languages"), F.map_from_entries(F.collect_list(F.struct("_l", "rows"))).alias("variants"))
    return out.select("disease_class_id", "g.clinical_doc_group_id", "g.specialty", "g.disease_path", "doc_type", "available_languages", "variants")


def flag_counts(rows: DataFrame, column: str = "quality_flags") -> DataFrame:
    return rows.select(F.explode(column).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def summary(rows: DataFrame, min_chars: int) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(0))), F.lit(0)).alias(f"total_{c}")
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("char_count") >= min_chars).alias("usable_rows"), total("char_count"), total("pending_visual_count"), F.count_if(F.col("docling_batch_failed_count") > 0).alias("rows_with_failed_batches"),
        F.round(F.try_divide(F.sum("elapsed_seconds"), F.count("elapsed_seconds")), 3).alias("avg_seconds"),
    )
