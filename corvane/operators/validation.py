"""Quality report of merged rows: review flags, artefacts, manifests, duplicate texts.

artefacts is a listing (path) of what exists; a null or empty path does not exist. Rows delivered twice are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as X
from ..functions.barrier import first_by_key, once, side_by_side
from ..functions.text import clean, filled, missing_as_empty
from .durable import durable

ARTEFACTS = ("markdown_path", "agentic_json_path", "raw_docling_dir", "visual_manifest_path")
DESCRIPTIVE = "variant_id disease_class_id clinical_doc_group_id specialty disease_path doc_type source_path source_format extraction_source extraction_method language_hint".split()


def validation_text(rows: DataFrame) -> DataFrame:
    """rows with `_text` and its source: the cleaned column where it is filled, else the raw one."""
    if "clean_text" in rows.columns:
        chosen = filled(F.col("clean_text"))
        return rows.withColumns({"_text": F.coalesce(chosen, missing_as_empty(F.col("raw_text"))), "validation_text_source": F.when(chosen.isNotNull(), "clean_text").otherwise("raw_text")})
    return rows.withColumns({"_text": missing_as_empty(F.col("raw_text")), "validation_text_source": F.lit("raw_text")})


def with_artefacts(rows: DataFrame, artefacts: DataFrame) -> DataFrame:
    """rows with a boolean has_<column> for each artefact column. The paths of all columns are looked up in one join, from a written
    table of slim rows, and come back as a set of column numbers."""
    listed = artefacts.filter("path <> ''").select(F.col("path").alias("_p")).distinct()
    rows = durable(rows.withColumn("_uid", F.monotonically_increasing_id()))  # the number of a row must not be made anew
    named = rows.select("_uid", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(c).alias("p")) for k, c in enumerate(ARTEFACTS)))).alias("a")).filter("a.p <> ''").select("_uid", "a.k", F.col("a.p").alias("_p"))
    there = named.join(listed, "_p", "left_semi").groupBy("_uid").agg(F.collect_set("k").alias("_there"))
    rows = rows.join(there, "_uid", "left")
    return rows.withColumns({f"has_{c}": F.coalesce(F.array_contains("_there", k), F.lit(False)) for k, c in enumerate(ARTEFACTS)}).drop("_uid", "_there")


def manifest_facts(manifest: DataFrame, artefacts: DataFrame | None = None) -> DataFrame:
    """(variant_id, manifest_rows, missing_crops)."""
    m = manifest.select("variant_id", "crop_path")
    if artefacts is not None:
        listed = artefacts.filter("path <> ''").select(F.col("path").alias("_p"), F.lit(True).alias("_is")).distinct()
        m = m.join(listed, m["crop_path"] == listed["_p"], "left")
        lost = F.count_if(F.col("_is").isNull())
    else:
        lost = F.count_if(missing_as_empty(F.col("crop_path")) == "")
    return m.groupBy("variant_id").agg(F.count(F.lit(1)).alias("manifest_rows"), lost.alias("missing_crops"))


def review_flags(min_chars: int) -> Column:
    """Flags in their order, each once, of rows as text_facts and with_artefacts leave them."""
    n, language, pending = F.col("_n"), F.col("_lang"), F.coalesce("pending_visual_count", F.lit(0))
    flag = lambda cond, name: F.when(cond, F.lit(name))
    manifest = F.col("has_visual_manifest_path")
    own = X.compact(
        flag(~F.coalesce(F.col("source_format") == "pdf", F.lit(False)), "non_pdf_row_in_pdf_only_validation"),
        flag(n < min_chars, "needs_review_char_count_below_min"),
        flag(F.size("_codes") == 0, "needs_review_no_icd_codes_detected"),
        flag(F.col("_bad") > 0, "needs_review_bad_text_patterns"),
        flag((n > R.LOW_CHARS) & (F.col("letter_ratio") < R.LETTER_RATIO), "needs_review_low_letter_ratio"),
        flag((F.coalesce("final_language", F.lit("")) == "unknown") | (language == "unknown"), "needs_review_unknown_language"),
        flag(~F.col("has_markdown_path"), "missing_markdown_output"),
        flag(~F.col("has_agentic_json_path"), "missing_agentic_json_output"),
        flag(~F.col("has_raw_docling_dir"), "missing_raw_docling_dir"),
        flag(pending > 0, "pending_visual_assets"),
        flag((pending > 0) & ~manifest, "missing_visual_manifest"),
        flag((pending > 0) & manifest & (F.coalesce("manifest_rows", F.lit(0)) != pending), "visual_manifest_count_mismatch"),
        flag((pending > 0) & manifest & (F.coalesce("missing_crops", F.lit(0)) > 0), "missing_visual_crop_files"),
        flag(F.coalesce("docling_batch_failed_count", F.lit(0)) > 0, "docling_batch_failures"),
        flag(F.coalesce("page_count", F.lit(0)) <= 0, "missing_page_count"),
    )
    return F.array_distinct(F.concat(F.coalesce("quality_flags", F.array().cast("array<string>")), "_quality", own))


def text_facts(rows: DataFrame) -> DataFrame:
    """rows with all that follows from the text, and without the texts: later joins move slim rows only."""
    text = F.col("_t")
    rows = once(validation_text(rows), _t=clean(F.col("_text")))
    rows = once(rows, _lang=F.coalesce(filled(F.col("detected_language")), X.language_by_markers(text)), _codes=X.codes(text), _bad=X.bad_patterns(text))
    rows = once(rows, _quality=X.quality_flags(text, F.col("_lang")))
    rows = rows.withColumns({c: X.ratio(text, p) for c, p in X.RATIOS.items()} | {"_n": F.length(text)})
    return rows.drop("_t", "_text", "raw_text", "clean_text")


def quality_report(rows: DataFrame, artefacts: DataFrame, manifest: DataFrame, min_chars: int, *keep: str) -> DataFrame:
    """The QA row of every merged row."""
    rows = with_artefacts(text_facts(rows), artefacts).join(manifest_facts(manifest, artefacts), "variant_id", "left")
    rows = once(rows, _flags=review_flags(min_chars))
    lang, codes, flags = F.col("_lang"), F.col("_codes"), F.col("_flags")
    return rows.select(
        *keep, *DESCRIPTIVE, lang.alias("detected_language"), F.coalesce(filled(F.col("final_language")), lang).alias("final_language"), "validation_text_source", F.col("_n").alias("char_count"), "page_count",
        *X.RATIOS, F.size(codes).alias("icd_code_count"), F.array_join(F.slice(codes, 1, R.SHOWN_CODES), ", ").alias("icd_codes_detected"), F.col("_bad").alias("bad_pattern_count"),
        "pending_visual_count", "visual_asset_count", "docling_batch_count", "docling_batch_failed_count", *ARTEFACTS, F.size(flags).alias("review_flag_count"), F.array_join(flags, "; ").alias("review_flags"), (F.size(flags) > 0).alias("needs_review"),
    )


def visual_review(rows: DataFrame, manifest: DataFrame, artefacts: DataFrame) -> DataFrame:
    """A row for each item of the manifests, as `blocks.visual_manifest` gives them, with whether its crop exists."""
    listed = artefacts.filter("path <> ''").select(F.col("path").alias("_p"), F.lit(True).alias("_is")).distinct()
    items = manifest.join(rows.select("variant_id", "source_path").distinct(), "variant_id")
    return items.join(listed, items["crop_path"] == listed["_p"], "left").select(
        "variant_id", "source_path", "asset_id", "page", "order", "suggested_type", "crop_path", F.coalesce("_is", F.lit(False)).alias("crop_exists"), "status", "caption"
    )


def duplicate_texts(rows: DataFrame, *keep: str) -> DataFrame:
    """Rows whose long text is that of another row, with the size of their group.

    Group sizes are counted by partial aggregation, and only hashes of two rows or more are joined back, so a text that a third of
    all rows share never meets in one task.
    """
    rows = validation_text(rows).filter(F.length("_text") >= R.DUPLICATE_LEAST).withColumn("text_hash", X.text_hash(F.col("_text")))
    slim = rows.select("text_hash", *keep, "variant_id", "source_path", "specialty", "disease_path", "doc_type", "final_language", "char_count")
    groups = slim.groupBy("text_hash").agg(F.count(F.lit(1)).alias("duplicate_group_size")).filter("duplicate_group_size > 1")
    return slim.join(groups, "text_hash")


def flag_ranking(report: DataFrame, order: str = "variant_id") -> DataFrame:
    """(flag, n) of the joined flags, most frequent first; ties in the order of their first row and place there."""
    flags = report.select(F.struct(F.col(order).alias("o"), F.lit(0).alias("p")).alias("_at"), F.posexplode(F.split("review_flags", "; ")).alias("p", "flag")).filter("flag <> ''")
    ranked = flags.groupBy("flag").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_at.o", "p")).alias("_first"))
    return ranked.orderBy(F.desc("n"), "_first").select("flag", "n")


def report_summary(report: DataFrame, visuals: DataFrame, duplicates: DataFrame) -> DataFrame:
    """One row: totals of a validation run."""
    count = F.count(F.lit(1))
    rows = report.agg(count.alias("total_rows"), F.count_if("needs_review").alias("needs_review_total"), F.coalesce(F.sum("char_count"), F.lit(0)).cast("bigint").alias("total_chars"))
    return side_by_side(rows, visuals.agg(count.alias("visual_asset_total")), duplicates.agg(F.countDistinct("text_hash").alias("duplicate_groups")))


def best_candidate(candidates: DataFrame) -> DataFrame:
    """The longest readable candidate of each variant; ties go to the method of the lower rank. `stats` has each length, -1 for a failure; a method listed twice counts once, with its longest text."""
    n = F.when(F.col("ok"), F.length(missing_as_empty(F.col("text")))).otherwise(-1)
    agg = candidates.withColumn("_n", n).groupBy("variant_id").agg(
        F.max(F.when(F.col("ok"), F.struct(F.col("_n"), (-F.col("method_rank")).alias("r"), "method", "text"))).alias("b"), F.array_sort(F.collect_set(F.when(F.col("method").isNotNull(), F.struct(F.col("method").alias("key"), (-F.col("_n")).alias("m"))))).alias("_e")
    )
    return agg.select("variant_id", F.col("b.method").alias("method"), F.col("b.text").alias("text"), F.col("b._n").alias("char_count"), F.map_from_entries(F.transform(first_by_key(F.col("_e")), lambda x: F.struct(x["key"], -x["m"]))).alias("stats"))
