"""The Word stage: rows of the registry, candidates of the extraction backends, one parsed row a variant, failures, summary.

Native readers compete first; the best of them and the structured conversion compete by length, ties to the native one. A variant
of which no reader gives a text is a failure row. Rows listed twice stay two rows. Null languages count as known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as X
from ..functions.barrier import first_by_key, once, side_by_side
from ..functions.text import clean, missing_as_empty

STRUCTURED = "docling"  # value of `source` and of flags for the structured conversion
PASSED = "source_path source_format language_hint".split()


def word_rows_of(registry: DataFrame, only_format: str | None = None, only_unknown: bool = False, start: int = 0, limit: int = 0) -> DataFrame:
    """The registry's Word rows, of one format or of unknown language only; start and limit take a part in the order of paths."""
    rows = registry.filter(F.lower("source_extension").isin(*R.WORD_EXTENSIONS))
    if only_format:
        rows = rows.filter(F.col("source_format") == only_format)
    if only_unknown:
        rows = rows.filter(F.coalesce("language_hint", F.lit("")) == "unknown")
    if start or limit:
        rows = rows.orderBy(missing_as_empty(F.col("source_path")), "variant_id").offset(start)
        rows = rows.limit(limit) if limit else rows
    return rows


def parsed_rows(rows: DataFrame, candidates: DataFrame, min_chars: int, *keep: str) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, failures) of rows (variant_id, source_path, source_format, language_hint) and candidates (variant_id, method,
    method_rank, source, text, ok, error)."""
    c = once(candidates.withColumn("ok", F.coalesce("ok", F.lit(False))), _t=F.when(F.col("ok"), clean(F.col("text"))))
    structured = F.coalesce(F.col("source") == STRUCTURED, F.lit(False))
    n = F.when(F.col("ok"), F.length("_t")).otherwise(-1)
    c = c.withColumns({"_n": n, "_s": structured})
    best = lambda cond: F.max(F.when(cond & F.col("ok"), F.struct("_n", (-F.col("method_rank")).alias("r"), "method", F.col("_t").alias("text"))))
    wrong = lambda cond: F.max(F.when(cond & ~F.col("ok"), F.coalesce("error", F.lit("failed"))))
    per = c.groupBy("variant_id").agg(
        best(~F.col("_s")).alias("n"), best(F.col("_s")).alias("d"), wrong(~F.col("_s")).alias("_ne"), wrong(F.col("_s")).alias("_de"),
        F.array_sort(F.collect_set(F.when(~F.col("_s") & F.col("method").isNotNull(), F.struct(F.col("method").alias("key"), (-F.col("_n")).alias("m"))))).alias("_stats"),
    )
    per = per.withColumn("extractor_stats", F.map_from_entries(F.transform(first_by_key(F.col("_stats")), lambda x: F.struct(x["key"], -x["m"])))).drop("_stats")
    length = lambda x: F.coalesce(F.col(f"{x}._n"), F.lit(0))
    per = per.withColumns({"native_char_count": length("n"), "docling_char_count": length("d")})
    native = (F.col("native_char_count") > 0) & (F.col("native_char_count") >= F.col("docling_char_count"))
    chosen = F.when(native, F.col("n")).when(F.col("docling_char_count") > 0, F.col("d"))
    per = per.withColumns({"_c": chosen, "extraction_source": F.when(native, "native").otherwise(STRUCTURED), "native_error": F.when(F.col("n").isNull(), F.col("_ne")), "docling_error": F.when(F.col("d").isNull(), F.col("_de"))})
    joined = rows.join(per, "variant_id", "left")
    out = once(joined.filter("_c is not null"), _lang=X.language_by_markers(F.col("_c.text")))
    text, low = F.col("_c.text"), F.col("_c._n") < min_chars
    flags = F.concat(X.quality_flags(text, F.col("_lang")), X.compact(F.when(low, F.lit("low_char_count")), F.when(F.col("native_error").isNotNull(), F.lit("native_extraction_error")), F.when(F.col("docling_error").isNotNull(), F.lit("docling_extraction_error"))))
    method = F.col("_c.method")
    parsed = out.select(
        *keep, "variant_id", *PASSED, F.col("_lang").alias("detected_language"), F.when(F.col("source_format") == "doc", F.concat(F.lit("doc_to_docx_"), method)).otherwise(method).alias("extraction_method"), "extraction_source",
        F.col("n.method").alias("native_method"), "native_char_count", "docling_char_count", "extractor_stats", "native_error", "docling_error", F.col("_c._n").alias("char_count"), F.array_distinct(flags).alias("quality_flags"),
        low.alias("needs_review"), F.when(low, F.lit("word_extraction_weak_low_char_count")).alias("review_reason"), F.lit(False).alias("needs_ocr"), F.lit(None).cast("string").alias("ocr_reason"), text.alias("raw_text"),
    )
    error = F.concat_ws("; ", F.coalesce("_ne", F.lit("no native text")), F.coalesce("_de", F.lit("no structured text")))
    failed = joined.filter("_c is null").select(*keep, "variant_id", *PASSED, F.lit(True).alias("needs_review"), F.lit("word_extraction_failed").alias("review_reason"), F.lit(False).alias("needs_ocr"), error.alias("error"))
    return parsed, failed


def summary(considered: DataFrame, todo: DataFrame, parsed: DataFrame, failed: DataFrame) -> DataFrame:
    """One row of counts: considered, run, skipped, ok, weak, failed."""
    count = F.count(F.lit(1))
    done = parsed.agg(count.alias("parsed_ok"), F.count_if("needs_review").alias("parsed_weak_needs_review"))
    rows = side_by_side(considered.agg(count.alias("registry_word_rows_considered")), todo.agg(count.alias("tasks_run")), done, failed.agg(count.alias("failed")))
    return rows.withColumn("skipped_existing", F.col("registry_word_rows_considered") - F.col("tasks_run"))
