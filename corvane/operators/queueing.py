"""Queue of the files that a layout engine has to read.

Rows whose file is missing go to a failure table; rows of one variant, path and reason are kept once, the first in
(priority of reason, path) order. Empty inputs give empty tables; null paths count as missing files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import rules as R
from ..functions.text import missing_as_empty, stable_id

PRIMARY, BACKFILL = "selected_pdf_docling_surya", "backfill_pdf_docling_surya"
QUEUE_ORDER = ("specialty", "disease_path", "doc_type", "language_hint", "source_path")


def is_pdf() -> F.Column:
    return F.coalesce(F.lower("source_extension").isin(*R.PDF_EXTENSIONS), F.lit(False)) | (F.coalesce(F.lower("source_format"), F.lit("")) == "pdf")


def with_file(rows: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose file exists, rows whose file does not)."""
    listed = files.select(F.col("path").alias("_path")).distinct()
    on = rows["source_path"] == listed["_path"]
    return rows.join(listed, on, "left_semi"), rows.join(listed, on, "left_anti")


def queued(rows: DataFrame, reason: str) -> DataFrame:
    path = F.col("source_path")
    return rows.withColumns(
        {
            "queue_id": stable_id(F.concat(F.lit("docling_surya::"), "variant_id", F.lit("::"), path), "dq"),
            "ocr_engine": F.lit("docling_surya"), "ocr_status": F.lit("pending"), "ocr_reason": F.lit(reason), "ocr_input_path": path, "ocr_input_format": F.lit("pdf"),
            "original_source_path": path, "original_source_format": F.coalesce("source_format", F.lit("pdf")), "from_word_conversion": F.lit(False), "converted_pdf_path": F.lit(None).cast("string"),
            "pdf_batch_size": F.lit(0), "defer_vlm": F.lit(True), "agentic_json_path": F.lit(None).cast("string"), "visual_manifest_path": F.lit(None).cast("string"),
        }
    )


def first_of_each(rows: DataFrame, *order: str) -> DataFrame:
    """The first row of each variant, path and reason in the given order, by partial aggregation."""
    key = ["variant_id", "ocr_input_path", "ocr_reason"]
    rest = [c for c in rows.columns if c not in key]
    kept = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return kept.select(*(F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in rows.columns))


def build_queue(registry: DataFrame, files: DataFrame, cfg: Settings) -> tuple[DataFrame, DataFrame]:
    """(queue, failures) of a registry with `selected` and `selection_reason`."""
    pdf = registry.filter(is_pdf())
    primary, lost = with_file(pdf.filter(F.coalesce("selected", F.lit(False))), files)
    rows, failed = queued(primary, PRIMARY), lost.withColumn("reason", F.lit("selected_pdf_source_missing"))
    if cfg.include_backfill:
        extra, gone = with_file(pdf.filter("selection_reason = 'pdf_backfill_candidate_word_exists'"), files)
        rows = rows.unionByName(queued(extra, BACKFILL))
        failed = failed.unionByName(gone.withColumn("reason", F.lit("backfill_pdf_source_missing")))
    return first_of_each(rows, "source_path"), failed


def ordered(queue: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """The queue in its order; a limit takes the top rows of it."""
    out = queue.orderBy(*(missing_as_empty(F.col(c)) for c in QUEUE_ORDER))
    out = out.offset(offset) if offset else out
    return out.limit(limit) if limit else out


def summary(queue: DataFrame) -> DataFrame:
    """One row: rows of the queue by reason."""
    return queue.agg(F.count(F.lit(1)).alias("queue_total"), F.count_if(F.col("ocr_reason") == PRIMARY).alias("selected_pdf_total"), F.count_if(F.col("ocr_reason") == BACKFILL).alias("backfill_pdf_total"))


def by_reason(queue: DataFrame, only: str) -> DataFrame:
    """Rows of the backfill, or the others; a null reason is no backfill."""
    is_backfill = missing_as_empty(F.col("ocr_reason")).startswith("backfill")
    return queue.filter(is_backfill if only == "backfill" else ~is_backfill)


def not_done(queue: DataFrame, done: DataFrame) -> DataFrame:
    """Rows whose variant has no output yet."""
    return queue.join(done.select("variant_id").distinct(), "variant_id", "left_anti")
