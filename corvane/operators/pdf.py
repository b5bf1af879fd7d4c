"""From queued PDFs to rows of parsed_docling: page scan, layout, blocks, visuals, records, summary.

Page and layout engines are backends behind an Arrow boundary, as in `extraction`; failures are rows. Everything after them is
relational. Null contents count as failures; documents without a readable page have no record and one failure row; a batch that fails
gives no items, so its pages fall back to their native text.
"""

from __future__ import annotations

import traceback
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import boxes as B
from ..functions import rules as R
from ..functions import text as X
from ..functions.barrier import once, side_by_side
from ..functions.text import missing_as_empty
from . import blocks

PAGES = "variant_id string, page int, width_pts double, height_pts double, text_chars int, native_text string, ok boolean, error string"
ITEMS = "variant_id string, batch_no int, batch_start_page int, kind string, item_seq int, label string, text string, markdown string, local_page int, l double, t double, r double, b double, ok boolean, error string"
PAGE_BACKENDS: dict[str, Callable[[bytes], list[tuple[float, float, str]]]] = {}
LAYOUT_BACKENDS: dict[str, Callable[[], Callable[[bytes, list[dict]], list[dict]]]] = {}


def page_backend(name: str):
    """Registers a page reader: bytes -> (width, height, native text) of each page."""
    return lambda f: PAGE_BACKENDS.setdefault(name, f)


def layout_backend(name: str):
    """Registers a maker of layout engines, called once a task: () -> ((bytes, pages of a batch) -> items)."""
    return lambda f: LAYOUT_BACKENDS.setdefault(name, f)


@page_backend("pdf_objects")
def _pdf_objects(content: bytes) -> list[tuple[float, float, str]]:
    from ..functions.pdf_objects import Document

    return Document(content).pages()


@layout_backend("native_lines")
def _native_lines():
    """Items without a layout engine: the lines of a page's native text, from top to bottom."""

    def run(content: bytes, pages: list[dict]) -> list[dict]:
        out = []
        for p in pages:
            lines = [x for x in (p["native_text"] or "").split("\n") if x.strip()]
            step = p["height_pts"] / max(len(lines), 1)
            for k, line in enumerate(lines):
                top = p["height_pts"] - k * step
                out.append({"kind": "text", "label": "text", "text": line, "markdown": "", "local_page": p["local_page"], "l": 0.0, "t": top, "r": p["width_pts"], "b": top - step})
        return out

    return run


def scan_pages(files: DataFrame, backend: str = "pdf_objects") -> DataFrame:
    """PAGES rows of files (variant_id, content): one for each page, or one with ok = false and the error."""
    read = PAGE_BACKENDS[backend]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for v, content in zip(batch["variant_id"], batch["content"]):
                try:
                    found = [(v, k, w, h, len(t.strip()), t, True, None) for k, (w, h, t) in enumerate(read(bytes(content)), 1)]
                except Exception as e:  # noqa: BLE001 - a broken file is a row
                    found = [(v, None, None, None, None, None, False, f"{type(e).__name__}: {e}")]
                rows += found
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PAGES.split(", ")]).astype({"page": "Int32", "text_chars": "Int32"})

    return files.select("variant_id", "content").mapInPandas(run, PAGES)


def is_scanned_like(native_text: Column) -> Column:
    return F.length(X.strip(missing_as_empty(native_text))) < R.SCANNED_PAGE


def lay_out(files: DataFrame, pages: DataFrame, cfg: Settings, backend: str = "native_lines") -> DataFrame:
    """ITEMS rows of files (variant_id, content) with their pages in batches of `cfg.page_batch`; a failed batch is one row with its error."""
    engine = LAYOUT_BACKENDS[backend]
    names = [c.split()[0] for c in ITEMS.split(", ")]
    batch_no = F.floor((F.col("page") - 1) / cfg.page_batch).cast("int") + 1
    page = F.struct("page", "width_pts", "height_pts", "native_text", (F.col("page") - (batch_no - 1) * cfg.page_batch).alias("local_page"))
    batches = pages.filter("page is not null").groupBy("variant_id", batch_no.alias("batch_no")).agg(F.array_sort(F.collect_list(page)).alias("pages"))
    src = batches.join(files.select("variant_id", "content"), "variant_id").select("variant_id", "batch_no", "pages", "content")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work, blank = engine(), dict.fromkeys(names)
        for part in parts:
            rows = []
            for v, no, found, content in zip(part["variant_id"], part["batch_no"], part["pages"], part["content"]):
                start = (no - 1) * cfg.page_batch + 1
                try:
                    items = [dict(x) for x in work(bytes(content), [dict(p) if isinstance(p, dict) else p.asDict() for p in found])]
                    rows += [{**blank, "variant_id": v, "batch_no": no, "batch_start_page": start, "item_seq": k, "ok": True, "error": None, **x} for k, x in enumerate(items)]
                except Exception as e:  # noqa: BLE001 - a broken batch is a row
                    rows.append({**blank, "variant_id": v, "batch_no": no, "batch_start_page": start, "ok": False, "error": f"batch {no} failed: {type(e).__name__}: {e}\n{traceback.format_exc()}"})
            yield pd.DataFrame(rows, columns=names).astype({"batch_no": "Int32", "batch_start_page": "Int32", "item_seq": "Int32", "local_page": "Int32", **dict.fromkeys("ltrb", "Float64")})

    return src.mapInPandas(run, ITEMS)


#: Columns that records() makes; those of the queue with the same names give way.
MADE = frozenset(
    "variant_id detected_language extraction_method quality_flags markdown_path agentic_json_path raw_docling_dir visual_manifest_path visual_assets_dir pending_visual_count visual_asset_count docling_batch_count docling_batch_failed_count page_count char_count icd_codes_detected elapsed_seconds raw_text".split()
)


def records(queue: DataFrame, found: DataFrame, visuals: DataFrame, pages: DataFrame, failed_batches: DataFrame, cfg: Settings, *keep: str) -> DataFrame:
    """Rows of parsed_docling of the queue's variants that have pages; `keep` names further columns of the queue.

    failed_batches has (variant_id, batch_no). Texts are assembled per document; all joins are on the variant. elapsed_seconds is null:
    the work on one document is spread over tasks.
    """
    batches = F.ceil(F.col("page_count") / cfg.page_batch).cast("int")
    counted = pages.groupBy("variant_id").agg(F.count(F.lit(1)).cast("int").alias("page_count"))
    shown = visuals.groupBy("variant_id").agg(F.count(F.lit(1)).cast("int").alias("_visuals"))
    broken = failed_batches.select("variant_id", "batch_no").distinct().groupBy("variant_id").agg(F.count(F.lit(1)).cast("int").alias("_failed"))
    facts = counted.join(blocks.raw_text(found), "variant_id", "left").join(shown, "variant_id", "left").join(broken, "variant_id", "left").withColumnRenamed("raw_text", "_assembled")
    text = F.col("_text")
    rows = once(queue.join(facts, "variant_id"), _text=missing_as_empty(F.col("_assembled")))
    rows = once(rows, _lang=X.language_by_markers(text))
    own = X.compact(
        F.when(F.coalesce("_failed", F.lit(0)) > 0, F.lit("docling_batch_errors")), F.when(F.coalesce("_visuals", F.lit(0)) > 0, F.lit("pending_visual_assets")),
        F.when(F.length(text) < cfg.min_chars, F.lit("pdf_low_char_count")),
    )
    v = F.col("variant_id")
    return rows.select(
        *(c for c in keep if c not in MADE), "variant_id", F.col("_lang").alias("detected_language"), F.lit("agentic_pdf_docling_surya_deferred_vlm").alias("extraction_method"),
        F.array_sort(F.array_distinct(F.concat(X.quality_flags(text, F.col("_lang")), own))).alias("quality_flags"),
        F.concat(F.lit("data/parsed_docling/"), v, F.lit("/document.md")).alias("markdown_path"), F.concat(F.lit("data/parsed_pdf_agentic/"), v, F.lit("/agentic.json")).alias("agentic_json_path"),
        F.concat(F.lit("data/parsed_pdf_docling_raw/"), v).alias("raw_docling_dir"), F.concat(F.lit("data/pdf_visual_assets/"), v, F.lit("/visual_manifest.jsonl")).alias("visual_manifest_path"),
        F.concat(F.lit("data/pdf_visual_assets/"), v).alias("visual_assets_dir"), F.coalesce("_visuals", F.lit(0)).alias("pending_visual_count"), F.coalesce("_visuals", F.lit(0)).alias("visual_asset_count"),
        batches.alias("docling_batch_count"), F.coalesce("_failed", F.lit(0)).alias("docling_batch_failed_count"), "page_count", F.length(text).alias("char_count"), X.codes(text).alias("icd_codes_detected"), F.lit(None).cast("double").alias("elapsed_seconds"), text.alias("raw_text"),
    )


def batch_outputs(pages: DataFrame, failed_batches: DataFrame, cfg: Settings) -> DataFrame:
    """(variant_id, batch_no, first_page, last_page, status) of every batch."""
    count = pages.groupBy("variant_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    rows = count.select("variant_id", F.explode(B.page_batches(F.col("n"), cfg.page_batch)).alias("b")).select("variant_id", "b.*")
    broken = failed_batches.select("variant_id", "batch_no", F.lit("failed").alias("_s")).distinct()
    return rows.join(broken, ["variant_id", "batch_no"], "left").select("variant_id", "batch_no", "first_page", "last_page", F.coalesce("_s", F.lit("ok")).alias("status"))


def agentic(found: DataFrame, pages: DataFrame, visuals: DataFrame, failed_batches: DataFrame, cfg: Settings) -> DataFrame:
    """One nested document a variant: class of the document, processing facts, batches, pages with their blocks."""
    by = lambda df, c, name: df.groupBy("variant_id").agg(c.alias(name))
    batches = by(batch_outputs(pages, failed_batches, cfg), F.array_sort(F.collect_list(F.struct("batch_no", "first_page", "last_page", "status"))), "batches")
    rows = blocks.document_class(pages).join(by(found, F.count(F.lit(1)), "total_blocks"), "variant_id", "left").join(by(visuals, F.count(F.lit(1)), "pending_visual_count"), "variant_id", "left")
    rows = rows.join(batches, "variant_id", "left").join(blocks.nested_pages(found).withColumnRenamed("pages", "_nested"), "variant_id", "left")
    return rows.select(
        "variant_id", F.struct(F.col("document_class").alias("kind"), F.col("scanned_ratio").alias("scanned_page_ratio")).alias("classification"),
        F.struct(F.lit(True).alias("defer_vlm"), F.lit(cfg.page_batch).alias("batch_size"), F.lit(cfg.render_dpi).alias("render_dpi"), F.col("pages").alias("total_pages"), F.coalesce("total_blocks", F.lit(0)).alias("total_blocks"), F.coalesce("pending_visual_count", F.lit(0)).alias("pending_visual_count")).alias("processing"),
        "batches", F.col("_nested").alias("pages"),
    )


def failures(queue: DataFrame, scanned: DataFrame) -> DataFrame:
    """Queue rows without a record, with status and error: unreadable files, and files that are not there."""
    broken = scanned.filter(~F.coalesce("ok", F.lit(False))).groupBy("variant_id").agg(F.min("error").alias("error"))
    good = scanned.filter("ok").select("variant_id").distinct()
    return queue.join(good, "variant_id", "left_anti").join(broken, "variant_id", "left").withColumns({"ocr_status": F.lit("failed"), "error": F.coalesce("error", F.concat(F.lit("input PDF not found: "), missing_as_empty(F.col("ocr_input_path"))))})


def summary(considered: DataFrame, parsed: DataFrame, failed: DataFrame, visuals: DataFrame) -> DataFrame:
    """One row of counts over a run."""
    count = F.count(F.lit(1))
    done = parsed.agg(count.alias("parsed_ok"), F.coalesce(F.sum("char_count"), F.lit(0)).alias("total_chars"))
    return side_by_side(considered.agg(count.alias("ocr_rows_considered")), done, failed.agg(count.alias("failed")), visuals.agg(count.alias("total_visual_assets_manifest")))
