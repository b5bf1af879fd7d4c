"""Stages of the pipeline as plans from tables to named tables; results run when they are written (tables that are read twice are cut by checkpoints)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import blocks, extraction, merging, pdf, queueing, registry, validation, word
from ..operators.durable import durable
from ..sources import readers

_IN_ORDER = ("specialty", "disease_path", "doc_type")


def _as_text(*columns: str) -> list:
    return [F.coalesce(c, F.lit("None")) for c in columns]


def build_registry(files: DataFrame, cfg: Settings) -> dict[str, DataFrame]:
    supported, skipped = registry.scan(files)
    inv, reviews = registry.inventory(supported, cfg)
    rows = registry.select_variants(inv)
    chosen = registry.selected(rows)
    return {
        "inventory": inv, "registry": rows, "skipped": skipped.unionByName(reviews), "selected": chosen.orderBy(*registry.SELECTED_ORDER), "rejected": registry.rejected(rows), "pdf_backfill": registry.backfill(rows),
        "grouped": registry.grouped(chosen).orderBy(*_IN_ORDER), "fallback_plan": registry.fallback_plan(chosen), "counters": registry.counters(rows, "language_hint", "source_format", "doc_type", "specialty", "selection_reason"), "summary": registry.summary(rows),
    }


def extract_word(rows: DataFrame, files: DataFrame, done: DataFrame | None, cfg: Settings, only_format: str | None = None, only_unknown: bool = False, start: int = 0, limit: int = 0) -> dict[str, DataFrame]:
    """Texts of Word variants; files has (path, content). Variants that have an output already are left out."""
    considered = word.word_rows_of(rows, only_format, only_unknown, start, limit)
    todo = queueing.not_done(considered, done) if done is not None else considered
    todo = durable(todo).select("variant_id", *word.PASSED, *(c for c in todo.columns if c not in ("variant_id", *word.PASSED)))
    content = todo.join(files, todo["source_path"] == files["path"]).select("variant_id", "source_format", "content")
    found = durable(extraction.candidates(content, cfg.timeout_seconds))
    keep = [c for c in todo.columns if c not in ("variant_id", *word.PASSED)]
    parsed, failed = word.parsed_rows(todo, found, cfg.min_chars, *keep)
    weak = parsed.filter("needs_review").select("variant_id", *word.PASSED, "detected_language", "needs_review", "review_reason", "char_count", "quality_flags")
    return {"parsed_word": parsed, "word_failures": failed, "weak": weak, "summary": word.summary(considered, todo, parsed, failed)}


def build_queue(rows: DataFrame, files: DataFrame, cfg: Settings) -> dict[str, DataFrame]:
    queue, failed = queueing.build_queue(rows, files, cfg)
    return {"ocr_queue": queueing.ordered(queue), "failures": failed, "counters": registry.counters(queue, "ocr_reason", "language_hint", "doc_type"), "summary": queueing.summary(queue)}


def assemble_pdf(items: DataFrame, pages: DataFrame, queue: DataFrame | None = None, cfg: Settings = Settings(), images: DataFrame | None = None, failed_batches: DataFrame | None = None) -> dict[str, DataFrame]:
    """Layout items and pages, as a layout engine gives them, to blocks, manifest, texts, records and nested documents.

    queue names the variants that get a record (all that have pages where it is missing); failed_batches has (variant_id, batch_no).
    """
    once = blocks.one_measure(pages)
    found = durable(blocks.assemble_blocks(items, pages))
    visuals = durable(blocks.with_visuals(found, images, cfg.crop_padding))
    manifest = blocks.visual_manifest(visuals)
    broken = failed_batches if failed_batches is not None else items.limit(0).select("variant_id", "batch_no")
    queue = queue if queue is not None else once.select("variant_id").distinct()
    keep = [c for c in queue.columns if c != "variant_id"]
    parsed = pdf.records(queue, found, manifest, once, broken, cfg, *keep)
    return {
        "blocks": visuals, "visual_manifest": manifest, "raw_text": blocks.raw_text(found), "markdown": blocks.markdown(visuals), "agentic": pdf.agentic(visuals, once, manifest, broken, cfg),
        "document_class": blocks.document_class(once), "parsed_docling": parsed,
    }


def extract_pdf(queue: DataFrame, files: DataFrame, done: DataFrame | None, cfg: Settings, layout: str = "native_lines", only: str | None = None) -> dict[str, DataFrame]:
    """The PDF stage: page scan, layout in batches, records. files has (path, content); only is 'backfill' or 'primary'."""
    queue = queueing.by_reason(queue, only) if only else queue
    todo = durable(queueing.not_done(queue, done) if done is not None else queue)  # what is done must not change while results are written
    content = durable(todo.join(files, todo["ocr_input_path"] == files["path"]).select("variant_id", "content").dropDuplicates(["variant_id"]))
    scanned = durable(pdf.scan_pages(content))
    pages = scanned.filter("ok").drop("ok", "error")
    items = durable(pdf.lay_out(content, pages, cfg, layout))
    out = assemble_pdf(items.filter("ok"), pages, todo, cfg, None, items.filter("not ok").select("variant_id", "batch_no"))
    failed = pdf.failures(todo, scanned)
    return {**out, "page_info": pages, "failures": failed, "batch_failures": items.filter("not ok").select("variant_id", "batch_no", "error"), "summary": pdf.summary(todo, out["parsed_docling"], failed, out["visual_manifest"])}


def merge(parsed: DataFrame, cfg: Settings, order: str = "row_id", fallback: DataFrame | None = None) -> dict[str, DataFrame]:
    """Merged rows; where the table of results is empty, the rows of the per-variant files (`fallback`) are taken."""
    parsed = readers.first_filled(parsed, fallback) if fallback is not None else parsed
    rows = merging.merged(parsed, order)
    return {"merged": rows, "grouped": merging.grouped(rows, order).orderBy(*_as_text(*_IN_ORDER)), "missing": merging.missing(rows, cfg.min_chars), "flag_counts": merging.flag_counts(rows), "summary": merging.summary(rows, cfg.min_chars)}


def validate(rows: DataFrame, artefacts: DataFrame, manifest: DataFrame, cfg: Settings, cleaned: DataFrame | None = None) -> dict[str, DataFrame]:
    """Reports on merged rows, or on the cleaned ones where they are given and there are any."""
    rows = readers.first_filled(cleaned, rows) if cleaned is not None else rows
    report = durable(validation.quality_report(rows, artefacts, manifest, cfg.min_chars))
    visuals, duplicates = validation.visual_review(rows, manifest, artefacts), validation.duplicate_texts(rows)
    return {
        "quality_report": report, "needs_review": report.filter("needs_review"), "visual_review": visuals, "duplicates": duplicates, "flag_ranking": validation.flag_ranking(report),
        "counters": registry.counters(report, "source_format", "extraction_source", "detected_language", "final_language", "doc_type", "extraction_method"), "summary": validation.report_summary(report, visuals, duplicates),
    }
