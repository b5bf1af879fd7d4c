"""Queries over the project's tables, one for each operator or group of operators. Each runs over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import boxes as B
from ..functions import paths as P
from ..functions import tables as T
from ..functions import text as X
from ..operators import blocks, extraction, merging, pdf, queueing, registry, validation, word
from ..sources.readers import spread
from .oracle import oracle_sql  # noqa: F401 - part of the contract

CFG = Settings()


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{d}/{name}.parquet"))


def listing(spark: SparkSession, d: str) -> DataFrame:
    """The registry's paths as a file listing; a sixteenth each as lock files, other formats and reviews, by digest."""
    src = table(spark, d, "registry").groupBy(F.col("source_path").alias("p")).agg(F.max("size_kb").alias("kb"))
    name = P.name(F.col("p"))
    folder = F.substring("p", F.lit(1), F.length("p") - F.length(name))
    h = F.substring(F.md5(F.col("p").cast("binary")), 1, 1)
    path = F.when(h == "0", F.concat(folder, F.lit("~$"), name)).when(h == "1", F.concat("p", F.lit(".txt"))).when(h == "2", F.concat(folder, F.lit("рецензия "), name)).otherwise(F.col("p"))
    return src.select(path.alias("path"), F.floor(F.coalesce("kb", F.lit(0.0)) * 1024).cast("bigint").alias("length"))


def _inventory(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    supported, skipped = registry.scan(listing(spark, d))
    inv, reviews = registry.inventory(supported, CFG)
    return inv, reviews, skipped


def _selection(spark: SparkSession, d: str) -> DataFrame:
    return registry.select_variants(_inventory(spark, d)[0])


def path_features(spark, d):
    p = F.col("path")
    parts = P.relative_parts(p, CFG)
    return listing(spark, d).select(
        "path", P.name(p).alias("filename"), P.extension(p).alias("extension"), P.stem(p).alias("stem"), P.specialty(parts).alias("specialty"), P.disease_path(parts, P.stem(p)).alias("disease_path"), P.doc_type(p).alias("doc_type"),
        P.language_hint(p).alias("language_hint"), P.is_review(p).alias("is_review"), P.file_key(P.stem(p)).alias("file_key"), X.stable_id(p, "var").alias("variant_id"), P.is_supported(p).alias("is_supported"),
    )


def inventory_ids(spark, d):
    return _inventory(spark, d)[0].select("inventory_id", "variant_id", "source_path", "disease_class_id", "clinical_doc_group_id", "priority", "size_kb")


def select_variants(spark, d):
    return _selection(spark, d).select("variant_id", "disease_class_id", "doc_type", "language_hint", "source_extension", "source_path", "selected", "selection_reason")


def selected_order(spark, d):
    """The selected rows in their order, with their place."""
    rows = registry.selected(_selection(spark, d))
    return registry.numbered(rows, F.struct(*registry.SELECTED_ORDER)).select("ordinal", "variant_id")


def pdf_backfill(spark, d):
    return registry.backfill(_selection(spark, d)).select("variant_id", "source_path", "selection_reason")


def rejected_duplicates(spark, d):
    return registry.rejected(_selection(spark, d)).select("variant_id", "source_path", "selection_reason")


def skipped_files(spark, d):
    _, reviews, skipped = _inventory(spark, d)
    return skipped.unionByName(reviews).select("path", "extension", "skip_reason")


def registry_grouped(spark, d):
    groups = registry.grouped(registry.selected(_selection(spark, d)))
    return groups.select("disease_class_id", "doc_type", "specialty", "disease_path", F.array_join("available_languages", ",").alias("languages"), F.explode("variants").alias("language", "rows")).select(
        "disease_class_id", "doc_type", "specialty", "disease_path", "languages", "language", F.array_join(F.transform("rows", lambda r: r["variant_id"]), ",").alias("variant_ids")
    )


def fallback_plan(spark, d):
    return registry.fallback_plan(registry.selected(_selection(spark, d)))


def registry_counters(spark, d):
    return registry.counters(_selection(spark, d).withColumn("reason_kind", F.regexp_replace("selection_reason", "^duplicate_of_.*", "duplicate")), "language_hint", "source_format", "doc_type", "specialty", "reason_kind")


def registry_summary(spark, d):
    return registry.summary(_selection(spark, d))


def _queue(spark, d):
    rows = table(spark, d, "registry")
    files = rows.select(F.col("source_path").alias("path")).filter(F.substring(F.md5(F.col("source_path").cast("binary")), 1, 1) != "f")
    return queueing.build_queue(rows, files, CFG)


def ocr_queue(spark, d):
    return queueing.ordered(_queue(spark, d)[0]).select("queue_id", "variant_id", "ocr_reason", "ocr_input_path", "original_source_format")


def queue_failures(spark, d):
    return _queue(spark, d)[1].groupBy("variant_id", "reason").agg(F.count(F.lit(1)).alias("n"))


def queue_only_backfill(spark, d):
    return queueing.by_reason(_queue(spark, d)[0], "backfill").select("queue_id", "variant_id")


def resume_antijoin(spark, d):
    """Queue rows that neither results table has an output for."""
    done = table(spark, d, "parsed_docling").select("variant_id").union(table(spark, d, "parsed_guidelines_raw").select("variant_id"))
    return queueing.not_done(_queue(spark, d)[0], done).select("queue_id", "variant_id")


def queue_top(spark, d):
    """The first hundred rows of the queue after ten, as a limited run takes them."""
    q = _queue(spark, d)[0].filter("source_path is not null")
    return q.orderBy("source_path", "ocr_reason").offset(10).limit(100).select("variant_id", "ocr_reason")


def _raw(spark, d):
    return table(spark, d, "parsed_guidelines_raw")


def clean_text_hash(spark, d):
    t = X.clean(F.col("raw_text"))
    return _raw(spark, d).select("row_id", F.length(t).alias("n"), F.md5(t.cast("binary")).alias("clean_md5"), X.text_hash(F.col("raw_text")).alias("text_hash"))


def language_detect(spark, d):
    return _raw(spark, d).select("row_id", X.language_by_markers(F.col("raw_text")).alias("language"))


def quality_flags(spark, d):
    t = X.clean(F.col("raw_text"))
    return _raw(spark, d).select("row_id", F.array_join(X.quality_flags(t, X.language_by_markers(F.col("raw_text"))), ",").alias("flags"))


def icd_codes(spark, d):
    return _raw(spark, d).select("row_id", F.array_join(X.codes(X.clean(F.col("raw_text"))), ",").alias("codes"), X.has_code_marker(F.col("raw_text")).alias("has_marker"))


def char_counts(spark, d):
    t = X.clean(F.col("raw_text"))
    return _raw(spark, d).select("row_id", F.length(t).alias("n"), *(X.count_of(t, p).cast("int").alias(n.replace("ratio", "count")) for n, p in X.RATIOS.items()))


def char_ratios(spark, d):
    t = X.clean(F.col("raw_text"))
    return _raw(spark, d).select("row_id", *(X.ratio(t, p).alias(n) for n, p in X.RATIOS.items()))


def bad_patterns(spark, d):
    return _raw(spark, d).select("row_id", X.bad_patterns(X.clean(F.col("raw_text"))).cast("int").alias("n"))


def table_quality(spark, d):
    """Tables as runs of bar lines of the texts: one for each record that has a bar."""
    md = F.array_join(F.filter(F.split(X.missing_as_empty(F.col("raw_text")), "\n"), lambda x: x.contains("|")), "\n")
    return _raw(spark, d).filter(F.col("raw_text").contains("|")).select("row_id", F.array_join(T.table_reasons(md), ",").alias("reasons"))


def visual_types(spark, d):
    m = table(spark, d, "visual_manifest")
    return m.select("asset_id", T.visual_type(F.col("suggested_type"), F.concat_ws(" ", "caption", "before_text", "after_text")).alias("kind")).distinct()


def _items(spark, d):
    """Layout items made of the lines of the texts, by place: pictures, tables and texts on pages of five lines."""
    docs = table(spark, d, "parsed_docling").groupBy("variant_id").agg(F.max(F.struct("row_id", "raw_text")).alias("m")).select("variant_id", F.col("m.raw_text").alias("raw_text"))
    i = F.col("i")
    rows = docs.filter("raw_text is not null").select("variant_id", F.posexplode(F.split("raw_text", "\n", -1)).alias("i", "line"))
    page = F.floor(i / 5).cast("int") + 1
    batch = F.floor((page - 1) / 8).cast("int") + 1
    kind = F.when(i % 6 == 0, "picture").when(i % 6 == 1, "table").otherwise("text")
    md = F.when(i % 6 != 1, "").when(i % 5 == 0, "| a | b |\n|---|---|\n| 1 | 2 |\n| 3 | 4 |").when(i % 5 == 1, "| a | b |\n| 1 | 2 | 3 |\n| 4 | 5 | 6 | 7 |").when(i % 5 == 2, "| only one column |\n| still only one |").when(i % 5 == 3, "| a single row of a table |").otherwise("| a |")
    left, top = (i % 4 * 64).cast("double"), (1024 - (i * 3 % 5) * 128).cast("double")
    label = F.when(kind == "picture", F.when(i % 4 == 0, "chart").when(i % 4 == 2, "Схема").otherwise("picture")).when(i % 7 == 2, "caption").otherwise(kind)
    return rows.select(
        "variant_id", batch.alias("batch_no"), ((batch - 1) * 8 + 1).alias("batch_start_page"), kind.alias("kind"), i.alias("item_seq"), label.alias("label"), F.when(kind == "text", F.col("line")).otherwise("").alias("text"), md.alias("markdown"),
        (page - (batch - 1) * 8).alias("local_page"), left.alias("l"), top.alias("t"), F.when(i % 17 == 3, left).otherwise(left + 64).alias("r"), (top - 64).alias("b"),
    )


def _pages(spark, d):
    """One row a page, as measured last."""
    return blocks.one_measure(table(spark, d, "page_info"))


def _blocks(spark, d):
    return blocks.assemble_blocks(_items(spark, d), _pages(spark, d))


def page_measures(spark, d):
    return blocks.one_measure(table(spark, d, "page_info")).select("variant_id", "page", "width_pts", "height_pts")


def document_class(spark, d):
    once = blocks.one_measure(table(spark, d, "page_info"))
    return blocks.document_class(once).select("variant_id", "pages", "scanned_pages", "document_class")


def block_order(spark, d):
    return blocks.in_reading_order(blocks.located(_items(spark, d), _pages(spark, d))).select("variant_id", "batch_no", "page", "order", "type", F.col("bbox.x0").alias("x0"), F.col("bbox.y0").alias("y0"), F.array_join("reasons", ",").alias("reasons"))


def page_fallback(spark, d):
    b = _blocks(spark, d)
    return b.filter("fallback").select("variant_id", "page", "block_id", "type", "label")


def neighbor_context(spark, d):
    return blocks.with_context(_blocks(spark, d)).select("variant_id", "block_id", F.md5(F.col("before_text").cast("binary")).alias("before_md5"), F.md5(F.col("after_text").cast("binary")).alias("after_md5"), F.md5(F.col("caption").cast("binary")).alias("caption_md5"))


def visual_manifest(spark, d):
    m = blocks.visual_manifest(_blocks(spark, d))
    hashed = [F.md5(F.col(c).cast("binary")).alias(f"{c}_md5") for c in ("caption", "before_text", "after_text")]
    return m.select("doc_id", "variant_id", "asset_id", "page", "order", "block_id", "suggested_type", F.col("bbox.x0").alias("x0"), F.col("bbox.y0").alias("y0"), F.col("bbox.x1").alias("x1"), F.col("bbox.y1").alias("y1"), "crop_path", *hashed, "status")


def _images(spark, d):
    """Page images of 1000 x 1400 pixels for three quarters of the pages, some of them empty, by digest."""
    digit = F.substring(F.md5(F.concat_ws("/", "variant_id", F.col("page").cast("string")).cast("binary")), 1, 1)
    return _pages(spark, d).filter(digit < "c").select("variant_id", "page", F.when(digit == "0", 0).otherwise(1000).alias("width"), F.lit(1400).alias("height"))


def visual_blocks(spark, d):
    """Blocks after the export of visuals: what has a crop, what has none and why."""
    rows = blocks.with_visuals(_blocks(spark, d), _images(spark, d), CFG.crop_padding).filter(blocks.is_visual())
    c = F.col("visual.crop")
    return rows.select("variant_id", "block_id", "type", "needs_review", "needs_vlm", F.array_join("reasons", ",").alias("reasons"), "visual.asset_id", *(c[x].alias(f"crop_{x}") for x in ("left", "top", "right", "bottom")))


def raw_text_assembly(spark, d):
    return blocks.raw_text(_blocks(spark, d)).select("variant_id", F.md5(F.col("raw_text").cast("binary")).alias("text_md5"))


def markdown_assembly(spark, d):
    return blocks.markdown(blocks.with_visuals(_blocks(spark, d))).select("variant_id", F.md5(F.col("markdown").cast("binary")).alias("markdown_md5"))


def page_nesting(spark, d):
    ids = F.array_join(F.transform("pages", lambda p: F.concat(p["page"].cast("string"), F.lit(":"), F.array_join(F.transform(p["blocks"], lambda b: b["block_id"]), ","))), ";")
    return blocks.nested_pages(_blocks(spark, d)).select("variant_id", F.size("pages").alias("n_pages"), F.aggregate("pages", F.lit(0), lambda a, p: a + F.size(p["blocks"])).alias("n_blocks"), F.md5(ids.cast("binary")).alias("ids_md5"))


def page_scan(spark, d):
    """Facts of each page that a scan gives, from its native text."""
    t = X.strip(X.missing_as_empty(F.col("native_text")))
    return _pages(spark, d).select("variant_id", "page", "width_pts", "height_pts", F.length(t).alias("text_chars"), pdf.is_scanned_like(F.col("native_text")).alias("is_scanned_like"))


def _fails(variant: F.Column, batch: F.Column) -> F.Column:
    return F.substring(F.md5(F.concat_ws("_", variant, batch.cast("string")).cast("binary")), 1, 1) == "0"


def _pdf(spark, d):
    """(queue, pages, failed batches, blocks, manifest): a sixteenth of the batches fails, by digest."""
    pages = _pages(spark, d)
    broken = pages.select("variant_id", (F.floor((F.col("page") - 1) / CFG.page_batch).cast("int") + 1).alias("batch_no")).distinct().filter(_fails(F.col("variant_id"), F.col("batch_no")))
    found = blocks.assemble_blocks(_items(spark, d).filter(~_fails(F.col("variant_id"), F.col("batch_no"))), pages)
    queue = merging.latest(table(spark, d, "parsed_docling"), "variant_id", "ingested_at", "row_id").select("variant_id", "source_path", "doc_type", "language_hint")
    return queue, pages, broken, found, blocks.visual_manifest(found)


def parsed_pdf(spark, d):
    """Records of parsed_docling made from layout items and pages."""
    queue, pages, broken, found, manifest = _pdf(spark, d)
    rows = pdf.records(queue, found, manifest, pages, broken, CFG, "source_path", "doc_type", "language_hint")
    return rows.select(
        "variant_id", "source_path", "doc_type", "language_hint", "detected_language", "extraction_method", F.array_join("quality_flags", ",").alias("flags"), "markdown_path", "agentic_json_path", "raw_docling_dir", "visual_manifest_path", "visual_assets_dir",
        "pending_visual_count", "visual_asset_count", "docling_batch_count", "docling_batch_failed_count", "page_count", "char_count", F.array_join("icd_codes_detected", ",").alias("codes"), F.md5(F.col("raw_text").cast("binary")).alias("text_md5"),
    )


def pdf_batches(spark, d):
    _, pages, broken, _, _ = _pdf(spark, d)
    return pdf.batch_outputs(pages, broken, CFG)


def pdf_summary(spark, d):
    queue, pages, broken, found, manifest = _pdf(spark, d)
    scanned = pages.select("variant_id", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error"))
    failed = pdf.failures(queue.withColumn("ocr_input_path", F.col("source_path")), scanned)
    return pdf.summary(queue, pdf.records(queue, found, manifest, pages, broken, CFG), failed, manifest)


def bbox_normalize(spark, d):
    items = _items(spark, d).withColumn("page", F.col("batch_start_page") + F.col("local_page") - 1).join(_pages(spark, d), ["variant_id", "page"])
    rows = items.select("variant_id", "item_seq", B.relative_box(*(F.col(c) for c in "ltrb"), F.col("width_pts"), F.col("height_pts")).alias("x"))
    return rows.select("variant_id", "item_seq", "x.x0", "x.y0", "x.x1", "x.y1", B.area(F.col("x")).alias("area"))


def crop_box(spark, d):
    m = table(spark, d, "visual_manifest").filter("bbox is not null").distinct()
    c = B.crop(F.col("bbox"), 800 + F.col("page") % 7 * 100, 1100 + F.col("page") % 5 * 100, CFG.crop_padding)
    return m.select("asset_id", c.alias("c")).select("asset_id", "c.left", "c.top", "c.right", "c.bottom")


def page_batches(spark, d):
    rows = table(spark, d, "parsed_docling").select("row_id", F.explode(B.page_batches(F.col("page_count"), CFG.page_batch)).alias("b"))
    return rows.select("row_id", "b.batch_no", "b.first_page", "b.last_page")


def _merged(spark, d):
    return merging.merged(table(spark, d, "parsed_docling"), "row_id")


def merge_normalize(spark, d):
    """All columns; arrays as texts, texts as digests."""
    rows = _merged(spark, d)
    shown = {"quality_flags": F.array_join("quality_flags", ","), "icd_codes_detected": F.array_join("icd_codes_detected", ","), "raw_text": F.md5(F.col("raw_text").cast("binary"))}
    return rows.select(*(shown.get(c, F.col(c)).alias(c) for c in rows.columns))


def merge_missing(spark, d):
    return merging.missing(_merged(spark, d), CFG.min_chars)


def merge_grouped(spark, d):
    g = merging.grouped(_merged(spark, d), "row_id")
    return g.select("disease_class_id", "doc_type", "specialty", "clinical_doc_group_id", F.array_join("available_languages", ",").alias("languages"), F.explode("variants").alias("language", "rows")).select(
        "disease_class_id", "doc_type", "specialty", "clinical_doc_group_id", "languages", "language", F.array_join(F.transform("rows", lambda r: F.concat_ws("/", r["seq"].cast("string"), r["variant_id"], r["char_count"].cast("string"), r["detected_language"], F.array_join(r["quality_flags"], "+"))), ",").alias("rows")
    )


def merge_flag_counts(spark, d):
    return merging.flag_counts(_merged(spark, d))


def merge_summary(spark, d):
    return merging.summary(_merged(spark, d), CFG.min_chars)


def merge_latest(spark, d):
    return merging.latest(table(spark, d, "parsed_docling"), "variant_id", "ingested_at", "row_id").select("variant_id", "row_id")


def artefacts(spark, d):
    """A listing of what exists: the paths that the results name, a sixteenth left out by digest."""
    raw = _raw(spark, d)
    named = raw.select(F.explode(F.array("markdown_path", "agentic_json_path", "raw_docling_dir", "visual_manifest_path")).alias("path")).union(table(spark, d, "visual_manifest").select("crop_path"))
    return named.filter("path <> ''").distinct().filter(F.substring(F.md5(F.col("path").cast("binary")), 1, 1) != "f")


def _report(spark, d):
    return validation.quality_report(_raw(spark, d), artefacts(spark, d), table(spark, d, "visual_manifest"), CFG.min_chars, "row_id")


def quality_report(spark, d):
    """All columns."""
    return _report(spark, d)


def needs_review(spark, d):
    return _report(spark, d).filter("needs_review").select("row_id", "review_flags")


def flag_ranking(spark, d):
    return validation.flag_ranking(_report(spark, d), "row_id")


def duplicate_texts(spark, d):
    return validation.duplicate_texts(_raw(spark, d), "row_id").select("row_id", "text_hash", "duplicate_group_size", "variant_id", "final_language", "char_count")


def manifest_check(spark, d):
    facts = validation.manifest_facts(table(spark, d, "visual_manifest"), artefacts(spark, d))
    return _raw(spark, d).join(facts, "variant_id", "left").select("row_id", F.coalesce("pending_visual_count", F.lit(0)).alias("pending"), F.coalesce("manifest_rows", F.lit(0)).cast("bigint").alias("manifest_rows"), F.coalesce("missing_crops", F.lit(0)).cast("bigint").alias("missing_crops"))


def visual_review(spark, d):
    return validation.visual_review(_raw(spark, d), _manifest(spark, d), artefacts(spark, d))


def validation_summary(spark, d):
    raw = _raw(spark, d)
    return validation.report_summary(_report(spark, d), validation.visual_review(raw, _manifest(spark, d), artefacts(spark, d)), validation.duplicate_texts(raw))


def queue_summary(spark, d):
    return queueing.summary(_queue(spark, d)[0])


def _manifest(spark, d):
    """The driver's table names its `order` otherwise."""
    return table(spark, d, "visual_manifest").withColumnRenamed("order_no", "order")


def _candidates(spark, d):
    """Candidate texts of three methods for each record: whole, without its last half, and failed or whole, by row."""
    raw, t = _raw(spark, d).filter("raw_text is not null"), F.col("raw_text")
    forms = F.array(
        F.struct(F.lit("first").alias("method"), F.lit(1).alias("method_rank"), F.when(F.col("row_id") % 3 == 0, F.substring(t, F.lit(1), F.floor(F.length(t) / 2).cast("int"))).otherwise(t).alias("text"), F.lit(True).alias("ok")),
        F.struct(F.lit("second").alias("method"), F.lit(2).alias("method_rank"), t.alias("text"), (F.col("row_id") % 2 == 0).alias("ok")),
        F.struct(F.lit("third").alias("method"), F.lit(3).alias("method_rank"), F.concat(t, F.when(F.col("row_id") % 5 == 0, "x").otherwise("")).alias("text"), (F.col("row_id") % 7 != 0).alias("ok")),
    )
    return raw.select(F.col("row_id").cast("string").alias("variant_id"), F.explode(forms).alias("c")).select("variant_id", "c.*")


def word_best_candidate(spark, d):
    return validation.best_candidate(_candidates(spark, d)).select("variant_id", "method", "char_count", F.array_join(F.transform(F.array_sort(F.map_entries("stats")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("stats"))


def _word(spark, d):
    """(rows, candidates) of a Word stage: formats, failures and the structured conversion by row."""
    raw, t, k = _raw(spark, d), F.col("raw_text"), F.col("row_id")
    rows = raw.select(k.cast("string").alias("variant_id"), "source_path", F.when(k % 4 == 0, "doc").otherwise("docx").alias("source_format"), "language_hint")
    one = lambda method, rank, source, text, ok: F.struct(F.lit(method).alias("method"), F.lit(rank).alias("method_rank"), F.lit(source).alias("source"), F.when(ok, text).alias("text"), ok.alias("ok"), F.when(~ok, F.concat(F.lit("broken "), F.lit(method))).alias("error"))
    half = F.substring(t, F.lit(1), F.floor(F.length(t) / 2).cast("int"))
    forms = F.array(one("first", 1, "native", F.when(k % 3 == 0, half).otherwise(t), k % 11 != 0), one("second", 2, "native", t, k % 2 == 0), one("third", 1, word.STRUCTURED, F.concat(t, F.when(k % 5 == 0, " x").otherwise("")), k % 7 != 0))
    return rows, raw.filter("raw_text is not null").select(k.cast("string").alias("variant_id"), F.explode(forms).alias("c")).select("variant_id", "c.*")


def word_rows(spark, d):
    """Parsed rows of the Word stage."""
    rows, found = _word(spark, d)
    parsed, _ = word.parsed_rows(rows, found, CFG.min_chars)
    stats = F.array_join(F.transform(F.array_sort(F.map_entries("extractor_stats")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return parsed.withColumns({"extractor_stats": stats, "quality_flags": F.array_join("quality_flags", ","), "raw_text": F.md5(F.col("raw_text").cast("binary"))})


def word_failures(spark, d):
    rows, found = _word(spark, d)
    return word.parsed_rows(rows, found, CFG.min_chars)[1]


def word_summary(spark, d):
    rows, found = _word(spark, d)
    todo = rows.filter(F.col("variant_id").cast("bigint") % 9 != 0)
    parsed, failed = word.parsed_rows(todo, found, CFG.min_chars)
    return word.summary(rows, todo, parsed, failed)


def word_selection(spark, d):
    """Word rows of the registry of unknown language, the hundred after the first ten by path."""
    rows = table(spark, d, "registry").groupBy("variant_id").agg(F.max(F.struct("source_path", "source_format", "source_extension", "language_hint")).alias("m")).select("variant_id", "m.*")
    return word.word_rows_of(rows, None, True, 10, 100).select("variant_id", "source_path")


def failures_split(spark, d):
    ok, failed = extraction.split_by_status(_candidates(spark, d))
    return ok.groupBy("method").agg(F.count(F.lit(1)).alias("n")).withColumn("status", F.lit("ok")).unionByName(failed.groupBy("method").agg(F.count(F.lit(1)).alias("n")).withColumn("status", F.lit("failed")))


_NOT_QUERIES = {"spread", "table", "listing", "oracle_sql", "queries", "artefacts"}


def queries() -> dict:
    here = globals()
    return {k: f for k, f in here.items() if callable(f) and getattr(f, "__module__", "") == __name__ and not k.startswith("_") and k not in _NOT_QUERIES}
