"""Operators on small tables: selection invariants, queue, blocks, merging, validation, extraction, sources."""

import io
import json
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from corvane.config import Settings
from corvane.functions.pdf_objects import Document
from corvane.operators import blocks, durable, extraction, merging, pdf, queueing, registry, validation, word
from corvane.plans import catalog, stages
from corvane.sources import readers, writers
from corvane.streaming import incremental

SF = "/root/testdata/sf0.001"
ROOT = "data/raw_guidelines"
FILES = [
    (f"{ROOT}/К/Б/протокол_ru.docx", 2048), (f"{ROOT}/К/Б/протокол 2_ru.docx", 4096), (f"{ROOT}/К/Б/протокол_ru.pdf", 100), (f"{ROOT}/К/Б/протокол лат.doc", 1), (f"{ROOT}/Н/В/стандарт лист.pdf", 10),
    (f"{ROOT}/Н/В/стандарт лист 2.pdf", 20), (f"{ROOT}/Н/В/~$стандарт.docx", 1), (f"{ROOT}/Н/В/a.txt", None), (f"{ROOT}/Н/В/рецензия стандарт.pdf", 5), (None, 1), (f"{ROOT}/Н/В/стандарт лист.pdf", 10),
]


def files(spark):
    return spark.createDataFrame(FILES, "path string, length bigint")


def test_registry(spark):
    out = stages.build_registry(files(spark), Settings())
    rows = {r.source_path.split("/")[-1]: r for r in out["registry"].collect()}
    assert rows["протокол 2_ru.docx"].selected and rows["протокол 2_ru.docx"].selection_reason == "word_primary_best_for_language_ru"
    assert rows["протокол_ru.docx"].selection_reason == f"duplicate_of_{rows['протокол 2_ru.docx'].variant_id}"
    assert rows["протокол_ru.pdf"].selection_reason == "pdf_backfill_candidate_word_exists"
    assert rows["стандарт лист 2.pdf"].selected and not rows["стандарт лист.pdf"].selected  # one key, the larger wins
    assert {(r.filename, r.skip_reason) for r in out["skipped"].collect()} == {("~$стандарт.docx", "temporary_word_lock_file"), ("a.txt", "unsupported_extension"), ("рецензия стандарт.pdf", "review_or_expert_document")}
    plan = {(r.doc_type, r.requested_language): (r.resolved_language, r.fallback_type) for r in out["fallback_plan"].collect()}
    assert plan["protocol", "uz_cyr"] == ("ru", "fallback") and plan["protocol", "uz_lat"] == ("uz_lat", "exact") and plan["standard", "ru"] == ("unknown", "fallback")
    n = out["inventory"].count()
    assert n == out["selected"].count() + out["rejected"].count() + out["pdf_backfill"].count() == 6


def test_inventory_has_gaps_for_reviews(spark):
    ids = [r.inventory_id for r in stages.build_registry(files(spark), Settings())["inventory"].orderBy("inventory_id").collect()]
    kept = [r.inventory_id for r in stages.build_registry(files(spark), Settings(include_reviews=True))["inventory"].orderBy("inventory_id").collect()]
    assert len(kept) == len(ids) + 1 and set(ids) < set(kept) and kept[0] == "inv_000001"


def test_registry_of_nothing(spark):
    out = stages.build_registry(files(spark).limit(0), Settings())
    assert all(out[k].count() == 0 for k in ("inventory", "registry", "skipped", "grouped", "fallback_plan", "counters"))


def test_selection_invariants(spark):
    rows = catalog._selection(spark, SF)
    bad = rows.groupBy("disease_class_id", "doc_type", "language_hint", F.when(F.col("language_hint") == "unknown", F.col("normalized_file_key"))).agg(F.count_if("selected").alias("n"), F.max(F.col("selection_reason").startswith("pdf_back")).alias("b")).filter("n > 1 or n = 0 and not b")
    assert bad.count() == 0


def test_queue(spark):
    rows = spark.createDataFrame(
        [("v1", "a.pdf", "pdf", ".pdf", True, "x"), ("v1", "a.pdf", "pdf", ".pdf", True, "x"), ("v2", "b.pdf", None, ".PDF", False, "pdf_backfill_candidate_word_exists"), ("v3", "c.pdf", "pdf", None, True, "x"), ("v4", "d.docx", "docx", ".docx", True, "x"), ("v5", None, "pdf", ".pdf", None, None)],
        "variant_id string, source_path string, source_format string, source_extension string, selected boolean, selection_reason string",
    ).withColumns({c: F.lit("") for c in ("specialty", "disease_path", "doc_type", "language_hint")})
    have = spark.createDataFrame([("a.pdf",), ("b.pdf",), ("d.docx",)], "path string")
    queue, failed = queueing.build_queue(rows, have, Settings())
    assert sorted((r.variant_id, r.ocr_reason) for r in queue.collect()) == [("v1", queueing.PRIMARY), ("v2", queueing.BACKFILL)]
    assert [(r.variant_id, r.reason) for r in failed.collect()] == [("v3", "selected_pdf_source_missing")]
    assert [r.variant_id for r in queueing.by_reason(queue, "backfill").collect()] == ["v2"]
    assert queueing.not_done(queue, queue.filter("variant_id = 'v1'")).count() == 1
    assert queueing.ordered(queue, limit=1).count() == 1


def test_blocks(spark):
    pages = spark.createDataFrame([("v", p, 100.0, 100.0, c, t) for p, c, t in ((1, 5, None), (2, 50, " native "), (3, 0, ""), (4, 40, "x"))], "variant_id string, page int, width_pts double, height_pts double, text_chars int, native_text string")
    item = lambda kind, seq, text, md, label, t: ("v", 1, 1, kind, seq, label, text, md, 1, 0.0, t, 50.0, t - 10.0)
    items = spark.createDataFrame(
        [item("text", 0, "second", "", "text", 80.0), item("text", 1, "first", "", "caption", 90.0), item("picture", 0, "", "", "chart", 70.0), item("text", 2, "third", "", "text", 60.0), item("table", 0, "", "| a |", "table", 50.0), ("v", 1, 1, "text", 9, "t", "lost", "", 9, 0.0, 9.0, 5.0, 1.0), ("v", 1, 1, "text", 8, "t", "flat", "", 1, 0.0, 9.0, 0.0, 1.0)],
        "variant_id string, batch_no int, batch_start_page int, kind string, item_seq int, label string, text string, markdown string, local_page int, l double, t double, r double, b double",
    )
    out = stages.assemble_pdf(items, pages)
    got = [(r.page, r.order, r.type, r.fallback) for r in out["blocks"].orderBy("order").collect()]
    assert got == [(1, 0, "text", False), (1, 1, "text", False), (1, 2, "pending_visual", False), (1, 3, "text", False), (1, 4, "table", False), (2, 5, "text", True), (3, 6, "pending_visual", True), (4, 7, "text", True)]
    m = {r.page * 100 + r.order: r for r in out["visual_manifest"].collect()}
    assert (m[102].before_text, m[102].after_text, m[102].caption, m[102].suggested_type) == ("first\nsecond", "third\n| a |", "", "chart")
    assert m[104].suggested_type == "complex_table" and m[306].before_text == ""
    assert out["raw_text"].first().raw_text == "first\n\nsecond\n\nthird\n\n| a |\n\nnative\n\nx"
    md = out["markdown"].first().markdown
    assert md.startswith("<!-- page 1 -->\n\n\nfirst") and "[PENDING_VISUAL asset_id=v_p0001_b000002 type=chart]" in md and md.count("<!-- page") == 4
    nested = out["agentic"].first()
    assert len(nested.pages) == 4 and nested.classification.kind == "mixed" and nested.processing.total_blocks == 8 and [b.status for b in nested.batches] == ["ok"]
    record = out["parsed_docling"].first()
    assert record.page_count == 4 and record.pending_visual_count == 3 and record.quality_flags == ["low_char_count", "pdf_low_char_count", "pending_visual_assets", "unknown_detected_language"]
    images = spark.createDataFrame([("v", 1, 1000, 1000), ("v", 1, 1000, 1000)], "variant_id string, page int, width int, height int")
    seen = {r.order: (r.visual and r.visual.crop, r.reasons) for r in blocks.with_visuals(blocks.assemble_blocks(items, pages), images).filter(blocks.is_visual()).collect()}
    assert seen[2][0].left == 0 and seen[2][0].top == 288 and seen[6] == (None, ["page_without_blocks", "page_image_missing_for_visual_crop"])
    assert blocks.visual_manifest(blocks.assemble_blocks(items, pages), images).count() == 2
    assert out["document_class"].first().document_class == "mixed"


def test_context_after_caption_block(spark):
    rows = spark.createDataFrame([("v", 1, 0, "text", "Рис. 1", "", "caption"), ("v", 1, 1, "pending_visual", "", "", "p"), ("v", 1, 2, "pending_visual", "", "", "p")], "variant_id string, page int, order int, type string, text string, markdown string, label string")
    got = {r.order: (r.before_text, r.caption) for r in blocks.with_context(rows).collect()}
    assert got == {0: ("", ""), 1: ("Рис. 1", "Рис. 1"), 2: ("Рис. 1", "Рис. 1")}


def test_merge_and_validate_edge_rows(spark):
    parsed = spark.read.parquet(f"{SF}/parsed_docling.parquet")
    nothing = parsed.limit(1).select(*(F.lit(None).cast(t).alias(n) for n, t in parsed.dtypes))
    rows = merging.merged(nothing, "row_id").first()
    assert (rows.detected_language, rows.final_language, rows.char_count, rows.quality_flags, rows.pending_visual_count) == ("unknown", "unknown", 0, ["empty_text", "unknown_detected_language"], 0)
    assert merging.merged(parsed.limit(0), "row_id").count() == 0
    raw = spark.read.parquet(f"{SF}/parsed_guidelines_raw.parquet")
    none = raw.limit(1).select(*(F.lit(None).cast(t).alias(n) for n, t in raw.dtypes))
    art = spark.createDataFrame([], "path string")
    r = validation.quality_report(none, art, spark.read.parquet(f"{SF}/visual_manifest.parquet"), 500).first()
    assert r.needs_review and "missing_markdown_output" in r.review_flags and "non_pdf_row_in_pdf_only_validation" in r.review_flags


def test_best_candidate(spark):
    rows = spark.createDataFrame([("a", "m1", 1, "xx", True), ("a", "m2", 2, "yy", True), ("a", "m3", 3, None, False), ("b", "m1", 1, None, False)], "variant_id string, method string, method_rank int, text string, ok boolean")
    got = {r.variant_id: (r.method, r.stats) for r in validation.best_candidate(rows).collect()}
    assert got == {"a": ("m1", {"m1": 2, "m2": 2, "m3": -1}), "b": (None, {"m1": -1})}


def test_extraction(spark):
    W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = f"<w:document {W}><w:body><w:p><w:r><w:t>Один</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p><w:r><w:t>Два</w:t></w:r></w:p></w:body></w:document>"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", body)
    rows = spark.createDataFrame([("v1", "docx", bytearray(buf.getvalue())), ("v2", "docx", bytearray(b"broken")), ("v3", "doc", bytearray(b"")), ("v4", "txt", None)], "variant_id string, source_format string, content binary")
    got = {(r.variant_id, r.method): r for r in extraction.candidates(rows).collect()}
    assert got["v1", "docling_docx_simple_pipeline"].text == "Один\n\n| a | b |\n|---|---|\n\nДва" and got["v1", "docx_all_parts"].ok
    assert got["v1", "docx_in_order"].text == "Один\n\na\n\nb\n\nДва" and got["v1", "docx_paragraphs_then_tables"].text == "Один\nДва\na | b"
    assert not got["v2", "docx_in_order"].ok and "converter" in got["v3", None].error or not extraction.shutil.which("soffice") and not got["v4", "plain_text"].ok


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1, "y": "а"}\n\nbroken\n{"x": 2, "y": null}\n', encoding="utf-8")
    assert sorted(r.x for r in readers.json_lines(spark, str(tmp_path / "a.jsonl"), "x int, y string").collect() if r.x) == [1, 2]
    assert readers.json_lines(spark, str(tmp_path / "none.jsonl"), "x int").count() == 0
    (tmp_path / "b.csv").write_text('﻿id,n\nv1,"1"\nv2,x\n', encoding="utf-8")
    assert [(r.id, r.n, r.z) for r in readers.csv_rows(spark, str(tmp_path / "b.csv"), "id string, n int, z string").orderBy("id").collect()] == [("v1", 1, None), ("v2", None, None)]
    df = spark.createDataFrame([("v1", ["a"]), ("v2", None)], "variant_id string, flags array<string>")
    writers.write_csv(df, str(tmp_path / "c"), ["variant_id", "flags", "more"])
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["variant_id", "flags", "more"]
    writers.append_failures(df, str(tmp_path / "f"), "r1")
    writers.append_failures(df, str(tmp_path / "f"), "r2")
    assert spark.read.json(str(tmp_path / "f")).count() == 4
    writers.write_by_variant(df, str(tmp_path / "v"))
    writers.write_summary({"а": 1}, str(tmp_path / "s" / "s.json"))
    assert json.loads((tmp_path / "s" / "s.json").read_text(encoding="utf-8")) == {"а": 1}
    writers.write_csv(df, str(tmp_path / "m"), ["variant_id"], mark=True)
    assert all(p.read_bytes().startswith(b"\xef\xbb\xbfvariant_id") for p in (tmp_path / "m").glob("*.csv"))
    assert writers.header_union(df, df.withColumn("z", F.lit(1)).select("z", "flags")) == ["variant_id", "flags", "z"]
    (tmp_path / "run" / "merged").mkdir(parents=True)
    (tmp_path / "run" / "data" / "pdf_visual_assets" / "v1" / "pages").mkdir(parents=True)
    (tmp_path / "run" / "data" / "pdf_visual_assets" / "v1" / "pages" / "p.png").write_bytes(b"1")
    (tmp_path / "run" / "data" / "pdf_visual_assets" / "v1" / "m.jsonl").write_text("{}")
    with zipfile.ZipFile(writers.pack(str(tmp_path / "run"), str(tmp_path / "export"))) as z:
        names, manifest = z.namelist(), json.loads(z.read("export_manifest.json"))
    assert "data/pdf_visual_assets/v1/m.jsonl" in names and not any("p.png" in n for n in names)
    assert manifest["contents"] == ["merged", "data/pdf_visual_assets"] and manifest["contains_complex_visual_crops"] and not manifest["contains_validation_reports"]
    assert [r.n for r in readers.broken_json(spark, str(tmp_path / "a.jsonl")).collect()] == [1]
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "a.jsonl"), "x int, y string", strict=True).collect()
    for v in ("v2", "v1"):
        (tmp_path / "files" / v).mkdir(parents=True)
        (tmp_path / "files" / v / "parsed.json").write_text(json.dumps({"variant_id": v, "n": 1}))
        (tmp_path / "word" / v).parent.mkdir(exist_ok=True)
        (tmp_path / "word" / f"{v}.json").write_text(json.dumps({"variant_id": v}))
    (tmp_path / "files" / "v3").mkdir()
    (tmp_path / "files" / "v3" / "parsed.json").write_text("{broken")
    for v in ("v1", "v3"):
        (tmp_path / "assets" / v).mkdir(parents=True)
        (tmp_path / "assets" / v / "visual_manifest.jsonl").write_text(json.dumps({"variant_id": v, "asset_id": "a"}) + "\n")
    rows, manifest = readers.rebuilt_docling(spark, str(tmp_path / "files"), str(tmp_path / "assets"), "variant_id string, n int", "variant_id string, asset_id string")
    assert [r.variant_id for r in rows.collect() if r.variant_id] == ["v1", "v2"] and [tuple(r) for r in manifest.collect()] == [("v1", "a")]
    assert [r.variant_id for r in readers.rebuilt_word(spark, str(tmp_path / "word"), "variant_id string").collect()] == ["v1", "v2"]
    df.write.parquet(str(tmp_path / "raw"))
    assert readers.validation_source(spark, str(tmp_path / "raw"), str(tmp_path / "none"), True).count() == 2
    assert readers.first_filled(df.limit(0), df).count() == 2


def test_incremental_listing(spark, tmp_path):
    tree = tmp_path / "tree" / "К"
    tree.mkdir(parents=True)
    (tree / "a.pdf").write_bytes(b"1")
    for n in ("b.docx", None):
        stream = incremental.registered(incremental.new_files(spark, str(tmp_path / "tree")), Settings(raw_root=str(tmp_path / "tree")))
        incremental.run_once(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
        if n:
            (tree / n).write_bytes(b"22")
    assert sorted(r.filename for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a.pdf", "b.docx"]
    assert readers.list_files(spark, str(tmp_path / "tree")).count() == 2
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path / "tree"))
    assert sum(r.files for r in incremental.daily_counts(found).collect()) == 2


def test_numbered_is_dense(spark):
    df = spark.range(500).withColumn("k", F.md5(F.col("id").cast("string")))
    got = registry.numbered(df, F.col("k")).orderBy("k").select("ordinal").collect()
    assert [r.ordinal for r in got] == list(range(1, 501))


def test_durable_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        class _jsc:
            sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isEmpty": staticmethod(lambda: True)}))}))

    session = type("Session", (), {"sparkContext": Context, "conf": type("C", (), {"get": staticmethod(lambda k, default=None: default)})})
    with pytest.raises(RuntimeError, match="checkpoint"):
        durable.durable(type("Frame", (), {"sparkSession": session}))
    assert durable.durable(spark.range(3)).count() == 3


def make_pdf(*pages, packed=False):
    """A small PDF of pages (width, height, text)."""
    cmap = b"beginbfchar <0041> <0416> endbfchar beginbfrange <0061> <0063> <0430> endbfrange"
    objects = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [%s] /Count %d >>" % (b" ".join(b"%d 0 R" % (5 + 2 * k) for k in range(len(pages))), len(pages)), b"<< /Type /Font /ToUnicode 4 0 R >>", b"<< /Length %d >>\nstream\n%s\nendstream" % (len(cmap), cmap)]
    for k, (w, h, text) in enumerate(pages):
        data = b"BT /F1 12 Tf " + b" T* ".join(b"<%s> Tj" % "".join(f"{c:04x}" for c in line).encode() if isinstance(line, list) else b"/F0 9 Tf (%s) Tj" % line for line in text) + b" ET"
        if packed:
            data = zlib.compress(data)
        objects.append(b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %g %g] /Resources << /Font << /F1 3 0 R >> >> /Contents %d 0 R >>" % (w, h, 6 + 2 * k))
        objects.append(b"<< /Length %d %s>>\nstream\n%s\nendstream" % (len(data), b"/Filter /FlateDecode " if packed else b"", data))
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (k, o) for k, o in enumerate(objects, 1)) + b"trailer << /Root 1 0 R >>"


def test_pages_of_a_pdf():
    for packed in (False, True):
        got = Document(make_pdf((595, 842, [b"First \\(line\\)", b"second"]), (300.5, 200, [[0x41, 0x61, 0x63]]), packed=packed)).pages()
        assert got == [(595, 842, "First (line)\nsecond"), (300.5, 200, "Жав")]
    for bad in (b"", b"no pdf", b"%PDF-1.4", b"%PDF-1.4 /Encrypt"):
        with pytest.raises(ValueError):
            Document(bad).pages()


def test_page_scan_and_layout(spark):
    whole = make_pdf(*((100, 200, [b"line %d" % k]) for k in range(10)))
    files = spark.createDataFrame([("a", bytearray(whole)), ("b", bytearray(b"broken")), ("c", None)], "variant_id string, content binary")
    scanned = pdf.scan_pages(files)
    got = {(r.variant_id, r.page): r for r in scanned.collect()}
    assert len(got) == 12 and got["a", 10].native_text == "line 9" and got["a", 1].text_chars == 6 and not got["b", None].ok and not got["c", None].ok
    pages = scanned.filter("ok")
    items = pdf.lay_out(files, pages, Settings(page_batch=4)).collect()
    assert sorted((i.batch_no, i.batch_start_page, i.local_page) for i in items) == [(k // 4 + 1, k // 4 * 4 + 1, k % 4 + 1) for k in range(10)] and all(i.ok for i in items)
    pdf.LAYOUT_BACKENDS["failing"] = lambda: lambda content, found: 1 / 0
    assert {(i.batch_no, i.ok) for i in pdf.lay_out(files, pages, Settings(page_batch=4), "failing").collect()} == {(1, False), (2, False), (3, False)}
    assert pdf.scan_pages(files.limit(0)).count() == 0


def docx(*paragraphs):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>' + "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs) + "</w:body></w:document>")
    return buf.getvalue()


def test_pipeline_from_a_folder(spark, tmp_path):
    root = tmp_path / "raw"
    for path, content in {
        "Кардиология/Анемия/протокол_ru.docx": docx("Клинический протокол лечения анемии. " * 20, "Диагностика и лечение."), "Кардиология/Анемия/протокол_ru.pdf": make_pdf((100, 100, [b"treatment of the patient I10"])),
        "Кардиология/Боль/протокол_ru.pdf": make_pdf((100, 200, [b"Code I10 of the protocol", b"second line"]), (100, 200, [])), "Кардиология/Боль/протокол лат.pdf": b"broken", "Кардиология/Боль/старый.doc": b"old",
    }.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(content)
    cfg = Settings(raw_root=str(root))
    files, content = readers.list_files(spark, str(root)), readers.contents(spark, str(root))
    reg = stages.build_registry(files, cfg)
    words = stages.extract_word(reg["registry"], content, None, cfg)
    assert [(r.extraction_method, r.extraction_source, r.needs_review) for r in words["parsed_word"].collect()] == [("docx_in_order", "native", False)]
    assert words["word_failures"].count() == 1 and words["summary"].first().registry_word_rows_considered == 2
    queue = stages.build_queue(reg["registry"], files, cfg)
    out = stages.extract_pdf(queue["ocr_queue"], content, None, cfg)
    parsed = out["parsed_docling"].cache()
    s = out["summary"].first()
    assert (s.ocr_rows_considered, s.parsed_ok, s.failed) == (queue["summary"].first().queue_total, 2, 1) and "not a PDF" in out["failures"].first().error
    two = {r.page_count: r for r in parsed.collect()}[2]
    assert two.raw_text == "Code I10 of the protocol\n\nsecond line" and two.icd_codes_detected == ["I10"] and two.pending_visual_count == 1 and two.docling_batch_count == 1
    merged = stages.merge(parsed.withColumn("row_id", F.monotonically_increasing_id()), cfg)
    artefacts = merged["merged"].select(F.explode(F.array("markdown_path", "agentic_json_path", "raw_docling_dir", "visual_manifest_path")).alias("path"))
    report = stages.validate(merged["merged"], artefacts, out["visual_manifest"], cfg)
    flags = {r.page_count: r.review_flags for r in report["quality_report"].collect()}
    assert "missing_visual_crop_files" in flags[2] and "missing_markdown_output" not in flags[2] and "visual_manifest_count_mismatch" not in flags[2]
    assert [(r.order, r.crop_exists) for r in report["visual_review"].collect()] == [(2, False)]
    r = report["summary"].first()
    assert (r.total_rows, r.needs_review_total, r.visual_asset_total, r.duplicate_groups) == (2, 2, 1, 0)
    assert stages.extract_pdf(queue["ocr_queue"], content, parsed, cfg)["summary"].first().parsed_ok == 0
    writers.write_summary(writers.summary_of(reg["summary"], reg["counters"]), str(tmp_path / "s.json"))
    assert json.loads((tmp_path / "s.json").read_text())["by_source_format"]["pdf"] == 3
    writers.write_word_artefacts(words["parsed_word"], str(tmp_path / "artefacts"))
    assert any(p.read_text().startswith("# протокол_ru\n\n") for p in (tmp_path / "artefacts" / "markdown").rglob("*.txt"))
    writers.write_manifests(out["visual_manifest"], str(tmp_path / "manifests"))
    assert spark.read.json(str(tmp_path / "manifests" / "by_variant")).count() == 1


def test_word_rows_edges(spark):
    rows = spark.createDataFrame([("a", "p/a.docx", "docx", "ru"), ("b", "p/b.doc", "doc", None), ("c", "p/c.docx", "docx", "unknown"), ("d", None, "docx", "unknown")], "variant_id string, source_path string, source_format string, language_hint string").withColumn("source_extension", F.concat(F.lit("."), "source_format"))
    found = spark.createDataFrame(
        [("a", "m1", 1, "native", "xx", True, None), ("a", "m1", 1, "native", "x", True, None), ("a", "s", 1, "docling", "yy", True, None), ("b", "m1", 1, "native", None, False, "bad"), ("b", "s", 1, "docling", "zzz", True, None), ("c", "m1", 1, "native", " ", True, None), ("c", None, None, "native", None, False, "none")],
        "variant_id string, method string, method_rank int, source string, text string, ok boolean, error string",
    )
    parsed, failed = word.parsed_rows(rows, found, 500)
    got = {r.variant_id: r for r in parsed.collect()}
    assert got["a"].extraction_method == "m1" and got["a"].extractor_stats == {"m1": 2} and got["a"].native_error is None
    assert got["b"].extraction_method == "doc_to_docx_s" and got["b"].native_error == "bad" and "native_extraction_error" in got["b"].quality_flags
    assert {r.variant_id for r in failed.collect()} == {"c", "d"}
    assert [r.variant_id for r in word.word_rows_of(rows, "docx", True, 0, 1).collect()] == ["d"] and word.word_rows_of(rows, "doc").count() == 1
    empty = word.parsed_rows(rows.limit(0), found.limit(0), 500)
    assert empty[0].count() == empty[1].count() == 0


def test_settings_from_texts(monkeypatch):
    monkeypatch.setenv("CORVANE_PAGE_BATCH", "0")
    monkeypatch.setenv("CORVANE_TIMEOUT_SECONDS", "1.5")
    cfg = Settings.from_mapping(Settings.environment() | {"include_reviews": " Yes ", "min_chars": "x", "ocr_languages": "ru, ,en"})
    assert (cfg.page_batch, cfg.timeout_seconds, cfg.include_reviews, cfg.min_chars, cfg.ocr_languages) == (1, 1.5, True, 500, ("ru", "en"))


def test_flag_ranking_ties_by_first_seen(spark):
    rows = spark.createDataFrame([("v2", "b; a"), ("v1", "c; b"), ("v3", None), ("v4", "")], "variant_id string, review_flags string")
    assert [(r.flag, r.n) for r in validation.flag_ranking(rows).collect()] == [("b", 2), ("c", 1), ("a", 1)]


def test_command_line(spark, tmp_path, monkeypatch):
    import sys

    from corvane import __main__ as cli

    root, out = tmp_path / "raw", tmp_path / "out"
    for path, content in {"К/Б/протокол_ru.docx": docx("Клинический протокол лечения. " * 30), "К/В/протокол_ru.pdf": make_pdf((100, 200, [b"Code I10"]), (100, 200, []))}.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(content)
    monkeypatch.setattr(cli.SparkSession.builder.__class__, "getOrCreate", lambda self: spark, raising=False)
    for stage in ("registry", "queue", "word", "pdf", "merge", "validate", "word", "pack"):
        monkeypatch.setattr(sys, "argv", ["corvane", stage, "--in", str(out), "--out", str(out), "--raw", str(root)])
        cli.main()
    assert spark.read.parquet(str(out / "parsed_word")).count() == 1 and spark.read.parquet(str(out / "parsed_docling")).count() == 1
    assert json.loads((out / "validate_summary.json").read_text())["total_rows"] == 1
    assert json.loads((out / "word_summary.json").read_text())["skipped_existing"] == 1
    assert (tmp_path / "out.zip").exists()
