"""Writers. Tables are written by the output committer, so that readers never see half a table."""

from __future__ import annotations

import json
import os
import shutil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.extraction import markdown_of


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def append_failures(df: DataFrame, path: str, run_id: str) -> None:
    write_json_lines(df.withColumn("run_id", F.lit(run_id)), path, "append")


def flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON texts, as CSV needs them."""
    return df.select(*(F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes))


def header_union(*tables: DataFrame) -> list[str]:
    """Columns of several tables in the order in which they are first seen."""
    return list(dict.fromkeys(c for t in tables for c in t.columns))


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, mark: bool = False) -> None:
    """A CSV table with a header; the listed columns, missing ones as empty. An empty table still has its header.
    With `mark` every file begins with a byte order mark, as spreadsheets want it."""
    out = flat(df)
    if columns:
        out = out.select(*(F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns))
    if mark:
        out = out.toDF(f"\ufeff{out.columns[0]}", *out.columns[1:])
    out.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_by_variant(df: DataFrame, path: str) -> None:
    """One folder a variant."""
    df.repartition("variant_id").write.mode("overwrite").partitionBy("variant_id").parquet(path)


def write_word_artefacts(parsed: DataFrame, folder: str) -> None:
    """<folder>/markdown and <folder>/json: a text and a JSON record of each variant, one folder a variant."""
    title = F.regexp_replace(F.element_at(F.split("source_path", "/"), -1), r"\.[^.]+$", "")
    markdown = parsed.select("variant_id", markdown_of(title, F.col("raw_text")).alias("value"))
    markdown.repartition("variant_id").write.mode("overwrite").partitionBy("variant_id").text(f"{folder}/markdown")
    record = parsed.select("variant_id", F.to_json(F.struct(*parsed.columns), {"ignoreNullFields": "false"}).alias("value"))
    record.repartition("variant_id").write.mode("overwrite").partitionBy("variant_id").text(f"{folder}/json")


def write_manifests(manifest: DataFrame, folder: str) -> None:
    """The manifest of each variant in a folder of its own, and the whole as one CSV table."""
    manifest.repartition("variant_id").write.mode("overwrite").option("ignoreNullFields", False).partitionBy("variant_id").json(f"{folder}/by_variant")
    write_csv(manifest, f"{folder}/csv", "variant_id asset_id page order block_id suggested_type crop_path status caption".split())


def summary_of(counts: DataFrame, *counters: DataFrame) -> dict:
    """A summary for write_summary: the one row of `counts`, and each counter of (counter, key, n) tables under by_<counter>."""
    out = counts.first().asDict() if counts is not None else {}
    for table in counters:
        for r in table.orderBy(F.desc("n"), "key").toLocalIterator():
            out.setdefault(f"by_{r['counter']}", {})[r["key"]] = r["n"]
    return out


def write_summary(row: dict, path: str) -> None:
    """A small JSON document of the driver, put in place in one step."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.tmp", "w", encoding="utf-8") as f:
        json.dump(row, f, ensure_ascii=False, indent=2, default=str)
    os.replace(f"{path}.tmp", path)


#: What an export holds, where it exists: tables and reports, then folders of each variant. Page images are never packed.
EXPORTED = (
    "merged", "grouped", "summary", "parsed_docling", "visual_manifest", "quality_report", "needs_review", "visual_review", "duplicates", "flag_ranking", "counters",
    "data/parsed_docling", "data/parsed_pdf_agentic", "data/parsed_pdf_docling_raw", "data/pdf_visual_assets",
)


def pack(folder: str, archive: str, parts: tuple[str, ...] = EXPORTED, created_at: str | None = None) -> str:
    """A zip of the listed parts of a folder that exist, with export_manifest.json on what is in it and what is missing."""
    import datetime

    target = f"{archive}.export"
    shutil.rmtree(target, ignore_errors=True)
    os.makedirs(target)
    found = [p for p in parts if os.path.exists(os.path.join(folder, p))]
    for p in found:
        source, to = os.path.join(folder, p), os.path.join(target, p)
        if os.path.isdir(source):
            shutil.copytree(source, to, ignore=shutil.ignore_patterns("pages"))
        else:
            os.makedirs(os.path.dirname(to), exist_ok=True)
            shutil.copy2(source, to)
    has = lambda *names: any(n in found for n in names)
    manifest = {
        "created_at": created_at or datetime.datetime.now().astimezone().isoformat(timespec="seconds"), "contents": found, "missing": [p for p in parts if p not in found], "contains_raw_guidelines": False, "contains_word_outputs": has("parsed_word"),
        "contains_pdf_extraction_json": has("parsed_docling", "data/parsed_docling"), "contains_rendered_page_images": False, "contains_complex_visual_crops": has("data/pdf_visual_assets"), "contains_validation_reports": has("quality_report"), "vlm_status": "deferred",
    }
    write_summary(manifest, os.path.join(target, "export_manifest.json"))
    out = shutil.make_archive(archive, "zip", target)
    shutil.rmtree(target)
    return out
