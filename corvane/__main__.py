"""Command line: python -m corvane STAGE --in DIR --out DIR [--raw DIR] [--set name=value ...]

Stages read the tables that earlier stages wrote and write theirs below --out: registry, queue, word, pdf (page scan, layout and
assembly), assemble (of items that a layout engine gave), merge, validate, pack. Each stage also writes summary.json.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .operators import queueing
from .plans import stages
from .sources import readers, writers


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = os.path.join(folder, name)
    return spark.read.parquet(path if os.path.exists(path) else f"{path}.parquet")


def _done(spark: SparkSession, a: argparse.Namespace, name: str) -> DataFrame | None:
    path = os.path.join(a.out, name)
    return spark.read.parquet(path) if os.path.exists(path) and not a.force else None


def run(spark: SparkSession, a: argparse.Namespace) -> dict[str, DataFrame]:
    cfg = Settings.from_mapping({**Settings.environment(), **{k: v for k, v in {"raw_root": a.raw}.items() if v}, **dict(x.split("=", 1) for x in a.set)})
    t = lambda name: _table(spark, a.source, name)
    if a.stage == "registry":
        return stages.build_registry(readers.list_files(spark, cfg.raw_root), cfg)
    if a.stage == "queue":
        return stages.build_queue(t("registry"), readers.list_files(spark, cfg.raw_root), cfg)
    if a.stage == "word":
        return stages.extract_word(t("registry"), readers.contents(spark, cfg.raw_root), _done(spark, a, "parsed_word"), cfg, a.only_format, a.only_unknown, a.start, a.limit)
    if a.stage == "pdf":
        return stages.extract_pdf(queueing.ordered(t("ocr_queue"), a.limit or None, a.start), readers.contents(spark, cfg.raw_root), _done(spark, a, "parsed_docling"), cfg, only=a.only)
    if a.stage == "assemble":
        return stages.assemble_pdf(t("layout_items"), t("page_info"), cfg=cfg)
    if a.stage == "merge":
        rows = t("parsed_docling")
        return stages.merge(rows if "row_id" in rows.columns else rows.withColumn("row_id", F.col("variant_id")), cfg)
    listed = readers.list_files(spark, a.artefacts) if a.artefacts else spark.createDataFrame([], "path string")
    rows = t("parsed_guidelines_raw") if os.path.exists(os.path.join(a.source, "parsed_guidelines_raw.parquet")) else t("merged")
    manifest = t("visual_manifest")
    return stages.validate(rows, listed, manifest.withColumnRenamed("order_no", "order"), cfg, t("cleaned") if a.prefer_cleaned and os.path.exists(os.path.join(a.source, "cleaned")) else None)


def main() -> None:
    p = argparse.ArgumentParser(prog="corvane", description=__doc__)
    p.add_argument("stage", choices=["registry", "queue", "word", "pdf", "assemble", "merge", "validate", "pack"])
    p.add_argument("--in", dest="source", default=".")
    p.add_argument("--out", required=True)
    p.add_argument("--raw")
    p.add_argument("--run-id", default="run", help="names the run in logs of failures")
    p.add_argument("--only", choices=["backfill", "primary"])
    p.add_argument("--only-format", choices=["docx", "doc"])
    p.add_argument("--only-unknown", action="store_true")
    p.add_argument("--prefer-cleaned", action="store_true")
    p.add_argument("--force", action="store_true")
    p.add_argument("--start", type=int, default=0)
    p.add_argument("--limit", type=int, default=0)
    p.add_argument("--artefacts")
    p.add_argument("--set", action="append", default=[], metavar="name=value")
    a = p.parse_args()
    if a.stage == "pack":
        print(writers.pack(a.out, a.out.rstrip("/")))
        return
    spark = SparkSession.builder.appName(f"corvane-{a.stage}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    out = run(spark, a)
    for name, df in out.items():
        mode = "append" if name in ("parsed_word", "parsed_docling", "page_info", "visual_manifest") and not a.force and a.stage in ("word", "pdf") else "overwrite"
        df.write.mode(mode).parquet(os.path.join(a.out, name))
    stored = lambda name: spark.read.parquet(os.path.join(a.out, name))
    if a.stage == "word":
        writers.append_failures(stored("word_failures"), os.path.join(a.out, "word_failures_log"), a.run_id)
        writers.write_word_artefacts(stored("parsed_word"), os.path.join(a.out, "parsed_word_files"))
    if a.stage == "pdf":
        writers.append_failures(stored("failures"), os.path.join(a.out, "failures_log"), a.run_id)
        writers.write_manifests(stored("visual_manifest"), os.path.join(a.out, "visual_manifests"))
    if a.stage == "validate":
        for name in ("quality_report", "needs_review", "visual_review", "duplicates"):
            writers.write_csv(stored(name), os.path.join(a.out, f"{name}_csv"), mark=True)
    if "summary" in out:
        written = [spark.read.parquet(os.path.join(a.out, n)) for n in ("summary", "counters") if n in out]
        writers.write_summary(writers.summary_of(*written), os.path.join(a.out, f"{a.stage}_summary.json"))


if __name__ == "__main__":
    main()
