"""Registry of a file tree: inventory, best variants, backfill, groups, fallback plan, counters.

Empty listings give empty tables; null paths are dropped; extra columns of a listing are not read. Ties of priority and
size are broken by path. Repeated paths count as one file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import paths as P
from ..functions import rules as R
from .durable import durable

VARIANT = "variant_id inventory_id disease_class_id clinical_doc_group_id specialty disease_path doc_type language_hint source_format source_extension priority size_kb normalized_file_key source_path filename".split()


def scan(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(supported files, skipped files with their reason) of a listing (path, length)."""
    path = F.col("path")
    listed = files.filter(path.isNotNull()).groupBy("path").agg(F.max("length").alias("length"))
    skipped = listed.filter(~P.is_supported(path)).select(
        "path", P.name(path).alias("filename"), P.extension(path).alias("extension"), F.when(P.is_lock_file(path), "temporary_word_lock_file").otherwise("unsupported_extension").alias("skip_reason")
    )
    return listed.filter(P.is_supported(path)), skipped


def numbered(files: DataFrame, order: Column) -> DataFrame:
    """files with `ordinal`, from 1 in the given order, without a single global task.

    Rows are range-partitioned and sorted; a partition's offset is the sum of the counts before it (one row a partition).
    """
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = files.withColumn("_key", order).repartitionByRange(n, "_key").sortWithinPartitions("_key").withColumn("_part", F.spark_partition_id())
    # both uses must see the same ranges, which are sampled: the table is made once
    local = durable(ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_part").orderBy("_key"))))
    counts = local.groupBy("_part").agg(F.max("_local").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return local.join(F.broadcast(before.drop("_n")), "_part").withColumn("ordinal", F.col("_local") + F.col("_before")).drop("_key", "_part", "_local", "_before")


def inventory(files: DataFrame, cfg: Settings) -> tuple[DataFrame, DataFrame]:
    """(inventory, files left out as reviews). Ordinals count all supported files by path components, so ids may have gaps."""
    ranked = numbered(files, F.split("path", "/"))
    base = ranked.select(*(c.alias(n) for n, c in P.features(F.col("path"), F.col("length"), cfg).items()), F.format_string("inv_%06d", "ordinal").alias("inventory_id"), P.is_review(F.col("path")).alias("_review"))
    full = base.withColumns(P.group_ids())
    kept = full if cfg.include_reviews else full.filter(~F.col("_review"))
    reviews = full.filter(F.col("_review") & F.lit(not cfg.include_reviews)).select(F.col("source_path").alias("path"), "filename", F.col("source_extension").alias("extension"), F.lit("review_or_expert_document").alias("skip_reason"))
    return kept.select(*VARIANT), reviews


def select_variants(inv: DataFrame) -> DataFrame:
    """Every row of the inventory with `selected` and `selection_reason`.

    A group with any Word file is served by its Word files; its PDFs become backfill. One best file is kept for each known
    language, and for each file key of unknown language. Groups are reduced to pools with partial aggregation, the Word flag is
    taken from the pools, and rows are joined once with their pool, so that a group with a third of all files is never sorted in one task
    (adaptive execution splits the join of a hot pool).
    """
    inv = durable(inv)  # slim rows that are read twice
    group = ["disease_class_id", "doc_type"]
    known = F.col("language_hint").isin(*R.REQUESTED_LANGUAGES)
    rows = inv.withColumns({"_is_word": F.col("source_extension").isin(*R.WORD_EXTENSIONS), "_key": F.when(known, F.lit("")).otherwise(F.concat(F.lit("k"), "normalized_file_key"))})
    pool = [*group, "_is_word", "language_hint", "_key"]
    best = rows.groupBy(*pool).agg(F.min(F.struct("priority", (-F.coalesce("size_kb", F.lit(0.0))).alias("s"), "source_path", "variant_id")).alias("_b"))
    best = best.join(best.groupBy(*group).agg(F.max("_is_word").alias("_word")), group)
    rows = rows.join(best, pool).withColumns({"_best": F.col("_b.variant_id"), "_backfill": F.col("_word") & ~F.col("_is_word")})
    first = F.col("source_path") == F.col("_b.source_path")
    name = F.when(F.col("_word"), "word_primary").otherwise("pdf_primary_no_word_available")
    reason = (
        F.when(F.col("_backfill"), "pdf_backfill_candidate_word_exists")
        .when(~first, F.concat(F.lit("duplicate_of_"), "_best"))
        .when(known, F.concat(name, F.lit("_best_for_language_"), "language_hint"))
        .otherwise(F.concat(name, F.lit("_unknown_language_keep_for_content_detection")))
    )
    return rows.select(*inv.columns, (~F.col("_backfill") & first).alias("selected"), reason.alias("selection_reason"))


def selected(rows: DataFrame) -> DataFrame:
    return rows.filter("selected")


def backfill(rows: DataFrame) -> DataFrame:
    return rows.filter("selection_reason = 'pdf_backfill_candidate_word_exists'")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter("selection_reason like 'duplicate_of_%'")


SELECTED_ORDER = ("specialty", "disease_path", "doc_type", "language_hint", "priority", "source_path")


def grouped(sel: DataFrame) -> DataFrame:
    """One row a document: its languages and, for each, the selected variants in order."""
    key = ["disease_class_id", "doc_type"]
    per = sel.groupBy(*key, "language_hint").agg(
        F.min(F.struct("specialty", "disease_path", "clinical_doc_group_id")).alias("g"),
        F.array_sort(F.collect_list(F.struct("priority", "source_path", "variant_id", "source_format", "size_kb", "selection_reason"))).alias("rows"),
    )
    return per.groupBy(*key).agg(
        F.min("g").alias("g"), F.sort_array(F.collect_list("language_hint")).alias("available_languages"), F.map_from_entries(F.collect_list(F.struct("language_hint", "rows"))).alias("variants")
    ).select("disease_class_id", "g.clinical_doc_group_id", "g.specialty", "g.disease_path", "doc_type", "available_languages", "variants")


def fallback_plan(sel: DataFrame) -> DataFrame:
    """For each document and requested language the variant to use: of that language, else of the first in the fallback order.

    Only the first variant of each language is gathered, by partial aggregation, so a document of any number of variants is one small row."""
    key = ["disease_class_id", "doc_type"]
    first = sel.groupBy(*key, "language_hint").agg(F.min(F.struct("specialty", "disease_path", "clinical_doc_group_id")).alias("g"), F.min(F.struct("priority", "source_path", "variant_id", "source_format")).alias("v"))
    groups = first.groupBy(*key).agg(F.min("g").alias("g"), F.map_from_entries(F.collect_list(F.struct("language_hint", "v"))).alias("variants")).select(*key, "g.*", "variants")
    asked = groups.withColumn("requested_language", F.explode(F.array(*map(F.lit, R.REQUESTED_LANGUAGES))))
    have = F.col("variants")
    order = [F.col("requested_language"), *map(F.lit, R.FALLBACK_ORDER)]
    resolved = F.coalesce(*(F.when(F.map_contains_key(have, l), l) for l in order))
    rows = asked.withColumn("resolved_language", resolved).filter("resolved_language is not null").withColumn("_v", F.try_element_at(have, F.col("resolved_language")))
    return rows.select(
        "disease_class_id", "clinical_doc_group_id", "specialty", "disease_path", "doc_type", "requested_language", "resolved_language",
        F.when(F.col("requested_language") == F.col("resolved_language"), "exact").otherwise("fallback").alias("fallback_type"),
        F.col("_v.variant_id").alias("resolved_variant_id"), F.col("_v.source_format").alias("resolved_source_format"), F.col("_v.source_path").alias("resolved_source_path"),
    )


def counters(rows: DataFrame, *columns: str) -> DataFrame:
    """(counter, key, n) of each column's values, in one pass over the rows."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("counter"), F.col(c).cast("string").alias("key")) for c in columns)))
    return rows.select(pairs.alias("p")).groupBy("p.counter", "p.key").agg(F.count(F.lit(1)).alias("n"))


def summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("inventory_rows"), F.count_if("selected").alias("selected_rows"),
        F.count_if(F.col("selection_reason") == "pdf_backfill_candidate_word_exists").alias("backfill_rows"),
        F.count_if(F.col("selection_reason").startswith("duplicate_of_")).alias("duplicate_rows"),
        F.countDistinct("disease_class_id", "doc_type").alias("documents"),
    )
