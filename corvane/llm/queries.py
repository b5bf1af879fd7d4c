"""Queries of the problems and, where SQL can express them, their SQL."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import boilerplate, chars, encode, language, leaks, lookalike, mojibake, quality, residue, scanned, split


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{d}/{name}.parquet"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "parsed_docling")
    return scanned.repair(docs, scanned.fit(docs)).filter("defect is not null").select("row_id", "line_no", "defect")


def p1_text(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "parsed_docling")
    return scanned.repair(docs, scanned.fit(docs)).filter("defect is null").select("row_id", "text")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.repeated_lines(_t(spark, d, "parsed_guidelines_raw")).select("row_id", "line_no")


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.cleaned(_t(spark, d, "parsed_guidelines_raw")).select("row_id", "clean_text")


def p2_templates(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.templates(_t(spark, d, "parsed_guidelines_raw"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.garbled_rows(_t(spark, d, "parsed_guidelines_raw"), mojibake.sample_texts(_t(spark, d, "language_samples")))


def p3_text(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.repair(_t(spark, d, "parsed_guidelines_raw"), mojibake.sample_texts(_t(spark, d, "language_samples")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    vocab = lookalike.vocabulary(_t(spark, d, "common_words"), _t(spark, d, "language_samples"))
    return lookalike.same_looking_pairs(_t(spark, d, "parsed_guidelines_raw"), vocab)


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    vocab = lookalike.vocabulary(_t(spark, d, "common_words"), _t(spark, d, "language_samples"))
    return lookalike.look_classes(_t(spark, d, "parsed_guidelines_raw"), vocab)


def p4_text(spark: SparkSession, d: str) -> DataFrame:
    vocab = lookalike.vocabulary(_t(spark, d, "common_words"), _t(spark, d, "language_samples"))
    return lookalike.consistent(_t(spark, d, "parsed_guidelines_raw"), vocab)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return language.mislabelled(_t(spark, d, "parsed_guidelines_raw"), _t(spark, d, "language_samples"))


def p5_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.identify(_t(spark, d, "parsed_guidelines_raw"), _t(spark, d, "language_samples"))


def p6_statistics(spark: SparkSession, d: str) -> DataFrame:
    raw = _t(spark, d, "parsed_guidelines_raw")
    samples, common = _t(spark, d, "language_samples"), _t(spark, d, "common_words")
    drop = boilerplate.remover(boilerplate.repeated_templates(raw))
    if drop is None:  # too many templates for a broadcast: the texts are cleaned first
        return quality.statistics(boilerplate.cleaned(raw), samples, common)
    counted = raw.select("row_id", "raw_text", F.when(F.col("variant_id").isNotNull(), F.col("specialty")).alias("source"))
    return quality.statistics(counted, samples, common, text_col="raw_text", left_aside=drop, group_col="source")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_statistics(spark, d).filter("kind in ('list', 'table', 'junk')").select("row_id", "kind")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return split.split_oversized(_t(spark, d, "parsed_guidelines_raw"), _t(spark, d, "split_limits")).filter("piece_no = 1").select("row_id")


def p7_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.split_oversized(_t(spark, d, "parsed_guidelines_raw"), _t(spark, d, "split_limits"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode(_t(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(_t(spark, d, "documents"), _t(spark, d, "eval_items")).select("doc_id", "item_id")


def p9_passages(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(_t(spark, d, "documents"), _t(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue_rows(_t(spark, d, "documents"))


def p10_messages(spark: SparkSession, d: str) -> DataFrame:
    return residue.messages(residue.candidates(_t(spark, d, "documents"))).select("message", "sources", "verdict")


def p10_kept(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents")
    return docs.join(residue.residue_rows(docs), "doc_id", "left_anti").select("doc_id", "source", "text")


_P2_HITS = """
lines AS (
  SELECT row_id, variant_id, specialty, unnest(string_split(raw_text, chr(10))) AS line,
         unnest(range(1, len(string_split(raw_text, chr(10))) + 1)) AS line_no
  FROM parsed_guidelines_raw WHERE trim(specialty) <> '' AND raw_text IS NOT NULL AND variant_id IS NOT NULL),
keyed AS (SELECT row_id, variant_id, specialty, line_no, regexp_replace(lower(line), '[^\\p{L}]+', '', 'g') AS k FROM lines),
total AS (SELECT specialty, count(DISTINCT variant_id) AS n FROM parsed_guidelines_raw WHERE trim(specialty) <> '' GROUP BY 1),
often AS (
  SELECT specialty, k FROM (SELECT specialty, k, count(DISTINCT variant_id) AS c FROM keyed WHERE length(k) >= 20 GROUP BY 1, 2)
  JOIN total USING (specialty) WHERE c >= 4 AND 100 * c >= 2 * n),
hits AS (SELECT row_id, CAST(line_no AS INTEGER) AS line_no FROM keyed JOIN often USING (specialty, k))
"""


def _look_sql() -> str:
    """A text's look in SQL: plain forms, composed, every Cyrillic look-alike (with its accents) as its Latin twin."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    plain = sorted(chars.PLAIN.items(), key=lambda x: x[1] is None)  # what is removed comes last
    source, target = "".join(chr(c) for c, _ in plain if c), "".join(chr(to) for _, to in plain if to is not None)
    twins = dict(chars.CYR_TO_LAT)
    for c in map(chr, range(0x400, 0x530)):
        base, *marks = unicodedata.normalize("NFD", c)
        if marks and base in chars.CYR_TO_LAT:
            twins[c] = unicodedata.normalize("NFC", chars.CYR_TO_LAT[base] + "".join(marks))
    single = {c: l for c, l in twins.items() if len(l) == 1}
    out = f"translate(nfc_normalize(translate(raw_text, {q(source)}, {q(target)})), {q(''.join(single))}, {q(''.join(single.values()))})"
    for c, l in twins.items():
        if len(l) > 1:
            out = f"replace({out}, {q(c)}, {q(l)})"
    return f"nfc_normalize({out})"


def queries() -> dict:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1:2].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": f"WITH {_P2_HITS} SELECT row_id, line_no FROM hits",
        "p2_clean": f"""WITH {_P2_HITS}, parts AS (SELECT row_id, unnest(string_split(raw_text, chr(10))) AS line, unnest(range(1, len(string_split(raw_text, chr(10))) + 1)) AS line_no FROM parsed_guidelines_raw WHERE raw_text IS NOT NULL),
            kept AS (SELECT row_id, string_agg(line, chr(10) ORDER BY line_no) AS t FROM parts ANTI JOIN hits USING (row_id, line_no) GROUP BY 1)
            SELECT row_id, CASE WHEN raw_text IS NOT NULL THEN coalesce(t, '') END AS clean_text FROM parsed_guidelines_raw LEFT JOIN kept USING (row_id)""",
        "p4_found": f"WITH k AS (SELECT row_id, raw_text, {_look_sql()} AS look FROM parsed_guidelines_raw WHERE raw_text IS NOT NULL), s AS (SELECT * FROM k WHERE regexp_matches(look, '\\S')) SELECT a.row_id AS row_id_a, b.row_id AS row_id_b FROM s a JOIN s b ON a.look = b.look AND a.row_id < b.row_id AND a.raw_text <> b.raw_text",
        "p4_classes": f"WITH k AS (SELECT row_id, raw_text, {_look_sql()} AS look FROM parsed_guidelines_raw WHERE raw_text IS NOT NULL) SELECT row_id, min(row_id) OVER w AS class_id, count(*) OVER w AS n_rows, min(raw_text) OVER w <> max(raw_text) OVER w AS several_forms FROM k WHERE regexp_matches(look, '\\S') WINDOW w AS (PARTITION BY look)",
        "p7_found": "SELECT row_id FROM parsed_guidelines_raw JOIN (SELECT doc_type, min(max_chars) AS most FROM split_limits WHERE max_chars >= 1 GROUP BY 1) USING (doc_type) WHERE length(raw_text) > most",
    }
