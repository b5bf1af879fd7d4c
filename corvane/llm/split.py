"""Problem 7: pieces of oversized texts, by a recursive hierarchy of separators and greedy packing.

Levels: section, paragraph, line, sentence, word, character. A span too long for the room is cut at the separators of
its level; parts still too long are cut at the next level. Parts are packed greedily; each next piece begins with the
last `overlap` characters of the one before, so piece k is text[start:end] and start(k+1) = end(k) - overlap.

Defined results: only texts longer than their limit have pieces; null texts and kinds without a limit have none; where
several limits are listed for a kind the smallest counts; an overlap of the limit or more is held at limit - 1, a null
or negative one is 0; a limit under 1 counts as none. Lengths are code points.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import map_rows

LEVELS = [re.compile(p) for p in (r"\n[ \t\r]*\n(?=[ \t]*(?:\d+\.\s|#|[^\n]{1,60}\n))", r"\n[ \t\r]*\n\s*", r"\n", r"(?<=[.!?…;])\s+", r"\s+")]


def parts(text: str, start: int, end: int, room: int, level: int) -> list[int]:
    """Ends of parts of text[start:end], each at most `room` long where the levels allow, in order."""
    if end - start <= room:
        return [end]
    if level == len(LEVELS):
        return [*range(start + room, end, room), end]
    out: list[int] = []
    at = start
    for cut in [*(m.end() for m in LEVELS[level].finditer(text, start, end)), end]:
        if cut > at:
            out += [cut] if cut - at <= room else parts(text, at, cut, room, level + 1)
            at = cut
    return out


def pieces(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of each piece."""
    if len(text) <= limit:
        return [(0, len(text))]
    overlap = min(max(overlap, 0), limit - 1)
    room = limit - overlap  # what a piece after the first adds
    out, start, end = [], 0, 0
    for cut in parts(text, 0, len(text), room, 0):
        if cut - start > limit:
            out.append((start, end))
            start = max(end - overlap, 0)
        end = cut
    return [*out, (start, end)]


def split_oversized(df: DataFrame, limits: DataFrame, row_col: str = "row_id", kind_col: str = "doc_type", text_col: str = "raw_text") -> DataFrame:
    """(row_id, piece_no, start, end, n_pieces, piece); `end` is exclusive, both count code points from 0.

    The table of limits has one row a kind and is broadcast only while it has under 10,000; texts within their limit are
    dropped in the JVM before any Python.
    """
    kind = dict(df.dtypes)[row_col]
    lim = limits.filter("max_chars >= 1").groupBy(F.col("doc_type").alias("_kind")).agg(F.min(F.struct("max_chars", F.coalesce("overlap_chars", F.lit(0)).alias("overlap_chars"))).alias("_l"))
    small = lim.limit(10_000).count() < 10_000
    src = df.select(df[row_col].alias("row_id"), df[kind_col].alias("_kind"), df[text_col].alias("txt"))
    src = src.join(F.broadcast(lim) if small else lim, "_kind").filter(F.length("txt") > F.col("_l.max_chars")).select("row_id", "txt", F.col("_l.max_chars").alias("most"), F.col("_l.overlap_chars").alias("lap"))

    def make():
        def work(c: dict[str, list]) -> dict[str, list]:
            rows = []
            for i, t, most, lap in zip(c["row_id"], c["txt"], c["most"], c["lap"]):
                cut = pieces(t, most, lap)
                rows += [(i, k, a, b, len(cut), t[a:b]) for k, (a, b) in enumerate(cut, 1)]
            return dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}

        return work

    names = ["row_id", "piece_no", "start", "end", "n_pieces", "piece"]
    arrow = pa.schema([("row_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()), ("piece_no", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("n_pieces", pa.int32()), ("piece", pa.string())])
    return map_rows(src, make, f"row_id {kind}, piece_no int, start int, end int, n_pieces int, piece string", arrow)
