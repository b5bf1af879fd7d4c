"""Quality of a table in markdown, and kinds of visual blocks, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R
from .text import any_of, missing_as_empty, strip

LINE_BREAK = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"


def column_counts(markdown: Column) -> Column:
    """Cells of each row that is not a ruler."""
    rows = F.filter(F.transform(F.split(missing_as_empty(markdown), LINE_BREAK), strip), lambda x: x.contains("|"))
    bare = F.transform(rows, lambda x: F.regexp_replace(x, r"^\|+|\|+$", ""))
    used = F.filter(bare, lambda x: F.regexp_replace(x, r"(?U)[|\-:\s]", "") != "")
    return F.transform(used, lambda x: F.size(F.split(x, r"\|")))


def pipe_rows(markdown: Column) -> Column:
    return F.size(F.filter(F.split(missing_as_empty(markdown), LINE_BREAK), lambda x: x.contains("|")))


def mode(counts: Column) -> Column:
    """Most frequent value, the lowest of several."""
    tally = F.transform(F.array_distinct(counts), lambda v: F.struct(F.size(F.filter(counts, lambda x: x == v)).alias("n"), (-v).alias("v")))
    return -F.array_max(tally)["v"]


def table_reasons(markdown: Column) -> Column:
    """Why a table is not good; an empty array for a good one."""
    counts = column_counts(markdown)
    top = mode(counts)
    share = F.size(F.filter(counts, lambda x: x == top)) / F.size(counts)
    reasons = F.array_compact(F.array(F.when(top < 2, F.lit("table_has_fewer_than_2_columns")), F.when(share < R.TABLE_CONSISTENCY, F.lit("inconsistent_row_column_counts"))))
    return (
        F.when(F.length(strip(missing_as_empty(markdown))) < R.TABLE_LEAST, F.array(F.lit("empty_or_short_table_markdown")))
        .when(pipe_rows(markdown) < 2, F.array(F.lit("not_enough_markdown_table_rows")))
        .when(F.size(counts) == 0, F.array(F.lit("no_usable_table_cells")))
        .otherwise(reasons)
    )


def visual_type(label: Column, context: Column) -> Column:
    s = F.lower(F.concat(missing_as_empty(label), F.lit(" "), missing_as_empty(context)))
    return F.when(any_of(s, R.FLOWCHART_WORDS), "flowchart").when(any_of(s, R.CHART_WORDS), "chart").when(any_of(s, R.TABLE_WORDS), "complex_table").otherwise("figure")
