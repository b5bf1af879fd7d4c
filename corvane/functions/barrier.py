"""Columns computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that the optimizer cannot copy into every later use, each through a one-row generator.

    Long chains of regular expressions are otherwise evaluated again for every column that reads them, or make generated
    code too large to compile.
    """
    for name, c in columns.items():
        df = df.select("*", F.explode(F.array(c)).alias(name))
    return df


def side_by_side(*parts: DataFrame) -> DataFrame:
    """One-row tables with different columns as one row."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.agg(*(F.max(c).alias(c) for c in out.columns))


def first_by_key(entries: Column) -> Column:
    """Entries of a sorted array<struct<key, ...>> without those whose first field is that of the one before."""
    key = lambda x: x["key"]
    return F.filter(entries, lambda x, i: (i == 0) | (key(x) != key(F.get(entries, i - 1))))
