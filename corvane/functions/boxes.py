"""Page geometry as expressions: relative boxes, areas, crops, page batches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c.cast("double")))


def relative_box(l: Column, t: Column, r: Column, b: Column, width: Column, height: Column) -> Column:  # noqa: E741
    """Box of shares of the page from its top left corner; the input's origin is the bottom left one. Null where a size is 0."""
    x0, x1 = clamp(F.try_divide(l, width)), clamp(F.try_divide(r, width))
    y0, y1 = clamp(1 - F.try_divide(t, height)), clamp(1 - F.try_divide(b, height))
    box = F.struct(F.least(x0, x1).alias("x0"), F.least(y0, y1).alias("y0"), F.greatest(x0, x1).alias("x1"), F.greatest(y0, y1).alias("y1"))
    return F.when((width > 0) & (height > 0) & l.isNotNull() & t.isNotNull() & r.isNotNull() & b.isNotNull(), box)


def area(box: Column) -> Column:
    return F.greatest(F.lit(0.0), box["x1"] - box["x0"]) * F.greatest(F.lit(0.0), box["y1"] - box["y0"])


def crop(box: Column, width: Column, height: Column, padding: int) -> Column:
    """Pixels of a padded crop within its image; null where nothing is left."""
    left = F.greatest(F.lit(0), (box["x0"] * width).cast("int") - padding)
    top = F.greatest(F.lit(0), (box["y0"] * height).cast("int") - padding)
    right = F.least(width.cast("int"), (box["x1"] * width).cast("int") + padding)
    bottom = F.least(height.cast("int"), (box["y1"] * height).cast("int") + padding)
    return F.when((right > left) & (bottom > top), F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom")))


def page_batches(pages: Column, size: int) -> Column:
    """array<struct<batch_no, first_page, last_page>>; empty for documents without pages."""
    starts = F.when(pages > 0, F.sequence(F.lit(0), pages - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s, i: F.struct((i + 1).alias("batch_no"), (s + 1).alias("first_page"), F.least(s + size, pages).alias("last_page")))
