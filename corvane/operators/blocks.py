"""Layout blocks: boxes, reading order, page fallbacks, context, visual manifest, assembled text.

raw items have (variant_id, batch_no, batch_start_page, kind, item_seq, label, text, markdown, local_page, l, t, r, b);
pages have (variant_id, page, width_pts, height_pts, text_chars, native_text). Items of unknown pages, without a box or
with an area of nothing are dropped. Windows are over one page or one document's blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..functions import rules as R
from ..functions import tables as T
from ..functions import text as X
from ..functions.text import clean, filled, missing_as_empty


def one_measure(pages: DataFrame) -> DataFrame:
    """Pages measured several times count once, as measured last (then the widest)."""
    cols = [c for c in ("width_pts", "height_pts", "text_chars", "native_text") if c in pages.columns]
    key = F.col("measured_at") if "measured_at" in pages.columns else F.lit(None).cast("timestamp")
    return pages.filter("page is not null").groupBy("variant_id", "page").agg(F.max(F.struct(key.alias("_at"), *cols)).alias("_m")).select("variant_id", "page", *(F.col(f"_m.{c}") for c in cols))


def document_class(pages: DataFrame) -> DataFrame:
    """(variant_id, pages, scanned_pages, scanned_ratio, document_class) by the share of pages with hardly any text."""
    scanned = F.coalesce("text_chars", F.lit(0)) < R.SCANNED_PAGE
    agg = pages.groupBy("variant_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if(scanned).alias("scanned_pages"))
    share = F.col("scanned_pages") / F.col("pages")
    return agg.select(
        "variant_id", "pages", "scanned_pages", F.round(share, 3).alias("scanned_ratio"),
        F.when(share > R.SCANNED_SHARE, "scanned").when(share > R.MIXED_SHARE, "mixed").otherwise("digital").alias("document_class"),
    )


def located(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Items with their page and box."""
    p = pages.select("variant_id", "page", "width_pts", "height_pts")
    rows = items.withColumn("page", F.col("batch_start_page") + F.col("local_page") - 1).join(p, ["variant_id", "page"])
    rows = rows.withColumn("bbox", B.relative_box(F.col("l"), F.col("t"), F.col("r"), F.col("b"), F.col("width_pts"), F.col("height_pts")))
    return rows.filter(B.area(F.col("bbox")) > R.SMALLEST_AREA)


def in_reading_order(rows: DataFrame) -> DataFrame:
    """Blocks of each batch numbered from 0 by page, top, left and place among the items."""
    w = Window.partitionBy("variant_id", "batch_no").orderBy("page", F.col("bbox.y0"), F.col("bbox.x0"), "item_seq")
    kind = F.when(F.col("kind") == "picture", "pending_visual").otherwise(F.col("kind"))
    reasons = F.when(F.col("kind") == "table", T.table_reasons(F.col("markdown"))).when(F.col("kind") == "picture", F.array(F.lit("visual_needs_vlm"))).otherwise(F.array().cast("array<string>"))
    return rows.select(
        "variant_id", "batch_no", "page", (F.row_number().over(w) - 1).alias("order"), kind.alias("type"), "bbox", "text", "markdown", F.coalesce("label", F.lit("")).alias("label"),
        reasons.alias("reasons"), (F.size(reasons) > 0).alias("needs_review"), F.lit(False).alias("fallback"),
    )


def page_fallbacks(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """A block for each page that has none: its native text, else the whole page as a visual."""
    bare = pages.join(blocks.select("variant_id", "page").distinct(), ["variant_id", "page"], "left_anti")
    text = clean(F.col("native_text"))
    has = text != ""
    whole = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(1.0).alias("x1"), F.lit(1.0).alias("y1"))
    return bare.select(
        "variant_id", F.lit(None).cast("int").alias("batch_no"), "page", F.lit(1 << 30).alias("order"), F.when(has, "text").otherwise("pending_visual").alias("type"), whole.alias("bbox"), F.when(has, text).otherwise("").alias("text"),
        F.lit("").alias("markdown"), F.when(has, "native_text_fallback").otherwise("full_page_visual_fallback").alias("label"),
        F.when(has, F.array().cast("array<string>")).otherwise(F.array(F.lit("page_without_blocks"))).alias("reasons"), (~has).alias("needs_review"), F.lit(True).alias("fallback"),
    )


def renumbered(blocks: DataFrame) -> DataFrame:
    """Blocks of each document numbered from 0 by page and order, with their ids."""
    w = Window.partitionBy("variant_id").orderBy("page", "order")
    return blocks.withColumn("order", F.row_number().over(w) - 1).withColumn("block_id", F.format_string("p%04d_b%06d", "page", "order"))


def assemble_blocks(items: DataFrame, pages: DataFrame) -> DataFrame:
    once = one_measure(pages)
    blocks = in_reading_order(located(items, once))
    return renumbered(blocks.unionByName(page_fallbacks(blocks, once)))


def with_context(blocks: DataFrame) -> DataFrame:
    """Each block with before_text, after_text and caption from the text and table blocks around it on its page.

    Only the nearest blocks are gathered (last and next two readable ones), through running positions, so that a page of any length costs one sort.
    """
    page = Window.partitionBy("variant_id", "page").orderBy("order")
    readable = F.col("type").isin("text", "table")
    own = clean(F.coalesce(filled(F.col("text")), filled(F.col("markdown")), F.lit("")))
    item = F.when(readable, F.struct(own.alias("t"), F.lower("label").alias("l")))
    prior, later = page.rowsBetween(Window.unboundedPreceding, -1), page.rowsBetween(1, Window.unboundedFollowing)
    rows = blocks.withColumn("_i", item)
    b1, a1 = F.last("_i", True).over(prior), F.first("_i", True).over(later)
    # the second nearest is the nearest of the nearest: carried along by position
    rows = rows.withColumn("_b1", b1).withColumn("_a1", a1)
    rows = rows.withColumn("_b2", F.last(F.when(F.col("_i").isNotNull(), F.struct(F.col("_b1").alias("s"))), True).over(prior)["s"])
    rows = rows.withColumn("_a2", F.first(F.when(F.col("_i").isNotNull(), F.struct(F.col("_a1").alias("s"))), True).over(later)["s"])

    def joined(*parts: str) -> Column:
        return F.concat_ws("\n", *(F.col(f"{p}.t") for p in parts))

    def caption_of(c: str) -> Column:
        opens = F.lit(False)
        for x in R.CAPTION_OPENINGS:
            opens = opens | F.lower(F.col(f"{c}.t")).startswith(x)
        return F.when(F.col(f"{c}.l").contains("caption") | opens, F.col(f"{c}.t"))

    return rows.withColumns(
        {
            "before_text": F.substring(clean(joined("_b2", "_b1")), 1, R.CONTEXT_CHARS),
            "after_text": F.substring(clean(joined("_a1", "_a2")), 1, R.CONTEXT_CHARS),
            "caption": F.substring(clean(F.coalesce(caption_of("_b1"), caption_of("_a1"), F.lit(""))), 1, R.CAPTION_CHARS),
        }
    ).drop("_i", "_b1", "_b2", "_a1", "_a2")


def is_visual() -> Column:
    """Blocks that need a picture: pending visuals and tables under review."""
    return (F.col("type") == "pending_visual") | (F.col("type") == "table") & F.col("needs_review")


def with_visuals(blocks: DataFrame, images: DataFrame | None = None, padding: int = 12) -> DataFrame:
    """blocks with context and, for those that need a picture, `visual`: asset, kind, crop and its path; reasons tell why there is none.

    images has (variant_id, page, width, height) in pixels of the pages that were rendered; without it every page counts as rendered
    and crops have no pixels. A page without an image, or a crop of nothing, leaves the block without an asset.
    """
    rows = with_context(blocks)
    asset = F.format_string("%s_p%04d_b%06d", "variant_id", "page", "order")
    kind = F.when(F.col("type") == "table", "complex_table").otherwise(T.visual_type(F.col("label"), F.concat_ws(" ", "caption", "before_text", "after_text")))
    if images is None:
        rows = rows.withColumns({"_there": F.lit(True), "_crop": F.lit(None).cast("struct<left:int,top:int,right:int,bottom:int>"), "_cropped": F.lit(True)})
    else:
        size = images.select("variant_id", "page", F.col("width").alias("_w"), F.col("height").alias("_h")).dropDuplicates(["variant_id", "page"])
        rows = rows.join(size, ["variant_id", "page"], "left").withColumn("_crop", B.crop(F.col("bbox"), F.col("_w"), F.col("_h"), padding))
        rows = rows.withColumns({"_there": F.col("_w").isNotNull(), "_cropped": F.col("_crop").isNotNull()}).drop("_w", "_h")
    made = is_visual() & F.col("_there") & F.col("_cropped")
    path = F.concat(F.lit("data/pdf_visual_assets/"), "variant_id", F.lit("/crops/"), asset, F.lit(".png"))
    why = F.when(made, "visual/table crop exported for later VLM enrichment").when(is_visual() & ~F.col("_there"), "page_image_missing_for_visual_crop").when(is_visual(), "visual_crop_failed")
    visual = F.when(made, F.struct(asset.alias("asset_id"), kind.alias("suggested_type"), path.alias("crop_path"), F.col("_crop").alias("crop")))
    reasons = F.when(made, F.array_sort(F.array_distinct(F.concat("reasons", F.array(why))))).when(why.isNotNull(), F.concat("reasons", F.array(why))).otherwise(F.col("reasons"))
    return rows.withColumns({"visual": visual, "_reasons": reasons, "needs_vlm": made}).withColumn("needs_review", F.col("needs_review") | why.isNotNull()).drop("reasons", "_there", "_crop", "_cropped").withColumnRenamed("_reasons", "reasons")


def visual_manifest(blocks: DataFrame, images: DataFrame | None = None, padding: int = 12) -> DataFrame:
    """A row for each block that needs a picture and has one; blocks may come from with_visuals already."""
    rows = (blocks if "visual" in blocks.columns else with_visuals(blocks, images, padding)).filter("visual is not null")
    return rows.select(
        F.col("variant_id").alias("doc_id"), "variant_id", "visual.asset_id", "page", "order", "block_id", "visual.suggested_type", "bbox", "visual.crop_path", "caption", "before_text", "after_text", F.lit("pending_vlm").alias("status"),
    )


CROPPERS: dict = {}


def crop_backend(name: str):
    """Registers a cropper: (image bytes, left, top, right, bottom) -> image bytes."""
    return lambda f: CROPPERS.setdefault(name, f)


@crop_backend("pillow")
def _pillow(content: bytes, left: int, top: int, right: int, bottom: int) -> bytes:
    import io

    from PIL import Image

    out = io.BytesIO()
    Image.open(io.BytesIO(content)).crop((left, top, right, bottom)).save(out, "PNG")
    return out.getvalue()


def crops(visuals: DataFrame, images: DataFrame, backend: str = "pillow") -> DataFrame:
    """(asset_id, crop_path, content, error) of the visuals of with_visuals; images has (variant_id, page, content) too. Failures are rows."""
    cut = CROPPERS[backend]

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for asset, path, content, c in zip(batch["asset_id"], batch["crop_path"], batch["content"], batch["crop"]):
                try:
                    rows.append((asset, path, cut(bytes(content), *(int(c[k]) for k in ("left", "top", "right", "bottom"))), None))
                except Exception as e:  # noqa: BLE001 - a picture that cannot be cut is a row
                    rows.append((asset, path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["asset_id", "crop_path", "content", "error"])

    src = visuals.filter("visual is not null").join(images.select("variant_id", "page", "content"), ["variant_id", "page"])
    return src.select("visual.asset_id", "visual.crop_path", "content", "visual.crop").mapInPandas(run, "asset_id string, crop_path string, content binary, error string")


def _assembled(rows: DataFrame, parts: Column, name: str) -> DataFrame:
    piece = F.struct("page", "order", parts.alias("t"))
    gathered = rows.withColumn("_t", piece).groupBy("variant_id").agg(F.array_sort(F.collect_list("_t")).alias("_l"))
    return gathered.select("variant_id", clean(F.array_join(F.transform("_l", lambda x: x["t"]), "\n\n")).alias(name))


def raw_text(blocks: DataFrame) -> DataFrame:
    """(variant_id, raw_text) of the documents that have a readable block."""
    t = F.coalesce(filled(F.col("markdown")), filled(F.col("text")))
    return _assembled(blocks.filter(F.col("type").isin("text", "table") & (clean(t) != "")), clean(t), "raw_text")


def markdown(blocks: DataFrame) -> DataFrame:
    """(variant_id, markdown) with page marks and placeholders of visuals, of blocks as with_visuals leaves them."""
    page = Window.partitionBy("variant_id", "page").orderBy("order")
    part = lambda name: missing_as_empty(F.col(f"visual.{name}"))
    visual = F.concat(F.lit("[PENDING_VISUAL asset_id="), part("asset_id"), F.lit(" type="), part("suggested_type"), F.lit("]"))
    body = F.when(F.col("type") == "pending_visual", visual).otherwise(filled(X.strip(F.coalesce(filled(F.col("markdown")), filled(F.col("text"))))))
    mark = F.when(F.row_number().over(page) == 1, F.concat(F.lit("\n\n<!-- page "), F.col("page").cast("string"), F.lit(" -->\n")))
    rows = blocks.withColumn("_p", F.concat_ws("\n\n", mark, body))
    return _assembled(rows.filter("_p <> ''"), F.col("_p"), "markdown")


def nested_pages(blocks: DataFrame) -> DataFrame:
    """(variant_id, pages): blocks nested by page in order."""
    cols = [c for c in blocks.columns if c not in ("variant_id", "page", "order")]
    per = blocks.groupBy("variant_id", "page").agg(F.array_sort(F.collect_list(F.struct("order", "block_id", *[c for c in cols if c != "block_id"])), lambda a, b: a["order"] - b["order"]).alias("blocks"))
    return per.groupBy("variant_id").agg(F.array_sort(F.collect_list(F.struct("page", "blocks")), lambda a, b: a["page"] - b["page"]).alias("pages"))
