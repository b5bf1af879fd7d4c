"""Features of a file's path as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Settings
from . import rules as R
from .text import any_of, let, one_space, stable_id, strip


def name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(path: Column) -> Column:
    """With its dot and as written; empty for names that begin with their only dot or end with one."""
    return F.regexp_extract(name(path), r"(?s)^.+(\.[^.]+)$", 1)


def extension(path: Column) -> Column:
    return F.lower(suffix(path))


def stem(path: Column) -> Column:
    n = name(path)
    return F.substring(n, F.lit(1), F.length(n) - F.length(suffix(path)))


def source_format(ext: Column) -> Column:
    return F.regexp_replace(ext, r"\.", "")


def is_lock_file(path: Column) -> Column:
    return name(path).startswith("~$")


def is_supported(path: Column) -> Column:
    return extension(path).isin(*R.SUPPORTED) & ~is_lock_file(path)


def relative_parts(path: Column, cfg: Settings) -> Column:
    """Parts below the raw root, or of the whole path where it lies elsewhere."""
    out = path
    for root in (cfg.raw_root, f"{cfg.project_root}/{cfg.raw_root}" if cfg.project_root else ""):
        if root:
            out = F.when(path.startswith(f"{root}/"), F.substring(path, len(root) + 2, 1 << 30)).otherwise(out)
    return F.filter(F.split(out, "/"), lambda x: x != "")


def is_stop_folder(folder: Column) -> Column:
    return F.regexp_replace(strip(F.lower(folder)), r"(?U)^[\d\s\x{1c}-\x{1f}.+_-]+", "").isin(*R.STOP_FOLDERS)


def tidy(part: Column) -> Column:
    return one_space(strip(part))


def specialty(parts: Column) -> Column:
    return F.coalesce(tidy(F.get(parts, F.lit(0))), F.lit("unknown_specialty"))


def disease_path(parts: Column, file_stem: Column) -> Column:
    """Folders between specialty and file up to the first stop folder; the file's stem where there are none."""

    def kept(middle: Column) -> Column:
        stop = F.array_position(F.transform(middle, is_stop_folder), True)
        return F.array_join(F.transform(F.slice(middle, F.lit(1), F.when(stop > 0, (stop - 1).cast("int")).otherwise(F.size(middle))), tidy), " / ")

    middle = let(parts, lambda p: F.slice(p, F.lit(2), F.greatest(F.size(p) - 2, F.lit(0))))
    return F.coalesce(F.nullif(let(middle, kept), F.lit("")), file_stem)


def searchable(path: Column) -> Column:
    return F.replace(F.lower(path), F.lit("\\"), F.lit("/"))


def is_review(path: Column) -> Column:
    return let(searchable(path), lambda p: any_of(p, R.REVIEW_MARKERS))


def doc_type(path: Column) -> Column:
    return let(searchable(path), lambda p: F.when(any_of(p, R.STANDARD_MARKERS), "standard").when(any_of(p, R.PROTOCOL_MARKERS), "protocol").otherwise("unknown"))


def language_hint(path: Column) -> Column:
    def by_markers(x: Column) -> Column:
        out = F.when(F.lit(False), F.lit(""))
        for where in (x["file"], x["path"]):
            for language, markers in (("ru", R.PATH_RU), ("uz_lat", R.PATH_UZ_LAT), ("uz_cyr", R.PATH_UZ_CYR)):
                out = out.when(any_of(where, markers), language)
        return out.when(x["file"].rlike("[қўғҳ]"), "uz_cyr").otherwise("unknown")

    p = searchable(path)
    return let(F.struct(F.element_at(F.split(p, "/"), -1).alias("file"), p.alias("path")), by_markers)


def file_key(file_stem: Column) -> Column:
    """The stem without language and kind words, removed in turn, and without digits and marks."""

    def removed(low: Column) -> Column:
        out = F.aggregate(F.split(F.lit("|".join(R.KEY_REMOVALS)), r"\|"), low, lambda x, w: F.replace(x, w, F.lit(" ")))
        out = strip(one_space(F.regexp_replace(out, r"(?U)[\d_().,\-–—]+", " ")))
        return F.coalesce(F.nullif(out, F.lit("")), low)

    return let(F.lower(file_stem), removed)


def size_kb(length: Column) -> Column:
    return F.coalesce(F.round(length / 1024, 2), F.lit(0.0))


def features(path: Column, length: Column, cfg: Settings) -> dict[str, Column]:
    """The columns of a variant's record that follow from its path and size, but for the ids of groups."""
    parts, s, ext = relative_parts(path, cfg), stem(path), extension(path)
    return {
        "variant_id": stable_id(path, "var"),
        "specialty": specialty(parts),
        "disease_path": disease_path(parts, s),
        "doc_type": doc_type(path),
        "language_hint": language_hint(path),
        "source_format": source_format(ext),
        "source_extension": ext,
        "source_path": path,
        "filename": name(path),
        "size_kb": size_kb(length),
        "normalized_file_key": file_key(s),
        "priority": F.coalesce(*(F.when(ext == e, F.lit(p)) for e, p in R.PRIORITY.items()), F.lit(R.OTHER_PRIORITY)),
    }


def group_ids() -> dict[str, Column]:
    return {
        "disease_class_id": stable_id(F.concat_ws("::", "specialty", "disease_path"), "dc"),
        "clinical_doc_group_id": stable_id(F.concat_ws("::", "specialty", "disease_path", "doc_type"), "cd"),
    }
