"""Problem 2: lines repeated among the records of one source, by fixed-depth template trees.

A line is parsed into tokens of `TOKEN` letters and slots, the gaps before, in and after the tokens that hold anything but letters.
Tokens are cut from the letters alone, so that a mark or blank inside a word moves no token. A tree has a fixed depth: the number
of letters, then `DEPTH` tokens, then a leaf with the templates that share them, told apart by the rest of their tokens. A slot matches
whatever stands in it; where it differs from line to line it is a wildcard of the template.

Each task grows a tree a source from its lines, with the documents of each template. Trees are merged across tasks by the place of a
template in the tree (its tokens as hashes), counting distinct documents by partial aggregation. The merged tree's templates that
cover enough documents form a small tree again, which the lines are matched with.

Defined results: null and blank texts have no lines; records without a specialty (null or blank) never count; lines
with fewer than `min_letters` letters never count; a variant counts once however often it was delivered; line numbers
count from 1 at line feeds. Repeated rows are judged one by one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import CHUNK, durable, map_rows

LETTERS = re.compile(r"[^\W\d_]+").findall
TOKEN, DEPTH = 8, 2  # letters of a token, tokens on the way to a leaf
HEAD = 40  # characters in which a line's first token is looked for before all of it is parsed
BROADCAST = 50_000
PLACE = ["n", "t1", "t2", "rest"]


def letters_of(line: str) -> str:
    s = "".join(LETTERS(line.lower()))
    return s if s.isalpha() else "".join(filter(str.isalpha, s))


def tokens_of(letters: str) -> tuple[int, str, str, str]:
    """Place of a template in the tree: number of letters, the tokens of the way, the other tokens."""
    return len(letters), letters[:TOKEN], letters[TOKEN : DEPTH * TOKEN], letters[DEPTH * TOKEN :]


def _h32(s: str) -> int:
    return xxhash.xxh32_intdigest(s) - 2**31


def _h64(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s) - 2**63


class TemplateTree:
    """The tree that one task grows from the lines of one source; leaves hold templates with the documents they are in."""

    def __init__(self) -> None:
        self.root: dict[int, dict[str, dict[str, dict[str, set[int]]]]] = {}

    def add(self, letters: str, doc: int) -> bool:
        """Puts a line into its template; whether the template is new to the document."""
        n, t1, t2, rest = tokens_of(letters)
        docs = self.root.setdefault(n, {}).setdefault(t1, {}).setdefault(t2, {}).setdefault(rest, set())
        if doc in docs:
            return False
        docs.add(doc)
        return True

    def templates(self) -> Iterator[tuple[tuple[int, int, int, int], set[int]]]:
        """(place with hashed tokens, documents) of every template."""
        for n, first in self.root.items():
            for t1, second in first.items():
                h1 = _h32(t1)
                for t2, leaf in second.items():
                    h2 = _h32(t2)
                    for rest, docs in leaf.items():
                        yield (n, h1, h2, _h64(rest)), docs


class MergedTree:
    """The templates found, by source and tokens; lines are matched level by level."""

    def __init__(self, rows: list[tuple]):
        self.root: dict[str, dict] = {}
        self.opening: dict[str, set[int]] = {}
        for grp, n, t1, t2, rest, *value in rows:
            self.opening.setdefault(grp, set()).add(t1)
            self.root.setdefault(grp, {}).setdefault(n, {}).setdefault(t1, {}).setdefault(t2, {})[rest] = tuple(value)

    def match(self, grp: str | None, line: str, min_letters: int) -> tuple | None:
        """What is known of the line's template, None for a line without one."""
        by_length = self.root.get(grp)
        if by_length is None or len(line) < min_letters:
            return None
        if len(line) > HEAD and len(first := letters_of(line[:HEAD])) >= TOKEN and _h32(first[:TOKEN]) not in self.opening[grp]:
            return None  # no template opens with the line's first token
        letters = letters_of(line)
        n, t1, t2, rest = tokens_of(letters)
        node = by_length.get(n)
        node = node and node.get(_h32(t1))
        node = node and node.get(_h32(t2))
        return node.get(_h64(rest)) if node else None


def slots_of(line: str) -> tuple[str, list[tuple[int, str]]]:
    """(letters, slots) of a line; a slot is the number of letters before it and what stands in it, blanks as one."""
    letters, slots, gap = [], [], ""
    for c in line.lower():
        if c.isalpha():
            if gap:
                slots.append((len(letters), re.sub(r"\s+", " ", gap)))
                gap = ""
            letters.append(c)
        else:
            gap += c
    if gap.strip():
        slots.append((len(letters), re.sub(r"\s+", " ", gap)))
    return "".join(letters), slots


def _source(df: DataFrame, row_col: str, group_col: str, doc_col: str, text_col: str) -> DataFrame:
    src = df.select(df[row_col].alias("row_id"), df[group_col].alias("grp"), F.xxhash64(df[doc_col]).alias("doc"), df[text_col].alias("txt"))
    return src.filter(F.col("txt").isNotNull() & (F.trim("grp") != "") & df[doc_col].isNotNull())


def grown(src: DataFrame, min_letters: int, most: int = 60_000) -> DataFrame:
    """(grp, n, t1, t2, rest, doc): the trees of all tasks, a row for each document of a template. A task hands on its trees whenever
    they have `most` rows, which bounds its memory."""
    names = ["grp", *PLACE, "doc"]
    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, TemplateTree] = {}
        size = 0

        def handed() -> pa.RecordBatch:
            rows = [(grp, *place, doc) for grp, tree in trees.items() for place, docs in tree.templates() for doc in docs]
            trees.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * len(names), types)], names)

        for batch in batches:
            for k in range(0, batch.num_rows, CHUNK):
                part = batch.slice(k, CHUNK).to_pydict()
                for grp, doc, text in zip(part["grp"], part["doc"], part["txt"]):
                    tree = trees.get(grp) or trees.setdefault(grp, TemplateTree())
                    for line in text.split("\n"):
                        if len(line) >= min_letters and len(s := letters_of(line)) >= min_letters:
                            size += tree.add(s, doc)
                    if size >= most:
                        size = 0
                        yield handed()
        yield handed()

    return src.select("grp", "doc", "txt").mapInArrow(run, "grp string, n int, t1 int, t2 int, rest bigint, doc bigint")


def repeated_templates(df: DataFrame, row_col: str = "row_id", group_col: str = "specialty", doc_col: str = "variant_id", text_col: str = "raw_text", min_letters: int = 20, min_docs: int = 4, min_share: float = 0.02) -> DataFrame:
    """(grp, n, t1, t2, rest, docs, total): the merged trees' templates that cover enough distinct documents of their source.

    At most lines-per-document / min_share templates a source can pass, whatever the number of rows. The result is a written table.
    """
    total = df.filter(F.trim(df[group_col]) != "").groupBy(df[group_col].alias("grp")).agg(F.countDistinct(df[doc_col]).alias("total"))
    trees = grown(_source(df, row_col, group_col, doc_col, text_col), min_letters)
    counted = trees.distinct().groupBy("grp", *PLACE).agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") >= min_docs)
    return durable(counted.join(total, "grp").filter(F.col("docs") >= F.col("total") * F.lit(min_share)))


def merged_tree(found: DataFrame) -> Callable[[], MergedTree] | None:
    """What makes the tree of the templates found in a task, from a broadcast; None where they are too many for one."""
    rows = [tuple(r) for r in found.limit(BROADCAST + 1).collect()]
    if len(rows) > BROADCAST:
        return None
    shared = found.sparkSession.sparkContext.broadcast(rows)
    return lambda: MergedTree(shared.value)


def repeated_lines(df: DataFrame, row_col: str = "row_id", group_col: str = "specialty", doc_col: str = "variant_id", text_col: str = "raw_text", min_letters: int = 20, min_docs: int = 4, min_share: float = 0.02) -> DataFrame:
    """(row_id, line_no, docs, total) of every occurrence of a repeated line.

    While the templates found are under BROADCAST rows their tree is broadcast and lines are matched in a narrow map; beyond it the
    lines' places are joined with them by shuffle.
    """
    found = repeated_templates(df, row_col, group_col, doc_col, text_col, min_letters, min_docs, min_share)
    tree = merged_tree(found)
    src = _source(df, row_col, group_col, doc_col, text_col)
    kind = dict(df.dtypes)[row_col]
    key = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    if tree is None:
        return _places(src, kind, key, min_letters).join(found, ["grp", *PLACE]).select("row_id", "line_no", "docs", "total")

    def make():
        match = tree().match

        def work(c: dict[str, list]) -> dict[str, list]:
            hits = [(row, no, *got) for row, grp, text in zip(c["row_id"], c["grp"], c["txt"]) for no, line in enumerate(text.split("\n"), 1) if (got := match(grp, line, min_letters))]
            return dict(zip(("row_id", "line_no", "docs", "total"), map(list, zip(*hits)))) if hits else {n: [] for n in ("row_id", "line_no", "docs", "total")}

        return work

    arrow = pa.schema([("row_id", key), ("line_no", pa.int32()), ("docs", pa.int64()), ("total", pa.int64())])
    return map_rows(src, make, f"row_id {kind}, line_no int, docs bigint, total bigint", arrow)


def _places(src: DataFrame, kind: str, key: pa.DataType, min_letters: int) -> DataFrame:
    """(row_id, line_no, grp, n, t1, t2, rest) of every line long enough. Narrow."""
    names = ["row_id", "line_no", "grp", *PLACE]

    def work(c: dict[str, list]) -> dict[str, list]:
        out = []
        for row, grp, text in zip(c["row_id"], c["grp"], c["txt"]):
            for no, line in enumerate(text.split("\n"), 1):
                if len(s := letters_of(line)) >= min_letters:
                    n, t1, t2, rest = tokens_of(s)
                    out.append((row, no, grp, n, _h32(t1), _h32(t2), _h64(rest)))
        return dict(zip(names, map(list, zip(*out)))) if out else {n: [] for n in names}

    arrow = pa.schema([("row_id", key), ("line_no", pa.int32()), ("grp", pa.string()), ("n", pa.int32()), ("t1", pa.int32()), ("t2", pa.int32()), ("rest", pa.int64())])
    return map_rows(src, lambda: work, f"row_id {kind}, line_no int, grp string, n int, t1 int, t2 int, rest bigint", arrow)


def templates(df: DataFrame, row_col: str = "row_id", group_col: str = "specialty", doc_col: str = "variant_id", text_col: str = "raw_text", min_letters: int = 20, min_docs: int = 4, min_share: float = 0.02) -> DataFrame:
    """(grp, template, docs, total): the templates found in readable form, slots that differ between lines as <*>.

    Every task gives a template's slots as its lines have them, with how many lines have each; they are merged slot by slot with partial
    aggregation: a slot keeps its content where all lines of the template agree, and is a wildcard otherwise.
    """
    found = repeated_templates(df, row_col, group_col, doc_col, text_col, min_letters, min_docs, min_share)
    tree = merged_tree(found)
    names = ["grp", *PLACE, "docs", "total", "pos", "held", "lines"]
    arrow = pa.schema([("grp", pa.string()), ("n", pa.int32()), ("t1", pa.int32()), ("t2", pa.int32()), ("rest", pa.int64()), ("docs", pa.int64()), ("total", pa.int64()), ("pos", pa.int32()), ("held", pa.string()), ("lines", pa.int64())])

    def collected(match: Callable) -> Callable[[dict[str, list]], dict[str, list]]:
        def work(c: dict[str, list]) -> dict[str, list]:
            counts: dict[tuple, int] = {}
            for grp, text in zip(c["grp"], c["txt"]):
                for line in text.split("\n"):
                    if got := match(grp, line):
                        letters, slots = slots_of(line)
                        n, t1, t2, rest = tokens_of(letters)
                        for pos, held in ((-1, letters), *slots):
                            k = (grp, n, _h32(t1), _h32(t2), _h64(rest), *got, pos, held)
                            counts[k] = counts.get(k, 0) + 1
            return dict(zip(names, map(list, zip(*((*k, v) for k, v in counts.items()))))) if counts else {n: [] for n in names}

        return work

    def make():
        merged = tree() if tree else None
        return collected((lambda grp, line: merged.match(grp, line, min_letters)) if merged else (lambda grp, line: (0, 0) if len(letters_of(line)) >= min_letters else None))

    slots = map_rows(_source(df, row_col, group_col, doc_col, text_col), make, ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'int' if f.type == pa.int32() else 'bigint'}" for f in arrow), arrow)
    if tree is None:
        slots = slots.drop("docs", "total").join(found, ["grp", *PLACE])
    key = ["grp", *PLACE, "docs", "total"]
    merged = slots.groupBy(*key, "pos").agg(F.min("held").alias("lo"), F.max("held").alias("hi"), F.sum("lines").alias("lines"))
    whole = merged.filter("pos = -1").select(*key, F.col("lo").alias("letters"), F.col("lines").alias("all_lines"))
    gaps = merged.filter("pos >= 0").join(whole.select(*key, "all_lines"), key).withColumn("held", F.when((F.col("lo") == F.col("hi")) & (F.col("lines") == F.col("all_lines")), F.col("lo")).otherwise("<*>"))
    rows = whole.join(gaps.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "held"))).alias("slots")), key, "left")
    slots_or_none = F.coalesce("slots", F.array().cast("array<struct<pos:int,held:string>>"))
    text = F.aggregate(
        slots_or_none, F.struct(F.lit(0).alias("at"), F.lit("").alias("s")),
        lambda a, x: F.struct(x["pos"].alias("at"), F.concat(a["s"], F.substring("letters", a["at"] + 1, x["pos"] - a["at"]), x["held"]).alias("s")),
        lambda a: F.concat(a["s"], F.substring("letters", a["at"] + 1, F.length("letters"))),
    )
    return rows.select("grp", text.alias("template"), "docs", "total")


def remover(found: DataFrame, min_letters: int = 20) -> Callable[[], Callable[[str | None, str], str]] | None:
    """What makes a function (group, text) -> text without the lines of the templates found; None where they are too many to broadcast."""
    tree = merged_tree(found)
    if tree is None:
        return None

    def make():
        match = tree().match
        return lambda grp, text: "\n".join(x for x in text.split("\n") if match(grp, x, min_letters) is None)

    return make


def cleaned(df: DataFrame, row_col: str = "row_id", group_col: str = "specialty", doc_col: str = "variant_id", text_col: str = "raw_text", min_letters: int = 20, min_docs: int = 4, min_share: float = 0.02) -> DataFrame:
    """(row_id, group_col, clean_text): the texts without their repeated lines. Lines are parsed and left out in one narrow map; no text is
    shuffled unless the templates are too many for a broadcast. Null texts stay null; records that do not count keep their texts."""
    found = repeated_templates(df, row_col, group_col, doc_col, text_col, min_letters, min_docs, min_share)
    drop = remover(found, min_letters)
    kind = dict(df.dtypes)[row_col]
    if drop is None:
        return without_lines(df, repeated_lines(df, row_col, group_col, doc_col, text_col, min_letters, min_docs, min_share), row_col, text_col).select(df[row_col].alias("row_id"), df[group_col], "clean_text")

    def make():
        rid = drop()
        return lambda c: {"row_id": c["row_id"], group_col: c[group_col], "clean_text": [t if t is None or not d else rid(g, t) for t, g, d in zip(c["txt"], c[group_col], c["has_doc"])]}

    arrow = pa.schema([("row_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()), (group_col, pa.string()), ("clean_text", pa.string())])
    return map_rows(df.select(df[row_col].alias("row_id"), df[group_col], df[doc_col].isNotNull().alias("has_doc"), df[text_col].alias("txt")), make, f"row_id {kind}, {group_col} string, clean_text string", arrow)


def without_lines(df: DataFrame, hits: DataFrame, row_col: str = "row_id", text_col: str = "raw_text", out_col: str = "clean_text") -> DataFrame:
    """df with out_col: the text without the lines of hits (row_id, line_no), by a join on the row. Null texts stay null.

    A row's own line numbers are gathered, never those of a group of rows, so a row's size bounds the array.
    """
    drop = hits.groupBy("row_id").agg(F.collect_set("line_no").alias("_drop"))
    joined = df.join(drop, df[row_col] == drop["row_id"], "left").drop(drop["row_id"])
    parts = F.split(df[text_col], "\n", -1)
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col("_drop"), (i + 1).cast("int"))), "\n")
    return joined.withColumn(out_col, F.when(F.col("_drop").isNull(), df[text_col]).otherwise(kept)).drop("_drop")
