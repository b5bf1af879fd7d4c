"""Problem 4: one spelling for texts that look the same, by tries walked with a weighted edit automaton.

The vocabulary of the fixed tables (frequent words, texts with a trusted language) is a trie. A token walks it with an
automaton whose steps cost nothing for the same letter, for its look-alike of the other alphabet and for ignorable
characters, and are forbidden otherwise; a word reached at no cost is the canonical spelling. Other tokens are spelled
by table: canonical composition, ordinary width, and one alphabet, chosen by the letters that only one alphabet has.
Both ways depend on nothing but what a token looks like, so two texts get one form if and only if they look the same.

Defined results: a null text has a null form; a text of nothing but blanks and invisible characters never makes a pair;
rows with the same stored text make no pair with each other, but each makes one with every row that looks the same.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Memo, durable, map_rows
from .chars import CYR_TO_LAT, PLAIN, SKELETON, _PURE_CYR, _PURE_LAT, _TO_CYR, plain_text

TOKEN = re.compile(r"[^\W\d_]+(?:[̀-ͯ]+[^\W\d_]*)*")
TWIN = {**CYR_TO_LAT, **{l: c for c, l in CYR_TO_LAT.items()}}


class Automaton:
    """Walks a vocabulary trie; the cost of a look-alike or an ignorable character is 0, of any other difference too much."""

    def __init__(self, vocabulary: Iterable[str]):
        self.trie: dict = {}
        for word in sorted(set(vocabulary)):
            node = self.trie
            for ch in unicodedata.normalize("NFD", word):
                node = node.setdefault(ch, {})
            node.setdefault("", word)

    def spell(self, token: str) -> str | None:
        """The vocabulary's spelling of the token, the first in order where several look the same."""
        states = [self.trie]
        for ch in unicodedata.normalize("NFD", token):
            cost = PLAIN.get(ord(ch), ch)
            if cost is None:
                continue  # ignorable: every state stays
            ch = chr(cost) if isinstance(cost, int) else cost
            step = []
            for node in states:
                for x in (ch, TWIN.get(ch)):
                    if x and x in node:
                        step.append(node[x])
            if not step:
                return None
            states = step
        return min((node[""] for node in states if "" in node), default=None)


def by_table(token: str) -> str:
    """A spelling that depends on the looks alone: the alphabet of the letters that only one has, else Latin."""
    look = unicodedata.normalize("NFD", token).translate(SKELETON)
    if _PURE_CYR.search(look) and not _PURE_LAT.search(look):
        look = look.translate(_TO_CYR)
    return unicodedata.normalize("NFC", look)


class Canonical:
    def __init__(self, vocabulary: Iterable[str]):
        auto = Automaton(vocabulary)
        self.words = Memo(lambda w: auto.spell(w) or by_table(w))

    def __call__(self, text: str) -> str:
        words = self.words
        return TOKEN.sub(lambda m: words[m[0]], plain_text(text))


def vocabulary(common: DataFrame, samples: DataFrame) -> list[str]:
    """Words of the two fixed tables (a few thousand whatever the corpus size), in lower case and as written."""
    words = common.select(F.col("word").alias("w")).union(samples.select(F.explode(F.split("sample_text", r"(?U)[^\p{L}]+"))))
    return [r[0] for r in words.filter(F.length("w") > 0).distinct().collect()]


def consistent(df: DataFrame, vocab: list[str], row_col: str = "row_id", text_col: str = "raw_text", hashes: bool = False) -> DataFrame:
    """(row_id, text) in canonical form, or with hashes=True (row_id, look, stored): 128-bit digests of form and text."""
    kind = dict(df.dtypes)[row_col]
    key = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    src = df.select(df[row_col].alias("row_id"), df[text_col].alias("txt"))

    def make():
        canonical = Canonical(vocab)
        digest = lambda s: xxhash.xxh3_128_digest(s.encode("utf-8", "surrogatepass"))

        def work(c: dict[str, list]) -> dict[str, list]:
            forms = [t if t is None else canonical(t) for t in c["txt"]]
            if not hashes:
                return {"row_id": c["row_id"], "text": forms}
            rows = [(i, digest(f), digest(t)) for i, f, t in zip(c["row_id"], forms, c["txt"]) if f and not f.isspace()]
            return dict(zip(("row_id", "look", "stored"), map(list, zip(*rows)))) if rows else {"row_id": [], "look": [], "stored": []}

        return work

    if hashes:
        return map_rows(src, make, f"row_id {kind}, look binary, stored binary", pa.schema([("row_id", key), ("look", pa.binary()), ("stored", pa.binary())]))
    return map_rows(src, make, f"row_id {kind}, text string", pa.schema([("row_id", key), ("text", pa.string())]))


SALTS = 16
BLOCK = 256  # rows of one look that meet the rows of another block in one task


def _with_looks(rows: DataFrame, looks: DataFrame) -> DataFrame:
    """rows joined with a table of looks that is repeated over salts, so that a look of a third of all rows is split."""
    spread = looks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int")).join(spread, ["look", "salt"]).drop("salt")


def look_classes(df: DataFrame, vocab: list[str], row_col: str = "row_id", text_col: str = "raw_text") -> DataFrame:
    """(row_id, class_id, n_rows, several_forms): one row for each record that can be seen, with the least row_id of those that look the
    same, their number, and whether they are stored in several ways. The scalable form: copies are not expanded into pairs."""
    rows = durable(consistent(df, vocab, row_col, text_col, hashes=True))
    looks = rows.groupBy("look").agg(F.min("row_id").alias("class_id"), F.count(F.lit(1)).alias("n_rows"), (F.min("stored") != F.max("stored")).alias("several_forms"))
    return _with_looks(rows, looks).select("row_id", "class_id", "n_rows", "several_forms")


def same_looking_pairs(df: DataFrame, vocab: list[str], row_col: str = "row_id", text_col: str = "raw_text", block: int = BLOCK) -> DataFrame:
    """(row_id_a, row_id_b), a < b: all rows that look the same and differ as stored.

    Digests are grouped with partial aggregation; only looks stored in two ways or more go further. The rows of such a look are dealt
    into blocks of about `block` rows, and blocks meet two by two, so that no task has more than block x block pairs of a look;
    a row is repeated once for each block of its look, which is far less than its pairs.
    """
    rows = durable(consistent(df, vocab, row_col, text_col, hashes=True))
    several = rows.groupBy("look").agg(F.min("stored").alias("lo"), F.max("stored").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo <> hi")
    kept = _with_looks(rows, several.select("look", F.ceil(F.col("n") / block).cast("int").alias("blocks"))).withColumn("own", F.pmod(F.xxhash64("row_id", F.lit(1)), F.col("blocks")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    a = kept.select("look", "row_id", "stored", F.col("own").alias("x"), each.alias("y")).alias("a")
    b = kept.select("look", "row_id", "stored", each.alias("x"), F.col("own").alias("y")).alias("b")
    on = (F.col("a.look") == F.col("b.look")) & (F.col("a.x") == F.col("b.x")) & (F.col("a.y") == F.col("b.y")) & (F.col("a.row_id") < F.col("b.row_id")) & (F.col("a.stored") != F.col("b.stored"))
    return a.join(b, on).select(F.col("a.row_id").alias("row_id_a"), F.col("b.row_id").alias("row_id_b"))
