"""Problem 9: passages of evaluation items inside a corpus, by winnowing.

Words are compared without case, marks, look-alike differences and the choice of the Uzbek alphabet, as 64-bit hashes. Of every `w`
neighbouring k-grams of words the one with the smallest hash is a fingerprint, on both sides, so every shared run of
k + w - 1 words or more shares a fingerprint. A passage of n >= 15 words with at most n / 6 errors has an unchanged run
of at least ceil((n - e) / (e + 1)) >= 4 words, which is k + w - 1 for k = 3, w = 2: no passage is missed. Its unchanged runs
hold two fingerprints at least (a run of r words holds (r - 2) // 2 or more), so a document and an item with one in common are no pair.
Hits are extended to maximal equal runs, and runs are chained; a chain counts its item's words and its errors, and no gap is too wide for
it but one that holds more errors than the item allows.

The items' fingerprints are one table. While it is small, by a checked size, it is broadcast with the items' words and joined in a
narrow map over the documents; beyond it the fingerprints of both sides are joined by shuffle, with the items' side repeated over salts so
that a common phrase meets in no single task, and only pairs with enough hits are extended.

Defined results: null, empty and blank texts on either side have no passage; an opening sentence shared by
`shared_by` items or more is an instruction and no part of the items; repeated rows each give a row; an item twice under one id counts
once, with its first text in order.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Memo, durable, map_rows
from .chars import one_script, plain_text

APOSTROPHES = "‘’'`´ʻʼ"
#: Letters and digits with their accents; '_' divides words.
WORD = re.compile(r"[^\W_]+(?:[̀-ͯ]+[^\W_]*)*").findall
# Cyrillic letters and their letters in the Uzbek Latin alphabet (apostrophes left out).
LATIN = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюяўқғҳ", "a b v g d e yo j z i y k l m n o p r s t u f x ts ch sh sh . i . e yu ya o q g h".replace(".", "").split(" ")))
TO_LATIN = str.maketrans(LATIN)
K, W = 3, 2  # words of a k-gram, k-grams of a window
LEAST_HITS = 2
BROADCAST = 4_000_000  # words of all items: 32 MB of hashes, and fingerprints of about the same size
SALTS = 16
END = 0  # stands between two documents; no word has this hash


def fold_word(word: str) -> str:
    return one_script(word).translate(TO_LATIN).replace("ye", "e")


def raw_words(text: str) -> list[str]:
    text = plain_text(text).lower()
    for a in APOSTROPHES:
        text = text.replace(a, "")
    return WORD(text)


def word_hash(word: str) -> int:
    return (xxhash.xxh3_64_intdigest(fold_word(word)) or 1) - 2**63


def divided(text: str) -> tuple[list[str], list[str]]:
    """Words of the opening sentence, and the others."""
    head, _, rest = re.match(r"(?s)(.*?)([.!?:…]\s|\Z)(.*)", text).groups()
    return raw_words(head), raw_words(rest)


def winnow(ids: np.ndarray, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the fingerprints of a row of word hashes; END belongs to no k-gram."""
    n = len(ids) - k + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h, good = np.zeros(n, np.uint64), np.ones(n, bool)
    for j in range(k):
        part = ids[j : j + n]
        good &= part != END
        h = (h ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h[~good] = np.uint64(2**64 - 1)
    pick = np.zeros(n, bool)
    windows = np.lib.stride_tricks.sliding_window_view(h, min(w, n))
    pick[np.arange(len(windows)) + windows.argmin(axis=1)] = True
    pick &= good
    return np.flatnonzero(pick), h[pick].view(np.int64)


class Prints:
    """The items' words, flat, and their fingerprints in arrays sorted by value."""

    def __init__(self, items: Iterable[tuple[int, list[int]]]):
        items = [(i, np.array(w, np.int64)) for i, w in items]
        self.ids = np.array([i for i, _ in items], np.int64)
        self.flat = np.concatenate([np.empty(0, np.int64), *(w for _, w in items)])
        self.ends = np.cumsum([len(w) for _, w in items]).astype(np.int64)
        found = [winnow(w)[1] for _, w in items]
        value = np.concatenate([np.empty(0, np.int64), *found])
        own = np.repeat(np.arange(len(items)), [len(x) for x in found]).astype(np.int32)
        order = np.lexsort((own, value))
        value, own = value[order], own[order]
        first = np.ones(len(value), bool)
        first[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
        self.value, self.owner = value[first], own[first]

    def words(self, n: int) -> np.ndarray:
        """Hashed words of the n-th item."""
        return self.flat[self.ends[n - 1] if n else 0 : self.ends[n]]

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the item) of every fingerprint the row shares with an item."""
        at, value = winnow(ids)
        lo, hi = np.searchsorted(self.value, value, "left"), np.searchsorted(self.value, value, "right")
        n = hi - lo
        if not n.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        upto = np.cumsum(n)
        return np.repeat(at, n), self.owner[np.repeat(lo - (upto - n), n) + np.arange(upto[-1])]


def passage(doc: list[int], item: list[int], least: int = 15, one_in: int = 6) -> tuple[int, int] | None:
    """(words, errors) of the longest passage of the item within doc that is long and faithful enough."""
    places = defaultdict(list)
    for j, x in enumerate(item):
        places[x].append(j)
    runs, live = [], {}
    for d, x in enumerate(doc):
        now = {}
        for j in places.get(x, ()):
            now[j] = live.pop(j - 1, (d, j))
        runs += [(d0, j0, d - d0) for d0, j0 in live.values()]
        live = now
    runs += [(d0, j0, len(doc) - d0) for d0, j0 in live.values()]
    runs.sort()
    best, most = None, len(item) // one_in  # a chain with more errors than the whole item allows is no passage
    for a, (d0, j0, n0) in enumerate(runs):
        errors = {a: 0}
        for b in range(a, len(runs)):
            if b not in errors:
                continue
            d1, j1, n1 = runs[b]
            e, n = errors[b], j1 + n1 - j0
            # words changed at the very ends of a passage still are the item's words
            spare = min(max(least - n, 0), len(item) - n)
            if n + spare >= least and one_in * (e + spare) <= n + spare and (best is None or n > best[0]):
                best = (n, e)
            for c in range(b + 1, len(runs)):
                d2, j2, _ = runs[c]
                gap_d, gap_j = d2 - d1 - n1, j2 - j1 - n1
                if gap_d > most:
                    break
                if gap_d >= 0 and gap_j >= 0 and (cost := e + max(gap_d, gap_j)) <= most and cost < errors.get(c, most + 1):
                    errors[c] = cost
    return best


def extended(doc: list[int], at: list[int], item: list[int], least: int, one_in: int) -> tuple[int, int] | None:
    """The best passage around the hits `at` of a document; hits further apart than a passage of the item can be are judged apart."""
    if len(at) < LEAST_HITS or len(item) < least - least // one_in:
        return None
    m, best, k = len(item) + len(item) // one_in + K, None, 0
    while k < len(at):
        j = k
        while j + 1 < len(at) and at[j + 1] - at[j] <= m:
            j += 1
        got = passage(doc[max(0, at[k] - m) : at[j] + m], item, least, one_in) if j > k else None
        if got and (best is None or got > best):
            best = got
        k = j + 1
    return best


def item_words(items: DataFrame, shared_by: int = 3) -> DataFrame:
    """(item_id, words): hashed words of each item without its instruction. Instructions are counted over all items."""
    clean = items.filter(F.trim("text") != "").groupBy("item_id").agg(F.min("text").alias("text"))
    arrow = pa.schema([("item_id", pa.int64()), ("head", pa.list_(pa.int64())), ("rest", pa.list_(pa.int64()))])

    def make():
        number = Memo(word_hash)

        def work(c: dict[str, list]) -> dict[str, list]:
            parts = [divided(t) for t in c["text"]]
            return {"item_id": c["item_id"], "head": [[number[w] for w in h] for h, _ in parts], "rest": [[number[w] for w in r] for _, r in parts]}

        return work

    rows = durable(map_rows(clean.select(F.col("item_id").cast("bigint").alias("item_id"), "text"), make, "item_id bigint, head array<bigint>, rest array<bigint>", arrow)).withColumn("_h", F.xxhash64("head"))
    often = rows.groupBy("_h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= shared_by).select(F.col("_h").alias("_s"), F.lit(True).alias("_shared"))
    return rows.join(often, F.col("_h") == F.col("_s"), "left").select("item_id", F.when(F.col("_shared"), F.col("rest")).otherwise(F.concat("head", "rest")).alias("words"))


def find_leaks(docs: DataFrame, items: DataFrame, least: int = 15, one_in: int = 6, id_col: str = "doc_id", text_col: str = "text", broadcast: int = BROADCAST) -> DataFrame:
    """(doc_id, item_id, n_words, n_errors): the longest passage of each item in each document that holds one."""
    words = durable(item_words(items).filter(F.size("words") >= least - least // one_in))
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("txt")).filter(F.trim("txt") != "")
    total = words.agg(F.sum(F.size("words"))).first()[0] or 0
    return _by_broadcast(src, words, least, one_in) if total <= broadcast else _by_shuffle(src, words, least, one_in)


def _key(kind: str) -> pa.DataType:
    return pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()


def _by_broadcast(src: DataFrame, words: DataFrame, least: int, one_in: int) -> DataFrame:
    kind = src.schema["doc_id"].dataType.simpleString()
    arrow = pa.schema([("doc_id", _key(kind)), ("item_id", pa.int64()), ("n_words", pa.int32()), ("n_errors", pa.int32())])
    shared = src.sparkSession.sparkContext.broadcast(Prints((r[0], r[1]) for r in words.orderBy("item_id").toLocalIterator()))

    def make():
        prints, number = shared.value, Memo(word_hash)

        def work(c: dict[str, list]) -> dict[str, list]:
            ids, ends = [], []
            for t in c["txt"]:
                ids += [number[w] for w in raw_words(t)]
                ids += [END] * K  # no k-gram crosses two documents
                ends.append(len(ids))
            place, owner = prints.hits(np.array(ids, np.int64))
            doc = np.searchsorted(ends, place, "right")
            found = defaultdict(list)
            for p, d, i in zip(place.tolist(), doc.tolist(), owner.tolist()):
                found[d, i].append(p)
            out = []
            for (d, i), at in found.items():
                if len(at) < LEAST_HITS:
                    continue
                start = ends[d - 1] if d else 0
                best = extended(ids[start : ends[d] - K], [p - start for p in at], prints.words(i).tolist(), least, one_in)
                if best:
                    out.append((c["doc_id"][d], int(prints.ids[i]), *best))
            return dict(zip(arrow.names, map(list, zip(*out)))) if out else {n: [] for n in arrow.names}

        return work

    return map_rows(src, make, f"doc_id {kind}, item_id bigint, n_words int, n_errors int", arrow)


def _by_shuffle(src: DataFrame, words: DataFrame, least: int, one_in: int) -> DataFrame:
    """Fingerprints of both sides joined by value. The documents' words are a written table, so that pairs read them again."""
    kind = src.schema["doc_id"].dataType.simpleString()

    def hashed():
        number = Memo(word_hash)
        return lambda c: {"doc_id": c["doc_id"], "words": [[number[w] for w in raw_words(t)] for t in c["txt"]]}

    def printed(with_places: bool):
        def work(c: dict[str, list]) -> dict[str, list]:
            key, places, values = [], [], []
            for i, w in zip(c["key"], c["words"]):
                at, value = winnow(np.array(w, np.int64))
                if not with_places:
                    value = np.unique(value)
                    at = np.zeros(len(value), np.int64)
                key += [i] * len(value)
                places += at.tolist()
                values += value.tolist()
            return {"key": key, "place": places, "print": values}

        return lambda: work

    flat = pa.schema([("key", pa.int64()), ("place", pa.int32()), ("print", pa.int64())])
    rows = map_rows(src, hashed, f"doc_id {kind}, words array<bigint>", pa.schema([("doc_id", _key(kind)), ("words", pa.list_(pa.int64()))]))
    texts = durable(rows.withColumn("key", F.monotonically_increasing_id()))  # repeated rows keep keys of their own
    there = map_rows(words.select(F.col("item_id").alias("key"), "words"), printed(False), "key bigint, place int, print bigint", flat)
    here = map_rows(texts.select("key", "words"), printed(True), "key bigint, place int, print bigint", flat)
    salted = there.select(F.col("key").alias("item_id"), F.col("print"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    joined = here.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(salted, ["print", "salt"])
    pairs = joined.groupBy("key", "item_id").agg(F.array_sort(F.collect_list("place")).alias("at")).filter(F.size("at") >= LEAST_HITS)
    full = pairs.join(words.withColumnRenamed("words", "item"), "item_id").join(texts, "key")
    arrow = pa.schema([("doc_id", _key(kind)), ("item_id", pa.int64()), ("n_words", pa.int32()), ("n_errors", pa.int32())])

    def judged():
        def work(c: dict[str, list]) -> dict[str, list]:
            got = [(d, i, *best) for d, i, at, item, w in zip(c["doc_id"], c["item_id"], c["at"], c["item"], c["words"]) if (best := extended(w, at, item, least, one_in))]
            return dict(zip(arrow.names, map(list, zip(*got)))) if got else {n: [] for n in arrow.names}

        return work

    return map_rows(full.select("doc_id", "item_id", "at", "item", "words"), judged, f"doc_id {kind}, item_id bigint, n_words int, n_errors int", arrow)
