"""Problem 5: languages of texts and segments, by segmentation-marginalised unigrams over a fixed public vocabulary.

Each language has a probability for every piece of a public tokenizer's vocabulary. The likelihood of a word sums over
all its segmentations into pieces by the forward algorithm; the probabilities are fitted on the trusted samples by
expectation-maximisation with the same algorithm (the table of samples has a fixed size, which bounds the fit). A
sentence's score is the sum over its words; the posterior over languages, with equal priors, is the confidence.
Garbled words are restored and look-alikes brought to one alphabet before scoring.

Defined results: a null, empty or blank text has no segment and no language; a text without a full sentence is labelled
from all its words with kind 'words' and is never in the found rows; a record's segments are its runs of sentences of
one language, in order. Repeated rows are judged one by one.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Memo, map_rows
from .chars import readable
from .encode import TOKENIZERS
from .mojibake import shared

LONGEST = 12
JUNK, DOUBTFUL = -3.75, -3.0  # log likelihood a letter: below the first no prose, above the second surely prose
VOWELS = frozenset("аеёиоуыэюяўaeiouy")
ITEM = re.compile(r"\s*(?:[-–—•*]|\d+[.)])\s.*[;)]\s*\Z")
UNKNOWN = -14.0  # log probability of a character that is no piece
#: Words of a lower-case text in the alphabets of these languages.
WORD = re.compile(r"[a-zà-öø-ÿЀ-ӿ‘’]+").findall
SENTENCE = re.compile(r"[^.!?…]+[.!?…]")


@lru_cache(2)
def pieces(folder: str, name: str = "piece_bpe_32k.model") -> frozenset[str]:
    """The vocabulary's pieces in lower case, word starts marked by '^', and every single letter."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, name))
    found = {sp.id_to_piece(k).replace("▁", "^").lower() for k in range(sp.get_piece_size()) if not sp.is_control(k) and not sp.is_byte(k) and not sp.is_unknown(k)}
    return frozenset(p for p in found if 0 < len(p) <= LONGEST)


def words_of(text: str) -> list[str]:
    return WORD(text.lower().replace("`", "‘").replace("ʻ", "‘").replace("ʼ", "’").replace("'", "’"))


def spans(word: str, vocab: frozenset[str]) -> tuple[str, list[tuple[int, int, str]]]:
    """The marked word and all its pieces by place; letters outside the vocabulary are pieces of their own."""
    w = "^" + word
    return w, [(a, b, w[a:b]) for a in range(len(w)) for b in range(a + 1, min(len(w), a + LONGEST) + 1) if b == a + 1 or w[a:b] in vocab]


def _forward(n: int, edges: list[tuple[int, int, str]], p: dict[str, float]) -> list[float]:
    f = [0.0] * (n + 1)
    f[0] = 1.0
    for a, b, piece in edges:  # edges come in order of their start, so f[a] is complete
        f[b] += f[a] * p.get(piece, 1e-7 if b > a + 1 else 1e-6)
    return f


def _log_forward(n: int, edges: list[tuple[int, int, str]], p: dict[str, float]) -> float:
    """Logarithm of the forward probability of a whole word of any length: values that become small are scaled up."""
    f = [0.0] * (n + 1)
    f[0], shift, last = 1.0, 0.0, -1
    for a, b, piece in edges:
        if a != last:
            last = a
            if f[a] < 1e-150:
                up, shift = 1 / f[a], shift + math.log(f[a])
                f[a : a + LONGEST + 1] = [x * up for x in f[a : a + LONGEST + 1]]
        f[b] += f[a] * p.get(piece, 1e-7 if b > a + 1 else 1e-6)
    return math.log(f[n]) + shift


def fit(samples: Iterable[tuple[str, str]], vocab: frozenset[str], rounds: int = 4) -> dict[str, tuple[float, ...]]:
    """piece -> probability in each language (in sorted order), under '' the languages' names."""
    counts: dict[str, Counter] = {}
    for language, text in samples:
        counts.setdefault(language, Counter()).update(words_of(text))
    names = sorted(counts)
    fitted = []
    for name in names:
        lattice = [(len(w), e, n) for x, n in counts[name].items() if len(x) <= 40 for w, e in [spans(x, vocab)]]
        p: dict[str, float] = {}
        for _, e, n in lattice:
            for _, _, piece in e:
                p[piece] = p.get(piece, 0) + n * len(piece)
        total = sum(p.values())
        p = {k: v / total for k, v in p.items()}
        for _ in range(rounds):
            new: dict[str, float] = {}
            for length, edges, n in lattice:
                f = _forward(length, edges, p)
                back = [0.0] * (length + 1)
                back[length] = 1.0
                for a, b, piece in reversed(edges):
                    back[a] += back[b] * p.get(piece, 1e-7)
                for a, b, piece in edges:
                    x = f[a] * p.get(piece, 1e-7) * back[b] / f[length]
                    if x > 1e-6:
                        new[piece] = new.get(piece, 0.0) + n * x
            total = sum(new.values()) + 0.01 * len(new)
            p = {k: (v + 0.01) / total for k, v in new.items()}
        fitted.append(p)
    return {"": tuple(names), **{piece: tuple(p.get(piece, 1e-6 if len(piece) == 1 else 1e-7) for p in fitted) for piece in set().union(*fitted)}}


class Scorer:
    """Log likelihoods of words in each language."""

    def __init__(self, model: dict[str, tuple], vocab: frozenset[str]):
        self.names, self.vocab = model[""], vocab
        self.p = [{k: v[j] for k, v in model.items() if k} for j in range(len(self.names))]
        self.words = Memo(self.word)

    def word(self, word: str) -> tuple[float, ...]:
        w, edges = spans(word, self.vocab)
        return tuple(_log_forward(len(w), edges, p) for p in self.p)

    def totals(self, groups: list[list[str]]) -> np.ndarray:
        """Log likelihoods of groups of words, one row a group; no group may be empty."""
        ends = np.cumsum([len(g) for g in groups])
        flat = np.array([self.words[w] for g in groups for w in g])
        return np.add.reduceat(flat, np.concatenate([[0], ends[:-1]]), axis=0)

    def __call__(self, text: str) -> tuple[str, float, int]:
        """Most likely language, its posterior, and the number of words."""
        words = words_of(text)
        if not words:
            return "", 0.0, 0
        total = self.totals([words])[0]
        top = int(total.argmax())
        return self.names[top], float(1 / np.exp(np.maximum(total - total[top], -700)).sum()), len(words)


def sentences(text: str, least: int = 5) -> list[tuple[int, list[str]]]:
    """(line number, words) of the full sentences: running words up to a closing mark, no cells, no list items, no junk."""
    out = []
    low = text.lower().replace("`", "‘").replace("ʻ", "‘").replace("ʼ", "’").replace("'", "’")
    for no, line in enumerate(low.split("\n"), 1):
        if len(line) < 3 * least or "\t" in line or line.count("|") > 1 or ITEM.match(line):
            continue
        for s in SENTENCE.findall(line):
            words = WORD(s)
            if len(words) >= least:
                out.append((no, words))
    return out


def prose_like(words: list[str], top: float) -> bool:
    """Whether words can be prose of any of the languages: likely enough a letter, with enough vowels."""
    n = sum(map(len, words))
    return top / (n + len(words)) > JUNK and sum(c in VOWELS for w in words for c in w) >= 0.2 * n


def segments(text: str, score: Scorer, least: int = 5) -> list[tuple[str, float, int, int, int]]:
    """(language, confidence, first line, last line, words) of each run of full sentences of one language."""
    found = sentences(text, least)
    if not found:
        return []
    totals = score.totals([w for _, w in found])
    best = totals.argmax(axis=1)
    top = totals[np.arange(len(best)), best]
    sure = 1 / np.exp(np.maximum(totals - top[:, None], -700)).sum(axis=1)
    out: list[tuple[str, float, int, int, int]] = []
    for (no, words), k, t, c in zip(found, best.tolist(), top.tolist(), sure.tolist()):
        n, lang = len(words), score.names[k]
        if t / (sum(map(len, words)) + n) < DOUBTFUL and not prose_like(words, t):
            continue
        if out and out[-1][0] == lang:
            _, before, first, _, m = out[-1]
            out[-1] = (lang, (before * m + c * n) / (m + n), first, no, m + n)
        else:
            out.append((lang, c, no, no, n))
    return out


@lru_cache(2)
def _scorer(rows: tuple[tuple[str, str], ...], folder: str) -> Scorer:
    vocab = pieces(folder)
    return Scorer(fit(rows, vocab), vocab)


def identify(df: DataFrame, samples: DataFrame, row_col: str = "row_id", text_col: str = "raw_text", folder: str = TOKENIZERS, least: int = 5) -> DataFrame:
    """(row_id, segment_no, language, confidence, first_line, last_line, n_words, kind); kind is 'sentences', or 'words' for a
    text without a full sentence. Narrow: the samples' texts travel with the function, the model is fitted once a worker."""
    rows = tuple((r[0], r[1]) for r in samples.filter("language is not null and sample_text is not null").orderBy("sample_id").select("language", "sample_text").collect())
    kind = dict(df.dtypes)[row_col]
    arrow = pa.schema([("row_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()), ("segment_no", pa.int32()), ("language", pa.string()), ("confidence", pa.float64()), ("first_line", pa.int32()), ("last_line", pa.int32()), ("n_words", pa.int32()), ("kind", pa.string())])

    def make():
        score, fix = _scorer(rows, folder), shared(tuple(t for _, t in rows))

        def work(c: dict[str, list]) -> dict[str, list]:
            out = []
            for i, text in zip(c["row_id"], c["txt"]):
                text = readable(fix(text))
                found = segments(text, score, least)
                if found:
                    out += [(i, k, *s, "sentences") for k, s in enumerate(found, 1)]
                else:
                    lang, sure, n = score(text)
                    if n:
                        out.append((i, 1, lang, sure, 1, text.count("\n") + 1, n, "words"))
            return dict(zip(arrow.names, map(list, zip(*out)))) if out else {n: [] for n in arrow.names}

        return work

    src = df.select(df[row_col].alias("row_id"), df[text_col].alias("txt")).filter(F.trim("txt") != "")
    return map_rows(src, make, f"row_id {kind}, segment_no int, language string, confidence double, first_line int, last_line int, n_words int, kind string", arrow)


def mislabelled(df: DataFrame, samples: DataFrame, row_col: str = "row_id", text_col: str = "raw_text", label_col: str = "detected_language", folder: str = TOKENIZERS, least: int = 5) -> DataFrame:
    """(row_id, language): the languages of the full sentences of records whose label is missing or wrong, or which have several.

    The label travels through the narrow map as part of the key, so that no join is needed.
    """
    keyed = df.select(F.struct(df[row_col].cast("string").alias("r"), F.coalesce(df[label_col], F.lit("")).alias("l")).alias("k"), df[text_col].alias("txt"))
    packed = keyed.select(F.to_json("k").alias("k"), "txt")
    found = identify(packed, samples, "k", "txt", folder, least).filter("kind = 'sentences'")
    per = found.groupBy("row_id", "language").agg(F.sum("n_words").alias("n"))
    langs = per.groupBy("row_id").agg(F.collect_set("language").alias("langs"))
    k = F.from_json("row_id", "r string, l string")
    wrong = langs.filter((F.size("langs") > 1) | (F.element_at("langs", 1) != F.trim(k["l"])))
    return wrong.select(k["r"].cast(dict(df.dtypes)[row_col]).alias("row_id"), F.explode("langs").alias("language"))
