"""Problem 6: per-document text statistics and the nearest structural profile by Jensen-Shannon divergence.

A text has three distributions: of its tokens over the function words of a language and classes of other tokens, of its
characters over classes, and, as basic counts, of its characters over shapes of lines. Each is compared with profiles by
Jensen-Shannon divergence; the kind of the nearest profile is the kind of the text, and no other rule decides it.

Profiles are fitted on the fixed table of trusted samples, each language by itself: prose from the samples as they are, cut into
lines and without blanks; lists, tables and junk from the same words laid out as entries, as rows of cells, and with the vowels,
the letters or the words lost (see layouts). Lines repeated within the source are left aside.

Defined results: null and blank texts, and texts of nothing but repeated lines, have null statistics and kind null;
garbled text is restored before it is judged; repeated rows are judged one by one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import map_rows
from .chars import readable
from .mojibake import shared

KINDS = ("prose", "list", "table", "junk")
#: Characters by class; blanks and line feeds between tokens are counted too.
CLASSES = ("vowel", "consonant", "digit", "sentence mark", "cell mark", "entry mark", "other", "blank")
#: Tokens that are no function word.
TOKENS = ("word", "number", "code", "broken word", "signs", "run")
#: Lines: rows of cells, one solid token, marked entries by length, other lines by length and closing mark.
SHAPES = ("cells", "solid", "entry", "long entry", *(f"{n} {e}" for n in ("short", "middle", "long") for e in ("open", "closed")))
WEIGHTS = (0.3, 0.3, 0.4)  # tokens, characters, lines
VOWELS = frozenset("аеёиоуыэюяўaeiouyáéíóúïöü")
SENTENCE_MARKS, CELL_MARKS, ENTRY_MARKS = frozenset(".,!?…:"), frozenset("|\t;"), frozenset("-–—•*·▪●○◦‣")
BULLET = re.compile(r"\s*(?:[-–—•*·▪●○◦‣+]|\(?\d{1,3}[.)]|[a-zа-я][.)])\s+\S")
ENDS = re.compile(r"[.!?…][»”\"’)\]*]*\s*\Z")
GAPS = re.compile(r"(?<=\S)\s{3,}(?=\S)")
CORE = re.compile(r"[^\W_](?:.*[^\W_])?", re.S)
WORD = re.compile(r"[^\W\d_]+(?:[‘’'-][^\W\d_]+)*[‘’']?\Z")
NUMBER = re.compile(r"\d+(?:[.,:/x×-]\d+)*\Z")
LONGEST = 30


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Divergence in bits, 0 to 1, of distributions along the last axis."""
    p, q = np.asarray(p, float), np.asarray(q, float)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a, b = np.where(p > 0, p * np.log2(p / m), 0.0), np.where(q > 0, q * np.log2(q / m), 0.0)
    return np.maximum((a.sum(-1) + b.sum(-1)) / 2, 0.0)


def token_class(core: str) -> int:
    """Place in TOKENS of a token without its outer signs."""
    if not core:
        return 4
    if len(core) > LONGEST:
        return 5
    if NUMBER.match(core):
        return 1
    if not WORD.match(core):
        return 2
    n = sum(map(str.isalpha, core))
    return 0 if sum(c in VOWELS for c in core) >= 0.17 * n and n > 1 else 3


def char_counts(token: str) -> list[int]:
    """Characters of a token by CLASSES, all but blanks."""
    out = [0] * len(CLASSES)
    for c in token:
        low = c.lower()
        out[0 if low in VOWELS else 1 if c.isalpha() else 2 if c.isdigit() else 3 if c in SENTENCE_MARKS else 4 if c in CELL_MARKS else 5 if c in ENTRY_MARKS else 6] += 1
    return out


def line_shape(line: str, n_tokens: int) -> int:
    """Place in SHAPES of a line that is not blank. Cells are divided by bars, tabs, tight semicolons or wide gaps, and have few tokens each."""
    bars, tight = line.count("|"), line.count(";") - line.count("; ") - line.rstrip().endswith(";")
    cuts = bars if bars > 1 else line.strip().count("\t") or (tight if tight > 1 else len(GAPS.findall(line)) if "   " in line else 0)
    if cuts and n_tokens <= 8 * (cuts + 1):
        return 0
    if n_tokens == 1 and len(line) > LONGEST:
        return 1
    if BULLET.match(line):
        return 2 if n_tokens < 10 else 3
    return 4 + 2 * (0 if n_tokens < 6 else 1 if n_tokens < 12 else 2) + (ENDS.search(line) is not None)


def layouts(words: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """(kind, text): the words and texts of one language laid out as each kind. Nothing is drawn at random."""
    content = words or ["a"]
    pick = lambda k, n: " ".join(content[(k * 7 + j) % len(content)] for j in range(n))
    num = lambda k: f"{(k * 37) % 400 + 1}" if k % 3 else f"{(k * 13) % 90}.{k % 10}"
    whole = "\n".join(texts)
    out = [("prose", whole), ("prose", re.sub(r"(?<=[.!?]) ", "\n", whole)), ("prose", re.sub(r"([^\n]{60}\S*) ", r"\1\n", whole)), ("prose", whole.replace(" ", ""))]
    out += [("prose", "\n".join(f"{pick(k, 1 + k % 3)}\n\n{t}" for k, t in enumerate(texts)))]
    entries = [f"{pick(k, 1 + k % 4)}{f' {num(k)}' if k % 3 == 0 else ''}{';' if k % 4 == 1 else ''}" for k in range(60)]
    out += [("list", "\n".join(f"{mark.format(k + 1)}{e}" for k, e in enumerate(entries))) for mark in ("– ", "{}. ", "* ", "")]
    rows = [[pick(k, 1), pick(k + 3, 1 + k % 3), *(num(k + j) for j in range(k % 3 + 1))] for k in range(40)]
    out += [("table", "\n".join(sep.join(r) for r in rows)) for sep in ("\t", " | ", ";")]
    out += [("table", "\n".join(f"| {' | '.join(r)} |" for r in rows)), ("table", "\n".join("".join(c.ljust(26) for c in r) for r in rows))]
    letters = re.sub(r"[\W\d_]", "", whole)
    bare = "".join(c for c in letters.lower() if c not in VOWELS) or "x"
    noise = [bare[(k * 11) % len(bare) :][: 1 + k % 4] + (str(k % 9) if k % 5 == 0 else "") + (".:;"[k % 3] if k % 6 == 0 else "") for k in range(600)]
    codes = "".join(f"{c.upper() if k % 2 else c}{k * 7 % 10 if k % 3 == 0 else ''}" for k, c in enumerate((letters * 3)[:3000]))
    signs = "".join("=/\\|-_~^#<>{}[]+*.,:;'\"1l"[(k * k + 3 * k) % 25] for k in range(3000))
    out += [("junk", "\n".join(" ".join(noise[k : k + 18]) for k in range(0, 600, 18))), ("junk", "\n".join(codes[k : k + 70] for k in range(0, len(codes), 70))), ("junk", "\n".join(signs[k : k + 64] for k in range(0, 3000, 64)))]
    out += [("junk", "\n".join(f"{'._-='[k % 4] * (30 + k % 20)} {num(k)}" for k in range(40)))]
    out += [("junk", "\n".join(" ".join(str((k * j * j + 7 * j) % 10 ** (1 + (k + j) % 6)) for j in range(1, 6 + k % 9)) for k in range(1, 60)))]
    return out


class Profiles:
    """Profiles of every kind in every language, and the tables that turn texts into distributions."""

    def __init__(self, samples: list[tuple[str, str]], common: Iterable[tuple[str | None, str]]):
        own: dict[str | None, set[str]] = {}
        for language, word in common:
            own.setdefault(language, set()).add(word.lower())
        self.words = sorted(set().union(*own.values())) if own else []
        self.place = {w: k for k, w in enumerate(self.words)}
        self.index: dict[str, int] = {}
        self.kinds: list[tuple[int, int]] = []
        self.reset()
        by: dict[str, list[str]] = {}
        for language, text in samples:
            by.setdefault(language, []).append(text)
        self.masks, rows = [], []
        for language, texts in sorted(by.items()):
            self.masks.append(np.array([w in own.get(language, ()) for w in self.words] + [True] * len(TOKENS)))
            content = [w for w in dict.fromkeys(re.findall(r"[^\W\d_]{3,}", "\n".join(texts))) if w.lower() not in self.place]
            for kind, text in layouts(content, texts):
                rows.append(self.distribution(self.counts(text))[-1])
                self.kinds.append((KINDS.index(kind), len(self.masks) - 1))
        self.which, self.language = np.array(self.kinds).reshape(-1, 2).T
        self.profiles = np.array(rows, np.float32).reshape(len(rows), -1)
        self.weights = np.repeat(np.array(WEIGHTS, np.float32), (len(self.words) + len(TOKENS), len(CLASSES), len(SHAPES)))
        self.own = self.entropy(self.profiles)

    def distribution(self, counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """The three distributions side by side, one row a language: function words of other languages are words like others."""
        n = len(self.words)
        tokens = np.where(self.masks, counts[0], 0.0)
        tokens[:, n] += counts[0].sum() - tokens.sum(1)
        rest = np.concatenate([x / max(x.sum(), 1) for x in counts[1:]])
        return np.hstack([tokens / max(counts[0].sum(), 1), np.broadcast_to(rest, (len(tokens), len(rest)))]).astype(np.float32)

    def entropy(self, p: np.ndarray) -> np.ndarray:
        """Weighted sum of p log2 p, so that a divergence is half the sum of two of them less that of the middle."""
        return (p * np.log2(np.maximum(p, 1e-30))) @ self.weights

    def reset(self) -> None:
        self.index.clear()
        self.classes, self.made = np.zeros(1024, np.int32), np.zeros((1024, len(CLASSES)), np.int32)

    def learn(self, token: str) -> int:
        m = CORE.search(token)
        core = m[0] if m else ""
        at = self.place.get(core.lower())
        k = self.index[token] = len(self.index)
        if k == len(self.classes):
            self.classes, self.made = np.concatenate([self.classes, np.zeros_like(self.classes)]), np.concatenate([self.made, np.zeros_like(self.made)])
        self.classes[k] = len(self.words) + token_class(core) if at is None else at
        self.made[k] = char_counts(token)
        return k

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens by function word and class, characters by class, characters by shape of their lines."""
        if len(self.index) > 400_000:
            self.reset()
        index, ids = self.index, []
        lines = [0] * len(SHAPES)
        chars = np.zeros(len(CLASSES))
        for line in text.split("\n"):
            tokens = line.split()
            if tokens:
                lines[line_shape(line, len(tokens))] += sum(map(len, tokens))
                ids += tokens
                chars[4] += line.count("\t")
                chars[7] += len(tokens)
        at = np.array([index[t] if t in index else self.learn(t) for t in ids], np.int64)
        tokens = np.bincount(self.classes[at], minlength=len(self.words) + len(TOKENS)).astype(float)
        chars += self.made[at].sum(0)
        return tokens, chars, np.array(lines, float)

    def divergences(self, counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Weighted Jensen-Shannon divergence from every profile."""
        own = self.distribution(counts)
        return (self.entropy(own)[self.language] + self.own) / 2 - self.entropy((own[self.language] + self.profiles) / 2)

    def nearest(self, counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[str, float]:
        """Kind of the nearest profile, and the divergence from the nearest prose."""
        if not len(self.which):  # no samples, nothing to compare with
            return "prose", 0.0
        d = self.divergences(counts)
        return KINDS[self.which[int(d.argmin())]], max(float(d[self.which == 0].min()), 0.0)


NAMES = ["row_id", "n_chars", "n_words", "mean_word_length", "letter_ratio", "symbol_ratio", "line_end_ratio", "common_word_ratio", "divergence", "kind"]


def describe(text: str, counts: tuple[np.ndarray, np.ndarray, np.ndarray], n_common: int) -> tuple:
    """n_chars to common_word_ratio of NAMES: basic counts of a text."""
    tokens, chars, lines = counts
    n = max(len(text), 1)
    words = int(tokens[: n_common + 1].sum() + tokens[n_common + 3] + tokens[n_common + 5])
    closed = [x for x in text.split("\n") if x.strip()]
    letters = float(chars[0] + chars[1])
    return len(text), words, letters / max(words, 1), letters / n, float(chars[4] + chars[5] + chars[6]) / n, sum(ENDS.search(x) is not None for x in closed) / max(len(closed), 1), float(tokens[:n_common].sum()) / max(words, 1)


def statistics(df: DataFrame, samples: DataFrame, common: DataFrame, row_col: str = "row_id", text_col: str = "clean_text", left_aside: Callable[[], Callable[[object, str], str]] | None = None, group_col: str | None = None) -> DataFrame:
    """One row of NAMES for every row of df. Narrow; the two fixed tables travel with the function.

    left_aside() makes a function (group, text) -> text that is applied first, with the values of group_col, so that lines are
    left out and texts judged in one pass over them.
    """
    trusted = [(r[0], r[1]) for r in samples.filter("language is not null and sample_text is not null").orderBy("sample_id").select("language", "sample_text").collect()]
    frequent = sorted({(r[0] or "", r[1]) for r in common.filter("word is not null").select("language", "word").collect()})
    kind = dict(df.dtypes)[row_col]

    def make():
        profiles, fix = Profiles(trusted, frequent), shared(tuple(t for _, t in trusted))
        aside = left_aside() if left_aside else None
        n_common = len(profiles.words)

        def one(i, group, text):
            if text and aside:
                text = aside(group, text)
            if not text or not text.strip():
                return (i, *[None] * 9)
            stored, text = text, readable(text)
            counts = profiles.counts(text)
            what, far = profiles.nearest(counts)
            if what != "prose" and fix.garbled(stored):  # as stored: what looks like a blank may be a byte
                text = readable(fix(stored))
                counts = profiles.counts(text)
                what, far = profiles.nearest(counts)
            return (i, *describe(text, counts, n_common), far, what)

        return lambda c: dict(zip(NAMES, map(list, zip(*map(one, c["row_id"], c["grp"], c["txt"])))))

    arrow = pa.schema([("row_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()), ("n_chars", pa.int32()), ("n_words", pa.int32()), *((n, pa.float64()) for n in NAMES[3:9]), ("kind", pa.string())])
    src = df.select(df[row_col].alias("row_id"), (df[group_col] if group_col else F.lit(None).cast("string")).alias("grp"), df[text_col].alias("txt"))
    return map_rows(src, make, f"row_id {kind}, n_chars int, n_words int, " + ", ".join(f"{n} double" for n in NAMES[3:9]) + ", kind string", arrow)
