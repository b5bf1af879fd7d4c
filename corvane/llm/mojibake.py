"""Problem 3: text decoded with a wrong character encoding, by best-first search over encode, decode and unescape steps.

States are strings; an edge encodes a state with one charset and decodes the bytes with another, unescapes entities, or
brings look-alikes to plain form. States already seen are skipped by hash. A character-plausibility cost (letter pairs
of the trusted language samples, plus fixed costs for signs that no text of these languages has) orders the frontier, and
the cheapest state reached is the restored text. Words are searched, then runs of words agree on one chain of steps.

Defined results: null and empty texts are unchanged and never found; a text with U+FFFD inside is always found (characters
were lost for good), as is one with words of question marks or runs of them between letters, and restored as far as its other characters allow; rare letters and signs that no step makes more
plausible stay as they are. Repeated rows are judged one by one.
"""

from __future__ import annotations

import codecs
import heapq
import html
import math
import re
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Memo, map_rows
from .chars import readable

CHARSETS = ("cp1252", "latin-1", "cp1251", "koi8-r", "cp866", "mac-cyrillic", "iso8859-5", "cp437", "mac-roman")
LETTERS = "abcdefghijklmnopqrstuvwxyzабвгдеёжзийклмнопрстуфхцчшщъыьэюяўқғҳ‘’"
ORDINARY = re.compile(r"[\x20-\x7eА-Яа-яЁёЎўҚқҒғҲҳ«»“”‘’–—№°±…]*\Z")
CONTROL = re.compile(r"[\x7f-\x9f\ufffd]")
#: Charsets that texts of these languages are written in.
ORIGINAL = ("cp1251", "koi8-r", "cp866", "mac-cyrillic", "iso8859-5", "cp1252")
ASCII = re.compile(r"[\x20-\x7e]*\Z")
STEP = 3.0  # nats for every decoding step
LOST = "�"
RISE = re.compile(r"[a-zа-яёўқғҳà-öø-ÿ](?=[A-ZА-ЯЁЎҚҒҲÀ-ÖØ-Þ])")
#: A Cyrillic word in the usual case: no pair of the charsets above makes one out of another such word.
SIMPLE = re.compile(r"[«“(\[]*[А-ЯЁЎҚҒҲ]?[а-яёўқғҳ]{2,}(?:-[а-яёўқғҳ]+)*[»”)\]]*\Z")
SPLIT = re.compile(r"[\n\t .,;:()]+").split
HIDDEN = re.compile("[\xa0\xad]")
#: Signs that a restored word may have.
FAMILIAR = re.compile(r"[\x20-\x7eА-Яа-яЁёЎўҚқҒғҲҳ«»“”‘’–—№°±…\u00a0-\u00ff€•″′≤≥×™\ufffd\U0001d400-\U0001d7ff]*\Z")
#: Words of ordinary signs that may still be bytes: a sign right after a letter, or two alphabets at once.
DOUBT = re.compile(r"[A-Za-zЀ-ӿ][°±№…“–—]|[Ѐ-ӿ][‘’”]|[A-Za-z‘’][А-яЁёЎўҚқҒғҲҳ]|[А-яЁёЎўҚқҒғҲҳ][A-Za-z]")

#: A restored word of letters that were other letters before, and the words that steps may lead to one: they keep digits and numbers of letters.
WORD_LIKE = re.compile(r"[^\w]*\w[^\W\d_A-ZА-ЯЁ?-]{4,}[^\w]*\Z")
SWAPPED = re.compile(r"(?=(?:\W*[^\W\d_]|\W*\d(?=\W*[^\W\d_])|[^?]*\?){4})(?!.*[^\W\d_].*[0-9_])|.*&")
#: Character references with their closing sign, perhaps escaped again.
ENTITY = re.compile(r"&(?:amp;)*(?:#\d{2,7}|#[xX][0-9a-fA-F]{2,6}|[A-Za-z][A-Za-z0-9]{1,30});")
#: Letters that became question marks: words of nothing else, or runs between two letters. A mark after a word is punctuation.
ERASED = re.compile(r"(?<!\S)[«“\"(]*\?{4,}[\])».,:;”\"]*(?!\S)|(?<!\S)\?{2,}[.,;:]?[ \t]+\?{2,}[.,;:]?(?!\S)|[^\W\d_]\?{2,}[^\W\d_]")


def _open(m: re.Match) -> str:
    s = m[0]
    while (u := html.unescape(s)) != s:
        s = u
    return s


def unescaped(text: str) -> str:
    """A text whose characters stand in it as references is unescaped whole, before it is cut into words; a text in which
    references stand for ASCII signs only is no case and stays."""
    if "&" not in text or all(_open(m).isascii() for m in ENTITY.finditer(text)):
        return text
    return ENTITY.sub(_open, text)


def _table(name: str) -> str:
    """256 characters; bytes without a meaning stand for themselves, as lenient decoders have it."""
    return "".join(bytes([b]).decode(name, "ignore") or chr(b) for b in range(256))


DECODE = {name: _table(name) for name in CHARSETS}
ENCODE = {name: {ord(c): b for b, c in enumerate(t)} | {0xFFFD: 0xFF} for name, t in DECODE.items()}


def _flat(c: str) -> float:
    """Cost of a sign outside the trained letters."""
    o = ord(c)
    if o < 128:
        return 2.5 if c.isalnum() or c in " .,;:()-" else 3.5 if o >= 32 else 6.0
    if c in "«»“”–—№°±…":
        return 3.5
    if c == LOST:
        return 5.0
    if c.isalpha() and (0x250 <= o < 0x400 or o >= 0x530) and not 0x1D400 <= o < 0x1D800:
        return 16.0  # a letter of none of the scripts in question
    return 7.0 if c.isalpha() and o < 0x250 else 6.0 if o in (0xA7, 0xB2, 0xB3, 0xB5, 0xBD, 0xD7, 0x2022, 0xA9, 0xAE) else 8.5


class Plausibility:
    """Nats of a word: letter pairs with smoothing, word edges, capitals in odd places."""

    def __init__(self, samples: Iterable[str]):
        pairs, single = Counter(), Counter()
        known = set(LETTERS)
        for text in samples:
            for word in re.findall(r"[^\W\d_]+(?:[‘’][^\W\d_]+)*[‘’]?", text.lower()):
                w = f"^{''.join(c for c in word if c in known)}$"
                pairs.update(zip(w, w[1:]))
                single.update(w[:-1])
        n = len(LETTERS) + 2
        self.pair = {(a, b if b != "$" else ""): -math.log((pairs[a, b] + 0.02) / (single[a] + 0.02 * n)) for a in "^" + LETTERS for b in LETTERS + "$"}
        self.end = {a: min(self.pair[a, ""], 4.0) for a in LETTERS}
        self.flat = Memo(_flat, 70_000)

    def __call__(self, s: str) -> float:
        low = s.lower()
        total, last, pair, end, flat = 0.0, "^", self.pair.get, self.end, self.flat
        for c in low:
            p = pair((last, c))
            if p is not None:
                total += p
                last = c
            else:
                if last != "^":
                    total += end[last]
                total += flat[c]
                last = "^"
        if last != "^":
            total += end[last]
        if low != s and len(low) == len(s):
            total += 4.0 * len(RISE.findall(s)) + (0.2 * len(s) if s.isupper() else 0.0)
        return total


def plain(s: str) -> str:
    """Look-alikes, blanks and invisible signs in ordinary form; control characters stay, for they may be bytes."""
    return s if CONTROL.search(s) else readable(s)


def _steps(s: str):
    """(name, next state) of every step that applies. Bytes that are valid UTF-8 leave no doubt about their charset."""
    p = plain(s)
    if p != s:
        yield "look", p
    if "&" in s and (u := html.unescape(s)) != s:
        yield "unescape", u
    raws, sure = [], False
    for e, table in ENCODE.items():
        try:
            raw = codecs.charmap_encode(s, "strict", table)[0]
        except (UnicodeEncodeError, TypeError):
            continue
        if max(raw, default=0) >= 128:
            u = raw.decode("utf-8", "replace")
            sure |= LOST not in u
            raws.append((e, raw))
            yield f"{e}>utf-8", u
    if not sure:
        for e, raw in raws:
            for d in ORIGINAL:
                if d != e:
                    yield f"{e}>{d}", codecs.charmap_decode(raw, "strict", DECODE[d])[0]


def take(s: str, step: str) -> str | None:
    """The state one named step leads to, if it applies."""
    if step == "look":
        return plain(s)
    if step == "unescape":
        return html.unescape(s)
    e, d = step.split(">")
    try:
        raw = codecs.charmap_encode(s, "strict", ENCODE[e])[0]
    except (UnicodeEncodeError, TypeError):
        return None
    return raw.decode("utf-8", "replace") if d == "utf-8" else codecs.charmap_decode(raw, "strict", DECODE[d])[0]


def search(s: str, cost: Plausibility) -> tuple[str, float, tuple[str, ...]]:
    """Cheapest state, its cost with steps, and the steps. States are expanded until the next costs clearly more than the
    best (12 nats) or no step that is left can be cheaper; a state that costs more than the one it came from (4 nats) is not followed.
    There is no limit of states or steps: every step has a cost, so a path ends where its steps alone cost more than the best state."""
    start = cost(s)
    best = (start, s, ())
    heap: list[tuple[float, str, tuple[str, ...]]] = [(start, s, ())]
    seen = {hash(s)}
    lost = 2 * s.count(LOST) + s.count("?")
    while heap:
        total, state, path = heapq.heappop(heap)
        if path and (total > best[0] + 12 or total < 3.0 * (len(state) + 1) and ORDINARY.match(state)):
            break
        if STEP * (sum(x != "look" for x in path) + 1) >= best[0]:
            continue
        for name, nxt in _steps(state):
            h = hash(nxt)
            if h in seen or nxt.count(LOST) > lost:
                continue
            seen.add(h)
            steps = (*path, name)
            price = cost(nxt) + STEP * sum(x != "look" for x in steps)
            if price < best[0]:
                best = (price, nxt, steps)
            if price < total + 4:
                heapq.heappush(heap, (price, nxt, steps))
    return best[1], best[0], best[2]


class Repair:
    """Judges words from a cache and repairs texts."""

    def __init__(self, samples: Iterable[str], floor: float = 4.8, gain: float = 9.0, swap: float = 14.0):
        self.cost, self.floor, self.gain, self.swap = Plausibility(samples), floor, gain, swap
        self.words = Memo(self.judge)

    def judge(self, word: str) -> tuple[float, str, tuple[str, ...]] | None:
        """(gain, restored, steps) of a word that decoding makes clearly more plausible; (0, word, ()) where characters were
        lost and no step helps; None otherwise."""
        if ASCII.match(word) or SIMPLE.match(word):
            return None
        look = plain(word)
        if look != word and not HIDDEN.search(word) and not CONTROL.search(word) and ORDINARY.match(look):
            return self.words[look]  # variants that look the same share one verdict
        own = self.cost(look)
        usual = ORDINARY.match(look)
        if usual and not DOUBT.search(look) and (own < self.floor * (len(look) + 1) or not SWAPPED.match(look)):
            return None
        fixed, price, steps = search(look, self.cost)
        if HIDDEN.search(word):  # what looks like a blank or a soft hyphen may be a byte
            other = search(word, self.cost)
            if other[2] and other[1] <= price + 4 and len(other[0]) >= len(fixed):
                fixed, price, steps = other
        gain = own - price
        if steps and price - STEP * len(steps) < 4.2 * (len(fixed) + 1):
            decodes = sum(x != "look" for x in steps)
            if steps[-1].endswith("utf-8") and gain >= 4 and LOST not in fixed and FAMILIAR.match(fixed) and (not usual or decodes == 1 and DOUBT.search(look)):
                return gain + 8, fixed, steps
            if usual:  # letters became other letters: only a large gain tells, and letters stay letters
                if gain >= self.swap and WORD_LIKE.match(fixed.replace("?", "а")) and sum(map(str.isalpha, look)) == sum(map(str.isalpha, fixed)):
                        return gain, fixed, steps
            elif gain >= self.gain and FAMILIAR.match(fixed):
                return gain + 8, fixed, steps
        return (0.0, word, ()) if LOST in word else None

    def bad(self, text: str) -> dict[str, tuple[float, str, tuple[str, ...]]]:
        """The garbled words of a text."""
        words = self.words
        return {w: r for w in dict.fromkeys(SPLIT(text)) if (r := words[w]) is not None}

    def garbled(self, text: str | None, least: float = 12.0) -> bool:
        if not text:
            return False
        if LOST in text or "??" in text and ERASED.search(text) or unescaped(text) != text:
            return True
        if text.isascii():
            return False
        total, odd = 0.0, False
        for w in dict.fromkeys(SPLIT(text)):
            if (r := self.words[w]) is not None:
                total += r[0]
                odd = odd or not ORDINARY.match(w)
                if total >= (least if odd else least + 8):
                    return True
        return False

    def __call__(self, text: str | None) -> str | None:
        if not self.garbled(text):
            return text
        text = unescaped(text)
        bad = self.bad(text)
        chains = Counter()
        for gain, _, steps in bad.values():
            chains[tuple(x for x in steps if x != "look")] += gain
        chains.pop((), None)
        lines = []
        for line in text.split("\n"):
            words = re.split(r"([\t .,;:()]+)", line)
            hit = [w in bad for w in words]
            if any(hit):
                top = [c for c, _ in chains.most_common(3)]
                words = [self.restore(w, bad.get(w), top, any(hit[max(0, k - 4) : k + 5])) for k, w in enumerate(words)]
                line = "".join(words)
            lines.append(line)
        return "\n".join(lines)

    def restore(self, word: str, own: tuple | None, chains: list, near: bool) -> str:
        """A garbled word restored; its neighbours follow the text's main chains where that makes them no less plausible."""
        if own and own[2]:
            return own[1]
        if not near or word.isascii():
            return word
        now, best = self.cost(word), word
        for chain in chains:
            s = word
            for step in chain:
                s = take(s, step) if s is not None else None
            if s is not None and (c := self.cost(s)) < now - 0.5:
                now, best = c, s
        return best


@lru_cache(2)
def shared(samples: tuple[str, ...]) -> Repair:
    """One judge a Python worker: its caches serve all tasks that the worker runs."""
    return Repair(samples)


def sample_texts(samples: DataFrame) -> list[str]:
    """The fixed table of trusted texts, in a fixed order."""
    return [r[0] for r in samples.filter(F.col("sample_text").isNotNull()).orderBy("sample_id").select("sample_text").collect()]


def repair(df: DataFrame, samples: list[str], row_col: str = "row_id", text_col: str = "raw_text") -> DataFrame:
    """(row_id, garbled, text): whether any passage was garbled, and the restored text. Narrow."""
    kind = dict(df.dtypes)[row_col]

    def make():
        fix = shared(tuple(samples))

        def work(c: dict[str, list]) -> dict[str, list]:
            flags = [fix.garbled(t) for t in c["txt"]]
            return {"row_id": c["row_id"], "garbled": flags, "text": [fix(t) if f else t for f, t in zip(flags, c["txt"])]}

        return work

    arrow = pa.schema([("row_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()), ("garbled", pa.bool_()), ("text", pa.string())])
    return map_rows(df.select(df[row_col].alias("row_id"), df[text_col].alias("txt")), make, f"row_id {kind}, garbled boolean, text string", arrow)


def garbled_rows(df: DataFrame, samples: list[str], row_col: str = "row_id", text_col: str = "raw_text") -> DataFrame:
    """(row_id) of the records with a garbled passage."""
    kind = dict(df.dtypes)[row_col]

    def make():
        fix = shared(tuple(samples))
        return lambda c: {"row_id": [i for i, t in zip(c["row_id"], c["txt"]) if fix.garbled(t)]}

    return map_rows(df.select(df[row_col].alias("row_id"), df[text_col].alias("txt")).filter("txt is not null"), make, f"row_id {kind}", pa.schema([("row_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string())]))
