"""Problem 1: repair of text from scanned pages.

Pages' edges are found by fuzzy repetition of lines: the document's title, a mask of the corpus's running headers, lines beside
page breaks that are alike on several pages, and page numbers that follow each other. Words divided at line ends are joined by the rules of a corpus vocabulary, and words
with misread characters are corrected to vocabulary words that common confusions lead to.

The vocabulary and the header masks are counted over all distinct texts (copies are left out by digest, with one shuffle of
the texts; then partial counts in each partition, one shuffle of counts). Words need a fixed number of texts, and so do header masks, at
every size, so that rare words and small series are known in large tables too. Both tables grow with the corpus. While they are small, by
a checked size, they are broadcast; beyond it records are dealt into blocks, the words that a block's records may ask for are joined
with the vocabulary by shuffle, and each block is repaired with its own part of it, with the same result (see repair_in_blocks).

Defined results: null, empty and blank texts, and records whose paragraphs are not wrapped into short lines, have no defects and stay
as they are. A title in its own place, headings and numbers of the text are kept. Repeated rows are judged one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Memo, durable, map_rows

WORD = re.compile(r"[^\W\d_]+(?:[‘’'][^\W\d_]+)*(?:-[^\W\d_]+(?:[‘’'][^\W\d_]+)*)*")
HYPHENS = "-¬\xad‐‑–"
END_WORD = re.compile(rf"(?:.*[^\w‘’'])?([^\W\d_]+(?:[‘’'][^\W\d_]+)*[‘’']?)([{HYPHENS}]?)\Z")
TAIL = re.compile(rf"[{HYPHENS}]\s*\Z")
START_WORD = re.compile(r"[^\W\d_]+(?:[‘’'][^\W\d_]+)*")
CLOSING = frozenset(".!?;:)»”…")
LOWER = re.compile(r"[a-zа-яёўқғҳ‘’]")
MISREAD_HALF = "а1а"  # stands for a half whose misread character shows in the whole word only
WIDEST = 100  # characters of a scanned line; paragraphs that are not wrapped are longer
MOST_WORDS, MOST_HEADS = 1_000_000, 20_000  # of a broadcast: some 60 MB of texts and counts
BLOCK_ROWS = 2_000

# Signs that a page's characters are misread as fall into one class with them, by alphabet. Sequences are
# replaced before single signs in the Cyrillic table and after them in the Latin one.
CYRILLIC_CLASSES = "и u н п л n й|с е c e s|т m|г r|ш щ|о 0 o|з 3|в 8|б 6|ч 4|к k қ|а a|р p|х x|у y"
CYRILLIC_RUNS = (("lll", "ш"), ("ll1", "ш"), ("llı", "ш"), ("ьi", "ы"), ("ьl", "ы"), ("ь1", "ы"), ("u,", "ц"), ("к,", "қ"), ("у'", "ў"), ("io", "ю"), ("ii", "н"))
LATIN_CLASSES = "il1|í,ec,tf,hbu,o0,s5,gq9,z2"
LATIN_RUNS = (("rn", "m"), ("ri", "n"), ("ei", "d"), ("ii", "h"))
_CYR_CLASS = str.maketrans({x: c.split()[0] for c in CYRILLIC_CLASSES.split("|") for x in c.split()})
_LAT_CLASS = str.maketrans({x: c[0] for c in LATIN_CLASSES.split(",") for x in c})
_HAS_CYR = re.compile("[Ѐ-ӿ]")


def fold(word: str) -> str:
    """The class of a word in lower case: words that common misreadings turn into each other have one."""
    if _HAS_CYR.search(word):
        for run, to in CYRILLIC_RUNS:
            if run in word:
                word = word.replace(run, to)
        return word.translate(_CYR_CLASS)
    word = word.translate(_LAT_CLASS)
    for run, to in LATIN_RUNS:
        if run in word:
            word = word.replace(run, to)
    return word


DIGITS = str.maketrans("lIiі|!OoОоQSsВBЗзбZ", "1111110000055883362")
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500}
STRAY = re.compile(r"(?<=[^\W_])[|~*`^_¦\\]+(?=[^\W_])|(?<=[^\W_]{2})[|~`^_¦\\]+(?=\W|\Z)|(?<!\S)[|~`^_¦\\]+(?=[^\W_]{2})")
CODE = re.compile(r"[A-ZА-Я]\d{1,2}(?:[.,]\d{1,2})?\Z|[A-ZА-Я]{1,3}-?\d+(?:/\d+)?\Z|\d+(?:-[а-яёўқғҳa-z‘’]{1,4})\Z|\d+[.,/:x×-]?\d*(?:[.,/:-]\d+)*\Z|[^\W\d_]+-\d+\Z")
MIXED_DIGIT = re.compile(r"[^\W\d_]\d|\d[^\W\d_]")
MIXED_SCRIPT = re.compile(r"[A-Za-z][Ѐ-ӿ]|[Ѐ-ӿ][A-Za-z]")
GLUED = re.compile(r"([^\W\d_]{3,})\d+(?:[.,]\d+)?\Z")  # a full cell that touches the number of the next
LETTERS = re.compile(r"[^\W\d_]+(?:[‘’'][^\W\d_]*)*\Z")
TOKENS = re.compile(r"[^\s«»“”()\[\],;!?…]+")
ITEM = re.compile(r"\s*(?:[-–—•*·]|\(?\d{1,3}[.)])\s")


def closed(line: str) -> bool:
    """Whether a line ends with a mark that closes a sentence or an entry."""
    return line.rstrip()[-1:] in CLOSING


def is_wrapped(lines: list[str]) -> bool:
    """Whether paragraphs were cut into the lines of a page: lines most of whose characters are in short ones, of which some go on in lower case."""
    texts = [x for x in lines if x.strip()]
    if 2 * sum(len(x) for x in texts if len(x) > WIDEST and "|" not in x and "\t" not in x) > sum(map(len, texts)):
        return False
    return any(len(a) > 24 and LOWER.match(b.lstrip()) and not closed(a) and not ITEM.match(a) for a, b in zip(texts, texts[1:])) or len(_numbers(lines)) > 1


def roman(s: str) -> int | None:
    if not s or any(c not in ROMAN for c in s):
        return None
    v = [ROMAN[c] for c in s]
    total = sum(-a if a < b else a for a, b in zip(v, [*v[1:], 0]))
    return total if 0 < total < 400 else None


_DIGIT = r"[\dlIiі|!OoОоQSsВBЗзбZ]"
_NUM = rf"(?P<n>\d{_DIGIT}{{0,4}}|{_DIGIT}{{1,3}}\d{_DIGIT}{{0,3}}|[lI]{{1,2}}|[ivxlcd]{{1,8}})"
_OF = rf"(?:\s*(?:/|из|of|dan|дан|u3|uз)\s*{_DIGIT}{{1,5}})?"
# Forms of page numbers; words may have a misread character, so any word of about their length passes the form and is compared.
_FORMS = [
    (re.compile(rf"[~*=\[(–—-]+\s*{_NUM}\s*[~*=\])–—-]+\Z"), None),
    (re.compile(rf"{_NUM}\s*/\s*{_DIGIT}{{1,5}}\Z"), None),
    (re.compile(rf"(?P<w>[^\W\d_]\S{{2,8}}?)\.?\s+№?\s*{_NUM}{_OF}\Z"), ("стр", "страница", "page", "sahifa", "саҳифа", "bet", "бет")),
    (re.compile(rf"{_NUM}\s*[-–]\s*(?P<w>\S{{3,6}})\Z"), ("бет", "bet")),
]
_BARE = re.compile(rf"{_NUM}\Z")


def alike(a: str, b: str, least: float = 0.8) -> bool:
    if a == b:
        return True
    if min(len(a), len(b)) < least * max(len(a), len(b)) - 1:
        return False
    m = SequenceMatcher(None, a, b, autojunk=False)
    return m.quick_ratio() >= least and m.ratio() >= least


def pairs_admit(a: str, b: str, least: float) -> bool:
    """Whether the letter pairs of two lines admit that alike() holds: a sign without a match takes at most two pairs with it."""
    most = (1 - least / 2) * (len(a) + len(b))
    lost = most + len(a) - least * (len(a) + len(b)) / 2
    return len({*zip(a, a[1:])} - {*zip(b, b[1:])}) <= lost


def page_number(s: str) -> tuple[int | None, bool] | None:
    """(value, explicit) of a line that has the form of a page number; None for other lines."""
    if len(s) > 26:
        return None
    for form, words in _FORMS:
        m = form.match(s)
        if m and (not words or any(alike(m["w"].lower().rstrip("."), w, 0.62) for w in words)):
            return _value(m["n"]), True
    m = _BARE.match(s)
    return (_value(m["n"]), False) if m else None


def _value(n: str) -> int | None:
    if not any(map(str.isdigit, n)) and (v := roman(n)) is not None:
        return v
    t = n.translate(DIGITS)
    return int(t) if t.isdigit() else None


def _numbers(lines: list[str]) -> list[int]:
    """Places of the lines with an explicit page number."""
    return [k for k, x in enumerate(lines) if len(x) < 30 and (p := page_number(x.strip())) and p[1]]


def letters(s: str) -> str:
    return re.sub(r"[\W_]+", " ", s.lower()).strip()


def mask(s: str) -> str:
    return re.sub(rf"\d{_DIGIT}*", "#", re.sub(r"\s+", " ", s.strip().lower()))


DIGIT_LIKE = re.compile(r"\d|[lIO]/|/[lIO]")
NOISY_ROMAN = re.compile(r"[ivxlcd1IlVX|`'*~^_]{2,12}\Z")


def number_is_roman(line: str) -> bool:
    return not any(map(str.isdigit, line)) and sum(c in ROMAN for c in line.strip()) > 0


def head_and_number(s: str) -> tuple[str, tuple[int | None, bool] | None]:
    """A line's header part and its page number, where two or more blanks divide them."""
    p = page_number(s)
    if p:
        return "", p
    if "   " not in s and "\t" not in s:
        return s, None
    parts = re.split(r"\s{2,}", s)
    if len(parts) == 2:
        for number, head in (parts, parts[::-1]):
            p = page_number(number)
            if p:
                return head, p
    return s, None


class Model:
    """The corpus's words with their counts, and its header masks."""

    def __init__(self, words: dict[str, int], heads: list[str]):
        best: dict[str, str] = {}
        for w in sorted(words, key=lambda w: (-words[w], w)):
            best.setdefault(fold(w), w)
        self.know(words, best, max(words.values(), default=0), frozenset(w.split("-")[0] for w in words if "-" in w))
        self.heads = heads
        self.plain_heads = frozenset(h for h in heads if "#" not in h)
        self.by_length: dict[int, list[str]] = {}
        for h in heads:
            self.by_length.setdefault(len(h), []).append(h)
        self.known_head = Memo(self.is_head, 50_000)

    def know(self, words: dict[str, int], best: dict[str, str], top: int, firsts: frozenset[str]) -> None:
        """Takes a vocabulary: words with counts, the most frequent word of each class, the top count, first halves of words with hyphens."""
        self.words, self.by_class, self.firsts = words, best, firsts
        self.common = frozenset(w for w, n in words.items() if 30 * n > top)
        self.usual = frozenset(w for w, n in words.items() if 2_000 * n >= top)  # what is rarer may be a half or a misread word itself
        self.fixed, self.bad = Memo(self.correct), Memo(self.bad_word)

    def is_head(self, form: str) -> bool:
        """Whether a form is like a header mask; only masks of a length that alike() admits are compared."""
        if "#" not in form and not self.plain_heads:
            return False
        n = len(form)
        near = self.by_length.get(n, ())
        return form in near or any(alike(form, h, 0.84) for k, hs in self.by_length.items() if min(n, k) >= 0.84 * max(n, k) - 1 for h in hs if "#" in form or h in self.plain_heads)

    def correct(self, word: str) -> str | None:
        """The vocabulary word that the usual confusions lead to, if it is far more frequent than the word itself."""
        found = self.by_class.get(fold(word))
        if found is None or found == word or self.words[found] < max(8, 30 * self.words.get(word, 0)):
            return None
        return found

    def running(self, lines: list[str]) -> set[int]:
        """Places of the lines that are nothing but headers, footers or page numbers."""
        texts = [(k, x.strip()) for k, x in enumerate(lines) if x.strip()]
        out: set[int] = set()
        heads, numbers, title = {}, [], None
        own: dict[int, tuple] = {}
        for n, (k, s) in enumerate(texts):
            head, number = head_and_number(s)
            if head and number:
                own[k] = (n, head, number)
            if head and len(head) <= 50 and DIGIT_LIKE.search(head) and head[-1] not in CLOSING and "#" in (form := mask(head)) and self.known_head[form]:
                heads[k] = True
            elif head and title is None and not number:
                title = [letters(s)]
                if n + 1 < len(texts):
                    title.append(letters(f"{s} {texts[n + 1][1]}"))
                continue
            elif head and self.plain_heads and len(head) <= 60 and head[-1] not in CLOSING and "#" not in (form := mask(head)) and self.known_head[form]:
                heads[k] = True
            elif head and title and head[-1] not in ".;,:" and any(0.8 * len(t) - 2 <= len(head) <= 1.25 * len(t) + 4 for t in title) and any(alike(letters(head), t, 0.82) for t in title):
                heads[k] = True
            if number and (not head or k in heads):
                numbers.append((n, k, *number))
        chain = self.sequence(numbers)
        found = self.repeated_edges(texts, {k for _, k, _, explicit in numbers if explicit or k in chain} | set(heads), {k: head for k, (_, head, _) in own.items()})
        if found:
            heads |= dict.fromkeys(found, True)
            numbers = sorted({*numbers, *((own[k][0], k, *own[k][2]) for k in found if k in own)}, key=lambda x: x[:2])
            chain = self.sequence(numbers)
        out |= set(heads)
        last = texts[-1][0] if texts else -1
        around = {texts[n + d][0] for n, (k, _) in enumerate(texts) if k in heads for d in (-1, 1) if 0 <= n + d < len(texts)}
        romans = sum(number_is_roman(lines[k]) for _, k, _, _ in numbers if k in chain)
        if romans > 1 and 2 * romans > len(chain):  # a misread number among roman ones has no value of its place
            chain |= {k for k, s in texts if len(s) <= 12 and min(chain) < k < max(chain) and NOISY_ROMAN.match(s) and sum(c in ROMAN for c in s) > 1}
            out |= {k for k in chain if NOISY_ROMAN.match(lines[k].strip())}
        for n, k, value, explicit in numbers:
            if explicit or k in chain or not chain and k == last or k in around and (k in chain or not chain and k > texts[0][0]):
                out.add(k)
        return out

    @staticmethod
    def repeated_edges(texts: list[tuple[int, str]], breaks: set[int], own: dict[int, str], least: float = 0.88) -> set[int]:
        """Places of the lines beside page breaks, or with a page number of their own, that are alike on pages which follow each
        other (or every other page), on one side of the break, with or without digits. Lines found are edges too, so headers of
        several lines are found one by one. The first line is the title's own place; lines that go on in lower case need three
        pages; a line that is more often found inside the pages than at their edges belongs to the text."""
        found: set[int] = set()
        if not breaks and len(own) < 2:
            return found
        same = lambda a, b: a == b or min(len(a), len(b)) >= least * max(len(a), len(b)) - 1 and pairs_admit(a, b, least) and alike(a, b, least)
        while True:
            edge, page, near, gap = breaks | found, 0, {}, True
            for n, (k, s) in enumerate(texts):
                if k in edge or k in own:  # lines beside each other are one break
                    page, gap = page + gap, False
                else:
                    gap = True
                if not n or k in edge:
                    continue
                side = "own" if k in own else "above" if texts[n - 1][0] in edge else "below" if n + 1 < len(texts) and texts[n + 1][0] in edge or edge and n + 1 == len(texts) else ""
                head = own.get(k, s)
                if side and 4 < len(head) <= 60 and not closed(head) and not ITEM.match(head) and sum(map(str.isalpha, form := mask(head))) > 3:
                    near[k] = page + (side == "below"), "" if side == "own" else side, form
            new, low = set(), {k for k, s in texts if LOWER.match(s)}
            for k, (at, side, form) in near.items():
                mates = [p for j, (p, d, f) in near.items() if j != k and d == side and p != at and same(form, f)]
                if len(mates) > (k in low) and min(abs(p - at) for p in mates) <= 2:
                    inside = sum(same(form, mask(s)) for j, s in texts if j not in near and j not in edge)
                    if len(mates) + 1 >= 0.4 * (len(mates) + 1 + inside):
                        new.add(k)
            if not new:
                return found
            found |= new

    @staticmethod
    def sequence(numbers: list[tuple]) -> set[int]:
        """Places of the longest row of numbers in which each equals the one before or follows it."""
        best: dict[int, tuple[int, int]] = {}
        for i, (_, _, v, _) in enumerate(numbers):
            best[i] = (1, -1)
            for j in range(max(0, i - 12), i):
                w = numbers[j][2]
                if v is not None and w is not None and 0 <= v - w <= 3 and best[j][0] + 1 > best[i][0]:
                    best[i] = (best[j][0] + 1, j)
        if not best:
            return set()
        end = max(best, key=lambda i: (best[i][0], i))
        if best[end][0] < 2:
            return set()
        out = set()
        while end >= 0:
            out.add(numbers[end][1])
            end = best[end][1]
        return out

    def broken(self, a: str, hyphen: str, b: str) -> bool:
        """Whether a word goes on from the end of a line to the opening of the next."""
        words, low, rest = self.words, a.lower(), b.lower()
        whole, dashed = low + rest, f"{low}-{rest}"
        if not hyphen:
            return words.get(whole, 0) >= 8 and words[whole] > 30 * min(words.get(low, 0), words.get(rest, 0)) and words[whole] > 3 * max(words.get(rest, 0), 0 if len(low) < 4 else words.get(low, 0))
        if words.get(dashed, 0) > words.get(whole, 0):
            return False
        if whole in words:
            return True
        if b[0].isupper() or any(d.startswith(low + "-") and words.get(rest, 0) > 0 for d in (dashed,) if low in self.firsts) or (low in self.usual and rest in self.usual and hyphen == "-" and len(low) > 3 and len(rest) > 3):
            return False
        return True

    def bad_word(self, token: str) -> bool:
        """Whether a token between blanks has a misread or stray character."""
        t = token.strip(".:'‘’\"%°±<>=+–—-")
        if len(t) < 2 or t.isdigit():
            return False
        if STRAY.search(token):
            return True
        if MIXED_SCRIPT.search(t):
            return True
        if MIXED_DIGIT.search(t) and not CODE.match(t) and not ((m := GLUED.match(t)) and m[1].lower() in self.words):
            return True
        for w in t.lower().split("-"):
            if len(w) > 3 and w not in self.common and LETTERS.match(w) and self.fixed[w] is not None:
                return True
        return False

    def defects(self, text: str) -> tuple[list[tuple[int, str]], str]:
        """((line number, defect) ..., repaired text)."""
        lines = text.split("\n")
        if not is_wrapped(lines):
            return [], text
        out = self.running(lines)
        found = [(k + 1, "running_line") for k in out]
        body = [k for k, x in enumerate(lines) if k not in out and x.strip()]
        bad, cut = self.bad, {}
        for n, k in enumerate(body):
            line = lines[k]
            m = END_WORD.match(line.rstrip().rpartition(" ")[2])
            if m and n + 1 < len(body):
                after = lines[body[n + 1]].lstrip()
                s = START_WORD.match(after)
                if s and self.broken(m[1], m[2], s[0]):
                    cut[k] = (m[1], s[0])
                    found.append((k + 1, "broken_word"))
        opened = {body[n + 1]: cut[k] for n, k in enumerate(body) if k in cut}
        for k in body:
            words = TOKENS.findall(TAIL.sub("", lines[k]) if k in cut else lines[k])
            if k in cut and words:  # the halves are judged as one word
                whole = "".join(cut[k]).lower()
                words[-1] = words[-1] if STRAY.search(words[-1]) or MIXED_SCRIPT.search(words[-1]) else ""
                if whole not in self.words and (fix := self.fixed[whole]):
                    at = next((i for i, (x, y) in enumerate(zip(whole, fix)) if x != y), len(whole))
                    if at < len(cut[k][0]):
                        words.append(MISREAD_HALF)
            if k in opened and words:
                words[0] = words[0] if STRAY.search(words[0]) or MIXED_SCRIPT.search(words[0]) or MIXED_DIGIT.search(words[0]) else ""
                whole = "".join(opened[k]).lower()
                if whole not in self.words and (fix := self.fixed[whole]):
                    at = next((i for i, (x, y) in enumerate(zip(whole, fix)) if x != y), len(whole))
                    if at >= len(opened[k][0]):
                        words.append(MISREAD_HALF)
            if any(bad[w] for w in words if w):
                found.append((k + 1, "bad_chars"))
        return sorted(found), self.join(lines, body, cut, {n for n, d in found if d == "bad_chars"})

    def join(self, lines: list[str], body: list[int], cut: dict, bad: set[int]) -> str:
        """Continuous paragraphs: running lines left out, divided words joined, misread words corrected."""
        paragraphs: list[str] = []
        last = None
        for k in body:
            line = lines[k].strip()
            blank = last is not None and any(not lines[j].strip() for j in range(last + 1, k))
            goes_on = last is not None and (last in cut or not closed(lines[last]) and LOWER.match(line) and not ITEM.match(line))
            if goes_on:
                before = paragraphs[-1]
                if last in cut:
                    paragraphs[-1] = TAIL.sub("", before) + line
                else:  # a hyphen that the word keeps needs no blank
                    paragraphs[-1] = before + line if TAIL.search(before) and before[-2:-1].isalnum() else f"{before} {line}"
            elif last is not None and not blank and closed(lines[last]) and len(lines[last]) > 24 and not ITEM.match(line) and len(line) > 24:
                paragraphs[-1] += " " + line
            else:
                paragraphs.append(line)
            last = k
        if not bad:
            return "\n\n".join(paragraphs)
        return "\n\n".join(TOKENS.sub(lambda m: self.mend(m[0]), p) for p in paragraphs)

    def mend(self, token: str) -> str:
        if not self.bad[token]:
            return token
        clean = STRAY.sub("", token)
        core = clean.strip(".:'‘’\"%°±<>=+–—-")
        if core.lower() in self.words or core.isdigit():
            return clean
        if sum(map(str.isdigit, core)) * 2 > len(core) and (t := core.translate(DIGITS)).replace(",", "").replace(".", "").isdigit():
            return clean.replace(core, t)
        fix = self.correct(core.lower())
        if not fix:
            return clean
        return clean.replace(core, fix.upper() if core.isupper() and len(core) > 3 else fix[:1].upper() + fix[1:] if core[:1].isupper() else fix)


def count_corpus(df: DataFrame, text_col: str = "raw_text", flush: int = 300_000) -> DataFrame:
    """(kind, key, n): rows with each word ('w'; the first and last of a line are left out), with each mask of a short line
    ('l'), and with each such line beside a page number ('h'). Counted within partitions before the shuffle."""

    def run(batches):
        counts: Counter = Counter()

        def out():
            keys = list(counts)
            for s in range(0, len(keys), 50_000):
                part = keys[s : s + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part]), pa.array([w for _, w in part]), pa.array([counts[k] for k in part], pa.int64())], ["kind", "key", "n"])
            counts.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                lines = text.split("\n")
                seen: set[tuple[str, str]] = set()
                if is_wrapped(lines):
                    for x in lines:
                        seen.update(("w", w) for w in WORD.findall(x.lower())[1:-1])
                    texts = [x.strip() for x in lines if x.strip()]
                    titles = [letters(" ".join(texts[:n])) for n in (1, 2)]  # a title may be a running line in its own record only
                    number = [page_number(x) if len(x) <= 26 else None for x in texts]
                    for k, x in enumerate(texts):
                        if 4 < len(x) <= 60 and not number[k] and not closed(x):
                            head, own = head_and_number(x)
                            m = mask(head)
                            seen.add(("l", m))
                            if (own or k and number[k - 1] or k + 1 < len(texts) and number[k + 1]) and ("#" in m or k and not any(alike(letters(head), t, 0.82) for t in titles)):
                                seen.add(("h", m))
                else:
                    seen.update(("w", w) for w in WORD.findall(text.lower()))
                counts.update(seen)
            if len(counts) > flush:
                yield from out()
        yield from out()

    src = df.select(df[text_col].alias("txt")).filter(F.trim("txt") != "")
    return src.mapInArrow(run, "kind string, key string, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def distinct_texts(df: DataFrame, text_col: str = "raw_text", most: int = 500_000) -> DataFrame:
    """(raw_text): each text that is not blank once. Digests are counted first, and only texts whose digest occurs twice are aggregated, within
    partitions before the shuffle, so that copies of one text meet in no single task and other texts stay where they are. The digests
    that occur twice are broadcast while there are at most `most` (16 bytes each); beyond it they are joined by shuffle."""
    keyed = df.select(df[text_col].alias("raw_text")).filter(F.trim("raw_text") != "").withColumn("digest", F.unhex(F.md5(F.col("raw_text").cast("binary"))))
    several = durable(keyed.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"))
    side = F.broadcast(several) if several.limit(most + 1).count() <= most else several
    once = keyed.join(side, "digest", "left_anti").select("raw_text")
    return once.unionByName(keyed.join(side, "digest", "left_semi").groupBy("digest").agg(F.first("raw_text").alias("raw_text")).select("raw_text"))


def corpus_counts(df: DataFrame, text_col: str = "raw_text", least: int = 3, least_heads: int = 5) -> DataFrame:
    """(kind, key, n) of count_corpus over the distinct texts: words of `least` texts or more, masks of `least_heads` or more. A written table."""
    return durable(count_corpus(distinct_texts(df, text_col)).filter((F.col("kind") == "w") & (F.col("n") >= least) | (F.col("kind") != "w") & (F.col("n") >= least_heads)))


def head_masks(counted: DataFrame) -> DataFrame:
    """(key): the header masks, short lines that stand beside page numbers in most of the texts that have them."""
    beside, lines = counted.filter("kind = 'h'").select("key", "n"), counted.filter("kind = 'l'").select("key", F.col("n").alias("all_n"))
    signs = F.length(F.regexp_replace("key", r"[^\p{L}]", ""))
    rows = beside.join(lines, "key", "left").filter(F.col("n") >= 0.4 * F.coalesce("all_n", "n"))
    return rows.filter(signs > F.when(F.col("key").contains("#"), 1).otherwise(3)).select("key")


def fit(df: DataFrame, text_col: str = "raw_text", least: int = 3, least_heads: int = 5, most_words: int = MOST_WORDS, most_heads: int = MOST_HEADS) -> Model | DataFrame:
    """The vocabulary and the header masks: a Model where both are small enough to be broadcast, else the table of counts, which
    repair() looks up in blocks. Copies of one text count once."""
    counted = corpus_counts(df, text_col, least, least_heads)
    heads = durable(head_masks(counted))
    words = counted.filter("kind = 'w'")
    if words.limit(most_words + 1).count() > most_words or heads.limit(most_heads + 1).count() > most_heads:
        return words.select("kind", "key", "n").unionByName(heads.select(F.lit("h").alias("kind"), "key", F.lit(0).cast("bigint").alias("n")))
    return Model({r[0]: r[1] for r in words.select("key", "n").toLocalIterator()}, sorted(r[0] for r in heads.collect()))


def repair(df: DataFrame, model: Model | DataFrame, row_col: str = "row_id", text_col: str = "raw_text") -> DataFrame:
    """(row_id, line_no, defect, text): a row for each defect, and one without line and defect that carries the repaired text."""
    if isinstance(model, DataFrame):
        return repair_in_blocks(df, model, row_col, text_col)
    kind = dict(df.dtypes)[row_col]
    shared = df.sparkSession.sparkContext.broadcast((model.words, model.heads))

    def make():
        m = _model(shared)
        return lambda c: _repaired(m, c["row_id"], c["txt"])

    return map_rows(df.select(df[row_col].alias("row_id"), df[text_col].alias("txt")), make, f"row_id {kind}, line_no int, defect string, text string", _schema(kind))


def _schema(kind: str) -> pa.Schema:
    return pa.schema([("row_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()), ("line_no", pa.int32()), ("defect", pa.string()), ("text", pa.string())])


def _repaired(m: Model, rows: list, texts: list[str | None]) -> dict[str, list]:
    out = []
    for i, t in zip(rows, texts):
        found, fixed = m.defects(t) if t and t.strip() else ([], t)
        out += [(i, n, d, None) for n, d in found]
        out.append((i, None, None, fixed))
    return dict(zip(("row_id", "line_no", "defect", "text"), map(list, zip(*out)))) if out else {n: [] for n in ("row_id", "line_no", "defect", "text")}


def asked(text: str) -> set[tuple[str, str]]:
    """(kind, key) of all that Model may look up for a text: words ('w'), classes ('c'), first halves ('f'), forms of lines ('h')."""
    lines = text.split("\n")
    if not is_wrapped(lines):
        return set()
    words: set[str] = set()
    out: set[tuple[str, str]] = set()
    texts = [x.strip() for x in lines if x.strip()]
    for n, line in enumerate(texts):
        head, _ = head_and_number(line)
        if 0 < len(head) <= 60:
            out.add(("h", mask(head)))
        for token in TOKENS.findall(line):
            for t in (token, STRAY.sub("", token), TAIL.sub("", token)):
                core = t.strip(".:'‘’\"%°±<>=+–—-").lower()
                words.update((core, *core.split("-")))
                if m := GLUED.match(core):
                    words.add(m[1])
        m = END_WORD.match(line.rpartition(" ")[2])
        for after in texts[n + 1 :] if m else ():  # any of the next lines may be left out as a running line, but not a long one
            if s := START_WORD.match(after):
                low, rest = m[1].lower(), s[0].lower()
                words.update((low, rest, low + rest, f"{low}-{rest}"))
                out.add(("f", low))
            if len(after) > WIDEST or len(after) > 62 and "  " not in after and "\t" not in after:
                break
    out.update(("w", w) for w in words)
    out.update(("c", fold(w)) for w in words)
    return out


def lookup_table(counted: DataFrame) -> DataFrame:
    """(kind, key, word, n) of words, classes with their most frequent word, and first halves."""

    def folded() -> Callable:
        return lambda c: {"key": c["key"], "n": c["n"], "cls": [fold(w) for w in c["key"]]}

    words = counted.filter("kind = 'w'")
    classed = map_rows(words.select("key", "n"), folded, "key string, n bigint, cls string", pa.schema([("key", pa.string()), ("n", pa.int64()), ("cls", pa.string())]))
    best = classed.groupBy("cls").agg(F.min(F.struct((-F.col("n")).alias("m"), "key")).alias("b"))
    own = words.select(F.lit("w").alias("kind"), "key", F.col("key").alias("word"), "n")
    first = words.filter(F.col("key").contains("-")).select(F.lit("f").alias("kind"), F.split("key", "-")[0].alias("key"), F.lit("").alias("word"), F.lit(1).cast("bigint").alias("n")).distinct()
    return own.unionByName(best.select(F.lit("c").alias("kind"), F.col("cls").alias("key"), F.col("b.key").alias("word"), (-F.col("b.m")).alias("n"))).unionByName(first)


def known_forms(forms: DataFrame, heads: DataFrame, chunk: int = MOST_HEADS) -> tuple[DataFrame, bool]:
    """(kind 'h', key, word, n) of the distinct forms of lines that are like a header mask, and whether any mask has no number. Masks are a
    stated set that all forms are compared with, in chunks of a bounded size."""
    parts = max(1, -(-heads.count() // chunk))
    plain = not heads.filter(~F.col("key").contains("#")).isEmpty()
    marked = durable(heads.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts))))
    out = None
    for p in range(parts):
        shared = heads.sparkSession.sparkContext.broadcast(sorted(r[0] for r in marked.filter(F.col("part") == p).select("key").collect()))

        def make(shared=shared):
            m = Model({}, shared.value)
            return lambda c: {"key": [k for k in c["key"] if m.known_head[k]]}

        part = map_rows(forms, make, "key string", pa.schema([("key", pa.string())]))
        out = part if out is None else out.union(part)
    return out.distinct().select(F.lit("h").alias("kind"), "key", F.lit("").alias("word"), F.lit(1).cast("bigint").alias("n")), plain


def repair_in_blocks(df: DataFrame, counted: DataFrame, row_col: str = "row_id", text_col: str = "raw_text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """repair() with a vocabulary of any size: what the records of a block may ask for is joined with it by shuffle. Blocks are dealt by a
    hash of the row, so copies of one text meet in no single block."""
    kind = dict(df.dtypes)[row_col]
    blocks = max(1, -(-df.count() // block_rows))
    src = df.select(df[row_col].alias("row_id"), df[text_col].alias("txt")).withColumn("block", F.pmod(F.xxhash64("row_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    src = durable(src)  # the place of a row must not be made anew

    def gather():
        def work(c: dict[str, list]) -> dict[str, list]:
            keys = {(b, *k) for b, t in zip(c["block"], c["txt"]) if t and t.strip() for k in asked(t)}
            return dict(zip(("block", "kind", "key"), map(list, zip(*keys)))) if keys else {"block": [], "kind": [], "key": []}

        return work

    want = durable(map_rows(src.select("block", "txt"), gather, "block int, kind string, key string", pa.schema([("block", pa.int32()), ("kind", pa.string()), ("key", pa.string())])).distinct())
    forms, plain = known_forms(want.filter("kind = 'h'").select("key").distinct(), counted.filter("kind = 'h'").select("key"))
    top = counted.filter("kind = 'w'").agg(F.max("n")).first()[0] or 0
    part = want.join(lookup_table(counted).unionByName(forms), ["kind", "key"]).select("block", "kind", "key", "word", "n")
    arrow = _schema(kind)

    def one(texts: pa.Table, known: pa.Table) -> pa.Table:
        k = known.to_pydict()
        rows = list(zip(k["kind"], k["key"], k["word"], k["n"]))
        m = Model({}, [])
        m.know({w: n for kd, _, w, n in rows if kd in "wc"}, {key: w for kd, key, w, _ in rows if kd == "c"}, top, frozenset(key for kd, key, _, _ in rows if kd == "f"))
        heads = {key for kd, key, _, _ in rows if kd == "h"}
        m.known_head, m.plain_heads = Memo(heads.__contains__, 50_000), frozenset(["-"] if plain else [])
        t = texts.to_pydict()
        return pa.Table.from_pydict(_repaired(m, t["row_id"], t["txt"]), schema=arrow)

    return src.groupBy("block").cogroup(part.groupBy("block")).applyInArrow(one, f"row_id {kind}, line_no int, defect string, text string")


_models: dict[int, tuple[tuple, Model]] = {}  # the value is held, so that no other takes its id


def _model(shared) -> Model:
    """One model a worker and broadcast, so that its caches serve all tasks."""
    key = shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) is not None else id(shared.value)
    if key not in _models:
        _models.clear()
        _models[key] = shared.value, Model(*shared.value)
    return _models[key][1]
