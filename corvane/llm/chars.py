"""Character knowledge shared by the operators: look-alikes, blanks, invisible characters, alphabets."""

from __future__ import annotations

import re
import unicodedata

# Cyrillic letters and the Latin letters of the same shape.
CYRILLIC_LIKE = "АВЕКМНОРСТУХІЅЈҺԚԜаеорсухіѕјһԛԝӏ"
LATIN_LIKE = "ABEKMHOPCTYXISJhQWaeopcyxisjhqwl"
# Further pairs that only occur next to letters of the other alphabet.
CYR_TO_LAT = {c: l for c, l in zip(CYRILLIC_LIKE, LATIN_LIKE) if c not in "Һӏ"}
LAT_TO_CYR = {l: c for c, l in CYR_TO_LAT.items() if c not in "ІЅЈҺԚԜіѕјһԛԝ"}
SPACES = [0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]


def is_invisible(cp: int) -> bool:
    """Format characters, variation selectors and controls that leave no mark (not tab or line feed)."""
    if cp in (9, 10):
        return False
    kind = unicodedata.category(chr(cp))
    return kind == "Cf" or kind == "Cc" and cp not in (11, 12, 0x85) or 0xFE00 <= cp <= 0xFE0F or cp in (0x034F, 0x115F, 0x1160, 0x3164, 0xFFA0)


def _build() -> dict[int, int | None]:
    t: dict[int, int | None] = {}
    for cp in [*range(0x300, 0x10000), *range(0x00, 0x300), *range(0xE0000, 0xE0200)]:
        if 0xD800 <= cp < 0xE000:
            continue
        if is_invisible(cp):
            t[cp] = None
    for cp in range(0xFF01, 0xFF5F):
        t[cp] = cp - 0xFEE0
    t |= dict.fromkeys(SPACES, 0x20)
    return t


#: Removes what cannot be seen, turns full-width forms and blanks into the ordinary ones. Scripts stay.
PLAIN = _build()
#: After canonical decomposition: additionally every Cyrillic look-alike becomes its Latin twin.
SKELETON = PLAIN | {ord(c): ord(l) for c, l in CYR_TO_LAT.items()}
#: Full-width Latin look-alikes go through PLAIN first, so one pass over SKELETON is enough.

ODD = re.compile(r"[^\x09\x0a\x20-\x7eЀ-ӿ‘’“”«»–—№°±…]")
_CYR = re.compile(r"[Ѐ-ӿ]")
_LAT = re.compile(r"[A-Za-z]")
AMBIGUOUS = set(CYR_TO_LAT) | set(LAT_TO_CYR)
_PURE_CYR = re.compile("[" + "".join(c for c in map(chr, range(0x400, 0x500)) if c.isalpha() and c not in CYR_TO_LAT) + "]")
_PURE_LAT = re.compile("[" + "".join(c for c in map(chr, [*range(65, 91), *range(97, 123)]) if c not in LAT_TO_CYR) + "]")
_TO_CYR = {ord(l): ord(c) for l, c in LAT_TO_CYR.items()}
_TO_LAT = {ord(c): ord(l) for c, l in CYR_TO_LAT.items()}
_MIXED = re.compile(r"[A-Za-z][Ѐ-ӿ]|[Ѐ-ӿ][A-Za-z]")
_LETTERS = re.compile(r"[^\W\d_]+")


def one_script(token: str, cyrillic: bool = True) -> str:
    """A token whose look-alikes all belong to one alphabet: that of its other letters, or the one given."""
    c, l = _PURE_CYR.search(token), _PURE_LAT.search(token)
    if c and not l:
        return token.translate(_TO_CYR)
    if l and not c:
        return token.translate(_TO_LAT)
    if c and l:
        return token
    return token.translate(_TO_CYR if cyrillic else _TO_LAT)


_PLAIN_OF = {chr(k): "" if v is None else chr(v) for k, v in PLAIN.items()}


def plain_text(text: str) -> str:
    """Ordinary width, ordinary blanks, composed accents, nothing invisible. Alphabets stay."""
    if ODD.search(text):
        text = unicodedata.normalize("NFC", ODD.sub(lambda m: _PLAIN_OF.get(m[0], m[0]), text))
    return text


def readable(text: str) -> str:
    """Plain forms, composed accents, and one alphabet in every run of letters that mixes two."""
    text = plain_text(text)
    if _MIXED.search(text):
        text = _LETTERS.sub(lambda m: one_script(m[0], len(_CYR.findall(m[0])) >= len(_LAT.findall(m[0]))) if _CYR.search(m[0]) and _LAT.search(m[0]) else m[0], text)
    return text
