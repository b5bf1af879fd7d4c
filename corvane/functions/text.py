"""Text expressions: cleaning, marker languages, quality flags, codes, ratios. All run in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R

BLANK = r"[\s\x{1c}-\x{1f}]"


def missing_as_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def filled(c: Column) -> Column:
    """The text, or null where it is null or empty."""
    return F.when(c != "", c)


def strip(c: Column) -> Column:
    """Without Unicode blanks and separators at both ends."""
    return F.regexp_replace(c, rf"(?U)\A{BLANK}+|{BLANK}+\z", "")


def one_space(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U){BLANK}+", " ")


def any_of(c: Column, words: Iterable[str]) -> Column:
    """Whether the text holds any of the words."""
    return c.rlike("|".join(re.escape(w) for w in words))


def how_many(c: Column, words: Iterable[str]) -> Column:
    """How many of the words the text holds, each counted once."""
    out = F.lit(0)
    for w in words:
        out = out + c.contains(w).cast("int")
    return out


def stable_id(c: Column, prefix: str) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.md5(c.cast("binary")), 1, 12))


# What cleaning replaces, in turn.
_CLEANING = (
    (r"(?iuU)Ошибка!" + BLANK + r"*Закладка" + BLANK + r"*не" + BLANK + r"*опред[^\n]*", " "),
    (r"(?iuU)Error!" + BLANK + r"*Bookmark" + BLANK + r"*not" + BLANK + r"*defined[^\n]*", " "),
    (r"\r\n?", "\n"),
    (r"[ \t]+", " "),
    (r"\n[ \t]+", "\n"),
    (r"\n{4,}", "\n\n\n"),
)


def clean(c: Column) -> Column:
    """Cleaned text; null becomes empty."""
    out = F.translate(missing_as_empty(c), "\x00\u200b\ufeff", " ")
    for pattern, to in _CLEANING:
        out = F.regexp_replace(out, pattern, to)
    return strip(out)


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c) with c evaluated once however often use reads it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def _language(s: Column) -> Column:
    lat, ru, cyr = how_many(s, R.TEXT_UZ_LAT), how_many(s, R.TEXT_RU), how_many(s, R.TEXT_UZ_CYR)
    own = F.regexp_count(s, F.lit("[қўғҳ]"))
    return (
        F.when(F.length(s) < R.LANGUAGE_LEAST, "unknown")
        .when(lat >= 2, "uz_lat")
        .when((own >= R.UZ_CYR_LETTERS) | (cyr >= 2), "uz_cyr")
        .when(F.regexp_count(s, F.lit("[а-яёқўғҳ]")) > F.regexp_count(s, F.lit("[a-z]")), F.when(ru >= cyr, "ru").otherwise("uz_cyr"))
        .when(lat >= 1, "uz_lat")
        .otherwise("unknown")
    )


def language_by_markers(text: Column) -> Column:
    """Language of a text by its marker words and letters; text may be uncleaned."""
    return let(F.lower(clean(F.substring(missing_as_empty(text), 1, R.LANGUAGE_SAMPLE))), _language)


LETTER = "[A-Za-zА-Яа-яЁёҚқЎўҒғҲҳ]"
RATIOS = {"letter_ratio": LETTER, "digit_ratio": r"(?U)\d", "cyrillic_ratio": "[А-Яа-яЁёҚқЎўҒғҲҳ]", "latin_ratio": "[A-Za-z]"}


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def ratio(text: Column, pattern: str) -> Column:
    """Share of the characters that match, to four places, halves up; 0 for an empty text. Rounded in whole numbers, so that every
    engine has the same last digit."""
    n = F.length(text)
    return F.when(n > 0, F.floor((count_of(text, pattern).cast("bigint") * 20_000 + n) / (2 * n)) / 10_000).otherwise(F.lit(0.0))


def compact(*flags: Column) -> Column:
    return F.array_compact(F.array(*flags))


def quality_flags(text: Column, language: Column) -> Column:
    """Flags of a cleaned text in their order."""
    n = F.length(missing_as_empty(text))
    return compact(
        F.when(n == 0, "empty_text").when(n < R.LOW_CHARS, "low_char_count"),
        F.when(language == "unknown", F.lit("unknown_detected_language")),
        F.when(count_of(missing_as_empty(text), "�") > R.REPLACEMENTS, F.lit("encoding_replacement_chars")),
        F.when((n > R.LOW_CHARS) & (count_of(missing_as_empty(text), LETTER) / n < R.LETTER_RATIO), F.lit("low_letter_ratio")),
    )


def codes(text: Column) -> Column:
    """Classification codes in upper case, each once, in order."""
    found = F.regexp_extract_all(missing_as_empty(text), F.lit(r"(?iuU)\b[A-ZА-Я]\d{2}(?:\.\d{1,2})?\b"), F.lit(0))
    return F.array_distinct(F.transform(found, F.upper))


def has_code_marker(text: Column) -> Column:
    return any_of(F.lower(missing_as_empty(text)), R.CODE_MARKERS)


# Signs of a bad text.
BAD_PATTERNS = ("�{3,}", r"([^\n])\1{20,}", r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}]")


def bad_patterns(text: Column) -> Column:
    out = F.lit(0)
    for p in BAD_PATTERNS:
        out = out + count_of(missing_as_empty(text), p)
    return out


def text_hash(text: Column) -> Column:
    """Digest of a text regardless of case and blanks, over its first characters."""
    return F.md5(F.substring(one_space(F.lower(clean(text))), 1, R.HASH_CHARS).cast("binary"))
