"""Problem 10: unfilled placeholders, filler, error pages and notices that scripts are required.

Texts are read in plain form. Sentences that hold a word of such messages are candidates: numbers, addresses, dates
and ids are masked, both Uzbek alphabets and Russian are folded to one alphabet, words that stand for each other in
such messages are masked too, and exact hashes of the masked messages are grouped across sources with partial aggregation.
Recurrence decides: a message is residue only if its group is in several sources and a phrase rule knows it; rules that
say less need more sources. Every distinct message is classified once. Placeholders and runs of filler words are recognised by form.

Defined results: null, empty and blank texts are no residue; brackets around numbers, comparison signs, code, special
tokens and sentences that speak about such messages are content; a message of a single source is content, and so is one
whose rows have no source. Repeated rows are judged one by one.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import durable, map_rows
from .chars import readable
from .leaks import TO_LATIN

ID = r"[A-Za-zА-Яа-яЁёЎўҚқҒғҲҳ‘’'][\w.‘’']*"
WORDS = rf"{ID}(?: {ID}){{0,4}}"
_CAPS = "[A-ZА-ЯЁЎҚҒҲ]"
# Forms of unfilled slots by the sign they have. Names begin with a letter, so sets of numbers and references are no slots.
PLACEHOLDERS = [
    (mark, re.compile(form))
    for mark, form in (
        ("{{", rf"\{{\{{\s*{WORDS}\s*\}}\}}"),
        ("{%", r"\{%-?\s*\w+[^{}%\n]{0,60}%\}"),
        ("<%", rf"<%=?-?\s*{ID}\s*-?%>"),
        ("${", rf"\$\{{\s*{ID}\s*\}}"),
        ("%(", rf"%\({ID}\)[sdrf]"),
        ("%", rf"%{_CAPS}{{2,}}(?:[_.]{_CAPS}+)*%"),
        ("__", rf"__{_CAPS}{{2,}}(?:[_.]{_CAPS}+)*__"),
        ("#", rf"#{_CAPS}{{3,}}(?:[_.]{_CAPS}+)*#"),
        ("@@", rf"@@{ID}@@"),
        ("[[", rf"\[\[\s*{WORDS}\s*\]\]"),
        ("<<", rf"<<\s*{WORDS}\s*>>"),
        ("{", rf"(?<![\w{{$]){{{ID}}}(?![\w}}])"),
        ("<", rf"<{_CAPS}[A-ZА-ЯЁЎҚҒҲ‘’']+(?:[ _][A-ZА-ЯЁЎҚҒҲ‘’']{{2,}}){{0,4}}>"),
        ("[", r"\[(?i:вставить|заполнить|указать|введите|вставьте|укажите|заполните|insert|enter|fill in|specify|add|your) [^\[\]\n]{2,60}\]"),
        ("[", r"\[[^\[\]\n]{2,60} (?i:киритинг|кўрсатинг|тўлдиринг|ёзинг|қўйинг|kiriting|ko[‘’']rsating|to[‘’']ldiring|yozing|qo[‘’']ying|here)\]"),
        ("[", r"\[(?i:фио|ф\. ?и\. ?о\.|имя|название|наименование|дата|номер|адрес|подпись|должность|телефон|name|date|number|address|title|phone|исми?|номи|сана|манзил|имзо|ismi?|nomi|sana|manzil|imzo)(?: [^\W\d_]+){0,3}\]"),
        *((x, rf"\b{re.escape(x)}\b") for x in ("ДД.ММ.ГГГГ", "DD.MM.YYYY", "MM/DD/YYYY", "KK.OO.YYYY", "КК.ОО.ЙЙЙЙ", "XX.XX.XXXX", "ХХ.ХХ.ХХХХ")),
    )
]

# Words of filler text in the usual pseudo-Latin.
LOREM = frozenset("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split())
# Sentences that stand for missing content.
FILLER = (
    "Образец текста",
    "Замените его своим содержанием",
    "Текст раздела будет добавлен позднее",
    "Здесь должен быть текст",
    "Введите описание здесь",
    "Заголовок раздела",
    "Namuna matni",
    "Uni o‘zingizniki bilan almashtiring",
    "Bo‘lim matni keyinroq qo‘shiladi",
    "Bu yerda matn bo‘lishi kerak",
    "Tavsifni shu yerga kiriting",
    "Bo‘lim sarlavhasi",
    "Sample text",
    "Replace it with your own content",
    "Section text will be added later",
    "Your text goes here",
    "Enter a description here",
    "Section title",
    "Section heading",
    "Text goes here",
    "Click to add a heading",
    "Click to add a title",
    "Click to add text",
)
# Texts of the status codes.
STATUS = (
    "Not Found",
    "Page not found",
    "Forbidden",
    "Access denied",
    "Internal Server Error",
    "Gone",
    "Too Many Requests",
    "Bad Gateway",
    "Bad Request",
    "Unauthorized",
    "Service Unavailable",
    "Service temporarily unavailable",
    "Gateway Timeout",
    "Request Timeout",
    "Страница не найдена",
    "Неверный запрос",
    "Внутренняя ошибка сервера",
    "Сервис временно недоступен",
    "Доступ запрещён",
    "Время ожидания истекло",
    "Сбой шлюза",
    "Слишком много запросов",
    "Документ удалён",
    "Требуется вход",
    "Sahifa topilmadi",
    "So‘rov noto‘g‘ri",
    "Serverda ichki xato",
    "Xizmat vaqtincha mavjud emas",
    "Kirish taqiqlangan",
    "Kutish vaqti tugadi",
    "Shlyuz ishlamayapti",
    "So‘rovlar juda ko‘p",
    "Hujjat o‘chirilgan",
    "Tizimga kiring",
)


FOLDED = TO_LATIN | dict.fromkeys(map(ord, "‘’'`´ʻʼ"))


def fold(s: str) -> str:
    """Lower case, one alphabet, no apostrophes, single blanks."""
    return " ".join(s.lower().translate(FOLDED).replace("ye", "e").split())


def mask(line: str) -> str:
    """A message without what changes from page to page: leading signs and tags, numbers, dates, addresses, ids."""
    s = fold(line)
    s = re.sub(r"https?://\S+|\S+@\S+", "<a>", s)
    s = re.sub(r"\b(?=[0-9a-f]*\d)[0-9a-f]{4,}\b|\d+(?:[.,:/-]\d+)*", "#", s)
    s = re.sub(r"^(?:<noscript>|</?\w+>|[^\w<#(/]+)+|\s*\(#\)\s*$|</noscript>$", "", s)
    return s.strip()


# Words that stand for each other in such messages, in the folded form.
ALIKE = [
    ("", r"\(#\)|\b(?:error|oshibka|xato|http) (?=#)|#[ :.–—-]*(?=\w)"),
    ("<js>", r"\b(?:java ?script|js)(?:ni)?\b|\b(?:skript|stsenari|ssenari)\w*|\baktivni\w* element\w*(?: stranits\w*)?|\bactive content\b|\bfaol \w+"),
    ("<page>", r"\b(?:protokol|dokument|razdel|stranits|soderjani|sayt|portal|reestr|bayonnoma|hujjat|bolim|sahifa|tarkib|protocol|document|section|page|content|site|website|registr)\w*"),
    ("<on>", r"\b(?:vklyuchite|aktiviruyte|razreshite|turn on|enable|activate|allow|switch on|yoqing|eqing|faollashtiring|ezing|ruxsat bering)\b"),
    ("<off>", r"\b(?:otklyuchen|zapreshen|zablokirovan|vyklyuchen|ochirilgan|taqiqlangan|bloklangan|disabled|blocked)\w*"),
    ("", r"(?:,? (?:i|ili|va|yoki|and|or|v nastroykax|in your|poetomu|shuning uchun|so|to continue)\b.*|[\s.!…]+)\Z"),
]
ALIKE = [(to, re.compile(form)) for to, form in ALIKE]


def grouped_form(message: str) -> str:
    """The form whose hash groups masked messages: without what one wording has and the next has not."""
    if "</" in message:  # an error page in one line is grouped by its title
        message = message.partition("</")[0]
    for to, form in ALIKE:
        message = form.sub(to, message)
    return message.strip(" .!…:–—-")


_any = lambda phrases: "|".join(sorted({re.escape(fold(p)) for p in phrases}, key=len, reverse=True))
_js = r"(?:java ?script|js)"
SURE = [
    re.compile(p)
    for p in (
        rf"^(?:{_any(FILLER)})[.!…]*$",
        rf"^(?:error |oshibka |xato |http )?#[ :.–—-]*(?:{_any(STATUS)})[.!]*(?: \(#\))?[.!]*$",
        rf"^(?:{_any(STATUS)}) ?\(#\)[.!]*",
        r"^(?:error )?#\s[^<]{3,40}</title>",
        r"^traceback \(most recent call last\)",
        r"^fatal error: (?:allowed memory|uncaught|call to)",
        r"^error establishing a database connection",
        r"^ora-#: ",
        r"^warning: (?:include|require|mysql|pg_)\w*\(\)",
        rf"^{fold('К сожалению, запрошенн')}\w+ \w+ {fold('больше не доступ')}",
        r"^afsuski, soralgan \w+ endi mavjud emas",
        r"^sorry, the requested \w+ is no longer available",
        # scripts are required
        rf"^[^.!?]{{0,60}}\b{fold('не работает без')} {_js}\b",
        rf"^[^.!?]{{0,60}}\b(?:doesnt|does not|wont|will not) (?:work|run|open) without {_js}\b",
        rf"^[^.!?]{{0,60}}\b(?:{_any(['включите', 'активируйте', 'разрешите', 'turn on', 'enable', 'activate', 'allow', 'switch on'])}) {_js}\b",
        rf"^[^.!?]{{0,60}}\b{_js}(?:ni|ni )? ?(?:yoqing|eqing|faollashtiring|ezing|ruxsat bering)\b",
        rf"^{fold('в вашем браузере')} (?:{_any(['отключен', 'запрещен', 'заблокирован', 'выключен'])})\w* (?:{_any(['скрипт', 'сценари', 'активн', 'java'])})",
        rf"^{fold('ваш браузер')} (?:{_any(['блокирует', 'не выполняет', 'не поддерживает', 'устарел'])})",
        r"^brauzeringizda (?:skript|ssenari|faol|java)\w* ?\w* ?(?:ochirilgan|taqiqlangan|bloklangan|yoq)",
        r"^brauzeringiz (?:eskirgan|skript|ssenari|java)",
        r"^your browser (?:has (?:script|blocked|active|java|disabled)|blocks|doesnt|does not|is (?:blocking|outdated|too old|out of date))",
        rf"^(?:\w+, )?(?:{fold('идёт проверка браузера')}|brauzer tekshirilmoqda|(?:checking|verifying) (?:your )?browser)",
    )
]
_page = r"(?:protokol|dokument|razdel|stranits|sayt|portal|sahifa|hujjat|page|site|website|document)\w*"
LIKELY = [re.compile(p) for p in (rf"^(?:oops|uups|ups)\b.{{0,60}}$", r"^something went wrong\b.{0,40}$", r"^todo ?[:—–-] ?.{3,60}$", r"^(?:error |http )?#[ :.-]+(?:nginx|apache|iis)\b.{0,20}$",
    rf"^(?:error|oshibka|xato|http) #[ :.-]+(?:{_page} )?(?:does not exist|is unavailable|ne sushestvuet|nedostup\w*|mavjud emas|topilmadi)[.!]*$",
    rf"^{_page} (?:vremenno |seychas |temporarily |is |vaqtincha )*(?:nedostup\w*|ne sushestvuet|unavailable|mavjud emas)[.!]*$", rf"^(?:etot |dannyy |daniy |this )?{_page} (?:trebuet|requires)\b[^.!?]{{0,40}}{_js}[.!]*$",
    rf"^{_js} (?:va|and|i) (?:cookies|kookies) ", rf"^[^.!?]{{0,40}}\b(?:captcha|ddos)\b", rf"^{fold('Требуются')} {_js}", r"^(?:brauzer|browser)\w* \w+ \w*$")]
# What a message must hold, in the folded form that the rules read, for any rule to match: each rule of SURE and
# LIKELY has a part of this list, a phrase of FILLER or STATUS, or a status code in brackets. A code before other words needs STATUS or <title>.
PARTS = "java|js|skript|stsenari|ssenari|aktivn|traceback|fatal error|establishing|ora-|include|require|mysql|pg_|bolshe ne dostup|nedostup|ne sushestvu|does not exist|unavailable|mavjud emas|topilmadi|oops|ups|went wrong|todo|nginx|apache|endi mavjud emas|no longer available|brauzer|browser|captcha|ddos|</title>"
HINTS = tuple(dict.fromkeys([*PARTS.split("|"), *(fold(p) for p in (*FILLER, *STATUS, "не работает без", "ваш браузер", "в вашем браузере"))]))


def hinted(folded: str) -> bool:
    """Whether any rule may match a text or sentence that fold() has brought to the form of the rules."""
    return any(h in folded for h in HINTS)


def classify(message: str) -> str | None:
    """'sure', 'likely' or None for a masked message."""
    if any(r.search(message) for r in SURE):
        return "sure"
    return "likely" if any(r.search(message) for r in LIKELY) else None


def has_filler(low: str) -> bool:
    """A run of six or more words of the pseudo-Latin filler."""
    if not any(x in low for x in ("lorem", "ipsum", "лорем", "ипсум")):
        return False
    run = 0
    for w in re.findall(r"[a-z]+", low.translate(TO_LATIN)):
        run = run + 1 if w in LOREM else 0
        if run >= 6:
            return True
    return False


def has_placeholder(text: str) -> bool:
    return any(mark in text and form.search(text) for mark, form in PLACEHOLDERS)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, ghash, mhash, message): one row for a document's slots or filler (hashes null), one for each candidate
    sentence, with the hash of its group and its own."""
    kind = dict(docs.dtypes)[id_col]
    arrow = pa.schema([("doc_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()), ("source", pa.string()), ("ghash", pa.int64()), ("mhash", pa.int64()), ("message", pa.string())])
    digest = lambda m: xxhash.xxh3_64_intdigest(m) - 2**63

    def make():
        split = re.compile(r"\n|(?<=[.!?…])\s+").split

        def work(c: dict[str, list]) -> dict[str, list]:
            out = []
            for i, src, text in zip(c["doc_id"], c["source"], c["txt"]):
                text = readable(text)
                if has_placeholder(text) or has_filler(text.lower()):
                    out.append((i, src, None, None, None))
                if not hinted(fold(text)):
                    continue
                seen = set()
                for s in (*split(text), *text.split("\n")):
                    if s.strip() and hinted(fold(s)):
                        m = mask(s)
                        if m and m not in seen:
                            seen.add(m)
                            out.append((i, src, digest(grouped_form(m)), digest(m), m))
            return dict(zip(arrow.names, map(list, zip(*out)))) if out else {n: [] for n in arrow.names}

        return work

    src = docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), docs[text_col].alias("txt")).filter(F.trim("txt") != "")
    return map_rows(src, make, f"doc_id {kind}, source string, ghash bigint, mhash bigint, message string", arrow)


def messages(found: DataFrame, min_sources: int = 2, likely_sources: int = 3) -> DataFrame:
    """(mhash, message, sources, verdict) of every distinct candidate message that is residue: known to a phrase rule, and of a group
    that is in `min_sources` sources, or in `likely_sources` where the rule says less."""
    distinct = durable(found.filter("mhash is not null").groupBy("ghash", "mhash", "source").agg(F.min("message").alias("message")))
    groups = distinct.select("ghash", "source").distinct().groupBy("ghash").agg(F.count("source").alias("sources")).filter(F.col("sources") >= min_sources)
    recurring = distinct.groupBy("ghash", "mhash").agg(F.min("message").alias("message")).join(groups, "ghash")
    arrow = pa.schema([("mhash", pa.int64()), ("message", pa.string()), ("sources", pa.int64()), ("verdict", pa.string())])

    def make():
        return lambda c: {**{k: c[k] for k in ("mhash", "message", "sources")}, "verdict": [classify(m) for m in c["message"]]}

    judged = map_rows(recurring.select("mhash", "message", "sources"), make, "mhash bigint, message string, sources bigint, verdict string", arrow)
    return judged.filter(F.col("verdict").eqNullSafe("sure") | F.col("verdict").eqNullSafe("likely") & (F.col("sources") >= likely_sources))


def residue_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", min_sources: int = 2, likely_sources: int = 3) -> DataFrame:
    """(doc_id) of the documents with residue. Only candidate sentences are shuffled."""
    found = durable(candidates(docs, id_col, text_col, source_col))
    hits = found.join(messages(found, min_sources, likely_sources).select("mhash"), "mhash", "left_semi").select("doc_id")
    return found.filter("mhash is null").select("doc_id").union(hits).distinct()
