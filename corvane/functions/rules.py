"""Word lists, orders and thresholds that define the results. Order matters where lists are applied in turn."""

WORD_EXTENSIONS = (".docx", ".doc")
PDF_EXTENSIONS = (".pdf",)
SUPPORTED = WORD_EXTENSIONS + PDF_EXTENSIONS
PRIORITY = {".docx": 1, ".doc": 2, ".pdf": 3}
OTHER_PRIORITY = 99
REQUESTED_LANGUAGES = ("ru", "uz_cyr", "uz_lat")
FALLBACK_ORDER = ("ru", "uz_cyr", "uz_lat", "unknown")

STOP_FOLDERS = ("ворд", "word", "doc", "docx", "сайтга", "сайт", "pdf", "пдф", "нкп", "нкс", "мкп", "мкс", "протокол", "протоколы", "protocol", "protokol", "стандарт", "стандарты", "standard", "standart", "илова", "приложение")
REVIEW_MARKERS = ("рецензия", "тақриз", "такриз", "review", "эксперт", "expert", "хулоса", "заключение")
STANDARD_MARKERS = ("стандарт", "standart", "standard", "нкс", "мкс", "mks", "клиник стандарт")
PROTOCOL_MARKERS = ("нкп", "протокол", "protokol", "protocol", "мкп", "mpk", "mkp", "клиник протокол")
PATH_RU = (" рус", "_рус", "-рус", "рус.", "русс", "русча", " russian", "_ru", "-ru", " ru.")
PATH_UZ_LAT = (" лат", "_лат", "-лат", "латин", "лотин", "лот", " latin", "_lat", "-lat", "uzb latin", "uzbek latin")
PATH_UZ_CYR = (" кир", "_кир", "-кир", "кирил", "кирилл", " cyr", "_cyr", "-cyr", "uzb kir", "uzbek cyr", "узб кир")
KEY_REMOVALS = ("рус", "ру", "russian", "ru", "узб", "кирилл", "кирил", "кир", "cyr", "латин", "лотин", "лот", "latin", "lat", "нкп", "нкс", "мкп", "мкс", "протокол", "стандарт", "protocol", "standard", "protokol", "standart", "organized")

TEXT_UZ_LAT = ("o‘zbekiston", "o'zbekiston", "sog‘liq", "sog'liq", "bo‘yicha", "bo'yicha", "davolash", "kasallik", "shifokor", "tibbiy", "toshkent", "vazirligi", "tashxis", "profilaktika", "bemor")
TEXT_RU = ("министерство", "здравоохранения", "республики", "клинический", "протокол", "стандарт", "лечение", "диагностика", "заболевание", "беременность", "пациент", "профилактика")
TEXT_UZ_CYR = ("соғлиқ", "сақлаш", "бўйича", "даволаш", "касаллик", "шифокор", "тиббий", "ташхис", "бемор", "вазирлиги")
CODE_MARKERS = ("мкб", "mkb", "icd", "мкх", "код", "code")

FLOWCHART_WORDS = ("flow", "algorithm", "алгоритм", "схема", "блок-схема")
CHART_WORDS = ("chart", "graph", "диаграм", "график", "шкала", "scale")
TABLE_WORDS = ("table", "таблица", "жадвал")
CAPTION_OPENINGS = ("figure", "рис", "расм", "таблица", "жадвал")

LANGUAGE_SAMPLE, LANGUAGE_LEAST, UZ_CYR_LETTERS = 12_000, 50, 10
LOW_CHARS, REPLACEMENTS, LETTER_RATIO = 500, 20, 0.25
SCANNED_PAGE, SCANNED_SHARE, MIXED_SHARE = 30, 0.70, 0.10
TABLE_LEAST, TABLE_CONSISTENCY = 20, 0.75
DUPLICATE_LEAST, HASH_CHARS, SHOWN_CODES = 1000, 50_000, 50
SMALLEST_AREA = 0.00001
CONTEXT_CHARS, CAPTION_CHARS, CONTEXT_BLOCKS = 2000, 1000, 2
