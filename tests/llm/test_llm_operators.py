"""Each operator on small cases: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import os
import random
import unicodedata
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corvane.llm import boilerplate, encode, language, leaks, lookalike, mojibake, quality, residue, scanned, split

SF = "/root/testdata/sf0.001"
needs_files = pytest.mark.skipif(not os.path.exists(encode.TOKENIZERS), reason="no tokenizer files")


def raw(spark, rows, extra="x"):
    cols = "row_id bigint, variant_id string, specialty string, raw_text string, piece string, text string, doc_type string, detected_language string"
    return spark.createDataFrame([(i, v, s, t, extra, extra, k, None) for i, v, s, t, k in rows], cols)


@pytest.fixture(scope="module")
def samples(spark):
    return spark.read.parquet(f"{SF}/language_samples.parquet")


@pytest.fixture(scope="module")
def repair(samples):
    return mojibake.Repair(mojibake.sample_texts(samples))


# 1
def model():
    words = Counter({w: 100 for w in "получен осмотр больного терапевт врач врач-терапевт подтверждённой классификации лабораторно по при код указывают".split()})
    return scanned.Model(dict(words), ["клинические протоколы. выпуск #"])


PAGE = "Рекомендации по анемии\nПосле выписки врач проводит осмотр больного и при полу-\n1\nКЛИНИЧЕСКИЕ ПРОТОКОЛЫ. ВЫПУСК 38\nчении результата назначает врач-\nтерапевт получсн снова, код J10.1 по\nдтверждённой по классификации 5 из 10 н0вый\nследующий осмотр больного проводит врач.\n2"


def test_scanned_page():
    m = model()
    m.words["получении"] = 50
    m = scanned.Model(m.words, m.heads)
    found, text = m.defects(PAGE)
    assert [x for x in found if x[1] == "running_line"] == [(3, "running_line"), (4, "running_line"), (9, "running_line")]
    assert [x for x in found if x[1] == "broken_word"] == [(2, "broken_word"), (6, "broken_word")]
    assert [n for n, d in found if d == "bad_chars"] == [6, 7]
    assert "при получении результата назначает врач-терапевт получен снова" in text and "ВЫПУСК" not in text


def test_clean_records_stay():
    text = "Заголовок\n\n" + "Длинная строка без переносов и без ошибок. " * 5 + "\n331\n"
    assert model().defects(text) == ([], text)


def test_page_number_forms():
    for s, v in {"12": 12, "~ 2 ~": 2, "Стр. 7": 7, "страница 1 из 2": 1, "5-бет": 5, "3 / 9": 3, "xiv": 14, "l37": 137, "page 2 of 3": 2}.items():
        assert scanned.page_number(s)[0] == v, s
    for s in ("12,5 мг", "Лечение", "раз в 3 дня."):
        assert scanned.page_number(s) is None, s


def test_scanned_table(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, PAGE), (3, PAGE)], "row_id bigint, raw_text string").withColumn("defect", F.lit("x"))
    out = scanned.repair(df, scanned.fit(df)).filter("defect is null").collect()
    assert Counter(r.row_id for r in out) == {1: 1, 2: 1, 3: 2}
    assert scanned.repair(df.limit(0), scanned.fit(df.limit(0))).count() == 0


def test_rare_headers_are_learned_at_every_size(spark):
    page = "Заметки\nПосле выписки врач проводит осмотр больного и при\nполучении результата назначает лечение номер {}\n{}\nВЕСТНИК КЛИНИКИ. ТОМ {}\nследующий осмотр больного проводит врач.\n{}"
    rare = [(page.format("абвгде"[k], k + 1, 20 + k, k + 2),) for k in range(6)]
    df = spark.createDataFrame(rare, "raw_text string").union(spark.range(10_100).selectExpr("concat('Чистая запись без страниц ', id)"))
    assert scanned.fit(df).heads == ["вестник клиники. том #"]


def test_copies_of_one_text_count_once(spark):
    words = "обследование назначают планово каждому взрослому пациенту отделения"
    clean = [(k, f"Запись {k}: {words} без отклонений") for k in range(60)]
    scan = "Заметки о порядке обследования взрослых\nСегодня обследовапие назначают планово взрослому\nпациенту отделения и выписывают его домой."
    df = spark.createDataFrame([*clean, *((100 + k, scan) for k in range(30))], "row_id bigint, raw_text string")
    model = scanned.fit(df, least=1)
    assert model.words["обследовапие"] == 1 and model.words["обследование"] == 60
    got = {(r.row_id, r.line_no) for r in scanned.repair(df, model).filter("defect = 'bad_chars'").collect()}
    assert got == {(100 + k, 2) for k in range(30)}


def test_blocks_give_what_the_broadcast_gives(spark):
    docs = spark.read.parquet(f"{SF}/parsed_docling.parquet").select("row_id", "raw_text").union(spark.createDataFrame([(-1, None), (-2, ""), (-3, PAGE), (-3, PAGE)], "row_id bigint, raw_text string"))
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    m = scanned.fit(docs)
    want = key(scanned.repair(docs, m))
    assert isinstance(m, scanned.Model) and want
    counted = scanned.fit(docs, most_words=5)
    assert not isinstance(counted, scanned.Model) and key(scanned.repair(docs, counted)) == want
    assert key(scanned.repair_in_blocks(docs, counted, block_rows=7)) == want
    assert key(scanned.repair(docs.repartition(3, "row_id"), m)) == want
    heads = spark.createDataFrame([("выпуск #",), ("том #",), ("институт терапии",)], "key string")
    forms = spark.createDataFrame([("выпуск #",), ("вьпуск #",), ("институт терапин",), ("лечение",)], "key string")
    got = {n: ({r.key for r in scanned.known_forms(forms, heads, n)[0].collect()}, scanned.known_forms(forms, heads, n)[1]) for n in (1, 9)}
    assert got[1] == got[9] == ({"выпуск #", "вьпуск #", "институт терапин"}, True)


def test_one_wide_line_does_not_make_a_record_clean():
    m = model()
    m = scanned.Model({**m.words, "получении": 50}, m.heads)
    found, _ = m.defects(PAGE + "\n" + "слово " * 17)
    assert (2, "broken_word") in found and (4, "running_line") in found


def test_headers_without_numbers(spark):
    body = "Сегодня врач проводит осмотр больного и назначает при\nобострении лечение по схеме отделения, указывая {} раз."
    two, three = "При анемии средней тяжести показаны таблетки железа, их\nпринимают до обеда и запивают водой.", "Контроль анализа крови проводят каждую неделю, пока он\nне станет обычным для возраста больного."
    pages = [body.format("один"), "3", "Республиканский институт терапии", two, "4", "Республиканскнй институт терапии", three, "5"]
    found = model().defects("\n".join(["О лечении больных с анемией в отделениях", *pages]))[0]
    assert [n for n, d in found if d == "running_line"] == [4, 5, 8, 9, 12]
    words = "сосуды почки печень лёгкие кости нервы".split()
    rows = [(f"Заметка о болезни: {w}\n{body.format(w)}\n{k + 1}\nИнститут терапии и хирургии\nПосле этого врач описывает {w}.",) for k, w in enumerate(words)]
    m = scanned.fit(spark.createDataFrame(rows, "raw_text string"))
    assert m.heads == ["институт терапии и хирургии"]
    assert (5, "running_line") in m.defects(rows[0][0])[0]


# 2
def test_repeated_lines_against_brute_force(spark):
    rng = random.Random(1)
    lines = ["Информация предназначена только для врачей %d." % 1, "СОХРАНИТЕ страницу в закладки, пожалуйста!", "Короткая"]
    rows = []
    for i in range(120):
        body = [f"Текст записи {'абвгдежзик'[j % 10] * 12} {rng.random()}" if rng.random() < 0.5 else "".join(rng.choice("абвгдежзик") for _ in range(30)) for j in range(3)]
        if rng.random() < 0.3:
            body.append(rng.choice(lines).lower() if rng.random() < 0.5 else rng.choice(lines).replace("1", str(i)))
        rows.append((i, f"v{i % 100}", ["А", "Б", None, " "][i % 4], rng.choice([None, "", "\n".join(body)]) if i % 9 == 0 else "\n".join(body), None))
    df = raw(spark, rows)
    got = sorted((r.row_id, r.line_no) for r in boilerplate.repeated_lines(df).collect())
    docs, total, place = defaultdict(set), defaultdict(set), []
    for i, v, s, t, _ in rows:
        if s and s.strip():
            total[s].add(v)
            for n, line in enumerate((t or "").split("\n"), 1):
                k = "".join(c for c in line.lower() if c.isalpha())
                if len(k) >= 20:
                    docs[s, k].add(v)
                    place.append((i, n, s, k))
    want = sorted((i, n) for i, n, s, k in place if len(docs[s, k]) >= 4 and 100 * len(docs[s, k]) >= 2 * len(total[s]))
    assert got == want and want
    drop = set(want)
    for out in (boilerplate.cleaned(df), boilerplate.without_lines(df, boilerplate.repeated_lines(df))):
        clean = {r.row_id: r.clean_text for r in out.select("row_id", "clean_text").collect()}
        assert all(clean[i] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n"), 1) if (i, n) not in drop)) for i, _, _, t, _ in rows)
    assert boilerplate.repeated_lines(df.limit(0)).count() == 0 and boilerplate.cleaned(df.limit(0)).count() == 0
    # many rows a tree, and a join in place of the broadcast, change nothing
    src = boilerplate._source(df, "row_id", "specialty", "variant_id", "raw_text")
    assert sorted(map(tuple, boilerplate.grown(src, 20, most=3).distinct().collect())) == sorted(map(tuple, boilerplate.grown(src, 20).distinct().collect()))
    most, boilerplate.BROADCAST = boilerplate.BROADCAST, 0
    try:
        assert sorted((r.row_id, r.line_no) for r in boilerplate.repeated_lines(df).collect()) == want
        by_join = {tuple(r) for r in boilerplate.templates(df).collect()}
        again = {r.row_id: r.clean_text for r in boilerplate.cleaned(df).collect()}
    finally:
        boilerplate.BROADCAST = most
    assert again == clean and by_join == {tuple(r) for r in boilerplate.templates(df).collect()}


def test_templates_have_wildcards_where_lines_differ(spark):
    lines = ["Дата печати: 10.05.2025. Страница загружена", "ДАТА ПЕЧАТИ - 11.06.2025. Страница загружена", "Дата печа-ти: 1.1. Страница загружена!", "дата печати: 2. Страница загружена"]
    df = raw(spark, [(k, f"v{k}", "А", f"Заголовок {k}\n{x}", None) for k, x in enumerate(lines)])
    assert [(r.grp, r.template, r.docs, r.total) for r in boilerplate.templates(df).collect()] == [("А", "дата печа<*>ти<*>страница загружена<*>", 4, 4)]
    assert boilerplate.templates(df.limit(0)).count() == 0


# 3
@pytest.mark.parametrize("enc,dec", [("utf-8", "cp1251"), ("utf-8", "cp866"), ("utf-8", "koi8-r"), ("cp1251", "latin-1"), ("koi8-r", "cp1251"), ("cp1251", "cp866")])
def test_mojibake_round_trip(repair, enc, dec):
    plain = "Противопоказанием к применению является постоянная лихорадка, а также возраст больного"
    bad = "".join(w.encode(enc).decode(dec, "ignore") if enc != "utf-8" or True else w for w in plain)
    assert repair.garbled(bad)
    assert unicodedata.normalize("NFC", repair(bad)).split()[:2] == plain.split()[:2]


def test_mojibake_depends_on_no_other_text(samples):
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table("/root/testdata/sf0.01/parsed_guidelines_raw.parquet", columns=["raw_text"])["raw_text"].to_pylist() if t]
    got = []
    for seed in range(3):
        order = list(range(len(texts)))
        random.Random(seed).shuffle(order)
        fix = mojibake.Repair(mojibake.sample_texts(samples))
        out = {k: (fix.garbled(texts[k]), fix(texts[k])) for k in order}
        got.append([out[k] for k in range(len(texts))])
    assert got[0] == got[1] == got[2] and sum(g for g, _ in got[0]) > 20


def test_mojibake_leaves_rare_signs(repair):
    for t in (None, "", "About 26 treatment-naïve patients; café-au-lait (ÄÖÜ-test), 5 µg, x²", "Бўлимда ё‘тал 38 °C ±5 %", "ОТПРАВИТЬ КОЛЛЕГЕ ЭТУ СТРАНИЦУ", "щхвщ бж лфнб кн шщ. р;"):
        assert not repair.garbled(t) and repair(t) == t
    assert repair.garbled("текст �� с утратой")


def test_mojibake_in_ascii(repair):
    plain = "Противопоказанием к применению является лихорадка; возраст больного"
    for bad in ("".join(f"&#{ord(c)};" if ord(c) > 127 else c for c in plain), "".join(f"&amp;#x{ord(c):x};" if ord(c) > 127 else c for c in plain)):
        assert bad.isascii() and repair.garbled(bad) and repair(bad) == plain
    assert repair("Na&iuml;ve patients") == "Naïve patients"
    for t in ("?????????????? ? ?????????? 5 mg", "Dose ?? ?? ??????.", "Ле??ние больного"):
        assert repair.garbled(t), t
    for t in ("Really??", "Is it 5 mg? Or 6 mg?", "a &amp; b, x &lt; 5; R&D; q?a=1&copy=2", "Что это?? Нет!"):
        assert not repair.garbled(t) and repair(t) == t, t


def test_mojibake_table(spark, samples):
    df = raw(spark, [(1, "v", "s", None, None), (2, "v", "s", "Рекомендации по анемии".encode().decode("cp1251", "replace"), None), (2, "v", "s", "чистый текст", None)])
    assert [r.row_id for r in mojibake.garbled_rows(df, mojibake.sample_texts(samples)).collect()] == [2]
    assert mojibake.repair(df.limit(0), mojibake.sample_texts(samples)).count() == 0


# 4
def test_same_looks(spark):
    a = "Уровень ёмкости ўзга, код A12"
    rows = [(1, a), (2, unicodedata.normalize("NFD", a)), (3, a.replace("о", "o").replace(" ", " ")), (4, a.replace("к", "к​")), (5, a.replace("A12", "Ａ１２")), (6, a + "."), (7, None), (8, " "), (9, "​"), (10, a), (11, a.replace("ё", "е"))]
    df = raw(spark, [(i, "v", "s", t, None) for i, t in rows])
    got = {(r.row_id_a, r.row_id_b) for r in lookalike.same_looking_pairs(df, ["уровень", "сор"]).collect()}
    same = [1, 2, 3, 4, 5, 10]
    assert got == {(x, y) for x in same for y in same if x < y and (x, y) != (1, 10)}
    forms = {r.row_id: r.text for r in lookalike.consistent(df, ["уровень"]).collect()}
    assert forms[7] is None and len({forms[i] for i in same}) == 1 and forms[1].startswith("Уровень")
    assert lookalike.same_looking_pairs(df.limit(0), []).count() == 0


def test_a_look_of_many_rows_meets_in_blocks(spark):
    df = spark.range(300).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "Сор 12").when(F.col("id") % 3 == 1, "Cop 12").otherwise("Сор\u200b 12").alias("raw_text"))
    for block in (16, 256):
        pairs = lookalike.same_looking_pairs(df, [], block=block).collect()
        assert len(pairs) == len({tuple(p) for p in pairs}) == 3 * 100 * 100 and all(p[0] < p[1] for p in pairs)
    rows = lookalike.look_classes(df.union(spark.createDataFrame([(500, "иное"), (501, None), (502, " ")], "row_id bigint, raw_text string")), []).collect()
    assert {(r.class_id, r.n_rows, r.several_forms) for r in rows} == {(0, 300, True), (500, 1, False)} and len(rows) == 301


def test_automaton():
    auto = lookalike.Automaton(["сор", "рос"])
    assert auto.spell("cop") == "сор" and auto.spell("c​оp") == "сор" and auto.spell("сот") is None


# 5
@needs_files
def test_languages(spark, samples):
    mixed = "Препарат вводят в дозе десять мг под контролем врача.\nBemorga tekshiruv uchun shifokor bilan maslahatlashish tavsiya etiladi.\n"
    df = raw(spark, [(1, "v", "s", mixed, None), (2, "v", "s", None, None), (3, "v", "s", "Слово", None), (4, "v", "s", "The nurse should order a full blood count on time.", None), (5, "v", "s", "бж 13ч б гдзв п ж лк. щщ вв дд ккк мм нн.", None)]).withColumn("detected_language", F.when(F.col("row_id") == 4, "en"))
    got = {(r.row_id, r.language) for r in language.mislabelled(df, samples).collect()}
    assert got == {(1, "ru"), (1, "uz_lat")}
    seg = [(r.segment_no, r.language, r.first_line) for r in language.identify(df, samples).filter("row_id = 1").orderBy("segment_no").collect()]
    assert seg == [(1, "ru", 1), (2, "uz_lat", 2)]
    assert language.mislabelled(df.limit(0), samples).count() == 0


@needs_files
def test_language_held_out():
    from corvane.llm.language import Scorer, fit, pieces
    import pyarrow.parquet as pq

    rows = [(r["language"], r["sample_text"]) for r in pq.read_table(f"{SF}/language_samples.parquet").to_pylist()]
    train, test = rows[::2], rows[1::2]
    vocab = pieces(encode.TOKENIZERS)
    score = Scorer(fit(train, vocab), vocab)
    assert sum(score(t)[0] == l for l, t in test) >= 0.95 * len(test)


def test_words_are_scored_in_whole():
    score = language.Scorer({"": ("en",), **{c: (0.04,) for c in "^abcdefghij"}}, frozenset("^abcdefghij"))
    for n in (5, 60, 61, 1000):
        assert score.word(("abcdefghij" * 100)[:n])[0] == pytest.approx((n + 1) * language.math.log(0.04))
    assert score.word("z" * 90)[0] == pytest.approx(language.math.log(0.04) + 90 * language.math.log(1e-6))


# 6
def test_kinds(spark, samples):
    texts = {
        "prose": "Рекомендации\nПосле выписки врач проводит осмотр и разъясняет больному правила приёма лекарств. Температура выше нормы служит основанием для вызова врача.",
        "list": "Список\n- код C25.3\n- Гараборин 550 мг\n- клинический анализ крови\n- нарастающая боль",
        "table": "Код\tДоза\tНорма\nАлорин\t10\t20\nБелорин\t5\t7\nГалорин\t1\t2",
        "junk": "........................ 12\n======================== 77\n//\\\\##__++--==~~^^",
    }
    df = raw(spark, [(k, "v", "s", t, None) for k, t in enumerate([*texts.values(), None, " \n"])])
    got = {r.row_id: r.kind for r in quality.statistics(df, samples, spark.read.parquet(f"{SF}/common_words.parquet"), text_col="raw_text").collect()}
    assert [got[k] for k in range(4)] == list(texts) and got[4] is None and got[5] is None
    mixed = "\n".join([texts["prose"], *texts["prose"].split("\n")[1:] * 3, texts["table"]])
    both = quality.statistics(raw(spark, [(1, "v", "s", mixed, None), (2, "v", "s", texts["table"] + "\n" + texts["list"].replace("- ", "– "), None)]), samples, spark.read.parquet(f"{SF}/common_words.parquet"), text_col="raw_text")
    assert {r.row_id: r.kind for r in both.collect()}[1] == "prose"
    assert quality.jensen_shannon((1, 0), (0, 1)) == 1 and quality.jensen_shannon((0.5, 0.5), (0.5, 0.5)) == 0


def test_kinds_of_held_out_words(samples):
    """Profiles of half of the samples against layouts of the other half: the divergence alone tells the kinds apart."""
    rows = [(r.language, r.sample_text) for r in samples.orderBy("sample_id").collect()]
    common = [("ru", w) for w in "в на и при для не".split()] + [("en", w) for w in "the of and is to a".split()] + [("uz_cyr", w) for w in "ва билан учун бу".split()] + [("uz_lat", w) for w in "va bilan uchun bu".split()]
    profiles = quality.Profiles(rows[::2], common)
    right = total = 0
    for language in ("ru", "en", "uz_cyr", "uz_lat"):
        texts = [t for l, t in rows[1::2] if l == language]
        words = list(dict.fromkeys(w for t in texts for w in quality.re.findall(r"[^\W\d_]{3,}", t)))
        for kind, text in quality.layouts(words, texts):
            total += 1
            right += profiles.nearest(profiles.counts(text))[0] == kind
    assert right >= 0.97 * total
    counts = profiles.counts("Врач назначает осмотр и лечение 5 мг.\n- код I10; 7\n|a|b|c|")
    parts = quality.np.split(profiles.distribution(counts)[profiles.language], (len(profiles.words) + len(quality.TOKENS), len(profiles.words) + len(quality.TOKENS) + len(quality.CLASSES)), axis=1)
    theirs = quality.np.split(profiles.profiles, (parts[0].shape[1], parts[0].shape[1] + parts[1].shape[1]), axis=1)
    want = sum(w * quality.jensen_shannon(p, q) for w, p, q in zip(quality.WEIGHTS, parts, theirs))
    assert quality.np.allclose(profiles.divergences(counts), want, atol=1e-4)


# 7
def test_pieces(spark):
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(["слово ", "Конец. ", "\n", "\n\n", "1. Раздел\n", "x" * rng.randrange(1, 60), "😀"]) for _ in range(rng.randrange(1, 60)))
        limit, lap = rng.randrange(1, 80), rng.randrange(0, 100)
        cut = split.pieces(text, limit, lap)
        lap = min(lap, limit - 1)
        assert cut[0][0] == 0 and cut[-1][1] == len(text) and all(0 < b - a <= limit for a, b in cut)
        if len(text) > limit:
            assert all(c == max(b - lap, 0) and d > b for (_, b), (c, d) in zip(cut, cut[1:]))
    limits = spark.createDataFrame([("a", 10, 3), ("a", 12, 3), ("b", None, 1)], "doc_type string, max_chars int, overlap_chars int")
    df = raw(spark, [(1, "v", "s", "один два три четыре", "a"), (2, "v", "s", "коротко", "a"), (3, "v", "s", None, "a"), (4, "v", "s", "один два три четыре", "b"), (5, "v", "s", "один два три четыре", None)])
    out = split.split_oversized(df, limits).orderBy("piece_no").collect()
    assert {r.row_id for r in out} == {1} and all(len(r.piece) <= 10 for r in out) and out[0].piece == "один два "
    assert split.split_oversized(df.limit(0), limits).count() == 0


# 8
@needs_files
def test_encoding_matches_the_reference_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    _, _, ranks = encode.load(encode.TOKENIZERS)
    ref = tiktoken.Encoding("own", pat_str=encode.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", " ", "<|endoftext|>", "a" * 3000, "it's we'll  \n\n x", "Даволаш ва ташхис бўйича", "𝑔𝑚 é​", "12345ж" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("ids", F.lit(1)).union(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit(1)))
    want = Counter((r.doc_id, tuple(ref.encode_ordinary(r.text) if r.text else ())) for r in df.collect())
    got = Counter((r.doc_id, tuple(r.ids)) for r in encode.encode(df).collect())
    assert got == want
    assert encode.encode(df.limit(0)).count() == 0
    byte_ids, table, _ = encode.load(encode.TOKENIZERS)
    rng = random.Random(1)
    for n in (257, 1000, 20_000):
        for signs in ("abcdefghijklmnopqrstuvwxyz", "ab", "абвгдеж", "-", "漢字仮名"):
            word = "".join(rng.choice(signs) for _ in range(n))
            assert encode.encode_words([word], byte_ids, table)[0].tolist() == ref._core_bpe.encode_single_piece(word.encode())


# 9
def words(rng, n):
    return ["".join(rng.choice("бвгдклмнпрст") + rng.choice("аеиоу") for _ in range(3)) for _ in range(n)]


def test_leaks_find_every_faithful_passage():
    rng = random.Random(3)
    for _ in range(300):
        item = words(rng, 40)
        prints = leaks.Prints([(1, [leaks.word_hash(w) for w in item])])
        n = rng.randrange(15, 36)
        at = rng.randrange(0, len(item) - n + 1)
        part = item[at : at + n]
        for _ in range(n // 6):
            k = rng.randrange(1, len(part) - 1)
            how = rng.randrange(3)
            part[k : k + 1] = [["чужое"], [], [part[k], "чужое"]][how]
        doc = [leaks.word_hash(w) for w in [*words(rng, 10), *part, *words(rng, 10)]]
        at = prints.hits(leaks.np.array(doc))[0].tolist()
        assert len(at) >= leaks.LEAST_HITS
        got = leaks.extended(doc, at, prints.words(0).tolist(), 15, 6)
        assert got and got[0] >= 13


def test_leaks_table(spark):
    rng = random.Random(4)
    items = {k: "Выберите верный ответ. " + " ".join(words(rng, 30)) for k in range(5)}
    passage = items[0].split(". ")[1].split()
    wide = " ".join([*passage[:14], *words(rng, 4), *passage[14:]])  # four words put in at one place
    df = spark.createDataFrame([(1, "Начало. " + " ".join(passage[:20]).upper() + "!"), (2, " ".join(passage[:9])), (3, None), (4, " "), (5, "Выберите верный ответ. " * 9), (6, items[1]), (6, items[1]), (7, wide)], "doc_id bigint, text string").withColumn("item_id", F.lit(1))
    it = spark.createDataFrame([*items.items(), (9, None), (8, "")], "item_id bigint, text string")
    for size in (leaks.BROADCAST, 0):
        got = sorted((r.doc_id, r.item_id) for r in leaks.find_leaks(df, it, broadcast=size).collect())
        assert got == [(1, 0), (6, 1), (6, 1), (7, 0)], size
        assert leaks.find_leaks(df, it.limit(0), broadcast=size).count() == 0 and leaks.find_leaks(df.limit(0), it, broadcast=size).count() == 0


def test_instructions_are_counted_over_all_items(spark):
    rng = random.Random(5)
    it = spark.createDataFrame([(k, "Прочитайте задание и выберите один верный ответ из списка. " + " ".join(words(rng, 20))) for k in range(3)] + [(9, "Другое начало. " + " ".join(words(rng, 20)))], "item_id bigint, text string")
    got = {r.item_id: len(r.words) for r in leaks.item_words(it.repartition(4)).collect()}
    assert got == {0: 20, 1: 20, 2: 20, 9: 22}


def test_uzbek_alphabets_fold_together():
    assert [leaks.fold_word(w) for w in leaks.raw_words("Йиртилган шарбатни ертўлада")] == [leaks.fold_word(w) for w in leaks.raw_words("Yirtilgan sharbatni yerto‘lada")]


# 10
def test_residue(spark):
    bad = ["Текст {{ clinic.title }} здесь", "x %PATIENT_NAME% y", "a ${drugName} b", "[вставить должность эксперта] текст", "срок KK.OO.YYYY", "504 Gateway Timeout\nПовторите.", "Саҳифа топилмади (404). Манзилни текширинг.", "Lorem ipsum dolor sit amet sed ipsum", "Портал не работает без JavaScript", "Brauzeringizda skriptlar o‘chirilgan. Sahifani yangilang.", "<html><head><title>404 Not Found</title></head></html>", "Namuna matni.", "Fatal error: Allowed memory size of 37 bytes exhausted", "{order_no}"]
    good = [None, "", " ", "Набор {1, 2, 3} описан в [4], значения <0,05", "Для работы журнала должен быть включён JavaScript, это проверяет инженер.", "Ошибка 404 в отчёте означает, что снимок удалён.", "<|endoftext|> def dose(w): return w * 0.5 # mg", "± 5 % и 6 %", "If the portal reports that a page is not found, the clerk confirms it."]
    cols = "doc_id bigint, text string, source string, message string"
    df = spark.createDataFrame([(k + 100 * n, t, f"s{n}", "x") for n in range(3) for k, t in enumerate([*bad, *good])], cols)
    assert {r.doc_id for r in residue.residue_rows(df).collect()} == {k + 100 * n for n in range(3) for k in range(len(bad))}
    assert residue.residue_rows(df.limit(0)).count() == 0
    # recurrence decides over messages, forms alone over placeholders and filler
    forms = {k for k, t in enumerate(bad) if residue.has_placeholder(t) or residue.has_filler(t.lower())}
    assert len(forms) == 7
    for one in (df.filter("source = 's0'"), df.withColumn("source", F.lit(None).cast("string"))):
        assert {r.doc_id % 100 for r in residue.residue_rows(one).collect()} == forms


def test_residue_held_out_wording(spark):
    bad = ["Oops! Something went wrong. Please try again later.", "502 nginx", "Error 404 page does not exist", "Этот сайт требует включённого JavaScript.", "Страница временно недоступна", "TODO: заполнить раздел", "[ФИО пациента]"]
    good = ["Сайт клиники недоступен по выходным, записаться можно по телефону.", "Врач требует включённого монитора.", "Список [1, 2] дан ниже."]
    df = spark.createDataFrame([(k + 100 * n, t, f"s{n}") for n in range(3) for k, t in enumerate([*bad, *good])], "doc_id bigint, text string, source string")
    assert {r.doc_id % 100 for r in residue.residue_rows(df).collect()} == set(range(len(bad)))


def test_messages_count_sources_of_documents_with_placeholders(spark):
    rows = [(1, "{{ name }}\n503 Service Unavailable", "a"), (2, "Service Unavailable (503).", "b"), (3, "503 Service Unavailable", "b")]
    found = residue.candidates(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    assert {r.sources for r in residue.messages(found).collect()} == {2}


def test_residue_hints_pass_what_the_rules_know(spark):
    bad = ["Ошибка 500: Внутренняя ошибка сервера", "Ошибка 403. Доступ запрещён", "Xato 403: Kirish taqiqlangan", "Warning: require() failed", "Warning: mysql_connect() failed", "Warning: pg_connect() failed"]
    bad += [f"{code}: {p}" for code in (404, 503) for p in residue.STATUS] + list(residue.FILLER) + ["502 Bad Gateway (502) " + "nginx " * 90, "Traceback (most recent call last) " + "in module " * 60]
    likely = ["Пройдите captcha и продолжайте", "Сайт защищён от ddos атак"]
    good = ["Ошибка в отчёте сервера исправлена.", "Сахар требует контроля."]
    rows = [*((k + 300 * n, t, f"s{n}") for n in range(2) for k, t in enumerate(bad)), *((1000 + 10 * k + n, t, f"s{n}") for k, t in enumerate(likely) for n in range(3)), *((2000 + k, t, "s") for k, t in enumerate(good))]
    got = {r.doc_id for r in residue.residue_rows(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    missed = [t for i, t, _ in rows if i < 2000 and i not in got and residue.classify(residue.mask(t))]
    assert not missed and set(range(6)) <= got and {1000, 1001, 1002, 1010, 1011, 1012} <= got and not got & {2000, 2001}


# SQL
def test_queries_match_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from corvane.llm import queries

    con = duckdb.connect()
    for name in ("parsed_guidelines_raw", "split_limits"):
        con.execute(f"create view {name} as select * from read_parquet('/root/testdata/sf0.01/{name}.parquet')")
    for name, sql in queries.oracle_sql().items():
        got = queries.queries()[name](spark, "/root/testdata/sf0.01")
        cols = sorted(got.columns)
        want = con.execute(f"select {', '.join(cols)} from ({sql})").fetchall()
        assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(want, key=repr) and want, name
