"""SQL that gives the rows of the catalog's queries from the same tables in another engine."""

from __future__ import annotations

from ..functions import rules as R

_BLANK = r"\t\n\x0b\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_q = lambda s: "'" + s.replace("'", "''") + "'"
_list = lambda xs: ", ".join(map(_q, xs))
_any = lambda c, xs: "(" + " OR ".join(f"contains({c}, {_q(x)})" for x in xs) + ")"
_sum = lambda c, xs: "(" + " + ".join(f"CAST(contains({c}, {_q(x)}) AS INTEGER)" for x in xs) + ")"
_strip = lambda c: rf"regexp_replace({c}, '\A[{_BLANK}]+|[{_BLANK}]+\z', '', 'g')"
_one = lambda c: rf"regexp_replace({c}, '[{_BLANK}]+', ' ', 'g')"


def _clean(c: str) -> str:
    out = f"replace(replace(coalesce({c}, ''), chr(8203), ''), chr(65279), '')"
    for p, to in ((rf"Ошибка![{_BLANK}]*Закладка[{_BLANK}]*не[{_BLANK}]*опред[^\n]*", "' '"), (rf"Error![{_BLANK}]*Bookmark[{_BLANK}]*not[{_BLANK}]*defined[^\n]*", "' '")):
        out = f"regexp_replace({out}, '{p}', {to}, 'gi')"
    for p, to in ((r"\r\n?", "chr(10)"), (r"[ \t]+", "' '"), (r"\n[ \t]+", "chr(10)"), (r"\n{4,}", "chr(10) || chr(10) || chr(10)")):
        out = f"regexp_replace({out}, '{p}', {to}, 'g')"
    return _strip(out)


def _count(c: str, cls: str) -> str:
    return f"length(regexp_replace({c}, '[^{cls}]', '', 'g'))"


def _ratio(c: str, cls: str) -> str:
    return f"CASE WHEN length({c}) > 0 THEN ((CAST({_count(c, cls)} AS BIGINT) * 20000 + length({c})) // (2 * length({c}))) / 10000 ELSE 0.0 END"


def _language(c: str) -> str:
    s = f"lower({_clean(f'substr(coalesce({c}, {chr(39)*2}), 1, {R.LANGUAGE_SAMPLE})')})"
    return s


_LANG_CASE = f"""CASE WHEN length(s) < {R.LANGUAGE_LEAST} THEN 'unknown' WHEN {_sum('s', R.TEXT_UZ_LAT)} >= 2 THEN 'uz_lat'
 WHEN {_count('s', 'қўғҳ')} >= {R.UZ_CYR_LETTERS} OR {_sum('s', R.TEXT_UZ_CYR)} >= 2 THEN 'uz_cyr'
 WHEN {_count('s', 'а-яёқўғҳ')} > {_count('s', 'a-z')} THEN CASE WHEN {_sum('s', R.TEXT_RU)} >= {_sum('s', R.TEXT_UZ_CYR)} THEN 'ru' ELSE 'uz_cyr' END
 WHEN {_sum('s', R.TEXT_UZ_LAT)} >= 1 THEN 'uz_lat' ELSE 'unknown' END"""
_LETTER = "A-Za-zА-Яа-яЁёҚқЎўҒғҲҳ"
_W = r"\p{L}\p{M}\p{Nd}\p{Pc}\x{200c}\x{200d}"


def _codes(c: str) -> str:
    double = rf"regexp_replace(' ' || {c} || ' ', '([^{_W}])', '\1\1', 'g')"
    return rf"list_transform(regexp_extract_all({double}, '[^{_W}]([A-Za-zА-Яа-я]\p{{Nd}}{{2}}(?:\.\.\p{{Nd}}{{1,2}})?)[^{_W}]', 1), lambda x: upper(replace(x, '..', '.')))"


def _distinct(lst: str) -> str:
    """First occurrences in order."""
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


_P = f"""
src AS (SELECT source_path AS p, max(size_kb) AS kb FROM registry GROUP BY 1),
named AS (SELECT p, kb, string_split(p, '/')[-1] AS nm, substr(md5(p), 1, 1) AS h FROM src),
listing AS (SELECT CASE h WHEN '0' THEN left(p, length(p) - length(nm)) || '~$' || nm WHEN '1' THEN p || '.txt' WHEN '2' THEN left(p, length(p) - length(nm)) || 'рецензия ' || nm ELSE p END AS path,
  CAST(floor(coalesce(kb, 0.0) * 1024) AS BIGINT) AS length FROM named),
f0 AS (SELECT path, length, string_split(path, '/')[-1] AS filename, regexp_extract(string_split(path, '/')[-1], '(?s)^.+(\\.[^.]+)$', 1) AS suf,
  list_filter(string_split(CASE WHEN starts_with(path, 'data/raw_guidelines/') THEN substr(path, {len('data/raw_guidelines/') + 1}) ELSE path END, '/'), lambda x: x <> '') AS parts,
  replace(lower(path), '\\', '/') AS lp FROM listing),
f1 AS (SELECT *, lower(suf) AS extension, left(filename, length(filename) - length(suf)) AS stem, string_split(lp, '/')[-1] AS lf,
  CASE WHEN len(parts) >= 3 THEN parts[2:len(parts) - 1] ELSE [] END AS middle FROM f0),
f2 AS (SELECT *, list_transform(middle, lambda x: regexp_replace({_strip('lower(x)')}, '^[0-9{_BLANK}.+_-]+', '') IN ({_list(R.STOP_FOLDERS)})) AS stops FROM f1),
f3 AS (SELECT *, list_transform(CASE WHEN list_position(stops, true) > 0 THEN middle[1:list_position(stops, true) - 1] ELSE middle END, lambda x: {_one(_strip('x'))}) AS kept FROM f2),
feat AS (SELECT path, length, filename, extension, stem, coalesce({_one(_strip('parts[1]'))}, 'unknown_specialty') AS specialty,
  CASE WHEN len(kept) > 0 THEN array_to_string(kept, ' / ') ELSE stem END AS disease_path,
  CASE WHEN {_any('lp', R.STANDARD_MARKERS)} THEN 'standard' WHEN {_any('lp', R.PROTOCOL_MARKERS)} THEN 'protocol' ELSE 'unknown' END AS doc_type,
  CASE WHEN {_any('lf', R.PATH_RU)} THEN 'ru' WHEN {_any('lf', R.PATH_UZ_LAT)} THEN 'uz_lat' WHEN {_any('lf', R.PATH_UZ_CYR)} THEN 'uz_cyr' WHEN {_any('lp', R.PATH_RU)} THEN 'ru' WHEN {_any('lp', R.PATH_UZ_LAT)} THEN 'uz_lat'
   WHEN {_any('lp', R.PATH_UZ_CYR)} THEN 'uz_cyr' WHEN regexp_matches(lf, '[қўғҳ]') THEN 'uz_cyr' ELSE 'unknown' END AS language_hint,
  {_any('lp', R.REVIEW_MARKERS)} AS is_review, lower(stem) AS lstem, 'var_' || substr(md5(path), 1, 12) AS variant_id,
  extension IN ({_list(R.SUPPORTED)}) AND NOT starts_with(filename, '~$') AS is_supported FROM f3)"""


def _key() -> str:
    out = "lstem"
    for w in R.KEY_REMOVALS:
        out = f"replace({out}, {_q(w)}, ' ')"
    return _strip(_one(rf"regexp_replace({out}, '[\p{{Nd}}_().,\-–—]+', ' ', 'g')"))


_FEAT = f"{_P}, feats AS (SELECT *, CASE WHEN k <> '' THEN k ELSE lstem END AS file_key FROM (SELECT *, {_key()} AS k FROM feat))"
_INV = f"""{_FEAT},
ranked AS (SELECT *, row_number() OVER (ORDER BY string_split(path, '/')) AS ordinal FROM feats WHERE is_supported),
inv AS (SELECT *, 'inv_' || lpad(CAST(ordinal AS VARCHAR), CAST(greatest(6, length(CAST(ordinal AS VARCHAR))) AS INTEGER), '0') AS inventory_id, 'dc_' || substr(md5(specialty || '::' || disease_path), 1, 12) AS disease_class_id,
  'cd_' || substr(md5(specialty || '::' || disease_path || '::' || doc_type), 1, 12) AS clinical_doc_group_id, CASE extension WHEN '.docx' THEN 1 WHEN '.doc' THEN 2 WHEN '.pdf' THEN 3 ELSE 99 END AS priority,
  round(length / 1024, 2) AS size_kb FROM ranked WHERE NOT is_review)"""
_SEL = f"""{_INV},
w AS (SELECT *, bool_or(extension IN ('.docx', '.doc')) OVER (PARTITION BY disease_class_id, doc_type) AS has_word FROM inv),
v AS (SELECT *, has_word AND extension = '.pdf' AS bf, language_hint IN ({_list(R.REQUESTED_LANGUAGES)}) AS known FROM w),
r AS (SELECT *, row_number() OVER g AS rk, first_value(variant_id) OVER g AS best FROM v
  WINDOW g AS (PARTITION BY disease_class_id, doc_type, bf, language_hint, CASE WHEN NOT known THEN file_key END ORDER BY priority, size_kb DESC, path)),
sel AS (SELECT *, NOT bf AND rk = 1 AS selected, CASE WHEN bf THEN 'pdf_backfill_candidate_word_exists' WHEN rk > 1 THEN 'duplicate_of_' || best
  WHEN known THEN CASE WHEN has_word THEN 'word_primary' ELSE 'pdf_primary_no_word_available' END || '_best_for_language_' || language_hint
  ELSE CASE WHEN has_word THEN 'word_primary' ELSE 'pdf_primary_no_word_available' END || '_unknown_language_keep_for_content_detection' END AS selection_reason, path AS source_path FROM r)"""
_GRP = f"""{_SEL},
per AS (SELECT disease_class_id, doc_type, min(specialty) AS specialty, min(disease_path) AS disease_path, min(clinical_doc_group_id) AS cd, language_hint AS language, list(variant_id ORDER BY priority, path) AS ids,
  list(path ORDER BY priority, path) AS paths, list(replace(extension, '.', '') ORDER BY priority, path) AS fmts FROM sel WHERE selected GROUP BY disease_class_id, doc_type, language_hint),
langs AS (SELECT disease_class_id, doc_type, list(language ORDER BY language) AS ls FROM per GROUP BY 1, 2)"""

_QUEUE = """
files AS (SELECT DISTINCT source_path AS path FROM registry WHERE substr(md5(source_path), 1, 1) <> 'f'),
pdf AS (SELECT * FROM registry WHERE lower(source_extension) = '.pdf' OR coalesce(lower(source_format), '') = 'pdf'),
want AS (SELECT *, 'selected_pdf_docling_surya' AS ocr_reason, 'selected_pdf_source_missing' AS lost FROM pdf WHERE coalesce(selected, false)
  UNION ALL SELECT *, 'backfill_pdf_docling_surya', 'backfill_pdf_source_missing' FROM pdf WHERE selection_reason = 'pdf_backfill_candidate_word_exists'),
queue AS (SELECT DISTINCT ON (variant_id, source_path, ocr_reason) *, 'dq_' || substr(md5('docling_surya::' || variant_id || '::' || source_path), 1, 12) AS queue_id FROM want SEMI JOIN files ON want.source_path = files.path)"""

_ITEMS = r"""
docs AS (SELECT variant_id, arg_max(raw_text, row_id) AS raw_text FROM (SELECT variant_id, row_id, coalesce(raw_text, chr(1)) AS raw_text FROM parsed_docling) GROUP BY 1),
ln AS (SELECT variant_id, unnest(string_split(raw_text, chr(10))) AS line, unnest(range(0, len(string_split(raw_text, chr(10))))) AS i FROM docs WHERE raw_text <> chr(1)),
it0 AS (SELECT variant_id, CAST(i AS INTEGER) AS i, line, CAST(i // 5 + 1 AS INTEGER) AS page, CAST((i // 5) // 8 + 1 AS INTEGER) AS batch_no, CASE i % 6 WHEN 0 THEN 'picture' WHEN 1 THEN 'table' ELSE 'text' END AS kind FROM ln),
items AS (SELECT *, CASE WHEN kind = 'text' THEN line ELSE '' END AS text,
  CASE WHEN i % 6 <> 1 THEN '' WHEN i % 5 = 0 THEN E'| a | b |\n|---|---|\n| 1 | 2 |\n| 3 | 4 |' WHEN i % 5 = 1 THEN E'| a | b |\n| 1 | 2 | 3 |\n| 4 | 5 | 6 | 7 |' WHEN i % 5 = 2 THEN E'| only one column |\n| still only one |' WHEN i % 5 = 3 THEN '| a single row of a table |' ELSE '| a |' END AS markdown,
  CASE WHEN kind = 'picture' THEN CASE i % 4 WHEN 0 THEN 'chart' WHEN 2 THEN 'Схема' ELSE 'picture' END WHEN i % 7 = 2 THEN 'caption' ELSE kind END AS label,
  CAST((i % 4) * 64 AS DOUBLE) AS l, CAST(CASE WHEN i % 17 = 3 THEN (i % 4) * 64 ELSE i % 4 * 64 + 64 END AS DOUBLE) AS r, CAST(1024 - (i * 3 % 5) * 128 AS DOUBLE) AS t, CAST(1024 - (i * 3 % 5) * 128 - 64 AS DOUBLE) AS b FROM it0),
pages AS (SELECT variant_id, page, width_pts AS w, height_pts AS h, text_chars, coalesce(native_text, chr(1)) AS native_text FROM (SELECT *,
  row_number() OVER (PARTITION BY variant_id, page ORDER BY measured_at DESC NULLS LAST, width_pts DESC NULLS LAST, height_pts DESC NULLS LAST, text_chars DESC NULLS LAST, native_text DESC NULLS LAST) AS n FROM page_info WHERE page IS NOT NULL) WHERE n = 1),
boxed AS (SELECT items.*, w > 0 AND h > 0 AS sized, least(1.0, greatest(0.0, l / w)) AS x0, least(1.0, greatest(0.0, r / w)) AS x1, least(1.0, greatest(0.0, 1 - t / h)) AS y0, least(1.0, greatest(0.0, 1 - b / h)) AS y1 FROM items JOIN pages USING (variant_id, page)),
loc AS (SELECT * FROM boxed WHERE sized AND (x1 - x0) * (y1 - y0) > 0.00001),
bl0 AS (SELECT variant_id, batch_no, page, CAST(row_number() OVER (PARTITION BY variant_id, batch_no ORDER BY page, y0, x0, i) - 1 AS INTEGER) AS ord, CASE WHEN kind = 'picture' THEN 'pending_visual' ELSE kind END AS type, x0, y0, x1, y1, text, markdown, label,
  CASE WHEN kind = 'picture' THEN 'visual_needs_vlm' WHEN kind = 'text' THEN '' ELSE CASE i % 5 WHEN 0 THEN '' WHEN 1 THEN 'inconsistent_row_column_counts' WHEN 2 THEN 'table_has_fewer_than_2_columns' WHEN 3 THEN 'not_enough_markdown_table_rows' ELSE 'empty_or_short_table_markdown' END END AS reasons, false AS fallback FROM loc),
""" + f"""
fb AS (SELECT variant_id, page, {_clean("CASE WHEN native_text = chr(1) THEN '' ELSE native_text END")} AS nt FROM pages ANTI JOIN (SELECT DISTINCT variant_id, page FROM bl0) b USING (variant_id, page)),
bl1 AS (SELECT variant_id, page, ord, type, x0, y0, x1, y1, text, markdown, label, reasons, fallback FROM bl0 UNION ALL
  SELECT variant_id, page, 1073741824, CASE WHEN nt <> '' THEN 'text' ELSE 'pending_visual' END, 0.0, 0.0, 1.0, 1.0, nt, '', CASE WHEN nt <> '' THEN 'native_text_fallback' ELSE 'full_page_visual_fallback' END, CASE WHEN nt <> '' THEN '' ELSE 'page_without_blocks' END, true FROM fb),
bl AS (SELECT * EXCLUDE ord, CAST(row_number() OVER (PARTITION BY variant_id ORDER BY page, ord) - 1 AS INTEGER) AS ord FROM bl1),
blocks AS (SELECT *, printf('p%04d_b%06d', page, ord) AS block_id, {_clean("CASE WHEN text <> '' THEN text ELSE markdown END")} AS own, {_clean("CASE WHEN markdown <> '' THEN markdown ELSE text END")} AS body FROM bl),
rd AS (SELECT variant_id, page, ord, own, lower(label) AS lab, row_number() OVER (PARTITION BY variant_id, page ORDER BY ord) AS n FROM blocks WHERE type IN ('text', 'table')),
pos AS (SELECT b.*, coalesce((SELECT max(0)), 0) AS z, count(r.n) AS k FROM blocks b LEFT JOIN rd r ON r.variant_id = b.variant_id AND r.page = b.page AND r.ord < b.ord GROUP BY ALL),
ctx AS (SELECT p.*, b2.own AS b2, b1.own AS b1, b1.lab AS l1, a1.own AS a1, a1.lab AS m1, a2.own AS a2 FROM (SELECT *, CASE WHEN type IN ('text', 'table') THEN 1 ELSE 0 END AS me FROM pos) p
  LEFT JOIN rd b1 ON b1.variant_id = p.variant_id AND b1.page = p.page AND b1.n = p.k LEFT JOIN rd b2 ON b2.variant_id = p.variant_id AND b2.page = p.page AND b2.n = p.k - 1
  LEFT JOIN rd a1 ON a1.variant_id = p.variant_id AND a1.page = p.page AND a1.n = p.k + p.me + 1 LEFT JOIN rd a2 ON a2.variant_id = p.variant_id AND a2.page = p.page AND a2.n = p.k + p.me + 2)"""
_opens = lambda c: "(" + " OR ".join(f"starts_with(lower({c}), {_q(x)})" for x in R.CAPTION_OPENINGS) + ")"
_CTX = f"""{_ITEMS},
cx AS (SELECT variant_id, page, ord, type, label, reasons, block_id, x0, y0, x1, y1, markdown, text, substr({_clean("concat_ws(chr(10), b2, b1)")}, 1, {R.CONTEXT_CHARS}) AS before_text, substr({_clean("concat_ws(chr(10), a1, a2)")}, 1, {R.CONTEXT_CHARS}) AS after_text,
  substr(CASE WHEN b1 IS NOT NULL AND (contains(l1, 'caption') OR {_opens('b1')}) THEN b1 WHEN a1 IS NOT NULL AND (contains(m1, 'caption') OR {_opens('a1')}) THEN a1 ELSE '' END, 1, {R.CAPTION_CHARS}) AS caption FROM ctx)"""


def _visual(label: str, context: str) -> str:
    s = f"lower(coalesce({label}, '') || ' ' || {context})"
    return f"CASE WHEN {_any(s, R.FLOWCHART_WORDS)} THEN 'flowchart' WHEN {_any(s, R.CHART_WORDS)} THEN 'chart' WHEN {_any(s, R.TABLE_WORDS)} THEN 'complex_table' ELSE 'figure' END"


_FLAGS = f"""[CASE WHEN length(t) = 0 THEN 'empty_text' WHEN length(t) < {R.LOW_CHARS} THEN 'low_char_count' END, CASE WHEN lang = 'unknown' THEN 'unknown_detected_language' END,
 CASE WHEN {_count('t', '�')} > {R.REPLACEMENTS} THEN 'encoding_replacement_chars' END, CASE WHEN length(t) > {R.LOW_CHARS} AND {_count('t', _LETTER)} / length(t) < {R.LETTER_RATIO} THEN 'low_letter_ratio' END]"""
_compact = lambda lst: f"list_filter({lst}, lambda x: x IS NOT NULL)"
_N_BAD = r"CAST(len(regexp_extract_all(t, '\x{fffd}{3,}')) + len(regexp_extract_all(t, '[\x01-\x08\x0b\x0c\x0e-\x1f]')) + coalesce(list_sum(list_transform(list_filter(list_distinct(string_split(t, '')), lambda c: c <> '' AND c <> chr(10) AND contains(t, repeat(c, 21))), lambda c: len(regexp_extract_all(t, regexp_escape(c) || '{21,}')))), 0) AS INTEGER)"
_HAS_BAD = r"(regexp_matches(t, '\x{fffd}{3,}') OR regexp_matches(t, '[\x01-\x08\x0b\x0c\x0e-\x1f]') OR len(list_filter(list_distinct(string_split(t, '')), lambda c: c <> '' AND c <> chr(10) AND contains(t, repeat(c, 21)))) > 0)"
_RAW = f"""
txt AS (SELECT *, {_clean('raw_text')} AS t, {_language('raw_text')} AS s FROM parsed_guidelines_raw),
raw AS (SELECT *, {_LANG_CASE} AS auto FROM txt)"""
_MERGED = f"""
txt AS (SELECT *, {_clean('raw_text')} AS t FROM parsed_docling),
txt2 AS (SELECT *, {_language('t')} AS s FROM txt),
lg AS (SELECT *, CASE WHEN detected_language <> '' THEN detected_language ELSE {_LANG_CASE} END AS lang FROM txt2),
mg AS (SELECT row_id, variant_id, disease_class_id, clinical_doc_group_id, specialty, disease_path, doc_type, coalesce(nullif(source_path, ''), nullif(original_source_path, ''), nullif(ocr_input_path, '')) AS source_path,
  filename, size_kb, extraction_method, {', '.join(f"{c}" for c in ('markdown_path', 'agentic_json_path', 'raw_docling_dir', 'visual_manifest_path', 'visual_assets_dir', 'elapsed_seconds', 'ocr_reason', 'ocr_input_path'))}, coalesce(visual_asset_count, 0) AS visual_asset_count, coalesce(docling_batch_count, 0) AS docling_batch_count,
  coalesce(language_hint, 'unknown') AS language_hint, lang AS detected_language, CASE WHEN lang <> 'unknown' THEN lang ELSE coalesce(language_hint, 'unknown') END AS final_language, length(t) AS char_count,
  list_sort(list_distinct(list_concat(coalesce(quality_flags, []), {_compact(_FLAGS)}, {_compact("[CASE WHEN coalesce(pending_visual_count, 0) > 0 THEN 'pending_visual_assets' END, CASE WHEN coalesce(docling_batch_failed_count, 0) > 0 THEN 'docling_batch_errors' END]")}))) AS flags,
  coalesce(pending_visual_count, 0) AS pending_visual_count, coalesce(docling_batch_failed_count, 0) AS docling_batch_failed_count, coalesce(page_count, 0) AS page_count,
  CASE WHEN len(icd_codes_detected) > 0 THEN icd_codes_detected ELSE {_distinct('cs')} END AS codes, t FROM (SELECT *, {_codes('t')} AS cs FROM lg))"""
_ART = """
named AS (SELECT unnest([markdown_path, agentic_json_path, raw_docling_dir, visual_manifest_path]) AS path FROM parsed_guidelines_raw UNION ALL SELECT crop_path FROM visual_manifest),
art AS (SELECT DISTINCT path FROM named WHERE path <> '' AND substr(md5(path), 1, 1) <> 'f'),
mf AS (SELECT variant_id, count(*) AS manifest_rows, count(*) FILTER (WHERE art.path IS NULL) AS missing_crops FROM visual_manifest m LEFT JOIN art ON m.crop_path = art.path GROUP BY 1)"""
_has = lambda c: f"coalesce({c} IN (SELECT path FROM art), false)"
_REPORT = f"""{_RAW}, {_ART},
rep0 AS (SELECT r.* EXCLUDE (detected_language), CASE WHEN detected_language <> '' THEN detected_language ELSE auto END AS lang, {_codes('t')} AS cs, manifest_rows, missing_crops, coalesce(pending_visual_count, 0) AS pend, {_has('visual_manifest_path')} AS hm,
  {_has('markdown_path')} AS h1, {_has('agentic_json_path')} AS h2, {_has('raw_docling_dir')} AS h3 FROM raw r LEFT JOIN mf USING (variant_id)),
rep1 AS (SELECT *, {_distinct('cs')} AS codes, list_concat(coalesce(quality_flags, []), {_compact(_FLAGS)}, {_compact(f'''[
  CASE WHEN source_format IS DISTINCT FROM 'pdf' THEN 'non_pdf_row_in_pdf_only_validation' END, CASE WHEN length(t) < 500 THEN 'needs_review_char_count_below_min' END, CASE WHEN len(cs) = 0 THEN 'needs_review_no_icd_codes_detected' END,
  CASE WHEN {_HAS_BAD} THEN 'needs_review_bad_text_patterns' END, CASE WHEN length(t) > 500 AND {_ratio('t', _LETTER)} < 0.25 THEN 'needs_review_low_letter_ratio' END,
  CASE WHEN coalesce(final_language, '') = 'unknown' OR lang = 'unknown' THEN 'needs_review_unknown_language' END, CASE WHEN NOT h1 THEN 'missing_markdown_output' END, CASE WHEN NOT h2 THEN 'missing_agentic_json_output' END, CASE WHEN NOT h3 THEN 'missing_raw_docling_dir' END,
  CASE WHEN pend > 0 THEN 'pending_visual_assets' END, CASE WHEN pend > 0 AND NOT hm THEN 'missing_visual_manifest' END, CASE WHEN pend > 0 AND hm AND coalesce(manifest_rows, 0) <> pend THEN 'visual_manifest_count_mismatch' END,
  CASE WHEN pend > 0 AND hm AND coalesce(missing_crops, 0) > 0 THEN 'missing_visual_crop_files' END, CASE WHEN coalesce(docling_batch_failed_count, 0) > 0 THEN 'docling_batch_failures' END, CASE WHEN coalesce(page_count, 0) <= 0 THEN 'missing_page_count' END]''')}) AS fl FROM rep0),
report AS (SELECT *, {_distinct('fl')} AS flags FROM rep1)"""
_CAND = """
cand AS (SELECT CAST(row_id AS VARCHAR) AS variant_id, m.* FROM (SELECT row_id, unnest([
  {'method': 'first', 'rk': 1, 'text': CASE WHEN row_id % 3 = 0 THEN left(raw_text, length(raw_text) // 2) ELSE raw_text END, 'ok': true}, {'method': 'second', 'rk': 2, 'text': raw_text, 'ok': row_id % 2 = 0},
  {'method': 'third', 'rk': 3, 'text': raw_text || CASE WHEN row_id % 5 = 0 THEN 'x' ELSE '' END, 'ok': row_id % 7 <> 0}]) AS m FROM parsed_guidelines_raw WHERE raw_text IS NOT NULL))"""

_VIS = "(type = 'pending_visual' OR type = 'table' AND reasons <> '')"
_KIND = f"""CASE WHEN type = 'table' THEN 'complex_table' ELSE {_visual('label', "concat_ws(' ', caption, before_text, after_text)")} END"""
_BROKEN = "substr(md5({v} || '_' || {b}), 1, 1) = '0'"
_PDF = f"""{_ITEMS.replace('b FROM it0)', f"b FROM it0 WHERE NOT {_BROKEN.format(v='variant_id', b='batch_no')})")},
que AS (SELECT variant_id, source_path, doc_type, language_hint FROM (SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY ingested_at DESC NULLS LAST, row_id DESC) AS n FROM parsed_docling) WHERE n = 1),
cnt AS (SELECT variant_id, CAST(count(*) AS INTEGER) AS np FROM pages GROUP BY 1),
fail AS (SELECT DISTINCT variant_id, CAST((page - 1) // 8 + 1 AS INTEGER) AS batch_no FROM pages WHERE {_BROKEN.format(v='variant_id', b='CAST((page - 1) // 8 + 1 AS INTEGER)')}),
txts AS (SELECT variant_id, {_clean('string_agg(body, chr(10) || chr(10) ORDER BY page, ord)')} AS t FROM blocks WHERE type IN ('text', 'table') AND body <> '' GROUP BY 1),
vis AS (SELECT variant_id, CAST(count(*) AS INTEGER) AS nv FROM blocks WHERE {_VIS} GROUP BY 1),
fl AS (SELECT variant_id, CAST(count(*) AS INTEGER) AS nf FROM fail GROUP BY 1),
r0 AS (SELECT que.*, np, CAST(ceil(np / 8) AS INTEGER) AS nb, coalesce(nv, 0) AS nv, coalesce(nf, 0) AS nf, coalesce(t, '') AS t, {_language('t')} AS s FROM que JOIN cnt USING (variant_id) LEFT JOIN txts USING (variant_id) LEFT JOIN vis USING (variant_id) LEFT JOIN fl USING (variant_id)),
r1 AS (SELECT *, {_LANG_CASE} AS lang, {_codes('t')} AS cs FROM r0),
rec AS (SELECT *, list_sort(list_distinct(list_concat({_compact(_FLAGS)}, {_compact("[CASE WHEN nf > 0 THEN 'docling_batch_errors' END, CASE WHEN nv > 0 THEN 'pending_visual_assets' END, CASE WHEN length(t) < 500 THEN 'pdf_low_char_count' END]")}))) AS flags FROM r1)"""
_WORD_FLAGS = "[CASE WHEN length(t) < 500 THEN 'low_char_count' END, CASE WHEN native_error IS NOT NULL THEN 'native_extraction_error' END, CASE WHEN docling_error IS NOT NULL THEN 'docling_extraction_error' END]"
_WORD = f"""
wr AS (SELECT CAST(row_id AS VARCHAR) AS variant_id, source_path, CASE WHEN row_id % 4 = 0 THEN 'doc' ELSE 'docx' END AS source_format, language_hint FROM parsed_guidelines_raw),
wc AS (SELECT CAST(row_id AS VARCHAR) AS variant_id, {_clean('CASE WHEN row_id % 3 = 0 THEN left(raw_text, length(raw_text) // 2) ELSE raw_text END')} AS t1, {_clean('raw_text')} AS t2, {_clean("raw_text || CASE WHEN row_id % 5 = 0 THEN ' x' ELSE '' END")} AS t3,
  row_id % 11 <> 0 AS o1, row_id % 2 = 0 AS o2, row_id % 7 <> 0 AS o3 FROM parsed_guidelines_raw WHERE raw_text IS NOT NULL),
w1 AS (SELECT *, CASE WHEN o1 THEN length(t1) ELSE -1 END AS n1, CASE WHEN o2 THEN length(t2) ELSE -1 END AS n2, CASE WHEN o3 THEN length(t3) ELSE -1 END AS n3 FROM wc),
w2 AS (SELECT *, CASE WHEN n1 < 0 AND n2 < 0 THEN NULL WHEN n1 >= n2 THEN 'first' ELSE 'second' END AS native_method, greatest(n1, n2, 0) AS native_char_count, greatest(n3, 0) AS docling_char_count, 'first=' || n1 || ',second=' || n2 AS extractor_stats,
  CASE WHEN NOT o2 THEN 'broken second' WHEN NOT o1 THEN 'broken first' END AS any_ne, CASE WHEN NOT o3 THEN 'broken third' END AS any_de FROM w1),
w3 AS (SELECT *, CASE WHEN native_char_count > 0 AND native_char_count >= docling_char_count THEN 'native' WHEN docling_char_count > 0 THEN 'docling' END AS extraction_source, CASE WHEN native_method IS NULL THEN any_ne END AS native_error, any_de AS docling_error FROM w2),
w35 AS (SELECT *, CASE extraction_source WHEN 'native' THEN native_method WHEN 'docling' THEN 'third' END AS method, CASE WHEN extraction_source = 'native' THEN CASE native_method WHEN 'first' THEN t1 ELSE t2 END WHEN extraction_source = 'docling' THEN t3 END AS t FROM w3),
w37 AS (SELECT *, {_language('t')} AS s FROM wr LEFT JOIN w35 USING (variant_id)),
w4 AS (SELECT *, {_LANG_CASE} AS lang FROM w37)"""


def oracle_sql() -> dict[str, str]:
    sel = lambda cols, where: f"WITH {_SEL} SELECT {cols} FROM sel WHERE {where}"
    return {
        "path_features": f"WITH {_FEAT} SELECT path, filename, extension, stem, specialty, disease_path, doc_type, language_hint, is_review, file_key, variant_id, is_supported FROM feats",
        "inventory_ids": f"WITH {_INV} SELECT inventory_id, variant_id, path AS source_path, disease_class_id, clinical_doc_group_id, priority, size_kb FROM inv",
        "select_variants": sel("variant_id, disease_class_id, doc_type, language_hint, extension AS source_extension, source_path, selected, selection_reason", "true"),
        "selected_order": f"WITH {_SEL} SELECT row_number() OVER (ORDER BY specialty, disease_path, doc_type, language_hint, priority, source_path) AS ordinal, variant_id FROM sel WHERE selected",
        "pdf_backfill": sel("variant_id, source_path, selection_reason", "bf"),
        "rejected_duplicates": sel("variant_id, source_path, selection_reason", "starts_with(selection_reason, 'duplicate_of_')"),
        "skipped_files": f"WITH {_FEAT} SELECT path, extension, CASE WHEN starts_with(filename, '~$') THEN 'temporary_word_lock_file' WHEN NOT is_supported THEN 'unsupported_extension' ELSE 'review_or_expert_document' END AS skip_reason FROM feats WHERE NOT is_supported OR is_review",
        "registry_grouped": f"WITH {_GRP} SELECT disease_class_id, doc_type, specialty, disease_path, array_to_string(ls, ',') AS languages, language, array_to_string(ids, ',') AS variant_ids FROM per JOIN langs USING (disease_class_id, doc_type)",
        "fallback_plan": f"""WITH {_GRP}, want AS (SELECT disease_class_id, doc_type, unnest(['ru', 'uz_cyr', 'uz_lat']) AS requested_language, ls FROM langs),
            res AS (SELECT *, CASE WHEN list_contains(ls, requested_language) THEN requested_language ELSE list_filter([{_list(R.FALLBACK_ORDER)}], lambda x: list_contains(ls, x))[1] END AS resolved_language FROM want)
            SELECT disease_class_id, cd AS clinical_doc_group_id, specialty, disease_path, doc_type, requested_language, resolved_language, CASE WHEN requested_language = resolved_language THEN 'exact' ELSE 'fallback' END AS fallback_type,
            ids[1] AS resolved_variant_id, fmts[1] AS resolved_source_format, paths[1] AS resolved_source_path FROM res JOIN per USING (disease_class_id, doc_type) WHERE per.language = resolved_language""",
        "registry_counters": f"""WITH {_SEL}, c AS (SELECT unnest([{{'counter': 'language_hint', 'key': language_hint}}, {{'counter': 'source_format', 'key': replace(extension, '.', '')}}, {{'counter': 'doc_type', 'key': doc_type}}, {{'counter': 'specialty', 'key': specialty}},
            {{'counter': 'reason_kind', 'key': regexp_replace(selection_reason, '^duplicate_of_.*', 'duplicate')}}]) AS x FROM sel) SELECT x.counter AS counter, x.key AS key, count(*) AS n FROM c GROUP BY 1, 2""",
        "registry_summary": f"WITH {_SEL} SELECT count(*) AS inventory_rows, count(*) FILTER (WHERE selected) AS selected_rows, count(*) FILTER (WHERE bf) AS backfill_rows, count(*) FILTER (WHERE starts_with(selection_reason, 'duplicate_of_')) AS duplicate_rows, count(DISTINCT disease_class_id || doc_type) AS documents FROM sel",
        "ocr_queue": f"WITH {_QUEUE} SELECT queue_id, variant_id, ocr_reason, source_path AS ocr_input_path, coalesce(source_format, 'pdf') AS original_source_format FROM queue",
        "queue_failures": f"WITH {_QUEUE} SELECT variant_id, lost AS reason, count(*) AS n FROM want ANTI JOIN files ON want.source_path = files.path GROUP BY 1, 2",
        "queue_only_backfill": f"WITH {_QUEUE} SELECT queue_id, variant_id FROM queue WHERE starts_with(ocr_reason, 'backfill')",
        "resume_antijoin": f"WITH {_QUEUE} SELECT queue_id, variant_id FROM queue WHERE variant_id NOT IN (SELECT variant_id FROM parsed_docling WHERE variant_id IS NOT NULL UNION ALL SELECT variant_id FROM parsed_guidelines_raw WHERE variant_id IS NOT NULL)",
        "queue_top": f"WITH {_QUEUE} SELECT variant_id, ocr_reason FROM queue ORDER BY source_path, ocr_reason LIMIT 100 OFFSET 10",
        "clean_text_hash": f"WITH {_RAW} SELECT row_id, length(t) AS n, md5(t) AS clean_md5, md5(substr({_one('lower(t)')}, 1, {R.HASH_CHARS})) AS text_hash FROM raw",
        "language_detect": f"WITH {_RAW} SELECT row_id, auto AS language FROM raw",
        "quality_flags": f"WITH {_RAW} SELECT row_id, array_to_string({_compact(_FLAGS)}, ',') AS flags FROM (SELECT *, auto AS lang FROM raw)",
        "icd_codes": f"WITH {_RAW}, c AS (SELECT *, {_codes('t')} AS cs FROM raw) SELECT row_id, array_to_string({_distinct('cs')}, ',') AS codes, {_any('lower(coalesce(raw_text, chr(32)))', R.CODE_MARKERS)} AS has_marker FROM c",
        "char_counts": f"WITH {_RAW} SELECT row_id, length(t) AS n, {_count('t', _LETTER)} AS letter_count, {_count('t', chr(92) + 'p{Nd}')} AS digit_count, {_count('t', 'А-Яа-яЁёҚқЎўҒғҲҳ')} AS cyrillic_count, {_count('t', 'A-Za-z')} AS latin_count FROM raw",
        "char_ratios": f"WITH {_RAW} SELECT row_id, {_ratio('t', _LETTER)} AS letter_ratio, {_ratio('t', chr(92) + 'p{Nd}')} AS digit_ratio, {_ratio('t', 'А-Яа-яЁёҚқЎўҒғҲҳ')} AS cyrillic_ratio, {_ratio('t', 'A-Za-z')} AS latin_ratio FROM raw",
        "bad_patterns": f"WITH {_RAW} SELECT row_id, {_N_BAD} AS n FROM raw",
        "table_quality": f"""WITH l AS (SELECT row_id, list_filter(string_split(raw_text, chr(10)), lambda x: contains(x, '|')) AS ls FROM parsed_guidelines_raw WHERE contains(raw_text, '|')),
            b AS (SELECT row_id, ls, list_transform(list_filter(list_transform(ls, lambda x: regexp_replace({_strip('x')}, '^\\|+|\\|+$', '', 'g')), lambda x: regexp_replace(x, '[|\\-:{_BLANK}]', '', 'g') <> ''), lambda x: len(string_split(x, '|'))) AS n FROM l),
            m AS (SELECT *, list_sort(list_transform(list_distinct(n), lambda v: {{'c': -len(list_filter(n, lambda x: x = v)), 'v': v}}))[1] AS top FROM b)
            SELECT row_id, CASE WHEN length({_strip('array_to_string(ls, chr(10))')}) < 20 THEN 'empty_or_short_table_markdown' WHEN len(ls) < 2 THEN 'not_enough_markdown_table_rows' WHEN len(n) = 0 THEN 'no_usable_table_cells'
            ELSE concat_ws(',', CASE WHEN top.v < 2 THEN 'table_has_fewer_than_2_columns' END, CASE WHEN -top.c / len(n) < 0.75 THEN 'inconsistent_row_column_counts' END) END AS reasons FROM m""",
        "visual_types": f"SELECT DISTINCT asset_id, {_visual('suggested_type', chr(39) + ' ' + chr(39) + ' || concat_ws(' + chr(39) + ' ' + chr(39) + ', caption, before_text, after_text)')} AS kind FROM visual_manifest",
        "page_measures": "SELECT variant_id, page, width_pts, height_pts FROM (SELECT *, row_number() OVER (PARTITION BY variant_id, page ORDER BY measured_at DESC NULLS LAST, width_pts DESC NULLS LAST, height_pts DESC NULLS LAST, text_chars DESC NULLS LAST, native_text DESC NULLS LAST) AS n FROM page_info WHERE page IS NOT NULL) WHERE n = 1",
        "document_class": """WITH p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY variant_id, page ORDER BY measured_at DESC NULLS LAST, width_pts DESC NULLS LAST, height_pts DESC NULLS LAST, text_chars DESC NULLS LAST) AS n FROM page_info WHERE page IS NOT NULL) WHERE n = 1),
            a AS (SELECT variant_id, count(*) AS pages, count(*) FILTER (WHERE coalesce(text_chars, 0) < 30) AS scanned_pages FROM p GROUP BY 1) SELECT *, CASE WHEN scanned_pages / pages > 0.7 THEN 'scanned' WHEN scanned_pages / pages > 0.1 THEN 'mixed' ELSE 'digital' END AS document_class FROM a""",
        "block_order": f'WITH {_ITEMS} SELECT variant_id, batch_no, page, ord AS "order", type, x0, y0, reasons FROM bl0',
        "page_fallback": f"WITH {_ITEMS} SELECT variant_id, page, block_id, type, label FROM blocks WHERE fallback",
        "neighbor_context": f"WITH {_CTX} SELECT variant_id, block_id, md5(before_text) AS before_md5, md5(after_text) AS after_md5, md5(caption) AS caption_md5 FROM cx",
        "visual_manifest": f"""WITH {_CTX} SELECT variant_id AS doc_id, variant_id, variant_id || '_' || block_id AS asset_id, page, ord AS "order", block_id, {_KIND} AS suggested_type, x0, y0, x1, y1, 'data/pdf_visual_assets/' || variant_id || '/crops/' || variant_id || '_' || block_id || '.png' AS crop_path,
            md5(caption) AS caption_md5, md5(before_text) AS before_text_md5, md5(after_text) AS after_text_md5, 'pending_vlm' AS status FROM cx WHERE {_VIS}""",
        "visual_blocks": f"""WITH {_CTX}, im AS (SELECT variant_id, page, CASE WHEN g = '0' THEN 0 ELSE 1000 END AS iw, 1400 AS ih FROM (SELECT *, substr(md5(variant_id || '/' || page), 1, 1) AS g FROM pages) WHERE g < 'c'),
            c AS (SELECT cx.*, iw IS NOT NULL AS there, greatest(0, CAST(trunc(x0 * iw) AS INTEGER) - 12) AS cl, greatest(0, CAST(trunc(y0 * ih) AS INTEGER) - 12) AS ct, least(iw, CAST(trunc(x1 * iw) AS INTEGER) + 12) AS cr, least(ih, CAST(trunc(y1 * ih) AS INTEGER) + 12) AS cb FROM cx LEFT JOIN im USING (variant_id, page) WHERE {_VIS}),
            m AS (SELECT *, there AND cr > cl AND cb > ct AS made FROM c)
            SELECT variant_id, block_id, type, true AS needs_review, made AS needs_vlm, array_to_string(CASE WHEN made THEN list_sort(list_append(CASE WHEN reasons = '' THEN [] ELSE string_split(reasons, ',') END, 'visual/table crop exported for later VLM enrichment')) ELSE list_append(string_split(reasons, ','), CASE WHEN there THEN 'visual_crop_failed' ELSE 'page_image_missing_for_visual_crop' END) END, ',') AS reasons,
            CASE WHEN made THEN variant_id || '_' || block_id END AS asset_id, CASE WHEN made THEN cl END AS crop_left, CASE WHEN made THEN ct END AS crop_top, CASE WHEN made THEN cr END AS crop_right, CASE WHEN made THEN cb END AS crop_bottom FROM m""",
        "raw_text_assembly": f"WITH {_ITEMS} SELECT variant_id, md5({_clean('string_agg(body, chr(10) || chr(10) ORDER BY page, ord)')}) AS text_md5 FROM blocks WHERE type IN ('text', 'table') AND body <> '' GROUP BY 1",
        "markdown_assembly": f"""WITH {_CTX}, m AS (SELECT variant_id, page, ord, concat_ws(chr(10) || chr(10), CASE WHEN row_number() OVER (PARTITION BY variant_id, page ORDER BY ord) = 1 THEN chr(10) || chr(10) || '<!-- page ' || page || ' -->' || chr(10) END,
            CASE WHEN type = 'pending_visual' THEN '[PENDING_VISUAL asset_id=' || variant_id || '_' || block_id || ' type=' || {_KIND} || ']' ELSE nullif({_strip("CASE WHEN markdown <> '' THEN markdown ELSE text END")}, '') END) AS p FROM cx)
            SELECT variant_id, md5({_clean('string_agg(p, chr(10) || chr(10) ORDER BY page, ord)')}) AS markdown_md5 FROM m WHERE p <> '' GROUP BY 1""",
        "page_nesting": f"WITH {_ITEMS}, pg AS (SELECT variant_id, page, count(*) AS n, string_agg(block_id, ',' ORDER BY ord) AS ids FROM blocks GROUP BY 1, 2) SELECT variant_id, CAST(count(*) AS INTEGER) AS n_pages, CAST(sum(n) AS INTEGER) AS n_blocks, md5(string_agg(page || ':' || ids, ';' ORDER BY page)) AS ids_md5 FROM pg GROUP BY 1",
        "page_scan": f"WITH {_ITEMS} SELECT variant_id, page, width_pts, height_pts, length(s) AS text_chars, length(s) < {R.SCANNED_PAGE} AS is_scanned_like FROM (SELECT variant_id, page, w AS width_pts, h AS height_pts, CASE WHEN native_text = chr(1) THEN '' ELSE {_strip('native_text')} END AS s FROM pages)",
        "parsed_pdf": f"""WITH {_PDF} SELECT variant_id, source_path, doc_type, language_hint, lang AS detected_language, 'agentic_pdf_docling_surya_deferred_vlm' AS extraction_method, array_to_string(flags, ',') AS flags, 'data/parsed_docling/' || variant_id || '/document.md' AS markdown_path,
            'data/parsed_pdf_agentic/' || variant_id || '/agentic.json' AS agentic_json_path, 'data/parsed_pdf_docling_raw/' || variant_id AS raw_docling_dir, 'data/pdf_visual_assets/' || variant_id || '/visual_manifest.jsonl' AS visual_manifest_path, 'data/pdf_visual_assets/' || variant_id AS visual_assets_dir,
            nv AS pending_visual_count, nv AS visual_asset_count, nb AS docling_batch_count, nf AS docling_batch_failed_count, np AS page_count, length(t) AS char_count, array_to_string({_distinct('cs')}, ',') AS codes, md5(t) AS text_md5 FROM rec""",
        "pdf_batches": f"WITH {_PDF}, s AS (SELECT variant_id, np, unnest(range(0, np, 8)) AS s FROM cnt) SELECT s.variant_id, CAST(s // 8 + 1 AS INTEGER) AS batch_no, CAST(s + 1 AS INTEGER) AS first_page, CAST(least(s + 8, np) AS INTEGER) AS last_page, CASE WHEN f.batch_no IS NULL THEN 'ok' ELSE 'failed' END AS status FROM s LEFT JOIN fail f ON f.variant_id = s.variant_id AND f.batch_no = s // 8 + 1",
        "pdf_summary": f"WITH {_PDF} SELECT (SELECT count(*) FROM que) AS ocr_rows_considered, (SELECT count(*) FROM rec) AS parsed_ok, CAST((SELECT coalesce(sum(length(t)), 0) FROM rec) AS BIGINT) AS total_chars, (SELECT count(*) FROM que ANTI JOIN cnt USING (variant_id)) AS failed, (SELECT count(*) FROM blocks WHERE {_VIS}) AS total_visual_assets_manifest",

        "bbox_normalize": f"WITH {_ITEMS} SELECT variant_id, i AS item_seq, CASE WHEN sized THEN x0 END AS x0, CASE WHEN sized THEN y0 END AS y0, CASE WHEN sized THEN x1 END AS x1, CASE WHEN sized THEN y1 END AS y1, CASE WHEN sized THEN greatest(0.0, x1 - x0) * greatest(0.0, y1 - y0) END AS area FROM boxed",
        "crop_box": """SELECT asset_id, l AS "left", t AS "top", r AS "right", b AS "bottom" FROM (SELECT asset_id, CASE WHEN ok THEN l END AS l, CASE WHEN ok THEN t END AS t, CASE WHEN ok THEN r END AS r, CASE WHEN ok THEN b END AS b FROM (SELECT *, r > l AND b > t AS ok FROM (
            SELECT asset_id, greatest(0, CAST(trunc(bbox.x0 * w) AS INTEGER) - 12) AS l, greatest(0, CAST(trunc(bbox.y0 * h) AS INTEGER) - 12) AS t, least(w, CAST(trunc(bbox.x1 * w) AS INTEGER) + 12) AS r, least(h, CAST(trunc(bbox.y1 * h) AS INTEGER) + 12) AS b
            FROM (SELECT DISTINCT *, 800 + page % 7 * 100 AS w, 1100 + page % 5 * 100 AS h FROM visual_manifest WHERE bbox IS NOT NULL))))""",
        "page_batches": "SELECT row_id, CAST(s // 8 + 1 AS INTEGER) AS batch_no, CAST(s + 1 AS INTEGER) AS first_page, CAST(least(s + 8, page_count) AS INTEGER) AS last_page FROM (SELECT row_id, page_count, unnest(range(0, page_count, 8)) AS s FROM parsed_docling WHERE page_count > 0)",
        "merge_normalize": f"WITH {_MERGED} SELECT row_id, variant_id, disease_class_id, clinical_doc_group_id, specialty, disease_path, doc_type, source_path, 'pdf' AS source_format, '.pdf' AS source_extension, filename, size_kb, 'pdf_agentic_docling_surya' AS extraction_source, extraction_method, markdown_path, agentic_json_path, raw_docling_dir, visual_manifest_path, visual_assets_dir, visual_asset_count, docling_batch_count, elapsed_seconds, ocr_reason, ocr_input_path, language_hint, detected_language, final_language, char_count, array_to_string(flags, ',') AS quality_flags, pending_visual_count, docling_batch_failed_count, page_count, array_to_string(codes, ',') AS icd_codes_detected, CAST(len(codes) AS INTEGER) AS icd_code_count, md5(t) AS raw_text FROM mg",
        "merge_missing": f"WITH {_MERGED} SELECT variant_id, source_path, 'low_char_count' AS reason, char_count FROM mg WHERE char_count < 500",
        "merge_grouped": f"""WITH {_MERGED}, p AS (SELECT disease_class_id, doc_type, coalesce(nullif(final_language, ''), 'unknown') AS language, string_agg(concat_ws('/', row_id, variant_id, char_count, detected_language, array_to_string(flags, '+')), ',' ORDER BY row_id) AS rows FROM mg GROUP BY 1, 2, 3),
            g AS (SELECT disease_class_id, doc_type, arg_max(struct_pack(sp := specialty, cd := clinical_doc_group_id), row_id) AS x FROM mg GROUP BY 1, 2), l AS (SELECT disease_class_id, doc_type, string_agg(language, ',' ORDER BY language) AS languages FROM p GROUP BY 1, 2)
            SELECT p.disease_class_id, p.doc_type, x.sp AS specialty, x.cd AS clinical_doc_group_id, languages, language, p.rows FROM p JOIN g ON p.disease_class_id IS NOT DISTINCT FROM g.disease_class_id AND p.doc_type IS NOT DISTINCT FROM g.doc_type
            JOIN l ON p.disease_class_id IS NOT DISTINCT FROM l.disease_class_id AND p.doc_type IS NOT DISTINCT FROM l.doc_type""",
        "merge_flag_counts": f"WITH {_MERGED} SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM mg) GROUP BY 1",
        "merge_summary": f"WITH {_MERGED} SELECT count(*) AS rows, count(*) FILTER (WHERE char_count >= 500) AS usable_rows, CAST(sum(char_count) AS BIGINT) AS total_char_count, CAST(sum(pending_visual_count) AS BIGINT) AS total_pending_visual_count, count(*) FILTER (WHERE docling_batch_failed_count > 0) AS rows_with_failed_batches, round(sum(elapsed_seconds) / count(elapsed_seconds), 3) AS avg_seconds FROM mg",
        "merge_latest": "SELECT variant_id, row_id FROM (SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY ingested_at DESC NULLS LAST, row_id DESC) AS n FROM parsed_docling) WHERE n = 1",
        "quality_report": f"""WITH {_REPORT} SELECT row_id, variant_id, disease_class_id, clinical_doc_group_id, specialty, disease_path, doc_type, source_path, source_format, extraction_source, extraction_method, language_hint, {_ratio('t', _LETTER)} AS letter_ratio, {_ratio('t', chr(92) + 'p{Nd}')} AS digit_ratio, {_ratio('t', 'А-Яа-яЁёҚқЎўҒғҲҳ')} AS cyrillic_ratio, {_ratio('t', 'A-Za-z')} AS latin_ratio,
            {_N_BAD} AS bad_pattern_count, visual_asset_count, docling_batch_count, docling_batch_failed_count, markdown_path, agentic_json_path, raw_docling_dir, visual_manifest_path, lang AS detected_language, coalesce(nullif(final_language, ''), lang) AS final_language, 'raw_text' AS validation_text_source, length(t) AS char_count, page_count, CAST(len(codes) AS INTEGER) AS icd_code_count,
            array_to_string(codes[1:50], ', ') AS icd_codes_detected, pending_visual_count, CAST(len(flags) AS INTEGER) AS review_flag_count, array_to_string(flags, '; ') AS review_flags, len(flags) > 0 AS needs_review FROM report""",
        "needs_review": f"WITH {_REPORT} SELECT row_id, array_to_string(flags, '; ') AS review_flags FROM report WHERE len(flags) > 0",
        "flag_ranking": f"WITH {_REPORT} SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM report) GROUP BY 1",
        "duplicate_texts": f"WITH {_RAW}, h AS (SELECT *, md5(substr({_one('lower(t)')}, 1, {R.HASH_CHARS})) AS text_hash FROM raw WHERE length(raw_text) >= {R.DUPLICATE_LEAST}) SELECT row_id, text_hash, duplicate_group_size, variant_id, final_language, char_count FROM (SELECT *, count(*) OVER (PARTITION BY text_hash) AS duplicate_group_size FROM h) WHERE duplicate_group_size > 1",
        "manifest_check": f"WITH {_ART} SELECT row_id, coalesce(pending_visual_count, 0) AS pending, coalesce(manifest_rows, 0) AS manifest_rows, coalesce(missing_crops, 0) AS missing_crops FROM parsed_guidelines_raw LEFT JOIN mf USING (variant_id)",
        "visual_review": f'''WITH {_ART} SELECT m.variant_id, p.source_path, asset_id, page, order_no AS "order", suggested_type, m.crop_path, art.path IS NOT NULL AS crop_exists, status, caption FROM visual_manifest m JOIN (SELECT DISTINCT variant_id, source_path FROM parsed_guidelines_raw) p USING (variant_id) LEFT JOIN art ON m.crop_path = art.path''',
        "validation_summary": f"""WITH {_REPORT}, h AS (SELECT md5(substr({_one('lower(t)')}, 1, {R.HASH_CHARS})) AS text_hash FROM raw WHERE length(raw_text) >= {R.DUPLICATE_LEAST})
            SELECT (SELECT count(*) FROM report) AS total_rows, (SELECT count(*) FROM report WHERE len(flags) > 0) AS needs_review_total, CAST((SELECT sum(length(t)) FROM report) AS BIGINT) AS total_chars,
            (SELECT count(*) FROM visual_manifest m JOIN (SELECT DISTINCT variant_id, source_path FROM parsed_guidelines_raw) p USING (variant_id)) AS visual_asset_total, (SELECT count(*) FROM (SELECT text_hash FROM h GROUP BY 1 HAVING count(*) > 1)) AS duplicate_groups""",
        "queue_summary": f"WITH {_QUEUE} SELECT count(*) AS queue_total, count(*) FILTER (WHERE ocr_reason = 'selected_pdf_docling_surya') AS selected_pdf_total, count(*) FILTER (WHERE ocr_reason = 'backfill_pdf_docling_surya') AS backfill_pdf_total FROM queue",
        "word_rows": f"""WITH {_WORD} SELECT variant_id, source_path, source_format, language_hint, lang AS detected_language, CASE WHEN source_format = 'doc' THEN 'doc_to_docx_' ELSE '' END || method AS extraction_method, extraction_source, native_method, native_char_count, docling_char_count, extractor_stats,
            native_error, docling_error, length(t) AS char_count, array_to_string({_distinct(f"list_concat({_compact(_FLAGS)}, {_compact(_WORD_FLAGS)})")}, ',') AS quality_flags, length(t) < 500 AS needs_review, CASE WHEN length(t) < 500 THEN 'word_extraction_weak_low_char_count' END AS review_reason, false AS needs_ocr, CAST(NULL AS VARCHAR) AS ocr_reason, md5(t) AS raw_text FROM w4 WHERE t IS NOT NULL""",
        "word_failures": f"""WITH {_WORD} SELECT variant_id, source_path, source_format, language_hint, true AS needs_review, 'word_extraction_failed' AS review_reason, false AS needs_ocr, concat_ws('; ', coalesce(any_ne, 'no native text'), coalesce(any_de, 'no structured text')) AS error FROM w4 WHERE t IS NULL""",
        "word_summary": f"""WITH {_WORD}, x AS (SELECT * FROM w4 WHERE CAST(variant_id AS BIGINT) % 9 <> 0) SELECT (SELECT count(*) FROM w4) AS registry_word_rows_considered, count(*) AS tasks_run, count(t) AS parsed_ok, count(*) FILTER (WHERE length(t) < 500) AS parsed_weak_needs_review, count(*) FILTER (WHERE t IS NULL) AS failed, (SELECT count(*) FROM w4) - count(*) AS skipped_existing FROM x""",
        "word_selection": f"""WITH o AS (SELECT variant_id, max({{'p': source_path, 'f': source_format, 'e': source_extension, 'l': language_hint}}) AS m FROM registry GROUP BY 1) SELECT variant_id, m.p AS source_path FROM o WHERE lower(m.e) IN ({_list(R.WORD_EXTENSIONS)}) AND m.l = 'unknown' ORDER BY coalesce(m.p, ''), variant_id LIMIT 100 OFFSET 10""",
        "word_best_candidate": f"""WITH {_CAND} SELECT variant_id, CASE WHEN bool_or(ok) THEN (list({{'n': -length(text), 'rk': rk, 'm': method}} ORDER BY length(text) DESC, rk) FILTER (WHERE ok))[1].m END AS method, max(length(text)) FILTER (WHERE ok) AS char_count,
            string_agg(method || '=' || CASE WHEN ok THEN length(text) ELSE -1 END, ',' ORDER BY method) AS stats FROM cand GROUP BY 1""",
        "failures_split": f"WITH {_CAND} SELECT method, count(*) AS n, CASE WHEN ok THEN 'ok' ELSE 'failed' END AS status FROM cand GROUP BY 1, 3",
    }
