"""The same results as the queries' in the SQL of DuckDB."""

from __future__ import annotations

from .config import EMPTY_LABELS, SAFE_WORDS, TASKS
from .operators.redaction import RULES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_CURRENT = """cur AS (
  SELECT page_key, clean_ocr, final_llm_scrubbed FROM (
    SELECT *, row_number() OVER (PARTITION BY page_key ORDER BY written_at DESC NULLS LAST, clean_ocr DESC NULLS LAST, final_llm_scrubbed DESC NULLS LAST) AS rn
    FROM audit_trail WHERE page_key IS NOT NULL) WHERE rn = 1)"""
_CLEAN = """cur AS (
  SELECT page_key, clean_ocr FROM (
    SELECT page_key, clean_ocr, row_number() OVER (PARTITION BY page_key ORDER BY written_at DESC NULLS LAST, clean_ocr DESC NULLS LAST) AS rn
    FROM audit_trail WHERE page_key IS NOT NULL) WHERE rn = 1)"""
_FINAL = """cur AS (
  SELECT page_key, final_llm_scrubbed FROM (
    SELECT page_key, final_llm_scrubbed, row_number() OVER (PARTITION BY page_key ORDER BY written_at DESC NULLS LAST, final_llm_scrubbed DESC NULLS LAST) AS rn
    FROM audit_trail WHERE page_key IS NOT NULL) WHERE rn = 1)"""
_STEM = "CASE WHEN contains(page_key, '_page_') THEN regexp_extract(page_key, '^(.*)_page_', 1) ELSE page_key END"
_NUMBER = "TRY_CAST(regexp_extract(page_key, '_page_(\\d+)$', 1) AS BIGINT)"
_ITEMS = "items AS (SELECT DISTINCT page_key, e FROM (SELECT page_key, unnest(extracted_identifiers) AS e FROM patient_data_extractor) WHERE e IS NOT NULL AND page_key IS NOT NULL)"
_ALL = "|".join(f"(?:{p})" for _, p in RULES)
_GOING = "|".join(f"(?:{p})" for n, p in RULES if "DATE" not in n)
_SAFE = ", ".join(map(_text, SAFE_WORDS))
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def _merged(order: str) -> str:
    rule = "=" * 50
    return f"""WITH {_FINAL}
SELECT {_STEM} AS stem, count(*) AS n_pages,
  '# Document: ' || {_STEM} || chr(10) || chr(10) || string_agg('## ' || page_key || chr(10) || chr(10) || coalesce(final_llm_scrubbed, '') || chr(10) || chr(10) || '{rule}' || chr(10) || chr(10), '' ORDER BY {order}) AS document
FROM cur GROUP BY {_STEM}"""


_TERMS = """terms AS (SELECT DISTINCT page_key, lower(e) AS term FROM items WHERE e <> '' AND lower(e) <> '')"""
_TEXTS = "texts AS (SELECT page_key, lower(coalesce(clean_ocr, '')) AS clean, lower(coalesce(final_llm_scrubbed, '')) AS final FROM cur)"
_TARGETS = f"""WITH {_CURRENT}, {_ITEMS}, {_TERMS}, {_TEXTS},
targets AS (SELECT t.page_key, t.term AS target, x.clean, x.final FROM terms t JOIN texts x ON t.page_key = x.page_key WHERE contains(x.clean, t.term))"""
_WORDS = r"'[\p{L}\p{N}_]+'"
_SCORES = f"""{_TARGETS},
known AS (SELECT * FROM texts WHERE page_key IN (SELECT page_key FROM terms)),
hit AS (SELECT page_key, sum(CASE WHEN contains(final, target) THEN 0 ELSE 1 END) AS tp, sum(CASE WHEN contains(final, target) THEN 1 ELSE 0 END) AS fn FROM targets GROUP BY page_key),
before AS (SELECT DISTINCT page_key, unnest(regexp_extract_all(clean, {_WORDS})) AS w FROM known),
after AS (SELECT DISTINCT page_key, unnest(regexp_extract_all(final, {_WORDS})) AS w FROM known),
expected AS (SELECT DISTINCT page_key, unnest(regexp_extract_all(target, {_WORDS})) AS w FROM targets),
nb AS (SELECT page_key, count(*) AS n FROM before GROUP BY page_key),
ne AS (SELECT page_key, count(*) AS n FROM expected GROUP BY page_key),
nf AS (SELECT page_key, count(*) AS n FROM (SELECT * FROM before EXCEPT SELECT * FROM after EXCEPT SELECT * FROM expected) GROUP BY page_key),
scores AS (SELECT k.page_key, CAST(coalesce(tp, 0) AS BIGINT) AS tp, CAST(coalesce(fn, 0) AS BIGINT) AS fn, CAST(coalesce(nf.n, 0) AS BIGINT) AS fp,
  CAST(greatest(0, coalesce(nb.n, 0) - coalesce(ne.n, 0) - coalesce(nf.n, 0)) AS BIGINT) AS tn
  FROM known k LEFT JOIN hit USING (page_key) LEFT JOIN nb USING (page_key) LEFT JOIN ne USING (page_key) LEFT JOIN nf USING (page_key))"""

_BOXES = """b AS (SELECT CAST(l_orderkey AS VARCHAR) AS page_key,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) - 1 AS INT) AS idx,
  CAST(l_partkey * 7 % 1100 AS INT) AS x0, CAST(l_suppkey * 13 % 1600 AS INT) AS y0,
  CAST(l_partkey * 7 % 1100 AS INT) + 20 + CAST(l_quantity AS INT) * 8 AS x1, CAST(l_suppkey * 13 % 1600 AS INT) + 10 + CAST(l_partkey % 50 AS INT) AS y1,
  (['Text', 'PageHeader', 'Table', 'PageFooter', 'SectionHeader'])[l_linenumber % 5 + 1] AS label FROM lineitem)"""
_SIZES = "s AS (SELECT CAST(o_orderkey AS VARCHAR) AS page_key, CAST(o_custkey % 3000 + 200 AS INT) AS width, CAST(o_orderkey % 2500 + 200 AS INT) AS height FROM orders)"
_READINGS = """r AS (SELECT CAST(user_id AS VARCHAR) AS page_key, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS patch,
  CAST(event_id % 5 * 90 AS INT) AS angle, CAST(CAST(value AS DECIMAL(12, 2)) AS DOUBLE) AS confidence FROM events)"""


def _strip_markup() -> str:
    c = "raw_text"
    for pattern, into in (
        (r"(?s)<!--.*?-->", " "),
        (r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "),
        (r"(?s)</?[A-Za-z][^<>]*>", " "),
        (r"(?m)^ {0,3}#{1,6} +", ""),
        (r"(?m)^\|?[ :|-]*-{3}[ :|-]*$", " "),
        (r"\*\*|__|~~|`+", ""),
    ):
        c = f"regexp_replace({c}, '{pattern}', '{into}', 'g')"
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        c = f"replace({c}, '{name}', '{sign}')"
    c = f"regexp_replace({c}, '\\s+', ' ', 'g')"
    return _STRIP.format(c)


def _angles(least: int) -> str:
    return f"""WITH {_READINGS}, s AS (SELECT *, row_number() OVER (PARTITION BY page_key ORDER BY patch) AS rn FROM r WHERE confidence > {least} AND patch <= 100), p AS (SELECT DISTINCT page_key FROM r)
SELECT p.page_key, CASE WHEN angle IN (0, 90, 180, 270) THEN angle ELSE 0 END AS angle, CASE WHEN angle IS NULL THEN 'none' WHEN patch = 0 THEN 'page' ELSE 'patch' END AS tier FROM p LEFT JOIN (SELECT * FROM s WHERE rn = 1) s ON p.page_key = s.page_key"""


ORACLE = {
    "page_keys": f"SELECT DISTINCT page_key, printf('%s_page_%02d', coalesce(stem, {_STEM}), page) AS made, coalesce(stem, {_STEM}) AS doc_stem FROM page_metadata",
    "file_routing": """SELECT * FROM (SELECT DISTINCT original_file, regexp_extract(original_file, '^(.*)\\.[^.]+$', 1) AS stem, lower(regexp_extract(original_file, '[^.](\\.[^.]+)$', 1)) AS extension,
  CASE WHEN lower(regexp_extract(original_file, '[^.](\\.[^.]+)$', 1)) = '.pdf' THEN 'pdf' WHEN lower(regexp_extract(original_file, '[^.](\\.[^.]+)$', 1)) IN ('.png','.jpg','.jpeg','.tiff','.tif','.bmp','.webp') THEN 'image'
  WHEN lower(regexp_extract(original_file, '[^.](\\.[^.]+)$', 1)) IN ('.txt','.md','.json','.csv') THEN 'text' END AS family FROM preprocess_audit) WHERE family IS NOT NULL""",
    "image_files": "SELECT original_file, status FROM preprocess_audit WHERE contains(original_file, 'LS') AND regexp_matches(lower(original_file), '[^.]\\.(png|jpg|jpeg|tiff|tif|bmp|webp)$')",
    "page_subset": "SELECT page_key, page FROM page_metadata WHERE page IN (1, 3, 5)",
    "numbered_documents": "SELECT doc_id, printf('%s_page_%02d', stem, row_number() OVER (PARTITION BY stem ORDER BY doc_id)) AS page_key FROM (SELECT doc_id, coalesce(source, 'unknown') AS stem FROM documents)",
    "last_written": f"WITH {_CURRENT} SELECT * FROM cur",
    "stem_counts": f"SELECT {_STEM} AS stem, count(DISTINCT page_key) AS n_pages, CAST(sum(len(removed_info)) AS BIGINT) AS n_removed FROM page_metadata GROUP BY 1",
    "merged_documents": _merged(f"{_NUMBER}, page_key"),
    "merged_lexicographic": _merged("page_key"),
    "page_files": f"WITH {_FINAL} SELECT {_STEM} || '/' || page_key || '.md' AS name, final_llm_scrubbed AS content FROM cur",
    "strip_markup": f"SELECT DISTINCT page_key, raw_text, {_strip_markup()} AS text FROM corpus_dict",
    "ocr_tree_text": f"""WITH {_CLEAN} SELECT page_key, {_STRIP.format("array_to_string(list_transform(string_split(clean_ocr, chr(10)), lambda l: array_to_string(list_filter(regexp_split_to_array(l, '\\s+'), lambda w: w <> ''), ' ')), chr(10))")} AS text FROM cur WHERE clean_ocr IS NOT NULL""",
    "content_blocks": f"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {_STRIP.format("x")}), lambda x: x <> ''), chr(10) || chr(10)) AS text FROM documents WHERE text IS NOT NULL""",
    "page_texts": f"""WITH {_CURRENT} SELECT page_key, {_STRIP.format("concat_ws(chr(10) || chr(10), clean_ocr, final_llm_scrubbed)")} AS text FROM cur""",
    "word_ngrams": f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), {_WORDS}) AS w FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, CASE WHEN len(w) < 3 THEN [] ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END AS g FROM w)
SELECT doc_id, CAST(len(g) AS INT) AS n_grams, CAST(len(list_distinct(g)) AS INT) AS n_distinct FROM g""",
    "chunks_stage1": f"""WITH RECURSIVE {_CLEAN}, walk AS (
  SELECT page_key, clean_ocr AS t, 0 AS chunk_idx, 0 AS start_, CAST(CASE WHEN length(clean_ocr) <= 1500 THEN length(clean_ocr) WHEN contains(substr(clean_ocr, 2, 1499), ' ') THEN 1500 - instr(reverse(substr(clean_ocr, 1, 1500)), ' ') ELSE 1500 END AS INT) AS end_ FROM cur WHERE length(clean_ocr) > 0
  UNION ALL
  SELECT page_key, t, chunk_idx + 1, end_, CAST(CASE WHEN length(t) - end_ <= 1500 THEN length(t) WHEN contains(substr(t, end_ + 2, 1499), ' ') THEN end_ + 1500 - instr(reverse(substr(t, end_ + 1, 1500)), ' ') ELSE end_ + 1500 END AS INT) FROM walk WHERE end_ < length(t))
SELECT page_key, chunk_idx, start_ AS start, end_ AS "end" FROM walk""",
    "rule_ner": f"""WITH {_CLEAN}, m AS (SELECT page_key, regexp_extract_all(clean_ocr, '{_ALL}') AS f FROM cur WHERE clean_ocr IS NOT NULL),
e AS (SELECT page_key, unnest(range(0, len(f))) AS idx, unnest(f) AS surface FROM m)
SELECT page_key, CAST(idx AS INT) AS idx, CASE {" ".join(f"WHEN regexp_full_match(surface, '{p}') THEN '{n}'" for n, p in RULES)} ELSE '' END AS label, surface FROM e""",
    "span_redacted": f"""WITH {_CLEAN} SELECT page_key, regexp_replace(clean_ocr, '{_GOING}', '***', 'g') AS text, array_to_string(list_reverse(regexp_extract_all(clean_ocr, '{_GOING}')), '|') AS removed FROM cur WHERE clean_ocr IS NOT NULL""",
    "reply_identifiers": """WITH d AS (SELECT DISTINCT * FROM patient_data_extractor),
x AS (SELECT reply_id, reply_id % 4 <> 3 AND contains_pii IS NOT NULL AND NOT list_contains(list_transform(coalesce(extracted_identifiers, []), lambda i: i IS NULL), true) AS accepted, extracted_identifiers AS ids FROM d)
SELECT reply_id, accepted, CASE WHEN accepted THEN coalesce(array_to_string(ids, '|'), '') ELSE '' END AS identifiers FROM x""",
    "harvested": f"WITH {_ITEMS} SELECT page_key, string_agg(e, '|' ORDER BY e) AS identifiers FROM items GROUP BY page_key",
    "identifier_words": f"""WITH {_ITEMS}, w AS (SELECT DISTINCT page_key, unnest(regexp_split_to_array(e, '\\s+')) AS w FROM items),
k AS (SELECT * FROM w WHERE w <> '' AND length(w) > 2 AND w <> '***' AND NOT regexp_matches(w, '^\\p{{Nd}}+$') AND lower(w) NOT IN ({_SAFE}))
SELECT p.page_key, coalesce(string_agg(k.w, '|' ORDER BY -length(k.w), k.w), '') AS words FROM (SELECT DISTINCT page_key FROM items) p LEFT JOIN k ON p.page_key = k.page_key GROUP BY p.page_key""",
    "redacted_entities": """SELECT page_key, string_agg(e, '|' ORDER BY e) AS entities FROM (SELECT DISTINCT page_key, e FROM (
  SELECT page_key, unnest(redacted_entities) AS e FROM audit_trail UNION ALL SELECT page_key, unnest(extracted_identifiers) AS e FROM patient_data_extractor) WHERE e IS NOT NULL) GROUP BY page_key""",
    "truth_pages": f"WITH {_CURRENT}, {_ITEMS}, {_TERMS} SELECT c.page_key, count(*) AS n_terms FROM cur c JOIN terms t ON c.page_key = t.page_key GROUP BY c.page_key",
    "truth_missing": f"WITH {_CURRENT}, {_ITEMS}, {_TERMS} SELECT page_key FROM cur WHERE page_key NOT IN (SELECT page_key FROM terms)",
    "term_found": f"{_TARGETS} SELECT page_key, target, contains(final, target) AS leaked FROM targets",
    "page_scores": f"{_SCORES} SELECT page_key, tp, fn, fp, tn FROM scores",
    "scorecard": f"""{_SCORES}, t AS (SELECT CAST(coalesce(sum(tp), 0) AS BIGINT) AS tp, CAST(coalesce(sum(fn), 0) AS BIGINT) AS fn, CAST(coalesce(sum(fp), 0) AS BIGINT) AS fp, CAST(coalesce(sum(tn), 0) AS BIGINT) AS tn FROM scores)
SELECT *, CASE WHEN tp + fn > 0 THEN tp * 100.0::DOUBLE / (tp + fn)::DOUBLE ELSE 0.0::DOUBLE END AS sensitivity, CASE WHEN tn + fp > 0 THEN tn * 100.0::DOUBLE / (tn + fp)::DOUBLE ELSE 0.0::DOUBLE END AS specificity FROM t""",
    "leak_report": f"""{_TARGETS}, l AS (SELECT *, instr(final, target) AS pos FROM targets WHERE contains(final, target))
SELECT page_key AS Page, target AS Leaked_PHI, '...' || replace(substr(final, greatest(pos - 35, 1), least(pos + length(target) + 35, length(final) + 1) - greatest(pos - 35, 1)), chr(10), ' ') || '...' AS Context_Surrounding_Leak FROM l""",
    "debug_report": """WITH m AS (SELECT DISTINCT page_key, stem, page, rotated, composite FROM page_metadata),
a AS (SELECT page_key, redacted_entities FROM (SELECT page_key, redacted_entities, row_number() OVER (PARTITION BY page_key ORDER BY written_at DESC NULLS LAST, redacted_entities DESC NULLS LAST) AS rn FROM audit_trail WHERE page_key IS NOT NULL) WHERE rn = 1)
SELECT stem AS "Filename", page AS "Page", rotated AS "Rotated", composite AS "Composite Image", CASE WHEN len(redacted_entities) > 0 THEN array_to_string(redacted_entities, ', ') ELSE 'None' END AS "De-id Info Removed" FROM m LEFT JOIN a USING (page_key)""",
    "preprocess_summary": "SELECT status, coalesce(detected_rotation, -1) AS rotation, coalesce(was_composite_spread, false) AS composite, count(*) AS files, CAST(sum(coalesce(pages_output, 0)) AS BIGINT) AS pages FROM preprocess_audit GROUP BY 1, 2, 3",
    "split_file_names": """SELECT original_file, CAST(part AS INT) AS part, regexp_replace(original_file, '\\.[^.]+$', '') || CASE WHEN pages_output > 1 THEN '_page_' || part ELSE '' END || '.jpg' AS name
FROM (SELECT original_file, pages_output, unnest(range(1, pages_output + 1)) AS part FROM (SELECT DISTINCT original_file, pages_output FROM preprocess_audit WHERE status = 'SUCCESS' AND pages_output > 0))""",
    "composite_files": "SELECT original_file, sum(pages_output) > 1 AS composite FROM (SELECT DISTINCT original_file, pages_output FROM preprocess_audit WHERE status = 'SUCCESS' AND pages_output > 0) GROUP BY 1",
    "sanitised_labels": f"""SELECT label, substr(coalesce(nullif({_STRIP.format("replace(regexp_replace(label, '[\\\\/*?:\"<>|\\n\\t]', '', 'g'), ' ', '_')")}, ''), 'unnamed_text'), 1, 40) AS clean FROM (SELECT DISTINCT unnest(removed_info) AS label FROM page_metadata)""",
    "list_cells": "SELECT DISTINCT page_key, CASE WHEN len(removed_info) > 0 THEN array_to_string(removed_info, ', ') ELSE 'None' END AS cell FROM page_metadata",
    "redacted_words": f"""WITH {_CURRENT}, c AS (SELECT * FROM cur WHERE clean_ocr IS NOT NULL),
b AS (SELECT DISTINCT page_key, unnest(regexp_extract_all(lower(clean_ocr), {_WORDS})) AS w FROM c), a AS (SELECT DISTINCT page_key, unnest(regexp_extract_all(lower(coalesce(final_llm_scrubbed, '')), {_WORDS})) AS w FROM c),
g AS (SELECT * FROM b EXCEPT SELECT * FROM a)
SELECT c.page_key, coalesce(string_agg(g.w, ' ' ORDER BY g.w), '') AS gone FROM c LEFT JOIN g ON c.page_key = g.page_key GROUP BY c.page_key""",
    "control_free": r"SELECT doc_id, regexp_replace(text, '[\x00-\x1F\x7F]', ' ', 'g') AS text FROM documents",
    "large_regions": f"WITH {_BOXES} SELECT page_key, idx, (x1 - x0) * (y1 - y0) AS area FROM b WHERE x1 > x0 AND y1 > y0 AND (x1 - x0) * (y1 - y0) >= 1240 * 1754 * 0.005",
    "rotation_replies": "SELECT event_id, CAST(([90, 180, 270, 0, 0, 0, 0, 90, 0])[event_id % 9 + 1] AS INT) AS angle FROM events",
    "spread_replies": "SELECT event_id, ([true, true, true, false, false, false, true, false, false])[event_id % 9 + 1] AS spread FROM events",
    "padded_boxes": f"""WITH {_BOXES} SELECT * FROM (SELECT page_key, idx, greatest(0, x0 - 6) AS x0, greatest(0, y0 - 6) AS y0, least(1240, x1 + 6) AS x1, least(1754, y1 + 6) AS y1 FROM b) WHERE x1 > x0 AND y1 > y0""",
    "region_ids": f"""WITH {_BOXES} SELECT page_key, idx, printf('region_%02d_%s', row_number() OVER (PARTITION BY page_key ORDER BY y0, idx) - 1, label) AS region_id FROM b""",
    "content_blocks_in_order": f"""WITH {_BOXES}, n AS (SELECT page_key, idx, label, printf('block_%03d', row_number() OVER (PARTITION BY page_key ORDER BY floor(y0 / 40.0), x0, idx) - 1) AS region_id FROM b)
SELECT page_key, idx, region_id, label FROM n WHERE label NOT IN ({", ".join(map(_text, EMPTY_LABELS))})""",
    "line_heights": f"WITH {_BOXES} SELECT page_key, CAST(median(y1 - y0) AS DOUBLE) AS median_height FROM b GROUP BY page_key",
    "page_hulls": f"WITH {_BOXES} SELECT page_key, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM b GROUP BY page_key",
    "page_strips": f"""WITH {_SIZES}, h AS (SELECT page_key, height + 120 AS height FROM s), n AS (SELECT page_key, height, unnest(range(0, CAST(greatest(ceil((height - 800) / 600.0), 0) AS INT) + 1)) AS strip_idx FROM h)
SELECT page_key, CAST(strip_idx AS INT) AS strip_idx, CAST(strip_idx * 600 AS INT) AS y0, CAST(least(strip_idx * 600 + 800, height) AS INT) AS y1 FROM n""",
    "fitted_sizes": f"""WITH {_SIZES} SELECT page_key, CAST(CASE WHEN greatest(width, height) > 896 THEN trunc(width * (896.0::DOUBLE / greatest(width, height))) ELSE width END AS INT) AS w,
CAST(CASE WHEN greatest(width, height) > 896 THEN trunc(height * (896.0::DOUBLE / greatest(width, height))) ELSE height END AS INT) AS h, CAST(trunc(width * 0.4::DOUBLE) AS INT) AS band_first, CAST(trunc(width * 0.6::DOUBLE) AS INT) AS band_end FROM s""",
    "spread_gate": f"WITH {_SIZES} SELECT page_key, CASE WHEN height >= width THEN false ELSE width > 2 * height END AS is_composite FROM s",
    "gutters": """WITH e AS (SELECT vec_id, embedding AS v, CAST(trunc(len(embedding) * 0.4::DOUBLE) AS INT) AS f, CAST(trunc(len(embedding) * 0.6::DOUBLE) AS INT) AS t FROM embeddings)
SELECT vec_id, CAST(f + list_position(v[f + 1:t], list_min(v[f + 1:t])) - 1 AS INT) AS gutter FROM e""",
    "first_confident": f"WITH {_READINGS}, s AS (SELECT *, row_number() OVER (PARTITION BY page_key ORDER BY patch) AS rn FROM r WHERE confidence > 4 AND patch <= 100) SELECT page_key, angle, patch FROM s WHERE rn = 1",
    "page_angles": _angles(4),
    "sure_page_angles": _angles(480),
    "event_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY 1, 2",
}
#: The cut of a stage-2 chunk that begins at `at`: after a delimiter that leaves more than the overlap, else hard.
_CUT = "CASE WHEN length(t) - {at} <= 1500 THEN length(t) WHEN instr(reverse(translate(substr(t, {at} + 2, 1500), chr(10) || '.,', '   ')), ' ') > 0 AND 1501 - instr(reverse(translate(substr(t, {at} + 2, 1500), chr(10) || '.,', '   ')), ' ') > 150 THEN {at} + 1501 - instr(reverse(translate(substr(t, {at} + 2, 1500), chr(10) || '.,', '   ')), ' ') ELSE {at} + 1500 END"
_WALK2 = f"""WITH RECURSIVE {_CLEAN}, texts AS (SELECT page_key, clean_ocr AS t FROM cur WHERE length(clean_ocr) > 0),
walk AS (SELECT page_key, t, 0 AS chunk_idx, 0 AS start_, CAST({_CUT.format(at="0")} AS INT) AS end_ FROM texts
  UNION ALL SELECT page_key, t, chunk_idx + 1, end_ - 150, CAST({_CUT.format(at="(end_ - 150)")} AS INT) FROM walk WHERE end_ < length(t))"""
ORACLE["chunks_stage2"] = f"""{_WALK2} SELECT page_key, chunk_idx, start_ AS start, end_ AS "end" FROM walk"""
ORACLE["chunks_stage1_native"] = ORACLE["chunks_stage1"]
ORACLE["chunk_questions"] = f"""{_WALK2} SELECT task, count(*) AS questions, count(DISTINCT page_key) AS pages FROM walk, (SELECT unnest([{", ".join(_text(t) for t, _ in TASKS)}]) AS task) GROUP BY task"""

# Words of harvested identifiers, replaced one after the other.  Where a word begins or ends with a letter, none may stand
# beside it, else one must; the neighbour is matched and kept, and a second pass takes words that share a neighbour.
_LETTER = r"[\p{L}\p{N}_]"
_OTHER = r"[^\p{L}\p{N}_]"
_QUOTED = r"regexp_replace(w, '([.+*?()|\[\]{}^$\\-])', '\\\1', 'g')"
_PATTERN = f"""'(?is)' || CASE WHEN regexp_matches(left(w, 1), '{_LETTER}') THEN '(^|{_OTHER})' ELSE '({_LETTER})' END || {_QUOTED} || CASE WHEN regexp_matches(right(w, 1), '{_LETTER}') THEN '({_OTHER}|$)' ELSE '({_LETTER})' END"""
_FOLD = f"""k AS (SELECT page_key, w, {_PATTERN} AS pattern FROM (SELECT DISTINCT page_key, unnest(regexp_split_to_array(e, '\\s+')) AS w FROM items)
  WHERE w <> '' AND length(w) > 2 AND w <> '***' AND NOT regexp_matches(w, '^\\p{{Nd}}+$') AND lower(w) NOT IN ({_SAFE})),
o AS (SELECT *, row_number() OVER (PARTITION BY page_key ORDER BY -length(w), w) AS n FROM k),
walk AS (SELECT page_key, 0 AS n, text, CAST([] AS VARCHAR[]) AS removed FROM base
  UNION ALL SELECT f.page_key, f.n + 1, regexp_replace(regexp_replace(f.text, o.pattern, '\\1***\\2', 'g'), o.pattern, '\\1***\\2', 'g'), CASE WHEN regexp_matches(f.text, o.pattern) THEN list_append(f.removed, o.w) ELSE f.removed END
  FROM walk f JOIN o ON f.page_key = o.page_key AND o.n = f.n + 1),
done AS (SELECT page_key, arg_max(text, n) AS text, arg_max(removed, n) AS removed FROM walk GROUP BY page_key)"""
ORACLE["word_redacted"] = f"""WITH RECURSIVE base AS (SELECT page_key, roberta_only AS text FROM (
    SELECT page_key, roberta_only, row_number() OVER (PARTITION BY page_key ORDER BY written_at DESC NULLS LAST, roberta_only DESC NULLS LAST) AS rn FROM audit_trail WHERE page_key IS NOT NULL) WHERE rn = 1 AND roberta_only IS NOT NULL),
{_ITEMS}, {_FOLD} SELECT page_key, text, array_to_string(removed, '|') AS removed FROM done"""
ORACLE["audit_records"] = f"""WITH RECURSIVE {_CLEAN}, full_text AS (SELECT page_key, coalesce(clean_ocr, '') AS text FROM cur),
base AS (SELECT page_key, regexp_replace(text, '{_GOING}', '***', 'g') AS text, text AS whole FROM full_text), {_ITEMS}, {_FOLD.replace("FROM base", "FROM (SELECT page_key, text FROM base)")}
SELECT b.page_key, CASE WHEN blank THEN '' ELSE whole END AS clean_ocr, CASE WHEN blank THEN '' ELSE b.text END AS roberta_only, CASE WHEN blank THEN '' ELSE d.text END AS final_llm_scrubbed,
  CASE WHEN blank THEN '' ELSE array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(whole, '{_GOING}'), d.removed))), '|') END AS redacted_entities
FROM (SELECT *, {_STRIP.format("whole")} = '' AS blank FROM base) b JOIN done d ON b.page_key = d.page_key"""

# Boxes, largest first, each kept unless a box kept before covers it.
_AREA = "(({0}).x1 - ({0}).x0) * (({0}).y1 - ({0}).y0)"
_SHARED = "greatest(least(({0}).x1, ({1}).x1) - greatest(({0}).x0, ({1}).x0), 0) * greatest(least(({0}).y1, ({1}).y1) - greatest(({0}).y0, ({1}).y0), 0)"
ORACLE["surviving_boxes"] = f"""WITH RECURSIVE {_BOXES}, s AS (SELECT page_key, list({{'idx': idx, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} ORDER BY (x1 - x0) * (y1 - y0) DESC, idx) AS boxes FROM b WHERE (x1 - x0) * (y1 - y0) > 0 GROUP BY page_key),
walk AS (SELECT page_key, boxes, 1 AS n, boxes[1:0] AS kept FROM s
  UNION ALL SELECT page_key, boxes, n + 1, CASE WHEN len(list_filter(kept, lambda p: {_SHARED.format("boxes[n]", "p")} > 0.85::DOUBLE * {_AREA.format("boxes[n]")})) > 0 THEN kept ELSE list_append(kept, boxes[n]) END FROM walk WHERE n <= len(boxes)),
u AS (SELECT page_key, unnest(kept) AS k FROM walk WHERE n = len(boxes) + 1)
SELECT page_key, k.idx AS idx, k.x0 AS x0, k.y0 AS y0, k.x1 AS x1, k.y1 AS y1 FROM u"""
# Lines from the top, each joined to the first paragraph that takes it.
ORACLE["paragraph_boxes"] = f"""WITH RECURSIVE {_BOXES}, s AS (SELECT page_key, median(CAST(y1 - y0 AS DOUBLE)) AS m, list({{'x0': CAST(x0 AS DOUBLE), 'y0': CAST(y0 AS DOUBLE), 'x1': CAST(x1 AS DOUBLE), 'y1': CAST(y1 AS DOUBLE)}} ORDER BY y0, idx) AS boxes FROM b GROUP BY page_key),
walk AS (SELECT page_key, m, boxes, 1 AS n, boxes[1:0] AS made FROM s
  UNION ALL SELECT page_key, m, boxes, n + 1, CASE WHEN place IS NULL THEN list_append(made, boxes[n]) ELSE list_transform(made, lambda p, i: CASE WHEN i = place
    THEN {{'x0': least(p.x0, (boxes[n]).x0), 'y0': least(p.y0, (boxes[n]).y0), 'x1': greatest(p.x1, (boxes[n]).x1), 'y1': greatest(p.y1, (boxes[n]).y1)}} ELSE p END) END
  FROM (SELECT *, list_position(list_transform(made, lambda p: (boxes[n]).y0 - p.y1 >= 0 AND (boxes[n]).y0 - p.y1 <= 0.5::DOUBLE * m AND greatest(p.x0 - (boxes[n]).x1, (boxes[n]).x0 - p.x1) <= m), true) AS place FROM walk WHERE n <= len(boxes))),
u AS (SELECT page_key, unnest(made) AS p, unnest(range(0, len(made))) AS i FROM walk WHERE n = len(boxes) + 1)
SELECT page_key, CAST(i AS INT) AS paragraph_idx, p.x0 AS x0, p.y0 AS y0, p.x1 AS x1, p.y1 AS y1 FROM u"""

_PAD = "greatest(0, x0 - 4) AS x0, greatest(0, y0 - 4) AS y0, least(1240, x1 + 4) AS x1, least(1754, y1 + 4) AS y1"
_SOUND = "WHERE x1 > x0 AND y1 > y0"
# The hull's last row of pixels is that of the lowest corner.
ORACLE["line_regions"] = f"""WITH {_BOXES}, n AS (SELECT page_key, printf('line_%03d', row_number() OVER (PARTITION BY page_key ORDER BY y0 + 2, idx) - 1) AS region_id, x0, least(y0, y1 - 1) AS y0, x1, greatest(y0 + 2, y1) AS y1 FROM b)
SELECT * FROM (SELECT page_key, region_id, {_PAD} FROM n) {_SOUND}"""
ORACLE["paragraph_regions"] = f"""WITH p AS ({ORACLE["paragraph_boxes"]}), n AS (SELECT page_key, printf('line_%03d', paragraph_idx) AS region_id, CAST(x0 AS INT) AS x0, CAST(y0 AS INT) AS y0, CAST(x1 AS INT) AS x1, CAST(y1 AS INT) AS y1 FROM p)
SELECT * FROM (SELECT page_key, region_id, {_PAD} FROM n) {_SOUND}"""
ORACLE["block_regions"] = f"""WITH {_BOXES}, n AS (SELECT *, printf('block_%03d', row_number() OVER (PARTITION BY page_key ORDER BY floor(y0 / 40.0), x0, idx) - 1) AS region_id FROM b)
SELECT * FROM (SELECT page_key, region_id, {_PAD} FROM n WHERE label NOT IN ({", ".join(map(_text, EMPTY_LABELS))})) {_SOUND}"""
_STRIPS = f"""{_BOXES}, q AS (SELECT *, idx % 3 * 600 AS y_off, least(800, 1874 - idx % 3 * 600) AS sh, y0 % 900 AS y FROM b),
c AS (SELECT page_key, idx, label, y_off, sh, greatest(x0 - 30, 0) AS l, least(x1, 1360) AS r, y - 20 AS t, y + 90 AS e FROM q),
w AS (SELECT page_key, idx, greatest(l - 60, 0) AS x0, greatest(t + y_off - 60, 0) AS y0, least(r - 60, 1240) AS x1, least(e + y_off - 60, 1754) AS y1, label || '_ab' AS label FROM c WHERE r > l AND least(e, sh) > greatest(t, 0)),
f AS (SELECT * FROM w {_SOUND})"""
ORACLE["strip_boxes"] = f"WITH {_STRIPS} SELECT * FROM f"
ORACLE["mined_boxes"] = ORACLE["surviving_boxes"].replace(_BOXES, _STRIPS).replace("FROM b WHERE", "FROM f WHERE").replace("SELECT page_key, k.idx AS idx, k.x0 AS x0, k.y0 AS y0, k.x1 AS x1, k.y1 AS y1 FROM u", "SELECT u.page_key, f.idx, f.x0, f.y0, f.x1, f.y1, f.label FROM u JOIN f ON u.page_key = f.page_key AND u.k.idx = f.idx")
ORACLE["page_number_lists"] = f"""WITH p AS (SELECT {_STEM} AS stem, list_sort(list_distinct(list(page) FILTER (page IS NOT NULL))) AS p FROM page_metadata GROUP BY 1)
SELECT stem, CASE WHEN len(p) % 3 <> 0 THEN array_to_string(p, '|') END AS numbers FROM p"""
ORACLE["ground_truth_shapes"] = """WITH e AS (SELECT DISTINCT reply_id, list_filter(extracted_identifiers, lambda x: x IS NOT NULL) AS e FROM patient_data_extractor)
SELECT DISTINCT reply_id, CASE WHEN reply_id % 4 IN (1, 2) THEN e[1] ELSE array_to_string(e, '|') END AS terms FROM e WHERE len(e) > 0"""
_TOKENS = r"<\|[^|<>]*\|>|</?s>|<(?:pad|unk|bos|eos)>"
ORACLE["special_free"] = f"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND source IS NULL THEN NULL ELSE {_STRIP.format(f"regexp_replace('<|start|> ' || text || '</s><pad><|end of text|>', '{_TOKENS}', '', 'g')")} END AS text FROM documents"""
