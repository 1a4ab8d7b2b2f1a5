"""The same results as the queries' in the SQL of DuckDB, where SQL can express them."""

# Forms are the wordings of lines; a printed form is one that stands on three pages as it is, and those that differ from it
# by misread characters only count with it.
_PRINTED = r"""WITH cur AS (
  SELECT page_key, clean_ocr FROM (
    SELECT page_key, clean_ocr, row_number() OVER (PARTITION BY page_key ORDER BY written_at DESC NULLS LAST, clean_ocr DESC NULLS LAST) AS rn FROM audit_trail WHERE page_key IS NOT NULL) WHERE rn = 1 AND regexp_matches(clean_ocr, '[^\s\p{Z}]')),
p AS (SELECT page_key, CASE WHEN contains(page_key, '_page_') THEN regexp_extract(page_key, '^(.*)_page_', 1) ELSE page_key END AS stem, string_split(clean_ocr, chr(10)) AS lines FROM cur),
stems AS (SELECT stem, count(*) AS pages FROM p GROUP BY stem),
l AS (SELECT page_key, stem, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS line_no FROM p),
t AS (SELECT page_key, stem, line_no, list_filter(list_transform(regexp_split_to_array(lower(line), '[\s\p{Z}]+'), lambda x:
  CASE WHEN length(regexp_replace(x, '[^\p{L}]', '', 'g')) < 3 AND regexp_matches(x, '[0-9]') THEN '' ELSE regexp_replace(x, '[^\p{L}]', '', 'g') END), lambda x: x <> '') AS w FROM l),
f AS (SELECT * FROM t WHERE len(w) >= 5),
forms AS (SELECT stem, w, count(DISTINCT page_key) AS n FROM f GROUP BY stem, w),
met AS (SELECT a.stem, a.w AS form, b.w AS printed FROM forms a JOIN forms b ON a.stem = b.stem AND len(a.w) = len(b.w) AND b.n >= 3 AND (a.w = b.w OR
  (len(list_filter(list_zip(a.w, b.w), lambda x: x[1] <> x[2])) <= greatest(1, 2 * len(a.w) // 5) AND len(list_filter(list_zip(a.w, b.w), lambda x: x[1] <> x[2] AND levenshtein(x[1], x[2]) > 2)) = 0))),
often AS (SELECT m.stem, m.printed FROM met m JOIN f ON f.stem = m.stem AND f.w = m.form JOIN stems s ON s.stem = m.stem GROUP BY m.stem, m.printed, s.pages HAVING count(DISTINCT f.page_key) >= 6 AND count(DISTINCT f.page_key) >= 0.2 * s.pages),
found AS (SELECT DISTINCT f.page_key, f.line_no FROM f JOIN met m ON f.stem = m.stem AND f.w = m.form JOIN often o ON o.stem = m.stem AND o.printed = m.printed)"""

ORACLE: dict[str, str] = {
    # Words are numbered; a run of six is known by its words; every run that began earlier covers its six words.
    "p3_found": r"""WITH cur AS (
  SELECT page_key, clean_ocr FROM (
    SELECT page_key, clean_ocr, row_number() OVER (PARTITION BY page_key ORDER BY written_at DESC NULLS LAST, clean_ocr DESC NULLS LAST) AS rn
    FROM audit_trail WHERE page_key IS NOT NULL) WHERE rn = 1),
w AS (SELECT page_key, regexp_extract_all(lower(clean_ocr), '\p{L}+') AS w FROM cur WHERE clean_ocr IS NOT NULL),
g AS (SELECT page_key, unnest(range(1, len(w) - 4)) AS k, unnest(list_transform(range(1, len(w) - 4), lambda i: array_to_string(w[i:i + 5], ' '))) AS run FROM w WHERE len(w) >= 6),
again AS (SELECT page_key, k FROM (SELECT page_key, k, row_number() OVER (PARTITION BY page_key, run ORDER BY k) AS times FROM g) WHERE times > 1),
covered AS (SELECT page_key, count(DISTINCT place) AS n FROM (SELECT page_key, unnest(range(k, k + 6)) AS place FROM again) GROUP BY page_key)
SELECT c.page_key FROM covered c JOIN w ON c.page_key = w.page_key WHERE c.n >= 0.3 * len(w.w)""",
    "p4_found": f"{_PRINTED} SELECT page_key, line_no FROM found",
    "p4_clean": _PRINTED.replace("WITH cur", "WITH every AS (SELECT page_key, clean_ocr FROM (SELECT page_key, clean_ocr, row_number() OVER (PARTITION BY page_key ORDER BY written_at DESC NULLS LAST, clean_ocr DESC NULLS LAST) AS rn FROM audit_trail WHERE page_key IS NOT NULL) WHERE rn = 1), cur", 1)
    + """, gone AS (SELECT page_key, list(line_no) AS n FROM found GROUP BY page_key)
SELECT e.page_key, CASE WHEN g.n IS NULL THEN e.clean_ocr ELSE array_to_string(list_filter(string_split(e.clean_ocr, chr(10)), lambda x, i: NOT list_contains(g.n, i)), chr(10)) END AS text FROM every e LEFT JOIN gone g ON e.page_key = g.page_key""",
}
