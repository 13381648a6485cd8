"""DuckDB statements that state what each registered query must return.

The expected values of the case collection are plain arithmetic on orders and
line items; they never look at the generated HTML or JSON.  RE2 has no
look-behind and an ASCII ``\\s``, so Unicode classes are written out and
splits go through a marker character.
"""

from __future__ import annotations

from casewright.functions.embedding import plane_table
from casewright.operators import context, language_model
from casewright.operators import similarity_join as _NEAR
from casewright.operators import vector_index
from casewright.plans.settings import ASKED_EVERY, CASE_FOLDERS, LANGUAGE_SAMPLE, LSH_BITS, LSH_TABLES

WS = r"[\t\n\x0B\f\r\x1C-\x20\x{85}\p{Z}]"
TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def _squeeze(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS}+', ' ', 'g'))"


def _tokens(c: str) -> str:
    return TOKENS.format(c)


def _dollars(c: str) -> str:
    return f"({c}) / CAST(100 AS DOUBLE)"


def _text(cents: str) -> str:
    return f"(({cents}) // 100)::VARCHAR || '.' || lpad((({cents}) % 100)::VARCHAR, 2, '0')"


# --- the case collection ------------------------------------------------------

FACTS = """
sums AS (
  SELECT l_orderkey,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS c,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
         min([l_linenumber, l_suppkey])[2] AS suppkey,
         min([l_linenumber, l_partkey])[2] AS partkey
  FROM lineitem GROUP BY l_orderkey),
facts AS (
  SELECT o_orderkey AS k, o_orderdate AS ordered, sums.* EXCLUDE (l_orderkey)
  FROM orders LEFT JOIN sums ON o_orderkey = l_orderkey)
"""

CASES = (
    FACTS
    + """,
base AS (
  SELECT *, 'case_' || k AS case_id,
         c * 5 // 100 AS tax_a,
         CASE WHEN k % 2 = 0 THEN c * 3 // 100 END AS tax_b,
         c * 21 // 100 AS vat,
         CASE WHEN k % 5 = 0 AND k % 15 <> 0 THEN c * ((k % 9) * 2 + 1) // 200 END AS royalty,
         c + CASE WHEN k % 7 = 0 THEN 100 ELSE 0 END AS inv,
         CASE k % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'GBP' END AS cur,
         CASE WHEN k % 5 = 0 THEN CAST(k % 9 AS DOUBLE) + 0.5 END AS pct,
         CASE k % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'es' WHEN 2 THEN 'fr' ELSE 'de' END AS lang,
         CAST(strftime(ordered, '%Y%m%d%H%M') AS BIGINT) AS processed
  FROM facts WHERE c IS NOT NULL),
cases AS (
  SELECT base.*,
         c + tax_a + coalesce(tax_b, 0) + vat + coalesce(royalty, 0)
           + CASE WHEN k % 11 = 0 THEN 1000 ELSE 0 END AS total,
         coalesce(s_name, 'unknown') AS supplier, coalesce(p_name, 'unknown') AS part
  FROM base LEFT JOIN supplier ON suppkey = s_suppkey LEFT JOIN part ON partkey = p_partkey),
docs AS (
  SELECT *, '/cases/case_' || k || '/' || role || '_' || k || '.pdf' AS path,
         role || '_' || k AS document_id
  FROM cases, (SELECT unnest(['invoice', 'declaration', 'royalty']) AS role)
  WHERE role <> 'royalty' OR k % 5 = 0)
"""
)

FIELD_COLUMNS = f"""
  {_dollars('inv')} AS invoice_total, cur AS invoice_currency,
  {_dollars('c')} AS declaration_invoice_total, {_dollars('tax_a')} AS "declaration_tax_A",
  {_dollars('tax_b')} AS "declaration_tax_B", {_dollars('vat')} AS "declaration_VAT",
  {_dollars('royalty')} AS declaration_royalty, {_dollars('total')} AS declaration_total,
  cur AS declaration_currency, pct AS royalty_percentage
"""

_LOW = "lower(cur)"
# (document role, chunk id, cleaned text)
_INVOICE_ROWS = [
    "'No|Article|Qty|Unit|Note|Amount|Cur'",
    f"'1|' || part || '|' || quantity || '|pcs|new & boxed|' || {_text('c')} || '|' || {_LOW}",
    f"'||||Total|' || {_text('inv')} || '|' || {_LOW}",
]
_TH = "'<tr><th>' || replace({}, '|', '</th><th>') || '</th></tr>'"
_TD = "'<tr><td>' || replace({}, '|', '</td><td>') || '</td></tr>'"
_INVOICE_HTML = (
    "'<table>' || "
    + _TH.format(_INVOICE_ROWS[0])
    + " || "
    + _TD.format(_INVOICE_ROWS[1].replace("new & boxed", "new &amp; boxed"))
    + " || "
    + _TD.format(
        f"'||||<b>Total</b>| ' || {_text('inv')} || '|' || {_LOW}"
    )
    + " || '</table>'"
)
_DECLARATION_ROWS = [
    ("'Item|Base|Amount|Currency'", "TRUE"),
    (f"'Invoice||' || {_text('c')} || '|' || {_LOW}", "TRUE"),
    (f"'Tax A|5 %|' || {_text('tax_a')} || '|' || {_LOW}", "TRUE"),
    (f"'Tax B|3 %|' || {_text('tax_b')} || '|' || {_LOW}", "tax_b IS NOT NULL"),
    (f"'VAT|21 %|' || {_text('vat')} || '|' || {_LOW}", "TRUE"),
    (f"'Royalty||' || {_text('royalty')} || '|' || {_LOW}", "royalty IS NOT NULL"),
    (f"'Total||' || {_text('total')} || '|' || {_LOW}", "TRUE"),
]
_DECLARATION_HTML = (
    "'<table>' || "
    + " || ".join(
        f"CASE WHEN {cond} THEN "
        + (_TH if i == 0 else _TD).format(row.replace(" %|", "&nbsp;%|"))
        + " ELSE '' END"
        for i, (row, cond) in enumerate(_DECLARATION_ROWS)
    )
    + " || '</table>'"
)
_DECLARATION_LIST = (
    "list_filter(["
    + ", ".join(f"CASE WHEN {cond} THEN {row} END" for row, cond in _DECLARATION_ROWS)
    + "], lambda x: x IS NOT NULL)"
)
_ROYALTY_TEXT = "'The licensee pays a royalty of ' || (k % 9) || ',5 % on net sales.'"

CHUNKS = (
    CASES
    + f""",
chunks AS (
  SELECT *, 'i0' AS chunk_id, 'Commercial invoice ' || k AS text FROM docs WHERE role = 'invoice'
  UNION ALL SELECT *, 'i1', 'Goods supplied by ' || supplier || '. Article: ' || part || '.'
    FROM docs WHERE role = 'invoice'
  UNION ALL SELECT *, 'i4', {_INVOICE_HTML} FROM docs WHERE role = 'invoice'
  UNION ALL SELECT *, 'd0', 'Import declaration ' || k FROM docs WHERE role = 'declaration'
  UNION ALL SELECT *, '', {_DECLARATION_HTML} FROM docs WHERE role = 'declaration'
  UNION ALL SELECT *, 'r0', 'Royalty agreement ' || k FROM docs WHERE role = 'royalty'
  UNION ALL SELECT *, 'r1', {_ROYALTY_TEXT} FROM docs WHERE role = 'royalty')
"""
)

_CHUNK_COLUMNS = """case_id, document_id, path AS document_path, lang AS source_language,
  lang <> 'en' AS translation_applied, chunk_id, text,
  case_id || '_' || document_id || '_' || chunk_id AS id"""

_CASE_PATHS = """'/cases/case_' || k || '/invoice_' || k || '.pdf' AS invoice_path,
  '/cases/case_' || k || '/declaration_' || k || '.pdf' AS declaration_path,
  CASE WHEN k % 5 = 0 THEN '/cases/case_' || k || '/royalty_' || k || '.pdf' END AS royalty_path"""

# The words of a text with one blank around each, and its different character 3-grams.
_PLAIN = "(' ' || trim(regexp_replace(lower(text), '\\P{L}+', ' ', 'g')) || ' ')"
_GRAMS_OF = """list_distinct(list_transform(range(1, greatest(length(plain) - 1, 1)),
      lambda i: substr(plain, i, 3)))"""
_GRAMS = f"""
plain AS (SELECT doc_id, lang, text, {_PLAIN} AS plain FROM documents),
sample AS (
  SELECT * FROM plain WHERE lang IS NOT NULL AND text IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) <= {LANGUAGE_SAMPLE}),
counts AS (
  SELECT gram, lang, count(*) AS texts FROM (SELECT lang, unnest({_GRAMS_OF}) AS gram FROM sample)
  GROUP BY gram, lang)
"""

_BATCH = f"""WITH {CHUNKS} SELECT id, case_id, text, invoice_total, declaration_total, metadata, processed
  FROM (SELECT {_CHUNK_COLUMNS}, {FIELD_COLUMNS}, concat_ws(' | ',
      '/cases/case_' || k || '/invoice_' || k || '.pdf',
      '/cases/case_' || k || '/declaration_' || k || '.pdf',
      CASE WHEN k % 5 = 0 THEN '/cases/case_' || k || '/royalty_' || k || '.PDF' END) AS metadata,
    CASE WHEN k % 6 = 1 THEN 2::BIGINT ELSE 1::BIGINT END AS processed FROM chunks)"""

_INVENTORY = """SELECT 'case_' || k AS id,
  '/cases/case_' || k || '/invoice_' || k || '.pdf' AS invoice_path,
  CASE WHEN c IS NOT NULL THEN '/cases/case_' || k || '/declaration_' || k || '.pdf' END
    AS declaration_path,
  CASE WHEN k % 5 = 0 THEN '/cases/case_' || k || '/royalty_' || k || '.PDF' END AS royalty_path
FROM facts"""

ANOMALIES = (
    CASES
    + f""",
anomalies AS (
  SELECT case_id, unnest(list_filter([
      CASE WHEN inv <> c THEN 'INVOICE_TOTAL_MISMATCH' END,
      CASE WHEN c + tax_a + coalesce(tax_b, 0) + vat + coalesce(royalty, 0) <> total
           THEN 'DECLARATION_TOTAL_MISMATCH' END,
      CASE WHEN pct IS NOT NULL AND royalty IS NULL THEN 'ROYALTY_MISMATCH' END],
      lambda x: x IS NOT NULL)) AS anomaly_rule,
    {_dollars('inv')} AS invoice_total, {_dollars('c')} AS declaration_invoice_total,
    {_dollars('total')} AS declaration_total
  FROM cases)
"""
)

_ROLE_FIELDS = {
    "invoice": ("invoice_total", "invoice_currency"),
    "royalty": ("royalty_percentage",),
}


def _metadata() -> str:
    def pick(role: str, value: str, name: str) -> str:
        return f"CASE WHEN role = '{role}' THEN {value} END AS \"{name}\""

    columns = [
        pick("invoice", _dollars("inv"), "invoice_total"),
        pick("invoice", "cur", "invoice_currency"),
        pick("declaration", _dollars("c"), "declaration_invoice_total"),
        pick("declaration", _dollars("tax_a"), "declaration_tax_A"),
        pick("declaration", _dollars("tax_b"), "declaration_tax_B"),
        pick("declaration", _dollars("vat"), "declaration_VAT"),
        pick("declaration", _dollars("royalty"), "declaration_royalty"),
        pick("declaration", _dollars("total"), "declaration_total"),
        pick("declaration", "cur", "declaration_currency"),
        pick("royalty", "pct", "royalty_percentage"),
    ]
    return f"WITH {CASES} SELECT case_id, path, {', '.join(columns)} FROM docs"


_ELEMENT_COUNT = "CASE role WHEN 'invoice' THEN 5 ELSE 2 END"
_HEADER = (
    "CASE role WHEN 'invoice' THEN 'Commercial invoice ' WHEN 'declaration' "
    "THEN 'Import declaration ' ELSE 'Royalty agreement ' END || k"
)


def _json_item(idx: int, type_: str, content: str) -> str:
    return f"{{'idx': {idx}, 'type': '{type_}', 'content': {content}}}"


_PAYLOAD = (
    "CASE role WHEN 'invoice' THEN to_json(["
    + ", ".join(
        [
            _json_item(0, "section_header", "'Commercial invoice ' || k"),
            _json_item(
                1,
                "text",
                "'Goods sup-' || chr(10) || 'plied by ' || supplier || '.' || chr(10) "
                "|| '  Article: ' || part || '.'",
            ),
            _json_item(4, "table", _INVOICE_HTML),
        ]
    )
    + "])::VARCHAR WHEN 'declaration' THEN to_json(["
    + ", ".join(
        [
            _json_item(0, "section_header", "'Import declaration ' || k"),
            _json_item(1, "table", _DECLARATION_HTML),
        ]
    )
    + "])::VARCHAR ELSE to_json(["
    + ", ".join(
        [
            _json_item(0, "section_header", "'Royalty agreement ' || k"),
            _json_item(1, "text", _ROYALTY_TEXT),
        ]
    )
    + "])::VARCHAR END"
)

# --- pages --------------------------------------------------------------------

_BLOCK = (
    "h[1-6]|p|li|ul|ol|dl|div|table|article|section|aside|nav|main|header|footer|"
    "form|blockquote|pre|head|body|html"
)


def _unescape(c: str) -> str:
    # These names also count without the semicolon.
    for name, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("middot", "·"), ("copy", "©")):
        c = f"regexp_replace({c}, '&{name};?', '{char}', 'g')"
    return f"regexp_replace({c}, '&amp;?', '&', 'g')"


_PAGES = rf"""
WITH visible AS (
  SELECT page_id, regexp_replace(html,
    '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->', ' ', 'g') AS h
  FROM pages),
pieces AS (
  SELECT page_id, p, ordinality AS n
  FROM visible, unnest(string_split(regexp_replace(h, '(?i)(</?(?:{_BLOCK})\b)', chr(1) || '\1', 'g'),
                                    chr(1))) WITH ORDINALITY AS u(p, ordinality)),
kept AS (
  SELECT page_id, n, CASE WHEN regexp_matches(p, '(?i)^<h[1-6]') THEN 'section_header' ELSE 'text' END
           AS type,
         {_squeeze(_unescape("regexp_replace(p, '<[^>]+>', ' ', 'g')"))} AS content
  FROM pieces WHERE regexp_matches(p, '(?i)^<(?:h[1-6]|p|li)\b'))
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INTEGER) AS idx,
       type, content
FROM kept WHERE content <> ''
"""

# --- text -----------------------------------------------------------------------

STOP_WORDS = {
    "en": ("the", "and", "of", "to", "is", "that", "it", "for", "with", "this", "by", "are"),
    "fr": ("le", "les", "et", "des", "une", "du", "est", "dans", "pour", "sur", "avec", "qui"),
    "de": ("der", "die", "und", "das", "den", "mit", "ist", "nicht", "von", "ein", "auf", "zu"),
    "es": ("el", "los", "las", "y", "por", "con", "para", "una", "del", "se", "como", "su"),
}


def _language() -> str:
    counts = ", ".join(
        f"len(list_filter(t, lambda x: x IN ({', '.join(repr(w) for w in ws)}))) AS n_{code}"
        for code, ws in STOP_WORDS.items()
    )
    return f"""
WITH t AS (SELECT doc_id AS id, {_tokens('text')} AS t FROM documents),
n AS (SELECT id, {counts} FROM t)
SELECT id, CASE greatest(n_en, n_fr, n_de, n_es) WHEN n_en THEN 'en' WHEN n_fr THEN 'fr'
       WHEN n_de THEN 'de' ELSE 'es' END AS detected FROM n"""


_SENTENCES = f"string_split(regexp_replace(text, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1))"

_PARAGRAPHS = f"""
WITH RECURSIVE parts AS (
  SELECT doc_id AS id, list_filter(list_transform(string_split(text, chr(10)),
           lambda x: {_strip('x')}), lambda x: x <> '') AS ps FROM documents),
walk AS (
  SELECT id, ps, 1 AS pos, 0 AS chunk_no, CAST(length(ps[1]) // 4 AS BIGINT) AS used
  FROM parts WHERE len(ps) > 0
  UNION ALL
  SELECT id, ps, pos + 1,
         CASE WHEN used + length(ps[pos + 1]) // 4 > 128 THEN chunk_no + 1 ELSE chunk_no END,
         CASE WHEN used + length(ps[pos + 1]) // 4 > 128 THEN length(ps[pos + 1]) // 4
              ELSE used + length(ps[pos + 1]) // 4 END
  FROM walk WHERE pos < len(ps))
SELECT id, chunk_no, string_agg(ps[pos], chr(10) ORDER BY pos) AS text FROM walk GROUP BY id, chunk_no
"""

# --- search ---------------------------------------------------------------------

_VECTORS = """
dims AS (
  SELECT vec_id AS id, label, unnest(embedding)::DOUBLE AS v,
         generate_subscripts(embedding, 1) AS dim FROM embeddings),
centre AS (SELECT label AS query_id, dim, avg(v) AS v FROM dims GROUP BY label, dim)
"""
_METRIC = {
    "cosine": "sum(d.v * q.v) / (sqrt(sum(d.v * d.v)) * sqrt(sum(q.v * q.v)))",
    "dot": "sum(d.v * q.v)",
    "l2": "-sqrt(sum((d.v - q.v) * (d.v - q.v)))",
}


def _knn_cte(metric: str = "cosine", where: str = "TRUE", k: int = 10) -> str:
    return f"""{_VECTORS},
scored AS (
  SELECT q.query_id, d.id, round({_METRIC[metric]}, 9) AS score
  FROM dims d JOIN centre q USING (dim) WHERE {where} GROUP BY q.query_id, d.id),
knn AS (
  SELECT query_id, id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM scored QUALIFY rank <= {k})
"""


def _knn(metric: str = "cosine", where: str = "TRUE") -> str:
    return f"WITH {_knn_cte(metric, where)} SELECT query_id, id, rank, round(score, 6) AS score FROM knn"


def _lsh_cte() -> str:
    """Pairs that share a bucket of some table of hyperplanes."""
    planes = plane_table(64, LSH_TABLES * LSH_BITS)
    values = ", ".join(
        f"({i + 1}, {p}, {w:.6f}::DOUBLE)" for i, row in enumerate(planes.tolist()) for p, w in enumerate(row)
    )
    return f"""{_VECTORS}, planes(dim, plane, w) AS (VALUES {values}),
sides AS (
  SELECT side, id, plane, sum(v * w) > 0 AS above
  FROM (SELECT 'd' AS side, id, dim, v FROM dims UNION ALL
        SELECT 'q', id, dim, v FROM dims WHERE id % {ASKED_EVERY} = 0)
  JOIN planes USING (dim) GROUP BY side, id, plane),
codes AS (
  SELECT side, id, plane // {LSH_BITS} AS t, sum(above::INTEGER * (1 << (plane % {LSH_BITS}))) AS code
  FROM sides GROUP BY side, id, t),
pairs AS (
  SELECT DISTINCT q.id AS query_id, d.id FROM codes q JOIN codes d USING (t, code)
  WHERE q.side = 'q' AND d.side = 'd')"""


def _nearest(rows: str, centres: str) -> str:
    """id, code and cell of rows; the centre of greatest product, of equals the first."""
    return f"""SELECT s.id, s.code, c.cell FROM {rows} s CROSS JOIN {centres} c
      QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY list_dot_product(s.code, c.code) DESC, c.cell) = 1"""


def _cells_cte() -> str:
    """Cells, margin and the rows each query meets, as the inverted file is defined."""
    vi = vector_index

    def code(v: str) -> str:
        norm = f"sqrt(list_sum(list_transform({v}, lambda x: x * x)))"
        return f"list_transform({v}, lambda x: coalesce(floor({vi.UNIT} * x / nullif({norm}, 0) + 0.5), 0))"

    rounds = "".join(
        f"""
near{r} AS ({_nearest("sample", f"centres{r}")}),
means{r} AS (
  SELECT cell, list(mean ORDER BY dim) AS v FROM (
    SELECT cell, dim, sum(v) / count(*) AS mean
    FROM (SELECT cell, unnest(code) AS v, generate_subscripts(code, 1) AS dim FROM near{r}) GROUP BY cell, dim)
  GROUP BY cell),
centres{r + 1} AS (
  SELECT c.cell, CASE WHEN m.cell IS NULL THEN c.code ELSE {code("m.v")} END AS code
  FROM centres{r} c LEFT JOIN means{r} m USING (cell)),"""
        for r in range(vi.ROUNDS)
    )
    last = f"centres{vi.ROUNDS}"
    return f"""
coded AS (
  SELECT vec_id AS id, {code("embedding::DOUBLE[]")} AS code FROM embeddings WHERE embedding IS NOT NULL),
sample AS (
  SELECT *, row_number() OVER (ORDER BY md5(id::VARCHAR), id) AS n FROM coded QUALIFY n <= {vi.SAMPLE_ROWS}),
centres0 AS (
  SELECT n AS cell, code FROM sample
  WHERE n <= greatest(1, least({vi.MOST_CELLS}, (SELECT count(*) // {vi.ROWS_PER_CELL} FROM sample)))),{rounds}
placed AS ({_nearest("coded", last)}),
asking AS (SELECT * FROM sample WHERE n > (SELECT count(*) FROM sample) - {vi.CALIBRATION_ROWS}),
close AS (
  SELECT a.id AS asked, s.id, s.n FROM asking a JOIN sample s ON a.id <> s.id
  QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY list_dot_product(a.code, s.code) DESC, s.n) <= {vi.NEIGHBOURS}),
to_centres AS (
  SELECT a.id, c.cell, list_dot_product(a.code, c.code) AS product,
    max(list_dot_product(a.code, c.code)) OVER (PARTITION BY a.id) AS best
  FROM (SELECT id, code FROM asking UNION SELECT id, code FROM coded WHERE id % {ASKED_EVERY} = 0) a
  CROSS JOIN {last} c),
gaps AS (
  SELECT best - product AS gap, row_number() OVER (ORDER BY best - product) AS n, count(*) OVER () AS total
  FROM close k JOIN placed p ON p.id = k.id JOIN to_centres t ON t.id = k.asked AND t.cell = p.cell),
margin AS (SELECT max(gap) AS margin FROM gaps WHERE n = ceil({vi.TARGET} * total)),
looked AS (
  SELECT id AS query_id, cell FROM to_centres, margin WHERE product >= best - margin AND id % {ASKED_EVERY} = 0),
met AS (SELECT query_id, p.id, cell, p.code FROM looked JOIN placed p USING (cell))"""


def _bm25_cte(
    k: int,
    questions: str = "SELECT item_id AS query_id, text FROM benchmark",
    documents: str = "documents",
) -> str:
    return f"""
questions AS ({questions}),
lists AS (SELECT doc_id AS id, {_tokens('text')} AS ts FROM {documents}),
totals AS (SELECT count(*) AS n, avg(len(ts)) AS mean_length FROM lists),
words AS (SELECT id, len(ts) AS dl, unnest(ts) AS term FROM lists),
asked AS (SELECT DISTINCT query_id, unnest({_tokens('text')}) AS term FROM questions),
tf AS (SELECT id, dl, term, count(*) AS tf FROM words
       WHERE term IN (SELECT term FROM asked) GROUP BY id, dl, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
bm25_scores AS (
  SELECT query_id, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * 2.2 * tf
           / (tf + 1.2 * (0.25 + 0.75 * dl / mean_length))), 9) AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term), totals GROUP BY query_id, id),
bm25 AS (
  SELECT query_id, id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM bm25_scores QUALIFY rank <= {k})
"""


_SUPPLIED = """SELECT s_suppkey AS query_id, 'goods supplied by ' || s_name AS text
  FROM supplier WHERE s_suppkey % 25 = 1"""

_CHANGED = """
changed AS (
  SELECT doc_id, lang, CASE WHEN doc_id % 3 = 0 THEN text || ' and once more' ELSE text END AS text
  FROM documents WHERE lang <> 'fr'
  UNION ALL SELECT -1 - doc_id, lang, text FROM documents WHERE lang <> 'fr' AND doc_id % 10 = 0)
"""

_EMBED = f"""
hashed AS (
  SELECT 'd' AS side, doc_id AS id, unnest({_tokens('text')}) AS term FROM documents
  UNION ALL SELECT 'q', item_id, unnest({_tokens('text')}) FROM benchmark),
buckets AS (
  SELECT side, id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 256 AS b, count(*)::DOUBLE AS n
  FROM hashed GROUP BY side, id, b),
norms AS (SELECT side, id, sqrt(sum(n * n)) AS norm FROM buckets GROUP BY side, id),
unit AS (SELECT side, id, b, n / norm AS v FROM buckets JOIN norms USING (side, id))
"""


def _semantic_cte(k: int, where: str = "TRUE") -> str:
    return f"""{_EMBED},
dots AS (
  SELECT q.id AS query_id, d.id, sum(q.v * d.v) AS s
  FROM unit q JOIN unit d ON q.b = d.b WHERE q.side = 'q' AND d.side = 'd' GROUP BY q.id, d.id),
semantic AS (
  SELECT item_id AS query_id, doc_id AS id, round(coalesce(s, 0), 9) AS score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY round(coalesce(s, 0), 9) DESC, doc_id)
              AS INTEGER) AS rank
  FROM benchmark CROSS JOIN documents
  LEFT JOIN dots ON dots.query_id = item_id AND dots.id = doc_id
  WHERE {where} QUALIFY rank <= {k})
"""


def _top(name: str, source: str, k: int, order: str = "score DESC, id") -> str:
    return f"""{name} AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS INTEGER) AS rank
  FROM ({source}) QUALIFY rank <= {k})"""


_RRF = """SELECT query_id, id, round(sum(1.0::DOUBLE / (rank + 60)), 9) AS score
  FROM (SELECT query_id, id, rank FROM semantic UNION ALL SELECT query_id, id, rank FROM bm25)
  GROUP BY query_id, id"""
_WEIGHTED = """SELECT query_id, id, round(sum(s), 9) AS score FROM (
    SELECT query_id, id, score / max(score) OVER (PARTITION BY query_id) * 0.6::DOUBLE AS s FROM semantic
    UNION ALL
    SELECT query_id, id, score / max(score) OVER (PARTITION BY query_id) * 0.4::DOUBLE AS s FROM bm25)
  GROUP BY query_id, id"""


def _jaccard(a: str, b: str) -> str:
    return (
        f"coalesce(len(list_intersect(list_distinct({a}), list_distinct({b})))::DOUBLE "
        f"/ nullif(len(list_distinct(list_concat({a}, {b}))), 0), 0)"
    )


def _rerank(pool: str) -> str:
    return f"""SELECT p.query_id, p.id, p.rank AS first_rank,
    round({_jaccard(_tokens('b.text'), _tokens('d.text'))}, 9) AS score
  FROM {pool} p JOIN documents d ON d.doc_id = p.id JOIN benchmark b ON b.item_id = p.query_id"""


_HYBRID = f"{_semantic_cte(20)}, {_bm25_cte(20)}, {_top('fused', _RRF, 5)}"
_FIRST = "score DESC, first_rank, id"
_STRATEGIES = f"""WITH {_semantic_cte(20)}, {_bm25_cte(20)}, {_top('pool', _RRF, 20)},
{_top('reranked', _rerank('pool'), 3, _FIRST)},
compared AS (
  SELECT 'semantic' AS strategy, query_id, id, rank FROM semantic WHERE rank <= 3
  UNION ALL SELECT 'hybrid', query_id, id, rank FROM pool WHERE rank <= 3
  UNION ALL SELECT 'hybrid_rerank', query_id, id, rank FROM reranked)
"""

_PASSAGES = "bm25 JOIN documents ON doc_id = id"

_LINES = f"""SELECT item_id * 100000 + n - 1 AS query_id, l AS text
  FROM (SELECT item_id, list_filter(list_transform(string_split({_strip('text')}, chr(10)),
          lambda x: {_strip('x')}), lambda x: x <> '') AS ls FROM benchmark),
       unnest(ls) WITH ORDINALITY AS u(l, n)"""

# --- sessions, scoring, logs ---------------------------------------------------------

_MESSAGE = "to_json({'role': role, 'content': text})::VARCHAR"
_WORDS = f"len(list_filter(regexp_split_to_array(text, '{WS}+'), lambda x: x <> ''))"


def _any(needles: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower(text), '{n}')" for n in needles) + ")"


_LABELS = ("invoice_total_mismatch", "declaration_total_mismatch", "royalty_mismatch")
_SCORES = rf"""
scores AS (
  SELECT conv_id, turn,
    {_WORDS} < 350 AS word_count_check,
    {_any(('invoice', 'royalty', 'declaration', 'valuation', 'invoice total', 'vat', 'currency'))}
      AS mentions_valuation_docs,
    CAST({_any(('case_id', 'invoice total', 'declaration total', 'declaration invoice total',
                'royalty percentage', 'declaration royalty', 'anomaly', 'mismatch'))} AS INTEGER)
    + CAST({_any(_LABELS)} AS INTEGER)
    + CAST(regexp_matches(lower(text), '\bcase[-_ ]?id\b|\bcase\s*[=:]\s*[a-z0-9_-]+') AS INTEGER)
    + CAST(regexp_matches(text, '(^|[^\p{{L}}\p{{N}}_])\p{{Nd}}+($|[^\p{{L}}\p{{N}}_])') AS INTEGER)
    + CAST({_any(('source', 'document'))} AS INTEGER) AS evidence_citations,
    {_any((*_LABELS, 'anomaly', 'mismatch'))} AS uses_detect_anomalies,
    contains(text, '```') OR contains(lower(text), 'python') AS has_code_example,
    CASE WHEN {_WORDS} BETWEEN 50 AND 200 THEN 1.0::DOUBLE
         WHEN {_WORDS} < 50 THEN {_WORDS} / 50::DOUBLE
         ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE - ({_WORDS} - 200) / 200::DOUBLE) END
      AS response_length_score
  FROM conversations)
"""
_SCORERS = (
    "word_count_check",
    "mentions_valuation_docs",
    "evidence_citations",
    "uses_detect_anomalies",
    "has_code_example",
    "response_length_score",
)

_PAIRS = """
pairs AS (
  SELECT a.conv_id * 1000 + a.turn AS pair_id, a.text AS candidate, b.text AS reference
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1),
toks AS (SELECT pair_id, {c} AS c, {r} AS r FROM pairs)
""".format(c=_tokens("candidate"), r=_tokens("reference"))


def _overlap(n: int) -> str:
    def side(name: str) -> str:
        grams = (
            name
            if n == 1
            else f"list_transform(range(1, len({name}) - {n - 2}), "
            f"lambda i: array_to_string(list_slice({name}, i, i + {n - 1}), ' '))"
        )
        return f"SELECT pair_id, unnest({grams}) AS g FROM toks"

    return f"""
c{n} AS (SELECT pair_id, g, count(*) AS n FROM ({side('c')}) GROUP BY ALL),
r{n} AS (SELECT pair_id, g, count(*) AS n FROM ({side('r')}) GROUP BY ALL),
m{n} AS (SELECT pair_id, sum(least(c{n}.n, r{n}.n)) AS m FROM c{n} JOIN r{n} USING (pair_id, g)
         GROUP BY pair_id)"""


_TRACES = """
traces AS (
  SELECT event_id::VARCHAR AS request_id, 'tr-' || event_id AS trace_id,
         epoch_us(ts) // 1000 AS timestamp_ms, CAST(round(value * 100) AS BIGINT) AS execution_time_ms,
         CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'OK' END AS status,
         event_type, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS kk
  FROM events)
"""
_TRACE_COLUMNS = "request_id, trace_id, timestamp_ms, execution_time_ms, status"

_HOURLY = """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, count(*) AS requests,
  count(*) FILTER (WHERE event_type = 'error') AS errors,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS latency_sum, max(value) AS latency_max
FROM events GROUP BY 1"""

_TOKEN_PRICES = """prices(m, model, in_rate, out_rate) AS (VALUES
  (0, 'Llama 4 Maverick', 7.143::DOUBLE, 21.429::DOUBLE), (1, 'Llama 3.3 70B', 7.143, 21.429),
  (2, 'GPT OSS 120B', 2.143, 8.571), (3, 'Gemma 3 12B', 2.143, 7.143),
  (4, 'Llama 3.1 8B', 2.143, 6.429), (5, 'GPT OSS 20B', 1.000, 4.286))"""
_HOUR_PRICES = """prices(m, model, entry_rate) AS (VALUES
  (0, 'Llama 4 Maverick', 85.714::DOUBLE), (1, 'Llama 3.3 70B', 85.714), (2, 'Llama 3.1 8B', 53.571),
  (3, 'Llama 3.2 3B', 46.429), (4, 'Llama 3.2 1B', 42.857))"""

_MERGE = """
target AS (SELECT 'case_' || c_custkey AS id, '/old/' || c_name AS invoice_path,
                  c_mktsegment AS volume_path FROM customer WHERE c_acctbal >= 0),
source AS (SELECT 'case_' || c_custkey AS id, '/new/' || c_name AS invoice_path
           FROM customer WHERE c_nationkey < 13)
"""


def _supplier(name: str, roles: list[str]) -> str:
    return (
        f"WITH {CASES} SELECT supplier, document_id FROM docs "
        f"WHERE lower(supplier) = lower('{name}') AND role IN ({', '.join(map(repr, roles))})"
    )


ORACLES: dict[str, str] = {
    # sources and sinks
    "case_inventory": f"WITH {FACTS} {_INVENTORY}",
    "complete_cases": f"WITH {FACTS} SELECT * FROM ({_INVENTORY}) WHERE declaration_path IS NOT NULL",
    "completeness": f"""WITH {FACTS} SELECT TRUE AS has_invoice, declaration_path IS NOT NULL
        AS has_declaration, royalty_path IS NOT NULL AS has_royalty, count(*) AS count
        FROM ({_INVENTORY}) GROUP BY ALL""",
    "scan_binary": f"""SELECT 'case_' || o_custkey % {CASE_FOLDERS} AS "case",
        'order ' || o_orderkey || ' of ' || o_custkey AS line FROM orders""",
    "scan_incremental": f"""SELECT 'case_' || o_custkey % {CASE_FOLDERS} AS "case",
        sum(length('order ' || o_orderkey || ' of ' || o_custkey) + 1)::BIGINT AS bytes
        FROM orders WHERE o_orderkey % 3 = 1 GROUP BY 1""",
    "eval_questions": f"""SELECT question FROM (
        SELECT {_strip("unnest(string_split(text, chr(10)))")} AS question FROM benchmark) WHERE question <> ''""",
    "ensure_columns": """SELECT o_orderkey, o_orderstatus, CAST(NULL AS BIGINT) AS processed,
        CAST(NULL AS VARCHAR) AS note FROM orders""",
    "latest_run": "SELECT max(strftime(o_orderdate, '%Y%m%d%H%M')::BIGINT) AS latest_run FROM orders",
    "watermark_start": """SELECT strftime(max(date_trunc('minute', o_orderdate)), '%Y-%m-%d %H:%M:%S')
        AS range_start FROM orders""",
    "sink_append_evolve": """SELECT o_orderkey, o_orderstatus, year(o_orderdate)::BIGINT AS processed,
        CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "sink_overwrite_runs": """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN 'X'
        ELSE o_orderstatus END AS o_orderstatus, year(o_orderdate)::BIGINT AS processed FROM orders""",
    "sink_ignore": "SELECT o_orderkey, o_orderstatus FROM orders",
    "session_append": f"""SELECT turn AS id, conv_id::VARCHAR AS session_id, {_MESSAGE} AS message_data
        FROM conversations""",
    # filters and projections
    "run_slice": f"""WITH {CASES} SELECT path, lang AS source_language, processed FROM docs
        WHERE processed = (SELECT max(processed) FROM cases)""",
    "pending_docs": f"""WITH {CASES} SELECT path, lang AS source_language FROM docs
        WHERE lang <> 'en' AND (lang = 'fr' OR processed = (SELECT max(processed) FROM cases))""",
    "project_scalars": f"WITH {_TRACES} SELECT {_TRACE_COLUMNS} FROM traces",
    "trace_search": f"""WITH {_TRACES} SELECT {_TRACE_COLUMNS} FROM traces WHERE event_type = 'click'
        AND user_id = 7 AND status = 'OK' AND timestamp_ms >= 1704500000000""",
    "latest_traces": f"""WITH {_TRACES} SELECT {_TRACE_COLUMNS} FROM traces
        ORDER BY timestamp_ms DESC, trace_id LIMIT 20""",
    "trace_stats": f"""WITH {_TRACES} SELECT count(*) AS n, round(avg(execution_time_ms), 6) AS avg_ms,
        min(execution_time_ms) AS min_ms, max(execution_time_ms) AS max_ms,
        CAST(sum(kk % 4) AS BIGINT) AS spans FROM traces""",
    "status_counts": f"WITH {_TRACES} SELECT status, count(*) AS count FROM traces GROUP BY status",
    "final_messages": "SELECT conv_id, turn, text AS content FROM conversations WHERE role = 'assistant'",
    # documents
    "parse_elements": _PAGES,
    "path_ids": f"""WITH {FACTS}, names AS (
        SELECT *, unnest([
          '/cases/case_' || k || '/invoice_' || k || '.pdf',
          CASE WHEN c IS NOT NULL THEN '/cases/case_' || k || '/declaration_' || k || '.pdf' END,
          CASE WHEN k % 5 = 0 THEN '/cases/case_' || k || '/royalty_' || k || '.PDF' END,
          '/cases/case_' || k || '/scan_' || k || '.pdf',
          '/cases/case_' || k || '/declaration_' || k || '.txt',
          '/cases/notes_' || k || '/invoice_' || k || '.pdf']) AS path,
          unnest(['invoice_' || k, 'declaration_' || k, 'royalty_' || k || '.PDF', 'scan_' || k,
                  'declaration_' || k || '.txt', 'invoice_' || k]) AS document_id,
          unnest(['invoice', 'declaration', 'royalty', NULL, 'declaration', 'invoice']) AS role,
          unnest([1, 2, 3, 4, 5, 6]) AS n
        FROM facts)
        SELECT path, CASE WHEN n = 6 THEN document_id ELSE 'case_' || k END AS case_id, document_id, role
        FROM names WHERE path IS NOT NULL""",
    "html_table_cells": f"""WITH {CASES}, listed AS (
        SELECT path, [{', '.join(_INVOICE_ROWS)}] AS rs FROM docs WHERE role = 'invoice'
        UNION ALL SELECT path, {_DECLARATION_LIST} FROM docs WHERE role = 'declaration')
        SELECT path, CAST(n - 1 AS INTEGER) AS row_no, r AS cells
        FROM listed, unnest(rs) WITH ORDINALITY AS u(r, n)""",
    "invoice_fields": f"""WITH {CASES} SELECT path, {_dollars('inv')} AS amount, cur AS currency
        FROM docs WHERE role = 'invoice'""",
    "declaration_fields": f"""WITH {CASES} SELECT path, {_dollars('c')} AS declaration_invoice_total,
        {_dollars('tax_a')} AS "declaration_tax_A", {_dollars('tax_b')} AS "declaration_tax_B",
        {_dollars('vat')} AS "declaration_VAT", {_dollars('royalty')} AS declaration_royalty,
        {_dollars('total')} AS declaration_total, cur AS declaration_currency,
        CAST(0 AS INTEGER) AS bad_amounts FROM docs WHERE role = 'declaration'""",
    "royalty_pct": f"""WITH {CASES} SELECT path, CASE role WHEN 'royalty' THEN pct END
        AS royalty_percentage FROM docs""",
    "structured_metadata": _metadata(),
    "case_rollup": f"WITH {CASES} SELECT case_id, {FIELD_COLUMNS} FROM cases",
    "extract_chunks": f"WITH {CHUNKS} SELECT {_CHUNK_COLUMNS} FROM chunks",
    "unreadable_documents": f"""WITH {CASES} SELECT path,
        CASE WHEN k % 13 = 1 THEN 1::INTEGER END AS bad_elements FROM docs WHERE k % 13 IN (0, 1)""",
    "damaged_chunks": f"""WITH {CHUNKS} SELECT path AS document_path, count(*) AS chunks FROM chunks
        WHERE k % 13 <> 0 GROUP BY path""",
    "pipeline_run": _BATCH,
    "pipeline_rerun": _BATCH,
    "pipeline_search": f"""WITH {_bm25_cte(5, _SUPPLIED, f"(SELECT id AS doc_id, text FROM ({_BATCH}))")}
        SELECT query_id, id, rank, round(score, 6) AS score FROM bm25""",
    "stream_cases": f"SELECT * EXCLUDE (processed) FROM ({_BATCH})",
    "stream_waiting": f"""WITH {FACTS} SELECT id, invoice_path IS NOT NULL AS has_invoice
        FROM ({_INVENTORY}) WHERE declaration_path IS NULL""",
    "chunks_enriched": f"""WITH {CHUNKS} SELECT {_CHUNK_COLUMNS}, {FIELD_COLUMNS}, {_CASE_PATHS},
        concat_ws(' | ', invoice_path, declaration_path, royalty_path) AS metadata FROM chunks""",
    "apply_translations": f"""WITH {CASES} SELECT path, CAST({_ELEMENT_COUNT} AS INTEGER) AS elements,
        CASE WHEN lang = 'en' THEN '' ELSE 'EN: ' END || {_HEADER} AS first_content,
        'section_header|' || CASE role WHEN 'invoice' THEN 'text|page_footer|text|table'
          WHEN 'declaration' THEN 'table' ELSE 'text' END AS types FROM docs""",
    "translation_payload": f"WITH {CASES} SELECT path, {_PAYLOAD} AS payload FROM docs",
    "translation_outcome": f"""WITH {CASES} SELECT path,
        CASE lang WHEN 'de' THEN 'en' ELSE lang END AS source_language, lang = 'es' AS applied,
        CASE lang WHEN 'es' THEN 'EN: ' ELSE '' END || {_HEADER} AS first_content FROM docs""",
    "recover_json": """SELECT conv_id, turn, CASE WHEN turn % 4 < 3 THEN role END AS found_role,
        CASE WHEN turn % 4 < 3 THEN turn END AS found_turn FROM conversations""",
    # rules
    "anomalies_all": f"WITH {ANOMALIES} SELECT * FROM anomalies",
    "anomalies_one_rule": f"""WITH {ANOMALIES} SELECT * FROM anomalies
        WHERE anomaly_rule = 'DECLARATION_TOTAL_MISMATCH'""",
    "anomalies_sql_fn": f"WITH {ANOMALIES} SELECT * FROM anomalies",
    "anomalies_sql_fn_one": f"""WITH {ANOMALIES} SELECT * FROM anomalies
        WHERE anomaly_rule = 'ROYALTY_MISMATCH'""",
    # merges
    "merge_upsert": f"""WITH {_MERGE} SELECT id, coalesce(t.invoice_path, s.invoice_path) AS invoice_path,
        CASE WHEN s.id IS NULL THEN 1 ELSE 2 END::BIGINT AS processed,
        CASE WHEN s.id IS NULL THEN t.volume_path ELSE 'v2' END AS volume_path
        FROM target t FULL JOIN source s USING (id)""",
    "merge_insert_only": f"""WITH {_MERGE} SELECT id, coalesce(t.invoice_path, s.invoice_path)
        AS invoice_path, CASE WHEN t.id IS NULL THEN 2 ELSE 1 END::BIGINT AS processed,
        CASE WHEN t.id IS NULL THEN 'v2' ELSE t.volume_path END AS volume_path
        FROM target t FULL JOIN source s USING (id)""",
    "merge_update_only": f"""WITH {_MERGE} SELECT t.id, coalesce(s.invoice_path, t.invoice_path)
        AS invoice_path, CASE WHEN s.id IS NULL THEN 1 ELSE 2 END::BIGINT AS processed,
        CASE WHEN s.id IS NULL THEN t.volume_path ELSE 'v2' END AS volume_path
        FROM target t LEFT JOIN source s ON s.id = t.id""",
    "index_delta": "SELECT doc_id AS id, lang FROM documents WHERE lang <> 'en'",
    # text
    "clean_text": f"""SELECT doc_id AS id, {_squeeze(
        "regexp_replace(text, '([" + chr(92) + "p{L}" + chr(92) + "p{N}_])-" + WS + "*" + chr(92)
        + "n" + WS + "*([" + chr(92) + "p{L}" + chr(92) + "p{N}_])', '" + chr(92) + "1" + chr(92)
        + "2', 'g')")} AS cleaned FROM documents""",
    "excerpt": r"""SELECT doc_id AS id, substr(text, 1, 200) || '...' AS excerpt,
        replace(substr(text, 1, 300), chr(10), '\n') AS preview FROM documents""",
    "chunk_stats": """SELECT count(*) AS n, round(avg(length(text)), 6) AS avg_length,
        min(length(text))::INTEGER AS min_length, max(length(text))::INTEGER AS max_length
        FROM documents""",
    "chunk_fixed": """SELECT doc_id AS id, s::INTEGER AS start, substr(text, s + 1, 500) AS text
        FROM documents, unnest(range(0, length(text), 450)) AS u(s)""",
    "chunk_sentence": f"""WITH t AS (SELECT doc_id AS id, {_SENTENCES} AS s FROM documents)
        SELECT id, CAST((i - 1) // 5 AS INTEGER) AS chunk_no,
        array_to_string(list_slice(s, i, i + 4), ' ') AS text
        FROM t, unnest(range(1, len(s) + 1, 5)) AS u(i)""",
    "chunk_paragraph": _PARAGRAPHS,
    "detect_language": _language(),
    "language_grams": f"WITH {_GRAMS} SELECT * FROM counts",
    "detect_language_grams": f"""WITH {_GRAMS},
        totals AS (SELECT lang, count(*) AS total FROM sample GROUP BY lang),
        kept AS (SELECT gram FROM counts GROUP BY gram ORDER BY sum(texts) DESC, gram LIMIT {language_model.MOST_GRAMS}),
        shares AS (SELECT gram, lang, ln((coalesce(texts, 0) + 1) / (total + 2)) AS share
          FROM kept CROSS JOIN totals LEFT JOIN counts USING (gram, lang)),
        model AS (SELECT gram, lang, round(share - avg(share) OVER (PARTITION BY gram), 6) AS weight FROM shares),
        scores AS (SELECT id, lang, round(sum(weight), 6) AS score
          FROM (SELECT doc_id AS id, unnest({_GRAMS_OF}) AS gram FROM plain) JOIN model USING (gram)
          GROUP BY id, lang),
        best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) = 1)
        SELECT doc_id AS id, lang AS detected, round(score, 3) AS score
        FROM (SELECT doc_id FROM documents) LEFT JOIN best ON id = doc_id""",
    "dedup_exact": """SELECT min(doc_id) AS id, count(*) AS copies FROM documents GROUP BY text""",
    # arithmetic and cost
    "arith_functions": """SELECT l_orderkey, l_linenumber, l_partkey,
        l_extendedprice + l_quantity AS added, l_extendedprice - l_quantity AS subtracted,
        l_quantity * l_discount AS multiplied,
        CASE WHEN l_discount <> 0 THEN l_quantity / l_discount END AS divided FROM lineitem""",
    "calculator": """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber % 4
        WHEN 0 THEN l_quantity + l_discount WHEN 1 THEN l_quantity - l_discount
        WHEN 2 THEN l_quantity * l_discount
        ELSE CASE WHEN l_discount = 0 THEN 'inf'::DOUBLE ELSE l_quantity / l_discount END END AS result
        FROM lineitem""",
    "usage_cost": f"""WITH {_TOKEN_PRICES}, used AS (
        SELECT event_id % 6 AS m, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS tokens_in,
               CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS tokens_out
        FROM events GROUP BY 1)
        SELECT model, tokens_in, tokens_out,
               round(tokens_in / 1e6 * in_rate + tokens_out / 1e6 * out_rate, 6) AS cost
        FROM used JOIN prices USING (m)""",
    "provisioned_cost": f"""WITH {_HOUR_PRICES}, used AS (
        SELECT event_id % 5 AS m, count(DISTINCT date_trunc('hour', ts)) AS hours FROM events GROUP BY 1)
        SELECT model, hours, round(hours * entry_rate, 6) AS total_cost,
               hours * 65 * 3600 AS total_tokens,
               round(hours * entry_rate / (hours * 65 * 3600) * 1e6, 6) AS cost_per_million
        FROM used JOIN prices USING (m)""",
    "cost_difference": f"""WITH {_TOKEN_PRICES}, used AS (
        SELECT event_id % 6 AS m, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS tokens_in,
               CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS tokens_out
        FROM events GROUP BY 1),
        {_HOUR_PRICES.replace("prices(", "hour_prices(")}, hours AS (
        SELECT event_id % 5 AS m, count(DISTINCT date_trunc('hour', ts)) AS hours FROM events GROUP BY 1)
        SELECT p.model, round(round(tokens_in / 1e6 * in_rate + tokens_out / 1e6 * out_rate, 6)
               - round(hours * entry_rate, 6), 6) AS difference
        FROM used JOIN prices p USING (m)
        JOIN (SELECT model, hours, entry_rate FROM hours JOIN hour_prices USING (m)) h ON h.model = p.model""",
    # vectors
    "knn_topk": _knn(),
    "knn_dot": _knn("dot"),
    "knn_l2": _knn("l2"),
    "knn_filtered": _knn(where="d.label = 3"),
    "knn_range_filtered": _knn(where="d.label >= 5"),
    "ann_lsh": f"""WITH {_lsh_cte()}, scored AS (
          SELECT query_id, p.id, round({_METRIC["cosine"]}, 9) AS score
          FROM pairs p JOIN dims d USING (id) JOIN dims q ON q.id = p.query_id AND q.dim = d.dim
          GROUP BY query_id, p.id),
        {_top("best", "SELECT * FROM scored", 10)}
        SELECT query_id, id, rank, round(score, 6) AS score FROM best""",
    "ann_cells": f"""WITH {_cells_cte()}, {_VECTORS}, short AS (
          SELECT m.query_id, m.id FROM met m JOIN coded q ON q.id = m.query_id
          QUALIFY row_number() OVER (
            PARTITION BY query_id ORDER BY list_dot_product(m.code, q.code) DESC, m.id) <= {10 * vector_index.SHORT}),
        scored AS (
          SELECT query_id, p.id, round({_METRIC["cosine"]}, 9) AS score
          FROM short p JOIN dims d USING (id) JOIN dims q ON q.id = p.query_id AND q.dim = d.dim
          GROUP BY query_id, p.id),
        {_top("best", "SELECT * FROM scored", 10)}
        SELECT query_id, id, rank, round(score, 6) AS score FROM best""",
    "ann_cells_met": f"""WITH {_cells_cte()}
        SELECT query_id, count(DISTINCT cell) AS cells, count(*) AS rows FROM met GROUP BY query_id""",
    "ann_candidates": f"WITH {_lsh_cte()} SELECT query_id, count(*) AS scored FROM pairs GROUP BY query_id",
    "retrieval_metrics": f"""WITH {_knn_cte()}, totals AS (
        SELECT label AS query_id, count(*) AS total FROM embeddings GROUP BY label),
        m AS (
        SELECT query_id, sum((label = query_id)::INT) AS found,
          min(CASE WHEN label = query_id THEN rank END) AS first_hit,
          sum((label = query_id)::INT / log2(rank + 1)) AS dcg
        FROM knn JOIN embeddings ON vec_id = id GROUP BY query_id)
        SELECT query_id, round(found / 10, 6) AS precision, round(found / total, 6) AS recall,
          round(coalesce(1 / first_hit, 0), 6) AS mrr,
          round(dcg / list_sum(list_transform(range(1, least(total, 10) + 1),
                                              lambda i: 1 / log2(i + 1))), 6) AS ndcg
        FROM totals JOIN m USING (query_id)""",
    # keywords and fusion
    "embed_hash": f"""WITH {_EMBED} SELECT doc_id AS id, count(v)::INTEGER AS filled,
        round(coalesce(max(v), 0), 6) AS greatest
        FROM documents LEFT JOIN unit ON side = 'd' AND id = doc_id GROUP BY doc_id""",
    "bm25_topk": f"WITH {_bm25_cte(10)} SELECT query_id, id, rank, round(score, 6) AS score FROM bm25",
    "hybrid_rrf": f"""WITH {_semantic_cte(20)}, {_bm25_cte(20)}, {_top('fused', _RRF, 10)}
        SELECT query_id, id, rank, round(score, 6) AS score FROM fused""",
    "hybrid_weighted": f"""WITH {_semantic_cte(20)}, {_bm25_cte(20)}, {_top('fused', _WEIGHTED, 10)}
        SELECT query_id, id, rank, round(score, 6) AS score FROM fused""",
    "rerank_two_stage": f"""WITH {_bm25_cte(20)}, {_top('reranked', _rerank('bm25'), 5, _FIRST)}
        SELECT query_id, id, rank, round(score, 6) AS score FROM reranked""",
    "strategy_compare": f"{_STRATEGIES} SELECT * FROM compared",
    "strategy_overlap": f"""{_STRATEGIES}, votes AS (
        SELECT query_id, id, count(*) AS strategies FROM compared GROUP BY query_id, id)
        SELECT query_id, strategies, count(*) AS ids FROM votes GROUP BY query_id, strategies""",
    "multi_query_fusion": f"""WITH {_bm25_cte(10, _LINES)}, merged AS (
        SELECT query_id // 100000 AS query_id, id, min(rank) AS best_rank, count(*) AS votes
        FROM bm25 GROUP BY 1, 2)
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY best_rank, votes DESC, id)
                       AS INTEGER) AS rank FROM merged QUALIFY rank <= 5""",
    # context
    "context_order": f"""WITH {_knn_cte()}, counted AS (
        SELECT *, count(*) OVER (PARTITION BY query_id) AS n FROM knn)
        SELECT query_id, id, CAST(CASE WHEN n <= 2 OR rank = 1 THEN rank WHEN rank = 2 THEN n - 1
          ELSE rank - 1 END AS BIGINT) AS position
        FROM counted WHERE n <= 2 OR rank < n OR rank = 2""",
    "context_by_role": f"""WITH {_bm25_cte(10)} SELECT query_id, id, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY CASE lang WHEN 'fr' THEN 0 WHEN 'en' THEN 1 WHEN 'de' THEN 2
        ELSE 3 END, rank) AS INTEGER) AS position FROM {_PASSAGES}""",
    "context_by_source": f"""WITH {_bm25_cte(10)}, led AS (
        SELECT *, min(rank) OVER (PARTITION BY query_id, source) AS lead FROM {_PASSAGES})
        SELECT query_id, id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY lead, rank)
        AS INTEGER) AS position FROM led""",
    "context_budget": f"""WITH {_bm25_cte(10)}, used AS (
        SELECT query_id, id, rank, CAST(sum(length(text) // 4) OVER (PARTITION BY query_id ORDER BY rank)
        AS BIGINT) AS used_tokens FROM {_PASSAGES})
        SELECT * FROM used WHERE used_tokens <= 748""",
    "dedup_near": f"""WITH {_bm25_cte(20)}, p AS (
        SELECT query_id, id, rank, {_tokens('text')} AS ts FROM {_PASSAGES})
        SELECT query_id, id, rank FROM p a WHERE NOT EXISTS (
          SELECT 1 FROM p b WHERE b.query_id = a.query_id AND b.rank < a.rank
          AND {_jaccard('a.ts', 'b.ts')} >= 0.5)""",
    "rag_context": f"""WITH {_bm25_cte(5)}, made AS (
        SELECT query_id, string_agg('ID ' || rank || ': ' || id || chr(10) || 'Case ID: ' || source
          || chr(10) || 'Content: ' || text, chr(10) || '---' || chr(10) ORDER BY rank) AS context,
          count(*)::INTEGER AS sources
        FROM {_PASSAGES} GROUP BY query_id)
        SELECT query_id, context, sources,
          'Answer the question from the context below. If it is not covered, say so.' || chr(10)
          || chr(10) || 'CONTEXT:' || chr(10) || context || chr(10) || chr(10) || 'QUESTION: ' || text
          || chr(10) || chr(10) || 'Cite the case ID of every passage you use.' || chr(10) || chr(10)
          || 'ANSWER:' AS prompt
        FROM made JOIN benchmark ON item_id = query_id""",
    "rag_batch": f"""WITH {_HYBRID}, made AS (
          SELECT query_id, to_json(list({{'id': id, 'source': source}} ORDER BY rank))::VARCHAR AS sources,
            string_agg('[Document ' || rank || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY rank) AS context
          FROM fused JOIN documents ON doc_id = id GROUP BY query_id)
        SELECT query_id, sources,
          'Answer from these documents only; if they do not tell, say that you lack the information.'
          || chr(10) || chr(10) || context || chr(10) || chr(10) || 'Question: ' || text
          || chr(10) || chr(10) || 'Answer:' AS prompt
        FROM made JOIN benchmark ON item_id = query_id""",
    "rag_chat": f"""WITH {_HYBRID}, made AS (
          SELECT query_id, string_agg('[ID: ' || id || ', Case ID: ' || source || ']: ' || text,
            chr(10) || chr(10) ORDER BY rank) AS context
          FROM fused JOIN documents ON doc_id = id WHERE score >= 0.02 GROUP BY query_id)
        SELECT query_id, 0::INTEGER AS pos, 'system' AS role,
          'You assist with research on stored cases. Use this context to answer.' || chr(10) || 'CONTEXT:'
          || chr(10) || context || chr(10)
          || 'Say so if it holds nothing relevant, and cite the Case ID of every claim.' AS content FROM made
        UNION ALL SELECT query_id, 1::INTEGER, 'user', text FROM made JOIN benchmark ON item_id = query_id""",
    "search_records": f"""WITH es_documents AS (SELECT * FROM documents WHERE lang = 'es'),
        {_HYBRID.replace("documents", "es_documents").replace("rank <= 5", "rank <= 3")}
        SELECT query_id, rank, to_json({{'Case': source, 'ID': id::VARCHAR, 'language': lang,
          'excerpt': substr(text, 1, 200) || '...'}})::VARCHAR AS record
        FROM fused JOIN documents ON doc_id = id""",
    "extractive_summary": f"""WITH s AS (
        SELECT doc_id AS id, CAST(n AS INTEGER) AS sentence_no, {_strip('p')} AS sentence
        FROM documents, unnest({_SENTENCES}) WITH ORDINALITY AS u(p, n)),
        w AS (SELECT id, sentence_no, unnest({_tokens('sentence')}) AS term FROM s),
        f AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({_tokens('text')}) AS term
              FROM documents) GROUP BY term),
        scored AS (SELECT id, sentence_no,
          round(sum(ln((SELECT count(*) FROM documents) / df)) / count(*), 9) AS score
          FROM w JOIN f USING (term) GROUP BY id, sentence_no),
        best AS (SELECT * FROM scored
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, sentence_no) <= 2)
        SELECT id, sentence_no, sentence, round(score, 6) AS score FROM best JOIN s USING (id, sentence_no)""",
    "diverse_summary": f"""WITH s AS (
        SELECT doc_id AS id, CAST(n AS INTEGER) AS sentence_no, {_strip('p')} AS sentence
        FROM documents, unnest({_SENTENCES}) WITH ORDINALITY AS u(p, n)),
        coded AS (SELECT *, list_transform({_tokens('sentence')},
          lambda t: ('0x' || substr(md5(t), 1, 8))::BIGINT % {context.TERM_BUCKETS}) AS words FROM s),
        f AS (SELECT bucket, ln((SELECT count(*) FROM documents) / count(DISTINCT id)) AS idf
          FROM (SELECT id, unnest(words) AS bucket FROM coded) GROUP BY bucket),
        scored AS (SELECT id, sentence_no, round(avg(idf) * (1 + 1 / sentence_no)
            * least(1, count(*) / {context.FULL_SENTENCE}), 9) AS score
          FROM (SELECT id, sentence_no, unnest(words) AS bucket FROM coded) JOIN f USING (bucket)
          GROUP BY id, sentence_no),
        all_ AS (SELECT id, sentence_no, sentence, list_distinct(words) AS words, score
          FROM scored JOIN coded USING (id, sentence_no)),
        first_ AS (SELECT * FROM all_ QUALIFY row_number() OVER (
          PARTITION BY id ORDER BY round({context.OWN_SHARE}::DOUBLE * score, 9) DESC, sentence_no) = 1),
        second_ AS (SELECT a.* FROM all_ a JOIN first_ f ON f.id = a.id AND f.sentence_no <> a.sentence_no
          QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY round({context.OWN_SHARE}::DOUBLE * a.score
            - (1 - {context.OWN_SHARE}::DOUBLE) * (len(list_intersect(a.words, f.words))::DOUBLE
              / len(list_distinct(list_concat(a.words, f.words)))) * f.score, 9) DESC,
            a.sentence_no) = 1)
        SELECT id, sentence_no, sentence, round(score, 6) AS score
        FROM (SELECT * FROM first_ UNION ALL SELECT * FROM second_)""",
    "result_rows": f"""WITH {_bm25_cte(10)} SELECT query_id, 2::INTEGER AS entries, id, rank FROM bm25""",
    # sessions
    "session_history": f"""SELECT conv_id::VARCHAR AS session_id, {_MESSAGE} AS message_data,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn // 2, turn) AS seq FROM conversations""",
    "last_message": """SELECT conv_id, turn, role, text FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    "conversation_prompt": """WITH ids AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1)
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ordinal, role,
               text AS content FROM conversations
        UNION ALL SELECT conv_id, 0, 'system', 'You audit customs cases.' FROM ids
        UNION ALL SELECT conv_id, n + 1, 'user', 'Next for ' || conv_id FROM ids
        UNION ALL SELECT conv_id + 1000000000, 0, 'system', 'You audit customs cases.' FROM ids
        UNION ALL SELECT conv_id + 1000000000, 1, 'user', 'Next for ' || (conv_id + 1000000000) FROM ids""",
    # scoring
    "score_answers": f"WITH {_SCORES} SELECT * FROM scores",
    "eval_summary": f"WITH {_SCORES} "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS metric, round(avg({s}::DOUBLE), 6) AS value FROM scores" for s in _SCORERS
    ),
    "text_overlap_metrics": f"""WITH {_PAIRS}, {_overlap(1)}
        SELECT pair_id, c = r AS exact_match,
          round(coalesce(2 * m / nullif(len(c) + len(r), 0), 0), 6) AS token_f1,
          round(coalesce(m / nullif(len(r), 0), 0), 6) AS rouge1
        FROM toks LEFT JOIN m1 USING (pair_id)""",
    "bleu4": f"""WITH {_PAIRS}, {_overlap(1)}, {_overlap(2)}, {_overlap(3)}, {_overlap(4)}
        SELECT pair_id, round(CASE WHEN m1.m > 0 AND m2.m > 0 AND m3.m > 0 AND m4.m > 0 THEN
            CASE WHEN len(c) > len(r) THEN 1 ELSE exp(1 - len(r) / len(c)) END
            * pow((m1.m / len(c)) * (m2.m / (len(c) - 1)) * (m3.m / (len(c) - 2)) * (m4.m / (len(c) - 3)), 0.25)
            ELSE 0 END, 6) AS bleu
        FROM toks LEFT JOIN m1 USING (pair_id) LEFT JOIN m2 USING (pair_id)
        LEFT JOIN m3 USING (pair_id) LEFT JOIN m4 USING (pair_id)""",
    "bleu": f"""WITH {_PAIRS}, {_overlap(1)}, {_overlap(2)}
        SELECT pair_id, round(CASE WHEN m1.m > 0 AND m2.m > 0 THEN
            CASE WHEN len(c) > len(r) THEN 1 ELSE exp(1 - len(r) / len(c)) END
            * sqrt((m1.m / len(c)) * (m2.m / (len(c) - 1))) ELSE 0 END, 6) AS bleu
        FROM toks LEFT JOIN m1 USING (pair_id) LEFT JOIN m2 USING (pair_id)""",
    # logs and streams
    "log_hourly": _HOURLY,
    "stream_log_hourly": _HOURLY,
    "stream_sessions": f"""SELECT conv_id::VARCHAR AS session_id, turn AS id, {_MESSAGE} AS message_data
        FROM conversations""",
    "stream_elements": _PAGES,
    "stream_index_sync": f"""WITH {_EMBED} SELECT doc_id AS id, count(v)::INTEGER AS filled,
        round(coalesce(max(v), 0), 6) AS greatest
        FROM documents LEFT JOIN unit ON id = doc_id AND side = 'd' GROUP BY doc_id""",
    "near_join": f"""WITH words AS (SELECT doc_id AS id, coalesce({_tokens('text')}, []) AS ts FROM documents),
        sets AS (SELECT id, CASE WHEN len(ts) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
          range(1, greatest(len(ts) - {_NEAR.SHINGLE - 1}, 1) + 1),
          lambda i: array_to_string(ts[i:i + {_NEAR.SHINGLE - 1}], ' ')))) END AS s FROM words),
        classes AS (SELECT s, min(id) AS class_id, count(*) AS members FROM sets GROUP BY s),
        grams AS (SELECT class_id, members, len(s) AS n, unnest(s) AS g FROM classes),
        near AS (SELECT a.class_id, b.class_id AS other, any_value(b.members) AS others
          FROM grams a JOIN grams b ON a.g = b.g AND a.class_id <> b.class_id GROUP BY a.class_id, b.class_id
          HAVING count(*)::DOUBLE / (any_value(a.n) + any_value(b.n) - count(*)) >= {_NEAR.THRESHOLD}::DOUBLE),
        links AS (SELECT class_id, sum(others) AS others FROM near GROUP BY class_id)
        SELECT id, class_id, members, (members - 1 + coalesce(others, 0))::BIGINT AS links
        FROM sets JOIN classes USING (s) LEFT JOIN links USING (class_id)""",
    "index_delete": f"""WITH {_CHANGED}, lists AS (SELECT doc_id AS id, lang, {_tokens('text')} AS ts FROM changed)
        SELECT id, lang, coalesce(len(ts), 0)::BIGINT AS length,
          coalesce(len(list_distinct(ts)), 0)::INTEGER AS terms FROM lists""",
    "index_delete_search": f"""WITH {_CHANGED}, {_bm25_cte(10, documents="changed")}
        SELECT query_id, id, rank, round(score, 6) AS score FROM bm25""",
    "index_search": f"""WITH {_semantic_cte(10)}
        SELECT query_id, id, rank, round(score, 6) AS score FROM semantic""",
    "index_search_filtered": f"""WITH {_semantic_cte(10, "lang = 'fr'")}
        SELECT query_id, id, rank, round(score, 6) AS score FROM semantic""",
    # the question set
    "q01": f"WITH {CASES} SELECT document_id FROM docs WHERE pct = 3.5",
    "q02": f"WITH {CASES} SELECT DISTINCT supplier FROM cases",
    "q03": f"WITH {CASES} SELECT DISTINCT pct AS royalty_percentage FROM cases WHERE pct IS NOT NULL",
    "q04": f"""WITH {CASES} SELECT case_id AS id, strftime(ordered, '%Y-%m-%dT%H:%M:%S')
        AS ingestion_timestamp FROM cases WHERE ordered = (SELECT max(ordered) FROM cases)""",
    "q05": f"""WITH {CASES} SELECT document_id, pct AS royalty_percentage FROM docs
        WHERE role = 'royalty' AND pct = (SELECT max(pct) FROM cases)""",
    "q06": f"WITH {ANOMALIES} SELECT * FROM anomalies ORDER BY case_id, anomaly_rule",
    "q07": f"""WITH {CASES} SELECT document_id FROM docs
        WHERE role = 'invoice' AND lower(part) LIKE '%blue bolt%'""",
    "q08": f"WITH {CASES} SELECT count(*) AS documents FROM docs WHERE lang = 'es'",
    "q09": _supplier("Supplier#000000001", ["invoice", "declaration"]),
    "q10": _supplier("DOES_NOT_EXIST_999", ["invoice", "declaration"]),
    "q11": f"WITH {CASES} SELECT document_id FROM docs WHERE pct = 99",
    "q12": f"""WITH {CASES} SELECT supplier, count(*) AS documents FROM docs WHERE supplier <> 'unknown'
        GROUP BY supplier ORDER BY documents DESC, supplier LIMIT 1""",
    "q13": f"""WITH {CASES} SELECT document_id, pct AS royalty_percentage FROM docs
        WHERE role = 'royalty' AND pct > 2 AND pct < 6""",
    "q14": _supplier("SUPPLIER#000000002", ["invoice"]),
}
