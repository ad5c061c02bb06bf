"""The registered queries as DuckDB SQL over views of the same tables.

The SQL is written on its own, not derived from the Spark plans: RE2 patterns
instead of Java ones, recursive SQL instead of one regular expression for the
chunks, list functions instead of numpy for the vectors.
"""

from __future__ import annotations

from sheetlake.functions import fixed
from sheetlake.plans import tables as t
from sheetlake.plans.queries import CHUNK_BYTES, KEY_SOURCES, LENGTH_SOURCES, PART_BYTES, TYPE_SOURCES

COLUMNS = {
    "customer": {"c_custkey": "", "c_name": "", "c_nationkey": "", "c_acctbal": "double", "c_mktsegment": ""},
    "supplier": {"s_suppkey": "", "s_name": "", "s_nationkey": "", "s_acctbal": "double"},
    "part": {"p_partkey": "", "p_name": "", "p_brand": "", "p_type": "", "p_size": "", "p_retailprice": "double"},
    "orders": {
        "o_orderkey": "", "o_custkey": "", "o_orderstatus": "", "o_totalprice": "double",
        "o_orderdate": "time", "o_orderpriority": "",
    },
    "events": {"event_id": "", "ts": "time", "user_id": "", "event_type": "", "value": "double", "props": ""},
    "documents": {"doc_id": "", "text": "", "lang": "", "source": "", "n_chars": ""},
}


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def txt(column: str, kind: str) -> str:
    if kind == "double":
        return f"CAST(CAST({column} AS DECIMAL(18,2)) AS VARCHAR)"
    if kind == "time":
        return f"strftime({column}, '%Y-%m-%d')"
    return f"CAST({column} AS VARCHAR)"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def contains_any(column: str, words) -> str:
    return "(" + (" OR ".join(f"contains({column}, {lit(w)})" for w in words) or "false") + ")"


# --- relations -----------------------------------------------------------------
def headers_of(tables) -> str:
    rows = [f"({lit(n)}, {i}, {lit(c)})" for n in tables for i, c in enumerate(COLUMNS[n])]
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) AS v(source, pos, name))"


def cells_of(tables, wanted=lambda name: True, sample: int | None = None) -> str:
    parts = []
    for n in tables:
        columns = COLUMNS[n]
        first = next(iter(columns))
        base = f"(SELECT * FROM {n} ORDER BY {first} LIMIT {sample})" if sample else n
        for i, (c, kind) in enumerate(columns.items()):
            if wanted(c):
                parts.append(
                    f"SELECT {lit(n)} AS source, {first} AS row_no, {i} AS pos, {lit(c)} AS name, "
                    f"coalesce({txt(c, kind)}, '') AS value FROM {base} AS {n}"
                )
    return "(" + union(parts) + ")"


DOC_HEADERS = "(SELECT source, doc_id AS pos, text AS name FROM documents)"

ORDER_HEADERS = """(SELECT CAST(l_orderkey AS VARCHAR) AS source, l_linenumber AS pos,
    max(l_returnflag) || '-' || CAST(CAST(max(l_quantity) AS INT) AS VARCHAR) AS name
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""

AMOUNT_HEADERS = """(SELECT strftime(l_shipdate, '%Y') AS source, l_linenumber AS pos, CASE l_linenumber
    WHEN 1 THEN '支出先-' || l_returnflag || '-支出額（百万円）' || l_suppkey
    WHEN 2 THEN '執行額' || l_suppkey
    WHEN 3 THEN '支出先の評価' || l_suppkey
    WHEN 4 THEN '支出済額-' || l_suppkey
    WHEN 5 THEN '支出' || l_suppkey || '額の説明は妥当か。'
    WHEN 6 THEN '予算-支出額-' || l_suppkey || '執行額'
    ELSE '支出' || l_suppkey END AS name
  FROM lineitem)"""

LONG_LINEITEM = """(SELECT 'database' || strftime(l_shipdate, '%Y') || '.csv' AS source,
    CAST(l_orderkey AS VARCHAR) AS k1,
    CASE l_linenumber
      WHEN 1 THEN '支出先上位10者リスト-' || l_returnflag || '.支払先-' || l_linenumber || '-支出額（百万円）'
      WHEN 2 THEN '支出先上位10者リスト-A.支払先-' || l_linenumber || '-契約-方式'
      WHEN 3 THEN '支出先上位10者リスト-A.支払先-' || l_linenumber
      WHEN 4 THEN '支出先上位10者リスト-A.支払先-x-金額'
      WHEN 5 THEN '予算-グループ-金額-' || l_linenumber
      WHEN 6 THEN '予算-グループ-金額'
      ELSE '事業名' || l_linestatus END AS original_column_name,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS value
  FROM lineitem)"""

# One anchored pattern per indexed shape; a name that fits neither keeps its whole text as detail.
LISTED = r"(?s)^[^-]*-[^-]*[.]支払先-([0-9]+)(?:-(.*))?$"
GROUPED = r"(?s)^[^-]*-グループ-([^-]*)-([0-9]+)(?:-.*)?$"
BLOCK = r"(?s)^[^-]*-([^-]*[.]支払先|グループ)(?:-.*)?$"

PARSED = f"""(SELECT source, k1, original_column_name, value,
    regexp_extract(original_column_name, '^[^-]*') AS concept,
    nullif(regexp_extract(original_column_name, '{BLOCK}', 1), '') AS block,
    nullif(listed.number || grouped.number, '') AS item_index,
    if(listed.number <> '', listed.rest, if(grouped.number <> '', grouped.attribute, original_column_name)) AS detail
  FROM (SELECT *, regexp_extract(original_column_name, '{LISTED}', ['number', 'rest']) AS listed,
      regexp_extract(original_column_name, '{GROUPED}', ['attribute', 'number']) AS grouped
    FROM {LONG_LINEITEM}))"""

CLEAN = f"""(SELECT regexp_extract(source, '([0-9]{{4}})', 1) AS year, k1 || '--' AS business_id,
    concept, block, item_index, detail, value, original_column_name
  FROM {PARSED} WHERE regexp_matches(value, '[^\\s\\x{{3000}}]'))"""


DOCUMENT_PARTS = f"""(WITH pairs AS (SELECT year(o_orderdate) || '-' || o_orderpriority || '--' AS id,
      '注文-' || o_orderstatus AS name, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS value FROM orders),
    sized AS (SELECT *, name || ': ' || value AS text, octet_length(encode(name || ': ' || value)) + 4 AS size FROM pairs),
    placed AS (SELECT *, sum(size) OVER (PARTITION BY id) AS total,
      sum(size) OVER (PARTITION BY id ORDER BY name, value ROWS UNBOUNDED PRECEDING) - size AS start FROM sized)
  SELECT CASE WHEN total > {PART_BYTES} THEN id || '_chunk_' || CAST(start // {PART_BYTES} AS BIGINT) ELSE id END AS id,
    id AS parent_id, string_agg(text, '。 ' ORDER BY name, value) AS contents
  FROM placed GROUP BY 1, 2)"""


# --- lengths and types -----------------------------------------------------------
def bin_case(length: str, labels: bool) -> str:
    whens = []
    for i, b in enumerate(fixed.LENGTH_BINS):
        whens.append(f"WHEN {length} <= {b} THEN {lit(str(b)) if labels else i}")
    last = lit(f"{fixed.LENGTH_BINS[-1]}+") if labels else len(fixed.LENGTH_BINS)
    return f"CASE {' '.join(whens)} ELSE {last} END"


LENGTHS = f"""(SELECT source, 'header' AS kind, length(name) AS length FROM {headers_of(LENGTH_SOURCES)}
  UNION ALL SELECT source, 'cell', length(value) FROM {cells_of(LENGTH_SOURCES)})"""

LENGTH_BINS = f"""(SELECT source, kind, {bin_case('length', False)} AS bin_no, {bin_case('length', True)} AS bin,
    count(*) AS n FROM {LENGTHS} GROUP BY ALL)"""

LENGTH_METRICS = f"""(SELECT source,
    count(*) FILTER (kind = 'header') AS column_count,
    count(*) FILTER (kind = 'cell') AS cell_count,
    max(length) FILTER (kind = 'header') AS max_header_len,
    round(sum(length) FILTER (kind = 'header') / count(*) FILTER (kind = 'header'), 1) AS avg_header_len,
    max(length) FILTER (kind = 'cell') AS max_cell_len,
    round(sum(length) FILTER (kind = 'cell') / count(*) FILTER (kind = 'cell'), 1) AS avg_cell_len
  FROM {LENGTHS} GROUP BY source)"""

NUMBER = r"[0-9]+(_[0-9]+)*"
CELL_KIND = rf"""CASE WHEN regexp_full_match(value, '[\s\x{{3000}}]*') THEN 'empty'
    WHEN lower(value) IN ('true', 'false') THEN 'bool'
    WHEN regexp_full_match(value, '\s*[+-]?{NUMBER}\s*') THEN 'int'
    WHEN regexp_full_match(value,
      '(?i)\s*[+-]?((({NUMBER})(\.({NUMBER})?)?|\.{NUMBER})(e[+-]?{NUMBER})?|nan|inf|infinity)\s*') THEN 'float'
    ELSE 'text' END"""

TYPE_COUNTS = f"""(SELECT source, pos, name, count(*) AS n_rows,
    {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ('empty', 'bool', 'int', 'float', 'text'))},
    max(length(value)) AS max_len, CAST(sum(length(value)) AS BIGINT) AS total_len,
    CAST(coalesce(sum(length(value)) FILTER (kind != 'empty'), 0) AS BIGINT) AS non_empty_len
  FROM (SELECT *, {CELL_KIND} AS kind FROM {cells_of(TYPE_SOURCES)}) GROUP BY source, pos, name)"""

DOMINANT = f"""CASE WHEN n_empty = n_rows THEN 'fully_empty'
    WHEN n_empty / n_rows >= {fixed.DOMINANCE} THEN 'mostly_empty'
    WHEN n_int / (n_rows - n_empty) >= {fixed.DOMINANCE} THEN 'mostly_int'
    WHEN n_float / (n_rows - n_empty) >= {fixed.DOMINANCE} THEN 'mostly_float'
    WHEN n_bool / (n_rows - n_empty) >= {fixed.DOMINANCE} THEN 'mostly_bool'
    WHEN n_text / (n_rows - n_empty) >= {fixed.DOMINANCE} THEN 'mostly_text'
    ELSE 'mixed' END"""


# --- header scores ---------------------------------------------------------------
def keyword_rows(hypothesis) -> str:
    rows = [f"({lit(g)}, {lit(w)})" for g, words in hypothesis.items() for w in words]
    return f"(VALUES {', '.join(rows)}) AS k(target, keyword)"


def exclusivity_rows(header_rows: str, targets) -> str:
    """Counts the targets each header names, then the others for each target."""
    return f"""(WITH named AS (SELECT DISTINCT source, pos, name, target FROM {header_rows} AS h
      JOIN {keyword_rows(targets)} ON contains(h.name, k.keyword))
    SELECT source, pos, name, target, score FROM (
      SELECT *, 1.0::DOUBLE - 0.5::DOUBLE * (count(*) OVER (PARTITION BY source, pos) - 1) AS score FROM named)
    WHERE score > 0)"""


AMOUNT_RANKS = f"""(WITH scored AS (SELECT name, source,
      CASE WHEN {contains_any('name', fixed.RANK_CATEGORIES[0] + fixed.RANK_CATEGORIES[1])}
           THEN 20 * (CAST({contains_any('name', fixed.RANK_CATEGORIES[0])} AS INT)
                    + CAST({contains_any('name', fixed.RANK_CATEGORIES[1])} AS INT))
           WHEN contains(name, '支出') THEN 1 END
      - 15 * ({' + '.join(f"CAST(contains(name, {lit(w)}) AS INT)" for w in fixed.RANK_EXCLUSIONS)})
      - CASE WHEN regexp_matches(name, 'か。?$') THEN 15 ELSE 0 END
      + CASE WHEN contains(name, '-') AND {contains_any("string_split(name, '-')[-1]", fixed.RANK_LAST_PART)}
             THEN 5 ELSE 0 END AS tenths
    FROM {AMOUNT_HEADERS})
  SELECT name AS header_name, sum(tenths) AS tenths, round(sum(tenths) / 10, 2)::DOUBLE AS score,
    count(DISTINCT source) AS found_in_sources_count
  FROM scored WHERE tenths IS NOT NULL GROUP BY name HAVING sum(tenths) > 0)"""

HEADER_TYPES = f"""(WITH h AS MATERIALIZED {ORDER_HEADERS},
    lists AS (SELECT source, count(*) AS column_count, CAST(sum(length(name)) AS BIGINT) AS total_length,
      string_agg(pos || '=' || name, '|' ORDER BY pos) AS content FROM h GROUP BY source)
  SELECT column_count, total_length, count(*) AS n_sources, count(DISTINCT content) = 1 AS consistent,
    dense_rank() OVER (ORDER BY column_count, total_length) AS type_no
  FROM lists GROUP BY column_count, total_length)"""


# --- keys ------------------------------------------------------------------------
def _has(words):
    return lambda name: any(w in name for w in words)


NA_LIST = ", ".join(lit(x) for x in fixed.NA_TOKENS)


def diagnostics(sample: int | None) -> str:
    includes, excludes = _has(t.TABLE_KEY_WORDS), _has(t.TABLE_KEY_EXCLUSIONS)
    cells = cells_of(KEY_SOURCES, lambda n: includes(n) and not excludes(n), sample)
    return f"""WITH c AS (SELECT source, pos, name, row_no,
        CASE WHEN value NOT IN ({NA_LIST}) THEN value END AS value FROM {cells}),
      firsts AS (SELECT source, pos, name, value, min(row_no) AS row_no FROM c WHERE value IS NOT NULL GROUP BY ALL),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY source, pos ORDER BY row_no, value) AS r FROM firsts),
      shown AS (SELECT source, pos, string_agg(value, ' | ' ORDER BY r) AS sample_values
        FROM ranked WHERE r <= {fixed.SAMPLE_VALUES} GROUP BY source, pos)
    SELECT s.source, s.name AS column_name, round(coalesce(s.d / nullif(s.n, 0), 0), 4) AS uniqueness_rate,
      s.n AS non_empty_count, coalesce(shown.sample_values, '') AS sample_values
    FROM (SELECT source, pos, name, count(value) AS n, count(DISTINCT value) AS d FROM c GROUP BY ALL) s
    LEFT JOIN shown USING (source, pos)"""


def sketched() -> str:
    cells = cells_of(KEY_SOURCES, _has(t.TABLE_KEY_WORDS), None)
    return f"""SELECT source, name, count(value) AS non_empty_count, count(DISTINCT value) AS n_distinct, true AS within_error
      FROM (SELECT source, pos, name, CASE WHEN value NOT IN ({NA_LIST}) THEN value END AS value FROM {cells})
      GROUP BY source, pos, name"""


def key_map(sample: int | None) -> str:
    words, trumps = ("key", "name", "date"), ("o_orderdate", "p_partkey")
    cells = cells_of(KEY_SOURCES, _has((*words, *trumps)), sample)
    ranks = " ".join(f"WHEN name = {lit(x)} AND u > 0.3 THEN {len(trumps) - i}" for i, x in enumerate(trumps))
    sources = ", ".join(f"({lit(s)})" for s in KEY_SOURCES)
    return f"""WITH c AS (SELECT source, pos, name, CASE WHEN value NOT IN ({NA_LIST}) THEN value END AS value
        FROM {cells}),
      stats AS (SELECT source, pos, name, count(value) AS n, count(DISTINCT value) / nullif(count(value), 0) AS u
        FROM c GROUP BY ALL),
      scored AS (SELECT *, CASE {ranks} ELSE 0 END AS trump,
        CASE WHEN {contains_any('name', words)} AND u >= 0.3 THEN
          100 + CASE WHEN contains(name, 'cust') THEN 100 ELSE 0 END
          - CASE WHEN contains(name, 'nation') THEN 1000 ELSE 0 END
          - 50 * (length(name) - length(replace(name, '-', ''))) - length(name) END AS base FROM stats),
      kept AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY trump DESC,
          CASE WHEN trump = 0 THEN base * u END DESC, pos) AS r
        FROM scored WHERE trump > 0 OR base > -500)
    SELECT s.source, kept.name AS key_column FROM (VALUES {sources}) AS s(source)
    LEFT JOIN kept ON kept.source = s.source AND kept.r = 1"""


def metadata() -> str:
    names = {t.ORDERS_FILE: "orders", "customer": "customer", "part": "part"}
    head_rows, parts = [], []
    for source, table in names.items():
        columns = dict(COLUMNS[table])
        if table == "orders":
            columns["o_orderyear"] = ""
        base = "(SELECT *, year(o_orderdate) AS o_orderyear FROM orders)" if table == "orders" else table
        for i, (c, kind) in enumerate(columns.items()):
            head_rows.append(f"({lit(source)}, {i}, {lit(c)})")
            parts.append(f"SELECT {lit(source)} AS source, {i} AS pos, coalesce({txt(c, kind)}, '') AS value FROM {base}")
    heads = f"(SELECT * FROM (VALUES {', '.join(head_rows)}) AS v(source, pos, name))"
    return f"""WITH stats AS (SELECT source, pos, count(*) AS rows_, count(*) FILTER (filled) AS n,
          count(DISTINCT value) FILTER (filled) AS d,
          count(*) FILTER (value = regexp_extract(source, '(20[0-9][0-9])', 1)) AS y
        FROM (SELECT *, trim(value) != '' AS filled FROM ({union(parts)})) GROUP BY source, pos),
      ranked AS (SELECT e.*, s.*, row_number() OVER (PARTITION BY e.source, e.target ORDER BY
          e.score + CASE WHEN e.target IN ('project_id', 'project_name') THEN s.d / s.n
                         WHEN e.target = 'year' THEN s.y / s.n ELSE 0 END DESC, e.pos) AS r
        FROM {exclusivity_rows(heads, t.TABLE_TARGETS)} e JOIN stats s ON e.source = s.source AND e.pos = s.pos
        WHERE s.n > 0)
    SELECT source, target, name AS column_name, pos AS column_index, score AS exclusivity_score,
      round(d / n, 3) AS uniqueness_rate, round(n / rows_, 3) AS non_empty_rate FROM ranked WHERE r = 1"""


# --- separation --------------------------------------------------------------------
def children(by_block: bool) -> str:
    block = "CASE WHEN l_returnflag = 'R' THEN 'B' ELSE 'A' END"
    per_block = f"""(SELECT l_orderkey, {block} AS block, l_linenumber,
        CAST(CAST(max(l_extendedprice) AS DECIMAL(18,2)) AS VARCHAR) AS amount,
        CAST(max(l_suppkey) AS VARCHAR) AS supplier, CAST(max(l_partkey) AS VARCHAR) AS number
      FROM lineitem GROUP BY ALL)"""
    picked = "{0}" if by_block else "arg_max({0}, block)"
    columns = ", ".join(
        f"{picked.format(c)} AS {n}"
        for c, n in (("amount", "expenditure_amount_jpy_million"), ("supplier", "supplier_name"),
                     ("number", "supplier_corporate_id"))
    )
    return f"""SELECT 'lineitem.csv' AS source, CAST(l_orderkey AS VARCHAR) AS project_id,
      {'block, ' if by_block else ''}l_linenumber AS expenditure_index, {columns},
      CAST(NULL AS VARCHAR) AS contract_summary
    FROM {per_block} {'' if by_block else 'GROUP BY l_orderkey, l_linenumber'}"""


# --- corpus and retrieval ------------------------------------------------------------
WORDS = (
    r"[\p{Han}\p{Hiragana}\p{Katakana}ー]"
    r"|[\p{Latin}\p{Greek}\p{Cyrillic}\p{Arabic}\p{Hebrew}\p{Hangul}\p{Devanagari}\p{Thai}\p{M}\p{N}]+"
)


def words(column: str) -> str:
    return f"regexp_extract_all({column}, {lit(WORDS)})"


DOC_TOKENS = f"(SELECT CAST(doc_id AS VARCHAR) AS id, {words('text')} AS tokens FROM documents)"


def chunks(limit: int) -> str:
    """Greedy cuts as a recursion over the byte offsets of the spaces."""
    size = "octet_length(encode(tokens[i]))"
    return f"""(WITH RECURSIVE docs AS MATERIALIZED (SELECT id, tokens,
          octet_length(encode(array_to_string(tokens, ' '))) AS total FROM {DOC_TOKENS}),
      tok AS MATERIALIZED (SELECT id, i, tokens[i] AS token,
          sum({size} + 1) OVER (PARTITION BY id ORDER BY i) - {size} - 1 AS place
        FROM (SELECT id, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM docs WHERE total > {limit})),
      spaces AS MATERIALIZED (SELECT id, any_value(total) AS total, list(CAST(place - 1 AS BIGINT)) AS offsets
        FROM tok JOIN docs USING (id) WHERE i > 1 GROUP BY id),
      cuts(id, n, start) AS (
        SELECT id, 0::BIGINT, 0::BIGINT FROM spaces
        UNION ALL
        SELECT c.id, c.n + 1,
          list_max(list_filter(s.offsets, lambda p: p > c.start AND p < c.start + {limit}))
        FROM cuts c JOIN spaces s ON s.id = c.id WHERE s.total - c.start > {limit}),
      spans AS (SELECT id, n, start, lead(start, 1, 9000000000000) OVER (PARTITION BY id ORDER BY n) AS next FROM cuts)
    SELECT s.id || '_chunk_' || s.n AS id, s.id AS parent_id, CAST(s.n AS INT) AS chunk_no,
      string_agg(tok.token, ' ' ORDER BY tok.i) AS contents
    FROM spans s JOIN tok ON tok.id = s.id AND tok.place >= s.start AND tok.place < s.next GROUP BY s.id, s.n
    UNION ALL
    SELECT id, id, NULL, array_to_string(tokens, ' ') FROM docs WHERE total <= {limit})"""


def postings(token_rows: str) -> str:
    return f"""(SELECT id, len(tokens) AS dl, term, count(*) AS tf
      FROM (SELECT id, tokens, unnest(tokens) AS term FROM {token_rows}) GROUP BY ALL)"""


def bm25(token_rows: str) -> str:
    return f"""(WITH toks AS MATERIALIZED (SELECT * FROM {token_rows}),
      post AS MATERIALIZED {postings('toks')},
      corpus AS (SELECT count(*) AS n, sum(len(tokens)) / count(*) AS avg_dl FROM toks WHERE len(tokens) > 0),
      q AS (SELECT query_id, term, count(*) AS qtf FROM
        (SELECT item_id AS query_id, unnest({words('text')}) AS term FROM benchmark) GROUP BY ALL),
      terms AS (SELECT term, count(*) AS df FROM post GROUP BY term),
      scored AS (SELECT q.query_id, post.id, sum(CAST(floor(
          q.qtf * ln(1 + (corpus.n - terms.df + 0.5) / (terms.df + 0.5))
          * post.tf / (post.tf + {fixed.BM25_K1}::DOUBLE * (1 - {fixed.BM25_B}::DOUBLE
            + {fixed.BM25_B}::DOUBLE * (post.dl / corpus.avg_dl))) / 1e-12::DOUBLE + 0.5) AS BIGINT)) AS units
        FROM q JOIN terms USING (term) JOIN post USING (term) CROSS JOIN corpus GROUP BY ALL),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY units DESC, id) AS rank FROM scored)
    SELECT query_id, CAST(rank AS INT) AS rank, split_part(id, '_chunk_', 1) AS id, id AS chunk_id,
      round(CAST(units AS DOUBLE) * 1e-12, 6) AS score FROM ranked WHERE rank <= {fixed.TOP_K})"""


KNN = f"""(WITH pairs AS (SELECT b.item_id AS query_id, CAST(v.vec_id AS VARCHAR) AS id,
      list_sum(list_transform(list_zip(q.embedding, v.embedding),
        lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) * (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)))) AS distance
    FROM benchmark b JOIN embeddings q ON q.vec_id = b.item_id CROSS JOIN embeddings v),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs)
  SELECT query_id, CAST(rank AS INT) AS rank, id, round(distance, 6) AS distance FROM ranked
  WHERE rank <= {fixed.TOP_K})"""

HYBRID = f"""(WITH legs AS (SELECT query_id, 0 AS leg, rank, id FROM {bm25(DOC_TOKENS)}
    UNION ALL SELECT query_id, 1, rank, id FROM {KNN}),
  first AS (SELECT query_id, id, min(leg * 1000 + rank) AS place FROM legs GROUP BY ALL)
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY place) AS INT) AS position, f.id,
    CASE WHEN place < 1000 THEN 'keyword' ELSE 'vector' END AS leg, CAST(place % 1000 AS INT) AS rank,
    coalesce(d.text, '') AS contents
  FROM first f LEFT JOIN documents d ON CAST(d.doc_id AS VARCHAR) = f.id)"""


def prompt_sql() -> str:
    before, rest = fixed.PROMPT_TEMPLATE.split("{context}")
    between, after = rest.split("{query}")
    return f"""SELECT b.item_id AS query_id, {lit(before)} || coalesce(string_agg(h.contents,
        {lit(fixed.CONTEXT_SEPARATOR)} ORDER BY h.position), '') || {lit(between)} || b.text || {lit(after)} AS prompt
      FROM benchmark b LEFT JOIN {HYBRID} h ON h.query_id = b.item_id GROUP BY b.item_id, b.text"""


UNPIVOT_ORDERS = union(
    [
        f"SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, "
        f"{lit(c)} AS original_column_name, {txt(c, k)} AS value FROM orders WHERE trim({txt(c, k)}) != ''"
        for c, k in list(COLUMNS["orders"].items())[3:]
    ]
)


def corpus_samples() -> str:
    orders = {"first": "id", "last": "id DESC", "random": "md5('0:' || id), id"}
    docs = "(SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents)"
    parts = [
        f"SELECT * FROM (SELECT {lit(kind)} AS sample_kind, id, substr(text, 1, 200) || '...' AS preview "
        f"FROM {docs} ORDER BY {order} LIMIT 3)"
        for kind, order in orders.items()
    ]
    return f"""SELECT s.*, (SELECT count(*) FROM documents) AS total_docs FROM ({union(parts)}) s
      WHERE sample_kind != 'random' OR (SELECT count(*) FROM documents) > 3"""


HEADER_CATALOG = " UNION ALL ".join(
    f"""SELECT unnest({columns!r}) AS name, unnest(range({len(columns)}))::INT AS pos, n AS n_files, n AS presence_count
    FROM (SELECT count(DISTINCT floor({columns[0]} / {rows}.0)) AS n FROM {name})"""
    for name, columns, rows in t.MANY_FILES
)


def all_sql() -> dict[str, str]:
    doc_sources = [f"src{i}" for i in range(20)]
    clean = "replace(replace(coalesce({0}, ''), chr(10), ' '), chr(13), ' ') AS {0}"
    return {
        "clean_cells": f"SELECT doc_id, {', '.join(clean.format(c) for c in ('text', 'lang', 'source'))} FROM documents",
        "safe_names": r"""SELECT page_id, regexp_replace(url, '[^\p{L}\p{N}]', '_', 'g') AS sheet_name,
            trim(regexp_replace(url, '[^\p{L}\p{N}_]+', '_', 'g'), '_') AS file_name FROM pages""",
        "unpivot_wide": f"SELECT 'orders' AS source, * FROM ({UNPIVOT_ORDERS})",
        "stream_unpivot": UNPIVOT_ORDERS,
        "stream_changing_headers": UNPIVOT_ORDERS,
        "incremental_long": UNPIVOT_ORDERS,
        "header_catalog": HEADER_CATALOG,
        "split_records": "SELECT doc_id::VARCHAR AS doc_id, nullif(text, '') AS text, lang, source FROM documents",
        "csv_round_trip": UNPIVOT_ORDERS,
        "long_round_trip": f"SELECT * FROM {CLEAN}",
        "document_round_trip": "SELECT CAST(doc_id AS VARCHAR) AS id, text AS contents FROM documents",
        "stream_clean": f"""SELECT '2000' AS year, o_orderkey AS business_id, original_column_name AS concept,
            CAST(NULL AS VARCHAR) AS block, CAST(NULL AS VARCHAR) AS item_index, original_column_name AS detail,
            value, original_column_name FROM ({UNPIVOT_ORDERS})""",
        "composite_id": "SELECT l_orderkey || '-' || '' || '-' || l_linenumber AS business_id, l_partkey, l_suppkey "
        "FROM lineitem",
        "parse_header_path": f"SELECT original_column_name, concept, block, item_index, detail FROM {PARSED}",
        "year_from_source": """SELECT o_orderkey, regexp_extract(s, '([0-9]{4})', 1) AS first_year,
            TRY_CAST(nullif(regexp_extract(s, '(20[0-9]{2})', 1), '') AS INT) AS calendar_year
            FROM (SELECT o_orderkey, o_orderkey || '_' || strftime(o_orderdate, '%Y') AS s FROM orders)""",
        "union_sources": """SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
            UNION ALL BY NAME SELECT s_name AS name, s_suppkey AS key, s_nationkey AS nation FROM supplier""",
        "clean_long_data": f"SELECT * FROM {CLEAN}",
        "presence_matrix": "SELECT text AS name, "
        + ", ".join(f"max(CASE WHEN source = {lit(s)} THEN 1 ELSE 0 END) AS {s}" for s in doc_sources)
        + " FROM documents GROUP BY text",
        "presence": "SELECT DISTINCT text AS name, source, 1 AS present FROM documents",
        "presence_count": "SELECT text AS name, count(DISTINCT source) AS presence_count FROM documents GROUP BY text",
        "bitmap_presence": "SELECT text AS name, count(DISTINCT source) AS presence_count FROM documents GROUP BY text",
        "source_overlap": """WITH w AS (SELECT DISTINCT lang, unnest(string_split(text, ' ')) AS name FROM documents WHERE lang IS NOT NULL)
            SELECT 'en' AS source_a, b.lang AS source_b, count(a.name) AS shared_names
            FROM w b LEFT JOIN (SELECT name FROM w WHERE lang = 'en') a USING (name) WHERE b.lang <> 'en' GROUP BY b.lang""",
        "keyword_containment": """SELECT keyword, count(*) AS n_names FROM (SELECT DISTINCT text FROM documents) d
            JOIN (SELECT DISTINCT unnest(string_split(text, ' ')) AS keyword FROM benchmark) k
            ON keyword <> '' AND contains(d.text, keyword) GROUP BY keyword""",
        "explore_keyword": "SELECT DISTINCT text AS name FROM documents WHERE contains(text, 'eau')",
        "candidate_headers": f"""SELECT source, pos FROM {DOC_HEADERS}
            WHERE (contains(name, 'tion') OR contains(name, 'eau')) AND NOT contains(name, 'http')""",
        "keyword_hits": f"""SELECT target, keyword, count(*) AS total_occurrences,
            count(DISTINCT source) AS found_in_sources_count
            FROM {DOC_HEADERS} h JOIN {keyword_rows(t.DOCUMENT_KEYWORDS)} ON contains(h.name, k.keyword) GROUP BY ALL""",
        "keyword_sources": f"""SELECT target, keyword, source, count(*) AS occurrences
            FROM {DOC_HEADERS} h JOIN {keyword_rows(t.DOCUMENT_KEYWORDS)} ON contains(h.name, k.keyword) GROUP BY ALL""",
        "header_fingerprint": f"SELECT * FROM {HEADER_TYPES}",
        "header_fingerprint_members": f"""SELECT ty.type_no, s.source, ty.consistent,
              content = first_value(content) OVER (PARTITION BY type_no ORDER BY source) AS matches_first FROM
            (SELECT source, count(*) AS column_count, CAST(sum(length(name)) AS BIGINT) AS total_length,
               string_agg(pos || '=' || name, '|' ORDER BY pos) AS content FROM {ORDER_HEADERS} GROUP BY source) s
            JOIN {HEADER_TYPES} ty USING (column_count, total_length)""",
        "rank_headers": f"SELECT header_name, score, found_in_sources_count FROM {AMOUNT_RANKS}",
        "rank_headers_top": f"""SELECT header_name, score, found_in_sources_count FROM {AMOUNT_RANKS}
            ORDER BY tenths DESC, header_name LIMIT 20""",
        "exclusivity_score": f"SELECT source, pos, target, score FROM {exclusivity_rows(DOC_HEADERS, t.DOCUMENT_KEYWORDS)}",
        "source_metrics": f"""SELECT source, count(*) AS column_count, max(length(name)) AS max_header_length
            FROM {DOC_HEADERS} GROUP BY source""",
        "source_summary": f"""SELECT count(*) AS n_sources, max(n) AS max_columns, min(n) AS min_columns,
            avg(n) AS avg_columns, max(m) AS max_header_length
            FROM (SELECT source, count(*) AS n, max(length(name)) AS m FROM {DOC_HEADERS} GROUP BY source)""",
        "length_bins": f"SELECT * FROM {LENGTH_BINS}",
        "length_metrics": f"SELECT * FROM {LENGTH_METRICS}",
        "length_summary": f"""SELECT max(max_cell_len) AS max_cell_len_overall,
            max(max_header_len) AS max_header_len_overall FROM {LENGTH_METRICS}""",
        "length_matrix": "SELECT bin_no, bin, "
        + ", ".join(f"CAST(coalesce(sum(n) FILTER (source = {lit(s)}), 0) AS BIGINT) AS {s}" for s in LENGTH_SOURCES)
        + f" FROM {LENGTH_BINS} WHERE kind = 'cell' GROUP BY bin_no, bin",
        "source_matrix": "SELECT source, "
        + ", ".join(
            f"CAST(coalesce(sum(n) FILTER (bin_no = {i}), 0) AS BIGINT) AS \"len_{b}\""
            for i, b in enumerate([*map(str, fixed.LENGTH_BINS), f"{fixed.LENGTH_BINS[-1]}+"])
        )
        + f" FROM {LENGTH_BINS} WHERE kind = 'cell' GROUP BY source",
        "distribution_report": "SELECT source, "
        + ", ".join(
            f"""'{{' || string_agg('"' || bin || '":' || n, ',' ORDER BY bin_no) FILTER (kind = {lit(k)}) || '}}'
            AS {k}_len_distribution"""
            for k in ("header", "cell")
        )
        + f" FROM {LENGTH_BINS} GROUP BY source",
        "column_type_counts": f"SELECT * FROM {TYPE_COUNTS}",
        "source_sizes": f"""SELECT source, count(*) AS column_count, max(n_rows) AS row_count
            FROM {TYPE_COUNTS} GROUP BY source""",
        "column_type_summary": f"""SELECT source, dominant_type, count(*) AS column_count,
            round(sum(n_empty) / sum(n_rows), 3) AS avg_empty_rate, max(max_len) AS overall_max_cell_len,
            round(sum(total_len) / sum(n_rows), 2) AS avg_cell_len,
            coalesce(round(sum(non_empty_len) / nullif(sum(n_rows) - sum(n_empty), 0), 2), 0) AS avg_non_empty_cell_len
            FROM (SELECT *, {DOMINANT} AS dominant_type FROM {TYPE_COUNTS}) GROUP BY source, dominant_type""",
        "key_diagnostics": diagnostics(None),
        "sketched_uniqueness": sketched(),
        "key_diagnostics_sampled": diagnostics(fixed.SAMPLE_ROWS),
        "key_diagnostics_full": diagnostics(None),
        "map_key_columns": key_map(None),
        "map_key_columns_sampled": key_map(fixed.SAMPLE_ROWS),
        "map_key_columns_full": key_map(None),
        "identify_metadata": metadata(),
        "separate_main": """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(count(*) AS VARCHAR) AS n_lines
            FROM lineitem GROUP BY l_orderkey""",
        "separate_children": children(False),
        "separate_children_by_block": children(True),
        "separate_many_files": f"""SELECT * REPLACE ('f' || CAST(trunc(CAST(project_id AS BIGINT) / 500) AS BIGINT) AS source)
            FROM ({children(False)})""",
        "build_documents": f"""SELECT year || '-' || business_id AS id,
            string_agg(detail || ': ' || value, '。 ' ORDER BY original_column_name, value) AS contents
            FROM {CLEAN} GROUP BY year, business_id""",
        "build_document_parts": f"SELECT * FROM {DOCUMENT_PARTS}",
        "tokenize_docs": f"SELECT id, array_to_string(tokens, ' ') AS contents FROM {DOC_TOKENS}",
        "chunk_docs": f"SELECT * FROM {chunks(CHUNK_BYTES)}",
        "corpus_check": corpus_samples(),
        "doc_preview": "SELECT CAST(doc_id AS VARCHAR) AS id, substr(text, 1, 200) || '...' AS preview FROM documents",
        "bm25_index": f"SELECT * FROM {postings(DOC_TOKENS)}",
        "bm25_terms": f"SELECT term, count(*) AS df FROM {postings(DOC_TOKENS)} GROUP BY term",
        "bm25_corpus": f"""SELECT count(*) AS n_docs, round(sum(len(tokens)) / count(*), 6) AS avg_dl
            FROM {DOC_TOKENS} WHERE len(tokens) > 0""",
        "bm25_search": f"SELECT * FROM {bm25(DOC_TOKENS)}",
        "stored_search": f"SELECT * FROM {bm25(DOC_TOKENS)}",
        "bm25_search_chunked": "SELECT * FROM "
        + bm25(f"(SELECT id, string_split(contents, ' ') AS tokens FROM {chunks(CHUNK_BYTES)})"),
        "vector_store_check": """SELECT len(embedding) AS dimension, count(*) AS n_vectors,
            count(*) FILTER (embedding IS NULL) AS n_null,
            count(*) FILTER (len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) > 0) AS n_with_holes,
            len(embedding) = (SELECT len(embedding) FROM embeddings GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1)
              AS is_valid
            FROM embeddings GROUP BY 1""",
        "knn_l2": f"SELECT * FROM {KNN}",
        "knn_l2_stored": f"SELECT * FROM {KNN}",
        "hybrid_search": f"SELECT * FROM {HYBRID}",
        "answer_preview": f"SELECT query_id, position, substr(contents, 1, 1000) || '...' AS contents FROM {HYBRID}",
        "assemble_prompt": prompt_sql(),
    }
