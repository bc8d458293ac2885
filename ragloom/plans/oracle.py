"""DuckDB SQL equal in result to each registered query (the correctness oracle)."""

from __future__ import annotations

from ragloom.functions.prompts import NO_ANSWER, RAG_PROMPT_HEAD, RAG_PROMPT_MID, RAG_PROMPT_TAIL, SYSTEM_MESSAGE, TEMPLATES
from ragloom.operators.embedding import TOKEN_SPLIT
from ragloom.plans.sqlfrag import WS_SQL, chunks_sql, lit, terms_sql
from ragloom.sources.reports import NO_CHUNKS_FIXED

K, MIN_SCORE, DIM, MAX_BYTES, MAX_CHUNKS = 5, 0.5, 256, 2000, 10


QUESTIONS = "SELECT item_id AS query_id, text AS question FROM benchmark"


def _sparse_hits_sql(k: int = K, min_score: float | None = MIN_SCORE, dim: int = DIM, questions: str = QUESTIONS) -> str:
    """R8 in SQL: hashed-token cosine of the questions against T1 chunks, top-k (CTEs ch, q, hits)."""
    thr = f"WHERE score >= {min_score}" if min_score is not None else ""
    return f"""
    ch AS {chunks_sql()},
    ct AS {terms_sql('ch', 'chunk_id', 'content', dim)},
    cn AS (SELECT chunk_id, sum(n * n) AS n2 FROM ct GROUP BY chunk_id),
    q AS ({questions}),
    qt AS {terms_sql('q', 'query_id', 'question', dim)},
    qn AS (SELECT query_id, sum(n * n) AS n2 FROM qt GROUP BY query_id),
    dots AS (SELECT qt.query_id, ct.chunk_id, sum(ct.n * qt.n) AS dot
             FROM ct JOIN qt ON ct.bucket = qt.bucket GROUP BY qt.query_id, ct.chunk_id),
    scored AS (SELECT qn.query_id, c.chunk_id, c.doc_id, c.chunk_index, c.content,
                      coalesce(d.dot, 0) / (sqrt(cn.n2) * sqrt(qn.n2)) AS score
               FROM cn JOIN ch c ON c.chunk_id = cn.chunk_id CROSS JOIN qn
               LEFT JOIN dots d ON d.chunk_id = cn.chunk_id AND d.query_id = qn.query_id),
    hits AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_index) AS INTEGER) AS rank
             FROM (SELECT * FROM scored {thr}) QUALIFY rank <= {k})"""


def _contexts_sql(max_bytes: int = MAX_BYTES, max_chunks: int = MAX_CHUNKS) -> str:
    return f"""
    kept AS (SELECT * FROM hits WHERE score >= {MIN_SCORE}),
    d1 AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY query_id, doc_id, chunk_index ORDER BY score DESC, rank) = 1),
    d2 AS (SELECT * FROM d1 QUALIFY row_number() OVER (PARTITION BY query_id, content ORDER BY score DESC, doc_id, chunk_index) = 1),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_index) AS INTEGER) AS pos FROM d2),
    flagged AS (SELECT *, (sum(strlen(content) + 1) OVER (PARTITION BY query_id ORDER BY pos
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= {max_bytes} AND pos <= {max_chunks}) AS in_pack
                FROM ranked),
    ctx AS (SELECT query_id,
                   coalesce(string_agg(CASE WHEN in_pack THEN content || chr(10) END, '' ORDER BY pos), '') AS context,
                   CAST(count(*) FILTER (WHERE in_pack) AS BIGINT) AS n_chunks,
                   CAST(coalesce(sum(CASE WHEN in_pack THEN strlen(content) + 1 END), 0) AS BIGINT) AS n_bytes,
                   CAST(count(*) AS BIGINT) AS n_hits
            FROM flagged GROUP BY query_id)"""


RAG_CONTEXTS = f"""
WITH {_sparse_hits_sql()},
{_contexts_sql()}
SELECT q.query_id, q.question, coalesce(ctx.context, '') AS context,
       coalesce(ctx.n_chunks, 0) AS n_chunks, coalesce(ctx.n_bytes, 0) AS n_bytes,
       coalesce(ctx.n_hits, 0) > 0 AS answerable,
       CASE WHEN coalesce(ctx.n_hits, 0) > 0
            THEN {lit(RAG_PROMPT_HEAD)} || coalesce(ctx.context, '') || {lit(RAG_PROMPT_MID)} || q.question || {lit(RAG_PROMPT_TAIL)}
       END AS prompt,
       CASE WHEN NOT (coalesce(ctx.n_hits, 0) > 0) THEN {lit(NO_ANSWER)} END AS fixed_reply
FROM q LEFT JOIN ctx ON q.query_id = ctx.query_id
"""

RAG_CONTEXTS_GRAPH = f"""
WITH {_sparse_hits_sql()},
{_contexts_sql(max_bytes=4000, max_chunks=10)}
SELECT q.query_id, q.question, coalesce(ctx.context, '') AS context,
       coalesce(ctx.n_chunks, 0) AS n_chunks, coalesce(ctx.n_bytes, 0) AS n_bytes,
       TRUE AS answerable,
       {lit(RAG_PROMPT_HEAD)} || coalesce(ctx.context, '') || {lit(RAG_PROMPT_MID)} || q.question || {lit(RAG_PROMPT_TAIL)} AS prompt,
       CAST(NULL AS VARCHAR) AS fixed_reply
FROM q LEFT JOIN ctx ON q.query_id = ctx.query_id
"""

CHUNK_FIXED = f"SELECT * FROM {chunks_sql()}"

CHUNK_ROWS = f"""
SELECT chunk_id, doc_id, chunk_index, content, coalesce(source, '') AS source,
       '{{"chunk_index":' || to_json(CAST(chunk_index AS VARCHAR)) || ',"doc_id":' || to_json(doc_id)
       || ',"original_length":' || to_json(CAST(strlen(text) AS VARCHAR)) || ',"source":' || to_json(coalesce(source, ''))
       || '}}' AS metadata_json
FROM {chunks_sql(extra="source, text")}
"""

COUNT_CHUNKS = f"""
SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_chunks
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM {chunks_sql()} GROUP BY doc_id) c
  ON CAST(d.doc_id AS VARCHAR) = c.doc_id
"""

CHUNKS_PER_DOCUMENT = f"SELECT doc_id, count(*) AS n_chunks FROM {chunks_sql()} GROUP BY doc_id"


def _hits_only(min_score=None, k=K, questions=QUESTIONS, cols="query_id, chunk_id, doc_id, chunk_index, score, rank"):
    return f"WITH {_sparse_hits_sql(k=k, min_score=min_score, questions=questions)}\nSELECT {cols} FROM hits"


KNN_SPARSE = _hits_only()

DEDUP_HITS = f"""
WITH {_sparse_hits_sql()},
{_contexts_sql()}
SELECT query_id, chunk_id, doc_id, chunk_index, score FROM d2
"""

PACK_CONTEXT = f"""
WITH {_sparse_hits_sql()},
{_contexts_sql()}
SELECT query_id, chunk_id, pos, CAST(strlen(content) AS BIGINT) AS n_bytes FROM flagged WHERE in_pack
"""

RAG_PROMPT = f"SELECT query_id, prompt FROM ({RAG_CONTEXTS}) WHERE answerable"

DOC_METADATA_JSON = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id,
       '{"doc_id":' || to_json(CAST(doc_id AS VARCHAR)) || ',"original_length":' || to_json(CAST(strlen(text) AS VARCHAR))
       || ',"source":' || to_json(coalesce(source, '')) || '}' AS metadata_json
FROM documents
"""

METADATA_ROUNDTRIP = f"""
SELECT chunk_id, doc_id, chunk_index, coalesce(source, '') AS source, CAST(strlen(text) AS BIGINT) AS original_length,
       CAST(4 AS BIGINT) AS n_keys
FROM {chunks_sql(extra="source, text")}
"""

HASH_EMBED = f"""
SELECT doc_id, CAST(bucket AS INTEGER) AS bucket, n
FROM {terms_sql("(SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents)", "doc_id", "text", DIM)}
"""

_E = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
_COS = "round(list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))), 9)"

KNN_SINGLE = f"""
WITH {_E},
ex AS (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
m AS (SELECT list(a ORDER BY i) AS mv FROM (SELECT i, avg(x) AS a FROM ex GROUP BY i)),
s AS (SELECT vec_id, label, {_COS.format(a="v", b="mv")} AS score FROM e, m)
SELECT vec_id, label, score, CAST(row_number() OVER (ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM s WHERE score IS NOT NULL QUALIFY rank <= 10
"""


def _knn_batch_sql(k, min_score=None):
    thr = f"AND score >= {min_score}" if min_score is not None else ""
    return f"""
WITH {_E},
s AS (SELECT q.vec_id AS query_id, c.vec_id, c.label, {_COS.format(a="q.v", b="c.v")} AS score FROM e q, e c)
SELECT query_id, vec_id, label, score,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM s WHERE score IS NOT NULL {thr} QUALIFY rank <= {k}
"""


KNN_BATCH = _knn_batch_sql(5)
KNN_THRESHOLD = _knn_batch_sql(10, 0.25)


def _render(system_parts, user_parts, key, rel):
    return f"SELECT {key}, {' || '.join(system_parts)} AS system, {' || '.join(user_parts)} AS user FROM {rel}"


def _tmpl(template: str, slots: dict[str, str]) -> list[str]:
    import re as _re

    out, pos = [], 0
    for m in _re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            out.append(lit(template[pos:m.start()]))
        out.append(slots[m.group(1)])
        pos = m.end()
    if pos < len(template):
        out.append(lit(template[pos:]))
    return out


def _render_sql(name, slots, key, rel):
    from ragloom.functions.prompts import TEMPLATES

    system, user = TEMPLATES[name]
    return _render(_tmpl(system, slots), _tmpl(user, slots), key, rel)


RENDER_TRANSLATE = _render_sql("translate", {"text": "text", "target_lang": "'English'"}, "item_id", "benchmark")
RENDER_CODE = _render_sql("code", {"requirement": "text", "language": "'Python'"}, "item_id", "benchmark")
RENDER_SUMMARIZE = _render_sql("summarize", {"content": "text", "style": "lang", "max_length": "'200'"}, "doc_id", "documents")

_HISTORY = f"""
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS seq, 'system' AS role, {lit(SYSTEM_MESSAGE)} AS content FROM conversations
    UNION ALL
    SELECT conv_id, CAST(turn + 1 AS BIGINT) AS seq, role, text AS content FROM conversations"""

CONVERSATION_HISTORY = _HISTORY

_LAST_USER = "SELECT conv_id AS query_id, arg_max(text, turn) AS question FROM conversations WHERE role = 'user' GROUP BY conv_id"

MODEL_INPUT = f"""
WITH {_sparse_hits_sql(questions=_LAST_USER)},
{_contexts_sql()},
hist AS ({_HISTORY}),
p AS (SELECT q.query_id AS conv_id,
             {lit(RAG_PROMPT_HEAD)} || coalesce(ctx.context, '') || {lit(RAG_PROMPT_MID)} || q.question || {lit(RAG_PROMPT_TAIL)} AS content
      FROM q JOIN ctx ON q.query_id = ctx.query_id WHERE ctx.n_hits > 0),
last AS (SELECT conv_id, max(seq) AS m FROM hist GROUP BY conv_id)
SELECT h.conv_id, h.seq, h.role, h.content FROM hist h WHERE h.conv_id IN (SELECT conv_id FROM p)
UNION ALL
SELECT p.conv_id, CAST(last.m + 1 AS BIGINT) AS seq, 'user' AS role, p.content FROM p JOIN last ON p.conv_id = last.conv_id
"""


def _report_sql(hits_cte: str, questions: str, key_select: str) -> str:
    entry = ("chr(10) || '[文档' || CAST(rank AS VARCHAR) || ']' || chr(10) || '内容: ' || content || chr(10) "
             "|| CASE WHEN doc_id IS NOT NULL THEN '文档ID: ' || doc_id || chr(10) ELSE '' END")
    return f"""
WITH {hits_cte},
rep AS (SELECT query_id, '找到 ' || CAST(count(*) AS VARCHAR) || ' 个相关文档：' || chr(10)
               || string_agg({entry}, '' ORDER BY rank) AS report
        FROM hits GROUP BY query_id)
SELECT {key_select}, coalesce(rep.report, '未找到相关文档') AS report
FROM q LEFT JOIN rep ON q.query_id = rep.query_id
"""


SEARCH_REPORT = _report_sql(_sparse_hits_sql(min_score=None), QUESTIONS, "q.query_id")

_USER_CALLS = "SELECT conv_id * 1000000 + turn AS query_id, text AS question FROM conversations WHERE role = 'user'"

TOOL_RESULTS = f"""
WITH r AS ({_report_sql(_sparse_hits_sql(min_score=None, questions=_USER_CALLS), _USER_CALLS, "q.query_id AS query_id")})
SELECT c.conv_id, CAST(c.turn AS INTEGER) AS call_pos, 'call_' || CAST(c.conv_id AS VARCHAR) || '_' || CAST(c.turn AS VARCHAR) AS call_id,
       'tool' AS role, r.report AS content
FROM conversations c JOIN r ON r.query_id = c.conv_id * 1000000 + c.turn
WHERE c.role = 'user'
"""

TOOL_HISTORY = f"""
WITH hist AS ({_HISTORY}),
last AS (SELECT conv_id, max(seq) AS m FROM hist GROUP BY conv_id),
t AS ({TOOL_RESULTS})
SELECT conv_id, seq, role, content, CAST(NULL AS VARCHAR) AS tool_call_id FROM hist
UNION ALL
SELECT t.conv_id, CAST(last.m + 1 + t.call_pos AS BIGINT) AS seq, 'tool' AS role, t.content, t.call_id AS tool_call_id
FROM t JOIN last ON t.conv_id = last.conv_id
"""

MERGE_FRAGMENTS = "SELECT conv_id, turn, coalesce(text, '') AS content FROM conversations"

IMPORT_REPORT = f"""
SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS chunk_count,
       coalesce(c.n, 0) > 0 AS success,
       CASE WHEN coalesce(c.n, 0) = 0 THEN {lit(NO_CHUNKS_FIXED)} END AS error
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM {chunks_sql()} GROUP BY doc_id) c
  ON CAST(d.doc_id AS VARCHAR) = c.doc_id
"""

IMPORT_TOTALS = f"""
SELECT CAST(count(*) FILTER (WHERE success) AS BIGINT) AS n_success,
       CAST(count(*) FILTER (WHERE NOT success) AS BIGINT) AS n_failed,
       CAST(coalesce(sum(chunk_count), 0) AS BIGINT) AS total_chunks
FROM ({IMPORT_REPORT})
"""

FIELD_LIMIT_VIOLATIONS = f"""
WITH r AS (
  SELECT CAST(doc_id AS VARCHAR) || ':0' AS chunk_id, text AS content, CAST(doc_id AS VARCHAR) AS doc_id,
         coalesce(source, '') AS source,
         '{{"doc_id":' || to_json(CAST(doc_id AS VARCHAR)) || ',"original_length":' || to_json(CAST(strlen(text) AS VARCHAR))
         || ',"source":' || to_json(coalesce(source, '')) || '}}' AS metadata_json
  FROM documents),
c AS (
  SELECT doc_id, 'chunk_id' AS field, CAST(strlen(chunk_id) AS BIGINT) AS n_bytes, CAST(64 AS BIGINT) AS max_bytes FROM r
  UNION ALL SELECT doc_id, 'content', strlen(content), 16384 FROM r
  UNION ALL SELECT doc_id, 'doc_id', strlen(doc_id), 64 FROM r
  UNION ALL SELECT doc_id, 'source', strlen(source), 256 FROM r
  UNION ALL SELECT doc_id, 'metadata_json', strlen(metadata_json), 4096 FROM r)
SELECT doc_id, field, n_bytes, max_bytes FROM c WHERE n_bytes > max_bytes
"""

_BM25_BASE = f"""
    ch AS {chunks_sql()},
    q AS ({QUESTIONS}),"""

def _bm25_sql(depth: int = K) -> str:
    return f"""
    ctok AS (SELECT chunk_id, tok FROM (SELECT chunk_id, unnest(regexp_split_to_array(lower(content), '{TOKEN_SPLIT}')) AS tok FROM ch)
             WHERE tok <> ''),
    dl AS (SELECT ch.chunk_id, CAST(count(ctok.tok) AS DOUBLE) AS dl FROM ch LEFT JOIN ctok ON ch.chunk_id = ctok.chunk_id
           GROUP BY ch.chunk_id),
    stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
    tf AS (SELECT chunk_id, tok, CAST(count(*) AS DOUBLE) AS tf FROM ctok GROUP BY chunk_id, tok),
    bqt AS (SELECT DISTINCT query_id, tok FROM (SELECT query_id, unnest(regexp_split_to_array(lower(question), '{TOKEN_SPLIT}')) AS tok FROM q)
           WHERE tok <> ''),
    dfq AS (SELECT tok, CAST(count(*) AS DOUBLE) AS df FROM tf WHERE tok IN (SELECT tok FROM bqt) GROUP BY tok),
    bm AS (SELECT bqt.query_id, tf.chunk_id,
                  round(sum(ln((stats.n - dfq.df + 0.5) / (dfq.df + 0.5) + 1.0) * (tf.tf * 2.2)
                            / (tf.tf + 1.2 * (1 - 0.75 + 0.75 * dl.dl / stats.avgdl))), 9) AS score
           FROM bqt JOIN tf ON bqt.tok = tf.tok JOIN dfq ON dfq.tok = bqt.tok JOIN dl ON dl.chunk_id = tf.chunk_id, stats
           GROUP BY bqt.query_id, tf.chunk_id),
    bmhits AS (SELECT bm.query_id, ch.chunk_id, ch.doc_id, ch.chunk_index, bm.score,
                      CAST(row_number() OVER (PARTITION BY bm.query_id ORDER BY bm.score DESC, ch.doc_id, ch.chunk_index) AS INTEGER) AS rank
               FROM bm JOIN ch ON bm.chunk_id = ch.chunk_id WHERE bm.score > 0 QUALIFY rank <= {depth})"""


FUSE = 20

BM25_SEARCH = f"WITH {_BM25_BASE}{_bm25_sql()}\nSELECT query_id, chunk_id, doc_id, chunk_index, score, rank FROM bmhits"

RRF_FUSE = f"""
WITH {_sparse_hits_sql(k=FUSE, min_score=None)},
{_bm25_sql(FUSE)},
u AS (SELECT query_id, chunk_id, doc_id, chunk_index, rank FROM hits
      UNION ALL SELECT query_id, chunk_id, doc_id, chunk_index, rank FROM bmhits),
f AS (SELECT query_id, chunk_id, doc_id, chunk_index, sum(1.0 / (60 + rank)) AS score FROM u
      GROUP BY query_id, chunk_id, doc_id, chunk_index)
SELECT query_id, chunk_id, doc_id, chunk_index, score,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_index) AS INTEGER) AS rank
FROM f QUALIFY rank <= 5
"""

_HISTORY_Q = """
SELECT conv_id AS query_id, string_agg(coalesce(text, ''), chr(10) ORDER BY back DESC) AS question
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC NULLS LAST, text DESC NULLS LAST) AS back FROM conversations)
WHERE back <= 3
GROUP BY conv_id"""

RETRIEVE_WITH_HISTORY = _hits_only(questions=_HISTORY_Q)

_MD_DOCS = """
    SELECT doc_id, string_agg(CASE WHEN i = 0 THEN '# ' || line
                                   WHEN length(line) < 40 THEN '## ' || line
                                   WHEN length(line) < 80 THEN '### ' || line
                                   ELSE line END, chr(10) ORDER BY i) AS text
    FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i FROM documents)
    GROUP BY doc_id"""

def _markdown_sql(docs: str) -> str:
    """T4: one step a fence or heading line, the open marker as the state; then sections between headings."""
    return f"""
WITH RECURSIVE md AS ({docs}),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
      FROM md),
k AS (SELECT doc_id, i, m, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n
      FROM (SELECT doc_id, i, CASE WHEN regexp_matches(line, '^#{{2,3}} ') THEN '#' ELSE regexp_extract(line, '^ {{0,3}}(```|~~~)', 1) END AS m FROM l)
      WHERE m <> ''),
r(doc_id, n, i, m, before, after) AS (
  SELECT doc_id, n, i, m, '', CASE WHEN m = '#' THEN '' ELSE m END FROM k WHERE n = 1
  UNION ALL
  SELECT k.doc_id, k.n, k.i, k.m, r.after,
         CASE WHEN k.m = '#' THEN r.after WHEN r.after = '' THEN k.m WHEN r.after = k.m THEN '' ELSE r.after END
  FROM r JOIN k ON k.doc_id = r.doc_id AND k.n = r.n + 1),
h AS (SELECT l.*, CASE WHEN r.m = '#' AND r.before = '' THEN 1 ELSE 0 END AS is_head FROM l LEFT JOIN r ON r.doc_id = l.doc_id AND r.i = l.i),
s AS (SELECT *, sum(is_head) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS section FROM h),
sec AS (SELECT doc_id, section, trim(string_agg(line, chr(10) ORDER BY i), {WS_SQL}) AS content FROM s GROUP BY doc_id, section),
o AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section) - 1 AS BIGINT) AS chunk_index, content
      FROM sec WHERE length(content) > 0)
SELECT doc_id || ':' || CAST(chunk_index AS VARCHAR) AS chunk_id, doc_id, chunk_index, content FROM o
"""


CHUNK_MARKDOWN = _markdown_sql(_MD_DOCS)
CHUNK_MARKDOWN_FENCED = _markdown_sql(f"""
    SELECT doc_id, string_agg(CASE WHEN starts_with(line, '#') THEN line WHEN length(line) % 7 = 0 THEN '``` ' || line
                                   WHEN length(line) % 11 = 0 THEN ' ~~~' || line ELSE line END, chr(10) ORDER BY i) AS text
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM ({_MD_DOCS}))
    GROUP BY doc_id""")

# the numbers by n_chars % 8, as a long: NaN, 1e30, 3.9, -3.9, x, '', Infinity, 12
METADATA_ODD_JSON = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(doc_id AS VARCHAR) AS meta_doc_id, CAST(n_chars AS BIGINT) AS chunk_index, 'new' AS source,
       CAST([0, 0, 3, -3, 0, 0, 0, 12][n_chars % 8 + 1] AS BIGINT) AS n, CAST(5 AS BIGINT) AS n_keys
FROM documents
"""

_MEANS = """mu AS (SELECT label, list(a ORDER BY i) AS mv FROM (SELECT label, i, avg(x) AS a FROM
      (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e) GROUP BY label, i) GROUP BY label)"""

KNN_LABEL_MEANS = f"""
WITH {_E}, {_MEANS},
s AS (SELECT mu.label AS query_id, e.vec_id, e.label, {_COS.format(a="mu.mv", b="e.v")} AS score FROM mu, e)
SELECT query_id, vec_id, label, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM s WHERE score IS NOT NULL QUALIFY rank <= 10
"""

# every vector with its cells in order of cosine (cells are numbered by label from 0)
_CELLS = f"""{_E}, {_MEANS},
cc AS (SELECT mv, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS cell FROM mu),
near AS (SELECT vec_id, label, v, cell, row_number() OVER (PARTITION BY vec_id ORDER BY
           list_dot_product(v, mv) / sqrt(list_dot_product(mv, mv)) DESC, cell) AS pos FROM e, cc)"""

IVF_ASSIGN_LABELS = f"WITH {_CELLS} SELECT vec_id, label, cell FROM near WHERE pos = 1"

IVF_SEARCH_PROBES = f"""
WITH {_CELLS},
s AS (SELECT q.vec_id AS query_id, c.vec_id, c.label, {_COS.format(a="q.v", b="c.v")} AS score
      FROM near q JOIN near c ON q.cell = c.cell AND c.pos = 1 AND q.pos <= 2)
SELECT query_id, vec_id, label, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM s WHERE score IS NOT NULL QUALIFY rank <= 5
"""

_NO_SPACE = "translate({x}, {ws}, '')"


def _no_space(x: str) -> str:
    return _NO_SPACE.format(x=x, ws=WS_SQL)


CHUNK_RECURSIVE_CHECKS = f"SELECT doc_id, CAST(0 AS BIGINT) AS n_over, md5({_no_space('coalesce(text, %s)' % lit(''))}) AS digest FROM documents"

_ROUTED = "CASE lang WHEN 'en' THEN source || '.md' WHEN 'de' THEN source || '.MARKDOWN' WHEN 'fr' THEN source || '.txt' ELSE source END"

CHUNK_ROUTED_CHECKS = f"""
WITH t AS ({CHUNK_MARKDOWN}),
md AS (SELECT doc_id, count(*) AS n, md5(string_agg(content, chr(1) ORDER BY chunk_index)) AS digest FROM t GROUP BY doc_id),
x AS (SELECT m.doc_id, m.text, d.lang IN ('en', 'de') AS is_markdown FROM ({_MD_DOCS}) m JOIN documents d ON CAST(d.doc_id AS VARCHAR) = m.doc_id)
SELECT x.doc_id, is_markdown, CAST(0 AS BIGINT) AS n_over, CASE WHEN is_markdown THEN md.n END AS n_chunks,
       CASE WHEN is_markdown THEN md.digest ELSE md5({_no_space('x.text')}) END AS digest
FROM x LEFT JOIN md ON md.doc_id = x.doc_id WHERE NOT is_markdown OR md.n > 0
"""

FILE_METADATA = """
SELECT doc_id, path, regexp_extract(path, '([^/]*)$', 1) AS filename, path AS filepath, path AS source, 'Txt' AS file_type, CAST(4 AS BIGINT) AS n_keys
FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, '/data/' || coalesce(source, '') || '/doc ' || CAST(doc_id AS VARCHAR) || '.Txt' AS path FROM documents)
"""

TEXT_FUNCTIONS = f"""
SELECT d.doc_id, md5(regexp_replace(trim(m.text, {WS_SQL}), '[' || {WS_SQL} || ']+', ' ', 'g')) AS digest,
       lower(regexp_extract({_ROUTED}, '(\\.[^./]*)$', 1)) AS ext, lang IN ('en', 'de') AS by_type,
       CASE WHEN d.doc_id % 3 = 1 THEN CAST(d.doc_id AS VARCHAR) ELSE 'hit_' || CAST(d.doc_id AS VARCHAR) END AS hit_id
FROM documents d JOIN ({_MD_DOCS}) m ON m.doc_id = CAST(d.doc_id AS VARCHAR)
"""

EMBED_MISSING = """
SELECT vec_id, CAST(CASE WHEN label % 3 = 2 THEN 64 ELSE 2 END AS BIGINT) AS width,
       CASE WHEN label % 3 = 2 THEN round(CAST(embedding[1] AS DOUBLE), 6) ELSE CAST(length('vector ' || CAST(vec_id AS VARCHAR)) AS DOUBLE) END AS first
FROM embeddings
"""

DIMENSION_SPLIT = "SELECT vec_id, label % 4 <> 0 AS usable FROM embeddings"

MERGE_HIT_LISTS = f"""
WITH {_sparse_hits_sql(min_score=None)}
SELECT query_id, chunk_id, doc_id, chunk_index, CASE WHEN rank < 5 THEN score ELSE score * 0.5 END AS score FROM hits
"""

TEMPLATE_HISTORY = f"""
WITH hist AS ({_HISTORY}),
asked AS ({_LAST_USER}),
last AS (SELECT conv_id, max(seq) AS m FROM hist GROUP BY conv_id)
SELECT conv_id, seq, role, content FROM hist
UNION ALL
SELECT last.conv_id, CAST(m + 1 AS BIGINT), 'user', {" || ".join(_tmpl(TEMPLATES["translate"][1], {"text": "question", "target_lang": "'English'"}))}
FROM last JOIN asked ON asked.query_id = last.conv_id
UNION ALL
SELECT last.conv_id, CAST(m + 2 AS BIGINT), 'assistant', 'answer: ' || question FROM last JOIN asked ON asked.query_id = last.conv_id
"""

_DISPATCHED = """SELECT conv_id * 1000000 + turn AS query_id, text AS question FROM conversations
      WHERE role = 'user' AND (conv_id + turn) % 5 = 0"""

TOOL_DISPATCH = f"""
WITH r AS ({_report_sql(_sparse_hits_sql(min_score=None, questions=_DISPATCHED), _DISPATCHED, "q.query_id AS query_id")})
SELECT c.conv_id, c.turn AS reply_seq, CAST(0 AS INTEGER) AS call_pos, 'call_0' AS call_id, 'tool' AS role,
       CASE (c.conv_id + c.turn) % 5 WHEN 0 THEN r.report
            WHEN 1 THEN '工具search_docs执行失败，请检查输入或重试'
            WHEN 2 THEN '工具weather执行失败，请检查输入或重试'
            ELSE '计算结果: ' || CAST(c.turn AS VARCHAR) || ' = ' || CAST(c.turn AS VARCHAR) END AS content
FROM conversations c LEFT JOIN r ON r.query_id = c.conv_id * 1000000 + c.turn
WHERE c.role = 'user' AND (c.conv_id + c.turn) % 5 <> 4
"""

DOCUMENTS_FROM_TABLE = """
SELECT CASE WHEN doc_id % 3 <> 0 THEN CAST(doc_id AS VARCHAR)
            ELSE substring(sha256(coalesce(source, '') || chr(0) || coalesce(text, '')), 1, 32) END AS doc_id,
       text, coalesce(source, '') AS source
FROM documents"""

EMBED_DISTINCT = """
SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN len(embedding) ELSE 2 END::INTEGER AS width,
       CASE WHEN vec_id % 3 <> 0 THEN length(coalesce(text, ''))::DOUBLE END AS first
FROM embeddings JOIN documents ON vec_id = doc_id
"""

ORACLE = {
    "knn_label_means": KNN_LABEL_MEANS,
    "ivf_assign_labels": IVF_ASSIGN_LABELS,
    "ivf_grow_labels": IVF_ASSIGN_LABELS,
    "chunk_table_function": CHUNK_FIXED,
    "embed_distinct": EMBED_DISTINCT,
    "documents_from_table": DOCUMENTS_FROM_TABLE,
    "ivf_search_probes": IVF_SEARCH_PROBES,
    "ivf_join_probes": IVF_SEARCH_PROBES,
    "chunk_recursive_checks": CHUNK_RECURSIVE_CHECKS,
    "chunk_routed_checks": CHUNK_ROUTED_CHECKS,
    "file_metadata": FILE_METADATA,
    "text_functions": TEXT_FUNCTIONS,
    "embed_missing": EMBED_MISSING,
    "dimension_split": DIMENSION_SPLIT,
    "merge_hit_lists": MERGE_HIT_LISTS,
    "template_history": TEMPLATE_HISTORY,
    "tool_dispatch": TOOL_DISPATCH,
    "rag_contexts": RAG_CONTEXTS,
    "rag_contexts_graph": RAG_CONTEXTS_GRAPH,
    "chunk_fixed": CHUNK_FIXED,
    "chunk_rows": CHUNK_ROWS,
    "count_chunks": COUNT_CHUNKS,
    "chunks_per_document": CHUNKS_PER_DOCUMENT,
    "knn_sparse": KNN_SPARSE,
    "knn_sparse_index": KNN_SPARSE,
    "knn_batch_blocks": KNN_BATCH,
    "bm25_index_search": BM25_SEARCH,
    "dedup_hits": DEDUP_HITS,
    "pack_context": PACK_CONTEXT,
    "rag_prompt": RAG_PROMPT,
    "doc_metadata_json": DOC_METADATA_JSON,
    "metadata_roundtrip": METADATA_ROUNDTRIP,
    "hash_embed": HASH_EMBED,
    "knn_single": KNN_SINGLE,
    "knn_batch": KNN_BATCH,
    "knn_threshold": KNN_THRESHOLD,
    "ivf_search": KNN_BATCH,
    "ivf_join": KNN_BATCH,
    "render_translate": RENDER_TRANSLATE,
    "render_code": RENDER_CODE,
    "render_summarize": RENDER_SUMMARIZE,
    "conversation_history": CONVERSATION_HISTORY,
    "model_input": MODEL_INPUT,
    "tool_results": TOOL_RESULTS,
    "tool_history": TOOL_HISTORY,
    "search_report": SEARCH_REPORT,
    "merge_fragments": MERGE_FRAGMENTS,
    "import_report": IMPORT_REPORT,
    "import_totals": IMPORT_TOTALS,
    "field_limit_violations": FIELD_LIMIT_VIOLATIONS,
    "bm25_search": BM25_SEARCH,
    "rrf_fuse": RRF_FUSE,
    "retrieve_with_history": RETRIEVE_WITH_HISTORY,
    "chunk_markdown": CHUNK_MARKDOWN,
    "chunk_markdown_fenced": CHUNK_MARKDOWN_FENCED,
    "metadata_odd_json": METADATA_ODD_JSON,
}
