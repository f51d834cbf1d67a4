"""Query catalogue: each query over the test tables with the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import recovery
from ..functions.tokens import TOKEN_PATTERN, count_tokens
from ..operators import batches, chunking, layout, projects, results, routing, rules
from ..schemas import corpus_chunk_error
from ..session import reachable
from ..sources import sinks, store
from ..sources.staging import spread
from ..streaming import flows
from .pipeline import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_DOCS = """v_docs AS (SELECT doc_id, 'PRJ' || lpad(CAST(doc_id % 10 AS VARCHAR), 3, '0') AS project_name,
 ['IXP','ROP','INI','DEC','IFS','IVS','RAS'][doc_id % 7 + 1] || '-' || doc_id || '.pdf' AS document_name, text AS content,
 CASE WHEN doc_id % 11 = 0 THEN 'error' ELSE 'success' END AS processing_status, 'batch_' || (doc_id % 5) AS batch_id, lang, source FROM documents)"""
_RULES = """rules AS (SELECT * FROM (VALUES ('IXP',1,'auditoria'),('ROP',2,'productos'),('INI',2,'productos'),('DEC',2,'productos'),('IFS',2,'productos'),
 ('ROP',3,'desembolsos'),('INI',3,'desembolsos'),('DEC',3,'desembolsos'),('IFS',3,'desembolsos')) r(prefix, prompt_number, prompt_type))"""
_ROUTED = f"{_DOCS}, {_RULES}, routed AS (SELECT d.*, r.* FROM v_docs d JOIN rules r ON r.prefix = split_part(d.document_name, '-', 1))"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(reachable(spark), sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return run

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- listings, routing, requests ---------------------------------------------------------------


@query(f"WITH {_ROUTED} SELECT project_name, prompt_type, count(*) AS n_requests, CAST(sum(length(content)) AS BIGINT) AS n_chars FROM routed GROUP BY ALL")
def route_prompt_counts(spark, sf_dir):
    routed = routing.route(views(spark, sf_dir))
    return routed.groupBy("project_name", "prompt_type").agg(F.count("*").alias("n_requests"), F.sum(F.length("content").cast("long")).alias("n_chars"))


@query(f"WITH {_DOCS} SELECT doc_id, document_name FROM v_docs WHERE regexp_matches(upper(document_name), '^(INI|IXP|DEC|ROP|IFS)')")
def required_prefix_filter(spark, sf_dir):
    return views(spark, sf_dir).where(routing.has_required_prefix("document_name")).select("doc_id", "document_name")


_EDGE = "CASE doc_id % 4 WHEN 0 THEN document_name WHEN 1 THEN replace(document_name, '-', '_a-') WHEN 2 THEN replace(document_name, '-', '') ELSE replace(document_name, '.pdf', '_chunk_003.json') END"


@query(f"WITH {_DOCS}, e AS (SELECT doc_id, {_EDGE} AS name FROM v_docs), c AS (SELECT *, split_part(name, '_chunk_', 1) AS n FROM e) SELECT doc_id, name, upper(CASE WHEN contains(n, '-') THEN split_part(n, '-', 1) ELSE left(n, 3) END) AS prefix, regexp_matches(upper(name), '^(INI|IXP|DEC|ROP|IFS)') AS required FROM c")
def prefix_extract_edge(spark, sf_dir):
    e = views(spark, sf_dir).select("doc_id", F.expr(_EDGE).alias("name"))
    return e.select("doc_id", "name", routing.extract_prefix("name").alias("prefix"), routing.has_required_prefix("name").alias("required"))


_KIND = "document_name || CASE doc_id % 3 WHEN 0 THEN '_Desembolso' WHEN 1 THEN '_prd' ELSE '_Auditor' END"


@query(f"WITH {_DOCS}, n AS (SELECT doc_id, lower({_KIND}) AS n FROM v_docs) SELECT doc_id, CASE WHEN regexp_matches(n, 'auditor|ixp') THEN 'Auditoria' WHEN regexp_matches(n, 'desembolso|des') THEN 'Desembolsos' WHEN regexp_matches(n, 'producto|prd') THEN 'Productos' ELSE 'Auditoria' END AS folder FROM n")
def document_type_heuristic(spark, sf_dir):
    return views(spark, sf_dir).select("doc_id", routing.document_type(F.expr(_KIND)).alias("folder"))


_FILES = f"""{_DOCS}, files AS (SELECT *, ['raw','raw/sub','processed/DI','processed/chunks',''][doc_id % 5 + 1] AS folder, length(content) AS file_size FROM v_docs)"""


def files(spark, sf_dir) -> DataFrame:
    """Listing rows made of documents: raw ones, nested ones, records, chunks, and stray objects at the top."""
    folders = F.array(*map(F.lit, ("raw", "raw/sub", "processed/DI", "processed/chunks", "")))
    return views(spark, sf_dir).withColumn("folder", F.get(folders, (F.col("doc_id") % 5).cast("int"))).withColumn("file_size", F.length("content").cast("long"))


@query(f"WITH {_FILES} SELECT project_name, count(*) FILTER (WHERE folder LIKE 'raw%') AS n_documents, min(document_name) FILTER (WHERE folder LIKE 'raw%') AS first_name FROM files WHERE folder <> '' GROUP BY ALL")
def project_listing(spark, sf_dir):
    f = files(spark, sf_dir)
    raw = store.list_raw_documents(f).groupBy("project_name").agg(F.count("*").alias("n_documents"), F.min("document_name").alias("first_name"))
    return store.list_projects(f).join(raw, "project_name", "left").select("project_name", F.coalesce("n_documents", F.lit(0).cast("long")).alias("n_documents"), "first_name")


@query(f"WITH {_DOCS} SELECT project_name, count(*) AS total, count(*) FILTER (WHERE processing_status = 'success') AS successful, count(*) FILTER (WHERE processing_status = 'error') AS failed, count(*) FILTER (WHERE processing_status LIKE 'skipped%') AS skipped FROM v_docs GROUP BY ALL")
def project_rollup(spark, sf_dir):
    return layout.rollup(views(spark, sf_dir))


_DONE = f"""{_DOCS}, done AS (SELECT doc_id FROM v_docs WHERE doc_id % 4 = 0 AND processing_status = 'success' AND doc_id % 8 <> 0), cut AS (SELECT doc_id FROM labels)"""


def _statuses(spark, sf_dir) -> DataFrame:
    """Documents of which some have a record (a failed or an empty one doesn't count) and those with labels have chunks."""
    v = views(spark, sf_dir)
    layouts = v.where("doc_id % 4 = 0").withColumn("content", F.when(F.col("doc_id") % 8 == 0, "").otherwise(F.lit("x")))
    labelled = v.join(_table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    chunks = labelled.select("project_name", F.col("document_name").alias("original_document"), F.explode(F.array(F.lit(0), F.lit(1))).alias("chunk_index"))
    return layout.pending(v.select("doc_id", "project_name", "document_name"), layouts, chunks)


@query(f"WITH {_DONE} SELECT doc_id, project_name, document_name FROM v_docs WHERE doc_id NOT IN (SELECT doc_id FROM done) AND doc_id NOT IN (SELECT doc_id FROM cut)")
def pending_documents_anti(spark, sf_dir):
    return _statuses(spark, sf_dir).where("status is null").drop("status")


@query(f"WITH {_DONE} SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM done) THEN 'skipped_already_processed' ELSE 'skipped_already_chunked' END AS status FROM v_docs WHERE doc_id IN (SELECT doc_id FROM done) OR doc_id IN (SELECT doc_id FROM cut)")
def chunked_documents_semi(spark, sf_dir):
    return _statuses(spark, sf_dir).where("status is not null").select("doc_id", "status")


@query(f"WITH {_DOCS} SELECT project_name, document_name, length(content) AS n_chars FROM v_docs WHERE doc_id % 3 <> 0 UNION ALL SELECT project_name, replace(document_name, '.pdf', '_chunk_000'), length(content) FROM v_docs WHERE doc_id % 3 = 0")
def di_union_chunks(spark, sf_dir):
    v = views(spark, sf_dir)
    chunks = v.where("doc_id % 3 = 0").select("project_name", F.replace("document_name", F.lit(".pdf"), F.lit("_chunk_000")).alias("document_name"), "content", F.col("document_name").alias("original_document"))
    return routing.inputs(v, chunks).select("project_name", "document_name", F.length("content").cast("long").alias("n_chars"))


_CORPUS = """corpus AS (SELECT project_name, document_name AS part, chr(10) || chr(10) || '--- DOCUMENT: ' || document_name || ' ---' || chr(10) || chr(10) || coalesce(content, '') || chr(10) || chr(10) || repeat('-', 50) || chr(10) || chr(10) AS c FROM v_docs WHERE processing_status = 'success'
 UNION ALL SELECT project_name, '', chr(10) || chr(10) || repeat('=', 80) || chr(10) || chr(10) || 'PROJECT: ' || upper(project_name) || chr(10) || 'PROCESSED DOCUMENTS: ' || count(*) FILTER (WHERE processing_status = 'success') || '/' || count(*) || chr(10) || 'SKIPPED DOCUMENTS: ' || count(*) FILTER (WHERE processing_status LIKE 'skipped%') || chr(10) || 'PROCESSOR: Azure Document Intelligence' || chr(10) || repeat('=', 80) || chr(10) || chr(10) FROM v_docs GROUP BY project_name)"""


@query(f"WITH {_DOCS}, {_CORPUS} SELECT project_name, part, length(c) AS n_chars, md5(c) AS digest FROM corpus")
def concat_corpus(spark, sf_dir):
    return layout.corpus(views(spark, sf_dir)).select("project_name", "part", F.length("content").cast("long").alias("n_chars"), F.md5("content").alias("digest"))


@query(f"WITH {_ROUTED} SELECT project_name || '_' || replace(document_name, '.pdf', '') || '_prompt' || prompt_number AS custom_id, project_name || '_' || replace(document_name, '.pdf', '') || '_' || prompt_type AS file_id FROM routed")
def request_ids(spark, sf_dir):
    return routing.route(views(spark, sf_dir)).select(routing.custom_id("project").alias("custom_id"), routing.custom_id("file").alias("file_id"))


_LENGTHS = ", ".join(f"('{k}', {len(v)})" for k, v in routing.PROMPTS.items())


@query(f"WITH {_ROUTED}, p AS (SELECT * FROM (VALUES {_LENGTHS}) p(prompt_type, n)) SELECT project_name, prompt_number, count(*) AS n_requests, CAST(sum(length(content) + n + 13) AS BIGINT) AS message_chars FROM routed JOIN p USING (prompt_type) GROUP BY ALL")
def request_manifest_size(spark, sf_dir):
    made = routing.requests(views(spark, sf_dir), EngineConfig())
    size = F.length(F.get(F.col("body.messages"), F.lit(1))["content"]).cast("long")
    return made.groupBy("project_name", "prompt_number").agg(F.count("*").alias("n_requests"), F.sum(size).alias("message_chars"))


@query(f"WITH {_ROUTED} SELECT project_name, document_name, prefix, string_agg(prompt_type, ',' ORDER BY prompt_number) AS prompts_applied, count(*) AS n_requests FROM routed GROUP BY ALL")
def batch_info_rollup(spark, sf_dir):
    made = routing.route(views(spark, sf_dir))
    return routing.documents_info(made).select("project_name", "document_name", "prefix", F.array_join("prompts_applied", ",").alias("prompts_applied"), "n_requests")


@query(f"WITH {_DOCS} SELECT doc_id, project_name, document_name FROM v_docs ORDER BY length(content) DESC, doc_id LIMIT 10")
def top_documents(spark, sf_dir):
    return store.top(views(spark, sf_dir), F.length("content"), 10, "doc_id").select("doc_id", "project_name", "document_name")


@query(f"WITH {_DOCS} SELECT count(*) FILTER (WHERE doc_id % 4 = 0) AS single, count(*) FILTER (WHERE doc_id % 4 IN (1, 2)) AS whole, count(*) FILTER (WHERE doc_id % 4 = 3) AS rejected FROM v_docs")
def message_dispatch(spark, sf_dir):
    v = views(spark, sf_dir)
    m = v.select("project_name", F.when(F.col("doc_id") % 4 != 3, "processing").alias("queue_type"), F.when(F.col("doc_id") % 4 == 0, F.col("document_name")).when(F.col("doc_id") % 4 == 1, "").alias("document_name"))
    return m.agg(*[F.count_if(routing.message_kind() == k).alias(k) for k in ("single", "whole", "rejected")])


# --- text and chunks ----------------------------------------------------------------------------


@query("SELECT doc_id, count(*) AS n_paragraphs, CAST(sum(length(p)) AS BIGINT) AS n_chars FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS p FROM documents) WHERE trim(p) <> '' GROUP BY ALL")
def paragraphs(spark, sf_dir):
    each = _table(spark, sf_dir, "documents").select("doc_id", F.explode(chunking.paragraphs("text", "\n")).alias("p"))
    return each.groupBy("doc_id").agg(F.count("*").alias("n_paragraphs"), F.sum(F.length("p").cast("long")).alias("n_chars"))


_SPLIT = r"regexp_replace(text, chr(10) || '([A-Z])', chr(1) || '\1', 'g')"


@query(f"SELECT doc_id, count(*) AS n_sections, max(length(s)) AS longest FROM (SELECT doc_id, unnest(string_split({_SPLIT}, chr(1))) AS s FROM documents) WHERE trim(s) <> '' GROUP BY ALL")
def sections(spark, sf_dir):
    each = _table(spark, sf_dir, "documents").select("doc_id", F.explode(chunking.sections("text", (r"\n[A-Z]",))).alias("s"))
    return each.groupBy("doc_id").agg(F.count("*").alias("n_sections"), F.max(F.length("s").cast("long")).alias("longest"))


#: RE2 has no lookaround: what stands around the white space is kept by groups, and a mark takes its place.
_SENTENCES = r"""string_split(regexp_replace({}, '([.?!…])[ \t\n\x0B\f\r]+(["''«“¿¡]?[A-ZÁÉÍÓÚÑ0-9])', '\1' || chr(1) || '\2', 'g'), chr(1))"""


@query(f"SELECT doc_id, CAST(len(list_filter({_SENTENCES.format('text')}, lambda x: trim(x) <> '')) AS INTEGER) AS n_sentences FROM documents")
def sentences(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", F.size(chunking.sentences("text")).alias("n_sentences"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) AS BIGINT) AS n_tokens FROM documents")
def token_counts(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", count_tokens("text").cast("long").alias("n_tokens"))


@query("SELECT doc_id, k AS piece, length(substr(text, CAST(k * 600 + 1 AS BIGINT), 600)) AS n_chars, md5(substr(text, CAST(k * 600 + 1 AS BIGINT), 600)) AS digest FROM (SELECT doc_id, text, unnest(range((length(text) + 599) // 600)) AS k FROM documents)")
def chunk_fixed_window(spark, sf_dir):
    each = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.fixed_windows("text", 600)).alias("piece", "part"))
    return each.select("doc_id", F.col("piece").cast("long").alias("piece"), F.length("part").cast("long").alias("n_chars"), F.md5("part").alias("digest"))


_EACH = """SELECT d.project_name, format('{{}}_chunk_{{:03d}}', replace(d.document_name, '.pdf', ''), c.k) AS document_name, CAST(c.k AS INTEGER) AS chunk_index, c.content, CAST(c.tokens AS INTEGER) AS tokens, c.sections_range, CAST(c.total_chunks AS INTEGER) AS total_chunks, c.chunking_strategy FROM c JOIN d USING (doc_id)""".format()
_WHOLE = """SELECT doc_id AS project_name, format('{{}}_chunk_{{:03d}}', doc_id, c.k) AS document_name, CAST(c.k AS INTEGER) AS chunk_index, c.content, CAST(c.tokens AS INTEGER) AS tokens, c.sections_range, doc_id || '_concatenated' AS original_document, CAST(c.total_chunks AS INTEGER) AS total_chunks, c.chunking_strategy, d.total AS total_tokens FROM c JOIN d USING (doc_id)""".format()


def _packing_sql(limit: int, overlap: int, texts: str = f"{_DOCS}, t AS (SELECT doc_id, project_name, document_name, content FROM v_docs)", result: str = _EACH) -> str:
    """The packer as a recursion over the parts of a text: sections, sentences of large sections, slices of large sentences,
    and cuts, at which what is held is let go."""

    def n(x: str) -> str:
        return f"len(regexp_extract_all({x}, '{TOKEN_PATTERN}'))"

    def strip(x: str) -> str:
        return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"

    tail = rf"CASE WHEN k = 0 THEN '' WHEN held <= k THEN cur ELSE array_to_string(list_slice(regexp_extract_all(cur, '(?:{TOKEN_PATTERN})\s*'), held - k + 1, held), '') END"
    return rf"""WITH RECURSIVE {texts}, d AS (SELECT *, {n('content')} AS total FROM t),
s AS (SELECT doc_id, i, m, p, {n('p')} AS n FROM (SELECT doc_id, unnest(parts) AS p, unnest(range(len(parts))) AS i, len(parts) AS m FROM (SELECT doc_id, list_filter(list_transform(string_split(content, chr(10)), lambda x: {strip('x')}), lambda x: x <> '') AS parts FROM d WHERE total > {limit}))),
z AS (SELECT doc_id, i, j, mj, p, {n('p')} AS n FROM (SELECT doc_id, i, unnest(parts) AS p, unnest(range(len(parts))) AS j, len(parts) AS mj FROM (SELECT doc_id, i, list_filter(list_transform({_SENTENCES.format('p')}, lambda x: {strip('x')}), lambda x: x <> '') AS parts FROM s WHERE n > {limit}))),
l AS (SELECT doc_id, i, j, unnest(c) AS p, unnest(range(len(c))) AS k FROM (SELECT doc_id, i, j, list_transform(range((n + {limit - 1}) // {limit}), lambda b: array_to_string(list_slice(t, b * {limit} + 1, (b + 1) * {limit}), '')) AS c FROM (SELECT *, regexp_extract_all(p, '(?:{TOKEN_PATTERN})\s*') AS t FROM z WHERE n > {limit}))),
u AS (SELECT doc_id, i, -1 AS j, -1 AS k, 'part' AS kind, p, n, i - 1 AS label FROM s WHERE n <= {limit}
 UNION ALL SELECT doc_id, i, -2, -1, 'cut', '', 0, i FROM s WHERE n > {limit}
 UNION ALL SELECT doc_id, i, j, 0, 'part', p, n, j - 1 FROM z WHERE n <= {limit}
 UNION ALL SELECT doc_id, i, j, -1, 'cut', '', 0, j FROM z WHERE n > {limit} AND mj > 1
 UNION ALL SELECT doc_id, i, j, k, 'slice', p, {n('p')}, k FROM l
 UNION ALL SELECT DISTINCT doc_id, i, 1000000, 0, 'cut', '', 0, mj - 1 FROM z WHERE mj > 1
 UNION ALL SELECT DISTINCT doc_id, 1000000, 0, 0, 'cut', '', 0, m - 1 FROM s),
w AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i, j, k) AS pos FROM u),
r AS (SELECT doc_id, CAST(0 AS BIGINT) AS pos, '' AS cur, CAST(0 AS BIGINT) AS held, CAST(NULL AS VARCHAR) AS body, CAST(0 AS BIGINT) AS body_n, '' AS range FROM (SELECT DISTINCT doc_id FROM w)
 UNION ALL SELECT doc_id, pos, CASE WHEN kind <> 'part' THEN '' WHEN cur = '' THEN p WHEN fits THEN cur || chr(10) || chr(10) || p WHEN trim(lead) = '' THEN p ELSE lead || chr(10) || chr(10) || p END,
  CASE WHEN kind <> 'part' THEN 0 WHEN cur = '' THEN n WHEN fits THEN held + n ELSE n + least(k, held) END,
  CASE WHEN kind = 'slice' THEN p WHEN cur <> '' AND NOT fits THEN cur END, CASE WHEN kind = 'slice' THEN n ELSE held END, CASE WHEN kind = 'slice' THEN 'Sección ' || label ELSE 'Hasta sección ' || label END
  FROM (SELECT *, {tail} AS lead FROM (SELECT r.doc_id, w.pos, r.cur, r.held, w.kind, w.p, w.n, w.label, w.kind = 'part' AND r.held + w.n <= {limit} AS fits, greatest(0, least({overlap}, {limit} - w.n)) AS k FROM r JOIN w ON w.doc_id = r.doc_id AND w.pos = r.pos + 1))),
c AS (SELECT doc_id, body AS content, body_n AS tokens, range AS sections_range, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS k, count(*) OVER (PARTITION BY doc_id) AS total_chunks, 'sections_with_overlap' AS chunking_strategy FROM r WHERE body IS NOT NULL
 UNION ALL SELECT doc_id, content, total, 'Documento completo', 0, 1, 'none' FROM d WHERE total <= {limit})
{result}"""


def _chunked(spark, sf_dir, overlap: int) -> DataFrame:
    cfg = EngineConfig(max_tokens=256, overlap_tokens=overlap, section_patterns=(r"\n",))
    return chunking.stored_chunks(chunking.chunk(spread(views(spark, sf_dir)), cfg)).drop("original_document")


@query(_packing_sql(256, 0))
def chunk_packed_no_overlap(spark, sf_dir):
    return _chunked(spark, sf_dir, 0)


@query(_packing_sql(256, 32))
def chunk_packed_overlap(spark, sf_dir):
    return _chunked(spark, sf_dir, 32)


@query(_packing_sql(256, 32, f"{_DOCS}, {_CORPUS}, t AS (SELECT project_name AS doc_id, string_agg(c, '' ORDER BY part) AS content FROM corpus GROUP BY project_name)", _WHOLE))
def project_chunks(spark, sf_dir):
    """Chunks of every project's concatenated text, which is spread over rows and ranges."""
    cfg = EngineConfig.project(max_tokens=256, overlap_tokens=32, section_patterns=(r"\n",))
    return projects.chunk_projects(layout.corpus(spread(views(spark, sf_dir))), cfg)


_WIDE = r"regexp_replace(regexp_replace(text, ' ', chr(160), 'g'), '(e)', '\1' || chr(12288), 'g')"


@query(rf"SELECT doc_id, CAST(len(regexp_extract_all({_WIDE}, '{TOKEN_PATTERN}')) AS INTEGER) AS n_tokens, CAST(len(regexp_extract_all({_WIDE}, '{TOKEN_PATTERN}')) AS INTEGER) AS chunk_tokens FROM documents")
def token_counts_wide_spaces(spark, sf_dir):
    """Counts of the JVM and of the packer in Python, over texts with no-break and ideographic spaces."""
    wide = F.regexp_replace(F.replace("text", F.lit(" "), F.lit("\u00a0")), "(e)", "$1\u3000")
    cut = chunking.chunk(spread(_table(spark, sf_dir, "documents")).select("doc_id", wide.alias("content")), EngineConfig(max_tokens=64, overlap_tokens=0))
    return cut.select("doc_id", F.col("total_tokens").alias("n_tokens"), F.aggregate("chunks", F.lit(0), lambda a, c: a + c["tokens"]).alias("chunk_tokens"))


@query(f"""WITH {_DOCS} SELECT format('{{}}_chunk_{{:03d}}', project_name, doc_id % 7) AS id_chunk, project_name AS proyecto, CASE WHEN doc_id % 13 = 0 THEN '' ELSE md5(content) END AS contenido, CASE WHEN doc_id % 17 = 0 THEN -1 ELSE 5 END AS tokens,
CASE WHEN doc_id % 17 = 0 THEN 'tokens is negative' WHEN doc_id % 13 = 0 THEN 'contenido is blank' END AS reason FROM v_docs""")
def corpus_validation(spark, sf_dir):
    v = views(spark, sf_dir).select("project_name", (F.col("doc_id") % 7).cast("int").alias("chunk_index"), F.when(F.col("doc_id") % 13 == 0, "").otherwise(F.md5("content")).alias("content"), F.when(F.col("doc_id") % 17 == 0, -1).otherwise(5).alias("tokens"), F.lit("x").alias("sections_range"), F.lit("none").alias("chunking_strategy"))
    r = chunking.corpus_records(v, EngineConfig(), F.lit("2024-01-01"))
    return r.select("id_chunk", "proyecto", "contenido", "tokens", corpus_chunk_error(r).alias("reason"))


# --- batches ------------------------------------------------------------------------------------

_BATCHES = """infos AS (SELECT 'b' || doc_id AS batch_id, 'PRJ' || lpad(CAST(doc_id % 10 AS VARCHAR), 3, '0') AS project_name, doc_id FROM documents),
st AS (SELECT *, ['validating','in_progress','finalizing','completed','failed'][doc_id % 5 + 1] AS status FROM infos), mk AS (SELECT batch_id FROM st WHERE doc_id % 2 = 0 AND status = 'completed')"""


def _batches(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    v = views(spark, sf_dir)
    infos = v.select(F.concat(F.lit("b"), F.col("doc_id").cast("string")).alias("batch_id"), "project_name", "doc_id", F.col("doc_id").alias("created_at"), F.lit("submitted").alias("status"))
    names = F.array(*map(F.lit, ("validating", "in_progress", "finalizing", "completed", "failed")))
    status = infos.select("batch_id", "doc_id", F.get(names, (F.col("doc_id") % 5).cast("int")).alias("status"))
    return infos.drop("doc_id"), status, status.where("doc_id % 2 = 0 and status = 'completed'").select("batch_id")


@query(f"""WITH {_BATCHES}, a AS (SELECT * FROM st WHERE status IN ('validating','in_progress','finalizing','completed') AND NOT (status = 'completed' AND batch_id IN (SELECT batch_id FROM mk)) AND project_name IN ('PRJ001', 'PRJ003', 'PRJ004')),
b AS (SELECT * FROM st WHERE status = 'completed' AND batch_id NOT IN (SELECT batch_id FROM mk))
SELECT batch_id, coalesce(a.project_name, b.project_name) AS project_name, coalesce(a.status, b.status) AS status, b.batch_id IS NOT NULL AS is_orphaned, coalesce(a.doc_id, b.doc_id) AS created_at FROM a FULL OUTER JOIN b USING (batch_id)""")
def pending_orphan_merge(spark, sf_dir):
    folders = spark.createDataFrame([("PRJ001",), ("PRJ003",), ("PRJ004",)], "folderName string")
    return batches.pending(*_batches(spark, sf_dir), folders)


@query(f"WITH {_BATCHES} SELECT count(*) AS batches, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status IN ('validating','in_progress','finalizing')) AS in_flight, count(*) FILTER (WHERE status = 'failed') AS other FROM st")
def batch_dispatch_counts(spark, sf_dir):
    infos, status, _ = _batches(spark, sf_dir)
    return batches.dispatch_counts(batches.with_status(infos, status))


@query(f"WITH {_BATCHES} SELECT batch_id, project_name, status FROM st WHERE status = 'failed'")
def dead_batches(spark, sf_dir):
    infos, status, _ = _batches(spark, sf_dir)
    return batches.dead(infos, status).select("batch_id", "project_name", "status")


@query("SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def last_writer_wins(spark, sf_dir):
    e = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return sinks.last_writer_wins(e, ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "user_id", "event_type", "value")


@query("SELECT user_id, count(*) AS expired FROM events WHERE ts < TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 24 HOURS GROUP BY ALL")
def expired_batches_24h(spark, sf_dir):
    e = _table(spark, sf_dir, "events").withColumn("created_at", F.col("ts"))
    return batches.expired(e, F.lit("2024-01-30 00:00:00").cast("timestamp")).groupBy("user_id").agg(F.count("*").alias("expired"))


@query("SELECT event_id, user_id, event_type, lag(event_type) OVER w AS before, lead(event_type) OVER w AS after FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def status_timeline(spark, sf_dir):
    return flows.moves(_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")).drop("ts")


@query("SELECT strftime(time_bucket(INTERVAL 5 MINUTES, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_5min(spark, sf_dir):
    return flows.tumbling(_table(spark, sf_dir, "events")).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")


# --- responses ----------------------------------------------------------------------------------

_RESPONSE_SQL = "'PRJ' || (doc_id % 10) || '_IXP-' || doc_id || '_prompt' || (doc_id % 4 + 1)"


def _ids(spark, sf_dir) -> DataFrame:
    i = F.col("doc_id").cast("string")
    return _table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("PRJ"), (F.col("doc_id") % 10).cast("string"), F.lit("_IXP-"), i, F.when(F.col("doc_id") % 3 == 0, F.lit("_chunk_002")).otherwise(""), F.lit("_prompt"), (F.col("doc_id") % 4 + 1).cast("string")).alias("custom_id"))


@query("""WITH i AS (SELECT doc_id, 'PRJ' || (doc_id % 10) || '_IXP-' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '_chunk_002' ELSE '' END || '_prompt' || (doc_id % 4 + 1) AS custom_id FROM documents)
SELECT custom_id, split_part(custom_id, '_', 1) AS project_name, regexp_extract(custom_id, '^[^_]*_(.*)_prompt[0-9]+$', 1) AS document_name, CASE doc_id % 4 WHEN 0 THEN 'auditoria' WHEN 1 THEN 'productos' WHEN 2 THEN 'desembolsos' END AS prompt_type, CASE WHEN doc_id % 3 = 0 THEN 'chunk_002' END AS chunk_info FROM i""")
def parse_custom_id(spark, sf_dir):
    return _ids(spark, sf_dir).select("custom_id", results.parse_id("custom_id").alias("id")).select("custom_id", "id.*")


def _lines(spark, sf_dir) -> DataFrame:
    """Response lines whose contents cycle through six shapes; every tenth failed, every 23rd isn't JSON."""
    d = _ids(spark, sf_dir)
    i = F.col("doc_id").cast("string")
    one = F.concat(F.lit('{"a":'), i, F.lit("}"))
    shapes = [one, F.concat(F.lit("```json\n"), one, F.lit("\n```")), F.concat(F.lit("["), one, F.lit(","), one, F.lit("]")), F.concat(one, one), F.concat(F.lit("["), one, F.lit(","), one, F.lit(',{"a":')), F.lit("nothing found")]
    content = F.get(F.array(*shapes), (F.col("doc_id") % 6).cast("int"))
    body = F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices"))
    response = F.struct(F.when(F.col("doc_id") % 10 == 9, 429).otherwise(200).alias("status_code"), body.alias("body"))
    line = F.to_json(F.struct("custom_id", response.alias("response")))
    return d.select(F.concat(F.lit("batch_"), (F.col("doc_id") % 5).cast("string")).alias("batch_id"), F.when(F.col("doc_id") % 23 == 22, F.lit("{broken")).otherwise(line).alias("value"))


_ITEMS = """l AS (SELECT doc_id, 'batch_' || (doc_id % 5) AS batch_id, doc_id % 23 = 22 AS broken, doc_id % 10 = 9 AS refused, CASE doc_id % 6 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 5 THEN 1 ELSE 2 END AS n,
 'PRJ' || (doc_id % 10) || '_IXP-' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '_chunk_002' ELSE '' END AS stem, doc_id % 4 + 1 AS number FROM documents),
items AS (SELECT *, unnest(range(n)) + 1 AS part FROM l WHERE NOT broken AND NOT refused)"""


@query(f"""WITH {_ITEMS} SELECT batch_id, stem || '_prompt' || number || CASE WHEN n > 1 THEN '_part_' || lpad(CAST(part AS VARCHAR), 3, '0') ELSE '' END AS item_id,
CASE WHEN doc_id % 6 = 5 THEN '{{"_raw_text":"nothing found","_parse_error":"no JSON object"}}' ELSE '{{"a":' || doc_id || '}}' END AS object, doc_id % 6 <> 5 AS recovered FROM items""")
def response_objects(spark, sf_dir):
    return results.objects(results.parse_lines(_lines(spark, sf_dir))).select("batch_id", "item_id", "object", "recovered")


@query(f"""WITH {_ITEMS}, f AS (SELECT batch_id, count(*) FILTER (WHERE broken OR refused) AS failed FROM l GROUP BY ALL), s AS (SELECT batch_id, count(*) AS ok FROM items GROUP BY ALL)
SELECT batch_id, ok + failed AS total, ok AS successful, failed, round(100.0 * ok / (ok + failed), 6) AS success_rate FROM f JOIN s USING (batch_id)""")
def response_statistics(spark, sf_dir):
    parsed = results.parse_lines(_lines(spark, sf_dir))
    return results.statistics(parsed, by=["batch_id"]).select("batch_id", "total", "successful", "failed", F.round("success_rate", 6).alias("success_rate"))


@query("SELECT user_id, count(*) AS total, count(*) FILTER (WHERE event_type <> 'error') AS successful, count(*) FILTER (WHERE event_type = 'error') AS failed, round(100.0 * count(*) FILTER (WHERE event_type <> 'error') / count(*), 6) AS success_rate FROM events GROUP BY ALL")
def result_status_stats(spark, sf_dir):
    e = _table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") == "error", "status 500").alias("error"))
    return results.statistics(e, e.where("error is null"), ["user_id"]).select("user_id", "total", "successful", "failed", F.round("success_rate", 6).alias("success_rate"))


@query(f"""WITH {_ITEMS} SELECT regexp_replace(stem, '^[^_]*_', '') AS document_name, CASE number WHEN 1 THEN 'auditoria' WHEN 2 THEN 'productos' WHEN 3 THEN 'desembolsos' END AS prompt_type, count(*) AS n_objects FROM items GROUP BY ALL""")
def group_by_document_type(spark, sf_dir):
    items = results.objects(results.parse_lines(_lines(spark, sf_dir)))
    return results.by_document(items).select("document_name", "prompt_type", F.size("objects").cast("long").alias("n_objects"))


@query(f"WITH {_ITEMS}, d AS (SELECT regexp_replace(stem, '^[^_]*_', '') AS document_name, number FROM items) SELECT document_name, count(*) FILTER (WHERE number = 1) AS auditoria, count(*) FILTER (WHERE number = 2) AS productos, count(*) FILTER (WHERE number = 3) AS desembolsos FROM d GROUP BY ALL")
def pivot_by_type(spark, sf_dir):
    return results.pivot_types(results.objects(results.parse_lines(_lines(spark, sf_dir))))


@query(f"WITH {_ITEMS}, t AS (SELECT unnest(['auditoria','productos','desembolsos']) AS prompt_type, unnest([1,2,3]) AS number) SELECT prompt_type, count(i.part) AS n FROM t LEFT JOIN items i USING (number) GROUP BY ALL")
def group_by_type(spark, sf_dir):
    return results.by_type(results.objects(results.parse_lines(_lines(spark, sf_dir))))


@query(f"""WITH {_ITEMS} SELECT batch_id, count(DISTINCT regexp_replace(stem, '^[^_]*_', '')) AS documents_processed, count(*) FILTER (WHERE number = 1) AS auditoria, count(*) FILTER (WHERE number = 2) AS productos, count(*) FILTER (WHERE number = 3) AS desembolsos FROM items GROUP BY ALL""")
def batch_summary(spark, sf_dir):
    s = results.summary(results.objects(results.parse_lines(_lines(spark, sf_dir))))
    return s.select("batch_id", "documents_processed", *[F.coalesce(F.try_element_at("prompts_results", F.lit(t)), F.lit(0)).alias(t) for t in results.TYPES])


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'proyectado' ELSE 'realizado' END AS tag, CAST(l_linenumber AS VARCHAR) AS monto FROM lineitem)
SELECT l_orderkey, tag AS tipo, monto, CASE WHEN monto = '2' THEN 'own' ELSE 'meta' END AS origen, 'BIGINT' AS monto_type, CAST(monto AS INTEGER) + 1 AS campo_value, monto = '2' AS firme, 'BOOLEAN' AS firme_type FROM r""")
def flatten_nested(spark, sf_dir):
    amount, triple, firm = F.col("l_linenumber").alias("monto"), F.struct((F.col("l_linenumber") + 1).alias("value"), F.lit("EXTRAIDO_DIRECTO").alias("confidence")).alias("campo"), (F.col("l_linenumber") == 2).alias("firme")
    line = F.struct(amount, triple, firm, F.lit("x").alias("tipo_registro_norm"), F.when(F.col("l_linenumber") == 2, "own").alias("origen"))
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") % 2 == 0).alias("planned"), line.alias("r"))
    nested = rows.groupBy("l_orderkey").agg(F.collect_list(F.when(F.col("planned"), F.col("r"))).alias("proyectados"), F.collect_list(F.when(~F.col("planned"), F.col("r"))).alias("realizados"))
    made = nested.select("l_orderkey", F.to_json(F.struct(F.struct("proyectados", "realizados").alias("desembolsos"), F.struct(F.lit("meta").alias("origen"), F.lit("y").alias("tipo_registro_norm")).alias("metadata"))).alias("object"))
    flat = results.flatten_disbursements(made)
    v = F.parse_json("object")
    texts = [F.variant_get(v, f"$.{p}", "string").alias(n) for n, p in (("tipo", "tipo_registro_norm"), ("monto", "monto"), ("origen", "origen"))]
    kinds = [F.schema_of_variant(F.variant_get(v, f"$.{p}", "variant")).alias(f"{p}_type") for p in ("monto", "firme")]
    return flat.select("l_orderkey", *texts, *kinds, F.variant_get(v, "$.campo.value", "int").alias("campo_value"), F.variant_get(v, "$.firme", "boolean").alias("firme"))


_CUT = "left(props, CAST(length(props) - event_id % 3 AS INT))"


@query(f"""WITH c AS (SELECT event_id, {_CUT} AS t FROM events), q AS (SELECT event_id, CASE WHEN (length(t) - length(replace(t, '"', ''))) % 2 = 1 THEN t || '"' ELSE t END AS t FROM c), b AS (SELECT event_id, regexp_replace(rtrim(t), ',$', '') AS t FROM q)
SELECT event_id, t || repeat('}}', greatest(0, (length(t) - length(replace(t, '{{', ''))) - (length(t) - length(replace(t, '}}', ''))))) AS repaired FROM b""")
def repair_truncated(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", recovery.repair_json(F.expr(_CUT)).alias("repaired"))


@query(f"""WITH c AS (SELECT event_id, {_CUT} AS t FROM events) SELECT event_id, concat_ws('; ', CASE WHEN length(replace(t, '{{', '')) <> length(replace(t, '}}', '')) THEN 'unbalanced braces' END, CASE WHEN rtrim(t) LIKE '%,' OR rtrim(t) LIKE '%"' THEN 'cut at the end' END) AS found FROM c""")
def diagnose_json(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", recovery.diagnose_json(F.expr(_CUT)).alias("found"))


@query("""WITH a AS (SELECT user_id, event_type, event_id, value FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM a) SELECT user_id, event_type, event_id, value FROM r WHERE rn = 1""")
def consolidate_latest(spark, sf_dir):
    e = _table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return results.consolidate(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["user_id", "event_type"], "event_id")


@query("SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def json_path_props(spark, sf_dir):
    return store.with_value(_table(spark, sf_dir, "events"), "props").select("event_id", F.try_variant_get("value", "$.k", "int").alias("k"))


# --- layout and rules ---------------------------------------------------------------------------


@query("SELECT user_id, round(avg(CASE WHEN value > 0 THEN value END), 6) AS confidence FROM events GROUP BY ALL")
def confidence_average(spark, sf_dir):
    part = F.struct(F.col("value").alias("confidence"))
    per = _table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(part).alias("tables"))
    none = F.array().cast("array<struct<confidence:double>>")
    built = per.select("user_id", F.struct("tables", none.alias("paragraphs"), none.alias("key_value_pairs")).alias("json_data"))
    return built.select("user_id", F.round(layout.average_confidence("json_data"), 6).alias("confidence"))


@query("""WITH c AS (SELECT n_regionkey, n_name, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INT) AS r FROM nation), m AS (SELECT n_regionkey, r, '| ' || n_name || ' | ' || CASE WHEN r % 2 = 0 THEN 'even' ELSE '' END || ' |' || CASE WHEN r = 0 THEN chr(10) || '| --- | --- |' ELSE '' END AS line FROM c)
SELECT n_regionkey, string_agg(line, chr(10) ORDER BY r) AS markdown FROM m GROUP BY ALL""")
def table_markdown(spark, sf_dir):
    n = _table(spark, sf_dir, "nation").withColumn("r", F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1)
    name = F.struct(F.col("n_name").alias("content"), F.col("r").alias("row_index"), F.lit(0).alias("column_index"))
    even = F.struct(F.lit("even").alias("content"), F.col("r").alias("row_index"), F.lit(1).alias("column_index"))
    cells = n.groupBy("n_regionkey").agg(F.flatten(F.collect_list(F.when(F.col("r") % 2 == 0, F.array(name, even)).otherwise(F.array(name)))).alias("cells"))
    return cells.select("n_regionkey", layout.table_markdown(F.struct("cells")).alias("markdown"))


@query("""WITH d AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority AS currency, o_orderstatus AS record_type, ['ROP','INI','DEC'][o_custkey % 3 + 1] AS source, CAST(o_custkey % 3 AS INT) AS p FROM orders)
SELECT period, currency, record_type, o_orderkey, source FROM (SELECT *, row_number() OVER (PARTITION BY period, currency, record_type ORDER BY p, o_orderkey DESC) AS rn FROM d) WHERE rn = 1""")
def dedup_period_currency(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.col("o_orderpriority").alias("currency"), F.col("o_orderstatus").alias("record_type"), F.get(F.array(*map(F.lit, rules.SOURCE_ORDER)), (F.col("o_custkey") % 3).cast("int")).alias("source"))
    return rules.dedup_disbursements(rows, revised="o_orderkey").select("period", "currency", "record_type", "o_orderkey", "source")


@query("SELECT lang, source, round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END), 6) AS coverage, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ROLLUP (lang, source)")
def coverage_rollup(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(_table(spark, sf_dir, "labels"), "doc_id")
    c = d.withColumn("confidence", F.when(F.col("quality") == 1, "EXTRAIDO_DIRECTO").otherwise("NO_EXTRAIDO"))
    return c.rollup("lang", "source").agg(F.round(rules.coverage("confidence"), 6).alias("coverage"), F.count("*").alias("n"))


_GOAL = "CASE p_partkey % 4 WHEN 0 THEN p_size || ' km' WHEN 1 THEN '1.' || lpad(CAST(p_size AS STRING), 3, '0') || ' personas' WHEN 2 THEN p_size || '%' ELSE p_size || ',5 ha' END"


@query("SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 1 THEN 1000 + p_size WHEN 3 THEN p_size + 0.5 ELSE p_size END AS DOUBLE) AS number, ['km','personas','%','ha'][p_partkey % 4 + 1] AS unit, ['km','personas','%','hectáreas'][p_partkey % 4 + 1] AS unit_norm FROM part")
def goal_unit_split(spark, sf_dir):
    number, unit = rules.goal(F.expr(_GOAL))
    return _table(spark, sf_dir, "part").select("p_partkey", number.alias("number"), unit.alias("unit"), rules.goal_unit(unit).alias("unit_norm"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Favorable' WHEN 1 THEN 'Favorable con reservas' WHEN 2 THEN 'Desfavorable' ELSE 'no se menciona' END AS opinion FROM documents")
def opinion_class(spark, sf_dir):
    phrases = F.array(*map(F.lit, ("presenta razonablemente la situación", "opinión favorable con salvedades", "Opinión DESFAVORABLE", "sin texto")))
    return _table(spark, sf_dir, "documents").select("doc_id", rules.opinion(F.get(phrases, (F.col("doc_id") % 4).cast("int"))).alias("opinion"))


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18, 2)) AS amount FROM orders")
def amount_parse(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("US$ "), F.format_number("o_totalprice", 2))).otherwise(F.concat(F.lit("Bs "), F.translate(F.format_number("o_totalprice", 2), ",.", ".,")))
    return _table(spark, sf_dir, "orders").select("o_orderkey", rules.amount(text).cast("decimal(18,2)").alias("amount"))


from . import queues, records  # noqa: E402,F401 registers more queries
