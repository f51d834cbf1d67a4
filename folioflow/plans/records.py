"""More of the query catalogue: listings, files, records and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import names, recovery
from ..operators import batches, chunking, layout, results, routing, rules
from ..schemas import metadata_error
from ..sources import sinks, store
from ..sources.staging import spread
from ..streaming import flows
from .catalog import _BATCHES, _DOCS, _FILES, _ROUTED, _batches, _ids, _table, files, query
from .pipeline import views

# --- listings and state -------------------------------------------------------------------------


@query(f"WITH {_FILES} SELECT project_name, count(*) FILTER (WHERE folder IN ('raw', 'raw/sub')) AS raw, count(*) FILTER (WHERE folder = 'processed/DI') AS processed, count(*) FILTER (WHERE folder = 'processed/chunks') AS chunks FROM files WHERE folder <> '' GROUP BY ALL")
def listing_folders(spark, sf_dir):
    f = files(spark, sf_dir)
    kinds = {"raw": store.list_raw_documents(f), "processed": store.list_processed_documents(f), "chunks": store.list_chunks(f)}
    tagged = [v.select("project_name", F.lit(k).alias("kind")) for k, v in kinds.items()]
    every = tagged[0].union(tagged[1]).union(tagged[2])
    return every.groupBy("project_name").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])


@query(f"WITH {_FILES} SELECT doc_id, document_name FROM files WHERE project_name || '/' || folder LIKE 'PRJ003/processed%' AND document_name LIKE '%1%'")
def listing_prefix(spark, sf_dir):
    return store.list_with_prefix(files(spark, sf_dir), "PRJ003/processed", "1").select("doc_id", "document_name")


@query(f"WITH {_FILES} SELECT project_name || '/' || CASE WHEN folder = '' THEN '' ELSE folder || '/' END || document_name AS name FROM files WHERE project_name = 'PRJ003' AND folder LIKE 'processed%' AND doc_id % 2 = 1")
def listing_container_names(spark, sf_dir):
    f = files(spark, sf_dir)
    return store.names_with_prefix({"even": f.where("doc_id % 2 = 0"), "odd": f.where("doc_id % 2 = 1")}, "PRJ003/processed", "odd")


@query(f"WITH {_FILES}, w AS (SELECT doc_id, project_name, document_name FROM v_docs) SELECT w.doc_id, EXISTS (SELECT 1 FROM files f WHERE f.doc_id = w.doc_id AND f.folder LIKE 'raw%') AS in_raw, EXISTS (SELECT 1 FROM files f WHERE f.doc_id = w.doc_id AND f.folder = 'processed/DI') AS in_processed FROM w")
def documents_exist(spark, sf_dir):
    f, wanted = files(spark, sf_dir), views(spark, sf_dir).select("doc_id", "project_name", "document_name")
    out = wanted
    for name, folder in (("in_raw", store.RAW), ("in_processed", store.LAYOUT)):
        out = out.join(store.exist_in(wanted, f, folder).select("doc_id", F.lit(True).alias(name)), "doc_id", "left")
    return out.select("doc_id", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("in_raw", "in_processed")])


@query(f"WITH {_FILES} SELECT doc_id FROM files WHERE NOT (folder LIKE 'raw%' AND doc_id % 6 = 0)")
def files_without_deleted(spark, sf_dir):
    f = files(spark, sf_dir)
    gone = store.list_raw_documents(f).where("doc_id % 6 = 0").select("project_name", "document_name")
    return sinks.without_deleted(f, gone).select("doc_id")


def _state(spark, sf_dir) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    name = F.when(F.col("c_custkey") % 7 == 0, "").when(F.col("c_custkey") % 11 == 0, None).otherwise(F.concat(F.lit("F"), (F.col("c_custkey") % 50).cast("string")))
    return c.select(F.col("c_custkey").cast("string").alias("id"), name.alias("folderName"), (F.col("c_custkey") % 3 == 0).alias("isBatchPending"), F.col("c_custkey").cast("long").alias("n"))


@query("SELECT DISTINCT 'F' || (c_custkey % 50) AS \"folderName\" FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 7 <> 0 AND c_custkey % 11 <> 0")
def pending_folders(spark, sf_dir):
    return store.pending_folders(_state(spark, sf_dir))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey % 3 = 0 AS pending FROM customer WHERE c_custkey = 12 UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_custkey % 3 = 0 FROM customer WHERE c_custkey > 100 AND c_custkey % 3 = 0")
def state_items(spark, sf_dir):
    s = _state(spark, sf_dir)
    found = store.read_item(s, "id", "12").unionByName(store.query_state(s, "n > 100 and isBatchPending"))
    return found.select("id", F.col("isBatchPending").alias("pending"))


@query("WITH s AS (SELECT c_custkey AS id, 'old' AS v, 1 AS t FROM customer), c AS (SELECT c_custkey AS id, 'new' AS v, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS t FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT -1 - c_custkey, 'added', 5 FROM customer WHERE c_custkey % 5 = 0) SELECT coalesce(s.id, c.id) AS id, CASE WHEN s.id IS NULL OR (c.id IS NOT NULL AND c.t >= s.t) THEN c.v ELSE s.v END AS v FROM s FULL OUTER JOIN c USING (id)")
def state_upsert(spark, sf_dir):
    k = _table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("id"))
    state = k.select("id", F.lit("old").alias("v"), F.lit(1).alias("t"))
    changes = k.where("id % 2 = 0").select("id", F.lit("new").alias("v"), F.when(F.col("id") % 4 == 0, 0).otherwise(1).alias("t"))
    added = k.where("id % 5 = 0").select((-1 - F.col("id")).alias("id"), F.lit("added").alias("v"), F.lit(5).alias("t"))
    return sinks.upsert(state, changes.unionByName(added), "id", "t").select("id", "v")


@query(f"WITH {_DOCS} SELECT doc_id, CASE split_part(replace(document_name, '.pdf', ['.PDF','.docx','.doc','.txt','.xlsx','.xls','.png',''][doc_id % 8 + 1]), '.', 2) WHEN 'PDF' THEN 'application/pdf' WHEN 'docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' WHEN 'doc' THEN 'application/msword' WHEN 'txt' THEN 'text/plain' WHEN 'xlsx' THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' WHEN 'xls' THEN 'application/vnd.ms-excel' ELSE 'application/octet-stream' END AS mime FROM v_docs")
def media_types(spark, sf_dir):
    endings = F.array(*map(F.lit, (".PDF", ".docx", ".doc", ".txt", ".xlsx", ".xls", ".png", "")))
    name = F.replace("document_name", F.lit(".pdf"), F.get(endings, (F.col("doc_id") % 8).cast("int")))
    return views(spark, sf_dir).select("doc_id", sinks.mime_type(name).alias("mime"))


@query(f"WITH {_DOCS} SELECT DISTINCT project_name, 'processing' AS queue_type FROM v_docs")
def sender_messages(spark, sf_dir):
    return flows.project_messages(views(spark, sf_dir))


@query(f"WITH {_DOCS} SELECT doc_id, nfc_normalize(document_name || chr(233) || 'e' || chr(769) || chr(64257)) AS name FROM v_docs")
def names_normalized(spark, sf_dir):
    return views(spark, sf_dir).select("doc_id", names.normalize_name(F.concat("document_name", F.lit("ééﬁ"))).alias("name"))


# --- layout -------------------------------------------------------------------------------------

_ANSWER = """'{"content":' || CASE WHEN o_orderkey % 2 = 0 THEN '""' ELSE '"body"' END || ',"tables":[{"row_count":1,"column_count":2,"cells":[{"content":"' || o_orderkey || '","row_index":0,"column_index":0},{"content":"b","row_index":0,"column_index":1,"row_span":2}]},{"row_count":0,"column_count":0}],"figures":[{"caption":{"content":"fig"},"bounding_regions":[{"page_number":1,"polygon":[1,2,3,4,5]},{"page_number":2,"polygon":[{"x":1,"y":2},[3,4],"bad"]}]},{"caption":"plain"},{}],"key_value_pairs":[{"key":{"content":"k"},"value":{"content":"' || o_orderstatus || '"},"confidence":0.5},{"key":"only"}],"paragraphs":[{"content":"p"},{"content":"q","role":"title"}]}'"""


def _structured(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", layout.structured(F.expr(_ANSWER)).alias("d"))


@query("""SELECT o_orderkey, '0,1' AS table_ids, '1,2' AS spans, 'fig|plain|' AS captions, '1.0:2.0 3.0:4.0|1.0:2.0 3.0:4.0' AS polygons, 'k=' || o_orderstatus || '|only=' AS pairs, '0:p:,1:q:title' AS paragraphs FROM orders""")
def layout_structured(spark, sf_dir):
    d = F.col("d")

    def listed(c, f, mark: str = ","):
        return F.array_join(F.transform(c, f), mark)

    points = F.flatten(F.transform(d["images"], lambda i: F.transform(i["bounding_regions"], lambda r: listed(r["polygon"], lambda p: F.concat_ws(":", p["x"].cast("string"), p["y"].cast("string")), " "))))
    return _structured(spark, sf_dir).select(
        "o_orderkey", listed(d["tables"], lambda t: t["table_id"].cast("string")).alias("table_ids"), listed(F.flatten(F.transform(d["tables"], lambda t: t["cells"])), lambda c: c["row_span"].cast("string")).alias("spans"),
        listed(d["images"], lambda i: i["caption"], "|").alias("captions"), F.array_join(points, "|").alias("polygons"), listed(d["key_value_pairs"], lambda p: F.concat_ws("=", p["key"], p["value"]), "|").alias("pairs"),
        listed(d["paragraphs"], lambda p: F.concat_ws(":", p["paragraph_id"].cast("string"), p["content"], F.coalesce(p["role"], F.lit("")))).alias("paragraphs"),
    )


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN 'body' || chr(10) || chr(10) ELSE '' END || chr(10) || '## Table 1' || chr(10) || chr(10) || '| ' || o_orderkey || ' | b |' || chr(10) || '| --- | --- |' || chr(10) || chr(10) || chr(10) || '## Table 2' || chr(10) || chr(10) || chr(10) || chr(10) || '## Key-Value Pairs' || chr(10) || chr(10) || '**k**: ' || o_orderstatus || chr(10) || chr(10) || '**only**: ' || chr(10) || chr(10) AS markdown, CAST(0.5 AS DOUBLE) AS confidence FROM orders""")
def layout_markdown(spark, sf_dir):
    return _structured(spark, sf_dir).select("o_orderkey", layout.markdown("d").alias("markdown"), layout.average_confidence("d").alias("confidence"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber // 2 = 0 THEN '' ELSE array_to_string(list_transform(range(l_linenumber // 2), lambda k: CAST(2 * k + 1 AS DOUBLE) || ':' || CAST(2 * k + 2 AS DOUBLE)), ' ') END AS points FROM lineitem")
def polygon_pairs(spark, sf_dir):
    flat = F.transform(F.sequence(F.lit(1), "l_linenumber"), lambda x: x.cast("double"))
    points = layout.polygon_points(flat)
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(F.transform(points, lambda p: F.concat_ws(":", p["x"].cast("string"), p["y"].cast("string"))), " ").alias("points"))


@query(f"WITH {_DOCS}, t AS (SELECT project_name, CASE WHEN project_name < 'PRJ003' THEN 0 ELSE count(*) END AS listed, count(*) FILTER (WHERE regexp_matches(document_name, '^(INI|IXP)') AND project_name <> 'PRJ005') AS total FROM v_docs GROUP BY project_name) SELECT project_name, CASE WHEN project_name = 'PRJ009' THEN 'error_listing_documents' WHEN listed = 0 THEN 'no_documents_found' WHEN total = 0 THEN 'no_documents_with_required_prefixes' ELSE 'completed' END AS status FROM t")
def run_statuses(spark, sf_dir):
    taken = routing.has_required_prefix("document_name", ("INI", "IXP")) & (F.col("project_name") != "PRJ005")
    t = views(spark, sf_dir).groupBy("project_name").agg(F.count("*").alias("n"), F.count_if(taken).alias("total"))
    listed = F.when(F.col("project_name") < "PRJ003", 0).otherwise(F.col("n"))
    return t.select("project_name", layout.run_status(F.col("total"), listed, F.col("project_name") == "PRJ009").alias("status"))


@query(f"WITH {_DOCS} SELECT project_name, replace(document_name, '.pdf', '.json') AS file_name, md5(content) AS digest FROM v_docs WHERE processing_status = 'success' UNION ALL SELECT project_name, project_name || '_metadata.json', CAST(count(*) AS VARCHAR) || '/' || count(*) FILTER (WHERE processing_status = 'success') FROM v_docs GROUP BY project_name")
def processed_project_files(spark, sf_dir):
    f = layout.processed_files(views(spark, sf_dir).select("project_name", "document_name", "content", "processing_status"))
    counts = F.concat_ws("/", F.get_json_object("value", "$.total"), F.get_json_object("value", "$.successful"))
    return f.select("project_name", "file_name", F.when(F.endswith("file_name", F.lit("_metadata.json")), counts).otherwise(F.md5(F.get_json_object("value", "$.content"))).alias("digest"))


@query(f"WITH {_DOCS} SELECT project_name, replace(document_name, '.pdf', '.md') AS file_name, md5('# ' || document_name || chr(10) || chr(10) || content) AS digest FROM v_docs WHERE processing_status = 'success'")
def markdown_documents(spark, sf_dir):
    return layout.markdown_files(views(spark, sf_dir)).select("project_name", "file_name", F.md5("value").alias("digest"))


# --- chunks and requests ------------------------------------------------------------------------


@query(f"""WITH {_DOCS}, c AS (SELECT project_name, row_number() OVER w - 1 AS k, coalesce(content, '') AS content, length(coalesce(content, '')) AS tokens, count(*) OVER (PARTITION BY project_name) AS n, CAST(sum(length(coalesce(content, ''))) OVER (PARTITION BY project_name) AS BIGINT) AS total FROM v_docs WINDOW w AS (PARTITION BY project_name ORDER BY doc_id)),
r AS (SELECT project_name, k, n, CAST(to_json({{'id_chunk': format('{{}}_chunk_{{:03d}}', project_name, k), 'proyecto': project_name, 'contenido': content, 'tokens': tokens, 'indice_chunk': k, 'rango_secciones': 'Hasta sección ' || k, 'estrategia_chunking': 'sections_with_overlap', 'max_tokens_configurado': 100000, 'overlap_tokens': 500, 'timestamp_procesamiento': '2024-01-01 00:00:00', 'fuente': 'document_intelligence_chunking', 'version_esquema': '1.0'}}) AS VARCHAR) AS record FROM c WHERE trim(regexp_replace(content, '\\s+', ' ', 'g')) <> ''),
f AS (SELECT project_name, format('docs/{{}}_chunk_{{:03d}}.md', project_name, k) AS file_name, 0 AS line, '# Chunk ' || k || ' - Proyecto ' || project_name || chr(10) || chr(10) || '**Tokens:** ' || format('{{:,}}', tokens) || '  ' || chr(10) || '**Rango:** Hasta sección ' || k || '  ' || chr(10) || '**Estrategia:** sections_with_overlap  ' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || content || chr(10) AS value FROM c
 UNION ALL SELECT project_name, format('agents_output/corpus_chunk_{{:03d}}.jsonl', k), 0, record FROM r UNION ALL SELECT project_name, 'agents_output/corpus_document_intelligence.jsonl', k, record FROM r WHERE n > 1
 UNION ALL SELECT project_name, 'docs/' || project_name || '_chunking_metadata.json', k + 1, CAST(to_json({{'index': k, 'content': content, 'tokens': tokens, 'sections_range': 'Hasta sección ' || k}}) AS VARCHAR) || CASE WHEN k + 1 < n THEN ',' ELSE '' END FROM c
 UNION ALL SELECT DISTINCT project_name, 'docs/' || project_name || '_chunking_metadata.json', 0, '{{"project_name":"' || project_name || '","total_tokens":' || total || ',"requires_chunking":true,"chunks":[' FROM c
 UNION ALL SELECT DISTINCT project_name, 'docs/' || project_name || '_chunking_metadata.json', n + 1, '],"chunking_strategy":"sections_with_overlap","max_tokens_per_chunk":100000,"overlap_tokens":500}}' FROM c)
SELECT project_name, file_name, CAST(line AS INTEGER) AS line, md5(value) AS digest FROM f""")
def chunk_files(spark, sf_dir):
    """Files of projects whose documents stand in for chunks."""
    content, of = F.coalesce("content", F.lit("")), Window.partitionBy("project_name")
    k = (F.row_number().over(of.orderBy("doc_id")) - 1).alias("chunk_index")
    size = F.length(content)
    made = views(spark, sf_dir).select("project_name", k, content.alias("content"), size.alias("tokens"), F.count("*").over(of).alias("total_chunks"), F.sum(size).over(of).alias("total_tokens"), F.lit("sections_with_overlap").alias("chunking_strategy"))
    made = made.withColumn("sections_range", F.concat(F.lit("Hasta sección "), F.col("chunk_index").cast("string")))
    f = sinks.chunk_files(made, EngineConfig.project(), F.lit("2024-01-01 00:00:00"))
    return f.select("project_name", "file_name", F.col("line").cast("int").alias("line"), F.md5("value").alias("digest"))


@query(f"WITH {_DOCS}, p AS (SELECT project_name, count(*) AS n FROM v_docs GROUP BY ALL), c AS (SELECT project_name, n, unnest(range(n % 4 + 1)) AS k FROM p) SELECT project_name, format('{{}}_chunk_{{:03d}}', project_name, k) AS document_name, project_name || '_concatenated' AS original_document, CAST(n % 4 + 1 AS INTEGER) AS total_chunks FROM c")
def project_chunk_names(spark, sf_dir):
    n = views(spark, sf_dir).groupBy("project_name").agg(F.count("*").alias("n"))
    parts = F.transform(F.sequence(F.lit(0), (F.col("n") % 4).cast("int")), lambda k: F.struct(k.alias("index"), F.lit("x").alias("content"), F.lit(1).alias("tokens"), F.lit("").alias("sections_range")))
    made = n.select("project_name", parts.alias("chunks"), F.lit("none").alias("chunking_strategy"))
    return chunking.project_chunks(made).select("project_name", "document_name", "original_document", "total_chunks")


@query(rf"WITH {_DOCS}, t AS (SELECT project_name, len(regexp_extract_all(content, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')) AS n FROM v_docs) SELECT project_name, count(*) FILTER (WHERE n > 5000) AS chunked, count(*) FILTER (WHERE n <= 5000) AS not_chunked FROM t GROUP BY ALL")
def chunk_summary(spark, sf_dir):
    done = chunking.chunk(spread(views(spark, sf_dir)), EngineConfig.project(max_tokens=5000, section_patterns=(r"\n",)))
    return chunking.chunk_summary(done).select("project_name", "chunked", "not_chunked")


@query(f"WITH {_DOCS}, r AS (SELECT * FROM (VALUES ('IXP','auditoria'),('ROP','productos'),('INI','productos'),('DEC','productos'),('IFS','productos'),('ROP','desembolsos'),('INI','desembolsos'),('DEC','desembolsos'),('IFS','desembolsos')) r(prefix, t)) SELECT replace(document_name, '.pdf', '') || '_' || t || '_chunk_' || CASE WHEN doc_id % 2 = 0 THEN '002' ELSE '000' END AS custom_id FROM v_docs JOIN r ON r.prefix = split_part(document_name, '-', 1)")
def document_request_ids(spark, sf_dir):
    name = F.when(F.col("doc_id") % 2 == 0, F.concat(F.regexp_replace("document_name", r"\.pdf$", ""), F.lit("_chunk_002.json"))).otherwise(F.col("document_name"))
    return routing.requests(views(spark, sf_dir).withColumn("document_name", name), EngineConfig(), "document").select("custom_id")


_TEXTS = ", ".join(f"('{k}', '{v.replace(chr(39), chr(39) * 2)}')" for k, v in routing.PROMPTS.items())


@query(f"WITH {_ROUTED}, p AS (SELECT * FROM (VALUES {_TEXTS}) p(prompt_type, prompt_text)) SELECT project_name || '_' || replace(document_name, '.pdf', '') || '_prompt' || prompt_number AS custom_id, 'system,user' AS roles, md5('{routing.SYSTEM_MESSAGE}') AS first_digest, md5(prompt_text || chr(10) || chr(10) || 'Documento:' || chr(10) || coalesce(content, '')) AS digest, 1000 AS budget FROM routed JOIN p USING (prompt_type)")
def request_line_bodies(spark, sf_dir):
    lines = routing.request_lines(routing.requests(views(spark, sf_dir), EngineConfig()))
    read = F.from_json("value", "custom_id string, body struct<messages:array<struct<role:string,content:string>>,max_completion_tokens:int>")
    r = lines.select(read.alias("r"))
    messages = [F.md5(F.get("r.body.messages", F.lit(k))["content"]) for k in range(2)]
    return r.select("r.custom_id", F.array_join(F.transform("r.body.messages", lambda m: m["role"]), ",").alias("roles"), messages[0].alias("first_digest"), messages[1].alias("digest"), F.col("r.body.max_completion_tokens").alias("budget"))


@query(f"WITH {_ROUTED}, p AS (SELECT * FROM (VALUES {_TEXTS}) p(prompt_type, prompt_text)) SELECT project_name, project_name || '_' || replace(document_name, '.pdf', '') || '_prompt' || prompt_number AS custom_id, prompt_number, prompt_type, prompt_text, md5(coalesce(content, '')) AS context, document_name, CASE WHEN lower(document_name) LIKE '%ixp%' OR lower(document_name) LIKE '%auditor%' THEN 'Auditoria' WHEN lower(document_name) LIKE '%des%' THEN 'Desembolsos' WHEN lower(document_name) LIKE '%prd%' OR lower(document_name) LIKE '%producto%' THEN 'Productos' ELSE 'Auditoria' END AS document_type, 'DI' AS subfolder, prefix, '2024-01-01' AS created_at FROM routed JOIN p USING (prompt_type)")
def payload_manifest(spark, sf_dir):
    made = routing.payloads(routing.requests(views(spark, sf_dir), EngineConfig()), F.lit("2024-01-01"))
    return made.withColumn("context", F.md5("context"))


# --- batches and results ------------------------------------------------------------------------


@query(f"WITH {_DOCS}, n AS (SELECT doc_id, project_name, project_name || '/' || CASE doc_id % 3 WHEN 0 THEN 'batch_info_' || doc_id || '.json' WHEN 1 THEN 'batch_info_' || doc_id || '.txt' ELSE 'info.json' END AS path FROM v_docs) SELECT doc_id, doc_id % 3 = 0 AS is_info, project_name AS project FROM n")
def batch_info_names(spark, sf_dir):
    i = F.col("doc_id").cast("string")
    name = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("batch_info_"), i, F.lit(".json"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("batch_info_"), i, F.lit(".txt"))).otherwise("info.json")
    path = F.concat_ws("/", F.lit("base"), "project_name", name)
    stated = F.when(F.col("doc_id") % 2 == 0, F.col("project_name"))
    return views(spark, sf_dir).select("doc_id", batches.is_batch_info(name).alias("is_info"), batches.project_of(path, stated).alias("project"))


@query(f"WITH {_BATCHES} SELECT DISTINCT 'b' || doc_id AS batch_id, CASE WHEN doc_id % 5 = 4 THEN 'error' ELSE 'completed' END AS status, CAST(CASE WHEN doc_id % 5 = 4 THEN 0 ELSE doc_id % 7 END AS INTEGER) AS total FROM st")
def batch_status_snapshot(spark, sf_dir):
    infos, _, _ = _batches(spark, sf_dir)
    return batches.status(infos, _Answers()).select("batch_id", "status", "total")


class _Answers:
    """A batch service for the query above: every fifth batch's request fails."""

    def submit(self, path: str, project: str, part: int) -> str:
        return f"{project}-{part}"

    def status(self, batch_id: str) -> dict:
        n = int(batch_id[1:])
        if n % 5 == 4:
            raise TimeoutError("no answer")
        return {"status": "completed", "created_at": n, "request_counts": {"total": n % 7}}


@query(f"WITH {_DOCS}, h AS (SELECT DISTINCT project_name, ['auditoria','productos','desembolsos'][doc_id % 4 + 1] AS f FROM v_docs WHERE doc_id % 4 < 3 AND (doc_id % 10 <> 3 OR doc_id % 4 = 0)), q AS (SELECT project_name, list(f) AS have FROM h GROUP BY ALL) SELECT project_name, array_to_string(list_filter(['auditoria','productos','desembolsos'], lambda x: NOT list_contains(have, x)), ',') AS missing, len(have) = 3 AS complete FROM q")
def results_missing(spark, sf_dir):
    kinds = F.get(F.array(*map(F.lit, results.TYPES)), (F.col("doc_id") % 4).cast("int"))
    have = views(spark, sf_dir).where("doc_id % 4 < 3 and (doc_id % 10 <> 3 or doc_id % 4 = 0)").select("project_name", kinds.alias("document_name"))
    return batches.missing_types(have, results.TYPES).select("project_name", F.array_join("missing", ",").alias("missing"), "complete")


@query("SELECT user_id AS id, false AS pending, count(*) FILTER (WHERE event_type <> 'error') AS successful, round(100.0 * count(*) FILTER (WHERE event_type <> 'error') / count(*), 6) AS rate FROM events GROUP BY ALL")
def folder_state_changes(spark, sf_dir):
    e = _table(spark, sf_dir, "events").select(F.col("user_id").alias("project_name"), F.lit("b").alias("batch_id"), F.when(F.col("event_type") == "error", "status 500").alias("error"))
    s = results.statistics(e, e.where("error is null"), ["project_name", "batch_id"])
    changes = batches.folder_changes(batches.markers_of(s, F.lit("2024-01-01")), F.lit("2024-01-01"))
    return changes.select("id", F.col("isBatchPending").alias("pending"), F.col("lastStats.successful_responses").alias("successful"), F.round("lastStats.success_rate", 6).alias("rate"))


_TYPE = "CASE doc_id % 4 WHEN 0 THEN 'auditoria' WHEN 1 THEN 'productos' WHEN 2 THEN 'desembolsos' END"


@query(f"""SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN '{{"a":' || doc_id || '}}' WHEN 1 THEN '[{{"a":1}},{{"a":2}}]' WHEN 2 THEN '{{"keep":' || doc_id || '}}' WHEN 3 THEN '"only words"' WHEN 4 THEN NULL WHEN 5 THEN 'default' WHEN 6 THEN '{{"b":1}}' ELSE NULL END AS shown, CASE WHEN doc_id % 8 = 5 THEN 'words ' || doc_id END AS preview, CASE WHEN doc_id % 8 = 5 THEN 'productos' END AS as_type FROM documents""")
def materialised_contents(spark, sf_dir):
    i = F.col("doc_id").cast("string")
    quoted = F.concat(F.lit('{\\"a\\":'), i, F.lit("}"))
    shapes = [F.concat(F.lit('{"_raw_text":"'), quoted, F.lit('","_parse_error":"x"}')), F.lit('{"_raw_text":"{\\"a\\":1} {\\"a\\":2}","_parse_error":"x"}'), F.concat(F.lit('{"_raw_text":"none","keep":'), i, F.lit("}")), F.lit('{"_raw_text":"only words","_parse_error":"x"}'), F.lit("{}"), F.concat(F.lit("words "), i), F.lit('{"b":1}'), F.lit(" [ ] ")]
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.get(F.array(*shapes), (F.col("doc_id") % 8).cast("int")).alias("object"), F.when(F.col("doc_id") % 8 == 5, "productos").otherwise("auditoria").alias("prompt_type"))
    made = results.materialise(rows, stamp=F.lit("2024-01-01 10:00:00").cast("timestamp"))
    preview = F.get_json_object("object", "$._original_content_preview")
    kind = F.when(preview.isNotNull() & (F.get_json_object("object", "$.check_producto") == "No") & (F.get_json_object("object", "$.meta_producto.confidence") == "NO_EXTRAIDO") & (F.get_json_object("object", "$.fecha_extraccion") == "2024-01-01 10:00"), "productos")
    return made.select("doc_id", F.when(preview.isNotNull(), "default").otherwise(F.col("object")).alias("shown"), preview.alias("preview"), kind.alias("as_type"))


_TEXT = """CASE doc_id % 5 WHEN 0 THEN '```json' || chr(10) || '{"a":' || doc_id || '}' || chr(10) || '```' WHEN 1 THEN '{"a":"' || doc_id WHEN 2 THEN 'see ```json' || chr(10) || '[' || doc_id || ']' || chr(10) || '``` end' WHEN 3 THEN 'words' ELSE '{"a":[1,2' END"""


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '{"a":' || doc_id || '}' WHEN 1 THEN '{"a":"' || doc_id || '"}' WHEN 2 THEN '[' || doc_id || ']' WHEN 3 THEN 'words' ELSE '{"a":[1,2' END AS found FROM documents""")
def extract_json(spark, sf_dir):
    text = F.expr(_TEXT.replace("chr(10)", "'\\n'"))
    return _table(spark, sf_dir, "documents").select("doc_id", recovery.extract_json(text).alias("found"))


@query("""WITH r AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'auditoria' WHEN 1 THEN 'productos' WHEN 2 THEN 'desembolsos' END AS prompt_type FROM documents WHERE doc_id % 10 <> 9), c AS (SELECT prompt_type, 'PRJ' || (doc_id % 10) || '_IXP-' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '_chunk_002' ELSE '' END || '_prompt' || (doc_id % 4 + 1) AS custom_id, '{"a":' || doc_id || '}' AS content FROM r WHERE prompt_type IS NOT NULL)
SELECT prompt_type, custom_id, content, row_number() OVER (PARTITION BY prompt_type ORDER BY custom_id, content) AS position, count(*) OVER (PARTITION BY prompt_type) AS n FROM c""")
def contents_by_type(spark, sf_dir):
    rows = _ids(spark, sf_dir).select("custom_id", F.concat(F.lit('```json\n{"a":'), F.col("doc_id").cast("string"), F.lit("}\n```")).alias("content"), F.when(F.col("doc_id") % 10 == 9, "status 429").alias("error"))
    return results.contents_by_type(rows)


@query(f"""WITH i AS (SELECT 'batch_' || (doc_id % 5) AS batch_id, 'D' || (doc_id % 40) AS d, {_TYPE} AS t, doc_id FROM documents), p AS (SELECT batch_id, d, t, '[' || string_agg('{{"a":' || doc_id || '}}', ',' ORDER BY lpad(CAST(doc_id AS VARCHAR), 9, '0')) || ']' AS a FROM i WHERE t IS NOT NULL GROUP BY ALL)
SELECT batch_id, d AS key, '{{' || string_agg('"' || t || '":' || a, ',' ORDER BY t) || '}}' AS value FROM p GROUP BY batch_id, d UNION ALL SELECT batch_id, t, '{{' || string_agg('"' || d || '":' || a, ',' ORDER BY d) || '}}' FROM p GROUP BY batch_id, t""")
def batch_result_files(spark, sf_dir):
    i = F.col("doc_id").cast("string")
    items = _table(spark, sf_dir, "documents").select(F.concat(F.lit("batch_"), (F.col("doc_id") % 5).cast("string")).alias("batch_id"), F.concat(F.lit("D"), (F.col("doc_id") % 40).cast("string")).alias("document_name"), F.expr(_TYPE).alias("prompt_type"), F.lpad(i, 9, "0").alias("item_id"), F.concat(F.lit('{"a":'), i, F.lit("}")).alias("object"))
    by_document, by_type = sinks.result_files(items)
    return by_document.unionByName(by_type)


# --- rules --------------------------------------------------------------------------------------


@query(f"WITH {_DOCS} SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'missing field filename' WHEN 1 THEN 'missing field file_size' WHEN 2 THEN 'missing field processing_status' END AS reason FROM v_docs")
def metadata_validation(spark, sf_dir):
    i = F.col("doc_id") % 4
    rows = views(spark, sf_dir).select("doc_id", F.when(i != 0, F.col("document_name")).alias("filename"), F.when(i != 1, F.length("content")).alias("file_size"), F.when(i != 2, F.col("processing_status")).alias("processing_status"))
    return rows.select("doc_id", metadata_error(rows).alias("reason"))


@query("SELECT doc_id, ['No requerido','Pendiente','No disponible','Disponible',NULL][doc_id % 5 + 1] AS state, ['pendiente','proyectado','realizado',NULL][doc_id % 4 + 1] AS data_type, (doc_id % 3 <> 0) OR doc_id % 2 = 0 AS allowed FROM documents")
def extraction_states(spark, sf_dir):
    i = F.col("doc_id")
    states = F.array(*map(F.lit, ("no aplica aquí", "En trámite", "vencido", "fue ENTREGADO", "otra cosa")))
    kinds = F.array(*map(F.lit, ("por definir", "Estimado", "se ha ejecutado", "otra cosa")))
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.when(i % 3 == 0, "SSC").otherwise("IXP").alias("source"), F.when(i % 2 == 0, "status_auditoria_SSC").otherwise("codigo_CFA").alias("field"))
    return rows.select("doc_id", rules.report_status(F.get(states, (i % 5).cast("int"))).alias("state"), rules.data_type(F.get(kinds, (i % 4).cast("int"))).alias("data_type"), rules.allowed_source("field", "source").alias("allowed"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_totalprice AS DECIMAL(18, 2)) END AS usd FROM orders")
def amounts_in_dollars(spark, sf_dir):
    n = F.format_number("o_totalprice", 2)
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("US$ "), n)).when(F.col("o_orderkey") % 3 == 1, F.concat(n, F.lit(" USD"))).otherwise(F.concat(F.lit("Bs "), n))
    return _table(spark, sf_dir, "orders").select("o_orderkey", rules.usd_amount(text).cast("decimal(18,2)").alias("usd"))


@query("SELECT user_id, event_type, count(*) AS \"count\" FROM events GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark, sf_dir):
    return rules.repeated_keys(_table(spark, sf_dir, "events"), ("user_id", "event_type"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority AS currency, o_orderstatus AS record_type, CAST(1 AS BIGINT) AS n_kept, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL")
def one_row_per_key(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.col("o_orderpriority").alias("currency"), F.col("o_orderstatus").alias("record_type"), F.lit("ROP").alias("source"))
    kept = rules.dedup_disbursements(rows, revised="o_orderkey")
    return kept.groupBy("period", "currency", "record_type").agg(F.count("*").alias("n_kept"), F.max("o_orderkey").alias("o_orderkey"))
