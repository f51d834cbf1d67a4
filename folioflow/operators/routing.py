"""Which documents are extracted, with which prompts, and the requests for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BATCH_REQUESTS, PROMPT_PREFIXES, PROMPT_TYPES, EngineConfig

#: Our own prompt texts; a table of other texts can be passed instead.
PROMPTS = {
    "auditoria": "List each audit finding of the document as a JSON object with value, confidence and evidence for every field.",
    "productos": "List each product and its goal as one JSON object per product, with the goal's number and unit apart.",
    "desembolsos": "List each disbursement as one JSON object per period, currency and record type; don't convert currencies.",
}


# The first message of every request, and what stands between prompt and document.
SYSTEM_MESSAGE = "Eres un Analista experto en documentos de auditoría. Tu tarea es extraer información específica siguiendo un formato estructurado y emitiendo conceptos normalizados para entregar en formato JSON lo solicitado."
DOCUMENT_MARK = "\n\nDocumento:\n"


def has_required_prefix(name: Column | str, prefixes: tuple[str, ...] = EngineConfig.prefixes) -> Column:
    return F.upper(name).rlike("^(" + "|".join(prefixes) + ")")


def extract_prefix(name: Column | str, fallback: Column | str | None = None) -> Column:
    """Upper-case text before the first dash, else the first three characters; chunk suffixes don't count."""
    n = F.coalesce(name, fallback, F.lit("")) if fallback is not None else F.coalesce(name, F.lit(""))
    n = F.substring_index(n, "_chunk_", 1)
    return F.upper(F.when(F.contains(n, F.lit("-")), F.substring_index(n, "-", 1)).otherwise(F.left(n, F.lit(3))))


def document_type(name: Column | str) -> Column:
    """Folder of a document by words in its name; the first match wins."""
    n = F.lower(name)

    def has(*words: str) -> Column:
        return n.rlike("|".join(words))

    return F.when(has("auditor", "ixp"), "Auditoria").when(has("desembolso", "des"), "Desembolsos").when(has("producto", "prd"), "Productos").otherwise("Auditoria")


def rules(spark: SparkSession) -> DataFrame:
    """prefix, prompt_number, prompt_type: nine rows."""
    rows = [(p, n, PROMPT_TYPES[n]) for n, prefixes in PROMPT_PREFIXES.items() for p in prefixes]
    return spark.createDataFrame(rows, "prefix string, prompt_number int, prompt_type string")


def prompts(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame(list((texts or PROMPTS).items()), "prompt_type string, prompt_text string")


def route(docs: DataFrame, name_col: str = "document_name") -> DataFrame:
    """Documents times the prompts that apply to them; the rules are nine rows and broadcast."""
    return docs.withColumn("prefix", extract_prefix(name_col)).join(F.broadcast(rules(docs.sparkSession)), "prefix")


def custom_id(style: str = "project") -> Column:
    """project: {project}_{stem}_prompt{n}. file: {project}_{document}_{type}[_chunk_000].
    document: {document}_{type}_chunk_000."""
    stem = F.regexp_replace("document_name", r"\.[^.]*$", "")
    number = F.regexp_extract("document_name", r"_chunk_(\d+)", 1)
    if style == "project":
        return F.concat_ws("_", "project_name", stem, F.concat(F.lit("prompt"), F.col("prompt_number").cast("string")))
    bare = F.substring_index(stem, "_chunk_", 1)
    chunk = F.when(number != "", F.concat(F.lit("chunk_"), F.lpad(number, 3, "0")))
    if style == "file":
        return F.concat_ws("_", "project_name", bare, "prompt_type", chunk)
    return F.concat_ws("_", bare, "prompt_type", F.coalesce(chunk, F.lit("chunk_000")))


def requests(docs: DataFrame, cfg: EngineConfig, style: str = "project", texts: dict[str, str] | None = None) -> DataFrame:
    """One request per document or chunk and prompt: its id, line and manifest columns."""
    spark = docs.sparkSession
    routed = route(docs).join(F.broadcast(prompts(spark, texts)), "prompt_type")
    message = F.concat("prompt_text", F.lit(DOCUMENT_MARK), F.coalesce("content", F.lit("")))
    body = F.struct(
        F.lit(cfg.model).alias("model"),
        F.array(F.struct(F.lit("system").alias("role"), F.lit(SYSTEM_MESSAGE).alias("content")), F.struct(F.lit("user").alias("role"), message.alias("content"))).alias("messages"),
        F.lit(cfg.max_completion_tokens).alias("max_completion_tokens"),
        F.lit(cfg.temperature).alias("temperature"),
    )
    rows = routed.withColumn("custom_id", custom_id(style))
    return rows.select("custom_id", F.lit("POST").alias("method"), F.lit("/chat/completions").alias("url"), body.alias("body"), "project_name", "document_name", "prompt_number", "prompt_type", "prefix")


def request_line() -> Column:
    return F.to_json(F.struct("custom_id", "method", "url", "body"), {"ignoreNullFields": "false"})


def request_lines(made: DataFrame) -> DataFrame:
    return made.select(request_line().alias("value"))


def documents_info(made: DataFrame) -> DataFrame:
    """Per document its type, folder, prefix and the prompts applied, in order of their numbers."""
    applied = F.transform(F.array_sort(F.collect_list(F.struct("prompt_number", "prompt_type"))), lambda x: x["prompt_type"])
    return made.groupBy("project_name", "document_name", "prefix").agg(applied.alias("prompts_applied"), F.count("*").alias("n_requests")).withColumns({"document_type": document_type("document_name"), "subfolder": subfolder("document_name")})


def subfolder(name: Column | str) -> Column:
    """Folder that a request's text comes from."""
    return F.when(F.contains(name, F.lit("_chunk_")), "chunks").otherwise("DI")


def payloads(made: DataFrame, stamp: Column | None = None) -> DataFrame:
    """A record per request with its prompt and context: what a batch's payload manifest lists."""
    user = F.get(F.col("body.messages"), F.lit(1))["content"]
    cut = F.instr(user, F.lit(DOCUMENT_MARK))
    return made.select(
        "project_name", "custom_id", "prompt_number", "prompt_type", F.left(user, cut - 1).alias("prompt_text"), F.substring(user, cut + len(DOCUMENT_MARK), F.length(user)).alias("context"), "document_name",
        document_type("document_name").alias("document_type"), subfolder("document_name").alias("subfolder"), "prefix", (F.current_timestamp() if stamp is None else stamp).cast("string").alias("created_at"),
    )


def inputs(layouts: DataFrame, chunks: DataFrame) -> DataFrame:
    """What requests are made of: chunks, and the documents that have none."""
    chunked = chunks.select("project_name", F.col("original_document").alias("document_name")).distinct()
    whole = layouts.join(chunked, ["project_name", "document_name"], "left_anti").select("project_name", "document_name", "content")
    return whole.unionByName(chunks.select("project_name", "document_name", "content"))


def message_kind() -> Column:
    """single (one document), whole (a project), or rejected: without a required field."""
    sound = F.col("project_name").isNotNull() & F.col("queue_type").isNotNull()
    single = F.coalesce(F.col("document_name") != "", F.lit(False))
    return F.when(~sound, "rejected").when(single, "single").otherwise("whole")


def dispatch(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Messages for one document, for a whole project, and those without their required fields."""
    return tuple(messages.where(message_kind() == k) for k in ("single", "whole", "rejected"))


def batch_files(made: DataFrame) -> DataFrame:
    """project_name, part, n_requests: how a project's requests are cut into batches that the service takes."""
    per = made.groupBy("project_name").agg(F.count("*").alias("n"))
    parts = per.select("project_name", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / BATCH_REQUESTS) - 1)).alias("part"))
    return parts.select("project_name", "part", F.least(F.lit(BATCH_REQUESTS), F.col("n") - F.col("part") * BATCH_REQUESTS).alias("n_requests"))
