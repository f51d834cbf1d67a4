"""Writers. All overwrite by path or by key, so a repeated run leaves the same state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators.chunking import corpus_records
from ..schemas import CORPUS_FIELDS, corpus_chunk_error

_KEEP_NULLS = {"ignoreNullFields": "false"}


def as_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns), _KEEP_NULLS)


def write_records(df: DataFrame, path: str, by: str | None = "project_name") -> None:
    """One JSON record per line, nulls written, partitioned by project."""
    names = [c for c in df.columns if c != by]
    rows = df.select(*([by] if by else []), as_json(*names).alias("value"))
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).text(path)


def write_jsonl(df: DataFrame, path: str, rejected: str | None = None, error=corpus_chunk_error) -> None:
    """Valid records as lines; the others go to the rejected path with their reason."""
    checked = df.withColumn("reason", error(df))
    checked.where("reason is null").select(as_json(*df.columns).alias("value")).write.mode("overwrite").text(path)
    if rejected:
        checked.where("reason is not null").select(as_json(*checked.columns).alias("value")).write.mode("overwrite").text(rejected)


def chunk_files(chunks: DataFrame, cfg: EngineConfig, stamp: Column | None = None, metadata: bool = True) -> DataFrame:
    """project_name, file_name, line, value: the files of a project's chunks (project_name, chunk_index, content, tokens, sections_range,
    chunking_strategy, total_chunks, total_tokens). A markdown file and a file with one corpus record per chunk, for
    several chunks one file of all records, and one about the whole. Files of a whole project are rows that follow one another by
    `line`, so none holds a project. Records that the validator refuses are left out."""
    number = F.format_string("_chunk_%03d", "chunk_index")
    head = F.concat(F.lit("# Chunk "), F.col("chunk_index").cast("string"), F.lit(" - Proyecto "), "project_name", F.lit("\n\n**Tokens:** "), F.format_number("tokens", 0), F.lit("  \n**Rango:** "), F.coalesce("sections_range", F.lit("")), F.lit("  \n**Estrategia:** "), "chunking_strategy", F.lit("  \n\n---\n\n"))
    text = chunks.select("project_name", F.concat(F.lit("docs/"), "project_name", number, F.lit(".md")).alias("file_name"), F.lit(0).alias("line"), F.concat(head, "content", F.lit("\n")).alias("value"))
    records = corpus_records(chunks, cfg, stamp, keep=("project_name", "chunk_index", "total_chunks"))
    sound = records.where(corpus_chunk_error(records).isNull()).select("project_name", "chunk_index", "total_chunks", as_json(*CORPUS_FIELDS).alias("value"))
    each = sound.select("project_name", F.concat(F.lit("agents_output/corpus"), number, F.lit(".jsonl")).alias("file_name"), F.lit(0).alias("line"), "value")
    every = sound.where("total_chunks > 1").select("project_name", F.lit("agents_output/corpus_document_intelligence.jsonl").alias("file_name"), F.col("chunk_index").alias("line"), "value")
    out = text.unionByName(each).unionByName(every)
    if not metadata:
        return out
    about = F.concat(F.lit("docs/"), "project_name", F.lit("_chunking_metadata.json")).alias("file_name")
    item = F.concat(as_json(F.col("chunk_index").alias("index"), "content", "tokens", "sections_range"), F.when(F.col("chunk_index") + 1 < F.col("total_chunks"), ",").otherwise(""))
    items = chunks.select("project_name", about, (F.col("chunk_index") + 1).alias("line"), item.alias("value"))
    per = chunks.groupBy("project_name").agg(F.max("total_chunks").alias("n"), F.max("chunking_strategy").alias("s"), F.max("total_tokens").alias("t"))
    needed = F.col("s") != "none"
    first = F.concat(F.lit('{"project_name":'), F.to_json(F.col("project_name").cast("variant")), F.lit(',"total_tokens":'), F.col("t").cast("string"), F.lit(',"requires_chunking":'), needed.cast("string"), F.lit(',"chunks":['))
    limits = F.when(needed, F.lit(f',"max_tokens_per_chunk":{cfg.max_tokens},"overlap_tokens":{cfg.overlap_tokens}')).otherwise("")
    last = F.concat(F.lit('],"chunking_strategy":"'), "s", F.lit('"'), limits, F.lit("}"))
    ends = per.select("project_name", about, F.explode(F.array(F.struct(F.lit(0).alias("line"), first.alias("value")), F.struct((F.col("n") + 1).cast("int").alias("line"), last.alias("value")))).alias("e")).select("project_name", "file_name", "e.line", "e.value")
    return out.unionByName(items).unionByName(ends)


# Media types by file ending.
MIME = {
    "pdf": "application/pdf", "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "doc": "application/msword",
    "txt": "text/plain", "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "xls": "application/vnd.ms-excel",
}


def mime_type(name: Column | str) -> Column:
    ending = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
    known = F.create_map(*[F.lit(x) for pair in MIME.items() for x in pair])
    return F.coalesce(F.try_element_at(known, ending), F.lit("application/octet-stream"))


def write_raw(raw: DataFrame, path: str) -> None:
    """Raw documents (project_name, document_name, content) with their media types, by project."""
    raw.withColumn("content_type", mime_type("document_name")).write.mode("overwrite").partitionBy("project_name").parquet(path)


def write_files(files: DataFrame, path: str) -> None:
    """Files (project_name, file_name, value), one line of JSON each, by project."""
    rows = files.select("project_name", as_json("file_name", "value").alias("value"))
    rows.write.mode("overwrite").partitionBy("project_name").text(path)


def write_corpus(parts: DataFrame, path: str) -> None:
    """Corpus parts in order below a folder per project; a project may spread over many files, whose names sort in the
    order of their parts. Every part ends with a line end, which the writer adds."""
    ordered = parts.repartitionByRange("project_name", "part").sortWithinPartitions("project_name", "part")
    ordered.select("project_name", F.expr("left(content, length(content) - 1)").alias("value")).write.mode("overwrite").partitionBy("project_name").text(path)


def result_files(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A batch's results by document and by type, one JSON text each: batch_id, key, value."""
    named = items.where("prompt_type is not null and document_name is not null")

    def nested(outer: str, inner: str) -> DataFrame:
        listed = F.transform(F.array_sort(F.collect_list(F.struct("item_id", "object"))), lambda x: x["object"])
        per = named.groupBy("batch_id", outer, inner).agg(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("array"))
        field = F.concat(F.to_json(F.col(inner).cast("variant")), F.lit(":"), "array")
        body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(inner, field.alias("f")))), lambda x: x["f"]), ",")
        return per.groupBy("batch_id", F.col(outer).alias("key")).agg(F.concat(F.lit("{"), body, F.lit("}")).alias("value"))

    return nested("document_name", "prompt_type"), nested("prompt_type", "document_name")


def write_contents(contents: DataFrame, path: str) -> None:
    """Contents (prompt_type, custom_id, content) as JSON lines by type, in the order of their ids over a type's files."""
    ordered = contents.repartitionByRange("prompt_type", "custom_id").sortWithinPartitions("prompt_type", "custom_id")
    ordered.select("prompt_type", as_json("custom_id", "content").alias("value")).write.mode("overwrite").partitionBy("prompt_type").text(path)


def layout_file_name(name: Column | str, compat: bool = False) -> Column:
    """Stem + .json; compat replaces .pdf and .docx wherever they stand and leaves other names alone."""
    if compat:
        return F.replace(F.replace(name, F.lit(".pdf"), F.lit(".json")), F.lit(".docx"), F.lit(".json"))
    return F.concat(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit(".json"))


def upsert(state: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """The state with changed rows replaced: per key the row with the greatest order, changes first at ties."""
    both = state.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (key, "_new")]
    kept = both.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, "_new")).alias("_row"))
    return kept.select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in both.columns if c != "_new"])


def last_writer_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by the given order. An aggregate, so nothing is sorted or gathered."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")


def without_deleted(files: DataFrame, deleted: DataFrame) -> DataFrame:
    """A view in which deleted objects are gone; nothing is destroyed."""
    return files.join(deleted, [c for c in ("project_name", "document_name") if c in deleted.columns], "left_anti")
