"""Schemas of the records, as DDL, and the validators of corpus chunks and document metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = "struct<content:string,row_index:int,column_index:int,row_span:int,column_span:int,confidence:double,kind:string>"
TABLE = f"struct<table_id:int,row_count:int,column_count:int,confidence:double,cells:array<{CELL}>>"
IMAGE = "struct<figure_id:int,caption:string,confidence:double,bounding_regions:array<struct<page_number:int,polygon:array<struct<x:double,y:double>>>>>"
KEY_VALUE = "struct<key:string,value:string,confidence:double>"
PARAGRAPH = "struct<paragraph_id:int,content:string,role:string,confidence:double>"
LAYOUT = f"struct<content:string,tables:array<{TABLE}>,images:array<{IMAGE}>,key_value_pairs:array<{KEY_VALUE}>,paragraphs:array<{PARAGRAPH}>>"

#: What providers answer: captions, keys and values as texts or objects, polygons in any form.
RAW_FIGURE = "struct<caption:string,confidence:double,bounding_regions:array<struct<page_number:int,polygon:array<string>>>>"
RAW_LAYOUT = (
    f"struct<content:string,tables:array<struct<row_count:int,column_count:int,confidence:double,cells:array<{CELL}>>>,"
    f"figures:array<{RAW_FIGURE}>,images:array<{RAW_FIGURE}>,"
    f"key_value_pairs:array<{KEY_VALUE}>,paragraphs:array<struct<content:string,role:string,confidence:double>>>"
)

RAW_DOCUMENT = "project_name string, document_name string, path string, content binary, file_size long, modified_at timestamp"
LAYOUT_DOCUMENT = (
    "project_name string, document_name string, content string, metadata struct<filename:string,file_size:long,content_length:long,processing_status:string,"
    f"pages:int,tables_found:int,images_found:int,confidence_score:double,error_message:string,skip_reason:string>, json_data {LAYOUT}"
)
CHUNK = "index int, content string, tokens int, sections_range string"
STORED_CHUNK = "document_name string, chunk_index int, content string, tokens int, sections_range string, metadata struct<created_at:string,project_name:string,original_document:string,total_chunks:int,chunking_strategy:string>"
REQUEST = "custom_id string, method string, url string, body struct<model:string,messages:array<struct<role:string,content:string>>,max_completion_tokens:int,temperature:double>"
RESPONSE = "custom_id string, response struct<status_code:int,body:struct<choices:array<struct<message:struct<content:string>>>,usage:string>>"
FOLDER_STATE = "id string, folderName string, isBatchPending boolean, jobBatchId string, lastProcessedBatchId string, processedAt string, lastStats struct<total_processed:int,successful_responses:int,failed_responses:int,success_rate:double>"
QUEUE_MESSAGE = "project_name string, queue_type string, document_name string, document_type string, operation_id string"
LOG_EVENT = "timestamp timestamp, level string, logger string, message string, operation_id string, operation_name string, custom_fields map<string,string>"

# The fields of a corpus record.
CORPUS_FIELDS = (
    "id_chunk", "proyecto", "contenido", "tokens", "indice_chunk", "rango_secciones", "estrategia_chunking",
    "max_tokens_configurado", "overlap_tokens", "timestamp_procesamiento", "fuente", "version_esquema",
)
# The fields of document metadata.
METADATA_FIELDS = ("filename", "file_size", "processing_status")


def corpus_chunk_error(df: DataFrame) -> Column:
    """The first rule that a corpus record breaks, or null."""
    missing = [f for f in CORPUS_FIELDS if f not in df.columns]
    if missing:
        return F.lit(f"missing field {missing[0]}")
    rules = [F.when(F.col(f).isNull(), F.lit(f"missing field {f}")) for f in CORPUS_FIELDS]
    for f in ("tokens", "indice_chunk"):
        rules.append(F.when(F.col(f) < 0, F.lit(f"{f} is negative")))
    for f in ("contenido", "proyecto"):
        rules.append(F.when(F.trim(F.regexp_replace(f, r"\s+", " ")) == "", F.lit(f"{f} is blank")))
    return F.coalesce(*rules)


def metadata_error(df: DataFrame) -> Column:
    """The first metadata field that is missing, or null."""
    missing = [f for f in METADATA_FIELDS if f not in df.columns]
    if missing:
        return F.lit(f"missing field {missing[0]}")
    return F.coalesce(*[F.when(F.col(f).isNull(), F.lit(f"missing field {f}")) for f in METADATA_FIELDS])


def validate(df: DataFrame, error=corpus_chunk_error) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their reason."""
    checked = df.withColumn("reason", error(df))
    return checked.where("reason is null").drop("reason"), checked.where("reason is not null")
