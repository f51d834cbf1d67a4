"""Sources, batches, layout and streams."""

import json
import unicodedata

from pyspark.sql import functions as F

from folioflow.config import EngineConfig
from folioflow.operators import batches, layout, results, routing
from folioflow.plans.pipeline import Pipeline, register
from folioflow.schemas import validate
from folioflow.sources.epochs import Epochs
from folioflow.sources import sinks, store
from folioflow.streaming import flows


def names(df, c="document_name"):
    return sorted(r[c] for r in df.collect())


def test_store_listings_and_name_forms(spark, tmp_path):
    root = tmp_path / "basedocuments"
    nfd = unicodedata.normalize("NFD", "IXP-informé.pdf")
    for path in (f"P1/raw/{nfd}", "P1/raw/sub/ROP-x.pdf", "P1/processed/DI/a.json", "P1/processed/chunks/a_chunk_000.json", "P2/raw/IVS-q.pdf"):
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text('{"a": 1}')
    files = store.listing(spark, str(root))
    assert names(store.list_projects(files), "project_name") == ["P1", "P2"]
    assert len(names(store.list_raw_documents(files))) == 3
    assert names(store.list_chunks(files)) == ["a_chunk_000.json"]
    assert names(store.list_with_prefix(files, "P1/processed", "chunk")) == ["a_chunk_000.json"]
    wanted = spark.createDataFrame([("P1", "IXP-informé.pdf"), ("P1", "no.pdf")], "project_name string, document_name string")
    found = {r["document_name"]: r["path"] for r in store.find_documents(wanted, store.list_raw_documents(files)).collect()}
    assert found["IXP-informé.pdf"] and found["no.pdf"] is None
    similar = store.similar_names(spark.createDataFrame([("P1", "ROP-X.docx"), ("P1", "x.doc"), ("P2", "rop-x"), ("P1", ".pdf")], "project_name string, document_name string"), store.list_raw_documents(files))
    assert sorted((r["document_name"], unicodedata.normalize("NFC", r["stored"])) for r in similar.collect()) == [("ROP-X.docx", "ROP-x.pdf"), ("x.doc", "IXP-informé.pdf"), ("x.doc", "ROP-x.pdf")]
    assert names(store.read_binary(spark, str(root)).where("file_size = 8")) and names(store.read_processed(spark, str(root))) == ["a.json"]


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x":1}\n\n{bad\n')
    (tmp_path / "b.jsonl").write_text('{"x":2}\n')
    assert names(store.read_jsonl(spark, str(tmp_path), "x int"), "x") == [1, 2]
    assert names(store.read_jsonl(spark, str(tmp_path), "x int", whole_file=True), "x") == [2]


def test_routing_edges(spark):
    cases = {"IXP-x.pdf": ["auditoria"], "rop-x.pdf": ["desembolsos", "productos"], "IFS-x.pdf": ["desembolsos", "productos"], "IXP_a-b.pdf": [], "IXPreport.pdf": ["auditoria"], "IVS-x.pdf": []}
    df = spark.createDataFrame([(k,) for k in cases], "document_name string")
    got = {k: [] for k in cases}
    for r in routing.route(df).collect():
        got[r["document_name"]].append(r["prompt_type"])
    assert {k: sorted(v) for k, v in got.items()} == cases


def test_layout_replay(spark):
    answer = {"content": "", "tables": [{"table_id": 0, "row_count": 2, "column_count": 2, "confidence": 0.5, "cells": [{"content": "a", "row_index": 0, "column_index": 0}, {"content": "b", "row_index": 0, "column_index": 1}, {"content": "c", "row_index": 1, "column_index": 1}]}], "images": [], "key_value_pairs": [{"key": "k", "value": "v", "confidence": 1.0}], "paragraphs": [{"confidence": 0.0}]}
    raw = spark.createDataFrame([("P", "a.pdf", b"1", 1), ("P", "b.pdf", b"2", 1)], "project_name string, document_name string, content binary, file_size long")
    got = {r["document_name"]: r for r in layout.analyze(raw, layout.Replay({"a.pdf": json.dumps(answer)})).collect()}
    assert got["a.pdf"]["content"] == "\n## Table 1\n\n| a | b |\n| --- | --- |\n|  | c |\n\n\n## Key-Value Pairs\n\n**k**: v\n\n" and got["a.pdf"]["confidence_score"] == 0.75
    assert got["b.pdf"]["processing_status"] == "error" and "KeyError" in got["b.pdf"]["error_message"]
    flat = spark.createDataFrame([([0.0, 0.0, 1.0, 1.0],), ([],), ([1.0],), (None,), ([1.0, 2.0, 3.0],)], "p array<double>")
    assert [r[0] and len(r[0]) for r in flat.select(layout.polygon_points(F.col("p"))).collect()] == [2, [], [], None, 1]
    assert flat.select(layout.polygon_points(F.col("p"), compat=True)).first()[0] == []


def test_pending_batches(spark):
    infos = spark.createDataFrame([("a", "P", 1, "x"), ("a", "P", 2, "y"), ("b", "Q", 1, "x"), ("c", "P", 1, "x")], "batch_id string, project_name string, created_at long, status string")
    status = spark.createDataFrame([("a", "in_progress"), ("b", "completed"), ("c", "completed")], "batch_id string, status string")
    markers = spark.createDataFrame([("c",)], "batch_id string")
    none = spark.createDataFrame([], "folderName string")
    got = {r["batch_id"]: r["is_orphaned"] for r in batches.pending(infos, status, markers, none).collect()}
    assert got == {"a": False, "b": True}
    assert {r["batch_id"] for r in batches.pending(infos, status, markers, none, compat=True).collect()} == {"b"}
    assert batches.wait(iter(["validating", "completed"]).__next__, sleep=lambda s: None) == "completed"


def test_results_errors_and_types(spark):
    lines = ['{"custom_id":"P1_IXP-a_prompt1","response":{"status_code":200,"body":{"choices":[{"message":{"content":"{}"}}]}}}', '{"custom_id":"x","response":null}', '{"custom_id":"P_y_prompt2","response":{"status_code":200,"body":{"choices":[]}}}', "{broken", ""]
    parsed = results.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(str(r["error"]) for r in parsed.collect()) == ["None", "no choices", "no response", "not JSON"]
    ids = spark.createDataFrame([("P1_IXP-a_prompt1",), ("P1_a_b_prompt3",), ("P1_x_prompt9",), ("nounderscore",), ("P1_ROP-productos_prompt3",)], "c string")
    got = [r["i"] for r in ids.select(results.parse_id("c").alias("i")).collect()]
    assert [(g and g["document_name"], g and g["prompt_type"]) for g in got] == [("IXP-a", "auditoria"), ("a_b", "desembolsos"), ("x", None), (None, None), ("ROP-productos", "desembolsos")]
    assert ids.select(results.prompt_type("c", compat=True)).collect()[4][0] == "productos"


def test_sinks(spark, tmp_path):
    state = spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int")
    assert sorted(map(tuple, sinks.upsert(state, spark.createDataFrame([("a", 2)], "id string, v int"), "id", "v").collect())) == [("a", 2), ("b", 1)]
    sinks.write_records(spark.createDataFrame([("P", None, 1)], "project_name string, x string, y int"), str(tmp_path / "o"))
    assert spark.read.text(str(tmp_path / "o")).first()["value"] == '{"x":null,"y":1}'
    good, bad = validate(spark.createDataFrame([("f", 1, None)], "filename string, file_size int, processing_status string"), error=__import__("folioflow.schemas", fromlist=["x"]).metadata_error)
    assert good.count() == 0 and bad.first()["reason"] == "missing field processing_status"


def test_streams_dont_depend_on_micro_batches(spark, tmp_path):
    rows = [{"project_name": f"P{k % 3}", "queue_type": "processing", "operation_id": str(k)} for k in range(9)] + [{"queue_type": "x"}]
    tables = []
    for files in (1, 3):
        src = tmp_path / f"in{files}"
        src.mkdir()
        for k in range(files):
            (src / f"{k}.json").write_text("\n".join(json.dumps(r) for r in rows[k::files]))
        out = str(tmp_path / f"out{files}")
        for run in range(2):  # the second run finds a repeated message
            (src / f"again{run}.json").write_text(json.dumps(rows[0]))
            q = flows.each_once(flows.messages(spark, str(src), 1), ["operation_id"], out, str(tmp_path / f"cp{files}"))
            q.awaitTermination()
        tables.append(sorted(r["operation_id"] for r in Epochs(spark, out).read("rows", "operation_id string").collect()))
    assert tables[0] == tables[1] == sorted(str(k) for k in range(9))


def test_lifecycle_moves_forward_only(spark, tmp_path):
    src, out = str(tmp_path / "s"), str(tmp_path / "o")
    spark.createDataFrame([("a", "validating", 1), ("a", "in_progress", 2), ("a", "validating", 3), ("a", "completed", 4), ("b", "validating", 1)], "batch_id string, status string, t int").select("batch_id", "status", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("batch_id string, status string, ts timestamp").parquet(src)
    q = flows.lifecycle(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out)
    q.awaitTermination()
    got = sorted((r["batch_id"], r["status"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", "completed"), ("a", "in_progress"), ("a", "validating"), ("b", "validating")]


def test_pipeline_and_sql_names(spark):
    p = Pipeline(spark, EngineConfig(max_tokens=5, overlap_tokens=1))
    raw = spark.createDataFrame([("P", "IXP-a.pdf", b"1", 1), ("P", "IVS-b.pdf", b"2", 1)], "project_name string, document_name string, content binary, file_size long")
    none = raw.limit(0).select("project_name", "document_name", F.lit("").alias("content"), F.lit("success").alias("processing_status"))
    cuts = raw.limit(0).select("project_name", "document_name", F.lit(0).alias("chunk_index"), F.col("document_name").alias("original_document"), F.lit("").alias("content"))
    layouts = p.ingest(raw, layout.Replay({"IXP-a.pdf": json.dumps({"content": "a b c d e f g h"})}), none, cuts)
    chunks = p.chunk(layouts)
    assert chunks.count() == 2 and names(p.requests(layouts, chunks), "custom_id") == ["P_IXP-a_chunk_000_prompt1", "P_IXP-a_chunk_001_prompt1"]
    register(spark)
    assert spark.sql("SELECT count(*) FROM chunk_table('a b c d e f', 4, 0)").first()[0] == 2
    assert spark.sql("""SELECT recover_json_objects('{"a":1} {"b":2}')""").first()[0] == ['{"a":1}', '{"b":2}']
