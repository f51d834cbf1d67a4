"""Submission, status, streams from end to end, files, the log, and SQL names."""

import json

import pytest
from pyspark.sql import functions as F

from folioflow import log
from folioflow.config import EngineConfig
from folioflow.functions import recovery
from folioflow.operators import batches, chunking, layout, results, routing, rules
from folioflow.operators.chunking import Packer
from folioflow.plans.pipeline import Pipeline, register
from folioflow.sources import sinks, store
from folioflow.streaming import flows


def desk():
    """A batch service that takes everything; a class of this module would not be found by the workers."""

    class Desk:
        def submit(self, path, project, part):
            return f"{project}-{part}"

        def status(self, batch_id):
            if batch_id.startswith("Q"):
                raise ConnectionError("gone")
            return {"status": "completed", "output_file_id": "o", "request_counts": {"total": 3, "completed": 2}}

    return Desk()


def layouts(spark, n=4):
    rows = [("P" if k % 2 else "Q", f"IXP-{k}.pdf", f"text {k}", "success") for k in range(n)]
    return spark.createDataFrame(rows, "project_name string, document_name string, content string, processing_status string")


def test_submit_and_status(spark, tmp_path, monkeypatch):
    made = routing.requests(layouts(spark, 40), EngineConfig())
    for limit, least in ((50_000, 1), (6, 4)):
        monkeypatch.setattr(routing, "BATCH_REQUESTS", limit)
        infos = batches.submit(made, desk(), str(tmp_path / str(limit)), F.lit("2024-01-01"))
        rows = infos.collect()
        assert sum(r["n_requests"] for r in rows) == 40 and {r["project_name"] for r in rows} == {"P", "Q"} and len(rows) >= 2 * least
        assert {r["n_documents"] for r in rows} == {20} and {r["completion_window"] for r in rows} == {"24h"}
        assert spark.read.text(str(tmp_path / str(limit) / "requests")).count() == 40
    assert {(r["id"], r["isBatchPending"]) for r in batches.pending_changes(infos).collect()} == {("P", True), ("Q", True)}
    got = {r["batch_id"][0]: r for r in batches.status(infos, desk()).collect()}
    assert (got["P"]["status"], got["P"]["total"], got["P"]["completed"], got["P"]["failed"]) == ("completed", 3, 2, 0)
    assert got["Q"]["status"] == "error" and "ConnectionError" in got["Q"]["message"]


def test_streams_from_messages_to_items(spark, tmp_path):
    raw = spark.createDataFrame([("P", "IXP-a.pdf", b"1", 1), ("P", "ROP-b.pdf", b"2", 1), ("Q", "INI-c.pdf", b"3", 1), ("R", "INI-d.pdf", b"4", 1)], "project_name string, document_name string, content binary, file_size long")
    answers = {n: json.dumps({"content": f"{n} one two three four five six"}) for n in ("IXP-a.pdf", "ROP-b.pdf", "INI-c.pdf", "INI-d.pdf")}
    p = Pipeline(spark, EngineConfig(max_tokens=5, overlap_tokens=0))
    queue, out = tmp_path / "queue", str(tmp_path / "out")
    queue.mkdir()
    for k, messages in enumerate(([{"project_name": "P", "queue_type": "processing"}], [{"project_name": "Q", "queue_type": "processing", "document_name": "INI-c.pdf"}, {"project_name": "P", "queue_type": "processing"}, {"queue_type": "x"}])):
        (queue / f"{k}.json").write_text("\n".join(map(json.dumps, messages)))
        p.stream_ingest(str(queue), raw, layout.Replay(answers), out).awaitTermination()
    done = spark.read.parquet(f"{out}/layouts")
    assert sorted(r["document_name"] for r in done.collect()) == ["INI-c.pdf", "IXP-a.pdf", "ROP-b.pdf"]  # each once, and R was not asked for
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{out}/requests").collect()]
    assert {x["custom_id"].rsplit("_prompt", 1)[0].rsplit("_chunk", 1)[0] for x in lines} == {"P_IXP-a", "P_ROP-b", "Q_INI-c"}
    responses, items = tmp_path / "responses", str(tmp_path / "items")
    responses.mkdir()
    body = [{"custom_id": x["custom_id"], "response": {"status_code": 200, "body": {"choices": [{"message": {"content": json.dumps({"n": k, "ok": True})}}]}}} for k, x in enumerate(lines)]
    (responses / "batch_7.jsonl").write_text("\n".join([*map(json.dumps, body), "{broken"]))
    for _ in range(2):  # a second run finds nothing new
        p.stream_results(str(responses), items).awaitTermination()
    got = spark.read.parquet(f"{items}/items").collect()
    assert len(got) == len(lines) and {r["batch_id"] for r in got} == {"batch_7"} and {json.loads(r["object"])["ok"] for r in got} == {True}
    s = spark.read.parquet(f"{items}/statistics").first()
    assert (s["total"], s["failed"]) == (len(lines) + 1, 1)


def test_queue_helpers(spark, tmp_path):
    path = str(tmp_path / "q")
    projects = spark.createDataFrame([("B",), ("A",), ("A",)], "project_name string")
    assert flows.send(flows.project_messages(projects), path, dry_run=True).count() == 2 and not (tmp_path / "q").exists()
    assert [r["project_name"] for r in flows.send(flows.project_messages(projects), path, limit=1).collect()] == ["A"]
    info = flows.queue_info(spark, path).first()
    assert (info["messages"], info["rejected"]) == (1, 0) and flows.peek(spark, path, 1).first()["project_name"] == "A"
    assert flows.paced() == {"processingTime": "420 seconds"}


def test_recovery_in_the_jvm_equals_python(spark):
    texts = ['{"b":1,"a":"x\\"}"}', ' [ {"a":[1,{"c":null}]} , {"b":2.5} ] ', '[{"a":1},[{"b":2}]]', "[1,2]", '{"a":1,"a":2}', '```json\n{"a":1}\n```', '{"a":1}{"b":2}', "text", "", None, "[]", "{}", '[{"a":1},null]', '"{}"', '{"é":"ü\\n"}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["found"] for r in recovery.recovered(df, "t", "found").collect()}
    for i, t in enumerate(texts):
        assert [json.loads(x) for x in got[i]] == recovery.objects(t), t


def test_typed_rows_keep_their_types(spark):
    value = {"desembolsos": {"proyectados": [{"monto": 5, "ok": True, "campo": {"value": 1, "evidence": None}, "origen": "own"}], "realizados": [{"monto": None}]}, "metadata": {"origen": "meta", "n": [1]}}
    df = spark.createDataFrame([(json.dumps(value),), ('{"a":1}',), ("text",), ('{"desembolsos":[1]}',), ('{"desembolsos":{}}',)], "object string")
    got = [json.loads(r["object"]) if r["object"] != "text" else "text" for r in results.flatten_disbursements(df).collect()]
    assert got == [{"monto": 5, "ok": True, "campo": {"value": 1, "evidence": None}, "origen": "own", "n": [1], "tipo_registro_norm": "proyectado"}, {"monto": None, "origen": "meta", "n": [1], "tipo_registro_norm": "realizado"}, {"a": 1}, "text", {"desembolsos": [1]}]


def test_default_records(spark):
    df = spark.createDataFrame([("x" * 300, t) for t in (*results.TYPES, None)], "object string, prompt_type string")
    got = [json.loads(r["object"]) for r in results.materialise(df, stamp=F.lit("2024-05-06 07:08:09").cast("timestamp")).collect()]
    for kind, record in zip((*results.TYPES, "auditoria"), got, strict=True):
        fields = dict(results.RECORD_FIELDS[kind])
        assert list(record) == [*fields, "_parse_error", "_original_content_preview"] and record["_original_content_preview"] == "x" * 200
        assert record["codigo_CFA"] == {"value": None, "confidence": "NO_EXTRAIDO", "evidence": None} and record["fecha_extraccion"] == "2024-05-06 07:08"
    assert got[0]["texto_justificacion"] == {"quote": None} and got[0]["status_auditoria_SSC"] == "Pendiente"


def test_error_lines(spark):
    assert results.error_lines(spark.createDataFrame([("{}",), (" ",), ("x",)], "value string")).first()[0] == 2


def test_written_files(spark, tmp_path):
    docs = layouts(spark, 6)
    sinks.write_corpus(layout.corpus(docs), str(tmp_path / "corpus"))
    for project in "PQ":
        text = "".join(f.read_text() for f in sorted((tmp_path / "corpus" / f"project_name={project}").glob("part-*.txt")))
        names = [f"IXP-{k}.pdf" for k in range(6) if (k % 2 == 1) == (project == "P")]
        parts = "".join(f"\n\n--- DOCUMENT: {n} ---\n\ntext {n[4]}\n\n{'-' * 50}\n\n" for n in names)
        assert text == f"\n\n{'=' * 80}\n\nPROJECT: {project}\nPROCESSED DOCUMENTS: 3/3\nSKIPPED DOCUMENTS: 0\nPROCESSOR: Azure Document Intelligence\n{'=' * 80}\n\n{parts}"
    sinks.write_raw(spark.createDataFrame([("P", "a.pdf", b"x")], "project_name string, document_name string, content binary"), str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).first()["content_type"] == "application/pdf"
    sinks.write_files(layout.processed_files(docs), str(tmp_path / "files"))
    assert spark.read.text(str(tmp_path / "files")).count() == 8


def test_download(spark, tmp_path):
    at = tmp_path / "base" / "P" / "raw"
    at.mkdir(parents=True)
    (at / "IXP-informe\u0301.pdf").write_bytes(b"abc")
    wanted = spark.createDataFrame([("P", "IXP-inform\u00e9.pdf"), ("P", "none.pdf")], "project_name string, document_name string")
    got = {r["document_name"]: r["content"] for r in store.download(spark, str(tmp_path / "base"), wanted).collect()}
    assert bytes(got["IXP-inform\u00e9.pdf"]) == b"abc" and got["none.pdf"] is None


def test_log(spark, tmp_path):
    file = str(tmp_path / "a.log")
    with pytest.raises(KeyError), log.OperationLog("ingest", log.logger("folioflow.test", file)) as op:
        op.document("a.pdf", "layout", "success", pages=3)
        op.batch("b1", "completed")
        op.metric("tokens", 7)
        raise KeyError("x")
    events = [json.loads(line) for line in open(file)]
    assert [e["message"] for e in events] == ["operation started", "document", "batch", "metric", "'x'", "operation ended"]
    assert {e["operation_id"] for e in events} == {op.id} and events[-1]["success"] == "False" and events[4]["error_code"] == "KeyError"
    rows = op.rows(spark).collect()
    assert len(rows) == 6 and rows[1]["custom_fields"]["pages"] == "3" and log.operation_id() != log.operation_id()
    df, seen = log.observed(spark.range(5), "n", F.count("*").alias("rows"))
    df.collect()
    assert seen.get == {"rows": 5}


def test_sql_names(spark):
    register(spark)
    got = spark.sql("""SELECT count_tokens('uno dos, tres'), repair_json('{"a":[1,{"b":"c'), normalize_name('e\u0301')""").first()
    assert tuple(got) == (4, '{"a":[1,{"b":"c"}}]', "\u00e9")
    for text in ('{"a":1,', '{"a":[1,2', "plain", '{"a":"b"} '):
        assert spark.createDataFrame([(text,)], "t string").selectExpr("repair_json(t)").first()[0] == recovery.repair(text)


def test_packing_time_is_linear_and_seams_are_counted():
    parts = [f"word{k} and more." for k in range(3000)]
    out = Packer(100_000, 0).pack(parts)
    assert len(out) == 1 and out[0]["tokens"] == 12_000
    tokenizers = pytest.importorskip("public_tokenizers")
    for file in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        p = Packer(60, 8, file=tokenizers.path(file))
        texts = ["one, two!", "(three)", "four\u00e9 five...", "6 7 8", '"nine"'] * 30
        assert all(c["tokens"] == p.count(c["content"]) <= 60 for c in p.pack(texts))


def test_rules_of_keys_and_dollars(spark):
    df = spark.createDataFrame([("US$ 1,000.50",), ("1.000,50 usd",), ("Bs 5",), ("U$S 7",), (None,)], "t string")
    assert [None if r[0] is None else float(r[0]) for r in df.select(rules.usd_amount("t")).collect()] == [1000.5, 1000.5, None, 7.0, None]
    rows = spark.createDataFrame([("2024-01", "USD", "x", "DEC", 9), ("2024-01", "USD", "x", "ROP", 1), ("2024-01", "USD", "x", "ROP", None), ("2024-01", "USD", "y", "other", 3)], "period string, currency string, record_type string, source string, revised int")
    kept = rules.dedup_disbursements(rows)
    assert kept.columns == rows.columns and {tuple(r)[2:] for r in kept.collect()} == {("x", "ROP", 1), ("y", "other", 3)}
    assert rules.repeated_keys(rows, ("period", "currency", "record_type")).count() == 1 and rules.repeated_keys(kept, ("period", "currency", "record_type")).count() == 0


def test_project_settings_and_windows(spark):
    assert (EngineConfig().overlap_tokens, EngineConfig.project().overlap_tokens, EngineConfig.project(overlap_tokens=3).overlap_tokens) == (512, 500, 3)
    df = spark.createDataFrame([("abcdefg",), ("",), (None,), ("abc",)], "t string")
    assert [r[0] for r in df.select(chunking.fixed_windows("t", 3)).collect()] == [["abc", "def", "g"], [], [], ["abc"]]
