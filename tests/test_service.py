"""Published epochs, submission once each, the service's stream, state tables, and the fate of messages: with failures in between."""

import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folioflow.config import EngineConfig
from folioflow.functions.running import running_max
from folioflow.operators import ledger, routing
from folioflow.sources.epochs import Epochs
from folioflow.sources.state import StateTable
from folioflow.streaming import flows, intake, service


class Died(Exception):
    pass


def die(*_):
    raise Died


def test_epochs_are_seen_whole_or_not_at_all(spark, tmp_path):
    root, kind = str(tmp_path / "e"), "x long"
    rows = lambda *x: spark.createDataFrame([(k,) for k in x], kind)
    e = Epochs(spark, root)
    assert e.published() == [] and e.read("a", kind).count() == 0
    assert e.write(0, {"a": rows(1, 2), "b": rows(9)})
    with pytest.raises(Died):  # both tables are written, the manifest isn't
        Epochs(spark, root, die).write(1, {"a": rows(3), "b": rows(8)})
    assert e.published() == [0] and sorted(r[0] for r in e.read("a", kind).collect()) == [1, 2]
    assert e.write(1, {"a": rows(4), "b": rows(7)}) and not e.write(1, {"a": rows(5)})
    assert sorted(r[0] for r in e.read("a", kind).collect()) == [1, 2, 4] and [r[0] for r in e.read("b", kind, since=0).collect()] == [7]
    assert e.sweep(["a", "b"]) == 2 + 0 and sorted(r[0] for r in e.read("a", kind).collect()) == [1, 2, 4]
    e.compact()
    assert e.write(2, {"a": rows(6)}) and e.published() == [0, 1, 2] and not e.write(0, {"a": rows(1)})
    e.compact()
    assert len(list(Path(root, "_published").glob("*.json"))) == 1 and sorted(r[0] for r in e.read("a", kind).collect()) == [1, 2, 4, 6]


def desk(folder, most=10**9):
    """A service that remembers its batches in a folder and fails once it has `most`."""

    class Desk:
        def find(self, shard):
            at = Path(folder, shard)
            return json.loads(at.read_text()) if at.exists() else None

        def submit(self, shard, path, project):
            import time

            time.sleep(0.01)
            if len(list(Path(folder).iterdir())) >= most:
                raise ConnectionError("gone")
            n = sum(len(x.read_text().splitlines()) for x in Path(path.removeprefix("file:")).glob("part-*"))
            answer = {"batch_id": f"b-{shard[:6]}", "input_file_id": f"f-{shard[:6]}", "status": "validating", "n": n}
            with open(Path(folder, shard), "x") as f:  # a second submission of a shard would fail here
                f.write(json.dumps(answer))
            return answer

    return Desk()


def test_submission_goes_on_where_it_failed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(routing, "BATCH_REQUESTS", 5)
    rows = [(f"P{k % 3}", f"IXP-{k}.pdf", f"text {k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "project_name string, document_name string, content string")
    made = routing.requests(docs, EngineConfig())
    at, folder = str(tmp_path / "out"), tmp_path / "desk"
    folder.mkdir()
    n = ledger.shards(made).select("shard").distinct().count()
    assert n > 10 and ledger.shards(made.repartition(7)).select("shard").distinct().exceptAll(ledger.shards(made).select("shard").distinct()).count() == 0
    first = ledger.submit(made, desk(str(folder), 4), at, wave=3)
    done = len(list(folder.iterdir()))
    assert 4 <= done < n and first.count() == done  # tasks that run side by side may pass the limit together
    before = {p.name: p.read_text() for p in folder.iterdir()}
    second = ledger.submit(made, desk(str(folder)), at, wave=4)
    assert second.count() == n == len(list(folder.iterdir())) and all((folder / k).read_text() == v for k, v in before.items())
    assert sum(json.loads(p.read_text())["n"] for p in folder.iterdir()) == 60 == second.agg(F.sum("n_requests")).first()[0]
    # the last wave dies after the service has taken it, before the ledger is published: it is found again, not sent again
    manifests = sorted(Path(at, "ledger", "_published").glob("*.json"))
    manifests[-1].unlink()
    third = ledger.submit(made, desk(str(folder), 0), at)
    assert third.count() == n == len(list(folder.iterdir())) and third.where("found").count() >= 1
    assert ledger.submit(made, desk(str(folder), 0), at).count() == n
    infos = ledger.batch_infos(third, made, F.lit("2024-01-01")).collect()
    assert len(infos) == n and sum(len(x["documents_info"]) for x in infos) == 60
    assert infos[0].asDict().keys() == {"batch_id", "project_name", "input_file_id", "created_at", "status", "total_requests", "documents_info", "completion_window"}
    assert set(infos[0]["documents_info"][0].asDict()) == {"document_name", "document_type", "subfolder", "prefix", "prompts_applied", "processed_at"}


def answer(batch, k, content='{"a": 1}', code=200):
    return json.dumps({"custom_id": f"{batch}_IXP-{k}_prompt1", "response": {"status_code": code, "body": {"choices": [{"message": {"content": content}}], "usage": {}}}})


def folder_service(at):
    (at / "files").mkdir(parents=True)
    polls = [
        [{"batch_id": "b1", "project_name": "P", "status": "in_progress"}, {"batch_id": "b2", "project_name": "Q", "status": "completed", "output_file_id": "o2", "error_file_id": "e2"}],
        [{"batch_id": "b1", "project_name": "P", "status": "completed", "output_file_id": "o1"}, {"batch_id": "b2", "project_name": "Q", "status": "completed", "output_file_id": "o2", "error_file_id": "e2"}, {"batch_id": "b3", "project_name": "R", "status": "failed"}],
    ]
    (at / "batches.json").write_text(json.dumps(polls))
    (at / "files" / "o1").write_text("\n".join([answer("b1", 1), answer("b1", 2, "x", 500), "broken", "", answer("b1", 3, '[{"a": 2}, {"a": 3}]')]))
    (at / "files" / "o2").write_text(answer("b2", 1) + "\n")
    (at / "files" / "e2").write_text(json.dumps({"custom_id": "b2_IXP-9_prompt1", "error": {"message": "too long"}}) + "\n")
    return at


def tables(spark, out):
    e = Epochs(spark, out)
    return {n: sorted(map(str, e.read(n, s).drop("epoch").collect())) for n, s in (("items", service.ITEMS), ("errors", service.ERRORS), ("markers", service.MARKERS))}


def test_tick_from_submitted_to_markers(spark, tmp_path):
    """A service is polled twice; the second micro-batch dies before it is published, and the query is started anew."""
    found = {}
    for name, crash in (("plain", None), ("killed", lambda epoch: die() if epoch == 1 else None)):
        at = folder_service(tmp_path / name / "service")
        out, checkpoint = str(tmp_path / name / "out"), str(tmp_path / name / "checkpoint")

        def run(crash=None, at=at, out=out, checkpoint=checkpoint):
            service.tick(service.moves(spark, "folioflow.streaming.service:FolderService", str(at)), out, checkpoint, crash=crash).awaitTermination()

        run()
        got = tables(spark, out)
        assert len(got["markers"]) == 1 and "b2" in got["markers"][0] and len(got["items"]) == 1 and "too long" in got["errors"][0]
        (at / "poll").write_text("1")
        if crash:
            with pytest.raises(Exception, match="Died"):
                run(crash)
            assert tables(spark, out) == got  # nothing of the second epoch is seen
        run()
        run()
        found[name] = tables(spark, out)
    assert found["plain"] == found["killed"]
    markers = {m["batch_id"]: m for m in Epochs(spark, str(tmp_path / "plain" / "out")).read("markers", service.MARKERS).collect()}
    assert {k: (m["status"], m["total"], m["successful"], m["failed"]) for k, m in markers.items()} == {"b1": ("completed", 4, 2, 2), "b2": ("completed", 2, 1, 1), "b3": ("failed", 0, 0, 0)}
    assert len(found["plain"]["items"]) == 4 and len(found["plain"]["errors"]) == 3
    states = spark.createDataFrame([("b1", "completed"), ("b9", "completed"), ("b8", "in_progress")], "batch_id string, status string")
    assert [r[0] for r in service.pending(states, str(tmp_path / "plain" / "out")).collect()] == ["b9"]


def test_state_table(spark, tmp_path):
    t = StateTable(spark, str(tmp_path / "state"), "id string, v long, t long", "id", "t", buckets=8)
    r, plain = random.Random(5), {}
    rows = lambda x: spark.createDataFrame(x, "id string, v long, t long")
    assert t.read().count() == 0 and not t.exists("1")
    for step in range(5):
        changes = [(str(r.randrange(200)), r.randrange(10**6), r.randrange(10 * step, 10 * step + 25)) for _ in range(80)]
        changes = list({(a, c): (a, b, c) for a, b, c in changes}.values())
        t.upsert(rows([*changes, (None, 1, 1)]))
        for a, b, c in sorted(changes, key=lambda x: x[2]):
            if a not in plain or c >= plain[a][1]:
                plain[a] = (b, c)
        if step == 2:
            t.compact()
        assert {x["id"]: (x["v"], x["t"]) for x in t.read().collect()} == plain
    some = next(iter(plain))
    assert tuple(t.read_item(some).first()) == (some, *plain[some]) and t.exists(some) and not t.exists("nobody")
    files = set(t._parts().where((F.col("bucket") == t._bucket(F.lit(some))) & (F.col("id") == some)).select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    assert len(files) <= 3 and all(f"bucket={t.read_item(some).select(t._bucket(F.col('id'))).first()[0]}/" in f for f in files)  # a base and two deltas


def test_leases(spark):
    t0 = datetime(2024, 1, 1)
    rows = [("a", "sent", 0), ("a", "taken", 1), ("a", "done", 2), ("b", "taken", 1), ("c", "taken", 7), ("d", "taken", 8), ("d", "failed", 9), *[("e", "taken", k) for k in range(3)], ("f", "sent", 1)]
    h = spark.createDataFrame([(i, w, t0 + timedelta(minutes=m)) for i, w, m in rows], "message_id string, what string, ts timestamp")
    got = {x["message_id"]: (x["state"], x["attempts"]) for x in intake.leases(h, F.lit(t0 + timedelta(minutes=10)), "5 minutes", 3).collect()}
    assert got == {"a": ("done", 1), "b": ("visible", 1), "c": ("leased", 1), "d": ("visible", 1), "e": ("dead", 3), "f": ("visible", 0)}


def test_dead_letters(spark):
    lines = ['{"project_name": "P", "queue_type": "q"}', "", "  ", "{broken", "[1]", '{"queue_type": "q"}', '{"project_name": "P"}', '{"project_name": " ", "queue_type": "q"}', None]
    got = intake.dead_letters(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert sorted(x["cause"] for x in got) == sorted(["empty", "empty", "empty", "not JSON", "no object", "no project_name", "no queue_type", "no project_name"])


def test_broken_messages_become_dead_letters(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ['{"project_name": "P", "queue_type": "q"}', "{broken", '{"project_name": " ", "queue_type": "q"}', '{"queue_type": "q"}']
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    src = str(tmp_path / "in")
    flows.each_once(flows.messages(spark, src), ["project_name"], str(tmp_path / "m"), str(tmp_path / "cm")).awaitTermination()
    flows.each_once(flows.refused(spark, src), ["value"], str(tmp_path / "d"), str(tmp_path / "cd")).awaitTermination()
    assert [r[0] for r in Epochs(spark, str(tmp_path / "m")).read("rows", "project_name string").collect()] == ["P"]
    dead = {r["value"]: r["cause"] for r in Epochs(spark, str(tmp_path / "d")).read("rows", "value string, cause string").collect()}
    assert dead == {lines[1]: "not JSON", lines[2]: "no project_name", lines[3]: "no project_name"}


@pytest.mark.parametrize("burst", [1, 3])
def test_pacing(spark, burst):
    """Against a bucket that is emptied and filled message by message."""
    r, gap = random.Random(burst), 2.5
    rows = [(k, "ab"[r.random() < 0.2], datetime(2024, 1, 1) + timedelta(seconds=r.randrange(600))) for k in range(300)]
    df = spark.createDataFrame(rows, "message_id long, key string, ts timestamp").repartition(5)
    got = {x["message_id"]: x["released"] for x in intake.paced(df, ["key"], gap, burst).collect()}
    for key in "ab":
        tokens, last = float(burst), None
        for i, _, ts in sorted((x for x in rows if x[1] == key), key=lambda x: (x[2], x[0])):
            t = ts.timestamp()
            at = t if last is None else max(t, last)
            if last is not None:
                tokens = min(burst, tokens + (at - last) / gap)
            if tokens < 1:
                at, tokens = at + (1 - tokens) * gap, 1.0
            tokens, last = tokens - 1, at
            assert abs(got[i].timestamp() - at) < 1e-3


def test_running_max(spark):
    rows = [(None if i % 5 == 0 else "k", i, (i * 7919) % 101) for i in range(300)]
    for x in running_max(spark.createDataFrame(rows, "k string, i long, v long").repartition(4), ["k"], ["i"], "v").collect():
        assert x["before_v"] == max((v for k, i, v in rows if k == x["k"] and i < x["i"]), default=None)
