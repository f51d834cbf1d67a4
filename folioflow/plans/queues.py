"""More of the query catalogue: messages and keyed state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources.staging import shared_folder
from ..sources.state import StateTable
from ..streaming import intake
from .catalog import _table, query

_GAP, _BURST = 1_800, 3


@query(f"""WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT event_id, user_id, i, t AS released, t + {_GAP * 1_000_000} AS owed FROM e WHERE i = 1
 UNION ALL SELECT e.event_id, e.user_id, e.i, greatest(e.t, r.owed - {(_BURST - 1) * _GAP * 1_000_000}), greatest(e.t, r.owed) + {_GAP * 1_000_000} FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1)
SELECT event_id, user_id, CAST(released AS BIGINT) AS released_us FROM r""")
def paced_release(spark, sf_dir):
    """When a token bucket per user lets each event go."""
    made = intake.paced(_table(spark, sf_dir, "events"), ["user_id"], _GAP, _BURST, tie="event_id")
    return made.select("event_id", "user_id", F.unix_micros("released").alias("released_us"))


@query("""WITH h AS (SELECT user_id, ts, CASE event_type WHEN 'click' THEN 'taken' WHEN 'error' THEN 'failed' WHEN 'purchase' THEN CASE WHEN event_id % 50 = 0 THEN 'done' ELSE 'sent' END ELSE 'sent' END AS what FROM events), n AS (SELECT max(ts) AS now FROM events),
g AS (SELECT user_id, count(*) FILTER (WHERE what = 'taken') AS attempts, max(ts) FILTER (WHERE what = 'taken') AS taken, max(ts) FILTER (WHERE what = 'failed') AS failed, bool_or(what = 'done') AS is_done FROM h GROUP BY user_id)
SELECT user_id, attempts, CASE WHEN is_done THEN 'done' WHEN taken + INTERVAL 12 HOUR > now AND (failed IS NULL OR failed < taken) THEN 'leased' WHEN attempts >= 20 THEN 'dead' ELSE 'visible' END AS state FROM g, n""")
def message_leases(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    kind = F.col("event_type")
    what = F.when(kind == "click", "taken").when(kind == "error", "failed").when((kind == "purchase") & (F.col("event_id") % 50 == 0), "done").otherwise("sent")
    now = e.agg(F.max("ts")).first()[0]
    return intake.leases(e.select("user_id", what.alias("what"), "ts"), F.lit(now), "12 hours", 20, "user_id").select("user_id", "attempts", "state")


@query("""SELECT CASE doc_id % 7 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'no project_name' WHEN 3 THEN 'no queue_type' WHEN 4 THEN 'no object' WHEN 5 THEN 'empty' WHEN 6 THEN 'no queue_type' END AS cause, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents WHERE doc_id % 7 <> 0 GROUP BY ALL""")
def dead_letter_causes(spark, sf_dir):
    p, i = F.concat(F.lit('"project_name":"P'), F.col("doc_id").cast("string"), F.lit('"')), F.col("doc_id") % 7
    q = F.lit('"queue_type":"processing"')
    line = F.when(i == 0, F.concat(F.lit("{"), p, F.lit(","), q, F.lit("}"))).when(i == 1, F.concat(F.lit("{"), p)).when(i == 2, F.concat(F.lit("{"), q, F.lit("}"))).when(i == 3, F.concat(F.lit("{"), p, F.lit("}")))
    line = line.when(i == 4, F.concat(F.lit("[{"), p, F.lit("}]"))).when(i == 5, " ").otherwise(F.concat(F.lit("{"), p, F.lit(',"queue_type":" "}')))
    dead = intake.dead_letters(_table(spark, sf_dir, "documents").select("doc_id", line.alias("value")))
    return dead.groupBy("cause").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query("""WITH a AS (SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderkey AS v, epoch(CAST(o_orderdate AS TIMESTAMP)) * 100000 + o_orderkey AS t FROM orders UNION ALL SELECT CAST(c_custkey AS VARCHAR), -1, 0 FROM customer)
SELECT id, arg_max(v, t) AS v, CAST(max(t) AS BIGINT) AS t FROM a GROUP BY id""")
def state_of_deltas(spark, sf_dir):
    """State of all customers by their last orders: a base, a compacted delta and three more."""
    table = StateTable(spark, f"{shared_folder(spark)}/state-{uuid.uuid4().hex}", "id string, v long, t long", "id", "t", buckets=8)
    o = _table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderkey").cast("long").alias("v"), (F.unix_seconds(F.col("o_orderdate").cast("timestamp")) * 100_000 + F.col("o_orderkey")).cast("long").alias("t"))
    table.upsert(_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.lit(-1).cast("long").alias("v"), F.lit(0).cast("long").alias("t")))
    for k in range(4):
        table.upsert(rows.where(F.pmod("v", F.lit(4)) == k))
        if k == 0:
            table.compact()
    return table.read()
