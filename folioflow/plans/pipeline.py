"""The engine's entry points, and names for SQL users."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import EngineConfig
from ..functions import names, recovery, tokens
from ..operators import batches, chunking, layout, ledger, projects, results, routing
from ..sources import store
from ..sources.epochs import Epochs
from ..sources.staging import staged
from ..streaming import flows
from ..streaming import service as flows_of_service


@dataclass
class Pipeline:
    """Raw documents to requests, and responses to results. Every step is a DataFrame; only submit and the streams write."""

    spark: SparkSession
    cfg: EngineConfig = field(default_factory=EngineConfig)

    def select_documents(self, raw: DataFrame) -> DataFrame:
        return raw.where(routing.has_required_prefix("document_name", self.cfg.prefixes))

    def ingest(self, raw: DataFrame, provider: layout.Provider, layouts: DataFrame, chunks: DataFrame) -> DataFrame:
        """Layouts of the documents that are new."""
        new = layout.pending(self.select_documents(raw), layouts, chunks).where("status is null").drop("status")
        return layout.analyze(new, provider)

    def chunk(self, layouts: DataFrame) -> DataFrame:
        """Stored chunks of the documents over the budget."""
        done = chunking.chunk(layouts.where("processing_status = 'success'"), self.cfg)
        return chunking.stored_chunks(done.where("requires_chunking"))

    def requests(self, layouts: DataFrame, chunks: DataFrame) -> DataFrame:
        return routing.requests(routing.inputs(layouts, chunks), self.cfg)

    def results(self, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Parsed lines and their flattened items."""
        parsed = results.parse_lines(lines)
        return parsed, results.flatten_disbursements(results.objects(parsed, self.cfg.compat))

    def tick(self, infos: DataFrame, status: DataFrame, markers: DataFrame, state: DataFrame | None = None) -> DataFrame:
        """Batches to look at now."""
        folders = None if state is None else store.pending_folders(state)
        return batches.pending(infos, status, markers, folders, self.cfg.compat)

    def submit(self, layouts: DataFrame, chunks: DataFrame, service: batches.Service, path: str) -> DataFrame:
        """Writes and submits the requests of all projects; a row per batch."""
        return batches.submit(self.requests(layouts, chunks), service, path)

    def submit_once(self, layouts: DataFrame, chunks: DataFrame, desk: ledger.Desk, path: str) -> DataFrame:
        """Submits the requests that the ledger below path doesn't hold yet; all confirmed shards."""
        return ledger.submit(self.requests(layouts, chunks), desk, path)

    def chunk_projects(self, layouts: DataFrame) -> DataFrame:
        """Chunks of the projects' concatenated texts."""
        return projects.chunk_projects(layout.corpus(layouts), self.cfg)

    def process(self, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Result lines (batch_id, value) to typed items and the statistics of every batch."""
        parsed, items = self.results(lines)
        return results.materialise(items), results.statistics(parsed, by=["batch_id"], compat=self.cfg.compat)

    def stream_ingest(self, queue: str, raw: DataFrame, provider: layout.Provider, out: str, trigger: dict | None = None, max_files: int = 6) -> StreamingQuery:
        """Takes in messages and writes what they ask for below out: the tables layouts, chunks, requests (text by project) and keys.

        raw: the raw documents of all projects; a micro-batch reads those of its messages. Each micro-batch is one
        published epoch (sources.epochs), so one that is repeated leaves nothing twice. Documents that earlier
        ones have written are not analysed again: their names stand in `keys`, dealt over buckets by project, of which
        a micro-batch reads its own projects' only, and no contents.
        """
        epochs = Epochs(self.spark, out)

        def work(messages: DataFrame, epoch: int) -> None:
            if epochs.done(epoch):
                return
            whole, single = (messages.where(routing.message_kind() == k) for k in ("whole", "single"))
            asked = raw.join(whole.select("project_name").distinct(), "project_name", "left_semi")
            asked = asked.unionByName(raw.join(single.select("project_name", "document_name").distinct(), ["project_name", "document_name"], "left_semi")).dropDuplicates(["project_name", "document_name"])
            layouts = staged(self.ingest(asked, provider, *self._done(epochs, messages)), "layouts")
            chunks = staged(self.chunk(layouts), "chunks")
            made = self.requests(layouts.where("processing_status = 'success'"), chunks)
            known = layouts.where("processing_status = 'success' and content <> ''").select("project_name", "document_name", F.lit("layout").alias("kind"))
            cut = chunks.where("chunk_index = 0").select("project_name", F.col("original_document").alias("document_name"), F.lit("chunks").alias("kind"))
            tables = {"layouts": layouts, "chunks": chunks, "requests": made.select("project_name", routing.request_line().alias("value")), "keys": known.unionByName(cut).withColumn("bucket", _bucket())}
            epochs.write(epoch, tables, {"requests": ["project_name"], "keys": ["bucket"]}, {"requests": "text"})

        stream = flows.messages(self.spark, queue, max_files)
        return stream.writeStream.foreachBatch(work).option("checkpointLocation", f"{out}/_checkpoint").trigger(**(trigger or {"availableNow": True})).start()

    def _done(self, epochs: Epochs, messages: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Documents that earlier micro-batches have laid out and cut, of the messages' projects."""
        buckets = [r[0] for r in messages.select(_bucket()).distinct().collect()]  # KEY_BUCKETS at most
        keys = epochs.read("keys", "project_name string, document_name string, kind string, bucket int").where(F.col("bucket").isin(buckets))
        layouts = keys.where("kind = 'layout'").select("project_name", "document_name", F.lit("kept").alias("content"), F.lit("success").alias("processing_status"))
        return layouts, keys.where("kind = 'chunks'").select("project_name", F.col("document_name").alias("original_document"), F.lit(0).alias("chunk_index"))

    def stream_results(self, lines: str, out: str, trigger: dict | None = None) -> StreamingQuery:
        """Takes in files of result lines, named {batch_id}.jsonl, and writes the tables items and statistics below out, each
        micro-batch as one published epoch."""
        epochs = Epochs(self.spark, out)

        def work(rows: DataFrame, epoch: int) -> None:
            items, statistics = self.process(rows)
            epochs.write(epoch, {"items": items, "statistics": statistics})

        name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.jsonl)?$", 1)
        stream = self.spark.readStream.text(lines).select(name.alias("batch_id"), "value")
        return stream.writeStream.foreachBatch(work).option("checkpointLocation", f"{out}/_checkpoint").trigger(**(trigger or {"availableNow": True})).start()

    def stream_service(self, service: str, argument: str, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Polls a batch service (package.module:Class) and writes what its ended batches have come to (streaming.service)."""
        return flows_of_service.tick(flows_of_service.moves(self.spark, service, argument), out, checkpoint, self.cfg, trigger)


#: Buckets of the keys of what is done.
KEY_BUCKETS = 64


def _bucket():
    return F.pmod(F.xxhash64("project_name"), F.lit(KEY_BUCKETS)).cast("int").alias("bucket")


def register(spark: SparkSession) -> None:
    """SQL names: recover_json_objects(text), extract_json(text), repair_json(text), count_tokens(text),
    normalize_name(text), and chunk_table(text, max_tokens, overlap). Those that need no Python are SQL functions."""
    from pyspark.sql.functions import udtf

    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION count_tokens(text STRING) RETURNS INT RETURN regexp_count(text, r'{tokens.TOKEN_PATTERN}')")
    quoted = "CASE WHEN (length(text) - length(replace(text, '\"', ''))) % 2 = 1 THEN concat(text, '\"') ELSE text END"
    bare = f"regexp_replace(regexp_replace({quoted}, r'\\s+$', ''), ',$', '')"
    close = " , ".join(f"repeat('{b}', greatest(0, (length({bare}) - length(replace({bare}, '{a}', ''))) - (length({bare}) - length(replace({bare}, '{b}', '')))))" for a, b in ("{}", "[]"))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION repair_json(text STRING) RETURNS STRING RETURN concat({bare}, {close})")
    spark.udf.register("normalize_name", names.nfc)
    spark.udf.register("recover_json_objects", recovery.recover_json_objects)
    spark.udf.register("extract_json", recovery.extract_json)

    @udtf(returnType="index int, content string, tokens int, sections_range string")
    class ChunkTable:
        def eval(self, text: str, max_tokens: int, overlap: int):
            for c in chunking.chunk_text(text or "", EngineConfig(max_tokens=max_tokens, overlap_tokens=overlap)):
                yield c["index"], c["content"], c["tokens"], c["sections_range"]

    spark.udtf.register("chunk_table", ChunkTable)


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Project documents derived from the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = F.array(*map(F.lit, ("IXP", "ROP", "INI", "DEC", "IFS", "IVS", "RAS")))
    i = F.col("doc_id")
    return docs.select(
        "doc_id", F.concat(F.lit("PRJ"), F.lpad((i % 10).cast("string"), 3, "0")).alias("project_name"),
        F.concat(F.get(names, (i % 7).cast("int")), F.lit("-"), i.cast("string"), F.lit(".pdf")).alias("document_name"), F.col("text").alias("content"),
        F.when(i % 11 == 0, "error").otherwise("success").alias("processing_status"), F.concat(F.lit("batch_"), (i % 5).cast("string")).alias("batch_id"),
        "lang", "source",
    )
