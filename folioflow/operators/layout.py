"""Layout of documents: provider calls, markdown, confidences and roll-ups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LAYOUT, RAW_LAYOUT

# What stands in a project's banner and between markdown's parts.
BANNER, PROCESSOR = "=" * 80, "Azure Document Intelligence"
TABLE_HEADING, PAIRS_HEADING = "\n## Table {}\n\n", "\n## Key-Value Pairs\n\n"

#: A provider turns (name, bytes) into JSON of the layout structure, or raises.
Provider = Callable[[str, bytes], str]


class Replay:
    """Stored answers by document name, for tests and repeatable runs."""

    def __init__(self, answers: dict[str, str]):
        self.answers = answers

    def __call__(self, name: str, content: bytes) -> str:
        return self.answers[name]


def analyze(raw: DataFrame, provider: Provider) -> DataFrame:
    """Layout and status of each raw document; a provider's error is that document's status."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            answers, errors = [], []
            for name, content in zip(rows["document_name"], rows["content"], strict=True):
                try:
                    answers.append(provider(name, content))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 the provider's failure is data
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield rows[["project_name", "document_name", "file_size"]].assign(answer=answers, error_message=errors)

    got = raw.select("project_name", "document_name", "content", "file_size").mapInPandas(call, "project_name string, document_name string, file_size long, answer string, error_message string")
    return got.select("project_name", "document_name", "file_size", structured("answer").alias("json_data"), "error_message").withColumns({
        "content": F.coalesce(F.when(F.col("json_data.content") != "", F.col("json_data.content")), markdown("json_data"), F.lit("")),
        "confidence_score": average_confidence("json_data"),
        "processing_status": F.when(F.col("error_message").isNull(), "success").otherwise("error"),
    })


def average_confidence(layout: str) -> Column:
    """Mean of the positive confidences of tables, paragraphs and key-value pairs; null without any."""
    parts = [F.coalesce(F.transform(f"{layout}.{k}", lambda x: x["confidence"]), F.array().cast("array<double>")) for k in ("tables", "paragraphs", "key_value_pairs")]
    good = F.filter(F.concat(*parts), lambda x: x > 0)
    total = F.aggregate(good, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(good) > 0, total / F.size(good))


def table_markdown(table: Column) -> Column:
    """Rows of cells between bars; columns run to the table's last one; a rule follows row 0 only; of cells in one
    place the last counts. Cells are sorted by place once, and each is written after as many bars as there are columns
    between it and the one before, so the work follows the cells."""
    cells = F.coalesce(table["cells"], F.array())
    width = F.array_max(F.transform(cells, lambda c: c["column_index"])) + 1
    entries = F.array_sort(F.transform(cells, lambda c, i: F.struct(c["row_index"].alias("row"), c["column_index"].alias("column"), i.alias("i"), F.coalesce(c["content"], F.lit("")).alias("content"))))
    placed = F.filter(entries, lambda e, i: ~F.coalesce((F.get(entries, i + 1)["row"] == e["row"]) & (F.get(entries, i + 1)["column"] == e["column"]), F.lit(False)))
    rule = F.concat(F.lit("\n|"), F.repeat(F.lit(" --- |"), width))

    def ending(e: Column) -> Column:
        return F.concat(F.repeat(F.lit(" | "), width - 1 - e["column"]), F.lit(" |"), F.when(e["row"] == 0, rule).otherwise(""))

    def cell(e: Column, i: Column) -> Column:
        before = F.get(placed, i - 1)
        first = F.concat(F.lit("| "), F.repeat(F.lit(" | "), e["column"]))
        lead = F.when(i == 0, first).when(before["row"] == e["row"], F.repeat(F.lit(" | "), e["column"] - before["column"])).otherwise(F.concat(ending(before), F.lit("\n"), first))
        return F.concat(lead, e["content"])

    return F.when(F.size(cells) > 0, F.concat(F.array_join(F.transform(placed, cell), ""), ending(F.element_at(placed, -1)))).otherwise("")


def key_value_markdown(pairs: Column) -> Column:
    """A line and a blank line per pair."""
    return F.array_join(F.transform(pairs, lambda p: F.concat(F.lit("**"), F.coalesce(p["key"], F.lit("")), F.lit("**: "), F.coalesce(p["value"], F.lit("")), F.lit("\n\n"))), "")


def markdown(layout: str) -> Column:
    """Text, tables and key-value pairs under their headings."""
    content, tables, pairs = (F.col(f"{layout}.{k}") for k in ("content", "tables", "key_value_pairs"))

    def table(t: Column, i: Column) -> Column:
        heading = F.replace(F.lit(TABLE_HEADING), F.lit("{}"), (i + 1).cast("string"))
        rows = table_markdown(t)
        return F.concat(heading, F.when(rows != "", F.concat(rows, F.lit("\n"))).otherwise(""), F.lit("\n"))

    body = F.when(content != "", F.concat(content, F.lit("\n\n"))).otherwise("")
    listed = F.array_join(F.transform(F.coalesce(tables, F.array()), table), "")
    about = F.when(F.size(F.coalesce(pairs, F.array())) > 0, F.concat(F.lit(PAIRS_HEADING), key_value_markdown(pairs))).otherwise("")
    return F.concat(F.coalesce(body, F.lit("")), listed, about)


def polygon_points(flat: Column, compat: bool = False) -> Column:
    """[x0, y0, x1, y1, ...] as points; compat skips bare numbers, so nothing is left."""
    none = F.array().cast("array<struct<x:double,y:double>>")
    if compat:
        return none
    points = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size(flat) / 2) - 1, F.lit(0))), lambda k: F.struct(F.get(flat, 2 * k).cast("double").alias("x"), F.get(flat, 2 * k + 1).cast("double").alias("y")))
    return F.when(flat.isNotNull(), F.when(F.size(flat) >= 2, points).otherwise(none))


def polygon(raw: Column, compat: bool = False) -> Column:
    """Points of a polygon whose elements are JSON texts: objects with x and y, or arrays of two and more; bare
    numbers are taken in pairs. Other elements are skipped."""
    bare = F.filter(F.transform(raw, lambda e: e.try_cast("double")), lambda e: e.isNotNull())

    def point(e: Column) -> Column:
        x, y = (F.coalesce(F.get_json_object(e, f"$.{name}"), F.get_json_object(e, f"$[{k}]")).try_cast("double") for k, name in enumerate("xy"))
        return F.struct(x.alias("x"), y.alias("y"))

    made = F.filter(F.transform(raw, point), lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    return F.when(raw.isNull(), F.array().cast("array<struct<x:double,y:double>>")).when(F.size(bare) > 0, polygon_points(bare, compat)).otherwise(made)


def _text(c: Column) -> Column:
    """Text of an element that is a text or an object with a content."""
    return F.coalesce(F.when(F.startswith(F.ltrim(c), F.lit("{")), F.coalesce(F.get_json_object(c, "$.content"), F.lit(""))), c, F.lit(""))


def structured(answer: Column | str, compat: bool = False) -> Column:
    """A provider's JSON answer as the layout structure: parts numbered in their order, spans of 1 and empty
    captions, keys and values where none are given, polygons as points."""
    raw = F.from_json(answer, RAW_LAYOUT)

    def each(name: str, make) -> Column:
        return F.coalesce(F.transform(raw[name], make), F.array())

    def cell(c: Column) -> Column:
        return F.struct(c["content"].alias("content"), c["row_index"].alias("row_index"), c["column_index"].alias("column_index"), F.coalesce(c["row_span"], F.lit(1)).alias("row_span"), F.coalesce(c["column_span"], F.lit(1)).alias("column_span"), c["confidence"].alias("confidence"), c["kind"].alias("kind"))

    def region(r: Column) -> Column:
        return F.struct(r["page_number"].alias("page_number"), polygon(r["polygon"], compat).alias("polygon"))

    tables = each("tables", lambda t, i: F.struct(i.alias("table_id"), t["row_count"].alias("row_count"), t["column_count"].alias("column_count"), t["confidence"].alias("confidence"), F.coalesce(F.transform(t["cells"], cell), F.array()).alias("cells")))
    figures = F.coalesce(raw["figures"], raw["images"], F.array())
    images = F.transform(figures, lambda f, i: F.struct(i.alias("figure_id"), _text(f["caption"]).alias("caption"), f["confidence"].alias("confidence"), F.coalesce(F.transform(f["bounding_regions"], region), F.array()).alias("bounding_regions")))
    pairs = each("key_value_pairs", lambda p: F.struct(_text(p["key"]).alias("key"), _text(p["value"]).alias("value"), p["confidence"].alias("confidence")))
    paragraphs = each("paragraphs", lambda p, i: F.struct(i.alias("paragraph_id"), p["content"].alias("content"), p["role"].alias("role"), p["confidence"].alias("confidence")))
    made = F.struct(raw["content"].alias("content"), tables.alias("tables"), images.alias("images"), pairs.alias("key_value_pairs"), paragraphs.alias("paragraphs"))
    return F.when(raw.isNotNull(), made).cast(LAYOUT)


def rollup(docs: DataFrame) -> DataFrame:
    """Per project: all, successful, failed and skipped documents."""
    s = F.col("processing_status")
    return docs.groupBy("project_name").agg(F.count("*").alias("total"), F.count_if(s == "success").alias("successful"), F.count_if(s == "error").alias("failed"), F.count_if(F.startswith(s, F.lit("skipped"))).alias("skipped"))


def run_status(total: Column, listed: Column, failed_listing: Column) -> Column:
    """Status of a project run."""
    return F.when(failed_listing, "error_listing_documents").when(listed == 0, "no_documents_found").when(total == 0, "no_documents_with_required_prefixes").otherwise("completed")


def corpus(docs: DataFrame, order: str = "document_name") -> DataFrame:
    """project_name, part, content: a project's text in parts that follow one another: part "" is the banner with the
    counts, then comes each successful document under its name, by `order`. A project of any size is never
    one row; sinks.write_corpus writes the parts in order."""
    text = F.concat(F.lit("\n\n--- DOCUMENT: "), "document_name", F.lit(" ---\n\n"), F.coalesce("content", F.lit("")), F.lit("\n\n" + "-" * 50 + "\n\n"))
    parts = docs.where("processing_status = 'success'").select("project_name", F.col(order).cast("string").alias("part"), text.alias("content"))
    c = {k: F.col(k).cast("string") for k in ("total", "successful", "skipped")}
    counts = F.concat(F.lit("PROCESSED DOCUMENTS: "), c["successful"], F.lit("/"), c["total"], F.lit("\nSKIPPED DOCUMENTS: "), c["skipped"])
    head = F.concat(F.lit(f"\n\n{BANNER}\n\nPROJECT: "), F.upper("project_name"), F.lit("\n"), counts, F.lit(f"\nPROCESSOR: {PROCESSOR}\n{BANNER}\n\n"))
    return rollup(docs).select("project_name", F.lit("").alias("part"), head.alias("content")).unionByName(parts)


def processed_files(docs: DataFrame, compat: bool = False) -> DataFrame:
    """project_name, file_name, value: a record per successful document, and each project's metadata."""
    from ..sources.sinks import as_json, layout_file_name

    names = [c for c in docs.columns if c != "project_name"]
    each = docs.where("processing_status = 'success'").select("project_name", layout_file_name("document_name", compat).alias("file_name"), as_json(*names).alias("value"))
    about = rollup(docs).select("project_name", F.concat("project_name", F.lit("_metadata.json")).alias("file_name"), as_json("project_name", "total", "successful", "failed", "skipped").alias("value"))
    return each.unionByName(about)


def markdown_files(docs: DataFrame) -> DataFrame:
    """project_name, file_name, value: a markdown file per successful document."""
    name = F.concat(F.regexp_replace("document_name", r"\.[^.]*$", ""), F.lit(".md"))
    return docs.where("processing_status = 'success'").select("project_name", name.alias("file_name"), F.concat(F.lit("# "), "document_name", F.lit("\n\n"), "content").alias("value"))


def pending(raw: DataFrame, layouts: DataFrame, chunks: DataFrame) -> DataFrame:
    """Raw documents with their status: already processed, already chunked, or new (null)."""
    done = layouts.where("processing_status = 'success' and content <> ''").select("project_name", "document_name", F.lit("skipped_already_processed").alias("a"))
    cut = chunks.where("chunk_index = 0").select("project_name", F.col("original_document").alias("document_name"), F.lit("skipped_already_chunked").alias("b"))
    keys = ["project_name", "document_name"]
    return raw.join(done.dropDuplicates(keys), keys, "left").join(cut.dropDuplicates(keys), keys, "left").withColumn("status", F.coalesce("a", "b")).drop("a", "b")
