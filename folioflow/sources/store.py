"""Project documents in a file store, and tables of state.

Layout under a root: <root>/<project>/raw, <root>/<project>/processed/{DI,chunks,openai_logs},
<root>/<project>/results. Listings are DataFrames of paths; contents are read by executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import EXTENSIONS
from ..functions.names import normalize_name, variants

RAW, LAYOUT, CHUNKS, LOGS, RESULTS = "raw", "processed/DI", "processed/chunks", "processed/openai_logs", "results"


def project_path(root: str, project: str, folder: str = "") -> str:
    return "/".join(x.strip("/") if k else x.rstrip("/") for k, x in enumerate((root, project, folder)) if x)


def parts(path: Column | str, root: str) -> list[Column]:
    """project, folder and name of a path below a root's last segment."""
    base = root.rstrip("/").rsplit("/", 1)[-1]
    below = F.substring_index(F.regexp_replace(path, f"^.*?/{base}/", ""), "?", 1)
    steps = F.split(below, "/")
    return [F.get(steps, F.lit(0)), F.array_join(F.slice(steps, 2, F.greatest(F.size(steps) - 2, F.lit(0))), "/"), F.element_at(steps, -1)]


def listing(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, project_name, folder, document_name, file_size, modified_at of every object; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    project, folder, name = parts("path", root)
    return files.select("path", project.alias("project_name"), folder.alias("folder"), name.alias("document_name"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at"))


def list_projects(files: DataFrame, ordered: bool = False) -> DataFrame:
    found = files.where("folder <> ''").select("project_name").distinct()
    return found.orderBy("project_name") if ordered else found


def in_folder(files: DataFrame, folder: str) -> DataFrame:
    """Objects at or below a folder of their project, nested ones included."""
    return files.where(((F.col("folder") == folder) | F.startswith("folder", F.lit(folder + "/"))) & (F.col("document_name") != ""))


def list_raw_documents(files: DataFrame) -> DataFrame:
    return in_folder(files, RAW)


def list_processed_documents(files: DataFrame) -> DataFrame:
    return in_folder(files, LAYOUT)


def list_chunks(files: DataFrame) -> DataFrame:
    return in_folder(files, CHUNKS)


def list_with_prefix(files: DataFrame, prefix: str, name_filter: str | Callable[[Column], Column] | None = None) -> DataFrame:
    """Objects whose project path starts with a prefix; the filter is a part of the name or a condition on it."""
    virtual = F.concat_ws("/", "project_name", "folder", "document_name")
    found = files.where(F.startswith(virtual, F.lit(prefix)))
    if name_filter is None:
        return found
    return found.where(F.contains("document_name", F.lit(name_filter)) if isinstance(name_filter, str) else name_filter(F.col("document_name")))


def list_supported(spark: SparkSession, root: str) -> DataFrame:
    """Objects with an ending that the layout stage takes, sorted."""
    return listing(spark, root, "*.{" + ",".join(EXTENSIONS) + "}").orderBy("project_name", "document_name")


def read_binary(spark: SparkSession, root: str, folder: str = RAW) -> DataFrame:
    """Raw documents with their bytes; executors hold one file at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    project, inner, name = parts("path", root)
    rows = files.select(project.alias("project_name"), inner.alias("folder"), name.alias("document_name"), "path", "content", F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at"))
    return in_folder(rows, folder).drop("folder")


def read_processed(spark: SparkSession, root: str, folder: str = LAYOUT) -> DataFrame:
    """content as text, and value as a variant where the text is JSON."""
    whole = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(root).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    project, inner, name = parts("path", root)
    rows = whole.select(project.alias("project_name"), inner.alias("folder"), name.alias("document_name"), "content")
    return in_folder(with_value(rows), folder).drop("folder")


def with_value(rows: DataFrame, content: str = "content") -> DataFrame:
    """Adds value: the content as a variant, null where it isn't JSON."""
    return rows.withColumn("value", F.try_parse_json(content))


def top(files: DataFrame, by: Column, n: int, *ties: str) -> DataFrame:
    """The n rows with the most of something; Spark keeps n rows per task and merges them."""
    return files.orderBy(by.desc(), *ties).limit(n)


def download(spark: SparkSession, root: str, wanted: DataFrame, folder: str = RAW) -> DataFrame:
    """wanted (project_name, document_name) with the bytes of the object of that name in any Unicode form; content is null
    where there is none. Only the objects that are found are read."""
    found = find_documents(wanted, in_folder(listing(spark, root), folder))
    bytes_of = read_binary(spark, root, folder).select("path", "content", "file_size")
    return found.join(bytes_of, "path", "left").select("project_name", "document_name", "stored", "path", "content", "file_size")


def names_with_prefix(containers: dict[str, DataFrame], prefix: str, container: str) -> DataFrame:
    """Names of a container's objects whose project path starts with a prefix, sorted."""
    found = list_with_prefix(containers[container], prefix)
    return found.select(F.concat_ws("/", "project_name", "folder", "document_name").alias("name")).orderBy("name")


def find_documents(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """wanted (project_name, document_name) with the path of the object of that name in any Unicode form.

    Where several forms exist, the name as given wins, then the forms in their order.
    """
    asked = wanted.select("project_name", "document_name", normalize_name("document_name", "NFKC").alias("form"))
    there = files.select("project_name", F.col("document_name").alias("stored"), normalize_name("document_name", "NFKC").alias("form"), "path")
    rank = F.array_position(variants("document_name"), F.col("stored"))
    met = asked.join(there, ["project_name", "form"], "left").withColumn("rank", F.when(rank > 0, rank).otherwise(F.lit(99)))
    best = met.groupBy("project_name", "document_name").agg(F.min_by(F.struct("stored", "path"), "rank").alias("best"))
    return best.select("project_name", "document_name", "best.stored", "best.path")


def similar_names(missing: DataFrame, files: DataFrame) -> DataFrame:
    """Stored names that hold the stem of a missing name, whatever their case; an empty stem is in none.

    A name that holds a stem holds its first three letters, so those are joined on, not whole projects.
    """
    stem, name = F.lower(F.regexp_replace("document_name", r"\.[^.]*$", "")), F.lower("document_name")
    a = missing.select("project_name", "document_name", stem.alias("stem"), F.left(stem, F.lit(3)).alias("gram")).where("stem <> ''")

    def grams_of(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(name)), lambda k: F.substring(name, k, F.lit(n)))

    grams = F.array_distinct(F.concat(*map(grams_of, (1, 2, 3))))
    b = files.where("document_name <> ''").select("project_name", F.col("document_name").alias("stored"), F.explode(grams).alias("gram"))
    return a.join(b, ["project_name", "gram"]).where(F.contains(F.lower("stored"), F.col("stem"))).drop("stem", "gram")


def exist_in(wanted: DataFrame, files: DataFrame, folder: str) -> DataFrame:
    """wanted rows whose object exists in a folder."""
    return wanted.join(in_folder(files, folder).select("project_name", "document_name"), ["project_name", "document_name"], "left_semi")


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType | None = None, whole_file: bool = False) -> DataFrame:
    """Lines parsed one by one; bad ones are dropped, or with whole_file everything in a file that has one."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path")).where(F.trim("value") != "")
    parsed = lines.withColumn("parsed", F.try_parse_json("value"))
    if whole_file:
        bad = parsed.where("parsed is null").select("path").distinct()
        parsed = parsed.join(bad, "path", "left_anti")
    parsed = parsed.where("parsed is not null")
    return parsed.select(F.from_json("value", schema).alias("r")).select("r.*") if schema is not None else parsed.select("value", "parsed")


def query_state(state: DataFrame, condition: Column | str) -> DataFrame:
    return state.where(condition)


def pending_folders(state: DataFrame) -> DataFrame:
    """Distinct non-empty folder names whose batch is pending."""
    return state.where("isBatchPending").where("folderName is not null and folderName <> ''").select("folderName").distinct()


def read_item(state: DataFrame, key: str, value: str) -> DataFrame:
    return state.where(F.col(key) == value).limit(1)


def item_exists(state: DataFrame, key: str, value: str) -> bool:
    return bool(read_item(state, key, value).take(1))
