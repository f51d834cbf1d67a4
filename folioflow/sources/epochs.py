"""Tables that grow by epochs, of which readers see whole ones only.

The tables of an epoch are written to folders of their own attempt. Then a manifest that names the folders is written
aside and renamed into place, which the file system does at once or not at all. Readers take the
folders of published manifests; what an attempt left that died before is never seen, and `sweep` removes it. An epoch that
is published already is not written again, so a repeated micro-batch leaves what the first one did.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

_MANIFESTS = "_published"


class Epochs:
    """Tables by name below a folder; `crash`, for tests, is called before the manifest is published."""

    def __init__(self, spark: SparkSession, root: str, crash: Callable[[], None] | None = None):
        self.spark, self.root, self.crash = spark, root.rstrip("/"), crash
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _manifest(self, epoch: int):
        return self._path(f"{self.root}/{_MANIFESTS}/{epoch:012d}.json")

    def published(self) -> list[int]:
        """Numbers of the published epochs, in order: names only, nothing is read."""
        at = self._path(f"{self.root}/{_MANIFESTS}")
        if not self._files.exists(at):
            return []
        names = [x.getPath().getName() for x in self._files.listStatus(at)]
        return sorted({e for n in names if n.endswith(".json") for e in _span(n)})

    def done(self, epoch: int) -> bool:
        return self._files.exists(self._manifest(epoch)) or epoch in self.published()

    def write(self, epoch: int, tables: dict[str, DataFrame], partition_by: dict[str, list[str]] | None = None, formats: dict[str, str] | None = None) -> bool:
        """Writes (as Parquet, or another format) and publishes an epoch; False if it had been published before."""
        if self.done(epoch):
            return False
        attempt = uuid.uuid4().hex
        folders = {}
        for name, df in tables.items():
            folders[name] = f"{name}/epoch={epoch}/attempt={attempt}"
            df.write.partitionBy(*(partition_by or {}).get(name, [])).format((formats or {}).get(name, "parquet")).save(f"{self.root}/{folders[name]}")
        if self.crash:
            self.crash()
        return self._publish(self._manifest(epoch), [{"epoch": epoch, "table": n, "folder": f, "schema": tables[n].schema.simpleString()} for n, f in folders.items()])

    def _publish(self, place, rows: list[dict]) -> bool:
        aside = self._path(f"{self.root}/{_MANIFESTS}/.{uuid.uuid4().hex}")
        out = self._files.create(aside, True)
        out.write(bytearray(("\n".join(json.dumps(r) for r in rows) + "\n").encode()))
        out.close()
        won = not self._files.exists(place) and self._files.rename(aside, place)
        if not won:
            self._files.delete(aside, False)
        return won

    def entries(self, since: int = -1) -> DataFrame | None:
        """epoch, table, folder, schema of the published epochs after one; None without any."""
        names = [f"{self.root}/{_MANIFESTS}/{n}" for n in self._names() if max(_span(n)) > since]
        if not names:
            return None
        return self.spark.read.schema("epoch long, table string, folder string, schema string").json(names).where(f"epoch > {since}")

    def _names(self) -> list[str]:
        at = self._path(f"{self.root}/{_MANIFESTS}")
        return sorted(n for x in (self._files.listStatus(at) if self._files.exists(at) else []) if (n := x.getPath().getName()).endswith(".json"))

    def read(self, table: str, schema: str, since: int = -1, form: str = "parquet") -> DataFrame:
        """Rows of a table from the published epochs after one; an empty table without any."""
        rows = self.entries(since)
        folders = [] if rows is None else [f"{self.root}/{r[0]}" for r in rows.where(rows["table"] == table).select("folder").distinct().collect()]  # one path per epoch
        none = self.spark.createDataFrame([], schema)
        if not folders:
            return none
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").format(form).load(folders).select(*none.columns)

    def compact(self) -> None:
        """Joins the manifests into one, named by its first and last epoch, so that listings stay short. Data stay in place."""
        names = self._names()
        if len(names) < 2:
            return
        rows = [r.asDict() for r in self.entries().collect()]
        first, last = min(map(min, map(_span, names))), max(map(max, map(_span, names)))
        # until the old ones are gone, their entries are read twice, which `distinct` above evens out
        if self._publish(self._path(f"{self.root}/{_MANIFESTS}/{first:012d}-{last:012d}.json"), rows):
            for n in names:
                self._files.delete(self._path(f"{self.root}/{_MANIFESTS}/{n}"), False)

    def sweep(self, tables: Iterable[str]) -> int:
        """Removes attempts that were never published; only while nobody writes. Returns how many."""
        rows = self.entries()
        kept = set() if rows is None else {r[0] for r in rows.select("folder").distinct().collect()}
        gone = 0
        for table in tables:
            for at in self._files.globStatus(self._path(f"{self.root}/{table}/epoch=*/attempt=*")) or []:
                parts = at.getPath().toString().rstrip("/").split("/")[-3:]
                if "/".join(parts) not in kept:
                    gone += bool(self._files.delete(at.getPath(), True))
        return gone


def _span(name: str) -> range:
    a, _, b = name.removesuffix(".json").partition("-")
    return range(int(a), int(b or a) + 1)
