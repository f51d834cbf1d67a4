"""A keyed state table of a base and deltas.

Rows are dealt over buckets by a hash of their key. An upsert writes the changed rows only, as one published epoch; a read
merges base and deltas, the row with the greatest order winning; a point read opens the files of one
bucket and lets Parquet skip what its key statistics exclude; compaction makes a new base of everything before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .epochs import Epochs


class StateTable:
    """schema: the rows' columns as DDL, with `key` (a string) and `order` among them."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, order: str, buckets: int = 64):
        self.spark, self.schema, self.key, self.order, self.buckets = spark, schema, key, order, buckets
        self.epochs = Epochs(spark, path)

    def _bucket(self, key) -> F.Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, table: str) -> None:
        dealt = rows.withColumn("bucket", self._bucket(F.col(self.key))).repartition("bucket").sortWithinPartitions("bucket", self.key)
        self.epochs.write((self.epochs.published() or [-1])[-1] + 1, {table: dealt}, {table: ["bucket"]})

    def upsert(self, changes: DataFrame) -> None:
        """Adds or replaces rows by key; of several changes of a key the last by order counts."""
        self._write(self._last(changes.where(F.col(self.key).isNotNull()).withColumn("epoch", F.lit(0))).drop("epoch"), "delta")

    def _last(self, rows: DataFrame) -> DataFrame:
        names = [c for c in rows.columns if c not in (self.key, "bucket")]
        best = rows.groupBy(self.key).agg(F.max_by(F.struct(*names), F.struct(self.order, "epoch")).alias("r"))
        return best.select(self.key, "r.*")

    def _parts(self) -> DataFrame:
        """Rows of the last base and of the deltas after it."""
        entries = self.epochs.entries()
        newest = -1 if entries is None else entries.where(F.col("table") == "base").agg(F.max("epoch")).first()[0]
        newest = -1 if newest is None else newest
        schema = f"{self.schema}, bucket int, epoch long"
        base = self.epochs.read("base", schema, newest - 1).where(F.col("epoch") == newest)
        return base.unionByName(self.epochs.read("delta", schema, newest))

    def read(self) -> DataFrame:
        return self._last(self._parts()).drop("epoch")

    def read_item(self, key: str) -> DataFrame:
        """The row of a key: one bucket's files of the base and of each delta."""
        return self._last(self._parts().where((F.col("bucket") == self._bucket(F.lit(key))) & (F.col(self.key) == key))).drop("epoch")

    def exists(self, key: str) -> bool:
        return self.read_item(key).limit(1).count() > 0

    def compact(self) -> None:
        """A new base of all rows; readers go on with the old one until it is published."""
        self._write(self.read(), "base")
