"""Whitening of embeddings by the singular vectors of their centred rows.

Entries c become integers x = floor(64 c) + 1,000,000. Each distinct x vector counts once in the fit:
their number, their exact sums S, and MLlib's computeSVD on the distributed rows x - S/n. Its singular
values s give the eigenvalues s^2/n of the covariance (divisor n); the total variance is the sum of
exact integer deviations, over n^3. All rows, copies included, are then projected.

Results for odd input: rows whose vector is null or empty or holds null or non-finite entries are dropped, and so
are those of another width than most rows have (the larger width at a tie); repeated rows and null ids
give rows of their own; components whose eigenvalue is 0 to the precision of doubles are left out, so constant
vectors or a single one give an empty result; a deviation beyond 64 bits is null; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, ready, stage

#: Entries become floor(SCALE c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Eigenvalues below this share of the largest are rounding errors.
LEAST_SHARE = 1e-12
FIELDS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that are usable, and their width."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = v.where(F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c)))
    widths = usable.groupBy(F.size("v").alias("width")).count().where("width > 0").orderBy(F.desc("count"), F.desc("width")).first()
    width = widths["width"] if widths else 0
    x = F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT)
    return usable.where(F.size("v") == width).select("vec_id", x.alias("x")), width


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column("x").flatten().to_numpy().reshape(-1, width)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int], int, int]:
    """Vectors, exact sums per dimension, least and largest entry; a row per task and dimension is summed up by Spark."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, low, high = [0] * width, 0, [0] * width, [0] * width
        for _, m in _matrices(batches, width):
            least, most = m.min(0).tolist(), m.max(0).tolist()
            low, high = (least, most) if not n else (list(map(min, low, least)), list(map(max, high, most)))
            safe = max(abs(min(least)), abs(max(most))) * len(m) < 1 << 63
            total = [a + int(b) for a, b in zip(total, m.sum(0) if safe else m.astype(object).sum(0), strict=True)]
            n += len(m)
        if n:
            yield pa.record_batch([pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array(map(str, total)), pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["dimension", "n", "total", "low", "high"])

    parts = fit.mapInArrow(add, "dimension int, n long, total string, low long, high long")
    rows = parts.groupBy("dimension").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dimension").collect()
    if not rows:
        return 0, [], 0, 0
    return rows[0]["n"], [int(r["total"]) for r in rows], min(r["low"] for r in rows), max(r["high"] for r in rows)


class Whitening:
    """n fit vectors, their sums, and unit eigenvectors (columns) with eigenvalues, the largest first."""

    def __init__(self, n: int, sums: list[int], low: int, high: int, vectors: np.ndarray, values: np.ndarray):
        self.n, self.sums, self.vectors, self.values = n, sums, vectors, values
        self.mean = np.array([s / n for s in sums])
        # Whether n x - S, squared and summed, stays within 64 bits for every row of the fit list, and so for every row.
        self.narrow = max(abs(low), abs(high)) * n < 1 << 62 and len(sums) * (n * (high - low)) ** 2 < 1 << 63

    def deviations(self, m: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exactly."""
        if self.narrow:
            d = self.n * m - np.array(self.sums, dtype=np.int64)
            return (d * d).sum(1).tolist()
        d = self.n * m.astype(object) - np.array(self.sums, dtype=object)
        return (d * d).sum(1).tolist()

    def centred(self, m: np.ndarray) -> np.ndarray:
        """x - S/n in doubles; the integers are subtracted exactly where they fit."""
        if self.narrow:
            return (self.n * m - np.array(self.sums, dtype=np.int64)) / self.n
        return m - self.mean

    def whiten(self, m: np.ndarray) -> np.ndarray:
        return self.centred(m) @ self.vectors / np.sqrt(self.values)


def fit(distinct: DataFrame, width: int, components: int) -> Whitening | None:
    """Of distinct integer vectors, which stay distributed; the driver holds width x width numbers."""
    n, sums, low, high = _sums(distinct, width)
    if not n or low == high:
        return None
    mean = F.array(*[F.lit(s / n) for s in sums])
    centred = distinct.select(array_to_vector(F.zip_with(F.col("x"), mean, lambda x, m: x.cast("double") - m)).alias("row"))
    # All singular vectors are asked for, which makes MLlib solve the small problem to full precision.
    svd = RowMatrix(MLUtils.convertVectorColumnsFromML(centred, "row")).computeSVD(width, computeU=False, rCond=LEAST_SHARE**0.5)
    values = np.square(svd.s.toArray()) / n
    keep = [k for k in np.argsort(-values, kind="stable").tolist() if values[k] > LEAST_SHARE * values.max()][:components]
    return Whitening(n, sums, low, high, svd.V.toArray()[:, keep], values[keep]) if keep else None


def _moments(distinct: DataFrame, width: int, w: Whitening) -> tuple[float, float]:
    """Total variance from exact deviations, and the largest entry of |covariance of whitened rows - identity|."""
    k = len(w.values)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact, first, second = 0, np.zeros(k), np.zeros((k, k))
        for _, m in _matrices(batches, width):
            exact += sum(w.deviations(m))
            white = w.whiten(m)
            first += white.sum(0)
            second += white.T @ white
        names = ["deviation", *(f"m_{i}" for i in range(k)), *(f"c_{i}_{j}" for i in range(k) for j in range(i + 1))]
        numbers = [exact / w.n**3, *first, *(second[i, j] for i in range(k) for j in range(i + 1))]
        yield pa.record_batch([pa.array(names), pa.array(map(float, numbers), pa.float64())], names=["name", "value"])

    found = dict(distinct.mapInArrow(add, "name string, value double").groupBy("name").agg(F.sum("value")).collect())
    mean = [found[f"m_{i}"] / w.n for i in range(k)]  # rounding errors: the rows are centred
    error = max(abs(found[f"c_{i}_{j}"] / w.n - mean[i] * mean[j] - (i == j)) for i in range(k) for j in range(i + 1))
    return found["deviation"], error


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each usable row and component."""
    spark = vectors.sparkSession
    ready(spark)
    rows, width = integers(vectors, id_col, vector_col)
    if not width:
        return spark.createDataFrame([], FIELDS)
    distinct = stage(rows.select("x").distinct(), "distinct")
    w = fit(distinct, width, components)
    if w is None:
        return spark.createDataFrame([], FIELDS)
    trace, error = _moments(distinct, width, w)
    discard(distinct)
    k = len(w.values)
    sent = spark.sparkContext.broadcast(w)  # width x components numbers

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        explained = w.values / trace
        for batch, m in _matrices(batches, width):
            n = len(m)
            ids = np.repeat(np.arange(n), k)
            deviation = pa.array([d if d < 1 << 63 else None for d in w.deviations(m)], pa.int64())
            columns = [
                batch.column("vec_id").take(pa.array(ids)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, w.n)), deviation.take(pa.array(ids)),
                pa.array(w.whiten(m).ravel()), pa.array(np.tile(explained, n)), pa.array(np.full(n * k, error)),
            ]
            yield pa.record_batch(columns, names=[x.split()[0] for x in FIELDS.split(", ")])

    return rows.mapInArrow(project, FIELDS)
