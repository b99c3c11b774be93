"""Whitening of embeddings: projections on the leading components of their covariance, at unit variance.

Entries become whole numbers first, so counts, sums and deviations are exact. Tasks sum what is centred by those exact
sums; the covariance has as many rows as the vectors have entries, whatever their number. Its upper spectrum is cut
into slices, which are solved in tasks of their own (see ``feast``).

Vectors that are null or hold null or non-finite entries are left out. Vectors of different lengths count as ending in
zeros. Whole numbers beyond 2**62 either way stay there; a deviation that no long holds is null. Components without
variance, to rounding, are left out, so a table of equal vectors gives no rows, as an empty one. Null keys stay, repeated
rows are rows of their own, and extra columns are not read. Equal eigenvalues go in any order, the same for all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.llm.feast import EPS, eigenpairs, slices
from crmweave.llm.frames import stored
from crmweave.llm.vectors import longest, matrix, usable

SCALE, OFFSET = 64, 1_000_000
FARTHEST = 1 << 62
MOST_ENTRIES = 8192  # the covariance is handled whole
LONG = (1 << 63) - 1


def whole(entries: np.ndarray) -> np.ndarray:
    """floor(64 * c) + 1000000 as longs."""
    scaled = np.clip(np.floor(SCALE * entries), -float(FARTHEST), float(FARTHEST))
    return np.minimum(scaled, FARTHEST - 1024).astype(np.int64) + OFFSET


class Centre:
    """Number and sums of the whole numbers, to centre them exactly."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.fits = max(map(abs, sums), default=0) < FARTHEST // 2

    def moved(self, x: np.ndarray) -> np.ndarray:
        """n * x - S: longs where these hold it, else Python integers."""
        if self.fits and int(np.abs(x).max(initial=0)) < FARTHEST // (2 * self.n):
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.moved(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums of (n * x - S)^2."""
        moved = self.moved(x)
        if moved.dtype == np.int64 and float((moved.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)) < FARTHEST:
            return pa.array((moved**2).sum(axis=1), pa.int64())
        exact = (sum(int(v) ** 2 for v in row) for row in moved)
        return pa.array([d if d <= LONG else None for d in exact], pa.int64())


def sums_of(vectors: DataFrame, column: str, size: int) -> Centre:
    """Sums are taken over both halves of the numbers apart, and added as decimals."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = whole(matrix(batch.column(0), size))
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": np.arange(size), "n": np.full(size, n), "high": high, "low": low})

    parts = vectors.select(column).mapInArrow(over, "i long, n long, high long, low long")
    rows = parts.groupBy("i").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low"))).orderBy("i").collect()
    return Centre(int(rows[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in rows])


def product_sums(rows: DataFrame, column: str, size: int, centred: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
    """Sum over all rows of the outer product of what is ``centred`` with itself."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = centred(batch.column(0))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(list(total))], names=["i", "row"])

    parts = rows.select(column).mapInArrow(over, "i long, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros((size, size))
    for r in parts.filter("j >= i").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def leading(spark, covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, ``most`` at most, falling, with their eigenvectors as columns; slices are solved in tasks."""
    cut = slices(covariance, min(most, len(covariance)))
    if not cut:
        return np.zeros(0), np.zeros((len(covariance), 0))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values, found = eigenpairs(covariance, low, high, count)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(list(found.T))], names=["value", "component"])

    parts = spark.createDataFrame(cut, "low double, high double, count long").repartition(len(cut))
    pairs = sorted(((r["value"], r["component"]) for r in parts.mapInArrow(over, "value double, component array<double>").collect()), reverse=True)
    counted = sum(c for _, _, c in cut)
    if len(pairs) != counted:
        raise ArithmeticError(f"{len(pairs)} eigenvalues of {counted}")
    pairs = [p for p in pairs[:most] if p[0] > 16 * len(covariance) * EPS * pairs[0][0]]
    return np.array([v for v, _ in pairs]), np.array([c for _, c in pairs]).reshape(len(pairs), -1).T


def whitened(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """One row per usable vector and component.

    key, component, n, deviation, whitened, explained (share of all variance), identity_error (of the whole result).
    """
    spark = embeddings.sparkSession
    vectors = embeddings.filter(usable(vector)).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    size = longest(vectors, "vector")
    if size > MOST_ENTRIES:
        raise ValueError(f"vectors of more than {MOST_ENTRIES} entries")
    axes, values, n, trace = np.zeros((size, 0)), np.zeros(0), 0, 0.0
    if size:
        centre = sums_of(vectors, "vector", size)
        n = centre.n
        covariance = product_sums(vectors, "vector", size, lambda c: centre.centred(whole(matrix(c, size)))) / n
        trace = float(np.trace(covariance))
        values, axes = leading(spark, covariance, components)
    count = len(values)
    scaled = axes / np.sqrt(values)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(matrix(batch.column(1), size))
            made = (centre.centred(x) @ scaled).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * count, pa.int32()), pa.array(made))
            yield pa.RecordBatch.from_arrays([batch.column(0), centre.deviations(x), lists], names=["key", "deviation", "whitened"])

    kind = vectors.schema["key"].dataType
    if not count:
        rows, error = vectors.limit(0).select("key", F.lit(0).cast("long").alias("deviation"), F.array(F.lit(0.0)).alias("whitened")), 0.0
    else:
        rows = stored(vectors.mapInArrow(over, f"key {kind.simpleString()}, deviation long, whitened array<double>"), "whitened")
        means = np.array(rows.agg(*(F.avg(F.col("whitened")[i]) for i in range(count))).first())
        error = float(np.abs(product_sums(rows, "whitened", count, lambda c: matrix(c, count) - means) / n - np.eye(count)).max())
    shares = F.array(*(F.lit(float(v / trace)) for v in values)) if count else F.array(F.lit(0.0))
    return rows.select("key", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("key").alias(key), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )
