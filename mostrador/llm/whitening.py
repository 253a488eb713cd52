"""Whitening of embeddings: principal components by FEAST contour integration, scaled to unit variance.

Two passes over the vectors give their exact sums and their covariance, each task keeping
one matrix and the tasks' matrices being added up row by row. Only the covariance
(dimensions times dimensions) comes to the driver, where it is reduced to tridiagonal
form to place the contours; the slices of the spectrum are solved in tasks of their own
(see ``feast``). A third pass projects every vector, and the whitened vectors, once
written, give their own covariance, whose distance from the identity is reported.

Vectors are arrays of whole numbers, so sums, means and squared distances from the mean are
exact; the deviation of a vector is checked to fit 64 bits and raises ``OverflowError`` if not.

Edge cases: rows whose vector is null or holds null or non-finite entries are dropped by
``quantised``. Vectors of another length than the most frequent one (the longest of these in
a tie) have no place in the fit and are left out. Components whose eigenvalue is zero within rounding
do not exist: constant vectors, or fewer vectors than dimensions, give fewer components, and
an empty table, a single vector or vectors all alike give no rows. Repeated rows and ids, and
rows without an id, are kept each for itself. Only id and vector are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.llm import feast
from mostrador.session import shared_folder

COMPONENTS = 32
_LONGEST = 2**63 - 1


class Whitening(NamedTuple):
    """``n`` vectors with ``sums``; ``values`` by falling size, ``vectors`` in columns, and the trace of the covariance."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", steps: int = 64, shift: int = 1_000_000) -> DataFrame:
    """``vec_id, x`` of the usable vectors, entries as whole numbers: ``floor(steps * c) + shift``."""
    usable = F.col(vector).isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != F.lit(float("inf")))
    )
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * steps) + F.lit(shift).cast("bigint"))
    return vectors.where(usable).select(F.col(vec_id).alias("vec_id"), whole.alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _sums(rows: DataFrame, folder: str) -> tuple[int, np.ndarray]:
    """Number and sums of the vectors of the most frequent length."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for dims in np.unique(lengths):
                part = _matrix(batch.column(1).filter(pa.array(lengths == dims)), int(dims))
                held = found.setdefault(int(dims), [0, np.zeros(dims, np.int64)])
                held[0] += len(part)
                held[1] = held[1] + part.sum(axis=0)
        keys = sorted(found)
        columns = [pa.array(keys, pa.int32()), pa.array([found[k][0] for k in keys], pa.int64())]
        sums = pa.array([found[k][1].tolist() for k in keys], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*columns, sums], ["dims", "n", "sums"])

    rows.mapInArrow(partial, "dims int, n bigint, sums array<bigint>").write.parquet(f"{folder}/sums")
    tasks = rows.sparkSession.read.parquet(f"{folder}/sums")
    best = tasks.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if best is None:
        return 0, np.zeros(0, np.int64)
    summed = tasks.where(F.col("dims") == best["dims"]).select(F.posexplode("sums").alias("at", "part"))
    summed = summed.groupBy("at").agg(F.sum("part").alias("total")).orderBy("at")  # one row per dimension
    return best["n"], np.array([r["total"] for r in summed.collect()], np.int64)


def _added(parts: DataFrame) -> np.ndarray:
    """The sum of square matrices given as rows ``row, task, entries``."""

    def added(rows: pa.Table) -> pa.Table:
        at = rows.column("row")[0].as_py()
        entries = rows.column("entries").combine_chunks()
        total = entries.flatten().to_numpy(zero_copy_only=False).reshape(len(entries), -1).sum(axis=0)
        return pa.table({"row": pa.array([at], pa.int32()), "task": pa.array([0], pa.int32()), "entries": pa.array([total.tolist()], pa.list_(pa.float64()))})

    shape = "row int, task int, entries array<double>"
    # Two steps, so that no task holds the rows of more than about the square root of all tasks.
    halfway = parts.groupBy("row", F.pmod("task", F.lit(64)).alias("turn")).applyInArrow(added, shape)
    whole = halfway.groupBy("row").applyInArrow(added, shape)
    return np.array([r["entries"] for r in whole.orderBy("row").collect()])


def _products(rows: DataFrame, column: str, dims: int, centred) -> DataFrame:
    """Per task, the products of the centred vectors, as rows of one matrix."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, task = np.zeros((dims, dims)), TaskContext.get().partitionId()
        for batch in batches:
            c = centred(_matrix(batch.column(0), dims))
            total += c.T @ c
        if total.any():
            entries = pa.array(total.tolist(), pa.list_(pa.float64()))
            ids = [pa.array(np.arange(dims), pa.int32()), pa.array(np.full(dims, task), pa.int32())]
            yield pa.RecordBatch.from_arrays([*ids, entries], ["row", "task", "entries"])

    return rows.select(column).mapInArrow(products, "row int, task int, entries array<double>")


def _eigenpairs(spark, covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest positive eigenvalues, falling, with unit eigenvectors in columns."""
    dims = len(covariance)
    parts = feast.slices(*feast.tridiagonal(covariance), most)
    if not parts:
        return np.zeros(0), np.zeros((dims, 0))

    # Tasks are dealt by bounds and count alone: the order of the pairs, and with it their signs, follows the rows dealt.
    whole = {p[:3]: p for p in parts}

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bounds in zip(*(column.to_pylist() for column in batch.columns)):
                values, vectors = feast.solve_slice(covariance, whole[bounds])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], ["value", "vector"]
                )

    table = spark.createDataFrame(list(whole), "low double, high double, count int").repartition(len(parts))
    found = table.mapInArrow(solved, "value double, vector array<double>").collect()
    # Rayleigh-Ritz over all slices together makes vectors of different slices orthogonal to rounding.
    basis, _ = np.linalg.qr(np.array([r["vector"] for r in found]).T)
    values, rotation = np.linalg.eigh(basis.T @ covariance @ basis)
    order = np.argsort(-values)[:most]
    return values[order], basis @ rotation[:, order]


def fit(rows: DataFrame, most: int = COMPONENTS) -> Whitening:
    """The whitening of ``rows`` (vec_id, x)."""
    spark = rows.sparkSession
    n, sums = _sums(rows, shared_folder(spark, "whitening"))
    dims = len(sums)
    if not dims:
        return Whitening(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0)
    added = _added(_products(_fitting(rows, dims), "x", dims, lambda x: centred(x, n, sums)))
    covariance = added / n if len(added) else np.zeros((dims, dims))
    values, vectors = _eigenpairs(spark, covariance, most)
    return Whitening(n, sums, values, vectors, float(np.trace(covariance)))


def _fitting(rows: DataFrame, dims: int) -> DataFrame:
    return rows.where(F.size("x") == dims)


def _exact(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums`` as whole numbers; of Python's where 64 bits might not hold them."""
    most = int(np.abs(x).max(initial=0)) * n + int(np.abs(sums).max(initial=0))
    if most > _LONGEST:
        return x.astype(object) * n - sums.astype(object)
    return x * np.int64(n) - sums


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Distances from the mean, rounded once."""
    return (_exact(x, n, sums) / n).astype(float)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Per vector, the sum of the squares of ``n * x - sums``: exact, or an ``OverflowError``."""
    apart = _exact(x, n, sums)
    reach = int(np.abs(apart).max(initial=0))
    if reach * reach * max(1, x.shape[1]) <= _LONGEST:
        return (apart * apart).sum(axis=1).astype(np.int64)
    wide = [sum(v * v for v in row) for row in apart.tolist()]
    return np.array(wide, np.int64)


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened`` (an array, one entry per component) of every vector of the fitted length."""
    n, sums = model.n, model.sums
    scaled = model.vectors / np.sqrt(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), len(sums))
            flat = pa.array((centred(x, n, sums) @ scaled).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * scaled.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviations(x, n, sums)), lists], ["vec_id", "deviation", "whitened"])

    key = rows.schema["vec_id"].dataType.simpleString()
    return _fitting(rows, len(sums)).mapInArrow(project, f"vec_id {key}, deviation bigint, whitened array<double>")


def identity_error(vectors: DataFrame, n: int, components: int) -> float:
    """The largest entry of the covariance of ``whitened`` less the identity. They are centred already."""
    added = _added(_products(vectors, "whitened", components, lambda w: w))
    return float(np.abs(added / n - np.eye(components)).max())


def components(rows: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of ``rows`` (vec_id, x), components numbered from 1."""
    spark = rows.sparkSession
    model = fit(rows, most)
    key = rows.schema["vec_id"].dataType.simpleString()
    if not len(model.values):
        return spark.createDataFrame(
            [], f"vec_id {key}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        )
    folder = shared_folder(spark, "whitened")
    whitened(rows, model).write.parquet(folder)
    vectors = spark.read.parquet(folder)
    error = identity_error(vectors, model.n, len(model.values))
    shares: Column = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return vectors.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
