"""Whitening of embeddings over distinct vectors with multiplicities.

Entries become whole numbers, x = floor(64 * entry) + 1,000,000. Rows with the
same x vector are one distinct vector whose weight is their number (or one,
where each distinct vector is to count once). Weighted sums are exact; the
covariance is a weighted matrix product of vectors from which the exact mean
was taken before, added up from partial products of the tasks in a fixed order.
Its unit eigenvectors, by falling eigenvalue, whiten each distinct vector once,
and the rows get the result back by a join on their x vector.

x vectors are compared whole: a key holds their distances from 1,000,000 in the
least width that fits, so it is shorter than the vector.

What passes through the driver are sums and one matrix for each length of
vectors, whose size depends on that length alone.

Defined cases: rows whose vector is null, empty or holds null or non-finite
entries are dropped; vectors of another length are a fit of their own; rows of
equal or null id are kept, each with its own result; fewer components than 32
where vectors are shorter; a component whose eigenvalue is zero but for
rounding has ``whitened`` null, and is left out of ``identity_error``; entries
beyond 2^46 in size count as 2^46; a deviation beyond a long is null; empty
tables give empty results; other columns are left.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, ship, table
from tessera.llm.vectors import by_length

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
MOST = 1 << 52

_WIDTHS = (1, 2, 4, 8)


def pack(y: np.ndarray) -> list[bytes]:
    """Rows of whole numbers as a width and the numbers in that width, the
    least that holds all of a row."""
    out: list[bytes] = [b""] * len(y)
    top = np.maximum(y.max(axis=1), -(y.min(axis=1) + 1))
    need = np.searchsorted([127, 32767, 2147483647], top)
    for kind in np.unique(need).tolist():
        mine = np.flatnonzero(need == kind)
        small = np.ascontiguousarray(y[mine].astype(f"<i{_WIDTHS[kind]}"))
        for i, row in zip(mine.tolist(), small, strict=True):
            out[i] = bytes((_WIDTHS[kind],)) + row.tobytes()
    return out


def unpack(keys: list[bytes], n: int) -> np.ndarray:
    """Rows of ``n`` whole numbers from their keys."""
    y = np.empty((len(keys), n), np.int64)
    width = np.array([k[0] for k in keys])
    for w in np.unique(width).tolist():
        mine = np.flatnonzero(width == w)
        y[mine] = np.frombuffer(b"".join(keys[i][1:] for i in mine), f"<i{w}").reshape(-1, n)
    return y


def _exact(y: np.ndarray, most: int) -> np.ndarray:
    """As 64-bit numbers if ``most`` bounds what is made of them, else as
    Python's."""
    return y if most < 1 << 62 else y.astype(object)


def centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Exact n * y - sums of rows of whole numbers."""
    top = max(1, int(np.abs(y).max(initial=0)))
    y = _exact(y, 2 * n * top + max(map(abs, sums)))
    return n * y - np.array(sums, y.dtype)


def _squares(c: np.ndarray) -> list[int | None]:
    top = int(np.abs(c).max(initial=0))
    c = _exact(c, top * top * c.shape[1])
    return [int(s) if s < 1 << 63 else None for s in (c * c).sum(axis=1)]


def coded(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id``, length and key of the x vector of each remaining row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, v in by_length(batch.column(1)):
                if len(at):
                    y = np.clip(np.floor(SCALE * v), -MOST, MOST).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), v.shape[1], np.int32)), pa.array(pack(y), pa.binary())],
                        ["vec_id", "size", "key"],
                    )

    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v")).mapInArrow(run, "vec_id long, size int, key binary")


def _sized(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    size = batch.column("size").to_numpy()
    for n in np.unique(size).tolist():
        yield n, np.flatnonzero(size == n)


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Weight and exact weighted sums of the x vectors of each length, with
    1,000,000 taken off every entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            for n, at in _sized(batch):
                mine = batch.take(pa.array(at))
                y, w = unpack(mine.column("key").to_pylist(), n), mine.column("weight").to_numpy()
                y = _exact(y, int(w.sum()) * max(1, int(np.abs(y).max(initial=0))))
                for i, s in enumerate([int(w.sum()), *(w.astype(y.dtype) @ y).tolist()]):
                    total[n, i - 1] = total.get((n, i - 1), 0) + s
        if total:
            size, dim = zip(*total, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(size, pa.int32()), pa.array(dim, pa.int32()), pa.array([decimal.Decimal(s) for s in total.values()], pa.decimal128(38, 0))],
                ["size", "dim", "total"],
            )

    parts = distinct.select("size", "key", "weight").mapInArrow(run, "size int, dim int, total decimal(38,0)")
    found: dict[int, dict[int, int]] = {}
    for r in parts.groupBy("size", "dim").agg(F.sum("total").alias("total")).collect():
        found.setdefault(r["size"], {})[r["dim"]] = int(r["total"])
    return {n: (s[-1], [s[i] for i in range(n)]) for n, s in found.items()}


def _added(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sum of the tasks' matrices (``size``, ``line``, ``task``, ``part``), one
    line of a matrix in a group, in the order of the tasks."""

    def add(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("task").to_numpy())
        lines = group.column("part").to_pylist()
        total = np.zeros(len(lines[0]) // 8)
        for i in order.tolist():
            total += np.frombuffer(lines[i], np.float64)
        return pa.table({"size": group.column("size")[:1], "line": group.column("line")[:1], "part": pa.array([total.tobytes()], pa.binary())})

    found: dict[int, dict[int, np.ndarray]] = {}
    for r in parts.groupBy("size", "line").applyInArrow(add, "size int, line int, part binary").collect():
        found.setdefault(r["size"], {})[r["line"]] = np.frombuffer(r["part"], np.float64)
    return {n: np.stack([lines[i] for i in range(len(lines))]) for n, lines in found.items()}


def _products(vectors: DataFrame, read, first: bool = False) -> dict[int, np.ndarray]:
    """Weighted products of centred vectors (or, if ``first``, one line with
    their weighted sum) of each length. ``read`` makes a batch's rows of one
    length a matrix of centred vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, at in _sized(batch):
                mine = batch.take(pa.array(at))
                d, w = read(mine, n), mine.column("weight").to_numpy().astype(np.float64)
                made = (w @ d)[None] if first else (d * w[:, None]).T @ d
                total[n] = total[n] + made if n in total else made
        for n, made in total.items():
            lines, task = len(made), TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(lines, n, np.int32)), pa.array(np.arange(lines, dtype=np.int32)), pa.array(np.full(lines, task, np.int32)), pa.array([x.tobytes() for x in made], pa.binary())],
                ["size", "line", "task", "part"],
            )

    return _added(vectors.mapInArrow(run, "size int, line int, task int, part binary"))


def _axes(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leading eigenvalues, their shares of the trace and unit eigenvectors,
    each with its largest entry positive."""
    value, axis = np.linalg.eigh((v + v.T) / 2)
    value, axis = value[::-1][:most], axis[:, ::-1][:, :most]
    axis = axis * np.sign(axis[np.abs(axis).argmax(axis=0), np.arange(axis.shape[1])])
    trace = float(np.trace(v))
    return value, value / trace if trace > 0 else np.full(len(value), np.nan), axis


def whiten(
    rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding", weights: str = "counts"
) -> DataFrame:
    """A row for each remaining row and component: ``vec_id``, ``component``
    (from 1), ``n`` (weight of the fit), ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``. ``weights`` is "counts", or "one" for
    a fit in which each distinct vector counts once."""
    if weights not in ("counts", "one"):
        raise ValueError("weights are counts or one")
    spark = rows.sparkSession
    ship(spark)
    of = materialise(coded(rows, id_col, vec_col), "coded")
    distinct = of.groupBy("size", "key").agg(F.count("*").alias("copies"))
    distinct = materialise(distinct.select("size", "key", (F.col("copies") if weights == "counts" else F.lit(1).cast("long")).alias("weight")), "distinct")

    fit = _sums(distinct)
    covariance = _products(distinct, lambda mine, n: (centred(unpack(mine.column("key").to_pylist(), n), *fit[n]) / fit[n][0]).astype(np.float64))
    axes = {n: _axes(v / fit[n][0], components) for n, v in covariance.items()}
    # What is zero but for rounding cannot be scaled to one.
    scaled = {n: axis / np.sqrt(np.where(value > value[0] * n * 1e-14, value, np.nan)) for n, (value, _, axis) in axes.items()}

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, at in _sized(batch):
                mine = batch.take(pa.array(at))
                c = centred(unpack(mine.column("key").to_pylist(), n), *fit[n])
                z = (c / fit[n][0]).astype(np.float64) @ scaled[n]
                yield pa.RecordBatch.from_arrays(
                    [*(mine.column(x) for x in ("size", "key", "weight")), pa.array(_squares(c), pa.int64()), pa.array([x.tobytes() for x in z], pa.binary())],
                    ["size", "key", "weight", "deviation", "z"],
                )

    turned = materialise(distinct.mapInArrow(turn, "size int, key binary, weight long, deviation long, z binary"), "whitened")

    def read(mine: pa.RecordBatch, n: int) -> np.ndarray:
        return np.frombuffer(b"".join(mine.column("z").to_pylist()), np.float64).reshape(mine.num_rows, -1)

    narrow = turned.select("size", "weight", "z")
    mean = {n: x[0] / fit[n][0] for n, x in _products(narrow, read, first=True).items()}
    spread = _products(narrow, lambda mine, n: read(mine, n) - mean[n])
    model = []
    for n, (_, explained, _) in axes.items():
        error = np.abs(spread[n] / fit[n][0] - np.eye(len(explained)))
        error = None if np.isnan(error).all() else float(np.nanmax(error))
        model += [(n, i, fit[n][0], None if np.isnan(x) else float(x), error) for i, x in enumerate(explained)]
    model = spark.createDataFrame(model, "size int, place int, n long, explained double, identity_error double")

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec, deviation = batch.column("vec_id"), batch.column("deviation")
            for n, at in _sized(batch):
                z = read(batch.take(pa.array(at)), n)
                k = z.shape[1]
                each = pa.array(np.repeat(at, k))
                yield pa.RecordBatch.from_arrays(
                    [vec.take(each), pa.array(np.full(len(each), n, np.int32)), pa.array(np.tile(np.arange(k, dtype=np.int32), len(at))), deviation.take(each), pa.array(z.ravel(), from_pandas=True)],
                    ["vec_id", "size", "place", "deviation", "whitened"],
                )

    joined = of.join(turned.drop("weight"), ["size", "key"]).select("vec_id", "size", "deviation", "z")
    long = joined.mapInArrow(spelled, "vec_id long, size int, place int, deviation long, whitened double")
    return long.join(F.broadcast(model), ["size", "place"]).select(  # 32 rows for each length
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened", "explained", "identity_error"
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
