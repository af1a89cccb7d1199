"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir

BLOCK_BYTES = 24 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: Spark serves
    the archive from the driver, so no folder needs to be shared for it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tessera-code-"), "tessera_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: later steps read
    files that outlive any executor instead of recomputing the lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def annotate(
    df: DataFrame,
    fn: Callable[[pa.StructArray], dict[str, pa.Array]],
    out: T.StructType,
) -> DataFrame:
    """Rows of ``df`` as ``row`` (a struct of all its columns) beside ``out``
    (a struct made by ``fn`` from a batch of rows). Structs keep the columns
    of the input apart from those of the operator, whatever their names."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("row", df.schema), T.StructField("out", out)])
    arrow_out = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            made = fn(rows)
            cols = [made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], f.type) for f in arrow_out]
            yield pa.RecordBatch.from_arrays([rows, pa.StructArray.from_arrays(cols, fields=list(arrow_out))], ["row", "out"])
            del batch, rows, made, cols
        trim()

    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def in_blocks(batches: Iterator[pa.RecordBatch], block_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Join or cut record batches into blocks of about ``block_bytes``; a row
    is never cut, so a longer one is a block of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        per_row = max(1, batch.nbytes // max(1, batch.num_rows))
        step = max(1, block_bytes // per_row)
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            size += part.get_total_buffer_size() if batch.num_rows <= step else per_row * part.num_rows
            if size >= block_bytes:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def trim() -> None:
    """Give freed memory back to the system: a worker's allocators would keep
    what one block needed while the next task's JVM side grows."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


_KEPT: dict[str, Callable[[], None]] = {}


def only(owner: str, drop: Callable[[], None] | None = None) -> None:
    """A worker outlives its tasks and serves one operator after the other.
    What others than ``owner`` keep between tasks is dropped, so that a worker
    holds the memory of one operator at a time; ``drop`` empties what the
    owner keeps."""
    others = [x for x in _KEPT if x != owner]
    for x in others:
        _KEPT.pop(x)()
    if others:
        trim()
    if drop is not None:
        _KEPT[owner] = drop


def spans_cover(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Boolean array of ``n`` positions covered by windows at ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:-1]) > 0
