"""Generic sources: text files, in-memory rows, ranges, line numbering."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions.text import split_lines
from tessera.plans.stored import indexed, row_id, stored

# Rows that one task of a numbering sorts, at most about so many.
ROWS_PER_RANGE = 1_000_000


def read_text_lines(
    spark: SparkSession, path: str | Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Lines of text files (gzip too) as a ``value`` column.

    Gzip files cannot be split, so one file lands in one task; pass
    ``partitions`` to spread the lines over more tasks after the read.
    """
    df = spark.read.text(path if isinstance(path, str) else list(path))
    if partitions:
        df = df.repartition(partitions)
    return df


def document_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, line_no, line): every line of every text value, numbered from 0.

    Narrow: each row explodes in place, no shuffle.
    """
    return df.select(
        F.col(id_col), F.posexplode_outer(split_lines(text_col)).alias("line_no", "line")
    ).where(F.col("line").isNotNull())


def numbered_lines(
    df: DataFrame, order_by: str | Sequence[str], ranges: int | None = None, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Attach a global 0-based ``line_index`` in the order of ``order_by``
    (the ``zipWithIndex`` operation).

    The order comes from columns; rows that are equal in them are ordered by
    a hash of all columns (for the order that files have, see
    ``read_file_lines``). The rows are counted and range-partitioned by twice
    as many quantiles as ``rows_per_range`` asks for (or by ``ranges``), so a
    range of twice the mean still keeps to it, and a hot key is cut by the
    hash. Each range is
    sorted and written once with the place of every row in it; one count for
    each range reaches the driver.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if not order:
        raise ValueError("numbered_lines needs columns to order by")
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    keyed = df.withColumn("_tie", tie)
    ranges = ranges or max(1, -(-2 * df.count() // rows_per_range))
    ranged = keyed.repartitionByRange(ranges, *order, "_tie").sortWithinPartitions(*order, "_tie")
    return indexed(ranged, "line_index", "numbered").drop("_tie")


def read_file_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of text files with their place: ``value``, ``file``, ``line_no``
    (in the file) and ``line_index`` (over all files, ordered by path), both
    from 0. Paths must not overlap.

    Splits of a file are read by separate tasks. A split is known by its file
    and first byte, and its lines are read in order; so the lines are written
    once with their place in the split, and the splits' counts give each
    split its offset. A row for each split is summed up by file, one for each
    file over all.
    """
    paths = path if isinstance(path, str) else list(dict.fromkeys(path))
    read = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), row_id().alias("row")
    )
    lines = stored(read, "lines")
    splits = lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    earlier = Window.unboundedPreceding, -1
    files = splits.groupBy("file").agg(F.sum("n").alias("n"))
    files = files.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(*earlier)), F.lit(0)).alias("files_before"))
    in_file = F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(*earlier))
    offsets = splits.select("file", "start", "first", F.coalesce(in_file, F.lit(0)).alias("before")).join(files, "file")
    placed = lines.join(stored(offsets, "splits"), ["file", "start"])
    line_no = F.col("before") + F.col("row") - F.col("first")
    return placed.select("value", "file", line_no.alias("line_no"), (F.col("files_before") + line_no).alias("line_index"))


def from_values(
    spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str
) -> DataFrame:
    """A DataFrame from in-memory rows (small literals only)."""
    return spark.createDataFrame(list(rows), schema)


def number_range(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """0..n-1 as ``id`` (bigint), generated in parallel."""
    return spark.range(0, n, 1, partitions)
