"""Tables written once into the shared folder and read back.

Several jobs of one query read them instead of computing them anew, lost
executors do not take them along, and a join on them is a plain shuffle join
that adaptive execution can split."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

# Spark's row ids hold the partition above these bits.
ROW_BITS = 33


# With it, Spark drops the shuffle files of a query that has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries inside drop their shuffle files when they end, not when the
    driver happens to collect its garbage: what they wrote stands for them.
    The session's own setting is put back."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet under ``spark.checkpoint.dir``, read back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_id() -> Column:
    """Partition and place of a row; to be stored, for another run of the
    plan may deal the rows otherwise."""
    return F.monotonically_increasing_id()


def indexed(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows of ``df`` numbered from 0 in ``column``, by the order of their
    partitions and of the rows inside. Stores the rows; one count for each
    partition passes through the driver."""
    kept = stored(df.withColumn("_row", row_id()), name)
    part = F.shiftright("_row", ROW_BITS)
    counts = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    begins, before = [], 0
    for r in counts:
        begins.append((r["_part"], before - (r["_part"] << ROW_BITS)))
        before += r["n"]
    begin = df.sparkSession.createDataFrame(begins, "_part bigint, _begin bigint")
    numbered = kept.withColumn("_part", part).join(F.broadcast(begin), "_part")  # a row for each partition
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_row") + F.col("_begin")).alias(column))
