"""Parsed log lines kept as a table by date, for many reports.

Parsing is the dear part of a log report. The store holds parsed lines as
Parquet in a folder for each date: a report reads the columns and the days it
asks for, and new or corrected days replace their own folders only."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Lines of a task that writes, at most about so many.
ROWS_PER_FILE = 1_000_000


def store_days(access: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write parsed lines (``date_time`` and any other columns) to the store at
    ``path``. Days that occur in ``access`` are replaced, all others stay.

    Lines without a time have a folder of their own (``day`` null). The rows
    of a day are dealt to as many tasks as its number of rows asks for, so a
    busy day is no single task and a quiet one no heap of small files."""
    rows = access.withColumn("day", F.to_date("date_time"))
    counts = rows.groupBy("day").agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / rows_per_file)
    # A row for each day, which the join broadcasts only if it is measured small.
    named = counts.select(F.struct("day").alias("_day"), parts.cast("int").alias("_parts"))
    dealt = rows.withColumn("_day", F.struct("day")).join(named, "_day")
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in access.columns]), F.col("_parts")))
    (
        dealt.repartition("day", "_part").drop("_day", "_parts", "_part")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    )


def read_days(spark: SparkSession, path: str, first: datetime.date | None = None, last: datetime.date | None = None) -> DataFrame:
    """Stored lines of the days from ``first`` to ``last``; other days are not
    read. Without bounds all lines, those without a time too."""
    rows = spark.read.parquet(path)
    rows = rows.withColumn("day", F.col("day").cast("date"))
    if first is not None:
        rows = rows.where(F.col("day") >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col("day") <= F.lit(last))
    return rows
