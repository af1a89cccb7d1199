"""Exact top-k of frequent values through a mergeable sketch.

A full count shuffles every distinct value. Where a few values are far more
frequent than the rest, a frequent-items sketch of fixed size finds all that
can be among the top k; these few are counted exactly, and the sketch's error
bound proves that no other value is as frequent. Where the proof fails (a flat
distribution) the full count decides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAP_SIZE = 1 << 14  # a power of two; the sketch tracks three quarters of it

# Fixed value: the sketch's error is at most 3.5 / map size of the rows.
ERROR = 3.5


def full_top(df: DataFrame, col: str, k: int) -> DataFrame:
    """(col, count) of the k most frequent values, by a full count; ties in
    count break on the value, nulls are left out."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(col)).limit(k)


def proven_top(df: DataFrame, col: str, k: int, map_size: int = MAP_SIZE) -> DataFrame | None:
    """As ``full_top``, from the sketch's candidates; None without a proof.

    The sketch is one row; it names at most ``0.75 * map_size`` values, so
    they are broadcast to the exact count. A value it does not name has at most
    twice the error (it reports by lower bounds), and the k-th exact count must
    be above that."""
    rows = df.where(F.col(col).isNotNull()).select(col)
    tracked = map_size * 3 // 4
    sketch = rows.agg(F.expr(f"approx_top_k(`{col}`, {tracked}, {tracked})").alias("items"), F.count(F.lit(1)).alias("n")).first()
    if not sketch["n"]:
        return full_top(rows.limit(0), col, k)
    named = df.sparkSession.createDataFrame([(x["item"],) for x in sketch["items"]], rows.schema)
    top = full_top(rows.join(F.broadcast(named), col, "left_semi"), col, k).collect()
    if len(top) < k or top[-1]["count"] <= 2 * ERROR / map_size * sketch["n"]:
        return None
    return df.sparkSession.createDataFrame(top, f"{col} {rows.schema[0].dataType.simpleString()}, count bigint")


def frequent_top(df: DataFrame, col: str, k: int, map_size: int = MAP_SIZE) -> DataFrame:
    """(col, count) of the k most frequent values, exactly."""
    found = proven_top(df, col, k, map_size)
    return full_top(df, col, k) if found is None else found
