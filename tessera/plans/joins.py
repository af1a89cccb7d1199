"""Join strategies that stay safe when a key is hot.

The library never forces a broadcast of data whose size grows with the
input: the optimizer broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time) and
falls back to a sort-merge join otherwise. Explicit ``F.broadcast`` is used
only on inputs with a fixed bound (a threshold range, a literal list).

A lookup join (one row per key on one side) needs a shuffle of its own on
both sides: then, when a hot key fills a partition of the other side, AQE
splits that partition and hands each piece the lookup's partition
(``spark.sql.adaptive.skewJoin.enabled``). A lookup that was grouped by the
key has none, for it lies as the join wants it; ``lookup_join`` gives it one.
A many-to-many join of a hot key makes far more rows than it reads, so
``grid_join`` cuts the key's pairs into a grid of tasks itself. Where most
records share a key with most others, ``block_pairs`` brings all keys of a
pair to one task; ``block_cells`` hands such a task's rows to a function.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``lookup`` (one row per ``key``, often made
    by grouping by it), safe for a key that fills a large part of ``rows``.

    The lookup is first dealt out by a hash of the key's hash, which no join
    can use as it is. So the join shuffles it again by the key, with a shuffle
    that AQE may read in pieces; a measured small one is broadcast as ever.
    """
    return rows.join(lookup.repartition(F.xxhash64(key)), key, how)


def salt_count(work: Column, per_task: int, limit: Column | int | None = None) -> Column:
    """Tasks to use for a key: ``ceil(work / per_task)``, at least 1.

    ``limit`` bounds it (e.g. by the row count of the split side: a task
    with less than one row of that side is useless). Computed in doubles and
    bounded before it becomes a whole number, so no product overflows.
    """
    most = F.lit(float(1 << 62)) if limit is None else (limit if isinstance(limit, Column) else F.lit(limit)).cast("double")
    n = F.ceil(F.least(work.cast("double") / F.lit(float(per_task)), most).cast("double"))
    return F.greatest(F.lit(1).cast("bigint"), n.cast("bigint"))


def grid_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_by: str,
    right_by: str,
    left_rows: str,
    right_rows: str,
    pairs_per_task: int,
) -> DataFrame:
    """Equi-join on ``key`` with the pairs of a hot key in a grid of tasks.

    Both inputs carry how many rows each side has of the key (``left_rows``,
    ``right_rows``). A key with more than ``pairs_per_task`` pairs gets
    ``rows x columns`` cells: a left row goes, by hash of ``left_by``, to one
    row of the grid and is copied along it, a right row to one column. Both
    numbers follow the sides' sizes, so that a cell reads about as much of
    either side and the copies grow with the root of the pairs. Keys with one
    cell are joined as usual. The result is exactly the plain equi-join;
    hashing sends a row to the same cells when a lost task runs again.
    """
    l, r = F.col(left_rows).cast("double"), F.col(right_rows).cast("double")
    cells = salt_count(l * r, pairs_per_task).cast("double")
    rows = salt_count(F.sqrt(cells * l / F.greatest(r, F.lit(1.0))), 1, F.least(cells, l))
    columns = salt_count(cells / rows, 1, r)

    def own(by: str, n: Column) -> Column:
        return F.pmod(F.xxhash64(F.col(by)), n)

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))

    a = left.withColumn("_row", own(left_by, rows)).withColumn("_column", every(columns)).drop(left_rows, right_rows)
    b = right.withColumn("_column", own(right_by, columns)).withColumn("_row", every(rows)).drop(left_rows, right_rows)
    return a.join(b, [key, "_row", "_column"]).drop("_row", "_column")


def block_pairs(
    left: DataFrame, right: DataFrame, key: str, left_by: str, right_by: str, rows: int, columns: int, sums: dict[str, Column]
) -> DataFrame:
    """Aggregates of all (``left_by``, ``right_by``) pairs that share a
    ``key``, by a grid of blocks of records (fragment and replicate).

    Left records go by hash to ``rows`` blocks and are copied to all
    ``columns``, right records the other way round. A cell of the grid has all
    keys of its pairs, so one shuffle by cell serves the grouping by key (which
    makes the pairs) and the one by pair; the rows a key makes never leave the
    task. Both sides carry ``value``; ``sums`` are aggregates by name over the
    columns ``key``, ``left_value`` and ``right_value``. A list of a key is as
    long as the records of a block at most.
    """
    def block(by: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col(by)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    kept = {by: F.struct(F.col(by).alias("id"), F.col("value").alias("value")) for by in (left_by, right_by)}
    a = left.select(block(left_by, rows).alias("_row"), every(columns).alias("_column"), key, kept[left_by].alias("_left"))
    b = right.select(every(rows).alias("_row"), block(right_by, columns).alias("_column"), key, kept[right_by].alias("_right"))
    dealt = a.unionByName(b, allowMissingColumns=True).repartition("_row", "_column")
    met = dealt.groupBy("_row", "_column", key).agg(F.collect_list("_left").alias("_lefts"), F.collect_list("_right").alias("_rights"))
    pairs = met.select("_row", "_column", key, F.explode("_lefts").alias("_left"), "_rights")
    pairs = pairs.select("_row", "_column", key, "_left", F.explode("_rights").alias("_right")).select(
        "_row", "_column", key, F.col("_left.id").alias(left_by), F.col("_right.id").alias(right_by),
        F.col("_left.value").alias("left_value"), F.col("_right.value").alias("right_value"),
    )
    return pairs.groupBy("_row", "_column", left_by, right_by).agg(*[c.alias(n) for n, c in sums.items()]).drop("_row", "_column")


def block_cells(
    left: DataFrame, right: DataFrame, left_by: str, right_by: str, rows: int, columns: int,
    run: Callable[[pa.Table, pa.Table], pa.Table], schema: T.StructType,
) -> DataFrame:
    """What ``run`` makes of the cells of the grid of ``block_pairs``: it gets
    the rows of both sides that fall into a cell, all those of their records.
    One shuffle a side; nothing between the rows and the result leaves the task.
    """
    def block(by: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col(by)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n > 1 else F.lit(0)

    a = left.select("*", block(left_by, rows).alias("_row"), every(columns).alias("_column"))
    b = right.select("*", every(rows).alias("_row"), block(right_by, columns).alias("_column"))
    cell = ["_row", "_column"]
    return a.groupBy(*cell).cogroup(b.groupBy(*cell)).applyInArrow(run, schema)


def block_shape(n_left: int, n_right: int, pairs_per_cell: int) -> tuple[int, int]:
    """Rows and columns of a grid whose cells hold about ``pairs_per_cell``
    pairs of records and about as many records of either side."""
    cells = max(1, -(-n_left * n_right // pairs_per_cell))
    rows = min(max(1, n_left), cells, max(1, round((cells * n_left / max(1, n_right)) ** 0.5)))
    return rows, max(1, min(n_right, -(-cells // rows)))
