"""Small relational building blocks: projections, filters, grouping, sorts
and set operations, each a thin layer of DataFrame calls with a fixed,
deterministic output (total-order tie-breaks everywhere a limit is taken).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.plans.joins import lookup_join
from tessera.sources.text import numbered_lines


def filter_modulo(df: DataFrame, col: str, m: int, r: int = 0) -> DataFrame:
    """Rows whose ``col % m == r`` (e.g. multiples of 7)."""
    return df.where(F.col(col) % m == r)


def sum_all(df: DataFrame, col: str, alias: str = "total") -> DataFrame:
    """One row: the sum of a column (bigint sums stay bigint)."""
    return df.agg(F.sum(col).alias(alias))


def count_rows(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def filter_min_count(counts: DataFrame, threshold: int, col: str = "count") -> DataFrame:
    """Groups with more than ``threshold`` rows (HAVING n > threshold)."""
    return counts.where(F.col(col) > threshold)


def group_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """The values of every key as a multiset: (key, value, multiplicity).

    This is the ``groupByKey`` result in long form. It never gathers a
    group into one list (a hot key would put a third of the data into one
    row of one task); each (key, value) count is partially aggregated.
    """
    return df.groupBy(key, value).agg(F.count(F.lit(1)).alias("multiplicity"))


def value_lists(df: DataFrame, key: str, value: str, size: int = 10_000) -> DataFrame:
    """(key, segment, values): the sorted values of every key in lists of
    ``size`` (the last of a key may be shorter), segments from 0. Joined in
    order they are the key's whole list.

    Rows are numbered in the order of key and value by ranges, so a hot key's
    values lie in many tasks; a row's segment follows from its number and the
    key's first. Rows with a null value are left out, a null key is a key."""
    rows = numbered_lines(df.where(F.col(value).isNotNull()).select(key, value), [key, value])
    keyed = rows.withColumn("_key", F.struct(key))
    first = keyed.groupBy("_key").agg(F.min("line_index").alias("_first"))
    segment = F.floor((F.col("line_index") - F.col("_first")) / size).cast("bigint")
    cut = lookup_join(keyed, first, "_key").select(key, value, segment.alias("segment"))
    return cut.groupBy(key, "segment").agg(F.sort_array(F.collect_list(value)).alias("values"))


def group_count_values(df: DataFrame, key: str, alias: str = "count") -> DataFrame:
    """(key, number of rows)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def lookup_pair(df: DataFrame, a_col: str, a_value, b_col: str, b_value) -> DataFrame:
    """Rows of one (a, b) pair."""
    return df.where((F.col(a_col) == a_value) & (F.col(b_col) == b_value))


def exact_match_count(df: DataFrame, col: str, value, alias: str = "n") -> DataFrame:
    """One row: how many rows have ``col == value``."""
    return df.where(F.col(col) == value).agg(F.count(F.lit(1)).alias(alias))


def sort_by_key(df: DataFrame, keys: Sequence[str], ascending: bool = True) -> DataFrame:
    cols: list[Column] = [F.asc(k) if ascending else F.desc(k) for k in keys]
    return df.orderBy(*cols)


def stable_sort(
    df: DataFrame, key: str, value: str, ascending: bool = True, digits: int = 3, ids: Sequence[str] = ()
) -> DataFrame:
    """Order by the key rounded to ``digits``, then the value, then ``ids``
    (columns that tell rows of equal value apart), so that equal keys always
    come out in the same order."""
    by = [F.round(F.col(key), digits), F.col(value), *[F.col(c) for c in ids]]
    return df.orderBy(*[c.asc() if ascending else c.desc() for c in by])


def sample_take(df: DataFrame, k: int, order: Sequence[str]) -> DataFrame:
    """k rows, chosen deterministically by a total order on ``order``."""
    return df.orderBy(*order).limit(k)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def project_field(df: DataFrame, *cols: str, **renamed: str) -> DataFrame:
    """Pick fields (``cols``) and renamed fields (``new=old``)."""
    return df.select(*cols, *[F.col(old).alias(new) for new, old in renamed.items()])


def join_on_key(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join on key column(s); the physical join (broadcast only when a
    side was measured small, else a shuffled join) is left to AQE."""
    return left.join(right, on, how)


def exact_title(movies: DataFrame, title: str, alias: str = "n") -> DataFrame:
    """One row: the number of items with exactly this title."""
    return exact_match_count(movies, "title", title, alias)


def distinct_ids(df: DataFrame, col: str = "id") -> DataFrame:
    return distinct_rows(df, [col])
