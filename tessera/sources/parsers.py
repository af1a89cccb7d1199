"""Line parsers: text lines in, typed columns out.

Each parser is a plain projection (no shuffle), so it works on batch and
streaming DataFrames alike. Failed lines are kept and flagged rather than
raising, so one bad line never fails a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.logs import (
    ACCESS_LOG_PATTERN,
    ACCESS_LOG_PATTERN_ORIGINAL,
    parse_apache_time,
)
from tessera.functions.text import remove_quotes

# Record patterns of the product and gold-mapping files, and
# the first field that marks each file's header line.
DATAFILE_PATTERN = r'^(.+),"(.+)",(.*),(.*),(.*)'
GOLDFILE_PATTERN = r"^(.+),(.+)"
DATAFILE_HEADER_FIELD = '"id"'
GOLDFILE_HEADER_FIELD = '"idAmazon"'

GROUP_SEP = "\n\n"

ACCESS_LOG_COLUMNS = (
    "host", "client_identd", "user_id", "date_time", "method", "endpoint",
    "protocol", "response_code", "content_size",
)


def parse_access_log(
    df: DataFrame, col: str = "value", pattern: str = ACCESS_LOG_PATTERN
) -> DataFrame:
    """Common Log Format line -> 9 typed columns plus ``parse_ok``.

    ``content_size`` ``-`` is 0; the zone of the time stamp is ignored.
    Columns of failed lines are NULL; the line itself stays in ``col``.
    """
    line = F.col(col)
    ok = F.coalesce(line.rlike(pattern), F.lit(False))
    # One regex pass for all nine groups: the match (extended with ``.*`` to
    # the end of the value, which cannot change how the groups match) is
    # rewritten to the groups joined by a separator that no group can hold
    # (eight groups have no whitespace, the time group exactly one
    # whitespace character), then split. The split is its own projection so
    # it is computed once per line, not once per output column (expressions
    # used only inside conditional branches are not shared by codegen).
    packed = F.regexp_replace(line, "(?s)" + pattern + ".*", GROUP_SEP.join(f"${i}" for i in range(1, 10)))
    staged = df.select("*", ok.alias("_ok"), F.when(ok, F.split(packed, GROUP_SEP)).alias("_parts"))

    def group(i: int) -> Column:
        return F.get(F.col("_parts"), i - 1)

    size = group(9)
    return staged.select(
        *[F.col(c) for c in df.columns],
        group(1).alias("host"),
        group(2).alias("client_identd"),
        group(3).alias("user_id"),
        parse_apache_time(group(4)).alias("date_time"),
        group(5).alias("method"),
        group(6).alias("endpoint"),
        group(7).alias("protocol"),
        group(8).cast("int").alias("response_code"),
        F.when(size == "-", F.lit(0).cast("bigint"))
        .otherwise(size.try_cast("bigint"))
        .alias("content_size"),
        F.col("_ok").alias("parse_ok"),
    )


def split_valid_failed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(access, failed): parsed lines split on ``parse_ok`` (narrow filters)."""
    return parsed.where(F.col("parse_ok")), parsed.where(~F.col("parse_ok"))


def parse_counts(parsed: DataFrame) -> DataFrame:
    """One row: n_parsed (all lines), n_access (ok), n_failed, in one pass."""
    return parsed.agg(
        F.count(F.lit(1)).alias("n_parsed"),
        F.count_if(F.col("parse_ok")).alias("n_access"),
        F.count_if(~F.col("parse_ok")).alias("n_failed"),
    )


def log_cleaning_report(df: DataFrame, col: str = "value") -> DataFrame:
    """One row comparing the original and the corrected log pattern.

    Each pattern is evaluated once per line (flags first, then counts).
    """
    line = F.col(col)
    flags = df.select(
        F.coalesce(line.rlike(ACCESS_LOG_PATTERN_ORIGINAL), F.lit(False)).alias("_o"),
        F.coalesce(line.rlike(ACCESS_LOG_PATTERN), F.lit(False)).alias("_c"),
    )
    return flags.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if("_o").alias("n_ok_original"),
        F.count_if(~F.col("_o")).alias("n_failed_original"),
        F.count_if("_c").alias("n_ok_corrected"),
        F.count_if(~F.col("_c")).alias("n_failed_corrected"),
    )


def _staged_groups(df: DataFrame, col: str, pattern: str, groups: int) -> DataFrame:
    """(_m, _g1.._gN): the match flag and each group, each regex evaluated
    once per line in its own projection (so later conditional uses share
    it); a group of a non-matching line is ''."""
    line = F.col(col)
    return df.select(
        F.coalesce(line.rlike(pattern), F.lit(False)).alias("_m"),
        *[F.regexp_extract(line, pattern, i).alias(f"_g{i}") for i in range(1, groups + 1)],
    )


def parse_product_csv(df: DataFrame, col: str = "value") -> DataFrame:
    """``"id","title","description","manufacturer","price"`` lines.

    -> (id, value, parse_status): status 1 for a record, 0 for the header
    (first field ``"id"``), -1 for a line the pattern rejects. ``value`` is
    title, description and manufacturer joined by spaces; quotes are removed
    from the id only.
    """
    g = _staged_groups(df, col, DATAFILE_PATTERN, 4)
    status = F.when(~F.col("_m"), F.lit(-1)).when(F.col("_g1") == DATAFILE_HEADER_FIELD, F.lit(0)).otherwise(F.lit(1))
    staged = g.select("*", status.alias("parse_status"))
    is_record = F.col("parse_status") == 1
    return staged.select(
        F.when(is_record, remove_quotes("_g1")).alias("id"),
        F.when(is_record, F.concat_ws(" ", "_g2", "_g3", "_g4")).alias("value"),
        "parse_status",
    )


def parse_gold_csv(df: DataFrame, col: str = "value") -> DataFrame:
    """``"a_id","b_id"`` lines -> (a_id, b_id, parse_status); header is 0."""
    g = _staged_groups(df, col, GOLDFILE_PATTERN, 2)
    status = F.when(~F.col("_m"), F.lit(-1)).when(F.col("_g1") == GOLDFILE_HEADER_FIELD, F.lit(0)).otherwise(F.lit(1))
    staged = g.select("*", status.alias("parse_status"))
    is_record = F.col("parse_status") == 1
    return staged.select(
        F.when(is_record, remove_quotes("_g1")).alias("a_id"),
        F.when(is_record, remove_quotes("_g2")).alias("b_id"),
        "parse_status",
    )


def parse_ratings(df: DataFrame, col: str = "value") -> DataFrame:
    """``user::item::rating::timestamp`` -> (user_id, item_id, rating).

    Short or malformed lines give NULLs (``get`` and ``try_cast`` never
    raise), so one bad line cannot fail the job."""
    parts = F.split(F.col(col), "::")
    return df.select(
        F.get(parts, 0).try_cast("bigint").alias("user_id"),
        F.get(parts, 1).try_cast("bigint").alias("item_id"),
        F.get(parts, 2).try_cast("double").alias("rating"),
    )


def parse_movies(df: DataFrame, col: str = "value") -> DataFrame:
    """``id::title::genres`` -> (item_id, title)."""
    parts = F.split(F.col(col), "::")
    return df.select(
        F.get(parts, 0).try_cast("bigint").alias("item_id"),
        F.get(parts, 1).alias("title"),
    )


def load_stopwords(df: DataFrame, col: str = "value") -> DataFrame:
    """Distinct non-empty words of a one-word-per-line source, as ``token``."""
    return df.select(F.trim(F.col(col)).alias("token")).where(F.col("token") != "").distinct()
