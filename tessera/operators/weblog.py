"""Web-server access-log reports.

Input: the ``access`` DataFrame of ``parse_access_log`` (parsed, ok lines).
Each report is one aggregation (one shuffle of at most a few columns);
Catalyst prunes the parse down to the columns the report reads. Counts that
the original computed by joining two aggregates of one source (requests and
distinct hosts per day) are computed here in a single aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.logs import day_of_month, hour_of_day


def _n() -> F.Column:
    return F.count(F.lit(1))


def content_size_stats(access: DataFrame) -> DataFrame:
    """One row: integer average, min and max of content_size."""
    return access.agg(
        F.expr("sum(content_size) div count(1)").alias("avg_size"),
        F.min("content_size").alias("min_size"),
        F.max("content_size").alias("max_size"),
    )


def response_code_counts(access: DataFrame) -> DataFrame:
    """(response_code, count)."""
    return access.groupBy("response_code").agg(_n().alias("count"))


def response_code_fractions(access: DataFrame) -> DataFrame:
    """(response_code, count, fraction of all requests).

    The total is the sum of the counts, over the rows of the result (a log
    has a thousand three-digit codes at most): the log is read once.
    """
    counts = response_code_counts(access)
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("fraction", F.col("count") / total)


def host_counts(access: DataFrame) -> DataFrame:
    return access.groupBy("host").agg(_n().alias("count"))


def frequent_hosts(access: DataFrame, min_hits: int = 10) -> DataFrame:
    """(host, count) for hosts with more than ``min_hits`` requests."""
    return host_counts(access).where(F.col("count") > min_hits)


def endpoint_counts(access: DataFrame) -> DataFrame:
    """(endpoint, count)."""
    return access.groupBy("endpoint").agg(_n().alias("count"))


def top_endpoints(access: DataFrame, k: int = 10) -> DataFrame:
    return endpoint_counts(access).orderBy(F.desc("count"), F.asc("endpoint")).limit(k)


def error_endpoint_counts(access: DataFrame) -> DataFrame:
    """(endpoint, count) of requests whose code is not 200."""
    return endpoint_counts(filter_status_ne(access, 200))


def top_error_endpoints(access: DataFrame, k: int = 10) -> DataFrame:
    return error_endpoint_counts(access).orderBy(F.desc("count"), F.asc("endpoint")).limit(k)


def unique_hosts(access: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: the number of distinct hosts (exact by default)."""
    agg = F.approx_count_distinct("host") if approximate else F.count_distinct("host")
    return access.agg(agg.alias("unique_hosts"))


def host_sketches(access: DataFrame, precision: int = 12) -> DataFrame:
    """(day, requests, hosts): a distinct sketch of the hosts of every date, a
    few kilobytes whatever the traffic. Kept as a table, it answers for any
    range of days without the log; a new day is one more row."""
    return access.groupBy(F.to_date("date_time").alias("day")).agg(
        _n().alias("requests"), F.hll_sketch_agg("host", precision).alias("hosts")
    )


def hosts_of_days(sketches: DataFrame, first=None, last=None) -> DataFrame:
    """One row: ``unique_hosts`` (estimated; with 12 bits about 1.6 % off, and
    exact for few hosts) and ``requests`` of the days from ``first`` to ``last``."""
    if first is not None:
        sketches = sketches.where(F.col("day") >= first)
    if last is not None:
        sketches = sketches.where(F.col("day") <= last)
    return sketches.agg(
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("hosts")), F.lit(0)).alias("unique_hosts"), F.coalesce(F.sum("requests"), F.lit(0)).alias("requests")
    )


def distinct_day_host(access: DataFrame) -> DataFrame:
    """Distinct (day, host) pairs, day = day of month."""
    return access.select(day_of_month("date_time").alias("day"), "host").distinct()


def daily_unique_hosts(access: DataFrame, by_date: bool = False) -> DataFrame:
    """(day, unique_hosts) sorted by day: the day of the month, or the date
    (``by_date``) where a log spans more than one month."""
    day = F.to_date("date_time") if by_date else day_of_month("date_time")
    return (
        access.groupBy(day.alias("day"))
        .agg(F.count_distinct("host").alias("unique_hosts"))
        .orderBy("day")
    )


def daily_requests_per_host(access: DataFrame, by_date: bool = False) -> DataFrame:
    """(day, avg_requests): requests div distinct hosts, per day (or date),
    sorted. One aggregation pass instead of a join of two aggregates.
    """
    day = F.to_date("date_time") if by_date else day_of_month("date_time")
    return (
        access.groupBy(day.alias("day"))
        .agg(F.expr("count(1) div count(DISTINCT host)").alias("avg_requests"))
        .orderBy("day")
    )


def filter_status_ne(access: DataFrame, code: int = 200) -> DataFrame:
    """Requests whose response code is not ``code``."""
    return access.where(F.col("response_code") != code)


def filter_status_eq(access: DataFrame, code: int = 404) -> DataFrame:
    """Requests whose response code is ``code``."""
    return access.where(F.col("response_code") == code)


def not_found(access: DataFrame) -> DataFrame:
    return filter_status_eq(access, 404)


def not_found_count(access: DataFrame) -> DataFrame:
    return not_found(access).agg(_n().alias("not_found"))


def distinct_not_found_endpoints(access: DataFrame) -> DataFrame:
    return not_found(access).select("endpoint").distinct()


def top_not_found_endpoints(access: DataFrame, k: int = 20) -> DataFrame:
    return (
        endpoint_counts(not_found(access))
        .orderBy(F.desc("count"), F.asc("endpoint"))
        .limit(k)
    )


def top_not_found_hosts(access: DataFrame, k: int = 25) -> DataFrame:
    return host_counts(not_found(access)).orderBy(F.desc("count"), F.asc("host")).limit(k)


def not_found_by_day(access: DataFrame) -> DataFrame:
    """(day, count) of 404s, sorted by day."""
    return (
        not_found(access)
        .groupBy(day_of_month("date_time").alias("day"))
        .agg(_n().alias("count"))
        .orderBy("day")
    )


def top_not_found_days(access: DataFrame, k: int = 5) -> DataFrame:
    return not_found_by_day(access).orderBy(F.desc("count"), F.asc("day")).limit(k)


def not_found_by_hour(access: DataFrame) -> DataFrame:
    """(hour, count) of 404s, sorted by hour (ascending)."""
    return (
        not_found(access)
        .groupBy(hour_of_day("date_time").alias("hour"))
        .agg(_n().alias("count"))
        .orderBy("hour")
    )
