"""Access-log reports over a stream of log files (Structured Streaming).

The parsers are plain projections, so the same ``parse_access_log`` runs on
a streaming DataFrame. Reports whose keys are bounded (response codes, hour
of day, day of month) keep bounded state and run in ``complete`` mode; the
query's state and progress live under the shared checkpoint folder, so a
restarted or re-scheduled query continues where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators import weblog as wl
from tessera.session import checkpoint_dir
from tessera.sources.parsers import parse_access_log, split_valid_failed

# Reports that are valid streaming aggregations (bounded keys).
STREAM_REPORTS = {
    "response_code_counts": wl.response_code_counts,
    "not_found_by_hour": lambda a: wl.not_found(a).groupBy(wl.hour_of_day("date_time").alias("hour")).agg(
        F.count(F.lit(1)).alias("count")
    ),
    "not_found_by_day": lambda a: wl.not_found(a).groupBy(wl.day_of_month("date_time").alias("day")).agg(
        F.count(F.lit(1)).alias("count")
    ),
}


def log_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files that appear under ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def access_stream(lines: DataFrame) -> DataFrame:
    """Parsed, valid log lines of a line stream."""
    return split_valid_failed(parse_access_log(lines))[0]


def start_report(
    access: DataFrame,
    report: str,
    name: str,
    sink: str,
    options: dict[str, str] | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a streaming report into ``sink``, a format of the caller's choice
    that takes ``complete`` output; ``options`` are the sink's. The ``memory``
    sink keeps its table on the driver; the reports here have at most a
    thousand keys (codes, hours, days).

    The checkpoint defaults to ``<spark.checkpoint.dir>/streams/<name>`` (the
    shared folder), so starting the same named report again resumes from its
    committed offsets and state instead of re-reading everything.
    """
    location = checkpoint or os.path.join(checkpoint_dir(access.sparkSession), "streams", name)
    writer = (
        STREAM_REPORTS[report](access)
        .writeStream.outputMode("complete")
        .format(sink)
        .queryName(name)
        .options(**(options or {}))
        .option("checkpointLocation", location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
