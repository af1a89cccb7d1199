"""Streaming log reports equal their batch counterparts."""

import tempfile

from tessera.operators import weblog as wl
from tessera.sources import fixtures as fx
from tessera.sources.parsers import parse_access_log, split_valid_failed
from tessera.sources.tables import Tables
from tessera.streaming.logs import access_stream, log_line_stream, start_report


def test_stream_matches_batch(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    lines = fx.clf_lines(t.events).select("value")
    src = tempfile.mkdtemp(prefix="tessera-stream-src-")
    lines.repartition(3).write.mode("overwrite").text(src + "/part")
    access = access_stream(log_line_stream(spark, src + "/part", max_files_per_trigger=1))
    q = start_report(access, "response_code_counts", "codes_stream", "memory")
    q.awaitTermination(120)
    got = {r.response_code: r["count"] for r in spark.sql("SELECT * FROM codes_stream").collect()}
    batch = split_valid_failed(parse_access_log(lines))[0]
    expected = {r.response_code: r["count"] for r in wl.response_code_counts(batch).collect()}
    assert got == expected

    q2 = start_report(access, "not_found_by_hour", "hours_stream", "memory")
    q2.awaitTermination(120)
    got2 = {r.hour: r["count"] for r in spark.sql("SELECT * FROM hours_stream").collect()}
    expected2 = {r.hour: r["count"] for r in wl.not_found_by_hour(batch).collect()}
    assert got2 == expected2


def test_restart_resumes_from_checkpoint(spark):
    """A second start of the same named report reads only new files."""
    import os

    t = Tables(spark, "/root/testdata/sf0.001")
    lines = fx.clf_lines(t.events).select("value")
    src = tempfile.mkdtemp(prefix="tessera-stream-src-")
    ckpt = tempfile.mkdtemp(prefix="tessera-stream-ckpt-")
    lines.limit(100).write.text(os.path.join(src, "b1"))
    access = access_stream(log_line_stream(spark, src + "/*"))
    q = start_report(access, "response_code_counts", "resume_stream", "memory", checkpoint=ckpt)
    q.awaitTermination(120)
    first = sum(r["count"] for r in spark.sql("SELECT * FROM resume_stream").collect())
    lines.limit(50).write.text(os.path.join(src, "b2"))
    q2 = start_report(access_stream(log_line_stream(spark, src + "/*")), "response_code_counts",
                      "resume_stream2", "memory", checkpoint=ckpt)
    q2.awaitTermination(120)
    second = sum(r["count"] for r in spark.sql("SELECT * FROM resume_stream2").collect())
    assert first > 0 and second == first + 50 - sum(1 for r in lines.limit(50).collect() if r.value.startswith("junk"))
