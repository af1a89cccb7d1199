"""Access-log parsing and reports."""

import datetime

from pyspark.sql import functions as F

from tessera.functions.logs import ACCESS_LOG_PATTERN_ORIGINAL
from tessera.operators import weblog as wl
from tessera.sources import fixtures as fx
from tessera.sources.parsers import log_cleaning_report, parse_access_log, parse_counts, split_valid_failed
from tessera.sources.tables import Tables

LINE = '127.0.0.1 - - [01/Aug/1995:00:00:01 -0400] "GET /images/launch-logo.gif HTTP/1.0" 200 1839'
TRAILING = 'h2 - - [02/Aug/1995:13:05:00 -0400] "GET /a.html HTTP/1.0 " 404 -'
JUNK = "not a log line"


def lines(spark, *ls):
    return spark.createDataFrame([(x,) for x in ls], "value string")


def test_parse_sample_line(spark):
    r = parse_access_log(lines(spark, LINE)).first()
    assert r.parse_ok
    assert (r.host, r.client_identd, r.user_id) == ("127.0.0.1", "-", "-")
    assert r.date_time == datetime.datetime(1995, 8, 1, 0, 0, 1)
    assert (r.method, r.endpoint, r.protocol) == ("GET", "/images/launch-logo.gif", "HTTP/1.0")
    assert (r.response_code, r.content_size) == (200, 1839)


def test_trailing_space_needs_corrected_pattern(spark):
    df = lines(spark, TRAILING)
    assert not parse_access_log(df, pattern=ACCESS_LOG_PATTERN_ORIGINAL).first().parse_ok
    r = parse_access_log(df).first()
    assert r.parse_ok and r.content_size == 0 and r.response_code == 404 and r.protocol == "HTTP/1.0"


def test_split_counts_invariant(spark):
    parsed = parse_access_log(lines(spark, LINE, TRAILING, JUNK))
    access, failed = split_valid_failed(parsed)
    c = parse_counts(parsed).first()
    assert (c.n_parsed, c.n_access, c.n_failed) == (3, 2, 1)
    assert access.count() + failed.count() == c.n_parsed
    rep = log_cleaning_report(lines(spark, LINE, TRAILING, JUNK)).first()
    assert (rep.n_ok_original, rep.n_ok_corrected, rep.n_failed_corrected) == (1, 2, 1)


def test_reports_on_literals(spark):
    access = split_valid_failed(parse_access_log(lines(spark, LINE, LINE, TRAILING)))[0]
    assert wl.content_size_stats(access).first().asDict() == {"avg_size": 1226, "min_size": 0, "max_size": 1839}
    assert {r.response_code: r["count"] for r in wl.response_code_counts(access).collect()} == {200: 2, 404: 1}
    fr = {r.response_code: round(r.fraction, 4) for r in wl.response_code_fractions(access).collect()}
    assert fr == {200: 0.6667, 404: 0.3333}
    assert wl.unique_hosts(access).first().unique_hosts == 2
    assert [tuple(r) for r in wl.daily_requests_per_host(access).collect()] == [(1, 2), (2, 1)]
    assert [tuple(r) for r in wl.not_found_by_hour(access).collect()] == [(13, 1)]
    assert [r.endpoint for r in wl.top_error_endpoints(access).collect()] == ["/a.html"]
    assert wl.frequent_hosts(access, 1).collect()[0].host == "127.0.0.1"


def test_clf_fixture_counts(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    rep = log_cleaning_report(fx.clf_lines(t.events)).first()
    events = t.events.count()
    junk = t.events.where(F.col("event_id") % 97 == 0).count()
    assert rep.n_lines == events + junk
    assert rep.n_ok_corrected == events
    assert rep.n_ok_original == t.events.where(F.col("event_id") % 7 != 0).count()


def test_time_parse_ignores_session_zone(spark):
    """A wall-clock time inside a DST gap of the session zone is kept as is."""
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        line = 'h - - [10/Mar/2024:02:30:00 -0400] "GET / HTTP/1.0" 200 1'
        r = parse_access_log(lines(spark, line)).first()
        assert r.date_time == datetime.datetime(2024, 3, 10, 2, 30, 0)
        bad = 'h - - [31/Feb/2024:02:30:00 -0400] "GET / HTTP/1.0" 200 1'
        assert parse_access_log(lines(spark, bad)).first().date_time is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_parse_apache_time_in_any_zone(spark):
    """A wall time in the gap of a zone's clock change stays as written."""
    from datetime import datetime

    from tessera.functions.logs import parse_apache_time

    df = spark.createDataFrame([("12/Mar/2023:02:30:00 -0400",), ("31/Dec/1999:23:59:59 -0400",), ("99/Mar/2023:02:30:00",), ("",), (None,), ("1/Mar/2023:02:30:00 x",)], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(parse_apache_time("t").alias("x")).collect()]
            assert got == [datetime(2023, 3, 12, 2, 30), datetime(1999, 12, 31, 23, 59, 59), None, None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
