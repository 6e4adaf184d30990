import datetime

from pyspark.sql import functions as F

from conftest import rows
from rillflow.operators import logs
from rillflow.sources.logs import bad_lines, good_lines, parse_lines, parse_report, read_access_log

# Fixed value: the documented line of the format.
SAMPLE = '127.0.0.1 - - [01/Aug/1995:00:00:01 -0400] "GET /images/launch-logo.gif HTTP/1.0" 200 1839'
NO_PROTOCOL = 'h2 - - [02/Aug/1995:13:05:09 -0400] "GET /x" 404 -'
TRAILING = 'h3 - u [03/Aug/1995:23:59:59 +0000] "POST /y HTTP/1.1" 302 0 "agent"'
BAD = [
    'h4 - - [01/Foo/1995:00:00:01 -0400] "GET / HTTP/1.0" 200 1',
    'h5 - - [01/Aug/1995:00:00:01 -0400] "GET / HTTP/1.0" 200 1k',
    "free text",
    "",
    " " + SAMPLE,
    "a\nb",
    None,
]


def parsed(spark, lines):
    return parse_lines(spark.createDataFrame([(x,) for x in lines], "line string"))


def test_fields(spark):
    got = {r.host: r for r in good_lines(parsed(spark, [SAMPLE, NO_PROTOCOL, TRAILING])).collect()}
    first = got["127.0.0.1"]
    assert first.date_time == datetime.datetime(1995, 8, 1, 0, 0, 1)
    assert (first.method, first.endpoint, first.protocol) == ("GET", "/images/launch-logo.gif", "HTTP/1.0")
    assert (first.status, first.size, first.client_id, first.user_id) == (200, 1839, "-", "-")
    assert (got["h2"].protocol, got["h2"].size, got["h2"].status) == ("", 0, 404)
    assert got["h2"].date_time == datetime.datetime(1995, 8, 2, 13, 5, 9)
    assert (got["h3"].size, got["h3"].user_id, got["h3"].status) == (0, "u", 302)


def test_bad_lines_are_kept_apart(spark):
    both = parsed(spark, [SAMPLE, *BAD])
    assert {r.line for r in bad_lines(both).collect()} == set(BAD)
    assert rows(parse_report(both)) == [(len(BAD) + 1, 1, len(BAD))]
    assert all(r.host is None and r.status is None for r in both.filter("not ok").collect())


def test_wall_clock_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        line = 'h - - [02/Apr/1995:02:30:00 -0400] "GET / HTTP/1.0" 200 1'
        assert rows(good_lines(parsed(spark, [line])).selectExpr("cast(date_time as string)")) == [
            ("1995-04-02 02:30:00",)
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_text_scan(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join([SAMPLE, "junk"]) + "\n")
    assert rows(parse_report(read_access_log(spark, str(tmp_path)))) == [(2, 1, 1)]


def test_analyses(spark):
    def line(host, day, status, endpoint, size="10", hour="05"):
        return f'{host} - - [{day}/Aug/1995:{hour}:00:00 -0400] "GET {endpoint} HTTP/1.0" {status} {size}'

    data = (
        [line("a", "01", 200, "/x", "5")] * 11
        + [line("b", "01", 404, "/y", "-"), line("b", "31", 404, "/y"), line("c", "31", 404, "/z", hour="07")]
        + [line("c", "31", 500, "/x")]
    )
    good = good_lines(parsed(spark, data)).persist()
    assert rows(logs.size_stats(good)) == [(85 / 15, 0, 10)]
    assert rows(logs.status_counts(good)) == [(200, 11), (404, 3), (500, 1)]
    assert rows(logs.busy_hosts(good)) == [("a",)]
    assert [tuple(r) for r in logs.top_endpoints(good, 2).collect()] == [("/x", 12), ("/y", 2)]
    assert [tuple(r) for r in logs.top_failed_endpoints(good).collect()] == [("/y", 2), ("/x", 1), ("/z", 1)]
    assert rows(logs.unique_hosts(good)) == [(3,)]
    assert rows(logs.unique_hosts_approx(good)) == [(3,)]
    assert [tuple(r) for r in logs.daily_hosts(good).collect()] == [(1, 2), (31, 2)]
    assert [tuple(r) for r in logs.daily_requests_per_host(good).collect()] == [(1, 6), (31, 1)]
    assert rows(logs.row_count(logs.not_found(good))) == [(3,)]
    assert [r[0] for r in logs.not_found_endpoints(good).collect()] == ["/y", "/z"]
    assert [tuple(r) for r in logs.not_found_top_endpoints(good, 1).collect()] == [("/y", 2)]
    assert [tuple(r) for r in logs.not_found_top_hosts(good).collect()] == [("b", 2), ("c", 1)]
    assert [tuple(r) for r in logs.not_found_by_day(good).collect()] == [(1, 1), (31, 2)]
    assert [tuple(r) for r in logs.not_found_top_days(good, 1).collect()] == [(31, 2)]
    assert [tuple(r) for r in logs.not_found_by_hour(good).collect()] == [(5, 2), (7, 1)]
    good.unpersist()


def test_pattern_runs_once_and_filter_reads_a_finished_column(spark):
    plan = logs.not_found_top_hosts(good_lines(parsed(spark, [SAMPLE])))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("regexp_replace") == 1
    assert "TakeOrderedAndProject" in text


def test_sketches_of_days_add_up(spark):
    lines = [(f"h{i % 3000}", datetime.datetime(2024, 1, 1 + i % 10)) for i in range(9000)]
    rows = spark.createDataFrame(lines, "host string, date_time timestamp_ntz")
    sketches = logs.daily_host_sketches(rows)
    exact = {d: len({h for h, t in lines if t.day == d}) for d in range(1, 11)}
    about = {r.day: r.n_hosts for r in logs.hosts_of_sketches(sketches, day=F.col("day")).collect()}
    assert about.keys() == exact.keys()
    assert all(abs(about[d] - exact[d]) <= 0.05 * exact[d] for d in exact)
    assert abs(logs.hosts_of_sketches(sketches).first().n_hosts - 3000) <= 150
    assert logs.hosts_of_sketches(sketches.filter("day = 99"), day=F.col("day")).collect() == []
