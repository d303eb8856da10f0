import datetime as dt

from pyspark.sql import functions as F

from retail_analytics.llm.revisits import canonical, resolve_revisits

SCHEMA = "record_id long, url string, ts timestamp, kind string, headers array<struct<name:string,value:string>>, state string"


def at(h, s=0):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=h, seconds=s)


def test_canonical_urls(spark):
    urls = ["http://WWW.Example.com:80/a/?b=2&utm_source=x&a=1#f", "https://u:p@example.com/a?a=1&b=2", "example.com/a/?b=2&a=1&sid=9"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(canonical(F.col("url")).alias("c")).distinct().collect()
    assert [r.c for r in rows] == ["example.com/a?a=1&b=2"]


def test_states_ties_and_nulls(spark):
    r = lambda i, h, etag=None, lm=None, s=0, url="http://a.com/x", kind="response", **more: (
        i, url, None if h is None else at(h, s), kind, [(k, v) for k, v in (("ETag", etag), ("Last-Modified", lm), *more.items()) if v], None)
    rows = [r(1, 0, "e1", Server="s", Age="1"), r(2, 50, "e2"), r(3, 50, "e3"), r(4, 60, lm="d"),
            r(10, 1, 'W/e1', kind="revisit", Age="9", **{"Content-Length": "0"}), r(11, 0, "e1", kind="revisit"), r(12, 51, "e3", kind="revisit"),
            r(13, 51, "e2", kind="revisit"), r(14, 61, lm="d", kind="revisit"), r(15, 61, "e9", kind="revisit"), r(16, 2000, lm="z", kind="revisit"),
            r(17, None, "e1", kind="revisit"), r(18, 5, "e1", url=None, kind="revisit"), r(19, 5, "e1", url="https://www.a.com/x/#k", kind="revisit"),
            r(20, 0, "e1", s=1, kind="revisit"), r(20, 0, "e1", s=1, kind="revisit"), (21, "http://a.com/x", at(7), "revisit", None, None),
            (22, "http://a.com/x", at(7), None, None, None)]
    out = {}
    for x in resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect():
        out.setdefault(x.record_id, []).append((x.target_id, x.state, [tuple(h) for h in x.headers]))
    assert out[10] == [(1, "resolved", [("age", "9"), ("etag", "W/e1"), ("server", "s")])]
    assert out[11] == [(None, "orphan", [("etag", "e1")])]                     # a response at the same time is not earlier
    assert out[12][0][:2] == (3, "resolved") and out[13][0][:2] == (3, "changed")   # of two at one time the larger id
    assert out[14][0][:2] == (4, "resolved") and out[15][0][:2] == (4, "unchecked") and out[16][0][:2] == (4, "changed")
    assert out[17][0][1] == out[18][0][1] == "orphan" and out[19][0][:2] == (1, "resolved")
    assert [x[:2] for x in out[20]] == [(1, "resolved")] * 2 and out[21] == [(1, "unchecked", [])] and 22 not in out


def test_hot_url_against_a_loop(spark):
    rows = [(i, "http://hot.com/", at(i * 7 % 300, i % 5), "response" if i % 3 else "revisit", [("etag", "e")], None) for i in range(900)]
    got = {x.record_id: x.target_id for x in resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    full = [(r[2], r[0]) for r in rows if r[3] == "response"]
    assert got == {r[0]: max((f for f in full if f[0] < r[2]), default=(None, None))[1] for r in rows if r[3] == "revisit"}


def test_empty_table(spark):
    assert resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0
