"""WARC not-modified revisits: an as-of join by canonical URL to the latest earlier full response, a check of the validators, and the
response's headers updated by those that a 304 may change."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import pick

# ---- fixed values: names from the HTTP caching rules and common tracking parameters -------------------------------
NOT_UPDATED = ("connection content-encoding content-length content-location content-range content-type keep-alive proxy-authenticate "
               "proxy-authorization proxy-connection te trailer transfer-encoding upgrade").split()
TRACKING = "^(utm_[a-z]+|fbclid|gclid|ref|sessionid|sid|phpsessid|jsessionid)$"
# -------------------------------------------------------------------------------------------------------------------
HEADERS = "array<struct<name:string,value:string>>"
BUCKET = 3600                  # seconds; one URL's captures are cut into such pieces


def canonical(url: Column) -> Column:
    """Host without user, www. and default port, lower-cased, path without a last slash, and the sorted query without tracking
    parameters; no scheme and fragment.  Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(url, r"(?s)#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    parts = F.split(F.regexp_extract(bare, r"(?s)\?(.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(parts, lambda p: (p != "") & ~F.lower(F.regexp_extract(p, "^[^=]*", 0)).rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def header(headers: Column, name: str) -> Column:
    """First value of a header, null if there is none."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def merged(stored: Column, fresh: Column) -> Column:
    """Stored headers, those that the 304 repeats replaced, sorted by lower-case name and value."""
    allowed = F.filter(fresh, lambda h: ~F.lower(h["name"]).isin(NOT_UPDATED))
    names = F.transform(allowed, lambda h: F.lower(h["name"]))
    kept = F.filter(stored, lambda h: ~F.array_contains(names, F.lower(h["name"])))
    return F.array_sort(F.transform(F.concat(kept, allowed), lambda h: F.struct(F.lower(h["name"]).alias("name"), h["value"].alias("value"))))


def resolve_revisits(records: DataFrame, id_col: str = "record_id", url_col: str = "url", ts_col: str = "ts", kind_col: str = "kind",
                     headers_col: str = "headers", bucket: int = BUCKET) -> DataFrame:
    """One row per revisit record: record_id, canon_url, target_id, state, headers.

    records: id, url, time, kind (response or revisit), headers (array of struct(name, value)).  target_id is the latest response
    of the same canonical URL strictly earlier, the largest id of those at one time.  state: ``resolved`` if the entity tags are
    equal (weakly) or, where one side has none, the modification dates; ``changed`` if they differ; ``unchecked`` if there is
    nothing to compare; ``orphan`` without an earlier response.  headers are merged when resolved, else the revisit's own.
    A null url or time is an orphan; null headers are none; other kinds are left out; repeated rows stay; an empty table gives
    an empty result; other columns are dropped.

    The captures of one URL, which may be a third of all, are cut by time: a window inside each piece, and the last response of
    earlier pieces from a table with a row per URL and piece.
    """
    rows = (pick(records, record_id=id_col, url=url_col, ts=ts_col, kind=kind_col, headers=headers_col)
            .withColumn("headers", F.coalesce(F.col("headers").cast(HEADERS), F.array().cast(HEADERS)))
            .select("record_id", canonical(F.col("url")).alias("canon_url"), F.unix_micros("ts").alias("us"), "kind", "headers")
            .where(F.col("kind").isin("response", "revisit"))
            .withColumn("piece", F.floor(F.col("us") / F.lit(bucket * 1_000_000))))
    full = F.when((F.col("kind") == "response") & F.col("us").isNotNull(), F.struct("us", "record_id", "headers"))
    earlier = Window.partitionBy("canon_url", "piece").orderBy("us").rangeBetween(Window.unboundedPreceding, -1)
    # rows without a url or a time are orphans by definition: they stay out of the windows, where they would be one group
    placed = F.col("canon_url").isNotNull() & F.col("us").isNotNull()
    lost = rows.where((F.col("kind") == "revisit") & ~placed)
    inside = rows.where(placed).withColumn("near", F.max(full).over(earlier)).where("kind = 'revisit'")
    ends = rows.where("kind = 'response' and us is not null and canon_url is not null").groupBy("canon_url", "piece").agg(F.max(full).alias("last"))
    # A revisit needs the piece's own carry even if the piece has no response, so revisit pieces enter with a null
    pieces = ends.unionByName(inside.select("canon_url", "piece").distinct()
                              .withColumn("last", F.lit(None).cast(ends.schema["last"].dataType)))
    before = Window.partitionBy("canon_url").orderBy("piece").rangeBetween(Window.unboundedPreceding, -1)
    carry = (pieces.groupBy("canon_url", "piece").agg(F.max("last").alias("last")).withColumn("carry", F.max("last").over(before))
             .select("canon_url", "piece", "carry"))
    own = ["record_id", "canon_url", "headers"]
    found = inside.join(carry, ["canon_url", "piece"], "left").select(*own, F.coalesce("near", "carry").alias("hit"))
    found = found.unionByName(lost.select(*own, F.lit(None).cast(found.schema["hit"].dataType).alias("hit")))
    stored = F.col("hit.headers")
    tag = [F.regexp_replace(header(h, "etag"), "^W/", "") for h in (F.col("headers"), stored)]
    date = [header(h, "last-modified") for h in (F.col("headers"), stored)]
    same = F.coalesce(tag[0] == tag[1], date[0] == date[1])
    state = (F.when(F.col("hit").isNull(), "orphan").when(same, "resolved").when(~same, "changed").otherwise("unchecked"))
    return (found.withColumn("state", state)
            .select("record_id", "canon_url", F.col("hit.record_id").alias("target_id"), "state",
                    F.when(F.col("state") == "resolved", merged(stored, F.col("headers"))).otherwise(merged(F.array().cast(HEADERS), F.col("headers"))).alias("headers")))


# ---- captures derived from ``pages``: a response and two revisits each --------------------------------------------

START = 1_700_000_000


def captures(pages: DataFrame) -> DataFrame:
    """record_id, url, ts, kind, headers.  The first revisit comes hours after its page's response, with another tag for every
    seventh page and with a date only for every fifth; the second comes half an hour before it."""
    at = START + (F.col("page_id") * 7919) % 2_592_000
    tag, day = F.md5(F.col("html").cast("binary")), (F.col("page_id") % 400).cast("string")

    def fields(**named: Column) -> Column:
        return F.array(*(F.struct(F.lit(n.replace("_", "-")).alias("name"), v.alias("value")) for n, v in named.items()))

    age = F.concat(F.lit("max-age="), (F.col("page_id") % 100).cast("string"))
    response = fields(Content_Type=F.lit("text/html"), Content_Length=F.octet_length("html").cast("string"), ETag=tag, Last_Modified=day, Server=F.lit("s1"))
    dated = fields(Last_Modified=day, Cache_Control=age, Content_Length=F.lit("0"))
    tagged = fields(ETag=F.when(F.col("page_id") % 7 == 0, F.lit("other")).otherwise(F.concat(F.lit("W/"), tag)), Cache_Control=age, Content_Length=F.lit("0"))
    later = F.when(F.col("page_id") % 5 == 0, dated).otherwise(tagged)
    def record(k: int, time: Column, kind: str, headers: Column) -> Column:
        return F.struct(F.lit(k).alias("k"), time.alias("at"), F.lit(kind).alias("kind"), headers.cast(HEADERS).alias("headers"))

    parts = F.array(record(0, at, "response", response), record(1, at + 3600 * (1 + F.col("page_id") % 5), "revisit", later),
                    record(2, at - 1800, "revisit", dated))
    return (pages.select("page_id", "url", F.explode(parts).alias("p"))
            .select((F.col("page_id") * 3 + F.col("p.k")).alias("record_id"), "url", F.timestamp_seconds("p.at").alias("ts"), "p.kind", "p.headers"))


def query(spark, sf_dir: str) -> DataFrame:
    out = resolve_revisits(captures(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")))
    lines = F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"]))
    return out.select("record_id", "canon_url", "target_id", "state", F.array_join(lines, "\n").alias("headers"))


def sql() -> str:
    return rf"""
WITH p AS (SELECT page_id, url, {START} + (page_id * 7919) % 2592000 AS sec, md5(html) AS tag, (page_id % 400)::VARCHAR AS day,
  'max-age=' || (page_id % 100) AS age, strlen(html)::VARCHAR AS size,
  regexp_replace(regexp_replace(url, '#.*$', '', 's'), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
c AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^.*@', ''), '^www\.|:(80|443)$', '', 'g')
    || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1, 's'), '/+$', '') AS head,
  array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1, 's'), '&'),
    lambda x: x <> '' AND NOT regexp_matches(lower(regexp_extract(x, '^[^=]*')), '{TRACKING}'))), '&') AS query FROM p),
u AS (SELECT *, head || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canon_url FROM c),
responses AS (SELECT canon_url, sec, page_id * 3 AS target_id, tag, day, size FROM u),
revisits AS (SELECT page_id * 3 + 1 AS record_id, canon_url, sec + 3600 * (1 + page_id % 5) AS sec, age,
    CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN 'other' ELSE tag END AS tag,
    CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN 'other' ELSE 'W/' || tag END AS shown, CASE WHEN page_id % 5 = 0 THEN day END AS day FROM u
  UNION ALL SELECT page_id * 3 + 2, canon_url, sec - 1800, age, NULL, NULL, day FROM u),
hits AS (SELECT v.record_id, max({{'sec': r.sec, 'target_id': r.target_id, 'tag': r.tag, 'day': r.day, 'size': r.size}}) AS hit
  FROM revisits v JOIN responses r ON r.canon_url = v.canon_url AND r.sec < v.sec GROUP BY v.record_id),
j AS (SELECT v.*, h.hit, CASE WHEN h.hit IS NULL THEN 'orphan' WHEN coalesce(v.tag = h.hit.tag, v.day = h.hit.day) THEN 'resolved'
  WHEN NOT coalesce(v.tag = h.hit.tag, v.day = h.hit.day) THEN 'changed' ELSE 'unchecked' END AS state FROM revisits v LEFT JOIN hits h USING (record_id)),
own AS (SELECT *, list_filter(['cache-control: ' || age, 'etag: ' || shown, 'last-modified: ' || day], lambda x: x IS NOT NULL) AS fresh FROM j)
SELECT record_id, canon_url, hit.target_id AS target_id, state, array_to_string(list_sort(CASE WHEN state = 'resolved' THEN list_concat(fresh,
  list_filter(['content-type: text/html', 'content-length: ' || hit.size, CASE WHEN shown IS NULL THEN 'etag: ' || hit.tag END,
    CASE WHEN day IS NULL THEN 'last-modified: ' || hit.day END, 'server: s1'], lambda x: x IS NOT NULL)) ELSE fresh END), chr(10)) AS headers
FROM own"""
