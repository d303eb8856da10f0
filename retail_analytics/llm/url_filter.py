"""URL filter: a trie over reversed host labels and path segments; the longest matching rule decides."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pick

MAX_TRIE_RULES = 200_000          # a trie of at most so many rules is broadcast; larger sets are joined


def url_parts(url):
    """Columns (host, path) of a url column: host from the first ``://`` up to / ? # or end with A-Z lower-cased, path from
    there up to ? # or end.  A null url or one without ``://`` has both empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


class Trie:
    """Rules (host, path prefix, verdict).  Host labels are stored from the last one; below a host node the rule's whole path
    segments follow, and the rest after its last slash is a prefix of the next segment (empty: any)."""

    def __init__(self):
        self.root: dict = {}

    def add(self, host: str, path: str, verdict: str) -> None:
        node = self.root
        for label in reversed(host.split(".")):
            node = node.setdefault("hosts", {}).setdefault(label, {})
        *whole, part = path.split("/")
        for segment in whole:
            node = node.setdefault("paths", {}).setdefault(segment, {})
        ends = node.setdefault("ends", {})
        if ends.get(part, ("", ""))[1] != "block":
            ends[part] = (host + path, verdict)

    def longest(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The matching rule with the most characters; between equals the one with the longer host, then a block."""
        best, node, segments = (-1, -1, False, None, None), self.root, path.split("/")
        for depth, label in enumerate([None, *reversed(host.split("."))]):
            if label is not None:
                node = node.get("hosts", {}).get(label)
                if node is None:
                    break
            at = node
            for i, segment in enumerate(segments):
                for part, (rule, verdict) in at.get("ends", {}).items():
                    if segment.startswith(part):
                        best = max(best, (len(rule), depth, verdict == "block", rule, verdict), key=lambda x: x[:3])
                if i + 1 == len(segments) or (at := at.get("paths", {}).get(segment)) is None:
                    break
        return best[3], best[4]


def _rows(rules: Sequence[tuple[str, str]]) -> list[tuple[str, str, str]]:
    out = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        if verdict not in ("allow", "block") or not host or not slash:
            raise ValueError(f"a rule is (allow | block, host/path prefix): {(verdict, rule)}")
        out.append((host.lower(), slash + path, verdict))
    return out


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str]], default: str = "allow", id_col: str = "page_id", url_col: str = "url",
               max_trie_rules: int = MAX_TRIE_RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    rules: (verdict, ``host/path``), for example ("block", "net/").  A rule fits its host and all subdomains if the url's path
    starts with the rule's.  The longest rule wins, between equal lengths the longer host, then a block; without one the
    verdict is ``default`` and rule is null.  Null or odd urls have an empty host and path and get the default; repeated rows
    stay; an empty table gives an empty result; other columns are dropped.  Up to ``max_trie_rules`` rules travel as one
    broadcast trie, more are joined by host.
    """
    rows = _rows(rules)
    host, path = url_parts(F.col("url"))
    parts = pick(pages, page_id=id_col, url=url_col).select("page_id", host.alias("host"), path.alias("path"))
    if len(rows) > max_trie_rules:
        table = pages.sparkSession.createDataFrame(rows, "rule_host string, rule_path string, verdict string")
        return url_filter_join(parts, table, default)
    trie = Trie()
    for r in rows:
        trie.add(*r)
    shared = pages.sparkSession.sparkContext.broadcast(trie.root)
    schema = parts.select("*", F.lit("").alias("rule"), F.lit("").alias("verdict")).schema

    def judge(batches):
        own = Trie()
        own.root = shared.value
        for b in batches:
            found = [own.longest(h, p) for h, p in zip(b.column("host").to_pylist(), b.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r for r, _ in found], pa.string()),
                                              pa.array([v or default for _, v in found], pa.string())],
                                             ["page_id", "host", "path", "rule", "verdict"])

    for f in schema:
        f.nullable = True
    return parts.mapInArrow(judge, schema)


def url_filter_join(parts: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same by a join on the host suffixes, for rule sets (rule_host, rule_path, verdict) of any size."""
    labels = F.split("host", r"\.")
    n = F.size(labels)
    distinct = parts.select("host", "path").distinct()
    suffixes = distinct.select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(
        F.slice(labels, n - i + 1, i), "."))).alias("rule_host"))
    name = F.concat("rule_host", "rule_path")
    best = (suffixes.join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path"))).groupBy("host", "path")
            .agg(F.max(F.struct(F.length(name).alias("n"), F.length("rule_host").alias("h"), (F.col("verdict") == "block").alias("b"),
                                name.alias("rule"), F.col("verdict"))).alias("best")))
    return parts.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                                                             F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def query(spark, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)


def sql() -> str:
    values = ", ".join(f"('{r.split('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for v, r in RULES)
    return rf"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {values}),
rest AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest)
SELECT page_id, host, path,
  (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules WHERE (host = rule_host OR host LIKE '%.' || rule_host)
    AND starts_with(path, rule_path)) AS rule,
  coalesce((SELECT arg_max(verdict, length(rule_host || rule_path)) FROM rules WHERE (host = rule_host OR host LIKE '%.' || rule_host)
    AND starts_with(path, rule_path)), 'allow') AS verdict
FROM parts"""
