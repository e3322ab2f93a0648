"""URL filters: a trie over reversed host labels and path segments, sent to every task.

A rule is a host and a path prefix with a verdict. It fits its host and all subdomains
when the path of the URL starts with its own; the deepest host, then the longest path
wins, whatever its verdict. Of equal rules the blocking one holds.

Rules are collected and broadcast in sets of a fixed largest size. More rules than one
set make further passes over the URLs, each written out and its set given back before the
next one is collected, so neither the driver nor a task ever holds more than one set; the
longest match of all passes counts.

Defined cases: a NULL URL, or one without ``://``, has an empty host and path and fits no
rule; no fitting rule gives a NULL rule and the default verdict; empty tables give no
rows; repeated rows are judged each; input columns named host, path, rule or verdict are
replaced by the results, all others are kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm.common import table
from hedonic.session import written

# So many rules at most are collected and broadcast at a time.
RULES_PER_PASS = 200_000

# Host, path and verdict of the registered query's rules.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Trie:
    """Rules by reversed host labels, and below a host by the segments of their paths."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            # a key that no label has: the trie of paths that start at this host
            node = node.setdefault(("paths",), {})
            *segments, rest = path.split("/")
            for segment in segments:
                node = node.setdefault(segment, {})
            # the last segment is a prefix of the URL's segment; "" stands for a closed one
            found = node.setdefault(("prefix",), {})
            if found.get(rest, (None,))[-1] != "block":
                found[rest] = (host, path, verdict)

    @staticmethod
    def _longest(node: dict, path: str) -> tuple[str, str, str] | None:
        best, segments = None, path.split("/")
        for depth, segment in enumerate(segments):
            prefixes = node.get(("prefix",))
            if prefixes:
                fitting = [p for p in prefixes if segment.startswith(p)]
                if fitting:
                    best = prefixes[max(fitting, key=len)]
            if depth == len(segments) - 1 or segment not in node:
                break
            node = node[segment]
        return best

    def find(self, host: str, path: str) -> tuple[str, str, str] | None:
        """The rule of the deepest host, then of the longest path, that fits."""
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if ("paths",) in node:
                best = self._longest(node[("paths",)], path) or best
        return best


def host_of(url: Column) -> Column:
    tail = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(tail, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _matcher(spark: SparkSession, rules: list[tuple[str, str, str]]) -> tuple[Callable[..., Column], Broadcast]:
    """The longest rule of one set for a host and a path, as a struct that orders by host depth and path length; the set sent out."""
    shared = spark.sparkContext.broadcast(Trie(rules))
    kind = T.StructType.fromDDL("depth int, long int, blocks boolean, host string, path string")

    @F.pandas_udf(kind)
    def search(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = shared.value
        for hosts, paths in columns:
            found = [trie.find(h, p) for h, p in zip(hosts, paths)]
            rows = [(len(r[0].split(".")), len(r[1]), r[2] == "block", r[0], r[1]) if r else (-1, -1, False, "", "") for r in found]
            yield pd.DataFrame(rows, columns=kind.names).astype({"depth": "int32", "long": "int32"})

    return search, shared


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", per_pass: int = RULES_PER_PASS) -> DataFrame:
    """``df`` with host, path, the longest fitting rule (host and path, NULL if none) and its verdict.

    ``rules`` has the string columns host, path and verdict ("allow" or "block").
    """
    rules = rules.select("host", "path", "verdict").distinct()
    passes = max(1, -(-rules.count() // per_pass))
    # twice the passes needed on average, so that sets uneven by hashing stay below the largest size
    passes = passes if passes == 1 else 2 * passes
    number = F.pmod(F.xxhash64("host", "path"), F.lit(passes))
    # the input's columns stay apart in a struct, so none of them meets a working column
    out = df.select(F.struct("*").alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    for k in range(passes):
        search, shared = _matcher(df.sparkSession, [tuple(r) for r in rules.filter(number == k).collect()])
        found = out.withColumn("found", search("host", "path"))
        out = found.select("row", "host", "path", (F.greatest("best", "found") if k else F.col("found")).alias("best"))
        if passes > 1:
            out = written(out, "judged-urls")
            shared.destroy()
    fits = F.col("best.depth") >= 0
    results = {
        "host": F.col("host"),
        "path": F.col("path"),
        "rule": F.when(fits, F.concat("best.host", "best.path")),
        "verdict": F.when(~fits, F.lit(default)).when(F.col("best.blocks"), F.lit("block")).otherwise(F.lit("allow")),
    }
    own = [F.col("row")[c].alias(c) for c in df.columns if c not in results]
    return out.select(*own, *[c.alias(name) for name, c in results.items()])


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = r"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.)*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.)*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM (
  SELECT page_id, host, path,
         CASE WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
              WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
              WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
              WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
              WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule
  FROM u)
"""
