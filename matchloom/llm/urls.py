"""URL filter: a trie over reversed host labels and path segments, longest match first."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stage, unstage

#: Most nodes of a trie that is shipped (counted as labels and segments of all rules; about 250 bytes each in a worker); the
#: rules of larger lists are joined (``judge_by_join``).
TRIE_NODES = 400_000


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def order(r: Rule) -> tuple[int, str, str]:
    """The longest rule wins; of equally long ones a block, then the greatest name."""
    return len(r.name), r.verdict, r.name


class Trie:
    """Nodes are dicts: reversed host labels, then path segments that end with a slash; unfinished segments are kept by length, so
    that a path asks for as many of its beginnings as there are lengths, however many rules there are.

    A rule's host fits that host and its subdomains; its path fits paths that start with it.
    """

    def __init__(self, rules: list[Rule]):
        self.root: dict = {}
        for r in rules:
            node = self.root
            for label in reversed(r.host.split(".")):
                node = node.setdefault(("h", label), {})
            *whole, rest = r.path.split("/")
            for segment in whole:
                node = node.setdefault(("p", segment), {})
            ends = node.setdefault("ends", {}).setdefault(len(rest), {})
            ends[rest] = max(ends.get(rest, r), r, key=order)

    def find(self, host: str, path: str) -> Rule | None:
        best: Rule | None = None
        node = self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(("h", label))
            if node is None:
                break
            at, i = node, 0
            while at is not None:
                ends = at.get("ends")
                if ends:
                    left = "/".join(segments[i:])
                    for n, of_length in ends.items():
                        r = of_length.get(left[:n])
                        if r and (best is None or order(r) > order(best)):
                            best = r
                at = at.get(("p", segments[i])) if i < len(segments) - 1 else None
                i += 1
        return best


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: list[Rule] | DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of each row: the longest fitting rule's verdict, else ``default`` with a null rule.

    Of equally long rules that fit a block wins; of those that agree the greatest name is given. Rules are a list, or a table (verdict,
    host, path), which reaches the driver only if it is small enough to ship. Host and path are cut by built-in functions; the trie is
    shipped to the tasks once (its size is checked) and asked in Arrow batches. No shuffle. Null urls have an empty host and path.
    """
    if isinstance(rules, DataFrame):
        parts = lambda c: F.length(F.regexp_replace(c, "[^./]", ""))
        names = rules.select(F.concat("host", "path").alias("n"))
        if (names.agg(F.sum(parts("n") + 2 + F.floor(F.length("n") / 200))).first()[0] or 0) > TRIE_NODES:
            return judge_by_join(pages, rules, default, id_col, url_col)
        rules = [Rule(*r) for r in rules.select("verdict", "host", "path").dropna().distinct().collect()]
    if sum(r.name.count(".") + r.name.count("/") + 2 + len(r.name) // 200 for r in rules) > TRIE_NODES:
        spark = pages.sparkSession
        table = spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
        return judge_by_join(pages, table, default, id_col, url_col)
    shipped = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("struct<rule:string,verdict:string>")
    def look_up(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        find = shipped.value.find
        found = [find(h, p) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame({"rule": [r and r.name for r in found], "verdict": [r.verdict if r else default for r in found]}, dtype=object)

    cut = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    return cut.withColumn("found", look_up("host", "path")).select(id_col, "host", "path", "found.rule", "found.verdict")


def judge_by_join(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The same for a table (verdict, host, path) of any size: joins on the host and its parents and on beginnings of the path, once per
    distinct url. A url asks with one beginning for each length that rules of the parent have, so no url meets a rule that does not fit.

    Distinct urls are joined (a url that a third of all pages share is one row) and rejoined to the pages. Both sides of
    each join are scans of staged tables, so adaptive execution splits a parent such as ``com`` and a hot url. Null urls have
    an empty host and path; rules with a null part fit nothing; an empty table of rules leaves the default to all.
    """
    cut = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    distinct = stage(cut.select("host", "path").distinct(), "url-distinct")
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    r = stage(rules.select(F.col("host").alias("parent"), F.col("path").alias("start"), F.col("verdict").alias("v")).where("parent IS NOT NULL AND start IS NOT NULL AND v IS NOT NULL").distinct(), "url-rules")
    lengths = r.select("parent", F.length("start").alias("n")).distinct()
    best = (
        distinct.withColumn("parent", F.explode(parents))
        .join(lengths, "parent")
        .where(F.col("n") <= F.length("path"))
        .withColumn("start", F.col("path").substr(F.lit(1), F.col("n")))
        .join(r, ["parent", "start"])
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length(F.concat("parent", "start")).alias("n"), F.col("v"), F.concat("parent", "start").alias("rule"))).alias("b"))
        .select("host", "path", F.col("b.rule").alias("rule"), F.col("b.v").alias("verdict"))
    )
    best = stage(best, "url-best")
    unstage(distinct, r)
    return cut.join(best, ["host", "path"], "left").select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
