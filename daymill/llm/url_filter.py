"""Allow and block lists of hosts and paths, the longest rule winning."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.llm.shared import ascii_lower

# A trie is broadcast up to so many rules and so many characters of them.
MOST_RULES, MOST_CHARS = 1_000_000, 64_000_000


@dataclass(frozen=True)
class Rule:
    """A verdict on a host, its subdomains, and the paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


class Trie:
    """Rules by reversed host labels, then path segments.

    A path that stops within a segment hangs on the last whole segment's node,
    and fits any segment that begins like it. Of the rules that fit, the one
    with the most characters wins, then the longer host, then ``block``.
    """

    def __init__(self, rules: Sequence[Rule]):
        self.hosts: dict = {}
        for rule in rules:
            node = self.hosts
            for label in reversed(rule.host.split(".")):
                node = node.setdefault(label, {})
            *whole, rest = rule.path.split("/")
            node = node.setdefault(None, {})
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault(None, {})
            key = (len(rule.text), len(rule.host), rule.verdict == "block")
            ends[rest] = max(ends.get(rest, (key, rule)), (key, rule), key=lambda x: x[0])

    def find(self, host: str, path: str) -> Rule | None:
        best = None
        node = self.hosts
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            inner = node.get(None)
            for segment in segments if inner is not None else ():
                for rest, found in inner.get(None, {}).items():
                    if segment.startswith(rest) and (best is None or found[0] > best[0]):
                        best = found
                inner = inner.get(segment)
                if inner is None:
                    break
        return best and best[1]


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end; without one, empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    whole = F.coalesce(url, F.lit(""))
    return F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _trie_verdicts(spark: SparkSession, rules: Sequence[Rule], default: str):
    sent = spark.sparkContext.broadcast(Trie(rules))  # read once by each worker

    @F.pandas_udf("rule string, verdict string")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = sent.value
        for hosts, paths in batches:
            found = [trie.find(h, p) for h, p in zip(hosts, paths)]
            yield pd.DataFrame({
                "rule": pd.Series([r and r.text for r in found], dtype=object),
                "verdict": [r.verdict if r else default for r in found],
            })

    return judge


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], *, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; columns so named are replaced.

    A rule fits its host and all subdomains if the path begins with the rule's.
    The most characters win, then the longer host, then ``block``. Without a
    rule, ``rule`` is null and the verdict is ``default``. A null url, one
    without ``://``, and an empty one have an empty host and path, which only a
    rule with an empty host could fit. Repeated rows and very long urls are
    judged like any other. More rules than a trie may hold are refused.
    """
    if len(rules) > MOST_RULES or sum(len(r.text) for r in rules) > MOST_CHARS:
        raise ValueError("too many rules for a broadcast trie; use filter_urls_by_join")
    parts = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    judged = parts.withColumn("__found", _trie_verdicts(pages.sparkSession, rules, default)("host", "path"))
    return judged.withColumns(
        {"rule": F.col("__found.rule"), "verdict": F.col("__found.verdict")}
    ).drop("__found")


def filter_urls_by_join(
    pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow"
) -> DataFrame:
    """As ``filter_urls``, for rules (``host``, ``path``, ``verdict``) of any number.

    Each distinct host and path is looked up by its host suffixes and path
    beginnings, so a common host or page is one row when it meets the rules.
    """
    parts = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    # Beginnings of the lengths that rules have, so a long url is not cut at every character.
    lengths = rules.agg(F.array_sort(F.collect_set(F.length("path"))).alias("lengths")).scalar()
    fitting = F.filter("__lengths", lambda n: n <= F.length("path"))
    starts = F.transform(fitting, lambda n: F.col("path").substr(F.lit(1), n))
    keys = parts.select("host", "path").distinct().withColumn("__lengths", lengths)
    probes = keys.select("*", F.explode(suffixes).alias("__host")).select(
        "*", F.explode(starts).alias("__path")
    )
    known = rules.select(
        F.col("host").alias("__host"), F.col("path").alias("__path"),
        F.col("verdict").alias("__verdict"),
    )
    text = F.concat("__host", "__path")
    best = (
        probes.join(known, ["__host", "__path"])
        .groupBy("host", "path")
        .agg(F.max(F.struct(
            F.length(text).alias("chars"), F.length("__host").alias("of_host"),
            (F.col("__verdict") == "block").alias("blocks"), text.alias("rule"),
            F.col("__verdict").alias("verdict"),
        )).alias("__found"))
    )
    judged = parts.drop("rule", "verdict").join(best, ["host", "path"], "left")
    return judged.select(
        *parts.drop("rule", "verdict").columns,
        F.col("__found.rule").alias("rule"),
        F.coalesce("__found.verdict", F.lit(default)).alias("verdict"),
    )
