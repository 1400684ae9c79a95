"""URL allow and block lists in a trie.

A rule is (verdict, host, path). It fits its host and all subdomains, if the URL's path starts
with the rule's. Of fitting rules the longest wins: the one with more host labels, then the one
with the longer path. The trie's first levels are host labels from the right, the next ones path
segments, so a URL is judged by walking down once, however many rules there are.

Rules come as a Python list and are cut into tries of at most ``TRIE_RULES`` rules and
``TRIE_CHARS`` characters. Each trie is broadcast and judged in a pass of its own, and a longer
match of a later pass takes over, so a list of any length gives the same verdicts as a single trie
would.

Defined cases: a null URL or one without ``://`` has an empty host and path, which no rule
fits; what no rule fits gets ``default``. Of rules with equal host and path the last one counts.
Rules without a host, or longer than ``RULE_CHARS``, are refused. Repeated rows are judged each; a
URL of any length is walked once, in time that grows with it; an empty table gives an empty
result. The table's other columns stay, whatever their names; those named host, path, rule or
verdict, in any case, are replaced.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbstream.llm.common import whole_row

TRIE_RULES = 200_000
TRIE_CHARS = 8 << 20
RULE_CHARS = 4096

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
    Path: from there up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


class HostTrie:
    """Nested dicts. A node has "labels" (next host label), and "rules": a path trie whose
    nodes have "next" (whole segments), "ends": rest of the last segment -> rule, and "sizes": the
    lengths of these rests, longest first."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            node = node.setdefault("rules", {})
            *whole, last = rule.path.split("/")
            for segment in whole:
                node = node.setdefault("next", {}).setdefault(segment, {})
            node.setdefault("ends", {})[last] = (
                rule.host.count(".") + 1, len(rule.path), rule.text, rule.verdict)
            sizes = node.setdefault("sizes", [])
            if len(last) not in sizes:
                bisect.insort(sizes, len(last), key=lambda n: -n)

    def longest(self, host: str, path: str) -> tuple[int, int, str, str] | None:
        """(host labels, path length, rule, verdict) of the longest rule that fits."""
        best, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            if "rules" in node:
                best = self._by_path(node["rules"], segments) or best
        return best

    @staticmethod
    def _by_path(node: dict, segments: list[str]):
        best = None
        for segment in segments:
            ends = node.get("ends")
            if ends:  # a rule's last segment may be the start of the URL's
                for n in node["sizes"]:
                    if n <= len(segment) and segment[:n] in ends:
                        best = ends[segment[:n]]
                        break
            node = node.get("next", {}).get(segment)
            if node is None:
                break
        return best


def _parts(rules: list[Rule], most: int) -> Iterator[list[Rule]]:
    part, chars = [], 0
    for rule in rules:
        if part and (len(part) >= most or chars + len(rule.text) > TRIE_CHARS):
            yield part
            part, chars = [], 0
        part.append(rule)
        chars += len(rule.text)
    if part:
        yield part


def judge_urls(pages: DataFrame, rules: Iterable[Rule], default: str = "allow",
               url: str = "url", trie_rules: int = TRIE_RULES) -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of these names are replaced."""
    rules = [Rule(verdict, host.translate(LOWER), path) for verdict, host, path in rules]
    for rule in rules:
        if (not rule.host or rule.verdict not in ("allow", "block")
                or len(rule.text) > RULE_CHARS):
            raise ValueError(f"not a rule: {rule}")
    # A later rule of the same host and path replaces the earlier one, also across tries.
    rules = list({(r.host, r.path): r for r in rules}.values())
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    best = F.lit(None).cast("struct<labels:int,length:int,rule:string,verdict:string>")
    # The table's own columns stay in one struct, where none of them can clash.
    judged = pages.select(whole_row(pages, kept).alias("row"), host.alias("host"),
                          path.alias("path"), best.alias("best"))
    for part in _parts(rules, trie_rules):
        trie = spark.sparkContext.broadcast(HostTrie(part))
        match = _matcher(trie)
        judged = (judged.withColumn("found", match("host", "path"))
                  .withColumn("best", F.when(
                      F.col("best").isNull() | (F.col("found") > F.col("best")),
                      F.col("found")).otherwise(F.col("best")))
                  .drop("found"))
    return judged.select(
        *([F.col("row.*")] if kept else []), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def _matcher(trie):
    kind = pa.struct([("labels", pa.int32()), ("length", pa.int32()),
                      ("rule", pa.string()), ("verdict", pa.string())])

    @F.arrow_udf("struct<labels:int,length:int,rule:string,verdict:string>")
    def match(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        found = map(trie.value.longest, hosts.to_pylist(), paths.to_pylist())
        names = ("labels", "length", "rule", "verdict")
        return pa.array([None if f is None else dict(zip(names, f)) for f in found], kind)

    return match
