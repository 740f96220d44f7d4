"""URL allow and block lists as a trie over reversed host labels, then path segments.

A rule fits its host and every subdomain, and every path that starts with the rule's path. Of
the rules that fit, the one with the most host labels wins, then the one with the longest path;
of two equal rules with different verdicts, ``allow`` wins. URLs without a rule get the default.

The trie is broadcast in blocks of at most ``block`` rules, whatever the size of the list; each
block is one pass over the urls that keeps the best rule so far.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiumlake.llm._store import shared

RULES_PER_BLOCK = 500_000

_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host between the first ``://`` and the next ``/``, ``?``, ``#`` or end,
    A-Z in lower case; the path from there up to ``?``, ``#`` or the end. Both empty for a null or
    for text without ``://``."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    rest = rest.split("#", 1)[0].split("?", 1)[0]
    at = rest.find("/")
    host, path = (rest, "") if at < 0 else (rest[:at], rest[at:])
    return host.translate(_ASCII_LOWER), path


class RuleTrie:
    """Nodes are dicts: host labels from the top-level domain down; at a node, ``paths`` leads to
    path segments, where the last, possibly partial, segment of a rule is kept as a prefix."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {"hosts": {}, "paths": None}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.translate(_ASCII_LOWER).split(".")) if host else ():
                node = node["hosts"].setdefault(label, {"hosts": {}, "paths": None})
            if node["paths"] is None:
                node["paths"] = {"next": {}, "ends": {}}
            at = node["paths"]
            *whole, last = path.split("/")
            for segment in whole:
                at = at["next"].setdefault(segment, {"next": {}, "ends": {}})
            if verdict == "allow" or last not in at["ends"]:
                at["ends"][last] = (f"{host}{path}", verdict)

    @staticmethod
    def _by_path(node: dict | None, path: str):
        best, segments = None, path.split("/")
        for depth, segment in enumerate(segments):
            if node is None:
                break
            if node["ends"]:
                for size in sorted({len(x) for x in node["ends"]}):
                    if size <= len(segment) and (hit := node["ends"].get(segment[:size])):
                        best = hit
            node = node["next"].get(segment) if depth < len(segments) - 1 else None
        return best

    def find(self, host: str, path: str) -> tuple[str, str, int] | None:
        """(rule, verdict, number of host labels) of the longest rule that fits."""
        node, best = self.root, None
        labels = host.split(".")[::-1] if host else []
        for depth in range(len(labels) + 1):
            if node["paths"] is not None and (hit := self._by_path(node["paths"], path)):
                best = (*hit, depth)
            if depth == len(labels) or (node := node["hosts"].get(labels[depth])) is None:
                break
        return best


_OUT = "id {id}, host string, path string, rule string, verdict string, labels int"


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    block: int = RULES_PER_BLOCK,
) -> DataFrame:
    """One row per input row: ``id_col``, host, path, rule (null without one), verdict.

    Null urls, urls without ``://`` and empty hosts have an empty host and path; only rules with
    an empty host could fit them, otherwise they get the default. Repeated rows give repeated
    results; other columns, whatever their names, are not read. No rules: the default for all.
    """
    rules = [tuple(r) for r in rules]
    kind = pages.schema[id_col].dataType.simpleString()
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    spark = pages.sparkSession
    tries = [
        shared(spark, RuleTrie(rules[k : k + block])) for k in range(0, len(rules), block)
    ]

    def judge(batches):
        loaded = [pickle.loads(t.value) for t in tries]
        for batch in batches:
            host, path, rule, verdict, labels = [], [], [], [], []
            for url in batch.column("url").to_pylist():
                h, p = split_url(url)
                found = [x for t in loaded if (x := t.find(h, p))]
                best = max(found, key=lambda x: (x[2], len(x[0]), x[1] == "allow"), default=(None, default, -1))
                host.append(h)
                path.append(p)
                rule.append(best[0])
                verdict.append(best[1])
                labels.append(best[2])
            text = [pa.array(x, pa.string()) for x in (host, path, rule, verdict)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *text, pa.array(labels, pa.int32())],
                names=["id", "host", "path", "rule", "verdict", "labels"],
            )

    judged = urls.mapInArrow(judge, _OUT.format(id=kind))
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", "verdict")
