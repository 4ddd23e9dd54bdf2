"""Operator 7, URL filter: a trie over reversed host labels, then path segments.

A rule fits its host and all hosts below it if the path of the URL starts with
the rule's path. The trie is walked by the labels of the host from the right;
each node on the way may hold a second trie over path segments, whose last
segment is a prefix. The longest rule wins.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.arrow import add_columns
from clicktide.session import new_scratch_dir

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ADDED = [
    T.StructField("host", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("verdict", T.StringType()),
]


class Rule(NamedTuple):
    text: str
    blocks: bool


class PathNode:
    __slots__ = ("next", "last")

    def __init__(self) -> None:
        self.next: dict[str, PathNode] = {}
        self.last: dict[str, Rule] = {}


class HostNode:
    __slots__ = ("next", "any_path", "paths")

    def __init__(self) -> None:
        self.next: dict[str, HostNode] = {}
        self.any_path: Rule | None = None
        self.paths: PathNode | None = None


def stronger(a: Rule | None, b: Rule | None) -> Rule | None:
    """The longer of two rules; of equal length the blocking one, then the smaller text."""
    if a is None or b is None:
        return a or b
    return max(a, b, key=lambda r: (len(r.text), r.blocks, [-ord(c) for c in r.text]))


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case (A-Z) and path; both empty without a ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    for mark in "#?":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(UPPER), slash + path


def build_trie(rules: list[tuple[str, str, bool]]) -> HostNode:
    """A trie of (host, path, blocks); an empty path fits every path."""
    root = HostNode()
    for host, path, blocks in rules:
        host = host.translate(UPPER)
        node, rule = root, Rule(host + path, blocks)
        for label in reversed(host.split(".")):
            node = node.next.setdefault(label, HostNode())
        if not path:
            node.any_path = stronger(node.any_path, rule)
            continue
        node.paths = at = node.paths or PathNode()
        *whole, last = path.split("/")[1:]
        for segment in whole:
            at = at.next.setdefault(segment, PathNode())
        at.last[last] = stronger(at.last.get(last), rule)
    return root


def match(root: HostNode, host: str, path: str) -> Rule | None:
    best, node = None, root
    segments = path.split("/")[1:]
    for label in reversed(host.split(".")) if host else ():
        node = node.next.get(label)
        if node is None:
            break
        best = stronger(best, node.any_path)
        at = node.paths
        for segment in segments:
            if at is None:
                break
            for size in range(min(len(segment), max(map(len, at.last), default=-1)) + 1):
                best = stronger(best, at.last.get(segment[:size]))
            at = at.next.get(segment)
    return best


def url_filter(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    default: str = "allow",
    without_host: str = "block",
    block_rules: int = 200_000,
) -> DataFrame:
    """Pages with ``host``, ``path``, the ``rule`` that fits best and its ``verdict``.

    ``rules`` has host, path and verdict ('allow' or 'block'); rows with a null
    in one of them, or a path without a leading slash, are no rules. The longest
    text of host and path wins, at equal length a block. Without a rule the
    verdict is ``default``, and ``without_host`` where the URL is null, empty or
    has no host. A column with the name of an added one is replaced.

    Tries reach the executors in blocks of about ``block_rules`` rules; the pages
    run through one block after the other.
    """
    usable = rules.select(
        F.col("host").alias("h"), F.col("path").alias("p"), F.col("verdict").alias("v")
    ).where("v IN ('allow', 'block') AND h <> '' AND (p = '' OR startswith(p, '/'))").distinct()
    blocks = -(-usable.count() // block_rules) or 1
    spark = pages.sparkSession
    result = pages
    for block in range(blocks):
        mine = usable.where(F.pmod(F.xxhash64("h", "p"), F.lit(blocks)) == block)
        trie = spark.sparkContext.broadcast(
            build_trie([(r["h"], r["p"], r["v"] == "block") for r in mine.toLocalIterator()])
        )
        if block:
            folder = new_scratch_dir(spark, "url-filter")
            result.write.parquet(folder)
            result = spark.read.parquet(folder)
        result = _with_trie(result, url_col, trie, block > 0, default, without_host)
    return result


def _with_trie(pages, url_col: str, trie, again: bool, default: str, without_host: str):
    names = [n.lower() for n in pages.columns]
    url = names.index(url_col.lower())
    earlier = [names.index(n) for n in ("rule", "verdict")] if again else []

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        before = [batch.column(i).to_pylist() for i in earlier]
        out = []
        for i, text in enumerate(batch.column(url).to_pylist()):
            host, path = split_url(text)
            best = match(trie.value, host, path)
            if before and before[0][i] is not None:
                best = stronger(best, Rule(before[0][i], before[1][i] == "block"))
            if best is not None:
                verdict = "block" if best.blocks else "allow"
            else:
                verdict = default if host else without_host
            out.append((host, path, best.text if best else None, verdict))
        return [pa.array([row[k] for row in out], pa.string()) for k in range(4)]

    return add_columns(pages, ADDED, compute)
