"""Operator 1 against a plain search, and its edge cases."""

import hashlib
import re

import pytest
from compare import differences
from pyspark.sql import functions as F

from clicktide.llm.decontaminate import benchmark_hits
from clicktide.llm.registry import ORACLES, op1_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def plain(docs, items, window=10):
    patterns = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            patterns.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    lengths = {len(p) for p in patterns}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (ids := patterns.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= ids
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def found(frame):
    rows = frame.select("doc_id", "n_words", "n_hit", "hit_items", "hit_words").collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["hit_words"]) == r["n_hit"]
    return sorted(((r[0], r[1], r[2], sorted(r[3])) for r in rows), key=str)


DOCS = [
    (1, "One two THREE four five six seven eight nine ten eleven"),
    (2, "zero one, two; three-four five six seven eight nine ten eleven twelve ten eleven"),
    (3, None), (4, ""), (5, "..."), (None, "short item here"), (7, "a short  ITEM"),
    (7, "a short  ITEM"), (8, "Ééa über " * 3 + "short item " * 400), (9, "x" * 300_000 + " short item"),
    (10, "short"), (11, "item short"),
]
ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item"),
    (3, None), (4, ""), (None, "eleven"), (2, "Short item"), (5, "über ééa Über"), (12, "short item"),
]
D, B = "doc_id bigint, text string", "item_id bigint, text string"


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_edges(spark, block_bytes):
    docs, items = spark.createDataFrame(DOCS, D), spark.createDataFrame(ITEMS, B)
    assert found(benchmark_hits(docs, items, block_bytes=block_bytes)) == plain(DOCS, ITEMS)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS, D), spark.createDataFrame(ITEMS, B)
    assert benchmark_hits(docs.limit(0), items).count() == 0
    assert all(r["n_hit"] == 0 for r in benchmark_hits(docs, items.limit(0)).collect())


def test_extra_columns(spark):
    docs = spark.createDataFrame(DOCS, D).withColumns({"N_Hit": F.lit("x"), "item": F.lit(1)})
    items = spark.createDataFrame(ITEMS, B).withColumn("body", F.lit(None))
    out = benchmark_hits(docs, items)
    assert out.columns == ["doc_id", "text", "item", "n_words", "n_hit", "hit_items", "hit_words"]
    assert found(out) == plain(DOCS, ITEMS)


def test_query(spark, data):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{data}/{t}.parquet").select(*c).collect()]
    want = plain(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    digest = lambda ids: hashlib.sha256(",".join(ids).encode()).hexdigest()
    rows = op1_decontaminate(spark, data).collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted(
        ((d, n, h, len(i), digest(i), h > 0) for d, n, h, i in want), key=str
    )
    assert 0 < sum(r["contaminated"] for r in rows) < len(rows) / 4


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, data, sf):
    folder = data.replace("sf0.001", sf)
    assert differences(op1_decontaminate(spark, folder), ORACLES["op1_decontaminate"], folder) == ""
