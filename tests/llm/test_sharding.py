"""Operator 9: the schedule, the law of near equal sizes, slots, and edge cases."""

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from clicktide.llm.registry import op9_lpt_shards
from clicktide.llm.sharding import assign_shards, longest_first


def test_longest_first():
    items = [(s, (i,)) for i, s in enumerate([7, 5, 4, 4, 3, 1])]
    chosen = longest_first(items, 2)
    load = [sum(s for s, k in items if chosen[k] == shard) for shard in (0, 1)]
    assert sorted(load) == [12, 12]
    assert longest_first([], 3) == {}


def check(rows, docs, shards, overhead=8):
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=str) == sorted(
        ((d, len((t or "").encode()) + overhead, zlib.crc32((t or "").encode())) for d, t in docs),
        key=str,
    )
    slots, load, home = defaultdict(list), defaultdict(int), defaultdict(set)
    texts = {d: t or "" for d, t in docs}
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
        home[texts[r["doc_id"]]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in home.values())
    assert set(slots) <= set(range(shards))
    return load


def test_edges(spark):
    docs = [(i, "same text") for i in range(500)] + [(1000 + i, "w%d " % i * i) for i in range(800)]
    docs += [(5000, None), (5001, ""), (5002, "é" * 100_000), (None, "no id"), (7, "same text")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns(
        {"Size": F.lit("x"), "_group": F.lit(1), "key": F.lit(2)}
    )
    out = assign_shards(frame, shards=4)
    assert out.columns == [
        "doc_id", "text", "_group", "key", "size", "text_crc32", "shard", "slot",
    ]
    load = check(out.collect(), docs, 4)
    assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values())
    assert assign_shards(frame.limit(0)).count() == 0


def test_query(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet")
            .select("doc_id", "text").collect()]
    rows = op9_lpt_shards(spark, data).collect()
    load = check(rows, docs, 24)
    assert len(load) == 24 and max(load.values()) < 1.2 * min(load.values())
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
