"""Operator 11 against a plain score of every document, and edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from clicktide.llm import search as se

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    N, L = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        wanted = {t: math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) for t in set(terms(text)) if df[t]}
        scored = []
        for d, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * N) // L if L else 50
            score = sum(w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t, w in wanted.items() if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d, score))
        scored.sort(key=lambda x: x[:3])
        out += [(item, i + 1, d, s) for i, (*_, d, s) in enumerate(scored[:k])]
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(n - i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 60)))) for i in range(n)]
    docs += [(5000, None), (5001, ""), (5002, " .,!"), (5003, "W1 w1, W2;w2 Ünï"), (None, "w1 w250"), (None, None),
             (5004, "w299 " * 700), (5005, docs[3][1]), (5005, docs[3][1]), (5006, "ünï")]
    items = [(f"q{i}", " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(12)]
    items += [("e", ""), ("n", None), ("x", "nowhere"), (None, "w1 W250"), ("q0", items[0][1]), ("u", "Ünï-w1"), ("w", "w299")]
    return docs, items


@pytest.mark.parametrize("k", [3, 50])
def test_against_plain_scores(spark, monkeypatch, k):
    monkeypatch.setattr(se, "SHARD_BYTES", 9000)
    docs, items = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id string, text string")
    more = {"term": se.F.lit("w1"), "shard": se.F.lit(1), "_item": se.F.lit(2), "rank": se.F.lit(9)}
    got = found(se.ranked_search(frame.withColumns(more), asked.withColumns(more), k=k))
    assert got == plain(docs, items, k)
    monkeypatch.setattr(se, "ITEMS_PER_PASS", 5)
    assert found(se.ranked_search(frame, asked, k=k)) == got


def test_empty_tables(spark):
    docs, items = corpus(20)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    asked = spark.createDataFrame(items, "item_id string, text string")
    assert found(se.ranked_search(frame.limit(0), asked)) == []
    assert found(se.ranked_search(frame, asked.limit(0))) == []
    assert found(se.ranked_search(frame.where("text IS NULL"), asked)) == []


def _shard(docs, stats):
    import pyarrow as pa

    data = [(t or "").encode() for _, t in docs]
    offsets = np.cumsum([0, *map(len, data)])
    batch = se._index_rows(7, pa.array([d for d, _ in docs], pa.int64()), np.frombuffer(b"".join(data), np.uint8), offsets)
    rows = batch.to_pylist()
    return se.Shard(np.array(rows[0]["ids"]), np.frombuffer(rows[0]["sizes"], np.int64), rows[1:], stats)


def _stats(docs):
    counts = [Counter(terms(t)) for _, t in docs]
    return se.Statistics(
        sum(1 for c in counts if c), sum(sum(c.values()) for c in counts), Counter(t for c in counts for t in c)
    )


def test_block_maxima_are_exact_and_blocks_are_skipped():
    """The greatest score of each block is that of one of its postings, and most blocks stay packed."""
    rng = random.Random(4)
    docs = [(i, "common " * rng.randrange(1, 4) + "filler " * rng.randrange(1, 90)) for i in range(20_000)]
    for i in rng.sample(range(20_000), 60):
        docs[i] = (i, docs[i][1] + " rare" * 3)
    stats = _stats(docs)
    shard = _shard(docs, stats)
    for term, at in shard.terms.items():
        for block in range(shard.n_blocks):
            if shard.count[at, block]:
                _, score = shard.scores(np.array([at]), np.array([block]))
                assert score.max() == shard.most[at, block]
    shard.unpacked = 0
    heap = se.Heap(10)
    lists = np.array([shard.terms[t] for t in ("common", "rare", "filler")])
    se.rank(shard, np.ones(len(docs), bool), lists, heap)
    assert shard.unpacked < 0.4 * 2 * len(docs)
    want = plain(docs, [("q", "common rare filler")], 10)
    assert sorted(zip(heap.id.tolist(), heap.score.tolist())) == sorted((d, s) for _, _, d, s in want)


def test_wide_frequencies_and_long_texts(spark):
    docs = [(1, "a " * 300_000 + "b"), (2, "b " * 40), (3, "a b c")]
    items = [("q", "a b"), ("c", "c a")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    asked = spark.createDataFrame(items, "item_id string, text string")
    assert found(se.ranked_search(frame, asked)) == plain(docs, items, 50)


def test_query_against_sql(spark, data):
    from compare import differences

    from clicktide.llm.registry import ORACLES, op11_ranked_search

    assert not differences(op11_ranked_search(spark, data), ORACLES["op11_ranked_search"], data)
