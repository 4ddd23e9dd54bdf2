"""Operator 4 against brute force over all pairs, and edge cases."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clicktide.llm import simhash as sh
from clicktide.llm.components import connected
from clicktide.llm.registry import op4_simhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text, ngram=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    parts = [w[i : i + ngram] for i in range(max(1, len(w) - ngram + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(docs):
    prints = [(d, plain_print(t)) for d, t in docs]
    values = sorted({f for _, f in prints})
    least = {f: min((d for d, g in prints if g == f and d is not None), default=None)
             for f in values}
    group = {f: f for f in values}
    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= 2 and group[a] != group[b]:
                old, new = group[b], group[a]
                group = {f: new if g == old else g for f, g in group.items()}
    ids = {}
    for f, g in group.items():
        if least[f] is not None:
            ids[g] = min(ids.get(g, least[f]), least[f])
    return sorted(((d, f"{f:016x}", ids.get(group[f])) for d, f in prints), key=str)


def found(frame):
    rows = frame.withColumn("fingerprint", sh.hex_digits(F.col("fingerprint"))).collect()
    return sorted((tuple(r) for r in rows), key=str)


def texts():
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(150)) for _ in range(6)]
    docs = []
    for i in range(160):
        w = base[i % 6].split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        docs.append((200 - i, " ".join(w)))
    docs += [(300, None), (301, ""), (302, " \n\t"), (303, "one"), (304, "ONE"), (305, "é two"),
             (None, "é two"), (None, None), (306, "word " * 70_000), (307, base[0]), (307, base[0])]
    return docs


def test_against_all_pairs(spark):
    docs = texts()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns(
        {"lanes": F.lit(1), "fingerprint": F.lit("x"), "node": F.lit(2), "_ID": F.lit(3)}
    )
    want = plain_components(docs)
    assert found(sh.simhash_components(frame)) == want
    assert len({c for *_, c in want}) < len({f for _, f, _ in want})
    assert sh.simhash_components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("segments, bucket", [(None, 256), (1, 256), (2, 16), (None, 16)])
def test_close_links_are_all_pairs_in_reach(spark, monkeypatch, segments, bucket):
    """Whatever the number of segments, and also where many share the value of one."""
    monkeypatch.setattr(sh, "BUCKET", bucket)
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(30)}
    for v in list(values):
        for _ in range(8):
            flips = rng.sample(range(64), rng.randrange(1, 5))
            values.add(v ^ sum(1 << f for f in flips))
    values |= {0xFFFF_FFFF_FFFF_0000 | rng.getrandbits(16) for _ in range(60)}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(v),) for v in values], "fingerprint bigint")
    for most in (0, 2, 3) if bucket == 256 and not segments else (2,):
        want = {(signed(a), signed(b)) for a in values for b in values
                if signed(a) < signed(b) and (a ^ b).bit_count() <= most}
        got = [tuple(r) for r in sh.close_links(frame, most, segments).collect()]
        assert set(got) == want and len(got) == len(want)


def test_balls_and_segments():
    masks = sh.pieces_of((1 << 64) - 1, 3)
    assert sum(masks) == (1 << 64) - 1 and [m.bit_count() for m in masks] == [21, 21, 22]
    assert len(sh.ball(masks[0], 2)) == 1 + 21 + 21 * 20 // 2
    assert {b & ~masks[1] for b in sh.ball(masks[1], 1)} == {0}
    assert [sh.segment_count(n, 2) for n in (0, 10**6, 10**8, 10**10, 10**12)] == [3, 3, 2, 1, 1]


def test_components(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000), (500, 700), (700, 500), (600, 500)]
    frame = spark.createDataFrame([*chain, (None, 4)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected(frame).collect()}
    assert got == {**{i: 0 for i in range(301)}, 500: 500, 600: 500, 700: 500}
    assert connected(frame.limit(0)).count() == 0


def test_majority():
    rng = np.random.default_rng(1)
    count = np.array([0, 1, 2, 255, 256, 0, 700])
    hashes = rng.integers(0, 2**64, count.sum(), dtype=np.uint64)
    got, at = sh.majority(hashes, count), 0
    for n, value in zip(count, got.tolist(), strict=True):
        part = [int(h) for h in hashes[at : at + n]]
        assert value == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in part) > n)
        at += n


def test_one_of_each(spark):
    docs = texts()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns(
        {"node": F.lit(1), "Rank": F.lit(2), "lanes": F.lit("x"), "_row": F.lit(1), "fingerprint": F.lit(0), "c0": F.lit(0)}
    )
    out = sh.one_of_each(frame)
    assert out.columns == frame.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sorted((d for d, _ in got), key=str) == sorted({c for *_, c in plain_components(docs)}, key=str)
    assert set(got) <= set(docs)
    assert sh.one_of_each(frame.limit(0)).count() == 0
    ids = spark.createDataFrame([(None, "a"), (None, "a"), (7, "b b"), (7, "B B"), (3, None)], "doc_id bigint, text string")
    assert sorted((tuple(r) for r in sh.one_of_each(ids.coalesce(1)).collect()), key=str) == [
        (3, None), (7, "b b"), (None, "a"),
    ]


def test_query(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet")
            .select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op4_simhash(spark, data).collect()), key=str)
    assert got == plain_components(docs)
