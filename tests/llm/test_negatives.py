"""Operator 12 against plain scores of all rows, bounds that always hold, and edge cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicktide.llm import negatives as ng

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def plain(rows, every=100, positives=5, negatives=10):
    kept = []
    for r, (i, label, v) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((r, i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for r, i, label, v in kept:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, q, other) for q, j, other, w in kept if q != r]
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
        for ps, p, *_ in [x for x in scored if x[3] == label][:positives]:
            near = [x for x in scored if x[3] != label and 30 * ps <= 100 * x[0] <= 90 * ps]
            out += [(i, p, n + 1, x[1], ps, x[0]) for n, x in enumerate(near[:negatives])]
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def rows(n=700, size=64, seed=1):
    rng = random.Random(seed)
    unit = lambda v: [x / math.sqrt(sum(y * y for y in v)) for x in v]
    centres = [unit([rng.gauss(0, 1) for _ in range(size)]) for _ in range(6)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        out.append((i, rng.randrange(4), unit([x + rng.gauss(0, 0.12) for x in c])))
    hot = out[5][2]
    out += [(n + i, i % 4, hot) for i in range(60)]
    out += [(100, 2, out[100][2]), (100, 2, out[100][2]), (None, 1, hot), (2000, None, hot), (2001, 1, None),
            (2002, 1, [0.1, None]), (2003, 1, [float("nan")] * 3), (2004, 1, [float("inf")]), (2100, 3, []),
            (2200, 3, [0.0] * size), (2300, 1, hot[:10]), (2400, 9, hot)]
    return out


@pytest.mark.parametrize("per_pass", [4096, 4])
def test_against_plain_scores(spark, monkeypatch, per_pass):
    data = rows()
    frame = spark.createDataFrame(data, SCHEMA).withColumns(
        {name: F.lit(7) for name in ("row", "rank", "score", "_row", "group", "ints")}
    )
    monkeypatch.setattr(ng, "ANCHORS_PER_PASS", per_pass)
    got = found(ng.hard_negatives(frame))
    assert got == plain(data)
    assert len({g[0] for g in got}) > 5


def test_other_sizes_and_empty_tables(spark):
    data = [(i, label, [100 * x for x in v[:5]]) for i, label, v in rows(150) if v and None not in v]
    frame = spark.createDataFrame(data, SCHEMA)
    assert found(ng.hard_negatives(frame, every=10)) == plain(data, every=10)
    assert found(ng.hard_negatives(frame.limit(0))) == []
    assert found(ng.hard_negatives(frame.where("vec_id = 7"))) == []


def test_too_long_vectors_are_an_error(spark):
    frame = spark.createDataFrame([(0, 1, [1e9])], SCHEMA)
    with pytest.raises(Exception, match="64-bit"):
        ng.hard_negatives(frame)


@pytest.mark.parametrize("size", [64, 128, 512])
def test_intervals_hold_and_are_narrow(size):
    rng = np.random.default_rng(3)
    ints = rng.integers(-90, 90, (500, size))
    ints[0] = 0
    ints[1] = 5
    ints[2] = np.eye(size, dtype=int)[3] * 4000
    assert np.allclose(np.linalg.norm(ng.rotate(ints), axis=1), np.linalg.norm(ints, axis=1))
    queries = ng.Queries(ints[:100])
    exact = ints @ ints[:100].T
    widths = []
    for levels in (1, 2, 4):
        low, high = queries.intervals(*ng.encode(ints, levels), slice(0, 100))
        assert (low <= exact).all() and (exact <= high).all()
        widths.append(float(np.median(high - low)))
    assert widths[0] > 1.5 * widths[1] > 2 * widths[2]


def test_few_rows_are_scored(monkeypatch):
    """The intervals reject most rows before any integer product."""
    rng = np.random.default_rng(5)
    ints = rng.normal(0, 32, (4096, 64)).astype(np.int64)
    codes, scales, rest = ng.encode(ints)
    n = len(ints)
    every = np.arange(n)
    anchors = ng.Anchors(every[:20], every[:20] % 10, ints[:20])
    scored = []
    plain_scored = ng._scored
    monkeypatch.setattr(ng, "_scored", lambda *a: (scored.append(len(a[2])), plain_scored(*a))[1])
    queries, best = ng.Queries(anchors.ints), ng.Best(5, 20)
    for at in range(0, n, 512):
        part = slice(at, at + 512)
        ng._positives(
            ng.Rows(every[part], every[part], np.ones(512, bool), every[part] % 10, ints[part], codes[part],
                    scales[part], rest[part]), anchors, queries, best,
        )
    assert sum(scored) < 0.5 * 20 * n / 10 and scored[-1] < scored[0] / 3


def test_query_against_sql(spark, data):
    from compare import differences

    from clicktide.llm.registry import ORACLES, op12_hard_negatives

    assert not differences(op12_hard_negatives(spark, data), ORACLES["op12_hard_negatives"], data)
