"""Operator 10 against a window-by-window version, and edge cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clicktide.llm import fingerprints as fp
from clicktide.llm.arrow import text_buffers
from clicktide.llm.registry import op10_fingerprint


def plain_ranks(text):
    out = []
    for i in range(len(text) - fp.WINDOW + 1):
        entropy = sum(int(fp.TERM[c]) for c in Counter(text[i : i + fp.WINDOW]).values())
        out.append(int(fp.RANK[min(entropy * fp.STEPS // (1000 * fp.WINDOW * 6), fp.STEPS)]))
    return out


def plain_features(text):
    """Windows that are features, by their places."""
    ranks = plain_ranks(text)
    span = min(fp.NEIGHBOURS, len(ranks))
    wins = Counter()
    runs = len(ranks) - span + 1 if ranks else 0
    for i in range(runs):
        wins[min(range(i, i + span), key=lambda k: (ranks[k], k))] += 1
    return [k for k in sorted(wins)
            if wins[k] >= min(fp.POPULARITY, runs) and ranks[k] < fp.NO_RANK]


def sample_texts():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("etaoinshrdluéß") for _ in range(rng.randrange(1, 9)))
    texts = [" ".join(word() for _ in range(n)) for n in (0, 1, 8, 12, 20, 24, 40, 300, 14_000)]
    return [*texts, "a" * 500, "", "x", "ab" * 3000 + texts[7], texts[7]]


def digests(texts):
    return fp.digests(*text_buffers(pa.array(texts, pa.string())))


def test_features_equal_the_plain_version():
    texts = [t for t in sample_texts() if len(t) < 20_000]
    buf, offsets = text_buffers(pa.array(texts, pa.string()))
    hashes, row = fp.features(buf, offsets)
    for r, text in enumerate(texts):
        places = plain_features(text.encode())
        assert (row == r).sum() == (len(places) or bool(text)), text[:50]
        one, _ = fp.features(*text_buffers(pa.array([text], pa.string())))
        assert (one == hashes[row == r]).all()
        windows = {text.encode()[k : k + fp.WINDOW] for k in places}
        assert not places or len(set(one.tolist())) == len(windows)


def test_long_text_in_slices(monkeypatch):
    text = sample_texts()[8]
    whole = digests([text])[0]
    monkeypatch.setattr(fp, "SLICE", 777)
    assert (digests([text])[0] == whole).all()


def test_likeness():
    texts = sample_texts()
    found = digests(texts)
    assert fp.likeness(found[7], found[-1]) == 1 and (found[7] == found[-1]).all()
    assert fp.likeness(found[0], found[0]) == 1 and fp.likeness(found[0], found[7]) == 0
    half = digests([texts[7][: len(texts[7]) // 2] + texts[8][: len(texts[7]) // 2]])[0]
    assert 0.25 < fp.likeness(found[7], half) < 0.75
    assert fp.likeness(found[7], found[5]) < 0.2
    for a in found:
        for b in found:
            assert 0 <= fp.likeness(a, b) <= 1
            assert fp.likeness(a, b) == pytest.approx(fp.likeness(b, a), abs=0.35)


def plain_rows(docs):
    key = lambda d: (d[0] is not None, d[0] or 0)
    ordered = sorted(docs, key=key)
    out = []
    for (doc, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, following = digests([text, edited, after])
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    own.tobytes().hex(), other.tobytes().hex(), fp.likeness(own, other),
                    fp.likeness(own, following)))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1 << 20, 3000])
def test_pairs_and_edges(spark, size):
    docs = list(zip(range(100, 10, -7), sample_texts(), strict=False))
    docs += [(None, "no id"), (-5, None), (2**60, "far é" * 40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).withColumns(
        {"_range": F.lit(1), "id": F.lit(2), "Fingerprint": F.lit("x"), "_text": F.lit("y")}
    )
    got = fp.fingerprint_pairs(frame, partition_bytes=size)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_rows(docs)
    assert fp.fingerprint_pairs(frame.limit(0)).count() == 0


def test_repeated_and_single_rows(spark):
    frame = spark.createDataFrame([(1, "same"), (1, "same"), (2, "b")], "doc_id bigint, text string")
    rows = sorted(tuple(r) for r in fp.fingerprint_pairs(frame, partition_bytes=4).collect())
    assert [r[0] for r in rows] == [1, 1, 2]
    one = fp.fingerprint_pairs(frame.where("doc_id = 2")).collect()
    assert [(r["near_next"], r["n_chars"]) for r in one] == [(1.0, 1)]


def test_query(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet")
            .select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op10_fingerprint(spark, data).collect()), key=str)
    assert got == plain_rows(docs)
    assert np.mean([r[5] for r in got]) > 0.3 > 0.1 > np.mean([r[6] for r in got])
