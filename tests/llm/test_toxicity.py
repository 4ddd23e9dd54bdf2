"""Operator 8: held-out accuracy, a plain version of the model, and edge cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicktide.llm import toxicity as tox
from clicktide.llm.registry import op8_toxicity


def corpus():
    """Ordinary words everywhere; rude ones in toxic texts only."""
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for i in range(600):
        words = [f"w{rng.integers(300)}" for _ in range(60)]
        if bad := i % 5 == 0:
            for _ in range(4):
                words[rng.integers(60)] = rng.choice(["vile", "nasty", "foulmouthed", "foulmood"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def test_learns_and_edges(spark):
    docs, labels = corpus()
    odd = [(None, "vile vile"), (9000, None), (9001, ""), (9002, "w1 " * 90_000), (9003, "VILE nasty"),
           (9004, "foulmouth vile"), (9003, "VILE nasty")]
    frame = spark.createDataFrame(docs + odd, "doc_id bigint, text string").withColumns(
        {"Score": F.lit("s"), "toxic": F.lit(1), "weight": F.lit(2), "mean": F.lit(3)}
    )
    marks = spark.createDataFrame(
        [*labels, *labels[:50], (None, 1), (3, None), (77777, 1)], "doc_id bigint, toxic int"
    ).withColumn("text", F.lit("x"))
    model = tox.fit_toxicity(frame, marks)
    out = tox.score_toxicity(frame, model)
    assert out.columns == ["doc_id", "text", "toxic", "weight", "mean", "score", "predicted"]
    rows = out.collect()
    truth = dict(labels)
    held = [r for r in rows if r["doc_id"] in truth and fold(r["doc_id"]) == 0]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert len(held) > 80 and right >= 0.97 * len(held)
    by = {r["doc_id"]: r for r in rows}
    assert [by[i]["predicted"] for i in (9000, 9001, 9002, 9003, None)] == [0, 0, 0, 1, 1]
    assert by[9000]["score"] == by[9001]["score"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert tox.score_toxicity(frame.limit(0), model).count() == 0


def test_held_out_labels_are_not_used(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    one = tox.fit_toxicity(frame, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    turned = [(i, 1 - t if fold(i) == 0 else t) for i, t in labels]
    two = tox.fit_toxicity(frame, spark.createDataFrame(turned, "doc_id bigint, toxic int"))
    assert (one.slope, one.intercept) == (two.slope, two.intercept)
    a, b = one.table(spark, 0), two.table(spark, 0)
    assert (a.keys == b.keys).all() and (a.values == b.values).all()


def test_all_labelled_rows_are_counted_and_blocks_add_up(spark):
    """A bound on the rows of the fit leaves the counts alone; many blocks score as one."""
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("_mean", F.lit("kept"))
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    one, few = tox.fit_toxicity(frame, marks), tox.fit_toxicity(frame, marks, max_rows=10, max_units=2)
    assert one.blocks == 1 < few.blocks
    values = [
        {r["unit"]: r["value"] for r in spark.read.parquet(m.path).collect()} for m in (one, few)
    ]
    assert values[0] == values[1]
    few = few._replace(slope=one.slope, intercept=one.intercept)
    a, b = ({r["doc_id"]: r["score"] for r in tox.score_toxicity(frame, m).collect()} for m in (one, few))
    assert a == pytest.approx(b)
    assert "_mean" in tox.score_toxicity(frame, one).columns


@pytest.mark.parametrize("kept", [[], [0], [1]])
def test_missing_classes(spark, kept):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = spark.createDataFrame([r for r in labels if r[1] in kept], "doc_id bigint, toxic int")
    model = tox.fit_toxicity(frame, marks)
    assert {r["predicted"] for r in tox.score_toxicity(frame, model).collect()} == {int(kept == [1])}


def test_labelled_texts_without_words(spark):
    frame = spark.createDataFrame([(1, ""), (2, None), (3, " .,")], "doc_id bigint, text string")
    model = tox.fit_toxicity(frame, spark.createDataFrame([(i, i % 2) for i in (1, 2, 3)], "doc_id bigint, toxic int"))
    assert {r["score"] for r in tox.score_toxicity(frame, model).collect()} == {
        tox.score_toxicity(frame, model).first()["score"]
    }


def test_table():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(1, 2**63, 5000).astype(np.uint64))
    table = tox.make_table(keys, np.arange(len(keys)))
    assert (tox.look_up(table, keys) == np.arange(len(keys))).all()
    assert (tox.look_up(table, keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == 0).all()
    assert (tox.look_up(tox.make_table(keys[:0], keys[:0]), keys) == 0).all()


def test_values_follow_the_formula(spark):
    counts = [(2 * i + i % 2, int(t), int(o)) for i, (t, o) in enumerate(
        np.random.default_rng(4).integers(0, 60, (40, 2)) ** 2 // 40) if t + o]
    frame = spark.createDataFrame(counts, "unit bigint, t bigint, o bigint")
    got = {r["unit"]: r["value"] for r in tox._values(frame).collect()}
    want = {}
    for kind in (0, 1):
        mine = [c for c in counts if c[0] & 1 == kind]
        total = [sum(c[k] for c in mine) for k in (1, 2)]
        spare = [sum(min(c[k], tox.DISCOUNT) for c in mine) for k in (1, 2)]
        for unit, *n in mine:
            shared = sum(n) / sum(total)
            p = [(max(n[k] - tox.DISCOUNT, 0) + spare[k] * shared) / total[k] for k in (0, 1)]
            differs = np.log(p[0] / p[1])
            if abs(differs) > tox.MARGIN:
                want[unit] = np.sign(differs) * (abs(differs) - tox.MARGIN)
    assert want and got == pytest.approx(want)


def plain_means(docs, labels):
    """Mean value of each text by counting in plain Python."""
    split = lambda text: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    toxic = {}
    for i, t in labels:
        toxic[i] = max(t, toxic.get(i, 0))
    texts = {(text, toxic[i]) for i, text in docs if i in toxic and fold(i) in (1, 2, 3)}
    kinds = {"word": lambda w: w, "start": lambda w: w.encode()[:5] if len(w.encode()) >= 5 else None}
    of = [Counter(), Counter()]
    for text, t in texts:
        words = split(text)
        of[t].update(set(zip([""] + words, words)))
    d = tox.DISCOUNT
    beyond = lambda x: math.copysign(max(abs(x) - tox.MARGIN, 0), x)
    chance = {}
    for kind, key in kinds.items():
        n = [Counter(key(w) for _, w in of[c] if key(w)) for c in (0, 1)]
        total, spare = [sum(c.values()) for c in n], [sum(min(x, d) for x in c.values()) for c in n]
        for w in n[0] | n[1]:
            shared = (n[0][w] + n[1][w]) / sum(total)
            chance[kind, w] = [(max(n[c][w] - d, 0) + spare[c] * shared) / total[c] for c in (0, 1)]
    both = of[0] + of[1]
    behind = {}
    for v, w in both:
        behind.setdefault(v, []).append((v, w))

    def value(v, w):
        p = chance.get(("word", w))
        if p is None:
            return 0.0
        mass = sum(max(both[x] - d, 0) for x in behind.get(v, []))
        if mass:
            backoff, q = 1 - mass / sum(both[x] for x in behind[v]), []
            for c in (0, 1):
                total, spare = (sum(f(of[c][x]) for x in behind[v]) for f in (int, lambda n: min(n, d)))
                s = max(both[v, w] - d, 0) / mass
                q.append((max(of[c][v, w] - d, 0) + spare * s) / total if total else s)
            p = [(1 - backoff) * q[c] + backoff * p[c] for c in (0, 1)]
        return beyond(math.log(p[1] / p[0]))

    means = {}
    for i, text in docs:
        words = split(text)
        starts = [chance.get(("start", kinds["start"](w))) for w in words]
        total = sum(value(v, w) for v, w in zip([""] + words, words))
        total += sum(beyond(math.log(p[1] / p[0])) for p in starts if p)
        means[i] = total / max(1, len(words))
    return means


def test_as_counted_plainly(spark):
    """Also with copies under other ids and repeated rows, and a phrase of words that are ordinary alone."""
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(500):
        words = [f"w{min(rng.integers(40), rng.integers(40))}" for _ in range(40)] + ["common", "évident"]
        words[7:7] = ["Nasty, WORD", "thing"] if i % 4 == 0 else []
        words[3:3] = ["go", "jump"] if i % 4 == 0 else ["go", "w1", "jump"]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs += [(1000 + i, docs[12][1]) for i in range(60)]
    labels += [(1000 + i, 1) for i in range(60)]
    frame = spark.createDataFrame([*docs, *docs[20:40], *docs[20:40]], "doc_id bigint, text string")
    model = tox.fit_toxicity(frame, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = {r["doc_id"]: r["mean"] for r in tox._with_means(frame, "text", model).collect()}
    want = plain_means(docs, labels)
    assert len({round(x, 6) for x in want.values()}) > 10
    assert got == pytest.approx(want, abs=1e-5)


def test_phrase_of_ordinary_words(spark):
    """Words that every text has are toxic only as one phrase, which order 1 can't see."""
    rng = np.random.default_rng(6)
    docs, labels = [], []
    for i in range(800):
        words = [f"w{rng.integers(100)}" for _ in range(30)]
        for _ in range(2):
            at = int(rng.integers(len(words)))
            words[at:at] = ["drop", "dead"] if i % 4 == 0 else ["drop", "w5", "dead"]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    right = []
    for order in (1, 2):
        rows = tox.score_toxicity(frame, tox.fit_toxicity(frame, marks, order=order)).collect()
        held = [r for r in rows if fold(r["doc_id"]) == 0]
        right.append(sum(r["predicted"] == labels[r["doc_id"]][1] for r in held) / len(held))
    assert right[0] < 0.85 and right[1] > 0.97


def test_query(spark, data):
    rows = op8_toxicity(spark, data).collect()
    assert all(r["held_out"] == (fold(r["doc_id"]) == 0) for r in rows)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert len(rows) == docs.count()
    larger = data.replace("sf0.001", "sf0.1")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    held = [r for r in op8_toxicity(spark, larger).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.97 * len(held)
