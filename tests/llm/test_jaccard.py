"""Operator 13 against brute force over all pairs, and edge cases."""

import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from clicktide.llm import jaccard as jc

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text, ngram=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(tuple(w[i : i + ngram]) for i in range(max(1, len(w) - ngram + 1))) if w else frozenset()


def plain_components(docs, share=90):
    sets = [plain_set(t) for _, t in docs]
    group = list(range(len(docs)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= share * len(x | sets[j]) and group[i] != group[j]:
                old = group[i]
                group = [group[j] if g == old else g for g in group]
    least = {}
    for (d, _), g in zip(docs, group):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    return sorted(((d, len(s), least.get(g)) for (d, _), s, g in zip(docs, sets, group)), key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def texts(seed=5):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(4000)}" for _ in range(n)) for n in (12, 30, 33, 90, 200, 400)]
    docs = []
    for i in range(240):
        w = base[i % 6].split()
        for _ in range(rng.randrange(1 + len(w) // 20)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        docs.append((900 - i, " ".join(w[: len(w) - rng.randrange(3)])))
    docs += [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two three"),
             (None, "one"), (None, None), (8, "word " * 70_000), (9, base[5]), (9, base[5]),
             (10, base[5].upper()), (11, "Ä " + base[4]), (12, "ä " + base[4])]
    return docs


def test_against_all_pairs(spark):
    docs = texts()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns(
        {name: F.lit(i) for i, name in enumerate(("a", "N", "slices", "mark", "node", "_ID"))}
    )
    want = plain_components(docs)
    assert found(jc.jaccard_components(frame)) == want
    sizes = {}
    for *_, c in want:
        sizes[c] = sizes.get(c, 0) + 1
    assert max(sizes.values()) > 20 and len(sizes) > 20
    assert jc.jaccard_components(frame.limit(0)).count() == 0


def test_other_threshold(spark):
    docs = texts(6)[:120]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert found(jc.jaccard_components(frame, threshold=Fraction(3, 4))) == plain_components(docs, 75)


def test_families_near_the_threshold(spark):
    """Texts that share most of their slices, of which some are linked only to a few others."""
    rng = random.Random(8)
    docs = []
    for family in range(4):
        base = [f"f{family}w{rng.randrange(4000)}" for _ in range(150)]
        for i in range(60):
            w = list(base)
            for _ in range(rng.choice((1, 2, 5, 9))):
                w[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
            docs.append((family * 100 + i, " ".join(w)))
            if not i % 9:
                w[7] = "twin"
                docs.append((1000 + family * 100 + i, " ".join(w)))
    want = plain_components(docs)
    assert found(jc.jaccard_components(spark.createDataFrame(docs, "doc_id bigint, text string"))) == want
    assert 12 < len({c for *_, c in want}) < len(docs) - 100


@pytest.mark.parametrize("threshold", [Fraction(9, 10), Fraction(3, 4), Fraction(1, 2)])
def test_linked_sets_share_a_slice(threshold):
    """Of sets as far apart as links allow, in size and content, some slice is equal."""
    import numpy as np

    starts, slices = jc.size_classes(threshold)
    rng = np.random.default_rng(4)
    for n in [*range(2, 60), 333, 4000]:
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        drop = int(len(x) * (1 - threshold))
        smaller = x[rng.permutation(len(x))[drop:]]
        half = int(len(x) * (1 - threshold) / (1 + threshold))
        swapped = np.concatenate([x[half:], rng.integers(0, 1 << 62, half).astype(np.uint64)])
        for y in (np.sort(smaller), np.sort(swapped)):
            same, both = len(np.intersect1d(x, y)), len(np.union1d(x, y))
            if same >= threshold * both and same < both:
                one, two = jc._slices([x, y], threshold, starts, slices)
                assert len(np.intersect1d(one, two)), (n, len(y))


def test_hot_group_of_copies_and_a_long_passage(spark):
    """A third of the rows hold one text; many others share a passage and are not linked."""
    rng = random.Random(2)
    passage = " ".join(f"p{rng.randrange(999)}" for _ in range(60))
    word = lambda: f"w{rng.randrange(3000)}"
    docs = [(i, passage + " the same end") for i in range(150)]
    docs += [(200 + i, passage + " " + " ".join(word() for _ in range(rng.randrange(90)))) for i in range(250)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    assert found(jc.jaccard_components(frame)) == plain_components(docs)


def test_query_against_sql(spark, data):
    from compare import differences

    from clicktide.llm.registry import ORACLES, op13_jaccard_join

    assert not differences(op13_jaccard_join(spark, data), ORACLES["op13_jaccard_join"], data)
