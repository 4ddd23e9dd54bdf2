"""The pipeline against plain versions of its stages, each on what the stage before kept."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_decontaminate import plain as plain_hits
from test_lines import plain as plain_lines
from test_packing import check as check_packing
from test_simhash import plain_components

import corpus_pipeline as cp


def rows(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = [docs]
    for name, stage in cp.STAGES:
        stage(spark, docs, data).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        found.append(docs)
    return found


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert [name for name, _ in cp.STAGES] == [
        "toxicity", "line_dedup", "near_duplicates", "decontamination", "packing",
    ]


def test_toxicity_keeps_texts(stages):
    before, after = (Counter(rows(s, "*")) for s in stages[:2])
    assert not after - before and sum(after.values()) > 0.7 * sum(before.values())


def test_lines(stages):
    want = plain_lines(rows(stages[1], "doc_id", "text", "source"), cp.MIN_SITES)
    got = rows(stages[2], "doc_id", "source", "text", "n_chars")
    assert sorted(got) == sorted((d, s, t, len(t)) for d, s, t, *_ in want)


def test_near_duplicates(stages):
    before = rows(stages[2], "doc_id", "text")
    assert {d for d, in rows(stages[3], "doc_id")} == {c for _, _, c in plain_components(before)}
    assert len(before) > stages[3].count() > 0


def test_decontamination(stages):
    hits = plain_hits(rows(stages[3], "doc_id", "text"), BENCHMARK(stages[3].sparkSession))
    assert {d for d, in rows(stages[4], "doc_id")} == {d for d, _, n, _ in hits if n == 0}


def BENCHMARK(spark):  # noqa: N802
    return rows(spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"), "item_id", "text")


def test_packing(stages):
    sequences, total = check_packing(stages[5].collect(), rows(stages[4], "doc_id", "text"))
    assert sequences <= total / 1024 * 1.03 + 1


def test_run(spark, data, stages):
    assert cp.run(spark, data).count() == stages[5].count()


def test_empty_null_and_repeated(spark, data):
    odd = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (None, "text", None, "b", 4),
           (3, "text two", "en", "b", None), (3, "text two", "en", "b", None), (4, "z " * 90_000, "", "", 1)]
    docs = spark.createDataFrame(odd, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for frame in (docs, docs.limit(0), docs.withColumn("node", F.lit("x"))):
        current = frame
        for name, stage in cp.STAGES:
            current = stage(spark, current, data)
            if name != "packing":
                assert current.columns == frame.columns
        ids = {r["doc_id"] for r in current.collect()}
        assert ids == (set() if frame.isEmpty() else {1, None, 3, 4})
