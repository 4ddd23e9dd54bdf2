import hashlib
import random

import pytest
from pyspark.sql import functions as F
from rows import as_tuples

from clicktide.operators import ranking
from clicktide.operators.ranking import first_k, least_draws


@pytest.fixture(params=[1000, 3])
def pre_cut(spark, request):
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield
    spark.conf.set(key, before)


def test_first_k_equals_sorting_each_group(spark, pre_cut):
    frame = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 500).alias("v"))
    got = {(r.g, r.rn, r.v) for r in first_k(frame, ["g"], [F.desc("v")], 5).collect()}
    expected = set()
    for g in range(3):
        values = sorted((i * 7 % 500 for i in range(500) if i % 3 == g), reverse=True)
        expected |= {(g, n + 1, v) for n, v in enumerate(values[:5])}
    assert got == expected


@pytest.mark.parametrize("digits", [1, 3])
def test_least_draws_equal_sorting_each_group(spark, monkeypatch, digits):
    monkeypatch.setattr(ranking, "BUCKET_DIGITS", digits)
    rng = random.Random(3)
    rows = [(rng.choice("aab"), f"s{i}", hashlib.md5(str(i % 290).encode()).hexdigest()) for i in range(300)]
    quotas = [("a", 37), ("b", 500), ("c", 4)]
    frame = spark.createDataFrame([*rows, ("zero", "s", "00"), ("none", "s", "00")], "g STRING, s STRING, d STRING")
    limits = spark.createDataFrame([*quotas, ("zero", 0)], "g STRING, quota BIGINT")
    want = []
    for g, quota in quotas:
        want += sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[1]))[:quota]
    assert as_tuples(least_draws(frame, limits, "g", "d", "s")) == sorted(want, key=repr)
