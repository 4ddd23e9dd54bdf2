"""The shape of physical plans."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import ACTION_WITH_SEQ, actions, users

import __spark_entry__ as entry_point
from clicktide.operators import ads, pages, sessions
from clicktide.operators.actions import filtered_actions
from clicktide.params import Condition
from clicktide.session import new_scratch_dir

DATA = "/root/testdata/sf0.001"
QUERIES = entry_point.queries()
OPTIONAL = re.compile(r"op\d+_|pipeline$")  # tested with their own subpackage
BATCH = [n for n in QUERIES if not n.endswith("_stream") and not OPTIONAL.match(n)]


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, DATA))
    assert not re.search("Python|InPandas|Arrow|CartesianProduct|NestedLoop", plan)


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
@pytest.mark.parametrize(
    "name", ["session_sample", "category_top10_session_count", "top3_ads_per_day",
             "area_top3_product"]
)
def test_groups_are_cut_before_the_shuffle(spark, name):
    plan = _plan(QUERIES[name](spark, DATA))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.fixture(scope="module")
def stored(spark):
    folder = new_scratch_dir(spark, "stored")
    days = [f"2024-01-0{d} 10:00:00" for d in (1, 2, 3)]
    table = actions(spark, *[{"action_time": t} for t in days])
    table.write.parquet(f"{folder}/plain")
    table.write.partitionBy("date").parquet(f"{folder}/by_date")
    return folder


def test_only_needed_columns_are_read(spark, stored):
    plan = _plan(sessions.session_profile(spark.read.parquet(f"{stored}/plain")))
    assert "ReadSchema: struct<session_id:string,action_time:string>" in plan


def test_dates_reach_the_scan(spark, stored):
    condition = Condition(start_date="2024-01-02")
    people = users(spark, (1, 20, "a"))
    plain = filtered_actions(spark.read.parquet(f"{stored}/plain"), people, condition)
    assert "GreaterThanOrEqual(date,2024-01-02)" in _plan(plain)
    by_date = spark.read.schema(ACTION_WITH_SEQ).parquet(f"{stored}/by_date")
    pruned = filtered_actions(by_date, people, condition)
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ >= ", _plan(pruned))
    assert pruned.count() == 2


@pytest.fixture
def tiny_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {key: spark.conf.get(key, None) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _final_plan(frame) -> tuple[str, int]:
    rows = len(frame.collect())
    return _plan(frame), rows


def test_join_with_a_hot_user_is_split(spark, tiny_skew_limits):
    table = spark.range(60_000).repartition(8).selectExpr(
        "IF(id % 3 = 0, 7, id) AS user_id", "uuid() AS session_id", "'2024-01-01' AS date"
    )
    people = spark.range(60_000).selectExpr("id AS user_id", "20 AS age", "'a' AS professional")
    plan, rows = _final_plan(filtered_actions(table, people, Condition(start_age=10)))
    assert rows == 60_000
    assert "skew=true" in plan


def test_gate_with_a_hot_user_is_split(spark, tiny_skew_limits):
    clicks = spark.range(60_000).repartition(8).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id % 50 AS STRING)) AS user_id",
        "IF(id % 3 = 0, CAST(id AS STRING), 'x') AS ads_id",
        "'d' AS day", "id AS batch", "uuid() AS city",
    )
    plan, rows = _final_plan(ads.ads_log_filtered(clicks, 5))
    assert 20_000 < rows < 21_000
    assert "skew=true" in plan


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
def test_gate_reads_clicks_and_list_once(spark):
    plan = _plan(QUERIES["ads_log_filtered"](spark, DATA))
    assert plan.count("FileScan parquet") == 4  # events, nation, region, and the list
    assert plan.count("user_blacklist") + plan.count("user-blacklist") >= 1


def test_hot_session_in_one_second_is_cut_by_rows(spark, tiny_skew_limits):
    n = 30_000
    actions = spark.range(n).selectExpr(
        "IF(id % 3 = 0, 'hot', CONCAT('s', id % 4000)) AS session_id", "id % 7 AS page_id",
        "'2024-01-01 10:00:00' AS action_time", "id AS seq",
        "CAST(NULL AS STRING) AS search_keyword", "id AS click_category_id",
        "id % 9 AS click_product_id", "CAST(NULL AS STRING) AS order_category_ids",
        "CAST(NULL AS STRING) AS order_product_ids", "CAST(NULL AS STRING) AS pay_category_ids",
        "CAST(NULL AS STRING) AS pay_product_ids",
    )
    chunks = [r["count"] for r in sessions._item_chunks(actions).groupBy("session_id", "chunk").count().collect()]
    assert sum(chunks) == n and max(chunks) < n / 16
    hot = sessions.session_info(actions, "t").where("sessionId = 'hot'").first()
    assert hot["clickProductIds"] == ",".join(str(i % 9) for i in range(0, n, 3))
    assert hot["stepLenth"] == n // 3
    items = sessions.session_items(actions).where("session_id = 'hot'").orderBy("position").collect()
    assert [r["item"] for r in items] == [str(i % 9) for i in range(0, n, 3)]
    assert [r["position"] for r in items] == list(range(1, n // 3 + 1))
    jumps = pages.page_jumps(actions).where("session_id = 'hot'").collect()
    assert sorted(r["seq"] for r in jumps) == list(range(0, n - 3, 3))
    assert all(r["next_page_id"] == (r["seq"] + 3) % 7 for r in jumps)
