import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from rows import actions, as_tuples, cities, products, users

from clicktide.files import child_names
from clicktide.params import Condition
from clicktide.plans import area_top3, offline
from clicktide.plans.area_top3 import area_top3_report
from clicktide.plans.offline import offline_reports, run_offline
from clicktide.schemas import (
    AREA_TOP3_PRODUCT,
    CATEGORY_TOP10,
    CATEGORY_TOP10_SESSION_COUNT,
    KEYED_VALUE,
    PAGE_CONVERT_RATE,
    RANDOM_SESSION_INFO,
    SESSION_STAT_INFO,
)
from clicktide.session import new_scratch_dir
from clicktide.sinks.keyed import (
    keyed_rows,
    keyed_upsert,
    put_snapshot,
    read_keyed,
    read_keyed_snapshot,
)
from clicktide.sinks.tables import console_preview, jdbc_append, save_table
from clicktide.sources.tables import load_tables, table_sizes

OUTPUTS = {
    "session_stat_info": SESSION_STAT_INFO,
    "random_session_info": RANDOM_SESSION_INFO,
    "category_top10": CATEGORY_TOP10,
    "category_top10_session_count": CATEGORY_TOP10_SESSION_COUNT,
    "page_convert_rate": PAGE_CONVERT_RATE,
}


def _tables(spark):
    return {
        "user_visit_action": actions(
            spark,
            {"click_category_id": 1, "click_product_id": 7},
            {"page_id": 2, "action_time": "2024-01-01 00:00:20"},
        ),
        "user_info": users(spark, (1, 20, "a")),
        "product_info": products(spark, 7),
        "city_info": cities(spark, (1, "one", "n")),
    }


def test_save_and_load_by_path(spark):
    folder = new_scratch_dir(spark, "tables")
    for name, frame in _tables(spark).items():
        by = ["date"] if name == "user_visit_action" else None
        for _ in range(2):
            save_table(frame, path=f"{folder}/{name}", partition_by=by)
    loaded = load_tables(spark, path=folder)
    assert as_tuples(table_sizes(loaded)) == [
        ("city_info", 1), ("product_info", 1), ("user_info", 1), ("user_visit_action", 2),
    ]
    assert loaded["user_visit_action"].columns[:2] == ["date", "user_id"]
    assert "seq" in loaded["user_visit_action"].columns


def test_save_and_load_by_database(spark, capsys):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for name, frame in _tables(spark).items():
        for _ in range(2):
            save_table(frame, f"shop.{name}", preview_rows=5)
    assert "one" in capsys.readouterr().out
    assert as_tuples(load_tables(spark, "shop")["city_info"]) == [(1, "one", "n")]


class _Writer:
    calls: list = []

    def jdbc(self, url, table, mode, properties):
        self.calls.append((url, table, mode, properties))


def test_jdbc_append_hands_over_to_the_writer():
    """Only the call is checked: no database is started for tests."""

    class Frame:
        write = _Writer()

    jdbc_append(Frame(), "jdbc:x", "t", "me", "secret", batch_size=5, max_connections=2)
    assert _Writer.calls == [
        ("jdbc:x", "t", "append",
         {"batchsize": "5", "numPartitions": "2", "user": "me", "password": "secret"})
    ]


def test_console_preview(spark, capsys):
    console_preview(spark.range(3), 2)
    assert "only showing top 2 rows" in capsys.readouterr().out


def test_keyed_values(spark):
    path = new_scratch_dir(spark, "keyed")

    def rows(*pairs):
        frame = spark.createDataFrame(list(pairs), "a STRING, b STRING, n BIGINT")
        return keyed_rows(frame, "h", ["a", "b"], "n")

    keyed_upsert(rows(("x", "1", 1), ("y", "1", 2)), path, 0)
    keyed_upsert(rows(("x", "1", 5)), path, 1)
    keyed_upsert(rows(("x", "1", 6)), path, 1)
    keyed_upsert(rows(("z", "1", 7)), path, 10)
    latest = [("h", "x:1", "6"), ("h", "y:1", "2"), ("h", "z:1", "7")]
    assert as_tuples(read_keyed(spark, path)) == latest


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(1, 60), st.integers(0, 3), st.booleans()), min_size=3, max_size=9),
    st.sampled_from([1, 2, 100]),
)
def test_keyed_values_with_gaps(spark, batches, every):
    """Whatever the numbers of the batches, the folds and the replays: the last value of every field."""
    path = new_scratch_dir(spark, "keyed")
    number, want = 0, {}
    for value, (step, field, again) in enumerate(batches):
        number += step
        for v in ([value + 1000, value] if again else [value]):
            keyed_upsert(spark.createDataFrame([("h", str(field), str(v))], KEYED_VALUE), path, number, every)
        want[str(field)] = str(value)
    assert dict(as_tuples(read_keyed(spark, path), "field", "value")) == want
    with pytest.raises(ValueError):
        keyed_upsert(spark.createDataFrame([("h", "0", "0")], KEYED_VALUE), path, number - 1, every)
    keyed_upsert(spark.createDataFrame([("h", "0", "new")], KEYED_VALUE), path, 0, every, run="new checkpoint")
    assert dict(as_tuples(read_keyed(spark, path), "field", "value")) == {**want, "0": "new"}


def test_batches_99_and_101_both_stay(spark):
    path = new_scratch_dir(spark, "keyed")
    for number in (99, 101, 205):
        keyed_upsert(spark.createDataFrame([("h", f"f{number}", "1")], KEYED_VALUE), path, number)
    assert as_tuples(read_keyed(spark, path), "field") == [("f101",), ("f205",), ("f99",)]


def test_snapshots_replace_each_other(spark):
    path = new_scratch_dir(spark, "snapshot")
    assert read_keyed_snapshot(spark, path).count() == 0
    for number in range(4):
        frame = spark.createDataFrame([("x", number)], "a STRING, n BIGINT")
        put_snapshot(keyed_rows(frame, "h", ["a"], "n"), path, number)
    assert as_tuples(read_keyed_snapshot(spark, path)) == [("h", "x", "3")]
    assert sorted(child_names(spark, path)) == ["2", "3"]


def test_all_reports_have_their_schema(spark):
    tables = _tables(spark)
    condition = Condition(target_page_flow=(1, 2))
    reports = offline_reports(tables["user_visit_action"], condition, "t")
    assert set(reports) == set(OUTPUTS)
    for name, report in reports.items():
        assert report.dtypes == [(f.name, f.dataType.simpleString()) for f in OUTPUTS[name]]
    assert area_top3_report(tables).dtypes == [
        (f.name, f.dataType.simpleString()) for f in AREA_TOP3_PRODUCT
    ]


def test_offline_run_writes_every_report(spark):
    folder = new_scratch_dir(spark, "out")

    def put(name, report):
        report.write.mode("append").parquet(f"{folder}/{name}")

    run_offline(spark, _tables(spark), Condition(target_page_flow=(1, 2)), "t", put)
    assert as_tuples(spark.read.parquet(f"{folder}/page_convert_rate")) == [("t", "1-2", 100.0)]
    assert spark.read.parquet(f"{folder}/random_session_info").count() == 1
    assert as_tuples(spark.read.parquet(f"{folder}/category_top10")) == [("t", "1", 1, 0, 0)]


def test_jobs_from_the_command_line(spark, capsys):
    folder = new_scratch_dir(spark, "job")
    for name, frame in _tables(spark).items():
        save_table(frame, path=f"{folder}/in/{name}")
    condition = '{"startDate":"2024-01-01","professionals":"a","targetPageFlow":"1,2"}'
    offline.main(
        ["--path", f"{folder}/in", "--condition", condition, "--task-id", "t",
         "--out", f"{folder}/out"]
    )
    stats = spark.read.parquet(f"{folder}/out/session_stat_info")
    assert as_tuples(stats, "task_id", "session_count", "visit_gt_10_ratio") == [("t", 1, 100.0)]
    area_top3.main(["--path", f"{folder}/in"])
    assert "one:100.0%" in capsys.readouterr().out


def test_scratch_needs_a_shared_folder():
    class Conf:
        @staticmethod
        def get(_, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "local[2]"

            @staticmethod
            def getCheckpointDir():  # noqa: N802
                return None

    with pytest.raises(RuntimeError):
        new_scratch_dir(Session(), "x")
