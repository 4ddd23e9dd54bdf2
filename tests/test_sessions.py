from rows import actions, as_tuples

from clicktide.operators.sessions import (
    sampled_session_ids,
    session_info,
    session_profile,
    session_sample,
    session_stat_info,
    sessions_per_hour,
)


def _session(name, *times, **fields):
    return [{"session_id": name, "action_time": f"2024-01-01 {t}", **fields} for t in times]


def test_limits_are_strict(spark):
    table = actions(
        spark,
        *_session("ten", "00:00:00", "00:00:10"),
        *_session("eleven", "00:00:00", "00:00:11"),
        *_session("five", *["00:00:00"] * 5),
        *_session("six", *["00:00:00"] * 6),
    )
    profile = session_profile(table)
    assert as_tuples(profile) == [
        ("eleven", 2, 11000), ("five", 5, 0), ("six", 6, 0), ("ten", 2, 10000),
    ]
    assert as_tuples(session_stat_info(profile, "t", "{}")) == [
        ("t", "{}", 4, 25.0, 75.0, 25.0, 75.0)
    ]


def test_empty_class_is_zero_and_no_session_is_null(spark):
    table = actions(spark, *_session("a", "00:00:00"))
    assert as_tuples(session_stat_info(session_profile(table), "t", "{}")) == [
        ("t", "{}", 1, 0.0, 100.0, 0.0, 100.0)
    ]
    none = session_profile(table.where("false"))
    assert as_tuples(session_stat_info(none, "t", "{}")) == [
        ("t", "{}", 0, None, None, None, None)
    ]


def test_session_info_lists_items_in_order_of_time(spark):
    table = actions(
        spark,
        {"action_time": "2024-01-01 00:30:00", "click_product_id": 5},
        {"action_time": "2024-01-01 00:00:05", "click_product_id": 7},
        {"action_time": "2024-01-01 00:00:05", "click_product_id": 6},
        {"action_time": "2024-01-01 00:10:00", "order_product_ids": "3,1"},
        {"action_time": "2024-01-01 00:20:00", "order_product_ids": ""},
        {"action_time": "2024-01-01 00:00:00", "search_keyword": "b", "click_product_id": 9},
        {"action_time": "2024-01-01 01:00:00", "search_keyword": "a"},
        {"action_time": "2024-01-01 01:00:01"},
    )
    expected = [
        ("t", "s", "2024-01-01 00:00:00", 8, 3601000, "b,a", "7,6,5", "3,1,", ""),
    ]
    assert as_tuples(session_info(table, "t")) == expected


def _many(spark, per_hour: dict[str, int]):
    rows = []
    for hour, n in per_hour.items():
        for i in range(n):
            rows += _session(f"{hour}-{i}", f"{hour}:00:00", f"{hour}:59:00")
    return actions(spark, *rows)


def test_hours_and_quotas(spark):
    table = _many(spark, {"01": 30, "02": 10})
    assert as_tuples(sessions_per_hour(table, 20)) == [
        ("2024-01-01 01", 30, 15), ("2024-01-01 02", 10, 5),
    ]


def test_sample_has_the_quota_of_each_hour_and_repeats(spark):
    table = _many(spark, {"01": 30, "02": 10, "03": 1})
    first = as_tuples(sampled_session_ids(table, 20, "x"))
    by_hour = {h: sum(s.startswith(h) for (s,) in first) for h in ("01", "02", "03")}
    assert by_hour == {"01": 15, "02": 5, "03": 0}
    assert first == as_tuples(sampled_session_ids(table.repartition(3), 20, "x"))
    assert first != as_tuples(sampled_session_ids(table, 20, "y"))


def test_quota_beyond_the_sessions_takes_all(spark):
    table = _many(spark, {"01": 3, "02": 2})
    assert session_sample(table, "t", 1000).count() == 5


def test_large_target_ranks_in_shares(spark):
    table = _many(spark, {"01": 40, "02": 5})
    assert sampled_session_ids(table, 3000, "x").count() == 45
