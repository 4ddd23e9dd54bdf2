from rows import actions, as_tuples, users

from clicktide.operators.actions import action_kind, filtered_actions
from clicktide.params import Condition, flow_pairs


def _selected(spark, condition):
    days = ("2024-01-01", "2024-01-02", "2024-01-03")
    table = actions(
        spark,
        *[{"user_id": u, "action_time": f"{d} 10:00:00"} for u in (1, 2, 9) for d in days],
    )
    people = users(spark, (1, 20, "teacher"), (2, 30, "O'Neil"), (3, 40, "teacher"))
    result = filtered_actions(table, people, condition)
    assert result.columns == table.columns
    return as_tuples(result, "user_id", "date")


def test_no_condition_keeps_known_users(spark):
    assert len(_selected(spark, Condition())) == 6


def test_bounds_are_inclusive(spark):
    condition = Condition("2024-01-02", "2024-01-03", 20, 20)
    assert _selected(spark, condition) == [(1, "2024-01-02"), (1, "2024-01-03")]


def test_professionals_are_bound_as_values(spark):
    condition = Condition(professionals=("O'Neil",))
    assert {user for user, _ in _selected(spark, condition)} == {2}


def test_duplicate_user_rows_multiply(spark):
    table = actions(spark, {"user_id": 1})
    people = users(spark, (1, 20, "a"), (1, 25, "a"))
    assert filtered_actions(table, people, Condition()).count() == 2
    assert filtered_actions(table, people, Condition(start_age=21)).count() == 1


def test_condition_from_json():
    condition = Condition.from_json(
        '{"startDate":"2024-01-01","endDate":"","startAge":"","endAge":50,'
        '"professionals":"\'a\',\'b\'","targetPageFlow":"1,2,3"}'
    )
    assert condition == Condition("2024-01-01", None, None, 50, ("a", "b"), (1, 2, 3))
    assert Condition.from_json("{}") == Condition()
    assert Condition.from_json(condition.to_json()) == condition


def test_flow_pairs_are_distinct():
    assert flow_pairs((1, 2, 1, 2)) == [(1, 2), (2, 1)]
    assert flow_pairs((1,)) == []


def test_action_kinds_differ_by_report(spark):
    both = {"search_keyword": "shoe", "click_category_id": 3, "click_product_id": 4}
    table = actions(
        spark,
        both,
        {"order_category_ids": "1", "order_product_ids": "2"},
        {"order_category_ids": "", "pay_category_ids": "1", "pay_product_ids": "2"},
        {},
    )
    result = as_tuples(action_kind(table), "seq", "session_kind", "category_kind")
    assert result == [
        (0, "search", "click"), (1, "order", "order"), (2, "pay", "pay"), (3, None, None),
    ]
