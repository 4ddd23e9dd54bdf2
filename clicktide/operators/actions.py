"""Selection of user actions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.functions.columns import category_action_kind, session_action_kind
from clicktide.params import Condition


def _all_of(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def _between(name: str, low, high) -> list[Column]:
    column = F.col(name)
    bounds = [] if low is None else [column >= low]
    return bounds if high is None else [*bounds, column <= high]


def filtered_actions(actions: DataFrame, users: DataFrame, condition: Condition) -> DataFrame:
    """Actions of known users that meet the condition; all bounds are inclusive.

    Users are cut to the matching ids before the join. No hint is set: Spark
    broadcasts the ids only when they measure small, and otherwise adaptive
    execution splits the partition of a user with very many actions.
    """
    user_tests = _between("age", condition.start_age, condition.end_age)
    if condition.professionals:
        user_tests.append(F.col("professional").isin(*condition.professionals))
    matching = users.where(_all_of(user_tests)).select("user_id")
    dated = actions.where(_all_of(_between("date", condition.start_date, condition.end_date)))
    return dated.join(matching, "user_id").select(*actions.columns)


def action_kind(actions: DataFrame, order_ids_col: str = "order_category_ids") -> DataFrame:
    """Each action with its kind in session reports and in category reports."""
    return actions.withColumns(
        {
            "session_kind": session_action_kind(),
            "category_kind": category_action_kind(order_ids_col),
        }
    )
