"""Column expressions shared by the operators. All stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label of the cities outside the two largest.
OTHER_CITIES = "其他"

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
HOUR_FORMAT = "yyyy-MM-dd HH"
DAY_FORMAT = "yyyy-MM-dd"
MINUTE_FORMAT = "HH:mm"


def percent_1dp(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, one decimal, half up; NULL for an empty whole."""
    tenths = F.lit(1000.0) * part / F.nullif(whole, F.lit(0))
    return F.floor(tenths + 0.5) / F.lit(10.0)


def ratio_tenths(part: Column, whole: Column) -> Column:
    """Tenths of a percent as BIGINT, dividing before scaling.

    The two orders of evaluation round differently for a few pairs of counts.
    """
    return F.floor(part / F.nullif(whole, F.lit(0)).cast("double") * 1000.0 + 0.5)


def csv_ids(ids: Column) -> Column:
    """The non-empty elements of a comma-separated list."""
    return F.filter(F.split(ids, ","), lambda x: x != "")


def epoch_second(action_time: Column) -> Column:
    """Seconds of a time as text; NULL for a text that is no time.

    An action without a time counts as a step and lengthens no visit.
    """
    return F.unix_timestamp(action_time.try_cast("timestamp"))


def format_second(second: Column, pattern: str) -> Column:
    return F.date_format(F.timestamp_seconds(second), pattern)


def session_action_kind() -> Column:
    """Kind of an action in a session report: the first of search, click, order, pay."""
    return (
        F.when(F.col("search_keyword").isNotNull(), "search")
        .when(F.col("click_product_id") != -1, "click")
        .when(F.col("order_product_ids").isNotNull(), "order")
        .when(F.col("pay_product_ids").isNotNull(), "pay")
    )


def category_action_kind(order_ids_col: str = "order_category_ids") -> Column:
    """Kind of an action in a category report: the first of click, order, pay."""
    return (
        F.when(F.col("click_category_id") != -1, "click")
        .when(F.col(order_ids_col) != "", "order")
        .when(F.col("pay_category_ids") != "", "pay")
    )


def pairs_json(pairs: Column, key: str, count: str) -> Column:
    """An array of structs as JSON text ``[{"key":count},...]``."""
    return F.to_json(F.transform(pairs, lambda p: F.create_map(p[key], p[count])))
