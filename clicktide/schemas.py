"""Schemas of the input and output tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
}


def _schema(text: str) -> T.StructType:
    """Columns from ``name TYPE`` pairs; needs no running session, unlike a DDL parse."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# -1 in a click column and NULL in an id list mean "not this kind of action".
USER_VISIT_ACTION = _schema(
    "date STRING, user_id BIGINT, session_id STRING, page_id BIGINT, action_time STRING,"
    " search_keyword STRING, click_category_id BIGINT, click_product_id BIGINT,"
    " order_category_ids STRING, order_product_ids STRING,"
    " pay_category_ids STRING, pay_product_ids STRING, city_id BIGINT"
)
USER_INFO = _schema(
    "user_id BIGINT, username STRING, name STRING, age INT, professional STRING, gender STRING"
)
PRODUCT_INFO = _schema("product_id BIGINT, product_name STRING, extend_info STRING")
CITY_INFO = _schema("city_id BIGINT, city_name STRING, area STRING")
ADS_LINE = _schema("value STRING")

BATCH_TABLES = {
    "user_visit_action": USER_VISIT_ACTION,
    "user_info": USER_INFO,
    "product_info": PRODUCT_INFO,
    "city_info": CITY_INFO,
}

SESSION_STAT_INFO = _schema(
    "task_id STRING, condition STRING, session_count BIGINT,"
    " visit_gt_10_ratio DOUBLE, visit_le_10_ratio DOUBLE,"
    " step_gt_5_ratio DOUBLE, step_le_5_ratio DOUBLE"
)
RANDOM_SESSION_INFO = _schema(
    "taskId STRING, sessionId STRING, startTime STRING, stepLenth BIGINT, visitLenth BIGINT,"
    " searchKeyWords STRING, clickProductIds STRING, orderProductIds STRING,"
    " payProductIds STRING"
)
CATEGORY_TOP10 = _schema(
    "task_id STRING, category_id STRING, click_count BIGINT, order_count BIGINT,"
    " pay_count BIGINT"
)
CATEGORY_TOP10_SESSION_COUNT = _schema(
    "taskId STRING, categoryId STRING, sessionId STRING, clickCount BIGINT"
)
PAGE_CONVERT_RATE = _schema("task_id STRING, page_jump STRING, ratio DOUBLE")
AREA_TOP3_PRODUCT = _schema(
    "area STRING, product_id BIGINT, product_name STRING, clickcount BIGINT, cityremark STRING"
)
KEYED_VALUE = _schema("hash_key STRING, field STRING, value STRING")
