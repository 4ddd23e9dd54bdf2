"""Hand-made input rows."""

from __future__ import annotations

from pyspark.sql import types as T

from clicktide.schemas import CITY_INFO, PRODUCT_INFO, USER_INFO, USER_VISIT_ACTION

ACTION_WITH_SEQ = T.StructType([*USER_VISIT_ACTION.fields, T.StructField("seq", T.LongType())])
EMPTY = {
    "user_id": 1, "session_id": "s", "page_id": 1, "action_time": "2024-01-01 00:00:00",
    "search_keyword": None, "click_category_id": -1, "click_product_id": -1,
    "order_category_ids": None, "order_product_ids": None,
    "pay_category_ids": None, "pay_product_ids": None, "city_id": 1,
}


def actions(spark, *rows: dict):
    """Actions numbered in the order given; fields left out are those of no action."""
    full = []
    for seq, row in enumerate(rows):
        merged = {**EMPTY, "seq": seq, **row}
        merged.setdefault("date", merged["action_time"][:10])
        full.append(tuple(merged[name] for name in ACTION_WITH_SEQ.names))
    return spark.createDataFrame(full, ACTION_WITH_SEQ)


def users(spark, *rows: tuple):
    """Users given as (user_id, age, professional)."""
    full = [(i, f"user_{i}", f"name_{i}", age, job, "F") for i, age, job in rows]
    return spark.createDataFrame(full, USER_INFO)


def cities(spark, *rows: tuple):
    return spark.createDataFrame(list(rows), CITY_INFO)


def products(spark, *ids: int):
    return spark.createDataFrame([(i, f"product {i}", "own") for i in ids], PRODUCT_INFO)


def lines(spark, *values: str):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def as_tuples(frame, *columns: str) -> list[tuple]:
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)
