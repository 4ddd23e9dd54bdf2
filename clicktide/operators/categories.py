"""Category counts and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions.columns import category_action_kind, csv_ids
from clicktide.operators.ranking import first_k


def category_action_counts(
    actions: DataFrame, order_ids_col: str = "order_category_ids"
) -> DataFrame:
    """Clicks, orders and pays of each category, one for every id in a list.

    An action counts for its first kind only. ``order_ids_col`` may name
    ``order_product_ids`` to count orders by those ids instead.
    """
    kind = F.col("kind")
    ids = (
        F.when(kind == "click", F.array(F.col("click_category_id").cast("string")))
        .when(kind == "order", csv_ids(F.col(order_ids_col)))
        .when(kind == "pay", csv_ids(F.col("pay_category_ids")))
    )
    marked = actions.withColumn("kind", category_action_kind(order_ids_col))
    return (
        marked.where(kind.isNotNull())
        .select("kind", F.explode(ids).alias("category_id"))
        .groupBy("category_id")
        .agg(
            F.count_if(kind == "click").alias("click_count"),
            F.count_if(kind == "order").alias("order_count"),
            F.count_if(kind == "pay").alias("pay_count"),
        )
    )


def category_top10(counts: DataFrame, task_id: str, k: int = 10) -> DataFrame:
    """The k categories with most clicks, then orders, then pays, then the least id."""
    return (
        counts.orderBy(
            F.desc("click_count"),
            F.desc("order_count"),
            F.desc("pay_count"),
            F.col("category_id").try_cast("bigint").asc_nulls_last(),
            F.asc("category_id"),
        )
        .limit(k)
        .select(
            F.lit(task_id).alias("task_id"),
            "category_id", "click_count", "order_count", "pay_count",
        )
    )


def category_session_counts(actions: DataFrame, top: DataFrame) -> DataFrame:
    """Clicks of each session on each category of ``top``, the rows of ``category_top10``."""
    # Ids are compared as text, so "04" is not category 4. No hint: the limit in ``top``
    # tells Spark that it is small enough to broadcast.
    return (
        actions.select(F.col("click_category_id").cast("string").alias("category_id"), "session_id")
        .join(top.select("category_id"), "category_id", "left_semi")
        .groupBy("category_id", "session_id")
        .agg(F.count("*").alias("click_count"))
    )


def category_top10_session_count(counts: DataFrame, task_id: str, k: int = 10) -> DataFrame:
    """The k sessions with most clicks in each category."""
    order = [F.desc("click_count"), F.asc("session_id")]
    return first_k(counts, ["category_id"], order, k).select(
        F.lit(task_id).alias("taskId"),
        F.col("category_id").alias("categoryId"),
        F.col("session_id").alias("sessionId"),
        F.col("click_count").alias("clickCount"),
    )
