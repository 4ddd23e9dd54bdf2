"""The click tables as views over a star-schema test set; ``oracles.py`` has them in SQL.

Each event becomes one user action and one ad click; customers, parts and
nations become users, products and cities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return _read(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.date_format(ts, "yyyy-MM-dd").alias("day"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("sec"),
        F.unix_millis(ts).alias("ms"),
    )


def user_visit_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")

    def when(event_type: str, value: Column) -> Column:
        return F.when(F.col("event_type") == event_type, value)

    def pair(first: Column, second: Column) -> Column:
        return F.concat_ws(",", first, second)

    session = F.concat_ws("-", F.col("user_id"), F.replace(F.col("day"), F.lit("-"), F.lit("")))
    return _events(spark, sf_dir).select(
        F.col("day").alias("date"),
        "user_id",
        session.alias("session_id"),
        (k % 10 + 1).alias("page_id"),
        F.col("sec").alias("action_time"),
        when("view", F.concat(F.lit("kw_"), k % 6)).alias("search_keyword"),
        when("click", k % 20 + 1).otherwise(-1).cast("bigint").alias("click_category_id"),
        when("click", k % 40).otherwise(-1).cast("bigint").alias("click_product_id"),
        when("purchase", pair(k % 20 + 1, (k + 7) % 20 + 1)).alias("order_category_ids"),
        when("purchase", pair((k + 3) % 20 + 1, (k + 11) % 20 + 1)).alias("order_product_ids"),
        when("signup", (k % 20 + 1).cast("string")).alias("pay_category_ids"),
        when("signup", (k % 40).cast("string")).alias("pay_product_ids"),
        (F.col("event_id") % 25).alias("city_id"),
        F.col("event_id").alias("seq"),
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return _read(spark, sf_dir, "customer").select(
        key.alias("user_id"),
        F.concat(F.lit("user_"), key).alias("username"),
        F.col("c_name").alias("name"),
        (key % 50 + 10).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("extend_info"),
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _read(spark, sf_dir, "nation")
    regions = _read(spark, sf_dir, "region")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def ads_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the ad-click stream, with the event id as ``seq``."""
    events = _events(spark, sf_dir).withColumn("city_id", F.col("event_id") % 25)
    area = F.replace(F.col("area"), F.lit(" "), F.lit("_"))
    line = F.concat_ws(" ", "ms", area, "city_name", "user_id", F.col("k") % 6 + 1)
    return events.join(city_info(spark, sf_dir), "city_id").select(
        line.alias("value"), F.col("event_id").alias("seq")
    )


def batch_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "user_visit_action": user_visit_action(spark, sf_dir),
        "user_info": user_info(spark, sf_dir),
        "product_info": product_info(spark, sf_dir),
        "city_info": city_info(spark, sf_dir),
    }
