"""Product clicks by area and the share of the cities behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.columns import OTHER_CITIES, ratio_tenths


def area_product_click_detail(
    actions: DataFrame, cities: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per click on a known product in a known city."""
    clicks = actions.select("city_id", F.col("click_product_id").alias("product_id"))
    return (
        clicks.join(cities, "city_id")
        .join(products, "product_id")
        .select("area", "product_id", "product_name", "city_name")
    )


def city_click_counts(
    actions: DataFrame, cities: DataFrame, products: DataFrame
) -> DataFrame:
    """Clicks by area, product and city.

    Clicks are counted by their ids before they meet the city and product
    tables: the joins then work on one row per pair of ids, and a city or
    product with very many clicks costs no more than any other.
    """
    clicks = (
        actions.groupBy("city_id", F.col("click_product_id").alias("product_id"))
        .agg(F.count("*").alias("clicks"))
    )
    return (
        clicks.join(cities, "city_id")
        .join(products, "product_id")
        .groupBy("area", "product_id", "product_name", "city_name")
        .agg(F.sum("clicks").alias("clicks"))
    )


def _percent_text(tenths: Column, whole_percent: bool) -> Column:
    shown = (F.floor(tenths / 10) * 10) if whole_percent else tenths
    return F.concat((shown / 10.0).cast("string"), F.lit("%"))


def city_remark(
    counted: DataFrame,
    keys: list[str],
    whole_percent: bool = False,
    count_col: str = "clicks",
) -> DataFrame:
    """Rows and city shares of each group: ``keys``, ``clickcount``, ``cityremark``.

    ``counted`` holds ``keys``, ``city_name`` and the clicks of that city. The
    remark names the two cities with most clicks and, when there are more, the
    rest; a city without name adds to the clicks but not to the remark.
    ``whole_percent`` cuts every share to whole percents.
    """
    group = Window.partitionBy(*keys)
    named = F.col("city_name") != ""
    clicks = F.col("n")
    best_first = group.orderBy(
        F.coalesce(named, F.lit(False)).desc(), clicks.desc(), F.col("city_name").asc()
    )
    # Windows spill, an array of all cities of a group would not.
    placed = (
        counted.groupBy(*keys, "city_name")
        .agg(F.sum(count_col).alias("n"))
        .withColumns(
            {
                "place": F.row_number().over(best_first),
                "clickcount": F.sum(clicks).over(group),
                "named_clicks": F.sum(F.when(named, clicks)).over(group),
                "named_cities": F.count_if(named).over(group),
            }
        )
        .where(F.col("place") <= 2)
        .withColumn("tenths", F.when(named, ratio_tenths(clicks, F.col("named_clicks"))))
    )

    def at(place: int, value: Column) -> Column:
        return F.max(F.when((F.col("place") == place) & named, value))

    unit = 10 if whole_percent else 1
    shown = F.floor(F.col("tenths") / unit) * unit
    label = F.concat(
        F.col("city_name"), F.lit(":"), _percent_text(F.col("tenths"), whole_percent)
    )
    summed = placed.groupBy(*keys).agg(
        F.max("clickcount").alias("clickcount"),
        F.max("named_cities").alias("named_cities"),
        at(1, label).alias("first"),
        at(2, label).alias("second"),
        (F.lit(1000) - F.sum(F.when(named, shown))).alias("rest"),
    )
    rest = F.concat(
        F.lit(f"{OTHER_CITIES}:"), (F.col("rest") / 10.0).cast("string"), F.lit("%")
    )
    return summed.select(
        *keys,
        "clickcount",
        F.concat_ws(
            ",", F.col("first"), F.col("second"), F.when(F.col("named_cities") > 2, rest)
        ).alias("cityremark"),
    )


def area_product_click_count(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    whole_percent: bool = False,
) -> DataFrame:
    """Clicks and city remark of each product in each area."""
    counted = city_click_counts(actions, cities, products)
    return city_remark(counted, ["area", "product_id", "product_name"], whole_percent)


def area_top3_product(counts: DataFrame, k: int = 3) -> DataFrame:
    """Products of rank 1..k by clicks in each area; ties keep their rank."""
    by_clicks = Window.partitionBy("area").orderBy(F.desc("clickcount"))
    return (
        counts.withColumn("rk", F.rank().over(by_clicks))
        .where(F.col("rk") <= k)
        .select("area", "product_id", "product_name", "clickcount", "cityremark")
    )
