"""The three products with most clicks in each area."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from clicktide.functions.sql import register_functions
from clicktide.operators.areas import area_product_click_count, area_top3_product
from clicktide.session import build_session
from clicktide.sinks.tables import console_preview
from clicktide.sources.tables import load_tables


#: The report as SQL text over the three tables, in steps that build on one another.
SQL_STEPS = {
    "area_product_click_detail": """
        SELECT c.area, p.product_id, p.product_name, c.city_name
        FROM user_visit_action v
        JOIN city_info c ON v.city_id = c.city_id
        JOIN product_info p ON p.product_id = v.click_product_id""",
    "area_product_city_clicks": """
        SELECT area, product_id, product_name, city_name, count(*) AS clicks
        FROM area_product_click_detail GROUP BY area, product_id, product_name, city_name""",
    "area_product_click_count": """
        SELECT area, product_id, product_name, sum(clicks) AS clickcount,
               city_remark(collect_list(struct(city_name, clicks))) AS cityremark
        FROM area_product_city_clicks GROUP BY area, product_id, product_name""",
    "area_top3_product": """
        SELECT area, product_id, product_name, clickcount, cityremark
        FROM (SELECT *, rank() OVER (PARTITION BY area ORDER BY clickcount DESC) AS rk
              FROM area_product_click_count)
        WHERE rk <= 3""",
}


def area_top3_sql(spark: SparkSession, tables: dict[str, DataFrame], upto: str = "area_top3_product") -> DataFrame:
    """A step of the report, run as SQL text; tables and earlier steps are views of the session."""
    register_functions(spark)
    for name in ("user_visit_action", "city_info", "product_info"):
        tables[name].createOrReplaceTempView(name)
    for name, text in SQL_STEPS.items():
        if name == upto:
            return spark.sql(text)
        spark.sql(text).createOrReplaceTempView(name)
    raise ValueError(f"no step {upto}")


def area_top3_report(tables: dict[str, DataFrame], whole_percent: bool = False) -> DataFrame:
    counts = area_product_click_count(
        tables["user_visit_action"], tables["city_info"], tables["product_info"], whole_percent
    )
    return area_top3_product(counts)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="top products by area")
    parser.add_argument("--database")
    parser.add_argument("--hive", action="store_true", help="tables of the Hive metastore")
    parser.add_argument("--path", help="folder of parquet tables instead of a database")
    parser.add_argument("--whole-percent", action="store_true")
    parser.add_argument("--sql", action="store_true", help="run the report as SQL text")
    args = parser.parse_args(argv)
    spark = build_session("area top products", hive=args.hive)
    tables = load_tables(spark, args.database, args.path)
    report = area_top3_sql(spark, tables) if args.sql else area_top3_report(tables, args.whole_percent)
    console_preview(report, 100)


if __name__ == "__main__":
    main()
