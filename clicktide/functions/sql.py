"""Functions that can be called from SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from clicktide.functions.columns import OTHER_CITIES

_COUNTS = "ARRAY<STRUCT<city_name: STRING, clicks: BIGINT>>"
_SHARES = "ARRAY<STRUCT<city_name: STRING, tenths: BIGINT>>"

#: Cities with a name, most clicks first, then by name, each with its share in tenths of a percent.
CITY_SHARES = f"""
CREATE OR REPLACE TEMPORARY FUNCTION city_shares(counts {_COUNTS}) RETURNS {_SHARES} RETURN
transform(
    array_sort(filter(counts, c -> c.city_name <> ''), (a, b) -> CASE
        WHEN a.clicks > b.clicks THEN -1 WHEN a.clicks < b.clicks THEN 1
        WHEN a.city_name < b.city_name THEN -1 WHEN a.city_name > b.city_name THEN 1 ELSE 0 END),
    c -> named_struct('city_name', c.city_name, 'tenths', floor(
        c.clicks / CAST(nullif(aggregate(
            filter(counts, x -> x.city_name <> ''), 0L, (total, x) -> total + x.clicks), 0) AS DOUBLE)
        * 1000D + 0.5D)))
"""

#: The two cities with most clicks and, when there are more, the rest, with their shares.
CITY_REMARK = f"""
CREATE OR REPLACE TEMPORARY FUNCTION city_remark(counts {_COUNTS}) RETURNS STRING RETURN
concat_ws(',',
    transform(slice(city_shares(counts), 1, 2),
              c -> concat(c.city_name, ':', CAST(c.tenths / 10D AS STRING), '%')),
    CASE WHEN size(city_shares(counts)) > 2 THEN concat('{OTHER_CITIES}:', CAST(
        (1000L - aggregate(slice(city_shares(counts), 1, 2), 0L, (total, c) -> total + c.tenths)) / 10D
        AS STRING), '%') END)
"""


def register_functions(spark: SparkSession) -> None:
    """Make ``city_remark`` known to the session's SQL.

    Its argument is the clicks by city of a group, as ``collect_list(struct(city_name, clicks))``
    over rows counted by city, so the list is as long as there are cities.
    """
    for statement in (CITY_SHARES, CITY_REMARK):
        spark.sql(statement)
