"""First k rows of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits of a draw that tell its bucket.
BUCKET_DIGITS = 3


def first_k(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank_col: str = "rn"
) -> DataFrame:
    """Rows of rank 1..k in each group, with the rank in ``rank_col``.

    A group may hold most of the input; Spark keeps the shuffle at k rows per group and
    task for small k.
    """
    in_group = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(in_group)).where(F.col(rank_col) <= k)


def least_draws(df: DataFrame, quotas: DataFrame, key: str, draw: str, tie: str) -> DataFrame:
    """The rows of each group with the least draws, as many as its ``quota``.

    ``draw`` is a hash as hexadecimal text, so draws are spread evenly. They are counted by their
    first digits; only rows up to the bucket in which the quota is reached are ranked, some
    quota and a 4096th of the group. Groups without a quota, or of less than 1, have none.
    """
    placed = df.withColumn("_bucket", F.substring(draw, 1, BUCKET_DIGITS))
    up_to = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(up_to), F.lit(0)))
    bound = before.join(quotas, key).where(F.col("_before") < F.col("quota")).groupBy(key).agg(
        F.max("_bucket").alias("_last"), F.max("quota").alias("quota")
    )
    near = placed.join(bound, key).where(F.col("_bucket") <= F.col("_last"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(draw, tie))
    return near.withColumn("rn", rank).where(F.col("rn") <= F.col("quota")).select(df.columns)
