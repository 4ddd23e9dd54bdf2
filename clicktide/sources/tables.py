"""The batch tables, read from a catalog database or from parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.schemas import BATCH_TABLES


def load_tables(
    spark: SparkSession, database: str | None = None, path: str | None = None
) -> dict[str, DataFrame]:
    """``user_visit_action``, ``user_info``, ``product_info`` and ``city_info`` by name.

    Columns are taken by name, in the declared order and type; further columns
    of a stored table, such as ``seq``, are kept behind them.
    """
    tables = {}
    for name, schema in BATCH_TABLES.items():
        if path:
            raw = spark.read.parquet(f"{path.rstrip('/')}/{name}")
        else:
            raw = spark.table(f"{database}.{name}" if database else name)
        declared = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
        extra = [c for c in raw.columns if c not in schema.names]
        tables[name] = raw.select(*declared, *extra)
    return tables


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for df in counts[1:]:
        result = result.unionByName(df)
    return result
