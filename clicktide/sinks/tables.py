"""Table, JDBC and console outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def save_table(
    df: DataFrame,
    table: str | None = None,
    path: str | None = None,
    partition_by: list[str] | None = None,
    preview_rows: int = 0,
) -> None:
    """Replace a managed table or a parquet folder by ``df``, then show some rows."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer.parquet(path)
    else:
        writer.saveAsTable(table)
    if preview_rows:
        spark = df.sparkSession
        console_preview(spark.read.parquet(path) if path else spark.table(table), preview_rows)


def jdbc_append(
    df: DataFrame,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    batch_size: int = 1000,
    max_connections: int = 20,
) -> None:
    """Append rows to a database table, straight from the executors.

    One transaction per partition; ``max_connections`` bounds the writers at
    the same time. Errors fail the job.
    """
    properties = {"batchsize": str(batch_size), "numPartitions": str(max_connections)}
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            properties[key] = value
    df.write.jdbc(url, table, mode="append", properties=properties)


def console_preview(df: DataFrame, rows: int = 100) -> StreamingQuery | None:
    """Print the first rows; of a stream, those of each batch until the query is stopped."""
    if not df.isStreaming:
        df.show(rows, truncate=False)
        return None
    writer = df.writeStream.format("console").option("numRows", rows)
    return writer.option("truncate", "false").start()
