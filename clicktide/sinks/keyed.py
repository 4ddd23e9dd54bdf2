"""Results as (hash_key, field, value) rows, kept by micro-batch.

A ``KeyedStore`` keeps the latest value of every field; what a micro-batch writes
again replaces what it wrote, so a replay after a failure changes nothing. Its
manifest names the live folders, and readers use it alone. A snapshot keeps the rows
of the last micro-batch only.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.files import child_names, exists, remove
from clicktide.schemas import KEYED_VALUE
from clicktide.streaming.batch_table import BatchTable
from clicktide.streaming.manifest import Manifest, Turn, begin

NO_PART = "all"
DIRECT = "direct"


def keyed_rows(
    df: DataFrame, hash_key: str | Column, field: list[str], value: str, *more: str
) -> DataFrame:
    """Rows for a key-value store: the field columns joined by ``:``; ``more`` columns stay."""
    key = F.lit(hash_key) if isinstance(hash_key, str) else hash_key
    return df.select(
        key.alias("hash_key"),
        F.concat_ws(":", *field).alias("field"),
        F.col(value).cast("string").alias("value"),
        *more,
    )


@dataclass(frozen=True)
class KeyedStore:
    """Latest values below ``path``. Rows may name a ``part``, of which there are a bounded number."""

    path: str
    every: int = 100

    @property
    def table(self) -> BatchTable:
        schema = "hash_key STRING, field STRING, value STRING, part STRING"
        keys = ("part", "hash_key", "field")
        return BatchTable(self.path, schema, keys, "value", "latest", self.every, "part")

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.path)

    def begin(self, spark: SparkSession, batch_id: int, run: str = DIRECT) -> Turn:
        return begin(spark, self.manifest, run, batch_id)

    def read(self, spark: SparkSession, state: dict, parts: Iterable[str] | None = None) -> DataFrame:
        rows = self.table.read(spark, state.get("table"), parts)
        return rows.select("hash_key", "field", "value")

    def put(self, df: DataFrame, turn: Turn) -> None:
        """Put the rows of one micro-batch."""
        spark = df.sparkSession
        if "part" not in df.columns:
            df = df.withColumn("part", F.lit(NO_PART))
        folded = self.table.fold(spark, turn.base.get("table"), turn.tag)
        state, _ = self.table.put(df, folded, turn.number, turn.tag)
        turn.commit(spark, {"table": state})


def keyed_upsert(df: DataFrame, path: str, batch_id: int, every: int = 100, run: str = DIRECT) -> None:
    """Put the rows of one micro-batch. The batch numbers of a run grow, with any gaps.

    The last batch may be put again and replaces itself. A run of another name, a new
    checkpoint for instance, goes on after whatever was put before.
    """
    store = KeyedStore(path.rstrip("/"), every)
    store.put(df, store.begin(df.sparkSession, batch_id, run))


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The latest value of every field."""
    store = KeyedStore(path.rstrip("/"))
    return store.read(spark, store.manifest.last(spark)[1])


def put_snapshot(df: DataFrame, path: str, batch_id: int) -> None:
    """Put rows that replace those of all earlier batches; the folder before stays for readers."""
    spark, folder = df.sparkSession, path.rstrip("/")
    df.write.mode("overwrite").parquet(f"{folder}/{batch_id}")
    for name in child_names(spark, folder):
        if int(name) < batch_id - 1:
            remove(spark, f"{folder}/{name}")


def read_keyed_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The fields of the last micro-batch, for results that replace each other."""
    folder = path.rstrip("/")
    numbers = [int(n) for n in child_names(spark, folder)] if exists(spark, folder) else []
    if not numbers:
        return spark.createDataFrame([], KEYED_VALUE)
    return spark.read.schema(KEYED_VALUE).parquet(f"{folder}/{max(numbers)}")
