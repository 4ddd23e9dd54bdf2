"""A keyed table that grows by the changes of each micro-batch."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.files import child_names

#: How the value of a key comes from its changes.
MERGES = ("sum", "max", "latest")
NEW = {"changes": [], "full": {}}


@dataclass(frozen=True)
class BatchTable:
    """Changed rows per micro-batch in ``name`` below ``path``, folded into full copies after ``every`` batches.

    What is live is a *state* that the caller keeps in a manifest: the folders of changes
    since the last fold, and the full copy of each part. Every method takes a state and the
    writing ones return the next; nothing is read by its place in the file system. With
    ``part``, one of the keys, files lie in folders by its values: readers name the
    parts they need, and a fold rewrites only the parts that changed.
    """

    path: str
    schema: str
    keys: tuple[str, ...]
    value: str
    merge: str = "sum"
    every: int = 100
    part: str | None = None
    name: str = "rows"

    @property
    def folders(self) -> tuple[str, str]:
        """Where the folders that states name lie."""
        return f"{self.name}/kind=changes", f"{self.name}/kind=full"

    def _where(self, folder: str) -> str:
        return f"{self.path}/{folder}"

    def _write(self, rows: DataFrame, kind: str, tag: str) -> tuple[str, list[str]]:
        """The folder written, and the parts that it holds ("" without parts)."""
        folder = f"{self.name}/kind={kind}/tag={tag}"
        writer = rows.write.mode("overwrite")
        if not self.part:
            writer.parquet(self._where(folder))
            return folder, [""]
        writer.partitionBy(self.part).parquet(self._where(folder))
        names = child_names(rows.sparkSession, self._where(folder))
        return folder, sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{self.part}="))

    def put(self, rows: DataFrame, state: dict | None, number: int, tag: str) -> tuple[dict, DataFrame]:
        """Write the changes of a batch; the next state, and the changes as written.

        Columns beyond the schema are stored for the caller and not merged.
        """
        state = state or NEW
        folder, parts = self._write(rows.withColumn("_at", F.lit(number).cast("bigint")), "changes", tag)
        change = {"folder": folder, "parts": parts}
        written = rows.sparkSession.read.schema(rows.schema).parquet(self._where(folder))
        return {**state, "changes": [*state["changes"], change]}, written.select(rows.columns)

    def _paths(self, state: dict, parts: Iterable[str] | None) -> list[str]:
        wanted = None if parts is None else set(parts)
        fits = lambda part: wanted is None or part in wanted
        below = lambda folder, part: self._where(f"{folder}/{self.part}={part}" if self.part else folder)
        full = [below(copy["folder"], part) for part, copy in state["full"].items() if fits(part)]
        return full + [below(c["folder"], p) for c in state["changes"] for p in c["parts"] if fits(p)]

    def rows(self, spark: SparkSession, state: dict | None, parts: Iterable[str] | None = None) -> DataFrame:
        """All stored rows of some parts, not merged, with the number of their batch in ``_at``."""
        schema = f"{self.schema}, _at BIGINT"
        paths = self._paths(state or NEW, parts)
        if not paths:
            return spark.createDataFrame([], schema)
        stored = spark.read.schema(schema).option("basePath", self._where(self.name)).parquet(*paths)
        return stored.drop("kind", "tag")

    def merged(self, rows: DataFrame) -> DataFrame:
        """One row for each key, with the number of its last batch in ``_at``."""
        best = {
            "sum": F.sum(self.value), "max": F.max(self.value),
            "latest": F.max_by(self.value, "_at"),
        }[self.merge]
        return rows.groupBy(*self.keys).agg(best.alias(self.value), F.max("_at").alias("_at"))

    def read(self, spark: SparkSession, state: dict | None, parts: Iterable[str] | None = None) -> DataFrame:
        """The table, or some parts of it."""
        return self.merged(self.rows(spark, state, parts)).drop("_at")

    def fold(self, spark: SparkSession, state: dict | None, tag: str, keep: Column | None = None) -> dict:
        """The state with full copies of the parts that changed, if they are due.

        With ``keep`` the whole table is rewritten and only the rows that it holds for stay.
        """
        state = state or NEW
        if len(state["changes"]) < self.every:
            return state
        changed = None if keep is not None else {p for c in state["changes"] for p in c["parts"]}
        rows = self.merged(self.rows(spark, state, changed))
        folder, parts = self._write(rows if keep is None else rows.where(keep), "full", tag)
        copies = {part: {"folder": folder} for part in parts}
        return {"changes": [], "full": copies if keep is not None else {**state["full"], **copies}}
