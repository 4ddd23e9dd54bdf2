"""The black-list gate: drops clicks of users who click one ad too often in a day.

Below its folder the gate keeps ``accepted`` and ``rejected`` lines by batch, the stored
``counts`` per user, ad and day, the ``listed`` users, and the ``inputs`` read so far. A
commit log names what is live. A batch takes effect with its commit and not before.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktide.files import child_names, exists, make_dir, publish, put_text, remove
from clicktide.operators.ads import CLICK_LIMIT, ads_log_parse, malformed_lines
from clicktide.streaming.batch_table import BatchTable
from clicktide.streaming.manifest import Fenced, Manifest

CLICK_SCHEMA = (
    "logdate TIMESTAMP, area STRING, city STRING, user_id STRING, ads_id STRING,"
    " day STRING, hour_min STRING"
)
CLICK_COLUMNS = [column.split()[0] for column in CLICK_SCHEMA.split(",")]
COUNT_KEYS = ("user_id", "ads_id", "day")
#: A click may be so much later than its arrival, for clocks that differ.
CLOCK_TOLERANCE = "INTERVAL 10 MINUTES"
#: Buckets of users and of inputs; days and users that come up name at most so many folders.
BUCKETS, DAY_PARTS = 64, 512


def bucket_of(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("string")


def day_part(day: str) -> Column:
    """Neighbouring days lie apart, and no line, however odd its time, adds a folder beyond the bound."""
    return F.pmod(F.unix_date(F.col(day).cast("date")), F.lit(DAY_PARTS)).cast("string")


@dataclass(frozen=True)
class GateStore:
    """Where the gate keeps its results, and its commit log.

    A commit holds the number of the batch, the run and the run's own number of the
    batch, and the live folders of all tables. How far each input has been read is one
    of these tables, so a run with a new, lost or older checkpoint neither counts
    a line again nor skips one. Each start of the gate takes the next epoch; a run
    whose epoch is not the newest fails, and no two runs can commit one number.
    """

    path: str
    every: int = 100

    @property
    def accepted(self) -> str:
        return f"{self.path}/accepted"

    @property
    def rejected(self) -> str:
        return f"{self.path}/rejected"

    @property
    def log(self) -> Manifest:
        return Manifest(self.path)

    @property
    def counts(self) -> BatchTable:
        schema = "user_id STRING, ads_id STRING, day STRING, click_count BIGINT, part STRING"
        keys = (*COUNT_KEYS, "part")
        return BatchTable(self.path, schema, keys, "click_count", "sum", self.every, "part", "counts")

    @property
    def listed(self) -> BatchTable:
        """Users are only ever added, in hash buckets; a batch reads those of its users."""
        schema = "user_id STRING, click_count BIGINT, part STRING"
        keys = ("user_id", "part")
        return BatchTable(self.path, schema, keys, "click_count", "max", self.every, "part", "listed")

    @property
    def inputs(self) -> BatchTable:
        """The last place read of each origin."""
        schema = "origin STRING, place BIGINT, part STRING"
        keys = ("origin", "part")
        return BatchTable(self.path, schema, keys, "place", "max", self.every, "part", "inputs")

    def _epochs(self, spark: SparkSession) -> list[int]:
        folder = f"{self.path}/epochs"
        names = child_names(spark, folder) if exists(spark, folder) else []
        return sorted(int(n) for n in names if n.isdigit())

    def open(self, spark: SparkSession) -> int:
        """Take over the store: the next epoch, which no other run has. What a failed run left goes."""
        while True:
            epochs = self._epochs(spark)
            epoch = max(epochs, default=0) + 1
            if put_text(spark, f"{self.path}/epochs/{epoch}", ""):
                for older in epochs[:-1]:
                    remove(spark, f"{self.path}/epochs/{older}")
                last, state = self.log.last(spark)
                if last >= 0:
                    self.publish(spark, last, state)
                tables = (self.counts, self.listed, self.inputs)
                self.log.sweep(spark, "staged", *(f for table in tables for f in table.folders))
                return epoch

    def check(self, spark: SparkSession, epoch: int) -> None:
        if max(self._epochs(spark), default=0) != epoch:
            raise Fenced(f"a newer run has taken over {self.path}")

    def publish(self, spark: SparkSession, number: int, state: dict) -> None:
        """Bring the lines of a committed batch to their final folders, if they are not there yet."""
        for name, final in (("clicks", self.accepted), ("bad", self.rejected)):
            staged = f"{self.path}/{state['staged']}/{name}"
            if exists(spark, staged):
                publish(spark, staged, f"{final}/batch_id={number}")
        remove(spark, f"{self.path}/{state['staged']}")

    def current(self, spark: SparkSession, table: BatchTable) -> DataFrame:
        """One of the tables after the last commit."""
        state = self.log.last(spark)[1]
        return table.read(spark, state.get("tables", {}).get(table.name))

    def next_offsets(self, spark: SparkSession, topic: str) -> str | None:
        """Where a new run goes on in each partition of the topic, as the reader's option; None before the first batch."""
        rows = self.current(spark, self.inputs).where(F.col("origin").startswith(f"{topic}:")).collect()
        places = {row["origin"].rsplit(":", 1)[1]: row["place"] + 1 for row in rows}
        return json.dumps({topic: places}, sort_keys=True) if places else None


def _in_future(now: datetime) -> Column:
    return F.col("logdate") > F.lit(now) + F.expr(CLOCK_TOLERANCE)


def _rejected(lines: DataFrame, now: datetime) -> DataFrame:
    """Lines set aside, and why: their form, or a time after their arrival."""
    future = ads_log_parse(lines.withColumn("line", F.col("value"))).where(_in_future(now))
    return malformed_lines(lines).select("value", F.lit("malformed").alias("reason")).unionByName(
        future.select(F.col("line").alias("value"), F.lit("future").alias("reason"))
    )


class _Batch:
    """The work on one micro-batch, from the state of the last commit to the next."""

    def __init__(self, spark: SparkSession, store: GateStore, number: int, state: dict, epoch: int):
        self.spark, self.store, self.number = spark, store, number
        self.tag = f"{number}-{epoch}-{os.urandom(4).hex()}"
        self.tables = {
            table.name: table.fold(spark, state.get("tables", {}).get(table.name), self.tag)
            for table in (store.counts, store.listed, store.inputs)
        }

    def stored(self, fresh: DataFrame, parts: list[str]) -> DataFrame:
        """The stored counts of the keys in ``fresh``.

        ``fresh`` is read from a table, so Spark knows its size. The keys of a batch go to the
        tasks that scan the stored counts, of which only the rows of these keys are shuffled; a
        batch too large for that meets them in a shuffled join.
        """
        counts, keys = self.store.counts, list(self.store.counts.keys)
        rows = counts.rows(self.spark, self.tables["counts"], parts)
        return counts.merged(rows.join(fresh.select(*keys), keys, "left_semi")).drop("_at")

    def _put(self, table: BatchTable, rows: DataFrame) -> DataFrame:
        self.tables[table.name], written = table.put(rows, self.tables[table.name], self.number, self.tag)
        return written

    def unread(self, lines: DataFrame) -> DataFrame:
        """The lines beyond what has been read of their origin; how far that is becomes part of the commit."""
        if "origin" not in lines.columns:
            return lines
        before = self.tables["inputs"]
        ends = lines.groupBy("origin").agg(F.max("place").alias("place"))
        parts = self._put(self.store.inputs, ends.withColumn("part", bucket_of("origin")))
        known = self.store.inputs.rows(self.spark, before, self.tables["inputs"]["changes"][-1]["parts"])
        if known.isEmpty():
            return lines
        seen = known.join(parts.select("origin"), "origin", "left_semi").groupBy("origin").agg(
            F.max("place").alias("seen")
        )
        fresh = F.col("seen").isNull() | (F.col("place") > F.col("seen"))
        return lines.join(seen, "origin", "left").where(fresh).drop("seen")

    def accept(self, lines: DataFrame, now: datetime) -> tuple[DataFrame, list[str]]:
        """Stage the clicks of users not listed, and set odd lines aside; the clicks, and the parts of their days."""
        folder = f"{self.store.path}/staged/{self.tag}"
        clicks = ads_log_parse(lines)
        users = clicks.where(~_in_future(now)).groupBy(bucket_of("user_id").alias("bucket")).count()
        found = {row["bucket"]: row["count"] for row in users.collect()}
        if sum(found.values()) < lines.count():
            _rejected(lines, now).write.mode("overwrite").parquet(f"{folder}/bad")
        listed = self.store.listed.rows(self.spark, self.tables["listed"], found).select("user_id").distinct()
        passed = clicks.where(~_in_future(now)).join(listed, "user_id", "left_anti").select(*CLICK_COLUMNS)
        passed.write.mode("overwrite").parquet(f"{folder}/clicks")
        accepted = self.spark.read.schema(CLICK_SCHEMA).parquet(f"{folder}/clicks")
        days = accepted.select(day_part("day").alias("part")).distinct()
        return accepted, [row["part"] for row in days.collect()]

    def count(self, accepted: DataFrame, parts: list[str], limit: int) -> None:
        """Add the clicks to the stored counts, and list the users whose count was at the limit before."""
        path = f"{self.store.path}/staged/{self.tag}/fresh"
        counted = accepted.groupBy(*COUNT_KEYS, day_part("day").alias("part")).agg(F.count("*").alias("clicks"))
        counted.write.mode("overwrite").parquet(path)
        fresh = self.spark.read.schema(counted.schema).parquet(path)
        stored = self.stored(fresh, parts)
        # A key stored at the limit lists the user; every other key is increased.
        prior = F.coalesce("click_count", F.lit(0))
        changed = fresh.join(stored, [*COUNT_KEYS, "part"], "left").select(
            *COUNT_KEYS, F.when(prior < limit, F.col("clicks")).otherwise(0).alias("click_count"),
            "part", prior.alias("prior"),
        )
        over = self._put(self.store.counts, changed).where(F.col("prior") >= limit)
        if not over.isEmpty():
            users = over.groupBy("user_id").agg(F.max("prior").alias("click_count"))
            self._put(self.store.listed, users.withColumn("part", bucket_of("user_id")))


def gate_batch(
    store: GateStore, limit: int, run: str = "direct", epoch: int | None = None
) -> Callable[[DataFrame, int], None]:
    """The work on one micro-batch of lines.

    Lines with an ``origin`` and ``place`` are known again wherever they come from. Lines
    without are told by their run and batch alone, so such a run must repeat its batches.
    """
    held = {"epoch": epoch}

    def put(lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        if held["epoch"] is None:
            held["epoch"] = store.open(spark)
        store.check(spark, held["epoch"])
        last, state = store.log.last(spark)
        if last >= 0:
            store.publish(spark, last, state)
        runs = state.get("runs", {})
        if "origin" not in lines.columns and batch_id <= runs.get(run, -1):
            return
        work = _Batch(spark, store, last + 1, state, held["epoch"])
        now = datetime.now(timezone.utc)
        lines.persist()
        try:
            accepted, parts = work.accept(work.unread(lines), now)
        finally:
            lines.unpersist()
        work.count(accepted, parts, limit)
        commit = {
            "run": run, "batch": batch_id, "epoch": held["epoch"], "runs": {**runs, run: batch_id},
            "tables": work.tables, "staged": f"staged/{work.tag}",
        }
        store.check(spark, held["epoch"])
        store.log.commit(spark, last + 1, commit)
        store.publish(spark, last + 1, commit)

    return put


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """A name kept in the checkpoint folder: it lives and is lost with the checkpoint."""
    names = child_names(spark, checkpoint) if exists(spark, checkpoint) else []
    for name in names:
        if name.startswith("run-"):
            return name
    name = f"run-{os.urandom(8).hex()}"
    make_dir(spark, f"{checkpoint}/{name}")
    return name


def start_gate(
    lines: DataFrame,
    store: GateStore,
    checkpoint: str,
    limit: int = CLICK_LIMIT,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run the gate, by default in micro-batches of five seconds."""
    spark = lines.sparkSession
    make_dir(spark, store.accepted)
    run, epoch = run_name(spark, checkpoint), store.open(spark)
    return (
        lines.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .foreachBatch(gate_batch(store, limit, run, epoch))
        .start()
    )


# The partition column is declared too: a reader may start before the first batch.
ACCEPTED_SCHEMA = f"{CLICK_SCHEMA}, batch_id BIGINT"


def accepted_clicks(spark: SparkSession, store: GateStore) -> DataFrame:
    """The clicks let through so far."""
    return spark.read.schema(ACCEPTED_SCHEMA).parquet(store.accepted).drop("batch_id")


def accepted_stream(spark: SparkSession, store: GateStore, **options: str) -> DataFrame:
    """The clicks let through, as a stream: each batch's folder comes into view in one step."""
    make_dir(spark, store.accepted)
    reader = spark.readStream.schema(ACCEPTED_SCHEMA).options(**options)
    return reader.parquet(store.accepted).drop("batch_id")


def blacklist_table(spark: SparkSession, store: GateStore) -> DataFrame:
    """The users listed so far."""
    return store.current(spark, store.listed).select("user_id")


def stored_counts(spark: SparkSession, store: GateStore) -> DataFrame:
    """Stored clicks per user, ad and day."""
    return store.current(spark, store.counts).select(*COUNT_KEYS, "click_count")
