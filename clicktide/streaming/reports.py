"""Running reports on the accepted clicks, each a streaming query of its own.

Counts per key are kept by Spark's state store, on disk and with a log of changes as its
checkpoint. No report waits for a watermark: late clicks, of whatever day, change the counts
of their day like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktide.files import child_names, remove
from clicktide.operators.ads import (
    ads_minute_counts,
    area_city_ads_day_clickcount,
    minutes_json,
    top3_ads_per_day,
)
from clicktide.sinks.keyed import KeyedStore, keyed_rows, put_snapshot
from clicktide.streaming.batch_table import BatchTable
from clicktide.streaming.gate import day_part
from clicktide.streaming.manifest import Manifest, begin

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Folders of single moments; the sixty minutes that are live never share one.
MINUTE_PARTS = 1024
HOUR_MS = 3_600_000
#: The work on one batch: its rows and its number.
Put = Callable[[DataFrame, int], None]


def city_count_rows(counts: DataFrame, *more: str | Column) -> DataFrame:
    return keyed_rows(
        counts, "area_city_ads_day_clickcount", ["area", "city", "ads_id", "day"], "click_count",
        *more,
    )


def top3_rows(top3: DataFrame, *more: str | Column) -> DataFrame:
    key = F.concat(F.lit("top3_ads_per_day:"), F.col("day"))
    return keyed_rows(top3, key, ["area"], "top_ads", *more)


def last_hour_rows(last_hour: DataFrame) -> DataFrame:
    return keyed_rows(last_hour, "last_hour_ads_click", ["ads_id"], "minute_clicks")


def _start(changed: DataFrame, put: Put, checkpoint: str, mode: str, trigger: dict | None) -> StreamingQuery:
    for key, value in STATE_STORE.items():
        changed.sparkSession.conf.set(key, value)
    return (
        changed.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .foreachBatch(put).start()
    )


def put_city_counts(path: str, run: str, every: int = 100) -> Put:
    """Put the counts that a batch changed."""
    store = KeyedStore(path, every)

    def put(changed: DataFrame, batch_id: int) -> None:
        rows = city_count_rows(changed, day_part("day").alias("part"))
        store.put(rows, store.begin(changed.sparkSession, batch_id, run))

    return put


def start_city_counts(
    clicks: DataFrame, path: str, checkpoint: str, run: str, trigger: dict | None = None
) -> StreamingQuery:
    """Running clicks per day, area, city and ad: changed keys are put with their new totals."""
    counts = area_city_ads_day_clickcount(clicks)
    return _start(counts, put_city_counts(path, run), checkpoint, "update", trigger)


def _leaders(rows: DataFrame) -> DataFrame:
    """The rows (day, area, ads_id, click_count) behind rankings that were put."""
    pairs = F.explode(F.from_json("value", "array<map<string,bigint>>"))
    ranked = rows.select(
        F.substring_index("hash_key", ":", -1).alias("day"), F.col("field").alias("area"), pairs.alias("pair")
    )
    return ranked.select("day", "area", F.explode("pair").alias("ads_id", "click_count"))


def put_top3(path: str, run: str, every: int = 100) -> Put:
    """Put the rankings that a batch changed.

    Counts only grow, so an ad that a batch does not change and that was not among the
    three best cannot be now: the best are among the old ranking and the changed ads.
    """
    store = KeyedStore(path, every)

    def put(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        turn = store.begin(spark, batch_id, run)
        staged = f"{path}/staged/{turn.tag}"
        counted = changed.select("day", "area", "ads_id", "click_count", day_part("day").alias("part"))
        counted.write.partitionBy("part").parquet(staged)
        parts = [n.split("=", 1)[1] for n in child_names(spark, staged) if n.startswith("part=")]
        if parts:
            fresh = spark.read.schema(counted.schema).parquet(staged).drop("part")
            before = _leaders(store.read(spark, turn.base, parts))
            touched = fresh.select("day", "area").distinct()
            all_ = fresh.unionByName(before.join(touched, ["day", "area"], "left_semi"))
            best = all_.groupBy("day", "area", "ads_id").agg(F.max("click_count").alias("click_count"))
            store.put(top3_rows(top3_ads_per_day(best), day_part("day").alias("part")), turn)
        remove(spark, staged)

    return put


def start_top3(
    clicks: DataFrame, path: str, checkpoint: str, run: str, trigger: dict | None = None
) -> StreamingQuery:
    """Running top ads per day and area."""
    counts = clicks.groupBy("day", "area", "ads_id").agg(F.count("*").alias("click_count"))
    return _start(counts, put_top3(path, run), checkpoint, "update", trigger)


def _minute_part(moment: str) -> Column:
    return F.pmod(F.floor(F.unix_millis(moment) / 60_000), F.lit(MINUTE_PARTS)).cast("string")


def put_last_hour(root: str, snapshot: str, run: str, every: int = 100) -> Put:
    """Clicks by ad and minute of the exact sixty minutes up to the latest click.

    The latest time only grows, so clicks an hour before it are over for good and are not
    stored. The others are kept twice: counted by minute, and counted by millisecond in a
    folder for each minute. A batch reads the minute counts, and single moments
    of the one minute in which the hour begins.
    """
    manifest = Manifest(root)
    minutes = BatchTable(
        root, "ads_id STRING, minute TIMESTAMP, click_count BIGINT", ("ads_id", "minute"), "click_count",
        "sum", every, None, "minutes",
    )
    moments = BatchTable(
        root, "ads_id STRING, logdate TIMESTAMP, click_count BIGINT, part STRING",
        ("ads_id", "logdate", "part"), "click_count", "sum", every, "part", "moments",
    )

    def put(clicks: DataFrame, batch_id: int) -> None:
        spark = clicks.sparkSession
        turn = begin(spark, manifest, run, batch_id)
        newest = clicks.agg(F.max(F.unix_millis("logdate"))).first()[0]
        # A new checkpoint reads all accepted clicks again, so its run starts from empty tables.
        base = turn.base if turn.base.get("run") == run else {}
        known = [t for t in (newest, turn.base.get("latest")) if t is not None]
        if not known:
            return
        latest = max(known)
        first = F.timestamp_millis(F.lit(latest - HOUR_MS))
        live = clicks.where(F.col("logdate") > first).groupBy(
            "ads_id", "logdate", _minute_part("logdate").alias("part")
        ).agg(F.count("*").alias("click_count"))
        singles = moments.fold(spark, base.get("moments"), turn.tag, F.col("logdate") > first)
        singles, fresh = moments.put(live, singles, turn.number, turn.tag)
        whole = minutes.fold(spark, base.get("minutes"), turn.tag, F.col("minute") > first)
        counted = ads_minute_counts(fresh, "click_count").drop("hour_min")
        whole, _ = minutes.put(counted, whole, turn.number, turn.tag)

        part = str((latest - HOUR_MS) // 60_000 % MINUTE_PARTS)
        edge = moments.read(spark, singles, [part]).where(
            (F.col("logdate") > first) & (F.date_trunc("minute", "logdate") == F.date_trunc("minute", first))
        )
        inner = minutes.read(spark, whole).where(F.col("minute") > first)
        both = ads_minute_counts(edge, "click_count").drop("hour_min").unionByName(inner)
        counts = ads_minute_counts(both.withColumnRenamed("minute", "logdate"), "click_count")
        put_snapshot(last_hour_rows(minutes_json(counts)), snapshot, turn.number)
        turn.commit(spark, {"latest": latest, "minutes": whole, "moments": singles})

    return put


def start_last_hour(
    clicks: DataFrame, root: str, snapshot: str, checkpoint: str, run: str, trigger: dict | None = None
) -> StreamingQuery:
    """Clicks by ad and minute of the last hour, replaced with every batch."""
    return _start(clicks, put_last_hour(root, snapshot, run), checkpoint, "append", trigger)

