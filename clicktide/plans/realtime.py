"""The streaming job: the gate, and three reports that follow its accepted clicks."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clicktide.operators.ads import CLICK_LIMIT
from clicktide.session import build_session
from clicktide.sinks.keyed import KeyedStore
from clicktide.sources.ads_log import TOPIC, ads_source, kafka_options
from clicktide.streaming import reports
from clicktide.streaming.gate import GateStore, accepted_stream, run_name, start_gate

COUNTS = "area_city_ads_day_clickcount"
TOP3 = "top3_ads_per_day"
LAST_HOUR = "last_hour_ads_click"


def gate_store(root: str) -> GateStore:
    return GateStore(f"{root}/gate")


def run_gate(
    lines: DataFrame, root: str, limit: int = CLICK_LIMIT, trigger: dict | None = None
) -> StreamingQuery:
    return start_gate(lines, gate_store(root), f"{root}/checkpoints/gate", limit, trigger)


def run_report(
    spark: SparkSession, root: str, name: str, trigger: dict | None = None, **options: str
) -> StreamingQuery:
    """Start the report of this name on the accepted clicks; ``options`` go to their reader."""
    clicks = accepted_stream(spark, gate_store(root), **options)
    checkpoint = f"{root}/checkpoints/{name}"
    run = run_name(spark, checkpoint)
    if name in (COUNTS, TOP3):
        store = KeyedStore(f"{root}/{name}")
        store.manifest.sweep(spark, "staged", *store.table.folders)
    if name == COUNTS:
        return reports.start_city_counts(clicks, f"{root}/{COUNTS}", checkpoint, run, trigger)
    if name == TOP3:
        return reports.start_top3(clicks, f"{root}/{TOP3}", checkpoint, run, trigger)
    if name == LAST_HOUR:
        return reports.start_last_hour(
            clicks, f"{root}/last-hour-store", f"{root}/{LAST_HOUR}", checkpoint, run, trigger
        )
    raise ValueError(f"no report {name}")


def start_all(lines: DataFrame, root: str, limit: int = CLICK_LIMIT) -> list[StreamingQuery]:
    """Start the gate and all reports, everything below ``root``."""
    spark = lines.sparkSession
    return [run_gate(lines, root, limit)] + [run_report(spark, root, n) for n in (COUNTS, TOP3, LAST_HOUR)]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="streaming ad reports")
    parser.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    parser.add_argument("--topic", default=TOPIC)
    parser.add_argument("--root", required=True, help="shared folder for output and checkpoints")
    parser.add_argument("--limit", type=int, default=CLICK_LIMIT)
    parser.add_argument("--max-offsets-per-trigger", type=int)
    args = parser.parse_args(argv)
    spark = build_session("streaming ad reports")
    root = args.root.rstrip("/")
    # A run without a checkpoint goes on where the store is, the first of all at the end of the topic.
    begin = gate_store(root).next_offsets(spark, args.topic) or "latest"
    options = kafka_options(args.servers, args.topic, begin, args.max_offsets_per_trigger)
    start_all(ads_source(spark, **options), root, args.limit)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
