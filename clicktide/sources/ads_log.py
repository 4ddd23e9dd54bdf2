"""The stream of ad-click lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.schemas import ADS_LINE

TOPIC = "ads_log"


def kafka_options(
    servers: str, topic: str = TOPIC, starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options; offsets live in the checkpoint of the query, not in a consumer group."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def ads_source(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """Lines as a stream: ``value``, where it comes from as ``origin``, and its ``place`` there.

    Origins are the partitions of the topic, places their offsets; a file is an origin of
    one place. ``fmt`` is ``kafka`` (options of ``kafka_options``, connector on the
    classpath) or a file format: ``text`` or ``parquet`` with ``path``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        origin, place = F.concat_ws(":", "topic", "partition"), F.col("offset")
    else:
        reader = reader.schema(ADS_LINE)
        origin, place = F.col("_metadata.file_path"), F.lit(0).cast("bigint")
    value = F.col("value").cast("string").alias("value")
    return reader.load().select(value, origin.alias("origin"), place.alias("place"))
