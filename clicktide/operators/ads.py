"""Ad clicks: parsing, black list, counts by region and minute. Batch forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.columns import DAY_FORMAT, MINUTE_FORMAT, pairs_json
from clicktide.operators.ranking import first_k
from clicktide.session import new_scratch_dir

CLICK_LIMIT = 10_000
BATCH_SECONDS = 5


# A time in digits, three more fields and a fifth that is not blank to the end.
LINE_PATTERN = r"(?s)^[+-]?[0-9]+( [^ ]*){3} .*[^ ]"
# The years 1 to 9999 in milliseconds; a time outside has no day in four-digit form.
FIRST_MILLI = -62_135_596_800_000
LAST_MILLI = 253_402_300_799_999


def _well_formed() -> Column:
    # Tested on the text itself: a test on the split fields would be pushed below
    # the split and repeat it.
    millis = F.substring_index("value", " ", 1).try_cast("bigint")
    in_range = millis.between(FIRST_MILLI, LAST_MILLI)
    return F.coalesce(F.col("value").rlike(LINE_PATTERN) & in_range, F.lit(False))


def ads_log_parse(lines: DataFrame) -> DataFrame:
    """Clicks from text lines ``<epoch ms> <area> <city> <user> <ad>``.

    Further fields are ignored. Lines that are not of this form are left to
    ``malformed_lines``.
    """
    extra = [c for c in lines.columns if c != "value"]
    fields = F.split(F.col("value"), " ", 6)
    parts = F.col("parts")
    return (
        lines.where(_well_formed())
        .select(*extra, fields.alias("parts"))
        .withColumn("logdate", F.timestamp_millis(parts[0].try_cast("bigint")))
        .select(
            *extra,
            "logdate",
            parts[1].alias("area"),
            parts[2].alias("city"),
            parts[3].alias("user_id"),
            parts[4].alias("ads_id"),
            F.date_format("logdate", DAY_FORMAT).alias("day"),
            F.date_format("logdate", MINUTE_FORMAT).alias("hour_min"),
        )
    )


def malformed_lines(lines: DataFrame) -> DataFrame:
    """The lines that ``ads_log_parse`` does not read."""
    return lines.where(~_well_formed())


def with_batch(clicks: DataFrame, seconds: int = BATCH_SECONDS) -> DataFrame:
    """Number the micro-batches by event time, for a log that carries no batch number."""
    return clicks.withColumn("batch", F.floor(F.unix_millis("logdate") / (seconds * 1000)))


def _batch_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per user, ad, day and batch, and the count stored before the batch."""
    earlier = (
        Window.partitionBy("user_id", "ads_id", "day")
        .orderBy("batch")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        clicks.groupBy("user_id", "ads_id", "day", "batch")
        .agg(F.count("*").alias("clicks"))
        .withColumn("prior", F.coalesce(F.sum("clicks").over(earlier), F.lit(0)))
    )


def user_blacklist(clicks: DataFrame, limit: int = CLICK_LIMIT) -> DataFrame:
    """Users listed for ever once they click an ad again on a day after ``limit`` clicks.

    ``clicks`` carries the number of the micro-batch in ``batch``. Up to the
    batch that lists a user all the user's clicks pass, so the listing batch
    follows from the unfiltered counts and no iteration is needed.
    """
    return (
        _batch_counts(clicks)
        .where(F.col("prior") >= limit)
        .groupBy("user_id")
        .agg(F.min("batch").alias("listed_batch"))
    )


def _not_listed(df: DataFrame, blacklist: DataFrame) -> DataFrame:
    # The list is written once. Spark then knows its size and either sends it to all
    # tasks or joins two plain shuffles, of which it can split a hot user's.
    path = new_scratch_dir(df.sparkSession, "user-blacklist")
    blacklist.write.parquet(path)
    listed = df.sparkSession.read.parquet(path)
    still_open = F.col("listed_batch").isNull() | (F.col("batch") <= F.col("listed_batch"))
    return df.join(listed, "user_id", "left").where(still_open).drop("listed_batch")


def ads_log_filtered(clicks: DataFrame, limit: int = CLICK_LIMIT) -> DataFrame:
    """Clicks whose user was not on the black list when their batch began."""
    return _not_listed(clicks, user_blacklist(clicks, limit)).select(*clicks.columns)


def user_ads_count_perday(clicks: DataFrame, limit: int = CLICK_LIMIT) -> DataFrame:
    """Stored clicks per user, ad and day.

    A key that has reached the limit is not increased any more; other ads of
    the user still are in the batch that lists the user.
    """
    open_counts = _not_listed(_batch_counts(clicks), user_blacklist(clicks, limit))
    return (
        open_counts.where(F.col("prior") < limit)
        .groupBy("user_id", "ads_id", "day")
        .agg(F.sum("clicks").alias("click_count"))
    )


def _clicks(count_col: str | None) -> Column:
    return F.sum(count_col) if count_col else F.count("*")


def area_city_ads_day_clickcount(
    clicks: DataFrame, count_col: str | None = None
) -> DataFrame:
    """Clicks per area, city, ad and day. Also runs on a stream."""
    return clicks.groupBy("area", "city", "ads_id", "day").agg(
        _clicks(count_col).alias("click_count")
    )


def area_ads_day_count(city_counts: DataFrame) -> DataFrame:
    """City counts rolled up to area, ad and day."""
    return city_counts.groupBy("area", "ads_id", "day").agg(
        F.sum("click_count").alias("click_count")
    )


def top3_ads_per_day(area_counts: DataFrame, k: int = 3) -> DataFrame:
    """The k ads with most clicks per day and area, as JSON text.

    ``area_counts`` is normally the roll-up of ``area_ads_day_count``. Given
    counts by city instead, one ad may take several of the k places.
    """
    order = [F.desc("click_count"), F.asc("ads_id")]
    if "city" in area_counts.columns:
        order.append(F.asc("city"))
    best = first_k(area_counts, ["day", "area"], order, k)
    # At most k rows per group are collected.
    listed = F.sort_array(F.collect_list(F.struct("rn", "ads_id", "click_count")))
    return (
        best.groupBy("day", "area")
        .agg(listed.alias("ads"))
        .select("day", "area", pairs_json(F.col("ads"), "ads_id", "click_count").alias("top_ads"))
    )


def last_hour_clicks(clicks: DataFrame, as_of: str | None = None) -> DataFrame:
    """Clicks of the hour up to ``as_of``, by default up to the latest click that is not in the future."""
    past = clicks.where(F.col("logdate") <= F.current_timestamp())
    end = (
        F.lit(as_of).cast("timestamp")
        if as_of
        else past.agg(F.max("logdate").alias("as_of")).scalar()
    )
    begin = end - F.expr("INTERVAL 60 MINUTES")
    return clicks.where((F.col("logdate") > begin) & (F.col("logdate") <= end))


def ads_minute_counts(clicks: DataFrame, count_col: str | None = None) -> DataFrame:
    """Clicks per ad and minute."""
    minute = F.date_trunc("minute", "logdate").alias("minute")
    return (
        clicks.groupBy("ads_id", minute)
        .agg(_clicks(count_col).alias("click_count"))
        .select(
            "ads_id", "minute",
            F.date_format("minute", MINUTE_FORMAT).alias("hour_min"), "click_count",
        )
    )


def minutes_json(minute_counts: DataFrame) -> DataFrame:
    """Per ad the list of (minute, clicks) as JSON text; an hour has at most 61 minutes."""
    listed = F.sort_array(F.collect_list(F.struct("minute", "hour_min", "click_count")))
    return (
        minute_counts.groupBy("ads_id")
        .agg(listed.alias("minutes"))
        .select(
            "ads_id",
            pairs_json(F.col("minutes"), "hour_min", "click_count").alias("minute_clicks"),
        )
    )


def last_hour_ads_click(clicks: DataFrame, as_of: str | None = None) -> DataFrame:
    """Clicks per minute of the last hour for each ad, as JSON text."""
    return minutes_json(ads_minute_counts(last_hour_clicks(clicks, as_of)))
