"""Session profiles, session shares and the proportional session sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.columns import (
    HOUR_FORMAT,
    SECOND_FORMAT,
    epoch_second,
    format_second,
    percent_1dp,
    session_action_kind,
)
from clicktide.operators.ranking import least_draws
from clicktide.operators.skew import row_chunks


def tie_column(df: DataFrame, fallback: str) -> str:
    """The column that orders actions of one second: ``seq`` where the table has it."""
    return "seq" if "seq" in df.columns else fallback


def session_profile(actions: DataFrame) -> DataFrame:
    """Steps and visit length of each session."""
    timed = actions.select("session_id", epoch_second(F.col("action_time")).alias("sec"))
    return timed.groupBy("session_id").agg(
        F.count("*").alias("step_length"),
        ((F.max("sec") - F.min("sec")) * 1000).alias("visit_length_ms"),
    )


def session_stat_info(profile: DataFrame, task_id: str, condition_json: str) -> DataFrame:
    """One row: number of sessions, and their shares by visit length and by steps."""
    long_visit = F.col("visit_length_ms") > 10_000
    many_steps = F.col("step_length") > 5
    counts = profile.agg(
        F.count("*").alias("session_count"),
        F.count_if(long_visit).alias("visit_gt_10"),
        F.count_if(~long_visit).alias("visit_le_10"),
        F.count_if(many_steps).alias("step_gt_5"),
        F.count_if(~many_steps).alias("step_le_5"),
    )
    total = F.col("session_count")
    shares = [
        percent_1dp(F.col(name), total).alias(f"{name}_ratio")
        for name in ("visit_gt_10", "visit_le_10", "step_gt_5", "step_le_5")
    ]
    return counts.select(
        F.lit(task_id).alias("task_id"), F.lit(condition_json).alias("condition"), total, *shares
    )


ITEM_OF_KIND = {
    "search": "search_keyword",
    "click": "click_product_id",
    "order": "order_product_ids",
    "pay": "pay_product_ids",
}


def _item_text() -> Column:
    """The item of an action of known kind as text."""
    text = F.lit(None)
    for kind, column in ITEM_OF_KIND.items():
        text = F.when(F.col("kind") == kind, F.col(column).cast("string")).otherwise(text)
    return text


def _joined_items(items: Column, kind: str) -> Column:
    """The items of one kind joined by commas; NULL when there is none."""
    of_kind = F.filter(items, lambda x: x["kind"] == kind)
    return F.when(F.size(of_kind) > 0, F.array_join(of_kind["item"], ","))


def _session_rows(actions: DataFrame) -> DataFrame:
    return actions.select(
        "session_id",
        epoch_second(F.col("action_time")).alias("sec"),
        F.col(tie_column(actions, "page_id")).alias("tie"),
        session_action_kind().alias("kind"),
        *ITEM_OF_KIND.values(),
    ).select("session_id", "sec", "tie", "kind", _item_text().alias("item"))


def _item_chunks(actions: DataFrame) -> DataFrame:
    """Actions of known kind in chunks by session, time and place; actions of no kind have no item."""
    items = _session_rows(actions).where(F.col("kind").isNotNull())
    return row_chunks(items, "session_id", ["sec", "tie", "kind", "item"])


def session_items(actions: DataFrame) -> DataFrame:
    """The items of each session and kind in order, one row each, for sessions of any length."""
    order = ["sec", "tie", "item"]
    chunked = _item_chunks(actions)
    in_chunk = Window.partitionBy("session_id", "kind", "chunk").orderBy(*order)
    earlier = (
        Window.partitionBy("session_id", "kind").orderBy("chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = chunked.groupBy("session_id", "kind", "chunk").agg(F.count("*").alias("n"))
    begins = sizes.select(
        "session_id", "kind", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    return (
        chunked.withColumn("nth", F.row_number().over(in_chunk))
        .join(begins, ["session_id", "kind", "chunk"])
        .select("session_id", "kind", (F.col("before") + F.col("nth")).alias("position"), "item")
    )


def session_info(actions: DataFrame, task_id: str) -> DataFrame:
    """Each session with its start, length and the items it searched, clicked, ordered, paid.

    Items stand in order of time. Steps and times are plain aggregates. The items
    of a long session are dealt by ranges of time into chunks of about equal rows and
    joined chunk by chunk, so a session with very many actions, even within one
    second, is spread over many tasks; only finished text meets in the last step.
    """
    steps = (
        _session_rows(actions).groupBy("session_id")
        .agg(
            F.count("*").alias("steps"),
            F.min("sec").alias("first_sec"),
            F.max("sec").alias("last_sec"),
        )
    )
    chunks = (
        _item_chunks(actions).groupBy("session_id", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("sec", "tie", "kind", "item"))).alias("items"))
        .select(
            "session_id", "chunk",
            *[_joined_items(F.col("items"), kind).alias(kind) for kind in ITEM_OF_KIND],
        )
    )
    texts = chunks.groupBy("session_id").agg(
        F.sort_array(F.collect_list(F.struct("chunk", *ITEM_OF_KIND))).alias("chunks")
    )

    def joined(name: str) -> Column:
        return F.coalesce(F.array_join(F.col("chunks")[name], ","), F.lit(""))

    return steps.join(texts, "session_id", "left").select(
        F.lit(task_id).alias("taskId"),
        F.col("session_id").alias("sessionId"),
        format_second(F.col("first_sec"), SECOND_FORMAT).alias("startTime"),
        F.col("steps").alias("stepLenth"),
        ((F.col("last_sec") - F.col("first_sec")) * 1000).alias("visitLenth"),
        joined("search").alias("searchKeyWords"),
        joined("click").alias("clickProductIds"),
        joined("order").alias("orderProductIds"),
        joined("pay").alias("payProductIds"),
    )


def _session_hours(actions: DataFrame) -> DataFrame:
    starts = actions.groupBy("session_id").agg(
        F.min(epoch_second(F.col("action_time"))).alias("start_sec")
    )
    return starts.select(
        "session_id", format_second(F.col("start_sec"), HOUR_FORMAT).alias("day_hour")
    )


def _quotas(hours: DataFrame, target: int) -> DataFrame:
    # The unpartitioned window sees one row per hour of the data, not sessions.
    total = F.sum("n_sessions").over(Window.partitionBy())
    quota = F.floor(F.col("n_sessions") / total.cast("double") * target + 0.5)
    counts = hours.groupBy("day_hour").agg(F.count("*").alias("n_sessions"))
    return counts.withColumn("quota", quota)


def sessions_per_hour(actions: DataFrame, target: int = 1000) -> DataFrame:
    """Sessions by the hour they began in, and how many of ``target`` that hour gets."""
    return _quotas(_session_hours(actions), target)


def sampled_session_ids(actions: DataFrame, target: int = 1000, seed: str = "0") -> DataFrame:
    """Ids of a sample of about ``target`` sessions, proportional to sessions per hour.

    Within an hour the sessions with the least hashes are taken, so the sample
    has exactly the quota of each hour and is the same in every run.
    """
    hours = _session_hours(actions)
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("session_id")))
    quotas = _quotas(hours, target).select("day_hour", "quota")
    chosen = least_draws(hours.withColumn("draw", draw), quotas, "day_hour", "draw", "session_id")
    return chosen.select("session_id")


def session_sample(
    actions: DataFrame, task_id: str, target: int = 1000, seed: str = "0"
) -> DataFrame:
    """``session_info`` of the sampled sessions only."""
    chosen = sampled_session_ids(actions, target, seed)
    kept = actions.join(chosen, "session_id", "left_semi")
    return session_info(kept.select(*actions.columns), task_id)
