"""Page visits, page-to-page jumps and their conversion rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.columns import epoch_second, ratio_tenths
from clicktide.operators.sessions import tie_column
from clicktide.operators.skew import row_chunks
from clicktide.params import flow_pairs


def page_visit_counts(actions: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    """Visits of every page of the flow but the last."""
    return (
        actions.where(F.col("page_id").isin(*flow[:-1]))
        .groupBy("page_id")
        .agg(F.count("*").alias("visits"))
    )


def page_steps(actions: DataFrame) -> DataFrame:
    """Every action with the page that follows in its session, NULL after the last.

    A window over whole sessions would put a session with very many actions into
    one task. Long sessions are cut into chunks of rows instead. Inside a chunk a window
    finds the next page; only the first and last action of each chunk then go
    through a window over the session, which joins the chunks.
    """
    tie = tie_column(actions, "page_id")
    rows = actions.select(
        "session_id", "page_id",
        epoch_second(F.col("action_time")).alias("sec"), F.col(tie).alias("tie"),
    )
    in_chunk = Window.partitionBy("session_id", "chunk").orderBy("sec", "tie", "page_id")
    in_session = Window.partitionBy("session_id").orderBy("chunk", "is_last")
    # Any column of an action may be null, so the edges are told by a literal.
    chunked = row_chunks(rows, "session_id", ["sec", "tie", "page_id"]).withColumn("there", F.lit(True)).withColumns(
        {
            "next_page_id": F.lead("page_id").over(in_chunk),
            "is_last": F.lead("there").over(in_chunk).isNull(),
            "is_first": F.lag("there").over(in_chunk).isNull(),
        }
    )
    columns = ["session_id", "sec", "tie", "page_id", "next_page_id"]
    inner = chunked.where(~F.col("is_last")).select(*columns)
    edges = (
        chunked.where(F.col("is_first") | F.col("is_last"))
        .withColumn("next_page_id", F.lead("page_id").over(in_session))
        .where("is_last")
        .select(*columns)
    )
    return inner.unionByName(edges)


def _jump_text() -> Column:
    return F.concat_ws("-", F.col("page_id"), F.col("next_page_id"))


def _in_flow(flow: tuple[int, ...]) -> Column:
    pairs = [f"{a}-{b}" for a, b in flow_pairs(flow)]
    return F.col("next_page_id").isin(*flow[1:]) & _jump_text().isin(*pairs)


def page_jumps(actions: DataFrame) -> DataFrame:
    """Each step from one page to the next in a session."""
    return (
        page_steps(actions)
        .where(F.col("next_page_id").isNotNull())
        .select(
            "session_id", F.col("tie").alias("seq"), "page_id", "next_page_id",
            _jump_text().alias("page_jump"),
        )
    )


def _step_counts(actions: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    return (
        page_steps(actions)
        .where(F.col("page_id").isin(*flow[:-1]))
        .groupBy("page_id", "next_page_id")
        .agg(F.count("*").alias("steps"))
    )


def page_jump_counts(actions: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    """How often each adjacent pair of the flow occurs."""
    return (
        _step_counts(actions, flow)
        .where(_in_flow(flow))
        .select(_jump_text().alias("page_jump"), F.col("steps").alias("jumps"))
    )


def page_convert_rate(actions: DataFrame, flow: tuple[int, ...], task_id: str) -> DataFrame:
    """Jumps as percentage of the visits of their first page, for jumps that occur.

    Every visit is one row of ``page_steps``, so visits and jumps come from the
    same counts and the actions are read once.
    """
    visits = F.sum("steps").over(Window.partitionBy("page_id"))
    counted = _step_counts(actions, flow).withColumn("visits", visits)
    return counted.where(_in_flow(flow)).select(
        F.lit(task_id).alias("task_id"),
        _jump_text().alias("page_jump"),
        (ratio_tenths(F.col("steps"), F.col("visits")) / 10.0).alias("ratio"),
    )
