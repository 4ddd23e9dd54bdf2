"""The batch reports on selected user actions, in one run."""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clicktide.files import remove
from clicktide.operators.actions import filtered_actions
from clicktide.operators.categories import (
    category_action_counts,
    category_session_counts,
    category_top10,
    category_top10_session_count,
)
from clicktide.operators.pages import page_convert_rate
from clicktide.operators.sessions import session_profile, session_sample, session_stat_info
from clicktide.params import Condition
from clicktide.session import build_session, new_scratch_dir
from clicktide.sinks.tables import jdbc_append, save_table
from clicktide.sources.tables import load_tables

Sink = Callable[[str, DataFrame], None]


def offline_reports(
    actions: DataFrame,
    condition: Condition,
    task_id: str,
    sample_target: int = 1000,
    seed: str = "0",
    order_ids_col: str = "order_category_ids",
    keep: Callable[[DataFrame], DataFrame] = lambda report: report,
) -> dict[str, DataFrame]:
    """All reports by the name of their output table, on already selected actions.

    ``keep`` may store a report that another one uses.
    """
    top10 = keep(category_top10(category_action_counts(actions, order_ids_col), task_id))
    clicks = category_session_counts(actions, top10)
    return {
        "session_stat_info": session_stat_info(
            session_profile(actions), task_id, condition.to_json()
        ),
        "random_session_info": session_sample(actions, task_id, sample_target, seed),
        "category_top10": top10,
        "category_top10_session_count": category_top10_session_count(clicks, task_id),
        "page_convert_rate": page_convert_rate(actions, condition.target_page_flow, task_id),
    }


def run_offline(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    condition: Condition,
    task_id: str,
    put: Sink,
    **options,
) -> None:
    """Select the actions once and write every report.

    The selection is stored as parquet in the shared folder: each report then
    reads only its columns, and nothing is lost with an executor.
    """
    path = new_scratch_dir(spark, "selected-actions")
    selected = filtered_actions(tables["user_visit_action"], tables["user_info"], condition)
    save_table(selected, path=path)
    try:
        stored = spark.read.schema(selected.schema).parquet(path)

        def keep(report: DataFrame) -> DataFrame:
            save_table(report, path=f"{path}-top10")
            return spark.read.schema(report.schema).parquet(f"{path}-top10")

        reports = offline_reports(stored, condition, task_id, keep=keep, **options)
        for name, report in reports.items():
            put(name, report)
    finally:
        remove(spark, path)
        remove(spark, f"{path}-top10")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="batch reports on user actions")
    parser.add_argument("--database")
    parser.add_argument("--hive", action="store_true", help="tables of the Hive metastore")
    parser.add_argument("--path", help="folder of parquet tables instead of a database")
    parser.add_argument("--condition", required=True, help="JSON text")
    parser.add_argument("--task-id", default=str(uuid.uuid4()))
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-user")
    parser.add_argument("--jdbc-password-conf", help="session setting that holds the password")
    parser.add_argument("--out", help="folder for parquet output instead of a database")
    args = parser.parse_args(argv)
    if not (args.jdbc_url or args.out):
        parser.error("one of --jdbc-url and --out is needed")
    spark = build_session("offline reports", hive=args.hive)

    def put(name: str, report: DataFrame) -> None:
        if args.out:
            report.write.mode("append").parquet(f"{args.out.rstrip('/')}/{name}")
        else:
            secret = args.jdbc_password_conf and spark.conf.get(args.jdbc_password_conf)
            jdbc_append(report, args.jdbc_url, name, args.jdbc_user, secret)

    tables = load_tables(spark, args.database, args.path)
    run_offline(spark, tables, Condition.from_json(args.condition), args.task_id, put)


if __name__ == "__main__":
    main()
