"""Run the session analysis and append its six reports.

    spark-submit --py-files footfall.zip footfall/plans/session_job.py \\
        --actions user_visit_action --users user_info --products product_info \\
        --params '{startDate:"2024-01-01", endDate:"2024-01-31", startAge:20, endAge:50,
                   targetPageFlow:"1,2,3,4,5,6,7"}' \\
        --out /warehouse/reports

With ``--jdbc-url`` the reports go to database tables of the same names.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.params import TaskParams
from footfall.plans.session_report import build_reports, save_reports
from footfall.session import build_session
from footfall.sinks.writers import append_files, append_jdbc, jdbc_options, replace_run
from footfall.sources.tables import city_areas, load_table, typed_actions


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--actions", required=True, help="table name, or folder of parquet files")
    parser.add_argument("--users", required=True)
    parser.add_argument("--products", required=True)
    parser.add_argument("--params", required=True, help="task parameters as JSON")
    parser.add_argument("--task-id", default=None, help="default: a new random id")
    parser.add_argument("--sample-size", type=int, default=1000)
    parser.add_argument("--sample-seed", default="0")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--out", help="folder to append parquet files to")
    parser.add_argument("--replace", action="store_true",
                        help="with --out: file reports by task id, so that a repeated run replaces itself")
    target.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-user")
    parser.add_argument("--jdbc-password")
    parser.add_argument("--jdbc-driver")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="[TABLE:]NAME=VALUE",
                        help="a writer option such as isolationLevel=NONE, for all tables or for one")
    return parser.parse_args(given)


def table_options(given: list[str], table: str) -> dict[str, str]:
    """The options for all tables, then those for this one."""
    named = [option.split("=", 1) for option in given]
    general = {name: value for name, value in named if ":" not in name}
    own = {name.split(":", 1)[1]: value for name, value in named if name.split(":", 1)[0] == table and ":" in name}
    return {"batchsize": "10000", **general, **own}


def sink(args: argparse.Namespace) -> Callable[[DataFrame, str], None]:
    if args.out:
        write = replace_run if args.replace else append_files
        return lambda report, name: write(report, f"{args.out}/{name}")
    return lambda report, name: append_jdbc(report, jdbc_options(
        args.jdbc_url, name, args.jdbc_user, args.jdbc_password, args.jdbc_driver,
        **table_options(args.jdbc_option, name)
    ))


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    """Build and append the reports; returns the task id."""
    task_id = args.task_id or str(uuid.uuid4())
    actions = load_table(spark, args.actions)
    if dict(actions.dtypes)["action_time"] == "string":
        actions = typed_actions(actions)
    reports = build_reports(
        actions, load_table(spark, args.users), load_table(spark, args.products), city_areas(spark),
        TaskParams.from_json(spark, args.params), task_id, args.sample_size, args.sample_seed,
    )
    save_reports(reports, sink(args))
    return task_id


if __name__ == "__main__":
    print(run(build_session("session-report"), arguments()))
