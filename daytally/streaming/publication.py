"""Which runs of a report its readers see.

A fresh run of a report counts all records again, so for a while its totals are short. Its
rows are kept apart until it has caught up: until it has read what there was when it began,
and the report's table holds all that it had written by then. Then its number is published,
and all its totals are seen at once. Under a report's folder:

    caught_up/version=<v>/   the run of version v had read, by then, all there was at its start
    published/run=<n>/       readers see run n

The first run is published as it begins: there is nothing that it could hide. Without any
published run, as in a table that no report job has written to, all rows are seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from daytally.operators.latest import VERSION, first_version, run_of
from daytally.session import ensure_folder, folder_numbers, newest_complete


def published_runs(spark: SparkSession, root: str) -> list[int]:
    return folder_numbers(spark, f"{root}/published", "run")


def publish(spark: SparkSession, root: str, run: int) -> None:
    ensure_folder(spark, f"{root}/published/run={run}")


def in_runs(runs: Sequence[int], version: str = VERSION) -> Column:
    """Whether a row is of one of ``runs``, told by its version; of any, if there are none."""
    found = F.lit(not runs)
    for run in runs:
        found = found | F.col(version).between(first_version(run), first_version(run + 1) - 1)
    return found


def in_runs_sql(runs: Sequence[int], version: str = VERSION) -> str:
    between = (f"{version} BETWEEN {first_version(r)} AND {first_version(r + 1) - 1}" for r in runs)
    return f"({' OR '.join(between)})" if runs else "TRUE"


def begin_run(spark: SparkSession, root: str, run: int) -> None:
    """Publish a run that is the first; else those that have written, if none is published."""
    if not published_runs(spark, root):
        written = {run_of(v) for v in folder_numbers(spark, f"{root}/changelog", VERSION)}
        for first in written or {run}:
            publish(spark, root, first)


def is_behind(spark: SparkSession, root: str, run: int) -> bool:
    """Whether a run has yet to read what there was when it began."""
    caught_up = {run_of(v) for v in folder_numbers(spark, f"{root}/caught_up", VERSION)}
    return run not in caught_up and run not in published_runs(spark, root)


def mark_caught_up(spark: SparkSession, root: str, run: int) -> None:
    newest = newest_complete(spark, f"{root}/changelog", VERSION)
    ensure_folder(spark, f"{root}/caught_up/{VERSION}={max(newest or 0, first_version(run))}")


def waiting(spark: SparkSession, root: str) -> list[int]:
    """The versions at which runs that are not published yet had caught up."""
    shown = published_runs(spark, root)
    if not shown:
        return []
    return sorted(v for v in folder_numbers(spark, f"{root}/caught_up", VERSION) if run_of(v) not in shown)
