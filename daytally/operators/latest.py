"""Latest value per key: how a keyed table is read from rows that only get appended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.operators.reports import Report

VERSION = "version"
OFFSET = "offset"
ARRIVED = "arrived_at"

# A version is (run, batch) in one BIGINT, so the aggregate below keeps fixed-width
# buffers and Spark can hash instead of sort. The lowest bit tells a batch from a fold:
# all versions of the run, and of those before it, up to that batch as one.
_BATCH_BITS = 40


def version_of(run: int, batch: int) -> int:
    return (run << _BATCH_BITS) | (batch << 1)


def fold_of(version: int) -> int:
    return version | 1


def run_of(version: int) -> int:
    return version >> _BATCH_BITS


def first_version(run: int) -> int:
    return run << _BATCH_BITS


def run_column() -> Column:
    return F.shiftright(VERSION, _BATCH_BITS)


def latest_rows(report: Report, changes: DataFrame, keep_version: bool = False, apart: Column | None = None) -> DataFrame:
    """One row per key of ``report``, taken from the row with the highest version; rows that
    differ in ``apart`` each keep one of their own.

    Partial aggregation before the shuffle keeps one row per key and task, so a key
    with very many versions costs no more than any other.
    """
    keys = [F.col(k) for k in report.key_names] + ([] if apart is None else [apart.alias("_apart")])
    version = F.max(VERSION).alias(VERSION)
    if report.keys_may_merge:
        # Rows of one version can differ here; break the tie by value so that the
        # result does not depend on the order of arrival.
        newest = F.max(F.struct(VERSION, *report.measure_names)).alias("newest")
        rows = changes.groupBy(*keys).agg(newest).select(*report.key_names, "newest.*")
    else:
        picked = [F.max_by(m, VERSION).alias(m) for m in report.measure_names]
        rows = changes.groupBy(*keys).agg(*picked, version)
    return rows.select(*report.columns, *([VERSION] if keep_version else []))


def latest_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key: the greatest by ``order``, then by its other columns.

    The row travels once, as the value that is compared. Of a key with very many rows
    each task sends one.
    """
    others = [c for c in rows.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *others)).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*rows.columns)


def latest_records(raw: DataFrame, resent_same_day: bool = False) -> DataFrame:
    """The raw table as its users see it: one row per ``ts_id``, the last one sent.

    What counts is the place in the topic, never a clock. A topic puts all messages of
    one key in one order; of messages without a place the last to arrive is taken.
    With ``resent_same_day`` the caller states that a resent record keeps its
    ``ts_date``; the date then joins the key, and a filter on it prunes partitions.
    """
    keys = ["ts_id", "ts_date"] if resent_same_day else ["ts_id"]
    return latest_by(raw, keys, [OFFSET, ARRIVED]).drop(OFFSET, ARRIVED)
