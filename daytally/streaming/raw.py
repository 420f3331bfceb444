"""The raw table: one row per record id, read from folds and the few parts after them.

Layout under ``<root>/intake``:

    parts/part=<p>/reason=<r>/ts_date=<d>/   judged messages of micro-batch p; appears whole
    records/fold=<n>/ts_date=<d>/            good records of folded parts, the day's segment
    moved/fold=<n>/                          which records of live segments were sent again later
    quarantine/fold=<n>/                     bad messages of folded parts
    manifests/<n>_<p>/                       live segments; the parts up to p are in folds up to n
    readers/<report>/run=<k>/                what a report that reads the parts has of them

A fold takes the parts since the one before. A day's records in it are a new segment of the
day; segments of a day are merged in tiers, so a day has few of them however often it is
added to, and a record is written again about once a tier. Of messages that were sent more
than once the last one is ``newest``; the others stay for reports that begin anew, equal
ones as one row that counts them (``sent``). A record of an earlier segment that comes again
is named in ``moved``, and its segment is left alone until it is merged. So a reader of one
day opens that day's segments, the names of its moved records, and the parts that are not
folded yet, whose number is bounded.

The intake takes the topic in order, so a later part holds what was sent later. A part may go
when two manifests hold it and every report has read beyond it. One process folds at a time;
readers go on, as what a fold replaces is removed by the next one.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.envelope import RAW, REASON
from daytally.operators.latest import ARRIVED, OFFSET, latest_by
from daytally.operators.reports import Report
from daytally.schemas import RECORD, RECORD_FIELDS, nullable
from daytally.session import (
    ensure_folder,
    folder_exists,
    folder_names,
    folder_numbers,
    is_complete,
    move_folder,
    new_folder,
    remove_folder,
    require_markers,
    settings,
)
from daytally.sources.files import batch_limit
from daytally.streaming.publication import published_runs

PART = "part"
FOLD = "fold"
DAY = "ts_date"
SENT = "sent"
NEWEST = "newest"

# Where parts keep records without fault.
GOOD = "good"

# Segments of a day and tier that are merged into one of the next tier.
FAN = 8

WATERMARK = "1 minute"

_OTHERS = [c for c in RECORD_FIELDS if c != DAY]
_SEGMENTS = T.StructType().add(FOLD, "long").add(DAY, "date").add("level", "integer").add("live", "boolean")


def intake_schema() -> T.StructType:
    """Folder columns come last, as Spark puts them: a stream may start on an empty folder
    and cannot tell them from the others before the first file is there."""
    fields = [f for f in nullable(RECORD) if f.name != DAY]
    kept = T.StructType(fields).add(RAW, "string").add(OFFSET, "long").add(ARRIVED, "timestamp")
    return kept.add(PART, "long").add(REASON, "string").add(DAY, "date")


def records_schema() -> T.StructType:
    fields = [f for f in nullable(RECORD) if f.name != DAY]
    kept = T.StructType(fields).add(OFFSET, "long").add(ARRIVED, "timestamp").add(SENT, "long").add(NEWEST, "boolean")
    return kept.add(FOLD, "long").add(DAY, "date")


def quarantine_schema() -> T.StructType:
    return T.StructType().add(REASON, "string").add(RAW, "string").add(ARRIVED, "timestamp").add(FOLD, "long")


# Parts


def write_part(rows: DataFrame, root: str, part: int) -> None:
    """Write a micro-batch once, whatever fails in between.

    It is written aside and moved when it is whole: a stream that reads the parts never sees
    a file of an attempt that failed. A day, or reason, is split by its measured size, so one
    that has a third of the batch is written by as many tasks as its bytes ask for.
    """
    spark = rows.sparkSession
    require_markers(spark)
    path, aside = f"{root}/intake/parts/{PART}={part}", f"{root}/intake/staging/{PART}={part}"
    if is_complete(spark, path) and not folder_exists(spark, aside):
        return
    if not is_complete(spark, aside):
        with settings(spark, {"spark.sql.adaptive.enabled": "true"}):
            split = rows.hint("rebalance", F.col(REASON), F.col(DAY))
            split.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(REASON, DAY).parquet(aside)
    move_folder(spark, aside, path)


def read_parts(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(intake_schema()).parquet(ensure_folder(spark, f"{root}/intake/parts"))


def complete_parts(spark: SparkSession, root: str) -> list[int]:
    """Highest first."""
    path = f"{root}/intake/parts"
    return [p for p in folder_numbers(spark, path, PART) if is_complete(spark, f"{path}/{PART}={p}")]


# Folds


@dataclass(frozen=True)
class Segment:
    """Records of a day, or with no day bad messages, in one fold."""

    fold: int
    day: str | None
    level: int


@dataclass(frozen=True)
class Manifest:
    """``dead``: segments that the manifest's own fold merged; the next fold removes them."""

    number: int
    part: int
    live: tuple[Segment, ...]
    dead: tuple[Segment, ...]


def _manifest_names(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """(number, part) of the complete manifests, newest first."""
    path = f"{root}/intake/manifests"
    names = [n for n in folder_names(spark, path) if n.replace("_", "").isdigit() and is_complete(spark, f"{path}/{n}")]
    return sorted((tuple(map(int, n.split("_"))) for n in names), reverse=True)


def newest_manifest(spark: SparkSession, root: str) -> Manifest | None:
    """A row for each day and tier, however many records there are."""
    names = _manifest_names(spark, root)
    if not names:
        return None
    number, part = names[0]
    rows = spark.read.schema(_SEGMENTS).parquet(f"{root}/intake/manifests/{number}_{part}").collect()
    kept = [(Segment(r[FOLD], r[DAY] and str(r[DAY]), r["level"]), r["live"]) for r in rows]
    return Manifest(number, part, tuple(s for s, live in kept if live), tuple(s for s, live in kept if not live))


def _write_manifest(spark: SparkSession, root: str, manifest: Manifest) -> None:
    rows = [(s.fold, s.day, s.level, live) for segments, live in ((manifest.live, True), (manifest.dead, False)) for s in segments]
    table = spark.createDataFrame(rows, "fold long, day string, level int, live boolean")
    table.select(FOLD, F.to_date("day").alias(DAY), "level", "live").coalesce(1).write.mode("overwrite").parquet(
        f"{root}/intake/manifests/{manifest.number}_{manifest.part}"
    )


def _is_one_of(segments: list[Segment] | tuple[Segment, ...], fold: str = FOLD) -> Column:
    """Whether a row is in one of ``segments`` of days; told by folder names, unopened."""
    days = defaultdict(list)
    for s in segments:
        days[s.day].append(s.fold)
    found = F.lit(False)
    for day, folds in days.items():
        if day is not None:
            found = found | ((F.col(DAY) == F.lit(day).cast("date")) & F.col(fold).isin(folds))
    return found


def _live_sql(manifest: Manifest) -> str:
    dead = [f"({DAY} = DATE'{s.day}' AND {FOLD} = {s.fold})" for s in manifest.dead if s.day is not None]
    return f"{FOLD} <= {manifest.number}" + "".join(f" AND NOT {d}" for d in dead)


def _segments(spark: SparkSession, root: str, manifest: Manifest) -> DataFrame:
    """All rows of live segments, records that were sent again later included."""
    rows = spark.read.schema(records_schema()).parquet(f"{root}/intake/records")
    return rows.filter((F.col(FOLD) <= manifest.number) & ~_is_one_of(manifest.dead))


def _moved(spark: SparkSession, root: str, manifest: Manifest) -> DataFrame:
    """(ts_id, ts_date, in_fold)"""
    return spark.read.schema("ts_id string, ts_date date, in_fold long").parquet(f"{root}/intake/moved/{FOLD}={manifest.number}")


def _settled(spark: SparkSession, root: str, manifest: Manifest) -> DataFrame:
    """The newest record of each id in the folds."""
    moved = _moved(spark, root, manifest).withColumnRenamed("in_fold", FOLD)
    return _segments(spark, root, manifest).filter(NEWEST).join(moved, ["ts_id", DAY, FOLD], "left_anti")


def _bad_folds(spark: SparkSession, root: str, manifest: Manifest) -> DataFrame:
    rows = spark.read.schema(quarantine_schema()).parquet(f"{root}/intake/quarantine")
    return rows.filter(F.col(FOLD).isin([s.fold for s in manifest.live if s.day is None]))


def _written(rows: DataFrame, path: str, *folders: str) -> None:
    with settings(rows.sparkSession, {"spark.sql.adaptive.enabled": "true"}):
        rows.hint("rebalance", *map(F.col, folders)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            *folders
        ).parquet(path)


def _merged(live: list[Segment]) -> tuple[list[Segment], int]:
    """Which segments of one day a new one takes in, and its tier."""
    taken, level = [], 0
    while len(tier := [s for s in live if s.level == level]) >= FAN - 1:
        taken, level = taken + tier, level + 1
    return taken, level


def _counted(rows: DataFrame) -> DataFrame:
    """Equal records as one, with how often they were sent and the last place and arrival.

    All that is aggregated has a fixed width, so Spark hashes the records and sorts none."""
    at_last = F.coalesce(F.max_by(ARRIVED, OFFSET), F.max(ARRIVED)).alias(ARRIVED)  # without places, the last to arrive
    sums = F.max(OFFSET).alias(OFFSET), at_last, F.sum(SENT).alias(SENT), F.max(NEWEST).alias(NEWEST)
    return rows.groupBy(*RECORD_FIELDS).agg(*sums).select(*RECORD_FIELDS, OFFSET, ARRIVED, SENT, NEWEST)


def fold(spark: SparkSession, root: str) -> Manifest | None:
    """Take all complete parts since the last fold into a new one; returns its manifest."""
    before, parts = newest_manifest(spark, root), complete_parts(spark, root)
    if not parts or (before is not None and parts[0] <= before.part):
        return before
    number, last = (before.number + 1 if before else 0), parts[0]
    arrived = read_parts(spark, root).filter((F.col(PART) > (before.part if before else -1)) & (F.col(PART) <= last))
    good = arrived.filter(F.col(REASON) == GOOD).withColumns({SENT: F.lit(1).cast("long"), NEWEST: F.lit(False)})

    scratch = new_folder(spark, "fold")
    last_first = [F.desc(c) for c in (OFFSET, ARRIVED, *RECORD_FIELDS) if c != "ts_id"]
    place = F.row_number().over(Window.partitionBy("ts_id").orderBy(*last_first))
    _counted(good).withColumn(NEWEST, place == 1).write.parquet(f"{scratch}/fresh")
    fresh = spark.read.parquet(f"{scratch}/fresh")
    ids = fresh.filter(NEWEST).select("ts_id")

    # A record's id is looked for by one column of the live segments; ids that are not among
    # the new ones are dropped by Spark's run-time filter before the shuffle.
    moved = spark.createDataFrame([], "ts_id string, ts_date date, in_fold long")
    if before:
        again = _settled(spark, root, before).select("ts_id", DAY, F.col(FOLD).alias("in_fold")).join(ids, "ts_id", "left_semi")
        moved = _moved(spark, root, before).unionByName(again)
    moved.write.parquet(f"{scratch}/moved")
    moved = spark.read.schema(moved.schema).parquet(f"{scratch}/moved")

    days = [None, *(str(r[DAY]) for r in fresh.select(DAY).distinct().collect())]
    by_day = defaultdict(list)
    for segment in before.live if before else ():
        by_day[segment.day].append(segment)
    choice = {day: _merged(by_day[day]) for day in days}
    taken = [s for segments, _ in choice.values() for s in segments]

    if any(s.day for s in taken):
        full = [day for day, (segments, _) in choice.items() if day and segments]
        is_full = F.col(DAY).isin([F.lit(d).cast("date") for d in full])
        old = _segments(spark, root, before).filter(_is_one_of(taken)).join(
            moved.withColumnsRenamed({"in_fold": FOLD}).withColumn("gone", F.lit(True)), ["ts_id", DAY, FOLD], "left"
        )
        old = old.withColumn(NEWEST, F.col(NEWEST) & F.col("gone").isNull()).drop("gone", FOLD)
        whole = _counted(fresh.filter(is_full).unionByName(old))
        fresh = fresh.filter(~is_full).unionByName(whole)
    _written(fresh, f"{root}/intake/records/{FOLD}={number}", DAY)
    moved.filter(~_is_one_of(taken, "in_fold")).coalesce(1).write.mode("overwrite").parquet(f"{root}/intake/moved/{FOLD}={number}")

    bad = arrived.filter(F.col(REASON) != GOOD).select(REASON, RAW, ARRIVED)
    if any(s.day is None for s in taken):
        old = spark.read.schema(quarantine_schema()).parquet(f"{root}/intake/quarantine")
        bad = bad.unionByName(old.filter(F.col(FOLD).isin([s.fold for s in taken if s.day is None])).select(bad.columns))
    with settings(spark, {"spark.sql.adaptive.enabled": "true"}):
        bad.hint("rebalance").write.mode("overwrite").parquet(f"{root}/intake/quarantine/{FOLD}={number}")

    made = [Segment(number, day, level) for day, (_, level) in choice.items()]
    kept = [s for s in (before.live if before else ()) if s not in taken]
    manifest = Manifest(number, last, (*kept, *made), tuple(taken))
    _write_manifest(spark, root, manifest)
    if before:
        _clear(spark, root, before)
    return manifest


def _clear(spark: SparkSession, root: str, before: Manifest) -> None:
    """Remove what only readers of an older manifest than ``before`` need, and parts that it
    holds and that all reports have read."""
    home = f"{root}/intake"
    for s in before.dead:
        remove_folder(spark, f"{home}/quarantine/{FOLD}={s.fold}" if s.day is None else f"{home}/records/{FOLD}={s.fold}/{DAY}={s.day}")
    used = {s.fold for s in before.live if s.day is not None}
    for old in folder_numbers(spark, f"{home}/records", FOLD):
        if old < before.number and old not in used and not [n for n in folder_names(spark, f"{home}/records/{FOLD}={old}") if "=" in n]:
            remove_folder(spark, f"{home}/records/{FOLD}={old}")
    for old in folder_numbers(spark, f"{home}/moved", FOLD):
        if old < before.number:
            remove_folder(spark, f"{home}/moved/{FOLD}={old}")
    for number, part in _manifest_names(spark, root):
        if number < before.number:
            remove_folder(spark, f"{home}/manifests/{number}_{part}")
    # The part that a report read last may not be through yet.
    needed = min([before.part + 1, *_read_by_reports(spark, root)])
    for part in folder_numbers(spark, f"{home}/parts", PART):
        if part < needed:
            remove_folder(spark, f"{home}/parts/{PART}={part}")


# Readers


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """Good records with their place and arrival, resent ones included that are not merged
    away yet: what the raw table is made of."""
    manifest = newest_manifest(spark, root)
    columns = [*RECORD_FIELDS, OFFSET, ARRIVED]
    rows = read_parts(spark, root).filter(F.col(REASON) == GOOD)
    if manifest is None:
        return rows.select(columns)
    return rows.filter(F.col(PART) > manifest.part).select(columns).unionByName(_settled(spark, root, manifest).select(columns))


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """The raw table: the record last sent of each id.

    Only the parts since the last fold are grouped; a filter on the day opens, of the folds,
    that day's segments.
    """
    manifest = newest_manifest(spark, root)
    rows = read_parts(spark, root).filter(F.col(REASON) == GOOD)
    if manifest is not None:
        rows = rows.filter(F.col(PART) > manifest.part)
    recent = latest_by(rows.select(*RECORD_FIELDS, OFFSET, ARRIVED), ["ts_id"], [OFFSET, ARRIVED]).select(*RECORD_FIELDS)
    if manifest is None:
        return recent
    settled = _settled(spark, root, manifest).select(*RECORD_FIELDS)
    return settled.join(recent.select("ts_id"), "ts_id", "left_anti").select(*RECORD_FIELDS).unionByName(recent)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """All bad messages, whole, with the reason."""
    manifest = newest_manifest(spark, root)
    rows = read_parts(spark, root).filter(F.col(REASON) != GOOD)
    columns = [REASON, RAW, ARRIVED]
    if manifest is None:
        return rows.select(columns)
    return rows.filter(F.col(PART) > manifest.part).select(columns).unionByName(_bad_folds(spark, root, manifest).select(columns))


def create_views(spark: SparkSession, database: str, root: str) -> None:
    """``daily_records`` and ``quarantine`` as views on the intake's folders."""
    manifest, home = newest_manifest(spark, root), f"{root}/intake"

    def declare(name: str, schema: T.StructType, folders: list[str]) -> str:
        table = f"{database}.{name}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({schema.toDDL()}) USING parquet PARTITIONED BY ({', '.join(folders)}) "
            f"LOCATION '{ensure_folder(spark, f'{home}/{name.removeprefix('intake_')}')}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        return table

    parts = declare("intake_parts", intake_schema(), [PART, REASON, DAY])
    later = f"FROM {parts} WHERE {PART} > {manifest.part if manifest else -1} AND {REASON}"
    fields = ", ".join(RECORD_FIELDS)
    others = [c for c in RECORD_FIELDS if c != "ts_id"]
    newest = f"max(struct({OFFSET}, {ARRIVED}, {', '.join(others)}))"
    picked = ", ".join("ts_id" if c == "ts_id" else f"newest.{c}" for c in RECORD_FIELDS)
    recent = f"SELECT {picked} FROM (SELECT ts_id, {newest} AS newest {later} = '{GOOD}' GROUP BY ts_id)"
    bad = f"SELECT {REASON}, {RAW}, {ARRIVED} {later} <> '{GOOD}'"
    if manifest is not None:
        records = declare("intake_records", records_schema(), [FOLD, DAY])
        kept = declare("intake_quarantine", quarantine_schema(), [FOLD])
        moved = f"SELECT ts_id, {DAY}, in_fold AS {FOLD} FROM parquet.`{home}/moved/{FOLD}={manifest.number}`"
        settled = (
            f"SELECT {fields} FROM (SELECT * FROM {records} WHERE {NEWEST} AND {_live_sql(manifest)}) "
            f"LEFT ANTI JOIN ({moved}) USING (ts_id, {DAY}, {FOLD}) LEFT ANTI JOIN (SELECT ts_id {later} = '{GOOD}') USING (ts_id)"
        )
        recent = f"{settled} UNION ALL {recent}"
        folds = ", ".join(str(s.fold) for s in manifest.live if s.day is None)
        bad = f"{bad} UNION ALL SELECT {REASON}, {RAW}, {ARRIVED} FROM {kept} WHERE {FOLD} IN ({folds})"
    spark.sql(f"CREATE OR REPLACE VIEW {database}.daily_records AS {recent}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.quarantine AS {bad}")


# Reports that read the parts as a stream


def _reader(root: str, report: Report, run: int) -> str:
    return f"{root}/intake/readers/{report.name}/run={run}"


def stream_raw(spark: SparkSession, root: str, report: Report, run: int = 0, **options: str) -> DataFrame:
    """The good records as a stream for one report, each as often as it was sent: read by
    column, not parsed again.

    A run that begins after a fold first reads a copy of what the folds hold, made once, as
    Spark's file stream keeps to one folder for good. It then reads the parts after those; no
    fold removes parts that a run has still to read.
    """
    folder, columns = _reader(root, report, run), [*dict.fromkeys([*report.inputs, "ts"])]
    begun = folder_numbers(spark, folder, "first")
    if not begun or (begun[0] > 0 and not is_complete(spark, f"{folder}/history")):
        for old in begun:
            remove_folder(spark, f"{folder}/first={old}")
        manifest = newest_manifest(spark, root)
        begun = [manifest.part + 1 if manifest else 0]
        ensure_folder(spark, f"{folder}/first={begun[0]}")
        if manifest:
            whole = _segments(spark, root, manifest).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(SENT).cast("int"))))
            whole.select(columns).write.mode("overwrite").parquet(f"{folder}/history")
    first, limit = begun[0], batch_limit(options)
    schema = T.StructType([f for f in nullable(RECORD) if f.name in columns])
    history = spark.readStream.schema(schema).options(**limit).parquet(ensure_folder(spark, f"{folder}/history"))
    parts = spark.readStream.schema(intake_schema()).options(**limit).parquet(ensure_folder(spark, f"{root}/intake/parts"))
    later = parts.filter((F.col(PART) >= first) & (F.col(REASON) == GOOD)).select(*columns, PART)
    return history.select(*columns, F.lit(first - 1).cast("long").alias(PART)).unionByName(later).withWatermark("ts", WATERMARK)


def mark_read(spark: SparkSession, root: str, report: Report, run: int, part: int) -> None:
    """The report has rows of ``part``; files come in the order of their parts, so it has
    all of those before."""
    folder = _reader(root, report, run)
    seen = folder_numbers(spark, folder, "seen")
    if part >= 0 and part not in seen:
        ensure_folder(spark, f"{folder}/seen={part}")
        for old in seen:
            remove_folder(spark, f"{folder}/seen={old}")


def _read_by_reports(spark: SparkSession, root: str) -> list[int]:
    """The parts that runs of reports have read last, or read first; of runs that a newer one
    has replaced none."""
    found = []
    for name in folder_names(spark, f"{root}/intake/readers"):
        shown = max(published_runs(spark, f"{root}/{name}"), default=0)
        for run in folder_numbers(spark, f"{root}/intake/readers/{name}", "run"):
            folder = f"{root}/intake/readers/{name}/run={run}"
            if run >= shown:
                found.append(max([*folder_numbers(spark, folder, "seen"), *folder_numbers(spark, folder, "first")], default=0))
    return found
