"""The versioned changelog: append-only rows of totals so far, read as keyed tables.

Layout under a report's folder, given by the caller:

    changelog/version=<v>/     JSON messages of one micro-batch of the report, or a fold
    changes/part=<p>/          the same rows, decoded to report types by a consumer
    snapshots/<n>_<p>_<q>../   one row per key of all parts up to p of p's run, up to q of q's run

A version is (run, batch number) of the report's stream; rows keep it all the way, so
the order and number of deliveries do not matter to a reader.

Folding keeps the number of folders small: old changelog versions become one, old parts
a snapshot. What a fold or a snapshot replaces is removed when the next one is made, so
a reader may take as long as the time between two of them. Folding is for one process at
a time; writers and readers go on meanwhile.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.envelope import RAW, REASON, encode, inspect
from daytally.operators.latest import VERSION, first_version, fold_of, latest_rows, run_column, run_of, version_of
from daytally.operators.reports import Report
from daytally.session import (
    ensure_folder,
    folder_exists,
    folder_names,
    folder_numbers,
    is_complete,
    newest_complete,
    remove_folder,
    require_markers,
    settings,
)
from daytally.sources.files import batch_limit
from daytally.streaming.publication import in_runs, in_runs_sql, publish, published_runs, waiting
from daytally.streaming.raw import create_views

MESSAGE = T.StructType().add("value", T.StringType()).add(VERSION, T.LongType())

PART = "part"

#: Messages that do not fit a report's types, and days that are over (see ``jobs``).
REJECTS = f"{REASON} STRING, {RAW} STRING"
FINAL_DAYS = "ts_date DATE, daily_pu BIGINT, daily_rev DOUBLE, daily_profit DOUBLE, n_records BIGINT"


def _write_once(rows: DataFrame, path: str, level: bool = True) -> None:
    """Write a folder unless it is there already, complete.

    A micro-batch that runs again after a crash has the same content. Leaving a
    complete folder alone keeps the files that a consumer may be reading; the rows are
    then only computed, as that is what brings a stream's state up to date. The
    rebalance turns the many small outputs of the state partitions into files of a fair
    size. Spark turns run-time planning off in a stream's session; this write, a batch
    query of its own, needs it. Rows that come out of a shuffle of this query itself are
    joined to fair files without another one: ``level`` is for others.
    """
    spark = rows.sparkSession
    require_markers(spark)
    if is_complete(spark, path):
        rows.write.format("noop").mode("overwrite").save()
        return
    with settings(spark, {"spark.sql.adaptive.enabled": "true"}):
        (rows.hint("rebalance") if level else rows).write.mode("overwrite").parquet(path)


def write_version(rows: DataFrame, path: str, run: int, batch: int, *carry: str, level: bool = True) -> None:
    """Write one micro-batch of a report as JSON messages; columns ``carry`` beside them.
    Totals that are grouped by the same query, not by a stream, need no ``level`` files."""
    _write_once(encode(rows, *carry), f"{path}/{VERSION}={version_of(run, batch)}", level)


def last_part(spark: SparkSession, path: str, run: int, batch: int) -> int:
    """The newest part of the intake that a micro-batch had rows of; -1 if it is not told."""
    folder = f"{path}/{VERSION}={version_of(run, batch)}"
    found = spark.read.schema(f"{PART} long").parquet(folder).agg(F.max(PART)).first()[0] if is_complete(spark, folder) else None
    return -1 if found is None else found


def write_changes(report: Report, typed: DataFrame, path: str, run: int, batch: int) -> None:
    """Append one consumer batch, reduced to the newest row per key and run: a newer run may
    be hidden from readers yet."""
    rows = latest_rows(report, typed, keep_version=True, apart=run_column())
    _write_once(rows, f"{path}/{PART}={version_of(run, batch)}", level=False)


def fold_changelog(spark: SparkSession, report: Report, path: str) -> int | None:
    """Make the newest message of each key, of all complete versions of a run, one version.

    It stands for them: a consumer that has read some of them reads the same totals
    again, one that has not finds them all. Each run has a fold of its own, as a newer one
    may be hidden yet. Returns the fold of the newest run.
    """
    complete = [v for v in folder_numbers(spark, path, VERSION) if is_complete(spark, f"{path}/{VERSION}={v}")]
    folds = [_fold_run(spark, report, path, [v for v in complete if run_of(v) == run]) for run in sorted({run_of(v) for v in complete})]
    return folds[-1] if folds else None


def _fold_run(spark: SparkSession, report: Report, path: str, versions: list[int]) -> int:
    """Fold a run's complete ``versions``, highest first."""
    newest, folds = versions[0], [v for v in versions if v == fold_of(v)]
    if folds[:1] == [newest]:
        return newest
    messages = read_changelog(spark, path).filter(F.col(VERSION).between(first_version(run_of(newest)), newest))
    keyed = inspect(messages, report.message_schema, required=report.key_names, carry=[VERSION])
    keys = [F.col(k) for k in report.key_names]
    good = keyed.filter(F.col(REASON).isNull()).groupBy(*keys).agg(F.max_by(RAW, VERSION).alias("value")).select("value")
    rejected = keyed.filter(F.col(REASON).isNotNull()).select(F.col(RAW).alias("value"))
    _write_once(good.unionByName(rejected), f"{path}/{VERSION}={fold_of(newest)}")
    for old in folder_numbers(spark, path, VERSION) if folds else []:
        if first_version(run_of(newest)) <= old < folds[0]:
            remove_folder(spark, f"{path}/{VERSION}={old}")
    return fold_of(newest)


def read_changelog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).parquet(path)


def stream_changelog(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The changelog as a stream of its own, for a second stage.

    A file of an unfinished write may vanish, and one that a fold replaces; the write
    that replaces it has the same rows or newer totals of the same keys and is read as
    well, so missing files are passed over and nothing is lost.
    """
    reader = spark.readStream.schema(MESSAGE).option("ignoreMissingFiles", "true")
    return reader.options(**batch_limit(options)).parquet(ensure_folder(spark, path))


def to_report_types(report: Report, messages: DataFrame) -> DataFrame:
    """Decode messages and cast to the report's types; adds ``reason`` where that fails.

    Messages hold totals as text. A text that is no number is set aside, not an error.
    Only keys are required: a null total is left out of a message.
    """
    decoded = inspect(messages, report.message_schema, required=report.key_names, carry=[VERSION])
    unreadable = F.lit(False)
    for field in report.schema:
        unreadable = unreadable | (F.col(field.name).isNotNull() & _typed(field).isNull())
    return decoded.select(
        *[_typed(f).alias(f.name) for f in report.schema],
        VERSION,
        RAW,
        F.coalesce(F.col(REASON), F.when(unreadable, "wrong type")).alias(REASON),
    )


def _typed(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.BinaryType):  # as JSON has it
        return F.try_to_binary(F.col(field.name), F.lit("base64"))
    return F.col(field.name).try_cast(field.dataType)


def as_text(report_rows: DataFrame) -> DataFrame:
    """The all-text form in which the keyed store holds a report."""
    text = {f.name: F.base64(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name).cast("string") for f in report_rows.schema}
    return report_rows.select(*[column.alias(name) for name, column in text.items()])


def changes_schema(report: Report) -> T.StructType:
    return T.StructType(list(report.schema) + [T.StructField(VERSION, T.LongType())])


def changelog_from_topic(messages: DataFrame) -> DataFrame:
    """Changelog messages of a broker's topic; each holds its version among its fields."""
    value = F.col("value").cast("string")
    return messages.select(value.alias("value"), F.get_json_object(value, f"$.{VERSION}").cast("long").alias(VERSION))


def messages_for_topic(report: Report, rows: DataFrame, run: int, batch: int) -> DataFrame:
    """A micro-batch as keyed messages that hold their version."""
    version = F.lit(version_of(run, batch)).alias(VERSION)
    key = F.to_json(F.struct(*report.key_names))
    return rows.select(key.alias("key"), F.to_json(F.struct(*report.columns, version)).alias("value"))


@dataclass(frozen=True)
class Snapshot:
    """``parts``: of each run that it holds, the last part."""

    path: str
    number: int
    parts: tuple[int, ...]

    def holds(self) -> Column:
        """Whether a part is in the snapshot; told by folder names, unopened."""
        held = F.lit(False)
        for part in self.parts:
            held = held | F.col(PART).between(first_version(run_of(part)), part)
        return held


def _snapshots(spark: SparkSession, root: str) -> list[Snapshot]:
    """The complete snapshots, newest first."""
    found = []
    for name in folder_names(spark, f"{root}/snapshots"):
        path = f"{root}/snapshots/{name}"
        if name.replace("_", "").isdigit() and is_complete(spark, path):
            number, *parts = map(int, name.split("_"))
            found.append(Snapshot(path, number, tuple(parts)))
    return sorted(found, key=lambda s: s.number, reverse=True)


def newest_snapshot(spark: SparkSession, root: str) -> Snapshot | None:
    return next(iter(_snapshots(spark, root)), None)


def _newest_parts(spark: SparkSession, root: str) -> dict[int, int]:
    """The last complete part of each run."""
    newest: dict[int, int] = {}
    for part in folder_numbers(spark, f"{root}/changes", PART):
        if run_of(part) not in newest and is_complete(spark, f"{root}/changes/{PART}={part}"):
            newest[run_of(part)] = part
    return newest


def newest_part(spark: SparkSession, root: str) -> int | None:
    """The highest part that was ever complete, folded ones included."""
    snapshot = newest_snapshot(spark, root)
    return max([*_newest_parts(spark, root).values(), *(snapshot.parts if snapshot else ())], default=None)


def read_changes(spark: SparkSession, report: Report, root: str, hidden: bool = False) -> DataFrame:
    """All rows a reader must look at: the newest snapshot, and of each run the parts
    after those in it, whenever they were written; with ``hidden``, those of runs that are
    not published as well."""
    columns = [*report.columns, VERSION]
    schema = changes_schema(report)
    runs = [] if hidden else published_runs(spark, root)
    changes = spark.read.schema(changes_schema(report).add(PART, T.LongType())).parquet(ensure_folder(spark, f"{root}/changes"))
    snapshot = newest_snapshot(spark, root)
    if snapshot is None:
        return changes.select(columns).filter(in_runs(runs))
    folded = spark.read.schema(schema).parquet(snapshot.path)
    return folded.select(columns).unionByName(changes.filter(~snapshot.holds()).select(columns)).filter(in_runs(runs))


def runs_in_full(spark: SparkSession, report: Report, root: str) -> list[int]:
    """Runs that have caught up and whose totals, as they were then, are all in the table:
    they may be published. Usually none is waiting, and nothing is read."""
    ready = []
    for version in waiting(spark, root):
        run, path = run_of(version), f"{root}/changelog"
        # What was written by then may have been folded since.
        folds = [v for v in folder_numbers(spark, path, VERSION) if v == fold_of(v) and run_of(v) == run and v >= version]
        written = read_changelog(spark, path).filter(F.col(VERSION).between(first_version(run), min(folds, default=version)))
        typed = to_report_types(report, written).filter(F.col(REASON).isNull())
        wanted = typed.groupBy(*report.key_names).agg(F.max(VERSION).alias(VERSION))
        there = read_changes(spark, report, root, hidden=True).filter(in_runs([run]))
        there = there.groupBy(*report.key_names).agg(F.max(VERSION).alias("_there"))
        if wanted.join(there, report.key_names, "left").filter(F.coalesce("_there", F.lit(-1)) < F.col(VERSION)).isEmpty():
            ready.append(run)
    return ready


def publish_ready(spark: SparkSession, report: Report, root: str, sink: Callable[[DataFrame], None] | None = None) -> None:
    """Let readers see the runs that have caught up and are in the table; ``sink`` gets all
    rows of such a run first."""
    for run in runs_in_full(spark, report, root):
        if sink is not None:
            sink(latest_rows(report, read_changes(spark, report, root, hidden=True).filter(in_runs([run])), keep_version=True))
        publish(spark, root, run)


def read_report(spark: SparkSession, report: Report, root: str) -> DataFrame:
    """The report as a keyed table: the latest row of each key."""
    return latest_rows(report, read_changes(spark, report, root))


def newest_rows(spark: SparkSession, report: Report, root: str) -> DataFrame:
    """The same rows with their versions, as a sink gets them."""
    return latest_rows(report, read_changes(spark, report, root), keep_version=True)


def compact(spark: SparkSession, report: Report, root: str) -> Snapshot | None:
    """Fold all complete parts into a new snapshot and return it.

    A consumer may go on meanwhile: its later parts are read beside the snapshot, those
    of a lower run as well as those of a higher one. Files are ranged by the whole key,
    so a day with very many keys is spread over several of them, and a filter on the day
    skips the others. Parts in the snapshot before, and older snapshots, are removed.
    """
    before = _snapshots(spark, root)
    parts = {run_of(p): p for p in (before[0].parts if before else ())}
    parts |= {run: max(part, parts.get(run, part)) for run, part in _newest_parts(spark, root).items()}
    if not parts or (before and set(before[0].parts) == set(parts.values())):
        return before[0] if before else None
    number = before[0].number + 1 if before else 0
    path = "_".join(map(str, [f"{root}/snapshots/{number}", *sorted(parts.values())]))
    covered = F.lit(False)
    for run, part in parts.items():
        covered = covered | F.col(PART).between(first_version(run), part)
    schema = changes_schema(report).add(PART, T.LongType())
    changes = spark.read.schema(schema).parquet(ensure_folder(spark, f"{root}/changes")).filter(covered)
    columns = [*report.columns, VERSION]
    if before:
        folded = spark.read.schema(changes_schema(report)).parquet(before[0].path).select(columns)
        changes = folded.unionByName(changes.filter(~before[0].holds()).select(columns))
    # Rows that are hidden yet stand beside those that readers see.
    apart = F.when(in_runs(published_runs(spark, root)), -1).otherwise(run_column())
    # Ranged first, rows of a key are together for both the newest of them and the files.
    (
        latest_rows(report, changes.select(columns).repartitionByRange(*report.key_names), keep_version=True, apart=apart)
        .sortWithinPartitions(*report.key_names)
        .write.mode("overwrite")
        .parquet(path)
    )
    if before:
        last = {run_of(p): p for p in before[0].parts}
        for part in folder_numbers(spark, f"{root}/changes", PART):
            if part <= last.get(run_of(part), -1):
                remove_folder(spark, f"{root}/changes/{PART}={part}")
        for old in before[1:]:
            remove_folder(spark, old.path)
    return Snapshot(path, number, tuple(sorted(parts.values())))


def create_tables(spark: SparkSession, database: str, root: str, reports: list[Report]) -> None:
    """Declare the report tables from their schemas, if absent, and views on them.

    ``<report>_changes`` is the append-only table under ``root/<report>``, ``<report>``
    the keyed view that ad-hoc SQL reads, ``<report>_text`` the same as text, the form of
    a keyed store, and ``<report>_rejects`` the messages that did not fit. Once there is an
    intake, ``daily_records`` holds one row per record id and ``quarantine`` the bad messages;
    ``final_days`` has the days that are over. A filter on a key passes through to the files.
    Call it again to see newly added parts and published runs, or to start from a new
    snapshot.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/{database}'")
    for report in reports:
        folder, table = f"{root}/{report.name}", f"{database}.{report.name}"
        fields = changes_schema(report).add(PART, T.LongType()).toDDL()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table}_changes ({fields}) USING parquet "
            f"PARTITIONED BY ({PART}) LOCATION '{ensure_folder(spark, folder + '/changes')}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {table}_changes SYNC PARTITIONS")
        columns = ", ".join([*report.columns, VERSION])
        seen = in_runs_sql(published_runs(spark, folder))
        source = f"SELECT {columns} FROM {table}_changes WHERE {seen}"
        snapshot = newest_snapshot(spark, folder)
        if snapshot is not None:
            held = " OR ".join(f"{PART} BETWEEN {first_version(run_of(p))} AND {p}" for p in snapshot.parts)
            source = f"SELECT {columns} FROM parquet.`{snapshot.path}` WHERE {seen} UNION ALL {source} AND NOT ({held})"
        keys = ", ".join(report.key_names)
        newest = f"max(struct({VERSION}, {', '.join(report.measure_names)}))"
        picked = ", ".join(
            f"{newest}.{m} AS {m}" if report.keys_may_merge else f"max_by({m}, {VERSION}) AS {m}"
            for m in report.measure_names
        )
        spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {keys}, {picked} FROM ({source}) GROUP BY {keys}")
        text = ", ".join(f"{'base64' if isinstance(f.dataType, T.BinaryType) else 'string'}({f.name}) AS {f.name}" for f in report.schema)
        spark.sql(f"CREATE OR REPLACE VIEW {table}_text AS SELECT {text} FROM {table}")
        _create_appended(spark, f"{database}.{report.name}_rejects", REJECTS, f"{folder}/rejects")
    _create_appended(spark, f"{database}.final_days", FINAL_DAYS, f"{root}/final_days")
    if folder_exists(spark, f"{root}/intake/parts"):
        create_views(spark, database, root)


def _create_appended(spark: SparkSession, view: str, schema: str, path: str) -> None:
    """A view on a table that a stream appends to, once it is there: of the files in its log
    only, as those of an attempt that failed may lie beside them."""
    if folder_exists(spark, f"{path}/_spark_metadata"):
        columns = ", ".join(f.name for f in T.StructType.fromDDL(schema))
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM parquet.`{path}`")
