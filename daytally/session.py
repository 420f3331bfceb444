"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MARKER = "_SUCCESS"
MARKER_SETTING = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Report state grows with the number of keys and is never dropped, so it must not live
#: on the heap.
STATE_SETTINGS = {
    STATE_STORE: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_roots: dict[str, str] = {}


def build_session(name: str = "daytally", **conf: str) -> SparkSession:
    """A session with the settings the reports rely on; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **STATE_SETTINGS,
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A machine-local folder is made only in local mode, where it is the shared folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="daytally-")
    return _local_roots[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.exists(hadoop_path)


def ensure_folder(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _path(spark, path)
    fs.mkdirs(hadoop_path)
    return path


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a batch write to ``path`` was committed."""
    return folder_exists(spark, f"{path}/{MARKER}")


def require_markers(spark: SparkSession) -> None:
    """Finished folders are told by Hadoop's marker; a cluster may have turned it off."""
    if spark._jsc.hadoopConfiguration().get(MARKER_SETTING, "true").lower() != "true":
        raise RuntimeError(f"set {MARKER_SETTING} to true: finished folders are told by it")


def folder_numbers(spark: SparkSession, path: str, label: str) -> list[int]:
    """The numbers n of the folders ``label=n`` under ``path``, highest first."""
    fs, hadoop_path = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
    return sorted((int(n.split("=")[1]) for n in names if n.startswith(f"{label}=")), reverse=True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _path(spark, path)
    fs.delete(hadoop_path, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move all files of a folder, its marker last; goes on where an earlier try ended.

    Where the target is not there yet, that is one renaming. A store without folders renames
    file by file; what it had moved before a crash stays, and the rest follows.
    """
    fs, old = _path(spark, source)
    _, new = _path(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.exists(new) and fs.rename(old, new):
        return
    files, listed = [], fs.listFiles(old, True)
    while listed.hasNext():
        files.append(listed.next().getPath().toString())
    base = fs.getFileStatus(old).getPath().toString()
    for file in sorted(files, key=lambda f: (f.endswith(MARKER), f)):
        _, into = _path(spark, target + file[len(base) :])
        fs.mkdirs(into.getParent())
        fs.delete(into, False)
        if not fs.rename(_path(spark, file)[1], into):
            raise OSError(f"cannot move {file}")
    fs.delete(old, True)


def newest_complete(spark: SparkSession, path: str, label: str) -> int | None:
    """The highest n of the complete folders ``label=n`` under ``path``."""
    numbers = folder_numbers(spark, path, label)
    return next((n for n in numbers if is_complete(spark, f"{path}/{label}={n}")), None)
