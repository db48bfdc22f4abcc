"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"

# Input bytes per shuffle partition, at every size of the input.
BYTES_PER_PARTITION = 256 * 1024**2

# What one task of a write reads, of files or of a shuffle. Rows take ten times as much where a task sorts them.
BYTES_PER_TASK = 32 * 1024**2
TASK_SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")

#: By session: how many writes are under way, and the settings from before the first of them.
_small: dict[int, tuple[int, dict[str, str]]] = {}
_small_lock = threading.Lock()

_local_scratch: dict[str, str] = {}
#: Folders handed out so far, by application.
_handed_out: dict[str, list[str]] = {}


def build_session(app: str = "lakemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are designed for.

    The number of shuffle partitions is left to the cluster here and raised by the jobs that
    know their input (``sized_shuffles``); adaptive execution coalesces small partitions and
    splits skewed ones at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def folder_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files below some folders, from the file system's own listing."""
    context = spark.sparkContext
    total = 0
    for path in paths:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(context._jsc.hadoopConfiguration())
        total += fs.getContentSummary(folder).getLength()
    return total


def frame_bytes(df: DataFrame) -> int:
    """Total size of the files that a frame reads; their folders are listed, each once."""
    names: dict[str, set[str]] = {}
    for file in df.inputFiles():
        folder, name = file.rsplit("/", 1)
        names.setdefault(folder, set()).add(unquote(name))
    context = df.sparkSession.sparkContext
    total = 0
    for path, files in names.items():
        folder = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(path))
        for status in folder.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(folder):
            if status.getPath().getName() in files:
                total += status.getLen()
    return total


def shuffle_partitions_for(input_bytes: int, at_least: int, each: int = BYTES_PER_PARTITION) -> int:
    """Partitions for a shuffle of that much input: never fewer than configured."""
    return max(at_least, -(-input_bytes // each))


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int, each: int = BYTES_PER_PARTITION) -> Iterator[None]:
    """Run jobs with as many shuffle partitions as their input calls for, ``each`` of its bytes to one."""
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    spark.conf.set(SHUFFLE_PARTITIONS, shuffle_partitions_for(input_bytes, int(before), each))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Run a job in tasks of ``BYTES_PER_TASK`` at most, so that sorting and grouping stay in memory at every size.

    Files and shuffles are compressed: with the defaults of 128 and 64 MB, tasks that sort what they read spill as soon as
    the input fills them. Smaller settings stay. Writes may run side by side; the last to end restores what was set.
    """
    session, to_bytes = spark._jsparkSession.hashCode(), spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
    with _small_lock:
        running, before = _small.get(session, (0, {}))
        if not running:
            before = {key: spark.conf.get(key) for key in TASK_SIZES}
            for key, value in before.items():
                spark.conf.set(key, f"{min(BYTES_PER_TASK, to_bytes.byteStringAsBytes(value))}b")
        _small[session] = running + 1, before
    try:
        yield
    finally:
        with _small_lock:
            running, before = _small.pop(session)
            if running > 1:
                _small[session] = running - 1, before
            else:
                for key, value in before.items():
                    spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session, where driver and executors are one process on one
    machine, may fall back to a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="lakemart-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; no two calls return the same."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside, on leaving: for work whose result is then written elsewhere.

    Without a scope they stay, because results are lazy and may still read them.
    """
    made = _handed_out.setdefault(spark.sparkContext.applicationId, [])
    start = len(made)
    try:
        yield
    finally:
        context = spark.sparkContext
        for path in made[start:]:
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        del made[start:]
