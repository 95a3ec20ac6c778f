"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import functools
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. The shuffle width is left to the cluster: AQE
# merges small shuffle partitions and splits skewed join partitions at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def get_spark(app_name: str = "strataflow", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session. Pass `master` only for local runs; spark-submit sets it on a cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_fallback() -> str:
    return tempfile.mkdtemp(prefix="strataflow-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can read: `spark.checkpoint.dir` as the session names it.

    Only a local-mode session may go without it, as the tests do.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_fallback()


def run_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one, for an intermediate table.

    It belongs to the surrounding `staging` block and is removed when that ends well;
    outside of any it is removed when the program ends, as its rows are read until then.
    """
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    owner = _owner.get()
    (_until_exit if owner is None else owner).append(path)
    return path


_owner: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("staging", default=None)
_until_exit: list[str] = []
stage_dir = run_dir


def _remove(paths: Iterable[str]) -> None:
    jvm = SparkContext._jvm
    for path in paths if jvm else ():
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(hadoop_path, True)


@atexit.register
def _remove_at_exit() -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        _remove(_until_exit)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Several outputs can then use it without computing it again, and a lost
    executor costs a re-read, not the whole lineage.
    """
    path = stage_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove what was staged inside the block once it succeeds; after a failure it stays for a look or a replay."""
    mine: list[str] = []
    token = _owner.set(mine)
    try:
        yield
    finally:
        _owner.reset(token)
    for path in mine:
        fs, hadoop_path = file_system(spark, path)
        fs.delete(hadoop_path, True)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system and path object behind a path string (local disk, HDFS or object store)."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path
