"""Session and shared-folder helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Shuffle files go when their execution ends, not when the driver's garbage collector finds them.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = 8, app: str = "tillbook") -> SparkSession:
    """A local session for tests and the bench, with its own shared folder; a cluster brings its own."""
    folder = tempfile.mkdtemp(prefix=f"{app}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config(CHECKPOINT_CONF, folder)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session.

    A session on one machine that names none gets a temporary folder, removed when Python ends.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tillbook-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set(CHECKPOINT_CONF, made)
    return made


def run_dir(spark: SparkSession) -> str:
    """The application's own folder below the shared one; it holds all it stages until ``remove_run``."""
    return f"{shared_dir(spark)}/tillbook-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the run folder."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_run(spark: SparkSession) -> None:
    """Remove what this application has staged; call it when its results are written elsewhere."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """What is planned inside removes its shuffle files when it ends."""
    before = spark.conf.get(CLEANUP_CONF)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_CONF, before)


def reliable_checkpoint(df):
    """Eager checkpoint on the shared folder: survives the loss of executors. Its shuffle files are removed once the rows are written."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    with _shuffles_removed(spark):
        return df.select("*").checkpoint(eager=True)  # a frame made here: it keeps the setting it was made under


def stage(df):
    """Write the rows out once on the shared folder and read them back.

    For an intermediate that several branches of a job use: the work below it
    runs once, its columns can still be pruned, and lost executors cost nothing.
    The shuffle files of that work are removed once the rows are written.
    """
    return stage_all([df])


def stage_all(parts: Iterable):
    """The same for the rows of several frames of one schema, one after another: the shuffle files of one lie on disk at a time."""
    path = None
    for df in parts:
        spark, path = df.sparkSession, path or fresh_path(df.sparkSession, "stage")
        with _shuffles_removed(spark):
            df.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
