"""Session helpers: builder for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "eventloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the few settings the jobs rely on; cluster settings stay with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="eventloom-")  # of a local session, whose executors are this process
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """New, unused path below the shared folder, in a subfolder of the application: what a run has
    left behind can be removed by the application's id."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there.

    It cuts the lineage, so a lost executor costs a re-read and not a re-run, and what follows reads
    only the columns it needs. Zstandard takes less of the disk than the default.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def spent_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffles of what is written meanwhile leave the executors' disks after it; Spark keeps them until the driver
    collects its garbage."""
    conf, name = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        yield
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def settle_alone(df: DataFrame) -> DataFrame:
    """``settle``, after which the shuffles of ``df`` leave the executors' disks."""
    with spent_shuffles(df.sparkSession):
        return settle(df)


def discard(table: DataFrame) -> None:
    """Delete the files of a settled table that nothing reads any more."""
    spark = table.sparkSession
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
