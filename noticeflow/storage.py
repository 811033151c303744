"""Reading tables and cutting lineage in storage that every executor shares."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of the folder; columns are pruned by what is selected from it."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.

    Only a local session (tests) that has none gets a temporary one; a cluster
    without it is refused, since a machine-local folder dies with its machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    at = context._jsc.sc().getCheckpointDir()
    if at.isDefined():
        return at.get()
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="noticeflow-")
    context.setCheckpointDir(made)
    return made


def materialize(df: DataFrame) -> DataFrame:
    """Write df once to the shared checkpoint folder and go on from the copy.

    Unlike localCheckpoint or cache the copy outlives lost executors. It is
    removed once nothing refers to it any more.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(spark))
    context._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    return df.checkpoint(eager=True)


def fs_path(spark: SparkSession, at: str):
    """(path, file system) of a place in shared storage."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, at: str) -> None:
    path, fs = fs_path(spark, at)
    fs.delete(path, True)


def done(spark: SparkSession, folder: str) -> int:
    """The highest version of a folder that is complete; -1 without any."""
    path, fs = fs_path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return max((int(n.removeprefix("done-")) for n in names if n.startswith("done-")), default=-1)


def mark_done(spark: SparkSession, folder: str, version: int) -> None:
    """Make a version of a folder the one in force.

    Each version has a marker file of its own, whose being there is all it says:
    nothing is deleted, renamed or half written, so a job that dies at any moment
    leaves either the old version in force or the new one. A version that another
    writer has marked in the meantime is an error.
    """
    path, fs = fs_path(spark, f"{folder}/done-{version:09d}")
    fs.create(path, False).close()


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores, for stages that compute much per row.

    A scan of many files is left as it is; only few or large files are shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(2 * cores)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    Needed where it is not installed on them; harmless where it is.
    """
    context = spark.sparkContext
    if getattr(context, "_noticeflow_shipped", False):
        return
    context._noticeflow_shipped = True
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="noticeflow-code-")) / "noticeflow.zip"  # served by the driver, read once by each executor
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    context.addPyFile(str(archive))
