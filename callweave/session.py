"""What every operator needs from the session: reading tables, shipping the package, a shared folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="callweave-"), "callweave.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("callweave", os.path.relpath(path, root)))
    context.addPyFile(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """A table just read, by the columns in as many partitions as there are cores, if it lies in fewer.

    For steps that work long on each row. A file of one row group is one task, whatever its size; tables of a size
    that matters have more than enough, and aren't moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *by) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as `spark.checkpoint.dir` or the context's checkpoint folder names it.

    In local mode, where neither is set, it's a folder of this machine; on a cluster that would lose rows, so it's an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = context._jsc.sc().getCheckpointDir()
        if current.isDefined():
            folder = current.get()
        elif context.master.startswith("local") and not context.master.startswith("local-cluster"):
            folder = "file://" + tempfile.mkdtemp(prefix="callweave-checkpoint-")
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(folder)
    return folder
