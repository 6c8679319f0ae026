"""Results that two later steps must see alike: written once to the folder that all executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import shared_folder

_written: list[tuple] = []


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder, removed by `release` or when the driver's Python ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/callweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    remove_later(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def remove_later(spark: SparkSession, path: str) -> None:
    """The folder is removed as those of `written`."""
    _written.append((spark, path))


def release() -> None:
    """Removes the tables written so far; what was derived from them can't be computed any more."""
    _remove()
    _written.clear()


def _remove() -> None:
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the JVM, or the folder, may be gone already: the others are tried all the same
            continue


atexit.register(_remove)
