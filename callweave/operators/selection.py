"""Which files a run takes: the first in path order, every n-th for a shard, those without a result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import written


def path_order(file: Column) -> Column:
    """Orders paths by their components, so `a/b` comes before `a-b`."""
    return F.split(file, "/")


def first_files(df: DataFrame, n: int | None, file: str = "file") -> DataFrame:
    """The rows of the first n files in path order; all for None. Only n rows reach one task."""
    if n is None:
        return df
    if n < 1:
        raise ValueError("a sample has at least one file")
    taken = df.select(F.col(file).alias("_f")).distinct().orderBy(path_order(F.col("_f"))).limit(n)
    return df.join(taken, F.col(file) == F.col("_f"), "left_semi")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """Adds `index`, the rows' places in the order from 0, without bringing all rows into one task.

    The rows are sorted by range and written; a row's place is its place in its partition plus the sizes of the
    partitions before, of which the driver sees one number each.
    """
    rows = df.select("*", *(o.alias(f"_o{i}") for i, o in enumerate(order)))
    columns = [f"_o{i}" for i in range(len(order))]
    local = written(rows.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn("_id", F.monotonically_increasing_id()).drop(*columns))
    part = F.shiftright("_id", 33)
    sizes = local.groupBy(part.alias("p")).count().orderBy("p").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["p"], total))
        total += r["count"]
    offsets = df.sparkSession.createDataFrame(starts, "_p long, _start long")
    return local.join(F.broadcast(offsets), part == F.col("_p")).withColumn("index", F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id", "_p", "_start")


def parse_shard(text: str) -> tuple[int, int]:
    """`I/N` with 0 <= I < N."""
    parts = text.split("/")
    if len(parts) != 2 or not all(p.strip().lstrip("+-").isdigit() for p in parts):
        raise ValueError(f"not a shard: {text!r}")
    i, n = map(int, parts)
    if n < 1 or not 0 <= i < n:
        raise ValueError(f"shard {i} of {n} doesn't exist")
    return i, n


def shard(df: DataFrame, which: tuple[int, int], file: str = "file") -> DataFrame:
    """Every n-th file in path order from the i-th on; adds `index`. df has a row per file."""
    return numbered(df, path_order(F.col(file))).where(F.col("index") % which[1] == which[0])


def shard_labels(gpus: list[str], workers: int) -> list[tuple[int, str, str]]:
    """(shard, gpu, label) of each worker; labels are of one length."""
    plan = [gpu for gpu in gpus for _ in range(workers)]
    width = len(str(len(plan) - 1))
    return [(i, gpu, f"{i:0{width}d}/{len(plan)}") for i, gpu in enumerate(plan)]


def unfinished(sources: DataFrame, *results: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """Sources without a text that isn't blank in each of the results."""
    from ..functions.text import is_blank

    done = None
    for r in results:
        usable = r.where(F.col(text).isNotNull() & ~is_blank(F.col(text))).select(F.col(file).alias("_f")).distinct()
        done = usable if done is None else done.join(usable, "_f")
    return sources if done is None else sources.join(done, F.col(file) == F.col("_f"), "left_anti")


def with_suffix(file: Column, suffix: str) -> Column:
    """A path with another suffix in the place of its last one."""
    return F.concat(F.regexp_replace(file, r"\.[^./]*$", ""), F.lit(suffix))


def matched(sources: DataFrame, results: DataFrame, suffix: str, file: str = "file") -> DataFrame:
    """(file, result, found) for each source: the path of its result, by the changed suffix, and whether results has it.

    A source without a result is that file's failure only.
    """
    there = results.select(F.col(file).alias("_r")).distinct().withColumn("_is", F.lit(True))
    rows = sources.select(F.col(file).alias("file")).distinct().withColumn("result", with_suffix(F.col("file"), suffix))
    return rows.join(there, F.col("result") == F.col("_r"), "left").select("file", "result", F.coalesce("_is", F.lit(False)).alias("found"))


def jobs(files: DataFrame, suffix: str, n: int | None = None, which: tuple[int, int] | None = None, file: str = "file") -> DataFrame:
    """(index, file, output) of a run: the first n files in path order, of those the shard's; no files at all are an error."""
    listed = files.select(F.col(file).alias("file")).distinct()
    if listed.isEmpty():
        raise ValueError("there are no files")
    taken = numbered(first_files(listed, n), path_order(F.col("file")))
    if which is not None:
        taken = taken.where(F.col("index") % which[1] == which[0])
    return taken.select("index", "file", with_suffix(F.col("file"), suffix).alias("output"))


def collisions(sources: DataFrame, file: str = "file") -> DataFrame:
    """(output, files): sources that would write the same output, as `a.wav` and `a.WAV`."""
    return sources.groupBy(with_suffix(F.col(file), "").alias("output")).agg(F.sort_array(F.collect_set(file)).alias("files")).where(F.size("files") > 1)
