"""Operators on time intervals: union, gaps, difference, splitting, crop windows.

Two forms of the union: `union` uses a window per entity and suits entities of the size of a recording;
`continuous_periods` sorts globally by range and carries state over partition borders, so that one entity may
hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written


def _valid(df: DataFrame, keep_empty: bool = False) -> DataFrame:
    kept = df.where(F.col("start").isNotNull() & F.col("end").isNotNull() & ~F.isnan(F.col("start").cast("double")) & ~F.isnan(F.col("end").cast("double")))
    return kept if keep_empty else kept.where(F.col("end") > F.col("start"))


def union(df: DataFrame, keys: Sequence[str], gap: float = 0.0, keep_empty: bool = False) -> DataFrame:
    """(keys, start, end): intervals of an entity that overlap, touch or lie at most `gap` apart as one.

    Rows with a null edge are no intervals; neither are those with end <= start, unless keep_empty.
    Repeated rows change nothing; other columns are dropped. A null key is an entity like any other.
    """
    order = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("start") <= F.col("_reach") + F.lit(gap), 0).otherwise(1)
    return (
        _valid(df.select(*keys, "start", "end"), keep_empty)
        .withColumn("_reach", reach)
        .withColumn("_island", F.sum(opens).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .drop("_island")
    )


def union_length(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, covered): the length of the union of each entity's intervals."""
    return union(df, keys).groupBy(*keys).agg(F.sum(F.col("end") - F.col("start")).alias("covered"))


def padded_coverage(df: DataFrame, keys: Sequence[str], pad: float = 0.15, gap: float = 0.05) -> DataFrame:
    """The union of word intervals that were widened by `pad` on both sides, not before 0."""
    wide = df.withColumns({"start": F.greatest(F.lit(0.0), F.col("start") - F.lit(pad)), "end": F.col("end") + F.lit(pad)})
    return union(wide, keys, gap)


def difference(whole: DataFrame, covered: DataFrame, keys: Sequence[str], least: float = 1.0, gap: float = 0.1) -> DataFrame:
    """(keys, start, end): what of `whole` isn't in `covered`, in pieces of at least `least`, near ones merged.

    Both inputs are unions (disjoint per entity). One pass over the edges of both: a piece is uncovered where
    the count of open whole intervals is 1 and that of covered ones 0; no join of interval pairs.
    """
    edges = None
    for source, w, c in ((whole, 1, 0), (covered, 0, 1)):
        for at, sign in (("start", 1), ("end", -1)):
            part = source.select(*keys, F.col(at).alias("at"), F.lit(w * sign).alias("w"), F.lit(c * sign).alias("c"))
            edges = part if edges is None else edges.unionByName(part)
    points = edges.groupBy(*keys, "at").agg(F.sum("w").alias("w"), F.sum("c").alias("c"))
    order = Window.partitionBy(*keys).orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    # an edge of a covered interval outside `whole` doesn't part a piece; one inside does, so pieces are exact
    pieces = (
        points.withColumns({"_w": F.sum("w").over(so_far), "_c": F.sum("c").over(so_far), "end": F.lead("at").over(order)})
        .where((F.col("_w") > 0) & (F.col("_c") == 0))
        .select(*keys, F.col("at").alias("start"), "end")
    )
    long = union(pieces, keys).where(F.col("end") - F.col("start") >= F.lit(least))
    return union(long, keys, gap)


def split(df: DataFrame, most: float = 20.0) -> DataFrame:
    """Intervals cut into pieces of at most `most`; other columns are kept."""
    length = F.col("end") - F.col("start")
    n = F.greatest(F.ceil(length / F.lit(most)), F.lit(1)).cast("int")
    return (
        _valid(df)
        .withColumn("_i", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumns({"start": F.col("start") + F.col("_i") * F.lit(float(most)), "_end": F.col("start") + (F.col("_i") + 1) * F.lit(float(most))})
        .withColumn("end", F.least("_end", "end"))
        .where("start < end")
        .drop("_i", "_end")
    )


def crop_window(start: Column, end: Column, audio: Column, pad: float = 0.5) -> tuple[Column, Column]:
    """The window around an interval that is transcribed again: padded, within 0 and the audio's length if known."""
    return F.greatest(F.lit(0.0), start - F.lit(pad)), F.least(end + F.lit(pad), F.coalesce(audio, end + F.lit(pad)))


def clip_to_crop(words: DataFrame, crop_start: str = "crop_start", crop_end: str = "crop_end") -> DataFrame:
    """Words timed from the start of their crop: those within it, cut at its end, moved to the recording's time."""
    length = F.col(crop_end) - F.col(crop_start)
    return (
        words.where(F.col("start") < length)
        .withColumn("end", F.least(F.col("end"), length))
        .where(F.col("end") > F.col("start"))
        .withColumns({"start": F.col("start") + F.col(crop_start), "end": F.col("end") + F.col(crop_start)})
    )


def centred_in(words: DataFrame, lo: str = "missing_start", hi: str = "missing_end") -> DataFrame:
    """Words whose centre lies in [lo, hi], both edges included."""
    centre = (F.col("start") + F.col("end")) / 2
    return words.where((centre >= F.col(lo)) & (centre <= F.col(hi)))


# --- continuous periods and gaps over globally range-sorted intervals ---


def _islands(codes: np.ndarray, start: np.ndarray, end: np.ndarray, gap: float) -> tuple[np.ndarray, np.ndarray]:
    """Of intervals sorted by (code, start): which open an island, and the running maximum of end per code."""
    n = len(codes)
    if not n:
        return np.empty(0, bool), end
    by_end = np.argsort(end, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    rank[by_end] = np.arange(n)
    group = np.concatenate([[0], np.cumsum(codes[1:] != codes[:-1])])
    reach = end[by_end][np.maximum.accumulate(group * n + rank) - group * n]
    opens = np.ones(n, dtype=bool)
    opens[1:] = (codes[1:] != codes[:-1]) | (start[1:] > reach[:-1] + gap)
    return opens, reach


def _premerged(keys: list[str], gap: float):
    """Within each batch, before anything is shuffled, the intervals of an entity are merged."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).dictionary_encode(null_encoding="encode") for i in range(len(keys))]
            code = np.zeros(batch.num_rows, dtype=np.int64)
            for c in columns:
                code = code * len(c.dictionary) + c.indices.to_numpy()
            start, end = (batch.column(len(keys) + i).to_numpy() for i in (0, 1))
            order = np.lexsort((start, code))
            code, start, end = code[order], start[order], end[order]
            opens, reach = _islands(code, start, end, gap)
            first = np.flatnonzero(opens)
            last = np.append(first[1:] - 1, len(order) - 1)
            rows = pa.array(order[first])
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(rows) for i in range(len(keys))), pa.array(start[first]), pa.array(reach[last])], names=[*keys, "start", "end"])

    return merge


def _scanned(keys: list[str], gap: float):
    """Islands of a partition sorted by (keys, start); before: the end of the entity's island before, if any here."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        names = [*keys, "start", "end", "before", "pid", "last"]
        open_: pa.RecordBatch | None = None  # the island that isn't closed yet

        def closed(rows: pa.RecordBatch, last: bool) -> pa.RecordBatch:
            n = rows.num_rows
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(n, pid, np.int32)), pa.array([False] * (n - 1) + [last])], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            with_before = pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, batch.schema.field("end").type)], names=names[:-2])
            if open_ is not None:
                merged = pa.Table.from_batches([open_, with_before]).combine_chunks()
                with_before = merged.to_batches()[0]
            same = np.ones(with_before.num_rows - 1, dtype=bool)
            for i in range(len(keys)):
                c = with_before.column(i).dictionary_encode(null_encoding="encode").indices.to_numpy()
                same &= c[1:] == c[:-1]
            code = np.concatenate([[0], np.cumsum(~same)])
            start, end = with_before.column(len(keys)).to_numpy(), with_before.column(len(keys) + 1).to_numpy()
            opens, reach = _islands(code, start, end, gap)
            first = np.flatnonzero(opens)
            last = np.append(first[1:] - 1, len(code) - 1)
            ends = reach[last]
            before_old = with_before.column(len(keys) + 2).take(pa.array(first[:1]))
            known = code[first[1:]] == code[first[:-1]]
            before = pa.concat_arrays([before_old, pa.array(ends[:-1], mask=~known, type=before_old.type)])
            rows = pa.array(first)
            islands = pa.RecordBatch.from_arrays([*(with_before.column(i).take(rows) for i in range(len(keys))), pa.array(start[first]), pa.array(ends), before], names=names[:-2])
            if islands.num_rows > 1:
                yield closed(islands.slice(0, islands.num_rows - 1), False)
            open_ = islands.slice(islands.num_rows - 1)
        if open_ is not None:
            yield closed(open_, True)

    return scan


def continuous_periods(df: DataFrame, keys: Sequence[str], gap: float = 0.0) -> DataFrame:
    """(keys, kind, start, end): the periods of each entity (kind `period`) and the gaps between them (`gap`).

    Intervals are merged within each batch, then sorted by range over (keys, start) and scanned once per
    partition; the islands of the partitions are written to the shared folder. From each partition's first
    and last island a summary goes to the driver (a row per partition); combining the summaries in order gives
    the island that is still open where a partition begins, and the islands it reaches are joined to it.

    Null edges, NaN and end <= start are no intervals. Null keys are an entity of their own. Repeated rows change
    nothing, other columns are dropped, an empty table gives an empty result. Entities may have any size. Keys may have any names but kind, start and end.
    """
    given = list(keys)
    # keys get names of their own, so that they may be called as they like
    keys = [f"k{i}" for i in range(len(given))]
    slim = _valid(df.select(*(F.col(g).alias(k) for g, k in zip(given, keys)), "start", "end"))
    fields = {f.name: f.dataType.simpleString() for f in slim.schema.fields}
    named = ", ".join(f"{k} {fields[k]}" for k in keys)
    number = fields["start"]
    merged = slim.mapInArrow(_premerged(keys, gap), f"{named}, start {number}, end {number}")
    ordered = merged.repartitionByRange(*keys, "start").sortWithinPartitions(*keys, "start", "end")
    islands = written(ordered.mapInArrow(_scanned(keys, gap), f"{named}, start {number}, end {number}, before {number}, pid int, last boolean"))

    entity = F.struct(*keys)
    summaries = (
        islands.groupBy("pid")
        .agg(F.max_by(F.struct(entity.alias("e"), F.col("start"), F.col("end")), F.col("last")).alias("tail"))
        .orderBy("pid")
        .collect()
    )
    carried, opened = [], None  # opened: entity, start and reach of the island that is open behind a partition
    for pid, tail in summaries:
        if opened is not None:
            carried.append((pid, opened))
        if opened is not None and tail["e"] == opened[0] and tail["start"] <= opened[2] + gap:
            opened = (opened[0], opened[1], max(opened[2], tail["end"]))
        else:
            opened = (tail["e"], tail["start"], tail["end"])
    spark = df.sparkSession
    carry_fields = ", ".join([*(f"c{i} {fields[k]}" for i, k in enumerate(keys)), f"c_start {number}", f"c_end {number}"])
    carry = spark.createDataFrame([(pid, *e, s, r) for pid, (e, s, r) in carried], f"c_pid int, {carry_fields}")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"c{i}"))
    rescanned = islands.join(F.broadcast(carry), (F.col("pid") == F.col("c_pid")) & same, "left")
    absorbed = F.coalesce(F.col("start") <= F.col("c_end") + F.lit(gap), F.lit(False))
    labelled = rescanned.select(
        *keys,
        F.when(absorbed, F.col("c_start")).otherwise(F.col("start")).alias("start"),
        F.when(absorbed, F.greatest("end", "c_end")).otherwise(F.col("end")).alias("end"),
        F.when(~absorbed, F.greatest("before", "c_end")).alias("before"),
        (absorbed | F.col("last")).alias("border"),
    )
    inner = labelled.where(~F.col("border")).select(*keys, "start", "end")
    # islands that end or go on at a partition's border: at most one per partition besides those it swallowed
    border = labelled.where("border").groupBy(*keys, "start").agg(F.max("end").alias("end"))
    gaps = labelled.where(F.col("before").isNotNull()).select(*keys, F.lit("gap").alias("kind"), F.col("before").alias("start"), F.col("start").alias("end"))
    periods = inner.unionByName(border.select(*inner.columns)).select(*keys, F.lit("period").alias("kind"), "start", "end")
    return periods.unionByName(gaps).select(*(F.col(k).alias(g) for g, k in zip(given, keys)), "kind", "start", "end")
