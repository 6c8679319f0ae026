"""Timelines repaired while chunks arrive, and lines closed by pauses, as streaming queries."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import DEFAULT, Config
from ..operators.timeline import spoken

_OUT = "file string, pos long, start double, end double, text string, reset boolean"
_STATE = "offset double, before double"


def repaired(stream: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Chunks (file, pos, start, end, text) of a stream with restarts of the clock repaired, as they arrive.

    A file's state is its offset and the end of its last chunk. Chunks of a file must arrive in order from batch to
    batch; within a batch they are sorted. Chunks with null times need the ones behind them, so they must be filled
    before (see timeline.fill_times).
    """
    tolerance = config.timestamp_reset_tolerance

    def repair(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        offset, before = state.get if state.exists else (0.0, 0.0)
        rows = pd.concat(list(frames)).sort_values("pos")
        out = []
        for pos, start, end, text in zip(rows["pos"], rows["start"], rows["end"], rows["text"]):
            reset = start < before - tolerance
            if reset:
                offset += before - start
            before = max(start, end)
            out.append((key[0], pos, start + offset, before + offset, text, reset))
        state.update((offset, before))
        yield pd.DataFrame(out, columns=["file", "pos", "start", "end", "text", "reset"])

    kept = spoken(stream.select("file", "pos", "start", "end", "text")).where(F.col("start").isNotNull() & F.col("end").isNotNull())
    return kept.groupBy("file").applyInPandasWithState(repair, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)


def paused_lines(stream: DataFrame, gap_seconds: float = 1.0, late: str = "10 minutes") -> DataFrame:
    """(file, start, end, chunks): sessions of chunks (file, at timestamp, seconds double) that pauses part.

    A chunk keeps its session open for its own length and the gap.
    """
    length = F.concat(F.round((F.col("seconds") + F.lit(gap_seconds)) * 1000).cast("long").cast("string"), F.lit(" milliseconds"))
    grouped = stream.withWatermark("at", late).groupBy("file", F.session_window("at", length).alias("w")).agg(F.count(F.lit(1)).alias("chunks"))
    return grouped.select("file", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "chunks")
