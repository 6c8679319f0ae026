"""Series of timed chunks: missing times filled, restarts of the clock repaired, coverage of the audio.

Both repairs are written as folds over the series at first sight; both have closed forms that need only
neighbouring values and a running sum, so a series of any length is spread over tasks (see `ordered`).

Rows are (file, pos, start, end, text); pos orders a file and is unique in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import text as T
from ..functions.numbers import coverage_ratio
from ..storage import written
from .ordered import BLOCK, across, cumulative, in_blocks, inside, with_summary

BLOCK_ROWS = 50_000
_KEYS, _ORDER = ["file"], ["pos"]


def spoken(df: DataFrame) -> DataFrame:
    """Chunks with their text tidied, without blank ones."""
    return df.withColumn("text", T.chunk_text(F.col("text"))).where(~T.is_blank(F.col("text")))


def fill_times(df: DataFrame, audio_end: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Fills null times: a start by the end before it (0 at first), an end by the next given start, the audio's end, or the start.

    Chunks without both times follow each other in a chain. The end that a start s gets is f(s) = the next given
    start if it's later than s, else the audio's end if that is later, else s; along a chain the next given start
    is the same, so f settles after two steps and the n-th chunk of a chain ends at f(f(s)) for n > 1.

    audio_end: a column with the length of the audio, null where unknown. NaN counts as null.
    """
    audio = F.col(audio_end).cast("double") if audio_end else F.lit(None).cast("double")
    given = spoken(df).withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("start", "end")})
    # written: rows and the summaries of their blocks come from it
    rows = written(in_blocks(given.withColumn("_audio", audio), F.floor(F.col("pos") / block_rows)))

    def fill(s: Column, following: Column, length: Column = F.col("_audio")) -> Column:
        return F.when(following > s, following).when(length > s, length).otherwise(s)

    # a row with one of its times, an anchor, doesn't hang on the row before it as far as its end goes; all rows
    # between an anchor and the next are chain. An anchor's end may hang on the next given start, which lies in its
    # block or is the first one of the blocks behind; behind the last anchor of a block there is none in the block.
    chain = F.col("start").isNull() & F.col("end").isNull()
    window, back = inside(_KEYS, *_ORDER), inside(_KEYS, *(F.col(o).desc() for o in _ORDER))
    rows = rows.withColumns({"_n": F.row_number().over(window), "_next": F.last("start", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))})
    rows = rows.withColumn("_own", F.when(~chain, F.struct("start", "end", F.col("_next").alias("next"), F.col("_n").alias("n"))))
    given_at = lambda c: F.when(F.col(c).isNotNull(), F.col("pos"))
    blocks = rows.groupBy(*_KEYS, BLOCK).agg(F.min_by("start", given_at("start")).alias("_first"), F.max_by("_own", given_at("_own")).alias("_tail"), F.count(F.lit(1)).alias("_size"), F.max("_audio").alias("_audio"))
    before, behind = (across(_KEYS, forward).rowsBetween(Window.unboundedPreceding, -1) for forward in (True, False))
    # rows since the last anchor of the blocks before: blocks without one add all their rows
    blocks = blocks.withColumns({"_carry": F.last("_first", ignorenulls=True).over(behind), "_anchored": F.count("_tail").over(across(_KEYS).rowsBetween(Window.unboundedPreceding, 0))})
    tail_end = F.when(F.col("_tail").isNotNull(), F.coalesce(F.col("_tail.end"), fill(F.col("_tail.start"), F.col("_carry"))))
    since = F.col("_size") - F.coalesce(F.col("_tail.n"), F.lit(0))
    blocks = blocks.withColumns({"_end": tail_end, "_run": F.sum(since).over(Window.partitionBy(*_KEYS, "_anchored").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, 0))})
    rows = with_summary(rows, blocks, _KEYS, "_carry", F.last("_end", ignorenulls=True).over(before).alias("_carried"), F.lag("_run").over(across(_KEYS)).alias("_since"))
    rows = rows.withColumns({"_next": F.coalesce("_next", "_carry"), "_anchor": F.last("_own", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))})
    local = F.col("_anchor").isNotNull()
    local_end = F.coalesce(F.col("_anchor.end"), fill(F.col("_anchor.start"), F.coalesce("_anchor.next", "_carry")))
    links = F.when(local, F.col("_n") - F.col("_anchor.n") - 1).otherwise(F.col("_n") - 1 + F.coalesce(F.col("_since"), F.lit(0)))
    base = F.coalesce(F.when(local, local_end).otherwise(F.col("_carried")), F.lit(0.0))
    onward = lambda s: fill(s, F.col("_next"))
    end_before = F.when(links == 0, base).when(links == 1, onward(base)).otherwise(onward(onward(base)))
    rows = rows.withColumn("start", F.coalesce(F.col("start"), end_before))
    rows = rows.withColumn("end", F.coalesce(F.col("end"), onward(F.col("start"))))
    return rows.drop("_next", "_n", "_own", "_anchor", "_carry", "_carried", "_since", "_audio", BLOCK)


def repair_restarts(df: DataFrame, config: Config = DEFAULT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Moves chunks behind a restart of the clock to follow what came before; adds `reset` (boolean).

    A chunk restarts the clock if it starts more than the tolerance before the chunk before it ended, both taken
    before any repair: the offset is the same on both sides. Each restart adds the difference to all that follows.
    """

    def moved(row: Column, before: Column) -> Column:
        end = F.coalesce(F.greatest(before["start"], before["end"]), F.lit(0.0))
        return F.when(row["start"] < end - F.lit(config.timestamp_reset_tolerance), end - row["start"]).otherwise(F.lit(0.0))

    rows = cumulative(in_blocks(df, F.floor(F.col("pos") / block_rows)), _KEYS, _ORDER, ["start", "end"], moved, "_offset", "_moved")
    return rows.withColumns({"start": F.col("start") + F.col("_offset"), "end": F.greatest("end", "start") + F.col("_offset"), "reset": F.col("_moved") > 0}).drop("_offset", "_moved", BLOCK)


def prepare(df: DataFrame, audio_end: str | None = None, config: Config = DEFAULT) -> DataFrame:
    """Filled and repaired chunks; a file of which nothing is left has no rows."""
    return repair_restarts(fill_times(df, audio_end), config)


def coverage(chunks: DataFrame, audio: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(file, transcript_end, audio_seconds, ratio, resets, short_transcript, cause) for each row of audio (file, audio_seconds).

    chunks may have `reset`; a file without chunks ends at 0. A ratio that can't be known isn't short.
    """
    resets = F.count_if("reset") if "reset" in chunks.columns else F.lit(0).cast("long")
    ends = chunks.groupBy("file").agg(F.max("end").alias("transcript_end"), resets.alias("resets"))
    rows = audio.select("file", "audio_seconds").join(ends, "file", "left")
    end = F.coalesce("transcript_end", F.lit(0.0))
    ratio = coverage_ratio(end, F.col("audio_seconds"))
    short = F.coalesce(ratio < F.lit(config.timeline_coverage_min_ratio), F.lit(False))
    cause = F.when(short, F.when(F.coalesce("resets", F.lit(0)) > 0, F.lit("restarted clock")).otherwise(F.lit("missing end")))
    return rows.select("file", end.alias("transcript_end"), "audio_seconds", ratio.alias("ratio"), F.coalesce("resets", F.lit(0)).cast("long").alias("resets"), short.alias("short_transcript"), cause.alias("cause"))


def mismatch(chunks: DataFrame, turns: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(file, transcript_end, speech_end, mismatch): transcripts that end long before the speech; files with both sides only."""
    a = chunks.groupBy("file").agg(F.max("end").alias("transcript_end"))
    b = turns.groupBy("file").agg(F.max("end").alias("speech_end"))
    ratio = coverage_ratio(F.col("transcript_end"), F.col("speech_end"))
    return a.join(b, "file").withColumn("mismatch", F.coalesce(ratio < F.lit(config.timeline_coverage_min_ratio), F.lit(False)))
