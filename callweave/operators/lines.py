"""Chunks put together as lines of text, turns of words, and subtitles.

A line can only go on while the speaker stays and pauses are short, so a recording first falls into runs at those
places (see `ordered`); the limit of a line's length, which depends on where the line before was cut, is followed
within a run only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import text as T
from ..functions.numbers import srt_clock
from .ordered import BLOCK, cumulative, in_blocks

BLOCK_ROWS = 50_000


def _runs(chunks: DataFrame, breaks: Callable[[Column, Column], Column], order: list[str]) -> DataFrame:
    """Adds `_run`, a number that grows where breaks(row, before) is true."""
    fields = ["start", "end", *(["speaker"] if "speaker" in chunks.columns else [])]
    opens = lambda row, before: F.when(before.isNull() | breaks(row, before), F.lit(1)).otherwise(F.lit(0))
    return cumulative(in_blocks(chunks, F.floor(F.col("pos") / BLOCK_ROWS)), ["file"], order, fields, opens, "_run", "_opens").drop("_opens", BLOCK)


def merge_lines(chunks: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(file, line, start, end, text) or, of chunks with `speaker`, (file, line, speaker, start, end, text).

    A chunk (file, pos, start, end, text) opens a new line if the speaker differs, if it begins more than the largest
    gap behind the end of the chunk before, or if the line would grow beyond max_chars (0: no limit).
    """
    spoken = "speaker" in chunks.columns

    def breaks(row: Column, before: Column) -> Column:
        pause = row["start"] - before["end"] > F.lit(config.speaker_merge_max_gap)
        return pause | ~row["speaker"].eqNullSafe(before["speaker"]) if spoken else pause

    most = config.speaker_merge_max_chars
    item = F.struct("pos", "start", "end", "text")
    keys = ["file", "_run", *(["speaker"] if spoken else [])]
    runs = _runs(chunks, breaks, ["pos"]).groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("items"))
    line = "struct<pos:bigint,start:double,end:double,text:string>"
    start = F.struct(F.lit(None).cast(line).alias("open"), F.array().cast(f"array<{line}>").alias("done"))

    def opened(x: Column) -> Column:
        return F.struct(x["pos"].cast("long").alias("pos"), x["start"].cast("double").alias("start"), x["end"].cast("double").alias("end"), T.lstrip(x["text"]).alias("text"))

    def step(state: Column, x: Column) -> Column:
        now = state["open"]
        longer = T.joined(now["text"], x["text"])
        fits = F.lit(True) if most <= 0 else F.length(longer) <= most
        grown = F.struct(now["pos"].alias("pos"), now["start"].alias("start"), x["end"].cast("double").alias("end"), longer.alias("text"))
        return F.when(now.isNull(), F.struct(opened(x).alias("open"), state["done"].alias("done"))).when(fits, F.struct(grown.alias("open"), state["done"].alias("done"))).otherwise(
            F.struct(opened(x).alias("open"), F.concat(state["done"], F.array(now)).alias("done"))
        )

    folded = runs.withColumn("f", F.aggregate("items", start, step))
    rows = folded.select(*keys, F.explode(F.concat(F.col("f.done"), F.array(F.col("f.open")))).alias("l"))
    number = F.row_number().over(Window.partitionBy("file").orderBy("l.pos"))
    return rows.select("file", number.alias("line"), *(["speaker"] if spoken else []), "l.start", "l.end", "l.text")


def document(lines: DataFrame, final_newline: bool = True) -> DataFrame:
    """(file, text): the lines of each file in order; with their speakers if they have them."""
    text = F.concat(F.col("speaker"), F.lit(": "), F.col("text")) if "speaker" in lines.columns else F.col("text")
    listed = F.sort_array(F.collect_list(F.struct(F.col("line"), text.alias("t"))))
    joined = lines.groupBy("file").agg(F.array_join(F.transform(listed, lambda x: x["t"]), "\n").alias("text"))
    return joined.withColumn("text", F.concat("text", F.lit("\n"))) if final_newline else joined


def word_turns(words: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(file, turn, speaker, start, end, words) in ms: words of one speaker at most turn_gap_ms apart.

    A turn ends where its last word ends, also if an earlier word ended later. A null speaker is a speaker.
    """
    runs = _runs(words, lambda row, before: ~row["speaker"].eqNullSafe(before["speaker"]) | (row["start"] - before["end"] > config.turn_gap_ms), ["pos"])
    return (
        runs.groupBy("file", "_run")
        .agg(F.first("speaker").alias("speaker"), F.min_by("start", "pos").alias("start"), F.max_by("end", "pos").alias("end"), F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]).alias("words"))
        .select("file", F.col("_run").cast("int").alias("turn"), "speaker", "start", "end", "words")
    )


def _spoken_text() -> Column:
    return T.strip(F.array_join("words", " "))


def _name(prefix: str = "Speaker ") -> Column:
    return F.when(F.col("speaker").isNull(), F.lit("UNASSIGNED")).otherwise(F.concat(F.lit(prefix), F.col("speaker").cast("string")))


def speaker_text(turns: DataFrame) -> DataFrame:
    """(file, text): a line per turn that has text."""
    lines = turns.withColumn("t", _spoken_text()).where("t <> ''").select("file", "turn", F.concat(_name(), F.lit(": "), F.col("t"), F.lit("\n")).alias("t"))
    return lines.groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "t"))), lambda x: x["t"]), "").alias("text"))


def cues(turns: DataFrame) -> DataFrame:
    """(file, cue, text): subtitles, also of turns without text, numbered from 1."""
    clock = lambda c: srt_clock(F.col(c) / 1000)
    text = F.concat(F.col("turn").cast("string"), F.lit("\n"), clock("start"), F.lit(" --> "), clock("end"), F.lit("\n["), _name(), F.lit("] "), _spoken_text(), F.lit("\n\n"))
    return turns.select("file", F.col("turn").alias("cue"), text.alias("text"))
