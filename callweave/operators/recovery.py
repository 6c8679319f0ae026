"""Speech that the transcript misses: where it is, what is transcribed again, and what of that is new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import text as T
from ..storage import written
from .intervals import centred_in, clip_to_crop, crop_window, difference, padded_coverage, split, union
from .ordered import BLOCK, cumulative, in_blocks

#: Words are numbered by blocks of so many seconds.
NUMBERED_SECONDS = 600.0


def missing_speech(turns: DataFrame, chunks: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(file, start, end): speech without words, of the least length, near pieces merged."""
    speech = union(turns, ["file"], config.speech_coverage_gap)
    words = padded_coverage(chunks, ["file"], config.word_coverage_padding_seconds, config.word_coverage_gap)
    return difference(speech, words, ["file"], config.min_missing_speech_seconds, config.speech_coverage_gap)


def retry_windows(missing: DataFrame, audio: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(file, missing_start, missing_end, crop_start, crop_end): pieces to transcribe again with their padded crops."""
    pieces = split(missing, config.missing_speech_max_retry_seconds).join(audio.select("file", "audio_seconds"), "file", "left")
    lo, hi = crop_window(F.col("start"), F.col("end"), F.col("audio_seconds"), config.missing_speech_retry_padding_seconds)
    return pieces.select("file", F.col("start").alias("missing_start"), F.col("end").alias("missing_end"), lo.alias("crop_start"), hi.alias("crop_end"))


def accept_retry(words: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Of words timed within their crop (with the columns of retry_windows) those inside the crop, centred in the missing piece, and not improbable."""
    kept = centred_in(clip_to_crop(words))
    if "probability" in words.columns:
        kept = kept.where(F.col("probability").isNull() | (F.col("probability") >= config.min_retry_word_probability))
    return kept


def new_words(original: DataFrame, recovered: DataFrame, config: Config = DEFAULT, same_text: Callable[[Column], Column] = T.canonical) -> DataFrame:
    """Recovered words (file, pos, start, end, text) that aren't in the original, in their order, each once.

    A word is a repeat if one of the originals, or one recovered and kept before it, has the same text (by
    `same_text`) and its centre within the tolerance. Originals are looked up by file, text and a bin of the centre.
    Recovered words of one text whose centres lie further apart can't repeat each other, so they fall into clusters
    first, and only within a cluster each is compared with those kept.
    """
    tolerance = config.recovered_center_tolerance
    centre = (F.col("start") + F.col("end")) / 2
    cell = F.floor(centre / F.lit(max(tolerance, 1e-3)))
    known = original.select(F.col("file").alias("_f"), same_text(F.col("text")).alias("_w"), centre.alias("_m"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("_cell"))
    fresh = recovered.withColumns({"_word": same_text(F.col("text")), "_centre": centre, "_own": cell})
    repeat = (F.col("file") == F.col("_f")) & (F.col("_word") == F.col("_w")) & (F.col("_own") == F.col("_cell")) & (F.abs(F.col("_m") - F.col("_centre")) <= F.lit(tolerance))
    fresh = fresh.join(known, repeat, "left_anti")
    by_centre = Window.partitionBy("file", "_word").orderBy("_centre", "pos")
    apart = F.when(F.col("_centre") - F.lag("_centre").over(by_centre) <= F.lit(tolerance), 0).otherwise(1)
    clusters = fresh.withColumn("_apart", apart).withColumn("_cluster", F.sum("_apart").over(by_centre.rowsBetween(Window.unboundedPreceding, 0)))
    columns = recovered.columns
    item = F.struct(F.col("pos").alias("pos"), F.col("_centre").alias("centre"), F.struct(*columns).alias("row"))
    grouped = clusters.groupBy("file", "_word", "_cluster").agg(F.sort_array(F.collect_list(item)).alias("_order"))

    # in a cluster whose centres rise with the positions only the last kept word can be near; else any may be
    near = lambda a, b: F.abs(a - b) <= F.lit(tolerance)
    centres = F.transform("_order", lambda x: x["centre"])
    rising = centres == F.array_sort(centres)
    none = F.array().cast(grouped.schema["_order"].dataType)
    start = F.struct(F.lit(None).cast("double").alias("last"), none.alias("kept"))
    by_last = F.aggregate(
        "_order", start, lambda s, x: F.when(F.coalesce(near(s["last"], x["centre"]), F.lit(False)), s).otherwise(F.struct(x["centre"].alias("last"), F.concat(s["kept"], F.array(x)).alias("kept")))
    )["kept"]
    by_all = F.aggregate("_order", none, lambda kept, x: F.when(F.exists(kept, lambda k: near(k["centre"], x["centre"])), kept).otherwise(F.concat(kept, F.array(x))))
    single = F.size("_order") == 1
    kept = F.when(single, F.col("_order")).when(rising, by_last).otherwise(by_all)
    return grouped.select(F.explode(kept).alias("i")).select("i.row.*")


def merge_recovered(original: DataFrame, recovered: DataFrame, config: Config = DEFAULT, same_text: Callable[[Column], Column] = T.canonical) -> DataFrame:
    """Original and new words with positions by (start, end)."""
    columns = [c for c in original.columns if c in recovered.columns and c != "pos"]
    fresh = new_words(original, recovered, config, same_text)
    every = original.select(*columns, F.lit(0).alias("_new"), F.col("pos").alias("_pos")).unionByName(fresh.select(*columns, F.lit(1).alias("_new"), F.col("pos").alias("_pos")))
    # numbered by blocks of time, so that a long recording isn't one task; written, as blocks and rows come from it
    blocks = in_blocks(written(every), F.floor(F.coalesce("start", F.lit(-1e12)) / NUMBERED_SECONDS))
    one = lambda row, before: F.when(before.isNull(), F.lit(0)).otherwise(F.lit(1))
    rows = cumulative(blocks, ["file"], ["start", "end", "_new", "_pos"], ["start"], one, "pos", "_one").drop("_one", BLOCK)
    return rows.withColumn("pos", F.col("pos").cast("long")).withColumn("recovered", F.col("_new") == 1).drop("_new", "_pos")


def recover(chunks: DataFrame, turns: DataFrame, audio: DataFrame, transcribe: Callable[[DataFrame], DataFrame], config: Config = DEFAULT) -> DataFrame:
    """Chunks with the words that further passes find; `transcribe` takes retry windows and gives words timed within them.

    The number of passes is bounded by the parameter; a pass that finds nothing to do or nothing new is the last.
    """
    combined = chunks
    for _ in range(config.missing_speech_retry_loops):
        # each pass reads what the one before wrote: plans don't grow with the passes, and a model isn't asked twice
        windows = written(retry_windows(missing_speech(turns, combined, config), audio, config))
        if windows.isEmpty():
            break
        found = written(accept_retry(transcribe(windows), config))
        numbered = found.withColumn("pos", (F.row_number().over(Window.partitionBy("file").orderBy("start", "end", "text")) - 1).cast("long"))
        fresh = new_words(combined, numbered, config)
        if fresh.isEmpty():
            break
        combined = written(merge_recovered(combined, numbered, config).drop("recovered"))
    return combined
