"""Accounting of runs: outcomes per file, per shard and per stage, and quality counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTS = ("total", "succeeded", "skipped", "failed")
GOOD, PARTIAL, BROKEN = 0, 1, 2


def run_summary(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, total, succeeded, skipped, failed, short_transcripts) of rows (status, short_transcript)."""
    count = lambda s: F.count_if(F.col("status") == s)
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), count("succeeded").alias("succeeded"), count("skipped").alias("skipped"), count("failed").alias("failed"), F.count_if("short_transcript").alias("short_transcripts")
    )


def roll_up(summaries: DataFrame) -> DataFrame:
    """One row from the summaries of shards; a null total marks one that couldn't be read.

    All null if none could be read; short_transcripts is null if no summary has it.
    """
    read = F.col("total").isNotNull()
    sums = [F.sum(F.when(read, F.col(c))).alias(c) for c in (*COUNTS, "short_transcripts")]
    return summaries.agg(*sums, F.count_if(~read).alias("missing"))


def worst_code(codes: DataFrame, order: str = "shard", code: str = "code") -> DataFrame:
    """(code): the first unexpected code if there is one, else the largest; 0 for no codes."""
    odd = ~F.col(code).isin(GOOD, PARTIAL, BROKEN)
    return codes.agg(F.coalesce(F.min_by(code, F.when(odd, F.col(order))), F.max(code), F.lit(0)).alias("code"))


def merge_code(worst: Column, code: Column) -> Column:
    """The worst code of stages; unexpected ones count as broken."""
    return F.greatest(worst, F.when(code.isin(GOOD, PARTIAL, BROKEN), code).otherwise(F.lit(BROKEN)))


# The wording of reports.
def code_text(code: Column) -> Column:
    known = F.when(code == GOOD, "전부 성공").when(code == PARTIAL, "일부 파일 실패").when(code == BROKEN, "폴더 또는 모델 경로 문제")
    return known.otherwise(F.concat(F.lit("알 수 없는 오류(코드 "), code.cast("string"), F.lit(")")))


def counts_text() -> Column:
    """The line that reports (total, succeeded, skipped, failed, short_transcripts, missing)."""
    line = F.concat(*(x for label, c in (("전체 ", "total"), ("개, 성공 ", "succeeded"), ("개, 건너뜀 ", "skipped"), ("개, 실패 ", "failed")) for x in (F.lit(label), F.col(c).cast("string"))), F.lit("개"))
    short = F.when(F.col("short_transcripts") > 0, F.concat(F.lit(", 뒷부분 누락 의심 "), F.col("short_transcripts").cast("string"), F.lit("개"))).otherwise(F.lit(""))
    missing = F.when(F.col("missing") > 0, F.concat(F.lit(" (샤드 "), F.col("missing").cast("string"), F.lit("개의 집계를 읽지 못해 실제보다 적음)"))).otherwise(F.lit(""))
    return F.when(F.col("total").isNull(), F.lit("집계를 읽지 못했습니다")).otherwise(F.concat(line, short, missing))


def recorded_short(document: Column) -> Column:
    """Whether a stored timestamp document (JSON) says that its transcript is short; false unless its ratio is a number."""
    ratio = F.get_json_object(document, "$.coverage.ratio").try_cast("double")
    return ratio.isNotNull() & (F.get_json_object(document, "$.coverage.short_transcript") == "true")


def speech_status(audio: DataFrame, turns: DataFrame) -> DataFrame:
    """(file, status): `vad_silence` for recordings in which no turn has a length, else `speech`."""
    spoken = turns.where(F.col("end") > F.col("start")).select(F.col("file").alias("_f")).distinct()
    rows = audio.select("file").distinct().join(spoken, F.col("file") == F.col("_f"), "left")
    return rows.select("file", F.when(F.col("_f").isNull(), "vad_silence").otherwise("speech").alias("status"))


def word_counters(words: DataFrame, turns: DataFrame) -> DataFrame:
    """(file, total_words, unassigned_words, retry_words, turns) from mapped words (file, raw_speaker, source) and turns."""
    w = words.groupBy("file").agg(F.count(F.lit(1)).alias("total_words"), F.count_if(F.col("raw_speaker").isNull()).alias("unassigned_words"), F.count_if(F.col("source") == "retry").alias("retry_words"))
    t = turns.groupBy("file").agg(F.count(F.lit(1)).alias("turns"))
    return w.join(t, "file", "full_outer").fillna(0, ["total_words", "unassigned_words", "retry_words", "turns"])


def total_counters(files: DataFrame) -> DataFrame:
    """One row of sums over files, with the share of unassigned words in percent (0 without words)."""
    sums = files.agg(F.count(F.lit(1)).alias("files"), *(F.sum(c).alias(c) for c in ("total_words", "unassigned_words", "retry_words", "turns")))
    return sums.withColumn("unassigned_percent", F.when(F.col("total_words") > 0, 100 * F.col("unassigned_words") / F.col("total_words")).otherwise(F.lit(0.0)))
