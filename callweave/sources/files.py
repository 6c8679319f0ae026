"""Folders of files as tables: audio, texts, timestamp documents, run summaries."""

from __future__ import annotations

import io
import wave

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank
from ..schemas import RUN_SUMMARY, TIMESTAMP_DOCUMENT


def relative(path: Column, root: str) -> Column:
    """A file's path below the root."""
    base = root.rstrip("/").removeprefix("file:")
    base = "/" + base.lstrip("/") if base.startswith("/") else base
    return F.substring_index(F.regexp_replace(path, r"^file:/+", "/"), base + "/", -1)


def scan(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(file, path, length, modified) of all files below root whose name ends with the suffix in any case; contents aren't read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    return rows.where(F.lower("path").endswith(suffix.lower())).select(relative(F.col("path"), root).alias("file"), "path", "length", "modified")


def any_file(spark: SparkSession, root: str, suffix: str) -> bool:
    return not scan(spark, root, suffix).isEmpty()


def audio(spark: SparkSession, root: str, suffix: str = ".wav") -> DataFrame:
    """(file, content, length)."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return rows.where(F.lower("path").endswith(suffix)).select(relative(F.col("path"), root).alias("file"), "content", "length")


@F.pandas_udf(T.DoubleType())
def wav_seconds(content: pd.Series) -> pd.Series:
    """The length of a WAV file by its header; null if it can't be told or isn't positive."""

    def seconds(data: bytes | None) -> float | None:
        try:
            with wave.open(io.BytesIO(data)) as sound:
                length = sound.getnframes() / sound.getframerate()
        except (wave.Error, EOFError, ZeroDivisionError, TypeError):
            return None
        return length if length > 0 else None

    return content.map(seconds).astype("Float64")


@F.pandas_udf(T.BinaryType())
def crop_wav(content: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
    """The piece of a WAV file between two times in seconds as a WAV file of its own; null if it can't be read or holds no frame.

    Frames from the one at `start` up to the one at `end` are taken, as far as there are any.
    """

    def cropped(data: bytes | None, lo: float | None, hi: float | None) -> bytes | None:
        try:
            with wave.open(io.BytesIO(data)) as sound:
                first, last = (min(max(round(t * sound.getframerate()), 0), sound.getnframes()) for t in (lo, hi))
                sound.setpos(first)
                frames = sound.readframes(max(0, last - first))
                if not frames:
                    return None
                out = io.BytesIO()
                with wave.open(out, "wb") as piece:
                    piece.setparams(sound.getparams())
                    piece.writeframes(frames)
        except (wave.Error, EOFError, TypeError, ValueError):
            return None
        return out.getvalue()

    return pd.Series([cropped(*row) for row in zip(content, start, end)])


def texts(spark: SparkSession, root: str, suffix: str = ".txt") -> tuple[DataFrame, DataFrame]:
    """((file, text) exactly as stored, (file, error) of files that aren't UTF-8)."""
    raw = audio(spark, root, suffix).select("file", "content")
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    good = raw.where(valid).select("file", F.col("content").cast("string").alias("text"))
    return good, raw.where(~valid).select("file", F.lit("not UTF-8").alias("error"))


def check_documents(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Timestamp documents of version 1 from (file, text): (file, document) and (file, reason) of those that break a rule.

    Rules: a JSON object; version 1; a unit of word or segment; chunks, and in each of them numbers as start and end
    and a text that isn't blank. The first rule that is broken is the reason.
    """
    parsed = raw.select("file", "text", F.from_json("text", TIMESTAMP_DOCUMENT, {"mode": "PERMISSIVE"}).alias("document"), F.try_variant_get(F.try_parse_json("text"), "$.version", "int").alias("v"))
    chunks = F.col("document.chunks")
    bad_number = F.exists(chunks, lambda c: c.isNull() | c["start"].isNull() | c["end"].isNull())
    bad_text = F.exists(chunks, lambda c: F.coalesce(is_blank(c["text"]), F.lit(True)))
    reason = (
        F.when(F.col("v").isNull() & F.col("document.chunks").isNull(), "not a document")
        .when(F.coalesce(F.col("document.version"), F.lit(-1)) != 1, "version")
        .when(~F.coalesce(F.col("document.unit").isin("word", "segment"), F.lit(False)), "unit")
        .when(F.coalesce(F.size(chunks), F.lit(0)) < 1, "no chunks")
        .when(bad_number, "time")
        .when(bad_text, "blank text")
    )
    judged = parsed.withColumn("reason", reason)
    return judged.where(F.col("reason").isNull()).select("file", "document"), judged.where(F.col("reason").isNotNull()).select("file", "reason")


def summaries(raw: DataFrame) -> DataFrame:
    """(file, total, succeeded, skipped, failed, short_transcripts) of run summaries as JSON; all null if a count is missing."""
    parsed = raw.select("file", F.from_json("text", RUN_SUMMARY).alias("s"))
    needed = ("total", "succeeded", "skipped", "failed")
    whole = F.lit(True)
    for c in needed:
        whole = whole & F.col(f"s.{c}").isNotNull()
    return parsed.select("file", *(F.when(whole, F.col(f"s.{c}")).alias(c) for c in (*needed, "short_transcripts")))
