"""Schemas of documents and tables."""

from __future__ import annotations

from pyspark.sql import types as T

CHUNK = T.StructType([T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("text", T.StringType())])
COVERAGE = T.StructType(
    [
        T.StructField("audio_seconds", T.DoubleType()),
        T.StructField("transcript_end", T.DoubleType()),
        T.StructField("ratio", T.DoubleType()),
        T.StructField("min_ratio", T.DoubleType()),
        T.StructField("short_transcript", T.BooleanType()),
    ]
)
TIMESTAMP_DOCUMENT = T.StructType(
    [T.StructField("version", T.IntegerType()), T.StructField("file", T.StringType()), T.StructField("unit", T.StringType()), T.StructField("coverage", COVERAGE), T.StructField("chunks", T.ArrayType(CHUNK))]
)
RUN_SUMMARY = T.StructType([T.StructField(n, T.LongType()) for n in ("total", "succeeded", "skipped", "failed", "short_transcripts")])
FINGERPRINT = T.StructType([T.StructField("settings", T.MapType(T.StringType(), T.StringType())), T.StructField("size", T.LongType()), T.StructField("modified", T.TimestampType())])
