"""Scalar functions on times and budgets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Config


def milliseconds(seconds: Column) -> Column:
    """Seconds as milliseconds, halves to the even neighbour."""
    return F.rint(seconds * 1000).cast("long")


def srt_clock(seconds: Column) -> Column:
    """HH:MM:SS,mmm; fractions of a millisecond are cut off, hours aren't capped."""
    ms = F.floor(seconds * 1000).cast("long")
    return F.format_string(
        "%02d:%02d:%02d,%03d", F.expr("0L") + F.floor(ms / 3_600_000).cast("long"), F.floor(ms % 3_600_000 / 60_000).cast("long"), F.floor(ms % 60_000 / 1000).cast("long"), (ms % 1000).cast("long")
    )


def coverage_ratio(transcript_end: Column, audio_seconds: Column) -> Column:
    """Null if the audio's length is unknown or not positive; may exceed 1."""
    return F.when(audio_seconds > 0, transcript_end / audio_seconds)


def generation_limit(tokens: Column, config: Config = DEFAULT) -> Column:
    room = F.greatest(F.lit(config.output_token_margin), (tokens * F.lit(config.output_token_ratio)).cast("long"))
    return F.least(F.lit(config.max_new_tokens), F.greatest(F.lit(config.min_new_tokens), tokens + room)).cast("long")


def time_limit(generation: Column, config: Config = DEFAULT) -> Column:
    if config.inference_tokens_per_second <= 0:
        return F.lit(float(config.max_inference_seconds))
    return F.greatest(F.lit(float(config.max_inference_seconds)), generation / F.lit(float(config.inference_tokens_per_second)))


def truncation_reason(last_token: Column, generated: Column, limit: Column, stop_tokens: Column) -> Column:
    """Null if the output ended with a stop token, else what stopped it."""
    return F.when(F.array_contains(stop_tokens, last_token), F.lit(None)).when(generated >= limit, F.lit("token-limit")).otherwise(F.lit("time-limit"))
