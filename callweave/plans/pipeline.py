"""The whole run: transcripts, speakers, masking, masking of the spoken lines; with gates between the stages.

A stage is a function from the tables so far to its result and to what tells each file's outcome from it. What the gates need is one row per
stage; files move through the stages as partitions of tables, not as processes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..models import Adapter, Identity, apply_model
from ..operators import lines, masking, quality, redaction, speakers, timeline
from ..storage import written

Tables = dict[str, DataFrame]
#: Gives a result, and from the result as it was written the outcome of each file.
Stage = Callable[[Tables], tuple[DataFrame, Callable[[DataFrame], DataFrame]]]


@dataclass
class Report:
    tables: Tables = field(default_factory=dict)
    summaries: dict[str, dict] = field(default_factory=dict)
    code: int = quality.GOOD
    stopped: str | None = None


def stage_code(summary: dict) -> int:
    """Good if no file failed, partial if some did, broken if there was none to work on."""
    if not summary["total"]:
        return quality.BROKEN
    return quality.PARTIAL if summary["failed"] else quality.GOOD


def run(stages: list[tuple[str, Stage]], tables: Tables, stop_on_partial: bool = False, soft: tuple[str, ...] = (), needs: dict[str, str] | None = None) -> Report:
    """Runs the stages in order.

    A broken stage ends the run, a partial one does if stop_on_partial; stages in `soft` never end it. A stage in
    `needs` is left out if the table named there has no rows.
    """
    report = Report(dict(tables))
    for name, stage in stages:
        if needs and name in needs and (needs[name] not in report.tables or report.tables[needs[name]].isEmpty()):
            continue
        try:
            result, outcomes = stage(report.tables)
            result = written(result)  # later stages read it; a model isn't asked again
            summary = quality.run_summary(outcomes(result)).first().asDict()
            code = stage_code(summary)
        except Exception as e:
            result, summary, code = None, {"error": f"{type(e).__name__}: {e}"}, quality.BROKEN
        report.summaries[name] = summary
        report.code = max(report.code, code)
        if result is not None:
            report.tables[name] = result
        if name not in soft and (code == quality.BROKEN or code == quality.PARTIAL and stop_on_partial):
            report.stopped = name
            break
    return report


def _outcomes(sources: DataFrame, done: DataFrame, short: DataFrame | None = None) -> DataFrame:
    ok = done.select(F.col("file").alias("_f")).distinct()
    rows = sources.select("file").distinct().join(ok, F.col("file") == F.col("_f"), "left").select("file", F.when(F.col("_f").isNotNull(), "succeeded").otherwise("failed").alias("status"))
    if short is None:
        return rows.withColumn("short_transcript", F.lit(False))
    return rows.join(short.select("file", "short_transcript"), "file", "left").fillna(False, ["short_transcript"])


def transcripts(config: Config = DEFAULT) -> Stage:
    """`raw` (file, pos, start, end, text) and `audio` (file, audio_seconds) to `chunks`."""

    def stage(t: Tables):
        raw = t["raw"].join(t["audio"].select("file", "audio_seconds"), "file", "left")
        chunks = timeline.prepare(raw, "audio_seconds", config)
        return chunks, lambda done: _outcomes(t["raw"], done, timeline.coverage(done, t["audio"], config))

    return stage


def spoken_lines(config: Config = DEFAULT) -> Stage:
    """`chunks` and `turns` to lines with speakers."""

    def stage(t: Tables):
        turns = speakers.label_speakers(t["turns"], config.speaker_label_format)
        named = turns.select("file", "start", "end", F.col("speaker").alias("label"))
        assigned = speakers.smooth(speakers.pick_speakers(t["chunks"], named, config), config)
        result = lines.document(lines.merge_lines(assigned.select("file", "pos", "start", "end", "text", "speaker"), config))
        return result, lambda done: _outcomes(t["chunks"], done)

    return stage


def masked(source: str, registry: masking.Registry, adapter: Adapter | None = None) -> Stage:
    """The texts of `source` (file, text) with known values masked, then by the adapter: (file, source_text, masked_text)."""

    def stage(t: Tables):
        texts = t[source].select("file", "text")
        known = texts.select("file", masking.mask_known(F.col("text"), registry).alias("text"))
        out = apply_model(known, adapter or Identity())
        good = out.where(F.col("error").isNull())
        result = texts.withColumnRenamed("text", "source_text").join(good.select("file", "masked_text"), "file")
        return result, lambda done: _outcomes(texts, done)

    return stage


def redaction_info(result: DataFrame, registry: masking.Registry) -> DataFrame:
    """(file, info) of what was masked."""
    found = redaction.replacements(redaction.line_pairs(result, ["file"]), ["file"], registry)
    return redaction.info(redaction.entries(found, ["file"]), ["file"])


def standard(registry: masking.Registry, config: Config = DEFAULT, adapter: Adapter | None = None, skip_spoken: bool = False) -> list[tuple[str, Stage]]:
    """The stages in their usual order; run them with soft=("spoken",) and needs={"masked_spoken": "spoken"}."""

    def plain(t: Tables):
        result = lines.document(lines.merge_lines(t["chunks"].select("file", "pos", "start", "end", "text"), config))
        return result, lambda done: _outcomes(t["chunks"], done)

    stages = [("chunks", transcripts(config)), ("plain", plain), ("spoken", spoken_lines(config)), ("masked", masked("plain", registry, adapter))]
    return stages if skip_spoken else [*stages, ("masked_spoken", masked("spoken", registry, adapter))]
