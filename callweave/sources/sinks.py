"""Results as documents and files, and the state of finished files."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config


def timestamp_documents(chunks: DataFrame, coverage: DataFrame, unit: str = "word", config: Config = DEFAULT) -> DataFrame:
    """(file, text): documents of version 1 as JSON, nulls written out; chunks (file, pos, start, end, text)."""
    listed = chunks.groupBy("file").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "start", "end", "text"))), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["text"].alias("text"))).alias("chunks"))
    state = F.struct("audio_seconds", "transcript_end", "ratio", F.lit(config.timeline_coverage_min_ratio).alias("min_ratio"), "short_transcript")
    rows = listed.join(coverage.select("file", state.alias("coverage")), "file")
    document = F.struct(F.lit(1).alias("version"), "file", F.lit(unit).alias("unit"), "coverage", "chunks")
    return rows.select("file", F.to_json(document, {"ignoreNullFields": "false"}).alias("text"))


def summary_documents(summaries: DataFrame) -> DataFrame:
    """(text): counts only, no paths."""
    names = [c for c in ("total", "succeeded", "skipped", "failed", "short_transcripts") if c in summaries.columns]
    return summaries.select(F.to_json(F.struct(*names)).alias("text"))


def write_files(df: DataFrame, root: str, suffix: str, file: str = "file", text: str = "text") -> DataFrame:
    """Writes each text to root/<file with the suffix>, by a temporary file beside it and a rename; (file, bytes, error).

    root must be a folder that all executors mount. Lazy: the files are written when the result is used. A task
    that is run again writes the same files again.
    """
    base = re.sub(r"^file:/+", "/", root)
    slim = df.select(F.col(file).alias("file"), F.col(text).alias("text"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, errors = [], []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = os.path.normpath(os.path.join(base, os.path.splitext(name)[0] + suffix))
                try:
                    if not target.startswith(os.path.normpath(base) + os.sep):
                        raise OSError("outside the folder")
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    handle, temporary = tempfile.mkstemp(dir=os.path.dirname(target))
                    with os.fdopen(handle, "wb") as out:
                        size = out.write((content or "").encode("utf-8", "surrogatepass"))
                        out.flush()
                        os.fsync(out.fileno())
                    os.replace(temporary, target)
                    sizes.append(size)
                    errors.append(None)
                except OSError as e:
                    sizes.append(None)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, type=pa.int64()), pa.array(errors, type=pa.string())], names=["file", "bytes", "error"])

    return slim.mapInArrow(put, "file string, bytes long, error string")


def without_failed(results: DataFrame, failed: DataFrame) -> DataFrame:
    """The stored results without those of files that failed in this run."""
    return results.join(failed.select("file").distinct(), "file", "left_anti")


def fingerprint(settings: dict[str, str], size: Column, modified: Column) -> Column:
    """What a result depends on; recorded, never compared when a run is resumed."""
    pairs = [x for k, v in sorted(settings.items()) for x in (F.lit(k), F.lit(v))]
    return F.struct(F.create_map(*pairs).alias("settings") if pairs else F.create_map().cast("map<string,string>").alias("settings"), size.alias("size"), modified.alias("modified"))


def completed_state(state: DataFrame, finished: DataFrame) -> DataFrame:
    """The state table (file, fingerprint, status, coverage) after files finished.

    A file's row stays if its fingerprint is the same and it was complete; else it is replaced by a new one.
    """
    old = state.select(F.col("file").alias("_f"), F.to_json("fingerprint").alias("_p"), F.col("status").alias("_s"), F.col("coverage").alias("_c"))
    merged = finished.join(old, F.col("file") == F.col("_f"), "left")
    same = (F.col("_p") == F.to_json("fingerprint")) & (F.col("_s") == "complete")
    fresh = merged.select("file", "fingerprint", F.lit("complete").alias("status"), F.when(F.coalesce(same, F.lit(False)), F.col("_c")).otherwise(F.col("coverage")).alias("coverage"))
    return state.join(finished.select("file"), "file", "left_anti").unionByName(fresh)
