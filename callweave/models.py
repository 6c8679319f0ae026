"""Models as adapters. Speech and language models stay outside; what they return is a table.

An adapter is loaded once per Python worker and called for batches of rows. A row that fails becomes a row with an
error, not a failed task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .config import DEFAULT, Config
from .functions import text as T
from .functions.numbers import generation_limit, time_limit, truncation_reason


class Adapter(Protocol):
    """load() is called once per worker; call(model, row) gives the output columns of a row or raises.

    An adapter may also have call_batch(model, rows), which gives them for all rows of a batch at once; where it raises,
    the rows of the batch are called one by one, so that only those at fault fail.
    """

    schema: str

    def load(self) -> Any: ...

    def call(self, model: Any, row: dict[str, Any]) -> dict[str, Any]: ...


class Identity:
    """A masking model that changes nothing; for tests and dry runs."""

    schema = "masked_text string"

    def load(self) -> None:
        return None

    def call(self, model: None, row: dict[str, Any]) -> dict[str, Any]:
        if not (row.get("text") or "").strip():
            raise ValueError("blank text")
        return {"masked_text": row["text"]}


_models: dict[str, Any] = {}


def apply_model(df: DataFrame, adapter: Adapter, keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """(keep, the adapter's columns, error) for each row."""
    names = [part.strip().split()[0] for part in adapter.schema.split(",")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    label = f"{type(adapter).__module__}.{type(adapter).__qualname__}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if label not in _models:
            _models[label] = adapter.load()
        for pdf in batches:
            rows, out = pdf.to_dict("records"), []
            found = None
            if hasattr(adapter, "call_batch"):
                try:
                    found = list(adapter.call_batch(_models[label], rows))
                except Exception:  # told by the rows one by one
                    found = None
            for i, row in enumerate(rows):
                base = {k: row[k] for k in keep} | dict.fromkeys(names)
                try:
                    out.append(base | (adapter.call(_models[label], row) if found is None else found[i]) | {"error": None})
                except Exception as e:  # one row's failure is that row's result
                    out.append(base | {"error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(out, columns=[*keep, *names, "error"])

    return df.mapInPandas(run, f"{kinds}, {adapter.schema}, error string")


def from_table(words: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A transcriber for retry windows that looks words up in a table (file, start, end, text) in the recording's time."""

    def transcribe(windows: DataFrame) -> DataFrame:
        w = words.select(F.col("file").alias("_f"), F.col("start").alias("_s"), F.col("end").alias("_e"), "text")
        hit = (F.col("file") == F.col("_f")) & (F.col("_s") < F.col("crop_end")) & (F.col("_e") > F.col("crop_start"))
        return windows.join(w, hit).select("file", "missing_start", "missing_end", "crop_start", "crop_end", (F.col("_s") - F.col("crop_start")).alias("start"), (F.col("_e") - F.col("crop_start")).alias("end"), "text")

    return transcribe


#: What a prompt is told about its text.
PROMPT_KINDS = {"plain": "일반 전사 텍스트", "diarized": "화자 구분 텍스트"}


def with_prompt(df: DataFrame, templates: dict[str, str], kind: Column, text: str = "text") -> DataFrame:
    """Adds `prompt`, the template of the kind with the text in the place of {text}."""
    chosen = F.create_map(*(F.lit(x) for pair in templates.items() for x in pair))[kind]
    return df.withColumn("prompt", F.replace(chosen, F.lit("{text}"), F.col(text)))


def input_error(text: Column, tokens: Column, config: Config = DEFAULT) -> Column:
    """Why a text can't be given to the masking model, or null: it is blank, or longer than the model takes."""
    blank = F.coalesce(T.is_blank(text), F.lit(True))
    return F.when(blank, F.lit("blank text")).when(tokens > config.max_input_tokens, F.concat(F.lit("too long: "), tokens.cast("string"), F.lit(f" of {config.max_input_tokens} tokens")))


def output_error(text: Column, last_token: Column, generated: Column, limit: Column, stops: Column) -> Column:
    """Why a model's output can't be used, or null: it is blank, or didn't end with a stop token."""
    cut = truncation_reason(last_token, generated, limit, stops)
    return F.when(F.coalesce(T.is_blank(text), F.lit(True)), F.lit("blank result")).otherwise(cut)


def with_budget(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Adds `max_new_tokens` and `max_seconds` by the number of input tokens."""
    return df.withColumn("max_new_tokens", generation_limit(F.col(tokens))).withColumn("max_seconds", time_limit(F.col("max_new_tokens")))


def model_source(path: str, exists: Callable[[str], bool]) -> tuple[str, str]:
    """(kind, source) of a diarization model: a folder with its config.yaml, a file, or a hub id `org/name`."""
    if exists(f"{path}/config.yaml"):
        return "folder", f"{path}/config.yaml"
    if exists(path):
        return "file", path
    if path.count("/") == 1 and all(path.split("/")) and not path.startswith((".", "~")):
        return "hub", path
    raise FileNotFoundError(path)


def stop_tokens(*sources: list[int] | int | None) -> list[int]:
    """The union of stop tokens from several settings, in the order found."""
    found: dict[int, None] = {}
    for s in sources:
        for token in s if isinstance(s, list) else [s]:
            if token is not None:
                found[token] = None
    return list(found)
