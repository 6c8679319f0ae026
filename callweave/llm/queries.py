"""The queries of the training-data problems; each reads its whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread, table
from ..storage import written
from . import leakage, personal, repetition, shared_spans, splitting, tokenize, transcripts, truncation


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The path of a public vocabulary file: under CALLWEAVE_TOKENIZERS, or where the public_tokenizers package is."""
    folder = os.environ.get("CALLWEAVE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join("/opt/tokenizers", name)
    return public_tokenizers.path(name)


def _scanned(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return spread(table(spark, sf_dir, name), key)


# --- 1: repetition inside a text ---


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repetition.ledger(_scanned(spark, sf_dir, "text_files", "file"))
    return repetition.apply_policy(rows, repetition.POLICIES[0]).select("file").distinct()


def p1_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repetition.ledger(_scanned(spark, sf_dir, "text_files", "file"))
    return rows.select("file", *(F.col("measures")[i].alias(f"{r}_share") for i, r in enumerate(repetition.RULES)), "failed")


def p1_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.ablation(repetition.ledger(_scanned(spark, sf_dir, "text_files", "file")))


def p1_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every policy says of every text, from one stored ledger."""
    stored = written(repetition.ledger(_scanned(spark, sf_dir, "text_files", "file")))
    judged = None
    for p in repetition.POLICIES:
        rows = repetition.apply_policy(stored, p).select("file", F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), "bits")
        judged = rows if judged is None else judged.unionByName(rows)
    return judged


# --- 2: texts cut off ---


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncation(_scanned(spark, sf_dir, "anonymization", "anon_id")).where("truncated").select("anon_id", "source")


def p2_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.rates(truncation.truncation(_scanned(spark, sf_dir, "anonymization", "anon_id")))


def p2_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.evidence(truncation.truncation(_scanned(spark, sf_dir, "anonymization", "anon_id")))


def p2_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.source_limits(truncation.measured(_scanned(spark, sf_dir, "anonymization", "anon_id")).where("chars is not null"))


# --- 3: splitting oversized texts ---


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "text_files").select(F.lit("text_files").alias("origin"), "file", "text").unionByName(table(spark, sf_dir, "diarization").select(F.lit("diarization").alias("origin"), "file", "text"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.cuts(splitting.split_texts(_texts(spark, sf_dir), keep=("origin", "file")), ("origin", "file"))


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = splitting.split_texts(_texts(spark, sf_dir), keep=("origin", "file"))
    return pieces.select("origin", "file", "piece", "start", "end", "boundary", "overlap", F.length("content").alias("size"))


# --- 4: clean speaker turns ---


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.speaker_turns(_scanned(spark, sf_dir, "stt_timestamps", "file")).select("file", "speaker", "start_ms").distinct()


def p4_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.speaker_turns(_scanned(spark, sf_dir, "stt_timestamps", "file"), pause_quantile=0.95).distinct()


# --- 6: personal information ---


def _personal(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return _scanned(spark, sf_dir, "text_files", "file"), table(spark, sf_dir, "anonymization_info"), table(spark, sf_dir, "registry")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.mentions(*_personal(spark, sf_dir)).select("file", "kind", "start_pos")


def p6_sanitised(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _personal(spark, sf_dir)
    return personal.sanitised(tables[0], personal.mentions(*tables))


def p6_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many mentions of each kind were found by their shape, a known value, or information."""
    return personal.mentions(*_personal(spark, sf_dir)).groupBy("kind", "route").agg(F.count(F.lit(1)).alias("mentions"))


def p6_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, info, registry = _personal(spark, sf_dir)
    return personal.context_bits(personal.found_candidates(texts, personal.known_values(info, registry)), "right")


# --- 7: token ids ---


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.encode_corpus(_scanned(spark, sf_dir, "documents", "doc_id"), vocabulary())


def p7_tokens_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _scanned(spark, sf_dir, "documents", "doc_id").select(F.struct("source", F.length("text").alias("chars")).alias("k"), "text")
    counted = tokenize.encode_corpus(documents, vocabulary(), key="k")
    return counted.groupBy(F.col("k.source").alias("source")).agg(F.count(F.lit(1)).alias("documents"), F.sum(F.size("ids")).alias("tokens"), F.sum("k.chars").alias("chars"))


# --- 8: evaluation items in documents ---


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(_scanned(spark, sf_dir, "documents", "doc_id"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).groupBy("item_id").agg(F.count_distinct("doc_id").alias("documents"), F.count_distinct(F.when(F.col("held") == 1, F.col("doc_id"))).alias("in_full"), F.max("held").alias("most_held"))


def p8_in_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in which a whole item stands letter for letter."""
    return _leaks(spark, sf_dir).where("whole").select("doc_id", "item_id").distinct()


def p8_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of items."""
    documents = _scanned(spark, sf_dir, "documents", "doc_id").select("doc_id", "text", F.length("text").alias("before"))
    cleaned = leakage.without_passages(documents, _leaks(spark, sf_dir))
    return cleaned.select("doc_id", "text", (F.col("before") - F.length("text")).alias("removed"))


# --- 9: long exact spans shared ---


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans.sharing_pairs(table(spark, sf_dir, "documents")).distinct()


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans.shared_shares(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    p1_found, p1_ledger, p1_policies, p1_ablation, p2_found, p2_rates, p2_evidence, p2_limits, p3_found, p3_pieces, p4_found, p4_turns,
    p6_found, p6_sanitised, p6_routes, p6_contexts, p7_ids, p7_tokens_by_source, p8_found, p8_items, p8_in_full, p8_cleaned, p9_found, p9_shares,
)}

from .oracles import ORACLES  # noqa: E402, F401
