"""Repetition inside single documents, as a ledger of rule failures.

Every rule measures one share of repeated content, once per text. The ledger holds the measurements and a bit
per rule that failed at its base threshold; policies (versioned sets of rules, with thresholds of their own where
they differ) are applied to the ledger later, without reading a text again, and ablations come from counting
ledger rows by their bits.

Rules, in the order of their bits:

0. span: characters in runs of at least 12 letters or digits (case and everything else aside) that also begin
   earlier in the text, over all letters and digits; the two runs may overlap
1. line: characters in lines that already occurred, over the characters of all lines
2. sentence: the same of sentences
3. paragraph: the same of paragraphs (parted by blank lines)
4. word: the share of the most frequent word in texts of at least 20 words
5. bigram: characters in repeated word pairs (from the second occurrence on), over the characters of all words
6. quintuple: the same of runs of five words

Defined results: a null text has null measurements and no bits; a text without letters or digits has zeros; all
rules take whole texts of any length. Repeated rows stay; other columns are kept, but for names the ledger adds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared_spans import codes_of, window_hashes

SPAN = 12
RULES = ("span", "line", "sentence", "paragraph", "word", "bigram", "quintuple")
#: Base thresholds: a rule fails at this share or above.
THRESHOLDS = (0.3, 0.3, 0.3, 0.3, 0.2, 0.2, 0.15)

_not_alnum = re.compile(r"[\W_]+")
_sentence = re.compile(r"(?<=[.?!…])\s+|[\r\n]+")
_paragraph = re.compile(r"(?:\r\n|\r|\n)\s*(?:\r\n|\r|\n)")


@dataclass(frozen=True)
class Policy:
    """Texts fail a policy if one of its rules fails; `over` gives thresholds that differ from the base."""

    name: str
    version: int
    rules: tuple[str, ...]
    over: dict[str, float] = field(default_factory=dict)

    @property
    def mask(self) -> int:
        return sum(1 << RULES.index(r) for r in self.rules)

    def bits(self):
        """The bits of the policy's rules that failed."""
        out = F.col("failed").bitwiseAND(F.lit(self.mask & ~sum(1 << RULES.index(r) for r in self.over)))
        for rule, least in self.over.items():
            i = RULES.index(rule)
            if rule in self.rules:
                out = out.bitwiseOR(F.when(F.col("measures")[i] >= F.lit(least), F.lit(1 << i)).otherwise(F.lit(0)))
        return out


POLICIES = (
    Policy("span_only", 1, ("span",)),
    Policy("broad", 1, RULES),
    Policy("broad", 2, ("span", "line", "sentence", "quintuple"), {"line": 0.5, "sentence": 0.5}),
)


def span_share(text: str, span: int = SPAN) -> float:
    """The share of letters and digits in runs of at least `span` of them that also begin earlier in the text."""
    codes = codes_of(_not_alnum.sub("", text.lower()))
    if len(codes) <= span:
        return 0.0
    hashes = window_hashes(codes, span)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    again = np.flatnonzero(ordered[1:] == ordered[:-1]) + 1
    if not len(again):
        return 0.0
    # the run before in the text with the same hash; compared character by character, as hashes may collide
    later, earlier = order[again], order[again - 1]
    equal = np.ones(len(later), dtype=bool)
    for i in range(span):
        equal &= codes[later + i] == codes[earlier + i]
    if not equal.all():
        seen: set[bytes] = set()
        starts = []
        for i in range(len(codes) - span + 1):
            run = codes[i : i + span].tobytes()
            if run in seen:
                starts.append(i)
            seen.add(run)
        later = np.array(starts, dtype=np.int64)
    cover = np.zeros(len(codes) + 1, dtype=np.int32)
    np.add.at(cover, later, 1)
    np.add.at(cover, later + span, -1)
    return float(np.count_nonzero(np.cumsum(cover[:-1]))) / len(codes)


def _repeated(parts: list[str]) -> float:
    seen: set[str] = set()
    total = again = 0
    for part in parts:
        part = part.strip()
        total += len(part)
        if part in seen:
            again += len(part)
        seen.add(part)
    return again / total if total else 0.0


def _repeated_grams(words: list[str], n: int) -> float:
    if len(words) < n:
        return 0.0
    grams = list(zip(*(words[i:] for i in range(n))))
    counts = Counter(grams)
    if len(counts) == len(grams):
        return 0.0
    covered, seen = bytearray(len(words)), set()
    for i, gram in enumerate(grams):
        if counts[gram] > 1:
            if gram in seen:
                covered[i : i + n] = b"\x01" * n
            seen.add(gram)
    total = sum(map(len, words))
    return sum(len(w) for w, c in zip(words, covered) if c) / total if total else 0.0


def measure(text: str) -> list[float]:
    """One value per rule."""
    words = [w for w in _not_alnum.split(text.lower()) if w]
    top = max(Counter(words).values()) / len(words) if len(words) >= 20 else 0.0
    return [
        span_share(text),
        _repeated(text.splitlines()),
        _repeated(_sentence.split(text)),
        _repeated(_paragraph.split(text)),
        top,
        _repeated_grams(words, 2),
        _repeated_grams(words, 5),
    ]


def ledger(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """(keep, measures array<double>, failed int): the measurements of each row and the bits of failed rules.

    Each row is measured where it is read; nothing is shuffled.
    """
    slim = df.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(keep)
        for batch in batches:
            rows = [measure(t) if t is not None else None for t in batch.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(rows, type=pa.list_(pa.float64()))], names=[*keep, "measures"])

    out = slim.mapInArrow(measured, f"{kinds}, measures array<double>")
    failed = F.lit(0)
    for i, least in enumerate(THRESHOLDS):
        failed = failed.bitwiseOR(F.when(F.col("measures")[i] >= F.lit(least), F.lit(1 << i)).otherwise(F.lit(0)))
    return out.withColumn("failed", failed)


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger rows that fail the policy, with the bits of its rules that failed."""
    return rows.withColumn("bits", policy.bits()).where(F.col("bits") != 0)


def ablation(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """(policy, version, rule, rows, failing, by_rule, only_by_rule) for each rule of each policy.

    only_by_rule: rows that would pass if the rule were left out. Rows are first counted by their bits under
    all policies (at most 2^7 groups per policy, combined on the map side), then the counts are split by rule.
    """
    each = F.explode(F.array(*(F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(p.mask).alias("mask"), p.bits().alias("bits")) for p in policies)))
    counts = rows.select(each.alias("p")).select("p.*").groupBy("policy", "version", "mask", "bits").count()
    rule = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << i).alias("bit")) for i, r in enumerate(RULES))))
    has = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        counts.withColumn("r", rule)
        .where(F.col("mask").bitwiseAND(F.col("r.bit")) != 0)
        .groupBy("policy", "version", F.col("r.rule").alias("rule"))
        .agg(
            F.sum("count").alias("rows"),
            F.sum(F.when(F.col("bits") != 0, F.col("count")).otherwise(0)).alias("failing"),
            F.sum(F.when(has, F.col("count")).otherwise(0)).alias("by_rule"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("only_by_rule"),
            F.bit_or(F.when(has, F.col("bits")).otherwise(F.lit(0))).alias("fails_with"),
        )
    )
