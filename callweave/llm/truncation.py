"""Texts that were cut by a field limit or in transfer.

Two kinds of evidence are combined as log odds:

* Length. Per source the lengths (characters and bytes) are fitted by a right-censored log-normal distribution:
  values at a candidate limit, that is a length that far more rows have than the density explains, count as
  censored there; expectation and maximisation alternate until the likelihood stands still. The censoring
  posterior of a value at a limit is the share of the rows there that the density doesn't explain. What a source cuts at
  its limits is taken from the prior of a cut elsewhere, so away from the limits it is less likely than in a source without any.
* Ending. The last word's ending (its last characters) is compared with the whole corpus: endings that close
  sentences there (before a mark or a line end), endings that close far more texts than cuts at random places would
  leave there, and endings that do neither. A broken character or a line that has only begun is cut for certain.
  Endings that do neither count by how much more often cuts at random places leave them than sentences close with
  them, rare endings as far as their last two characters or their last one say something: nothing where all are rare,
  up to UNFINISHED where the corpus is sure.

A text that ends with a finished sentence is complete by definition, so a finished ending outweighs any length. An
ending of which the corpus says little leaves it to the length: cut at a limit, else complete.

Everything is counted over all rows. Words are counted within each batch before they are shuffled; what is fitted
per source is a histogram of lengths, not its rows. Nothing grows on the driver.

Defined results: null, empty and blank texts aren't truncated; a null source is a source; repeated rows each count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import erf, exp, log, pi, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import written

#: An ending closes sentences if this share of its occurrences does, of at least MIN_SEEN.
FINAL_SHARE, MIN_SEEN = 0.3, 5
#: An ending closes texts if it does so this many times as often as cutting half of all texts anywhere would.
TEXT_END_LIFT = 4.0
#: Counts as so many places of each ending, divided into cuts and closings as the shorter ending is.
SMOOTHING = 1.0
#: A posterior of the length counts as this at most.
SUREST = 0.9999
#: The part of all rows that are cut, and the least part that is cut away from a source's limits.
P_CUT, P_CUT_LEAST = 0.1, 0.01
#: Log odds of the prior and of each kind of ending; of unfinished ones the most.
PRIOR, FINISHED, UNFINISHED, BROKEN = log(P_CUT / (1 - P_CUT)), -12.0, 7.0, 14.0
_tail = re.compile(r"[\W_]+$")
_closing = re.compile(r"[.?!…~。？！]")
_digits = re.compile(r"\d+")


def ending_key(word: str, n: int) -> str:
    """The last n characters of a word, its beginning being one of them; digits are alike."""
    return ("^" + _digits.sub("0", word.lower()))[-n:]


def last_word(text: str) -> tuple[str, str]:
    """(the last word without its marks, `broken` if a character is broken off or a line has only begun)."""
    text = text.rstrip()
    broken = text.endswith("�")
    tokens = text.rstrip("�").rstrip().splitlines()[-1].split() if text.rstrip("�").strip() else []
    while tokens and not _tail.sub("", tokens[-1]) and all(_closing.match(c) for c in tokens[-1]):
        tokens.pop()  # marks apart from their word
    word = _tail.sub("", tokens[-1]) if tokens else ""
    return word, "broken" if broken or not word else ""


def tally(text: str, counts: dict[str, list[int]]) -> None:
    """Adds a text's words to counts: word -> [closing a sentence, inside one, closing the text]."""
    lines = text.splitlines()
    for i, line in enumerate(lines):
        tokens = line.split()
        for j, token in enumerate(tokens):
            word = _tail.sub("", token)
            if not word:
                continue
            mark = token[len(word) : len(word) + 1]
            last = j == len(tokens) - 1
            if last and i == len(lines) - 1:
                kind = 2
            else:
                kind = 0 if (last or _closing.match(mark or " ")) and not word[-1].isdigit() else 1
            counts.setdefault(word, [0, 0, 0])[kind] += 1


def _words(df: DataFrame, text: str) -> DataFrame:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for t in batch.column(0).to_pylist():
                if t and t.strip():
                    tally(t, counts)
            # a word may be a whole text without spaces: what follows needs its end, and the ends of its beginnings
            columns = list(zip(*((w, *n) for w, n in counts.items()))) if counts else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()))], names=["word", "f", "m", "e"])

    return df.select(F.col(text)).mapInArrow(counted, "word string, f long, m long, e long").groupBy("word").agg(*(F.sum(c).alias(c) for c in "fme"))


def endings(df: DataFrame, text: str = "text") -> DataFrame:
    """(key, finished, known, cuts, closings): every ending of up to three characters that closes a word of the corpus, and if it closes sentences.

    cuts: how often as many cuts at random places as sentences close would leave it.
    """
    words = written(_words(df, text))  # counted for the keys and for the totals

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            closing: dict[str, list[int]] = {}
            places: dict[str, int] = {}
            for word, f, m, e in zip(*(c.to_pylist() for c in batch.columns)):
                for n in (1, 2, 3):
                    own = closing.setdefault(ending_key(word, n), [0, 0, 0])
                    own[0] += f
                    own[1] += m
                    own[2] += e
                # a cut at a random place leaves the ending of a beginning of the word
                total = f + m + e
                plain = "^" + word.lower()
                if len(plain) == len(word) + 1 and not _digits.search(word):
                    parts = (plain[max(0, i - n) : i] for i in range(2, len(plain) + 1) for n in (1, 2, 3))
                else:
                    parts = (ending_key(word[:i], n) if i <= 8 else _digits.sub("0", word[i - 8 : i].lower())[-n:] for i in range(1, len(word) + 1) for n in (1, 2, 3))
                for key in parts:
                    places[key] = places.get(key, 0) + total
            rows = [(k, *closing.get(k, (0, 0, 0)), places.get(k, 0)) for k in {**places, **closing}]
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.string(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds)], names=["key", "f", "m", "e", "t"])

    keys = words.mapInArrow(keyed, "key string, f long, m long, e long, t long").groupBy("key").agg(*(F.sum(c).alias(c) for c in "fmet"))
    # places of cuts: all characters of words; each stands once among the keys of each length
    totals = words.agg(F.sum((F.col("f") + F.col("m") + F.col("e")) * F.length("word")).alias("places"), F.sum("e").alias("texts"), F.sum("f").alias("closings"))
    seen = F.col("f") + F.col("m")
    closes = (seen >= MIN_SEEN) & (F.col("f") >= FINAL_SHARE * seen)
    expected = F.lit(0.5) * totals.select("texts").scalar() * F.col("t") / totals.select("places").scalar()
    formula = (F.col("e") >= MIN_SEEN) & (F.col("e") >= TEXT_END_LIFT * expected)
    cuts = totals.select("closings").scalar() * F.col("t") / totals.select("places").scalar()
    return keys.where(F.col("f") + F.col("m") + F.col("e") > 0).select("key", (closes | formula).alias("finished"), ((seen >= MIN_SEEN) | formula).alias("known"), cuts.alias("cuts"), F.col("f").alias("closings"))


# --- right-censored lengths ---


def _phi(x: float) -> float:
    return exp(-x * x / 2) / sqrt(2 * pi)


def _above(x: float) -> float:
    return max(1e-12, 0.5 * (1 - erf(x / sqrt(2))))


def fit_censored(lengths: np.ndarray, counts: np.ndarray, limits: dict[int, float], rounds: int = 200) -> tuple[float, float, dict[int, float]]:
    """(mu, sigma, posterior by limit) of log-normal lengths, right-censored at the limits.

    limits: the rows at each, of which a share is cut there; the share and the distribution are estimated in turn.
    """
    y, n = np.log(lengths), counts.astype(float)
    share = {c: 0.9 for c in limits}
    mu, sigma = float(np.average(y, weights=n)), max(0.05, float(np.sqrt(np.cov(y, aweights=n, bias=True))) if len(y) > 1 else 0.5)
    for _ in range(rounds):
        weight = n.copy()
        first = second = 0.0
        total = float(n.sum())
        for c, s in share.items():
            at = np.flatnonzero(lengths == c)[0]
            cut = n[at] * s
            weight[at] -= cut
            z = (log(c) - mu) / sigma
            hazard = _phi(z) / _above(z)
            mean = mu + sigma * hazard
            first += cut * mean
            second += cut * (mu * mu + sigma * sigma + sigma * (log(c) + mu) * hazard)
        new_mu = (float((weight * y).sum()) + first) / total
        new_sigma = max(0.05, sqrt(max(1e-9, (float((weight * y * y).sum()) + second) / total - new_mu**2)))
        moved = abs(new_mu - mu) + abs(new_sigma - sigma)
        mu, sigma = new_mu, new_sigma
        for c in share:
            at = np.flatnonzero(lengths == c)[0]
            expected = total * _phi((log(c) - mu) / sigma) / (sigma * c)
            share[c] = min(0.999, max(0.0, 1 - expected / n[at]))
        if moved < 1e-7:
            break
    return mu, sigma, share


def candidate_limits(lengths: np.ndarray, counts: np.ndarray, lift: float = 6.0) -> dict[int, float]:
    """Lengths that far more rows have than their neighbourhood (a tenth of the length to both sides)."""
    found = {}
    order = np.argsort(lengths)
    lengths, counts = lengths[order], counts[order]
    sums = np.concatenate([[0], np.cumsum(counts)])
    for c, n in zip(lengths.tolist(), counts.tolist()):
        if n < 5:
            continue
        lo, hi = np.searchsorted(lengths, [c * 0.9, c * 1.1])
        usual = (sums[hi] - sums[lo] - n) / max(1.0, 0.2 * c)
        if n >= 5 + lift * usual and n >= 5 * sqrt(usual + 1) + usual:
            found[c] = float(n)
    return found


def source_limits(rows: DataFrame) -> DataFrame:
    """(source, unit, limit, rows_at, posterior, mu, sigma, rows) from rows of (source, chars, bytes).

    Only lengths that at least five rows of a source have can be limits.
    """
    each = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("size")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("size"))))
    histogram = rows.select("source", each.alias("u")).select("source", "u.unit", "u.size").where("size > 0").groupBy("source", "unit", "size").agg(F.count(F.lit(1)).alias("n"))

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths, counts = pdf["size"].to_numpy(), pdf["n"].to_numpy()
        limits = candidate_limits(lengths, counts)
        mu, sigma, share = fit_censored(lengths, counts, limits)
        first = pdf.iloc[0]
        out = [(first["source"], first["unit"], int(c), int(n), float(share[c]), mu, sigma, int(counts.sum())) for c, n in limits.items()]
        return pd.DataFrame(out, columns=["source", "unit", "limit", "rows_at", "posterior", "mu", "sigma", "rows"])

    schema = "source string, unit string, limit long, rows_at long, posterior double, mu double, sigma double, rows long"
    return histogram.groupBy("source", "unit").applyInPandas(fitted, schema)


def measured(df: DataFrame, key: str = "anon_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, chars, bytes, key2, key3, broken) of each row."""
    slim = df.select(F.col(key).alias("id"), F.col(source).alias("source"), F.col(text).alias("t"))
    kind = slim.schema["id"].dataType.simpleString()

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(2).to_pylist():
                if t is None or not t.strip():
                    out.append((None, None, None, None, False))
                    continue
                word, mark = last_word(t)
                out.append((len(t), len(t.encode("utf-8", "surrogatepass")), ending_key(word, 2), ending_key(word, 3), mark == "broken"))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, type=k) for c, k in zip(columns, kinds))], names=["id", "source", "chars", "bytes", "key2", "key3", "broken"])

    return slim.mapInArrow(ends, f"id {kind}, source string, chars long, bytes long, key2 string, key3 string, broken boolean")


def truncation(df: DataFrame, key: str = "anon_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, probability, truncated, limit, length_posterior, ending, length_odds, ending_odds) for each row.

    limit: the limit, in characters or bytes, at which the row's length stands; ending: finished, unfinished or broken.
    """
    rows = measured(df, key, text, source)
    known = endings(df, text)
    limits = written(source_limits(rows.where("chars is not null")))  # met by characters, by bytes and by source
    three = known.select(F.col("key").alias("key3"), F.col("finished").alias("f3"), F.col("known").alias("k3"), F.col("cuts").alias("c3"), F.col("closings").alias("s3"))
    two = known.select(F.col("key").alias("key2"), F.col("finished").alias("f2"), F.col("cuts").alias("c2"), F.col("closings").alias("s2"))
    one = known.select(F.col("key").alias("key1"), F.col("cuts").alias("c1"), F.col("closings").alias("s1"))
    joined = rows.withColumn("key1", F.right("key2", F.lit(1))).join(three, "key3", "left").join(two, "key2", "left").join(one, "key1", "left")
    for unit in ("chars", "bytes"):
        own = limits.where(F.col("unit") == unit).select(F.col("source").alias("_s"), F.col("limit").alias(f"limit_{unit}"), F.col("posterior").alias(f"at_{unit}"))
        joined = joined.join(own, F.col("source").eqNullSafe(F.col("_s")) & (F.col(unit) == F.col(f"limit_{unit}")), "left").drop("_s")
    # a limit in bytes shows in characters too where all rows are alike, so the larger share of the two counts
    by_unit = limits.groupBy("source", "unit").agg((F.sum(F.col("rows_at") * F.col("posterior")) / F.max("rows")).alias("share"))
    elsewhere = F.greatest(F.lit(P_CUT) - F.max("share"), F.lit(P_CUT_LEAST))
    off = by_unit.groupBy("source").agg((F.log(elsewhere / (1 - elsewhere)) - PRIOR).alias("off_odds")).withColumnRenamed("source", "_s")
    joined = joined.join(off, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    finished = F.coalesce(F.when(F.col("k3"), F.col("f3")), F.col("f2"), F.lit(False))
    posterior = F.greatest(F.coalesce("at_chars", F.lit(0.0)), F.coalesce("at_bytes", F.lit(0.0)))
    ending = F.when(F.col("broken"), "broken").when(finished, "finished").otherwise("unfinished")
    sure = F.least("length_posterior", F.lit(SUREST))
    length_odds = F.when(F.col("length_posterior") > 0, F.log(sure / (1 - sure))).otherwise(F.coalesce("off_odds", F.lit(0.0)))
    ending_odds = F.when(F.col("ending") == "broken", BROKEN).when(F.col("ending") == "finished", FINISHED).otherwise(F.least("cut", F.lit(UNFINISHED)))
    cut = closed = F.lit(0.5)  # the parts of cuts and closings among the places of the ending, from the shortest to the longest
    for n in "123":
        cuts, closings = (F.coalesce(f"{c}{n}", F.lit(0.0)) for c in "cs")
        total = cuts + closings + SMOOTHING
        cut, closed = (cuts + SMOOTHING * cut) / total, (closings + SMOOTHING * closed) / total
    joined = joined.withColumn("cut", F.log(cut / closed))
    scored = joined.withColumns({"length_posterior": posterior, "ending": ending}).withColumns({"length_odds": length_odds, "ending_odds": ending_odds.cast("double")})
    odds = F.lit(PRIOR) + F.col("length_odds") + F.col("ending_odds")
    probability = F.when(F.col("chars").isNotNull(), 1 / (1 + F.exp(-odds))).otherwise(F.lit(0.0))
    return scored.select(
        F.col("id").alias(key), F.col("source").alias(source), probability.alias("probability"), (probability > 0.5).alias("truncated"),
        F.coalesce("limit_chars", "limit_bytes").alias("limit"), "length_posterior", "ending", "length_odds", "ending_odds",
    )


def evidence(found: DataFrame, source: str = "source") -> DataFrame:
    """(source, both, ending_only, length_only, added_by_length, cleared_by_length): rows that count as truncated by both kinds of evidence and by each alone.

    added_by_length: truncated by both but not by the ending alone; cleared_by_length: the other way round.
    """
    alone = {k: (F.col("probability") > 0) & (F.lit(PRIOR) + F.col(f"{k}_odds") > 0) for k in ("ending", "length")}
    return found.groupBy(source).agg(
        F.count_if("truncated").alias("both"), F.count_if(alone["ending"]).alias("ending_only"), F.count_if(alone["length"]).alias("length_only"),
        F.count_if(F.col("truncated") & ~alone["ending"]).alias("added_by_length"), F.count_if(~F.col("truncated") & alone["ending"]).alias("cleared_by_length"),
    )


def rates(found: DataFrame, source: str = "source") -> DataFrame:
    """(source, rows, truncated, rate) per source."""
    return found.groupBy(source).agg(F.count(F.lit(1)).alias("rows"), F.count_if("truncated").alias("truncated")).withColumn("rate", F.col("truncated") / F.col("rows"))
