"""Who speaks when: labels, the speaker of a chunk, smoothing.

Chunks are rows (file, pos, start, end, ...), turns rows (file, start, end, label). Overlaps are joined on the file
and a bin of time, so a long recording is spread over tasks and no chunk meets a turn that it can't overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..storage import written

BIN_SECONDS = 30.0
#: An interval has at most so many bins, or twice as many that are WIDE times as wide.
MOST_BINS, WIDE = 512, 1 << 20
_TURN = ("start", "end", "label")


def label_speakers(turns: DataFrame, label_format: str = DEFAULT.speaker_label_format) -> DataFrame:
    """Adds `speaker`: labels of a file numbered from 1 in the order of their first turn (start, end, label)."""
    firsts = turns.groupBy("file", "label").agg(F.min(F.struct(*_TURN)).alias("_first"))
    before, after = label_format.split("{index}")
    rank = F.row_number().over(Window.partitionBy("file").orderBy("_first"))
    names = firsts.select(F.col("file").alias("_f"), F.col("label").alias("_l"), F.concat(F.lit(before), rank.cast("string"), F.lit(after)).alias("speaker"))
    return turns.join(names, F.col("file").eqNullSafe(F.col("_f")) & F.col("label").eqNullSafe(F.col("_l"))).drop("_f", "_l")


def speaker_count(turns: DataFrame) -> DataFrame:
    return turns.groupBy("file").agg(F.count_distinct("label").alias("speakers"))


def _bins(start: Column, end: Column, width: float) -> Column:
    lo, hi = F.floor(start / width), F.floor(F.greatest(end, start) / width)
    return F.sequence(lo.cast("long"), hi.cast("long"))


def _placed(start: Column, end: Column, width: float, own: str, other: str) -> Column:
    """array<struct<table, bin>>: where an interval is looked up.

    Intervals of at most MOST_BINS bins have these. Longer ones have wide bins instead, at most 2 * MOST_BINS of them (the
    outer two hold all that is beyond), in a table of their own side (`own`), where all intervals of the other side are
    looked up. So no interval makes more than a bounded number of rows.
    """
    fine = F.transform(_bins(start, end, width), lambda b: F.struct(F.lit("fine").alias("table"), b.alias("bin")))
    bound = lambda x: F.least(F.greatest(F.floor(x / F.lit(width * WIDE)), F.lit(-MOST_BINS)), F.lit(MOST_BINS - 1)).cast("long")
    wide = F.sequence(bound(start), bound(F.greatest(end, start)))
    table = lambda name: F.transform(wide, lambda b: F.struct(F.lit(name).alias("table"), b.alias("bin")))
    short = F.greatest(end, start).cast("double") - start.cast("double") < F.lit(width * (MOST_BINS - 1))
    if own < other:  # of two long intervals one table is enough
        return F.when(short, F.concat(fine, table(other))).otherwise(F.concat(table(own), table(other)))
    return F.when(short, F.concat(fine, table(other))).otherwise(table(own))


def _numbered(turns: DataFrame) -> DataFrame:
    """Turns with valid edges and their place in the order (start, end, label) of the file."""
    kept = turns.where(F.col("start").isNotNull() & F.col("end").isNotNull()).select("file", *_TURN)
    return kept.withColumn("turn", F.row_number().over(Window.partitionBy("file").orderBy(*_TURN)))


def touching(chunks: DataFrame, turns: DataFrame, width: float = BIN_SECONDS, anchor: Column | None = None) -> DataFrame:
    """(file, pos, turn, c_start, c_end, t_start, t_end, label, overlap, holds): pairs that overlap, or whose turn holds the chunk's anchor.

    anchor: a point of the chunk (by default its middle, or its start if it ends before that).
    """
    middle = F.when(F.col("end") > F.col("start"), (F.col("start") + F.col("end")) / 2).otherwise(F.col("start").cast("double")) if anchor is None else anchor
    c = chunks.select("file", "pos", F.col("start").alias("c_start"), F.col("end").alias("c_end"), middle.alias("_at"), F.explode(_placed(F.col("start"), F.col("end"), width, "chunk", "turn")).alias("_b")).select("*", "_b.*")
    t = _numbered(turns).select(F.col("file").alias("_f"), "turn", F.col("start").alias("t_start"), F.col("end").alias("t_end"), "label")
    t = t.withColumn("_tb", F.explode(_placed(F.col("t_start"), F.col("t_end"), width, "turn", "chunk"))).select("*", F.col("_tb.table").alias("_table"), F.col("_tb.bin").alias("_bin"))
    overlap = F.least("c_end", "t_end") - F.greatest("c_start", "t_start")
    holds = F.col("_at").between(F.col("t_start"), F.col("t_end"))
    # a pair may share several bins: the one where the later of the two begins counts
    later = F.greatest("c_start", "t_start")
    wide = F.least(F.greatest(F.floor(later / F.lit(width * WIDE)), F.lit(-MOST_BINS)), F.lit(MOST_BINS - 1))
    first = F.when(F.col("table") == "fine", F.floor(later / width)).otherwise(wide)
    hit = (F.col("file") == F.col("_f")) & (F.col("table") == F.col("_table")) & (F.col("bin") == F.col("_bin")) & ((overlap > 0) | holds)
    return c.join(t, hit).where(F.col("bin") == first).select("file", "pos", "turn", "c_start", "c_end", "t_start", "t_end", "label", overlap.alias("overlap"), holds.alias("holds"))


def nearest(chunks: DataFrame, turns: DataFrame, anchor: Column) -> DataFrame:
    """(file, pos, label): the turn with an edge nearest to the anchor; of equally near ones the first.

    Edges and anchors are merged into one ordered series per file: the nearest edge before an anchor is the largest
    so far, the nearest behind it the smallest to come. Turns that hold the anchor are the caller's business.
    """
    t = _numbered(turns).select("file", F.explode(F.array(F.col("start").cast("double"), F.col("end").cast("double"))).alias("at"), "turn", "label")
    t = t.select("file", "at", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("pos"), F.struct(F.col("at"), (-F.col("turn")).alias("turn"), F.col("label")).alias("a"), F.struct("at", "turn", "label").alias("b"))
    empty_a, empty_b = (F.lit(None).cast(t.schema[c].dataType) for c in ("a", "b"))
    c = chunks.select("file", anchor.cast("double").alias("at"), F.lit(1).alias("kind"), F.col("pos").cast("long").alias("pos"), empty_a.alias("a"), empty_b.alias("b"))
    series = t.unionByName(c)
    up = Window.partitionBy("file").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("file").orderBy(F.col("at").desc(), F.col("kind").asc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = series.withColumns({"before": F.max("a").over(up), "after": F.min("b").over(down)}).where("kind = 1")
    before = F.when(F.col("before").isNotNull(), F.struct((F.col("at") - F.col("before.at")).alias("d"), (-F.col("before.turn")).alias("turn"), F.col("before.label").alias("label")))
    after = F.when(F.col("after").isNotNull(), F.struct((F.col("after.at") - F.col("at")).alias("d"), F.col("after.turn").alias("turn"), F.col("after.label").alias("label")))
    return rows.select("file", "pos", F.least(before, after)["label"].alias("label"))


def pick_speakers(chunks: DataFrame, turns: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Adds `speaker` to each chunk: the label it overlaps most.

    The turns that overlap a chunk are taken in order: one that overlaps by more than the tolerance beyond the best
    so far replaces it, one within the tolerance does if it goes on longer behind the chunk. Without an overlap it is
    the first turn that holds the chunk's middle, else the one nearest to it; without any turn it is unknown.
    """
    tolerance = F.lit(config.overlap_tie_tolerance)
    pairs = touching(chunks, turns, anchor=(F.col("start") + F.col("end")) / 2).groupBy("file", "pos").agg(
        F.sort_array(F.collect_list(F.when(F.col("overlap") > 0, F.struct("turn", "overlap", (F.col("t_end") - F.col("c_end")).alias("rest"), "label")))).alias("over"),
        F.min(F.when(F.col("holds"), F.struct("turn", "label"))).alias("holds"),
    )
    state = F.struct(F.lit(0.0).alias("overlap"), F.lit(0.0).alias("rest"), F.lit(None).cast("string").alias("label"), F.lit(False).alias("any"))

    def better(best: Column, t: Column) -> Column:
        more, less = t["overlap"] > best["overlap"] + tolerance, t["overlap"] < best["overlap"] - tolerance
        wins = ~best["any"] | more | (~less & (t["rest"] > best["rest"]))
        return F.when(wins, F.struct(t["overlap"].alias("overlap"), t["rest"].alias("rest"), t["label"].alias("label"), F.lit(True).alias("any"))).otherwise(best)

    best = F.aggregate("over", state, better)
    picked = pairs.select(F.col("file").alias("_f"), F.col("pos").alias("_p"), F.when(F.size("over") > 0, best["label"]).otherwise(F.col("holds.label")).alias("_label"))
    # written: most chunks are done here, and only those without a turn are looked at again
    rows = written(chunks.join(picked, (F.col("file") == F.col("_f")) & (F.col("pos") == F.col("_p")), "left").drop("_f", "_p"))
    lonely = rows.where(F.col("_label").isNull()).select("file", "pos", "start", "end")
    near = nearest(lonely, turns, (F.col("start") + F.col("end")) / 2).select(F.col("file").alias("_f"), F.col("pos").alias("_p"), F.col("label").alias("_near"))
    rows = rows.join(near, (F.col("file") == F.col("_f")) & (F.col("pos") == F.col("_p")), "left")
    return rows.withColumn("speaker", F.coalesce("_label", "_near", F.lit(config.unknown_speaker_label))).drop("_f", "_p", "_label", "_near")


def pick_by_overlap(words: DataFrame, segments: DataFrame) -> DataFrame:
    """Adds `speaker` (null without an overlap) and `overlap_ms`: the segment of most overlap, the first of equal ones.

    Both sides are in milliseconds.
    """
    pairs = touching(words, segments, BIN_SECONDS * 1000).where("overlap > 0")
    best = pairs.groupBy("file", "pos").agg(F.max(F.struct(F.col("overlap"), (-F.col("turn")).alias("turn"), F.col("label"))).alias("b"))
    picked = best.select(F.col("file").alias("_f"), F.col("pos").alias("_p"), F.col("b.label").alias("speaker"), F.col("b.overlap").cast("long").alias("_o"))
    rows = words.join(picked, (F.col("file") == F.col("_f")) & (F.col("pos") == F.col("_p")), "left")
    return rows.withColumn("overlap_ms", F.coalesce("_o", F.lit(0)).cast("long")).drop("_f", "_p", "_o")


def nearest_speakers(words: DataFrame, segments: DataFrame) -> DataFrame:
    """Adds `speaker`: the first segment that holds the word's anchor, else the nearest edge; null without segments.

    The anchor is the middle of the word, or its start if it has no length. Both sides are in milliseconds.
    """
    anchor = F.when(F.col("end") > F.col("start"), (F.col("start") + F.col("end")) / 2).otherwise(F.col("start").cast("double"))
    points = words.select("file", "pos", anchor.alias("start"), anchor.alias("end"))
    holds = touching(points, segments, BIN_SECONDS * 1000).groupBy("file", "pos").agg(F.min(F.struct("turn", "label")).alias("h"))
    held = holds.select(F.col("file").alias("_f"), F.col("pos").alias("_p"), F.col("h.label").alias("_held"), F.lit(True).alias("_is"))
    near = nearest(points, segments, F.col("start")).select(F.col("file").alias("_g"), F.col("pos").alias("_q"), F.col("label").alias("_near"))
    rows = words.join(held, (F.col("file") == F.col("_f")) & (F.col("pos") == F.col("_p")), "left").join(near, (F.col("file") == F.col("_g")) & (F.col("pos") == F.col("_q")), "left")
    return rows.withColumn("speaker", F.when(F.col("_is"), F.col("_held")).otherwise(F.col("_near"))).drop("_f", "_p", "_g", "_q", "_held", "_near", "_is")


def map_words(words: DataFrame, segments: DataFrame) -> DataFrame:
    """Words (file, pos, word, start, end in seconds, source) with speakers: `raw_speaker`, `speaker`, `overlap_ms`, times in ms.

    raw_speaker is null for words that overlap no segment; their speaker is the nearest. Empty words are left out.
    """
    from ..functions.numbers import milliseconds

    timed = words.where(F.col("word") != "").withColumns({"start": milliseconds(F.col("start")), "end": milliseconds(F.col("end")), "source": F.coalesce("source", F.lit("unknown"))})
    over = F.col("overlap") > 0
    best = touching(timed, segments, BIN_SECONDS * 1000).groupBy("file", "pos").agg(
        F.max(F.when(over, F.struct(F.col("overlap"), (-F.col("turn")).alias("turn"), F.col("label")))).alias("o"), F.min(F.when(F.col("holds"), F.struct("turn", "label"))).alias("h")
    )
    picked = best.select(F.col("file").alias("_f"), F.col("pos").alias("_p"), F.col("o.label").alias("raw_speaker"), F.col("o.overlap").cast("long").alias("overlap_ms"), F.col("h.label").alias("_held"))
    rows = timed.join(picked, (F.col("file") == F.col("_f")) & (F.col("pos") == F.col("_p")), "left").drop("_f", "_p").withColumn("overlap_ms", F.coalesce("overlap_ms", F.lit(0)).cast("long"))
    # written: only words without any segment are looked at again
    rows = written(rows.withColumn("_own", F.coalesce("raw_speaker", "_held")).drop("_held"))
    anchor = F.when(F.col("end") > F.col("start"), (F.col("start") + F.col("end")) / 2).otherwise(F.col("start").cast("double"))
    near = nearest(rows.where(F.col("_own").isNull()), segments, anchor).select(F.col("file").alias("_f"), F.col("pos").alias("_p"), F.col("label").alias("_near"))
    rows = rows.join(near, (F.col("file") == F.col("_f")) & (F.col("pos") == F.col("_p")), "left")
    return rows.withColumn("speaker", F.coalesce("_own", "_near")).drop("_f", "_p", "_own", "_near")


def smooth(assigned: DataFrame, config: Config = DEFAULT, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Chunks (keys, pos, start, end, speaker) where short runs between two runs of one other speaker take that speaker.

    A run is absorbed if it has at most max_chunks chunks, lasts at most max_seconds, and is at most max_gap from both
    neighbours. All runs are judged by the labels as given. Adds `absorbed`.
    """
    if config.speaker_smooth_max_chunks <= 0:
        return assigned.withColumn("absorbed", F.lit(False))
    order = Window.partitionBy(*keys).orderBy("pos")
    changes = F.when(F.col("speaker").eqNullSafe(F.lag("speaker").over(order)) & (F.row_number().over(order) > 1), 0).otherwise(1)
    runs = assigned.withColumn("_c", changes).withColumn("_run", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    summary = runs.groupBy(*keys, "_run").agg(F.count(F.lit(1)).alias("n"), F.min_by("start", "pos").alias("s"), F.max_by("end", "pos").alias("e"), F.first("speaker").alias("sp"))
    by_run = Window.partitionBy(*keys).orderBy("_run")
    before, after = F.lag("sp").over(by_run), F.lead("sp").over(by_run)
    fits = (
        F.lag("_run").over(by_run).isNotNull()
        & F.lead("_run").over(by_run).isNotNull()
        & before.eqNullSafe(after)
        & (F.col("n") <= config.speaker_smooth_max_chunks)
        & (F.col("e") - F.col("s") <= F.lit(config.speaker_smooth_max_seconds))
        & (F.col("s") - F.lag("e").over(by_run) <= F.lit(config.speaker_smooth_max_gap))
        & (F.lead("s").over(by_run) - F.col("e") <= F.lit(config.speaker_smooth_max_gap))
    )
    verdict = summary.withColumns({"_fits": fits, "_other": before}).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_run").alias("_r"), "_fits", "_other")
    same = F.col("_run") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rows = runs.join(verdict, same)
    return rows.withColumns({"absorbed": F.coalesce("_fits", F.lit(False)), "speaker": F.when(F.coalesce("_fits", F.lit(False)), F.col("_other")).otherwise(F.col("speaker"))}).drop("_c", "_run", "_r", "_fits", "_other", *(f"_k{i}" for i in range(len(keys))))
