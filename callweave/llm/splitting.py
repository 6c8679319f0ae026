"""Splitting oversized texts at natural boundaries, with overlap.

One regular expression with bounded quantifiers eats a text piece by piece: its alternatives run from line ends
over sentence ends to word ends in the upper half of what a piece may hold, then the same in the lower half, and
at last single characters up to the limit. The overlap is looked back from each cut: up to `overlap_most`
characters, from a word's start where one lies at least `overlap_least` back. All of it is SQL on arrays; rows
aren't shuffled and no text passes through Python.

Defined results: null texts and texts of at most `limit` characters give no pieces (`keep_short` gives them as one
piece); whitespace is every Unicode space; lengths and offsets count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 1000
OVERLAP_LEAST, OVERLAP_MOST = 50, 150
#: The characters that end a sentence.
ENDS = ".?!…"
BLOCK = 256


#: The characters that end a line.
LINES = r"\n\r\x85\u2028\u2029"


def _alternatives(most: int, least: int = 1) -> str:
    """Boundaries in the upper half by strength, then the last one of any kind in the lower half, then characters.

    What is cut in the lower half is followed by at least half a piece without any boundary, so two pieces in a
    row are never short.
    """
    half = most // 2
    upper = rf".{{{half},{most - 1}}}"
    return rf"{upper}[{LINES}]|{upper}[{ENDS}](?=\s)|{upper}\s|{upper}[{ENDS}]|.{{{least - 1},{half - 1}}}[\s{ENDS}]|.{{{least},{most}}}"


def pattern(limit: int = LIMIT, overlap_least: int = OVERLAP_LEAST) -> str:
    """The expression that eats a text: the first piece may fill the limit, later ones leave room for the overlap.

    The rest of a text that fits into a piece is taken whole. The first piece isn't shorter than the overlap.
    """
    later = limit - overlap_least
    return rf"(?sU)\A(?:.{{1,{limit}}}\z|{_alternatives(limit, overlap_least)})|.{{1,{later}}}\z|{_alternatives(later)}"


def with_offsets(df: DataFrame, parts: str, name: str) -> DataFrame:
    """Adds the offsets of consecutive parts: the sums of all lengths before each, in two levels of blocks.

    Each step is a column of its own, so that it is computed once; the work per part is BLOCK plus a share of the
    sums of blocks instead of all parts before.
    """
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    block = lambda b: F.slice("_lengths", b * BLOCK + 1, F.lit(BLOCK))
    stepped = (
        df.withColumn("_lengths", F.transform(parts, F.length))
        .withColumn("_blocks", F.when(F.size("_lengths") > 0, F.sequence(F.lit(0), F.floor((F.size("_lengths") - 1) / F.lit(BLOCK)).cast("int"))).otherwise(F.array().cast("array<int>")))
        .withColumn("_sums", F.transform("_blocks", lambda b: total(block(b))))
        .withColumn("_bases", F.transform("_blocks", lambda b: total(F.slice("_sums", F.lit(1), b))))
    )
    inside = lambda b: F.transform(block(b), lambda _, i: F.col("_bases")[b] + total(F.slice("_lengths", b * BLOCK + 1, i)))
    return stepped.withColumn(name, F.flatten(F.transform("_blocks", inside))).drop("_lengths", "_blocks", "_sums", "_bases")


def _longest_stretch(cores: Column) -> Column:
    """The most characters without a natural boundary that lie across cuts: behind the last one of a core, in cores without any, before the next one."""
    head = lambda c: F.length(F.regexp_extract(c, rf"(?U)^[^\s{ENDS}]*", 0))

    def step(state: Column, c: Column) -> Column:
        lead = head(c)
        most = F.greatest(state["most"], state["open"] + lead)
        return F.struct(F.when(lead == F.length(c), state["open"] + lead).otherwise(head(F.reverse(c))).alias("open"), most.alias("most"))

    return F.aggregate(cores, F.struct(F.lit(0).alias("open"), F.lit(0).alias("most")), step)["most"]


def split_texts(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("file",), limit: int = LIMIT, overlap_least: int = OVERLAP_LEAST, overlap_most: int = OVERLAP_MOST, keep_short: bool = False
) -> DataFrame:
    """(keep, piece, start, end, boundary, overlap, content, unbroken): the pieces of each text, in order.

    start, end: offsets of the piece; overlap: how many of its characters the piece before also holds; boundary:
    what it ends at (line, sentence, word, end, character); unbroken: between two natural boundaries of the text lie
    more than `limit` characters, so some cut can't be natural. Such a stretch is longer than a piece, so it is put
    together from what lies between the cuts and the boundaries next to them.
    """
    whole = df.select(*keep, F.col(text).alias("_text"))
    kept = whole.where(F.col("_text").isNotNull() if keep_short else F.length("_text") > limit)
    cores = kept.withColumn("_cores", F.regexp_extract_all("_text", F.lit(pattern(limit, overlap_least)), F.lit(0))).drop("_text")
    cores = cores.withColumn("unbroken", _longest_stretch(F.col("_cores")) > limit)
    rows = with_offsets(cores, "_cores", "_starts").select(
        *keep,
        "unbroken",
        F.size("_cores").alias("_n"),
        F.posexplode(F.transform("_cores", lambda c, i: F.struct(c.alias("core"), F.when(i > 1, F.col("_cores")[i - 2]).otherwise(F.lit("")).alias("back2"), F.when(i > 0, F.col("_cores")[i - 1]).otherwise(F.lit("")).alias("back1"), F.col("_starts")[i].alias("at")))).alias("_i", "_c"),
    )
    # two cores in a row always hold more than the overlap: a short one is followed by a long one
    room = F.least(F.lit(overlap_most), F.lit(limit) - F.length("_c.core"))
    before = F.right(F.concat("_c.back2", "_c.back1"), room)
    # the longest tail of it that begins with a word and has at least overlap_least characters, else all of it
    tail = F.regexp_extract(before, rf"(?sU)^(?:.*?\s)?(\S.{{{overlap_least - 1},}})$", 1)
    wordwise = F.when(F.length(tail) >= overlap_least, tail).otherwise(before)
    core = F.col("_c.core")
    return rows.withColumn("_before", F.when(F.col("_i") > 0, wordwise).otherwise(F.lit(""))).select(
        *keep,
        F.col("_i").alias("piece"),
        (F.col("_c.at") - F.length("_before")).alias("start"),
        (F.col("_c.at") + F.length(core)).alias("end"),
        F.when(F.col("_i") == F.col("_n") - 1, F.lit("end"))
        .when(core.rlike(rf"[{LINES}]\z"), F.lit("line"))
        .when(core.rlike(rf"(?sU)[{ENDS}]\s*\z"), F.lit("sentence"))
        .when(core.rlike(r"(?sU)\s\z"), F.lit("word"))
        .otherwise(F.lit("character"))
        .alias("boundary"),
        F.length("_before").alias("overlap"),
        F.concat("_before", core).alias("content"),
        "unbroken",
    )


def cuts(pieces: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, cut): `forced` for texts in whose pieces a cut parts a stretch that no natural cut can part, else `natural`."""
    return pieces.select(*keys, F.when(F.col("unbroken"), F.lit("forced")).otherwise(F.lit("natural")).alias("cut")).distinct()
