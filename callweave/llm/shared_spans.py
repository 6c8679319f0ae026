"""Long exact spans shared between documents, and the fuzzy passages around them.

1. Seeds: of every window of `least - K + 1` k-mers of a text the one with the smallest hash (winnowing), so any
   span of `least` characters that two texts share gives both the same seed. Occurrences of one k-mer in one
   text with the same surroundings count once.
2. Copies of a text collapse: seeds are grouped by k-mer, text and position before they meet, with the
   smallest doc_id as the representative of its class.
3. K-mers of a single class are dropped. The rest is joined on the k-mer into anchors of pairs of classes. A
   k-mer of more than HOT classes isn't joined: all spans of `least` characters around its occurrences are
   hashed instead and only equal spans meet, so an announcement shorter than `least` pairs nobody, however
   common it is, and a longer one pairs only those that do share it. Only the first and the last span of what two
   texts share in a row meet; the anchor is the whole run.
4. Anchors of a pair that overlap on one diagonal are one. They are chained in the order of both texts by the best
   sum of sizes less the costs of gaps, which Fenwick trees of prefix maxima give: one for steps that shift the
   diagonal to one side, one for those that shift it to the other.
5. Each chain is aligned in the passages of the two texts that it touches: exact spans come from extending
   its anchors character by character, the fuzzy passage from aligning the gaps between them.
6. Shares of texts need no pairs where many texts hold the same spans: such spans are counted by their content, what
   they cover is a union of places, and links come from groups of texts that hold the same sets of them.

Nothing is broadcast and nothing grows on the driver. Texts are shuffled once, the passages of pairs once more.

Defined results: null texts, and texts shorter than `least`, share nothing; texts are compared as stored; equal
texts form a class and share all of themselves; a doc_id that occurs twice doesn't pair with itself.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.intervals import union_length
from ..storage import written

LEAST = 250
K = 128
HOT = 32
#: A gap of a chain costs this much per character that the two sides differ in length, and per character skipped.
GAP_COST, SKIP_COST = 0.5, 0.05
#: A chain is cut where its anchors lie further apart than this.
MAX_GAP = 600
#: Texts are hashed in pieces of about this many characters.
PIECE_CHARS = 400_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def window_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of n codes, by doubling: about 2 log2(n) passes."""
    if len(codes) < n:
        return np.empty(0, dtype=np.uint64)
    power = (codes.astype(np.uint64) + np.uint64(1)) * _A
    power ^= power >> np.uint64(29)
    length, out, done = 1, None, 0
    rest = n
    while True:
        if rest & 1:
            if out is None:
                out = power.copy()
            else:
                size = min(len(out), len(power) - done)
                out = out[:size] * _B + power[done : done + size]
                out ^= out >> np.uint64(32)
            done += length
        rest >>= 1
        if not rest:
            return out[: len(codes) - n + 1]
        size = len(power) - length
        power = power[:size] * np.uint64(int(_B) + 2 * length) + power[length : length + size]
        power ^= power >> np.uint64(31)
        length *= 2


def minima(values: np.ndarray, w: int) -> np.ndarray:
    """Sorted places that hold the smallest value of some window of w values, the rightmost of equal ones.

    The low bits of a value give way to the place, so that a window's minimum tells where it is. Which place
    wins depends on the window's content alone, also where the upper bits of different values are equal.
    """
    n = len(values)
    if not n:
        return np.empty(0, np.int64)
    w = min(w, n)
    bits = np.uint64(max(1, n.bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    blocks = -(-n // w) * w
    padded = np.full(blocks, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = (values >> bits << bits) | (mask - np.arange(n, dtype=np.uint64))
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[: n - w + 1], ahead[w - 1 : n])  # of the window that begins at each place
    return np.unique((mask - (least & mask)).astype(np.int64))


def seeds_of(text: str, least: int = LEAST, k: int = K) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(k-mer hashes, positions, repeats) of the seeds of a text.

    Seeds with equal k-mers and equal surroundings (as far as a span of `least` around the k-mer may reach) count once;
    repeats holds (position of the one that counts, position of another).
    """
    codes = codes_of(text)
    if len(codes) < least:
        return np.empty(0, np.uint64), np.empty(0, np.int64), []
    hashes = window_hashes(codes, k)
    at = minima(hashes, least - k + 1)
    found = hashes[at]
    again: list[tuple[int, int]] = []
    if len(np.unique(found)) < len(found):
        side = least - k
        seen: dict[tuple, int] = {}
        keep = []
        for p, h in zip(at.tolist(), found.tolist()):
            around = (h, min(p, side), codes[max(0, p - side) : p + k + side].tobytes())
            first = seen.setdefault(around, p)
            if first == p:
                keep.append(p)
            else:
                again.append((first, p))
        at = np.array(keep, dtype=np.int64)
        found = hashes[at]
    return found, at, again


def seeds(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, k: int = K) -> DataFrame:
    """(kmer, doc, pos): the seeds of each class of equal texts, doc being its smallest key."""
    slim = df.where(F.length(text) >= least).select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("same"), F.col(text).alias("t"))

    def sown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, sames = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            kmers, places, rows = [], [], []
            for i in range(batch.num_rows):
                found, at, _ = seeds_of(batch.column(2)[i].as_py(), least, k)
                kmers.append(found.astype(np.int64))
                places.append(at.astype(np.int32))
                rows.append(np.full(len(at), i))
            row = np.concatenate(rows).astype(np.int64) if rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(kmers) if kmers else np.empty(0, np.int64)), pa.array(sames[row]), pa.array(np.concatenate(places) if places else np.empty(0, np.int32)), pa.array(docs[row])],
                names=["kmer", "same", "pos", "doc"],
            )

    return slim.mapInArrow(sown, "kmer long, same long, pos int, doc long").groupBy("kmer", "same", "pos").agg(F.min("doc").alias("doc")).select("kmer", "doc", "pos")


def shared_seeds(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, k: int = K) -> DataFrame:
    """(kmer, doc, pos, n): the seeds whose k-mer stands in several classes, and its number of occurrences."""
    sown = seeds(df, key, text, least, k)
    common = sown.groupBy("kmer").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi").select("kmer", "n")
    return sown.join(common, "kmer")


def _near(places: list[int], spans: int, side: int) -> np.ndarray:
    """The places among so many spans whose span holds the k-mer at one of the given places."""
    mark = np.zeros(spans + 1, dtype=np.int64)
    for p in places:
        mark[min(spans, max(0, p - side))] += 1
        mark[min(spans, p + 1)] -= 1
    return np.flatnonzero(np.cumsum(mark[:-1]) > 0)


def _meet(shared: DataFrame) -> DataFrame:
    left = shared.select(F.col("kmer"), F.col("doc").alias("doc_a"), F.col("pos").alias("pos_a"))
    right = shared.select(F.col("kmer").alias("other"), F.col("doc").alias("doc_b"), F.col("pos").alias("pos_b"))
    return left.join(right, (F.col("kmer") == F.col("other")) & (F.col("doc_a") < F.col("doc_b"))).select("doc_a", "doc_b", "pos_a", "pos_b")


def hot_windows(df: DataFrame, shared: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, k: int = K, hot: int = HOT, once: bool = False) -> DataFrame:
    """(kmer, doc, pos, before, behind): the spans of `least` around hot k-mers by their hash, all of them or each content of a text once.

    before, behind: the spans next to them, where those are listed too.
    """
    places = shared.where(F.col("n") > hot).groupBy("doc").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    texts = df.where(F.length(text) >= least).select(F.col(key).cast("long").alias("doc"), F.col(text).alias("t"))
    side = least - k

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text_, at in zip(*(c.to_pylist() for c in batch.columns)):
                every = window_hashes(codes_of(text_), least).astype(np.int64)
                begin = _near(at, len(every), side)
                if once:
                    begin = np.sort(begin[np.unique(every[begin], return_index=True)[1]])
                found = every[begin]
                next_to = np.diff(begin) == 1
                follow, lead = np.append(False, next_to)[: len(begin)], np.append(next_to, False)[: len(begin)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(np.full(len(begin), doc, dtype=np.int64)), pa.array(begin.astype(np.int32)), pa.array(np.roll(found, 1), mask=~follow), pa.array(np.roll(found, -1), mask=~lead)],
                    names=["kmer", "doc", "pos", "before", "behind"],
                )

    return texts.join(places, "doc").select("doc", "t", "places").mapInArrow(spans, "kmer long, doc long, pos int, before long, behind long")


def anchors(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, k: int = K, hot: int = HOT, shared: DataFrame | None = None, with_hot: bool = True) -> DataFrame:
    """(doc_a, doc_b, pos_a, pos_b, size): equal k-mers (or, of hot k-mers, runs of equal spans of `least`) of two classes.

    shared: the table of `shared_seeds`, where it's written already. Of a hot span that a text holds several times
    the first place meets the others' first. with_hot: k-mers of many classes too.
    """
    shared = shared_seeds(df, key, text, least, k) if shared is None else shared
    cold = _meet(shared.where(F.col("n") <= hot)).withColumn("size", F.lit(k))
    if not with_hot:
        return cold
    windows = hot_windows(df, shared, key, text, least, k, hot, once=True).dropDuplicates(["kmer", "doc"])
    # a span that all its texts hold between the same neighbours neither begins nor ends a run of any two of them
    differ = " or ".join(f"count({c}) < count(*) or min({c}) < max({c})" for c in ("before", "behind"))
    edges = windows.groupBy("kmer").agg(F.expr(f"count(*) > 1 and ({differ})").alias("edge")).where("edge").select("kmer")
    edge = windows.join(edges, "kmer")
    left = edge.select("kmer", *(F.col(c).alias(f"{c}_a") for c in ("doc", "pos", "before", "behind")))
    right = edge.select(F.col("kmer").alias("other"), *(F.col(c).alias(f"{c}_b") for c in ("doc", "pos", "before", "behind")))
    begins, ends = (~F.coalesce(F.col(f"{c}_a") == F.col(f"{c}_b"), F.lit(False)) for c in ("before", "behind"))
    met = left.join(right, (F.col("kmer") == F.col("other")) & (F.col("doc_a") < F.col("doc_b")) & (begins | ends))
    # spans that follow one another in both texts make one anchor, as long as their run
    runs = met.groupBy("doc_a", "doc_b", (F.col("pos_b") - F.col("pos_a")).alias("diagonal")).agg(
        *(F.sort_array(F.collect_list(F.when(at, F.col("pos_a")))).alias(name) for name, at in (("begin", begins), ("end", ends)))
    )
    warm = runs.select("doc_a", "doc_b", "diagonal", F.explode(F.arrays_zip("begin", "end")).alias("r")).select(
        "doc_a", "doc_b", F.col("r.begin").alias("pos_a"), (F.col("r.begin") + F.col("diagonal")).alias("pos_b"), (F.col("r.end") - F.col("r.begin") + least).alias("size")
    )
    return cold.unionByName(warm.select("doc_a", "doc_b", "pos_a", "pos_b", "size"))


class Fenwick:
    """Prefix maxima of (score, anchor) in one or more dimensions; cells are made as they are needed."""

    def __init__(self, *sizes: int):
        self.sizes = sizes
        self.best: dict[tuple[int, ...], tuple[float, int]] = {}

    @staticmethod
    def _up(i: int, n: int) -> Iterator[int]:
        i += 1
        while i <= n:
            yield i
            i += i & -i

    @staticmethod
    def _down(i: int) -> Iterator[int]:
        i += 1
        while i > 0:
            yield i
            i -= i & -i

    def add(self, at: tuple[int, ...], entry: tuple[float, int]) -> None:
        for cell in product(*(self._up(i, n) for i, n in zip(at, self.sizes))):
            if entry > self.best.get(cell, NO_ANCHOR):
                self.best[cell] = entry

    def upto(self, at: tuple[int, ...]) -> tuple[float, int]:
        return max((self.best.get(cell, NO_ANCHOR) for cell in product(*map(self._down, at))), default=NO_ANCHOR)


NO_ANCHOR = (float("-inf"), -1)


def runs_of(found: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Anchors (pos_a, pos_b, size) with those that overlap or touch on one diagonal as one, in the order of pos_a."""
    out: list[list[int]] = []
    for a, b, size in sorted(set(found), key=lambda x: (x[0] - x[1], x[0])):
        if out and out[-1][0] - out[-1][1] == a - b and a <= out[-1][0] + out[-1][2]:
            out[-1][2] = max(out[-1][2], a + size - out[-1][0])
        else:
            out.append([a, b, size])
    return sorted(tuple(r) for r in out)


def chains(found: Iterable[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Anchors (pos_a, pos_b, size) as chains that ascend in both texts without overlaps, the best first; each run of anchors is in one.

    A chain is worth its sizes less, for each step, SKIP_COST per character skipped on the side that skips more and
    GAP_COST per character by which the diagonal shifts. For a step that doesn't shift it to lower diagonals the
    cost is a difference of a term of the one anchor and a term of the other, and the anchors before are those with a
    lower end in b and no higher diagonal: a prefix in two dimensions. For a step to a lower diagonal the end in a,
    in whose order anchors are added, and the diagonal suffice. So the best predecessor is the better of two prefix
    maxima. In the end chains are cut at gaps of more than MAX_GAP.
    """
    order = runs_of(found)
    diagonal = [a - b for a, b, _ in order]
    rank = {d: r for r, d in enumerate(sorted(set(diagonal)))}
    ends_b = sorted({b + size for _, b, size in order})
    level, higher = Fenwick(len(rank), len(ends_b)), Fenwick(len(rank))
    score, before = [0.0] * len(order), [-1] * len(order)
    by_end = sorted(range(len(order)), key=lambda i: order[i][0] + order[i][2])
    added = 0
    for i, (a, b, size) in enumerate(order):
        while added < len(by_end) and order[j := by_end[added]][0] + order[j][2] <= a:
            pa_, pb, psize = order[j]
            level.add((rank[diagonal[j]], bisect_left(ends_b, pb + psize)), (score[j] + SKIP_COST * (pa_ + psize) + GAP_COST * diagonal[j], j))
            higher.add((len(rank) - 1 - rank[diagonal[j]],), (score[j] + SKIP_COST * (pb + psize) - GAP_COST * diagonal[j], j))
            added += 1
        up, j_up = level.upto((rank[diagonal[i]], bisect_right(ends_b, b) - 1))
        down, j_down = higher.upto((len(rank) - 2 - rank[diagonal[i]],))
        gain, j = max((up - SKIP_COST * a - GAP_COST * diagonal[i], j_up), (down - SKIP_COST * b + GAP_COST * diagonal[i], j_down))
        score[i] = size + max(0.0, gain)
        before[i] = j if gain > 0 else -1
    used, out = [False] * len(order), []
    for i in sorted(range(len(order)), key=lambda x: -score[x]):
        chain: list[tuple[int, int, int]] = []
        while i >= 0 and not used[i]:
            used[i] = True
            a, b, size = order[i]
            if chain and max(chain[-1][0] - a, chain[-1][1] - b) - size > MAX_GAP:
                out.append(chain[::-1])
                chain = []
            chain.append(order[i])
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def extend(a: np.ndarray, b: np.ndarray, i: int, j: int) -> tuple[int, int]:
    """How far texts a and b are equal to the left of i and j, and from i and j to the right."""
    n = min(i, j)
    left = np.flatnonzero(a[i - n : i][::-1] != b[j - n : j][::-1])
    m = min(len(a) - i, len(b) - j)
    right = np.flatnonzero(a[i : i + m] != b[j : j + m])
    return int(left[0]) if len(left) else n, int(right[0]) if len(right) else m


def align(a: str, b: str, chain: list[tuple[int, int, int]], least: int) -> tuple[list[tuple[int, int, int]], int, int, int, int, float]:
    """Exact spans (start_a, start_b, size) of at least `least`, and the fuzzy passage with its identity.

    a, b: the passages; the chain's positions are relative to them.
    """
    x, y = codes_of(a), codes_of(b)
    parts: list[tuple[int, int, int]] = []
    for i, j, _ in chain:
        left, right = extend(x, y, i, j)
        if right and not any(p <= i < p + s and i - p == j - q for p, q, s in parts):
            parts.append((i - left, j - left, left + right))
    if not parts:
        return [], 0, 0, 0, 0, 0.0
    exact = [p for p in parts if p[2] >= least]
    line: list[tuple[int, int, int]] = []
    for i, j, s in sorted(parts):
        if line:
            over = max(0, line[-1][0] + line[-1][2] - i, line[-1][1] + line[-1][2] - j)
            i, j, s = i + over, j + over, s - over
        if s > 0:
            line.append((i, j, s))
    equal = sum(s for _, _, s in line)
    for (i, j, s), (i2, j2, _) in zip(line, line[1:]):
        if i + s < i2 and j + s < j2:
            equal += sum(m.size for m in SequenceMatcher(None, a[i + s : i2], b[j + s : j2], autojunk=False).get_matching_blocks())
    (a0, b0, _), (a1, b1, s1) = line[0], line[-1]
    return exact, a0, a1 + s1, b0, b1 + s1, equal / max(a1 + s1 - a0, b1 + s1 - b0)


def passages(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, k: int = K, hot: int = HOT, shared: DataFrame | None = None, with_hot: bool = True) -> DataFrame:
    """Chains of pairs of classes: (doc_a, doc_b, start_a, end_a, start_b, end_b, identity, longest, spans).

    spans: the exact spans (start_a, start_b, size) of at least `least` characters; longest: the size of the
    largest, 0 if the passage is only similar. One row for each chain.
    """
    side = least - k
    pair = "doc_a long, doc_b long, chain int"

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for a, b, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for n, chain in enumerate(chains([(f["pos_a"], f["pos_b"], f["size"]) for f in found])):
                    steps = [v for link in chain for v in link]
                    for doc, s, part in ((a, 0, chain), (b, 1, chain)):
                        low, high = max(0, part[0][s] - side), max(p[s] + p[2] for p in part) + side
                        out.append((doc, a, b, n, s, low, high - low, steps))
            columns = list(zip(*out)) if out else [[]] * 8
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds)], names=["doc", "doc_a", "doc_b", "chain", "side", "low", "size", "steps"])

    links = anchors(df, key, text, least, k, hot, shared, with_hot).groupBy("doc_a", "doc_b").agg(F.collect_set(F.struct("pos_a", "pos_b", "size")).alias("found"))
    wanted = links.mapInArrow(chained, f"doc long, {pair}, side int, low int, size int, steps array<int>")
    texts = df.where(F.length(text) >= least).select(F.col(key).cast("long").alias("doc"), F.col(text).alias("t"))
    cut = wanted.join(texts, "doc").select("doc_a", "doc_b", "chain", "side", "low", "steps", F.substring(F.col("t"), F.col("low") + 1, F.col("size")).alias("part"))
    both = cut.groupBy("doc_a", "doc_b", "chain").agg(
        *(F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{c}_{s}") for s in (0, 1) for c in ("low", "part")),
        F.max("steps").alias("steps"),
    )

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                if r["part_0"] is None or r["part_1"] is None:
                    continue
                low_a, low_b, v = r["low_0"], r["low_1"], r["steps"]
                chain = [(v[i] - low_a, v[i + 1] - low_b, v[i + 2]) for i in range(0, len(v), 3)]
                exact, a0, a1, b0, b1, identity = align(r["part_0"], r["part_1"], chain, least)
                if a1:
                    out.append((r["doc_a"], r["doc_b"], a0 + low_a, a1 + low_a, b0 + low_b, b1 + low_b, identity, max([0, *(s for _, _, s in exact)]), [{"start_a": i + low_a, "start_b": j + low_b, "size": s} for i, j, s in exact]))
            columns = list(zip(*out)) if out else [[]] * 9
            span = pa.list_(pa.struct([("start_a", pa.int32()), ("start_b", pa.int32()), ("size", pa.int32())]))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), span)
            names = ["doc_a", "doc_b", "start_a", "end_a", "start_b", "end_b", "identity", "longest", "spans"]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds)], names=names)

    return both.select("doc_a", "doc_b", "low_0", "part_0", "low_1", "part_1", "steps").mapInArrow(
        aligned, "doc_a long, doc_b long, start_a int, end_a int, start_b int, end_b int, identity double, longest int, spans array<struct<start_a:int,start_b:int,size:int>>"
    )


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(rep, doc, n): the members of each class of at least two equal texts of `least` characters or more."""
    kept = df.where(F.length(text) >= least).select(F.col(key).cast("long").alias("doc"), F.md5(text).alias("same")).distinct()
    sizes = kept.groupBy("same").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return kept.join(sizes, "same").select("rep", "doc", "n")


def sharing_pairs(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, k: int = K, hot: int = HOT) -> DataFrame:
    """(doc_a, doc_b): all pairs of documents that share an exact span of `least` characters, copies included."""
    found = passages(df, key, text, least, k, hot).where(F.col("longest") >= least).select("doc_a", "doc_b").distinct()
    copies = classes(df, key, text, least)
    member = copies.select(F.col("rep"), F.col("doc").alias("member"))
    out = found
    for side in ("doc_a", "doc_b"):
        out = out.join(member.withColumnRenamed("rep", "_rep"), F.col(side) == F.col("_rep"), "left").withColumn(side, F.coalesce("member", side)).drop("_rep", "member")
    out = out.select(F.least("doc_a", "doc_b").alias("doc_a"), F.greatest("doc_a", "doc_b").alias("doc_b"))
    within = member.select("rep", F.col("member").alias("doc_a")).join(member.select(F.col("rep").alias("_rep"), F.col("member").alias("doc_b")), (F.col("rep") == F.col("_rep")) & (F.col("doc_a") < F.col("doc_b"))).select("doc_a", "doc_b")
    return out.unionByName(within)


def repeated_seeds(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, k: int = K) -> DataFrame:
    """(doc, pos, again): for texts that repeat a passage, where a seed's surroundings stand again."""
    slim = df.where(F.length(text) >= least).select(F.col(key).cast("long").alias("doc"), F.col(text).alias("t"))

    def sown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, p, q) for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for p, q in seeds_of(t, least, k)[2]]
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32()))], names=["doc", "pos", "again"])

    return slim.mapInArrow(sown, "doc long, pos int, again int").distinct()


def common_runs(df: DataFrame, shared: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, k: int = K, hot: int = HOT) -> DataFrame:
    """(doc, group struct<n, x, y>, start, size): runs of spans around hot k-mers that one set of several texts holds.

    group: that set, by its size and two hashes of its members. Every place of a span counts; nothing is paired.
    """
    windows = hot_windows(df, shared, key, text, least, k, hot).groupBy("kmer", "doc").agg(F.collect_set("pos").alias("places"))
    members = windows.groupBy("kmer").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("doc")).alias("x"), F.bit_xor(F.xxhash64(F.col("doc"), F.lit(1))).alias("y")).where("n > 1")
    placed = windows.join(members, "kmer").select("doc", F.explode("places").alias("pos"), F.struct("n", "x", "y").alias("group"))
    order = Window.partitionBy("doc").orderBy("pos")
    opens = F.when((F.lag("group").over(order) == F.col("group")) & (F.lag("pos").over(order) == F.col("pos") - 1), 0).otherwise(1)
    runs = placed.withColumn("_o", opens).withColumn("_run", F.sum("_o").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc", "_run").agg(F.first("group").alias("group"), F.min("pos").alias("start"), (F.max("pos") - F.min("pos") + least).alias("size")).drop("_run")


def common_links(runs: DataFrame, pairs: DataFrame, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """(rep, links): how many other texts share a run of `runs` or are listed in pairs (rep, other), without pairing large groups.

    A group next to which all its members hold one larger group links nobody besides, and is left out. Groups of at
    most `hot` texts are paired. Texts that hold the same larger groups have the same links by them, so these sets of
    groups meet instead of the texts, and a pair counts only if its two sets have no group in common.
    """
    order = Window.partitionBy("doc").orderBy("start")
    row = F.struct("group", "start", "size")
    beside = runs.withColumns({"_l": F.lag(row).over(order), "_r": F.lead(row).over(order)})
    left = F.when(F.col("_l.start") + F.col("_l.size") - least + 1 == F.col("start"), F.col("_l.group"))
    right = F.when(F.col("start") + F.col("size") - least + 1 == F.col("_r.start"), F.col("_r.group"))
    next_to = beside.select("doc", "group", F.explode(F.array(left, right)).alias("larger")).where("larger.n > group.n").distinct()
    within = next_to.groupBy("group", "larger").agg(F.count(F.lit(1)).alias("m")).where("m = group.n").select("group").distinct()
    held = written(runs.select("doc", "group").distinct().join(within, "group", "left_anti"))
    few = held.where(F.col("group.n") <= hot)
    met = few.select("group", F.col("doc").alias("rep")).join(few.select("group", F.col("doc").alias("other")), "group").where("rep <> other").select("rep", "other")
    sets = held.where(F.col("group.n") > hot).groupBy("doc").agg(F.sort_array(F.collect_set("group")).alias("groups")).withColumn("set", F.md5(F.to_json("groups")))
    sizes = written(sets.groupBy("set").agg(F.count(F.lit(1)).alias("m"), F.first("groups").alias("groups")))
    each = sizes.select("set", "m", F.explode("groups").alias("group"))
    near = written(each.select("set", "group").join(each.select(F.col("set").alias("near"), "m", "group"), "group").select("set", "near", "m").distinct())
    of = sets.select(F.col("doc").alias("_d"), "set")
    many = of.join(near.groupBy("set").agg((F.sum("m") - 1).alias("many")), "set").select(F.col("_d").alias("rep"), "many")
    listed = pairs.select("rep", "other").unionByName(met).distinct()
    for side in ("rep", "other"):
        listed = listed.join(of.withColumnRenamed("set", f"{side}_set"), F.col(side) == F.col("_d"), "left").drop("_d")
    apart = listed.join(near.select(F.col("set").alias("rep_set"), F.col("near").alias("other_set")), ["rep_set", "other_set"], "left_anti")
    each_pair = apart.groupBy("rep").agg(F.count(F.lit(1)).alias("pairs"))
    return each_pair.join(many, "rep", "full_outer").select("rep", (F.coalesce("pairs", F.lit(0)) + F.coalesce("many", F.lit(0))).alias("links"))


def shared_shares(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, k: int = K, hot: int = HOT) -> DataFrame:
    """(rep, copies, links, shared_chars, n_chars, share) of each class of texts that shares a span with another, or has copies.

    share: the part of its characters that lie in exact spans of `least` characters or more that also stand in a
    text of another class; 1.0 for a text with copies. links: other classes that it shares a span with.
    """
    seeds_ = written(shared_seeds(df, key, text, least, k))  # for the passages and for the spans of many texts
    found = written(passages(df, key, text, least, k, hot, seeds_, with_hot=False).where(F.col("longest") >= least)).select("doc_a", "doc_b", F.explode("spans").alias("s"))
    sides = found.select(F.col("doc_a").alias("rep"), F.col("doc_b").alias("other"), F.col("s.start_a").alias("start"), F.col("s.size").alias("size")).unionByName(
        found.select(F.col("doc_b").alias("rep"), F.col("doc_a").alias("other"), F.col("s.start_b").alias("start"), F.col("s.size").alias("size"))
    )
    common = written(common_runs(df, seeds_, key, text, least, k, hot))
    places = sides.select("rep", "start", "size").unionByName(common.select(F.col("doc").alias("rep"), "start", "size"))
    side = least - k
    again = repeated_seeds(df, key, text, least, k)
    # what a seed's surroundings hold of a span stands again where the seed does
    inside = (F.col("rep") == F.col("doc")) & (F.col("pos") >= F.col("start")) & (F.col("pos") + k <= F.col("start") + F.col("size"))
    low, high = F.greatest(F.col("start"), F.col("pos") - side), F.least(F.col("start") + F.col("size"), F.col("pos") + k + side)
    more = places.join(again, inside).select("rep", (low + F.col("again") - F.col("pos")).alias("start"), (high - low).alias("size"))
    places = places.unionByName(more)
    covered = union_length(places.select("rep", "start", (F.col("start") + F.col("size")).alias("end")), ["rep"])
    links = common_links(common, sides, least, hot)
    sizes = classes(df, key, text, least).groupBy("rep").agg(F.max("n").alias("copies"))
    texts = df.where(F.length(text) >= least).select(F.col(key).cast("long").alias("rep"), F.length(text).alias("n_chars")).dropDuplicates(["rep"])
    joined = covered.join(links, "rep").join(sizes, "rep", "full_outer").join(texts, "rep")
    return joined.select(
        "rep",
        F.coalesce("copies", F.lit(1)).alias("copies"),
        F.coalesce("links", F.lit(0)).alias("links"),
        F.when(F.col("copies") > 1, F.col("n_chars")).otherwise(F.col("covered")).cast("long").alias("shared_chars"),
        "n_chars",
        (F.when(F.col("copies") > 1, F.col("n_chars")).otherwise(F.col("covered")) / F.col("n_chars")).alias("share"),
    )
