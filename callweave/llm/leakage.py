"""Held-out evaluation items inside training documents.

The items' normalised n-grams (runs of letters and digits, case, spacing, punctuation and speaker labels
aside) go to every executor as a sorted hash set; one scan of the documents looks up every window of the
same length, and only passages with enough hits of one item, in the item's order, are aligned with it.
Documents are never shuffled. The set is broadcast behind a check of its size (MAX_SET_BYTES); item sets
beyond it are read and scanned in blocks, each of them within the bound, so there is no largest set.

Which changes are survived: the words that a passage leaves unchanged must still hold CANDIDATE_SHARE of the item's
n-grams, and be half of its words as they are. Unchanged words of fewer than GRAM letters without an unchanged neighbour
hold no n-gram; see the README for what that means in recall. Items of fewer than GRAM letters are found where they stand whole.

Defined results: null and empty texts and items without letters or digits match nothing; repeated item rows
count once; a document that occurs twice comes out twice only if its row does. Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.intervals import union

GRAM = 4
#: A passage is aligned with an item if it holds this share of the item's n-grams in the item's order.
CANDIDATE_SHARE = 0.08
MIN_SHARE = 0.5
#: Matches of fewer characters are taken for chance. Held shares of unrelated passages stay below 0.46 with 2.
MIN_BLOCK = 2
#: A passage may be this many times as long as the item.
PASSAGE = 1.5
#: N-grams of more items than this aren't looked up for items of which they cover at most COMMON_SHARE: half of such
#: an item's words can't be held without a third of the other ones.
COMMON, COMMON_SHARE = 16, 0.25
MAX_SET_BYTES = 64 << 20
#: Texts are hashed in pieces of about this many characters, so that memory doesn't follow the batch size.
PIECE_CHARS = 500_000

#: The writings of speaker labels before a colon.
LABEL = r"[\[(<]?(?:화자[ _]?[0-9０-９]{1,2}|화자미상|speaker[ _-]?[0-9]{1,2}|spk[ _-]?[0-9]{1,2}|agent|customer|manager|engineer|상담원|고객|팀장|기사)[\])>]?"
_label = re.compile(rf"(?:(?<=\s)|^){LABEL}\s?[:：]", re.IGNORECASE)
_other = re.compile(r"[\W_]+")
_letter = re.compile(r"[^\W_]")


def words_of(text: str) -> list[str]:
    """The normalised words of a text."""
    return [w for w in _other.split(_label.sub(" ", text).lower()) if w]


def compact(text: str) -> str:
    """The letters and digits of a text without its speaker labels, in lower case."""
    return _other.sub("", _label.sub(" ", text).lower())


def places_of(text: str) -> list[int]:
    """Where in the text the characters of its compact form stand."""
    plain = _label.sub(lambda m: " " * len(m[0]), text)
    return [i for i, c in enumerate(plain) for _ in _other.sub("", c.lower())]


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of n codes."""
    if len(codes) < n:
        return np.empty(0, dtype=np.uint64)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    out = np.zeros(len(codes) - n + 1, dtype=np.uint64)
    for i in range(n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += mixed[i : i + len(out)]
    out ^= out >> np.uint64(32)
    return out


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class _Grams:
    """The n-grams of one length; gram i stands in items owners[starts[i]:starts[i+1]] at `places`."""

    def __init__(self, n: int, hashes: list[np.ndarray], owners: list[np.ndarray], places: list[np.ndarray]):
        self.n = n
        every = np.concatenate(hashes)
        order = np.argsort(every, kind="stable")
        every, self.owners, self.places = every[order], np.concatenate(owners)[order], np.concatenate(places)[order]
        self.grams, first = np.unique(every, return_index=True)
        self.starts = np.append(first, len(every)).astype(np.int64)
        #: A bit per upper part of a hash: most windows end here.
        self.table = np.zeros(1 << 20, dtype=bool)
        self.table[(self.grams >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, place in the item) of each n-gram of an item."""
        found = gram_hashes(codes, self.n)
        at = np.flatnonzero(self.table[(found >> np.uint64(44)).astype(np.int64)])
        gram = np.searchsorted(self.grams, found[at])
        gram[gram == len(self.grams)] = 0
        keep = self.grams[gram] == found[at]
        at, gram = at[keep], gram[keep]
        counts = self.starts[gram + 1] - self.starts[gram]
        which = np.repeat(self.starts[gram], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(at, counts), self.owners[which], self.places[which]


class ItemSet:
    """The items of one block with their n-grams."""

    def __init__(self, items: list[tuple[int, str]], gram: int = GRAM, common: int = COMMON):
        self.ids = [i for i, _ in items]
        self.words = [words_of(t) for _, t in items]
        self.texts = ["".join(w) for w in self.words]
        self.lengths = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.sizes = np.zeros(len(items), dtype=np.int64)
        firsts = [np.unique(gram_hashes(codes_of(t), min(gram, max(1, len(t)))), return_index=True) for t in self.texts]
        many, owned = np.unique(np.concatenate([h for h, _ in firsts] or [np.empty(0, np.uint64)]), return_counts=True)
        many = many[owned > common]
        lists: dict[int, tuple[list, list, list]] = {}
        for i, (hashes, places) in enumerate(firsts):
            n = min(gram, len(self.texts[i]))
            rare = ~np.isin(hashes, many)
            covered = np.zeros(len(self.texts[i]), dtype=bool)
            for p in places[~rare]:
                covered[p : p + n] = True
            if covered.sum() > COMMON_SHARE * len(covered):
                rare[:] = True
            self.sizes[i] = rare.sum()
            if self.sizes[i]:
                for kept, values in zip(lists.setdefault(n, ([], [], [])), (hashes[rare], np.full(rare.sum(), i, dtype=np.int32), places[rare].astype(np.int32))):
                    kept.append(values)
        self.grams = [_Grams(n, *parts) for n, parts in lists.items()]

    def candidates(self, joined: str, ends: np.ndarray, share: float, least_held: float = 0.0) -> Iterator[tuple[int, int, int, int]]:
        """(item, text, first, last) of passages with enough different n-grams of an item in its order.

        joined: several texts, each followed by a character that no item holds; ends: where each of them ends. Per item
        and text the passages with most hits come first, and what overlaps one that was given isn't looked at again.
        Where fewer than least_held of the item's words stand at all, in any order, nothing is looked at.
        """
        if not self.grams:
            return
        codes = codes_of(joined)
        at, item, place = (np.concatenate(parts) for parts in zip(*(g.hits(codes) for g in self.grams)))
        if len(self.grams) > 1:
            order = np.argsort(at, kind="stable")
            at, item, place = at[order], item[order], place[order]
        # hits rise already; numbers of 16 bits are sorted in one pass
        order = np.argsort(item.astype(np.uint16) if len(self.ids) <= 1 << 16 else item, kind="stable")
        at, item, place = at[order], item[order].astype(np.int64), place[order]
        text = np.searchsorted(ends, at, side="right")
        span = len(codes) + 1
        reach = np.maximum((self.lengths * PASSAGE).astype(np.int64), 1)
        keys = item * span
        until = np.searchsorted(keys + at, keys + np.minimum(at + reach[item], ends[text] if len(text) else at), side="left")
        least = np.maximum(1, np.ceil(share * self.sizes)).astype(np.int64)
        dense = np.flatnonzero(until - np.arange(len(at)) >= least[item])
        if not len(dense):
            return
        firsts, lasts = at[dense], at[until[dense] - 1]
        room = np.maximum(0, reach[item[dense]] - (lasts - firsts))  # see leaks
        fronts, backs = (firsts - room).tolist(), (lasts + room + GRAM).tolist()
        firsts, lasts = firsts.tolist(), lasts.tolist()
        starts, stops = dense.tolist(), until[dense].tolist()
        borders = np.flatnonzero((np.diff(item[dense]) != 0) | (np.diff(text[dense]) != 0)) + 1
        lows = np.append(0, borders)
        for a, hi, i, n in zip(lows.tolist(), np.append(borders, len(dense)).tolist(), item[dense[lows]].tolist(), text[dense[lows]].tolist()):
            far, words, windows = int(reach[i]), self.words[i], []
            enough = least_held * len(words)
            begin, end = int(ends[n - 1]) if n else 0, int(ends[n]) - 1
            while a < hi:
                # the passages of windows that begin near each other lie in one part of the text
                b = bisect_right(firsts, firsts[a] + far // 2, a, hi)
                if sum(map(joined[max(begin, min(fronts[a:b])) : min(end, max(backs[a:b]))].__contains__, words)) >= enough:
                    windows += range(a, b)
                a = b
            windows.sort(key=lambda w: starts[w] - stops[w])
            taken: list[tuple[int, int]] = []
            for w in windows:
                first, last = firsts[w], lasts[w]
                if any(first <= y and x <= last for x, y in taken):
                    continue
                if _rising(place[starts[w] : stops[w]].tolist()) >= least[i]:
                    taken.append((first, last))
                    yield i, n, first, last

    def _in_order(self, i: int, passage: str) -> float:
        """A bound of what is held: the longest row of the item's words that stand in the passage at rising places."""
        tails: list[int] = []
        for word in self.words[i]:
            places, at = [], passage.find(word)
            while at >= 0:
                places.append(at)
                at = passage.find(word, at + 1)
            for p in reversed(places):  # so that a word counts once
                k = bisect_left(tails, p)
                tails[k : k + 1] = [p]
        return len(tails) / len(self.words[i])

    def held(self, i: int, passage: str, least: float = 0.0) -> float:
        """The share of the item's words that stand in the passage in the item's order; 0 where it can't reach `least`.

        A word is held if an alignment of the two texts covers all its characters by matches that reach
        beyond a single character on their own.
        """
        text = self.texts[i]
        if sum(map(passage.__contains__, self.words[i])) < least * len(self.words[i]) or self._in_order(i, passage) < least:
            return 0.0
        covered = np.zeros(len(text), dtype=bool)
        for block in SequenceMatcher(None, text, passage, autojunk=False).get_matching_blocks():
            if block.size >= min(MIN_BLOCK, len(text)):
                covered[block.a : block.a + block.size] = True
        ends = np.cumsum([len(w) for w in self.words[i]])
        total = np.concatenate([[0], np.cumsum(covered)])
        whole = total[ends] - total[np.concatenate([[0], ends[:-1]])] == np.diff(np.concatenate([[0], ends]))
        return float(whole.sum()) / len(ends)

    def leaks(self, texts: list[str], share: float, least: float) -> list[tuple[int, int, float, bool, int, int]]:
        """(text, item, held share, whether it stands whole, start, end) in compact texts, all passages of each item."""
        ends = np.cumsum([len(t) + 1 for t in texts])
        found = []
        for i, n, first, last in self.candidates("".join(t + "\x00" for t in texts), ends, share, least):
            text, base = texts[n], int(ends[n]) - len(texts[n]) - 1
            first, last = first - base, min(last - base + min(GRAM, int(self.lengths[i])), len(text))
            # the hit passage may be any part of the item: look as far as the rest of it could reach
            room = max(0, int(self.lengths[i] * PASSAGE) - (last - first))
            around = text[max(0, first - room) : last + room]
            held = self.held(i, around, least)
            if held >= least:
                found.append((n, i, held, self.texts[i] in around, first, last))
        return found


def _rising(places: list[int]) -> int:
    """The length of the longest strictly rising subsequence."""
    tails: list[int] = []
    for p in places:
        k = bisect_left(tails, p)
        tails[k : k + 1] = [p]
    return len(tails)


def _blocks(items: DataFrame | list[tuple[int, str]], key: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The different items in blocks of at most MAX_SET_BYTES; of a table no more than a block is on the driver at once."""
    if isinstance(items, DataFrame):
        rows = ((r[0], r[1]) for r in items.select(key, text).where(F.length(text) > 0).distinct().toLocalIterator())
    else:
        rows = iter(sorted({(i, t) for i, t in items if t}))
    block, size = [], 0
    for pair in rows:
        letters = len(compact(pair[1]))
        if letters:
            if block and size + 40 * letters > MAX_SET_BYTES:
                yield block
                block, size = [], 0
            block.append(pair)
            size += 40 * letters
    yield block


def leaks(df: DataFrame, items: DataFrame | list[tuple[int, str]], key: str = "doc_id", text: str = "text", share: float = CANDIDATE_SHARE, least: float = MIN_SHARE, item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, held, whole, start, end): passages of a document that hold at least `least` of an item's words.

    whole: the item stands there letter for letter. items: a table (item_key, item_text) or a list of pairs. start and end are offsets in the document's text; they
    span what was hit of the item, in whole words.
    """
    slim = df.select(F.col(key).alias("doc_id"), F.col(text).alias("t"))
    context = df.sparkSession.sparkContext
    found = None
    for part in _blocks(items, item_key, item_text):
        shared = context.broadcast(part)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = ItemSet(shared.value)
            for batch in batches:
                for rows in _scanned(known, batch, share, least):
                    columns = list(zip(*rows)) if rows else [[]] * 6
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.int32(), pa.int32()))],
                        names=["doc_id", "item_id", "held", "whole", "start", "end"],
                    )

        part_found = slim.mapInArrow(scan, "doc_id long, item_id long, held double, whole boolean, start int, end int")
        found = part_found if found is None else found.unionByName(part_found)
    return found


def _scanned(known: ItemSet, batch: pa.RecordBatch, share: float, least: float) -> Iterator[list[tuple]]:
    """The rows of a batch, piece by piece."""
    piece: list[tuple[int, str, str]] = []
    chars = 0
    for i in range(batch.num_rows + 1):
        if i < batch.num_rows and (t := batch.column(1)[i].as_py()):
            piece.append((batch.column(0)[i].as_py(), t, compact(t)))
            chars += len(t)
        if piece and (chars > PIECE_CHARS or i == batch.num_rows):
            rows = []
            for n, item, held, whole, first, last in known.leaks([c for _, _, c in piece], share, least):
                k, t, _ = piece[n]
                places = places_of(t)
                start, end = places[first], places[last - 1] + 1
                while start and _letter.match(t[start - 1]):
                    start -= 1
                while end < len(t) and _letter.match(t[end]):
                    end += 1
                rows.append((k, known.ids[item], held, whole, start, end))
            yield rows
            piece, chars = [], 0


def without_leaks(df: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """df without the documents that hold a leak."""
    return df.join(found.select(F.col("doc_id").alias("_leak")).distinct(), F.col(key) == F.col("_leak"), "left_anti")


def without_passages(df: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """df with `text` without the passages of found; documents without any stay as they are.

    Passages that overlap or touch are one. Null keys keep their texts.
    """
    spans = union(found.select(F.col("doc_id").alias("_leak"), "start", "end"), ["_leak"]).groupBy("_leak").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    joined = df.join(spans, F.col(key) == F.col("_leak"), "left")
    kept = F.transform(
        F.concat("_spans", F.array(F.struct(F.length(text).alias("start"), F.length(text).alias("end")))),
        lambda s, i: F.substring(F.col(text), F.when(i > 0, F.col("_spans")[i - 1]["end"]).otherwise(F.lit(0)) + 1, s["start"] - F.when(i > 0, F.col("_spans")[i - 1]["end"]).otherwise(F.lit(0))),
    )
    return joined.withColumn(text, F.when(F.col("_spans").isNull(), F.col(text)).otherwise(F.array_join(kept, ""))).drop("_leak", "_spans")
