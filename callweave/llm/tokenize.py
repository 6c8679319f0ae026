"""Encoding of a corpus with a byte-level BPE vocabulary.

Every pre-token is merged by a queue over the merge ranks: a bucket per rank holds positions of a
linked list of symbols, a three-level bitmap over the ranks finds the lowest rank that has a bucket
(find-first-set on each level), and entries whose symbols were merged meanwhile are skipped when they
come up. The work is proportional to the symbols plus the merges, also for a pre-token of megabytes.
Encoded pre-tokens are kept as ready bytes in a cache of bounded size.

Defined results: a null or empty text gives the empty list; strings that look like special tokens are
ordinary text; a lone surrogate can't occur in Spark strings.
"""

from __future__ import annotations

import base64
import os
import struct
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the public pattern that splits a text before the merges of byte_bpe_50k.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_ENTRIES = 200_000
#: Longer pre-tokens are encoded each time, so that the cache stays small.
CACHE_CHARS = 64
WORD = 64


class RankQueue:
    """Positions by rank; the lowest rank first, within a rank the leftmost position first."""

    def __init__(self, ranks: int):
        sizes = [-(-ranks // WORD)]
        while sizes[-1] > 1:
            sizes.append(-(-sizes[-1] // WORD))
        self.levels = [[0] * n for n in sizes]
        self.buckets: list[list[int] | None] = [None] * ranks

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        at = rank
        for level in self.levels:
            at, bit = divmod(at, WORD)
            had = level[at]
            level[at] = had | (1 << bit)
            if had:
                break

    def pop(self) -> tuple[int, int] | None:
        if not self.levels[-1][0]:
            return None
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            at = at * WORD + (word & -word).bit_length() - 1
        bucket = self.buckets[at]
        position = heappop(bucket)
        if not bucket:
            self.buckets[at] = None
            down = at
            for level in self.levels:
                down, bit = divmod(down, WORD)
                level[down] &= ~(1 << bit)
                if level[down]:
                    break
        return at, position


class ByteBpe:
    """An encoder of texts; ids are the merge ranks of the rank file."""

    def __init__(self, path: str, pattern: str = PATTERN, cache_entries: int = CACHE_ENTRIES):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.queue = RankQueue(max(self.ranks.values()) + 1)
        self.split = regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], int] = {}
        self.cache = _Cache(self, cache_entries)

    def _pair(self, left: int, right: int) -> int:
        """The rank of the merge of two symbols, -1 if there is none."""
        rank = self.pairs.get((left, right))
        if rank is None:
            rank = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            self.pairs[left, right] = rank
        return rank

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        symbols = [self.ranks[piece[i : i + 1]] for i in range(len(piece))]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue, pair = self.queue, self._pair
        for i in range(n - 1):
            if (rank := pair(symbols[i], symbols[i + 1])) >= 0:
                queue.push(rank, i)
        while (entry := queue.pop()) is not None:
            rank, i = entry
            if symbols[i] < 0 or (j := after[i]) >= n or pair(symbols[i], symbols[j]) != rank:
                continue  # stale: one of the two symbols was merged meanwhile
            symbols[i], symbols[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := pair(symbols[i], symbols[k])) >= 0:
                    queue.push(rank, i)
            if (h := before[i]) >= 0 and (rank := pair(symbols[h], symbols[i])) >= 0:
                queue.push(rank, h)
        return [s for s in symbols if s >= 0]

    def packed(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        return b"".join(map(self.cache.__getitem__, self.split(text)))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text or ""), dtype="<i4").tolist()


class _Cache(dict):
    def __init__(self, encoder: ByteBpe, most: int):
        super().__init__()
        self.encoder, self.most = encoder, most

    def __missing__(self, piece: str) -> bytes:
        ids = self.encoder.merge(piece.encode())
        packed = struct.pack(f"<{len(ids)}i", *ids)
        if len(piece) <= CACHE_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[piece] = packed
        return packed


_encoders: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """One encoder per Python worker and file."""
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]


def encode_corpus(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", into: str = "ids") -> DataFrame:
    """One row (key, ids) for each row of df; only the two columns are read, nothing is shuffled.

    path: the vocabulary where the driver finds it; executors get the file from the driver, once each.
    Columns of df other than key and text aren't used and may have any names. Repeated rows stay repeated.
    """
    slim = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = slim.schema["k"].dataType.simpleString()
    df.sparkSession.sparkContext.addFile(path)
    name = os.path.basename(path)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = encoder(SparkFiles.get(name)).packed
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = [pack(t) if t else b"" for t in part.column(1).to_pylist()]
                offsets = np.zeros(len(rows) + 1, dtype=np.int32)
                np.cumsum([len(r) >> 2 for r in rows], out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), dtype="<i4")))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["k", "ids"])

    return slim.mapInArrow(encoded, f"k {kind}, ids array<int>").select(F.col("k").alias(key), F.col("ids").alias(into))
