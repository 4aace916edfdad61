"""Byte-level BPE with a public vocabulary by a pair occurrence index.

The distinct pre-tokens that a task has not met yet are laid out as one doubly linked symbol list.
Each adjacent pair that has a rank is mapped to all its positions; ranks are applied in ascending
order over the whole list, and each merge updates the neighbouring pairs' position lists. A merged
symbol's own pairs always rank later than the merge that made it, so one ascending sweep gives the
same result as merging every pre-token by itself.

Defined results: null text -> null ids, empty text -> empty list. Special-token strings inside a
text are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kaghamar.functions.codepoints import slices

#: The pre-token pattern of the byte_bpe_50k vocabulary (a fixed value of that vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_FILE = "byte_bpe_50k.tiktoken"
#: Entries of a worker's memory of encoded pre-tokens; past it the memory starts anew (results stay the same).
MEMORY = 400_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


class PairIndexEncoder:
    """Encodes pre-tokens in bulk; holds a bounded memory of those already encoded."""

    def __init__(self, path: str, pattern: str = PATTERN, memory: int = MEMORY):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.find = regex.compile(pattern).findall
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.token = {i: t for t, i in self.rank.items()}
        self.pair: dict[tuple[int, int], int] = {}
        self.memory = memory
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def merged(self, left: int, right: int) -> int:
        """The id of the two symbols' concatenation, -1 if the vocabulary lacks it."""
        found = self.pair.get((left, right))
        if found is None:
            found = self.pair[left, right] = self.rank.get(self.token[left] + self.token[right], -1)
            if len(self.pair) > 4 * self.memory:
                self.pair = {(left, right): found}
        return found

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of distinct pre-tokens, by the pair occurrence index."""
        raw = [w.encode("utf-8", "replace") for w in words]
        lengths = np.array([len(x) for x in raw], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        symbol = self.single[np.frombuffer(b"".join(raw), np.uint8)].tolist()
        size = len(symbol)
        word_end = set((starts[1:] - 1).tolist())
        follow = [i + 1 for i in range(size)]
        before = [i - 1 for i in range(size)]
        for end in word_end:
            follow[end] = -1
        for begin in starts[:-1][lengths > 0].tolist():
            before[begin] = -1
        places: dict[int, list[int]] = {}
        merged = self.merged
        for i in range(size):
            if follow[i] >= 0 and (rank := merged(symbol[i], symbol[i + 1])) >= 0:
                places.setdefault(rank, []).append(i)
        active = list(places)
        heapq.heapify(active)
        alive = [True] * size
        while active:
            rank = heapq.heappop(active)
            at = places.pop(rank, None)
            if at is None:
                continue
            at.sort()
            for i in at:
                j = follow[i]
                if not alive[i] or j < 0 or merged(symbol[i], symbol[j]) != rank:
                    continue
                symbol[i], alive[j] = rank, False
                after = follow[i] = follow[j]
                if after >= 0:
                    before[after] = i
                    if (new := merged(rank, symbol[after])) >= 0:
                        if new not in places:
                            places[new] = []
                            heapq.heappush(active, new)
                        places[new].append(i)
                if (prior := before[i]) >= 0 and (new := merged(symbol[prior], rank)) >= 0:
                    if new not in places:
                        places[new] = []
                        heapq.heappush(active, new)
                    places[new].append(prior)
        keep = np.array(alive, bool)
        ids = np.array(symbol, np.int32)[keep] if size else np.zeros(0, np.int32)
        counts = np.concatenate([[0], np.cumsum(keep)])
        return ids, counts[starts]

    def learn(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.number]
        if not fresh:
            return
        ids, starts = self.encode_words(fresh)
        base = len(self.number)
        self.number.update((w, base + i) for i, w in enumerate(fresh))
        self.starts = np.concatenate([self.starts, self.starts[-1] + starts[1:]])
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts: list[str | None], with_ids: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """(flat ids, their count per text); a null text counts none."""
        found = [self.find(t) if t else [] for t in texts]
        if len(self.number) > self.memory:
            self._clear()
        self.learn(set().union(*found))
        number = self.number
        sizes = np.array([len(x) for x in found], np.int64)
        which = np.fromiter((number[w] for ws in found for w in ws), np.int64, int(sizes.sum()))
        lengths = np.diff(self.starts)[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bounds = ends[np.concatenate([[0], np.cumsum(sizes)])]
        if not with_ids:
            return None, np.diff(bounds)
        take = np.repeat(self.starts[which] - ends[:-1], lengths) + np.arange(ends[-1])
        return self.flat[take], np.diff(bounds)


@lru_cache(maxsize=2)
def encoder(path: str) -> PairIndexEncoder:
    return PairIndexEncoder(path)


def encode_documents(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, ids: str = "ids") -> DataFrame:
    """(key, ids): the token ids of each row's text; one row per input row.

    Null text gives null ids, an empty text an empty list; whole texts are encoded, of any length.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for whole in batches:
            for batch in slices(whole, "t"):
                column = batch.column("t")
                flat, counts = tool.encode(column.to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32(), mask=np.append(np.asarray(column.is_null()), False))
                lists = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("k"), lists], ["k", "ids"])

    narrow = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    schema = T.StructType([narrow.schema["k"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return narrow.mapInArrow(run, schema).select(F.col("k").alias(key), F.col("ids").alias(ids))


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, n_tokens): as `encode_documents`, but only the counts; null for a null text."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for whole in batches:
            for batch in slices(whole, "t"):
                column = batch.column("t")
                _, counts = tool.encode(column.to_pylist(), with_ids=False)
                yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(counts, pa.int64(), mask=np.asarray(column.is_null()))], ["k", "n"])

    narrow = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    schema = T.StructType([narrow.schema["k"], T.StructField("n", T.LongType())])
    return narrow.mapInArrow(run, schema).select(F.col("k").alias(key), F.col("n").alias("n_tokens"))
