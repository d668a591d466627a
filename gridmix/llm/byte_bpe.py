"""Byte-level BPE by a two-tier lookup.

A pre-token that is a vocabulary entry is resolved at once by a minimal perfect
hash over the vocabulary. Any other goes through the merges: its bytes are a
linked list, the ranks of neighbouring parts lie in a heap, and the least rank,
leftmost first, is merged until none is left.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import file_bytes, pick, text_runs

NONE = 1 << 62
_LOW = (1 << 32) - 1
_MASK = (1 << 64) - 1
_RUNS = re.compile(r"\s\s")


class PerfectHash:
    """Hash-and-displace: n keys in n slots, found by one hash and one displacement.

    Keys fall into buckets; a bucket, largest first, gets the least displacement
    that sends its keys to free slots. Buckets of one key name their slot.
    """

    def __init__(self, keys: list[bytes], values: list[int]):
        n = self.n = len(keys)
        self.buckets = max(1, n // 2)
        rows: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        for i, key in enumerate(keys):
            h = xxhash.xxh64_intdigest(key)
            rows[h % self.buckets].append((h, i))
        place, self.shift = [-1] * n, [0] * self.buckets
        singles = []
        for b in sorted(range(self.buckets), key=lambda b: -len(rows[b])):
            if len(rows[b]) < 2:
                singles += [(b, i) for _, i in rows[b]]
                continue
            d = 1
            while True:
                slots = [self._slot(h, d) for h, _ in rows[b]]
                if len(set(slots)) == len(slots) and all(place[s] < 0 for s in slots):
                    break
                d += 1
            self.shift[b] = d
            for s, (_, i) in zip(slots, rows[b]):
                place[s] = i
        free = (s for s in range(n) if place[s] < 0)
        for (b, i), s in zip(singles, free):
            place[s] = i
            self.shift[b] = -s - 1
        self.keys = [keys[i] for i in place]
        self.values = [values[i] for i in place]

    def _slot(self, h: int, d: int) -> int:
        x = (h ^ (d * 0x9E3779B97F4A7C15)) & _MASK
        x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 & _MASK
        return (x ^ (x >> 32)) % self.n

    def get(self, key: bytes) -> int | None:
        if not self.n:
            return None
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        s = -d - 1 if d < 0 else self._slot(h, d)
        return self.values[s] if self.keys[s] == key else None


def read_ranks(source: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in source.splitlines() if line)}


class ByteBpe:
    def __init__(self, table: PerfectHash, pattern: str, cache_words: int = 400_000):
        self.table, self.most = table, cache_words
        self.cut = regex.compile(pattern).findall
        self.bytes_of: list[bytes] = [b""] * (max(table.values, default=-1) + 1)
        for key, value in zip(table.keys, table.values):
            self.bytes_of[value] = key
        self.words: dict[str, bytes] = {}  # what follows a space, without it
        self.pieces: dict[str, bytes] = {}
        self.pairs: dict[bytes, int] = {}

    def rank(self, part: bytes) -> int:
        """Rank of a pair of parts that is not in ``pairs`` yet; NONE if it is no entry."""
        if len(self.pairs) > self.most:
            self.pairs.clear()
        found = self.table.get(part)
        found = self.pairs[part] = NONE if found is None else found
        return found

    def merge(self, word: bytes) -> list[int]:
        """Ids of a pre-token that is no vocabulary entry.

        ``after`` and ``before`` link the parts by their first bytes; a part that
        was merged into its left neighbour has 0 in ``after``. A heap entry is
        (rank, first byte of the left part, end of the right part) as one number.
        """
        n, known, rank, push = len(word), self.pairs.get, self.rank, heapq.heappush
        after, before, heap = list(range(1, n + 1)), list(range(-1, n)), []
        for i in range(n - 1):
            part = word[i:i + 2]
            r = known(part)
            if (rank(part) if r is None else r) != NONE:
                heap.append((known(part) << 64) | (i << 32) | (i + 2))
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            left, end = (entry >> 32) & _LOW, entry & _LOW
            middle = after[left]
            if not middle or middle >= n or after[middle] != end:
                continue  # one of its parts has been merged since
            after[middle], after[left] = 0, end
            if end < n:
                before[end] = left
                part = word[left:after[end]]
                r = known(part)
                if r is None:
                    r = rank(part)
                if r != NONE:
                    push(heap, (r << 64) | (left << 32) | after[end])
            start = before[left]
            if start >= 0:
                part = word[start:end]
                r = known(part)
                if r is None:
                    r = rank(part)
                if r != NONE:
                    push(heap, (r << 64) | (start << 32) | end)
        ids, at, get = [], 0, self.table.get
        while at < n:
            end = after[at]
            part = word[at:end]
            r = known(part)
            ids.append(get(part) if r is None else r)
            at = end
        return ids

    def piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            raw = piece.encode()
            whole = self.table.get(raw)
            ids = self.merge(raw) if whole is None else [whole]
            found = b"".join([i.to_bytes(4, "little") for i in ids])
            if len(raw) <= 256 and len(self.pieces) < self.most:
                self.pieces[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids, little-endian unsigned 32-bit.

        Where no two white-space characters meet, the pattern never matches
        across a space's left side, so each word with the space before it is
        encoded alone, and kept.
        """
        if not text or text[0].isspace() or text[-1].isspace() or _RUNS.search(text):
            return b"".join([self.piece(p) for p in self.cut(text)])
        first, *rest = text.split(" ")
        words = self.words
        new = set(rest).difference(words)
        for word in new:
            words[word] = b"".join([self.piece(p) for p in self.cut(" " + word)])
        out = b"".join([self.piece(p) for p in self.cut(first)] + [words[w] for w in rest])
        if len(words) > self.most:  # the words met first, the frequent ones, stay
            for word in new:
                del words[word]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODERS: dict[int, ByteBpe] = {}


class Coder:
    """The vocabulary as a task gets it: the perfect hash is built once, on the driver, and broadcast."""

    def __init__(self, spark, ranks: str, pattern: str):
        vocabulary = read_ranks(file_bytes(ranks))
        self.pattern = pattern
        self.sent = spark.sparkContext.broadcast(PerfectHash(list(vocabulary), list(vocabulary.values())))
        self.key = hash((ranks, pattern))

    def __call__(self) -> ByteBpe:
        if self.key not in _CODERS:
            _CODERS.clear()
            _CODERS[self.key] = ByteBpe(self.sent.value, self.pattern)
        return _CODERS[self.key]


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row, ids as little-endian unsigned 32-bit. A null text has none."""
    coder = Coder(docs.sparkSession, ranks, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder()
        for batch in batches:
            for at, texts in text_runs(batch, "text"):
                ids = pa.array([bpe.encode(t) for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], ["doc_id", "ids"])

    source = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"),
                                                 F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids stand for."""
    coder = Coder(encoded.sparkSession, ranks, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder()
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                some = batch.slice(i, 64)
                out = pa.array([bpe.decode(x.as_buffer()) if x.is_valid else None for x in some.column(1)], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), out], ["doc_id", "ids", "decoded"])

    return pick(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
