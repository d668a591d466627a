"""Packing by best-fit decreasing.

Overlong documents are cut into full windows of ``window`` tokens. What remains
of each document (under one window) is placed, longest first, into the open
window with the least room that still holds it. The windows are held in a
segment tree indexed by remaining capacity.

Pieces of one length are alike, so the tree works on counts: the corpus is
reduced to a histogram of piece lengths (at most ``window`` rows, whatever the
corpus size), best fit is run on that histogram, and its result is a list of
runs: "the pieces of rank a to b among all pieces, longest first, go to windows
s, s+1, ..., j in each, from offset o". Ranks are found in Spark by hashed
blocks of bounded size, so no length, however common, meets in one task.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import file_bytes, numbered, pick, place_of, stored, text_runs
from gridmix.llm.word_bpe import WordBpe

#: Pieces that one task ranks together.
BLOCK = 2_000

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
_ENCODER: dict[int, WordBpe] = {}


class CapacityTree:
    """Windows open at each remaining capacity, and the tightest that fits.

    A segment tree over capacities 0..window; a node says whether any window
    below it is open. ``groups[c]`` holds (first sequence id, number) of windows
    with c tokens of room that were filled alike.
    """

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.any = np.zeros(2 * self.leaves, dtype=bool)
        self.groups: list[deque[tuple[int, int]]] = [deque() for _ in range(window + 1)]

    def put(self, capacity: int, first: int, number: int) -> None:
        if number and capacity:
            self.groups[capacity].append((first, number))
            node = self.leaves + capacity
            while node and not self.any[node]:
                self.any[node] = True
                node >>= 1

    def take(self, capacity: int) -> tuple[int, int]:
        got = self.groups[capacity].popleft()
        if not self.groups[capacity]:
            node = self.leaves + capacity
            self.any[node] = False
            while node > 1 and not self.any[node ^ 1]:
                node >>= 1
                self.any[node] = False
        return got

    def tightest(self, length: int) -> int | None:
        """The least capacity of an open window that holds ``length``."""
        node = self.leaves + length
        if self.any[node]:
            return length
        while node > 1:
            if not node & 1 and self.any[node + 1]:  # a right sibling has open windows
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths.

    Returns runs (first rank, length, pieces in a window, first sequence id,
    first offset); ranks count all pieces, longest first, and a run ends where
    the next begins. Filling the tightest window until it no longer holds the
    length is what placing piece after piece does: with a piece in it the same
    window is tighter still.
    """
    tree, runs, rank, sequences = CapacityTree(window), [], 0, 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = window, window // length
                first, number = sequences, -(-left // each)
                sequences += number
            else:
                (first, number), each = tree.take(room), room // length
            full = min(number, left // each)
            over = left - full * each if full < number else 0  # pieces in the one window after the full ones
            runs.append((rank, length, each, first, window - room))
            rank, left = rank + full * each + over, left - full * each - over
            tree.put(room - each * length, first, full)
            if over:
                tree.put(room - over * length, first + full, 1)
            tree.put(room, first + full + bool(over), number - full - bool(over))
    return runs


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = 4096,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise ``docs`` and cut each into full windows and a remainder.

    Returns doc_id, start, length, doc_tokens, ids (little-endian unsigned
    32-bit). A document is its ids and then ``end_id``; a null or empty text is
    ``end_id`` alone. Repeated rows are packed as often as they occur.
    """
    spec = docs.sparkSession.sparkContext.broadcast(file_bytes(tokenizer))
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = spec.value
        encoder = _ENCODER.get(hash(source))
        if encoder is None:
            _ENCODER.clear()
            encoder = _ENCODER[hash(source)] = WordBpe(source)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, texts in text_runs(batch, "text"):
                out: tuple[list, ...] = ([], [], [], [], [])
                for i, own in enumerate(encoder.encode(texts), at):
                    own += end
                    total = len(own) // 4
                    for start in range(0, total, window):
                        part = own[4 * start:4 * (start + window)]
                        for column, value in zip(out, (ids[i], start, len(part) // 4, total, part)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, [pa.int64()] * 4 + [pa.binary()])],
                    ["doc_id", "start", "length", "doc_tokens", "ids"])

    source = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"),
                                                 F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(cut, PIECES)


def assign_windows(pieces: DataFrame, window: int = 4096, block: int = BLOCK) -> DataFrame:
    """Give each piece (a row with ``length`` in 1..window) a sequence_id and an offset there.

    Sequence ids are 0, 1, ... without gaps. Offsets in a sequence leave no
    gap. The other columns of ``pieces`` stay, whatever they are called, but for a
    sequence_id and an offset, which are replaced. Equal rows are packed each. An
    empty table gives an empty one; a null length is an error like one out of range.
    """
    spark = pieces.sparkSession
    names = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    plain = numbered(pieces)
    own = [f"c{i}" for i, c in enumerate(pieces.columns) if c in names]
    held = stored(plain.select(*own, F.col(f"c{place_of(pieces, 'length')}").cast("long").alias("length"),
                               F.monotonically_increasing_id().alias("_row")), "pieces")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(n is None or not 1 <= n <= window for n in counts):
        raise ValueError(f"lengths must lie in 1..{window}")
    runs = best_fit(counts, window)
    first, before, blocks = {}, 0, []
    for length in sorted(counts, reverse=True):
        first[length] = before
        before += counts[length]
        blocks.append((length, first[length], -(-counts[length] // block)))
    # One row per length; at most ``window`` rows.
    lengths = F.broadcast(spark.createDataFrame(blocks, "length long, base long, blocks long"))
    keyed = held.join(lengths, "length").withColumn(
        "_block", F.pmod(F.xxhash64("_row"), F.col("blocks")))
    sizes = keyed.groupBy("length", "_block").agg(F.count("*").alias("n"), F.first("base").alias("base"))
    before_block = sizes.select("length", "_block", (F.col("base") + F.sum("n").over(
        Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))).alias("a"), "base")
    ranked = keyed.drop("base", "blocks").withColumn(
        "_at", F.row_number().over(Window.partitionBy("length", "_block").orderBy("_row")) - 1
    ).join(before_block.select("length", "_block", F.coalesce("a", "base").alias("_from")), ["length", "_block"]
           ).withColumn("_rank", F.col("_from") + F.col("_at")).drop("_block", "_row", "_at", "_from")

    #: Bounded by the window: each length opens at most two groups of windows.
    plan = spark.sparkContext.broadcast(np.array(runs, dtype=np.int64).reshape(-1, 5))
    kept = own

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan.value
        for batch in batches:
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy(zero_copy_only=False)
            run = table[np.searchsorted(table[:, 0], rank, side="right") - 1]
            nth = rank - run[:, 0]
            sequence = run[:, 3] + nth // run[:, 2]
            offset = run[:, 4] + nth % run[:, 2] * run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in kept] + [pa.array(sequence), pa.array(offset)],
                [*kept, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.select(*kept).schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long").toDF(*names, "sequence_id", "offset")


def run_of(runs: list[tuple[int, int, int, int, int]], rank: int) -> tuple[int, int]:
    """(sequence id, offset) of one rank; for tests."""
    first, length, each, sequence, offset = runs[bisect_right([r[0] for r in runs], rank) - 1]
    return sequence + (rank - first) // each, offset + (rank - first) % each * length
