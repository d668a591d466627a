"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that holds at least two periods and ``least`` words, and that no
neighbouring word extends keeping period q.

Periods below ``DIRECT`` are found by comparing the words at that lag. For
periods from L to 2L (L = DIRECT, 2 DIRECT, ...) each window of L/2 grams of L/2
words selects its grams of least hash. A run of such a period holds a whole
window and its copy one period later, so it holds a selected gram and its copy:
equal selected grams L to 2L apart are the seeds, and each is extended to both
sides word by word. A pair that lies whole in one known run of a period that
divides its distance is no seed: its extension would be that run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import pick, text_runs

#: A run has so many words at least (and two periods).
LEAST = 12
#: Periods below are found by direct lag scans; a power of two.
DIRECT = 16
#: Pairs of grams looked at together, a bound of memory alone.
PAIRS = 1 << 19
FACTOR = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD1342543DE82EF95

RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def words(text: str) -> list[bytes]:
    r"""Maximal pieces ``[^\x20\x09-\x0D]+`` of a text: what ``bytes.split`` parts at."""
    return text.encode().split()


def numbered(own: list[bytes]) -> np.ndarray:
    """A number for each distinct word, in the words' places."""
    numbers: dict[bytes, int] = {}
    return np.fromiter([numbers.setdefault(w, len(numbers)) for w in own], np.int64, len(own))


def stretches(same: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(first, end) of the maximal stretches of True that hold at least ``least`` places."""
    if len(same) < least:
        return []
    walls = np.concatenate(([-1], np.flatnonzero(~same), [len(same)]))
    at = np.flatnonzero(np.diff(walls) > least)
    return [(int(walls[i]) + 1, int(walls[i + 1])) for i in at]


def sliding(op: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``op`` over each window of ``width`` values, by windows that double."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = op(values[:-step], values[step:])
        have += step
    return values


def minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Places that are the least of some window of ``width`` grams, all ties included.

    A place is one where the greatest least of the windows over it is its own value.
    """
    low = sliding(np.minimum, grams, width)
    edge = np.zeros(width - 1, grams.dtype)
    return np.flatnonzero(sliding(np.maximum, np.concatenate((edge, low, edge)), width) == grams)


class Hashes:
    """Hashes modulo 2^64 of all grams of one length, from prefix sums. Equal grams have equal
    hashes; that unequal ones may share one costs an extension and nothing else."""

    powers = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    def __init__(self, ids: np.ndarray) -> None:
        n = len(ids)
        if len(Hashes.powers) <= n:
            size = 2 * n + 1024
            for name, base in (("powers", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(Hashes, name, np.cumprod(steps, dtype=np.uint64))
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * FACTOR
        mixed = (mixed ^ (mixed >> np.uint64(29))) * FACTOR
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * Hashes.powers[:n], dtype=np.uint64)))

    def grams(self, length: int) -> np.ndarray:
        own = (self.sums[length:] - self.sums[:-length]) * Hashes.inverse[:len(self.sums) - length]
        return (own ^ (own >> np.uint64(32))) * FACTOR


def agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Number of leading places in which ``a`` and ``b`` agree; looks little further."""
    most, at, block = min(len(a), len(b)), 0, 32
    while at < most:
        end = min(at + block, most)
        differ = a[at:end] != b[at:end]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, block = end, 2 * block
    return most


def seeds(hashes: Hashes, known: dict[tuple[int, int], int], n: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distances, first places) of equal selected grams from ``scale`` to twice that apart, ordered."""
    half, limit = scale // 2, min(2 * scale, n // 2 + 1)
    grams = hashes.grams(half)
    if len(grams) < half:
        return
    places = minimizers(grams, half)
    order = np.argsort(grams[places], kind="stable")
    places, values = places[order], grams[places][order]
    same = values[1:] == values[:-1]
    if not same.any():
        return
    # Places whose gram has no equal are of no use.
    paired = np.concatenate((same, [False])) | np.concatenate(([False], same))
    places, values = places[paired], values[paired]
    group = np.concatenate(([0], np.cumsum(values[1:] != values[:-1])))
    # Up to ``beyond`` the partners of a place lie with it in a known run of a period no longer than the gram.
    beyond = np.zeros(len(grams), np.int64)
    for (start, end), period in known.items():
        if period <= half and end - start >= scale + half:
            own = beyond[start:end - half + 1]
            np.maximum(own, end - half + 1, out=own)
    wide = n + 2 * scale + 1
    key = group * wide + places
    low = np.searchsorted(key, group * wide + np.maximum(places + scale, beyond[places]))
    high = np.searchsorted(key, group * wide + places + limit)
    counts = np.maximum(high - low, 0)
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        # So many places that their pairs fit the bound, one place at least.
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        own = counts[at:to]
        if total := int(own.sum()):
            first = np.repeat(places[at:to], own)
            skip = np.repeat(np.cumsum(own) - own, own)
            second = places[np.repeat(low[at:to], own) + np.arange(total) - skip]
            ranked = np.lexsort((first, second - first))
            yield (second - first)[ranked], first[ranked]
        at = to


def find_runs(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of numbers, ordered by start, then period."""
    n = len(ids)
    # By place and in rising order of periods: a stretch found again has a multiple of its smallest period.
    known: dict[tuple[int, int], int] = {}
    for period in range(1, min(DIRECT, n // 2 + 1)):
        for start, end in stretches(ids[period:] == ids[:-period], max(least, 2 * period) - period):
            known.setdefault((start, end + period), period)
    scale = DIRECT
    hashes = Hashes(ids) if 2 * scale <= n else None
    while 2 * scale <= n:
        found: dict[tuple[int, int], int] = {}
        for distances, firsts in seeds(hashes, known, n, scale):
            last = covered = -1
            for period, first in zip(distances.tolist(), firsts.tolist()):
                if period != last:
                    last, covered = period, -1
                if first < covered:
                    continue
                end = first + agreeing(ids[first:], ids[first + period:])
                start = first - agreeing(ids[:first][::-1], ids[:first + period][::-1])
                covered = end
                if end - start + period >= max(least, 2 * period):
                    found.setdefault((start, end + period), period)
        for place, period in found.items():
            known.setdefault(place, period)
        scale *= 2
    return sorted((start, end - start, period) for (start, end), period in known.items() if end - start >= least)


def collapsed(own: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return own
    drop = np.zeros(len(own) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(own, np.cumsum(drop).tolist()) if not d]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs``.

    ``runs`` holds (start, length, period) of every run, in words, ordered by
    start, then period; ``collapsed`` is the text without the words that a run
    holds after its first period, joined by one space. A null or empty text has
    no words, no runs and an empty collapsed text; rows with a null or repeated
    id are treated like any other, extra columns are left out, and an empty
    table gives no rows. Whole texts are read, however long: time is near linear
    in the words, and memory linear.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_runs(batch, "text"):
                counts, spans, kept = [], [], []
                for text in texts:
                    own = words(text)
                    runs = find_runs(numbered(own), least) if len(own) >= least else []
                    counts.append(len(own))
                    spans.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    kept.append(b" ".join(collapsed(own, runs)).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(counts, pa.int64()),
                     pa.array(spans, pa.list_(_RUN)), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    source = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """Of :func:`periodic_runs`: number of runs, the longest one (ties: smallest start, then
    period), and digests of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("under"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))))
    best = found.select("doc_id", "runs", "collapsed", longest.alias("best"), lines.alias("lines"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.under")).alias("period"), F.expr("(1000 * best.length) div (-best.under)").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
