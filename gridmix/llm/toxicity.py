"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is logistic in the word
and word-beginning features it holds; a document's score is their noisy-or,
1 - prod(1 - score). Only document labels are known: the sentence weights are
fitted so that the noisy-or explains them, and the same weights then locate the
offending sentences.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import numbered, pick, place_of, stored, text_runs

#: Bounds of the sample of labelled rows that is learnt from (those of least hash): their number, the bytes
#: of all their texts, and of one text. They bound what the fit holds; every feature that is sure is used.
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 512 << 20
LONGEST = 1 << 20
THRESHOLD = 0.3

LETTERS = re.compile(r"[^\W\d_]+")
#: A sentence: up to its mark or the end of its line.
MARKS = ".!?\n"
SENTENCE = re.compile(r"[^.!?\n]+")


def features(chunk: str) -> list[str]:
    """Of a lower-cased run of non-blanks: each word in it, and its first 4 and 5 letters."""
    out = []
    for word in LETTERS.findall(chunk):
        out.append(word)
        out += [word[:n] + "~" for n in (4, 5) if len(word) > n]
    return out


@dataclass
class Model:
    """Weights of features and the bias of a sentence; ``hot`` and ``cold`` keep what tasks learn of words."""

    weights: dict[str, float]
    bias: float
    hot: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)
    cold: set[str] = field(default_factory=set, repr=False)

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "bias": self.bias, "hot": {}, "cold": set()}

    def hits(self, chunks: set[str]) -> set[str]:
        """Those of the chunks that hold a feature of the model."""
        new = chunks.difference(self.cold).difference(self.hot)
        for chunk in new:
            if found := tuple([f for f in features(chunk) if f in self.weights]):
                self.hot[chunk] = found
        if len(self.cold) < 400_000:  # the words met first, the frequent ones
            self.cold |= new.difference(self.hot)
        return chunks & self.hot.keys()

    def logit(self, chunks: list[str]) -> float:
        own = {f for c in chunks for f in self.hot.get(c, ())}
        return self.bias + sum(self.weights[f] for f in own)

    def score(self, text: str) -> tuple[float, list[tuple[float, int, int]]]:
        """Noisy-or of a text, and (score, start, end) of the sentences with features.

        Each mark ends a sentence, so an empty text is one empty sentence.
        """
        low = lowered(text)
        plain = softplus(self.bias)
        total, found = plain * sentences(low), []
        hits = self.hits(set(low.split()))
        for m in SENTENCE.finditer(low) if hits else ():
            # A sentence can begin or end inside a run of the text, so its own runs are asked for.
            if self.hits(set(chunks := m[0].split())):
                z = self.logit(chunks)
                found.append((1 / (1 + math.exp(-max(z, -700.0))), m.start(), m.end()))
                total += softplus(z) - plain
        return -math.expm1(-max(total, 0.0)), found


def lowered(text: str) -> str:
    """Lower case, with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join([c.lower() if len(c.lower()) == 1 else c for c in text])


def sentences(text: str) -> int:
    return 1 + sum(map(text.count, MARKS))


def softplus(z: float) -> float:
    return max(z, 0.0) + math.log1p(math.exp(-abs(z)))


def bags(text: str) -> tuple[int, list[list[str]]]:
    """Number of sentences, and the distinct features of each."""
    low = lowered(text)
    return sentences(low), [sorted({f for chunk in s.split() for f in features(chunk)}) for s in SENTENCE.findall(low)]


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic") -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled rows that aren't held out.

    Null ids and labels are left out, an id with several labels counts as toxic
    if one says so, and a text that occurs often counts once for each label. Rows
    whose text has more than ``LONGEST`` bytes are no part of the sample, and it
    ends before its texts have more than ``SAMPLE_BYTES``.
    """
    marks = pick(labels, id_col, label_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast(
        "double").alias("toxic")).where("doc_id is not null and toxic is not null")
    texts = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"),
                                                F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    marks = marks.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0.5, 1).otherwise(0)).alias("toxic"))
    # The ids of docs alone first: the labels may name rows that are gone.
    lengths = texts.groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("bytes"), F.count("*").alias("times"))
    there = lengths.where(F.col("bytes") <= LONGEST).join(marks, "doc_id", "left_semi")
    first = there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # over ``rows`` rows at most
    first = first.withColumn("upto", F.sum(F.col("bytes") * F.col("times")).over(order)).where(F.col("upto") <= SAMPLE_BYTES)
    chosen = F.broadcast(stored(marks.join(first.select("doc_id"), "doc_id"), "toxic-sample"))  # at most ``rows`` ids
    return texts.join(chosen, "doc_id").select("text", "toxic").dropDuplicates()


def choose(counted: DataFrame, toxic: int, clean: int) -> list[str]:
    """All features that toxic documents hold clearly more often, the surest first."""
    share = (F.col("t") + F.col("c")) / float(toxic + clean)
    gap = F.col("t") / float(max(toxic, 1)) - F.col("c") / float(max(clean, 1))
    spread = F.sqrt(share * (1 - share) * (1.0 / max(toxic, 1) + 1.0 / max(clean, 1)) + F.lit(1e-12))
    z = gap / spread
    # A feature must occur in five documents, and three times as often in toxic ones.
    sure = counted.where((F.col("t") >= 5) & (z >= 5) & (F.col("t") * max(clean, 1) >= 3.0 * F.col("c") * max(toxic, 1)))
    return [r["feature"] for r in sure.orderBy(z.desc(), "feature").collect()]


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Fit on a bounded sample of labelled rows (:func:`sample`); without toxic or without clean rows, on nothing."""
    held = stored(sample(docs, labels, rows, id_col, text_col, label_col), "toxic-texts")
    sizes = {r["toxic"]: r["n"] for r in held.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model({}, -20.0 if clean or not toxic else 20.0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            marks = batch.column(1).to_pylist()
            for at, texts in text_runs(batch, "text"):
                for i, text in enumerate(texts, at):
                    seen[marks[i]].update({f for c in set(text.lower().split()) for f in features(c)})
                if len(seen[0]) + len(seen[1]) > 500_000:
                    yield flat(seen)
                    seen = (Counter(), Counter())
        yield flat(seen)

    def flat(seen: tuple[Counter, Counter]) -> pa.RecordBatch:
        names = list(seen[0].keys() | seen[1].keys())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][f] for f in names], pa.int64()),
                                           pa.array([seen[0][f] for f in names], pa.int64())], ["feature", "t", "c"])

    counted = held.mapInArrow(count, "feature string, t long, c long").groupBy("feature").agg(
        F.sum("t").alias("t"), F.sum("c").alias("c"))
    chosen = choose(counted, toxic, clean)
    places = held.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(chosen)})

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = places.value
        for batch in batches:
            out: tuple[list, ...] = ([], [], [])
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                number, own = bags(text.as_py())
                kept = [s for s in ([place[f] for f in b if f in place] for b in own) if s]
                for column, value in zip(out, (y, number - len(kept), kept)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.list_(pa.list_(pa.int32())))], ["toxic", "plain", "bags"])

    # The sentences of the sample, which is bounded in bytes.
    data = held.mapInArrow(reduce, "toxic int, plain long, bags array<array<int>>").collect()
    data = sorted(data, key=lambda r: (r["toxic"], r["plain"], r["bags"]))
    weights, bias = descend(data, len(chosen))
    return Model({f: float(w) for f, w in zip(chosen, weights)}, bias)


class Bags:
    """The sample as arrays: the negative log-likelihood of its labels under the noisy-or, and its gradient.

    With A = sum of softplus(z) over a document's sentences, the chance that it
    is clean is exp(-A); the gradient of A by z is the sentence's score.
    """

    def __init__(self, data: list, size: int):
        self.size = size
        self.y = np.array([r["toxic"] for r in data], dtype=float)
        self.plain = np.array([r["plain"] for r in data], dtype=float)
        sentences = [(d, s) for d, r in enumerate(data) for s in r["bags"]]
        self.doc = np.array([d for d, _ in sentences], dtype=np.int64)
        self.row = np.repeat(np.arange(len(sentences)), [len(s) for _, s in sentences])
        self.col = np.array([f for _, s in sentences for f in s], dtype=np.int64)

    def reached(self, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """z of each sentence with features, and A of each document; the bias is last in ``theta``."""
        w, b = theta[:-1], theta[-1]
        z = b + np.bincount(self.row, w[self.col], minlength=len(self.doc))
        return z, np.bincount(self.doc, np.logaddexp(0, z), minlength=len(self.y)) + self.plain * np.logaddexp(0, b)

    def loss(self, theta: np.ndarray) -> float:
        _, a = self.reached(theta)
        return float(np.mean((1 - self.y) * a - self.y * np.log(np.maximum(-np.expm1(-a), 1e-12))))

    def gradient(self, theta: np.ndarray) -> np.ndarray:
        z, a = self.reached(theta)
        outer = (1 - self.y) - self.y * np.exp(-a) / np.maximum(-np.expm1(-a), 1e-12)
        by_z = outer[self.doc] / (1 + np.exp(-z))
        return np.append(np.bincount(self.col, by_z[self.row], minlength=self.size),
                         by_z.sum() + (outer * self.plain).sum() / (1 + math.exp(-theta[-1]))) / len(self.y)


def descend(data: list, size: int, rounds: int = 400, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of the labels under the noisy-or (Adam)."""
    bags_ = Bags(data, size)
    theta = np.zeros(size + 1)  # the bias is last; weights start at 3, it at -8
    theta[:-1], theta[-1] = 3.0, -8.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        grad = bags_.gradient(theta)
        grad[:-1] += decay * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, n_offending, worst_start, worst_end): the worst sentence by its place in the text, null if
    none holds a feature; n_offending counts sentences that alone reach the threshold. A null text is empty, rows that repeat
    or have no id are scored like any other, extra columns are left out, and an empty table gives no rows."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a weight for each sure feature of the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            out: list[tuple] = []
            for _, texts in text_runs(batch, "text"):
                for text in texts:
                    score, found = own.score(text)
                    worst = max(found, default=(None, None, None), key=lambda s: (s[0], -s[1]))
                    out.append((score, sum(s[0] >= THRESHOLD for s in found), worst[1], worst[2]))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, (pa.float64(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "score", "n_offending", "worst_start", "worst_end"])

    source = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"),
                                                 F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, score double, n_offending long, worst_start long, worst_end long")


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` as it is, all its columns whatever they are called, without the rows that score
    ``threshold`` or more. A null text is empty, equal texts score alike, and an empty table stays empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = place_of(docs, text_col)
    plain = numbered(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            keep = [own.score(str(text.as_py() or ""))[0] < threshold for text in batch.column(place)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
