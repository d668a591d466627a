"""Language identification by a convolutional network over bytes.

A text is lower-cased and its UTF-8 bytes are cut into windows of ``WINDOW``
bytes that overlap by one less than the widest filter, so that every run of
bytes a filter can see lies whole in some window. A window's bytes are embedded,
filters of several widths slide over them, each filter keeps its maximum, and a
softmax over these gives the languages' chances. A text's chances are the mean
over its windows, weighted by their bytes of letters.

The network is trained in numpy, on the driver, on a bounded sample: at most
``SAMPLE_ROWS`` distinct labelled texts, and of each at most ``PIECES`` pieces
of a window from all over the text. Every text is predicted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import pick, stored, text_runs

#: Bounds of the training sample: distinct labelled texts, and pieces of each.
SAMPLE_ROWS = 8_000
PIECES = 4
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: Training takes so many steps at least.
LEAST_STEPS = 800
#: Windows that go through the network together.
BLOCK = 32
UNKNOWN = "und"


def held_out(id_col: Column) -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def windows(data: bytes) -> np.ndarray:
    """The windows of some bytes, a row each; the last is filled up with zeros."""
    step = WINDOW - max(WIDTHS) + 1
    count = max(1, -(-(len(data) - max(WIDTHS) + 1) // step))
    held = np.zeros((count - 1) * step + WINDOW, np.uint8)
    held[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(held, WINDOW)[::step]


def letters(rows: np.ndarray) -> np.ndarray:
    """Bytes in each window that are of letters: a to z, or part of a longer character."""
    return (((rows >= 97) & (rows <= 122)) | (rows >= 128)).sum(axis=1)


@dataclass
class Network:
    """``embedding`` (256, E); ``filters`` (widest * E, widths * F), zero beyond a filter's width;
    ``bias`` of the filters; ``out`` (widths * F + 1, languages), the last row a bias."""

    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        units = len(WIDTHS) * FILTERS
        embedding = rng.normal(0, 0.5, (256, EMBEDDING)).astype("f4")
        embedding[0] = 0  # what windows are filled up with
        filters = rng.normal(0, 0.4, (max(WIDTHS) * EMBEDDING, units)).astype("f4") * cls.reach()
        return cls(languages, embedding, filters, np.zeros(units, "f4"), rng.normal(0, 0.1, (units + 1, len(languages))).astype("f4"))

    @staticmethod
    def reach() -> np.ndarray:
        """1 where a filter's width reaches, else 0."""
        width = np.repeat(WIDTHS, FILTERS)
        return (np.repeat(np.arange(max(WIDTHS)), EMBEDDING)[:, None] < width[None, :]).astype("f4")

    def columns(self, rows: np.ndarray) -> np.ndarray:
        """(windows, places, widest * E): the embedded bytes from each place on."""
        size, widest = rows.shape[1], max(WIDTHS)
        seen = np.zeros((len(rows), size + widest - 1, EMBEDDING), "f4")
        seen[:, :size] = self.embedding[rows]
        return np.concatenate([seen[:, o:o + size] for o in range(widest)], axis=2)

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """The filters' maxima, cut at zero, and a 1 for the bias."""
        columns = self.columns(rows)
        top = (columns.reshape(-1, columns.shape[2]) @ self.filters).reshape(len(rows), rows.shape[1], -1).max(axis=1)
        return np.concatenate((np.maximum(top + self.bias, 0), np.ones((len(rows), 1), "f4")), axis=1)

    def chances(self, rows: np.ndarray) -> np.ndarray:
        """Softmax over the languages, a row for each window."""
        return np.concatenate([softmax(self.pooled(rows[at:at + BLOCK]) @ self.out) for at in range(0, len(rows), BLOCK)])

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, its chance) of each text; (``UNKNOWN``, 0) without a letter or without languages."""
        known = [bool(self.languages) and any(map(str.isalpha, t)) for t in texts]
        parts = [windows(t.lower().encode()) for t, k in zip(texts, known) if k]
        if not parts:
            return [(UNKNOWN, 0.0)] * len(texts)
        rows = np.concatenate(parts)
        weights = letters(rows).astype(float)
        firsts = np.cumsum([0] + [len(p) for p in parts[:-1]])
        total = np.add.reduceat(self.chances(rows) * weights[:, None], firsts) / np.add.reduceat(weights, firsts)[:, None]
        best = zip(total.argmax(axis=1).tolist(), np.clip(total.max(axis=1), 0.0, 1.0).tolist())
        return [(self.languages[(b := next(best))[0]], b[1]) if k else (UNKNOWN, 0.0) for k in known]

    def train(self, rows: np.ndarray, marks: np.ndarray, epochs: int = 5, size: int = 64, rate: float = 4e-3, seed: int = 7) -> Network:
        """Adam on the cross entropy; a maximum passes its gradient to its place alone. Small samples are seen more often."""
        epochs = max(epochs, -(-LEAST_STEPS * size // len(rows)))
        rng, reach = np.random.default_rng(seed), self.reach()
        weights = [self.embedding, self.filters, self.bias, self.out]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        share = np.bincount(marks, minlength=len(self.languages)).astype("f4")
        balance = len(marks) / np.maximum(share, 1) / len(self.languages)
        step, steps, units = 0, epochs * -(-len(rows) // size), np.arange(len(self.bias))
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(rows), size):
                own = order[at:at + size]
                batch, y, n = rows[own], marks[own], len(own)
                columns = self.columns(batch)
                z = (columns.reshape(-1, columns.shape[2]) @ self.filters).reshape(n, WINDOW, -1)
                place = z.argmax(axis=1)
                top = np.take_along_axis(z, place[:, None], axis=1)[:, 0] + self.bias
                hidden = np.concatenate((np.maximum(top, 0), np.ones((n, 1), "f4")), axis=1)
                grad = softmax(hidden @ self.out)
                grad[np.arange(n), y] -= 1
                grad *= (balance[y] / n)[:, None]
                back = (grad @ self.out[:-1].T) * (top > 0)
                seen = columns[np.arange(n)[:, None], place]  # (windows, units, widest * E)
                by_seen = (back[:, :, None] * self.filters.T[None]).reshape(n, len(units), max(WIDTHS), EMBEDDING)
                bytes_seen = np.pad(batch, ((0, 0), (0, max(WIDTHS) - 1)))[
                    np.arange(n)[:, None, None], place[:, :, None] + np.arange(max(WIDTHS))]
                by_byte = np.zeros_like(self.embedding)
                np.add.at(by_byte, bytes_seen.ravel(), by_seen.reshape(-1, EMBEDDING))
                by_byte[0] = 0
                grads = [by_byte, np.einsum("nu,nuc->cu", back, seen) * reach, back.sum(axis=0), hidden.T @ grad]
                step += 1
                now = rate * (1 - 0.9 * step / steps)
                for w, g, a, b in zip(weights, grads, first, second):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    w -= (now * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-7)).astype("f4")
        return self


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(text, lang) of at most ``rows`` distinct labelled texts that aren't held out.

    Every language has the same part of them, or all it has. Rows without an
    id, text or language are left out; a text that occurs often counts once for
    each language. The texts are chosen by the hash of the text.
    """
    named = pick(docs, id_col, text_col, lang_col).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    named = named.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    named = named.withColumn("key", F.xxhash64("text"))
    keys = stored(named.select("lang", "key").distinct(), "language-keys")
    counts = {r["lang"]: r["count"] for r in keys.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return named.select("text", "lang")
    each = rows / len(counts)
    share = F.element_at(F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, each / n))]), F.col("lang"))
    place = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = keys.where(place <= share).orderBy(F.xxhash64("key"), "key", "lang").limit(rows)
    chosen = F.broadcast(stored(chosen, "language-sample"))  # at most ``rows`` keys
    return named.join(chosen, ["lang", "key"], "left_semi").groupBy("lang", "key").agg(F.min("text").alias("text")).select("text", "lang")


def pieces(text: str, most: int = PIECES) -> list[bytes]:
    """Up to ``most`` pieces of at most a window, spread over the whole text by a hash; one of them is short."""
    data = text.lower().encode()
    rng = np.random.default_rng([len(data), sum(data[:: max(1, len(data) // 64)])])
    if len(data) <= WINDOW:
        return [data]
    whole = [data[at:at + WINDOW] for at in rng.integers(0, len(data) - WINDOW + 1, most - 1).tolist()]
    words = data.split()
    at = int(rng.integers(len(words)))
    return whole + [b" ".join(words[at:at + int(rng.integers(1, 8))])[:WINDOW]]


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network:
    """The network, trained on a bounded sample of the labelled rows; without labelled letters it knows no language."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(p, lang) for text, lang in zip(batch.column(0), batch.column(1).to_pylist())
                   if any(map(str.isalpha, t := text.as_py())) for p in pieces(t)]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.binary()), pa.array([g for _, g in out], pa.string())],
                                             ["piece", "lang"])

    # At most ``rows`` times PIECES pieces of WINDOW bytes.
    found = sorted((r["lang"], bytes(r["piece"])) for r in sample(docs, rows, id_col, text_col, lang_col).mapInArrow(
        cut, "piece binary, lang string").collect())
    languages = sorted({lang for lang, _ in found})
    network = Network.fresh(languages)
    if len(languages) < 2:
        return network
    inputs = np.concatenate([windows(p) for _, p in found])
    return network.train(inputs, np.searchsorted(languages, [lang for lang, _ in found]))


def predictions(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from its whole text.

    ``UNKNOWN`` with score 0 where the text is null or has no letter, or where
    nothing was learnt. Rows with null or repeated ids are predicted like any
    other, extra columns are left out, an empty table gives no rows. A text is
    held once in bytes; its windows go through the network in blocks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)  # some 10 KB, and a column for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for at, texts in text_runs(batch, "text", 1 << 18):
                found = own.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    source = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
