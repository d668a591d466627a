"""Token counts from an exact length histogram.

Documents are encoded, reduced to (length, documents), and suffix sums over the
histogram answer totals, quantiles and truncated totals for every context
limit: with a limit L, documents over L give L tokens each, the others theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.byte_bpe import encode

#: Lengths that one window sums; the sums of such blocks are added to it.
SPAN = 4096


def histogram(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(length, n_docs) over all rows; a null or empty text has length 0."""
    encoded = encode(docs, ranks, pattern, id_col, text_col)
    lengths = encoded.select((F.octet_length("ids") / 4).cast("long").alias("length"))
    return lengths.groupBy("length").agg(F.count("*").alias("n_docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """For each occurring length L: n_docs, docs_over (longer ones), docs_to (up to L), total_tokens
    (of documents up to L) and truncated_tokens (of all documents, cut to L)."""
    held = counts.withColumn("span", F.floor(F.col("length") / SPAN)).withColumn(
        "tokens", F.col("n_docs") * F.col("length"))
    spans = held.groupBy("span").agg(F.sum("n_docs").alias("n"), F.sum("tokens").alias("t"))
    order = Window.orderBy("span")  # a row for each 4,096 possible lengths
    spans = spans.select(
        "span", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("t").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("t_before"),
        F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n_all"))
    up_to = Window.partitionBy("span").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    return held.join(spans, "span").select(
        "length", "n_docs", (F.col("n_before") + F.sum("n_docs").over(up_to)).alias("docs_to"),
        (F.col("t_before") + F.sum("tokens").over(up_to)).alias("total_tokens"), "n_all").select(
        "length", "n_docs", "docs_to", (F.col("n_all") - F.col("docs_to")).alias("docs_over"), "total_tokens",
        (F.col("total_tokens") + (F.col("n_all") - F.col("docs_to")) * F.col("length")).alias("truncated_tokens"))


def truncated(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(limit, tokens) of all documents cut to each limit; ``sums`` from suffix_sums."""
    one = sums.agg(F.max("total_tokens").alias("all_tokens"), F.max("docs_to").alias("all_docs"), *[
        F.max(F.when(F.col("length") <= n, F.col("total_tokens"))).alias(f"t{i}") for i, n in enumerate(limits)], *[
        F.max(F.when(F.col("length") <= n, F.col("docs_to"))).alias(f"d{i}") for i, n in enumerate(limits)])
    rows = [F.struct(F.lit(n).cast("long").alias("limit"), (F.coalesce(f"t{i}", F.lit(0)) + (
        F.coalesce("all_docs", F.lit(0)) - F.coalesce(f"d{i}", F.lit(0))) * n).alias("tokens"))
        for i, n in enumerate(limits)]
    return one.select(F.inline(F.array(*rows)))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the least length that at least this share of documents doesn't exceed."""
    total = sums.agg(F.max("docs_to").alias("all_docs"))
    joined = sums.join(F.broadcast(total))  # one row
    one = joined.agg(*[F.min(F.when(F.col("docs_to") >= q * F.col("all_docs"), F.col("length"))).alias(f"q{i}")
                       for i, q in enumerate(shares)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(q).alias("share"), F.col(f"q{i}").alias("length"))
                                         for i, q in enumerate(shares)])))
