"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm import (
    block_search,
    byte_bpe,
    hilbert_sharding,
    html_extract,
    language_id,
    packing,
    periodic_runs,
    quality_rules,
    simhash_dedup,
    token_counts,
    toxicity,
    url_filter,
    whitening,
)
from gridmix.llm.common import configure, pick, stored, table, vocabulary
from gridmix.llm.oracle import ORACLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed best-fit decreasing into sequences of 4096."""
    pieces = packing.cut_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    summed = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.assign_windows(summed)


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("failed_rules")


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and truncated totals of all documents for every occurring length."""
    import public_tokenizers

    counts = token_counts.histogram(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"),
                                    public_tokenizers.PATTERN)
    return token_counts.suffix_sums(stored(counts, "lengths"))


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return url_filter.verdicts(table(spark, sf_dir, "pages"))


@query
def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = simhash_dedup.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_dedup.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op6_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 runs of the curve, as many rows in each."""
    placed = hilbert_sharding.shards(table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


@query
def op7_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector among all vectors."""
    return block_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, from labels of rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = toxicity.scores(docs, model)
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                        "n_offending", "worst_start", "worst_end")


@query
def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.main_text(table(spark, sf_dir, "pages"))


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and what they decode to, as digests."""
    import public_tokenizers

    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    both = byte_bpe.decode(encoded, ranks, public_tokenizers.PATTERN)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.predictions(docs, language_id.fit(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every embedding."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), 16)


#: The contract's test pattern: where h % 10 = 0 (h: crc32 of the id), each word i >= a of the n words
#: becomes word a + (i - a) % p, with g = h div 10, a = g % n and p = 1 + (n - a) div (3 + g % 8).
PLANTED = r"""
CASE WHEN h % 10 = 0 THEN
  transform(array(filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w != '')), own ->
    CASE WHEN size(own) = 0 THEN '' ELSE
      transform(array(struct((h div 10) % size(own) AS a, 1 + (size(own) - (h div 10) % size(own)) div (3 + (h div 10) % 8) AS p)), at ->
        array_join(transform(own, (w, i) -> own[CASE WHEN i >= at.a THEN at.a + (i - at.a) % at.p ELSE i END]), ' '))[0]
    END)[0]
ELSE text END
"""


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, and the text without their repeats."""
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    hashed = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    planted = hashed.select("doc_id", F.expr(PLANTED).alias("text"))
    return periodic_runs.digests(periodic_runs.periodic_runs(planted))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
