"""Exact length histogram of encoded documents, and what it answers for every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import slices, prepare_workers, stage

BLOCK = 1024


@lru_cache(maxsize=2)
def _encoding(ranks_path: str):
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoded_lengths(documents: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """(length) per row of ``documents``: tokens of the whole text; 0 for null and empty texts."""
    prepare_workers(documents.sparkSession)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks_path or default_ranks())
        for batch in slices(batches):
            counts = [len(encoding.encode_ordinary(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["length"])

    return documents.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(lengths, "length long")


def length_histogram(documents: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """(length, n_docs): documents of each encoded length; counted per task before the shuffle."""
    return encoded_lengths(documents, ranks_path).groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as context limit, exact totals over all documents.

    n_docs, n_tokens: of this length; docs_over, tokens_over: longer ones; truncated_tokens: what is left of all
    documents when each is cut at the limit; dropped_tokens: what is cut off; rank_last: number of documents up to this
    length, so that the q-quantile is the first length with rank_last >= q * all.

    Sums go from block to block of ``BLOCK`` lengths and then within each block, so no task sees more than a block or the
    list of blocks. Empty histogram: empty result.
    """
    n_tokens = F.col("length") * F.col("n_docs")
    rows = histogram.select("length", "n_docs", n_tokens.alias("n_tokens"), F.floor(F.col("length") / BLOCK).alias("_block"))
    sums = rows.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("n_tokens").alias("_t"))
    later = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = sums.select(
        "_block",
        F.coalesce(F.sum("_d").over(later), F.lit(0)).alias("_docs_later"),
        F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_tokens_later"),
        F.sum("_d").over(every).alias("all_docs"),
        F.sum("_t").over(every).alias("all_tokens"),
    )
    longer = Window.partitionBy("_block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    over = rows.join(blocks, "_block").withColumns({
        "docs_over": F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("_docs_later"),
        "tokens_over": F.coalesce(F.sum("n_tokens").over(longer), F.lit(0)) + F.col("_tokens_later"),
    })
    dropped = F.col("tokens_over") - F.col("docs_over") * F.col("length")
    return over.select(
        "length", "n_docs", "n_tokens", "docs_over", "tokens_over",
        (F.col("all_tokens") - dropped).alias("truncated_tokens"), dropped.alias("dropped_tokens"),
        (F.col("all_docs") - F.col("docs_over")).alias("rank_last"), "all_docs", "all_tokens",
    )


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the smallest length that at least ``share`` of the documents do not exceed."""
    reached = [
        F.min(F.when(F.col("rank_last") >= F.lit(float(q)) * F.col("all_docs"), F.col("length"))).alias(str(i))
        for i, q in enumerate(shares)
    ]
    row = sums.agg(*reached)
    pairs = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"`{i}`").alias("length")) for i, q in enumerate(shares)]))
    return row.select(pairs.alias("p")).select("p.*")


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context_limit, docs_over, truncated_tokens) for any limits, also lengths that do not occur."""
    out = []
    for limit in limits:
        over, longer = F.col("length") > limit, F.lit(int(limit))
        out.append(F.struct(
            longer.alias("context_limit"),
            F.coalesce(F.sum(F.when(over, F.col("n_docs"))), F.lit(0)).alias("docs_over"),
            F.coalesce(F.sum(F.col("n_docs") * F.least(F.col("length"), longer)), F.lit(0)).alias("truncated_tokens"),
        ))
    return sums.agg(F.array(*out).alias("a")).select(F.explode("a").alias("p")).select("p.*")


def token_counts(documents: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """The suffix sums of all documents' encoded lengths.

    Null and empty texts have length 0; rows that repeat are counted each; special tokens' names in a text are ordinary
    text. Empty table: empty result; other columns are ignored.
    """
    return suffix_sums(stage(length_histogram(documents, ranks_path), "lengths"))
