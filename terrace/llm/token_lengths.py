"""The exact histogram of encoded lengths, and what it answers for every context limit.

Documents are encoded once and counted by length. The histogram has at most as many rows as there are different
lengths, which the longest document bounds, so its suffix sums take one small window whatever the corpus.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm._spark import sliced


@lru_cache(2)
def _encoding(rank_file: str, pattern: str):
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("terrace", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(docs: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """n_tokens (long) of each row; a null or empty text has 0.

    Repeated rows count each, rows without doc_id like others, very long texts whole; an empty table gives no rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(rank_file, pattern).encode_ordinary
        for batch in sliced(batches, "text"):
            yield pa.RecordBatch.from_pydict({"n_tokens": pa.array([len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()], pa.int64())})

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "n_tokens long")


def length_histogram(lengths: DataFrame, n_tokens: str = "n_tokens") -> DataFrame:
    """One row for each length L that occurs, with counts and the answers for the context limit L.

    n_docs: documents of length L. docs_within, tokens_within: documents of at most L and their ids. docs_over,
    tokens_over: those longer than L. truncated_total: ids that remain if every document is cut to L.
    quantile: share of documents of at most L. An empty table gives no rows; null lengths don't count.
    """
    counted = lengths.where(F.col(n_tokens).isNotNull()).groupBy(F.col(n_tokens).cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ids = F.col("length") * F.col("n_docs")
    summed = counted.select(
        "length", "n_docs", F.sum("n_docs").over(longer).alias("docs_from"), F.sum(ids).over(longer).alias("tokens_from"), F.sum("n_docs").over(whole).alias("all_docs"), F.sum(ids).over(whole).alias("all_tokens")
    )
    over, over_ids = F.col("docs_from") - F.col("n_docs"), F.col("tokens_from") - ids
    return summed.select(
        "length",
        "n_docs",
        (F.col("all_docs") - over).alias("docs_within"),
        (F.col("all_tokens") - over_ids).alias("tokens_within"),
        over.alias("docs_over"),
        over_ids.alias("tokens_over"),
        (F.col("all_tokens") - over_ids + over * F.col("length")).alias("truncated_total"),
        ((F.col("all_docs") - over) / F.col("all_docs")).alias("quantile"),
    )


def limits(histogram: DataFrame, wanted: list[int]) -> DataFrame:
    """For each wanted context limit, also between lengths that occur: docs_within, docs_over and truncated_total."""
    asked = [int(x) for x in dict.fromkeys(wanted)]
    count = lambda kept, what: F.coalesce(F.sum(F.when(kept, what)), F.lit(0))
    length, n = F.col("length"), F.col("n_docs")
    rows = [
        F.struct(F.lit(x).cast("long").alias("context_limit"), count(length <= x, n).alias("docs_within"), count(length > x, n).alias("docs_over"), (count(length <= x, length * n) + count(length > x, n) * x).alias("truncated_total"))
        for x in asked
    ]
    return histogram.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def quantiles(histogram: DataFrame, wanted: list[float]) -> DataFrame:
    """For each wanted share q: the least length that at least q of the documents don't exceed; null without documents."""
    rows = [F.struct(F.lit(float(q)).alias("q"), F.min(F.when(F.col("quantile") >= float(q), F.col("length"))).alias("length")) for q in dict.fromkeys(wanted)]
    return histogram.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
