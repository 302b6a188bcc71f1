"""Token counts from an exact length histogram.

Documents are encoded in one scan and reduced to (length, documents) before anything
is shuffled. The histogram is as long as there are different lengths. Running and
suffix sums over it answer, for every length as a context limit, how many documents
and tokens fit, what quantile the limit is, and how many tokens are left when every
document is cut to it. Sums run in blocks of lengths, so no task holds more than a block or
the list of blocks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliorank.storage import write_once

from .tokenizer import VOCABULARY, encoder

BLOCK = 1024


def token_lengths(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Column n_tokens: the encoded length of every whole text; 0 for null and empty."""

    def run(batches):
        encode = encoder(path).encode_ordinary
        for batch in batches:
            lengths = np.fromiter(
                (len(encode(t.as_py() or "")) for t in batch.column(0)), np.int64, batch.num_rows
            )
            values, counts = np.unique(lengths, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], ["n_tokens", "n_docs"])

    return documents.select(documents["text"]).mapInArrow(run, "n_tokens long, n_docs long")


def length_histogram(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(n_tokens, n_docs) for every length that occurs."""
    return token_lengths(documents, path).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def context_totals(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, as a context limit:

    n_docs of this length, docs_at_most and docs_longer, tokens_at_most (in the documents
    that fit), total_tokens, truncated_tokens (all documents cut to the limit), and
    quantile (the share of documents that fit). An empty histogram gives no rows.
    """
    tokens = F.col("n_tokens") * F.col("n_docs")
    blocked = histogram.withColumn("_block", F.floor(F.col("n_tokens") / BLOCK))
    sums = blocked.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum(tokens).alias("_t"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    offsets = sums.select(
        "_block",
        F.coalesce(F.sum("_d").over(earlier), F.lit(0)).alias("_docs_before"),
        F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_tokens_before"),
        F.sum("_d").over(everything).alias("_docs"),
        F.sum("_t").over(everything).alias("total_tokens"),
    )
    inside = Window.partitionBy("_block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        blocked.withColumn("_din", F.sum("n_docs").over(inside))
        .withColumn("_tin", F.sum(tokens).over(inside))
        .join(offsets, "_block")
    )
    at_most = F.col("_docs_before") + F.col("_din")
    longer = F.col("_docs") - at_most
    fit = F.col("_tokens_before") + F.col("_tin")
    return rows.select(
        "n_tokens",
        "n_docs",
        at_most.alias("docs_at_most"),
        longer.alias("docs_longer"),
        fit.alias("tokens_at_most"),
        "total_tokens",
        (fit + F.col("n_tokens") * longer).alias("truncated_tokens"),
        (at_most / F.col("_docs")).alias("quantile"),
    )


def count_tokens(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``context_totals`` of the documents' histogram.

    Null and empty texts have length 0; rows that repeat count each; texts of any length are
    encoded whole, one at a time; other columns are not looked at; an empty table gives no rows.
    """
    return context_totals(write_once(length_histogram(documents, path), "lengths"))


def length_quantile(totals: DataFrame, share: float) -> DataFrame:
    """The least length that at least ``share`` of all documents do not exceed."""
    return totals.where(F.col("quantile") >= share).agg(F.min("n_tokens").alias("n_tokens"))


def at_limit(totals: DataFrame, limits: DataFrame) -> DataFrame:
    """``context_totals`` for any limits: limit, docs_at_most, docs_longer, tokens_at_most, truncated_tokens, quantile.

    ``limits`` has a column ``limit`` of limits to ask for, a stated set that is broadcast.
    Between two lengths nothing changes but the cut itself: a limit has the sums of the next
    smaller length that occurs, and cuts every longer document to itself. Below the
    smallest length every document is cut; without documents there are no rows. Null limits
    are left out, repeated ones stand once.
    """
    asked = limits.select(F.col("limit").cast("bigint").alias("limit")).where("limit IS NOT NULL").distinct()
    sums = totals.select("n_tokens", "docs_at_most", "docs_longer", "tokens_at_most")
    # The largest length within each limit, found in one pre-aggregated pass over the lengths.
    met = sums.join(F.broadcast(asked), F.col("n_tokens") <= F.col("limit"))
    last = met.groupBy("limit").agg(F.max(F.struct("n_tokens", "docs_at_most", "docs_longer", "tokens_at_most")).alias("s"))
    whole = totals.agg(F.max(F.col("docs_at_most") + F.col("docs_longer")).alias("_docs")).where("_docs IS NOT NULL")
    found = F.broadcast(asked).join(last, "limit", "left").crossJoin(whole)
    longer = F.coalesce("s.docs_longer", "_docs")
    fit = F.coalesce("s.tokens_at_most", F.lit(0))
    at_most = F.coalesce("s.docs_at_most", F.lit(0))
    return found.select(
        "limit",
        at_most.alias("docs_at_most"),
        longer.alias("docs_longer"),
        fit.alias("tokens_at_most"),
        (fit + F.greatest("limit", F.lit(0)) * longer).alias("truncated_tokens"),
        (at_most / F.col("_docs")).alias("quantile"),
    )
