"""Precision, recall, MRR and NDCG at k, for all k in one aggregation."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import first_positions

# The list lengths the metrics are reported at.
CUTOFFS = (5, 10, 30)

STANDARD = "standard"
AS_WRITTEN = "as_written"


def hits_per_user(
    recommendations: DataFrame, test: DataFrame, cutoffs: Sequence[int] = CUTOFFS
) -> DataFrame:
    """Per user: test size and, per cut-off, hits, first hit and gain.

    Lists are cut to the largest cut-off before the join with the test part, so
    what is joined and grouped does not grow with the libraries.
    """
    placed = first_positions(recommendations, max(cutoffs)).select("user_id", "paper_id", "position")
    hit = test.select("user_id", "paper_id", F.lit(True).alias("_hit"))
    marked = placed.join(hit, ["user_id", "paper_id"], "left")
    sizes = test.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_test"))
    found = []
    for k in cutoffs:
        counts = F.col("_hit") & (F.col("position") <= k)
        found += [
            F.count(F.when(counts, 1)).alias(f"_hits{k}"),
            F.min(F.when(counts, F.col("position"))).alias(f"_first{k}"),
            F.coalesce(
                F.sum(F.when(counts, 1 / F.log2(F.col("position") + 1))), F.lit(0.0)
            ).alias(f"_gain{k}"),
        ]
    return marked.groupBy("user_id").agg(*found).join(sizes, "user_id")


def _ideal_gain(length: Column) -> Column:
    places = F.sequence(F.lit(1).cast("bigint"), length)
    return F.aggregate(places, F.lit(0.0), lambda total, i: total + 1 / F.log2(i + 1))


def _metrics_at(k: int, mode: str) -> Column:
    hits, first, gain = F.col(f"_hits{k}"), F.col(f"_first{k}"), F.col(f"_gain{k}")
    n_test = F.col("n_test")
    if mode == STANDARD:
        no_hit = F.lit(0.0)
        ndcg = gain / _ideal_gain(F.least(n_test, F.lit(k).cast("bigint")))
    elif mode == AS_WRITTEN:
        # Every hit gains the same, whatever its place, and the ideal starts at one.
        no_hit = F.lit(1.0 / k)
        dcg = hits / F.log2(F.lit(k + 1.0))
        ideal = F.when(hits > 0, hits / F.log2(hits + 1.0)).otherwise(0.0)
        ndcg = dcg / (1 + ideal)
    else:
        raise ValueError(f"unknown metric mode {mode!r}")
    return F.struct(
        F.lit(k).cast("bigint").alias("k"),
        (hits / F.lit(float(k))).alias("precision"),
        (hits / n_test).alias("recall"),
        F.coalesce(1 / first, no_hit).alias("mrr"),
        ndcg.alias("ndcg"),
    )


def metrics_per_user(
    recommendations: DataFrame,
    test: DataFrame,
    cutoffs: Sequence[int] = CUTOFFS,
    mode: str = STANDARD,
) -> DataFrame:
    """(user_id, k, precision, recall, mrr, ndcg); missing places are misses."""
    counted = hits_per_user(recommendations, test, cutoffs)
    per_k = F.array(*[_metrics_at(k, mode) for k in cutoffs])
    return counted.select("user_id", F.inline(per_k))


def _metric(name: str):
    def at_k(recommendations: DataFrame, test: DataFrame, k: int, mode: str = STANDARD) -> DataFrame:
        found = metrics_per_user(recommendations, test, [k], mode)
        return found.select("user_id", "k", F.col(name).alias(f"{name}_at_k"))

    at_k.__name__ = f"{name}_at_k"
    at_k.__doc__ = f"(user_id, k, {name}_at_k) of every user with recommendations."
    return at_k


precision_at_k = _metric("precision")
recall_at_k = _metric("recall")
mrr_at_k = _metric("mrr")
ndcg_at_k = _metric("ndcg")


def average_metrics(per_user: DataFrame) -> DataFrame:
    """Mean of every metric over users, per cut-off."""
    names = ["precision", "recall", "mrr", "ndcg"]
    return per_user.groupBy("k").agg(*[F.avg(n).alias(n) for n in names])


def evaluate_metrics(
    recommendations: DataFrame,
    test: DataFrame,
    cutoffs: Sequence[int] = CUTOFFS,
    mode: str = STANDARD,
) -> DataFrame:
    """(k, precision, recall, mrr, ndcg) averaged over users."""
    return average_metrics(metrics_per_user(recommendations, test, cutoffs, mode))
