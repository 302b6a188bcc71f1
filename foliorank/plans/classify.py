"""Recommendation as binary classification of (user, paper) pairs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import (
    feature_pipeline,
    join_library_metadata,
    join_paper_features,
    join_user_features,
    user_profile_stats,
)
from ..operators.interactions import positives, sample_negatives, union_interactions
from ..operators.libraries import split_rows
from ..operators.models import linear_svm, random_forest, rmse
from ..storage import write_once

TRAIN_SHARE = 0.8


def interaction_table(pairs: DataFrame, papers: DataFrame, seed: int) -> DataFrame:
    """Rated pairs that have metadata and as many unrated ones, with metadata.

    Negatives are drawn for the pairs that are left after the metadata join, so the
    labels stay balanced. The two numbers of a user are joined before the wider columns of a paper.
    """
    known = write_once(
        pairs.join(papers.select("paper_id"), "paper_id", "left_semi").select("user_id", "paper_id"),
        "known",
    )
    mixed = union_interactions(positives(known), sample_negatives(known, papers, seed))
    stats = user_profile_stats(join_library_metadata(known, papers))
    rows = join_paper_features(join_user_features(mixed, stats), papers)
    return rows.select(*mixed.columns, *[c for c in papers.columns if c != "paper_id"], "user_pages", "user_papers")


def classification_dataset(pairs: DataFrame, papers: DataFrame, seed: int = 42) -> DataFrame:
    """(user_id, paper_id, label, features) of all rated and sampled unrated pairs."""
    rows = write_once(interaction_table(pairs, papers, seed), "interactions")
    features = feature_pipeline().fit(rows).transform(rows)
    return features.select("user_id", "paper_id", "label", "features")


def classify_and_score(dataset: DataFrame, seed: int = 42) -> DataFrame:
    """(model, rmse) of both classifiers on the held-out fifth of the rows."""
    rows = write_once(dataset, "features")
    train, test = split_rows(rows, ["user_id", "paper_id"], seed, TRAIN_SHARE)
    scored = [
        rmse(fit(train, test)).select(F.lit(name).alias("model"), "rmse")
        for name, fit in (("linear_svm", linear_svm), ("random_forest", random_forest))
    ]
    return scored[0].unionByName(scored[1])
