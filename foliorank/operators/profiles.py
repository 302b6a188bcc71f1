"""User profiles from the papers of the train part."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import heavy_keys, join_heavy


def sum_sparse(train: DataFrame, weights: DataFrame) -> DataFrame:
    """(user_id, term_id, weight): summed term weights of a user's papers.

    The join is inner: papers without a vector do not count.
    """
    pairs = train.select("user_id", "paper_id")
    joined = join_heavy(pairs, weights, "paper_id", heavy_keys(pairs, "paper_id"))
    return joined.groupBy("user_id", "term_id").agg(F.sum("weight").alias("weight"))


def join_vectors(train: DataFrame, vectors: DataFrame) -> DataFrame:
    """(user_id, paper_id, vector, ...) of the papers that have a vector; a popular paper is split over tasks."""
    pairs = train.select("user_id", "paper_id")
    return join_heavy(pairs, vectors, "paper_id", heavy_keys(pairs, "paper_id"))


def sum_dense(train: DataFrame, vectors: DataFrame) -> DataFrame:
    """(user_id, vector): element-wise sum, combined before the shuffle."""
    joined = join_vectors(train, vectors)
    total = Summarizer.sum(array_to_vector("vector"))
    return joined.groupBy("user_id").agg(vector_to_array(total).alias("vector"))


def mean_by_tokens(train: DataFrame, vectors: DataFrame) -> DataFrame:
    """(user_id, vector): mean over all tokens of the user's papers.

    Paper vectors are means over ``n_tokens`` tokens, so their mean weighted by
    that count is the mean over the merged token lists, without merging them.
    """
    joined = join_vectors(train, vectors).filter(F.col("n_tokens") > 0)
    mean = Summarizer.mean(array_to_vector("vector"), F.col("n_tokens").cast("double"))
    return joined.groupBy("user_id").agg(vector_to_array(mean).alias("vector"))
