"""Term frequency, TF-IDF and topic vectors."""

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import write_once
from .terms import explode_terms

# The topic model's shape.
TOPICS = 40
TOPIC_ITERATIONS = 10
# Terms a count model holds on the driver and in every task.
MAX_MODEL_TERMS = 1 << 18


def term_frequency(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(paper_id, term_id, tf) over vocabulary terms; a sparse matrix in long form.

    The vocabulary is written first: its measured size decides whether it is broadcast.
    """
    known = write_once(vocabulary.select("term", "term_id"), "vocabulary")
    return (
        explode_terms(words)
        .join(known, "term")
        .groupBy("paper_id", "term_id")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def inverse_document_frequency(tf: DataFrame) -> DataFrame:
    """(term_id, df, idf) with idf = ln((m + 1) / (df + 1)), m = papers in ``tf``."""
    m = tf.select("paper_id").distinct().agg(F.count(F.lit(1))).scalar()
    frequencies = tf.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    return frequencies.withColumn("idf", F.log((m + 1) / (F.col("df") + 1)))


def tf_idf(tf: DataFrame, idf: DataFrame | None = None) -> DataFrame:
    """(paper_id, term_id, weight); zero weights are kept out, as in a sparse vector.

    ``idf`` should be a written table; without it, it is made from ``tf`` and written.
    """
    if idf is None:
        idf = write_once(inverse_document_frequency(tf), "idf")
    joined = tf.join(idf.select("term_id", "idf"), "term_id")
    weight = (F.col("tf") * F.col("idf")).alias("weight")
    return drop_zeros(joined.select("paper_id", "term_id", weight))


def drop_zeros(weights: DataFrame) -> DataFrame:
    """Dense to sparse in long form: only stored entries remain."""
    return weights.filter(F.col("weight") != 0)


def count_vectors(words: DataFrame, vocabulary: DataFrame, max_terms: int = MAX_MODEL_TERMS) -> DataFrame:
    """(paper_id, features) as MLlib vectors, papers without a known term left out.

    Counting happens inside the row against the model's term map: no shuffle. The
    map is the vocabulary, whose size is checked here; ``max_terms`` raises the limit.
    """
    rows = vocabulary.orderBy("term_id").limit(max_terms + 1).collect()
    if len(rows) > max_terms:
        raise ValueError(f"count vectors need a vocabulary of at most {max_terms} terms; raise max_terms")
    model = CountVectorizerModel.from_vocabulary(
        [row.term for row in rows], inputCol="words", outputCol="features"
    )
    counted = model.transform(words).select("paper_id", "features")
    return counted.filter(F.size(F.unwrap_udt("features")["indices"]) > 0)


def lda_topics(
    vectors: DataFrame, k: int = TOPICS, max_iter: int = TOPIC_ITERATIONS, seed: int = 1
) -> DataFrame:
    """(paper_id, vector): topic shares of each paper under a fitted LDA model."""
    model = LDA(k=k, maxIter=max_iter, seed=seed, featuresCol="features").fit(vectors)
    topics = model.transform(vectors)
    return topics.select("paper_id", vector_to_array("topicDistribution").alias("vector"))
