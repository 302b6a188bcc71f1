"""Feature columns of (user, paper) pairs."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import heavy_keys, join_heavy

# The columns in the order of the feature vector.
FEATURE_COLUMNS = ["pages", "year", "type_encoded", "user_pages", "user_papers"]
IMPUTED_COLUMNS = ["pages", "year", "type_index"]


def as_features(papers: DataFrame) -> DataFrame:
    """(paper_id, type, pages, year) with numbers as doubles, bad years as null."""
    return papers.select(
        "paper_id",
        "type",
        F.col("pages").cast("double").alias("pages"),
        F.col("year").try_cast("double").alias("year"),
    )


def join_paper_features(interactions: DataFrame, papers: DataFrame) -> DataFrame:
    """Interactions with pages, year and type; pairs without a paper vanish."""
    return interactions.join(papers, "paper_id")


def join_library_metadata(pairs: DataFrame, papers: DataFrame) -> DataFrame:
    """(user_id, pages, count 1) of the papers in the libraries."""
    own = pairs.select("user_id", "paper_id")
    known = join_heavy(own, papers, "paper_id", heavy_keys(own, "paper_id"))
    return known.select("user_id", "pages", F.lit(1).alias("count"))


def user_profile_stats(library_pages: DataFrame) -> DataFrame:
    """(user_id, user_pages, user_papers): mean pages, nulls left out, and papers."""
    return library_pages.groupBy("user_id").agg(
        F.avg("pages").alias("user_pages"), F.sum("count").alias("user_papers")
    )


def join_user_features(rows: DataFrame, stats: DataFrame) -> DataFrame:
    return rows.join(stats, "user_id")


def index_type(rows: DataFrame) -> DataFrame:
    """Add ``type_index``: 0 for the most frequent type; null types come last."""
    indexer = StringIndexer(inputCol="type", outputCol="type_index", handleInvalid="keep")
    return indexer.fit(rows).transform(rows)


def impute_mean(rows: DataFrame) -> DataFrame:
    """Missing pages, years and type indexes become the mean over the rows."""
    imputer = Imputer(inputCols=IMPUTED_COLUMNS, outputCols=IMPUTED_COLUMNS)
    return imputer.fit(rows).transform(rows)


def one_hot(rows: DataFrame) -> DataFrame:
    """Add ``type_encoded``: one place per type, all zeros for the last index."""
    encoder = OneHotEncoder(inputCols=["type_index"], outputCols=["type_encoded"])
    return encoder.fit(rows).transform(rows)


def assemble_features(rows: DataFrame) -> DataFrame:
    """(user_id, paper_id, label, features); missing numbers stay as NaN."""
    assembler = VectorAssembler(
        inputCols=FEATURE_COLUMNS, outputCol="features", handleInvalid="keep"
    )
    return assembler.transform(rows).select("user_id", "paper_id", "label", "features")


def feature_pipeline() -> Pipeline:
    """Index, impute, encode and assemble as one pipeline to fit and keep."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol="type", outputCol="type_index", handleInvalid="keep"),
            Imputer(inputCols=IMPUTED_COLUMNS, outputCols=IMPUTED_COLUMNS),
            OneHotEncoder(inputCols=["type_index"], outputCols=["type_encoded"]),
            VectorAssembler(
                inputCols=FEATURE_COLUMNS, outputCol="features", handleInvalid="keep"
            ),
        ]
    )
