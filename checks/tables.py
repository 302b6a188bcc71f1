"""The driver's tables in the shapes the library works on."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliorank.functions.vectors import as_doubles
from foliorank.storage import spread


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def papers(spark: SparkSession, folder: str) -> DataFrame:
    """Documents: the first line is the title, the rest the abstract, if any."""
    documents = spread(load(spark, folder, "documents").select("doc_id", "text"))
    cut = F.instr("text", "\n")
    return documents.select(
        F.col("doc_id").alias("paper_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(cut > 0, F.substr("text", cut + 1)).alias("abstract"),
    )


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Libraries: the distinct parts a customer has ordered."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("paper_id")
    ).distinct()


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as paper metadata: one brand lacks pages, "hot" parts lack a type."""
    brand = F.col("p_brand")
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("paper_id"),
        F.when(~F.startswith("p_name", F.lit("hot ")), F.col("p_type")).alias("type"),
        F.when(brand != "Brand#10", F.col("p_size")).cast("double").alias("pages"),
        (F.regexp_extract(brand, "[0-9]+", 0).cast("double") + 1980).alias("year"),
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as paper vectors; each counts as one token."""
    return load(spark, folder, "embeddings").select(
        F.col("vec_id").alias("paper_id"),
        F.lit(1).cast("bigint").alias("n_tokens"),
        as_doubles("embedding").alias("vector"),
    )


def word_table(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as word vectors, with the id as the word."""
    return load(spark, folder, "embeddings").select(
        F.col("vec_id").alias("word"), as_doubles("embedding").alias("vector")
    )
