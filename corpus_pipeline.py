"""The corpus pipeline: documents through five stages, each an operator of ``foliorank.llm``.

A stage gets all that the one before it kept and returns documents with the same
columns; the last one returns the mix. Between stages the documents are written and
read again, so a lost executor repeats part of one stage at most.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliorank.llm import decontaminate, jaccard, mixing, quality, suffixes
from foliorank.llm.common import WORD, row_key
from foliorank.session import ship_package
from foliorank.storage import write_once


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.judge(docs, keep=docs.columns).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8 or more, the document of smallest id.

    A document without an id stays if its group has no id at all; of equal rows one stays.
    """
    ship_package(spark)
    found = write_once(jaccard.jaccard_components(docs, k=5, numerator=80, denominator=100), "groups")
    gone = write_once(found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("row").distinct(), "gone")
    kept = docs.withColumn("_row", row_key("doc_id", "text"))
    kept = kept.join(gone, F.col("_row") == F.col("row"), "left_anti")
    repeated = write_once(
        found.groupBy("row").count().where("count > 1").select("row").join(gone, "row", "left_anti"), "repeated"
    )
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    once = kept.join(repeated, F.col("_row") == F.col("row"), "left_semi").dropDuplicates(["_row"])
    rest = kept.join(repeated, F.col("_row") == F.col("row"), "left_anti")
    return rest.unionByName(once).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that repeat an earlier one; those left without a word go."""
    ship_package(spark)
    found = suffixes.remove_repeats(docs, kept_text=True, keep=docs.columns)
    left = found.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(WORD))
    changed = F.col("n_removed") > 0
    new = {
        "text": F.when(changed, F.col("kept_text")).otherwise(F.col("kept.text")),
        "n_chars": F.when(changed, F.char_length("kept_text").cast("bigint")).otherwise(F.col("kept.n_chars")),
    }
    return left.select(*[new.get(c, F.col(f"kept.{c}")).alias(c) for c in docs.columns])


def benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    ship_package(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = write_once(decontaminate.find_copies(docs, items).select("row").distinct(), "copies")
    marked = docs.withColumn("_row", row_key("doc_id", "text"))
    return marked.join(hits, F.col("_row") == F.col("row"), "left_anti").select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents of which it takes words, with ``taken`` words, repeats counted."""
    return mixing.mix(docs, keep=docs.columns).where("taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_copies),
    ("mixing sources to target weights", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = write_once(docs, f"stage{number}")
    return docs


# Near duplicates, suffix order and alignment have no SQL; tests compare all stages with brute force.
ORACLE_SQL = None
