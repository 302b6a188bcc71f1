"""One query per operator of this subpackage over whole tables, and SQL where it can say the same."""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from foliorank.session import ship_package

from . import (
    conversations,
    decontaminate,
    jaccard,
    language,
    lm,
    mixing,
    quality,
    ranked_search,
    suffixes,
    token_counts,
    url_filters,
    vector_forest,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {
    "op1_mix_sources": mixing.MIX_SQL,
    "op2_warc_round_trip": warc.WARC_SQL,
    "op5_suffix_dedup": suffixes.SUFFIX_SQL,
    "op6_quality_rules": quality.quality_sql(),
    "op8_url_filters": url_filters.URL_SQL,
    "op10_jaccard_join": jaccard.JACCARD_SQL,
    "op11_vector_forest": vector_forest.FOREST_SQL,
    "op12_ranked_search": ranked_search.SEARCH_SQL,
    "op13_repair_conversations": conversations.REPAIR_SQL,
}


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet")


@query
def op1_mix_sources(spark, folder):
    return mixing.mix(documents(spark, folder))


@query
def op6_quality_rules(spark, folder):
    return quality.judge(documents(spark, folder))


@query
def op8_url_filters(spark, folder):
    return url_filters.judge_urls(pages(spark, folder))


@query
def op10_jaccard_join(spark, folder):
    found = jaccard.jaccard_components(documents(spark, folder), k=4, numerator=85, denominator=100)
    return found.drop("row")


@query
def op5_suffix_dedup(spark, folder):
    return suffixes.remove_repeats(documents(spark, folder))


@query
def op4_language_codes(spark, folder):
    return language.identify(documents(spark, folder))


@query
def op7_token_counts(spark, folder):
    return token_counts.count_tokens(documents(spark, folder))


@query
def op9_decontaminate(spark, folder):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate.find_copies(documents(spark, folder), items).drop("row")


@query
def op2_warc_round_trip(spark, folder):
    found = warc.round_trip(spark, pages(spark, folder))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_lm_scores(spark, folder):
    return lm.score_texts(documents(spark, folder))


@query
def op13_repair_conversations(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    return conversations.repair(conversations.damage(turns), copies="copies")


@query
def op12_ranked_search(spark, folder):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return ranked_search.search(documents(spark, folder), items)


@query
def op11_vector_forest(spark, folder):
    return vector_forest.near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
