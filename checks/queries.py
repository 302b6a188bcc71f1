"""One query per operator, each over whole tables: ``fn(spark, folder)``."""

from collections.abc import Callable
from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliorank.functions import text
from foliorank.functions import vectors as vec
from foliorank.functions.stem_rules import stem_rows
from foliorank.functions.stopwords import ENGLISH_STOPWORDS
from foliorank.operators import (
    blocks,
    embeddings,
    features,
    frequent,
    interactions,
    libraries,
    metrics,
    models,
    profiles,
    ranking,
    scoring,
    skipgram,
    terms,
    weights,
)
from foliorank.plans import classify, preprocess, recommend
from foliorank.schemas import PAPERS_SCHEMA
from foliorank.session import ship_package
from foliorank.sources import (
    read_table,
    scan_libraries,
    scan_papers,
    scan_papers_features,
    scan_stopwords,
    write_table,
    write_text,
)
from foliorank.storage import new_table_path, write_once

from . import tables

SEED = 7
TERM_LISTS = recommend.ListOptions(n_users=20, k=40, seed=SEED)
EXACT_TERM_LISTS = recommend.ListOptions(n_users=20, k=40, seed=SEED, method="row_number")
VECTOR_LISTS = recommend.ListOptions(n_users=50, k=35, seed=SEED)
EXACT_VECTOR_LISTS = recommend.ListOptions(n_users=50, k=35, seed=SEED, method="row_number")
ONE_USER_LIST = recommend.ListOptions(n_users=1, k=10, seed=SEED)
NO_STEM = recommend.TermOptions(stem=False)
NAMED_USER = 1
SYNONYM_WORD = 7
ANALOGY_WORDS = ([3, 11], [5], [8, 21])

REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, folder)

    REGISTERED[fn.__name__] = run
    return run


def r6(column: str | Column) -> Column:
    return F.round(column, 6)


def joined(words: str = "words") -> Column:
    return F.array_join(words, " ").alias(words)


# ------------------------------------------------------- shared first steps --


def written_pairs(spark, folder):
    """The library table, for queries that read it more than once."""
    return write_once(tables.pairs(spark, folder), "pairs")


def plain_words(spark, folder):
    return preprocess.preprocess_terms(tables.papers(spark, folder), stem=False)


def plain_vocabulary(spark, folder, words):
    return preprocess.build_vocabulary(tables.papers(spark, folder), words)


def plain_tf(spark, folder):
    words = write_once(plain_words(spark, folder), "words")
    return write_once(weights.term_frequency(words, plain_vocabulary(spark, folder, words)), "tf")


def plain_weights(spark, folder):
    return weights.tf_idf(plain_tf(spark, folder))


def term_split(spark, folder):
    return recommend.sampled_split(written_pairs(spark, folder), 20, SEED)


def vector_split(spark, folder):
    return recommend.sampled_split(written_pairs(spark, folder), 50, SEED)


def vector_profiles(spark, folder, split):
    return profiles.mean_by_tokens(libraries.train_part(split), tables.vectors(spark, folder))


def exact_vector_lists(spark, folder):
    """Lists of exactly k rows and the held-out papers, from the embeddings."""
    split = vector_split(spark, folder)
    lists = recommend.rank_by_vectors(
        vector_profiles(spark, folder, split), tables.vectors(spark, folder), split, EXACT_VECTOR_LISTS
    )
    return write_once(lists, "lists"), libraries.held_out_part(split)


# -------------------------------------------------------- sources and sinks --


@query
def scan_papers_csv(spark, folder):
    """Papers written as headerless CSV and scanned with the fixed schema."""
    path = new_table_path(spark, "papers-csv")
    one_line = F.translate(F.concat_ws(" ", "title", "abstract"), "\r\n", "  ")
    rows = tables.papers(spark, folder).select("paper_id", one_line.alias("title"))
    known = {"paper_id": F.col("paper_id"), "title": F.col("title")}
    columns = [known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in PAPERS_SCHEMA]
    rows.select(*columns).write.options(
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    scanned = scan_papers(spark, path)
    return scanned.select(
        F.col("paper_id").cast("bigint").alias("paper_id"), "type", "title", "abstract"
    )


def library_lines(spark, folder):
    """A library line per order, written as text."""
    path = new_table_path(spark, "libraries")
    orders = tables.load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = tables.load(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    parts = F.transform(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda p: p["l_partkey"]
    )
    grouped = lines.groupBy("l_orderkey").agg(F.concat_ws(",", parts.cast("array<string>")).alias("ids"))
    text_lines = grouped.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws(";", F.col("o_custkey").cast("string"), "ids").alias("value")
    )
    text_lines.write.text(path)
    return scan_libraries(spark, path)


@query
def scan_libraries_text(spark, folder):
    nested = library_lines(spark, folder)
    return nested.select("user_id", F.array_join("paper_ids", ",").alias("paper_ids"))


@query
def explode_library(spark, folder):
    return libraries.explode_library(library_lines(spark, folder))


@query
def nested_library_size(spark, folder):
    sized = libraries.nested_library_size(library_lines(spark, folder))
    return sized.select("user_id", F.array_join("paper_ids", ",").alias("paper_ids"), "library_size")


@query
def scan_stopwords_text(spark, folder):
    """A stop list of the words in more than a third of the papers, from a file."""
    path = new_table_path(spark, "stopwords")
    words = preprocess.preprocess_conservative(tables.papers(spark, folder))
    frequent = terms.document_frequency_band(
        terms.document_frequency(words),
        terms.count_distinct_papers(tables.papers(spark, folder)),
        min_papers=1,
        max_share=1.0,
    )
    n = terms.count_distinct_papers(tables.papers(spark, folder)).scalar()
    frequent.filter(F.col("df") > n / 3).select("term").write.text(path)
    listed = scan_stopwords(spark, path)
    kept = words.select("paper_id", text.remove_stopwords("words", listed).alias("words"))
    return kept.select("paper_id", joined())


@query
def save_and_reload_tables(spark, folder):
    path = new_table_path(spark, "tf-idf")
    write_table(plain_weights(spark, folder), path)
    return read_table(spark, path).select("paper_id", "term_id", r6("weight").alias("weight"))


@query
def save_text(spark, folder):
    path = new_table_path(spark, "metadata-text")
    write_text(tables.metadata(spark, folder), path)
    fields = F.from_json("value", "paper_id bigint, type string, pages double, year double")
    return spark.read.text(path).select(fields.alias("row")).select("row.*")


# ---------------------------------------------------- projections and filters --


@query
def project_papers(spark, folder):
    return tables.papers(spark, folder).select("paper_id", "title", "abstract")


@query
def rename_and_drop(spark, folder):
    rows = tables.metadata(spark, folder).withColumn("decade", F.floor(F.col("year") / 10) * 10)
    return rows.withColumnRenamed("paper_id", "paper_idx").drop("year", "type")


@query
def concat_text(spark, folder):
    return tables.papers(spark, folder).select("paper_id", text.concat_text().alias("title_abstract"))


@query
def cast_paper_id(spark, folder):
    part = tables.load(spark, folder, "part")
    mixed = F.when(F.col("p_size") > 40, F.col("p_name")).otherwise(F.col("p_partkey").cast("string"))
    rows = part.select(F.col("p_retailprice").alias("price"), mixed.alias("paper_id"))
    return interactions.cast_paper_id(rows)


@query
def constant_column(spark, folder):
    return features.join_library_metadata(
        tables.pairs(spark, folder), tables.metadata(spark, folder)
    ).groupBy("user_id").agg(F.sum("count").alias("papers"))


@query
def filter_user(spark, folder):
    return libraries.filter_user(tables.pairs(spark, folder), NAMED_USER)


@query
def filter_library_size(spark, folder):
    return libraries.users_above(tables.pairs(spark, folder), 20)


@query
def exclude_seen(spark, folder):
    all_pairs = written_pairs(spark, folder)
    split = libraries.split_train_test(all_pairs, SEED)
    return libraries.exclude_seen(all_pairs, libraries.train_part(split))


@query
def keep_vocabulary_terms(spark, folder):
    words = write_once(plain_words(spark, folder), "words")
    kept = terms.keep_vocabulary_terms(
        terms.explode_terms(words, distinct=True), plain_vocabulary(spark, folder, words)
    )
    return kept.select("paper_id", "term")


@query
def document_frequency_band(spark, folder):
    return terms.document_frequency_band(
        terms.document_frequency(plain_words(spark, folder)),
        terms.count_distinct_papers(tables.papers(spark, folder)),
    )


# ---------------------------------------------------------------------- text --


@query
def tokenize(spark, folder):
    words = text.tokenize(text.concat_text()).alias("words")
    return tables.papers(spark, folder).select("paper_id", words).select("paper_id", joined())


@query
def remove_stopwords(spark, folder):
    words = text.remove_stopwords(text.tokenize(text.concat_text()), ENGLISH_STOPWORDS)
    return tables.papers(spark, folder).select("paper_id", words.alias("words")).select(
        "paper_id", joined()
    )


@query
def strip_marks(spark, folder):
    """Token characters of raw pages, where hyphens and underscores are common."""
    pages = tables.load(spark, folder, "pages")
    words = text.strip_marks(text.tokenize(F.concat_ws(" ", "url", "html")))
    return pages.select("page_id", words.alias("words")).select("page_id", joined())


@query
def stem_distinct(spark, folder):
    words = text.stem_words(
        text.strip_marks(text.remove_stopwords(text.tokenize(text.concat_text()), ENGLISH_STOPWORDS))
    )
    stems = tables.papers(spark, folder).select("paper_id", F.array_distinct(words).alias("words"))
    return stems.select("paper_id", joined())


@query
def stem_bag(spark, folder):
    return preprocess.preprocess_terms(tables.papers(spark, folder)).select("paper_id", joined())


@query
def stem_word_rows(spark, folder):
    """Stems by the rule cascade of built-in functions, over rows of words."""
    rows = terms.explode_terms(plain_words(spark, folder)).groupBy("paper_id", "term").agg(F.count("*").alias("places"))
    return stem_rows(rows, "term")


@query
def merge_token_lists(spark, folder):
    words = preprocess.preprocess_conservative(tables.papers(spark, folder))
    merged = terms.merge_token_lists(written_pairs(spark, folder), words)
    return merged.select("user_id", "part", joined())


@query
def collect_user_words(spark, folder):
    """Tokens per user of the merged lists."""
    words = preprocess.preprocess_conservative(tables.papers(spark, folder))
    merged = terms.merge_token_lists(written_pairs(spark, folder), words)
    return merged.groupBy("user_id").agg(F.sum(F.size("words")).cast("bigint").alias("tokens"))


# ----------------------------------------------------- explode, nest and ids --


@query
def explode_terms(spark, folder):
    return terms.explode_terms(plain_words(spark, folder), distinct=True)


@query
def nest_terms(spark, folder):
    return terms.nest_terms(plain_words(spark, folder)).select("paper_id", joined("terms"))


@query
def nest_term_rows(spark, folder):
    rows = terms.explode_terms(plain_words(spark, folder))
    return terms.nest_term_rows(rows).select("paper_id", joined("terms"))


@query
def assign_user_ids(spark, folder):
    return libraries.assign_user_ids(tables.pairs(spark, folder))


@query
def library_size(spark, folder):
    return libraries.library_size(tables.pairs(spark, folder))


# --------------------------------------------------------------------- joins --


@query
def join_library_vectors(spark, folder):
    train = libraries.train_part(term_split(spark, folder))
    rows = train.join(plain_weights(spark, folder), "paper_id")
    return rows.select("user_id", "paper_id", "term_id", r6("weight").alias("weight"))


@query
def join_library_topics(spark, folder):
    topics = recommend.topic_vectors(tables.papers(spark, folder), NO_STEM, seed=SEED)
    rows = profiles.join_vectors(libraries.train_part(term_split(spark, folder)), topics)
    return topic_places(rows, "user_id", "paper_id")


@query
def join_profile_split(spark, folder):
    """Profile size next to the sizes of the train and test parts."""
    split = term_split(spark, folder)
    profile = profiles.sum_sparse(libraries.train_part(split), plain_weights(spark, folder))
    sizes = split.groupBy("user_id").agg(
        F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test")
    )
    total = profile.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_terms"), r6(F.sum("weight")).alias("weight")
    )
    return total.join(sizes, "user_id")


@query
def join_profile_sample(spark, folder):
    """Vector profiles next to the sampled users' held-out papers."""
    split = vector_split(spark, folder)
    profile = vector_profiles(spark, folder, split)
    length = r6(vec.norm("vector")).alias("length")
    return libraries.held_out_part(split).join(profile, "user_id").select("user_id", "paper_id", length)


@query
def join_user_words(spark, folder):
    words = preprocess.preprocess_conservative(tables.papers(spark, folder))
    rows = tables.pairs(spark, folder).join(words, "paper_id")
    return rows.select("user_id", "paper_id", F.size("words").cast("bigint").alias("tokens"))


@query
def join_paper_features(spark, folder):
    rated = interactions.positives(tables.pairs(spark, folder))
    return features.join_paper_features(rated, tables.metadata(spark, folder))


@query
def join_library_metadata(spark, folder):
    return features.join_library_metadata(
        tables.pairs(spark, folder), tables.metadata(spark, folder)
    )


@query
def join_user_features(spark, folder):
    rated, parts = tables.pairs(spark, folder), tables.metadata(spark, folder)
    stats = features.user_profile_stats(features.join_library_metadata(rated, parts))
    rows = features.join_user_features(interactions.positives(rated), stats)
    return rows.withColumn("user_pages", r6("user_pages"))


@query
def restrict_profiles(spark, folder):
    """Vector profiles of all users, restricted to those with more than 20 papers."""
    rated = written_pairs(spark, folder)
    profile = profiles.sum_dense(rated, tables.vectors(spark, folder))
    active = libraries.restrict_to_users(profile, libraries.users_above(rated, 20))
    return active.select("user_id", r6(vec.norm("vector")).alias("length"))


@query
def score_pairs_by_terms(spark, folder):
    split = term_split(spark, folder)
    train, weighted = libraries.train_part(split), write_once(plain_weights(spark, folder), "w")
    profile = write_once(profiles.sum_sparse(train, weighted), "profiles")
    return scoring.score_sparse(profile, weighted, train)


@query
def score_all_pairs_by_terms(spark, folder):
    """The same with the papers that share no term."""
    split = term_split(spark, folder)
    train, weighted = libraries.train_part(split), write_once(plain_weights(spark, folder), "w")
    profile = write_once(profiles.sum_sparse(train, weighted), "profiles")
    return scoring.score_sparse(profile, weighted, train, include_zero=True)


@query
def score_pairs_by_vectors(spark, folder):
    split = vector_split(spark, folder)
    return scoring.score_dense(
        vector_profiles(spark, folder, split),
        tables.vectors(spark, folder),
        libraries.train_part(split),
    )


# -------------------------------------------------------------- aggregations --


@query
def count_distinct_papers(spark, folder):
    return terms.count_distinct_papers(tables.papers(spark, folder))


@query
def document_frequency(spark, folder):
    return terms.document_frequency(plain_words(spark, folder))


@query
def profile_sum_sparse(spark, folder):
    train = libraries.train_part(term_split(spark, folder))
    summed = profiles.sum_sparse(train, plain_weights(spark, folder))
    return summed.withColumn("weight", r6("weight"))


@query
def profile_sum_dense(spark, folder):
    summed = profiles.sum_dense(tables.pairs(spark, folder), tables.vectors(spark, folder))
    return summed.select("user_id", F.posexplode("vector").alias("place", "value")).select(
        "user_id", F.col("place").cast("bigint").alias("place"), r6("value").alias("value")
    )


@query
def user_profile_stats(spark, folder):
    library_pages = features.join_library_metadata(
        tables.pairs(spark, folder), tables.metadata(spark, folder)
    )
    stats = features.user_profile_stats(library_pages)
    return stats.withColumn("user_pages", r6("user_pages"))


@query
def collect_recommendations(spark, folder):
    lists, _ = exact_vector_lists(spark, folder)
    collected = ranking.collect_recommendations(lists, 35)
    ids = F.col("recommendations").cast("array<string>")
    return collected.select("user_id", F.array_join(ids, ",").alias("recommendations"))


@query
def collect_ranked(spark, folder):
    """Dense lists of all sampled users in parts of 20, with every tied paper."""
    split = vector_split(spark, folder)
    coarse = tables.vectors(spark, folder).withColumn("vector", F.transform("vector", lambda x: F.round(x, 1)))
    scored = scoring.score_dense(
        vector_profiles(spark, folder, split), coarse, libraries.train_part(split), k=35, digits=1
    )
    collected = ranking.collect_ranked(ranking.top_k(scored, 35), part_papers=20)
    ids = F.col("recommendations").cast("array<string>")
    return collected.select("user_id", "part", F.array_join(ids, ",").alias("recommendations"))


@query
def merged_lists_in_parts(spark, folder):
    """Merged token lists cut each time they pass 1,000 tokens."""
    words = preprocess.preprocess_conservative(tables.papers(spark, folder))
    merged = terms.merge_token_lists(written_pairs(spark, folder), words, part_tokens=1000, cells=8)
    return merged.select("user_id", "part", joined())


@query
def average_metric(spark, folder):
    lists, test = exact_vector_lists(spark, folder)
    per_user = metrics.metrics_per_user(lists, test)
    return per_user.groupBy("k").agg(r6(F.avg("precision")).alias("precision"))


# --------------------------------------- ranking, sampling, splitting, union --


@query
def topk_dense_rank(spark, folder):
    """Papers ranked per label by their first coordinate, to one digit: many ties."""
    rows = tables.load(spark, folder, "embeddings")
    first = F.round(F.col("embedding")[0].cast("double"), 1)
    scored = rows.select(
        F.col("label").cast("bigint").alias("user_id"),
        F.col("vec_id").alias("paper_id"),
        first.alias("similarity"),
    )
    return ranking.top_k(scored, 3)


@query
def topk_row_number(spark, folder):
    rows = tables.load(spark, folder, "lineitem")
    scored = rows.select(
        F.col("l_suppkey").alias("user_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("paper_id"),
        F.col("l_quantity").alias("similarity"),
    )
    return ranking.top_k(scored, 5, "row_number")


@query
def topk_terms(spark, folder):
    return terms.top_terms(terms.document_frequency(plain_words(spark, folder)), 1000)


@query
def topk_terms_by_summary(spark, folder):
    """The same 1000 terms from per-task summaries and a second, exact count."""
    return frequent.frequent_terms(plain_words(spark, folder), 1000, counters=2000)


@query
def sample_users(spark, folder):
    return libraries.sample_users(tables.pairs(spark, folder), 20, SEED)


@query
def split_train_test(spark, folder):
    split = libraries.split_train_test(written_pairs(spark, folder), SEED)
    return split.withColumn("is_test", F.col("is_test").cast("int"))


@query
def random_split_rows(spark, folder):
    train, test = libraries.split_rows(tables.pairs(spark, folder), ["user_id", "paper_id"], SEED)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def sample_negatives(spark, folder):
    rated = written_pairs(spark, folder)
    return interactions.sample_negatives(rated, tables.metadata(spark, folder), SEED)


@query
def union_interactions(spark, folder):
    rated = written_pairs(spark, folder)
    unrated = interactions.sample_negatives(rated, tables.metadata(spark, folder), SEED)
    mixed = interactions.union_interactions(interactions.positives(rated), unrated)
    return mixed.groupBy("user_id", "label").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("paper_id").alias("id_sum")
    )


@query
def distinct_rows(spark, folder):
    return tables.papers(spark, folder).select("title", "abstract").distinct()


# ------------------------------------------------------------------- vectors --


def vectors_with_label_sum(spark, folder):
    rows = tables.load(spark, folder, "embeddings").select(
        "vec_id", "label", vec.as_doubles("embedding").alias("vector")
    )
    as_pairs = rows.select(F.col("label").alias("user_id"), F.col("vec_id").alias("paper_id"))
    sums = profiles.sum_dense(as_pairs, tables.vectors(spark, folder))
    return rows.join(sums.select(F.col("user_id").alias("label"), F.col("vector").alias("total")), "label")


@query
def cosine_similarity(spark, folder):
    rows = vectors_with_label_sum(spark, folder)
    return rows.select("vec_id", r6(vec.cosine_similarity("vector", "total")).alias("similarity"))


@query
def cosine_of_zero_vectors(spark, folder):
    """Vectors of the first label lose all length; their rows stay, without score."""
    rows = vectors_with_label_sum(spark, folder)
    scaled = F.transform("vector", lambda x: x * F.least(F.col("label"), F.lit(1)))
    return rows.select("vec_id", r6(vec.cosine_similarity(scaled, F.col("total"))).alias("similarity"))


@query
def dense_to_sparse(spark, folder):
    """Vector entries in long form; entries that round to zero are not stored."""
    entries = tables.vectors(spark, folder).select(
        "paper_id", F.posexplode("vector").alias("term_id", "value")
    )
    rounded = entries.select(
        "paper_id", F.col("term_id").cast("bigint").alias("term_id"), F.round("value", 2).alias("weight")
    )
    return weights.drop_zeros(rounded)


@query
def vector_add_subtract(spark, folder):
    rows = vectors_with_label_sum(spark, folder)
    moved = vec.add(vec.subtract("vector", "total"), F.col("vector"))
    return rows.select("vec_id", F.posexplode(moved).alias("place", "value")).select(
        "vec_id", F.col("place").cast("bigint").alias("place"), r6("value").alias("value")
    )


# ------------------------------------------------------------ feature stages --


@query
def term_frequency(spark, folder):
    return plain_tf(spark, folder)


@query
def inverse_document_frequency(spark, folder):
    idf = weights.inverse_document_frequency(plain_tf(spark, folder))
    return idf.withColumn("idf", r6("idf"))


@query
def tf_idf(spark, folder):
    return plain_weights(spark, folder).withColumn("weight", r6("weight"))


@query
def count_vectors(spark, folder):
    """Term counts as MLlib vectors, made inside the row, taken apart again."""
    words = write_once(plain_words(spark, folder), "words")
    counted = weights.count_vectors(words, plain_vocabulary(spark, folder, words))
    entries = counted.select(
        "paper_id", F.posexplode(vector_to_array("features")).alias("term_id", "tf")
    )
    return entries.filter("tf > 0").select(
        "paper_id", F.col("term_id").cast("bigint").alias("term_id"), F.col("tf").cast("bigint").alias("tf")
    )


def topic_places(rows, *keys):
    return rows.select(*keys, F.posexplode("vector").alias("place", "value")).select(
        *keys, F.col("place").cast("bigint").alias("place"), r6("value").alias("value")
    )


@query
def lda_topics(spark, folder):
    """Topic shares after ten steps, in long form."""
    return topic_places(recommend.topic_vectors(tables.papers(spark, folder), NO_STEM, seed=SEED), "paper_id")


def conservative_words(spark, folder):
    return write_once(preprocess.preprocess_conservative(tables.papers(spark, folder)), "words")


@query
def word2vec_conservative(spark, folder):
    model = embeddings.word2vec_fit(conservative_words(spark, folder), seed=SEED)
    return embeddings.word_vectors(model)


@query
def word2vec_intensive(spark, folder):
    words = write_once(preprocess.preprocess_intensive(tables.papers(spark, folder)), "stems")
    return embeddings.word_vectors(embeddings.word2vec_fit(words, seed=SEED))


@query
def word2vec_user_words(spark, folder):
    merged = terms.merge_token_lists(written_pairs(spark, folder), conservative_words(spark, folder))
    model = embeddings.word2vec_fit(write_once(merged, "merged"), seed=SEED)
    return embeddings.word_vectors(model)


@query
def skipgram_pair_counts(spark, folder):
    """Counted pairs of the sharded trainer, summed per word."""
    pairs = skipgram.pair_counts(conservative_words(spark, folder))
    return pairs.groupBy("a").agg(F.count("*").alias("pairs"), F.sum("n").alias("n"))


@query
def skipgram_vocabulary(spark, folder):
    """The words that the sharded trainer knows, and the length of their vectors."""
    found = skipgram.skipgram_vectors(conservative_words(spark, folder), vector_size=20, steps=2, seed=SEED)
    return found.select("word", F.size("vector").alias("places"))


@query
def find_synonyms(spark, folder):
    return embeddings.find_synonyms(tables.word_table(spark, folder), SYNONYM_WORD, 10)


@query
def find_synonyms_of_vector(spark, folder):
    words = tables.word_table(spark, folder)
    moved = embeddings.analogy_vector(words, *ANALOGY_WORDS)
    return embeddings.find_synonyms_of_vector(words, moved, 10)


@query
def analogy(spark, folder):
    return embeddings.analogy(tables.word_table(spark, folder), *ANALOGY_WORDS)


@query
def trained_synonyms(spark, folder):
    """Nearest words of the most frequent term under a trained model."""
    words = conservative_words(spark, folder)
    model = embeddings.word2vec_fit(words, seed=SEED)
    vectors = write_once(embeddings.word_vectors(model), "word-vectors")
    top = terms.top_terms(terms.document_frequency(words), 1).first()["term"]
    return embeddings.find_synonyms(vectors, top, 10)


def vocabulary_vectors(spark, folder, words):
    """Word vectors for the terms whose number is an embedding's id."""
    numbered = plain_vocabulary(spark, folder, words)
    rows = tables.word_table(spark, folder).withColumnRenamed("word", "term_id")
    return numbered.join(rows, "term_id").select(F.col("term").alias("word"), "vector")


def table_embeddings(spark, folder):
    words = write_once(plain_words(spark, folder), "words")
    vectors = write_once(vocabulary_vectors(spark, folder, words), "word-vectors")
    return embeddings.document_embedding(words, vectors)


@query
def document_embedding(spark, folder):
    embedded = table_embeddings(spark, folder)
    return embedded.select(
        "paper_id", "n_tokens", F.posexplode("vector").alias("place", "value")
    ).select(
        "paper_id", "n_tokens", F.col("place").cast("bigint").alias("place"), r6("value").alias("value")
    )


@query
def document_embedding_trained(spark, folder):
    return recommend.paper_embeddings(tables.papers(spark, folder), SEED)


def rated_with_features(spark, folder):
    """Rated pairs with paper and user features, as a table: every fit reads them again."""
    rated, parts = written_pairs(spark, folder), tables.metadata(spark, folder)
    stats = features.user_profile_stats(features.join_library_metadata(rated, parts))
    rows = features.join_user_features(interactions.positives(rated), stats)
    columns = ["user_id", "paper_id", "label", "type", "pages", "year", "user_pages", "user_papers"]
    return write_once(features.join_paper_features(rows, parts).select(columns), "rated")


@query
def index_type(spark, folder):
    rated = features.join_paper_features(tables.pairs(spark, folder), tables.metadata(spark, folder))
    rows = features.index_type(write_once(rated, "rated"))
    return rows.select("user_id", "paper_id", "type", "type_index")


@query
def impute_mean(spark, folder):
    rows = features.impute_mean(features.index_type(rated_with_features(spark, folder)))
    return rows.select(
        "user_id", "paper_id", r6("pages").alias("pages"), r6("year").alias("year"), "type_index"
    )


@query
def one_hot(spark, folder):
    encoded = features.one_hot(features.index_type(rated_with_features(spark, folder)))
    places = vector_to_array("type_encoded")
    return encoded.select(
        "user_id", "paper_id", F.size(places).alias("places"), (F.array_position(places, 1.0) - 1).alias("place")
    )


@query
def assemble_features(spark, folder):
    indexed = features.index_type(rated_with_features(spark, folder))
    rows = features.assemble_features(features.one_hot(features.impute_mean(indexed)))
    return rows.select("user_id", "paper_id", "label", *feature_columns())


def feature_columns():
    """The whole vector: two numbers, the place of the type among all types, two numbers."""
    values = vector_to_array("features")
    flags = F.slice(values, 3, F.size(values) - 4)
    ends = {"pages": 1, "year": 2, "user_pages": -2, "user_papers": -1}
    return [
        *[r6(F.element_at(values, at)).alias(name) for name, at in ends.items()],
        F.size(flags).alias("places"),
        (F.array_position(flags, 1.0) - 1).alias("place"),
    ]


# --------------------------------------------------------- models and errors --


def split_dataset(spark, folder):
    rated, parts = written_pairs(spark, folder), tables.metadata(spark, folder)
    rows = write_once(classify.classification_dataset(rated, parts, SEED), "features")
    return libraries.split_rows(rows, ["user_id", "paper_id"], SEED)


@query
def linear_svm(spark, folder):
    predicted = models.linear_svm(*split_dataset(spark, folder))
    return predicted.select("user_id", "paper_id", "label", "prediction")


@query
def random_forest(spark, folder):
    predicted = models.random_forest(*split_dataset(spark, folder))
    return predicted.select("user_id", "paper_id", "label", "prediction")


@query
def rmse(spark, folder):
    """Quality labels against toxicity as a (bad) prediction of them."""
    rows = tables.load(spark, folder, "labels").select(
        F.col("quality").alias("label"), F.col("toxic").cast("double").alias("prediction")
    )
    return models.rmse(rows).select(r6("rmse").alias("rmse"))


# ------------------------------------------------------------------- metrics --


def _one_metric(name, at_k):
    def run(spark, folder, k=10):
        lists, test = exact_vector_lists(spark, folder)
        return at_k(lists, test, k).withColumn(f"{name}_at_k", r6(f"{name}_at_k"))

    run.__name__ = f"{name}_at_k"
    return query(run)


_one_metric("precision", metrics.precision_at_k)
_one_metric("recall", metrics.recall_at_k)
_one_metric("mrr", metrics.mrr_at_k)
_one_metric("ndcg", metrics.ndcg_at_k)


def _rounded_metrics(df):
    return df.select("k", *[r6(m).alias(m) for m in ("precision", "recall", "mrr", "ndcg")])


@query
def evaluate_metrics(spark, folder):
    return _rounded_metrics(metrics.evaluate_metrics(*exact_vector_lists(spark, folder)))


@query
def evaluate_metrics_as_written(spark, folder):
    lists = exact_vector_lists(spark, folder)
    return _rounded_metrics(metrics.evaluate_metrics(*lists, mode=metrics.AS_WRITTEN))


@query
def evaluate_tfidf(spark, folder):
    papers, rated = tables.papers(spark, folder), written_pairs(spark, folder)
    lists = recommend.recommend_tfidf(papers, rated, EXACT_TERM_LISTS, NO_STEM)
    return _rounded_metrics(recommend.evaluate(lists, rated, EXACT_TERM_LISTS))


# -------------------------------------------------------------- recommenders --


@query
def recommend_tfidf(spark, folder):
    return recommend.recommend_tfidf(
        tables.papers(spark, folder), written_pairs(spark, folder), TERM_LISTS, NO_STEM
    )


@query
def recommend_tfidf_with_zeros(spark, folder):
    """Lists long enough to reach the papers that share no term, which tie at 0."""
    options = recommend.ListOptions(n_users=20, k=900, seed=SEED, include_zero=True)
    return recommend.recommend_tfidf(tables.papers(spark, folder), written_pairs(spark, folder), options, NO_STEM)


@query
def recommend_from_balls(spark, folder):
    """The lists of ``recommend_from_vectors`` by bounds on balls of papers."""
    split = vector_split(spark, folder)
    profile = write_once(vector_profiles(spark, folder, split), "profiles")
    train = libraries.train_part(split)
    return blocks.search_balls(blocks.build_balls(tables.vectors(spark, folder)), profile, train, 35).lists


@query
def recommend_tfidf_stemmed(spark, folder):
    return recommend.recommend_tfidf(
        tables.papers(spark, folder), written_pairs(spark, folder), TERM_LISTS
    )


@query
def recommend_lda(spark, folder):
    return recommend.recommend_lda(
        tables.papers(spark, folder), written_pairs(spark, folder), TERM_LISTS
    )


@query
def recommend_embedding_user(spark, folder):
    return recommend.recommend_embedding_user(
        tables.papers(spark, folder), written_pairs(spark, folder), NAMED_USER, ONE_USER_LIST
    )


@query
def recommend_embedding(spark, folder):
    return recommend.recommend_embedding(
        tables.papers(spark, folder), written_pairs(spark, folder), VECTOR_LISTS
    )


@query
def recommend_embedding_active(spark, folder):
    return recommend.recommend_embedding_active(
        tables.papers(spark, folder), written_pairs(spark, folder), VECTOR_LISTS
    )


@query
def recommend_from_vectors(spark, folder):
    """The embedding recommender over given paper vectors."""
    return recommend.recommend_from_embeddings(
        tables.vectors(spark, folder), written_pairs(spark, folder), VECTOR_LISTS
    )


@query
def recommend_user_from_vectors(spark, folder):
    one = libraries.filter_user(written_pairs(spark, folder), NAMED_USER)
    return recommend.recommend_from_embeddings(tables.vectors(spark, folder), one, ONE_USER_LIST)


@query
def recommend_active_from_vectors(spark, folder):
    rated = written_pairs(spark, folder)
    active = libraries.restrict_to_users(rated, libraries.users_above(rated, 20))
    return recommend.recommend_from_embeddings(tables.vectors(spark, folder), active, VECTOR_LISTS)


@query
def recommend_from_word_table(spark, folder):
    """Word vectors from a table, averaged per paper and per user, then ranked."""
    embedded = write_once(table_embeddings(spark, folder), "embedded")
    return recommend.recommend_from_embeddings(embedded, written_pairs(spark, folder), VECTOR_LISTS)


@query
def user_corpus_profile(spark, folder):
    return recommend.user_corpus_profiles(
        written_pairs(spark, folder), conservative_words(spark, folder), SEED
    )


@query
def build_vocabulary(spark, folder):
    words = plain_words(spark, folder)
    return plain_vocabulary(spark, folder, words)


@query
def build_vocabulary_stemmed(spark, folder):
    papers = tables.papers(spark, folder)
    return preprocess.build_vocabulary(papers, preprocess.preprocess_terms(papers))


@query
def classification_dataset(spark, folder):
    dataset = classify.classification_dataset(
        written_pairs(spark, folder), tables.metadata(spark, folder), SEED
    )
    return dataset.select("user_id", "paper_id", "label", *feature_columns())


@query
def classify_and_score(spark, folder):
    dataset = classify.classification_dataset(
        written_pairs(spark, folder), tables.metadata(spark, folder), SEED
    )
    return classify.classify_and_score(dataset, SEED)


@query
def preprocess_conservative(spark, folder):
    words = preprocess.preprocess_conservative(tables.papers(spark, folder))
    return words.select("paper_id", joined())


@query
def preprocess_intensive(spark, folder):
    words = preprocess.preprocess_intensive(tables.papers(spark, folder), stem=False)
    return words.select("paper_id", joined())


@query
def preprocess_intensive_stemmed(spark, folder):
    words = preprocess.preprocess_intensive(tables.papers(spark, folder), distinct=True)
    return words.select("paper_id", joined())


# ------------------------------------------------- facts of trained results --


@query
def lda_topic_facts(spark, folder):
    """Which papers have topic shares, how many, and their sum."""
    rows = recommend.topic_vectors(
        tables.papers(spark, folder), NO_STEM, seed=SEED, trainer=recommend.BY_MLLIB
    )
    total = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x)
    return rows.select("paper_id", F.size("vector").alias("places"), r6(total).alias("total"))


@query
def word2vec_vocabulary(spark, folder):
    """The words that a trained model knows, and the length of their vectors."""
    model = embeddings.word2vec_fit(conservative_words(spark, folder), seed=SEED)
    return embeddings.word_vectors(model).select("word", F.size("vector").alias("places"))


def predicted_facts(predicted):
    valid = F.col("prediction").isin(0.0, 1.0)
    return predicted.select("user_id", "paper_id", "label", valid.alias("valid"))


@query
def linear_svm_facts(spark, folder):
    """The rows that are predicted, and that predictions are classes."""
    return predicted_facts(models.linear_svm(*split_dataset(spark, folder)))


@query
def random_forest_facts(spark, folder):
    return predicted_facts(models.random_forest(*split_dataset(spark, folder)))


def list_facts(spark, folder, pairs, options):
    """Per user of trained embedding lists: levels, last rank, seen papers in it, and scores that
    the saved vectors do not give."""
    embedded = recommend.paper_embeddings(tables.papers(spark, folder), SEED)
    lists = write_once(recommend.recommend_from_embeddings(embedded, pairs, options), "lists")
    train = libraries.train_part(recommend.sampled_split(pairs, options.n_users, options.seed))
    profile = profiles.mean_by_tokens(train, embedded).withColumnRenamed("vector", "own")
    seen = train.withColumn("seen", F.lit(1))
    rows = lists.join(embedded, "paper_id").join(profile, "user_id").join(seen, ["user_id", "paper_id"], "left")
    score = F.round(vec.cosine_similarity("own", "vector"), 6)
    wrong = F.when(F.abs(score - F.col("similarity")) <= 1e-6, 0).otherwise(1)
    return rows.groupBy("user_id").agg(
        F.count_distinct("rank").alias("levels"),
        F.max("rank").alias("last"),
        F.coalesce(F.sum("seen"), F.lit(0)).cast("bigint").alias("seen"),
        F.sum(wrong).cast("bigint").alias("wrong"),
    )


@query
def recommend_embedding_facts(spark, folder):
    return list_facts(spark, folder, written_pairs(spark, folder), VECTOR_LISTS)


@query
def recommend_embedding_active_facts(spark, folder):
    rated = written_pairs(spark, folder)
    active = write_once(libraries.restrict_to_users(rated, libraries.users_above(rated, 20)), "active")
    return list_facts(spark, folder, active, VECTOR_LISTS)


@query
def recommend_embedding_user_facts(spark, folder):
    own = write_once(libraries.filter_user(written_pairs(spark, folder), NAMED_USER), "own")
    return list_facts(spark, folder, own, ONE_USER_LIST)


def written_papers(spark, folder):
    """Papers as CSV files with all 15 columns filled and line breaks kept; returns the folder."""
    path = new_table_path(spark, "papers-csv")
    made = {
        "paper_id": F.col("paper_id").cast("int"),
        "type": F.concat(F.lit('a "type", '), F.col("paper_id") % 3),
        "pages": F.when(F.col("paper_id") % 10 != 0, F.col("paper_id") % 500).cast("int"),
        "year": F.when(F.col("paper_id") % 7 != 0, (1990 + F.col("paper_id") % 30).cast("string")),
        "title": F.col("title"),
        "abstract": F.col("abstract"),
    }
    columns = [
        made.get(f.name, F.concat(F.lit(f"{f.name} "), F.col("paper_id"))).cast(f.dataType).alias(f.name)
        for f in PAPERS_SCHEMA
    ]
    tables.papers(spark, folder).select(*columns).write.options(
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="", lineSep="\n"
    ).csv(path)
    return path


@query
def scan_papers_all_columns(spark, folder):
    """15 columns whose texts hold quotes, backslashes and line breaks, also side by side and at the ends."""
    path = new_table_path(spark, "papers-csv")
    marked = {
        "title": F.translate(F.coalesce("title", F.lit("")), "aei", '"\\,'),
        "abstract": F.concat(F.lit('"'), F.translate(F.coalesce("abstract", F.lit("")), "tn ", '\\"\n'), F.lit('\\"')),
        "paper_id": F.col("paper_id").cast("int"),
        "pages": (F.col("paper_id") % 500).cast("int"),
    }
    columns = [
        marked.get(f.name, F.concat(F.lit(f'{f.name} "\\" \\\\ \n'), F.col("paper_id"))).cast(f.dataType).alias(f.name)
        for f in PAPERS_SCHEMA
    ]
    tables.papers(spark, folder).select(*columns).write.options(
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="", lineSep="\n"
    ).csv(path)
    read = scan_papers(spark, path, multi_line=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return read.withColumns({"title": F.coalesce("title", F.lit("")), "abstract": F.coalesce("abstract", F.lit(""))})


@query
def scan_papers_multi_line(spark, folder):
    """All 15 columns, with the line breaks of real abstracts."""
    rows = scan_papers(spark, written_papers(spark, folder), multi_line=True)
    return rows.withColumn("abstract", F.coalesce("abstract", F.lit(""))).withColumn("title", F.coalesce("title", F.lit("")))


@query
def scan_papers_with_floats(spark, folder):
    rows = scan_papers_features(spark, written_papers(spark, folder), multi_line=True)
    return rows.select("paper_id", "type", F.col("pages").cast("double").alias("pages"), F.col("year").cast("double").alias("year"))
