"""The recommenders, from papers and libraries to ranked lists.

Inputs are ``papers`` (paper_id, title, abstract) and ``pairs`` (user_id,
paper_id), each pair once. Every recommender gives (user_id, rank, paper_id,
similarity) for sampled users; ``sampled_split`` with the same seed gives the
matching train and test parts.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..functions.stopwords import ENGLISH_STOPWORDS
from ..operators.blocks import top_k_dense, top_k_sparse
from ..operators.embeddings import embed_with_model, word2vec_fit
from ..operators.libraries import (
    filter_user,
    held_out_part,
    restrict_to_users,
    sample_users,
    split_train_test,
    train_part,
    users_above,
)
from ..operators.metrics import STANDARD, evaluate_metrics
from ..operators.profiles import mean_by_tokens, sum_dense, sum_sparse
from ..operators.ranking import top_k
from ..operators.scoring import score_sparse
from ..operators.terms import (
    MAX_PAPER_SHARE,
    MIN_PAPERS,
    VOCABULARY_SIZE,
    merge_token_lists,
)
from ..operators.topics import topic_vectors_by_steps
from ..operators.weights import (
    TOPIC_ITERATIONS,
    TOPICS,
    count_vectors,
    inverse_document_frequency,
    lda_topics,
    term_frequency,
    tf_idf,
)
from ..storage import write_once
from .preprocess import build_vocabulary, preprocess_conservative, preprocess_terms


@dataclass(frozen=True)
class ListOptions:
    """Who gets a list, how long it is, and how ties are cut.

    ``include_zero`` lets papers without a shared term into term-based lists; they
    matter to users with fewer than ``k`` distinct scores above zero.
    """

    n_users: int = 20
    k: int = 40
    seed: int = 7
    method: str = "dense_rank"
    include_zero: bool = False


@dataclass(frozen=True)
class TermOptions:
    """How paper text becomes a vocabulary."""

    stopwords: Sequence[str] = field(default_factory=lambda: list(ENGLISH_STOPWORDS))
    stem: bool = True
    min_papers: int = MIN_PAPERS
    max_share: float = MAX_PAPER_SHARE
    size: int = VOCABULARY_SIZE


def sampled_split(pairs: DataFrame, n_users: int, seed: int) -> DataFrame:
    """(user_id, paper_id, is_test) of the sampled users, as a written table."""
    sampled = restrict_to_users(pairs, sample_users(pairs, n_users, seed))
    return write_once(split_train_test(write_once(sampled, "sampled"), seed), "split")


# --------------------------------------------------- term and topic profiles --

BY_STEPS = "steps"
BY_MLLIB = "mllib"


def term_weights(papers: DataFrame, options: TermOptions) -> DataFrame:
    """TF-IDF of all papers; token lists, counts and term weights are written once."""
    words = write_once(preprocess_terms(papers, options.stopwords, options.stem), "words")
    vocabulary = build_vocabulary(
        papers, words, options.min_papers, options.max_share, options.size
    )
    tf = write_once(term_frequency(words, vocabulary), "tf")
    idf = write_once(inverse_document_frequency(tf), "idf")
    return tf_idf(tf, idf)


def topic_vectors(
    papers: DataFrame,
    options: TermOptions,
    topics: int = TOPICS,
    max_iter: int = TOPIC_ITERATIONS,
    seed: int = 1,
    trainer: str = BY_STEPS,
) -> DataFrame:
    """Topic shares of all papers, written once.

    ``steps`` fits the topics by this library's repeatable steps, ``mllib`` by Spark's online trainer.
    """
    words = write_once(preprocess_terms(papers, options.stopwords, options.stem), "words")
    vocabulary = build_vocabulary(
        papers, words, options.min_papers, options.max_share, options.size
    )
    if trainer == BY_STEPS:
        tf = term_frequency(words, vocabulary)
        return write_once(topic_vectors_by_steps(tf, topics, max_iter, seed), "topics")
    if trainer != BY_MLLIB:
        raise ValueError(f"unknown trainer {trainer!r}")
    vectors = write_once(count_vectors(words, vocabulary), "counts")
    return write_once(lda_topics(vectors, topics, max_iter, seed), "topics")


def rank_by_terms(
    weights: DataFrame, split: DataFrame, options: ListOptions
) -> DataFrame:
    """Lists from term weights and summed term profiles."""
    train = train_part(split)
    profiles = write_once(sum_sparse(train, weights), "profiles")
    if options.include_zero:
        return top_k(score_sparse(profiles, weights, train, include_zero=True), options.k, options.method)
    return top_k_sparse(profiles, weights, train, options.k, options.method)


def rank_by_vectors(
    profiles: DataFrame, vectors: DataFrame, split: DataFrame, options: ListOptions
) -> DataFrame:
    """Lists from dense profiles and paper vectors."""
    return top_k_dense(write_once(profiles, "profiles"), vectors, train_part(split), options.k, options.method)


def recommend_tfidf(
    papers: DataFrame,
    pairs: DataFrame,
    options: ListOptions = ListOptions(),
    terms: TermOptions = TermOptions(),
) -> DataFrame:
    split = sampled_split(pairs, options.n_users, options.seed)
    return rank_by_terms(term_weights(papers, terms), split, options)


def recommend_lda(
    papers: DataFrame,
    pairs: DataFrame,
    options: ListOptions = ListOptions(),
    terms: TermOptions = TermOptions(),
    topics: int = TOPICS,
    max_iter: int = TOPIC_ITERATIONS,
    trainer: str = BY_STEPS,
) -> DataFrame:
    split = sampled_split(pairs, options.n_users, options.seed)
    vectors = topic_vectors(papers, terms, topics, max_iter, options.seed, trainer)
    profiles = sum_dense(train_part(split), vectors)
    return rank_by_vectors(profiles, vectors, split, options)


# -------------------------------------------------------- word embeddings --

EMBEDDING_LISTS = ListOptions(n_users=50, k=35)
ONE_USER_LIST = ListOptions(n_users=1, k=10)
ACTIVE_USER_SIZE = 20

SAME_MODEL = "same"
SEPARATE_MODEL = "separate"


def paper_embeddings(papers: DataFrame, seed: int = 1, **shape) -> DataFrame:
    """(paper_id, n_tokens, vector) under a model of the papers, written once."""
    words = write_once(preprocess_conservative(papers), "words")
    return write_once(embed_with_model(words, word2vec_fit(words, seed=seed, **shape)), "embedded")


def user_corpus_profiles(pairs: DataFrame, words: DataFrame, seed: int = 1, **shape) -> DataFrame:
    """(user_id, vector) under a second model, trained on the users' merged lists.

    The two models do not share a space, so cosines with paper embeddings compare
    unrelated axes; kept because it is what the first job of this kind did.
    """
    merged = write_once(merge_token_lists(pairs, words), "merged")
    model = word2vec_fit(merged, seed=seed, **shape)
    parts = embed_with_model(merged.withColumnRenamed("user_id", "paper_id"), model)
    # Parts are means over their tokens: weighting them back gives the whole list's mean.
    one_each = parts.select("paper_id").distinct().selectExpr("paper_id AS user_id", "paper_id")
    return mean_by_tokens(one_each, parts)


def recommend_from_embeddings(
    embedded: DataFrame, pairs: DataFrame, options: ListOptions = EMBEDDING_LISTS
) -> DataFrame:
    """Lists from given paper vectors (paper_id, n_tokens, vector)."""
    split = sampled_split(pairs, options.n_users, options.seed)
    return rank_by_vectors(mean_by_tokens(train_part(split), embedded), embedded, split, options)


def recommend_embedding(
    papers: DataFrame,
    pairs: DataFrame,
    options: ListOptions = EMBEDDING_LISTS,
    profile_model: str = SAME_MODEL,
    whole_library: bool = False,
    **shape,
) -> DataFrame:
    """Lists from averaged word vectors.

    Profiles come from the train papers under the papers' model. ``separate``
    trains a second model on merged lists, ``whole_library`` lets test papers into
    the profile.
    """
    split = sampled_split(pairs, options.n_users, options.seed)
    embedded = paper_embeddings(papers, options.seed, **shape)
    known = split.drop("is_test") if whole_library else train_part(split)
    if profile_model == SAME_MODEL:
        profiles = mean_by_tokens(known, embedded)
    elif profile_model == SEPARATE_MODEL:
        # The second model learns from every user; only the sampled keep a profile.
        words = preprocess_conservative(papers)
        library = pairs if whole_library else pairs.join(
            split.filter("is_test"), ["user_id", "paper_id"], "left_anti"
        )
        profiles = restrict_to_users(
            user_corpus_profiles(library, words, options.seed, **shape), split.select("user_id").distinct()
        )
    else:
        raise ValueError(f"unknown profile model {profile_model!r}")
    return rank_by_vectors(profiles, embedded, split, options)


def recommend_embedding_user(
    papers: DataFrame, pairs: DataFrame, user_id, options: ListOptions = ONE_USER_LIST, **how
) -> DataFrame:
    """The list of one named user."""
    return recommend_embedding(papers, filter_user(pairs, user_id), options, **how)


def recommend_embedding_active(
    papers: DataFrame,
    pairs: DataFrame,
    options: ListOptions = EMBEDDING_LISTS,
    library_above: int = ACTIVE_USER_SIZE,
    **how,
) -> DataFrame:
    """Lists of users with more than ``library_above`` papers."""
    active = restrict_to_users(pairs, users_above(pairs, library_above))
    return recommend_embedding(papers, active, options, **how)


def evaluate(
    recommendations: DataFrame, pairs: DataFrame, options: ListOptions, mode: str = STANDARD
) -> DataFrame:
    """Averaged metrics of a recommender's lists against the held-out papers."""
    split = sampled_split(pairs, options.n_users, options.seed)
    return evaluate_metrics(recommendations, held_out_part(split), mode=mode)
