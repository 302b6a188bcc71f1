import pytest

from checks import tables
from foliorank.operators import libraries
from foliorank.plans import recommend

FOLDER = "/root/testdata/sf0.001"
LISTS = recommend.ListOptions(n_users=6, k=5, seed=11)
SMALL_MODEL = {"vector_size": 8, "partitions": 2}


@pytest.fixture(scope="module")
def papers(spark):
    return tables.papers(spark, FOLDER).cache()


@pytest.fixture(scope="module")
def pairs(spark):
    return tables.pairs(spark, FOLDER).cache()


def check_lists(lists, pairs, options=LISTS):
    rows = lists.collect()
    split = recommend.sampled_split(pairs, options.n_users, options.seed)
    train = {(r.user_id, r.paper_id) for r in libraries.train_part(split).collect()}
    users = {r.user_id for r in split.collect()}
    assert rows and {r.user_id for r in rows} <= users
    assert not {(r.user_id, r.paper_id) for r in rows} & train
    for user in {r.user_id for r in rows}:
        mine = sorted((r.rank, -r.similarity) for r in rows if r.user_id == user)
        ranks = [rank for rank, _ in mine]
        assert ranks[0] == 1 and max(ranks) <= options.k
        assert [s for _, s in mine] == sorted(s for _, s in mine)
        # Dense ranks: one score per rank.
        assert len({s for _, s in mine}) == len(set(ranks))
    return rows


def test_tfidf(papers, pairs):
    lists = recommend.recommend_tfidf(papers, pairs, LISTS)
    check_lists(lists, pairs)
    for row in recommend.evaluate(lists, pairs, LISTS).collect():
        assert all(0 <= row[m] <= 1 for m in ("precision", "recall", "mrr", "ndcg"))


def test_exact_lists_have_k_rows(papers, pairs):
    options = recommend.ListOptions(n_users=6, k=5, seed=11, method="row_number")
    rows = recommend.recommend_tfidf(papers, pairs, options).collect()
    assert len(rows) == len({(r.user_id, r.rank) for r in rows}) <= 30


def test_lda(papers, pairs):
    check_lists(recommend.recommend_lda(papers, pairs, LISTS, topics=5, max_iter=2), pairs)


@pytest.mark.parametrize("how", [{}, {"whole_library": True}, {"profile_model": "separate"}])
def test_embedding(papers, pairs, how):
    few = libraries.restrict_to_users(pairs, libraries.sample_users(pairs, 12, 1))
    check_lists(recommend.recommend_embedding(papers, few, LISTS, **how, **SMALL_MODEL), few)


def test_embedding_of_one_user(papers, pairs):
    options = recommend.ListOptions(n_users=1, k=10, seed=11)
    rows = recommend.recommend_embedding_user(papers, pairs, 1, options, **SMALL_MODEL).collect()
    assert {r.user_id for r in rows} == {1}


def test_embedding_of_active_users(papers, pairs):
    rows = recommend.recommend_embedding_active(papers, pairs, LISTS, library_above=40, **SMALL_MODEL)
    sizes = {r.user_id: r.library_size for r in libraries.library_size(pairs).collect()}
    users = {r.user_id for r in rows.collect()}
    assert users and all(sizes[u] > 40 for u in users)


def test_unknown_profile_model(papers, pairs):
    with pytest.raises(ValueError):
        recommend.recommend_embedding(papers, pairs, LISTS, profile_model="other", **SMALL_MODEL)
