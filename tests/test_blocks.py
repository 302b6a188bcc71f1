"""Lists from posting blocks against the plain way, which scores every paper."""

import random

import pytest

from foliorank.operators import blocks, ranking, scoring

WEIGHTS = "paper_id bigint, term_id bigint, weight double"


def topical(seed=4, topics=12, papers=120):
    """Papers of a topic share its terms; users have read papers of one topic."""
    rng = random.Random(seed)
    rows, train = [], []
    for topic in range(topics):
        for p in range(papers):
            paper = topic * papers + p
            terms = rng.sample(range(topic * 30, topic * 30 + 30), 6) + rng.sample(range(1000, 1040), 2)
            rows += [(paper, t, rng.choice([0.5, 1.0, 1.5, 2.0])) for t in terms]
    for user in range(10):
        topic = user % topics
        train += [(f"u{user}", topic * papers + p) for p in rng.sample(range(papers), 8)]
    rows += [(90_000, 7, 0.0), (90_001, 5, 0.0)]
    return rows, train


@pytest.mark.parametrize("method", ["dense_rank", "row_number"])
@pytest.mark.parametrize("size", [7, 64, 100_000])
def test_lists_equal_scoring_all_papers(spark, method, size):
    rows, train = topical()
    weights = spark.createDataFrame(rows, WEIGHTS).repartition(4)
    read = spark.createDataFrame(train, "user_id string, paper_id bigint")
    profiles = read.join(weights, "paper_id").groupBy("user_id", "term_id").agg({"weight": "sum"})
    profiles = profiles.withColumnRenamed("sum(weight)", "weight")
    expected = ranking.top_k(scoring.score_sparse(profiles, weights, read), 15, method)
    packed = blocks.build_blocks(weights, size)
    search = blocks.search_blocks(packed, profiles, read, 15, method)
    assert sorted(search.lists.collect()) == sorted(expected.collect())
    n_bounds, n_scored = search.bounds.count(), search.scored.count()
    if size == 64:
        # All users' terms meet common ones in every block, but few blocks can reach a floor.
        assert n_scored < 0.5 * n_bounds
    assert packed.count() * 10 >= n_bounds >= n_scored > 0


def test_short_lists_ties_and_negative_weights(spark):
    rows = [(p, t, w) for p in range(40) for t, w in ((1, 1.0), (2, -0.5 if p % 2 else 0.5))]
    rows += [(100 + p, 3, 2.0) for p in range(30)]
    weights = spark.createDataFrame(rows, WEIGHTS)
    profiles = spark.createDataFrame(
        [(1, 1, 1.0), (1, 3, 0.2), (2, 2, -1.0), (3, 999, 1.0), (4, 2, 1.0)], "user_id int, term_id bigint, weight double"
    )
    read = spark.createDataFrame([(1, 0), (4, 2)], "user_id int, paper_id bigint")
    for k in (1, 2, 50):
        expected = ranking.top_k(scoring.score_sparse(profiles, weights, read), k)
        for size in (3, 64):
            search = blocks.search_blocks(blocks.build_blocks(weights, size), profiles, read, k)
            assert sorted(search.lists.collect()) == sorted(expected.collect())


def test_nothing(spark):
    weights = spark.createDataFrame([], WEIGHTS)
    profiles = spark.createDataFrame([], "user_id int, term_id bigint, weight double")
    read = spark.createDataFrame([], "user_id int, paper_id bigint")
    assert blocks.top_k_sparse(profiles, weights, read, 5).collect() == []


def clustered(seed=3, clusters=15, size=40, length=8):
    import numpy as np

    rng = np.random.default_rng(seed)
    rows = []
    for c in range(clusters):
        centre = rng.standard_normal(length)
        rows += [(c * size + i, (centre + 0.15 * rng.standard_normal(length)).tolist()) for i in range(size)]
    rows += [(10_000, [0.0] * length), (10_001, None), (10_002, rows[5][1]), (10_003, rows[5][1])]
    return [rows[i] for i in rng.permutation(len(rows))]


@pytest.mark.parametrize("method", ["dense_rank", "row_number"])
@pytest.mark.parametrize("ball", [5, 40, 5000])
def test_balls_equal_scoring_all_papers(spark, method, ball):
    rows = clustered()
    vectors = spark.createDataFrame(rows, "paper_id bigint, vector array<double>").repartition(3)
    by_id = dict(rows)
    profiles = spark.createDataFrame(
        [(u, by_id[u * 40]) for u in range(12)] + [(50, [0.0] * 8)], "user_id int, vector array<double>"
    )
    read = spark.createDataFrame([(u, u * 40 + i) for u in range(12) for i in range(10)], "user_id int, paper_id bigint")
    expected = ranking.top_k(scoring.score_dense(profiles, vectors, read), 12, method)
    search = blocks.search_balls(blocks.build_balls(vectors, ball), profiles, read, 12, method)
    assert sorted(search.lists.collect()) == sorted(expected.collect())
    if ball == 40:
        assert search.scored.count() < 0.5 * search.bounds.count()


def test_balls_hold_their_papers(spark):
    import math

    vectors = spark.createDataFrame(clustered(), "paper_id bigint, vector array<double>").repartition(2)
    found = blocks.build_balls(vectors, 40, chunk=100).collect()
    assert sorted(p for ball in found for p in ball.papers) == sorted([*range(600), 10_002, 10_003])
    for ball in found:
        for i in range(len(ball.papers)):
            cosine = sum(a * b for a, b in zip(ball.vectors[8 * i : 8 * i + 8], ball.centre))
            assert math.acos(min(1, cosine)) <= ball.radius + 1e-9
