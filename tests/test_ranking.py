import numpy as np
import pytest
from pyspark.sql import functions as F

from foliorank.operators import profiles, ranking, scoring


def frame(spark, rows):
    return spark.createDataFrame(rows, "user_id string, paper_id long, similarity double")


def test_dense_rank_keeps_ties(spark):
    scored = frame(spark, [("u", 1, 1.0), ("u", 2, 1.0), ("u", 3, 0.5)])
    assert {tuple(r)[1:3] for r in ranking.top_k(scored, 1).collect()} == {(1, 1), (1, 2)}
    assert {tuple(r)[1:3] for r in ranking.top_k(scored, 2).collect()} == {(1, 1), (1, 2), (2, 3)}
    exact = ranking.top_k(scored, 1, "row_number").collect()
    assert [(r.rank, r.paper_id) for r in exact] == [(1, 1)]


def test_dense_rank_equals_a_plain_window(spark):
    from pyspark.sql import Window

    scored = spark.range(20_000).select(
        F.concat(F.lit("u"), F.col("id") % 3).alias("user_id"),
        F.col("id").alias("paper_id"),
        # A third of all rows share the best score.
        F.when(F.col("id") % 7 < 2, 1.0).otherwise(F.round(F.abs(F.hash("id")) % 5000 / 5000, 4)).alias("similarity"),
    )
    plain = scored.withColumn(
        "rank", F.dense_rank().over(Window.partitionBy("user_id").orderBy(F.desc("similarity"))).cast("long")
    ).filter("rank <= 25")
    found = {tuple(r) for r in ranking.top_k(scored, 25).collect()}
    expected = {(r.user_id, r.rank, r.paper_id, r.similarity) for r in plain.collect()}
    assert found == expected


def test_collected_lists(spark):
    scored = frame(spark, [("u", 1, 0.1), ("u", 2, 0.9), ("u", 3, 0.9), ("v", 1, 0.4)])
    lists = ranking.collect_recommendations(ranking.top_k(scored, 2), 2)
    assert {r.user_id: r.recommendations for r in lists.collect()} == {"u": [2, 3], "v": [1]}


def brute_force(profile, vectors, seen):
    out = {}
    for user, u in profile.items():
        for paper, v in vectors.items():
            length = np.linalg.norm(u) * np.linalg.norm(v)
            if (user, paper) not in seen and length > 0:
                out[user, paper] = round(float(np.dot(u, v) / length), 6)
    return out


@pytest.fixture(scope="module")
def dense(spark):
    rng = np.random.default_rng(5)
    vectors = {i: rng.normal(size=8) for i in range(300)}
    vectors[17] = np.zeros(8)
    for copy in range(100, 200):  # a third of the papers are copies
        vectors[copy] = vectors[0]
    profile = {f"u{i}": rng.normal(size=8) for i in range(12)}
    profile["u3"] = np.zeros(8)
    seen = {(f"u{i}", j) for i in range(12) for j in range(0, 300, i + 3)}
    frames = (
        spark.createDataFrame([(u, v.tolist()) for u, v in profile.items()], "user_id string, vector array<double>"),
        spark.createDataFrame(
            [(p, v.tolist()) for p, v in vectors.items()] + [(999, None)], "paper_id long, vector array<double>"
        ).repartition(4),
        spark.createDataFrame(sorted(seen), "user_id string, paper_id long"),
    )
    return frames, brute_force(profile, vectors, seen)


def scores(df):
    return {(r.user_id, r.paper_id): r.similarity for r in df.collect()}


def close(found, expected):
    assert set(found) == set(expected)
    assert all(abs(found[key] - expected[key]) < 2e-6 for key in found)


@pytest.mark.parametrize("block_users", [1024, 5])
def test_dense_scores(dense, block_users):
    frames, expected = dense
    close(scores(scoring.score_dense(*frames, block_users=block_users, block_papers=70)), expected)


@pytest.mark.parametrize("block_users", [1024, 5])
@pytest.mark.parametrize("method", ["dense_rank", "row_number"])
def test_pruned_lists_are_the_same(dense, block_users, method):
    frames, _ = dense
    whole = ranking.top_k(scoring.score_dense(*frames), 10, method)
    pruned = ranking.top_k(
        scoring.score_dense(*frames, k=10, block_users=block_users, block_papers=70), 10, method
    )
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in pruned.collect()}


def test_no_profiles_no_scores(spark, dense):
    (profile, vectors, train), _ = dense
    assert scoring.score_dense(profile.limit(0), vectors, train).count() == 0


def test_sparse_scores_by_each_way(spark, monkeypatch):
    rng = np.random.default_rng(6)
    weights = [(p, t, float(rng.random())) for p in range(150) for t in range(30) if rng.random() < 0.2]
    users = [(f"u{u}", t, float(rng.random())) for u in range(9) for t in range(30) if rng.random() < 0.4]
    seen = [(f"u{u}", p) for u in range(9) for p in range(u, 150, 11)]
    frames = (
        spark.createDataFrame(users, "user_id string, term_id long, weight double"),
        spark.createDataFrame(weights, "paper_id long, term_id long, weight double"),
        spark.createDataFrame(seen, "user_id string, paper_id long"),
    )
    vectors = {p: np.zeros(30) for p in range(150)}
    for p, t, w in weights:
        vectors[p][t] = w
    profile = {f"u{u}": np.zeros(30) for u in range(9)}
    for u, t, w in users:
        profile[u][t] = w
    every = brute_force(profile, vectors, set(seen))
    shared = {k: s for k, s in every.items() if s > 0}
    assert len(shared) < len(every)

    def check():
        close(scores(scoring.score_sparse(*frames)), shared)
        close(scores(scoring.score_sparse(*frames, include_zero=True)), every)

    check()
    monkeypatch.setattr(scoring, "PIVOT_USERS", 2)
    check()
    monkeypatch.setattr(scoring, "BROADCAST_WEIGHTS", 2)
    check()


def test_every_profile_is_scored_whatever_the_options_say(spark):
    profiles_ = spark.createDataFrame([(u, 0, 1.0) for u in range(10)], "user_id long, term_id long, weight double")
    weights = spark.createDataFrame([(p, 0, 2.0) for p in range(3)], "paper_id long, term_id long, weight double")
    train = spark.createDataFrame([(0, 0)], "user_id long, paper_id long")
    for include_zero in (False, True):
        found = scoring.score_sparse(profiles_, weights, train, include_zero=include_zero)
        assert found.count() == 29 and found.select("user_id").distinct().count() == 10


def test_profiles(spark):
    train = spark.createDataFrame([("u", 1), ("u", 2), ("u", 9), ("v", 2)], "user_id string, paper_id long")
    vectors = spark.createDataFrame(
        [(1, 3, [1.0, 0.0]), (2, 1, [3.0, 2.0]), (3, 5, [9.0, 9.0])],
        "paper_id long, n_tokens long, vector array<double>",
    )
    summed = {r.user_id: r.vector for r in profiles.sum_dense(train, vectors).collect()}
    assert summed == {"u": [4.0, 2.0], "v": [3.0, 2.0]}
    mean = {r.user_id: r.vector for r in profiles.mean_by_tokens(train, vectors).collect()}
    assert mean["u"] == pytest.approx([1.5, 0.5]) and mean["v"] == pytest.approx([3.0, 2.0])


def test_collected_dense_lists_keep_all_ties(spark):
    rows = [("u", 1, p) for p in range(50)] + [("u", 2, p) for p in range(100, 700)] + [("v", 1, 3)]
    lists = spark.createDataFrame(rows, "user_id string, rank bigint, paper_id bigint").repartition(4)
    found = {(r.user_id, r.part): r.recommendations for r in ranking.collect_ranked(lists, part_papers=64).collect()}
    whole = [p for part in range(11) for p in found["u", part]]
    assert whole == [*range(50), *range(100, 700)] and found["v", 0] == [3] and len(found) == 12
    assert all(len(found["u", part]) == 64 for part in range(10))
    assert ranking.collect_ranked(lists.limit(0)).collect() == []


def test_ties_of_a_third_of_the_catalogue(spark):
    rows = [("u", p, 0.59955 if p % 3 == 0 else p / 10_000) for p in range(6000)]
    scored = spark.createDataFrame(rows, "user_id string, paper_id bigint, similarity double")
    ranked = ranking.top_k(scored, 6)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    # Rows are never dealt by their score.
    assert not any("similarity" in line for line in plan.splitlines() if "hashpartitioning" in line)
    best = sorted({s for _, _, s in rows}, reverse=True)[:6]
    expected = sorted(("u", best.index(s) + 1, p, s) for _, p, s in rows if s in best)
    assert sorted(tuple(r) for r in ranked.collect()) == expected and len(expected) > 2000
