import math

import pytest

from foliorank.operators import metrics


def lists(spark, papers):
    rows = [("u", i + 1, p) for i, p in enumerate(papers)]
    return spark.createDataFrame(rows, "user_id string, rank long, paper_id string")


def held_out(spark, papers):
    return spark.createDataFrame([("u", p) for p in papers], "user_id string, paper_id string")


def at(spark, papers, test, k, mode):
    row = metrics.metrics_per_user(lists(spark, papers), held_out(spark, test), [k], mode).first()
    return row.precision, row.recall, row.mrr, row.ndcg


FIVE = ["p1", "p2", "p3", "p4", "p5"]


def test_standard(spark):
    found = at(spark, FIVE, ["p2", "p5", "p9"], 5, "standard")
    assert found == pytest.approx((0.4, 2 / 3, 0.5, 0.477624), abs=1e-6)


def test_as_written(spark):
    found = at(spark, FIVE, ["p2", "p5", "p9"], 5, "as_written")
    assert found == pytest.approx((0.4, 2 / 3, 0.5, 0.342066), abs=1e-6)
    assert found[3] == pytest.approx((2 / math.log2(6)) / (1 + 2 / math.log2(3)))


def test_no_hit(spark):
    assert at(spark, FIVE, ["x"], 5, "standard") == (0, 0, 0, 0)
    assert at(spark, FIVE, ["x"], 5, "as_written") == pytest.approx((0, 0, 0.2, 0))


def test_short_list_counts_missing_places_as_misses(spark):
    assert at(spark, ["p1", "p2"], ["p2"], 5, "standard")[:3] == pytest.approx((0.2, 1.0, 0.5))


def test_all_cutoffs_at_once(spark):
    papers = [f"p{i}" for i in range(1, 41)]
    rows = metrics.metrics_per_user(lists(spark, papers), held_out(spark, ["p7", "p20"])).collect()
    assert {r.k: r.precision for r in rows} == pytest.approx({5: 0, 10: 0.1, 30: 2 / 30})
    for name in ("precision", "recall", "mrr", "ndcg"):
        alone = getattr(metrics, f"{name}_at_k")(lists(spark, papers), held_out(spark, ["p7", "p20"]), 10)
        [value] = [r[name] for r in rows if r.k == 10]
        assert alone.first()[f"{name}_at_k"] == pytest.approx(value)


def test_tied_ranks_are_placed_by_paper(spark):
    tied = spark.createDataFrame([("u", 1, "b"), ("u", 1, "a")], "user_id string, rank long, paper_id string")
    assert metrics.mrr_at_k(tied, held_out(spark, ["b"]), 5).first()["mrr_at_k"] == 0.5


def test_average_over_users(spark):
    recommendations = spark.createDataFrame(
        [("u", 1, "a"), ("v", 1, "a")], "user_id string, rank long, paper_id string"
    )
    test = spark.createDataFrame([("u", "a"), ("v", "b")], "user_id string, paper_id string")
    row = metrics.evaluate_metrics(recommendations, test, [1]).first()
    assert (row.precision, row.recall, row.mrr, row.ndcg) == (0.5, 0.5, 0.5, 0.5)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        at(spark, FIVE, ["p1"], 5, "other")
