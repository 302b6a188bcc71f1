import pytest
from pyspark.sql import functions as F

from foliorank.operators import libraries
from foliorank.operators.grouping import dense_index, position_in_group
from foliorank.operators.interactions import cast_paper_id, sample_negatives


def library(spark, sizes):
    rows = [(user, paper) for user, size in sizes.items() for paper in range(size)]
    return spark.createDataFrame(rows, "user_id string, paper_id long")


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_split_sizes(spark):
    sizes = {"a": 1, "b": 4, "c": 5, "d": 6, "e": 10, "f": 11}
    split = libraries.split_train_test(library(spark, sizes), seed=3)
    tests = {r.user_id: r.n for r in split.groupBy("user_id").agg(F.count_if("is_test").alias("n")).collect()}
    assert tests == {"a": 1, "b": 1, "c": 1, "d": 2, "e": 2, "f": 3}
    assert split.count() == sum(sizes.values())


def test_split_of_a_large_library_equals_the_plain_one(spark):
    pairs = library(spark, {"hot": 5000, "a": 7, "b": 150})
    plain = libraries.split_train_test(pairs, seed=3)
    celled = libraries.split_train_test(pairs, seed=3, cell_rows=100)
    assert as_set(plain) == as_set(celled)


def test_split_is_repeatable_and_seeded(spark):
    pairs = library(spark, {"a": 50})
    first = as_set(libraries.split_train_test(pairs, 1))
    assert first == as_set(libraries.split_train_test(pairs.repartition(5), 1))
    assert first != as_set(libraries.split_train_test(pairs, 2))


def test_positions_across_cells(spark):
    rows = spark.range(1000).select(F.lit("g").alias("g"), F.col("id").alias("x"))
    placed = position_in_group(rows, ["g"], F.floor(F.col("x") / 37), ["x"])
    assert placed.filter("position != x + 1 OR group_size != 1000").count() == 0


def test_dense_index(spark):
    keys = spark.range(500).selectExpr("concat('u', id % 250) AS user_id")
    numbered = dense_index(keys, "user_id", "n").collect()
    assert sorted(r.n for r in numbered) == list(range(250))


def test_users(spark):
    pairs = library(spark, {"a": 20, "b": 21, "c": 3})
    assert [r.user_id for r in libraries.users_above(pairs).collect()] == ["b"]
    assert libraries.sample_users(pairs, 2, 5).count() == 2
    assert libraries.filter_user(pairs, "c").count() == 3
    only = libraries.restrict_to_users(pairs, libraries.users_above(pairs, 10))
    assert {r.user_id for r in only.select("user_id").distinct().collect()} == {"a", "b"}
    nested = spark.createDataFrame([("a", ["1", "2"])], "user_id string, paper_ids array<string>")
    assert libraries.nested_library_size(nested).first()["library_size"] == 2
    assert as_set(libraries.explode_library(nested)) == {("a", "1"), ("a", "2")}


def test_exclude_seen_keeps_test_papers(spark):
    split = libraries.split_train_test(library(spark, {"a": 10}), 1)
    left = libraries.exclude_seen(split.drop("is_test"), libraries.train_part(split))
    assert as_set(left) == as_set(libraries.held_out_part(split))


def test_row_split(spark):
    rows = spark.range(20_000).toDF("x")
    train, test = libraries.split_rows(rows, ["x"], seed=1)
    assert train.count() + test.count() == 20_000
    assert 0.78 < train.count() / 20_000 < 0.82


def test_cast_ids(spark):
    ids = spark.createDataFrame([("12",), ("x1",), (None,)], "paper_id string")
    assert [r.paper_id for r in cast_paper_id(ids).collect()] == [12, None, None]


@pytest.mark.parametrize("cell_rows", [1_000_000, 7])
def test_negatives(spark, cell_rows):
    sizes = {"a": 1, "b": 30, "c": 60, "d": 99, "e": 100}
    papers = spark.range(100).toDF("paper_id")
    pairs = library(spark, sizes)
    drawn = sample_negatives(pairs, papers, seed=4, cell_rows=cell_rows)
    rows = [(r.user_id, r.paper_id) for r in drawn.collect()]
    assert len(rows) == len(set(rows))
    assert not set(rows) & {(r.user_id, r.paper_id) for r in pairs.collect()}
    counts = {u: sum(1 for x, _ in rows if x == u) for u in sizes}
    # As many as rated, or all that are left.
    assert counts == {u: min(m, 100 - m) for u, m in sizes.items()}
    assert {r.label for r in drawn.collect()} == {0}


def test_negatives_of_a_large_library_start_from_several_rows(spark, monkeypatch):
    from foliorank.operators import interactions

    papers = spark.range(3000).toDF("paper_id")
    pairs = library(spark, {"hot": 1200, "a": 5})
    whole = as_set(sample_negatives(pairs, papers, seed=4))
    monkeypatch.setattr(interactions, "STEPS_PER_ROW", 50)
    assert as_set(sample_negatives(pairs, papers, seed=4, cell_rows=100)) == whole
    monkeypatch.setattr(interactions, "LARGE_CATALOGUE", 10)
    assert as_set(sample_negatives(pairs, papers, seed=4)) == whole
