import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import IntegerType, StructType

from checks import queries
from foliorank.operators import features, models
from foliorank.plans import classify

classify_columns = ["label", "type", "pages", "year", "user_pages", "user_papers"]
SCHEMA = StructType().add("paper_id", IntegerType()).add("label", IntegerType()).add("features", VectorUDT())


def rows(spark):
    data = [(1, "x", 1.0), (2, "x", None), (3, "y", 3.0), (4, None, 4.0)]
    return spark.createDataFrame(
        [("u", p, 1, t, pages, 2000.0 + p, 2.5, 4) for p, t, pages in data],
        "user_id string, paper_id long, label int, type string, pages double, year double, "
        "user_pages double, user_papers long",
    )


def test_index_impute_encode(spark):
    indexed = features.index_type(rows(spark))
    assert {r.paper_id: r.type_index for r in indexed.collect()} == {1: 0, 2: 0, 3: 1, 4: 2}
    imputed = features.impute_mean(indexed)
    assert {r.paper_id: r.pages for r in imputed.collect()}[2] == pytest.approx(8 / 3)
    encoded = features.one_hot(imputed).select("paper_id", vector_to_array("type_encoded").alias("v"))
    assert {r.paper_id: r.v for r in encoded.collect()} == {1: [1, 0], 2: [1, 0], 3: [0, 1], 4: [0, 0]}
    assembled = features.assemble_features(features.one_hot(imputed))
    vector = assembled.filter("paper_id = 3").first()["features"].toArray().tolist()
    assert vector == [3.0, 2003.0, 0.0, 1.0, 2.5, 4.0]
    fitted = features.feature_pipeline().fit(rows(spark)).transform(rows(spark))
    same = {r.paper_id: r.features for r in fitted.collect()}
    assert same == {r.paper_id: r.features for r in assembled.collect()}


def test_bad_years_become_null(spark):
    papers = spark.createDataFrame(
        [(1, "a", 3, "1999"), (2, "a", None, "in press")],
        "paper_id long, type string, pages int, year string",
    )
    made = {r.paper_id: r for r in features.as_features(papers).collect()}
    assert made[1].year == 1999.0 and made[2].year is None and made[2].pages is None


def test_rmse(spark):
    predictions = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 0.0), (0, 0.0)], "label int, prediction double")
    assert models.rmse(predictions).first()["rmse"] == pytest.approx(math.sqrt(0.25))


def test_fits_read_a_written_table(spark, tmp_path):
    made = {
        "orders": ([(1, 5), (2, 6)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(1, 1), (1, 2), (2, 1)], "l_orderkey long, l_partkey long"),
        "part": ([(1, "red x", "t", "Brand#12", 4), (2, "hot y", "s", "Brand#10", 5)], "p_partkey long, p_name string, p_type string, p_brand string, p_size int"),
    }
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    rated = queries.rated_with_features(spark, str(tmp_path))
    assert {tuple(r) for r in rated.collect()} == {
        (5, 1, 1, "t", 4.0, 1992.0, 4.0, 2), (5, 2, 1, None, None, 1990.0, 4.0, 2), (6, 1, 1, "t", 4.0, 1992.0, 4.0, 1)
    }
    assert rated.columns == ["user_id", "paper_id", *classify_columns]
    assert "Join" not in rated._jdf.queryExecution().optimizedPlan().toString()


def test_user_numbers_are_joined_before_paper_columns(spark):
    """Ids and numbers are shuffled by user; the type's text is not."""
    papers = spark.createDataFrame([(1, "a", 2.0, 1.0), (2, "b", None, 2.0), (3, "c", 1.0, 3.0)], "paper_id long, type string, pages double, year double")
    pairs = spark.createDataFrame([("u", 1), ("u", 9), ("v", 2), (None, 3)], "user_id string, paper_id long")
    rows = classify.interaction_table(pairs, papers, 3)
    assert rows.columns == ["user_id", "paper_id", *classify_columns]
    known = {(r.user_id, r.paper_id, r.type, r.pages, r.year, r.user_pages, r.user_papers) for r in rows.where("label = 1").collect()}
    assert known == {("u", 1, "a", 2.0, 1.0, 2.0, 1), ("v", 2, "b", None, 2.0, None, 1)}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner, (paper_id") < plan.index("Join Inner, (user_id")


def test_dataset_and_models(spark):
    papers = spark.createDataFrame(
        [(i, "ab"[i % 2], float(i % 50), 1990.0 + i % 20) for i in range(200)],
        "paper_id long, type string, pages double, year double",
    )
    pairs = spark.createDataFrame(
        [(f"u{u}", p) for u in range(10) for p in range(u, 230, 7)], "user_id string, paper_id long"
    )
    dataset = classify.classification_dataset(pairs, papers)
    counts = {r.label: r["count"] for r in dataset.groupBy("label").count().collect()}
    # Pairs without metadata are gone, and negatives balance what is left.
    assert counts[1] == counts[0] == pairs.filter("paper_id < 200").count()
    scored = {r.model: r.rmse for r in classify.classify_and_score(dataset).collect()}
    assert set(scored) == {"linear_svm", "random_forest"}
    assert all(0 <= x <= 1 for x in scored.values())


def test_models_take_the_mean_for_missing_numbers(spark):
    nan, inf = float("nan"), float("inf")
    made = [(i, i % 2, Vectors.dense(float(i % 2), 3.0, nan if i % 5 == 0 else float(i), nan)) for i in range(40)]
    train = spark.createDataFrame(made, SCHEMA)
    test = spark.createDataFrame([(1, 1, Vectors.dense(1.0, nan, inf, 0.0)), (2, 0, Vectors.sparse(4, {3: 1.0}))], SCHEMA)
    known = [float(i) for i in range(40) if i % 5]
    own, other = (sorted(x.collect()) for x in models.fill_missing(train, test))
    assert own[0].filled.toArray().tolist() == [0.0, 3.0, pytest.approx(sum(known) / len(known)), 0.0]
    assert other[0].filled.toArray().tolist() == [1.0, 3.0, pytest.approx(sum(known) / len(known)), 0.0]
    assert other[1].filled == other[1].features
    for fit in (models.linear_svm, models.random_forest):
        predicted = {r.paper_id: r.prediction for r in fit(train, test).collect()}
        assert predicted == {1: 1.0, 2: 0.0}
