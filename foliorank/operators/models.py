"""Classifiers on (label, features) and their error."""

from pyspark.ml.classification import LinearSVC, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The settings of the two classifiers.
SVM_ITERATIONS = 5
SVM_REGULARISATION = 0.01
FOREST_TREES = 3
FOREST_DEPTH = 2
FOREST_SEED = 42


def _missing(x: Column) -> Column:
    return F.isnan(x) | (F.abs(x) == float("inf"))


def fill_missing(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both parts with ``filled``: ``features`` whose missing numbers are the mean over the train part.

    The classifiers refuse NaN and infinities, which a user without any known number has. A place
    that no train row knows becomes 0. Rows without a missing number keep their vector.
    """
    values = vector_to_array("features")
    places = F.explode(F.array_compact(F.transform(values, lambda x, i: F.when(_missing(x), i))))
    found = sorted(r[0] for r in train.select(places).union(test.select(places)).distinct().collect())
    if not found:
        return train.withColumn("filled", F.col("features")), test.withColumn("filled", F.col("features"))
    known = train.select(values.alias("v")).select(*[F.col("v")[i].alias(f"_{i}") for i in found])
    means = known.agg(*[F.avg(F.when(~_missing(F.col(c)), F.col(c))).alias(c) for c in known.columns]).first()
    by_place = F.create_map(*[F.lit(x) for i in found for x in (i, means[f"_{i}"] or 0.0)])
    put = F.transform(values, lambda x, i: F.when(_missing(x), by_place[i]).otherwise(x))
    filled = F.when(F.exists(values, _missing), array_to_vector(put)).otherwise(F.col("features"))
    return train.withColumn("filled", filled), test.withColumn("filled", filled)


def linear_svm(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test rows with the prediction of a linear support vector machine."""
    train, test = fill_missing(train, test)
    svm = LinearSVC(maxIter=SVM_ITERATIONS, regParam=SVM_REGULARISATION, featuresCol="filled")
    return svm.fit(train).transform(test).drop("filled")


def random_forest(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test rows with the prediction of a random forest."""
    train, test = fill_missing(train, test)
    forest = RandomForestClassifier(
        numTrees=FOREST_TREES, maxDepth=FOREST_DEPTH, seed=FOREST_SEED, labelCol="label", featuresCol="filled"
    )
    return forest.fit(train).transform(test).drop("filled")


def rmse(predictions: DataFrame) -> DataFrame:
    """Root of the mean squared difference of label and prediction, as one row."""
    error = F.col("label") - F.col("prediction")
    return predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"))
