from collections import Counter

from pyspark.sql import functions as F

from foliorank.operators import joins


def tables(spark):
    left = [(i, 7 if i % 3 == 0 else i) for i in range(6000)] + [(9000, None)]
    right = [(k, f"p{k}") for k in range(5000)] + [(7, "again"), (None, "none")]
    return (
        spark.createDataFrame(left, "user_id long, paper_id long").repartition(6),
        spark.createDataFrame(right, "paper_id long, title string").repartition(4),
    )


def test_equals_a_plain_join(spark):
    left, right = tables(spark)
    heavy = joins.heavy_keys(left, "paper_id", 100)
    assert [(r.paper_id, r._salts) for r in heavy.collect()] == [(7, 21)]
    found = joins.join_heavy(left, right, "paper_id", heavy)
    assert found.columns == ["paper_id", "user_id", "title"]
    assert Counter(found.collect()) == Counter(left.join(right, "paper_id").collect())
    assert joins.heavy_keys(left, "paper_id", 3000) is None and joins.heavy_keys(left, "paper_id") is None


def test_a_third_of_the_rows_is_spread(spark):
    left, right = tables(spark)
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        joined = joins.join_heavy(left, right, "paper_id", joins.heavy_keys(left, "paper_id", 20))
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(sizes) == 16 and sizes[-1] < 3 * sizes[8]
