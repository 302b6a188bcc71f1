import random

import pytest

from foliorank.operators import frequent, terms

LISTS = "paper_id bigint, words array<string>"


def corpus(seed=1, papers=400):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(2000)]
    weights = [1 / (i + 2) for i in range(2000)]
    rows = [(p, rng.choices(vocabulary, weights, k=rng.randrange(30)) + [f"once{p}", "all"]) for p in range(papers)]
    return rows + [(papers, None), (papers + 1, [])]


@pytest.mark.parametrize("counters", [8, 200, 100_000])
@pytest.mark.parametrize("band", [(1, None), (5, 80), (90, None)])
def test_equals_the_exact_count(spark, counters, band):
    least, most = band
    words = spark.createDataFrame(corpus(), LISTS).repartition(6)
    exact = terms.document_frequency(words).where(f"df >= {least}")
    if most is not None:
        exact = exact.where(f"df <= {most}")
    found = frequent.frequent_terms(words, 25, least, most, counters)
    assert sorted(found.collect()) == sorted(terms.top_terms(exact, 25).collect())


def test_nothing(spark):
    assert frequent.frequent_terms(spark.createDataFrame([], LISTS)).collect() == []
