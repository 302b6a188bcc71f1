import math
import random

import numpy as np
import pyarrow as pa
import pytest

from foliorank.operators import topics

COUNTS = "paper_id bigint, term_id bigint, tf bigint"


def corpus(seed=5, papers=90):
    """Papers draw their terms from one of three sets of ten, and some from a common set."""
    rng = random.Random(seed)
    rows = {}
    for paper in range(papers):
        for _ in range(60):
            term = 10 * (paper % 3) + rng.randrange(10) if rng.random() < 0.85 else 30 + rng.randrange(5)
            rows[paper, term] = rows.get((paper, term), 0) + 1
    return [(p, t, n) for (p, t), n in rows.items()]


def test_planted_topics_are_found_and_likelihood_rises(spark):
    lists = topics.count_lists(spark.createDataFrame(corpus(), COUNTS))
    fitted, likelihoods = topics.fit_topics(lists, k=4, steps=40, seed=2)
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(likelihoods[2:], likelihoods[3:]))
    assert likelihoods[-1] > likelihoods[0]
    shares = {r.paper_id: r.vector for r in topics.topic_shares(lists, fitted).collect()}
    assert set(shares) == set(range(90))
    assert all(sum(v) == pytest.approx(1) and min(v) > 0 for v in shares.values())

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    same = [cosine(shares[p], shares[p + 3]) for p in range(60)]
    other = [cosine(shares[p], shares[p + 1]) for p in range(60)]
    assert sum(same) / 60 > sum(other) / 60 + 0.2


def test_partitions_do_not_matter(spark):
    rows = corpus(7)
    found = []
    for parts in (1, 6):
        df = spark.createDataFrame(rows, COUNTS).repartition(parts)
        vectors = topics.topic_vectors_by_steps(df, k=5, steps=4).collect()
        found.append({r.paper_id: r.vector for r in vectors})
    for paper, vector in found[0].items():
        assert vector == pytest.approx(found[1][paper], rel=1e-9)


def test_limits_and_nothing(spark, monkeypatch):
    assert topics.topic_vectors_by_steps(spark.createDataFrame([], COUNTS)).collect() == []
    monkeypatch.setattr(topics, "MAX_TOPIC_NUMBERS", 100)
    with pytest.raises(ValueError, match="fewer terms"):
        topics.topic_vectors_by_steps(spark.createDataFrame(corpus(), COUNTS), k=40)


def test_papers_of_any_size_settle_as_one_by_one(monkeypatch):
    """Papers share products by size; shares and expected counts are those of a plain loop over papers."""
    rng = np.random.default_rng(4)
    sizes = np.array([1, 300, 2, 40, 41, 3, 90, 1, 39])
    lists = [(rng.integers(0, 50, n), rng.integers(1, 6, n).astype(float)) for n in sizes]
    model = topics._Topics(np.arange(50), rng.random((50, 4)), 5)
    papers, counts = [], np.zeros((50, 4))
    for terms, seen in lists:
        share = np.full(4, 0.25)
        for _ in range(5):
            share = share * ((seen / (model.shares[terms] @ share)) @ model.shares[terms])
            share = (share + 0.25) / (seen.sum() + 1)
        joint = model.shares[terms] * share
        np.add.at(counts, terms, joint * (seen / joint.sum(1))[:, None])
        papers.append(share)
    batch = pa.RecordBatch.from_pydict(
        {"terms": pa.array([t for t, _ in lists], pa.list_(pa.int64())), "counts": pa.array([n for _, n in lists], pa.list_(pa.float64()))}
    )
    for product, chunk in ((1 << 11, 1 << 15), (50, 100), (1, 1)):
        monkeypatch.setattr(topics, "_PRODUCT", product)
        monkeypatch.setattr(topics, "_CHUNK", chunk)
        assert np.allclose(np.concatenate([c[2] for c in model.chunks(batch)]), papers, rtol=1e-12)
        rows = next(topics._expected(model)([batch]))
        place, found = rows["place"].to_numpy()[1:], np.array(rows["counts"].to_pylist())[1:]
        assert np.allclose(found, counts[place], rtol=1e-12) and set(place) == set(np.flatnonzero(counts.any(1)))
