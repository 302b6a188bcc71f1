import math

import numpy as np
import pytest

from foliorank.llm import vector_forest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, bound=0.95):
    """n_links and component_id of every row, from all pairs."""
    good = []
    for at, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            u = np.array(v, np.float32).astype(np.float64)
            good.append((at, u / np.sqrt(u @ u)))
    links = {at: set() for at in range(len(rows))}
    by_length = {}
    for at, u in good:
        by_length.setdefault(len(u), []).append((at, u))
    for own in by_length.values():
        names = [at for at, _ in own]
        cosine = np.array([u for _, u in own]) @ np.array([u for _, u in own]).T
        for a, b in zip(*np.nonzero(cosine >= bound)):
            if a != b:
                links[names[a]].add(names[b])
    out, done = [None] * len(rows), set()
    for at in range(len(rows)):
        if at in done:
            continue
        group, stack = {at}, [at]
        while stack:
            for other in links[stack.pop()] - group:
                group.add(other)
                stack.append(other)
        ids = [rows[x][0] for x in group if rows[x][0] is not None]
        for x in group:
            out[x] = (rows[x][0], len(links[x]), min(ids) if ids else None)
        done |= group
    return [(*r, r[0] == r[2]) for r in out]


def spread(rng, centre, angle):
    """A unit vector at ``angle`` from a centre."""
    side = rng.standard_normal(len(centre))
    side -= (side @ centre) * centre
    return math.cos(angle) * centre + math.sin(angle) * side / np.sqrt(side @ side)


def corpus(n=1500, length=16, seed=1):
    rng = np.random.default_rng(seed)

    def unit():
        v = rng.standard_normal(length)
        return v / np.sqrt(v @ v)

    rows = [(i, unit()) for i in range(n)]
    for size, angle in ((400, 0.12), (150, 0.14), (60, 0.02)):
        centre = unit()
        rows += [(len(rows) + i, spread(rng, centre, rng.uniform(0, angle))) for i in range(size)]
        rows += [(len(rows) + i, spread(rng, centre, rng.uniform(0.15, 0.45))) for i in range(40)]
    for i in range(40):
        near = spread(rng, rows[i][1], math.acos(rng.uniform(0.93, 0.999)))
        rows.append((len(rows), near))
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    rows += [(10_000 + i, rows[3][1]) for i in range(30)] + [(5, rows[5][1]), (None, rows[7][1]), (None, rows[n + 2][1])]
    rows += [(20_000, None), (20_001, []), (20_002, [0.0] * length), (20_003, [float("nan")] * length)]
    rows += [(20_004, [1.0, None]), (20_005, [float("inf"), 1.0]), (20_006, [1.0, 2.0]), (20_007, [2.0, 4.0]), (None, None)]
    order = rng.permutation(len(rows))
    return [rows[i] for i in order]


def found(df, **options):
    result = vector_forest.near_vectors(df, **options)
    assert result.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in result.collect()), key=str)


@pytest.mark.parametrize("leaf, trees", [(64, 10), (10_000, 1)])
def test_against_brute_force(spark, leaf, trees):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", label int, key string").repartition(5)
    result = found(df, leaf=leaf, trees=trees)
    expected = sorted(brute(rows), key=str)
    assert len(result) == len(expected)
    if trees == 1:
        assert result == expected
    links, every = sum(r[1] for r in result), sum(r[1] for r in expected)
    assert 0.98 * every <= links <= every
    by_id = {r[0]: r for r in expected}
    for r in result:
        if r[0] is not None and r[0] != 5:
            assert r[1] <= by_id[r[0]][1]
    if trees > 1:
        same = sum(a[2] == b[2] for a, b in zip(result, expected))
        assert same >= 0.99 * len(expected)


def test_blocks_of_a_leaf(spark, monkeypatch):
    monkeypatch.setattr(vector_forest, "BLOCK", 50)
    rows = corpus(300)
    assert found(spark.createDataFrame(rows, SCHEMA), leaf=100_000, trees=2) == sorted(brute(rows), key=str)


def test_balls_are_used_for_crowds(spark):
    rng = np.random.default_rng(3)
    centre = np.eye(32)[0]
    rows = [(i, [float(x) for x in spread(rng, centre, rng.uniform(0, 0.13))]) for i in range(3000)]
    rows += [(5000 + i, [float(x) for x in rng.standard_normal(32)]) for i in range(1500)]
    rows += [(9000 + i, [float(x) for x in spread(rng, centre, rng.uniform(0.16, 0.4))]) for i in range(100)]
    result = found(spark.createDataFrame(rows, SCHEMA), leaf=128, trees=5)
    expected = sorted(brute(rows), key=str)
    links, every = sum(r[1] for r in result), sum(r[1] for r in expected)
    assert 0.99 * every <= links <= every
    assert {r[2] for r in result if r[0] < 3000} == {0}


def test_doubles_and_nothing(spark):
    rows = [(1, [1.0, 0.0]), (2, [1e200, 1e198]), (3, [0.0, -5e-300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(df) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert found(spark.createDataFrame([], SCHEMA)) == []
