import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from foliorank.llm import ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_words = len(held), sum(n for _, _, n in held)
    out = []
    for item, text in items:
        scored = []
        for i, counts, n in held:
            m, score = 25 + (75 * n * n_docs) // n_words, 0
            for term in terms(text):
                tf = counts.get(term, 0)
                if tf:
                    df = sum(term in c for _, c, _ in held)
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (
                        (1000000000 * tf) // (1000 * tf + 8 * m)
                    )
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def corpus(seed=2):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(60)] + ["Ünïcode", "中文", "The", "the", "a_b", "x-y", "Z9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 40)))) for i in range(300)]
    docs += [(None, docs[3][1]), (None, None), (300, ""), (301, docs[3][1]), (7, docs[7][1]), (302, "the " * 60_000 + "w50")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 8)))) for i in range(40)]
    items += [(5, items[5][1]), (None, "w1 w1 w2"), (90, None), (91, ""), (92, "... --"), (93, "unknown words only")]
    return docs, items


@pytest.mark.parametrize("coordinates, parts", [(1, 3), (16, 1), (1024, 7)])
def test_equals_brute_force(spark, coordinates, parts):
    docs, items = corpus()
    table = spark.createDataFrame([(*d, 0, "z") for d in docs], DOCS + ", rank int, item_id string").repartition(parts)
    asked = spark.createDataFrame([(*i, 1) for i in items], ITEMS + ", doc_id int")
    found = ranked_search.search(table, asked, coordinates=coordinates)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(docs, items)


def test_blocks_of_items(spark, monkeypatch):
    docs, items = corpus(4)
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 7)
    found = ranked_search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k=3)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(docs, items, 3)


def test_nothing(spark):
    docs, items = corpus()
    none, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert ranked_search.search(none, spark.createDataFrame(items, ITEMS)).collect() == []
    assert ranked_search.search(spark.createDataFrame(docs, DOCS), no_items).collect() == []


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(1)
    coordinate = rng.integers(0, 8, 50)
    keys = np.unique(rng.integers(0, 50 * 20, 400))
    impact = rng.integers(1, 10**6, len(keys))
    sketched = ranked_search.sketch(keys, impact, coordinate, 20, 8)
    for key, value in zip(keys, impact):
        assert sketched[coordinate[key % 50], key // 50] >= value
    assert set(sketched[sketched > 0]) <= set(impact)
