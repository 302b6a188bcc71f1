import random
import re

import numpy as np
import pytest

from foliorank.llm import jaccard
from foliorank.llm.text_arrays import split_words, word_grams

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k, numerator, denominator):
    sets = [(i, shingles(t, k)) for i, t in rows]
    label = {i: i for i, _ in rows}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for x in range(len(sets)):
        for y in range(x):
            (i, a), (j, b) = sets[x], sets[y]
            if a and b and denominator * len(a & b) >= numerator * len(a | b):
                p, q = root(i), root(j)
                label[max(p, q)] = min(p, q)
    return {i: (len(s), root(i)) for i, s in sets}


def edited(words, rng, share):
    return [rng.choice("lorem ipsum dolor sit amet".split()) + str(rng.random()) if rng.random() < share else w for w in words]


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    for _ in range(60):
        texts.append(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 8, 60, 120])))
    for base in texts[:20]:
        for _ in range(3):
            texts.append(edited(base, rng, rng.choice([0, 0.01, 0.03, 0.05])))
    hub = rng.choices(vocabulary, k=90)
    texts += [edited(hub, rng, rng.choice([0.01, 0.02, 0.04])) for _ in range(80)]
    texts += [rng.choices(vocabulary, k=60) + passage for _ in range(60)]
    rows = [(i * 7 % 1009, " ".join(w).upper() if i % 5 == 0 else " ".join(w)) for i, w in enumerate(texts)]
    return rows + [(2001, None), (2002, ""), (2003, " \n\t "), (2004, "one"), (2005, "One"), (2006, "one two")]


@pytest.mark.parametrize("k,numerator,rows_per_region", [(4, 85, 512), (5, 80, 512), (4, 85, 10)])
def test_components_equal_brute_force(spark, monkeypatch, k, numerator, rows_per_region):
    monkeypatch.setattr(jaccard, "REGION_ROWS", rows_per_region)
    rows = corpus(k + rows_per_region)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {
        r.doc_id: (r.n_shingles, r.component_id)
        for r in jaccard.jaccard_components(df, k, numerator, 100).collect()
    }
    assert found == brute(rows, k, numerator, 100)


def test_local_recursion_is_exact_on_a_tight_group():
    rng = random.Random(5)
    hub = [f"w{i}" for i in range(150)]
    sets = [shingles(" ".join(edited(hub, rng, 0.02)), 4) for _ in range(150)]
    ids = {s: n for n, s in enumerate(sorted(set().union(*sets)))}
    sizes = np.array([len(s) for s in sets])
    tokens = np.concatenate([[ids[t] for t in s] for s in sets])
    pairs = jaccard.region_links(tokens, np.cumsum(sizes) - sizes, sizes, np.arange(len(sets)), 85, 100)
    assert len(pairs) < len(sets)
    label = list(range(len(sets)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in pairs:
        assert len(sets[a] & sets[b]) * 100 >= 85 * len(sets[a] | sets[b])
        label[root(a)] = root(b)
    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a] & sets[b]) * 100 >= 85 * len(sets[a] | sets[b]):
                assert root(a) == root(b)


def test_repeated_ids_extra_columns_and_nothing(spark):
    rows = [(1, "a b c d e", "x"), (1, "a b c d e", "y"), (None, "a b c d e", "z"), (5, "A b c D e", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = sorted(jaccard.jaccard_components(df).collect(), key=lambda r: r.doc_id or 0)
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in found] == [
        (None, 1, 1), (1, 1, 1), (1, 1, 1), (5, 1, 1),
    ]
    assert jaccard.jaccard_components(df.limit(0)).collect() == []


def test_words_and_grams_by_hand():
    data = "Aa b\x0bC  aa B c".encode()
    words = split_words(np.frombuffer(data, np.uint8), np.array([0, 7, 7, len(data)]))
    assert words.counts.tolist() == [3, 0, 3]
    assert words.hashes[:3].tolist() == words.hashes[3:].tolist()
    grams, owner = word_grams(words, 4)
    assert owner.tolist() == [0, 2] and grams[0] == grams[1]


@pytest.mark.parametrize("rows_per_region", [512, 2])
def test_near_copies_without_an_id_link_others(spark, monkeypatch, rows_per_region):
    monkeypatch.setattr(jaccard, "REGION_ROWS", rows_per_region)
    rng = random.Random(11)
    rows, named = [], []
    for n in range(12):
        words = [f"w{n}x{rng.random()}" for _ in range(90)]
        # Each step changes six words at one end: neighbours link at 0.85, the ends of the chain do not.
        head, tail = ([f"{c}{n}z{j}" for j in range(6)] for c in "hy")
        chain = [words, head + words[6:], head + words[6:84] + tail]
        chain = [" ".join(c) for c in chain]
        ids = [10 * n + 5, None, 10 * n + 3] if n % 3 else [None, None, None]
        rows += list(zip(ids, chain, strict=True))
        named += list(zip([1000 * n + i for i in range(3)], chain, strict=True))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(map(tuple, jaccard.jaccard_components(df, 4, 85, 100).drop("row").collect()), key=str)
    groups = {}
    for (i, _), (key, (n, root)) in zip(rows, brute(named, 4, 85, 100).items(), strict=True):
        groups.setdefault(root, []).append((i, n))
    assert all(len(g) == 3 for g in groups.values())
    expected = []
    for g in groups.values():
        ids = [i for i, _ in g if i is not None]
        expected += [(i, n, min(ids) if ids else None) for i, n in g]
    assert found == sorted(expected, key=str)
    assert sum(1 for i, _, c in found if i is None and c is not None) == 8
