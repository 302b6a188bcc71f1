import hashlib
import random

import numpy as np
import pytest

from foliorank.llm import suffixes


def brute(rows, length=50):
    first = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if i is not None:
                first[w] = min(first.get(w, i), i)
    found = []
    for i, b in raw:
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if i is not None and first[b[s : s + length]] < i:
                gone[s : s + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        found.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "of", "été", "größe", "and", "tion", "er", "x"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice("abcdefgh") for _ in range(n))
    passages = [text(rng.choice([9, 12, 20, 40])) for _ in range(5)]
    rows = []
    for i in range(120):
        parts = [text(rng.choice([0, 1, 5, 30])) for _ in range(3)]
        for p in rng.sample(passages, rng.choice([0, 1, 2])):
            cut = rng.randrange(20)
            parts.insert(rng.randrange(4), p[cut:] if rng.random() < 0.5 else p)
        rows.append((rng.randrange(10_000), " ".join(parts)))
    rows += [(i + 20_000, t) for i, t in rows[:15]]
    rows += [(5, "a" * 130), (6, "a" * 49), (7, "a" * 50), (8, "b" + "a" * 80 + "c"), (9, "ab" * 60), (10, "ba" * 40)]
    rows += [(None, "a" * 130), (11, None), (12, ""), rows[0], (rows[1][0], rows[2][1])]
    return rows


@pytest.mark.parametrize("crowded", [None, 3])
def test_removed_bytes_equal_brute_force(spark, crowded):
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted((tuple(r) for r in suffixes.remove_repeats(df, crowded=crowded).collect()), key=str)
    assert found == brute(rows)


def test_kept_text_is_text(spark):
    rows = [(1, "é" * 60), (2, "xy " + "é" * 60 + "z"), (3, "née-" + "é" * 30 + " tail")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.kept_text for r in suffixes.remove_repeats(df, kept_text=True).collect()}
    assert left == {1: "é" * 60, 2: "xy z", 3: "née- tail"}


def test_nothing_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "t", 2, 3)], "doc_id long, text string, row int, spans int")
    assert [r.n_bytes for r in suffixes.remove_repeats(df).collect()] == [1]
    assert suffixes.remove_repeats(df.limit(0)).collect() == []


def prefix(a, b):
    return next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def test_columns_sort_all_suffixes():
    rng = random.Random(1)
    strings = ["".join(rng.choices("ab", k=rng.randrange(12))).encode() for _ in range(200)]
    tails = ["".join(rng.choices("xy", k=rng.randrange(1, 9))).encode() for _ in range(200)]
    padded = np.array([list(t.ljust(8, b"x")) for t in tails], np.uint8)
    order, common = suffixes.tail_order(np.zeros(200, np.int64), padded, np.array([len(t) for t in tails]))
    data = np.frombuffer(b"".join(strings), np.uint8)
    lengths = np.array([len(s) for s in strings])
    owner, before, common = suffixes.suffix_columns(data, lengths, order, common)
    assert len(set(zip(owner.tolist(), before.tolist()))) == len(owner) == len(data) + 200
    # Tails stand first; any other order is by bytes.
    found = [strings[o][len(strings[o]) - n :] + b"\0" + tails[o] for o, n in zip(owner, before)]
    assert found == sorted(found)
    for i in range(1, len(found)):
        one, two = (found[k].replace(b"\0", b"") for k in (i - 1, i))
        if (before[i - 1] == 0) == (before[i] == 0):
            assert common[i] == prefix(one, two) or (found[i - 1][:1] == b"\0") != (found[i][:1] == b"\0")


def test_a_border_anchor_with_many_contexts_stays_in_no_task(spark, monkeypatch):
    rng = random.Random(9)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(30))
    own = lambda: " ".join(f"q{rng.randrange(10**9)}" for _ in range(12))
    rows = [(i, f"{own()} {passage} {own()}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sizes, ordered = [], suffixes._ordered_runs

    def watched(segments, *rest):
        sizes.append(segments.groupBy("key").count().agg({"count": "max"}).first()[0] or 0)
        return ordered(segments, *rest)

    monkeypatch.setattr(suffixes, "_ordered_runs", watched)
    found = sorted((tuple(r) for r in suffixes.remove_repeats(df, crowded=10).collect()), key=str)
    assert found == brute(rows)
    assert sizes and max(sizes) <= 10
