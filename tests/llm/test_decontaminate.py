import random
import re

import numpy as np

from foliorank.llm import decontaminate

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smith_waterman(a, b):
    best, before = 0, [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b, 1):
            now.append(max(0, before[j - 1] + (2 if x == y else -1), before[j] - 1, now[j - 1] - 1))
        best, before = max(best, max(now)), now
    return best


def brute(documents, items, n=3, min_score=0.5):
    """Aligns every item with every whole document that shares an n-gram with it."""
    found = {}
    for d, text in documents:
        words = WORD.findall((text or "").lower())
        grams = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        for i, item in items:
            own = WORD.findall((item or "").lower())
            if not any(tuple(own[j : j + n]) in grams for j in range(len(own) - n + 1)):
                continue
            score = smith_waterman(own, words)
            if score >= max(min_score * 2 * len(own), 2 * min(8, len(own))):
                found[d, i] = score / (2 * len(own))
    return found


def edited(words, rng, share):
    out = []
    for w in words:
        r = rng.random()
        out += [] if r < share / 3 else [w, "extra"] if r < 2 * share / 3 else ["other"] if r < share else [w]
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)] + ["the", "of", "and"] * 300
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([10, 20, 40, 70])))) for i in range(25)]
    documents = []
    for i in range(250):
        body = rng.choices(vocabulary, k=rng.choice([5, 50, 300]))
        if i % 3 == 0:
            item = rng.choice(items)[1].split()
            at = rng.randrange(len(body))
            body[at:at] = edited(item, rng, rng.choice([0, 0.1, 0.2, 0.6]))
        documents.append((i, " ".join(body).upper() if i % 7 == 0 else " ".join(body)))
    return documents, items


def test_pairs_equal_whole_alignment(spark):
    documents, items = corpus(2)
    documents += [(300, None), (301, ""), (302, items[3][1]), (303, " ".join(items[3][1].split()[:4]))]
    items += [(90, None), (91, ""), (92, "of the"), (93, items[3][1])]
    a = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(documents, items)
    for block in (1 << 20, 2000):
        found = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_copies(a, b, block_bytes=block).collect()}
        assert found == expected
    assert (302, 93) in expected and len(expected) > 40


def test_an_item_that_leaked_everywhere_is_still_found(spark):
    documents, items = corpus(4)
    documents = [(i, f"{t} {items[0][1]}") for i, t in documents]
    a = spark.createDataFrame(documents, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_copies(a, b).collect()}
    assert {(i, 0) for i, _ in documents} <= found


def test_nothing_and_clashing_columns(spark):
    a = spark.createDataFrame([(1, "a b c d e f g h", 1)], "doc_id long, text string, row int")
    b = spark.createDataFrame([(None, "a b c d e f g h", "x")], "item_id long, text string, score string")
    assert [(r.doc_id, r.item_id, r.score) for r in decontaminate.find_copies(a, b).collect()] == [(1, None, 1.0)]
    assert decontaminate.find_copies(a.limit(0), b).collect() == []
    assert decontaminate.find_copies(a, b.limit(0)).collect() == []


def test_align_by_hand():
    items = np.array([[5, 6, 7, 8, 0]], np.uint64)
    windows = np.array([[9, 5, 6, 9, 7, 8, 1, 1]], np.uint64)
    assert decontaminate.align(items, windows).tolist() == [7]


def test_edited_copies_of_an_item_in_many_documents(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=15))) for i in range(4)]
    documents = []
    for i in range(240):
        body = rng.choices(vocabulary, k=40)
        own = items[i % 2][1].split()
        copy = own if i < 80 else [w if rng.random() > 0.2 else f"other{i}" for w in own]
        documents.append((i, " ".join(body[:20] + copy + body[20:])))
    a = spark.createDataFrame(documents, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(documents, items)
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_copies(a, b).collect()}
    assert found == expected
    assert len(expected) > 200


def test_a_common_trigram_of_all_items_in_slices(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "HITS", 7)
    documents, items = corpus(8)
    items = [(i, f"which of the {t}") for i, t in items[:12]]
    documents = [(i, f"which of the which of the {t}") for i, t in documents[:60]]
    a = spark.createDataFrame(documents, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_copies(a, b).collect()}
    assert found == brute(documents, items) and found


def test_copies_cut_into_pieces(spark):
    """Foreign words between the pieces of an item cost their alignment, nothing more."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(5000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate((100, 100, 60, 24))]
    documents = []
    for foreign in (5, 20, 30, 40, 45, 48, 60, 90):
        for item, text in items:
            for pieces in (2, 3, 4):
                own = text.split()
                cuts = [round(len(own) * j / pieces) for j in range(pieces + 1)]
                body = rng.choices(vocabulary, k=30)
                for a, b in zip(cuts, cuts[1:]):
                    body += own[a:b] + [f"x{rng.random()}" for _ in range(foreign)]
                documents.append((len(documents), " ".join(body)))
    a = spark.createDataFrame(documents, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(documents, items)
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_copies(a, b).collect()}
    assert found == expected and 20 < len(expected) < len(documents)


def test_null_ids_repeats_and_long_texts(spark):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(500)]
    item = " ".join(f"i{i}" for i in range(40))
    long = " ".join(rng.choices(vocabulary, k=200_000))
    documents = [(None, item), (None, f"{long} {item} {long}"), (3, item), (3, item), (4, long)]
    a = spark.createDataFrame(documents, "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = sorted(((r.doc_id, r.item_id, r.score) for r in decontaminate.find_copies(a, b).collect()), key=str)
    assert found == [(3, 1, 1.0), (3, 1, 1.0), (None, 1, 1.0), (None, 1, 1.0)]
