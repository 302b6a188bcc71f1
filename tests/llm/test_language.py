import math
import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np

from foliorank.llm import language

SYLLABLES = {
    "de": ["sch", "ung", "ein", "über", "keit", "ach"],
    "en": ["th", "ing", "tion", "ould", "er", "wh"],
    "fr": ["eau", "é", "ç", "elle", "oi", "ment"],
}


def corpus(seed, n=240):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.choice([1, 2, 3]))) for _ in range(rng.choice([3, 20, 80]))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_held_out_texts_and_edge_cases(spark):
    rows = corpus(1) + [(900, None, "en"), (901, "", "de"), (902, "123 !?", "fr"), (903, "thing tion", None), (None, "schung ein", "xx")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    found = {r.doc_id: r for r in language.identify(df.repartition(3)).collect()}
    assert len(found) == len(rows)
    out = [(i, lang) for i, _, lang in rows[:240] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(found[i].held_out for i, _ in out) and len(out) > 40
    assert sum(found[i].lang_pred == lang for i, lang in out) >= 0.97 * len(out)
    assert [found[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert [found[i].score for i in (900, 901, 902)] == [0.0] * 3
    assert found[903].lang_pred == "en" and found[None].lang_pred == "de" and not found[None].held_out
    assert all(0 <= r.score <= 1 for r in found.values())


def test_one_language_none_and_nothing(spark):
    df = spark.createDataFrame([(i, "thing", "en") for i in range(9)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language.identify(df).collect()} == {("en", 1.0)}
    none = df.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {(r.lang_pred, r.score) for r in language.identify(none).collect()} == {("und", 0.0)}
    assert language.identify(df.limit(0)).collect() == []


def test_codewords_differ():
    for n in (2, 3, 4, 7, 12, 40):
        code = language.codewords(n)
        assert len({tuple(c) for c in code}) == n and set(np.unique(code)) == {-1, 1}
        assert (np.abs(code.sum(axis=0)) < n).all()


def grams(text):
    framed = b" " + bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode()) + b" "
    for n in (2, 4):
        for i in range(len(framed) - n + 1):
            key = int.from_bytes(framed[i : i + n], "little")
            mixed = ((key + n) * 0x9E3779B1 & 0xFFFFFFFF) ^ (key >> 13)
            yield (mixed * 0x85EBCA6B & 0xFFFFFFFF) >> 17


def brute(rows, sharpness=8.0, lead=0.2):
    """Counts, weights, reliability, loss and choice, one number after the other."""
    training = [(t, lang) for i, t, lang in rows if i is not None and zlib.crc32(str(i).encode()) % 3 != 1 and lang and any(c.isalpha() for c in t or "")]
    names = sorted({lang for _, lang in training}, key=str.encode)
    counts = {name: Counter() for name in names}
    for text, lang in training:
        counts[lang].update(grams(text))
    totals = {name: sum(counts[name].values()) for name in names}
    code = language.codewords(len(names))

    def share(name, bucket):
        return (counts[name][bucket] + 0.05) / (totals[name] + 0.05 * language.BUCKETS)

    @lru_cache(None)
    def weight(bit, bucket):
        sides = [[share(n, bucket) for n, row in zip(names, code) if row[bit] == side] for side in (1, -1)]
        return math.log(sum(sides[0]) / len(sides[0])) - math.log(sum(sides[1]) / len(sides[1]))

    def margin(text):
        found = list(grams(text))
        return [sum(weight(bit, b) for b in found) / len(found) for bit in range(code.shape[1])]

    hits, seen = np.ones(code.shape), np.full(len(names), 2.0)
    for text, lang in training:
        own = names.index(lang)
        seen[own] += 1
        for bit, m in enumerate(margin(text)):
            hits[own, bit] += (m > 0) - (m < 0) == code[own, bit]
    reliability = hits / seen[:, None]
    out = []
    for i, text, _ in rows:
        out_of = i is not None and zlib.crc32(str(i).encode()) % 3 == 1
        if not any(c.isalpha() for c in text or ""):
            out.append((i, out_of, "und", 0.0, False))
            continue
        ms = margin(text)
        losses = []
        for row, trust in zip(code, reliability):
            losses.append(sum(math.log1p(math.exp(-sharpness * m * c)) * r / sum(trust) for m, c, r in zip(ms, row, trust)))
        best = min(range(len(names)), key=lambda k: losses[k])
        second = sorted(losses)[1]
        score = 1 / sum(math.exp(losses[best] - x) for x in losses)
        out.append((i, out_of, names[best], score, second - losses[best] < lead))
    return out


def test_equals_brute_force(spark):
    rows = corpus(3, 90)
    rows += [(500, rows[1][1], "fr"), (500, rows[1][1], "fr"), rows[4], (None, rows[2][1], "de"), (501, None, "en"), (502, "", "de")]
    rows += [(503, "7 9", "en"), (504, "schung thing eau " * 4000, None), (505, "ÜBER keit", "de"), (506, "zzz", "nl"), (507, "qqq ing", "nl")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = sorted((tuple(r) for r in language.identify(df).collect()), key=str)
    expected = sorted(brute(rows), key=str)
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert (a[0], a[1], a[2], a[4]) == (b[0], b[1], b[2], b[4]) and abs(a[3] - b[3]) < 1e-9
