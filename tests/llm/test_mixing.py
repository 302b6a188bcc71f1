import random
import re
from collections import Counter

from foliorank.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def corpus(seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(900):
        source = rng.choices(["big", "mid", "tiny", None], [6, 3, 0.3, 1])[0]
        text = " ".join(f"w{rng.randrange(9999)}" for _ in range(rng.randrange(40)))
        rows.append((None if i % 3 == 0 else i, text, source))
    rows += [(5001, None, "mid"), (5002, "", "big"), (None, "a b c " * 20_000, "big")] + [(7, "one two", "mid")] * 50
    return rows


def targets(totals):
    """Rounds of capped shares, as the contract has them: weights 3, 1, 2 by name, null last."""
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, found = 1.5 * sum(totals.values()), set(names), {}
    while open_:
        each = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if each * weight[s] > 2 * totals[s]}
        if not over:
            return found | {s: each * weight[s] for s in open_}
        for s in over:
            found[s] = 2.0 * totals[s]
            left -= found[s]
        open_ -= over
    return found


def test_rows_without_ids_and_repeats(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", taken int").repartition(4)
    found = mixing.mix(df).collect()
    assert len(found) == len(rows)
    totals, taken = Counter(), Counter()
    for _, text, source in rows:
        totals[source] += len(WORD.findall(text or ""))
    expected = targets(totals)
    for r in found:
        assert r.source_size in totals.values() and 0 <= r.taken <= 2 * r.size
    by_size = {v: k for k, v in totals.items()}
    for r in found:
        taken[by_size[r.source_size]] += r.taken
        assert abs(r.target - expected[by_size[r.source_size]]) < 1e-6 * r.target
    assert all(abs(taken[s] - expected[s]) <= 1 for s in totals)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_rows_without_ids_are_spread(spark):
    df = spark.createDataFrame([(None, f"text {i}", "s") for i in range(2000)], SCHEMA)
    assert df.select(mixing._draw(df, 11)).distinct().count() == 2000


def test_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
