import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import corpus_pipeline
from foliorank.llm import mixing, quality, url_filters

from .test_decontaminate import brute as leaks
from .test_jaccard import brute as near
from .test_suffixes import brute as repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        text.count("!"), sum(w.lower() in quality.STOP_WORDS for w in words), len(lines),
    )


def judged(text):
    n, chars, symbols, dup, repeat, bangs, stops, lines = measures(text)
    failed = n < 50 or 100 * repeat > 50 * n
    kept = not failed and 2 <= chars / n <= 15 and symbols / n <= 0.5 and bangs / n <= 0.5 and stops / n >= 0.01 and dup / lines <= 0.5
    return (n, chars, symbols, dup, repeat, failed, kept)


def targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), epochs=2):
    """Water-filling by rounds: clamp, hand the excess out again, until all fit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, found = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > epochs * sizes[s]]
        if not over:
            return found | {s: level * weight[s] for s in free}
        for s in over:
            found[s] = Fraction(epochs * sizes[s])
            left -= found[s]
            free.remove(s)
    return found


def mixed(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((hashlib.md5(("11|" + str(r[0])).encode()).hexdigest(), len(WORD.findall(r[1] or "")), r[0]))
    goal, taken = targets({s: sum(x[1] for x in own) for s, own in by.items()}), {}
    for s, own in by.items():
        size = sum(x[1] for x in own)
        whole = goal[s] // size if size else 0
        room = round(float(goal[s])) - whole * size
        for _, n, i in sorted(own):
            part = max(0, min(n, room))
            taken[i], room = whole * n + part, room - n
    return goal, taken


def corpus(seed):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(900)]
    vocabulary = "the of and to in is that".split() * 15 + words
    items = [(i, " ".join(rng.choices(words, k=25))) for i in range(6)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    rows = []
    for i in range(150):
        words = rng.choices(vocabulary, k=rng.choice([10, 80, 150]))
        if i % 9 == 0:
            words[20:20] = rng.choice(items)[1].split()
        if i % 10 == 1:
            words[30:30] = passage.split()
        if i % 11 == 2:
            words = [w + "###" for w in words]
        if i % 13 == 3:
            words = [w.upper() + "!!" for w in words]
        text = " ".join(words)
        if i % 17 == 4:
            text = "\n".join([" ".join(words[:6])] * 12)
        rows.append((i, text, "en", [None, "a", "b", "é", "z"][min(4, rng.randrange(12))], len(text)))
    for i in range(0, 150, 5):
        words = rows[i][1].split(" ")
        words[len(words) // 2] = "edited"
        rows.append((500 + i, " ".join(words), "en", "a", 0))
    rows += [(900 + i, rows[i][1], None, "b", 5) for i in range(0, 60, 4)]
    return rows + [(980, None, None, "b", None), (981, "", None, None, 0)], items


def test_all_stages_equal_brute_force(spark, tmp_path):
    rows, items = corpus(1)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [r for r in rows if judged(r[1])[-1]]
    group = near([r[:2] for r in kept], 5, 80, 100)
    kept = [r for r in kept if group[r[0]][1] == r[0]]
    first, docs = {}, []
    for r in sorted(kept):
        b, gone = r[1].encode(), [False] * len(r[1].encode())
        for s in range(len(b) - 49):
            if first.setdefault(b[s : s + 50], r[0]) != r[0]:
                gone[s : s + 50] = [True] * 50
        text = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        if WORD.search(text):
            docs.append((r[0], text, r[2], r[3], len(text) if any(gone) else r[4]))
    assert {i: n for i, _, n, _, _ in repeats([r[:2] for r in kept])} and len(docs) < len(rows)
    bad = {d for d, _ in leaks([d[:2] for d in docs], items)}
    docs = [d for d in docs if d[0] not in bad]
    assert bad and any(d[4] != r[4] for d in docs for r in rows if d[0] == r[0])
    goal, taken = mixed(docs)
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.text, r.lang, r.source, r.n_chars, r.taken) for r in found} == {
        d[0]: (*d[1:], taken[d[0]]) for d in docs if taken[d[0]]
    }
    assert all(abs(r.target - float(goal[r.source])) < 1e-6 for r in found)


def test_repeated_rows_null_ids_and_no_documents(spark, tmp_path):
    text = " ".join(f"the word{i}" for i in range(60))
    rows = [(3, text, "en", "a", 1)] * 3 + [(None, text, "en", "a", 1), (None, text.replace("word", "x"), None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted((r.doc_id or 0) for r in corpus_pipeline.near_duplicates(spark, df, "").collect()) == [0, 3]
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.limit(0), str(tmp_path)).collect() == []


def test_quality_measures_equal_plain_code(spark):
    rows, _ = corpus(3)
    rows = [*rows, (990, " \n\t ", None, None, 1), (991, "a a a a", None, None, 1), (992, "word\n" * 70 + "é " * 60, None, None, 1)]
    found = quality.judge(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("n_chars", "n_words"))
    assert sorted(tuple(r) for r in found.collect()) == sorted((r[0], *judged(r[1])) for r in rows)


def test_mix_equals_rounds_of_water_filling(spark):
    rows, _ = corpus(4)
    rows += [(700 + i, "one " * 4000, None, "huge", 1) for i in range(5)] + [(710, None, None, "empty", 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("n_chars", "taken").repartition(4)
    found = mixing.mix(df).collect()
    goal, taken = mixed(rows)
    assert {r.doc_id: r.taken for r in found} == taken
    by, sizes = defaultdict(int), {r.doc_id: r.size for r in found}
    for r in found:
        assert 0 <= r.taken <= 2 * sizes[r.doc_id]
        by[r.target] += 0
    assert len(by) >= 4 and mixing.mix(df.limit(0)).collect() == []


def test_url_verdicts(spark):
    canon = '<link href="{}" rel="canonical">'
    rows = [
        (1, "http://a.org/x#t", canon.format("https://b.net/es/1")),
        (2, "https://b.net/es/1?q=1", None),
        (3, "HTTP://WWW.Example.COM/en/7", canon.format("http://x.net/fr/2")),
        (4, "http://example.com/en/", "<p>"),
        (5, "http://example.community/en/", ""),
        (6, "//no.scheme/x", "x"),
        (7, None, None),
        (8, "http://c.org/a?b://c", '<meta content="0; url=/moved" http-equiv=refresh>'),
        (9, "http://c.org/moved", canon.format("//a.org/x")),
        (10, "http://user.com", canon.format("http://b.net/es/1")),
        (None, "http://a.org/x", "<p>"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int")
    found = {r.page_id: tuple(r)[1:] for r in url_filters.judge_urls(df).collect()}
    assert found == {
        1: ("a.org", "/x", None, "block"),
        2: ("b.net", "/es/1", "net/es/", "block"),
        3: ("www.example.com", "/en/7", "www.example.com/en/", "allow"),
        4: ("example.com", "/en/", "example.com/en/", "block"),
        5: ("example.community", "/en/", None, "allow"),
        6: ("", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("c.org", "/a", None, "block"),
        9: ("c.org", "/moved", None, "block"),
        10: ("user.com", "", None, "block"),
        None: ("a.org", "/x", None, "block"),
    }
    assert url_filters.judge_urls(df.limit(0)).collect() == []
    log = spark.createDataFrame([("http://one.org/", "http://two.org/"), ("http://two.org/", "http://z.net/fr/")], "url string, target string")
    pages = spark.createDataFrame([(1, "http://one.org/", ""), (2, "http://three.org/", None)], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in url_filters.judge_urls(pages, redirects=log).collect()} == {1: "block", 2: "allow"}


def test_relative_and_repeated_alias_targets(spark):
    canon, refresh = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    blocked = "http://b.net/es/1"
    links = [
        ("moved.html", "/d/moved.html"), ("./a", "/d/a"), ("../a", "/a"), ("../../../up/", "/up/"), ("?id=2", "/d/p?id=2"),
        ("e/../f/.", "/d/f/"), ("/r/./s/../t?x=/../y", "/r/t?x=/../y"), ("/go?u=https://x.net/es/1", "/go?u=https://x.net/es/1"),
        ("go?u=https://x.net/es/1", "/d/go?u=https://x.net/es/1"), ("a:b/../c", None), ("mailto:x@y.org", None), ("#top", None),
    ]
    rows = []
    for i, (link, target) in enumerate(links):
        rows.append((i, f"http://s{i}.org/d/p?q=1#f", (canon if i % 2 else refresh).format(link)))
        if target:
            rows.append((100 + i, f"https://s{i}.org{target}", canon.format(blocked)))
    rows += [
        (50, "http://two.org/a", canon.format("/b") + refresh.format("/c") + canon.format(blocked)),
        (51, "http://three.org", refresh.format("/b") + refresh.format("https://b.net/fr/9") + "<p>"),
        (52, "http://four.org", canon.format("x")),
        (53, "http://four.org/x", canon.format(blocked)),
        (54, "http://two.org/c", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.verdict for r in url_filters.judge_urls(df).collect()}
    assert {i: found[i] for i in range(len(links))} == {i: "block" if t else "allow" for i, (_, t) in enumerate(links)}
    assert {found[i] for i in (50, 51, 52, 53, 54)} == {"block"}
    # The url inside a query is not the target: without the page behind it nothing is blocked.
    clean = spark.createDataFrame([(1, "http://c.org/a", canon.format("/go?u=https://x.net/es/1"))], df.schema)
    assert [r.verdict for r in url_filters.judge_urls(clean).collect()] == ["allow"]
