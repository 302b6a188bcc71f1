import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliorank.operators import terms, weights
from foliorank.storage import write_once


def test_band_is_inclusive(spark):
    frequencies = spark.createDataFrame([("a", 19), ("b", 20), ("c", 21)], "term string, df long")
    n = spark.range(1).select(F.lit(200).alias("n_papers"))
    assert [r.term for r in terms.document_frequency_band(frequencies, n).collect()] == ["b"]


def test_document_frequency_counts_rows_once(spark):
    words = spark.createDataFrame(
        [(1, ["a", "a", "b"]), (2, ["a"]), (3, [])], "paper_id int, words array<string>"
    )
    assert {r.term: r.df for r in terms.document_frequency(words).collect()} == {"a": 2, "b": 1}


def test_distinct_papers(spark):
    papers = spark.createDataFrame(
        [(1, "t", None), (1, "t", None), (1, "t", ""), (2, "t", None)],
        "paper_id int, title string, abstract string",
    )
    assert terms.count_distinct_papers(papers).first()[0] == papers.distinct().count() == 3


def test_top_terms_break_ties_by_term(spark):
    frequencies = spark.createDataFrame(
        [("b", 2), ("a", 2), ("c", 5), ("d", 1)], "term string, df long"
    )
    top = terms.top_terms(frequencies, 3).orderBy("term_id").collect()
    assert [(r.term, r.term_id) for r in top] == [("c", 0), ("a", 1), ("b", 2)]


@pytest.mark.parametrize("papers_per_part", [200, 2])
def test_merged_lists_keep_all_tokens(spark, papers_per_part):
    pairs = spark.createDataFrame([("u", i) for i in range(10)] + [("v", 3)], "user_id string, paper_id int")
    words = spark.createDataFrame([(i, [f"w{i}", "x"]) for i in range(10)], "paper_id int, words array<string>")
    merged = terms.merge_token_lists(pairs, words, papers_per_part).collect()
    tokens = sorted(t for r in merged if r.user_id == "u" for t in r.words)
    assert tokens == sorted([f"w{i}" for i in range(10)] + ["x"] * 10)
    if papers_per_part == 200:
        [whole] = [r.words for r in merged if r.user_id == "u"]
        assert whole == [t for i in range(10) for t in (f"w{i}", "x")]
    else:
        assert len([r for r in merged if r.user_id == "u"]) > 1


def tf_fixture(spark):
    words = spark.createDataFrame(
        [(1, ["a", "a", "zz"]), (2, ["a", "b"]), (3, ["b2"]), (4, [])],
        "paper_id int, words array<string>",
    )
    vocabulary = spark.createDataFrame(
        [("a", 2, 0), ("b", 1, 1), ("b2", 1, 2)], "term string, df long, term_id long"
    )
    return words, vocabulary


def test_tf_and_idf(spark):
    words, vocabulary = tf_fixture(spark)
    tf = weights.term_frequency(words, vocabulary)
    assert {tuple(r) for r in tf.collect()} == {(1, 0, 2), (2, 0, 1), (2, 1, 1), (3, 2, 1)}
    idf = {r.term_id: r.idf for r in weights.inverse_document_frequency(tf).collect()}
    assert idf[0] == pytest.approx(math.log(4 / 3)) and idf[1] == pytest.approx(math.log(2))
    assert idf[0] == pytest.approx(0.287682, abs=1e-6) and idf[1] == pytest.approx(0.693147, abs=1e-6)


def test_tf_idf_equals_mllib(spark):
    from pyspark.ml.feature import IDF
    from pyspark.ml.functions import vector_to_array

    words, vocabulary = tf_fixture(spark)
    vectors = weights.count_vectors(words, vocabulary)
    assert {r.paper_id for r in vectors.collect()} == {1, 2, 3}
    fitted = IDF(inputCol="features", outputCol="w").fit(vectors)
    expected = {
        (r.paper_id, i): x
        for r in fitted.transform(vectors).select("paper_id", vector_to_array("w").alias("w")).collect()
        for i, x in enumerate(r.w)
        if x
    }
    found = weights.tf_idf(weights.term_frequency(words, vocabulary)).collect()
    assert {(r.paper_id, r.term_id) for r in found} == set(expected)
    for r in found:
        assert r.weight == pytest.approx(expected[r.paper_id, r.term_id])


def test_topics(spark):
    words = spark.createDataFrame(
        [(i, ["a", "b"] if i % 2 else ["c", "d"]) for i in range(20)], "paper_id int, words array<string>"
    )
    vocabulary = terms.top_terms(terms.document_frequency(words), 10)
    topics = weights.lda_topics(weights.count_vectors(words, vocabulary), k=3, max_iter=3).collect()
    assert len(topics) == 20
    for r in topics:
        assert len(r.vector) == 3 and np.isclose(sum(r.vector), 1)


def test_parts_in_order_are_the_merged_list_of_a_large_library(spark):
    pairs = spark.createDataFrame([(u, p) for u in (1, 2) for p in range(500) if u == 1 or p < 3], "user_id long, paper_id long")
    words = spark.createDataFrame([(p, [f"w{p}", f"v{p}"]) for p in range(500)], "paper_id long, words array<string>")
    plain = [w for p in range(500) for w in (f"w{p}", f"v{p}")]
    for part_tokens in (1_000_000, 64):
        rows = terms.merge_token_lists(pairs, words, part_tokens).orderBy("user_id", "part").collect()
        assert [w for r in rows if r.user_id == 1 for w in r.words] == plain
        assert [w for r in rows if r.user_id == 2 for w in r.words] == plain[:6]
        assert (len(rows) == 2) == (part_tokens > 1000)


def test_merged_lists_travel_packed(spark):
    """Nulls, empty tokens, marks and papers of several rows survive packing; no list is shuffled as an array."""
    lists = [(1, ["b", None, "", "é"]), (1, ["a"]), (1, ["a", "c"]), (2, []), (3, ["x" * 300]), (4, None), (5, ["z", "z"])]
    words = spark.createDataFrame(lists, "paper_id int, words array<string>")
    pairs = [("u", 1), ("u", 2), ("u", 3), ("u", 5), ("v", 4), ("v", 5), ("w", 2)]
    pairs = spark.createDataFrame(pairs, "user_id string, paper_id int")
    merged = terms.merge_token_lists(pairs, words)
    found = {r.user_id: r.words for r in merged.collect()}
    # Three rows of lists for paper 1 meet its three rows of places.
    first = ["a"] * 3 + ["a", "c"] * 3 + ["b", None, "", "é"] * 3
    assert found == {"u": [*first, "x" * 300, "z", "z"], "v": None, "w": []}
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "packed" in plan and "words" not in plan.split("MapInArrow", 1)[1].split("\n", 1)[1]


def test_places_of_packed_lists_travel_not_their_bytes(spark, monkeypatch):
    """What is shuffled to a paper's readers does not grow with its text; where tasks cannot open the folder, lists travel."""
    rng = random.Random(5)
    lists = [(p, [f"w{rng.randrange(10**9)}" for _ in range(400)]) for p in range(40)] + [(40, None), (41, []), (42, ["é", None, ""])]
    words = spark.createDataFrame(lists, "paper_id long, words array<string>").repartition(3)
    pairs = spark.createDataFrame([(u, p) for u in range(9) for p in range(43) if (u + p) % 3], "user_id long, paper_id long")
    written = {}
    monkeypatch.setattr(terms, "write_once", lambda df, name: written.setdefault(name, write_once(df, name)))

    def merged():
        written.clear()
        rows = {(r.user_id, r.part): r.words for r in terms.merge_token_lists(pairs, words, 3000).collect()}
        return rows, written["token-lists"].agg(F.max(F.length("packed"))).first()[0]

    by_place, longest = merged()
    assert longest <= 32
    monkeypatch.setattr(terms, "new_byte_folder", lambda spark, name: None)
    by_bytes, longest = merged()
    assert longest > 1000 and by_place == by_bytes and len(by_place) > 9
