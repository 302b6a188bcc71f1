import numpy as np
import pyarrow as pa
import pytest

from foliorank.operators import embeddings
from foliorank.operators.terms import merge_token_lists
from foliorank.operators.word_model import WordModel
from foliorank.plans import recommend

VECTORS = {"king": [1.0, 1.0], "man": [1.0, 0.0], "woman": [0.0, 1.0], "queen": [0.1, 2.0], "void": [0.0, 0.0]}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(list(VECTORS.items()), "word string, vector array<double>")


def test_synonyms(table):
    near = embeddings.find_synonyms(table, "woman", 2).collect()
    assert [r.word for r in near] == ["queen", "king"]
    assert embeddings.find_synonyms(table, "nobody", 2).count() == 0
    query = table.filter("word = 'woman'").select("vector")
    assert embeddings.find_synonyms_of_vector(table, query, 1).first()["word"] == "woman"


def test_analogy(table):
    assert embeddings.analogy(table, ["king"], ["man"], ["woman"]).first()["word"] == "queen"
    assert embeddings.analogy(table, ["king"], ["nobody"], ["woman"]).count() == 0
    assert embeddings.analogy(table, ["king", "man"], ["queen"], ["woman"]).count() == 0
    vector = embeddings.analogy_vector(table, ["king", "king"], ["man"], ["woman"]).first()["vector"]
    assert vector == [1.0, 3.0]


@pytest.mark.parametrize("broadcast_words", [100, 2])
def test_document_embedding_counts_unknown_words(spark, table, broadcast_words):
    words = spark.createDataFrame(
        [(1, ["man", "queen", "man", "zz"]), (2, []), (3, ["zz"])], "paper_id int, words array<string>"
    )
    rows = {r.paper_id: r for r in embeddings.document_embedding(words, table, broadcast_words).collect()}
    assert rows[1].vector == pytest.approx([2.1 / 4, 0.5]) and rows[1].n_tokens == 4
    assert rows[2].vector == [0.0, 0.0] and rows[3].vector == [0.0, 0.0]


def test_papers_are_summed_before_the_shuffle(spark, table, monkeypatch):
    """One sum a row reaches the shuffle, whatever the tokens looked up at once; rows of a paper and words add up."""
    rows = [(1, ["man", "zz", "man"]), (1, ["queen", None]), (2, None), (3, ["woman"] * 9), (None, ["man"]), (4, [])]
    words = spark.createDataFrame(rows, "paper_id int, words array<string>").coalesce(1)
    twice = table.union(table.where("word = 'queen'"))
    assert "_sum" in embeddings._summed_by_map(words, table)._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[1]
    for tokens in (1 << 17, 2):
        monkeypatch.setattr(embeddings, "SUMMED_TOKENS", tokens)
        found = {r.paper_id: r._sum for r in embeddings._summed_by_map(words, twice).collect()}
        assert found == {1: [2.2, 4.0], 3: [0.0, 9.0], None: [1.0, 0.0]}
    assert embeddings._summed_by_map(words, table.limit(0)).collect() == []


def test_words_are_hashed_once_for_many_lists(monkeypatch):
    """One look-up for 300,000 tokens; a long list is summed in pieces, and a batch of many lists in parts."""
    calls, index_in = [], embeddings.pc.index_in
    monkeypatch.setattr(embeddings.pc, "index_in", lambda *a, **k: calls.append(1) or index_in(*a, **k))
    lists = pa.array([["a", "x", "b"] * 3000, None, [], ["x"], *[["b", "a", "a"] * 10] * 20_000], pa.list_(pa.string()))
    names, table = pa.array(["a", "b"]), np.array([[1.0, 0.0], [0.0, 0.5]], np.float32)
    first = lists.slice(0, 10_000)
    (found,) = embeddings._list_sums(first, names, table)
    assert found[:2] == (0, 10_000) and len(calls) == 1
    parts = list(embeddings._list_sums(lists, names, table))
    assert [p[0] for p in parts[1:]] == [p[1] for p in parts[:-1]] and parts[-1][1] == len(lists)
    assert max(p[1] - p[0] for p in parts) <= embeddings.SUMMED_LISTS
    sums, seen = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
    assert sums[:5].tolist() == [[3000, 1500], [0, 0], [0, 0], [0, 0], [20, 5]] and (sums[4:] == [20, 5]).all()
    assert seen[:5].tolist() == [True, False, False, False, True] and seen[4:].all()


@pytest.fixture(scope="module")
def corpus(spark):
    words = [(i, ["spark", "join", f"w{i % 3}", "plan"] * 5) for i in range(30)]
    return spark.createDataFrame(words, "paper_id long, words array<string>")


def test_trained_model(spark, corpus):
    model = embeddings.word2vec_fit(corpus, vector_size=12, partitions=2)
    vectors = embeddings.word_vectors(model)
    assert {r.word for r in vectors.collect()} == {"spark", "join", "plan", "w0", "w1", "w2"}
    embedded = embeddings.embed_with_model(corpus, model)
    ours = {r.paper_id: r.vector for r in embeddings.document_embedding(corpus, vectors).collect()}
    for r in embedded.collect():
        assert len(r.vector) == 12 and r.n_tokens == 20
        assert ours[r.paper_id] == pytest.approx(r.vector, abs=1e-6)


def test_user_corpus_profiles_weigh_parts(spark, corpus):
    pairs = spark.createDataFrame([("u", i) for i in range(20)] + [("v", 3)], "user_id string, paper_id long")
    profiles = recommend.user_corpus_profiles(pairs, corpus, vector_size=6, partitions=2)
    rows = {r.user_id: r.vector for r in profiles.collect()}
    assert set(rows) == {"u", "v"} and all(len(v) == 6 for v in rows.values())
    assert merge_token_lists(pairs, corpus).count() == 2


def test_the_driver_holds_few_word_vectors_at_once(spark, monkeypatch):
    """Vectors of a model go to the tasks in blocks of words; means are those of one table."""
    rng = np.random.default_rng(8)
    rows = [(f"w{i}", rng.normal(size=3).tolist()) for i in range(50)] + [("w7", [1.0, 2.0, 3.0]), (None, [9.0] * 3)]
    vectors = spark.createDataFrame(rows, "word string, vector array<float>")
    lists = [(p, [f"w{i}" for i in rng.integers(0, 60, p)]) for p in range(30)] + [(30, None), (31, ["w7", None, "w7"])]
    words = spark.createDataFrame(lists, "paper_id int, words array<string>")
    held, whole = [], embeddings._word_matrix

    def matrix(*args):
        found = whole(*args)
        held.append(len(found[0]))
        return found

    monkeypatch.setattr(embeddings, "_word_matrix", matrix)
    means = []
    for sent in (1 << 17, 8):
        monkeypatch.setattr(embeddings, "SENT_WORDS", sent)
        held.clear()
        means.append({r.paper_id: r.vector for r in embeddings.embed_with_model(words, WordModel(vectors)).collect()})
        assert sum(held) == 50 and (len(held) == 1 or max(held) < 25)
    assert len(held) > 1 and means[0] == means[1] and means[0][31] == pytest.approx([x * 2 / 3 for x in np.add(rows[7][1], [1, 2, 3])])
    none = embeddings.embed_with_model(words, WordModel(vectors.limit(0))).collect()
    assert len(none) == 32 and all(r.vector == [] for r in none)
