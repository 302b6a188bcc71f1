import re

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliorank.functions import text
from foliorank.functions.stemmer import stem_word
from foliorank.functions.stopwords import ENGLISH_STOPWORDS
from foliorank.functions.text import concat_text, remove_stopwords, stem_words, strip_marks, tokenize
from foliorank.plans import preprocess

STOPWORDS = ["the", "of", "cannot"]


def words_of(spark, text, column):
    return spark.createDataFrame([(text,)], "text string").select(column.alias("w")).first()["w"]


@pytest.mark.parametrize(
    "text, tokens, terms, intensive",
    [
        (
            "The can-not e-mail of 3D co_op a-b",
            ["the", "can-not", "e-mail", "co_op", "a-b"],
            ["cannot", "email", "coop", "ab"],
            ["email", "coop", "ab"],
        ),
        ("--- ab abc", ["---", "abc"], ["", "abc"], ["", "abc"]),
        ("Éléphant café2abc", ["phant", "caf", "abc"], ["phant", "caf", "abc"], ["phant", "caf", "abc"]),
        ("", [], [], []),
    ],
)
def test_step_order(spark, text, tokens, terms, intensive):
    found = tokenize(F.col("text"))
    assert words_of(spark, text, found) == tokens
    assert words_of(spark, text, strip_marks(remove_stopwords(found, STOPWORDS))) == terms
    assert words_of(spark, text, remove_stopwords(strip_marks(found), STOPWORDS)) == intensive


def test_tokens_equal_regex_tokenizer(spark):
    from pyspark.ml.feature import RegexTokenizer

    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    reference = RegexTokenizer(minTokenLength=3, inputCol="text", outputCol="w", pattern="[^A-Za-z_-]")
    rows = reference.transform(documents).withColumn("ours", tokenize("text"))
    assert rows.filter("w != ours").count() == 0


def test_tokens_are_cut_from_bytes(monkeypatch):
    """Runs end with their text, whatever stands beside it and however many texts are cut at once; slices and nulls count."""
    texts = ["abc", "def-", "", "ab", "c", None, "é--_éabcé ab cd efg", "x" * 40, "--", "-_-", "ab\x00abcd", "Kab ſabc"] * 3
    texts += [None, "", "zz zzz"]
    held = pa.array(["cut away", *texts])[1:]
    expected = [t if t is None else re.findall("[a-z_-]{3,}", t) for t in texts]
    for size in (1, 7, 64, 1 << 22):
        monkeypatch.setattr(text, "CUT_BYTES", size)
        assert text._token_lists(held).to_pylist() == expected
    assert text._token_lists(held[:0]).to_pylist() == [] and text._token_lists(pa.array([None, ""], pa.string())).to_pylist() == [None, []]
    assert text._token_lists(held.cast(pa.large_string())).to_pylist() == expected


def test_marks_leave_lists_with_nulls(spark):
    rows = spark.createDataFrame([(["a-b", None, "__", "", "é_", "abc"],), ([],), (None,)], "w array<string>")
    assert [r.s for r in rows.select(strip_marks("w").alias("s")).collect()] == [["ab", None, "", "", "é", "abc"], [], None]


def test_default_stop_list_is_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    listed = {w for w in StopWordsRemover.loadDefaultStopWords("english") if w.isalpha()}
    assert listed - set(ENGLISH_STOPWORDS) == set()


def test_missing_parts_of_a_paper(spark):
    rows = spark.createDataFrame(
        [(1, None, "Spark jobs"), (2, None, None)], "paper_id int, title string, abstract string"
    )
    tokens = rows.select("paper_id", tokenize(concat_text()).alias("w")).orderBy("paper_id").collect()
    assert [r.w for r in tokens] == [["spark", "jobs"], []]


@pytest.mark.parametrize(
    "word, stem",
    [
        pair.split(":")
        for pair in """
        consign:consign consistency:consist consolatory:consolatori conspiracy:conspiraci
        knackeries:knackeri knives:knive kneeling:kneel generously:generous hopping:hop
        hoping:hope flies:fli dies:die ties:tie gas:gas this:this gaps:gap bed:bed sing:sing
        relational:relat happy:happi say:say by:by youth:youth science:scienc
        machine:machin learning:learn predictions:predict recommender:recommend
        communication:communic skis:ski news:news succeeded:succeed agreed:agre
        luxuriated:luxuri fulfill:fulfil Running:run of:of
        """.split()
    ],
)
def test_stems(word, stem):
    assert stem_word(word) == stem


def test_stemming_arrays(spark):
    rows = spark.createDataFrame(
        [(1, ["running", "runs", "", "running"]), (2, []), (3, None), (4, ["news"])],
        T.StructType([T.StructField("id", T.IntegerType()), T.StructField("w", T.ArrayType(T.StringType()))]),
    ).coalesce(1)
    stems = {r.id: r.s for r in rows.select("id", stem_words("w").alias("s")).collect()}
    assert stems == {1: ["run", "run", "", "run"], 2: [], 3: None, 4: ["news"]}


def test_preprocessing_plans(spark):
    papers = spark.createDataFrame(
        [(1, "Learning machines", "machines learn the can-not")],
        "paper_id int, title string, abstract string",
    )
    terms = preprocess.preprocess_terms(papers, STOPWORDS).first()["words"]
    assert terms == ["learn", "machin", "machin", "learn", "cannot"]
    assert preprocess.preprocess_intensive(papers, STOPWORDS, distinct=True).first()["words"] == [
        "learn",
        "machin",
    ]
    conservative = preprocess.preprocess_conservative(papers).first()["words"]
    assert conservative == ["learning", "machines", "machines", "learn", "the", "cannot"]


def test_text_steps_do_not_shuffle(spark, capsys):
    papers = spark.createDataFrame([(1, "a b", None)], "paper_id int, title string, abstract string")
    preprocess.preprocess_terms(papers).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_stems_of_long_batches_come_in_runs(monkeypatch):
    """No run of tokens is encoded beyond the bound; lists that cross it and null tokens are whole."""
    lists = pa.array([["walking", None, "runs"], None, [], ["hopping"] * 5, ["walking"]], pa.list_(pa.string()))
    seen, plain = [], pc.dictionary_encode
    monkeypatch.setattr(text.pc, "dictionary_encode", lambda x: seen.append(len(x)) or plain(x))
    expected = [["walk", None, "run"], None, [], ["hop"] * 5, ["walk"]]
    for tokens in (2, 1000):
        assert text._stem_lists(lists, tokens).to_pylist() == expected
        assert text._stem_lists(lists.slice(2), tokens).to_pylist() == expected[2:]
        assert max(seen) <= tokens
