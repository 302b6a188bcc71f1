"""The rule cascade in Spark and in SQL against the stemmer of the Arrow path."""

import random

import duckdb

from foliorank.functions.stem_rules import stem_rows, stem_sql
from foliorank.functions.stemmer import _IRREGULAR, _STEP_2, _STEP_3, _STEP_4, stem_word


def words():
    rng = random.Random(11)
    ends = [*_STEP_2, *_STEP_3, *_STEP_4, "ative", "ogi", "li", "ion", "ed", "edly", "ing", "ingly", "eed", "eedly"]
    ends += ["sses", "ied", "ies", "s", "us", "ss", "y", "e", "ll", "le", "'s", "'s'", "'", ""]
    starts = ["gener", "commun", "arsen", "yo", "ay", "a", "be", "hop", "hopp", "tr", "str", "contr", "kn", "x", "'a", "i"]
    found = set(_IRREGULAR) | {"", "y", "ab", "by", "say", "Generalizations", "YES", "yyyy", "é"}
    while len(found) < 6000:
        middle = "".join(rng.choice("aeiouybdlnrstz") for _ in range(rng.randint(0, 4)))
        found.add(rng.choice(starts) + middle + rng.choice(ends) + rng.choice(["", "", rng.choice(ends)]))
    return sorted(found)


def test_each_word_is_stemmed_once(spark):
    rows = [("walking", i) for i in range(50)] + [("runs", 7), (None, 1)]
    found = stem_rows(spark.createDataFrame(rows, "term string, i int"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "regexp" not in plan  # no rule runs over the rows themselves
    assert sorted(r.i for r in found.where("stem = 'walk'").collect()) == list(range(50)) and found.count() == 52


def test_spark_cascade(spark):
    rows = [(w, i, "x") for i, w in enumerate(words())] + [(None, -1, "x")]
    found = stem_rows(spark.createDataFrame(rows, "term string, w int, stem_of string"))
    assert found.columns == ["term", "w", "stem_of", "stem"]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    for term, _, _, stem in found.collect():
        assert stem == (None if term is None else stem_word(term)), term


def test_sql_cascade():
    with duckdb.connect() as connection:
        connection.execute("CREATE TABLE given (word VARCHAR)")
        connection.executemany("INSERT INTO given VALUES (?)", [(w,) for w in words()])
        found = dict(connection.sql(stem_sql("given", "word")).fetchall())
    assert found == {w: stem_word(w) for w in words()}
