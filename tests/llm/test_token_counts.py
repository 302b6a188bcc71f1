from foliorank.llm import token_counts
from foliorank.llm.tokenizer import VOCABULARY, encoder


def test_totals_equal_plain_sums(spark):
    texts = ["", None, "Hello world, it's 2024", "a" * 5000, "the " * 3000, "été größe\n\n\t x"] + ["one two"] * 7
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, n_tokens int").repartition(3)
    encode = encoder(VOCABULARY).encode_ordinary
    lengths = [len(encode(t or "")) for t in texts]
    found = {r.n_tokens: r for r in token_counts.count_tokens(df).collect()}
    assert set(found) == set(lengths)
    for limit, r in found.items():
        assert r.n_docs == lengths.count(limit)
        assert r.docs_at_most == sum(n <= limit for n in lengths)
        assert r.docs_longer == sum(n > limit for n in lengths)
        assert r.tokens_at_most == sum(n for n in lengths if n <= limit)
        assert r.total_tokens == sum(lengths)
        assert r.truncated_tokens == sum(min(n, limit) for n in lengths)
        assert abs(r.quantile - r.docs_at_most / len(texts)) < 1e-12
    totals = token_counts.count_tokens(df)
    assert token_counts.length_quantile(totals, 0.5).first().n_tokens == sorted(lengths)[6]


def test_nothing(spark):
    assert token_counts.count_tokens(spark.createDataFrame([], "text string")).collect() == []


def test_any_limit(spark):
    texts = ["", None, "Hello world", "a b c " * 50, "the " * 300] + ["one two three"] * 7
    encode = encoder(VOCABULARY).encode_ordinary
    lengths = [len(encode(t or "")) for t in texts]
    totals = token_counts.count_tokens(spark.createDataFrame([(t,) for t in texts], "text string"))
    asked = [0, 1, 2, 3, 7, 100, 150, 151, 299, 10**6, 3, -1]
    limits = spark.createDataFrame([(x,) for x in [*asked, None]], "limit long")
    found = {r.limit: r for r in token_counts.at_limit(totals, limits).collect()}
    assert set(found) == set(asked)
    for limit, r in found.items():
        assert r.docs_at_most == sum(n <= limit for n in lengths) and r.docs_longer == sum(n > limit for n in lengths)
        assert r.tokens_at_most == sum(n for n in lengths if n <= limit)
        assert r.truncated_tokens == sum(max(0, min(n, limit)) for n in lengths)
    assert token_counts.at_limit(totals.limit(0), limits).collect() == []
