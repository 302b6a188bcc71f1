"""Word vectors: training, nearest words, analogies and paper embeddings."""

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..functions.vectors import as_doubles, cosine_similarity
from .word_model import WordModel, train

# The shape of the word model and the parts it trains on.
VECTOR_SIZE = 100
TRAINING_PARTITIONS = 10
ANALOGY_CANDIDATES = 5

BY_RUNS = "runs"
BY_MLLIB = "mllib"

# Word vectors that may be broadcast: 80 MB at 100 doubles each.
BROADCAST_WORDS = 100_000
# Tokens that a task looks up at once (each look-up hashes all words first), lists whose sums it holds,
# and words of a list whose vectors it holds.
SUMMED_TOKENS, SUMMED_LISTS, SUMMED_WORDS = 1 << 20, 1 << 14, 1 << 12
# Words whose vectors the driver holds at once on their way to the tasks.
SENT_WORDS = 1 << 16


def word2vec_fit(
    words: DataFrame,
    vector_size: int = VECTOR_SIZE,
    partitions: int = TRAINING_PARTITIONS,
    seed: int = 1,
    min_count: int = 5,
    trainer: str = BY_RUNS,
) -> WordModel | Word2VecModel:
    """Skip-gram model over the ``words`` column.

    ``runs`` trains by this library's matrix products (``word_model``), ``mllib`` by Spark's trainer.
    ``partitions`` parts of the corpus are trained apart and merged. It changes the
    vectors, so it is a parameter and never follows from the cluster; ``runs`` takes more
    parts for a corpus whose parts would exceed a bound of tokens. MLlib's trainer keeps
    vocabulary x ``vector_size`` floats on the driver.
    """
    if trainer == BY_RUNS:
        return train(words, vector_size, partitions, seed, min_count)
    if trainer != BY_MLLIB:
        raise ValueError(f"unknown trainer {trainer!r}")
    mllib = Word2Vec(
        vectorSize=vector_size,
        numPartitions=partitions,
        minCount=min_count,
        seed=seed,
        inputCol="words",
        outputCol="vector",
    )
    return mllib.fit(words)


def word_vectors(model: WordModel | Word2VecModel) -> DataFrame:
    """(word, vector) of every word of the model."""
    if isinstance(model, WordModel):
        return model.vectors.select("word", as_doubles("vector").alias("vector"))
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def _nearest(vectors: DataFrame, query: DataFrame, n: int, left_out: Sequence, digits: int) -> DataFrame:
    """Top ``n`` words by cosine to the one vector of ``query``.

    The query vector is a scalar subquery, so this is one map over the words and a
    top-n; without a query vector there is no score and no row.
    """
    rows = vectors.select("word", as_doubles("vector").alias("vector"))
    for word in left_out:
        rows = rows.filter(F.col("word") != F.lit(word))
    asked = rows.withColumn("_query", query.select(as_doubles("vector")).scalar())
    score = F.round(cosine_similarity("vector", "_query"), digits)
    scored = asked.select("word", score.alias("similarity")).filter("similarity IS NOT NULL")
    return scored.orderBy(F.desc("similarity"), "word").limit(n)


def find_synonyms(vectors: DataFrame, word, n: int, digits: int = 6) -> DataFrame:
    """(word, similarity) of the ``n`` nearest words, the word itself left out."""
    query = vectors.filter(F.col("word") == F.lit(word)).select("vector")
    return _nearest(vectors, query, n, [word], digits)


def find_synonyms_of_vector(vectors: DataFrame, query: DataFrame, n: int, digits: int = 6) -> DataFrame:
    """Same for a one-row (vector) table; nothing is left out."""
    return _nearest(vectors, query, n, [], digits)


def analogy_vector(vectors: DataFrame, first: Sequence, second: Sequence, third: Sequence) -> DataFrame:
    """(vector): (first - second) + third, where a list of words is their sum.

    The asked words are few rows of the table; each counts with its sign. The
    vector is null when one of them is unknown.
    """
    times = Counter(first) + Counter(third)
    times.subtract(Counter(second))
    signs = F.create_map(*[F.lit(x) for word, sign in times.items() for x in (word, float(sign))])
    known = vectors.filter(F.col("word").isin(list(times)))
    signed = known.withColumn("_sign", signs[F.col("word")]).select(
        "word", F.transform(as_doubles("vector"), lambda x: x * F.col("_sign")).alias("_v")
    )
    total = vector_to_array(Summarizer.sum(array_to_vector("_v")))
    return signed.agg(
        F.when(F.count_distinct("word") == len(times), total).alias("vector")
    )


def analogy(vectors: DataFrame, first: Sequence, second: Sequence, third: Sequence) -> DataFrame:
    """The word nearest to (first - second) + third, each a list of words.

    It answers "second is to first as third is to ?". The words of the question
    are taken out of the five nearest; no row comes back when none is left or
    when a word is unknown.
    """
    query = analogy_vector(vectors, first, second, third)
    near = find_synonyms_of_vector(vectors, query, ANALOGY_CANDIDATES)
    asked = [*first, *second, *third]
    left = near.filter(~F.col("word").isin(asked))
    return left.orderBy(F.desc("similarity"), "word").limit(1)


def embed_with_model(words: DataFrame, model: WordModel | Word2VecModel) -> DataFrame:
    """(paper_id, n_tokens, vector): mean word vector, unknown words as zeros."""
    sized = words.select("paper_id", F.size("words").cast("bigint").alias("n_tokens"), "words")
    if isinstance(model, WordModel):
        return _mean_by_map(sized, model.vectors)
    return model.transform(sized).select("paper_id", "n_tokens", vector_to_array("vector").alias("vector"))


def _word_matrix(vectors: DataFrame, dtype: type) -> tuple[pa.Array, np.ndarray]:
    """(words, one row of numbers a word); a word that the table lists twice counts with both vectors."""
    held = vectors.select("word", F.col("vector").alias("_v")).where("word IS NOT NULL AND _v IS NOT NULL").toArrow()
    names, place = np.unique(np.array(held["word"].to_pylist(), object), return_inverse=True)
    flat = held["_v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    rows = flat.reshape(len(held), len(flat) // max(1, len(held)))
    table = np.zeros((len(names), rows.shape[1]), dtype)
    np.add.at(table, place, rows)
    return pa.array(names.tolist(), held.schema.field("word").type), table


class _Tables:
    """Rows of several tables, numbered through, as if they were one."""

    def __init__(self, tables: list[np.ndarray]):
        self.tables, self.starts = tables, np.cumsum([0, *map(len, tables)])
        self.shape = self.starts[-1], max(t.shape[1] for t in tables)

    def take(self, places: np.ndarray, axis: int = 0) -> np.ndarray:
        if len(self.tables) == 1:
            return self.tables[0].take(places, axis=axis)
        rows = np.empty((len(places), self.shape[1]), self.tables[0].dtype)
        owner = np.searchsorted(self.starts, places, "right") - 1
        for number in np.unique(owner):
            own = np.flatnonzero(owner == number)
            rows[own] = self.tables[number].take(places[own] - self.starts[number], axis=axis)
        return rows


def _send_words(vectors: DataFrame, dtype: type) -> tuple[Broadcast, list[Broadcast]]:
    """The words and the tables of their rows, for all tasks; the driver holds SENT_WORDS words' rows at once.

    Words are dealt by a hash, so that rows of one word meet in one table.
    """
    context = vectors.sparkSession.sparkContext
    blocks = max(1, -(-vectors.count() // SENT_WORDS))
    names, tables = [], []
    for block in range(blocks):
        own = vectors.where(F.pmod(F.xxhash64("word"), F.lit(blocks)) == block) if blocks > 1 else vectors
        found, table = _word_matrix(own, dtype)
        if len(found) or not names:
            names.append(found)
            tables.append(context.broadcast(table))
        del found, table
    return context.broadcast(pa.concat_arrays(names)), tables


def _sent(words: Broadcast, tables: list[Broadcast]) -> tuple[pa.Array, _Tables]:
    return words.value, _Tables([t.value for t in tables])


def _list_sums(lists: pa.Array, names: pa.Array, table: np.ndarray | _Tables) -> Iterator[tuple]:
    """(first list, last, sums of their words' rows, which lists have a known word), few tokens at a time."""
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat, start = lists.flatten(), 0
    while start < len(ends):
        first = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, first + SUMMED_TOKENS, "right")))
        stop = min(stop, start + SUMMED_LISTS)
        sums = np.zeros((stop - start, table.shape[1]))
        seen = np.zeros(stop - start, bool)
        for at in range(first, ends[stop - 1], SUMMED_TOKENS):
            own = flat.slice(at, min(SUMMED_TOKENS, ends[stop - 1] - at))
            found = pc.index_in(own.cast(names.type), value_set=names).fill_null(-1).to_numpy(zero_copy_only=False)
            known = np.flatnonzero(found >= 0)
            owner = np.searchsorted(ends, at + known, "right") - start
            cuts = np.flatnonzero(np.diff(owner, prepend=-1))
            lengths = np.diff(np.append(cuts, len(known)))
            seen[owner[cuts]] = True
            for paper, cut, n in zip(owner[cuts], cuts, lengths):
                for some in range(cut, cut + n, SUMMED_WORDS):
                    places = found[known[some : min(some + SUMMED_WORDS, cut + n)]]
                    sums[paper] += table.take(places, axis=0).sum(axis=0, dtype=np.float64)
        yield start, stop, sums, seen
        start = stop


def _number_lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), rows.ravel())


def _mean_by_map(words: DataFrame, vectors: DataFrame) -> DataFrame:
    """The mean vector of each row's list in place of ``words``; the model's are sent to all tasks as 32-bit numbers."""
    shipped = _send_words(vectors, np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = _sent(*shipped)
        for batch in batches:
            lists = batch.column("words")
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for start, stop, sums, _ in _list_sums(lists, names, table):
                mean = sums / np.maximum(sizes[start:stop], 1)[:, None]
                own = batch.slice(start, stop - start).select(kept)
                yield pa.RecordBatch.from_arrays([*own.columns, _number_lists(mean)], names=[*kept, "vector"])

    kept = [c for c in words.columns if c != "words"]
    vector = StructField("vector", ArrayType(DoubleType()))
    return words.mapInArrow(run, StructType([*(words.schema[c] for c in kept), vector]))


def _summed_by_map(words: DataFrame, vectors: DataFrame) -> DataFrame:
    """(paper_id, _sum) with the words sent to all tasks: a paper's tokens are summed in its own row.

    A word that the table lists twice counts with both vectors. Only papers with a known word have a row.
    """
    held = vectors.select("word", as_doubles("vector").alias("vector"))
    shipped = words.sparkSession.sparkContext.broadcast(_word_matrix(held, np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shipped.value
        for batch in batches:
            for start, stop, sums, seen in _list_sums(batch.column("words"), names, table):
                ids = batch.column("paper_id").slice(start, stop - start).filter(pa.array(seen))
                yield pa.RecordBatch.from_arrays([ids, _number_lists(sums[seen])], names=["paper_id", "_sum"])

    kind = words.schema["paper_id"].dataType.simpleString()
    summed = words.select("paper_id", "words").mapInArrow(run, f"paper_id {kind}, _sum array<double>")
    total = vector_to_array(Summarizer.sum(array_to_vector("_sum")))
    return summed.groupBy("paper_id").agg(total.alias("_sum"))


def _summed_by_count(tokens: DataFrame, vectors: DataFrame) -> DataFrame:
    """(paper_id, _sum) with the words shuffled: a frequent token is counted per paper first."""
    counted = tokens.groupBy("paper_id", "word").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    known = vectors.select("word", as_doubles("vector").alias("_v"))
    weighted = counted.join(known, "word").select(
        "paper_id", F.transform("_v", lambda x: x * F.col("_n")).alias("_v")
    )
    total = vector_to_array(Summarizer.sum(array_to_vector("_v")))
    return weighted.groupBy("paper_id").agg(total.alias("_sum"))


def document_embedding(
    words: DataFrame, vectors: DataFrame, broadcast_words: int = BROADCAST_WORDS
) -> DataFrame:
    """The same from a (word, vector) table of any size.

    The sum of the known words' vectors is divided by all tokens of the paper; a
    paper without a known word has zeros. Up to ``broadcast_words`` words are
    broadcast, more are joined by shuffle.
    """
    few = vectors.limit(broadcast_words + 1).count() <= broadcast_words
    tokens = words.select("paper_id", F.explode("words").alias("word"))
    sums = _summed_by_map(words, vectors) if few else _summed_by_count(tokens, vectors)
    sizes = words.groupBy("paper_id").agg(F.sum(F.size("words")).cast("bigint").alias("n_tokens"))
    zeros = vectors.select(F.transform(as_doubles("vector"), lambda x: x * 0)).limit(1).scalar()
    mean = F.transform("_sum", lambda x: x / F.col("n_tokens"))
    return sizes.join(sums, "paper_id", "left").select(
        "paper_id", "n_tokens", F.coalesce(mean, zeros).alias("vector")
    )
