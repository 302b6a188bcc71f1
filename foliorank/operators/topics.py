"""Topic shares of papers by variational EM with a hash-drawn start.

The model is latent Dirichlet allocation with symmetric priors. A step reads the term
counts once: every paper finds its topic shares under the current topics in ``inner``
rounds from uniform shares, and hands each of its terms the counts expected of it. Expected
counts are summed per term inside each task and then over tasks; they make the next topics.
Start and sums do not depend on partitions (up to the last bits of a sum), so the
shares can be compared with SQL.

Topics are terms x ``k`` numbers. Their size is checked before a step sends them to the tasks.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import draw_key
from ..storage import write_once
from .weights import TOPIC_ITERATIONS, TOPICS

INNER_ROUNDS = 5
# Numbers of a topic table in every task and on the driver: 80 MB.
MAX_TOPIC_NUMBERS = 10_000_000
_CHUNK = 1 << 15  # entries of papers that a task works on at once
_PRODUCT = 1 << 11  # entries in one product: their topic terms stay near the processor


def count_lists(tf: DataFrame) -> DataFrame:
    """(paper_id, term_id, tf) as one row per paper, terms ascending; a written table."""
    entries = F.array_sort(F.collect_list(F.struct("term_id", F.col("tf").cast("double").alias("tf"))))
    listed = tf.groupBy("paper_id").agg(entries.alias("entries"))
    terms, counts = F.col("entries.term_id").cast("array<bigint>"), F.col("entries.tf")
    return write_once(listed.select("paper_id", terms.alias("terms"), counts.alias("counts")), "count-lists")


class _Topics:
    """Shares of the terms in each topic, and what a paper makes of them."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, inner: int):
        self.terms, self.inner, self.k = terms, inner, counts.shape[1]
        self.prior = 1.0 / self.k
        total = counts.sum(axis=0) + self.prior * len(terms)
        self.shares = (counts + self.prior) / total

    def chunks(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """(first paper, last, shares of papers, places of entries, their weights, their topic terms)."""
        lists, counts = batch.column("terms"), batch.column("counts").flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        places = np.searchsorted(self.terms, lists.flatten().to_numpy(zero_copy_only=False))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + _CHUNK, "right")))
            own = slice(before, ends[stop - 1])
            sizes = np.diff(np.concatenate([[before], ends[start:stop]]))
            yield (start, stop, *self.settle(places[own], counts[own], sizes))
            start = stop

    def settle(self, places: np.ndarray, counts: np.ndarray, sizes: np.ndarray):
        terms = self.shares[places]
        owner, first = np.repeat(np.arange(len(sizes)), sizes), np.concatenate([[0], np.cumsum(sizes)[:-1]])
        length = np.add.reduceat(counts, first)
        papers = np.full((len(sizes), self.k), self.prior)
        # Papers of about equal size share products; missing entries count nothing.
        order = np.argsort(sizes, kind="stable")
        start = 0
        while start < len(order):
            few = sizes[order[start]]
            stop = int(np.searchsorted(sizes[order], max(few + 8, few + few // 8), "right"))
            stop = min(stop, start + max(1, _PRODUCT // sizes[order[stop - 1]]))
            own = order[start:stop]
            place = np.arange(sizes[own[-1]])
            held = place < sizes[own][:, None]
            at = np.where(held, first[own][:, None] + place, first[own][:, None])
            words, seen = terms[at], np.where(held, counts[at], 0.0)[:, None, :]
            found = papers[own][:, :, None]
            for _ in range(self.inner):
                weight = seen / (words @ found).transpose(0, 2, 1)
                found = found * (weight @ words).transpose(0, 2, 1)
                found = (found + self.prior) / (length[own][:, None, None] + 1.0)
            papers[own] = found[:, :, 0]
            start = stop
        return papers, owner, places, counts, terms


def _expected(topics: _Topics):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, likelihood = np.zeros((len(topics.terms), topics.k)), 0.0
        for batch in batches:
            for _, _, papers, owner, places, seen, terms in topics.chunks(batch):
                joint = terms * papers[owner]
                total = joint.sum(axis=1)
                likelihood += float(seen @ np.log(total))
                joint = np.ascontiguousarray((joint * (seen / total)[:, None]).T)
                used, at = np.unique(places, return_inverse=True)
                counts[used] += np.stack([np.bincount(at, weights=x, minlength=len(used)) for x in joint], axis=1)
        held = np.flatnonzero(counts.any(axis=1))
        # Place -1 carries the log-likelihood of the task's papers.
        place = pa.array(np.concatenate([[-1], held]), pa.int64())
        values = np.concatenate([[[likelihood] + [0.0] * (topics.k - 1)], counts[held]])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * topics.k, pa.int32()), values.ravel())
        yield pa.RecordBatch.from_arrays([place, lists], names=["place", "counts"])

    return run


def fit_topics(
    lists: DataFrame, k: int = TOPICS, steps: int = TOPIC_ITERATIONS, seed: int = 1, inner: int = INNER_ROUNDS
) -> tuple[_Topics | None, list[float]]:
    """Topics after ``steps`` steps over ``count_lists``, and the log-likelihood before each step.

    Refuses more than MAX_TOPIC_NUMBERS numbers of topics; papers may be any number.
    """
    terms = lists.select(F.explode("terms").alias("term_id")).distinct()
    if terms.count() * k > MAX_TOPIC_NUMBERS:
        raise ValueError(f"topics of more than {MAX_TOPIC_NUMBERS} numbers; take fewer terms or topics")
    drawn = terms.withColumn("topic", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    first_bits = F.conv(F.substring(draw_key(seed, "term_id", "topic"), 1, 8), 16, 10).cast("double")
    start = drawn.select("term_id", "topic", (first_bits / F.lit(float(1 << 32))).alias("n")).orderBy("term_id", "topic")
    start = start.toArrow()
    if not len(start):
        return None, []
    counts = start["n"].to_numpy().reshape(-1, k)
    known = start["term_id"].to_numpy()[::k].astype(np.int64)
    likelihoods = []
    for _ in range(steps):
        partial = lists.mapInArrow(_expected(_Topics(known, counts, inner)), "place bigint, counts array<double>")
        summed = vector_to_array(Summarizer.sum(array_to_vector("counts")))
        rows = partial.groupBy("place").agg(summed.alias("counts")).toArrow()
        place, values = rows["place"].to_numpy(), np.array(rows["counts"].to_pylist())
        counts = np.zeros_like(counts)
        counts[place[place >= 0]] = values[place >= 0]
        likelihoods.append(float(values[place < 0][0][0]))
    return _Topics(known, counts, inner), likelihoods


def topic_shares(lists: DataFrame, topics: _Topics | None) -> DataFrame:
    """(paper_id, vector): each paper's shares of the topics, which sum to 1."""
    schema = f"paper_id {lists.schema['paper_id'].dataType.simpleString()}, vector array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, papers, *_ in topics.chunks(batch):
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(papers) + 1) * topics.k, pa.int32()), papers.ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("paper_id").slice(start, stop - start), vectors], names=["paper_id", "vector"]
                )

    return lists.select("paper_id", "terms", "counts").mapInArrow(run, schema)


def topic_vectors_by_steps(
    tf: DataFrame, k: int = TOPICS, steps: int = TOPIC_ITERATIONS, seed: int = 1, inner: int = INNER_ROUNDS
) -> DataFrame:
    """(paper_id, vector) of every paper in (paper_id, term_id, tf); papers without a term have no row."""
    lists = count_lists(tf)
    topics, _ = fit_topics(lists, k, steps, seed, inner)
    return topic_shares(lists, topics)
