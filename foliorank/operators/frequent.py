"""The most frequent terms without shuffling the whole vocabulary.

A corpus of many sources has far more distinct tokens than papers have terms worth keeping.
Each task keeps a summary of at most ``counters`` terms: when it outgrows them, the count of the
first one left out is taken from all, and what it took is its error. A term that a task
has lost had at most that many papers there. Summaries merge by adding counts and errors.
The candidates they leave are then counted exactly in a second pass, and the result is
checked: the last count taken must be above all errors together. If it is not, the
summaries are made again with more counters. Shuffled rows are tasks x counters at most.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import write_once
from .terms import VOCABULARY_SIZE, explode_terms, top_terms

COUNTERS = 1 << 16


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, error = pa.table({"term": pa.array([], pa.string()), "n": pa.array([], pa.int64())}), 0
        for batch in batches:
            lists = batch.column("words").filter(batch.column("words").is_valid())
            coded = lists.flatten().dictionary_encode()
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            codes = coded.indices.to_numpy(zero_copy_only=False)
            # A term counts once a paper.
            distinct = np.unique(owner * max(1, len(coded.dictionary)) + codes) % max(1, len(coded.dictionary))
            n = np.bincount(distinct, minlength=len(coded.dictionary))
            more = pa.table({"term": coded.dictionary.cast(pa.string()), "n": pa.array(n, pa.int64())})
            held = pa.concat_tables([held, more]).group_by("term").aggregate([("n", "sum")]).rename_columns(["term", "n"])
            if len(held) > counters:
                counts = held["n"].to_numpy()
                cut = int(np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1])
                error += cut
                kept = held.filter(pc.greater(held["n"], cut))
                held = pa.table({"term": kept["term"], "n": pc.subtract(kept["n"], cut)})
        # The row without a term carries the task's error.
        terms = pa.concat_arrays([held["term"].combine_chunks() if len(held) else pa.array([], pa.string()), pa.nulls(1, pa.string())])
        counts = np.concatenate([held["n"].to_numpy(), [error]]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([terms, pa.array(counts)], names=["term", "n"])

    return run


def frequent_terms(
    words: DataFrame, size: int = VOCABULARY_SIZE, min_papers: int = 1, max_papers: int | None = None, counters: int = COUNTERS
) -> DataFrame:
    """(term, df, term_id): the ``size`` terms of most papers among those in ``min_papers`` to ``max_papers``.

    Equals ``top_terms`` of the exact frequencies, ties by the term. Null lists are papers without terms.
    """
    words = write_once(words.select("words"), "frequent-words")
    tokens = explode_terms(words.select(F.monotonically_increasing_id().alias("paper_id"), "words"), distinct=True)
    while True:
        summed = words.mapInArrow(_summaries(counters), "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
        merged = write_once(summed, "summaries")
        error = merged.where("term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        found = merged.where("term IS NOT NULL")
        # Terms that may be above the upper end do not count against the size.
        above = found.where(F.col("n") + error > max_papers).count() if max_papers is not None else 0
        least = found.orderBy(F.desc("n")).limit(size + above).agg(F.min("n"), F.count("*")).first()
        floor = least[0] if least[1] == size + above else 0
        candidates = write_once(found.where(F.col("n") + error >= floor).select("term"), "candidates")
        exact = tokens.join(candidates, "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
        band = exact.where(F.col("df") >= min_papers)
        if max_papers is not None:
            band = band.where(F.col("df") <= max_papers)
        top = write_once(top_terms(band, size), "frequent-terms")
        rows, last = top.agg(F.count("*"), F.min("df")).first()
        reached = last if rows == size else min_papers
        if error == 0 or error < reached:
            return top
        counters *= 4
