"""Ranked lexical search by hashed max-sketches: the k best documents of every item, exactly.

A term of a document has an impact that no query changes: a saturating function of its
frequency and the document's length. Each document folds the impacts of the terms that
occur in some query into ``coordinates`` maxima, a term's coordinate being its hash.
Looking up an item's terms in the sketch, weighted, bounds its score from above, because
a coordinate is never below the impact of a term that falls on it. The lookups of all
items of a block and all documents of a slice are one matrix product. A task then
takes an item's documents by descending bound, scores them exactly, and stops at the
first bound below the k-th best score it has seen so far in any of its slices. Each
task returns k documents an item at most, and a ranking in two steps keeps the k best of all.

Two passes over the texts: counts (documents, terms, and the document frequency of query
terms, summed per task), then scores. Items come in blocks of at most ``BLOCK_ITEMS`` rows and
``BLOCK_BYTES`` of text, each with its own two passes; a block's terms and weights are the
only data sent to all tasks. Whole texts are read, a slice of about 1 MB at a time; a longer
text is a slice of its own.

Null and empty texts hold no term: such a document matches nothing, such an item has no rows.
Rows that repeat are documents (items) of their own. Equal scores stand by ascending
doc_id, null last. Empty tables give no rows, and extra columns are ignored. Terms are
compared by 64-bit hashes of their bytes and lengths.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, text_bytes, text_slices
from .text_arrays import split_words

COORDINATES = 1024
BLOCK_ITEMS, BLOCK_BYTES = 1024, 1 << 20
_SALTS = 64
_STEP = 32  # documents scored between two looks at the threshold

# A term is a run of ASCII letters, digits and characters beyond ASCII.
_GAPS = np.ones(256, bool)
_GAPS[0x30:0x3A] = _GAPS[0x41:0x5B] = _GAPS[0x61:0x7B] = _GAPS[0x80:] = False


class Block:
    """Items of one block: their distinct terms, and each item's terms with repeats."""

    def __init__(self, ids: list, texts: list):
        self.ids = ids
        words = split_words(*text_bytes(pa.array(texts, pa.large_string())), _GAPS)
        self.terms, places = np.unique(words.hashes, return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), words.counts)
        pairs, self.repeats = np.unique(owner * max(1, len(self.terms)) + places, return_counts=True)
        self.owner, self.term = np.divmod(pairs, max(1, len(self.terms)))
        self.first = np.searchsorted(self.owner, np.arange(len(ids) + 1))


def item_blocks(items: DataFrame) -> Iterator[Block]:
    """Items with a text, in blocks of bounded size."""
    ids, texts, held = [], [], 0
    for row in items.select("item_id", "text").where("text IS NOT NULL").toLocalIterator(prefetchPartitions=True):
        if ids and (len(ids) >= BLOCK_ITEMS or held + len(row["text"]) > BLOCK_BYTES):
            yield Block(ids, texts)
            ids, texts, held = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        held += len(row["text"])
    if ids:
        yield Block(ids, texts)


def _slices(batches: Iterator[pa.RecordBatch], terms: np.ndarray):
    """Per slice: the batch's rows, words per document, and sorted (document x term) keys with frequencies."""
    size = max(1, len(terms))
    for batch in batches:
        texts = batch.column("text")
        for start, stop in text_slices(texts, 1 << 20):
            words = split_words(*text_bytes(texts.slice(start, stop - start)), _GAPS)
            places = np.minimum(np.searchsorted(terms, words.hashes), size - 1)
            known = terms[places] == words.hashes
            owner = np.repeat(np.arange(stop - start), words.counts)
            keys, frequency = np.unique(owner[known] * size + places[known], return_counts=True)
            yield batch, start, words.counts, keys, frequency


def term_counts(docs: DataFrame, terms: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms with repeats, and the documents that hold each of ``terms``."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        found, documents, words = np.zeros(len(sent.value), np.int64), 0, 0
        for _, _, counts, keys, _ in _slices(batches, sent.value):
            documents += int((counts > 0).sum())
            words += int(counts.sum())
            found += np.bincount(keys % len(found), minlength=len(found))
        kept = np.flatnonzero(found)
        names = np.concatenate([[-1, -2], kept])
        values = np.concatenate([[documents, words], found[kept]])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(values, pa.int64())], names=["term", "n"])

    rows = docs.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counted = dict(zip(rows["term"].to_pylist(), rows["n"].to_pylist()))
    frequency = np.zeros(len(terms), np.int64)
    for term, n in counted.items():
        if term >= 0:
            frequency[term] = n
    sent.unpersist()
    return counted.get(-1, 0), counted.get(-2, 0), frequency


def term_weights(documents: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in frequency], np.int64)


def impacts(frequency: np.ndarray, length: np.ndarray, documents: int, words: int) -> np.ndarray:
    """Of a term's frequency in documents of ``length`` terms; whole numbers, as the contract has them."""
    measure = 25 + (75 * length * documents) // max(1, words)
    return (1_000_000_000 * frequency) // (1000 * frequency + 8 * measure)


def sketch(keys: np.ndarray, impact: np.ndarray, coordinate: np.ndarray, rows: int, coordinates: int) -> np.ndarray:
    """(coordinates x documents) maxima of the impacts of the terms on each coordinate."""
    out = np.zeros(coordinates * rows)
    if len(keys):
        owner, term = np.divmod(keys, len(coordinate))
        cell = coordinate[term] * rows + owner
        order = np.argsort(cell, kind="stable")
        cell, impact = cell[order], impact[order]
        start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        out[cell[start]] = np.maximum.reduceat(impact, start)
    return out.reshape(coordinates, rows)


def _best(block: Block, weights: np.ndarray, documents: int, words: int, k: int, coordinates: int):
    coordinate = (block.terms % np.uint64(coordinates)).astype(np.int64)
    worth = weights[block.term] * block.repeats
    lookup = np.zeros((len(block.ids), coordinates))
    np.add.at(lookup, (block.owner, coordinate[block.term]), worth)

    def run(batches):
        best = [[] for _ in block.ids]
        least = np.ones(len(block.ids))  # a score to reach: above 0, and not below the k-th best
        for batch, start, counts, keys, frequency in _slices(batches, block.terms):
            impact = impacts(frequency, counts[keys // max(1, len(block.terms))], documents, words)
            bounds = lookup @ sketch(keys, impact, coordinate, len(counts), coordinates)
            # Sums of whole numbers below 2^53 are exact; a larger one may lose its last bits.
            bounds *= 1 + 1e-12
            ids = batch.column("doc_id")
            for item in np.flatnonzero((bounds >= least[:, None]).any(axis=1)):
                rows = np.flatnonzero(bounds[item] >= least[item])
                rows = rows[np.argsort(-bounds[item][rows], kind="stable")]
                own = slice(block.first[item], block.first[item + 1])
                term, worths = block.term[own], worth[own]
                for at in range(0, len(rows), _STEP):
                    if bounds[item][rows[at]] < least[item]:
                        break
                    step = rows[at : at + _STEP]
                    wanted = step[:, None] * len(block.terms) + term[None, :]
                    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    scores = (np.where(keys[place] == wanted, impact[place], 0) * worths).sum(axis=1)
                    for row, score in zip(step, scores):
                        if score >= least[item]:
                            name = ids[start + int(row)].as_py()
                            best[item].append((-int(score), name is None, name))
                    best[item] = sorted(best[item])[:k]
                    if len(best[item]) == k:
                        least[item] = -best[item][-1][0]
        rows = [(item, -s, name) for item, own in enumerate(best) for s, _, name in own]
        columns = [pa.array([r[i] for r in rows], t) for i, t in ((0, pa.int32()), (1, pa.int64()), (2, id_type[0]))]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "score", "doc_id"])

    id_type = [pa.int64()]
    return run, id_type


def search(docs: DataFrame, items: DataFrame, k: int = 10, coordinates: int = COORDINATES) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of every item with a score above 0."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    id_field, item_field = docs.schema["doc_id"], items.schema["item_id"]
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = []
    for block in item_blocks(items):
        if not len(block.terms):
            continue
        documents, words, frequency = term_counts(texts, block.terms)
        run, id_type = _best(block, term_weights(documents, frequency), documents, words, k, coordinates)
        id_type[0] = to_arrow_type(id_field.dataType)
        found = texts.mapInArrow(run, f"item int, score bigint, doc_id {id_field.dataType.simpleString()}")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        salted = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS))).orderBy(*order)
        first = found.withColumn("place", F.row_number().over(salted)).where(F.col("place") <= k)
        ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
        names = spark.createDataFrame(
            list(enumerate(block.ids)), f"item int, item_id {item_field.dataType.simpleString()}"
        )
        kept = ranked.where(F.col("rank") <= k).join(F.broadcast(names), "item")
        parts.append(scratch.write(kept.select("item_id", "rank", "doc_id", "score"), "best"))
    if not parts:
        schema = f"item_id {item_field.dataType.simpleString()}, rank int, doc_id {id_field.dataType.simpleString()}, score bigint"
        return spark.createDataFrame([], schema)
    if len(parts) == 1:
        return parts[0]
    return spark.read.schema(parts[0].schema).parquet(*scratch.paths["best"])


SEARCH_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
sizes AS (SELECT row, doc_id, len(terms) AS n FROM words WHERE len(terms) > 0),
totals AS (SELECT count(*) AS documents, sum(n)::BIGINT AS words FROM sizes),
asked AS (
  SELECT item, any_value(item_id) AS item_id, term, count(*) AS repeats
  FROM (SELECT item, item_id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark WHERE text IS NOT NULL))
  GROUP BY item, term),
held AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM words)
  WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM held, totals GROUP BY term, documents),
scores AS (
  SELECT item, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id,
         sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // words))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (row), totals
  GROUP BY item, row)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
      FROM scores WHERE score > 0)
WHERE rank <= 10
"""
