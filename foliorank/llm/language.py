"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over hashed
byte n-grams separates the languages with that bit from the others; its weights are
log-odds from n-gram counts over all training texts, each language counting the same.
A text's mean weight is the bit's margin. Decoding sums a logistic loss over bits,
weighted by how reliably the bit was predicted for that language in training, and
takes the codeword of least loss; a small lead over the second is flagged.

Counting, weighing and predicting are one scan each. Tasks add up counts before they
send anything, so what is shuffled depends on tasks, languages and buckets, not on
texts. The model is languages x buckets, of fixed size.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_bytes, text_slices

BUCKETS = 1 << 15
GRAMS = (2, 4)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def codewords(languages: int, seed: int = 5) -> np.ndarray:
    """Rows of +1 and -1: all splits of up to seven languages, else the best of random codes."""
    if languages <= 7:
        splits = np.arange(1, max(2, 1 << max(languages - 1, 0)))
        bits = (splits[None, :] >> np.arange(languages)[:, None]) & 1
        return np.where(bits == 1, 1, -1)
    length = math.ceil(10 * math.log2(languages))
    rng = np.random.default_rng(seed)
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice([-1, 1], (languages, length))
        if (np.abs(code.sum(axis=0)) == languages).any():
            continue
        distance = (length - code @ code.T) // 2 + np.eye(languages, dtype=int) * length
        if distance.min() > apart:
            best, apart = code, distance.min()
    return best


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte n-grams (A-Z lower-cased, texts framed by blanks) and their texts."""
    sizes = np.diff(offsets)
    framed = np.full(len(data) + 2 * len(sizes) + 8, 32, np.uint8)
    starts = offsets[:-1] + 2 * np.arange(len(sizes))
    framed[np.arange(len(data)) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)] = _LOWER[data]
    length = len(data) + 2 * len(sizes)
    words = np.zeros(length, np.uint32)
    for i in range(4):
        words |= framed[i : i + length].astype(np.uint32) << np.uint32(8 * i)
    owner = np.repeat(np.arange(len(sizes)), sizes + 2)
    left = np.repeat(starts + sizes + 2, sizes + 2) - np.arange(length)
    buckets, owners = [], []
    for n in GRAMS:
        keys = words & np.uint32((1 << (8 * n)) - 1) if n < 4 else words
        inside = left >= n
        hashed = ((keys + np.uint32(n)) * np.uint32(0x9E3779B1)) ^ (keys >> np.uint32(13))
        buckets.append(((hashed * np.uint32(0x85EBCA6B)) >> np.uint32(17))[inside])
        owners.append(owner[inside])
    return np.concatenate(buckets), np.concatenate(owners)


def margins(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean weight of every text for every bit; 0 for an empty text."""
    buckets, owner = gram_buckets(data, offsets)
    texts = len(offsets) - 1
    counts = np.maximum(np.bincount(owner, minlength=texts), 1)
    sums = [np.bincount(owner, weights=w[buckets], minlength=texts) for w in weights]
    return np.stack(sums, axis=1) / counts[:, None]


def held_out(doc_id: str | Column, modulus: int = 3) -> Column:
    """True where crc32 of the id's text leaves 1; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus)) == 1, F.lit(False))


def _count(training: DataFrame) -> DataFrame:
    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for start, stop in text_slices(batch.column(0), 1 << 20):
                data, offsets = text_bytes(batch.column(0).slice(start, stop - start))
                buckets, owner = gram_buckets(data, offsets)
                names = batch.column(1).slice(start, stop - start).dictionary_encode()
                code = names.indices.to_numpy()[owner]
                size = len(names.dictionary)
                table = np.bincount(code * BUCKETS + buckets, minlength=size * BUCKETS).reshape(size, BUCKETS)
                for name, row in zip(names.dictionary.to_pylist(), table, strict=True):
                    counts[name] = counts.get(name, 0) + row
        for name, row in counts.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(row[used], pa.int64())],
                ["lang", "bucket", "n"],
            )

    return training.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long")


def fit(training: DataFrame):
    """(languages, code, weights, reliability) from all rows of (text, lang)."""
    table = _count(training).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(table["lang"].to_pylist()), key=str.encode)
    code = codewords(len(languages))
    if len(languages) < 2:
        return languages, code, np.zeros((code.shape[1], BUCKETS)), np.ones(code.shape)
    number = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS))
    rows = np.array([number[x] for x in table["lang"].to_pylist()])
    counts[rows, table["bucket"].to_numpy()] = table["n"].to_numpy()
    shares = (counts + 0.05) / (counts.sum(axis=1, keepdims=True) + 0.05 * BUCKETS)
    weights = np.stack(
        [np.log(shares[bit == 1].mean(axis=0)) - np.log(shares[bit == -1].mean(axis=0)) for bit in code.T]
    )
    shipped = training.sparkSession.sparkContext.broadcast((number, code, weights))

    def right(batches):
        number, code, weights = shipped.value
        hits, seen = np.zeros(code.shape, np.int64), np.zeros(len(number), np.int64)
        for batch in batches:
            for start, stop in text_slices(batch.column(0), 1 << 20):
                data, offsets = text_bytes(batch.column(0).slice(start, stop - start))
                own = np.array([number[x] for x in batch.column(1).slice(start, stop - start).to_pylist()])
                agreed = np.sign(margins(weights, data, offsets)) == code[own]
                np.add.at(hits, own, agreed)
                seen += np.bincount(own, minlength=len(seen))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(number)), code.shape[1]), pa.int32()),
                pa.array(np.tile(np.arange(code.shape[1]), len(number)), pa.int32()),
                pa.array(hits.ravel()),
                pa.array(np.repeat(seen, code.shape[1])),
            ],
            ["lang", "bit", "hits", "seen"],
        )

    judged = (
        training.select("text", "lang")
        .mapInArrow(right, "lang int, bit int, hits long, seen long")
        .groupBy("lang", "bit")
        .agg(F.sum("hits").alias("hits"), F.sum("seen").alias("seen"))
        .toArrow()
    )
    reliability = np.full(code.shape, 0.5)
    reliability[judged["lang"].to_numpy(), judged["bit"].to_numpy()] = (judged["hits"].to_numpy() + 1) / (
        judged["seen"].to_numpy() + 2
    )
    return languages, code, weights, reliability


def identify(documents: DataFrame, modulus: int = 3, sharpness: float = 8.0, lead: float = 0.2) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score and ambiguous.

    Learns from text and non-null lang of documents that are not held out; a null id is
    not held out and not learned from. Null texts and texts without a letter are
    ``und`` with score 0, as is everything when nothing was learned; with one learned
    language every other text has it, with score 1. ``score`` is the codeword's share of
    exp(-loss). Texts of any length are read whole, in slices of about 1 MB or one longer
    text. ``ambiguous`` tells that the second best is within ``lead`` of it. Rows that
    repeat are judged alike, ties go to the first language by code point, an empty
    table gives no rows, other columns are not looked at.
    """
    frame = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"), documents["text"], documents["lang"].cast("string").alias("lang")
    ).withColumn("held_out", held_out("doc_id", modulus))
    letters = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    training = frame.where(~F.col("held_out") & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & letters)
    model = frame.sparkSession.sparkContext.broadcast((*fit(training), sharpness, lead))

    def run(batches):
        languages, code, weights, reliability, sharpness, lead = model.value
        trust = reliability / reliability.sum(axis=1, keepdims=True)
        for batch in batches:
            for start, stop in text_slices(batch.column(1), 1 << 20):
                part = batch.slice(start, stop - start)
                data, offsets = text_bytes(part.column(1))
                known = part.column(3).to_numpy(zero_copy_only=False)
                rows = len(known)
                best, score, close = np.zeros(rows, int), np.ones(rows), np.zeros(rows, bool)
                if len(languages) > 1:
                    at = sharpness * margins(weights, data, offsets)
                    loss = (np.logaddexp(0, -at[:, None, :] * code[None]) * trust[None]).sum(axis=2)
                    best = loss.argmin(axis=1)
                    shares = np.exp(loss.min(axis=1, keepdims=True) - loss)
                    score = 1 / shares.sum(axis=1)
                    ordered = np.sort(loss, axis=1)
                    close = ordered[:, 1] - ordered[:, 0] < lead
                known = known & bool(languages)
                names = [languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(names, pa.string()),
                        pa.array(np.where(known, score, 0.0)),
                        pa.array(close & known),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
                )

    return frame.select("doc_id", "text", "held_out", letters.alias("letters")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
    )
