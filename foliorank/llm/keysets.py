"""Keys that two or more owners share, and a filter of fixed size for them.

Content-defined keys (anchors of a text, prefix shingles of a set) are many, and
most belong to one owner only. One pre-aggregated shuffle of narrow rows finds the
shared ones; a Bloom filter of ``bits`` bits, the same size for any corpus, then
lets a second scan leave out the others before anything wide is made. The filter
only saves work: what it lets through is joined with the exact table again.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 27  # 2^27 bits are 16 MB on every executor
_SHIFTS = (0, 18, 37)


def shared_keys(rows: DataFrame) -> DataFrame:
    """(key, first): keys with more than one ``owner``, and the smallest owner."""
    spans = rows.groupBy("key").agg(F.min("owner").alias("first"), F.max("owner").alias("last"))
    return spans.where("first < last").select("key", "first")


def build_filter(keys: DataFrame, bits: int = FILTER_BITS):
    """Broadcast bit array over the well-mixed 64-bit column ``key``.

    The words of the array are OR-ed in one aggregation; the driver receives at most
    2^bits / 64 of them, however many keys there are.
    """
    mask = (1 << bits) - 1
    places = F.array(*[F.shiftrightunsigned("key", s).bitwiseAND(F.lit(mask)) for s in _SHIFTS])
    words = (
        keys.select(F.explode(places).alias("place"))
        .groupBy((F.shiftright("place", 6)).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("set"))
        .toArrow()
    )
    array = np.zeros(max(1, (1 << bits) // 64), np.int64)
    array[words["word"].to_numpy()] = words["set"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(array)


def may_hold(array: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True for every key of the filter, and for few others."""
    mask = np.uint64(len(array) * 64 - 1)
    found = np.ones(len(keys), bool)
    for shift in _SHIFTS:
        place = (keys >> np.uint64(shift)) & mask
        bit = (array[(place >> np.uint64(6)).astype(np.int64)].view(np.uint64) >> (place & np.uint64(63))) & np.uint64(1)
        found &= bit.astype(bool)
    return found


def long_column(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def lists(values: np.ndarray, counts: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    """List column of consecutive runs of ``counts`` values; null where asked."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), long_column(values), mask=None if null is None else pa.array(null)
    )


def map_slices(
    frame: DataFrame, schema: str, work: Callable[..., Iterator[pa.RecordBatch]], max_bytes: int = 1 << 20
) -> DataFrame:
    """Apply ``work(batch, data, offsets)`` to slices of rows with about ``max_bytes`` of ``text``."""
    from .common import text_bytes, text_slices

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for start, stop in text_slices(texts, max_bytes):
                part = batch.slice(start, stop - start)
                data, offsets = text_bytes(texts.slice(start, stop - start))
                yield from work(part, data, offsets)

    return frame.mapInArrow(run, schema)


