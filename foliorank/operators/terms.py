"""Token lists as rows, and the vocabulary built from them."""

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import new_byte_folder, write_once
from .joins import heavy_keys, join_heavy

# The document-frequency band and the size of the vocabulary.
MIN_PAPERS = 20
MAX_PAPER_SHARE = 0.1
VOCABULARY_SIZE = 1000

# Ranges of paper ids in which the places of a merged list are counted.
PAPER_CELLS = 64
# Bytes of token lists that a task unpacks at once.
UNPACKED_BYTES = 4 << 20
_NULL = -1
_NO_TOKENS = zlib.compress(bytes(4))
# Where a packed list lies: the task attempt whose file holds it, its first byte and its size.
_PLACE = "<qqi"
# Files that a task keeps open.
_OPEN_FILES = 128


def count_distinct_papers(papers: DataFrame) -> DataFrame:
    """Number of distinct (paper_id, title, abstract) rows.

    Rows are compared by id and a 256-bit digest of their text, so the shuffle
    carries some 80 bytes a row and not the text.
    """
    text = F.to_json(F.struct("title", "abstract"), {"ignoreNullFields": "false"})
    rows = papers.select("paper_id", F.sha2(text, 256).alias("_digest")).distinct()
    return rows.agg(F.count(F.lit(1)).alias("n_papers"))


def explode_terms(words: DataFrame, distinct: bool = False) -> DataFrame:
    """(paper_id, words) as (paper_id, term); ``distinct`` keeps a term once a row."""
    listed = F.array_distinct("words") if distinct else F.col("words")
    return words.select("paper_id", F.explode(listed).alias("term"))


def document_frequency(words: DataFrame) -> DataFrame:
    """Papers per term: repeats go inside the row, counts combine before the shuffle."""
    terms = explode_terms(words, distinct=True)
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def document_frequency_band(
    frequencies: DataFrame,
    n_papers: DataFrame,
    min_papers: int = MIN_PAPERS,
    max_share: float = MAX_PAPER_SHARE,
) -> DataFrame:
    """Terms in at least ``min_papers`` papers and at most ``max_share`` of them."""
    share = F.col("df") / n_papers.scalar()
    return frequencies.filter((F.col("df") >= min_papers) & (share <= max_share))


def top_terms(frequencies: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """The most frequent terms, numbered from 0; ties go by the term.

    The top is taken before numbering, so one task sees ``size`` rows at most.
    """
    top = frequencies.orderBy(F.desc("df"), "term").limit(size)
    by_frequency = Window.orderBy(F.desc("df"), "term")
    return top.withColumn("term_id", (F.row_number().over(by_frequency) - 1).cast("bigint"))


def keep_vocabulary_terms(terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(paper_id, term) rows whose term is in the vocabulary.

    The vocabulary is written first: its measured size decides whether it is broadcast.
    """
    return terms.join(write_once(vocabulary.select("term"), "vocabulary"), "term", "left_semi")


def nest_terms(words: DataFrame) -> DataFrame:
    """A paper's terms as one sorted list (a list is bounded by the paper's text)."""
    return words.select("paper_id", F.array_sort("words").alias("terms"))


def nest_term_rows(rows: DataFrame) -> DataFrame:
    """(paper_id, term) rows as one sorted list a paper, repeats kept (bounded by the paper's text)."""
    return rows.groupBy("paper_id").agg(F.array_sort(F.collect_list("term")).alias("terms"))


def paper_cells(papers: DataFrame, cells: int = PAPER_CELLS) -> DataFrame:
    """Add ``_cell`` to rows of distinct papers: ranges of paper_id, in order; a written table."""
    ranged = papers.repartitionByRange(cells, "paper_id").withColumn("_cell", F.spark_partition_id())
    return write_once(ranged, "paper-cells")


def pack_lists(words: DataFrame, folder: str | None = None) -> DataFrame:
    """(paper_id, tokens, bytes, packed): token lists as compressed bytes, with their number of tokens and size.

    Packed are the number of tokens, their lengths (-1: null) and their characters; a null list is null.
    With a ``folder`` of bytes the lists lie there, in a file a task, and ``packed`` are their places.
    """

    def rows(batches: Iterator[pa.RecordBatch], put: Callable[[bytes], bytes]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sizes, packed = [], [], []
            words = batch.column("words")
            ends = np.cumsum(words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            tokens = words.flatten().cast(pa.string())
            lengths = pc.binary_length(tokens).fill_null(_NULL).to_numpy(zero_copy_only=False).astype(np.int32)
            held_to = np.cumsum(np.maximum(lengths, 0), dtype=np.int64)
            # A null token has no characters, so those of a list lie side by side.
            filled = tokens.fill_null("")
            _, offsets, data = filled.buffers()
            begin = int(np.frombuffer(offsets, np.int32)[filled.offset]) if len(filled) else 0
            text = memoryview(data or b"")[begin:]
            first, at = 0, 0
            for known, last in zip(words.is_valid().to_pylist(), ends.tolist()):
                stop = int(held_to[last - 1]) if last else 0
                held = np.int32(last - first).tobytes() + lengths[first:last].tobytes() + bytes(text[at:stop])
                counts.append(last - first if known else None)
                sizes.append(len(held))
                packed.append(put(zlib.compress(held)) if known else None)
                first, at = last, stop
            made = [pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("paper_id"), *made], names=["paper_id", "tokens", "bytes", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if folder is None:
            yield from rows(batches, bytes)
            return
        attempt = TaskContext.get().taskAttemptId()
        system, path = fs.FileSystem.from_uri(f"{folder}/{attempt}")
        with system.open_output_stream(path) as file:

            def put(held: bytes) -> bytes:
                at = file.tell()
                file.write(held)
                return struct.pack(_PLACE, attempt, at, len(held))

            yield from rows(batches, put)

    kind = words.schema["paper_id"].dataType.simpleString()
    return words.select("paper_id", "words").mapInArrow(run, f"paper_id {kind}, tokens bigint, bytes bigint, packed binary")


def _reader(folder: str | None) -> Callable[[bytes | None], bytes | None]:
    """From ``packed`` of ``pack_lists`` to the compressed bytes."""
    if folder is None:
        return lambda packed: packed

    @lru_cache(_OPEN_FILES)
    def opened(attempt: int) -> pa.NativeFile:
        system, path = fs.FileSystem.from_uri(f"{folder}/{attempt}")
        return system.open_input_file(path)

    def read(place: bytes | None) -> bytes | None:
        if place is None:
            return None
        attempt, at, size = struct.unpack(_PLACE, place)
        return opened(attempt).read_at(size, at)

    return read


def _token_array(packed: list[bytes | None]) -> tuple[pa.Array, np.ndarray]:
    """All tokens of packed lists, and how many each list has."""
    held = [zlib.decompress(x or _NO_TOKENS) for x in packed]
    counts = [int.from_bytes(x[:4], "little") for x in held]
    lengths = np.concatenate([np.frombuffer(x, np.int32, n, 4) for x, n in zip(held, counts)])
    data = b"".join(x[4 + 4 * n :] for x, n in zip(held, counts))
    offsets = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))]).astype(np.int32)
    known = np.packbits(lengths != _NULL, bitorder="little")
    buffers = [pa.py_buffer(x) for x in (known, offsets, data)]
    return pa.Array.from_buffers(pa.string(), len(lengths), buffers), np.array(counts, np.int64)


def _token_order(packed: bytes | None) -> tuple:
    """Key by which lists of one paper are ordered: null first, then by their tokens, null tokens first."""
    return packed is not None, [(w is not None, w or "") for w in _token_array([packed])[0].to_pylist()]


def _unpacked(
    batches: Iterator[pa.RecordBatch], read: Callable[[bytes | None], bytes | None]
) -> Iterator[pa.RecordBatch]:
    """(user_id, part, by_paper) as (user_id, part, words): a row's lists one after another, null if one of them is."""
    for batch in batches:
        papers, sizes, packed = batch.column("by_paper").flatten().flatten()
        counts = batch.column("by_paper").value_lengths().to_numpy(zero_copy_only=False)
        ends = np.cumsum(counts)
        bytes_to = np.cumsum(sizes.to_numpy(zero_copy_only=False))[ends - 1]
        start = 0
        while start < len(ends):
            first, done = (ends[start - 1], bytes_to[start - 1]) if start else (0, 0)
            stop = max(start + 1, int(np.searchsorted(bytes_to, done + UNPACKED_BYTES, "right")))
            owner = np.repeat(np.arange(stop - start), counts[start:stop])
            ids = papers.slice(first, len(owner)).to_pylist()
            lists = [read(x) for x in packed.slice(first, len(owner)).to_pylist()]
            if any(a == b and x != y for a, b, x, y in zip(ids, ids[1:], lists, lists[1:])):
                # A paper with several lists: they go by their tokens.
                lists = [x for _, _, _, x in sorted(zip(owner, ids, map(_token_order, lists), lists), key=lambda r: r[:3])]
            tokens, lengths = _token_array(lists)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, lengths, stop - start))]).astype(np.int32)
            gap = np.bincount(owner, [x is None for x in lists], stop - start) > 0
            words = pa.ListArray.from_arrays(pa.array(offsets), tokens, mask=pa.array(gap))
            rows = batch.slice(start, stop - start)
            yield pa.RecordBatch.from_arrays([rows.column("user_id"), rows.column("part"), words], names=["user_id", "part", "words"])
            start = stop


def merge_token_lists(
    pairs: DataFrame, words: DataFrame, part_tokens: int = 1_000_000, cells: int = PAPER_CELLS
) -> DataFrame:
    """Token lists of a user's papers, merged in paper order: (user_id, part, words).

    The merged list is cut, between papers, each time it passes ``part_tokens``
    tokens: the parts in order are the merged list for a library of any size, and
    no row holds more than a part and a paper.

    A paper's place is a weighted prefix sum in two levels: papers are dealt once into
    ``cells`` ranges of their ids, tokens are summed per user and cell before the
    shuffle, and only the sums of the cells and the papers inside one cell
    are ever ordered. So a library that holds a third of all pairs is spread over all cells.
    Packed lists are written once to the shared folder, and only their places travel to the readers: a
    popular paper's list is read where it is merged, not copied by a shuffle. Where tasks cannot open that
    folder, the packed lists travel themselves.
    """
    folder = new_byte_folder(words.sparkSession, "packed-lists")
    words = write_once(pack_lists(words, folder), "token-lists")
    sizes = words.select("paper_id", F.col("tokens").alias("_tokens"))
    sized = pairs.join(paper_cells(sizes, cells), "paper_id")
    in_user = Window.partitionBy("user_id").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        sized.groupBy("user_id", "_cell")
        .agg(F.sum("_tokens").alias("_sum"))
        .select("user_id", "_cell", F.coalesce(F.sum("_sum").over(in_user), F.lit(0)).alias("_before"))
    )
    in_cell = (
        Window.partitionBy("user_id", "_cell").orderBy("paper_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.col("_before") + F.coalesce(F.sum("_tokens").over(in_cell), F.lit(0))
    placed = sized.join(before, ["user_id", "_cell"]).select(
        "user_id", F.floor(offset / part_tokens).alias("part"), "paper_id"
    )
    # A popular paper's row is copied to each of its readers: its readers are split over tasks.
    joined = join_heavy(placed, words.drop("tokens"), "paper_id", heavy_keys(pairs, "paper_id"))
    # Dealt first, so that no task collects lists before the shuffle.
    by_paper = F.array_sort(F.collect_list(F.struct("paper_id", "bytes", "packed"))).alias("by_paper")
    merged = joined.repartition("user_id", "part").groupBy("user_id", "part").agg(by_paper)
    kind = merged.schema["user_id"].dataType.simpleString()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _unpacked(batches, _reader(folder))

    return merged.mapInArrow(unpack, f"user_id {kind}, part {merged.schema['part'].dataType.simpleString()}, words array<string>")
