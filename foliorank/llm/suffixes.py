"""Suffix-array deduplication of bytes that repeat an earlier document.

A byte goes if a ``length``-byte string over it also starts in a document with a
smaller id. Three steps over the whole corpus find them:

1. Anchors. In every window of ``length`` bytes the gram with the smallest hash is
   its anchor, so equal windows have equal anchors, wherever they stand. Anchors are
   narrow rows; one pre-aggregated shuffle finds those of two or more documents.
2. Segments. A second scan cuts out, for each shared anchor, the windows that have
   it: a left part before the anchor and a tail from the anchor on, together fewer
   than twice ``length`` bytes. Equal segments are merged with their smallest and largest
   document before they meet, so a passage that a third of all documents share is
   a handful of rows.
3. Suffix order. The segments of an anchor form a collection whose Burrows-Wheeler
   transform and common-prefix array are built column by column: the tails in order
   are the collection's end markers, and each round inserts the next symbol of every
   segment's left part, from the anchor to the front. Runs of common prefixes of
   ``length`` or more are equal strings; each run's smallest document keeps it, all others
   lose it. An anchor with very many contexts is not held as a collection: its windows
   are grouped one by one.

The rounds are as many as bytes stand before an anchor, not as many as a document has:
that is what lets the construction run in parallel over anchors. The sequential files
of the method are the sorted shuffle files from which a task reads its segments; the
columns of one block of segments are arrays in memory.
"""

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, text_bytes
from .keysets import build_filter, long_column, map_slices, may_hold, shared_keys
from .text_arrays import U, mix

GRAM = 18  # bytes of an anchor; a window of 50 bytes holds 33 of them
BLOCK = 20_000  # segments whose columns are built together
CROWDED = 200_000  # contexts of one anchor beyond which its windows are compared one by one
_LAST = U((1 << 64) - 1)


def _sliding(pick, values: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of every run of ``width`` values, by doubling."""
    step = 1
    while 2 * step <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return pick(values[: -(width - step)], values[width - step :]) if width > step else values


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, key) of all anchors, and the anchor key of the window at every place (0: no window)."""
    size, width = len(data), length - GRAM + 1
    nothing = np.zeros(0, np.int64)
    if size < length:
        return nothing, nothing, nothing.view(np.uint64), nothing.view(np.uint64)
    padded = np.concatenate([data, np.zeros(GRAM + 8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (size + GRAM, 8), (1, 1)).copy().view(np.uint64).ravel()
    keys = words[:size] * U(0x9E3779B97F4A7C15)
    keys ^= (words[8 : 8 + size] * U(0xC2B2AE3D27D4EB4F)) >> U(3)
    keys += words[GRAM - 8 : GRAM - 8 + size] * U(0x165667B19E3779F9)
    keys = mix(keys)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(size)
    keys[left < GRAM] = _LAST
    least = _sliding(np.minimum, keys, width)
    least[left[: len(least)] < length] = 0
    edge = np.zeros(width - 1, np.uint64)
    # A gram is an anchor if it is the smallest of some window that holds it.
    holds = _sliding(np.maximum, np.concatenate([edge, least, edge]), width)
    places = np.flatnonzero((holds == keys) & (left >= GRAM))
    return np.searchsorted(offsets, places, "right") - 1, places, keys[places], least


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low..high] for many ranges."""
    width = 32
    rows = -(-len(values) // width)
    table = np.full(rows * width, np.iinfo(values.dtype).max, values.dtype)
    table[: len(values)] = values
    table = table.reshape(rows, width)
    from_left = np.minimum.accumulate(table, axis=1).ravel()
    to_right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    levels = [table.min(axis=1)]
    while len(levels[-1]) > 1 << (len(levels) - 1):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    found = np.minimum(to_right[low], from_left[high])
    first, last = low // width + 1, high // width - 1
    inner = np.flatnonzero(first <= last)
    if len(inner):
        a, b = first[inner], last[inner]
        level = np.floor(np.log2(b - a + 1)).astype(np.int64)
        for step in np.unique(level):
            at = inner[level == step]
            found[at] = np.minimum(
                found[at], np.minimum(levels[step][first[at]], levels[step][last[at] - (1 << step) + 1])
            )
    same = np.flatnonzero(low // width == high // width)
    if len(same):
        span = low[same, None] + np.arange(width)
        inside = span <= high[same, None]
        picked = np.where(inside, values[np.minimum(span, len(values) - 1)], np.iinfo(values.dtype).max)
        found[same] = picked.min(axis=1)
    return found


def tail_order(keys: np.ndarray, tails: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings by (key, tail), and the prefix each tail has in common with the one before.

    ``tails`` has a row of bytes for each string, padded; bytes past ``sizes`` do not count.
    """
    padded = np.zeros((len(sizes), -(-tails.shape[1] // 8) * 8), np.uint8)
    padded[:, : tails.shape[1]] = np.where(np.arange(tails.shape[1]) < sizes[:, None], tails, 0)
    columns = padded.view(">u8").astype(np.uint64)
    order = np.lexsort([sizes, *columns.T[::-1], keys])
    common = np.zeros(len(sizes), np.uint16)
    one, two = order[:-1], order[1:]
    differ = padded[one] != padded[two]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), padded.shape[1])
    first = np.minimum(first, np.minimum(sizes[one], sizes[two]))
    common[1:] = np.where(keys[one] == keys[two], first, 0)
    return order, common


def suffix_columns(
    data: np.ndarray, lengths: np.ndarray, order: np.ndarray, common: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of a collection in order: (string, symbols before its tail, prefix common with the one before).

    ``data`` holds the strings' left parts one after another; ``order`` and ``common`` are the
    order of their tails, which stand before all other suffixes like end markers. Round
    j inserts every string's suffix with j symbols: its place follows from the rank of its
    first symbol in the transform so far, its common prefixes from a range minimum
    between the places of the suffixes behind the first symbols.
    """
    count = len(lengths)
    ends = np.cumsum(lengths)

    # Symbols are bytes + 1; 0 stands in front of a whole string.
    def symbol(which, length):
        inside = length < lengths[which]
        found = np.zeros(len(which), np.uint16)
        found[inside] = data[(ends[which] - length - 1)[inside]].astype(np.uint16) + 1
        return found

    owner = order.astype(np.int32)
    size = np.zeros(count, np.uint16)
    transform = symbol(order, np.zeros(count, np.int64))
    active, place = order, np.arange(count)
    for j in range(1, int(lengths.max(initial=0)) + 1):
        going = lengths[active] >= j
        active, place = active[going], place[going]
        behind = np.argsort(transform, kind="stable")
        whole = int((transform == 0).sum())
        rank = np.empty(len(behind), np.int64)
        rank[behind] = np.arange(len(behind))
        # Behind every new spot stands, in the old order, the suffix without its first symbol.
        behind = behind[whole:]
        spot = rank[place] - whole + count
        by_spot = np.argsort(spot)
        active, spot = active[by_spot], spot[by_spot]
        total = len(transform) + len(active)

        fresh = np.zeros(total, bool)
        fresh[spot] = True
        merged = []
        for old, new in (
            (owner, active.astype(np.int32)),
            (size, np.full(len(active), j, np.uint16)),
            (transform, symbol(active, np.full(len(active), j))),
            (common, np.zeros(len(active), np.uint16)),
        ):
            column = np.empty(total, old.dtype)
            column[~fresh] = old
            column[fresh] = new
            merged.append(column)
        touched = np.zeros(total + 1, bool)
        touched[spot] = True
        touched[spot + 1] = True
        touched = np.flatnonzero(touched[:total])
        touched = touched[touched > count]
        one, two = behind[touched - 1 - count], behind[touched - count]
        same = transform[one] == transform[two]
        merged[3][touched] = 0
        if same.any():
            merged[3][touched[same]] = _range_min(common, one[same] + 1, two[same]) + 1
        owner, size, transform, common = merged
        place = spot
    return owner, size, common


def first_owners(data, offsets, at, keys, firsts, length):
    """For every ``length``-byte string of the segments: (segment, offset, smallest document).

    Segment i is data[offsets[i]:offsets[i + 1]] with its tail from ``at[i]`` on.
    """
    sizes = np.diff(offsets) - at
    span = np.arange(int(sizes.max(initial=0)))
    tails = data[np.minimum(offsets[:-1, None] + at[:, None] + span, len(data) - 1)]
    order, common = tail_order(keys, tails, sizes)
    total = np.cumsum(at)
    left = data[np.arange(total[-1]) - np.repeat(total - at - offsets[:-1], at)]
    owner, before, common = suffix_columns(left, at, order, common)
    # Strings too short for a window stand before those they begin, never between equal windows.
    enough = before + sizes[owner] >= length
    owner, before, joined = owner[enough], before[enough], (common >= length)[enough]
    heads = np.flatnonzero(~joined)
    if not len(heads):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    smallest = np.minimum.reduceat(firsts[owner], heads)
    smallest = np.repeat(smallest, np.diff(np.concatenate([heads, [len(owner)]])))
    offset = at[owner] - before
    order = np.lexsort((offset, owner))
    return owner[order].astype(np.int64), offset[order].astype(np.int64), smallest[order]


def _runs(block: pa.Table, length: int) -> pa.RecordBatch:
    """Runs of offsets with one smallest document, for whole anchors of a block."""
    block = block.combine_chunks()
    keys, at = block["key"].to_numpy(), block["at"].to_numpy().astype(np.int64)
    data, offsets = text_bytes(block["segment"].chunk(0))
    lengths = np.diff(offsets)
    low, high = block["low"].to_numpy(), block["high"].to_numpy()
    group = np.cumsum(np.concatenate([[True], keys[1:] != keys[:-1]])) - 1
    alone = np.bincount(group)[group] == 1
    # One context only: every string of it belongs to its smallest document.
    single = np.flatnonzero(alone & (low < high))
    several = np.flatnonzero(~alone)
    parts = [(single, np.zeros(len(single), np.int64), lengths[single] - length, low[single])]
    if len(several):
        total = np.cumsum(lengths[several])
        take = np.arange(total[-1]) - np.repeat(total - lengths[several] - offsets[several], lengths[several])
        which, offset, smallest = first_owners(
            data[take], np.concatenate([[0], total]), at[several], keys[several], low[several], length
        )
        if len(which):
            breaks = np.ones(len(which), bool)
            breaks[1:] = (which[1:] != which[:-1]) | (smallest[1:] != smallest[:-1])
            breaks[1:] |= offset[1:] != offset[:-1] + 1
            heads = np.flatnonzero(breaks)
            tails = np.concatenate([heads[1:], [len(which)]]) - 1
            rows = several[which[heads]]
            matter = smallest[heads] < high[rows]
            parts.append((rows[matter], offset[heads][matter], offset[tails][matter], smallest[heads][matter]))
    rows, start, stop, smallest = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays(
        [
            block["part"].chunk(0).take(pa.array(rows)),
            long_column(block["hash"].to_numpy()[rows]),
            pa.array(start, pa.int32()),
            pa.array(stop, pa.int32()),
            long_column(smallest),
        ],
        ["part", "hash", "first_offset", "last_offset", "smallest"],
    )


def _ordered_runs(segments: DataFrame, name: list[Column], length: int) -> DataFrame:
    """Suffix order of all segments: tasks read anchors in order, whole anchors at a time."""

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < BLOCK:
                continue
            table = pa.Table.from_batches(held)
            keys = table["key"].to_numpy()
            cut = int(np.searchsorted(keys == keys[-1], True))
            if cut:
                yield _runs(table.slice(0, cut), length)
                held = table.slice(cut).combine_chunks().to_batches()
                rows = len(keys) - cut
        if rows:
            yield _runs(pa.Table.from_batches(held), length)

    schema = "part int, hash long, first_offset int, last_offset int, smallest long"
    together = segments.repartition("key").sortWithinPartitions("key")
    named = together.select("key", "at", "segment", "low", (F.col("low") + F.col("spread")).alias("high"), *name)
    return named.mapInArrow(run, schema)


def _window_runs(segments: DataFrame, name: list[Column], length: int) -> DataFrame:
    """The rows of ``_ordered_runs`` for anchors with very many contexts, a row a window.

    Equal windows have equal anchors and equal bytes, so each window is a key of its own
    and no task holds an anchor: pre-aggregated minima and maxima give its documents,
    and one join gives them back. A segment has at most length - GRAM + 1 windows.
    """
    high = (F.col("low") + F.col("spread")).alias("high")
    last = F.length("segment") - length
    offsets = segments.where(last >= 0).select(
        "segment", *name, "low", high, F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("offset")
    )
    # A window is named by 96 bits, as segments are.
    window = F.substr("segment", F.col("offset") + 1, F.lit(length))
    windows = offsets.select(
        "part", "hash", "low", "high", "offset", F.hash(window).alias("w_part"), F.xxhash64(window).alias("w_hash")
    )
    ends = windows.groupBy("w_part", "w_hash").agg(F.min("low").alias("smallest"), F.max("high").alias("largest"))
    shared = ends.where("smallest < largest").drop("largest")
    return windows.join(shared, ["w_part", "w_hash"]).where("smallest < high").select(
        "part", "hash", F.col("offset").alias("first_offset"), F.col("offset").alias("last_offset"), "smallest"
    )


def repeated_intervals(texts: DataFrame, length: int, crowded: int | None = None) -> DataFrame:
    """Byte intervals [begin, stop) to remove: (doc_id, row, spans) for documents that lose bytes."""
    known = texts.where("doc_id IS NOT NULL AND text IS NOT NULL")
    scratch = Scratch(texts.sparkSession, "suffixes")

    def mark(part, data, offsets):
        text, _, keys, _ = anchors(data, offsets, length)
        ids = part.column(part.schema.get_field_index("doc_id")).to_numpy()[text]
        order = np.lexsort((keys, ids))
        keys, ids = keys[order], ids[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
        yield pa.RecordBatch.from_arrays([long_column(keys[fresh]), long_column(ids[fresh])], ["key", "owner"])

    shared = scratch.write(shared_keys(map_slices(known, "key long, owner long", mark, 256 << 10)), "anchors")
    passing = build_filter(shared)
    scratch.drop("anchors")
    reach = length - GRAM

    def cut(part, data, offsets):
        text, places, keys, least = anchors(data, offsets, length)
        held = may_hold(passing.value, keys)
        text, places, keys = text[held], places[held], keys[held]
        # The windows that have this anchor are neighbours: from the first to the last of those around it.
        around = places[:, None] - reach + np.arange(reach + 1)
        own = least[np.clip(around, 0, max(len(least) - 1, 0))] == keys[:, None] if len(places) else around > 0
        own &= (around >= offsets[text, None]) & (around < len(least))
        begin = places - reach + own.argmax(axis=1)
        stop = places - own[:, ::-1].argmax(axis=1) + length
        counts = stop - begin
        total = np.cumsum(counts)
        taken = (
            data[np.arange(total[-1]) - np.repeat(total - counts - begin, counts)] if len(total) else data[:0]
        )
        ends = np.concatenate([[0], total]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                long_column(keys),
                pa.array((places - begin), pa.int32()),
                pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(taken)]),
                part.column(part.schema.get_field_index("doc_id")).take(pa.array(text)),
                part.column(part.schema.get_field_index("row")).take(pa.array(text)),
                pa.array(begin - offsets[text], pa.int32()),
            ],
            ["anchor", "at", "segment", "doc_id", "row", "begin"],
        )

    # A segment is named by 96 bits, two hashes of its bytes.
    name = [F.hash("segment", "at").alias("part"), F.xxhash64("segment", "at").alias("hash")]
    schema = "anchor long, at int, segment binary, doc_id long, row int, begin int"
    segments = scratch.write(map_slices(known, schema, cut, 256 << 10), "segments")
    distinct = segments.groupBy("anchor", "at", "segment").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    )
    distinct = scratch.write(distinct.select("anchor", "at", "segment", "low", (F.col("high") - F.col("low")).alias("spread")), "distinct")
    scratch.drop()
    many = distinct.groupBy("anchor").count().where(F.col("count") > (crowded or CROWDED)).select("anchor")
    many = scratch.write(many, "many")
    if many.isEmpty():
        ordered = _ordered_runs(distinct.withColumnRenamed("anchor", "key"), name, length)
    else:
        usual = distinct.join(many, "anchor", "left_anti").withColumnRenamed("anchor", "key")
        crowd = distinct.join(many, "anchor", "left_semi")
        ordered = _ordered_runs(usual, name, length).unionByName(_window_runs(crowd, name, length))
    runs = scratch.write(ordered, "runs")
    scratch.drop("many", "distinct")
    placed = segments.select(*name, "doc_id", "row", "begin")
    hits = placed.join(runs, ["part", "hash"]).where("smallest < doc_id")
    span = F.struct(
        (F.col("begin") + F.col("first_offset")).alias("begin"),
        (F.col("begin") + F.col("last_offset") + length).alias("stop"),
    )
    spans = scratch.write(hits.groupBy("doc_id", "row").agg(F.collect_set(span).alias("spans")), "spans")
    scratch.drop("segments", "runs")
    return spans


def merge_spans(begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by half-open intervals."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(stop[order])
    heads = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
    tails = np.concatenate([heads[1:], [len(begin)]]) - 1
    return begin[heads], reach[tails]


def remove_repeats(
    documents: DataFrame,
    length: int = 50,
    kept_text: bool = False,
    crowded: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and what is asked for.

    Texts are judged as UTF-8 bytes, null as empty, and matches stay inside documents.
    Documents with one id do not remove each other; a document without an id neither
    removes nor loses anything. Texts shorter than ``length`` stay whole, rows that
    repeat have equal results, an empty table gives no rows, and other columns are not
    looked at. ``kept_text`` adds the remaining bytes as text, without characters that a
    cut has split. Texts of any length are judged whole, a slice of about 256 kB at a time or
    one longer text. ``keep`` adds columns of the documents, as struct ``kept``.
    """
    texts = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"),
        documents["text"],
        F.hash(documents["text"]).alias("row"),
        *([F.struct(*[documents[c] for c in keep]).alias("kept")] if keep else []),
    )
    spans = repeated_intervals(texts.select("doc_id", "text", "row"), length, crowded).select(
        F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "spans"
    )
    joined = texts.join(spans, (F.col("doc_id") == F.col("_id")) & (F.col("row") == F.col("_row")), "left")

    def finish(batches):
        for batch in batches:
            texts = batch.column(1)
            data, offsets = text_bytes(texts)
            spans = batch.column(3)
            ends = np.frombuffer(spans.buffers()[1], np.int32)[spans.offset : spans.offset + len(spans) + 1]
            begin = spans.values.field("begin").to_numpy(zero_copy_only=False)
            stop = spans.values.field("stop").to_numpy(zero_copy_only=False)
            valid = spans.is_valid().to_numpy(zero_copy_only=False)
            removed, counts = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            digests, left = [], []
            for i in range(len(texts)):
                own = data[offsets[i] : offsets[i + 1]]
                if valid[i] and ends[i] < ends[i + 1]:
                    a, b = merge_spans(begin[ends[i] : ends[i + 1]], stop[ends[i] : ends[i + 1]])
                    removed[i], counts[i] = int((b - a).sum()), len(a)
                    stays = np.ones(len(own), bool)
                    for x, y in zip(a, b, strict=True):
                        stays[x:y] = False
                    own = own[stays]
                raw = own.tobytes()
                digests.append(hashlib.sha256(raw).hexdigest())
                if kept_text:
                    left.append(raw.decode("utf-8", "ignore"))
            columns = [
                batch.column(0),
                pa.array(np.diff(offsets), pa.int64()),
                pa.array(removed),
                pa.array(counts),
                pa.array(digests, pa.string()),
            ]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if kept_text:
                columns.append(pa.array(left, pa.string()))
                names.append("kept_text")
            if keep:
                columns.append(batch.column(4))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept_text string" if kept_text else ""
    schema = T.StructType.fromDDL(schema)
    chosen = ["doc_id", "text", "row", "spans"]
    if keep:
        schema, chosen = schema.add("kept", texts.schema["kept"].dataType), [*chosen, "kept"]
    return joined.select(*chosen).mapInArrow(finish, schema)


# Brute force over all windows.
SUFFIX_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS number, doc_id, hex(encode(coalesce(text, ''))) AS bytes,
         CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes
  FROM documents),
blocks AS (
  SELECT number, doc_id, n_bytes, block, substr(bytes, 1024 * block + 1, 1024 + 98) AS part
  FROM (SELECT *, unnest(range(0, (n_bytes + 511) // 512)) AS block FROM d)),
starts AS (
  SELECT number, doc_id, 512 * block + j AS pos, substr(part, 2 * j + 1, 100) AS piece
  FROM (SELECT *, unnest(range(0, least(512, n_bytes - 49 - 512 * block))) AS j FROM blocks)),
firsts AS (SELECT piece, min(doc_id) AS first, max(doc_id) AS last FROM starts GROUP BY piece HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT number, pos FROM starts JOIN firsts USING (piece) WHERE first < doc_id),
places AS (
  SELECT number, 512 * block + j AS pos, substr(part, 2 * j + 1, 2) AS byte
  FROM (SELECT *, unnest(range(0, least(512, n_bytes - 512 * block))) AS j FROM blocks
        WHERE number IN (SELECT number FROM hits))),
marked AS (
  SELECT number, pos, byte,
         coalesce(max(CASE WHEN hits.number IS NOT NULL THEN 1 END) OVER (PARTITION BY number ORDER BY pos ROWS 49 PRECEDING), 0) AS gone
  FROM places LEFT JOIN hits USING (number, pos)),
runs AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY number ORDER BY pos) AS before FROM marked),
found AS (
  SELECT number, sum(gone) AS n_removed, sum(CASE WHEN gone = 1 AND before = 0 THEN 1 ELSE 0 END) AS n_spans,
         coalesce(string_agg(byte, '' ORDER BY pos) FILTER (gone = 0), '') AS kept
  FROM runs GROUP BY number)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, bytes))) AS kept_sha256
FROM d LEFT JOIN found USING (number)
"""
