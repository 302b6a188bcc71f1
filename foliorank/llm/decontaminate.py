"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Test items come in blocks of bounded size; each block meets every document in a
scan of its own, so documents are not shuffled. The scan looks for the word n-grams of
the items, all of them however many documents hold one, lays a window of the document
around each seed as far as any alignment through it can reach, and aligns item and window
by words. A window with too few
of the item's words to reach the score is passed by: that bound is exact and keeps
common n-grams cheap. Alignment runs over many windows at once.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import row_key
from .keysets import long_column, map_slices
from .text_arrays import split_words, word_grams

MATCH, OTHER, GAP = 2, -1, 1
LEAST_WORDS = 8  # an alignment is worth at least so many matching words, or the whole item
BLOCK_BYTES = 4 << 20
CELLS = 4_000_000
HITS = 500_000  # places of seeds laid out at once


class Items:
    """A block of test items: word hashes, and n-gram seeds with their places."""

    def __init__(self, rows: list[tuple[int | None, str | None]], n: int):
        texts = [(t or "").encode() for _, t in rows]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        words = split_words(np.frombuffer(b"".join(texts), np.uint8), offsets)
        self.ids = [i for i, _ in rows]
        self.words, self.first, self.sizes = words.hashes, words.first, words.counts
        grams, owner = word_grams(words, n)
        long_enough = self.sizes[owner] >= n
        grams, owner = grams[long_enough], owner[long_enough]
        counts = np.bincount(owner, minlength=len(rows))
        place = np.arange(len(grams)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.seeds, number = np.unique(grams, return_inverse=True)
        order = np.argsort(number, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.start = np.searchsorted(number[order], np.arange(len(self.seeds) + 1))

    def find(self, grams: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``grams``, seed) of all grams that are seeds."""
        maybe = np.flatnonzero(table[(grams & np.uint64(0xFFFF)).astype(np.int64)])
        if not len(self.seeds):
            return maybe[:0], maybe[:0]
        seed = np.minimum(np.searchsorted(self.seeds, grams[maybe]), len(self.seeds) - 1)
        real = self.seeds[seed] == grams[maybe]
        return maybe[real], seed[real]

    def table(self) -> np.ndarray:
        table = np.zeros(1 << 16, bool)
        table[(self.seeds & np.uint64(0xFFFF)).astype(np.int64)] = True
        return table


def align(items: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Best local alignment score of each row of word numbers with its window.

    Unused places hold 0 in items and 1 in windows, which equal nothing. Gaps cost one a
    word, so a row's gaps are one running maximum.
    """
    rows, width = windows.shape
    ramp = np.arange(width + 1, dtype=np.int32) * GAP
    before = np.zeros((rows, width + 1), np.int32)
    best = np.zeros(rows, np.int32)
    for i in range(items.shape[1]):
        score = np.where(windows == items[:, i : i + 1], MATCH, OTHER)
        now = np.maximum(before - GAP, 0)
        np.maximum(now[:, 1:], before[:, :-1] + score, out=now[:, 1:])
        now += ramp
        np.maximum.accumulate(now, axis=1, out=now)
        now -= ramp
        np.maximum(best, now.max(axis=1), out=best)
        before = now
    return best


def _needed(sizes: np.ndarray, min_score: float) -> np.ndarray:
    """The least score of a reported alignment."""
    return np.maximum(min_score * MATCH * sizes, MATCH * np.minimum(sizes, LEAST_WORDS))


def _windows(items: Items, words, at, seed, min_score: float):
    """(text, item, first word, end) of the stretches in which an alignment through a seed can lie.

    Foreign words cost one each and an item is worth two a word, so an alignment that reaches
    its score holds at most (item's worth - least score) of them: that is how far it can
    stray from the seed's diagonal on either side. Overlapping stretches of one
    item become one, so an item cut into pieces is aligned as a whole.
    """
    hits = items.start[seed + 1] - items.start[seed]
    total = np.cumsum(hits)
    flat = np.arange(total[-1]) - np.repeat(total - hits - items.start[seed], hits)
    item, inside = items.owner[flat], items.place[flat]
    word = np.repeat(at, hits)
    text = np.searchsorted(words.first, word, "right") - 1
    sizes = items.sizes[item]
    stray = (MATCH * sizes - _needed(sizes, min_score)).astype(np.int64)
    low = np.maximum(word - inside - stray, words.first[text])
    high = np.minimum(word - inside + sizes + stray, words.first[text + 1])
    return _merged(text, item, low, high)


def _merged(text, item, low, high):
    """Unions of overlapping stretches of the same text and item."""
    order = np.lexsort((low, item, text))
    text, item, low, high = text[order], item[order], low[order], high[order]
    pair = np.cumsum(np.concatenate([[0], (np.diff(text) != 0) | (np.diff(item) != 0)]))
    # The largest end so far inside the pair: ends of later pairs are lifted above earlier ones.
    lift = pair * (int(high.max(initial=0)) + 1)
    reach = np.maximum.accumulate(high + lift)
    fresh = np.ones(len(text), bool)
    fresh[1:] = (pair[1:] != pair[:-1]) | (low[1:] + lift[1:] > reach[:-1])
    start = np.flatnonzero(fresh)
    return text[start], item[start], low[start], np.maximum.reduceat(high, start)


def _words_held(left: np.ndarray, right: np.ndarray, own: np.ndarray, used: np.ndarray) -> np.ndarray:
    """At least how many item words each window holds: what an alignment can match at most.

    Windows are bit tables by the low bits of their words' hashes; a clash only raises the count.
    """
    bits = 1 << int(8 * right.shape[1]).bit_length()
    rows = np.arange(len(left))[:, None] * bits
    table = np.zeros(len(left) * bits, bool)
    table[(rows + (right & np.uint64(bits - 1)).astype(np.int64))[used]] = True
    held = table[rows + (left & np.uint64(bits - 1)).astype(np.int64)]
    return (held & own).sum(axis=1)


def _scores(items: Items, words, item, low, high, need) -> np.ndarray:
    """Alignment scores of windows, in batches of similar length; 0 where ``need`` is out of reach."""
    found = np.zeros(len(item), np.int64)
    widths = high - low
    order = np.argsort(widths, kind="stable")
    longest = np.maximum.accumulate(widths[order])
    start = 0
    while start < len(order):
        ahead = longest[start : start + CELLS]
        fits = np.searchsorted(np.arange(1, len(ahead) + 1) * ahead, CELLS, "right")
        rows = order[start : start + max(1, int(fits))]
        start += len(rows)
        left = np.full((len(rows), int(items.sizes[item[rows]].max())), 0, np.uint64)
        right = np.full((len(rows), int(widths[rows].max())), 1, np.uint64)
        own = np.arange(left.shape[1]) < items.sizes[item[rows], None]
        left[own] = items.words[(items.first[item[rows], None] + np.arange(left.shape[1]))[own]]
        used = np.arange(right.shape[1]) < widths[rows, None]
        right[used] = words.hashes[(low[rows, None] + np.arange(right.shape[1]))[used]]
        able = MATCH * _words_held(left, right, own, used) >= need[rows]
        if able.any():
            found[rows[able]] = align(left[able], right[able])
    return found


def item_blocks(items: DataFrame, id_column: str, block_bytes: int) -> Iterator[list[tuple]]:
    """Items as blocks of bounded size, streamed through the driver."""
    block, size = [], 0
    for row in items.select(items[id_column].cast("long"), items["text"]).toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1] or "")
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_copies(
    documents: DataFrame,
    items: DataFrame,
    n: int = 3,
    min_score: float = 0.5,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pairs of a document and a test item it holds a copy of: doc_id, item_id, score, row.

    ``score`` is the best local alignment as a share of the item's own (two a matching
    word, minus one for another word or a gap); pairs reach ``min_score`` and the worth of
    eight words or of the whole item. Words are split at ASCII white space, A-Z
    lower-cased. Null or empty texts, and items of fewer than ``n`` words, match nothing.
    Ids may be null or repeat: each document row and each item row is searched, and
    equal pairs of one text are given once. Empty tables give no rows; other columns are
    not looked at. ``row`` is a key of the document row.

    All alignments that pass through an n-gram of the item count, with any foreign words
    between its pieces; stretches of a text that no such n-gram is near are not aligned.
    Texts may be of any length: each is aligned in its stretches around seeds only.
    """
    texts = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"])
    texts = texts.withColumn("row", row_key("doc_id", "text"))
    schema = "doc_id long, item_id long, score double, row long"
    found = None
    for rows in item_blocks(items, "item_id", block_bytes):
        block = _search(texts, Items(rows, n), n, min_score, schema)
        found = block if found is None else found.unionByName(block)
    return found if found is not None else texts.sparkSession.createDataFrame([], schema)


def _search(texts: DataFrame, items: Items, n: int, min_score: float, schema: str) -> DataFrame:
    chosen = texts.sparkSession.sparkContext.broadcast((items, items.table()))
    hits_at_once = HITS

    def search(part, data, offsets):
        own, table = chosen.value
        words = split_words(data, offsets)
        grams, owner = word_grams(words, n)
        at, seed = own.find(grams, table)
        if not len(at):
            return
        # Gram number to word number: short texts give one gram, others one a full window.
        counts = words.counts
        per_text = np.where(counts >= n, counts - n + 1, 0)
        keep = at < per_text.sum()  # whole sequences of short texts stand behind all windows
        at, seed = at[keep], seed[keep]
        if not len(at):
            return
        word = at - (np.cumsum(per_text) - per_text)[owner[at]] + words.first[owner[at]]
        laid = np.cumsum(own.start[seed + 1] - own.start[seed])
        stretches = []
        start = 0
        while start < len(at):
            done = laid[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(laid, done + hits_at_once, "right")))
            stretches.append(_windows(own, words, word[start:stop], seed[start:stop], min_score))
            start = stop
        # A cut between hits may part one stretch: its pieces are joined before they are aligned.
        text, item, low, high = _merged(*(np.concatenate(x) for x in zip(*stretches, strict=True)))
        whole, need = MATCH * own.sizes[item], _needed(own.sizes[item], min_score)
        best = _scores(own, words, item, low, high, need)
        good = best >= need
        text, item, share = text[good], item[good], best[good] / whole[good]
        order = np.lexsort((-share, item, text))
        text, item, share = text[order], item[order], share[order]
        top = np.ones(len(text), bool)
        top[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
        text, item, share = text[top], item[top], share[top]
        yield pa.RecordBatch.from_arrays(
            [
                part.column(part.schema.get_field_index("doc_id")).take(pa.array(text)),
                pa.array([own.ids[i] for i in item], pa.int64()),
                pa.array(share, pa.float64()),
                part.column(part.schema.get_field_index("row")).take(pa.array(text)),
            ],
            ["doc_id", "item_id", "score", "row"],
        )

    return map_slices(texts, schema, search, 4 << 20)
