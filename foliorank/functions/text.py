"""Text steps as column expressions; tokens are cut from text and stemmed in Arrow batches."""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stemmer import stem_word

# Characters that belong to a token, and the shortest token kept.
TOKEN_CHARACTERS = b"abcdefghijklmnopqrstuvwxyz_-"
MIN_TOKEN_LENGTH = 3
# Bytes of text that a task cuts into tokens at once; a longer text is cut alone.
CUT_BYTES = 1 << 22
# Tokens that a task stems at once.
STEMMED_TOKENS = 1 << 17


def concat_text(title: str | Column = "title", abstract: str | Column = "abstract") -> Column:
    """Title and abstract joined by a blank; a null part is skipped."""
    return F.concat_ws(" ", title, abstract)


_INSIDE = np.isin(np.arange(256), list(TOKEN_CHARACTERS))


def _bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of non-null strings, as views."""
    strings = strings.cast(pa.string())
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1] if offsets else np.zeros(1, np.int32)
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def _strings(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings from their bytes and their ends, the first of which is 0."""
    offsets = pa.py_buffer(ends.astype(np.int32).tobytes())
    return pa.StringArray.from_buffers(len(ends) - 1, offsets, pa.py_buffer(data.tobytes()))


def _cut(data: np.ndarray, rows: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(tokens, tokens before the end of each row) of texts that begin and end at ``rows``."""
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[rows] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    long = last - first >= MIN_TOKEN_LENGTH - 1
    # Short runs lose all their bytes: the first, the last and any between.
    for place in range(MIN_TOKEN_LENGTH - 1):
        inside[np.minimum(first + place, last)[~long]] = False
    first, last = first[long], last[long]
    ends = np.concatenate([[0], np.cumsum(last - first + 1)])
    return _strings(data[inside], ends), np.searchsorted(first, rows[1:])


def _token_lists(texts: pa.Array) -> pa.Array:
    whole = pc.fill_null(texts, "")
    sizes = np.cumsum(pc.binary_length(whole).to_numpy(zero_copy_only=False), dtype=np.int64)
    parts, counts, start = [pa.array([], pa.string())], [np.zeros(1, np.int64)], 0
    while start < len(whole):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + CUT_BYTES, "right")))
        tokens, own = _cut(*_bytes(whole.slice(start, stop - start)))
        counts.append(own + counts[-1][-1])
        parts.append(tokens)
        start = stop
    offsets = pa.array(np.concatenate(counts).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.concat_arrays(parts), mask=texts.is_null())


@F.arrow_udf(T.ArrayType(T.StringType()))
def _tokens(texts: pa.Array) -> pa.Array:
    return _token_lists(texts)


def tokenize(text: str | Column) -> Column:
    """Lower-cased runs of token characters, at least three long.

    Taking the runs out gives the same list as splitting on every other
    character and dropping short pieces. All token characters are single bytes, which no
    other character of UTF-8 holds, so the runs are those of a text's bytes.
    """
    return _tokens(F.lower(text))


def remove_stopwords(words: str | Column, stopwords: Sequence[str]) -> Column:
    """Drop tokens that equal a stop word, ignoring case."""
    listed = [w.lower() for w in stopwords]
    return F.filter(words, lambda w: ~F.lower(w).isin(listed))


def strip_marks(words: str | Column) -> Column:
    """Delete hyphens and underscores inside tokens; emptied tokens stay."""
    marked = lambda w: F.contains(w, F.lit("-")) | F.contains(w, F.lit("_"))
    return F.transform(words, lambda w: F.when(marked(w), F.translate(w, "-_", "")).otherwise(w))


def _stem_lists(words: pa.Array, tokens: int = STEMMED_TOKENS) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(words), 0)
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(lengths).cast(pa.int32())])
    flat, stems = words.flatten(), [pa.array([], pa.string())]
    for start in range(0, len(flat), tokens):
        encoded = pc.dictionary_encode(flat.slice(start, tokens))
        found = pa.array([stem_word(w) for w in encoded.dictionary.to_pylist()], pa.string())
        stems.append(found.take(encoded.indices))
    return pa.ListArray.from_arrays(offsets, pa.concat_arrays(stems), mask=words.is_null())


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_words(words: pa.Array) -> pa.Array:
    """English stems of token lists, in place and with repeats.

    Works on runs of tokens of an Arrow batch: each run is dictionary-encoded, only its
    distinct tokens are stemmed, and the stems are put back by index. No token is
    shuffled, so a token that makes up a third of all text costs nothing extra.
    """
    return _stem_lists(words)
