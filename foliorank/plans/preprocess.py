"""From paper text to token lists and to the vocabulary."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH_STOPWORDS
from ..functions.text import concat_text, remove_stopwords, stem_words, strip_marks, tokenize
from ..operators.terms import (
    MAX_PAPER_SHARE,
    MIN_PAPERS,
    VOCABULARY_SIZE,
    count_distinct_papers,
    document_frequency,
    document_frequency_band,
    top_terms,
)


def preprocess_terms(
    papers: DataFrame, stopwords: Sequence[str] = ENGLISH_STOPWORDS, stem: bool = True
) -> DataFrame:
    """Tokens for TF-IDF and topics: stop words out, marks stripped, stems with repeats.

    A hyphenated stop word ("can-not") is no stop word yet and stays, without mark.
    """
    words = strip_marks(remove_stopwords(tokenize(concat_text()), stopwords))
    return papers.select("paper_id", (stem_words(words) if stem else words).alias("words"))


def preprocess_conservative(papers: DataFrame) -> DataFrame:
    """Tokens with marks stripped; nothing else is removed."""
    return papers.select("paper_id", strip_marks(tokenize(concat_text())).alias("words"))


def preprocess_intensive(
    papers: DataFrame,
    stopwords: Sequence[str] = ENGLISH_STOPWORDS,
    stem: bool = True,
    distinct: bool = False,
) -> DataFrame:
    """Marks stripped, then stop words out, then stems.

    ``distinct`` keeps each stem once, which loses order and counts for training.
    """
    words = remove_stopwords(strip_marks(tokenize(concat_text())), stopwords)
    words = stem_words(words) if stem else words
    return papers.select("paper_id", (F.array_distinct(words) if distinct else words).alias("words"))


def build_vocabulary(
    papers: DataFrame,
    words: DataFrame,
    min_papers: int = MIN_PAPERS,
    max_share: float = MAX_PAPER_SHARE,
    size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """(term, df, term_id): the most frequent terms inside the document-frequency band."""
    band = document_frequency_band(
        document_frequency(words), count_distinct_papers(papers), min_papers, max_share
    )
    return top_terms(band, size)
