"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the row, so the rules are evaluated
inside the scan, without user functions and without a shuffle. A rule is a row
of ``RULES``: a ratio and the range it must lie in.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, lower_ascii

SYMBOLS = "[#*$%&|<>]"
# Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for on with as by be was are this at from or an a it "
    "der die und das den dem ein eine zu ist mit von im auf für nicht des sich als auch "
    "le la les de du des et en un une est que qui dans pour pas sur au il elle "
    "el los las y del se un una por con no su para es lo como al"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a text only if ``numerator / denominator`` lies in [least, most]."""

    name: str
    numerator: str
    denominator: str
    least: float
    most: float


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", 0.0, 0.5),
    Rule("exclamations", "_exclamations", "n_words", 0.0, 0.5),
    Rule("stop_words", "_stops", "n_words", 0.01, 1.0),
    Rule("repeated_lines", "n_dup_lines", "_lines", 0.0, 0.5),
)


def _measures(documents: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Counts of every text; each step is a projection over the row before it."""
    text = F.coalesce(documents["text"], F.lit(""))
    words = documents.select(
        F.struct(*[documents[c] for c in keep]).alias("_kept"),
        text.alias("_text"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("_line_list"),
    )
    # Each three-word window as its hash and its place; equal windows become neighbours by sorting.
    size = F.size("_words")
    windows = F.when(
        size >= 3,
        F.array_sort(
            F.transform(
                F.sequence(F.lit(1), size - 2),
                lambda i: F.struct(
                    F.xxhash64(
                        F.element_at("_words", i), F.element_at("_words", i + 1), F.element_at("_words", i + 2)
                    ).alias("h"),
                    i.alias("i"),
                ),
            )
        ),
    ).otherwise(F.expr("CAST(array() AS ARRAY<STRUCT<h: BIGINT, i: INT>>)"))
    sorted_windows = words.select(
        "_kept",
        "_line_list",
        size.cast("bigint").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.regexp_count("_text", F.lit("!")).cast("bigint").alias("_exclamations"),
        F.size(F.filter("_words", lambda w: lower_ascii(w).isin(STOP_WORDS))).cast("bigint").alias("_stops"),
        windows.alias("_windows"),
    )
    # A window occurs twice or more if a neighbour in the sorted list is equal.
    last = F.size("_windows")
    twice = F.filter(
        F.transform(
            "_windows",
            lambda w, k: F.when(
                (w["h"] == F.get("_windows", k - 1)["h"]) | (w["h"] == F.get("_windows", k + 1)["h"]), w["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    repeated = sorted_windows.select(
        "*", F.when(last >= 2, F.array_sort(twice)).otherwise(F.expr("CAST(array() AS ARRAY<INT>)")).alias("_at")
    )
    covered = F.aggregate(
        F.transform(
            "_at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_at", k + 1) - p, F.lit(3)))
        ),
        F.lit(0),
        lambda total, n: total + n,
    )
    return repeated.select(
        "_kept",
        "n_words",
        "word_chars",
        "n_symbols",
        "_exclamations",
        "_stops",
        F.size("_line_list").cast("bigint").alias("_lines"),
        (F.size("_line_list") - F.size(F.array_distinct("_line_list"))).cast("bigint").alias("n_dup_lines"),
        covered.cast("bigint").alias("n_repeat_words"),
    )


def verdict(rules: Sequence[Rule]) -> Column:
    """The rules as one expression; a ratio over nothing passes."""
    passed = F.lit(True)
    for rule in rules:
        over = F.col(rule.denominator)
        ratio = F.try_divide(F.col(rule.numerator), over)
        passed = passed & F.coalesce(ratio.between(rule.least, rule.most), F.lit(True))
    return passed


def judge(
    documents: DataFrame, rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """One row per document: ``keep``, the measures, base_failed and kept.

    Null and empty texts have zero measures and fail. Lines count if they hold a word.
    Rows that repeat are judged alike; an empty table gives no rows; other columns
    are not looked at. Nothing depends on another row, so a text of any length is
    work of its own row only.
    """
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    result = F.struct(*names, base_failed.alias("base_failed"), (~base_failed & verdict(rules)).alias("kept"))
    # A generator of one row: a filter on the verdict stays above it. Pushed below, it would
    # hold every measure spelled out, with the sorted windows once for each comparison.
    judged = _measures(documents, keep).select("_kept", F.explode(F.array(result)).alias("_result"))
    return judged.select(
        *[F.col(f"_kept.{c}").alias(c) for c in keep],
        *[F.col(f"_result.{c}").alias(c) for c in [*names, "base_failed", "kept"]],
    )


def quality_sql() -> str:
    listed = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    checks = " AND ".join(
        f"({r.denominator.strip('_')} = 0 OR {r.numerator.strip('_')}::DOUBLE / {r.denominator.strip('_')} "
        f"BETWEEN {r.least} AND {r.most})"
        for r in RULES
    )
    return rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS line_list
  FROM documents
), g AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), c AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g
), r AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM c WHERE n > 1) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    len(regexp_extract_all(text, '!')) AS exclamations,
    len(list_filter(words, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') IN ({listed}))) AS stops,
    len(line_list) AS lines,
    CAST(len(line_list) - len(list_distinct(line_list)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {checks} AS kept
FROM b
"""
