"""The English Snowball (Porter2) rules as a cascade of column expressions.

One table of steps is compiled to a chain of Spark projections over rows of words, inside
whole-stage code, and to SQL text with the same nesting. A step sees the word ``w`` and the places ``r1`` and ``r2`` where its two suffix
regions start, and gives the next word. Suffix rules are tried from the longest suffix on; the
first that fits decides, also if its condition then leaves the word as it is.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import write_once
from .stemmer import _IRREGULAR, _STEP_2, _STEP_3, _STEP_4

_VOWEL = "[aeiouy]"
_PAIR = "[aeiouy][^aeiouy]"
_SHORT = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"
_PREFIX = "^(gener|commun|arsen)"

Like = Callable[[str, str], str]


def _ends(suffix: str) -> str:
    return f"right(w, {len(suffix)}) = '{suffix}'"


def _base(suffix: str) -> str:
    return f"left(w, length(w) - {len(suffix)})"


def _by_suffix(rules: dict[str, tuple[str, str]]) -> str:
    """CASE over suffix: (condition, replacement of the suffix), the longest suffix first."""
    cases = []
    for suffix in sorted(rules, key=lambda s: (-len(s), s)):
        condition, put = rules[suffix]
        then = f"{_base(suffix)} || '{put}'" if put else _base(suffix)
        cases.append(f"WHEN {_ends(suffix)} THEN CASE WHEN {condition} THEN {then} ELSE w END")
    return f"CASE {' '.join(cases)} ELSE w END"


def _in(region: str, suffix: str) -> str:
    return f"length(w) - {len(suffix)} >= {region}"


def _steps(like: Like) -> list[str]:
    """The cascade behind the regions, as expressions of w, r1 and r2."""

    def past(suffix: str) -> str:
        base = _base(suffix)
        doubled = " OR ".join(f"right({base}, 2) = '{c}{c}'" for c in "bdfgmnprt")
        return (
            f"CASE WHEN NOT {like(base, _VOWEL)} THEN w"
            f" WHEN right({base}, 2) IN ('at', 'bl', 'iz') THEN {base} || 'e'"
            f" WHEN {doubled} THEN left(w, length(w) - {len(suffix) + 1})"
            f" WHEN r1 >= length(w) - {len(suffix)} AND {like(base, _SHORT)} THEN {base} || 'e' ELSE {base} END"
        )

    pasts = " ".join(
        f"WHEN {_ends(s)} THEN " + (f"CASE WHEN {_in('r1', s)} THEN {_base(s)} || 'ee' ELSE w END" if s[:3] == "eed" else past(s))
        for s in ("eedly", "ingly", "edly", "eed", "ing", "ed")
    )
    derived = {s: (_in("r1", s), put) for s, put in _STEP_2.items()}
    derived["ogi"] = (f"{_in('r1', 'ogi')} AND right(w, 4) = 'logi'", "og")
    derived["li"] = (f"{_in('r1', 'li')} AND {like('w', '[cdeghkmnrt]li$')}", "")
    third = {s: (_in("r1", s), put) for s, put in _STEP_3.items()}
    third["ative"] = (f"{_in('r1', 'ative')} AND {_in('r2', 'ative')}", "")
    fourth = {s: (_in("r2", s), "") for s in _STEP_4}
    fourth["ion"] = (f"{_in('r2', 'ion')} AND {like('w', '[st]ion$')}", "")
    return [
        f"CASE WHEN right(w, 3) = '''s''' THEN {_base('xxx')} WHEN right(w, 2) = '''s' THEN {_base('xx')}"
        f" WHEN right(w, 1) = '''' THEN {_base('x')} ELSE w END",
        f"CASE WHEN {_ends('sses')} THEN {_base('xx')}"
        f" WHEN {_ends('ied')} OR {_ends('ies')} THEN CASE WHEN length(w) > 4 THEN {_base('xx')} ELSE {_base('x')} END"
        f" WHEN {_ends('s')} AND NOT {_ends('us')} AND NOT {_ends('ss')} AND {like(_base('xx'), _VOWEL)} THEN {_base('x')} ELSE w END",
        f"CASE {pasts} ELSE w END",
        f"CASE WHEN length(w) > 2 AND {like('w', '[^aeiouy][yY]$')} THEN {_base('x')} || 'i' ELSE w END",
        _by_suffix(derived),
        _by_suffix(third),
        _by_suffix(fourth),
        f"CASE WHEN {_ends('e')} AND ({_in('r2', 'x')} OR {_in('r1', 'x')} AND NOT {like(_base('x'), _SHORT)}) THEN {_base('x')}"
        f" WHEN {_ends('ll')} AND {_in('r2', 'x')} THEN {_base('x')} ELSE w END",
    ]


def _begin(replace_all: Callable[[str, str, str], str]) -> str:
    """The word with consonant y written Y, without a leading apostrophe."""
    bare = "CASE WHEN left(w, 1) = '''' THEN substr(w, 2) ELSE w END"
    return replace_all(replace_all(bare, "^y", "Y"), "([aeiouy])y", "{1}Y")


def _r1(like: Like) -> str:
    return (
        f"CASE WHEN {like('w', _PREFIX)} THEN length(regexp_extract(w, '{_PREFIX}', 0))"
        f" WHEN {like('w', _PAIR)} THEN length(regexp_extract(w, '^.*?{_PAIR}', 0)) ELSE length(w) END"
    )


def _r2(like: Like) -> str:
    rest = "substr(w, r1 + 1)"
    return f"CASE WHEN {like(rest, _PAIR)} THEN r1 + length(regexp_extract({rest}, '^.*?{_PAIR}', 0)) ELSE length(w) END"


def _irregular(key: str) -> str:
    return "CASE " + " ".join(f"WHEN {key} = '{w}' THEN '{s}'" for w, s in _IRREGULAR.items()) + " END"


def _cascade(word: str, like: Like, replace_all: Callable[[str, str, str], str]) -> list[dict[str, str]]:
    """The columns of each select of the cascade, from the column ``word`` to ``stem``."""
    kept = {c: c for c in ("token", "w", "r1", "r2")}
    steps = [{"token": f"lower({word})"}, {"token": "token", "w": _begin(replace_all).replace("w", "token")}]
    steps.append({"token": "token", "w": "w", "r1": _r1(like)})
    steps.append({"token": "token", "w": "w", "r1": "r1", "r2": _r2(like)})
    steps += [{**kept, "w": step} for step in _steps(like)]
    stem = f"CASE WHEN length(token) <= 2 THEN token ELSE coalesce({_irregular('token')}, translate(w, 'Y', 'y')) END"
    return [*steps, {"stem": stem}]


def stem_rows(words: DataFrame, column: str = "term") -> DataFrame:
    """Add ``stem`` to rows of one word each: built-in functions only, no Python worker.

    Null words have a null stem. Extra columns pass through, also under the names used here.
    The rows are written once; each distinct word is stemmed once, into a table joined back to them.
    """

    def like(value: str, pattern: str) -> str:
        return f"regexp_like({value}, '{pattern}')"

    def replace_all(value: str, pattern: str, put: str) -> str:
        return f"regexp_replace({value}, '{pattern}', '{put.replace('{1}', '$1')}')"

    others = F.struct(*[F.col(c) for c in words.columns]).alias("_row")
    rows = write_once(words.select(others, F.col(column).alias("_word")), "word-rows")
    found = rows.select("_word").distinct()
    for step in _cascade("_word", like, replace_all):
        found = found.select("_word", *[F.expr(e).alias(name) for name, e in step.items()])
    stems = write_once(found, "word-stems")
    return rows.join(stems, "_word", "left").select("_row.*", "stem")


def stem_sql(source: str, word: str) -> str:
    """SELECT of (word, stem) over the distinct words of a table expression, in DuckDB's SQL."""

    def like(value: str, pattern: str) -> str:
        return f"regexp_matches({value}, '{pattern}')"

    def replace_all(value: str, pattern: str, put: str) -> str:
        return f"regexp_replace({value}, '{pattern}', '{put.replace('{1}', chr(92) + '1')}', 'g')"

    query = f"(SELECT DISTINCT {word} AS word FROM {source})"
    for step in _cascade("word", like, replace_all):
        columns = ", ".join(f"{e} AS {name}" for name, e in step.items())
        query = f"(SELECT word, {columns} FROM {query})"
    return f"SELECT word, stem FROM {query}"
