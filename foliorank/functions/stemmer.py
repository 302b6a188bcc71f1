"""English Snowball (Porter2) stem of one word, from its published description."""

import re
from functools import lru_cache

# The rule tables of the published algorithm.
_IRREGULAR = dict(
    pair.split(":")
    for pair in """
    skis:ski skies:sky dying:die lying:lie tying:tie idly:idl gently:gentl ugly:ugli
    early:earli only:onli singly:singl sky:sky news:news howe:howe atlas:atlas
    cosmos:cosmos bias:bias andes:andes
    inning:inning innings:inning outing:outing outings:outing canning:canning
    cannings:canning herring:herring herrings:herring earring:earring
    earrings:earring proceed:proceed proceeds:proceed proceeded:proceed
    proceeding:proceed exceed:exceed exceeds:exceed exceeded:exceed
    exceeding:exceed succeed:succeed succeeds:succeed succeeded:succeed
    succeeding:succeed
    """.split()
)
_STEP_2 = dict(
    pair.split(":")
    for pair in """
    tional:tion enci:ence anci:ance abli:able entli:ent izer:ize ization:ize
    ational:ate ation:ate ator:ate alism:al aliti:al alli:al fulness:ful ousli:ous
    ousness:ous iveness:ive iviti:ive biliti:ble bli:ble fulli:ful lessli:less
    """.split()
)
_STEP_3 = dict(
    pair.split(":")
    for pair in """
    tional:tion ational:ate alize:al icate:ic iciti:ic ical:ic ful: ness:
    """.split()
)
_STEP_4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize".split()
_LONG_PREFIX = re.compile(r"gener|commun|arsen")
_DOUBLE = re.compile(r"(bb|dd|ff|gg|mm|nn|pp|rr|tt)$")
_AFTER_VOWEL_PAIR = re.compile(r"[aeiouy][^aeiouy]")
_VOWEL = re.compile(r"[aeiouy]")
# A short syllable at the end: vowel and closing consonant after a consonant,
# or a two-letter word of vowel and consonant.
_SHORT_END = re.compile(r"([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$")


def _longest(word: str, suffixes) -> str | None:
    found = [s for s in suffixes if word.endswith(s)]
    return max(found, key=len) if found else None


def _regions(word: str) -> tuple[int, int]:
    """Where the two suffix regions start."""
    prefix = _LONG_PREFIX.match(word)
    first = prefix or _AFTER_VOWEL_PAIR.search(word)
    r1 = first.end() if first else len(word)
    second = _AFTER_VOWEL_PAIR.search(word, r1)
    return r1, second.end() if second else len(word)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith("s") and not word.endswith(("us", "ss")) and _VOWEL.search(word[:-2]):
        return word[:-1]
    return word


def _past_and_gerund(word: str, r1: int) -> str:
    suffix = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if suffix is None:
        return word
    base = word[: -len(suffix)]
    if suffix.startswith("eed"):
        return base + "ee" if len(base) >= r1 else word
    if not _VOWEL.search(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if _DOUBLE.search(base):
        return base[:-1]
    return base + "e" if r1 >= len(base) and _SHORT_END.search(base) else base


def _derivation(word: str, r1: int, r2: int) -> str:
    suffix = _longest(word, [*_STEP_2, "ogi", "li"])
    if suffix and len(word) - len(suffix) >= r1:
        base = word[: -len(suffix)]
        if suffix == "ogi":
            word = base + "og" if base.endswith("l") else word
        elif suffix == "li":
            word = base if base[-1:] and base[-1] in "cdeghkmnrt" else word
        else:
            word = base + _STEP_2[suffix]
    suffix = _longest(word, [*_STEP_3, "ative"])
    if suffix and len(word) - len(suffix) >= r1:
        base = word[: -len(suffix)]
        if suffix != "ative":
            word = base + _STEP_3[suffix]
        elif len(base) >= r2:
            word = base
    suffix = _longest(word, [*_STEP_4, "ion"])
    if suffix and len(word) - len(suffix) >= r2:
        base = word[: -len(suffix)]
        if suffix != "ion" or base.endswith(("s", "t")):
            word = base
    return word


def _final_letter(word: str, r1: int, r2: int) -> str:
    base = word[:-1]
    if word.endswith("e") and (len(base) >= r2 or (len(base) >= r1 and not _SHORT_END.search(base))):
        return base
    if word.endswith("ll") and len(base) >= r2:
        return base
    return word


@lru_cache(maxsize=1 << 17)
def stem_word(word: str) -> str:
    """Stem of one word; words of up to two letters are only lower-cased."""
    word = word.lower()
    if len(word) <= 2:
        return word
    if word in _IRREGULAR:
        return _IRREGULAR[word]
    word = word.removeprefix("'")
    # A "y" that opens the word or follows a vowel is a consonant, written "Y".
    word = re.sub(r"([aeiouy])y", r"\1Y", re.sub(r"^y", "Y", word))
    r1, r2 = _regions(word)
    word = re.sub(r"('s'|'s|')$", "", word)
    word = _plural(word)
    word = _past_and_gerund(word, r1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in "aeiouy":
        word = word[:-1] + "i"
    word = _derivation(word, r1, r2)
    word = _final_letter(word, r1, r2)
    return word.replace("Y", "y")
