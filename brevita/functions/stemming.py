"""Porter's suffix stripping (M. F. Porter, "An algorithm for suffix stripping", 1980), as an Arrow UDF.

Words repeat, so the tokens of a batch are dictionary-encoded, each of its words is stemmed once, and texts are spelled anew from the indices; a
bounded memo in each Python worker carries stems from batch to batch. A join with a table of distinct words
would instead shuffle every token, with the commonest word in one partition.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The suffix tables of the paper's steps 2, 3 and 4.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al",
    "iviti": "ive", "biliti": "ble",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
)

# Words of up to this many letters are left alone by the scorer.
SHORT_WORD = 3
MEMO_WORDS = 1 << 17


def _shape(stem: str) -> str:
    """Vowels as V, consonants as C; y is a vowel after a consonant."""
    shape = ""
    for letter in stem:
        vowel = letter in "aeiou" or (letter == "y" and shape.endswith("C"))
        shape += "V" if vowel else "C"
    return shape


def _measure(stem: str) -> int:
    return len(re.findall("V+C+", _shape(stem)))


def _ends_double(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem).endswith("C")


def _ends_cvc(stem: str) -> bool:
    return _shape(stem).endswith("CVC") and stem[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plurals(word: str) -> str:
    if word.endswith("sses") or word.endswith("ies"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past_and_progressive(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = _longest(word, ("ed", "ing"))
    if suffix is None or "V" not in _shape(word[: -len(suffix)]):
        return word
    stem = word[: -len(suffix)]
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _ends_double(stem) and stem[-1] not in "lsz":
        return stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _ends_cvc(stem) else stem


def _swap(word: str, table: dict[str, str]) -> str:
    suffix = _longest(word, table)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    return stem + table[suffix] if _measure(stem) > 0 else word


def _drop(word: str) -> str:
    suffix = _longest(word, STEP_4)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    allowed = _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t")))
    return stem if allowed else word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _ends_cvc(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word) > 1 else word


@lru_cache(maxsize=MEMO_WORDS)
def porter_stem(word: str) -> str:
    word = _past_and_progressive(_plurals(word))
    if word.endswith("y") and "V" in _shape(word[:-1]):
        word = word[:-1] + "i"
    return _tidy(_drop(_swap(_swap(word, STEP_2), STEP_3)))


def stem_token(word: str) -> str:
    return porter_stem(word) if len(word) > SHORT_WORD else word


def stem_lists(normal: pa.Array) -> pa.Array:
    """Texts with every token stemmed. Tokens are dictionary-encoded, so each word of a batch is stemmed once."""
    lists = pc.split_pattern(normal, " ")
    words = pc.list_flatten(lists).dictionary_encode()
    stems = pa.array([stem_token(word) for word in words.dictionary.to_pylist()], pa.string())
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = pa.array([0, *lengths.cumsum().tolist()], pa.int32())
    joined = pc.binary_join(pa.ListArray.from_arrays(ends, stems.take(words.indices)), " ")
    return pc.if_else(pc.is_null(normal), pa.scalar(None, pa.string()), joined)


@F.arrow_udf(StringType())
def stem_tokens(normal: pa.Array) -> pa.Array:
    """Stem every token of a normalised text."""
    return stem_lists(normal.cast(pa.string()))
