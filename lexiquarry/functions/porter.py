"""Porter's suffix stripping (Porter 1980), for query terms and vocabularies.

Only distinct terms are stemmed, never running text. The rules of steps 2 to 4 are data.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Suffix rules of the published algorithm.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al",
    "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def _shape(stem: str) -> str:
    """Consonant and vowel runs of a stem as a string of c and v."""
    kinds = []
    for i, char in enumerate(stem):
        vowel = char in "aeiou" or (char == "y" and i > 0 and kinds[-1] == "c")
        kinds.append("v" if vowel else "c")
    return "".join(kinds)


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double_consonant(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _ends_cvc(stem: str) -> bool:
    return _shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def _longest_rule(word: str, rules: dict[str, str], least: int) -> str:
    for suffix in sorted(rules, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + rules[suffix] if _measure(stem) > least else word
    return word


def stem_word(word: str) -> str:
    """Stem of a lower-case word; words of one or two letters stay."""
    if len(word) <= 2:
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]

    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            if word.endswith(suffix):
                stem = word[: -len(suffix)]
                if _has_vowel(stem):
                    if stem.endswith(("at", "bl", "iz")):
                        stem += "e"
                    elif _double_consonant(stem) and stem[-1] not in "lsz":
                        stem = stem[:-1]
                    elif _measure(stem) == 1 and _ends_cvc(stem):
                        stem += "e"
                    word = stem
                break

    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    word = _longest_rule(word, STEP_2, 0)
    word = _longest_rule(word, STEP_3, 0)

    for suffix in sorted(STEP_4, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                word = stem
            break

    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _ends_cvc(stem)):
            word = stem
    if _measure(word) > 1 and _double_consonant(word) and word.endswith("l"):
        word = word[:-1]
    return word


@F.pandas_udf(T.StringType())
def stem_terms(terms: pd.Series) -> pd.Series:
    return terms.map(stem_word, na_action="ignore")
