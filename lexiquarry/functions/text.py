"""Column expressions for text normalisation. All are built-in functions, null in gives null out.

The steps work on the whole text with a one-character sentence mark inside, so that sentences and
words of a row are found without leaving the row: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiquarry.functions.fixed import LETTER_SPELLINGS, STOP_WORDS, ascii_spellings

SENTENCE_MARK = "\u0001"

# Patterns of the normalisation steps.
SPACE_RUN = " +"
SENTENCE_END = r"([.!?])\s+"
NON_WORD_CHAR = r"[!-@\[\]-`{-~]"
# Controls other than the sentence mark count as white space.
NON_WORD_RUN = r"[\x00\x02-@\[\]-`{-\x7f]+"
FUSED_SAMPLES = ("cannot", "gonna", "gotta", "gimme", "lemme", "wanna")
FUSED_WORDS = r"\b(?:(can)(not)|(gon|wan)(na)|(got)(ta)|(gim|lem)(me))\b"
FUSED_WORDS_APART = "$1$3$5$7 $2$4$6$8"
ANALYZER_JOINTS = "'’.:·,"
ANALYZER_PLACEHOLDERS = "\u0001\u0002\u0003\u0004\u0005\u0006\u0007"
ANALYZER_LETTER_JOINT = r"([\p{L}\p{M}])(['’.:·])([\p{L}\p{M}])"
ANALYZER_DIGIT_JOINT = r"(\p{N})([.,'])(\p{N})"
ANALYZER_NON_WORD = r"[^\p{L}\p{M}\p{N}_\x02-\x07]+"

def collapse_spaces(c: Column) -> Column:
    """One space for each run of spaces; tabs and line breaks stay."""
    return F.regexp_replace(c, SPACE_RUN, " ")


@lru_cache(maxsize=1)
def _spellings() -> tuple[str, str, dict[str, str]]:
    return ascii_spellings()


def to_ascii(c: Column) -> Column:
    """ASCII spelling of a text.

    Rows that are ASCII (byte length = character length) leave after each stage: first letters with
    one-letter spellings, then the usual ligatures, then all other spellings. Letters without a spelling stay,
    other signs are dropped.
    """
    source, target, longer = _spellings()
    ligatures = {k: v for k, v in longer.items() if k in LETTER_SPELLINGS}
    others = {k: v for k, v in longer.items() if k not in ligatures}

    def spell(text: Column, table: dict[str, str]) -> Column:
        for char, spelling in table.items():
            text = F.replace(text, F.lit(char), F.lit(spelling))
        return text

    def rest(text: Column) -> Column:
        return _unless_ascii(text, lambda t: F.regexp_replace(spell(t, others), r"[^\x00-\x7F\p{L}]", ""))

    return _unless_ascii(c, lambda t: bind(F.translate(t, source, target), lambda u: _unless_ascii(
        u, lambda v: bind(spell(v, ligatures), rest))))


def _unless_ascii(text: Column, change: Callable[[Column], Column]) -> Column:
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(change(text))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once per row, however often `use` mentions it."""
    return F.transform(F.array(value), use)[0]


def folded(c: Column) -> Column:
    """Lower-case ASCII spelling."""
    return F.lower(to_ascii(c))


def _marked(c: Column) -> Column:
    """Folded text with a mark after each sentence end."""
    return F.regexp_replace(
        F.regexp_replace(folded(c), r"\s+$", ""), SENTENCE_END, "$1" + SENTENCE_MARK)


def _words_only(c: Column) -> Column:
    """Punctuation and digits become spaces, spaces are single, fused words are set apart."""
    spaced = F.trim(F.regexp_replace(c, NON_WORD_RUN, " "))
    return bind(spaced, lambda s: F.when(
        reduce(or_, [F.contains(s, F.lit(word)) for word in FUSED_SAMPLES]),
        F.regexp_replace(s, FUSED_WORDS, FUSED_WORDS_APART)).otherwise(s))


def split_sentences(c: Column) -> Column:
    """ARRAY<STRING> of folded sentences, punctuation kept."""
    return F.array_remove(F.split(collapse_spaces(_marked(c)), SENTENCE_MARK), "")


def normalize_sentences(c: Column) -> Column:
    """ARRAY<STRING>: each sentence as its words joined by single spaces; empty ones stay."""
    sentences = F.split(_words_only(_marked(c)), f" ?{SENTENCE_MARK} ?")
    return F.when(c.rlike(r"^\s*$"), F.array().cast("array<string>")).otherwise(sentences)


def sentence_records(sentences: Column) -> Column:
    """ARRAY<STRUCT<tokens, sentence>> of normalised sentences."""
    return F.transform(
        sentences, lambda s: F.struct(words_of(s).alias("tokens"), s.alias("sentence")))


def words_of(sentence: Column) -> Column:
    """Words of a normalised sentence."""
    return F.array_remove(F.split(sentence, " "), "")


def flat_words(sentences: Column) -> Column:
    """All words of the sentences in order."""
    return words_of(F.array_join(sentences, " "))


def normalized_words(c: Column) -> Column:
    """All words of a raw text in order; the same words as in `normalize_sentences`."""
    return words_of(_words_only(folded(c)))


def drop_stop_words(sentences: Column, stop_words: list[str] | None = None) -> Column:
    """Sentences without stop words and without words of one or two letters."""
    stops = STOP_WORDS if stop_words is None else stop_words
    keep = lambda w: (F.length(w) > 2) & ~w.isin(*[s for s in stops if len(s) > 2])
    return F.transform(sentences, lambda s: F.array_join(F.filter(F.split(s, " "), keep), " "))


def analyze_standard(c: Column) -> Column:
    """ARRAY<STRING>: lower-case Unicode words with their digits; stop words are kept.

    A point or apostrophe between two letters, and a point or comma between two digits, stay inside
    the word. Each kind of joint gets its own placeholder while all other signs become spaces. Two
    passes are needed because a single letter can carry a joint on both sides.
    """
    text = F.lower(F.translate(c, ANALYZER_PLACEHOLDERS, " " * len(ANALYZER_PLACEHOLDERS)))
    for pattern in (ANALYZER_LETTER_JOINT, ANALYZER_DIGIT_JOINT):
        for _ in range(2):
            text = F.regexp_replace(text, pattern, f"$1{SENTENCE_MARK}$2$3")
    for joint, placeholder in zip(ANALYZER_JOINTS, ANALYZER_PLACEHOLDERS[1:], strict=True):
        text = F.replace(text, F.lit(SENTENCE_MARK + joint), F.lit(placeholder))
    text = F.regexp_replace(text, ANALYZER_NON_WORD, " ")
    return words_of(F.trim(F.translate(text, ANALYZER_PLACEHOLDERS[1:], ANALYZER_JOINTS)))


def valid_date(c: Column) -> Column:
    """DATE when the text is a full year-month-day date, else null."""
    return F.try_to_date(c, "yyyy-M-d")
