"""Text to words, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which characters form words (Unicode word breaks, simplified).
# Letters join across ' ’ . : · and digits across ' ’ . , ; while ideographs
# and hiragana stand alone. The possessive marks (++ and *+) only keep the
# regex engine from recursing on very long words; they match the same text.
SINGLES = r"ぁ-ゟ㐀-䶿一-鿿豈-﫿\x{20000}-\x{3FFFF}"
LETTER = rf"[\p{{L}}\p{{M}}&&[^{SINGLES}]]"
WORD = (
    rf"[{SINGLES}]"
    rf"|(?:{LETTER}++(?:['’.:·]{LETTER}++)*+"
    r"|\p{N}++(?:['’.,;]\p{N}++)*+"
    r"|_++)++"
)
# Characters whose lower case follows from their context, or is of another kind or Unicode version.
BY_CONTEXT = r"[Σ\x{1C89}\x{A7CB}\x{A7CC}\x{A7DA}\x{A7DC}\x{10D50}-\x{10D65}]"
# A word with the hyphen that glues it to a following word, if there is one.
WORD_AND_HYPHEN = rf"(?:{WORD})(?:-(?=[\p{{L}}\p{{N}}\p{{M}}_]))?"


def words(text: Column) -> Column:
    """Lower-cased words in order; NULL for NULL."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def cased_words(text: Column) -> Column:
    """Words in their original case; NULL for NULL."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def words_and_hyphens(text: Column) -> Column:
    """Lower-cased words, each ending in ``-`` if a hyphen alone separates it
    from the next word. No word ends in ``-`` otherwise."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_AND_HYPHEN), F.lit(0))


def cased_words_and_hyphens(text: Column) -> Column:
    """As ``words_and_hyphens``, in the original case."""
    return F.regexp_extract_all(text, F.lit(WORD_AND_HYPHEN), F.lit(0))


def lowered_as_a_whole(text: Column) -> Column:
    """Whether lower-casing word by word might give other words than ``words`` does."""
    return text.rlike(BY_CONTEXT)


def raw_words(phrase: Column) -> Column:
    """A query phrase split at white space, symbols kept."""
    return F.filter(F.split(phrase, r"\s+"), lambda w: w != "")
