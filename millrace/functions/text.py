"""Column functions over text. Every one is a native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English function words that carry no topic.
STOPWORDS = (
    "a an and are as at be but by for from had has have he her his i if in is it its no not of "
    "on or she so that the their there they this to was we were which will with you"
).split()

# The 32 ASCII punctuation marks.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def clean_text(c: Column) -> Column:
    """Word characters and blanks only, lower case, no blanks at either end."""
    kept = F.lower(F.regexp_replace(c, r"[^\w\s]", ""))
    return F.regexp_replace(kept, r"^\s+|\s+$", "")


def strip_ascii_punct(c: Column) -> Column:
    return F.translate(c, ASCII_PUNCTUATION, "")


def split_words(c: Column) -> Column:
    """Pieces between single blanks; two blanks in a row give an empty piece."""
    return F.split(c, " ", -1)


def tokenize_simple(c: Column) -> Column:
    """Lower-case runs of word characters, repeats kept."""
    return F.array_remove(F.split(F.lower(c), r"\W+"), "")


def tokenize_stop(c: Column, stopwords: list[str] = STOPWORDS) -> Column:
    """``tokenize_simple`` without the stopwords; empties go in the same pass."""
    return F.filter(F.split(F.lower(c), r"\W+"), lambda x: ~x.isin("", *stopwords))


def alpha_words(c: Column) -> Column:
    """All runs of the letters a to z in the lowered text."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[a-z]+"), 0)


def whitespace_tokens(c: Column) -> Column:
    """Newlines deleted, then split on runs of blanks; a blank text has no token."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(c), r"\n", ""), r"^\s+|\s+$", "")
    return F.array_remove(F.split(flat, r"\s+"), "")


def remove_quotes(c: Column) -> Column:
    return F.replace(c, F.lit('"'), F.lit(""))


def sentences(c: Column) -> Column:
    """Split behind a full stop, exclamation or question mark that a blank follows."""
    return F.array_remove(F.split(c, r"(?<=[.!?])\s+"), "")


def characters(c: Column) -> Column:
    return F.array_remove(F.split(c, ""), "")


def _positions(last: Column) -> Column:
    """1..last, empty when last is below 1."""
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def word_deletes(w: Column) -> Column:
    """Each string with one letter of ``w`` left out."""
    return F.transform(
        _positions(F.length(w)),
        lambda i: F.concat(w.substr(F.lit(1), i - 1), w.substr(i + 1, F.length(w))),
    )


def word_transposes(w: Column) -> Column:
    """Each string with two neighbouring letters of ``w`` swapped."""
    return F.transform(
        _positions(F.length(w) - 1),
        lambda i: F.concat(
            w.substr(F.lit(1), i - 1),
            w.substr(i + 1, F.lit(1)),
            w.substr(i, F.lit(1)),
            w.substr(i + 2, F.length(w)),
        ),
    )


def word_edits1(w: Column) -> Column:
    """Distinct strings one delete, transpose, replace or insert (a to z) away from ``w``."""
    letters = F.array(*[F.lit(x) for x in ALPHABET])
    replaces = F.flatten(
        F.transform(
            _positions(F.length(w)),
            lambda i: F.transform(
                letters,
                lambda x: F.concat(w.substr(F.lit(1), i - 1), x, w.substr(i + 1, F.length(w))),
            ),
        )
    )
    inserts = F.flatten(
        F.transform(
            _positions(F.length(w) + 1),
            lambda i: F.transform(
                letters, lambda x: F.concat(w.substr(F.lit(1), i - 1), x, w.substr(i, F.length(w)))
            ),
        )
    )
    return F.array_distinct(F.concat(word_deletes(w), word_transposes(w), replaces, inserts))
