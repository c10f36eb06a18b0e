"""Message text to tokens, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fixed
from .exprs import _col

# A blank goes between the two parts of each split word.
_SPLIT_POINT = r"\b(" + "|".join(rf"{a}(?={b}\b)" for a, b in fixed.SPLIT_WORDS) + ")"


def tokenize(text: Column | str) -> Column:
    """Lower-case runs of latin letters and digits; empty array for a text with none."""
    plain = F.regexp_replace(F.lower(_col(text)), "[^a-z0-9]+", " ")
    # Few texts have a word to split, and a substring test costs far less than the pattern.
    rare = F.lit(False)
    for a, b in fixed.SPLIT_WORDS:
        rare = rare | F.lower(_col(text)).contains(a + b)
    return F.array_remove(F.split(F.when(rare, F.regexp_replace(plain, _SPLIT_POINT, "$1 ")).otherwise(plain), " "), "")


def drop_stop_words(tokens: Column | str, words: list[str] = fixed.STOP_WORDS) -> Column:
    """Tokens that are no stop words, in their order, repeats kept."""
    return F.filter(_col(tokens), lambda t: ~t.isin(words))


def word_ngrams(tokens: Column | str, upto: int = 1) -> Column:
    """Single words, then for ``upto=2`` also pairs of neighbours joined by a blank."""
    t = _col(tokens)
    if upto == 1:
        return t
    if upto != 2:
        raise ValueError("upto must be 1 or 2")
    pairs = F.zip_with(
        F.slice(t, F.lit(1), F.greatest(F.size(t) - 1, F.lit(0))),
        F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.concat(t, pairs)


def content_words(text: Column | str, ngrams: int = 1) -> Column:
    """Terms of a text: its tokens without stop words, with pairs of neighbours for ``ngrams=2``."""
    return word_ngrams(drop_stop_words(tokenize(text)), ngrams)


def tally(terms: Column | str) -> Column:
    """The different terms of an array with how often each occurs, (term, tf), in the order of the terms; worked out inside the row."""
    def counted(sorted_terms: Column) -> Column:
        n = F.size(sorted_terms)
        starts = F.filter(F.sequence(F.lit(1), n), lambda i: ~F.get(sorted_terms, i - 1).eqNullSafe(F.get(sorted_terms, i - 2)))
        runs = lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(sorted_terms, i - 1).alias("term"), (F.coalesce(F.get(at, k + 1), n + 1) - i).cast("bigint").alias("tf")))
        return F.when(n > 0, F.get(F.transform(F.array(starts), runs), F.lit(0)))

    # Arrays of one element, so that the sorted terms and the starts are worked out once a row.
    return F.get(F.transform(F.array(F.sort_array(_col(terms))), counted), F.lit(0))
