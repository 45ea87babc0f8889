"""Multi-resolution blocking tokens of a cleaned record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text


def blocking_tokens(name: Column, addr: Column) -> Column:
    """Name and address words without stop words, the compact name twice, ``num_`` anchors, 3-grams of long name words; tokens of
    one character are dropped. Multiplicity is kept."""
    both = F.array_sort(F.array_union(text.numbers(name), text.numbers(addr)))
    cp = text.compact(name)
    long_words = F.filter(text.words(name), lambda w: F.length(w) >= 4)
    pieces = F.flatten(F.transform(long_words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3)))))
    every = F.concat(
        text.without(text.words(name), text.STOP_WORDS),
        text.without(text.words(addr), text.STOP_WORDS),
        F.when(F.length(cp) >= 5, F.array(cp, cp)).otherwise(F.array().cast("array<string>")),
        F.transform(both, lambda n: F.concat(F.lit("num_"), n)),
        pieces,
    )
    return F.filter(every, lambda t: F.length(t) >= 2)


def informative_tokens(name: Column, addr: Column) -> Column:
    """Distinct tokens for ad-hoc blocking: words of three or more letters, numbers, and the compact name."""
    take = lambda c: text.without(F.regexp_extract_all(c, F.lit("([a-z0-9]{3,})"), 1), text.STOP_WORDS)
    cp = text.compact(name)
    return F.array_distinct(F.concat(take(name), take(addr), text.numbers(name), text.numbers(addr), F.when(cp != "", F.array(cp)).otherwise(F.array().cast("array<string>"))))


def selective_words(name: Column) -> Column:
    return F.filter(text.without(text.words(name), text.STOP_WORDS), lambda w: F.length(w) >= 3)
