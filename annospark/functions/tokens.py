"""Row-local token work: stop words, n-grams and per-document counts.

The array helpers below take a *column name*, not an expression: Spark would
otherwise evaluate the producing expression again for every array element.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def drop_stop_words(tokens: Column, stop_words: Sequence[str], min_length: int = 1) -> Column:
    def keep(t: Column) -> Column:
        kept = ~t.isin(*stop_words) if stop_words else F.lit(True)
        return kept & (F.length(t) >= min_length) if min_length > 1 else kept

    return F.filter(tokens, keep)


def ngrams(tokens: str, n: int) -> Column:
    """All runs of ``n`` adjacent tokens, joined by a space."""
    t = F.col(tokens)
    if n == 1:
        return t
    starts = F.sequence(F.lit(1), F.size(t) - (n - 1))
    return F.when(
        F.size(t) >= n,
        F.transform(starts, lambda i: F.concat_ws(" ", *[F.element_at(t, i + k) for k in range(n)])),
    ).otherwise(F.array().cast("array<string>"))


def first_flags(ordered: str) -> Column:
    """``(term, is_first)`` per element of a sorted array, one ``is_first`` per term.

    Summing ``is_first`` over exploded rows gives the document frequency
    without a second grouping by document.
    """
    s = F.col(ordered)
    return F.transform(
        s,
        lambda x, i: F.struct(
            x.alias("term"),
            F.when((i == 0) | (F.get(s, i - 1) != x), 1).otherwise(0).alias("is_first"),
        ),
    )


def run_starts(ordered: str) -> Column:
    """0-based positions at which a new term begins in a sorted array."""
    s = F.col(ordered)
    positions = F.sequence(F.lit(0), F.size(s) - 1)
    return F.when(
        F.size(s) > 0,
        F.filter(positions, lambda i: (i == 0) | (F.get(s, i - 1) != F.get(s, i))),
    ).otherwise(F.array().cast("array<int>"))


def run_lengths(ordered: str, starts: str) -> Column:
    """``array<struct<term, tf>>`` of a sorted array, given its run starts."""
    s, b = F.col(ordered), F.col(starts)
    return F.transform(
        b,
        lambda start, j: F.struct(
            F.get(s, start).alias("term"),
            (F.coalesce(F.get(b, j + 1), F.size(s)) - start).alias("tf"),
        ),
    )
