"""Vote lists kept as text (``"['1', '0']"``): parsing and consensus.

A list is accepted only as a whole; anything malformed becomes an empty list.
Quoted items must be integers, bare numbers may carry a fraction that is cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from annospark.functions import lexicons as lex
from annospark.functions.patterns import WS

_NUMBER = r"[+-]?\d+"
_GAP = f"[{WS}]*"
_ITEM = rf"(?:'{_GAP}{_NUMBER}{_GAP}'|\"{_GAP}{_NUMBER}{_GAP}\"|{_NUMBER}(?:\.\d*)?)"
_ITEMS = rf"(?:{_GAP}{_ITEM}{_GAP}(?:,{_GAP}{_ITEM}{_GAP})*,?)?{_GAP}"
_VOTE_LIST = rf"^{_GAP}(?:\[{_ITEMS}\]|\({_ITEMS}\)){_GAP}\z"
#: Votes beyond this size count as this size, so that sums of some thousand votes can't overflow.
VOTE_LIMIT = 10**15
_ID_LIST = rf"^{_GAP}\[[^\[\]]*\]{_GAP}\z"
_ID_ITEM = rf"'[^']*'|\"[^\"]*\"|[^{WS},\[\]'\"]+"


def parse_votes(raw: Column) -> Column:
    """``array<bigint>`` of the votes; empty when the text is not a list of integers.

    A number of any length keeps its sign and counts as at most ``VOTE_LIMIT``.
    """
    numbers = F.regexp_extract_all(raw, F.lit(rf"({_NUMBER})(?:\.\d*)?"), F.lit(1))

    def limited(x: Column) -> Column:
        number = x.try_cast("bigint")  # null beyond 64 bits
        beyond = F.when(x.startswith("-"), -VOTE_LIMIT).otherwise(VOTE_LIMIT)
        return F.when(number.between(-VOTE_LIMIT, VOTE_LIMIT), number).otherwise(beyond)

    # Only lists with a long number pay for the look at each of them.
    parsed = F.when(raw.rlike(r"\d{16}"), F.transform(numbers, limited)).otherwise(numbers.try_cast("array<bigint>"))
    return F.when(F.coalesce(raw.rlike(_VOTE_LIST), F.lit(False)), parsed).otherwise(F.array().cast("array<bigint>"))


def parse_ids(raw: Column) -> Column:
    """``array<string>`` of the annotator ids in the list."""
    quoted = F.regexp_extract_all(raw, F.lit(_ID_ITEM), F.lit(0))
    return F.when(
        F.coalesce(raw.rlike(_ID_LIST), F.lit(False)),
        F.transform(quoted, lambda x: F.btrim(x, F.lit("'\""))),
    ).otherwise(F.array().cast("array<string>"))


def _fold(votes: Column, finish: Callable[[Column, Column], Column]) -> Column:
    """``finish(n, total)`` of a vote list that is read once.

    A label is filtered, grouped and compared a lot; with one reference to the
    list its expression stays small wherever the optimizer copies it to.
    """
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        votes,
        start,
        lambda s, x: F.struct((s["n"] + 1).alias("n"), (s["total"] + F.coalesce(x, F.lit(0))).alias("total")),
        lambda s: finish(s["n"], s["total"]),
    )


def vote_sum(votes: Column) -> Column:
    return _fold(votes, lambda n, total: total)


def vote_mean(votes: Column) -> Column:
    """Mean vote, null for an empty list."""
    return _fold(votes, lambda n, total: F.when(n > 0, total / n))


def majority_of(total: Column, n: Column) -> Column:
    """1, 0, or 0.5 on a tie, from a vote sum and a vote count; null without votes."""
    return (
        F.when(total * 2 > n, F.lit(1.0))
        .when(total * 2 < n, F.lit(0.0))
        .when(n > 0, F.lit(0.5))
    )


def majority(votes: Column) -> Column:
    return _fold(votes, lambda n, total: majority_of(total, n))


def agreement_group(votes: Column) -> Column:
    """How far the annotators of one text agree."""
    return _fold(
        votes,
        lambda n, total: F.when(n == 0, lex.UNKNOWN_AGREEMENT)
        .when((n == 1) | (total == 0) | (total == n), lex.NO_DISAGREEMENT)
        .when(total * 2 == n, lex.EVEN_DISAGREEMENT)
        .otherwise(lex.UNEVEN_DISAGREEMENT),
    )


def is_unanimous(votes: Column, min_votes: int = 2) -> Column:
    """At least ``min_votes`` votes, all equal to 0 or all equal to 1."""
    return _fold(votes, lambda n, total: (n >= min_votes) & ((total == 0) | (total == n)))


def final_label(votes: Column) -> Column:
    """1 when more than half of the votes are positive, else 0."""
    return _fold(votes, lambda n, total: F.when(total * 2 > n, 1).otherwise(0))


def any_positive(votes: Column) -> Column:
    return _fold(votes, lambda n, total: F.when(total > 0, 1).otherwise(0))


def polarized_value(votes: Column, method: str = "agg") -> Column:
    """Mean vote, or the mean cut to 0/1: ``bin`` > .5, ``bin-ceil`` >= .5, ``any`` > 0."""
    mean = F.coalesce(vote_mean(votes), F.lit(0.0))
    cuts = {"bin": mean > 0.5, "bin-ceil": mean >= 0.5, "any": mean > 0}
    if method == "agg":
        return mean
    if method not in cuts:
        raise ValueError(f"Unsupported method: {method}")
    return F.when(cuts[method], 1).otherwise(0)
