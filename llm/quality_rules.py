"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A text fails at its first broken rule, and rules behind that aren't computed for it. Before the run, every rule is tried on
a sample: its cost is the time it takes there, its selectivity the share of texts it rejects. Rules run in descending order
of rejection per cost. A text is kept if it breaks no rule, so the order decides the time and never the result.

Defined results: null texts have no words and fail the base rule; counts are per row, so repeated rows and other columns
don't matter; rules compare whole numbers, and a text exactly at a limit passes.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\u000b\f\r"
_WORD_BREAK = "[ \\t-\\r]+"
#: Rows of the sample on which costs and selectivities are estimated, about.
SAMPLE = 2000
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_words(documents: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_text`` (never null) and the array ``_words``."""
    trimmed = F.btrim(F.col("_text"), F.lit(SPACES))
    rows = documents.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    return rows.withColumn("_words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _WORD_BREAK)))


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``; windows are compared by 64 bits, within one text."""
    word = lambda i: F.get("_words", i)
    windows = F.transform(F.sequence(F.lit(0), F.size("_words") - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("_windows", F.when(F.size("_words") < 3, none).otherwise(windows))
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_ordered", F.when(some, ordered))
    twin = lambda k, h: F.coalesce(F.get("_ordered", k)["h"] == h, F.lit(False))
    places = F.filter("_ordered", lambda x, k: twin(k - 1, x["h"]) | twin(k + 1, x["h"]))
    rows = rows.withColumn("_places", F.sort_array(F.transform(places, lambda x: x["i"])))
    covered = F.transform("_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_places", k + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_windows", "_ordered", "_places")


def with_features(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the base counts, ``_text``, ``_words`` and ``_n_lines`` (lines with a word)."""
    rows = with_words(documents.drop(*FEATURES), text_col)
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = rows.withColumn("_lines", lines)
    rows = rows.select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("_n_lines"),
    )
    return _with_repeats(rows.drop("_lines"))


@dataclass(frozen=True)
class Rule:
    """``breaks`` is true where a text breaks the rule; it may use the counts, ``_text``, ``_words`` and ``_n_lines``."""

    name: str
    breaks: Column


def _count(pattern: str) -> Column:
    return F.regexp_count("_text", F.lit(pattern)).cast("long")


def default_rules() -> list[Rule]:
    """Rules on base counts, and rules that read the text again."""
    n = F.col("n_words")
    return [
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("symbols", F.col("n_symbols") * 10 > n),
        Rule("lines_repeated", F.col("n_dup_lines") * 2 > F.col("_n_lines")),
        Rule("shouting", _count(r"\p{Lu}") * 2 > _count(r"\p{L}")),
        Rule("letters", _count(r"\p{L}") * 2 < F.col("word_chars")),
        Rule("exclamation", _count("!") * 5 > n),
    ]


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / self.cost


def estimate(rows: DataFrame, rules: list[Rule], sample: int = SAMPLE) -> list[Estimate]:
    """Cost (seconds per row of the sample) and rejected share of each rule, the best worth first."""
    n = rows.count()
    if not n:
        return [Estimate(r, 1.0, 0.0) for r in rules]
    drawn = rows.sample(fraction=min(1.0, sample / n), seed=5).select("_text").persist()
    try:
        measured = with_features(drawn, "_text").persist()
        try:
            total, found = max(1, measured.count()), []
            for rule in rules:
                start = time.perf_counter()
                hit = measured.where(rule.breaks).count()
                found.append(Estimate(rule, (time.perf_counter() - start) / total, hit / total))
        finally:
            measured.unpersist()
    finally:
        drawn.unpersist()
    return sorted(found, key=lambda e: -e.worth)


def cascade(rules: list[Rule]) -> Column:
    """Name of the first broken rule, null if none is; later rules aren't evaluated."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule.breaks, F.lit(rule.name)).otherwise(out)
    return out


def judge(documents: DataFrame, text_col: str = "text", rules: list[Rule] | None = None, sample: int = SAMPLE) -> DataFrame:
    """The documents with the base counts, ``base_failed``, ``broken_rule`` and ``kept``."""
    documents = documents.drop("base_failed", "broken_rule", "kept")
    rules = default_rules() if rules is None else rules
    order = [e.rule for e in estimate(documents.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text")), rules, sample)]
    rows = with_features(documents, text_col)
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    rows = rows.withColumn("base_failed", base)
    broken = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(order))
    rows = rows.withColumn("broken_rule", broken).withColumn("kept", F.col("broken_rule").isNull())
    return rows.drop("_text", "_words", "_n_lines")
