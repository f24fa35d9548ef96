"""Findings and recommendations computed from the data.

A report row is a name, a measured value and a text; the measures come from
one-row aggregates, so a report costs a few narrow passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions import lexicons as lex
from annospark.functions import patterns as p
from annospark.operators import keys, lexical, quality

SIGNAL_ELEMENTS = ("hashtag", "emoji", "allcaps", "repeated_punctuation")


def signals_to_keep(df: DataFrame, text: str = "text", negations: Sequence[str] = lex.NEGATIONS) -> DataFrame:
    """Elements and negations that carry meaning, with their counts."""
    elements = quality.element_prevalence(df, text).filter(F.col("element").isin(*SIGNAL_ELEMENTS))
    found = lexical.negation_counts(lexical.token_counts(df, lexical.plain_words(F.col(text))), negations)
    return elements.select(
        F.col("element").alias("signal"), F.col("documents").alias("n"), "pct"
    ).unionByName(
        found.select(
            F.concat(F.lit("negation: "), F.col("token")).alias("signal"), "n", F.lit(None).cast("double").alias("pct")
        )
    )


def dominant_terms(df: DataFrame, text: str = "text", k: int = 5) -> DataFrame:
    """Most frequent words and bigrams without stop words."""
    words = lexical.without_stop_words(
        lexical.token_counts(df, lexical.plain_words(F.col(text))), lex.STOP_WORDS, 2
    )
    bigrams = lexical.ngram_counts(df, lexical.vectorizer_words(F.col(text)), 2, min_df=2)
    top_words = lexical.top(words, k).select(F.lit("word").alias("kind"), F.col("token").alias("term"), "n")
    top_bigrams = lexical.top(bigrams, k, "term").select(F.lit("bigram").alias("kind"), "term", "n")
    return top_words.unionByName(top_bigrams)


def _measures(df: DataFrame, label: str, text: str, row_id: str) -> DataFrame:
    """One row with every number the reports quote."""
    body = p.filled(F.col(text))
    flags = p.element_flags(body)
    words = p.word_count(body)
    base = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(p.validity_flags(F.col(text))["invalid"], 1)).alias("invalid"),
        F.count(F.when(F.col(label) == 0, 1)).alias("n0"),
        F.count(F.when(F.col(label) == 1, 1)).alias("n1"),
        F.max(words).alias("max_words"),
        F.percentile(words, F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75, 0.95, 0.99)])).alias("q"),
        sum((F.count(F.when(F.col(f"`{c}`").isNull(), 1)) for c in df.columns), F.lit(0)).alias("missing"),
        *[F.count(F.when(c, 1)).alias(name) for name, c in flags.items()],
    )
    copies = quality.duplicate_summary(df, text).agg(
        *[
            F.max(F.when(F.col("metric") == m, F.col("n"))).alias(m)
            for m in ("excess_text_copies", "excess_normalised_copies")
        ]
    )
    conflicts = quality.conflict_keys(df, text, label, row_id).agg(F.count(F.lit(1)).alias("conflicts"))
    counts = lexical.token_counts(df, lexical.plain_words(F.col(text)))
    t, n = F.col("token"), F.col("n")
    vocabulary = counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("tokens"),
        F.count(F.lit(1)).alias("types"),
        F.count(F.when(n == 1, 1)).alias("once"),
        F.count(F.when(n <= 5, 1)).alias("at_most_5"),
        F.coalesce(F.sum(F.when(t.isin(*lex.STOP_WORDS), n)), F.lit(0)).alias("stop_tokens"),
        F.coalesce(F.sum(F.when(t.isin(*lex.NEGATIONS), n)), F.lit(0)).alias("negations"),
        F.count(F.when(t.isin(*lex.SLANG_FORMS), 1)).alias("slang"),
        F.count(F.when(t.rlike(p.ELONGATION), 1)).alias("elongated"),
    )
    out = base
    for i, part in enumerate((copies, conflicts, vocabulary)):
        # One aggregate row each, attached as one scalar struct.
        out = out.withColumn(f"_s{i}", part.select(F.struct(*part.columns)).scalar())
    return out.select(*base.columns, "_s0.*", "_s1.*", "_s2.*")


def _pct(part: str) -> Column:
    return keys.percent(F.col(part), F.col("rows"))


def _rows(measures: DataFrame, values: dict[str, Column], texts: dict[str, tuple[str | Column, str | Column]], names: Sequence[str]) -> DataFrame:
    """One row per entry: its name, its measured value and its two texts."""
    a, b, c, d = names

    def text(x: str | Column) -> Column:
        return F.lit(x) if isinstance(x, str) else x

    return keys.unpivot_row(
        measures,
        [
            F.struct(F.lit(k).alias(a), v.cast("double").alias(b), text(texts[k][0]).alias(c), text(texts[k][1]).alias(d))
            for k, v in values.items()
        ],
    )


def _ratio() -> Column:
    return F.when(F.least("n0", "n1") > 0, F.greatest("n0", "n1") / F.least("n0", "n1"))


#: Impact and advice of each finding.
FINDING_TEXTS = {
    "rows": ("scale of the analysis", "use a reproducible pipeline"),
    "missing_values": ("missing values disturb parsing", "treat only the columns and rows concerned"),
    "invalid_texts": ("no linguistic content", "drop these rows"),
    "excess_text_copies": ("frequency bias", "review, then deduplicate"),
    "excess_normalised_copies": ("leakage between splits", "group copies before the split"),
    "leakage_pct": ("test scores may be too high", "deduplicate or group before the split"),
    "conflicting_texts": ("label noise", "apply one consensus rule"),
    "class_ratio": ("minority class may be learned poorly", "watch macro F1"),
    "class_0_pct": ("share of the class", "watch macro F1"),
    "class_1_pct": ("share of the class", "watch macro F1"),
    "median_words": ("typical length", "set the input length by model tokens"),
    "q1_words": ("typical length", "set the input length by model tokens"),
    "q3_words": ("typical length", "set the input length by model tokens"),
    "max_words": ("truncation risk", "set the input length by model tokens"),
    "types": ("sparsity of word models", "use subwords, no blind normalisation"),
    "tokens": ("corpus size", "use subwords, no blind normalisation"),
    "lexical_diversity": ("sparsity of word models", "use subwords, no blind normalisation"),
    "words_seen_once": ("typos, names or rare offensive terms", "don't drop; classify them"),
    "words_seen_at_most_5": ("typos, names or rare offensive terms", "don't drop; classify them"),
    "slang_forms": ("spelling variation", "normalise forms that occur"),
    "elongated_words": ("emphasis or typos", "normalise forms that occur"),
    **{f"{e}_pct": ("digital or emotional signal", "normalise selectively") for e in p.ELEMENTS},
}


def findings(df: DataFrame, label: str, text: str, row_id: str) -> DataFrame:
    """What the data shows: name, measured value, impact and advice."""
    m = _measures(df, label, text, row_id)
    labelled = F.col("n0") + F.col("n1")
    values = {
        "rows": F.col("rows"),
        "missing_values": F.col("missing"),
        "invalid_texts": F.col("invalid"),
        "excess_text_copies": F.col("excess_text_copies"),
        "excess_normalised_copies": F.col("excess_normalised_copies"),
        "leakage_pct": _pct("excess_normalised_copies"),
        "conflicting_texts": F.col("conflicts"),
        "class_ratio": _ratio(),
        "class_0_pct": keys.percent(F.col("n0"), labelled),
        "class_1_pct": keys.percent(F.col("n1"), labelled),
        "median_words": F.get("q", 1),
        "q1_words": F.get("q", 0),
        "q3_words": F.get("q", 2),
        "max_words": F.col("max_words"),
        "types": F.col("types"),
        "tokens": F.col("tokens"),
        "lexical_diversity": F.when(F.col("tokens") > 0, F.col("types") / F.col("tokens")),
        "words_seen_once": F.col("once"),
        "words_seen_at_most_5": F.col("at_most_5"),
        "slang_forms": F.col("slang"),
        "elongated_words": F.col("elongated"),
        **{f"{e}_pct": _pct(e) for e in p.ELEMENTS},
    }
    return _rows(m, values, FINDING_TEXTS, ("finding", "value", "impact", "advice"))


#: Decision and reason of each step; where the measure decides: (if any, if none).
STEP_TEXTS = {
    "invalid_texts": (("drop invalid rows", "nothing to drop"), "share of rows without content"),
    "lowercase": ("consider, not automatic", "share of texts in capitals, which mark intensity"),
    "url": (("replace by <URL>", "no priority"), "share of texts with a link"),
    "mention": (("replace by <USER>", "no priority"), "share of texts with a mention"),
    "hashtag": ("keep the word, drop the sign if needed", "share of texts with a hashtag"),
    "emoji": ("keep or describe", "share of texts with an emoji"),
    "punctuation": ("cap repeats, keep the signal", "share of texts with repeated punctuation"),
    "whitespace": ("normalise", "share of texts with a line break; words don't change"),
    "slang": (("normalise selectively", "not needed yet"), "forms of the dictionary that occur"),
    "elongation": ("selective", "elongated forms; repeats may mark intensity"),
    "stop_words": ("optional and conservative", "share of tokens; negations stay"),
    "stemming": ("test, not automatic", "may break slang, names and offensive words"),
    "negation": ("always keep", "negations that occur; they turn the meaning"),
    "deduplication": (("before the split", "check before the split"), "excess copies after normalisation"),
    "conflicting_labels": ("apply one consensus rule", "texts with more than one label"),
    "class_imbalance": ("class weights and macro F1", "majority to minority"),
    "max_length_p95": ("settle on model tokens", "words of a long text"),
    "max_length_p99": ("settle on model tokens", "words of a very long text"),
}
_DECIDED_BY = {"invalid_texts": "invalid", "url": "url", "mention": "mention", "slang": "slang", "deduplication": "excess_normalised_copies"}


def recommendations(df: DataFrame, label: str, text: str, row_id: str) -> DataFrame:
    """Preprocessing steps: the measure that decides, the decision and its reason."""
    m = _measures(df, label, text, row_id)
    values = {
        "invalid_texts": _pct("invalid"),
        "lowercase": _pct("allcaps"),
        "url": _pct("url"),
        "mention": _pct("mention"),
        "hashtag": _pct("hashtag"),
        "emoji": _pct("emoji"),
        "punctuation": _pct("repeated_punctuation"),
        "whitespace": _pct("newline"),
        "slang": F.col("slang"),
        "elongation": F.col("elongated"),
        "stop_words": keys.percent(F.col("stop_tokens"), F.col("tokens")),
        "stemming": F.lit(None),
        "negation": F.col("negations"),
        "deduplication": F.col("excess_normalised_copies"),
        "conflicting_labels": F.col("conflicts"),
        "class_imbalance": _ratio(),
        "max_length_p95": F.get("q", 3),
        "max_length_p99": F.get("q", 4),
    }
    texts: dict[str, tuple[str | Column, str | Column]] = {}
    for step, (decision, reason) in STEP_TEXTS.items():
        if isinstance(decision, tuple):
            decision = F.when(F.col(_DECIDED_BY[step]) > 0, decision[0]).otherwise(decision[1])
        texts[step] = (decision, reason)
    return _rows(m, values, texts, ("step", "measure", "recommendation", "reason"))
