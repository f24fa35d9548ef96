"""Lengths, distributions, class summaries, correlation and time."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions import patterns as p
from annospark.operators import keys, ranks
from annospark.sources.tables import materialised

CLASS_ELEMENTS = ("url", "mention", "hashtag", "emoji", "allcaps", "repeated_punctuation")
WORD_BINS = ((10, "<=10"), (50, "11-50"), (100, "51-100"), (None, ">100"))


def with_lengths(df: DataFrame, text: str = "text") -> DataFrame:
    """Add characters, words, whitespace words and heuristic sentences of a text."""
    body = p.filled(F.col(text))
    return df.withColumns(
        {
            "chars": p.char_count(body),
            "words": p.word_count(body),
            "space_words": p.space_word_count(body),
            "sentences": p.sentence_count(body),
        }
    )


def histogram(
    df: DataFrame,
    value: str,
    bins: int = 60,
    by: str | None = None,
    classes: Sequence | None = None,
) -> DataFrame:
    """Equal-width bins between the extremes, the last bin closed, empty bins kept.

    With ``by`` each class has its own range. The extremes are one struct per
    class, so they reach the rows as a single literal row.
    """
    groups = [None] if by is None else list(classes if classes is not None else keys.domain_of(df, by))
    x = F.col(value).cast("double")
    member = [F.lit(True) if by is None else F.col(by) == F.lit(g) for g in groups]
    index = F.lit(None).cast("int")
    for i, m in enumerate(member):
        index = F.when(m, i).otherwise(index)
    bounds = df.agg(
        F.array(
            *[
                F.struct(F.min(F.when(m, x)).alias("lo"), F.max(F.when(m, x)).alias("hi"))
                for m in member
            ]
        ).alias("b")
    )
    rows = df.filter(x.isNotNull()).select(x.alias("x"), index.alias("g")).filter("g is not null")
    ranged = rows.withColumn("r", F.get(bounds.scalar(), F.col("g")))
    lo, hi = F.col("r.lo"), F.col("r.hi")
    # A constant column spreads half a unit to each side.
    lo, hi = F.when(lo == hi, lo - 0.5).otherwise(lo), F.when(lo == hi, hi + 0.5).otherwise(hi)
    bucket = F.least(F.floor((F.col("x") - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    counts = ranged.select("g", bucket.alias("bin")).groupBy("g", "bin").agg(F.count(F.lit(1)).alias("n"))
    frame = bounds.select(F.posexplode("b").alias("g", "r")).filter("r.lo is not null").select(
        "g", lo.alias("lo"), ((hi - lo) / bins).alias("step"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    # The frame has len(groups) * bins rows, the counts at most as many.
    out = frame.join(F.broadcast(counts), ["g", "bin"], "left").select(
        "g",
        "bin",
        (F.col("lo") + F.col("bin") * F.col("step")).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("step")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    if by is None:
        return out.drop("g")
    return out.select(F.get(F.array(*[F.lit(g) for g in groups]), F.col("g")).alias(by), "bin", "lower", "upper", "n")


def box_stats(df: DataFrame, value: str, approx: bool = False) -> DataFrame:
    """Quartiles, fences and whisker ends of a value.

    The whiskers need the quartiles first, then one filtered pass.
    """
    x, shares = F.col(value).cast("double"), (0.25, 0.5, 0.75)
    if approx:
        q = df.agg(F.percentile_approx(x, F.array(*map(F.lit, shares))).alias("q"))
    else:
        df = materialised(df.select(x.alias(value)), "numbers")
        q = ranks.exact_quantiles(df, {"x": F.col(value)}, shares).select("q")
    q1, q2, q3 = (F.get(F.col("q"), i) for i in range(3))
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    rows = df.select(x.alias("x")).withColumn("q", q.scalar())
    return rows.agg(
        F.first("q").alias("q"),
        F.min(F.when(F.col("x") >= low, F.col("x"))).alias("whisker_low"),
        F.max(F.when(F.col("x") <= high, F.col("x"))).alias("whisker_high"),
        F.count(F.when((F.col("x") < low) | (F.col("x") > high), 1)).alias("outliers"),
    ).select(
        q1.alias("q1"), q2.alias("median"), q3.alias("q3"), "whisker_low", "whisker_high", "outliers"
    )


def value_counts(
    df: DataFrame, column: str, dropna: bool = True, within: Sequence[str] = ()
) -> DataFrame:
    """Rows and share per value, optionally inside each group of ``within``.

    Counting comes first, so the share is computed on one row per value.
    """
    rows = df.filter(F.col(column).isNotNull()) if dropna else df
    counts = rows.groupBy(*within, column).agg(F.count(F.lit(1)).alias("n"))
    if within:
        totals = counts.groupBy(*within).agg(F.sum("n").alias("_all"))
        return counts.join(totals, list(within)).select(
            *within, column, "n", keys.percent(F.col("n"), F.col("_all")).alias("pct")
        )
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", keys.percent(F.col("n"), total).alias("pct"))


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"))


def tail_bucket(df: DataFrame, column: str, limit: int = 6) -> DataFrame:
    """Counts per value with everything above ``limit`` in one bucket."""
    name = F.when(F.col(column) > limit, F.lit(f">{limit}")).otherwise(F.col(column).cast("string"))
    return df.groupBy(name.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def positives(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Positive rows and their share per label column."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.when(F.col(c) == 1, 1)).alias(c) for c in labels]
    )
    return keys.unpivot_row(
        row,
        [
            F.struct(F.lit(c).alias("label"), F.col(c).alias("n1"), keys.percent(F.col(c), F.col("rows")).alias("pct"))
            for c in labels
        ],
    )


def label_stats(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Negatives, positives, ties, shares and imbalance ratio of every label, in one pass."""
    outcomes = {"n0": 0.0, "n1": 1.0, "n_tie": 0.5}
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count(F.when(F.col(c) == value, 1)).alias(f"{c}_{name}")
            for c in labels
            for name, value in outcomes.items()
        ],
    )

    def entry(c: str) -> Column:
        n0, n1 = F.col(f"{c}_n0"), F.col(f"{c}_n1")
        ratio = F.when(n1 > 0, F.concat(F.lit("1 : "), F.bround(n0 / n1, 0).cast("long").cast("string")))
        return F.struct(
            F.lit(c).alias("label"),
            *[F.col(f"{c}_{name}").alias(name) for name in outcomes],
            *[
                keys.percent(F.col(f"{c}_{name}"), F.col("rows")).alias(name.replace("n", "pct", 1))
                for name in outcomes
            ],
            F.coalesce(ratio, F.lit("N/A")).alias("ratio"),
        )

    return keys.unpivot_row(row, [entry(c) for c in labels])


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Majority and minority of the binary classes, their ratio and its reading."""
    row = df.agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("n0"), F.count(F.when(F.col(label) == 1, 1)).alias("n1")
    )
    ratio = F.when(F.least("n0", "n1") > 0, F.greatest("n0", "n1") / F.least("n0", "n1"))
    return row.select(
        F.greatest("n0", "n1").alias("majority"), F.least("n0", "n1").alias("minority"), ratio.alias("ratio")
    ).withColumn(
        "status",
        F.when(F.col("ratio") < 1.5, "balanced").when(F.col("ratio") < 3, "slightly imbalanced").otherwise("imbalanced"),
    )


def length_by_label(df: DataFrame, label: str, lengths: Sequence[str] = ("chars", "words")) -> DataFrame:
    """Count, mean and median of each length per label; null labels are left out."""
    rows = materialised(df.filter(F.col(label).isNotNull()).select(label, *lengths), "lengths")
    means = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in lengths])
    return _with_medians(rows, means, label, lengths).select(label, "n", *[f"{m}_{c}" for c in lengths for m in ("mean", "median")])


def _with_medians(rows: DataFrame, groups: DataFrame, label: str, values: Sequence[str]) -> DataFrame:
    """Groups with ``median_<value>`` of each value."""
    found = ranks.exact_quantiles(rows, {c: F.col(c) for c in values}, (0.5,), [label])
    medians = [F.max(F.when(F.col("measure") == c, F.get("q", 0))).alias(f"median_{c.lstrip('_')}") for c in values]
    return groups.join(found.groupBy(label).agg(*medians), label, "left")


def mean_length_by_class(df: DataFrame, label: str, words: str = "words") -> DataFrame:
    """Mean words of negative and of positive texts, on one row."""
    return df.agg(
        F.avg(F.when(F.col(label) == 0, F.col(words))).alias("mean_negative"),
        F.avg(F.when(F.col(label) == 1, F.col(words))).alias("mean_positive"),
    )


def class_summary(df: DataFrame, label: str, text: str = "text") -> DataFrame:
    """Documents, lengths and element shares per class; the texts are read once, while the plan is built."""
    body = p.filled(F.col(text))
    flags = p.element_flags(body)
    rows = df.filter(F.col(label).isNotNull()).select(
        F.col(label),
        p.char_count(body).alias("_chars"),
        p.word_count(body).alias("_words"),
        *[flags[e].cast("int").alias(e) for e in CLASS_ELEMENTS],
    )
    rows = materialised(rows, "classes")
    shares = [f"{e}_pct" for e in CLASS_ELEMENTS]
    found = rows.groupBy(label).agg(
        F.count(F.lit(1)).alias("documents"),
        F.avg("_chars").alias("mean_chars"),
        F.avg("_words").alias("mean_words"),
        *[(F.avg(e) * 100).alias(s) for e, s in zip(CLASS_ELEMENTS, shares, strict=True)],
    )
    found = _with_medians(rows, found, label, ["_chars", "_words"])
    return found.select(label, "documents", "mean_chars", "median_chars", "mean_words", "median_words", *shares)


def label_correlation(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Pearson correlation of every label pair over rows without a tie."""
    clean = df
    for c in labels:
        clean = clean.filter(~F.coalesce(F.col(c) == 0.5, F.lit(False)))
    pairs = list(combinations(labels, 2))
    row = clean.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return keys.unpivot_row(
        row,
        [
            F.struct(F.lit(a).alias("label_a"), F.lit(b).alias("label_b"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)
        ],
    )


def monthly_counts(df: DataFrame, ts: str) -> DataFrame:
    month = F.date_trunc("month", F.col(ts)).alias("period")
    return df.filter(F.col(ts).isNotNull()).groupBy(month).agg(F.count(F.lit(1)).alias("n"))


def period_crosstab(df: DataFrame, ts: str, label: str, values: Sequence | None = None) -> DataFrame:
    """Rows per month and label value, zero where none; one column per value."""
    values = list(values) if values is not None else keys.domain_of(df, label)
    rows = df.filter(F.col(ts).isNotNull() & F.col(label).isin(values))
    month = F.date_trunc("month", F.col(ts)).alias("period")
    return rows.groupBy(month).agg(
        *[F.count(F.when(F.col(label) == F.lit(x), 1)).alias(str(x)) for x in values]
    )


def topic_by_label(df: DataFrame, topic: str, label: str) -> DataFrame:
    """Rows per topic and label with totals; ``level`` tells which key is summed over."""
    return df.rollup(topic, label).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("level")
    )


def length_coverage(df: DataFrame, words: str, limits: Sequence[int]) -> DataFrame:
    """Share of texts with at most N words."""
    row = df.agg(*[F.avg((F.col(words) <= n).cast("int")).alias(f"c{n}") for n in limits])
    return keys.unpivot_row(
        row, [F.struct(F.lit(n).alias("max_words"), F.col(f"c{n}").alias("coverage")) for n in limits]
    )


def word_bin(words: Column) -> Column:
    out = None
    for limit, name in WORD_BINS:
        if limit is None:
            return out.otherwise(name)
        out = F.when(words <= limit, name) if out is None else out.when(words <= limit, name)
    return out
