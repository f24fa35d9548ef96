"""Validity, duplicates, conflicts, elements and outliers of a text table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions import lexicons as lex
from annospark.functions import patterns as p
from annospark.functions.cleaning import duplicate_key, literal_map
from annospark.operators import keys, ranks


def text_validity(df: DataFrame, text: str = "text") -> DataFrame:
    """Count and share of each kind of unusable text and of their union."""
    flags = p.validity_flags(F.col(text))
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.when(c, 1)).alias(name) for name, c in flags.items()]
    )
    return keys.unpivot_row(
        counts,
        [
            F.struct(
                F.lit(name).alias("kind"),
                F.col(name).alias("n"),
                keys.percent(F.col(name), F.col("rows")).alias("pct"),
            )
            for name in flags
        ],
    )


def drop_invalid(df: DataFrame, text: str = "text", literals: bool = False) -> DataFrame:
    """Drop null, empty, blank and symbol-only texts; ``literals`` also drops ``nan`` words."""
    flags = p.validity_flags(F.col(text))
    bad = flags["null"] | flags["empty"] | flags["whitespace_only"] | flags["symbol_only"]
    if literals:
        bad = bad | flags["null_literal"]
    return df.filter(~bad)


def drop_unlabelled(df: DataFrame, label: str) -> DataFrame:
    return df.na.drop(subset=[label])


def duplicate_summary(df: DataFrame, text: str = "text") -> DataFrame:
    """Copies of rows, of texts and of normalised texts, from one scan and one shuffle."""
    marks = F.explode(
        F.array(
            F.struct(F.lit("row").alias("kind"), keys.row_digest(df).alias("key")),
            F.struct(F.lit("text").alias("kind"), keys.digest(F.col(text)).alias("key")),
            F.struct(F.lit("normalised").alias("kind"), keys.digest(duplicate_key(F.col(text))).alias("key")),
        )
    )
    groups = df.select(marks.alias("_m")).groupBy("_m.kind", "_m.key").agg(F.count(F.lit(1)).alias("n"))

    def total(kind: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, value)), F.lit(0))

    n = F.col("n")
    in_groups = F.when(n > 1, n).otherwise(0)
    row = groups.agg(
        total("row", n).alias("rows"),
        total("row", n - 1).alias("duplicate_rows"),
        total("text", in_groups).alias("rows_in_duplicate_texts"),
        total("text", n - 1).alias("excess_text_copies"),
        total("normalised", n - 1).alias("excess_normalised_copies"),
    )
    names = ["duplicate_rows", "rows_in_duplicate_texts", "excess_text_copies", "excess_normalised_copies"]
    return keys.unpivot_row(
        row,
        [
            F.struct(
                F.lit(c).alias("metric"), F.col(c).alias("n"), keys.percent(F.col(c), F.col("rows")).alias("pct")
            )
            for c in names
        ],
    )


def _copied_groups(df: DataFrame, text: str, row_id: str) -> DataFrame:
    return (
        df.select(keys.digest(F.col(text)).alias("_key"), F.col(row_id))
        .groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(row_id).alias(row_id))
        .filter("_n > 1")
    )


def duplicate_examples(
    df: DataFrame, text: str, row_id: str, show: Sequence[str], k: int = 12
) -> DataFrame:
    """The first ``k`` rows of duplicated texts, sorted by text and id.

    Every duplicated text has at least two rows, so the ``k`` smallest texts
    suffice; they are found on one row per group and broadcast (``k`` rows).
    """
    groups = _copied_groups(df.filter(F.col(text).isNotNull()), text, row_id)
    smallest = (
        keys.rows_at(df.select(row_id, text), groups, row_id)
        .orderBy(text, row_id)
        .limit(k)
        .select(keys.digest(F.col(text)).alias("_key"))
    )
    rows = df.withColumn("_key", keys.digest(F.col(text)))
    return (
        rows.join(F.broadcast(smallest), "_key", "left_semi")
        .orderBy(text, row_id)
        .limit(k)
        .select(row_id, *[c for c in show if c != row_id])
    )


def _conflict_groups(df: DataFrame, text: str, label: str, row_id: str) -> DataFrame:
    return (
        df.filter(F.col(text).isNotNull())
        .select(keys.digest(F.col(text)).alias("_key"), F.col(label).alias("_label"), F.col(row_id))
        .filter("_label is not null")
        .groupBy("_key")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("_label").alias("lowest"),
            F.max("_label").alias("highest"),
            F.min(row_id).alias(row_id),
        )
        .filter("lowest <> highest")
    )


def conflict_keys(df: DataFrame, text: str, label: str, row_id: str) -> DataFrame:
    """Texts that carry more than one label value, with their extremes."""
    groups = _conflict_groups(df, text, label, row_id)
    return groups.join(df.select(row_id, text), row_id).select(text, "rows", "lowest", "highest")


def conflict_rows(df: DataFrame, text: str, label: str, row_id: str) -> DataFrame:
    """All rows whose text carries conflicting labels, unlabelled copies included."""
    groups = _conflict_groups(df, text, label, row_id).select("_key", F.lit(True).alias("_conflict"))
    keyed = df.select(row_id, keys.digest(F.col(text)).alias("_key"))
    found = keys.lookup_by_key(keyed, groups, "_key", row_id, ["_conflict"], "inner")
    return keys.rows_at(df, found, row_id)


def quality_by_group(df: DataFrame, group: str, text: str = "text", short: int = 3) -> DataFrame:
    """Rows, missing texts, very short texts and copied texts per group, in one pass."""
    rows = df.select(
        F.col(group),
        keys.digest(F.col(text)).alias("_key"),
        F.col(text).isNull().cast("long").alias("_missing"),
        (p.space_word_count(p.filled(F.col(text))) <= short).cast("long").alias("_short"),
    )
    texts = rows.groupBy(group, "_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_missing").alias("missing"), F.sum("_short").alias("short")
    )
    return texts.groupBy(group).agg(
        F.sum("n").alias("rows"),
        F.sum("missing").alias("missing_texts"),
        F.sum("short").alias("short_texts"),
        F.sum(F.col("n") - 1).alias("duplicate_texts"),
    )


def very_short(df: DataFrame, words: Column, limit: int = 3) -> DataFrame:
    return df.filter(words <= limit)


def very_long(df: DataFrame, words: Column, limit: int = 200) -> DataFrame:
    return df.filter(words >= limit)


def length_extremes(df: DataFrame, words: Column, short: int = 3, long: int = 200) -> DataFrame:
    """Rows with at most ``short`` and at least ``long`` words."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(words <= short, 1)).alias("very_short"),
        F.count(F.when(words >= long, 1)).alias("very_long"),
    )
    return keys.unpivot_row(
        row,
        [
            F.struct(F.lit(c).alias("kind"), F.col(c).alias("n"), keys.percent(F.col(c), F.col("rows")).alias("pct"))
            for c in ("very_short", "very_long")
        ],
    )


def iqr_outliers(df: DataFrame, value: str, approx: bool = False) -> DataFrame:
    """Rows whose value lies above Q3 + 1.5 * IQR, with that bound."""
    shares = (0.25, 0.75)
    if approx:
        found = df.agg(F.percentile_approx(F.col(value), F.array(*map(F.lit, shares))).alias("q"))
    else:
        found = ranks.exact_quantiles(df, {"v": F.col(value)}, shares)
    bound = found.select((F.get("q", 1) + 1.5 * (F.get("q", 1) - F.get("q", 0))).alias("b"))
    return df.withColumn("upper_bound", bound.scalar()).filter(F.col(value) > F.col("upper_bound"))


def element_prevalence(df: DataFrame, text: str = "text") -> DataFrame:
    """Documents and share per digital or emotional element."""
    flags = p.element_flags(p.filled(F.col(text)))
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.when(c, 1)).alias(n) for n, c in flags.items()])
    return keys.unpivot_row(
        row,
        [
            F.struct(F.lit(n).alias("element"), F.col(n).alias("documents"), keys.percent(F.col(n), F.col("rows")).alias("pct"))
            for n in flags
        ],
    )


def with_advice(elements: DataFrame, advice: Mapping[str, str] = lex.ELEMENT_ADVICE) -> DataFrame:
    """Attach the recommendation for each element."""
    return elements.withColumn("advice", F.try_element_at(literal_map(advice), F.col("element")))
