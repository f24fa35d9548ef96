"""Consensus labels, conflict resolution and training-data strategies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions import lexicons as lex
from annospark.functions import votes as v
from annospark.operators import keys


def with_votes(df: DataFrame, labels: Sequence[str] = lex.LABELS, suffix: str = "_votes") -> DataFrame:
    """Add the parsed vote list of every label, parsed once for all later uses."""
    return df.withColumns({f"{c}{suffix}": v.parse_votes(F.col(c)) for c in labels})


def with_labels(df: DataFrame, labels: Sequence[str] = lex.LABELS) -> DataFrame:
    """Add ``<label>_label`` in {0, 0.5, 1, null} for every vote column."""
    return df.withColumns({f"{c}_label": v.majority(v.parse_votes(F.col(c))) for c in labels})


def with_annotator_count(df: DataFrame, ids: str = "annotators_id", out: str = "num_annotators") -> DataFrame:
    return df.withColumn(out, F.size(v.parse_ids(F.col(ids))))


def with_agreement(df: DataFrame, label: str = "toxicity", out: str = "agreement_group") -> DataFrame:
    return df.withColumn(out, v.agreement_group(v.parse_votes(F.col(label))))


def by_annotator_count(df: DataFrame, approach: str, count: str = "num_annotators") -> DataFrame:
    """``single`` keeps texts with one annotator, ``more`` the others."""
    if approach == "single":
        return df.filter(F.col(count) == 1)
    if approach == "more":
        return df.filter(F.col(count) != 1)
    raise ValueError(f"Unsupported approach: {approach}")


def most_frequent(label: Column, outcomes: Sequence[float] = lex.VOTE_OUTCOMES) -> Column:
    """Aggregate: the most frequent of the declared outcomes, ties to the smallest; null if none occurs."""
    counts = [F.count(F.when(label == v, 1)) for v in outcomes]
    most = F.greatest(*counts)
    out = F.lit(None).cast("double")
    for v, n in sorted(zip(outcomes, counts, strict=True), reverse=True):
        out = F.when((n == most) & (n > 0), F.lit(float(v))).otherwise(out)
    return out


def resolve_conflicts(
    df: DataFrame, key: Column, label: str, row_id: str, out: str = "resolved", outcomes: Sequence[float] = lex.VOTE_OUTCOMES
) -> DataFrame:
    """Give every row the most frequent label of its group, ties to the smallest.

    Only rows of groups whose labels differ are looked up, by id and key alone; all other rows keep their own label.
    ``outcomes`` are the labels that can occur.
    """
    keyed = df.select(row_id, F.col(label), keys.digest(key).alias("_key"))
    groups = (
        keyed.groupBy("_key")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count(label).alias("_known"),
            F.min(label).alias("_lo"),
            F.max(label).alias("_hi"),
            most_frequent(F.col(label), outcomes).alias("_mode"),
        )
        .filter((F.col("_lo") != F.col("_hi")) | ((F.col("_known") > 0) & (F.col("_known") < F.col("_n"))))
    )
    found = keys.lookup_by_key(keyed.select(row_id, "_key"), groups, "_key", row_id, ["_mode"], "inner").drop("_key")
    return df.join(found, row_id, "left").select(
        *[F.col(f"`{c}`") for c in df.columns if c != out], F.coalesce(F.col("_mode"), F.col(label)).alias(out)
    )


def is_changed(label: Column, resolved: Column) -> Column:
    """Whether resolution changed a row; a null label counts as changed."""
    return label.isNull() | resolved.isNull() | (label != resolved)


def pool_revote(
    df: DataFrame,
    key: Column,
    row_id: str,
    labels: Sequence[str] = lex.LABELS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Merge all votes on equal texts and vote again, one row per text.

    Only vote sums and counts are shuffled; ``carry`` columns come from the
    first row of each group by its unique id.
    """
    voted = with_votes(df.withColumn("_key", keys.digest(key)), labels)
    sums = voted.withColumns(
        {
            name: col
            for c in labels
            for name, col in (
                (f"{c}_sum", v.vote_sum(F.col(f"{c}_votes"))),
                (f"{c}_n", F.size(f"{c}_votes").cast("long")),
            )
        }
    )
    pooled = sums.groupBy("_key").agg(
        F.min(row_id).alias(row_id),
        F.count(F.lit(1)).alias("copies"),
        *[F.sum(f"{c}{s}").alias(f"{c}{s}") for c in labels for s in ("_sum", "_n")],
    )
    out = pooled.select(
        row_id,
        "copies",
        *[F.col(f"{c}_n").alias(f"{c}_pooled_votes") for c in labels],
        *[v.majority_of(F.col(f"{c}_sum"), F.col(f"{c}_n")).alias(f"{c}_label") for c in labels],
    )
    if not carry:
        return out
    return out.join(df.select(row_id, *carry), row_id)


def first_per_key(df: DataFrame, key: Column, row_id: str) -> DataFrame:
    """Keep the first row of every group.

    The survivors are found on (digest, id) alone and fetched by their unique
    id, so neither step sends a whole group to one task.
    """
    survivors = df.select(keys.digest(key).alias("_key"), F.col(row_id)).groupBy("_key").agg(
        F.min(row_id).alias(row_id)
    )
    return keys.rows_at(df, survivors, row_id)


def deduplicate(
    df: DataFrame, variant: str, key: Column, row_id: str, labels: Sequence[str] = lex.LABELS
) -> DataFrame:
    """``none``, ``first`` (keep the first copy) or ``pool`` (merge votes); labels voted."""
    if variant == "none":
        return with_labels(df, labels)
    if variant == "first":
        return with_labels(first_per_key(df, key, row_id), labels)
    if variant == "pool":
        carry = [c for c in df.columns if c != row_id]
        return pool_revote(df, key, row_id, labels, carry)
    raise ValueError(f"Unsupported variant: {variant}")


def tie_strategy(
    df: DataFrame, strategy: str, label: str, split: str = "split", weight: float = lex.TIE_WEIGHT
) -> DataFrame:
    """Ties in training: ``drop``, ``soft`` or ``weighted``; never in other splits."""
    tie = F.coalesce(F.col(label) == 0.5, F.lit(False))
    rest = ~tie | (F.col(split) == "train")
    if strategy == "drop":
        return df.filter(~tie).withColumn("weight", F.lit(1.0))
    if strategy == "soft":
        return df.filter(rest).withColumn("weight", F.lit(1.0))
    if strategy == "weighted":
        return df.filter(rest).withColumn("weight", F.when(tie, F.lit(weight)).otherwise(F.lit(1.0)))
    raise ValueError(f"Unsupported strategy: {strategy}")


def annotator_strategy(
    df: DataFrame, strategy: str, count: str = "num_annotators", weight: float = lex.SINGLE_ANNOTATOR_WEIGHT
) -> DataFrame:
    """Add ``weight`` and ``phase``: ``equal``, ``confidence``, ``curriculum``, ``consensus``.

    ``phase`` is the first training phase a row takes part in.
    """
    several = F.col(count) >= 2
    one = F.lit(1.0)
    if strategy == "equal":
        return df.withColumns({"weight": one, "phase": F.lit(1)})
    if strategy == "confidence":
        return df.withColumns({"weight": F.when(several, one).otherwise(F.lit(weight)), "phase": F.lit(1)})
    if strategy == "curriculum":
        return df.withColumns({"weight": one, "phase": F.when(several, 1).otherwise(2)})
    if strategy == "consensus":
        return df.filter(several).withColumns({"weight": one, "phase": F.lit(1)})
    raise ValueError(f"Unsupported strategy: {strategy}")


def unanimous(df: DataFrame, label: str = "toxicity", min_votes: int = 2) -> DataFrame:
    """Rows with at least ``min_votes`` votes that all agree."""
    return df.filter(v.is_unanimous(v.parse_votes(F.col(label)), min_votes))


def drop_spam(df: DataFrame, spam_label: str = "is_noise_or_spam_text_label") -> DataFrame:
    return df.filter(F.coalesce(F.col(spam_label) != 1, F.lit(True)))


def class_weights(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``pos_weight`` = negatives / positives per label column, null without positives."""
    counts = df.agg(
        *[F.count(F.when(F.col(c) == x, 1)).alias(f"{c}_{x}") for c in labels for x in (0, 1)]
    )
    return keys.unpivot_row(
        counts,
        [
            F.struct(
                F.lit(c).alias("label"),
                F.col(f"{c}_0").alias("n0"),
                F.col(f"{c}_1").alias("n1"),
                F.when(F.col(f"{c}_1") > 0, F.col(f"{c}_0") / F.col(f"{c}_1")).alias("pos_weight"),
            )
            for c in labels
        ],
    )
