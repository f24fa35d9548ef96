"""From annotated texts to model input: validate, resolve, deduplicate, clean, split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions import cleaning as clean
from annospark.functions import lexicons as lex
from annospark.functions import patterns as p
from annospark.functions import prompts
from annospark.operators import annotators as ann
from annospark.operators import keys, labels, quality, sampling
from annospark.sources.tables import materialised


def resolved_texts(df: DataFrame, label: str, row_id: str, text: str = "text") -> DataFrame:
    """One row per normalised text: its first row, with the group's most frequent label.

    A group is reduced to (first id, label counts) in every map task; the
    surviving rows are then fetched by their unique id.
    """
    groups = (
        df.select(keys.digest(clean.duplicate_key(F.col(text))).alias("_key"), F.col(row_id), F.col(label))
        .groupBy("_key")
        .agg(F.min(row_id).alias(row_id), labels.most_frequent(F.col(label)).alias("_label"))
        .drop("_key")
    )
    joined = df.join(groups, row_id)
    return joined.select(*[F.col("_label").alias(c) if c == label else F.col(f"`{c}`") for c in df.columns])


def prepare(
    df: DataFrame,
    row_id: str,
    text: str = "text",
    label: str = "toxicity",
    test: float = 0.2,
    seed: int = 42,
    slang: Mapping[str, str] | None = lex.SLANG_NORMAL,
    emoji: Mapping[str, str] | None = None,
    all_labels: Sequence[str] | None = None,
) -> DataFrame:
    """Cleaned, deduplicated texts with their label and split.

    Conflict resolution and deduplication come before the split, so no copy of
    a test text is in training.
    """
    voted = labels.with_labels(df, all_labels or [label])
    target = f"{label}_label"
    valid = quality.drop_invalid(voted, text)
    unique = quality.drop_unlabelled(resolved_texts(valid, target, row_id, text), target)
    unique = materialised(unique.select(row_id, text, target), "unique-texts")
    split = sampling.stratified_split(
        unique, target, row_id, (("test", test),), seed=seed, classes=lex.VOTE_OUTCOMES
    )
    cased = clean.preprocess(F.col(text), False, slang, emoji)
    # Lower-casing touches no blank, so the second form follows from the first.
    out = split.withColumn("text_clean_cased", cased).withColumn("text_clean_lower", F.lower("text_clean_cased"))
    return out.select(row_id, text, "text_clean_cased", "text_clean_lower", target, "split")


def step_log(df: DataFrame, row_id: str, text: str = "text", label: str = "toxicity") -> DataFrame:
    """Rows before and after each step, from one grouped pass over the texts.

    ``changed`` counts the rows whose label conflict resolution changes; a row left without a label counts as changed.
    """
    voted = labels.with_labels(df.select(row_id, text, label), [label])
    target = f"{label}_label"
    flags = _valid(text)
    groups = (
        voted.select(
            F.when(flags, keys.digest(clean.duplicate_key(F.col(text)))).alias("_key"), F.col(target)
        )
        .groupBy("_key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(target).alias("labelled"),
            F.greatest(*[F.count(F.when(F.col(target) == v, 1)) for v in lex.VOTE_OUTCOMES]).alias("same"),
        )
    )
    valid = F.col("_key").isNotNull()
    row = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("read"),
        F.coalesce(F.sum(F.when(valid, F.col("n"))), F.lit(0)).alias("valid"),
        F.count(F.when(valid, 1)).alias("unique"),
        F.count(F.when(valid & (F.col("labelled") > 0), 1)).alias("labelled"),
        F.coalesce(F.sum(F.when(valid, F.col("n") - F.col("same"))), F.lit(0)).alias("changed"),
    )
    none = F.lit(0).cast("long")
    steps = (
        ("drop_invalid", "read", "valid", none),
        ("resolve_conflicts", "valid", "valid", F.col("changed")),
        ("deduplicate", "valid", "unique", none),
        ("drop_unlabelled", "unique", "labelled", none),
    )
    return keys.unpivot_row(
        row,
        [
            F.struct(
                F.lit(name).alias("step"),
                F.col(a).alias("before"),
                F.col(b).alias("after"),
                (F.col(a) - F.col(b)).alias("dropped"),
                changed.alias("changed"),
            )
            for name, a, b, changed in steps
        ],
    )


def _valid(text: str) -> Column:
    flags = p.validity_flags(F.col(text))
    return ~(flags["null"] | flags["empty"] | flags["whitespace_only"] | flags["symbol_only"])


def experiment_rows(
    df: DataFrame,
    annotators: DataFrame,
    row_id: str,
    attributes: Sequence[str],
    language: str = "id",
    label: str = "toxicity",
    k: int = 5,
    seed: int = 42,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Annotation rows with fold, prompt and the annotator's own label.

    Folds are drawn on texts before the annotators are unfolded, so one text
    never sits on both sides of a fold.
    """
    target = f"{label}_label"
    texts = labels.with_labels(df, [label])
    folded = sampling.stratified_folds(texts, target, row_id, k, seed)
    rows = ann.explode_annotations(folded, annotators)
    return rows.select(
        row_id,
        "annotator_id",
        "fold",
        F.col(label).cast("int").alias("label"),
        prompts.demographic_prompt(F.col("text"), attributes, language, columns).alias("combined_text"),
    )
