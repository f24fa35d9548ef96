"""Scores of predictions: binary, sliced, swept, multi-label and compared.

Every score is arithmetic on confusion counts, so any grouping costs one
aggregation whose rows are combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.functions import lexicons as lex
from annospark.operators import keys

SCORES = (
    "accuracy",
    "macro_f1",
    "precision",
    "recall",
    "precision_class_1",
    "recall_class_1",
    "f1_class_1",
    "precision_class_0",
    "recall_class_0",
    "f1_class_0",
    "roc_auc",
    "precision_recall_auc",
)
CELLS = ("tp", "fp", "fn", "tn")


def argmax(scores: Column) -> Column:
    """Index of the first largest class score."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def cells(label: Column, pred: Column) -> dict[str, Column]:
    """The four confusion counts as aggregates."""
    pairs = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    return {name: F.count(F.when((label == a) & (pred == b), 1)).alias(name) for name, (a, b) in pairs.items()}


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(tp * 2, tp * 2 + fp + fn)


def with_scores(counts: DataFrame) -> DataFrame:
    """Add all scores to rows holding ``tp, fp, fn, tn``; 0/0 is 0.

    Precision, recall and F1 without a class are unweighted means over the classes
    that occur in labels or predictions. Both curve areas are those of the hard predictions: one operating
    point, 0.5 for the ROC area when only one class occurs.
    """
    tp, fp, fn, tn = (F.col(c) for c in CELLS)
    n = tp + fp + fn + tn
    out = counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, n),
            "precision_class_1": _ratio(tp, tp + fp),
            "recall_class_1": _ratio(tp, tp + fn),
            "f1_class_1": f1_of(tp, fp, fn),
            "precision_class_0": _ratio(tn, tn + fn),
            "recall_class_0": _ratio(tn, tn + fp),
            "f1_class_0": f1_of(tn, fn, fp),
        }
    )
    classes = (tp + fp + fn > 0).cast("int") + (tn + fp + fn > 0).cast("int")

    def mean(score: str) -> Column:  # a class that doesn't occur scores 0
        return _ratio(F.col(f"{score}_class_0") + F.col(f"{score}_class_1"), classes)

    return out.withColumns(
        {
            "macro_f1": mean("f1"),
            "precision": mean("precision"),
            "recall": mean("recall"),
            "roc_auc": F.when(
                (tp + fn > 0) & (tn + fp > 0), (F.col("recall_class_0") + F.col("recall_class_1")) / 2
            ).otherwise(F.lit(0.5)),
            "precision_recall_auc": F.when(
                tp + fn > 0,
                F.col("recall_class_1") * F.col("precision_class_1")
                + (1 - F.col("recall_class_1")) * _ratio(tp + fn, n),
            ).otherwise(F.lit(0.0)),
        }
    )


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """All scores, optionally per group such as a fold."""
    counts = df.groupBy(*by).agg(*cells(F.col(label), F.col(pred)).values())
    return with_scores(counts).select(*by, *CELLS, *SCORES)


def average_over(folds: DataFrame, scores: Sequence[str] = SCORES) -> DataFrame:
    """Mean and deviation of every score over folds or runs."""
    row = folds.agg(
        *[a for s in scores for a in (F.avg(s).alias(f"{s}_m"), F.stddev_samp(s).alias(f"{s}_s"))]
    )
    return keys.unpivot_row(
        row,
        [F.struct(F.lit(s).alias("metric"), F.col(f"{s}_m").alias("mean"), F.col(f"{s}_s").alias("std")) for s in scores],
    )


def score_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC area of real scores by the rank sum, equal scores sharing their rank.

    Rows are first counted per distinct score; the running count then sees one
    row per score value.
    """
    per_score = df.groupBy(F.col(score).alias("s")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("p"), F.count(F.when(F.col(label) == 0, 1)).alias("n")
    )
    # Only scores of one bucket are summed in order; the buckets follow the scores' own quantiles.
    bucketed = per_score.withColumn("b", keys.range_of(per_score, "s"))
    sizes = bucketed.groupBy("b").agg(F.sum("n").alias("bn"))
    before_bucket = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("b", F.coalesce(F.sum("bn").over(before_bucket), F.lit(0)).alias("off"))
    before = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = bucketed.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0))).join(offsets, "b")
    wins = F.sum(F.col("p") * (F.col("below") + F.col("off") + F.col("n") / 2.0))
    return ranked.agg(F.sum("p").alias("positives"), F.sum("n").alias("negatives"), wins.alias("w")).select(
        "positives",
        "negatives",
        F.when((F.col("positives") > 0) & (F.col("negatives") > 0), F.col("w") / F.col("positives") / F.col("negatives"))
        .otherwise(F.lit(0.5))
        .alias("roc_auc"),
    )


def confusion(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rows per label, actual and predicted value; ``pairs`` maps a label to its columns."""
    cells_ = F.explode(
        F.array(
            *[
                F.struct(F.lit(k).alias("label"), F.col(a).cast("int").alias("actual"), F.col(b).cast("int").alias("predicted"))
                for k, (a, b) in pairs.items()
            ]
        )
    )
    return df.select(cells_.alias("_c")).groupBy("_c.label", "_c.actual", "_c.predicted").agg(F.count(F.lit(1)).alias("n"))


def _sweep(df: DataFrame, pairs: Mapping[str, tuple[str, str]], grid: Mapping[str, Sequence[float]]) -> DataFrame:
    """``(name, threshold, tp, fp, fn, tn)`` of each label at each of its thresholds.

    Rows are counted by label and by the number of thresholds that lie below their score; the cells are running sums over
    that small table, so a fine grid costs no more passes or wider rows than a coarse one.
    """
    cuts = {k: sorted(set(map(float, grid[k]))) for k in pairs}
    rows = [
        F.struct(F.lit(k).alias("name"), F.col(y).cast("int").alias("y"), keys.cuts_below(F.col(s), cuts[k]).alias("below"))
        for k, (y, s) in pairs.items()
    ]
    counts = df.select(F.explode(F.array(*rows)).alias("r")).groupBy("r.name", "r.below").agg(
        F.count(F.when(F.col("r.y") == 1, 1)).alias("p"), F.count(F.when(F.col("r.y") == 0, 1)).alias("n")
    )
    asked = [
        F.struct(F.lit(k).alias("name"), F.lit(float(i)).alias("at"), F.lit(t).alias("threshold"), zero.alias("p"), zero.alias("n"))
        for k, ts in cuts.items()
        for i, t in enumerate(ts)
        for zero in (F.lit(0).cast("long"),)
    ]
    asked = df.sparkSession.range(1).select(F.explode(F.array(*asked)).alias("r")).select("r.*")
    # Rows above threshold i have more than i thresholds below them.
    placed = counts.select("name", (F.col("below") - 0.5).alias("at"), F.lit(None).cast("double").alias("threshold"), "p", "n")
    every = Window.partitionBy("name")
    above = every.orderBy(F.col("at").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = placed.unionByName(asked).select(
        "name",
        "threshold",
        F.sum("p").over(above).alias("tp"),
        F.sum("n").over(above).alias("fp"),
        F.sum("p").over(every).alias("_p"),
        F.sum("n").over(every).alias("_n"),
    )
    return sums.where("threshold IS NOT NULL").select(
        "name", "threshold", "tp", "fp", (F.col("_p") - F.col("tp")).alias("fn"), (F.col("_n") - F.col("fp")).alias("tn")
    )


def threshold_sweep(
    df: DataFrame, label: str, score: str, thresholds: Sequence[float] = lex.BINARY_THRESHOLDS
) -> DataFrame:
    """Scores at every threshold, all thresholds counted in one pass."""
    rows = _sweep(df, {"": (label, score)}, {"": thresholds})
    return with_scores(rows).select("threshold", *CELLS, *SCORES)


def best_threshold(sweep: DataFrame, score: str = "f1_class_1") -> DataFrame:
    """The threshold with the best score, the lowest among equals."""
    return sweep.orderBy(F.col(score).desc(), "threshold").limit(1)


def threshold_grid(ranges: Mapping[str, tuple[float, float]], step: float = 0.05) -> dict[str, list[float]]:
    """Thresholds from the low to the high end of each label's range."""
    return {
        k: [round(lo + i * step, 10) for i in range(int(round((hi - lo) / step)) + 1)] for k, (lo, hi) in ranges.items()
    }


def label_threshold_sweep(
    df: DataFrame, pairs: Mapping[str, tuple[str, str]], grid: Mapping[str, Sequence[float]]
) -> DataFrame:
    """Sweep each label over its own thresholds; one pass for all labels.

    ``pairs`` maps a label to its (actual, score) columns.
    """
    rows = _sweep(df, pairs, grid).withColumnRenamed("name", "label")
    return rows.withColumn("f1", f1_of(F.col("tp"), F.col("fp"), F.col("fn")))


def hierarchical_gate(
    df: DataFrame, score: str, threshold: float, subs: Mapping[str, float], out_suffix: str = "_pred"
) -> DataFrame:
    """Sub-label predictions that are 0 wherever the binary score stays at or below the threshold."""
    return df.withColumns(
        {
            f"{c}{out_suffix}": F.when((F.col(score) > threshold) & (F.col(c) > t), 1).otherwise(0)
            for c, t in subs.items()
        }
    )


def multilabel_metrics(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Per-label F1 beside macro-F1, Hamming loss and subset accuracy, in one pass."""
    wrong = F.lit(0)
    for a, b in pairs.values():
        wrong = wrong + (F.col(a) != F.col(b)).cast("int")
    aggs = [
        agg.alias(f"{k}_{name}")
        for k, (a, b) in pairs.items()
        for name, agg in cells(F.col(a), F.col(b)).items()
    ]
    row = df.agg(
        *aggs,
        F.avg(wrong / F.lit(len(pairs))).alias("hamming_loss"),
        F.avg((wrong == 0).cast("int")).alias("subset_accuracy"),
    )
    f1 = {k: f1_of(F.col(f"{k}_tp"), F.col(f"{k}_fp"), F.col(f"{k}_fn")) for k in pairs}
    macro = F.lit(0.0)
    for value in f1.values():
        macro = macro + value
    fields = {**{f"f1_{k}": value for k, value in f1.items()}, "macro_f1": macro / F.lit(len(pairs))}
    fields.update({c: F.col(c) for c in ("hamming_loss", "subset_accuracy")})
    return keys.unpivot_row(
        row, [F.struct(F.lit(k).alias("metric"), value.alias("value")) for k, value in fields.items()]
    )


def slice_metrics(df: DataFrame, slices: Sequence[str], label: str = "label", pred: str = "pred") -> DataFrame:
    """Scores inside every value of every slice column, in one pass."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(s).alias("dimension"), F.col(s).cast("string").alias("value")) for s in slices])
    )
    rows = df.select(F.col(label).alias("_l"), F.col(pred).alias("_p"), pairs.alias("_s"))
    counts = rows.groupBy("_s.dimension", "_s.value").agg(*cells(F.col("_l"), F.col("_p")).values())
    return with_scores(counts).select("dimension", "value", *CELLS, *SCORES)


def slice_lattice(
    df: DataFrame,
    dimensions: Sequence[str],
    label: str = "label",
    pred: str = "pred",
    min_support: int = 1,
    at_most: int | None = None,
) -> DataFrame:
    """Scores of every combination of the dimensions' values that has ``min_support`` rows, all rows included.

    ``level`` is the grouping id: the bit of a dimension, the last one's being 1, is set where the dimension is left out; its
    column is null then, while a null value has the bit unset. ``at_most`` limits the dimensions of one slice. Values are strings; rows
    whose label or prediction is null don't count; no rows give no slices. Rows are counted once at the finest level, and only
    those counts are summed up the lattice.
    """
    names = [f"_d{i}" for i in range(len(dimensions))]
    finest = df.groupBy(*[F.col(d).cast("string").alias(n) for d, n in zip(dimensions, names, strict=True)]).agg(
        *cells(F.col(label), F.col(pred)).values()
    )
    sizes = range((len(names) if at_most is None else min(at_most, len(names))) + 1)
    sets = [list(chosen) for k in sizes for chosen in combinations(names, k)]
    counts = finest.groupingSets(sets, *names).agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in CELLS])
    support = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    kept = counts.withColumn("n", support).where(F.col("n") >= max(min_support, 1))
    return with_scores(kept).select(
        "level", *[F.col(n).alias(d) for d, n in zip(dimensions, names, strict=True)], "n", *CELLS, *SCORES
    )


def cascade_rate(df: DataFrame, label: str, pred: str, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Share of sub-label errors that sit on rows the binary task missed."""
    errors = F.lit(0).cast("long")
    for a, b in pairs.values():
        errors = errors + (F.col(a) != F.col(b)).cast("long")
    missed = (F.col(label) == 1) & (F.col(pred) == 0)
    return df.agg(
        F.sum(errors).alias("sub_errors"), F.coalesce(F.sum(F.when(missed, errors)), F.lit(0)).alias("cascading_errors")
    ).withColumn("cascade_rate", _ratio(F.col("cascading_errors"), F.col("sub_errors")))


def iteration_advice(
    binary: DataFrame,
    cascade: DataFrame,
    limit: float = lex.CASCADE_LIMIT,
    rate_limit: float = 0.5,
    slices: DataFrame | None = None,
    sub_labels: DataFrame | None = None,
    drop: float = 0.1,
    near_zero: float = 0.05,
) -> DataFrame:
    """Next step from one row of binary scores and one row of cascade counts.

    With the scores of topic ``slices`` (column macro_f1), a topic that lies more than ``drop`` below all rows fires a rule;
    with ``sub_labels`` (column value, an F1), a label of at most ``near_zero`` does. The two rules of the plan that need
    error categories given by hand are the reader's.
    """
    rate = cascade.select("cascade_rate").scalar()
    row = binary.select(
        rate.alias("cascade_rate"),
        _ratio(F.col("fp"), F.col("fp") + F.col("tn")).alias("fp_rate"),
        _ratio(F.col("fn"), F.col("fn") + F.col("tp")).alias("fn_rate"),
        *([(F.col("macro_f1") - slices.agg(F.min("macro_f1").alias("m")).scalar()).alias("topic_drop")] if slices is not None else []),
        *([sub_labels.agg(F.min("value").alias("m")).scalar().alias("lowest_f1")] if sub_labels is not None else []),
    )
    rules = {
        "cascading": (F.col("cascade_rate") > limit, "improve binary recall before sub-labels"),
        "false_positives": (F.col("fp_rate") > rate_limit, "lower pos_weight or raise the threshold"),
        "false_negatives": (F.col("fn_rate") > rate_limit, "raise pos_weight or lower the threshold"),
    }
    if slices is not None:
        rules["topic_drop"] = (F.col("topic_drop") > drop, "sample stratified by topic")
    if sub_labels is not None:
        rules["sub_label_near_zero"] = (F.col("lowest_f1") <= near_zero, "use an asymmetric loss or train jointly with the binary task")
    return keys.unpivot_row(
        row,
        [
            F.struct(F.lit(k).alias("rule"), hit.alias("fires"), F.when(hit, F.lit(text)).otherwise(F.lit("none")).alias("action"))
            for k, (hit, text) in rules.items()
        ],
    )


def run_comparison(runs: DataFrame, variant: str, metric: str, control: str) -> DataFrame:
    """Mean, deviation and difference to the control per variant.

    ``runs`` has one row per variant and run.
    """
    stats = runs.groupBy(variant).agg(
        F.count(F.lit(1)).alias("runs"), F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std")
    )
    base = stats.filter(F.col(variant) == control).select("mean").scalar()
    return stats.withColumn("delta", F.col("mean") - base)


def severity(score: Column, medium: float, high: float) -> Column:
    """Low, Medium or High by the given cut-offs."""
    return F.when(score >= high, "High").when(score >= medium, "Medium").otherwise("Low")


def behaviour_accuracy(df: DataFrame, category: str, expected: str, predicted: str) -> DataFrame:
    """Cases, correct answers and accuracy per behavioural category."""
    right = (F.col(expected) == F.col(predicted)).cast("long")
    return df.groupBy(category).agg(
        F.count(F.lit(1)).alias("cases"), F.sum(right).alias("correct"), F.avg(right).alias("accuracy")
    )
