"""Is a run better than the control? Intervals by resampling the test rows.

Every replicate weighs each row by a Poisson number of mean 1, drawn from the digest of its id, so a replicate is the same
wherever and however often it is computed, and the rows are never copied or shuffled: all replicates are sums in one aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.operators import metrics

#: One digest gives this many draws of 16 bits.
DRAWS = 8
#: A draw that reaches the k-th cut is at least k + 1.
POISSON_CUTS = [
    round(65536 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(8)
]


def _weight(digest: Column, draw: int) -> Column:
    number = F.substring(digest, 4 * draw + 1, 4)  # four hex digits stand in the order of their numbers
    weight = F.when(number < f"{POISSON_CUTS[0]:04x}", 0)
    for k, cut in enumerate(POISSON_CUTS[1:], 1):
        weight = weight.when(number < f"{cut:04x}", k)
    return weight.otherwise(len(POISSON_CUTS))


def _weighted_cells(label: Column, pred: Column, weight: Column, prefix: str = "") -> list[Column]:
    pairs = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    return [
        F.sum(F.when((label == a) & (pred == b), weight).otherwise(0)).alias(prefix + name)
        for name, (a, b) in pairs.items()
    ]


def difference_intervals(
    df: DataFrame,
    row_id: str,
    label: str,
    control: str,
    variants: Sequence[str],
    metric: str = "macro_f1",
    replicates: int = 200,
    confidence: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """One row per variant: both scores, their difference, its interval and a two-sided p value.

    ``df`` has one row per test row with the label and a column of predictions for every run, all 0 or 1. A row whose label
    or prediction is null doesn't count for that run. Rows that share an id (null is an id too) are drawn together, as repeated texts should be.
    ``metric`` is one of ``metrics.SCORES``. A variant is ``significant`` if 0 lies outside its interval. No rows give no result.

    The large aggregate has at most 3 ** (runs + 1) groups for each eight replicates, combined in every map task; what
    follows works on those counts. The replicates' differences of one variant are a list of ``replicates`` numbers.
    """
    if metric not in metrics.SCORES:
        raise ValueError(f"unknown metric {metric!r}")
    if not variants or replicates < 2 or not 0 < confidence < 1:
        raise ValueError("variants, two replicates or more and a confidence between 0 and 1 are needed")
    runs = [f"v{i}" for i in range(len(variants))]
    rows = df.select(
        F.coalesce(F.col(row_id).cast("string"), F.lit("")).alias("id"),
        F.col(label).alias("y"),
        F.col(control).alias("c"),
        *[F.col(v).alias(r) for v, r in zip(variants, runs, strict=True)],
        F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // DRAWS))).alias("block"),
    ).withColumn("digest", F.md5(F.concat_ws("#", "id", F.lit(str(seed)), F.col("block").cast("string"))))
    counts = rows.groupBy("y", "c", *runs, "block").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(_weight(F.col("digest"), j)).alias(f"w{j}") for j in range(DRAWS)]
    )
    draws = [F.struct((F.col("block") * DRAWS + j + 1).alias("replicate"), F.col(f"w{j}").alias("weight")) for j in range(DRAWS)]
    # Replicate 0 is the table itself.
    draws.append(F.struct(F.when(F.col("block") == 0, 0).alias("replicate"), F.col("n").alias("weight")))
    long = (
        counts.withColumn("draw", F.explode(F.array(*draws)))
        .where(F.col("draw.replicate") <= replicates)
        .withColumn("run", F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), F.col(r).alias("pred")) for v, r in zip(variants, runs, strict=True)])))
    )
    weight = F.col("draw.weight")
    cells = long.groupBy(F.col("run.variant").alias("variant"), F.col("draw.replicate").alias("replicate")).agg(
        *_weighted_cells(F.col("y"), F.col("run.pred"), weight), *_weighted_cells(F.col("y"), F.col("c"), weight, "control_")
    )
    scored = metrics.with_scores(cells).select(
        "variant", "replicate", F.col(metric).alias("variant_score"), *[F.col(f"control_{c}").alias(c) for c in metrics.CELLS]
    )
    scored = metrics.with_scores(scored).select("variant", "replicate", "variant_score", F.col(metric).alias("control_score"))
    delta = F.col("variant_score") - F.col("control_score")

    def whole(value: Column) -> Column:
        return F.max(F.when(F.col("replicate") == 0, value))

    drawn = F.col("replicate") > 0
    out = scored.groupBy("variant").agg(
        whole(F.col("variant_score")).alias("score"),
        whole(F.col("control_score")).alias("control_score"),
        whole(delta).alias("delta"),
        F.array_sort(F.collect_list(F.when(drawn, delta))).alias("_deltas"),
        F.count(F.when(drawn & (delta <= 0), 1)).alias("_below"),
        F.count(F.when(drawn & (delta >= 0), 1)).alias("_above"),
    )
    edge = max(1, math.floor((1 - confidence) / 2 * replicates + 1e-9))
    out = out.withColumns(
        {
            "low": F.element_at("_deltas", edge),
            "high": F.element_at("_deltas", replicates + 1 - edge),
            "p_value": F.least(F.lit(1.0), 2 * (F.least("_below", "_above") + 1) / F.lit(replicates + 1)),
        }
    )
    return out.withColumn("significant", (F.col("low") > 0) | (F.col("high") < 0)).drop("_deltas", "_below", "_above")
