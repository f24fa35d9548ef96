"""Reproducible samples, splits, folds and resampling.

Random order is the md5 of ``id#seed``: the same rows on any cluster size.
Classes have few values but any number of rows, so no step ranks a class in
one task. The first characters of the digest place a row in one of 65,536 even
buckets per class. Counts per bucket form a small table; only rows that share
a bucket are ever ordered together.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from fractions import Fraction
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.operators import keys

BUCKET_DIGITS = 4
COPIES_PER_ROW = 1000
NOT_ELIGIBLE = -1


def class_rank(df: DataFrame, classes: Sequence[str], row_id: str, seed: int, out: str = "rank") -> DataFrame:
    """1-based rank of each row inside its class, in seeded random order.

    Equals ``row_number()`` over the class ordered by the seeded digest.
    """
    digest = keys.seeded_digest(F.col(row_id), seed)
    marked = df.withColumn("_d", digest).withColumn("_b", F.substring("_d", 1, BUCKET_DIGITS))
    return _two_level_rank(marked, classes, ["_d", row_id], out).drop("_d")


def _two_level_rank(df: DataFrame, groups: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Rank inside a group of any size, given an ordered bucket column ``_b``.

    Rows are ranked inside their bucket; the rows of earlier buckets are added
    from a table of bucket counts. Both sides meet on the group columns and the
    bucket, nulls included, by which the ranked rows are already partitioned.
    """
    inside = Window.partitionBy(*groups, "_b").orderBy(*order)
    ranked = df.withColumn("_in", F.row_number().over(inside))
    sizes = df.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_b").alias("_gb"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    same = F.col("_b").eqNullSafe(F.col("_gb"))
    for i, g in enumerate(groups):
        same = same & F.col(f"`{g}`").eqNullSafe(F.col(f"_g{i}"))
    rank = (F.col("_in") + F.col("_before")).alias(out)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("_b", out)]
    return ranked.join(offsets, same).select(*kept, rank)


def stratified_folds(df: DataFrame, label: str, row_id: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold``; inside a class the folds differ by at most one row."""
    ranked = class_rank(df, [label], row_id, seed, "_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def _class_index(column: Column, classes: Sequence) -> Column:
    """Position of a class among the declared ones; an undeclared class fails."""
    positions = F.create_map(*[F.lit(x) for i, value in enumerate(classes) for x in (value, i)])
    unknown = F.raise_error(F.lit(f"class not declared: expected one of {list(classes)}")).cast("int")
    return F.coalesce(F.try_element_at(positions, column), unknown)


def _quotas(sizes: Mapping[int, int], rows: int, parts: Sequence[tuple[str, float]]) -> list[dict[int, int]]:
    """Rows of each part per class: floor of its share, the rest by largest remainder."""
    pool = sum(sizes.values())
    taken, out = 0, []
    for _, fraction in parts:
        target = min(math.ceil(rows * Fraction(str(fraction))), pool - taken)
        taken += target
        shares = {c: divmod(target * n, pool) for c, n in sizes.items()}
        left = target - sum(whole for whole, _ in shares.values())
        by_rest = sorted(shares, key=lambda c: (-shares[c][1], c))
        out.append({c: shares[c][0] + (c in by_rest[:left]) for c in shares})
    return out


def _cut_digests(
    pool: DataFrame, histogram: DataFrame, ends: Mapping[tuple[int, int], int], row_id: str
) -> dict[tuple[int, int], str]:
    """Digest of the last row of each part per class.

    ``ends`` maps (class, part) to the rank of that row. The bucket holding
    the rank comes from the histogram; only rows of these buckets are ranked.
    """
    upto = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    marks = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(i).alias("i"), F.lit(e).cast("long").alias("e")) for (c, i), e in ends.items()])
    buckets = (
        histogram.withColumn("_upto", F.sum("_n").over(upto))
        .select("_c", "_b", "_n", "_upto", F.explode(F.filter(marks, lambda m: m["c"] == F.col("_c"))).alias("m"))
        .filter("m.e <= _upto and m.e > _upto - _n")
        .select("_c", "_b", "m.i", (F.col("m.e") - F.col("_upto") + F.col("_n")).alias("place"))
        .collect()
    )
    key = F.concat_ws("/", "_c", "_b")
    inside = Window.partitionBy("_key").orderBy("_d", row_id)
    found = (
        pool.select(key.alias("_key"), "_d", row_id)
        .filter(F.col("_key").isin([f"{r['_c']}/{r['_b']}" for r in buckets]))
        .withColumn("_at", F.concat_ws("/", "_key", F.row_number().over(inside)))
        .filter(F.col("_at").isin([f"{r['_c']}/{r['_b']}/{r['place']}" for r in buckets]))
    )
    digests = {r["_at"]: r["_d"] for r in found.select("_at", "_d").collect()}
    return {(r["_c"], r["i"]): digests[f"{r['_c']}/{r['_b']}/{r['place']}"] for r in buckets}


def stratified_split(
    df: DataFrame,
    label: str,
    row_id: str,
    parts: Sequence[tuple[str, float]] = (("test", 0.2),),
    rest: str = "train",
    seed: int = 42,
    classes: Sequence | None = None,
    eligible: Column | None = None,
    prefer: Column | None = None,
    out: str = "split",
    quotas_of: Callable | None = None,
) -> DataFrame:
    """Assign every row to a part with exact sizes and exact class shares.

    Each part takes ``ceil(fraction * rows)`` rows, spread over the classes by
    largest remainder. Rows that are not ``eligible`` stay in ``rest``;
    ``prefer``red rows are drawn first. A row with an undeclared class fails.
    ``quotas_of(sizes, rows, parts)`` shares the parts out in another way, by the position of a class.

    The data is not shuffled: two narrow jobs over (class, id) find one
    cut-off digest per class and part, the only values the driver sees, and
    the result is a plain projection comparing each row's digest with them.
    """
    values = list(classes) if classes is not None else keys.domain_of(df, label)
    allowed = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    first = F.lit("") if prefer is None else F.when(prefer, "0").otherwise("1")
    marked = df.withColumns(
        {
            "_d": F.concat(first, keys.seeded_digest(F.col(row_id), seed)),
            "_c": F.when(allowed, _class_index(F.col(label), values)).otherwise(NOT_ELIGIBLE),
        }
    )
    pool = marked.select(row_id, "_d", "_c", F.substring("_d", 1, BUCKET_DIGITS + (prefer is not None)).alias("_b"))
    histogram = pool.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("_n")).persist()
    try:
        counted = {r["_c"]: r["n"] for r in histogram.groupBy("_c").agg(F.sum("_n").alias("n")).collect()}
        sizes = {c: n for c, n in counted.items() if c != NOT_ELIGIBLE}
        quotas = (quotas_of or _quotas)(sizes, sum(counted.values()), parts) if sizes else []
        ends, upto = {}, dict.fromkeys(sizes, 0)
        for i, quota in enumerate(quotas):
            for c, n in quota.items():
                upto[c] += n
                ends[(c, i)] = min(upto[c], sizes[c])
        cuts = _cut_digests(pool, histogram, {k: e for k, e in ends.items() if e > 0}, row_id) if ends else {}
    finally:
        histogram.unpersist()
    part = F.lit(rest)
    for i in reversed(range(len(parts))):
        limits = [x for (c, k), cut in cuts.items() if k == i for x in (F.lit(c), F.lit(cut))]
        if limits:
            inside = F.coalesce(F.col("_d") <= F.try_element_at(F.create_map(*limits), F.col("_c")), F.lit(False))
            part = F.when(inside, parts[i][0]).otherwise(part)
    return marked.withColumn(out, part).drop("_d", "_c")


def rare_stratum(main: str, rare_first: Sequence[str], other: str = "toxic") -> Column:
    """Stratum of a row: its rarest positive label, else its main label."""
    name = F.when(F.col(main) == 1, other).otherwise("negative")
    for c in reversed(rare_first):
        name = F.when(F.col(c) == 1, c).otherwise(name)
    return name


def three_way_split(
    df: DataFrame,
    row_id: str,
    main: str,
    rare_first: Sequence[str],
    count: str = "num_annotators",
    val: float = 0.1,
    test: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Train, validation and test over rare labels; ties stay in training.

    Validation and test draw texts with two or more annotators first.
    """
    labels = [main, *rare_first]
    clean = F.lit(True)
    for c in labels:
        clean = clean & F.col(c).isin(0.0, 1.0)
    stratified = df.withColumn("stratum", rare_stratum(main, rare_first))
    return stratified_split(
        stratified,
        "stratum",
        row_id,
        (("test", test), ("val", val)),
        seed=seed,
        classes=[*rare_first, "toxic", "negative"],
        eligible=clean,
        prefer=F.col(count) >= 2,
    )


def seeded_sample(df: DataFrame, n: int, row_id: str, seed: int = 42) -> DataFrame:
    """``n`` rows in seeded random order, or all rows if there are fewer."""
    return df.orderBy(keys.seeded_digest(F.col(row_id), seed), row_id).limit(n)


def before_after(df: DataFrame, text: str, cleaned: Column, n: int, row_id: str, seed: int = 42) -> DataFrame:
    """A seeded sample of texts beside their cleaned form."""
    sample = seeded_sample(df.select(row_id, text), n, row_id, seed)
    return sample.select(row_id, F.col(text).alias("before"), cleaned.alias("after"))


def resample_ratio(
    df: DataFrame, label: str, row_id: str, ratio: int = 3, seed: int = 42
) -> DataFrame:
    """All negatives, and positives brought to one per ``ratio`` negatives.

    Too many positives are thinned without replacement; too few are drawn with
    replacement, ``copy`` numbering a row's draws. The two class sizes decide
    which, so they are counted first (two numbers reach the driver).
    """
    sizes = df.agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("n0"), F.count(F.when(F.col(label) == 1, 1)).alias("n1")
    ).first()
    target, n1 = sizes["n0"] // ratio, sizes["n1"]
    negatives = df.filter(F.col(label) == 0).withColumn("copy", F.lit(1))
    ranked = class_rank(df.filter(F.col(label) == 1), [label], row_id, seed, "_rank")
    if n1 > target or n1 == 0:
        drawn = ranked.filter(F.col("_rank") <= target).withColumn("copy", F.lit(1)).drop("_rank")
        return negatives.unionByName(drawn)
    draw = F.md5(F.concat(F.col("id").cast("string"), F.lit(f"#{seed}")))
    source = F.conv(F.substring(draw, 1, 12), 16, 10).cast("long") % n1 + 1
    # Draws of one row are counted, then unfolded in bounded pieces.
    draws = (
        df.sparkSession.range(target)
        .select(source.alias("_rank"), F.floor(F.col("id") / COPIES_PER_ROW).alias("_piece"))
        .groupBy("_rank", "_piece")
        .agg(F.count(F.lit(1)).cast("int").alias("_n"))
    )
    before = Window.partitionBy("_rank").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    numbered = draws.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("int"))
    # Each piece is unfolded where it is dealt to, not where its positive lies.
    drawn = ranked.join(numbered, "_rank").repartition("_rank", "_piece").select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.explode(F.sequence(F.col("_before") + 1, F.col("_before") + F.col("_n"))).alias("copy"),
    )
    return negatives.unionByName(drawn)


def union_all(*parts: DataFrame) -> DataFrame:
    """Concatenate row sets by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_row_number(
    df: DataFrame, group: Sequence[str], position: str, out: str = "row_in_group", ranges: int = keys.RANGES
) -> DataFrame:
    """Number the rows of each group from 0 by a unique integer position.

    A group may hold any share of the table and its positions may lie anywhere: rows are ordered within ``ranges`` ranges
    of about equal shares of all rows.
    """
    bucketed = df.withColumn("_b", keys.range_of(df, position, ranges))
    ranked = _two_level_rank(bucketed, group, [position], "_rank")
    return ranked.withColumn(out, (F.col("_rank") - 1).cast("long")).drop("_rank")


def error_samples(
    df: DataFrame, label: str, pred: str, row_id: str, n: int = 20, seed: int = 42
) -> DataFrame:
    """Up to ``n`` false positives and ``n`` false negatives in seeded order."""
    error = F.when((F.col(label) == 0) & (F.col(pred) == 1), "FP").when(
        (F.col(label) == 1) & (F.col(pred) == 0), "FN"
    )
    wrong = df.withColumn("error", error).filter("error is not null")
    w = Window.partitionBy("error").orderBy(keys.seeded_digest(F.col(row_id), seed), row_id)
    return wrong.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def _label_quotas(labels: int, sizes: Mapping[int, int], rows: int, parts: Sequence[tuple[str, float]]) -> list[dict[int, int]]:
    """Rows of each part per label combination (bit i of the class is label i), label by label from the rarest.

    Every combination gives its share rounded down. What a label, and the part as a whole, still lacks is taken from the
    combinations with the largest remainders, and steps that bring the sums nearer to their quotas follow until none does.
    """
    left, out = dict(sizes), []
    # The part as a whole counts as a label that every row has.
    holders = [[c for c in sizes if c >> i & 1] for i in range(labels)] + [list(sizes)]
    of = {c: [i for i in range(labels + 1) if c in holders[i]] for c in sizes}
    totals = [sum(sizes[c] for c in held) for held in holders]
    for _, fraction in parts:
        share = Fraction(str(fraction))
        want = [total * share for total in totals]
        want[-1] = Fraction(min(math.ceil(rows * share), sum(left.values())))
        given = {c: min(left[c], math.floor(n * share)) for c, n in sizes.items()}
        sums = [Fraction(sum(given[c] for c in held)) for held in holders]

        def change(moves: Sequence[tuple[int, int]], sums=sums, want=want) -> Fraction:
            """How much farther from the quotas, squared, the sums would be."""
            by = Counter()
            for c, step in moves:
                for i in of[c]:
                    by[i] += step
            return sum((2 * (sums[i] - want[i]) * d + d * d for i, d in by.items()), Fraction(0))

        def apply(moves: Sequence[tuple[int, int]], sums=sums, given=given) -> None:
            for c, step in moves:
                given[c] += step
                for i in of[c]:
                    sums[i] += step

        for i in sorted(range(labels + 1), key=lambda i: (totals[i], i)):
            for c in sorted(holders[i], key=lambda c: (given[c] - sizes[c] * share, c)):
                if sums[i] + 1 <= want[i] and given[c] < left[c]:
                    apply([(c, 1)])
        while True:
            single = [(c, d) for c in sizes for d in (1, -1) if 0 <= given[c] + d <= left[c]]
            pairs = [(a, b) for a in single for b in single if a[0] < b[0]]
            best = min(([m] for m in single), key=change, default=None)
            if best is None or change(best) >= 0:
                best = min(pairs, key=change, default=None)
            if best is None or change(best) >= 0:
                break
            apply(best)
        for c, n in given.items():
            left[c] -= n
        out.append(given)
    return out


def label_split(
    df: DataFrame,
    labels: Sequence[str],
    row_id: str,
    parts: Sequence[tuple[str, float]] = (("test", 0.1), ("val", 0.1)),
    rest: str = "train",
    seed: int = 42,
    eligible: Column | None = None,
    prefer: Column | None = None,
    out: str = "split",
) -> DataFrame:
    """Split so that every label has its share in every part, also where a text has several rare labels.

    Rows are counted by their combination of labels (1 or not; up to 9 labels), quotas are set on these counts from the
    rarest label on, and rows follow by digest cut-offs as in :func:`stratified_split`. Rows that are not ``eligible`` stay
    in ``rest`` and count in no label's quota.
    """
    if len(labels) > 9:
        raise ValueError("at most 9 labels")
    bits = sum((F.coalesce((F.col(f"`{c}`") == 1).cast("int"), F.lit(0)) * (1 << i) for i, c in enumerate(labels)), F.lit(0))
    combined = df.withColumn("_combination", bits)
    classes = range(1 << len(labels))
    found = stratified_split(
        combined, "_combination", row_id, parts, rest, seed, classes, eligible, prefer, out, partial(_label_quotas, len(labels))
    )
    return found.drop("_combination")
