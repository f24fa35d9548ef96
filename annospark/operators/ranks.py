"""Exact quantiles and long top lists without a task that sees all values.

Values are counted first, so rows shrink to distinct values. While a group has more of them than one task should order, its
values are cut into ranges by approximate quantiles, ranges are counted, and only those that hold a wanted rank are kept; each
such pass leaves about a 256th. The rest is ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.sources.tables import materialised

#: Distinct values that one task orders.
AT_ONCE = 1 << 16
#: Ranges of a pass.
RANGES = 256


def _refined(values: DataFrame, wanted: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Values of the ranges that hold a wanted rank, a group for each of them, and the ranks within them."""
    shares = [i / RANGES for i in range(1, RANGES)]
    cuts = values.groupBy(*keys).agg(F.percentile_approx("v", shares, 10 * RANGES).alias("cuts"))
    below = F.size(F.filter("cuts", lambda c: c < F.col("v")))
    ranged = materialised(values.join(cuts, keys).select(*keys, below.alias("range"), "v", "n"), "ranges")
    sizes = ranged.groupBy(*keys, "range").agg(F.sum("n").alias("size"))
    upto = F.sum("size").over(Window.partitionBy(*keys).orderBy("range"))
    sizes = sizes.select(*keys, "range", (upto - F.col("size")).alias("from"), upto.alias("to"))
    hit = wanted.join(sizes, keys).where((F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("to")))
    # The range becomes a part of the group's name.
    name = F.concat_ws("/", "part", F.col("range").cast("string"))
    hit = hit.withColumn("rank", F.col("rank") - F.col("from")).withColumn("part", name).select(*wanted.columns)
    hit = materialised(hit, "ranks")
    ranged = ranged.withColumn("part", name).select(*values.columns)
    return ranged.join(hit.select(*keys).distinct(), keys, "left_semi"), hit


def order_statistics(values: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """``wanted`` (by…, rank from 0) with ``v``: the value of that rank among ``values`` (by…, v, n), a written table of counts.

    Groups are not null.
    """
    keys = [*by, "part"]
    columns = wanted.columns
    values = values.select(*by, F.lit("").alias("part"), "v", "n")
    wanted = wanted.withColumn("rank0", F.col("rank")).withColumn("part", F.lit(""))
    while (values.groupBy(*keys).agg(F.count(F.lit(1)).alias("d")).agg(F.max("d")).first()[0] or 0) > AT_ONCE:
        values, wanted = _refined(values, wanted, keys)
        values = materialised(values, "values")
    order = Window.partitionBy(*keys).orderBy("v")
    upto = F.sum("n").over(order)
    placed = values.select(*keys, "v", (upto - F.col("n")).alias("from"), upto.alias("to"))
    found = wanted.join(placed, keys).where((F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("to")))
    return found.withColumn("rank", F.col("rank0")).select(*columns, "v")


def exact_quantiles(df: DataFrame, values: Mapping[str, Column], shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``(by…, measure, q)``: the quantiles of each measure in the order of ``shares``, linear between neighbours; nulls are left out.

    The values are counted while the plan is built; rows with a null in ``by`` are left out.
    """
    keys = [*by, "measure"]
    stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), c.cast("double").alias("v")) for m, c in values.items()]))
    rows = df.select(*[F.col(f"`{b}`") for b in by], stacked.alias("_m")).select(*by, "_m.measure", "_m.v").where("v IS NOT NULL")
    for b in by:
        rows = rows.where(F.col(f"`{b}`").isNotNull())
    counts = materialised(rows.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n")), "counts")
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("total"))
    place = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(s)).alias("share")) for i, s in enumerate(shares)]))
    places = totals.select(*keys, "total", place.alias("p")).select(*keys, "p.i", (F.col("p.share") * (F.col("total") - 1)).alias("at"))
    ends = F.explode(F.array(F.struct(F.floor("at").alias("rank"), F.lit(0).alias("end")), F.struct(F.ceil("at").alias("rank"), F.lit(1).alias("end"))))
    wanted = places.select(*keys, "i", "at", ends.alias("e")).select(*keys, "i", "at", "e.rank", "e.end")
    found = order_statistics(counts, wanted, keys)
    low, high = (F.max(F.when(F.col("end") == k, F.col("v"))).alias(f"v{k}") for k in (0, 1))
    found = found.groupBy(*keys, "i", "at").agg(low, high)
    between = (F.ceil("at") - F.col("at")) * F.col("v0") + (F.col("at") - F.floor("at")) * F.col("v1")
    found = found.select(*keys, "i", F.when(F.col("v0") < F.col("v1"), between).otherwise(F.col("v0")).alias("v"))
    return found.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("q"))


def first_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in an order, for a k of any size: ranges of rows are sorted and counted, and the places follow.

    Equal rows of the order are taken in any order; the ranges are written while the plan is built.
    """
    ranged = materialised(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_part", before.alias("_before")).where(F.col("_before") < k)
    placed = ranged.join(F.broadcast(sizes), "_part").withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return placed.where(F.col("_before") + F.col("_at") <= k).select(*[F.col(f"`{c}`") for c in df.columns])
