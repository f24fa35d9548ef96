"""Shape, schema, missing values and column roles of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.operators import keys, ranks
from annospark.sources.tables import materialised

TEXT_MIN_LENGTH = 20
TIME_MIN_RATE = 0.5
TIME_NAMES = ("date", "time", "timestamp", "created_at", "datetime")


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, rows and non-null rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(_c(f.name)).alias(f"n{i}") for i, f in enumerate(df.schema.fields)],
    )
    return keys.unpivot_row(
        counts,
        [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.col("rows"),
                F.col(f"n{i}").alias("non_null"),
            )
            for i, f in enumerate(df.schema.fields)
        ],
    )


def head(df: DataFrame, row_id: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.col(row_id)).limit(n)


def tail(df: DataFrame, row_id: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.col(row_id).desc()).limit(n)


def missing_table(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Missing values and their share per column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.when(_c(c).isNull(), 1)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    out = keys.unpivot_row(
        counts,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"n{i}").alias("missing"),
                keys.percent(F.col(f"n{i}"), F.col("rows")).alias("pct"),
            )
            for i, c in enumerate(df.columns)
        ],
    )
    return out.filter("missing > 0") if only_missing else out


def describe_numeric(
    df: DataFrame,
    columns: Sequence[str],
    quantiles: Sequence[float] = (0.25, 0.5, 0.75),
    approx: bool = False,
) -> DataFrame:
    """Count, mean, deviation, extremes and quantiles per column.

    Exact quantiles count the values in one more pass; ``approx`` needs none.
    """
    marks = F.array(*[F.lit(float(q)) for q in quantiles])
    exact: Column | None = None
    if not approx:
        df = materialised(df.select(*[_c(c) for c in columns]), "numbers")
        found = ranks.exact_quantiles(df, {str(i): _c(c) for i, c in enumerate(columns)}, quantiles)
        exact = found.agg(F.map_from_entries(F.collect_list(F.struct("measure", "q")))).scalar()

    aggregates = [
        a
        for i, c in enumerate(columns)
        for a in (
            F.count(_c(c)).alias(f"count{i}"),
            F.avg(_c(c)).alias(f"mean{i}"),
            F.stddev_samp(_c(c)).alias(f"std{i}"),
            F.min(_c(c)).cast("double").alias(f"min{i}"),
            *([F.percentile_approx(_c(c), marks).alias(f"q{i}")] if approx else []),
            F.max(_c(c)).cast("double").alias(f"max{i}"),
        )
    ]
    row = df.agg(*aggregates)
    if exact is not None:
        row = row.withColumn("_q", exact).withColumns({f"q{i}": F.try_element_at("_q", F.lit(str(i))) for i in range(len(columns))})
    return keys.unpivot_row(
        row,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"count{i}").alias("count"),
                F.col(f"mean{i}").alias("mean"),
                F.col(f"std{i}").alias("std"),
                F.col(f"min{i}").alias("min"),
                *[
                    F.get(F.col(f"q{i}"), k).cast("double").alias(f"p{q * 100:g}".replace(".", "_"))
                    for k, q in enumerate(quantiles)
                ],
                F.col(f"max{i}").alias("max"),
            )
            for i, c in enumerate(columns)
        ],
    )


def describe_columns(df: DataFrame, columns: Sequence[str], row_id: str) -> DataFrame:
    """Non-null count, distinct values, and the most frequent value per column.

    Values are counted by digest; only the winners' texts are fetched, one row
    per column. Among equally frequent values the first seen wins.
    """
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), keys.digest(_c(c).cast("string")).alias("value"))
                for c in columns
            ]
        )
    )
    counted = (
        df.select(F.col(row_id).alias("_id"), cells.alias("_x"))
        .filter(F.col("_x.value") != keys.NO_VALUE)
        .groupBy("_x.column", "_x.value")
        .agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first_id"))
    )
    rank = Window.partitionBy("column").orderBy(F.col("n").desc(), "first_id")
    winners = (
        counted.withColumn("_r", F.row_number().over(rank))
        .filter("_r = 1")
        .select("column", F.col("n").alias("freq"), "first_id")
    )
    totals = counted.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"))
    # One winner per listed column: a broadcast of len(columns) rows.
    picked = df.join(F.broadcast(winners.limit(len(columns))), F.col(row_id) == F.col("first_id"))
    value = F.lit(None).cast("string")
    for c in columns:
        value = F.when(F.col("column") == c, _c(c).cast("string")).otherwise(value)
    tops = picked.select("column", "freq", value.alias("top"))
    return totals.join(tops, "column").select("column", "count", "unique", "top", "freq")


def column_roles(df: DataFrame, text: str = "text", suffix: str = "_label", main: str = "toxicity_label") -> DataFrame:
    """Text column, label columns and main label as found in the schema.

    The text column is ``text`` when present, else the first string column
    whose mean length exceeds 20 characters.
    """
    labels = [c for c in df.columns if c.endswith(suffix)]
    chosen = main if main in df.columns else (labels[0] if labels else None)
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    means = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(F.length(_c(c))).alias(f"m{i}") for i, c in enumerate(strings)],
    )
    if text in df.columns:
        found = F.lit(text)
    else:
        found = F.lit(None).cast("string")
        for i in reversed(range(len(strings))):
            found = F.when(F.col(f"m{i}") > TEXT_MIN_LENGTH, F.lit(strings[i])).otherwise(found)
    return means.select(
        found.alias("text_column"),
        F.lit(",".join(labels)).alias("label_columns"),
        F.lit(chosen).cast("string").alias("main_label"),
    )


def time_columns(df: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """Columns named like a time, with the share of values that parse as one: in ISO spelling or one of ``formats``."""

    def parsed(value: Column) -> Column:
        return F.coalesce(F.try_to_timestamp(value), *[F.try_to_timestamp(value, F.lit(f)) for f in formats])

    names = [c for c in df.columns if any(k in c.lower() for k in TIME_NAMES)]
    rates = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.avg(parsed(_c(c).cast("string")).isNotNull().cast("int")).alias(f"r{i}")
            for i, c in enumerate(names)
        ],
    )
    if not names:
        return rates.select(F.lit("").alias("column"), F.lit(0.0).alias("parse_rate"), F.lit(False).alias("is_time")).limit(0)
    return keys.unpivot_row(
        rates,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"r{i}").alias("parse_rate"),
                (F.coalesce(F.col(f"r{i}"), F.lit(0.0)) >= TIME_MIN_RATE).alias("is_time"),
            )
            for i, c in enumerate(names)
        ],
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and excess copies of whole rows."""
    groups = df.select(keys.row_digest(df).alias("_key")).groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
