"""Grouping by text and joining on keys that one group may dominate.

Texts are grouped by a 256-bit digest: the shuffle moves 64 characters instead
of a whole text, and every aggregate over a group uses fixed-width buffers, so
a group of any size is reduced to one row per map task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tasks among which a lookup deals the rows of one key.
SALTS = 32

#: Ranges into which an ordered column is cut by its own quantiles.
RANGES = 256


NO_VALUE = "null"
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def digest(value: Column) -> Column:
    """Digest of a text; nulls share one key of their own.

    The key is never null, so no null check of it is pushed down to the scan,
    where it would compute the key a second time.
    """
    return F.coalesce(F.sha2(value, 256), F.lit(NO_VALUE))


def row_digest(df: DataFrame) -> Column:
    """Digest of a whole row: every column's exact value with its length, nulls marked."""
    parts = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(F.struct(value), {"ignoreNullFields": "false", "timestampFormat": _MICROS, "timestampNTZFormat": _MICROS})
        elif isinstance(f.dataType, T.BinaryType):
            value = F.base64(value)
        else:
            value = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(F.concat_ws(",", *parts))


def seeded_digest(row_id: Column, seed: int) -> Column:
    """Reproducible pseudo-random key of a row, equal on every engine."""
    return F.md5(F.concat(row_id.cast("string"), F.lit(f"#{seed}")))


def rows_at(df: DataFrame, positions: DataFrame, row_id: str) -> DataFrame:
    """Rows whose unique id is listed: a semi join on an evenly spread key."""
    return df.join(positions.select(row_id), row_id, "left_semi")


def lookup_by_key(
    rows: DataFrame,
    groups: DataFrame,
    key: str,
    row_id: str,
    values: Sequence[str],
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Attach ``values`` of each group to its rows, however large one group is.

    A group's rows are dealt by their id into ``salts`` pieces, and the group is sent to those pieces that exist: groups
    without rows aren't copied, and there are never more copies than rows. So one group's rows meet in ``salts`` pieces
    whatever its size, and ``groups`` may be far larger than what the rows need. Keep ``rows`` narrow.
    ``how`` is ``left`` or ``inner``; ``groups`` has one row per key.
    """
    dealt = rows.drop(*values).withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int"))
    pieces = dealt.where(F.col(f"`{key}`").isNotNull()).select(key, "_salt").distinct()
    # Groups have no known bound; a file's size, by which Spark would broadcast them, says little about their rows.
    copies = pieces.join(groups.select(key, *values).hint("merge"), key)
    return dealt.join(copies, [key, "_salt"], how).select(
        *[F.col(f"`{c}`") for c in rows.columns if c not in values], *values
    )


def range_of(df: DataFrame, column: str, ranges: int = RANGES) -> Column:
    """Number of the range a value falls in; the ranges hold about equal shares of the rows of ``df``.

    The cuts come from approximate quantiles, so they follow the data, and reach the driver (``ranges`` numbers).
    """
    shares = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(column, shares, 10 * ranges)).first()[0] or []
    return cuts_below(F.col(column), sorted(set(found)))


def cuts_below(value: Column, cuts: Sequence) -> Column:
    """Number of the ordered cuts that lie below a value, by binary search; 0 for null."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value > F.lit(cuts[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(cuts))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, null when there is nothing to share."""
    return F.try_divide(part * 100.0, whole)


def domain_of(df: DataFrame, column: str) -> list:
    """Distinct non-null values of a class column, in order.

    Pass the values yourself where they are known: this reads the column once.
    """
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def unpivot_row(row: DataFrame, fields: Sequence[Column]) -> DataFrame:
    """Turn one wide aggregate row into one row per struct in ``fields``."""
    return row.select(F.explode(F.array(*fields)).alias("_r")).select("_r.*")
