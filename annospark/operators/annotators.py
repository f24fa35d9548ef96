"""Annotator dimension, annotation rows and demographic views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annospark.functions import lexicons as lex
from annospark.functions import patterns as p
from annospark.functions import votes as v
from annospark.functions.cleaning import literal_map
from annospark.operators import keys


def clean_dimension(
    df: DataFrame,
    job: str = "status pekerjaan",
    vote_leaning: str = "president vote leaning",
) -> DataFrame:
    """Trim gender, band ages into generations, name candidates, make ids text."""
    age = F.col("age").cast("int")
    generation = F.lit(None).cast("string")
    for low, high, name in lex.GENERATIONS:
        generation = F.when(age.between(low, high), name).otherwise(generation)
    leaning = F.col(f"`{vote_leaning}`").cast("string")
    return df.withColumns(
        {
            "annotator_id": F.col("annotator_id").cast("string"),
            "gender": p.strip(F.col("gender")),
            "age_group": generation,
            job: F.when(F.col(f"`{job}`") == lex.HOUSEWIFE, lex.NOT_WORKING).otherwise(F.col(f"`{job}`")),
            vote_leaning: F.coalesce(
                F.try_element_at(literal_map(lex.CANDIDATES), leaning), F.lit(lex.NO_CANDIDATE)
            ),
        }
    )


def explode_annotations(
    df: DataFrame,
    annotators: DataFrame,
    labels: Sequence[str] = lex.LABELS,
    ids: str = "annotators_id",
    small: bool = False,
    row_id: str | None = None,
) -> DataFrame:
    """One row per (text, known annotator) with that annotator's own votes.

    A vote belongs to the annotator at the same position, fixed before the join, so an annotator missing from the dimension
    shifts nobody's vote. The annotators are sent to pieces of the annotations, so a busy one isn't one task's work; a
    caller who knows the dimension to be ``small`` has it broadcast. Rows and columns are the same either way. Rows are dealt
    out by ``row_id``, or by all their values if none is named.
    """
    voted = with_positions(df, labels, ids)
    clash = [c for c in annotators.columns if c in voted.columns and c != "annotator_id"]
    dimension = annotators.drop(*clash)
    values = [c for c in dimension.columns if c != "annotator_id"]
    if small:
        joined = voted.join(F.broadcast(dimension), "annotator_id", "inner")
        return joined.select(*[F.col(f"`{c}`") for c in voted.columns], *[F.col(f"`{c}`") for c in values])
    own = [row_id] if row_id else [f.name for f in voted.schema.fields if "map<" not in f.dataType.simpleString()]
    dealt = voted.withColumn("_row", F.xxhash64("text_id_index", *[F.col(f"`{c}`") for c in own]))
    return keys.lookup_by_key(dealt, dimension, "annotator_id", "_row", values, "inner").drop("_row")


def with_positions(df: DataFrame, labels: Sequence[str], ids: str = "annotators_id") -> DataFrame:
    """Explode the annotator list and take the vote at the annotator's position."""
    parsed = df.withColumns(
        {"_ids": v.parse_ids(F.col(ids)), **{c: v.parse_votes(F.col(c)) for c in labels}}
    )
    rows = parsed.select(
        *[F.col(f"`{c}`") for c in parsed.columns if c not in ("_ids", ids)],
        F.posexplode("_ids").alias("text_id_index", "annotator_id"),
    )
    return rows.withColumns({c: F.get(F.col(c), F.col("text_id_index")) for c in labels})


def annotation_index(df: DataFrame, text_id: str = "text_id", position: str = "text_id_index") -> DataFrame:
    """Number the surviving annotations of each text from 0, in list order.

    A text's group is as large as its list of annotators and no larger.
    """
    w = Window.partitionBy(text_id).orderBy(position)
    return df.withColumn("row_in_text", F.row_number().over(w) - 1)


def label_rate_by_attribute(df: DataFrame, attributes: Sequence[str], vote: str) -> DataFrame:
    """Votes, positives and positive rate per value of every attribute, in one pass."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(f"`{a}`").cast("string").alias("value")) for a in attributes])
    )
    return (
        df.select(F.col(vote).alias("_vote"), pairs.alias("_a"))
        .groupBy("_a.attribute", "_a.value")
        .agg(
            F.count("_vote").alias("annotations"),
            F.sum(F.col("_vote").cast("long")).alias("positives"),
            F.avg("_vote").alias("rate"),
        )
    )
