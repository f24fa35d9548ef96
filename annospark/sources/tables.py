"""Schemas, readers and sinks.

CSV texts hold line breaks; files of any size are read by many tasks all the same (:mod:`annospark.sources.csv_ranges`).
Read a large corpus once, write it with :func:`write_table`, and work on the Parquet copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.functions import lexicons as lex
from annospark.sources import csv_ranges

ANNOTATED = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("text_id", "annotators_id", "text", "initial_paragraph", "topic", *lex.LABELS)]
)

ANNOTATORS = T.StructType(
    [
        T.StructField("annotator_id", T.StringType()),
        T.StructField("ethnicity", T.StringType()),
        T.StructField("religion", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("domisili", T.StringType()),
        T.StructField("pendidikan terakhir", T.StringType()),
        T.StructField("status pekerjaan", T.StringType()),
        T.StructField("president vote leaning", T.StringType()),
        T.StructField("disability", T.StringType()),
        T.StructField("lgbt", T.StringType()),
    ]
)

#: Columns of the interim export.
INTERIM_COLUMNS = (
    "text_id",
    "text",
    "initial_paragraph",
    "topic",
    "toxicity_label",
    "identity_attack_label",
    "threat_incitement_to_violence_label",
    "insults_label",
    "profanity_obscenity_label",
    "sexually_explicit_label",
    "polarized_label",
    "related_to_election_2024_label",
    "is_noise_or_spam_text_label",
    "char_count",
    "word_count",
    "num_annotators",
)

_CSV_OUT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def nulls_from_words(df: DataFrame, words: Sequence[str] = lex.NULL_WORDS) -> DataFrame:
    """Read the usual spellings of a missing value as null."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and not f.name.startswith("_")]
    return df.withColumns(
        {c: F.when(~F.col(f"`{c}`").isin(*words), F.col(f"`{c}`")) for c in strings}
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType, row_pos: str | None = None) -> DataFrame:
    """CSV files with a header line each, values by position, quotes doubled, line breaks inside quotes kept.

    ``row_pos`` names one more column: the row's number from 0, files by path, rows by place in their file.
    """
    names = [f.name for f in schema.fields]
    records = csv_ranges.csv_records(spark, path, materialised)
    found = records.select(*([F.col("row").alias("_row")] if row_pos else []), csv_ranges.parsed(F.col("text"), names).alias("_values"))
    found = nulls_from_words(found.select(*(["_row"] if row_pos else []), "_values.*"))
    typed = [F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})").alias(f.name) for f in schema.fields]
    return found.select(*typed, *([F.col("_row").alias(row_pos)] if row_pos else []))


def read_annotated(spark: SparkSession, path: str, row_pos: str | None = "row_pos") -> DataFrame:
    """Annotated texts from CSV, numbered from 0 when ``row_pos`` is given: files by path, rows by place in their file."""
    return read_csv(spark, path, ANNOTATED, row_pos)


def read_texts(spark: SparkSession, path: str, row_id: str, partitions: int | None = None) -> DataFrame:
    """A Parquet table of texts, dealt by its row id into ``partitions`` if the caller asks for it.

    Text work is bound by regular expressions, so a table of few small files is worth dealing out; one of many is not.
    """
    df = spark.read.parquet(path)
    return df.repartition(partitions, row_id) if partitions else df


def read_annotators(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ANNOTATORS)


def read_annotators_json(spark: SparkSession, path: str) -> DataFrame:
    """Annotators from JSON lines."""
    return spark.read.schema(ANNOTATORS).json(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).options(**_CSV_OUT).csv(path)


def write_split(df: DataFrame, path: str, split: str = "split", fmt: str = "parquet") -> None:
    """Train and test in one write, one folder per split."""
    (write_csv if fmt == "csv" else write_table)(df, path, [split])


def interim(df: DataFrame, columns: Sequence[str] = INTERIM_COLUMNS) -> DataFrame:
    """Projection written to the interim store."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Score rows, per fold or averaged, as CSV."""
    write_csv(metrics, path)


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor reaches: ``spark.checkpoint.dir``, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/annospark").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """Write a table used several times to the shared folder and read it back.

    This cuts the lineage and survives lost executors. The copy stays until the folder is cleared, since the result reads it.
    """
    path = scratch_path(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
