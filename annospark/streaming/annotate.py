"""The row-local operators on a streaming table.

Parsing, voting, validity, cleaning and lengths need no state, so the same
columns serve a batch and a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from annospark.functions import cleaning as clean
from annospark.functions import lexicons as lex
from annospark.functions import patterns as p
from annospark.operators import labels as lab
from annospark.operators import stats
from annospark.sources.tables import ANNOTATED


def annotate(df: DataFrame, labels: Sequence[str] = lex.LABELS, text: str = "text") -> DataFrame:
    """Labels, annotator count, agreement, validity, duplicate key, lengths and cleaned text."""
    out = lab.with_agreement(lab.with_annotator_count(lab.with_labels(df, labels)), labels[0])
    return stats.with_lengths(out, text).withColumns(
        {
            "is_invalid": p.validity_flags(F.col(text))["invalid"],
            "duplicate_key": clean.duplicate_key(F.col(text)),
            "text_clean_cased": clean.preprocess(F.col(text)),
        }
    )


def read_stream(spark: SparkSession, path: str, schema=ANNOTATED) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def write_stream(df: DataFrame, path: str, name: str) -> StreamingQuery:
    """Append to Parquet, with offsets below the cluster's checkpoint folder."""
    root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set")
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{root.rstrip('/')}/{name}")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
