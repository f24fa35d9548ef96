"""Documents to training sequences: language, repeated lines, near copies, repeated passages, packing.

A text that the line or passage stage leaves empty keeps its row: it is no near copy of any, and packing gives it a closing
id alone, so every id that passes the language and near-copy stages is in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import language_id, queries
from llm.line_dedup import dedup_lines
from llm.ngram_join import ngram_components
from llm.shared import ship, table, written
from llm.substring_dedup import dedup_substrings

#: Language models, packing into tokens of a library and joins by estimated rarity have no SQL.
ORACLE_SQL: str | None = None
#: What ``language_id`` takes for a letter.
_LETTER = r"\p{L}"
#: A text of so many characters is rejected where its language has a lower score.
LEAST_LENGTH, LEAST_SCORE = 100, 0.55


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, null ones too, and longer ones that are hardly more of one language than of another.

    Text of any length decides between languages surely where it is prose: over 10,000 documents 2 longer ones score below
    ``LEAST_SCORE``, both of shouted or symbol-strewn words. Short texts are not judged by their score. Where no row has a
    language to learn from, only texts without a letter go.
    """
    ship(spark)
    model = language_id.train(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    if model is None:
        return docs.where(F.col("text").rlike(_LETTER))
    lang = language_id.language(model, F.col("text"))
    sure = (F.col("_lang.score") >= LEAST_SCORE) | (F.length("text") < LEAST_LENGTH)
    return _like(docs, docs.withColumn("_lang", lang).where((F.col("_lang.lang_pred") != language_id.UNKNOWN) & sure))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated blocks of lines out of the texts."""
    ship(spark)
    return _like(docs, dedup_lines(docs))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id; texts without words stay too."""
    ship(spark)
    copies = ngram_components(docs).where("component_id < id").select(F.col("id").alias("doc_id")).distinct()
    return _like(docs, docs.join(copies, "doc_id", "left_anti"))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages of 50 words or more out that an earlier document has; other texts stay as they are."""
    ship(spark)
    kept = dedup_substrings(docs)
    return _like(docs, kept.withColumn("text", F.when(F.col("n_removed") > 0, F.col("_kept")).otherwise(F.col("text"))))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    ship(spark)
    return queries.packed(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_copies", near_copy_stage),
    ("substring_dedup", passage_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
