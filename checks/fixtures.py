"""Annotated texts, annotators and predictions derived from the given tables.

The SQL runs unchanged in Spark and DuckDB: no backslashes, no lambdas, integer
arithmetic only. Every row and every whole text of the tables takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annospark.functions.lexicons import LABELS
from annospark.sources.tables import read_texts

#: Texts in a part, so that a task's work doesn't grow with the table.
TEXTS_AT_ONCE = 8192

# (multiplier, positives out of ten) of the vote pattern per label
_PATTERN = dict(
    zip(LABELS, ((31, 3), (13, 2), (43, 1), (17, 2), (29, 2), (47, 1), (7, 4), (11, 2), (19, 1)), strict=True)
)


def _vote_list(item) -> str:
    parts = [f"chr(39) || {item(0)} || chr(39)"]
    for k in (1, 2, 3):
        parts.append(f"CASE WHEN n_ann > {k} THEN ', ' || chr(39) || {item(k)} || chr(39) ELSE '' END")
    return "'[' || " + "\n      || ".join(parts) + " || ']'"


def _annotator(k: int) -> str:
    return (
        f"CASE WHEN (doc_id + {k}) % 23 = 0 THEN 'x{k}' "
        f"ELSE CAST((doc_id + {k * 5}) % 140 AS STRING) END"
    )


def _vote(label: str):
    factor, tenths = _PATTERN[label]
    return lambda k: (
        f"CASE WHEN (doc_id * {factor} + {k * 17} + doc_id % {k + 3}) % 10 < {tenths} THEN '1' ELSE '0' END"
    )


def social_cte(documents: str = "documents") -> str:
    """Every text of the table with links, mentions, hashtags, emoji or slang, and further rows with unusable texts."""
    return f"""social AS (
  SELECT doc_id, source AS topic,
    text || CASE doc_id % 8
                WHEN 0 THEN ' https://x.id/' || CAST(doc_id AS STRING)
                WHEN 1 THEN ' @user_' || CAST(doc_id % 50 AS STRING)
                WHEN 2 THEN ' #topik gak bgt'
                WHEN 3 THEN ' 😡 yg GILAAA!!!!'
                WHEN 4 THEN ' tidak krn jgn??? the'
                WHEN 5 THEN ' kalo udah gw'
                ELSE '' END AS text
  FROM {documents}
  UNION ALL
  SELECT doc_id + 1000000007 AS doc_id, source AS topic,
    CASE doc_id % 97 WHEN 5 THEN NULL WHEN 6 THEN '' WHEN 7 THEN '  ' WHEN 8 THEN '?!' ELSE 'NaN' END AS text
  FROM {documents} WHERE doc_id % 97 BETWEEN 5 AND 9)"""


def annotated_cte(documents: str = "documents") -> str:
    columns = [f"{_vote_list(_annotator)} AS annotators_id"]
    columns += [f"{_vote_list(_vote(c))} AS {c}" for c in LABELS]
    body = ",\n    ".join(columns)
    return f"""{social_cte(documents)},
annotated AS (
  SELECT CAST(doc_id AS STRING) AS text_id, doc_id, topic, text,
    CASE WHEN doc_id % 17 = 0 THEN 'konteks ' || topic END AS initial_paragraph,
    {body}
  FROM (SELECT *, CASE WHEN doc_id % 20 < 11 THEN 1 WHEN doc_id % 20 < 16 THEN 2
                       WHEN doc_id % 20 < 18 THEN 3 ELSE 4 END AS n_ann FROM social) s)"""


def annotators_cte(customer: str = "customer") -> str:
    return f"""annotators AS (
  SELECT CAST(c_custkey AS STRING) AS annotator_id,
    CASE c_custkey % 4 WHEN 0 THEN 'Sunda' WHEN 1 THEN 'Tionghoa' WHEN 2 THEN 'Bugis' ELSE 'Minang' END AS ethnicity,
    CASE c_custkey % 3 WHEN 0 THEN 'Islam' WHEN 1 THEN 'Hindu' ELSE 'Kristen' END AS religion,
    CASE c_custkey % 2 WHEN 0 THEN 'F ' ELSE 'M' END AS gender,
    CAST(10 + (c_custkey * 7) % 55 AS INT) AS age,
    c_mktsegment AS domisili,
    CASE c_custkey % 3 WHEN 0 THEN 'S1' WHEN 1 THEN 'SMA' ELSE 'S2' END AS education,
    CASE c_custkey % 5 WHEN 0 THEN 'Ibu Rumah Tangga' WHEN 1 THEN 'Pelajar' ELSE 'Bekerja' END AS job,
    CASE c_custkey % 5 WHEN 4 THEN '-' WHEN 0 THEN '' ELSE CAST(c_custkey % 5 AS STRING) END AS vote_leaning,
    CASE WHEN c_custkey % 10 = 0 THEN 'Ya' ELSE 'Tidak' END AS disability,
    CASE WHEN c_custkey % 14 = 0 THEN 'Ya' ELSE 'Tidak' END AS lgbt
  FROM {customer})"""


def predictions_cte(documents: str = "documents", labels: str = "labels") -> str:
    return f"""predictions AS (
  SELECT d.doc_id, d.source AS topic, d.lang, d.n_chars, CAST(d.doc_id % 5 AS INT) AS fold,
    CAST(l.toxic AS INT) AS label,
    CAST((d.doc_id * 37) % 101 AS DOUBLE) / 100 AS score,
    CAST(CASE WHEN (d.doc_id * 37) % 101 > 50 THEN 1 ELSE 0 END AS INT) AS pred
  FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id),
sub_predictions AS (
  SELECT p.*,
    CASE WHEN label = 1 AND doc_id % 2 = 0 THEN 1 ELSE 0 END AS y_insults,
    CASE WHEN label = 1 AND doc_id % 3 = 0 THEN 1 ELSE 0 END AS y_identity_attack,
    CASE WHEN label = 1 AND doc_id % 5 = 0 THEN 1 ELSE 0 END AS y_profanity_obscenity,
    CASE WHEN label = 1 AND doc_id % 7 = 0 THEN 1 ELSE 0 END AS y_threat,
    CASE WHEN label = 1 AND doc_id % 11 = 0 THEN 1 ELSE 0 END AS y_sexually_explicit,
    CAST((doc_id * 53) % 101 AS DOUBLE) / 100 AS s_insults,
    CAST((doc_id * 59) % 101 AS DOUBLE) / 100 AS s_identity_attack,
    CAST((doc_id * 61) % 101 AS DOUBLE) / 100 AS s_profanity_obscenity,
    CAST((doc_id * 67) % 101 AS DOUBLE) / 100 AS s_threat,
    CAST((doc_id * 71) % 101 AS DOUBLE) / 100 AS s_sexually_explicit
  FROM predictions p)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cores = spark.sparkContext.defaultParallelism
    rows = table(spark, sf_dir, "documents").count()
    return read_texts(spark, f"{sf_dir.rstrip('/')}/documents.parquet", "doc_id", max(cores, -(-rows // TEXTS_AT_ONCE)))


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    cte = annotated_cte("{documents}")
    return spark.sql(f"WITH {cte} SELECT * FROM annotated", documents=documents(spark, sf_dir))


def annotators(spark: SparkSession, sf_dir: str) -> DataFrame:
    cte = annotators_cte("{customer}")
    return spark.sql(f"WITH {cte} SELECT * FROM annotators", customer=table(spark, sf_dir, "customer"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    cte = predictions_cte("{documents}", "{labels}")
    return spark.sql(
        f"WITH {cte} SELECT * FROM sub_predictions",
        documents=table(spark, sf_dir, "documents"),
        labels=table(spark, sf_dir, "labels"),
    )
