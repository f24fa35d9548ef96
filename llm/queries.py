"""One query for each operator, over its whole table; ``QUERIES`` and, where SQL can express them, ``ORACLES``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import language_id, prefix_trie, quality_model
from llm.contamination import find_contamination
from llm.line_dedup import dedup_lines
from llm.ngram_join import ngram_components
from llm.oracles import ORACLES  # noqa: F401
from llm.packing import pack
from llm.piece_codec import encode_texts
from llm.quality_rules import FEATURES, judge
from llm.shared import ship, table
from llm.spelling import spelling_variants
from llm.substring_dedup import dedup_substrings
from llm.vector_search import nearest
from llm.warc import archived

#: Folder of the public vocabulary files, if not that of the installed package.
TOKENIZERS: str | None = None

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def vocabulary(name: str) -> str:
    if TOKENIZERS is not None:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(documents: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(documents, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("_kept", 256).alias("kept_sha256"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packed(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_texts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("held_out")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out)
    model = quality_model.train(documents, labels, "doc_id", "text", "quality")
    scored = documents.select("doc_id", held_out, quality_model.quality(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("held_out")
    model = language_id.train(documents.where(~held_out))
    return language_id.identify(documents.select("doc_id", "text", held_out), "text", model).drop("text")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *FEATURES, "base_failed", "kept")


def damaged_words(documents: DataFrame) -> DataFrame:
    """(word, n) of the runs of 7 letters or more, lower-cased in A-Z; a 31st of the runs, drawn by crc32, lose a code point.

    Runs of rows without an id stay as they are.
    """
    runs = documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z\u00C0-\u00FF]{7,})"), F.lit(1))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % 31 == 0, less).otherwise(F.col("run")).alias("word")
    return runs.select(word).where(F.length("word") >= 7).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(damaged_words(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(documents, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    items = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, parts = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns, parts, 5, shared))
