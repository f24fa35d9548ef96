"""Vocabulary, stop words, slang, n-grams and TF-IDF.

Tokens never leave their row before they are counted: arrays are exploded
straight into a count, which every map task combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas import Series, factorize
from pandas.util import hash_array
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.functions import cleaning as clean
from annospark.functions import lexicons as lex
from annospark.functions import patterns as p
from annospark.functions import tokens as tok
from annospark.operators import keys, ranks
from annospark.sources.tables import materialised

#: Bytes of tokens whose n-grams a task holds at once.
BYTES_AT_ONCE = 8_000_000
#: Between the tokens of a text on their way to Arrow, which takes one string far faster than a list of them.
SEPARATOR = "\x1f"


# --- tokenizers: text column -> array<string> --------------------------------
def space_tokens(text: Column) -> Column:
    return p.space_tokens(F.lower(p.filled(text)))


def plain_words(text: Column) -> Column:
    """Lower-case words after links and mentions are blanked out."""
    return p.words(clean.without_links(text))


def apostrophe_words(text: Column) -> Column:
    """Lower-case words, inner apostrophes kept, links and mentions removed."""
    return p.words_with_apostrophes(clean.without_links(text, ""))


def raw_words(text: Column) -> Column:
    """Lower-case words with inner apostrophes of the unchanged text."""
    return p.words_with_apostrophes(F.lower(p.filled(text)))


def vectorizer_words(text: Column) -> Column:
    """Lower-case words of the lightly cleaned text; markers count as words."""
    return p.words(F.lower(clean.light_clean(text)))


def marker_words(text: Column) -> Column:
    """Words of the lightly cleaned text; markers stay ``URL`` and ``USER``."""
    return p.words(clean.light_clean(text))


# --- counts -------------------------------------------------------------------
def token_counts(df: DataFrame, tokens: Column, by: Sequence[str] = ()) -> DataFrame:
    """``(by…, token, n)`` over all documents."""
    rows = df.select(*[F.col(c) for c in by], F.explode(tokens).alias("token"))
    return rows.groupBy(*by, "token").agg(F.count(F.lit(1)).alias("n"))


def without_stop_words(counts: DataFrame, stop_words: Sequence[str], min_length: int = 1) -> DataFrame:
    return counts.filter(~F.col("token").isin(*stop_words) & (F.length("token") >= min_length))


def without_stop_table(counts: DataFrame, stop_words: DataFrame, word: str = "word") -> DataFrame:
    """Counts without the words of a table of any size: an anti join on the word."""
    return counts.join(stop_words.select(F.col(word).alias("token")), "token", "left_anti")


def top(counts: DataFrame, k: int = 20, term: str = "token", order: str = "n") -> DataFrame:
    """The ``k`` most frequent terms, equal counts in term order."""
    return counts.orderBy(F.col(order).desc(), term).limit(k)


def top_by(counts: DataFrame, by: str, k: int, term: str = "token", order: str = "n") -> DataFrame:
    """The ``k`` most frequent terms of each group.

    The rank limit is applied in every map task first, so at most ``k`` rows
    per task and group reach the final ranking.
    """
    w = Window.partitionBy(by).orderBy(F.col(order).desc(), F.col(term))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def stop_word_share(counts: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    stop = F.col("token").isin(*stop_words)
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(stop, F.col("n"))), F.lit(0)).alias("stop_tokens"),
        F.count(F.when(stop, 1)).alias("stop_types"),
        keys.percent(F.coalesce(F.sum(F.when(stop, F.col("n"))), F.lit(0)), F.sum("n")).alias("pct"),
    )


def stop_word_counts(counts: DataFrame, stop_words: Sequence[str], k: int = 20) -> DataFrame:
    return top(counts.filter(F.col("token").isin(*stop_words)), k)


def stop_list(words: Sequence[str], extra: Sequence[str] = (), keep: Sequence[str] = lex.NEGATIONS) -> list[str]:
    """A stop list with additions, never holding a word from ``keep``."""
    return sorted((set(words) | set(extra)) - set(keep))


def negation_counts(counts: DataFrame, negations: Sequence[str] = lex.NEGATIONS) -> DataFrame:
    return counts.filter(F.col("token").isin(*negations))


def vocabulary_stats(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """Tokens, types, diversity, hapax and rare types, types per document."""
    n = F.col("n")
    row = counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("tokens"),
        F.count(F.lit(1)).alias("types"),
        F.count(F.when(n == 1, 1)).alias("once"),
        F.count(F.when(n == 2, 1)).alias("twice"),
        F.count(F.when(n <= 5, 1)).alias("at_most_5"),
    )
    total = documents.agg(F.count(F.lit(1)).alias("d")).scalar()
    return row.select(
        "*",
        F.when(F.col("tokens") > 0, F.col("types") / F.col("tokens")).alias("lexical_diversity"),
        keys.percent(F.col("once"), F.col("types")).alias("hapax_pct"),
        (F.col("types") / F.greatest(total, F.lit(1))).alias("types_per_document"),
    )


def rare_bands(counts: DataFrame) -> DataFrame:
    """Number of types seen once, twice and at most five times."""
    n = F.col("n")
    row = counts.agg(
        F.count(F.when(n == 1, 1)).alias("b1"),
        F.count(F.when(n == 2, 1)).alias("b2"),
        F.count(F.when(n <= 5, 1)).alias("b5"),
    )
    names = (("= 1", "b1"), ("= 2", "b2"), ("<= 5", "b5"))
    return keys.unpivot_row(row, [F.struct(F.lit(a).alias("band"), F.col(b).alias("types")) for a, b in names])


def rare_examples(counts: DataFrame, frequency: int = 1, k: int = 30) -> DataFrame:
    return counts.filter(F.col("n") == frequency).orderBy("token").limit(k)


def rare_word_classes(counts: DataFrame, slang: Mapping[str, str] = lex.SLANG_FORMS, most: int = 5) -> DataFrame:
    """Likely origin of rare words; words without any hint are left out."""
    t = F.col("token")
    origin = F.concat_ws(
        ", ",
        F.when(t.rlike(p.DIGIT), "kode/angka"),
        F.when(t.rlike(p.ELONGATION), "typo/elongasi"),
        F.when(t.isin(*slang), "slang/singkatan"),
        F.when(F.length(t) >= 15, "token sangat panjang/nama/URL residual"),
    )
    return counts.filter(F.col("n") <= most).withColumn("origin", origin).filter("origin <> ''")


def slang_found(counts: DataFrame, slang: Mapping[str, str] = lex.SLANG_FORMS) -> DataFrame:
    """Slang forms that occur, with frequency and normal form."""
    return counts.filter(F.col("token").isin(*slang)).withColumn(
        "normal_form", F.try_element_at(clean.literal_map(slang), F.col("token"))
    )


def elongated(counts: DataFrame, k: int | None = 20) -> DataFrame:
    """Tokens with a character three or more times in a row."""
    found = counts.filter(F.col("token").rlike(p.ELONGATION))
    return found if k is None else top(found, k)


def english_markers(counts: DataFrame, markers: Sequence[str] = lex.ENGLISH_MARKERS) -> DataFrame:
    return counts.filter(F.col("token").isin(*markers))


def documents_with_top_slang(
    df: DataFrame, text: str, slang: Mapping[str, str] = lex.SLANG_FORMS, k: int = 10
) -> DataFrame:
    """Documents that hold one of the ``k`` most frequent slang forms as a whole word."""
    ranked = top(slang_found(token_counts(df, raw_words(F.col(text))), slang), k)
    wanted = ranked.agg(F.collect_list("token").alias("w")).scalar()
    return df.filter(F.arrays_overlap(p.words(F.lower(p.filled(F.col(text)))), wanted))


# --- n-grams ------------------------------------------------------------------
def _counted_in_batches(by: Sequence[str], n: int, frequent: Broadcast | None = None, bits: int = 0) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function that counts the n-grams of batches ``(by…, _hash, _t)``, texts being runs of rows.

    ``frequent`` is a bitmap of (n - 1)-grams: an n-gram counts only where both of its own are set. What runs in tasks is defined inside,
    so that executors don't need this module.
    """
    most, separator = BYTES_AT_ONCE, SEPARATOR

    def joined(tokens: pa.Array, k: int, starts: np.ndarray) -> pa.Array:
        whole = max(len(tokens) - k + 1, 0)
        if 2 * len(starts) > whole:
            # Copying most of them one by one costs more than joining all in place.
            parts = [tokens.slice(i, whole) for i in range(k)]
            grams = pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0]
            return grams if len(starts) == whole else grams.take(pa.array(starts))
        parts = [tokens.take(pa.array(starts + i)) for i in range(k)]
        return pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0]

    def counted(rows: pa.Table) -> pa.Table | None:
        lists = pc.split_pattern(rows["_t"].combine_chunks(), separator)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        tokens, text = lists.flatten(), np.repeat(np.arange(len(sizes)), sizes)
        left = np.cumsum(sizes)[text] - np.arange(len(text))
        group = rows["_hash"].to_numpy()
        starts = np.flatnonzero(left >= n)
        if frequent is not None:
            shorter = np.flatnonzero(left >= n - 1)
            grams = joined(tokens, n - 1, shorter).dictionary_encode()
            hashes = hash_array(grams.dictionary.to_numpy(zero_copy_only=False), categorize=False)[grams.indices.to_numpy()]
            place = (hashes ^ group[text[shorter]].astype("uint64")) >> np.uint64(64 - bits)
            known = np.zeros(len(text) + 1, bool)
            known[shorter] = frequent.value[place >> np.uint64(3)] >> (place & np.uint64(7)).astype("uint8") & 1
            starts = starts[known[starts] & known[starts + 1]]
        if not len(starts):
            return None
        grams = joined(tokens, n, starts).dictionary_encode()
        code, text = grams.indices.to_numpy().astype("int64"), text[starts]
        of, groups = factorize(group)
        key, found = code, np.arange(len(grams.dictionary))
        if len(groups) > 1:
            key, found = factorize(code * len(groups) + of[text])
        # One for each text that has the n-gram.
        first = ~Series(key * len(sizes) + text).duplicated().to_numpy()
        times, df = np.bincount(key, minlength=len(found)), np.bincount(key[first], minlength=len(found))
        any_row = np.zeros(len(found), "int64")
        any_row[key] = text
        columns = [rows[c].combine_chunks().take(pa.array(any_row)) for c in by]
        terms = grams.dictionary if len(groups) == 1 else grams.dictionary.take(pa.array(found // len(groups)))
        return pa.table([*columns, terms, pa.array(times, pa.int64()), pa.array(df, pa.int64())], names=[*by, "term", "n", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column("_t")), 0).to_numpy(zero_copy_only=False).astype("int64"))
            start = 0
            while start < len(upto):
                end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most, "right")))
                found = counted(rows.slice(start, end - start))
                if found is not None:
                    yield from found.to_batches()
                start = end

    return run


def _ngram_rows(rows: DataFrame, by: Sequence[str], n: int, frequent: Broadcast | None = None, bits: int = 0) -> DataFrame:
    """``(by…, term, n, df)`` of rows ``(by…, _hash, _t)``: counted in batches of texts, then over all."""
    schema = T.StructType([rows.schema[c] for c in by]).add("term", "string").add("n", "long").add("df", "long")
    # Batches count as much as map tasks could: dealt out first, no task holds all n-grams of its texts.
    parts = rows.mapInArrow(_counted_in_batches(by, n, frequent, bits), schema).repartition(*by, "term")
    return parts.groupBy(*by, "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _gram_source(df: DataFrame, tokens: Column, stop_words: Sequence[str], by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Rows ``(by0, by1, …, _hash, _t)`` and the names of the first: groups, a hash of them, and tokens without stop words.

    ``_t`` is null where no token is left, so that one empty token differs from none.
    """
    groups = [f"by{i}" for i in range(len(by))]
    kept = [F.col(c).alias(g) for c, g in zip(by, groups, strict=True)]
    hashed = F.xxhash64(*by) if by else F.lit(0).cast("long")
    rows = df.select(*kept, hashed.alias("_hash"), tok.drop_stop_words(tokens, stop_words).alias("_t"))
    return rows.withColumn("_t", F.when(F.size("_t") > 0, F.array_join("_t", SEPARATOR))), groups


def ngram_counts(
    df: DataFrame,
    tokens: Column,
    n: int,
    stop_words: Sequence[str] = lex.STOP_WORDS,
    by: Sequence[str] = (),
    min_df: int = 1,
) -> DataFrame:
    """``(by…, term, n, df)``; stop words are removed before n-grams form.

    N-grams form and are counted in Arrow batches of texts, so that only counts of a batch reach Spark's aggregate. Tokens don't
    hold U+001F, which counts as white space.
    """
    rows, groups = _gram_source(df, tokens, stop_words, by)
    out = _ngram_rows(rows, groups, n)
    out = out.filter(F.col("df") >= min_df) if min_df > 1 else out
    return out.select(*[F.col(g).alias(c) for c, g in zip(by, groups, strict=True)], "term", "n", "df")


def _bitmap(terms: DataFrame, by: Sequence[str], bits: int) -> np.ndarray:
    """``2 ** bits`` bits, eight a byte, in which that of every term is set; words of 64 of them reach the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = hash_array(batch.column("term").to_numpy(zero_copy_only=False), categorize=False)
            place = (hashes ^ batch.column("_hash").to_numpy().astype("uint64")) >> np.uint64(64 - bits)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype("int64"))], names=["place"])

    hashed = F.xxhash64(*by) if by else F.lit(0).cast("long")
    place = terms.select("term", hashed.alias("_hash")).mapInArrow(places, "place long")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    words = place.groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(one).alias("set")).toArrow()
    out = np.zeros(max(1, 2**bits // 64), "<i8")
    out[words["at"].to_numpy()] = words["set"].to_numpy()
    return out.view("uint8")


def level_ngram_counts(
    df: DataFrame,
    tokens: Column,
    n: int,
    min_df: int,
    stop_words: Sequence[str] = lex.STOP_WORDS,
    by: Sequence[str] = (),
    bits: int = 25,
) -> DataFrame:
    """The rows of ``ngram_counts`` with ``df >= min_df``, counted level by level.

    An n-gram is in no more documents than its two (n - 1)-grams. So n-grams are counted, and shuffled, only where both
    reach ``min_df``, which drops the long tail of n-grams seen once. The frequent ones of a level are a bitmap of ``2 ** bits``
    bits (4 MB for 25), which is all that reaches the driver and is broadcast; where two share a bit, a few n-grams too many
    are counted and go by their exact count. Tokens are written once, each level reads them once, and all but the
    last level are counted while the plan is built. Tokens hold no U+001F; null texts have none.
    """
    if n < 2:
        return ngram_counts(df, tokens, n, stop_words, by, min_df)
    rows, groups = _gram_source(df, tokens, stop_words, by)
    rows = materialised(rows, "tokens")
    known = None
    for k in range(1, n + 1):
        counts = _ngram_rows(rows, groups, k, known, bits).where(F.col("df") >= min_df)
        if k < n:
            known = df.sparkSession.sparkContext.broadcast(_bitmap(counts, groups, bits))
    return counts.select(*[F.col(g).alias(c) for c, g in zip(by, groups, strict=True)], "term", "n", "df")


# --- TF-IDF -------------------------------------------------------------------
def document_terms(
    df: DataFrame, doc_id: str, tokens: Column, stop_words: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """``(doc_id, carry…, term, tf)``, counted inside each row without a shuffle."""
    rows = df.select(
        doc_id, *carry, F.sort_array(tok.drop_stop_words(tokens, stop_words)).alias("_s")
    )
    rows = rows.withColumn("_b", tok.run_starts("_s"))
    return rows.select(doc_id, *carry, F.explode(tok.run_lengths("_s", "_b")).alias("_x")).select(
        doc_id, *carry, "_x.term", "_x.tf"
    )


def most_frequent(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` terms of a written table ``(term, cf, …)`` with the largest ``cf``, equal ones in term order.

    A histogram of the frequencies gives the last one that is kept, and only terms of that frequency are put in order.
    """
    sizes = counts.groupBy("cf").agg(F.count(F.lit(1)).alias("n"))
    # One row a frequency: their number grows with the square root of the tokens.
    upto = F.sum("n").over(Window.orderBy(F.col("cf").desc()).rowsBetween(Window.unboundedPreceding, 0))
    last = sizes.select("cf", "n", upto.alias("upto")).where((F.col("upto") >= k) & (F.col("upto") - F.col("n") < k)).first()
    if last is None:
        return counts if k > 0 else counts.limit(0)
    edge = counts.where(F.col("cf") == last["cf"])
    left = k - (last["upto"] - last["n"])
    if left < last["n"]:
        edge = ranks.first_rows(edge, [F.col("term")], left)
    return counts.where(F.col("cf") > last["cf"]).unionByName(edge)


def tfidf_vocabulary(
    terms: DataFrame, documents: DataFrame, min_df: int, max_df: float, max_features: int | None = None
) -> DataFrame:
    """``(term, df, idf)`` of the kept terms: the ``max_features`` most frequent of them, or all."""
    total = documents.agg(F.count(F.lit(1)).alias("d")).scalar()
    stats = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    kept = stats.withColumn("_n", total).filter((F.col("df") >= min_df) & (F.col("df") <= F.col("_n") * max_df))
    if max_features is not None:
        kept = most_frequent(materialised(kept, "vocabulary"), max_features)
    return kept.select("term", "df", (F.log((F.col("_n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def term_index(vocabulary: DataFrame) -> DataFrame:
    """The vocabulary with ``id``, 0, 1, 2, … in the order of the terms: ranges of terms are written, counted and numbered."""
    ranged = materialised(vocabulary.repartitionByRange("term").withColumn("_part", F.spark_partition_id()), "terms")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row a partition.
    placed = ranged.join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    place = F.row_number().over(Window.partitionBy("_part").orderBy("term")) - 1
    return placed.select(*vocabulary.columns, (F.col("_before") + place).cast("long").alias("id"))


def tfidf_weights(
    df: DataFrame,
    doc_id: str,
    tokens: Column,
    stop_words: Sequence[str] = lex.STOP_WORDS,
    min_df: int = 2,
    max_df: float = 0.98,
    max_features: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``(doc_id, carry…, term, weight)``: sublinear tf, smoothed idf, unit length per document.

    The terms are written once to the shared folder and read for the vocabulary and for the weights, so texts are tokenised
    once, while the plan is built. A vocabulary bounded by ``max_features`` is broadcast, and then the only
    wide shuffle gathers a document's kept terms for its norm.
    """
    terms = materialised(document_terms(df, doc_id, tokens, stop_words, carry), "terms")
    vocabulary = tfidf_vocabulary(terms, df, min_df, max_df, max_features)
    if max_features is not None:
        vocabulary = F.broadcast(vocabulary)
    weighted = terms.join(vocabulary, "term").select(
        doc_id, *carry, "term", ((F.log("tf") + 1) * F.col("idf")).alias("_w")
    )
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(doc_id)))
    return weighted.select(doc_id, *carry, "term", (F.col("_w") / norm).alias("weight"))


def tfidf_mean(df: DataFrame, weights: DataFrame) -> DataFrame:
    """Mean weight per term over all documents, empty ones included."""
    total = df.agg(F.count(F.lit(1)).alias("d")).scalar()
    return weights.groupBy("term").agg(F.sum("weight").alias("_s")).select(
        "term", (F.col("_s") / total).alias("mean_tfidf")
    )


def top_weights(means: DataFrame, k: int = 20) -> DataFrame:
    """Top terms by mean weight; weights equal to 12 digits tie, in term order."""
    return means.orderBy(F.round("mean_tfidf", 12).desc(), "term").limit(k)


def tfidf_mean_by(df: DataFrame, weights: DataFrame, by: str, k: int) -> DataFrame:
    """Top ``k`` terms per class by mean weight within the class."""
    sums = weights.filter(F.col(by).isNotNull()).groupBy(by, "term").agg(F.sum("weight").alias("_s"))
    best = top_by(sums.withColumn("_o", F.round("_s", 9)), by, k, "term", "_o")
    sizes = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("_docs"))
    return best.join(sizes, by).select(by, "term", (F.col("_s") / F.col("_docs")).alias("mean_tfidf"), "rank")


def tfidf_shape(df: DataFrame, vocabulary: DataFrame) -> DataFrame:
    total = df.agg(F.count(F.lit(1)).alias("d")).scalar()
    return vocabulary.agg(F.count(F.lit(1)).alias("features")).select(total.alias("documents"), "features")


# --- effect of lower-casing ---------------------------------------------------
def case_effect(df: DataFrame, cased: str, lowered: str) -> DataFrame:
    """Vocabulary and token counts of two versions of a text, and the reduction.

    Both versions are counted in one scan and one shuffle.
    """
    versions = F.explode(
        F.array(
            F.struct(F.lit("cased").alias("version"), p.words(F.col(cased)).alias("tokens")),
            F.struct(F.lit("lower").alias("version"), p.words(F.col(lowered)).alias("tokens")),
        )
    )
    rows = df.select(versions.alias("_v")).select("_v.version", F.explode("_v.tokens").alias("token"))
    counts = rows.groupBy("version", "token").agg(F.count(F.lit(1)).alias("n"))

    def of(version: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("version") == version, value)), F.lit(0))

    return counts.agg(
        of("cased", F.lit(1)).alias("cased_types"),
        of("lower", F.lit(1)).alias("lower_types"),
        of("cased", F.col("n")).alias("cased_tokens"),
        of("lower", F.col("n")).alias("lower_tokens"),
    ).withColumn(
        "reduction_pct",
        keys.percent(F.col("cased_types") - F.col("lower_types"), F.col("cased_types")),
    )


def allcaps_types(df: DataFrame, cased: str, min_length: int = 3) -> DataFrame:
    """Upper-case words whose form is lost by lower-casing."""
    counts = token_counts(df, p.words(F.col(cased)))
    return counts.filter(p.is_all_upper(F.col("token")) & (F.length("token") >= min_length))
