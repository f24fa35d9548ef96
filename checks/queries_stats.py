"""Lengths, distributions, vocabulary, n-grams and TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from annospark.functions import cleaning
from annospark.functions import lexicons as lex
from annospark.functions import patterns as p
from annospark.functions.lexicons import LABELS
from annospark.operators import labels as lab
from annospark.operators import lexical, stats
from annospark.plans import report
from checks import fixtures as fx
from checks import sql as q
from checks.queries_labels import labelled
from checks.registry import query

#: Terms kept by the TF-IDF queries.
MAX_FEATURES = 30_000

CHARS, WORDS = f"len({q.filled('text')})", q.n_words("text")


def text():
    return F.col("text")


def with_label(spark, sf):
    return lab.with_labels(fx.annotated(spark, sf), ["toxicity"])


def lengths(spark, sf):
    return stats.with_lengths(with_label(spark, sf)).select("doc_id", "toxicity_label", "chars", "words", "space_words", "sentences")


# --- lengths ---------------------------------------------------------------------
@query(
    "text_lengths",
    f"{q.ANNOTATED} SELECT doc_id, CAST({CHARS} AS INTEGER) AS chars, CAST({WORDS} AS INTEGER) AS words, "
    f"CAST(len({q.space_words(q.filled('text'))}) AS INTEGER) AS space_words, "
    f"CAST(len(regexp_extract_all({q.filled('text')}, '[^.!?]*[^.!?{q.S}][^.!?]*')) AS INTEGER) AS sentences FROM annotated",
)
def text_lengths(spark, sf):
    return lengths(spark, sf).drop("toxicity_label")


def _histogram(bins: int, where: str = "TRUE") -> str:
    return (
        f"(WITH v AS (SELECT CAST(w AS DOUBLE) AS x FROM h WHERE {where}), "
        "r AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo, CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v), "
        f"b AS (SELECT CAST(least(floor((x - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin, count(*) AS n FROM v, r GROUP BY 1), "
        f"f AS (SELECT CAST(i AS INTEGER) AS bin FROM range({bins}) t(i)) "
        f"SELECT f.bin, {q.r6(f'lo + f.bin * ((hi - lo) / {bins})')} AS lower, {q.r6(f'lo + (f.bin + 1) * ((hi - lo) / {bins})')} AS upper, coalesce(n, 0) AS n "
        "FROM f CROSS JOIN r LEFT JOIN b ON f.bin = b.bin)"
    )


@query("length_histogram", f"{q.ANNOTATED}, h AS (SELECT {WORDS} AS w FROM annotated) SELECT * FROM {_histogram(60)}")
def length_histogram(spark, sf):
    return stats.histogram(lengths(spark, sf), "words", 60)


@query(
    "length_histogram_by_class",
    f"{q.LABELLED}, h AS (SELECT {WORDS} AS w, toxicity_label AS y FROM labelled) "
    + q.unpivot(("0.0", "0.5", "1.0"), lambda y: f"SELECT {y}::DOUBLE AS toxicity_label, * FROM {_histogram(50, f'y = {y}')}"),
)
def length_histogram_by_class(spark, sf):
    return stats.histogram(lengths(spark, sf), "words", 50, "toxicity_label", lex.VOTE_OUTCOMES)


@query(
    "length_box",
    f"{q.ANNOTATED}, h AS (SELECT CAST({WORDS} AS DOUBLE) AS x FROM annotated), "
    "b AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM h), "
    "f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM b) "
    f"SELECT {q.r6('min(q1)')} AS q1, {q.r6('min(median)')} AS median, {q.r6('min(q3)')} AS q3, min(x) FILTER (x >= lo) AS whisker_low, "
    "max(x) FILTER (x <= hi) AS whisker_high, count(*) FILTER (x < lo OR x > hi) AS outliers FROM h, f",
)
def length_box(spark, sf):
    return stats.box_stats(lengths(spark, sf), "words")


@query(
    "length_by_label",
    f"{q.LABELLED}, h AS (SELECT toxicity_label, {CHARS} AS c, {WORDS} AS w FROM labelled WHERE toxicity_label IS NOT NULL) "
    f"SELECT toxicity_label, count(*) AS n, {q.r6('avg(c)')} AS mean_chars, {q.r6('quantile_cont(c, 0.5)')} AS median_chars, "
    f"{q.r6('avg(w)')} AS mean_words, {q.r6('quantile_cont(w, 0.5)')} AS median_words FROM h GROUP BY 1",
)
def length_by_label(spark, sf):
    return stats.length_by_label(lengths(spark, sf), "toxicity_label")


@query(
    "length_by_class",
    f"{q.LABELLED}, h AS (SELECT toxicity_label AS y, len({q.space_words(q.filled('text'))}) AS w FROM labelled) "
    f"SELECT {q.r6('avg(w) FILTER (y = 0)')} AS mean_negative, {q.r6('avg(w) FILTER (y = 1)')} AS mean_positive FROM h",
)
def length_by_class(spark, sf):
    return stats.mean_length_by_class(lengths(spark, sf), "toxicity_label", "space_words")


@query(
    "length_coverage",
    f"{q.ANNOTATED}, h AS (SELECT {WORDS} AS w FROM annotated) "
    + q.unpivot((128, 256, 384), lambda n: f"SELECT {n} AS max_words, {q.r6(f'avg(CASE WHEN w <= {n} THEN 1 ELSE 0 END)')} AS coverage FROM h"),
)
def length_coverage(spark, sf):
    return stats.length_coverage(lengths(spark, sf), "words", lex.COVERAGE_LENGTHS)


_FLAGS = ", ".join(
    f"{q.r6(f'avg(CASE WHEN regexp_matches(t, {chr(39)}{q.ELEMENTS[e]}{chr(39)}) THEN 1 ELSE 0 END) * 100')} AS {e}_pct"
    for e in stats.CLASS_ELEMENTS
)


@query(
    "class_summary",
    f"{q.LABELLED}, h AS (SELECT toxicity_label, {q.filled('text')} AS t FROM labelled WHERE toxicity_label IS NOT NULL) "
    f"SELECT toxicity_label, count(*) AS documents, {q.r6('avg(len(t))')} AS mean_chars, {q.r6('quantile_cont(len(t), 0.5)')} AS median_chars, "
    f"{q.r6(f'avg(len({q.words(chr(116))}))')} AS mean_words, {q.r6(f'quantile_cont(len({q.words(chr(116))}), 0.5)')} AS median_words, {_FLAGS} FROM h GROUP BY 1",
)
def class_summary(spark, sf):
    return stats.class_summary(with_label(spark, sf), "toxicity_label")


CORRELATED = [f"{c}_label" for c in LABELS[:6]]
_NO_TIES = " AND ".join(f"{c} IS DISTINCT FROM 0.5" for c in CORRELATED)
_PAIRS = [(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1 :]]


@query(
    "label_correlation",
    f"{q.LABELLED} "
    + q.unpivot(_PAIRS, lambda e: f"SELECT '{e[0]}' AS label_a, '{e[1]}' AS label_b, {q.r6(f'corr({e[0]}, {e[1]})')} AS r FROM labelled WHERE {_NO_TIES}"),
)
def label_correlation(spark, sf):
    return stats.label_correlation(labelled(spark, sf), CORRELATED)


@query("monthly_counts", "SELECT CAST(date_trunc('month', ts) AS TIMESTAMP) AS period, count(*) AS n FROM events GROUP BY 1")
def monthly_counts(spark, sf):
    return stats.monthly_counts(fx.table(spark, sf, "events"), "ts")


@query(
    "monthly_orders",
    "SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS period, count(*) AS n FROM orders GROUP BY 1",
)
def monthly_orders(spark, sf):
    return stats.monthly_counts(fx.table(spark, sf, "orders"), "o_orderdate")


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query(
    "period_label_crosstab",
    "SELECT CAST(date_trunc('month', ts) AS TIMESTAMP) AS period, "
    + ", ".join(f"count(*) FILTER (event_type = '{e}') AS \"{e}\"" for e in EVENT_TYPES)
    + f" FROM events WHERE event_type IN ({q.quoted(EVENT_TYPES)}) GROUP BY 1",
)
def period_label_crosstab(spark, sf):
    return stats.period_crosstab(fx.table(spark, sf, "events"), "ts", "event_type", EVENT_TYPES)


@query(
    "topic_label",
    f"{q.LABELLED} SELECT topic, toxicity_label, count(*) AS n, CAST(grouping(topic, toxicity_label) AS INTEGER) AS level FROM labelled GROUP BY ROLLUP (topic, toxicity_label)",
)
def topic_label(spark, sf):
    return stats.topic_by_label(labelled(spark, sf), "topic", "toxicity_label")


# --- tokens --------------------------------------------------------------------------
PLAIN = q.words(q.links_blank("text"))
RAW = q.apostrophe_words(f"lower({q.filled('text')})")
REMOVED = q.apostrophe_words(q.links_blank("text", ""))
VECTOR = q.words(f"lower({q.light('text')})")
MARKED = q.words(q.light("text"))
STOP, NEG = q.quoted(lex.STOP_WORDS), q.quoted(lex.NEGATIONS)


def plain_counts(spark, sf):
    return lexical.token_counts(fx.annotated(spark, sf), lexical.plain_words(text()))


def raw_counts(spark, sf):
    return lexical.token_counts(fx.annotated(spark, sf), lexical.raw_words(text()))


_PLAIN_COUNTS = q.counts_of(PLAIN, "annotated")
_RAW_COUNTS = q.counts_of(RAW, "annotated")


@query("token_counts", f"{q.ANNOTATED} SELECT token, n FROM {_PLAIN_COUNTS}")
def token_counts(spark, sf):
    return plain_counts(spark, sf)


@query(
    "token_top_space",
    f"{q.LABELLED} SELECT token, n FROM {q.counts_of(q.space_words(f'lower({q.filled(chr(116) + chr(101) + chr(120) + chr(116))})'), 'labelled', where='toxicity_label = 1')} ORDER BY n DESC, token LIMIT 20",
)
def token_top_space(spark, sf):
    toxic = with_label(spark, sf).filter("toxicity_label = 1")
    return lexical.top(lexical.token_counts(toxic, lexical.space_tokens(text())), 20)


@query("token_top", f"{q.ANNOTATED} SELECT token, n FROM {_PLAIN_COUNTS} ORDER BY n DESC, token LIMIT 20")
def token_top(spark, sf):
    return lexical.top(plain_counts(spark, sf), 20)


@query(
    "token_top_nostop",
    f"{q.ANNOTATED} SELECT token, n FROM {_PLAIN_COUNTS} WHERE token NOT IN ({STOP}) AND len(token) > 1 ORDER BY n DESC, token LIMIT 20",
)
def token_top_nostop(spark, sf):
    return lexical.top(lexical.without_stop_words(plain_counts(spark, sf), lex.STOP_WORDS, 2), 20)


@query(
    "stopword_share",
    f"{q.ANNOTATED} SELECT CAST(sum(n) AS BIGINT) AS tokens, CAST(coalesce(sum(n) FILTER (token IN ({STOP})), 0) AS BIGINT) AS stop_tokens, "
    f"count(*) FILTER (token IN ({STOP})) AS stop_types, {q.r6(f'coalesce(sum(n) FILTER (token IN ({STOP})), 0) * 100.0 / sum(n)')} AS pct FROM {_PLAIN_COUNTS}",
)
def stopword_share(spark, sf):
    return lexical.stop_word_share(plain_counts(spark, sf), lex.STOP_WORDS)


@query("stopword_top", f"{q.ANNOTATED} SELECT token, n FROM {_PLAIN_COUNTS} WHERE token IN ({STOP}) ORDER BY n DESC, token LIMIT 20")
def stopword_top(spark, sf):
    return lexical.stop_word_counts(plain_counts(spark, sf), lex.STOP_WORDS)


@query("negation_counts", f"{q.ANNOTATED} SELECT token, n FROM {_PLAIN_COUNTS} WHERE token IN ({NEG})")
def negation_counts(spark, sf):
    return lexical.negation_counts(plain_counts(spark, sf))


@query(
    "vocab_stats",
    f"{q.ANNOTATED}, c AS (SELECT * FROM {_PLAIN_COUNTS}), s AS (SELECT CAST(sum(n) AS BIGINT) AS tokens, count(*) AS types, count(*) FILTER (n = 1) AS once, "
    "count(*) FILTER (n = 2) AS twice, count(*) FILTER (n <= 5) AS at_most_5 FROM c) "
    f"SELECT *, {q.r6('types::DOUBLE / tokens')} AS lexical_diversity, {q.r6('once * 100.0 / types')} AS hapax_pct, "
    f"{q.r6('types::DOUBLE / (SELECT count(*) FROM annotated)')} AS types_per_document FROM s",
)
def vocab_stats(spark, sf):
    df = fx.annotated(spark, sf)
    return lexical.vocabulary_stats(lexical.token_counts(df, lexical.plain_words(text())), df)


@query(
    "rare_bands",
    f"{q.ANNOTATED}, c AS (SELECT * FROM {_PLAIN_COUNTS}) SELECT '= 1' AS band, count(*) FILTER (n = 1) AS types FROM c UNION ALL "
    "SELECT '= 2', count(*) FILTER (n = 2) FROM c UNION ALL SELECT '<= 5', count(*) FILTER (n <= 5) FROM c",
)
def rare_bands(spark, sf):
    return lexical.rare_bands(plain_counts(spark, sf))


@query("rare_examples", f"{q.ANNOTATED} SELECT token, n FROM {_PLAIN_COUNTS} WHERE n = 1 ORDER BY token LIMIT 30")
def rare_examples(spark, sf):
    return lexical.rare_examples(plain_counts(spark, sf))


_ELONGATED = (
    "len(list_filter(range(1, len(token) - 1), lambda i: substr(token, i, 1) = substr(token, i + 1, 1) AND substr(token, i, 1) = substr(token, i + 2, 1))) > 0"
)


@query(
    "rare_word_classes",
    f"{q.ANNOTATED}, c AS (SELECT * FROM {_PLAIN_COUNTS} WHERE n <= 5), o AS (SELECT token, n, concat_ws(', ', "
    rf"CASE WHEN regexp_matches(token, '\p{{Nd}}') THEN 'kode/angka' END, CASE WHEN {_ELONGATED} THEN 'typo/elongasi' END, "
    f"CASE WHEN token IN ({q.quoted(lex.SLANG_FORMS)}) THEN 'slang/singkatan' END, "
    "CASE WHEN len(token) >= 15 THEN 'token sangat panjang/nama/URL residual' END) AS origin FROM c) SELECT * FROM o WHERE origin <> ''",
)
def rare_word_classes(spark, sf):
    return lexical.rare_word_classes(plain_counts(spark, sf))


@query(
    "slang_found",
    f"{q.ANNOTATED} SELECT token, n, {q.case_map('token', lex.SLANG_FORMS)} AS normal_form FROM {_RAW_COUNTS} WHERE token IN ({q.quoted(lex.SLANG_FORMS)})",
)
def slang_found(spark, sf):
    return lexical.slang_found(raw_counts(spark, sf))


@query("elongated_tokens", f"{q.ANNOTATED} SELECT token, n FROM {_RAW_COUNTS} WHERE {_ELONGATED} ORDER BY n DESC, token LIMIT 20")
def elongated_tokens(spark, sf):
    return lexical.elongated(raw_counts(spark, sf))


@query("english_markers", f"{q.ANNOTATED} SELECT token, n FROM {_RAW_COUNTS} WHERE token IN ({q.quoted(lex.ENGLISH_MARKERS)})")
def english_markers(spark, sf):
    return lexical.english_markers(raw_counts(spark, sf))


@query(
    "slang_documents",
    f"{q.ANNOTATED}, s AS (SELECT token FROM {_RAW_COUNTS} WHERE token IN ({q.quoted(lex.SLANG_FORMS)}) ORDER BY n DESC, token LIMIT 10), "
    f"d AS (SELECT doc_id, unnest({q.words(f'lower({q.filled(chr(116) + chr(101) + chr(120) + chr(116))})')}) AS w FROM annotated) "
    "SELECT DISTINCT doc_id FROM d WHERE w IN (SELECT token FROM s)",
)
def slang_documents(spark, sf):
    return lexical.documents_with_top_slang(fx.annotated(spark, sf), "text").select("doc_id")


@query(
    "class_top_words",
    f"{q.LABELLED}, c AS (SELECT * FROM {q.counts_of(MARKED, 'labelled', 'toxicity_label', 'toxicity_label IS NOT NULL')} WHERE token NOT IN ({STOP})), "
    "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY toxicity_label ORDER BY n DESC, token) AS INTEGER) AS rank FROM c) SELECT * FROM r WHERE rank <= 10",
)
def class_top_words(spark, sf):
    df = with_label(spark, sf).filter("toxicity_label is not null")
    counts = lexical.token_counts(df, lexical.marker_words(text()), ["toxicity_label"])
    return lexical.top_by(lexical.without_stop_words(counts, lex.STOP_WORDS), "toxicity_label", 10)


@query(
    "agreement_top_words",
    f"{q.LABELLED}, g AS (SELECT *, {q.AGREEMENT} AS agreement_group FROM labelled), "
    f"c AS (SELECT * FROM {q.counts_of(REMOVED, 'g', 'agreement_group')} WHERE token NOT IN ({q.quoted(lex.STOP_WORDS_AGREEMENT)})), "
    "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY agreement_group ORDER BY n DESC, token) AS INTEGER) AS rank FROM c) SELECT * FROM r WHERE rank <= 15",
)
def agreement_top_words(spark, sf):
    df = lab.with_agreement(fx.annotated(spark, sf))
    counts = lexical.token_counts(df, lexical.apostrophe_words(text()), ["agreement_group"])
    return lexical.top_by(lexical.without_stop_words(counts, lex.STOP_WORDS_AGREEMENT), "agreement_group", 15)


@query(
    "cloud_words",
    f"{q.LABELLED}, c AS (SELECT * FROM {q.counts_of(PLAIN, 'labelled', 'toxicity_label', 'toxicity_label IS NOT NULL')} WHERE token NOT IN ({STOP})), "
    "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY toxicity_label ORDER BY n DESC, token) AS INTEGER) AS rank FROM c) SELECT * FROM r WHERE rank <= 100",
)
def cloud_words(spark, sf):
    df = with_label(spark, sf).filter("toxicity_label is not null")
    counts = lexical.token_counts(df, lexical.plain_words(text()), ["toxicity_label"])
    return lexical.top_by(lexical.without_stop_words(counts, lex.STOP_WORDS), "toxicity_label", 100)


@query(
    "cloud_words_corpus",
    f"{q.ANNOTATED} SELECT token, n FROM {q.counts_of(PLAIN, 'annotated')} WHERE token NOT IN ({STOP}) ORDER BY n DESC, token LIMIT 120",
)
def cloud_words_corpus(spark, sf):
    counts = lexical.token_counts(fx.annotated(spark, sf), lexical.plain_words(text()))
    return lexical.top(lexical.without_stop_words(counts, lex.STOP_WORDS), 120)


@query(
    "cloud_words_agreement",
    f"{q.LABELLED}, g AS (SELECT *, {q.AGREEMENT} AS agreement_group FROM labelled), "
    f"c AS (SELECT * FROM {q.counts_of(REMOVED, 'g', 'agreement_group')} WHERE token NOT IN ({q.quoted(lex.STOP_WORDS_AGREEMENT)})), "
    "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY agreement_group ORDER BY n DESC, token) AS INTEGER) AS rank FROM c) SELECT * FROM r WHERE rank <= 100",
)
def cloud_words_agreement(spark, sf):
    df = lab.with_agreement(fx.annotated(spark, sf))
    counts = lexical.token_counts(df, lexical.apostrophe_words(text()), ["agreement_group"])
    return lexical.top_by(lexical.without_stop_words(counts, lex.STOP_WORDS_AGREEMENT), "agreement_group", 100)


_LOOSE_WORDS = q.words(q.sub(q.sub("lower(coalesce(text, ''))", rf"http[^{q.S}]+|www[^{q.S}]+", ""), q.MENTION, ""))


@query(
    "cloud_words_toxic",
    f"{q.LABELLED} SELECT token, n FROM {q.counts_of(_LOOSE_WORDS, 'labelled', '', 'toxicity_label = 1')} "
    f"WHERE token NOT IN ({q.quoted(lex.STOP_WORDS_EARLY)}) ORDER BY n DESC, token LIMIT 100",
)
def cloud_words_toxic(spark, sf):
    """Toxic texts with the looser link rule and their own stop list."""
    df = with_label(spark, sf).filter("toxicity_label = 1")
    words = p.words(cleaning.without_links(text(), "", p.URL_LOOSE))
    return lexical.top(lexical.without_stop_words(lexical.token_counts(df, words), lex.STOP_WORDS_EARLY), 100)


_STOP_TABLE = " UNION ALL ".join(f"SELECT '{w}' AS word" for w in (*lex.STOP_WORDS, *lex.SLANG_STOP_WORDS))


@query(
    "token_top_stop_table",
    f"{q.ANNOTATED}, s AS ({_STOP_TABLE}) SELECT token, n FROM {q.counts_of(PLAIN, 'annotated')} "
    f"WHERE token NOT IN (SELECT word FROM s WHERE word NOT IN ({NEG})) ORDER BY n DESC, token LIMIT 20",
)
def token_top_stop_table(spark, sf):
    """Stop words from a table: a list with additions, without the negations."""
    listed = lexical.stop_list(lex.STOP_WORDS, lex.SLANG_STOP_WORDS)
    table = spark.createDataFrame([(w,) for w in listed], "word string")
    counts = lexical.token_counts(fx.annotated(spark, sf), lexical.plain_words(text()))
    return lexical.top(lexical.without_stop_table(counts, table, "word"))


def _grams(n: int) -> str:
    parts = " || ' ' || ".join(f"t[i + {k}]" for k in range(n))
    return f"list_transform(range(1, CAST(len(t) AS BIGINT) - {n - 2}), lambda i: {parts})" if n > 1 else "t"


def _gram_counts(n: int, by: str = "", min_df: int = 2) -> str:
    lead = f"{by}, " if by else ""
    where = f"WHERE {by} IS NOT NULL" if by else ""
    return (
        f"t AS (SELECT {lead}doc_id, list_filter({VECTOR}, lambda w: w NOT IN ({STOP})) AS t FROM labelled {where}), "
        f"g AS (SELECT {lead}doc_id, unnest({_grams(n)}) AS term FROM t), "
        f"c AS (SELECT {lead}term, count(*) AS n, count(DISTINCT doc_id) AS df FROM g GROUP BY {lead}term HAVING count(DISTINCT doc_id) >= {min_df})"
    )


def _ngram_query(n: int):
    name = {1: "unigram_top", 2: "ngram_top", 3: "trigram_top"}[n]

    @query(name, f"{q.LABELLED}, {_gram_counts(n)} SELECT term, n, df FROM c ORDER BY n DESC, term LIMIT 20")
    def run(spark, sf):
        counts = lexical.ngram_counts(fx.annotated(spark, sf), lexical.vectorizer_words(text()), n, min_df=2)
        return lexical.top(counts, 20, "term")

    return run


for _n in (1, 2, 3):
    _ngram_query(_n)


@query(
    "ngram_top_by_class",
    f"{q.LABELLED}, {_gram_counts(2, 'toxicity_label', 1)}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY toxicity_label ORDER BY n DESC, term) AS INTEGER) AS rank FROM c) "
    "SELECT * FROM r WHERE rank <= 10",
)
def ngram_top_by_class(spark, sf):
    df = with_label(spark, sf).filter("toxicity_label is not null")
    counts = lexical.ngram_counts(df, lexical.vectorizer_words(text()), 2, by=["toxicity_label"])
    return lexical.top_by(counts, "toxicity_label", 10, "term")


@query("ngram_levels", f"{q.LABELLED}, {_gram_counts(3, min_df=3)} SELECT term, n, df FROM c")
def ngram_levels(spark, sf):
    return lexical.level_ngram_counts(fx.annotated(spark, sf), lexical.vectorizer_words(text()), 3, 3)


@query("ngram_levels_by_class", f"{q.LABELLED}, {_gram_counts(2, 'toxicity_label', 3)} SELECT toxicity_label, term, n, df FROM c")
def ngram_levels_by_class(spark, sf):
    df = with_label(spark, sf).filter("toxicity_label is not null")
    return lexical.level_ngram_counts(df, lexical.vectorizer_words(text()), 2, 3, by=["toxicity_label"])


_TFIDF = (
    f"t AS (SELECT doc_id, toxicity_label, unnest(list_filter({VECTOR}, lambda w: w NOT IN ({STOP}))) AS term FROM labelled), "
    "f AS (SELECT doc_id, toxicity_label, term, count(*) AS tf FROM t GROUP BY 1, 2, 3), n AS (SELECT count(*) AS n FROM labelled), "
    "v AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM f GROUP BY 1), "
    "k AS (SELECT term, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM v, n WHERE df >= 2 AND df <= 0.98 * n ORDER BY cf DESC, term LIMIT 30000), "
    "w AS (SELECT doc_id, toxicity_label, f.term, (1 + ln(tf)) * idf AS w FROM f JOIN k ON f.term = k.term), "
    "x AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w)"
)


def weights(df, carry=()):
    return lexical.tfidf_weights(df, "doc_id", lexical.vectorizer_words(text()), max_features=MAX_FEATURES, carry=carry)


@query(
    "tfidf_top",
    f"{q.LABELLED}, {_TFIDF} SELECT term, {q.r6('sum(weight) / (SELECT n FROM n)')} AS mean_tfidf FROM x GROUP BY term ORDER BY round(sum(weight) / (SELECT n FROM n), 12) DESC, term LIMIT 20",
)
def tfidf_top(spark, sf):
    df = fx.annotated(spark, sf)
    return lexical.top_weights(lexical.tfidf_mean(df, weights(df)), 20)


@query(
    "tfidf_top_by_class",
    f"{q.LABELLED}, {_TFIDF}, s AS (SELECT toxicity_label, term, sum(weight) AS s FROM x WHERE toxicity_label IS NOT NULL GROUP BY 1, 2), "
    "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY toxicity_label ORDER BY round(s, 9) DESC, term) AS INTEGER) AS rank FROM s), "
    "d AS (SELECT toxicity_label, count(*) AS docs FROM labelled GROUP BY 1) "
    f"SELECT r.toxicity_label, term, {q.r6('s / docs')} AS mean_tfidf, rank FROM r JOIN d ON r.toxicity_label = d.toxicity_label WHERE rank <= 15",
)
def tfidf_top_by_class(spark, sf):
    df = with_label(spark, sf)
    return lexical.tfidf_mean_by(df, weights(df, ["toxicity_label"]), "toxicity_label", 15)


@query("tfidf_shape", f"{q.LABELLED}, {_TFIDF} SELECT (SELECT n FROM n) AS documents, (SELECT count(*) FROM k) AS features")
def tfidf_shape(spark, sf):
    df = fx.annotated(spark, sf)
    terms = lexical.document_terms(df, "doc_id", lexical.vectorizer_words(text()), lex.STOP_WORDS)
    return lexical.tfidf_shape(df, lexical.tfidf_vocabulary(terms, df, 2, 0.98, MAX_FEATURES))


def cleaned(spark, sf):
    cased = fx.annotated(spark, sf).select("doc_id", cleaning.preprocess(text()).alias("cased"))
    return cased.withColumn("lowered", F.lower("cased"))


_CLEANED = (
    f"k AS (SELECT doc_id, {q.clean_cased('text', lex.SLANG_NORMAL)} AS cased, {q.clean_lower('text', lex.SLANG_NORMAL)} AS lowered FROM annotated), "
    f"a AS (SELECT unnest({q.words('cased')}) AS token FROM k), b AS (SELECT unnest({q.words('lowered')}) AS token FROM k)"
)


@query(
    "case_vocab",
    f"{q.ANNOTATED}, {_CLEANED}, r AS (SELECT (SELECT count(DISTINCT token) FROM a) AS cased_types, (SELECT count(DISTINCT token) FROM b) AS lower_types, "
    "(SELECT count(*) FROM a) AS cased_tokens, (SELECT count(*) FROM b) AS lower_tokens) "
    f"SELECT *, {q.r6('(cased_types - lower_types) * 100.0 / cased_types')} AS reduction_pct FROM r",
)
def case_vocab(spark, sf):
    return lexical.case_effect(cleaned(spark, sf), "cased", "lowered")


@query(
    "allcaps_types",
    f"{q.ANNOTATED}, {_CLEANED} SELECT token, count(*) AS n FROM a WHERE len(token) >= 3 AND regexp_matches(token, '\\p{{Lu}}') "
    "AND NOT regexp_matches(token, '[\\p{Ll}\\p{Lt}]') GROUP BY token",
)
def allcaps_types(spark, sf):
    return lexical.allcaps_types(cleaned(spark, sf), "cased")


# --- reports -----------------------------------------------------------------------------
@query(
    "signals_to_keep",
    f"{q.ANNOTATED} "
    + q.unpivot(
        report.SIGNAL_ELEMENTS,
        lambda e: f"SELECT '{e}' AS signal, count(*) FILTER (regexp_matches({q.filled('text')}, '{q.ELEMENTS[e]}')) AS n, "
        f"{q.r6(f'count(*) FILTER (regexp_matches({q.filled(chr(116) + chr(101) + chr(120) + chr(116))}, {chr(39)}{q.ELEMENTS[e]}{chr(39)})) * 100.0 / count(*)')} AS pct FROM annotated",
    )
    + f" UNION ALL SELECT 'negation: ' || token, n, NULL FROM {_PLAIN_COUNTS} WHERE token IN ({NEG})",
)
def signals_to_keep(spark, sf):
    return report.signals_to_keep(fx.annotated(spark, sf))


@query(
    "dominant_terms",
    f"{q.LABELLED}, {_gram_counts(2)}, w AS (SELECT token, n FROM {q.counts_of(PLAIN)} WHERE token NOT IN ({STOP}) AND len(token) > 1 ORDER BY n DESC, token LIMIT 5), "
    "b AS (SELECT term, n FROM c ORDER BY n DESC, term LIMIT 5) "
    "SELECT 'word' AS kind, token AS term, n FROM w UNION ALL SELECT 'bigram', term, n FROM b",
)
def dominant_terms(spark, sf):
    return report.dominant_terms(fx.annotated(spark, sf))


_MEASURES = (
    f"b AS (SELECT count(*)::DOUBLE AS rows, count(*) FILTER ({q.INVALID}) AS invalid, count(*) FILTER (toxicity_label = 0) AS n0, "
    f"count(*) FILTER (toxicity_label = 1) AS n1, max({WORDS}) AS max_words, "
    + ", ".join(f"quantile_cont({WORDS}, {m}) AS q{i}" for i, m in enumerate((0.25, 0.5, 0.75, 0.95, 0.99)))
    + ", "
    + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in ("text", "topic", "initial_paragraph", "toxicity_label"))
    + " AS missing, "
    + ", ".join(f"count(*) FILTER (regexp_matches({q.filled('text')}, '{pat}')) AS {e}" for e, pat in q.ELEMENTS.items())
    + " FROM labelled), "
    f"c AS (SELECT (SELECT sum(c - 1) FROM (SELECT count(*) AS c FROM labelled GROUP BY text)) AS excess_text, "
    f"(SELECT sum(c - 1) FROM (SELECT count(*) AS c FROM labelled GROUP BY {q.dup_key('text')})) AS excess_norm, "
    "(SELECT count(*) FROM (SELECT text FROM labelled WHERE text IS NOT NULL GROUP BY text HAVING count(DISTINCT toxicity_label) > 1)) AS conflicts), "
    f"v AS (SELECT sum(n) AS tokens, count(*) AS types, count(*) FILTER (n = 1) AS once, count(*) FILTER (n <= 5) AS at_most_5, "
    f"coalesce(sum(n) FILTER (token IN ({STOP})), 0) AS stop_tokens, coalesce(sum(n) FILTER (token IN ({NEG})), 0) AS negations, "
    f"count(*) FILTER (token IN ({q.quoted(lex.SLANG_FORMS)})) AS slang, count(*) FILTER ({_ELONGATED}) AS elongated FROM {q.counts_of(PLAIN)}), "
    "m AS (SELECT * FROM b, c, v)"
)
_RATIO = "CASE WHEN least(n0, n1) > 0 THEN greatest(n0, n1)::DOUBLE / least(n0, n1) END"
_FINDINGS = {
    "rows": "rows", "missing_values": "missing", "invalid_texts": "invalid", "excess_text_copies": "excess_text",
    "excess_normalised_copies": "excess_norm", "leakage_pct": "excess_norm * 100.0 / rows", "class_0_pct": "n0 * 100.0 / (n0 + n1)",
    "class_1_pct": "n1 * 100.0 / (n0 + n1)", "conflicting_texts": "conflicts", "class_ratio": _RATIO, "median_words": "q1",
    "q1_words": "q0", "q3_words": "q2", "max_words": "max_words", "types": "types", "tokens": "tokens",
    "lexical_diversity": "types::DOUBLE / tokens", "words_seen_once": "once", "words_seen_at_most_5": "at_most_5",
    "slang_forms": "slang", "elongated_words": "elongated", **{f"{e}_pct": f"{e} * 100.0 / rows" for e in q.ELEMENTS},
}
_RECOMMENDATIONS = {
    "invalid_texts": "invalid * 100.0 / rows", "lowercase": "allcaps * 100.0 / rows", "url": "url * 100.0 / rows",
    "mention": "mention * 100.0 / rows", "hashtag": "hashtag * 100.0 / rows", "emoji": "emoji * 100.0 / rows",
    "punctuation": "repeated_punctuation * 100.0 / rows", "whitespace": "newline * 100.0 / rows", "slang": "slang",
    "elongation": "elongated", "stop_words": "stop_tokens * 100.0 / tokens", "stemming": "NULL", "negation": "negations",
    "deduplication": "excess_norm", "conflicting_labels": "conflicts", "class_imbalance": _RATIO,
    "max_length_p95": "q3", "max_length_p99": "q4",
}


#: What decides a step whose decision depends on the data.
_DECISIVE = {"invalid_texts": "invalid", "url": "url", "mention": "mention", "slang": "slang", "deduplication": "excess_norm"}


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _decision(step: str) -> str:
    text = report.STEP_TEXTS[step][0]
    return _text(text) if isinstance(text, str) else f"CASE WHEN {_DECISIVE[step]} = 0 THEN {_text(text[1])} ELSE {_text(text[0])} END"


def _report_input(spark, sf):
    return with_label(spark, sf).select("doc_id", "text", "topic", "initial_paragraph", "toxicity_label")


@query(
    "report_findings",
    f"{q.LABELLED}, {_MEASURES} " + q.unpivot(_FINDINGS.items(), lambda e: f"SELECT '{e[0]}' AS finding, {q.r6(e[1])} AS value, {_text(report.FINDING_TEXTS[e[0]][0])} AS impact, {_text(report.FINDING_TEXTS[e[0]][1])} AS advice FROM m"),
)
def report_findings(spark, sf):
    return report.findings(_report_input(spark, sf), "toxicity_label", "text", "doc_id")


@query(
    "report_recommendations",
    f"{q.LABELLED}, {_MEASURES} " + q.unpivot(_RECOMMENDATIONS.items(), lambda e: f"SELECT '{e[0]}' AS step, {q.r6(e[1])} AS measure, {_decision(e[0])} AS recommendation, {_text(report.STEP_TEXTS[e[0]][1])} AS reason FROM m"),
)
def report_recommendations(spark, sf):
    return report.recommendations(_report_input(spark, sf), "toxicity_label", "text", "doc_id")

