"""Cleaning, profiling, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from annospark.functions import cleaning
from annospark.functions import lexicons as lex
from annospark.functions import patterns as p
from annospark.functions.lexicons import LABELS
from annospark.operators import dictionaries, lexical
from annospark.operators import labels as lab
from annospark.operators import profile, quality, sampling, stats
from annospark.plans import prepare
from annospark.sources import tables
from checks import fixtures as fx
from checks import sql as q
from checks.queries_labels import LABEL_COLUMNS, labelled
from checks.registry import query

def _text():
    return F.col("text")


# --- cleaning -------------------------------------------------------------------
@query("dup_key", f"{q.ANNOTATED} SELECT doc_id, {q.dup_key('text')} AS dup_key FROM annotated")
def dup_key(spark, sf):
    return fx.annotated(spark, sf).select("doc_id", cleaning.duplicate_key(_text()).alias("dup_key"))


@query("clean_basic", f"{q.ANNOTATED} SELECT doc_id, {q.mask_links('text')} AS cleaned FROM annotated")
def clean_basic(spark, sf):
    return fx.annotated(spark, sf).select("doc_id", cleaning.mask_links(_text()).alias("cleaned"))


@query("clean_punct", f"{q.ANNOTATED} SELECT doc_id, {q.cap_punct('text')} AS cleaned FROM annotated")
def clean_punct(spark, sf):
    return fx.annotated(spark, sf).select("doc_id", cleaning.cap_punctuation(_text()).alias("cleaned"))


EMOJI_ALIASES = {"😡": ":wajah_marah:", "😂": ":tertawa:"}


@query(
    "clean_emoji",
    f"{q.ANNOTATED} SELECT doc_id, replace(replace(text, '😡', ':wajah_marah:'), '😂', ':tertawa:') AS cleaned, text AS unchanged FROM annotated",
)
def clean_emoji(spark, sf):
    return fx.annotated(spark, sf).select(
        "doc_id",
        cleaning.describe_emoji(_text(), EMOJI_ALIASES).alias("cleaned"),
        cleaning.describe_emoji(_text()).alias("unchanged"),
    )


@query("clean_slang", f"{q.ANNOTATED} SELECT doc_id, {q.slang('text', lex.SLANG_NORMAL)} AS cleaned FROM annotated")
def clean_slang(spark, sf):
    return fx.annotated(spark, sf).select("doc_id", cleaning.normalise_slang(_text()).alias("cleaned"))


# Dictionaries that grow with the texts: every token of six characters or more is cut to four, every emoji has a name.
_SLANG_TABLE = (
    "slang AS (SELECT t AS word, substr(t, 1, 4) AS replacement FROM "
    "(SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS t FROM documents) WHERE length(t) >= 6)"
)
_ALIAS_TABLE = (
    f"alias AS (SELECT e AS word, ':' || substr(md5(e), 1, 6) || ':' AS replacement FROM "
    f"(SELECT DISTINCT unnest(regexp_extract_all(text, '{q.EMOJI}')) AS e FROM annotated))"
)


def _translated_sql(table: str, pieces: str, key: str, separator: str) -> str:
    return (
        f"x AS (SELECT doc_id, unnest({pieces}) AS w, generate_subscripts({pieces}, 1) AS i FROM annotated WHERE text IS NOT NULL), "
        f"j AS (SELECT doc_id, string_agg(coalesce(replacement, w), '{separator}' ORDER BY i) AS t FROM x LEFT JOIN {table} ON {key} = word GROUP BY doc_id) "
        "SELECT a.doc_id, coalesce(t, text) AS cleaned FROM annotated a LEFT JOIN j ON a.doc_id = j.doc_id"
    )


def _slang_table(spark, sf):
    words = fx.documents(spark, sf).select(F.explode(F.split(F.lower("text"), " ", -1)).alias("word")).distinct()
    return words.where(F.length("word") >= 6).withColumn("replacement", F.substring("word", 1, 4))


@query("clean_slang_table", f"{q.ANNOTATED}, {_SLANG_TABLE}, " + _translated_sql("slang", "string_split(text, ' ')", "lower(w)", " "))
def clean_slang_table(spark, sf):
    df = fx.annotated(spark, sf).select("doc_id", "text")
    return dictionaries.normalise_slang(df, "doc_id", "text", _slang_table(spark, sf)).select("doc_id", "cleaned")


@query(
    "clean_emoji_table",
    f"{q.ANNOTATED}, {_ALIAS_TABLE}, "
    + _translated_sql("alias", f"regexp_extract_all(text, '{q.EMOJI}|{q.EMOJI.replace('[', '[^')}+')", "w", ""),
)
def clean_emoji_table(spark, sf):
    df = fx.annotated(spark, sf).select("doc_id", "text")
    found = df.select(F.explode(F.regexp_extract_all("text", F.lit(p.EMOJI), F.lit(0))).alias("word")).distinct()
    aliases = found.withColumn("replacement", F.concat(F.lit(":"), F.substring(F.md5("word"), 1, 6), F.lit(":")))
    return dictionaries.describe_emoji(df, "doc_id", "text", aliases).select("doc_id", "cleaned")


@query(
    "slang_found_table",
    f"{q.ANNOTATED}, {_SLANG_TABLE}, c AS {q.counts_of(q.apostrophe_words('lower(' + q.filled('text') + ')'), 'annotated')} "
    "SELECT token, n, replacement AS normal_form FROM c JOIN slang ON token = word",
)
def slang_found_table(spark, sf):
    counts = lexical.token_counts(fx.annotated(spark, sf), lexical.raw_words(_text()))
    return dictionaries.slang_found(counts, _slang_table(spark, sf))


@query(
    "clean_full",
    f"{q.ANNOTATED} SELECT doc_id, {q.clean_cased('text', lex.SLANG_NORMAL)} AS text_clean_cased, "
    f"{q.clean_lower('text', lex.SLANG_NORMAL)} AS text_clean_lower FROM annotated",
)
def clean_full(spark, sf):
    return fx.annotated(spark, sf).select(
        "doc_id",
        cleaning.preprocess(_text()).alias("text_clean_cased"),
        cleaning.preprocess(_text(), lowercase=True).alias("text_clean_lower"),
    )


@query("clean_light", f"{q.ANNOTATED} SELECT doc_id, {q.light('text')} AS cleaned FROM annotated")
def clean_light(spark, sf):
    return fx.annotated(spark, sf).select("doc_id", cleaning.light_clean(_text()).alias("cleaned"))


_LOOSE = rf"http[^{q.S}]+|www[^{q.S}]+"


@query(
    "clean_links",
    f"{q.ANNOTATED} SELECT doc_id, {q.links_blank('text')} AS blanked, {q.links_blank('text', '')} AS removed, "
    f"{q.sub(q.sub("lower(coalesce(text, ''))", _LOOSE, ''), q.MENTION, '')} AS removed_loose FROM annotated",
)
def clean_links(spark, sf):
    return fx.annotated(spark, sf).select(
        "doc_id",
        cleaning.without_links(_text()).alias("blanked"),
        cleaning.without_links(_text(), "").alias("removed"),
        cleaning.without_links(_text(), "", p.URL_LOOSE).alias("removed_loose"),
    )


# A character is dropped when it equals both characters before it.
_SHRUNK = (
    "c AS (SELECT doc_id, unnest(string_split(t, '')) AS ch, generate_subscripts(string_split(t, ''), 1) AS i FROM m), "
    "d AS (SELECT doc_id, ch, i, lag(ch, 1) OVER w AS c1, lag(ch, 2) OVER w AS c2 FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY i)), "
    "s AS (SELECT doc_id, string_agg(ch, '' ORDER BY i) AS t FROM d WHERE ch = chr(10) OR c1 IS DISTINCT FROM ch OR c2 IS DISTINCT FROM ch GROUP BY doc_id)"
)


@query(
    "clean_minimal",
    f"{q.ANNOTATED}, m AS (SELECT doc_id, {q.sub(q.sub(q.filled('text'), q.URL, '[URL]'), q.MENTION, '[USER]')} AS t FROM annotated), "
    f"{_SHRUNK} SELECT m.doc_id, {q.collapse('coalesce(s.t, chr(32))')} AS cleaned FROM m LEFT JOIN s ON m.doc_id = s.doc_id",
)
def clean_minimal(spark, sf):
    return fx.annotated(spark, sf).select("doc_id", cleaning.minimal_clean(_text()).alias("cleaned"))


@query(
    "clean_heavy",
    f"{q.ANNOTATED} SELECT doc_id, array_to_string(list_filter({q.space_words(q.sub(f'lower({q.filled(chr(116) + chr(101) + chr(120) + chr(116))})', f'[^{q.W}{q.S}]|' + chr(92) + 'p{Nd}', ''))}, "
    f"lambda w: w NOT IN ({q.quoted(lex.STOP_WORDS)})), ' ') AS cleaned FROM annotated",
)
def clean_heavy(spark, sf):
    return fx.annotated(spark, sf).select("doc_id", cleaning.heavy_clean(_text()).alias("cleaned"))


@query("text_preview", f"{q.ANNOTATED} SELECT doc_id, substr(text, 1, 300) AS preview FROM annotated")
def text_preview(spark, sf):
    return fx.annotated(spark, sf).select("doc_id", cleaning.preview(_text()).alias("preview"))


@query(
    "clean_before_after",
    f"{q.ANNOTATED} SELECT doc_id, text AS before, {q.cap_punct('text')} AS after FROM annotated "
    f"WHERE regexp_matches({q.filled('text')}, '{q.REPEATED}') ORDER BY md5(CAST(doc_id AS VARCHAR) || '#1'), doc_id LIMIT 5",
)
def clean_before_after(spark, sf):
    df = fx.annotated(spark, sf).filter(p.has(p.filled(_text()), p.REPEATED_PUNCTUATION))
    return sampling.before_after(df, "text", cleaning.cap_punctuation(_text()), 5, "doc_id", seed=1)


# --- profiling --------------------------------------------------------------------
ANNOTATED_COLUMNS = ["text_id", "doc_id", "topic", "text", "initial_paragraph", "annotators_id", *LABELS]


@query(
    "schema_profile",
    f"{q.ANNOTATED} "
    + q.unpivot(
        list(enumerate(ANNOTATED_COLUMNS)),
        lambda e: f"SELECT {e[0]} AS position, '{e[1]}' AS \"column\", '{'bigint' if e[1] == 'doc_id' else 'string'}' AS dtype, "
        f"count(*) AS rows, count({e[1]}) AS non_null FROM annotated",
    ),
)
def schema_profile(spark, sf):
    return profile.schema_profile(fx.annotated(spark, sf))


@query(
    "head_tail",
    f"{q.ANNOTATED} SELECT * FROM (SELECT 'head' AS part, doc_id, topic, toxicity FROM annotated ORDER BY doc_id LIMIT 5) UNION ALL "
    "SELECT * FROM (SELECT 'tail' AS part, doc_id, topic, toxicity FROM annotated ORDER BY doc_id DESC LIMIT 5)",
)
def head_tail(spark, sf):
    df = fx.annotated(spark, sf).select("doc_id", "topic", "toxicity")
    head = profile.head(df, "doc_id").select(F.lit("head").alias("part"), "*")
    tail = profile.tail(df, "doc_id").select(F.lit("tail").alias("part"), "*")
    return sampling.union_all(head, tail)


@query(
    "missing_table",
    f"{q.ANNOTATED} "
    + q.unpivot(
        ANNOTATED_COLUMNS,
        lambda c: f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing, "
        f"{q.r6(f'count(*) FILTER ({c} IS NULL) * 100.0 / count(*)')} AS pct FROM annotated",
    ),
)
def missing_table(spark, sf):
    return profile.missing_table(fx.annotated(spark, sf))


@query(
    "missing_only",
    f"{q.ANNOTATED} SELECT * FROM ("
    + q.unpivot(
        ANNOTATED_COLUMNS,
        lambda c: f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing, "
        f"{q.r6(f'count(*) FILTER ({c} IS NULL) * 100.0 / count(*)')} AS pct FROM annotated",
    )
    + ") WHERE missing > 0",
)
def missing_only(spark, sf):
    return profile.missing_table(fx.annotated(spark, sf), only_missing=True)


_LENGTHS = {
    "chars": f"len({q.filled('text')})",
    "words": q.n_words("text"),
    "sentences": rf"len(regexp_extract_all({q.filled('text')}, '[^.!?]*[^.!?{q.S}][^.!?]*'))",
}


def _describe(c: str, marks) -> str:
    quantiles = ", ".join(f"{q.r6(f'quantile_cont(x, {m})')} AS p{m * 100:g}" for m in marks)
    return (
        f"SELECT '{c}' AS \"column\", count(x) AS count, {q.r6('avg(x)')} AS mean, {q.r6('stddev_samp(x)')} AS std, "
        f"CAST(min(x) AS DOUBLE) AS min, {quantiles}, CAST(max(x) AS DOUBLE) AS max "
        f"FROM (SELECT CAST({_LENGTHS[c]} AS DOUBLE) AS x FROM annotated)"
    )


MARKS = (0.25, 0.5, 0.75, 0.95, 0.99)


@query("describe_lengths", f"{q.ANNOTATED} {q.unpivot(_LENGTHS, lambda c: _describe(c, MARKS))}")
def describe_lengths(spark, sf):
    df = stats.with_lengths(fx.annotated(spark, sf).select("text"))
    return profile.describe_numeric(df, ["chars", "words", "sentences"], MARKS)


@query(
    "describe_columns",
    f"{q.ANNOTATED} "
    + q.unpivot(
        ["topic", "text", "toxicity", "initial_paragraph"],
        lambda c: f"SELECT '{c}' AS \"column\", (SELECT count({c}) FROM annotated) AS count, (SELECT count(DISTINCT {c}) FROM annotated) AS \"unique\", "
        f"top, freq FROM (SELECT {c} AS top, count(*) AS freq FROM annotated WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, min(doc_id) LIMIT 1)",
    ),
)
def describe_columns(spark, sf):
    return profile.describe_columns(
        fx.annotated(spark, sf), ["topic", "text", "toxicity", "initial_paragraph"], "doc_id"
    )


@query(
    "column_roles",
    "SELECT CASE WHEN (SELECT avg(len(text)) FROM documents) > 20 THEN 'text' END AS text_column, '' AS label_columns, CAST(NULL AS VARCHAR) AS main_label",
)
def column_roles(spark, sf):
    """No column has the expected name here, so the mean lengths decide."""
    found = profile.column_roles(fx.table(spark, sf, "documents"), text="body")
    return found


@query(
    "time_columns",
    "SELECT 'o_orderdate' AS \"column\", avg(CASE WHEN o_orderdate IS NOT NULL THEN 1.0 ELSE 0.0 END) AS parse_rate, TRUE AS is_time FROM orders",
)
def time_columns(spark, sf):
    return profile.time_columns(fx.table(spark, sf, "orders"))


@query(
    "duplicate_rows",
    f"{q.ANNOTATED} SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT topic, text, toxicity FROM annotated)) AS distinct_rows, "
    "count(*) - (SELECT count(*) FROM (SELECT DISTINCT topic, text, toxicity FROM annotated)) AS duplicate_rows FROM annotated",
)
def duplicate_rows(spark, sf):
    return profile.duplicate_rows(fx.annotated(spark, sf).select("topic", "text", "toxicity"))


#: Events with times that differ by microseconds.
_MICROS = "SELECT event_id, event_type, date_trunc('hour', ts) + to_microseconds(event_id % 5) AS t FROM events"


def micro_events(spark, sf):
    hour = F.unix_micros(F.date_trunc("hour", F.col("ts").cast("timestamp")))
    return fx.table(spark, sf, "events").select("event_id", "event_type", F.timestamp_micros(hour + F.col("event_id") % 5).alias("t"))


@query(
    "duplicate_event_rows",
    f"WITH e AS ({_MICROS}), d AS (SELECT DISTINCT event_type, t FROM e) SELECT (SELECT count(*) FROM e) AS rows, "
    "(SELECT count(*) FROM d) AS distinct_rows, (SELECT count(*) FROM e) - (SELECT count(*) FROM d) AS duplicate_rows",
)
def duplicate_event_rows(spark, sf):
    return profile.duplicate_rows(micro_events(spark, sf).drop("event_id"))


# --- quality ------------------------------------------------------------------------
@query(
    "text_validity",
    f"{q.ANNOTATED} "
    + q.unpivot(
        [*q.INVALID_PARTS.items(), ("invalid", q.INVALID)],
        lambda e: f"SELECT '{e[0]}' AS kind, count(*) FILTER ({e[1]}) AS n, {q.r6(f'count(*) FILTER ({e[1]}) * 100.0 / count(*)')} AS pct FROM annotated",
    ),
)
def text_validity(spark, sf):
    return quality.text_validity(fx.annotated(spark, sf))


@query("drop_invalid", f"{q.ANNOTATED} SELECT doc_id, text FROM annotated WHERE {q.VALID}")
def drop_invalid(spark, sf):
    return quality.drop_invalid(fx.annotated(spark, sf)).select("doc_id", "text")


@query(
    "drop_unlabelled",
    "SELECT d.doc_id, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic IS NOT NULL",
)
def drop_unlabelled(spark, sf):
    docs = fx.table(spark, sf, "documents").join(fx.table(spark, sf, "labels"), "doc_id", "left")
    return quality.drop_unlabelled(docs, "toxic").select("doc_id", "toxic")


def _excess(expr: str) -> str:
    return f"(SELECT count(*) - count(DISTINCT ({expr},)) FROM a)"


@query(
    "dup_summary",
    f"{q.ANNOTATED}, a AS (SELECT topic, text, toxicity FROM annotated), n AS (SELECT count(*) AS n FROM a), "
    "g AS (SELECT count(*) AS c FROM a GROUP BY text), k AS (SELECT count(*) AS c FROM a GROUP BY "
    f"{q.dup_key('text')}), r AS (SELECT count(*) AS c FROM a GROUP BY topic, text, toxicity), "
    "u AS (SELECT 'duplicate_rows' AS metric, CAST((SELECT sum(c - 1) FROM r) AS BIGINT) AS v UNION ALL "
    "SELECT 'rows_in_duplicate_texts', CAST((SELECT coalesce(sum(c), 0) FROM g WHERE c > 1) AS BIGINT) UNION ALL "
    "SELECT 'excess_text_copies', CAST((SELECT sum(c - 1) FROM g) AS BIGINT) UNION ALL "
    "SELECT 'excess_normalised_copies', CAST((SELECT sum(c - 1) FROM k) AS BIGINT)) "
    f"SELECT metric, v AS n, {q.r6('v * 100.0 / (SELECT n FROM n)')} AS pct FROM u",
)
def dup_summary(spark, sf):
    return quality.duplicate_summary(fx.annotated(spark, sf).select("topic", "text", "toxicity"))


@query(
    "dup_examples",
    f"{q.ANNOTATED} SELECT doc_id, text, toxicity FROM annotated WHERE text IN "
    "(SELECT text FROM annotated WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1) ORDER BY text, doc_id LIMIT 12",
)
def dup_examples(spark, sf):
    return quality.duplicate_examples(fx.annotated(spark, sf), "text", "doc_id", ["text", "toxicity"])


_CONFLICT = (
    "k AS (SELECT text, count(*) AS rows, min(toxicity_label) AS lowest, max(toxicity_label) AS highest FROM labelled "
    "WHERE text IS NOT NULL AND toxicity_label IS NOT NULL GROUP BY text HAVING count(DISTINCT toxicity_label) > 1)"
)


@query("conflict_keys", f"{q.LABELLED}, {_CONFLICT} SELECT text, rows, lowest, highest FROM k")
def conflict_keys(spark, sf):
    df = lab.with_labels(fx.annotated(spark, sf), ["toxicity"])
    return quality.conflict_keys(df, "text", "toxicity_label", "doc_id")


@query(
    "conflict_rows",
    f"{q.LABELLED}, {_CONFLICT} SELECT doc_id, text, toxicity_label FROM labelled WHERE text IN (SELECT text FROM k)",
)
def conflict_rows(spark, sf):
    df = lab.with_labels(fx.annotated(spark, sf), ["toxicity"])
    return quality.conflict_rows(df, "text", "toxicity_label", "doc_id").select("doc_id", "text", "toxicity_label")


@query(
    "dedup_first",
    f"{q.ANNOTATED}, k AS (SELECT min(doc_id) AS doc_id FROM annotated GROUP BY {q.dup_key('text')}) "
    "SELECT a.doc_id, a.text, a.toxicity FROM annotated a JOIN k ON a.doc_id = k.doc_id",
)
def dedup_first(spark, sf):
    df = fx.annotated(spark, sf).select("doc_id", "text", "toxicity")
    return lab.first_per_key(df, cleaning.duplicate_key(_text()), "doc_id")


@query(
    "agreement_quality",
    f"{q.LABELLED} SELECT {q.AGREEMENT} AS agreement_group, count(*) AS rows, count(*) FILTER (text IS NULL) AS missing_texts, "
    f"count(*) FILTER (len({q.space_words(q.filled('text'))}) <= 3) AS short_texts, "
    "count(*) - count(DISTINCT text) - CASE WHEN count(*) FILTER (text IS NULL) > 0 THEN 1 ELSE 0 END AS duplicate_texts "
    "FROM labelled GROUP BY 1",
)
def agreement_quality(spark, sf):
    return quality.quality_by_group(lab.with_agreement(fx.annotated(spark, sf)), "agreement_group")


@query(
    "length_extremes",
    f"{q.ANNOTATED}, w AS (SELECT len({q.space_words(q.filled('text'))}) AS w FROM annotated) "
    f"SELECT 'very_short' AS kind, count(*) FILTER (w <= 3) AS n, {q.r6('count(*) FILTER (w <= 3) * 100.0 / count(*)')} AS pct FROM w UNION ALL "
    f"SELECT 'very_long', count(*) FILTER (w >= 200), {q.r6('count(*) FILTER (w >= 200) * 100.0 / count(*)')} FROM w",
)
def length_extremes(spark, sf):
    return quality.length_extremes(fx.annotated(spark, sf), p.space_word_count(p.filled(_text())))


@query(
    "length_filters",
    f"{q.ANNOTATED}, w AS (SELECT doc_id, len({q.space_words(q.filled('text'))}) AS w FROM annotated) "
    "SELECT 'short' AS kind, doc_id FROM w WHERE w <= 3 UNION ALL SELECT 'long', doc_id FROM w WHERE w >= 200",
)
def length_filters(spark, sf):
    df, words = fx.annotated(spark, sf), p.space_word_count(p.filled(_text()))
    short = quality.very_short(df, words).select(F.lit("short").alias("kind"), "doc_id")
    return short.unionByName(quality.very_long(df, words).select(F.lit("long").alias("kind"), "doc_id"))


@query(
    "length_outliers",
    f"{q.ANNOTATED}, w AS (SELECT doc_id, {q.n_words('text')} AS words FROM annotated), "
    "b AS (SELECT quantile_cont(words, 0.75) + 1.5 * (quantile_cont(words, 0.75) - quantile_cont(words, 0.25)) AS b FROM w) "
    f"SELECT doc_id, CAST(words AS INTEGER) AS words, {q.r6('b')} AS upper_bound FROM w, b WHERE words > b",
)
def length_outliers(spark, sf):
    df = stats.with_lengths(fx.annotated(spark, sf)).select("doc_id", "words")
    return quality.iqr_outliers(df, "words")


def _element(e) -> str:
    flag = f"regexp_matches({q.filled('text')}, '{e[1]}')"
    return (
        f"SELECT '{e[0]}' AS element, count(*) FILTER ({flag}) AS documents, "
        f"{q.r6(f'count(*) FILTER ({flag}) * 100.0 / count(*)')} AS pct FROM annotated"
    )


@query("element_prevalence", f"{q.ANNOTATED} {q.unpivot(q.ELEMENTS.items(), _element)}")
def element_prevalence(spark, sf):
    return quality.element_prevalence(fx.annotated(spark, sf))


@query(
    "element_advice",
    f"{q.ANNOTATED}, e AS ({q.unpivot(q.ELEMENTS.items(), _element)}) SELECT *, {q.case_map('element', lex.ELEMENT_ADVICE)} AS advice FROM e",
)
def element_advice(spark, sf):
    return quality.with_advice(quality.element_prevalence(fx.annotated(spark, sf)))


# --- sources and sinks ----------------------------------------------------------------
def _null_words(c: str) -> str:
    words = ", ".join(f"'{w}'" for w in lex.NULL_WORDS)
    return f"CASE WHEN {c} IN ({words}) THEN NULL ELSE {c} END AS {c}"


@query(
    "csv_annotated",
    f"{q.ANNOTATED} SELECT {', '.join(_null_words(c) for c in ('text_id', 'annotators_id', 'text', 'initial_paragraph', 'topic', *LABELS))} FROM annotated",
)
def csv_annotated(spark, sf):
    path = tables.scratch_path(spark, "annotated-csv")
    tables.write_csv(fx.annotated(spark, sf).select([f.name for f in tables.ANNOTATED.fields]), path)
    return tables.read_annotated(spark, path, row_pos=None)


_SPACED = {"education": "pendidikan terakhir", "job": "status pekerjaan", "vote_leaning": "president vote leaning"}


def _spaced(spark, sf):
    return fx.annotators(spark, sf).withColumnsRenamed(_SPACED).select([f.name for f in tables.ANNOTATORS.fields])


_SPACED_SQL = 'education AS "pendidikan terakhir", job AS "status pekerjaan", vote_leaning AS "president vote leaning"'


_PART = "CASE WHEN doc_id % 10 = 0 THEN 0 WHEN doc_id % 10 < 4 THEN 1 ELSE 2 END"


@query(
    "csv_first_row",
    f"{q.ANNOTATED} SELECT text_id, row_number() OVER (ORDER BY {_PART}, doc_id) - 1 AS row_pos FROM annotated",
)
def csv_first_row(spark, sf):
    """Positions over files of unequal size, the smallest first."""
    path = tables.scratch_path(spark, "annotated-parts")
    rows = fx.annotated(spark, sf).withColumn("part", F.expr(_PART))
    # A part has as many files as its rows need; their names are in the order of the ranges.
    rows = rows.repartitionByRange("part", "doc_id").sortWithinPartitions("part", "doc_id")
    tables.write_csv(rows.select("part", *[f.name for f in tables.ANNOTATED.fields]), path, ["part"])
    return tables.read_annotated(spark, path).select("text_id", "row_pos")


@query(
    "csv_annotators",
    f"{q.ANNOTATORS} SELECT annotator_id, ethnicity, religion, gender, age, domisili, education AS \"pendidikan terakhir\", "
    "job AS \"status pekerjaan\", CASE WHEN vote_leaning = '' THEN NULL ELSE vote_leaning END AS \"president vote leaning\", disability, lgbt FROM annotators",
)
def csv_annotators(spark, sf):
    path = tables.scratch_path(spark, "annotators-csv")
    tables.write_csv(_spaced(spark, sf), path)
    return tables.read_annotators(spark, path)


@query(
    "json_annotators",
    f"{q.ANNOTATORS} SELECT annotator_id, ethnicity, religion, gender, age, domisili, {_SPACED_SQL}, disability, lgbt FROM annotators",
)
def json_annotators(spark, sf):
    path = tables.scratch_path(spark, "annotators-json")
    _spaced(spark, sf).write.json(path)
    return tables.read_annotators_json(spark, path)


@query(
    "interim_export",
    f"{q.LABELLED} SELECT text_id, text, initial_paragraph, topic, {', '.join(LABEL_COLUMNS)}, "
    f"CAST(len({q.filled('text')}) AS INTEGER) AS char_count, CAST(len({q.space_words(q.filled('text'))}) AS INTEGER) AS word_count, "
    "CAST(num_annotators AS INTEGER) AS num_annotators FROM labelled",
)
def interim_export(spark, sf):
    df = labelled(spark, sf).withColumns(
        {"char_count": p.char_count(p.filled(_text())), "word_count": p.space_word_count(p.filled(_text()))}
    )
    path = tables.scratch_path(spark, "interim")
    tables.write_table(tables.interim(df), path)
    return spark.read.parquet(path)


_UNIQUE = (
    f"v AS (SELECT doc_id, text, toxicity_label, {q.dup_key('text')} AS k FROM labelled WHERE {q.VALID}), "
    "c AS (SELECT k, toxicity_label AS y, count(*) AS n FROM v WHERE toxicity_label IS NOT NULL GROUP BY 1, 2), "
    "m AS (SELECT k, y FROM (SELECT k, y, row_number() OVER (PARTITION BY k ORDER BY n DESC, y) AS r FROM c) WHERE r = 1), "
    "f AS (SELECT k, min(doc_id) AS doc_id FROM v GROUP BY k), "
    "u AS (SELECT v.doc_id, v.text, m.y FROM f JOIN v ON f.doc_id = v.doc_id JOIN m ON f.k = m.k)"
)


def quota_sql(source: str, cls: str, fraction: str) -> str:
    """``quota(c, q)``: exact largest-remainder quotas of one part."""
    return (
        f"z AS (SELECT {cls} AS c, count(*) AS n FROM {source} GROUP BY 1), "
        f"t AS (SELECT c, n, CAST(sum(n) OVER () AS BIGINT) AS total, CAST(ceil(CAST(sum(n) OVER () AS BIGINT) * {fraction}) AS BIGINT) AS target FROM z), "
        "p AS (SELECT c, n, target * n // total AS base, target * n % total AS rest, target FROM t), "
        "quota AS (SELECT c, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= target - sum(base) OVER () THEN 1 ELSE 0 END AS q FROM p)"
    )


@query(
    "prepared_texts",
    f"{q.LABELLED}, {_UNIQUE}, {quota_sql('u', 'y', '0.2')}, "
    "r AS (SELECT u.*, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(doc_id AS VARCHAR) || '#42')) AS rk FROM u) "
    f"SELECT doc_id, text, {q.clean_cased('text', lex.SLANG_NORMAL)} AS text_clean_cased, {q.clean_lower('text', lex.SLANG_NORMAL)} AS text_clean_lower, "
    "y AS toxicity_label, CASE WHEN rk <= q THEN 'test' ELSE 'train' END AS split FROM r JOIN quota ON r.y = quota.c",
)
def prepared_texts(spark, sf):
    return prepare.prepare(fx.annotated(spark, sf), "doc_id")


@query(
    "split_export",
    f"{q.LABELLED}, {_UNIQUE}, {quota_sql('u', 'y', '0.2')}, "
    "r AS (SELECT u.*, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(doc_id AS VARCHAR) || '#42')) AS rk FROM u) "
    "SELECT CASE WHEN rk <= q THEN 'test' ELSE 'train' END AS split, y AS toxicity_label, count(*) AS n FROM r JOIN quota ON r.y = quota.c GROUP BY 1, 2",
)
def split_export(spark, sf):
    path = tables.scratch_path(spark, "split-csv")
    tables.write_split(prepare.prepare(fx.annotated(spark, sf), "doc_id"), path, fmt="csv")
    back = spark.read.options(header="true", multiLine="true", quote='"', escape='"').csv(path)
    return back.groupBy("split", F.col("toxicity_label").cast("double").alias("toxicity_label")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "step_log",
    f"{q.LABELLED}, v AS (SELECT {q.dup_key('text')} AS k, toxicity_label FROM labelled WHERE {q.VALID}), "
    "n AS (SELECT (SELECT count(*) FROM labelled) AS a, (SELECT count(*) FROM v) AS b, (SELECT count(DISTINCT k) FROM v) AS c, "
    "(SELECT count(DISTINCT k) FROM v WHERE toxicity_label IS NOT NULL) AS d) "
    "SELECT 'drop_invalid' AS step, a AS before, b AS after, a - b AS dropped, 0::BIGINT AS changed FROM n UNION ALL "
    "SELECT 'resolve_conflicts', b, b, 0, (SELECT count(*) FROM v LEFT JOIN (SELECT k, arg_min(toxicity_label, (-c, toxicity_label)) AS m FROM "
    "(SELECT k, toxicity_label, count(*) AS c FROM v WHERE toxicity_label IS NOT NULL GROUP BY ALL) GROUP BY k) w ON v.k = w.k "
    "WHERE v.toxicity_label IS DISTINCT FROM w.m OR w.m IS NULL) FROM n UNION ALL "
    "SELECT 'deduplicate', b, c, b - c, 0 FROM n UNION ALL SELECT 'drop_unlabelled', c, d, c - d, 0 FROM n",
)
def step_log(spark, sf):
    return prepare.step_log(fx.annotated(spark, sf), "doc_id")
