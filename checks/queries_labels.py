"""Votes, consensus, annotators, prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from annospark.functions import cleaning, prompts
from annospark.functions import lexicons as lex
from annospark.functions import votes as v
from annospark.functions.lexicons import LABELS
from annospark.operators import annotators as ann
from annospark.operators import labels as lab
from annospark.operators import sampling, stats
from checks import fixtures as fx
from checks import sql as q
from checks.registry import query

LABEL_COLUMNS = [f"{c}_label" for c in LABELS]
ATTRIBUTES = ["ethnicity", "religion", "disability", "lgbt", "gender", "age_group", "domisili",
              "pendidikan terakhir", "status pekerjaan", "president vote leaning"]
COLUMNS = {"pendidikan terakhir": "education", "status pekerjaan": "job", "president vote leaning": "vote_leaning"}


def labelled(spark, sf):
    return lab.with_annotator_count(lab.with_labels(fx.annotated(spark, sf)))


@query(
    "label_parse",
    f"{q.LABELLED} SELECT doc_id, "
    f"array_to_string({q.votes('toxicity')}, ',') AS toxicity_votes, "
    f"array_to_string({q.votes('polarized')}, ',') AS polarized_votes, "
    f"array_to_string({q.ids('annotators_id')}, ',') AS annotators FROM labelled",
)
def label_parse(spark, sf):
    def shown(c):
        return F.array_join(c.cast("array<string>"), ",")

    return fx.annotated(spark, sf).select(
        "doc_id",
        shown(v.parse_votes(F.col("toxicity"))).alias("toxicity_votes"),
        shown(v.parse_votes(F.col("polarized"))).alias("polarized_votes"),
        shown(v.parse_ids(F.col("annotators_id"))).alias("annotators"),
    )


@query("label_vote", f"{q.LABELLED} SELECT doc_id, {', '.join(LABEL_COLUMNS)} FROM labelled")
def label_vote(spark, sf):
    return labelled(spark, sf).select("doc_id", *LABEL_COLUMNS)


def _stats_entry(c: str) -> str:
    return (
        f"SELECT '{c}_label' AS label, n0, n1, n_tie, {q.r6('n0 * 100.0 / n')} AS pct0, {q.r6('n1 * 100.0 / n')} AS pct1, "
        f"{q.r6('n_tie * 100.0 / n')} AS pct_tie, "
        "CASE WHEN n1 > 0 THEN '1 : ' || CAST(CAST(round_even(n0::DOUBLE / n1, 0) AS BIGINT) AS VARCHAR) ELSE 'N/A' END AS ratio "
        f"FROM (SELECT count(*) AS n, count(*) FILTER ({c}_label = 0) AS n0, count(*) FILTER ({c}_label = 1) AS n1, "
        f"count(*) FILTER ({c}_label = 0.5) AS n_tie FROM labelled)"
    )


@query("label_stats", f"{q.LABELLED} {q.unpivot(LABELS, _stats_entry)}")
def label_stats(spark, sf):
    return stats.label_stats(labelled(spark, sf), LABEL_COLUMNS)


@query(
    "label_positives",
    f"{q.LABELLED} "
    + q.unpivot(
        LABELS,
        lambda c: f"SELECT '{c}_label' AS label, count(*) FILTER ({c}_label = 1) AS n1, "
        f"{q.r6(f'count(*) FILTER ({c}_label = 1) * 100.0 / count(*)')} AS pct FROM labelled",
    ),
)
def label_positives(spark, sf):
    return stats.positives(labelled(spark, sf), LABEL_COLUMNS)


@query(
    "label_distribution",
    f"{q.LABELLED} SELECT toxicity_label, count(*) AS n, {q.r6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct "
    "FROM labelled GROUP BY 1",
)
def label_distribution(spark, sf):
    return stats.value_counts(labelled(spark, sf), "toxicity_label", dropna=False)


@query(
    "label_imbalance",
    f"{q.LABELLED}, c AS (SELECT count(*) FILTER (toxicity_label = 0) AS n0, count(*) FILTER (toxicity_label = 1) AS n1 FROM labelled), "
    "r AS (SELECT greatest(n0, n1) AS majority, least(n0, n1) AS minority, "
    "CASE WHEN least(n0, n1) > 0 THEN greatest(n0, n1)::DOUBLE / least(n0, n1) END AS ratio FROM c) "
    f"SELECT majority, minority, {q.r6('ratio')} AS ratio, CASE WHEN ratio < 1.5 THEN 'balanced' WHEN ratio < 3 THEN 'slightly imbalanced' ELSE 'imbalanced' END AS status FROM r",
)
def label_imbalance(spark, sf):
    return stats.imbalance(labelled(spark, sf), "toxicity_label")


@query(
    "annotator_count_dist",
    f"{q.LABELLED} SELECT CAST(num_annotators AS INTEGER) AS num_annotators, count(*) AS n, "
    f"{q.r6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM labelled GROUP BY 1",
)
def annotator_count_dist(spark, sf):
    return stats.value_counts(labelled(spark, sf), "num_annotators")


@query(
    "annotator_count_range",
    f'{q.LABELLED} SELECT CAST(min(num_annotators) AS INTEGER) AS "min", CAST(max(num_annotators) AS INTEGER) AS "max" FROM labelled',
)
def annotator_count_range(spark, sf):
    return stats.value_range(labelled(spark, sf), "num_annotators")


@query(
    "annotator_tail_bucket",
    f"{q.LABELLED} SELECT CASE WHEN num_annotators > 2 THEN '>2' ELSE CAST(num_annotators AS VARCHAR) END AS bucket, count(*) AS n FROM labelled GROUP BY 1",
)
def annotator_tail_bucket(spark, sf):
    return stats.tail_bucket(labelled(spark, sf), "num_annotators", 2)


@query(
    "agreement_groups",
    f"{q.LABELLED} SELECT {q.AGREEMENT} AS agreement_group, count(*) AS n, "
    f"{q.r6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM labelled GROUP BY 1",
)
def agreement_groups(spark, sf):
    return stats.value_counts(lab.with_agreement(fx.annotated(spark, sf)), "agreement_group")


@query(
    "agreement_final_label",
    f"{q.LABELLED} SELECT doc_id, CASE WHEN toxicity_s * 2 > toxicity_n THEN 1 ELSE 0 END AS final_label "
    f"FROM labelled WHERE {q.AGREEMENT} = 'Tanpa Disagreement'",
)
def agreement_final_label(spark, sf):
    rows = lab.with_agreement(fx.annotated(spark, sf)).filter(F.col("agreement_group") == lex.NO_DISAGREEMENT)
    return rows.select("doc_id", v.final_label(v.parse_votes(F.col("toxicity"))).alias("final_label"))


@query(
    "polarized_value",
    f"{q.LABELLED} SELECT doc_id, {q.r6('polarized_s::DOUBLE / polarized_n')} AS agg, "
    "CASE WHEN polarized_s * 2 > polarized_n THEN 1 ELSE 0 END AS bin, "
    "CASE WHEN polarized_s * 2 >= polarized_n THEN 1 ELSE 0 END AS bin_ceil, "
    'CASE WHEN polarized_s > 0 THEN 1 ELSE 0 END AS any_value FROM labelled',
)
def polarized_value(spark, sf):
    df = lab.with_votes(fx.annotated(spark, sf), ["polarized"])
    votes = F.col("polarized_votes")
    names = {"agg": "agg", "bin": "bin", "bin-ceil": "bin_ceil", "any": "any_value"}
    return df.select("doc_id", *[v.polarized_value(votes, m).alias(n) for m, n in names.items()])


@query(
    "any_positive",
    f"{q.LABELLED} SELECT doc_id, CASE WHEN polarized_s > 0 THEN 1 ELSE 0 END AS any_label FROM labelled",
)
def any_positive(spark, sf):
    df = lab.with_votes(fx.annotated(spark, sf), ["polarized"])
    return df.select("doc_id", v.any_positive(F.col("polarized_votes")).alias("any_label"))


@query(
    "annotator_count_filter",
    f"{q.LABELLED} SELECT 'single' AS approach, doc_id FROM labelled WHERE num_annotators = 1 "
    "UNION ALL SELECT 'more' AS approach, doc_id FROM labelled WHERE num_annotators <> 1",
)
def annotator_count_filter(spark, sf):
    df = lab.with_annotator_count(fx.annotated(spark, sf))
    parts = [lab.by_annotator_count(df, a).select(F.lit(a).alias("approach"), "doc_id") for a in ("single", "more")]
    return sampling.union_all(*parts)


_GENERATION = "CASE WHEN age BETWEEN 12 AND 29 THEN 'Gen Z' WHEN age BETWEEN 30 AND 44 THEN 'Millenials' WHEN age BETWEEN 45 AND 59 THEN 'Gen X' END"
_DIM = (
    f"dim AS (SELECT annotator_id, ethnicity, religion, trim(gender) AS gender, age, domisili, education, "
    f"CASE WHEN job = 'Ibu Rumah Tangga' THEN 'Tidak Bekerja' ELSE job END AS job, "
    f"{q.case_map('vote_leaning', lex.CANDIDATES, chr(39) + 'Tidak ada' + chr(39))} AS vote_leaning, "
    f"disability, lgbt, {_GENERATION} AS age_group FROM annotators)"
)


def dimension(spark, sf):
    return ann.clean_dimension(fx.annotators(spark, sf), "job", "vote_leaning")


@query("annotator_dim_clean", f"{q.ANNOTATORS}, {_DIM} SELECT * FROM dim")
def annotator_dim_clean(spark, sf):
    return dimension(spark, sf)


_OWN = ", ".join(f"list_extract({q.votes(c)}, CAST(pos AS BIGINT)) AS {c}" for c in LABELS)
_EXPLODED = (
    f"{q.LABELLED}, {fx.annotators_cte()}, {_DIM}, "
    f"e AS (SELECT *, unnest({q.ids('annotators_id')}) AS annotator, generate_subscripts({q.ids('annotators_id')}, 1) AS pos FROM labelled), "
    f"x AS (SELECT e.doc_id, e.text_id, e.text, e.topic, CAST(pos - 1 AS INTEGER) AS text_id_index, d.annotator_id, "
    f"d.ethnicity, d.religion, d.gender, d.age_group, d.domisili, d.education, d.job, d.vote_leaning, d.disability, d.lgbt, {_OWN}, "
    f"{q.r6('polarized_s::DOUBLE / polarized_n')} AS polarized_mean "
    "FROM e JOIN dim d ON e.annotator = d.annotator_id)"
)


def exploded(spark, sf, **options):
    return ann.explode_annotations(fx.annotated(spark, sf), dimension(spark, sf), **options)


@query(
    "annotator_explode_align",
    f"{_EXPLODED} SELECT doc_id, text_id_index, annotator_id, age_group, gender, {', '.join(LABELS)} FROM x",
)
def annotator_explode_align(spark, sf):
    return exploded(spark, sf).select("doc_id", "text_id_index", "annotator_id", "age_group", "gender", *LABELS)


@query(
    "annotator_explode_spread",
    f"{_EXPLODED} SELECT doc_id, text_id_index, annotator_id, age_group, toxicity FROM x",
)
def annotator_explode_spread(spark, sf):
    """The same join with a dimension that the caller knows to be small."""
    return exploded(spark, sf, small=True, row_id="doc_id").select(
        "doc_id", "text_id_index", "annotator_id", "age_group", "toxicity"
    )


@query(
    "annotation_label",
    f"{_EXPLODED} SELECT doc_id, annotator_id, CAST(toxicity AS INTEGER) AS label, "
    "CAST(row_number() OVER (PARTITION BY text_id ORDER BY text_id_index) - 1 AS INTEGER) AS row_in_text FROM x",
)
def annotation_label(spark, sf):
    rows = ann.annotation_index(exploded(spark, sf))
    return rows.select("doc_id", "annotator_id", F.col("toxicity").cast("int").alias("label"), "row_in_text")


@query(
    "demographic_label_rate",
    f"{_EXPLODED} "
    + q.unpivot(
        ["ethnicity", "religion", "gender", "age_group", "education", "job", "vote_leaning", "disability", "lgbt"],
        lambda a: f"SELECT '{a}' AS attribute, {a} AS value, count(toxicity) AS annotations, CAST(sum(toxicity) AS BIGINT) AS positives, "
        f"{q.r6('avg(toxicity)')} AS rate FROM x GROUP BY {a}",
    ),
)
def demographic_label_rate(spark, sf):
    names = ["ethnicity", "religion", "gender", "age_group", "education", "job", "vote_leaning", "disability", "lgbt"]
    return ann.label_rate_by_attribute(exploded(spark, sf), names, "toxicity")


def _group_mode(key: str) -> str:
    return (
        f"c AS (SELECT {key} AS k, toxicity_label AS v, count(*) AS n FROM labelled WHERE toxicity_label IS NOT NULL GROUP BY 1, 2), "
        "m AS (SELECT k, v FROM (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY n DESC, v) AS r FROM c) WHERE r = 1)"
    )


@query(
    "label_resolve_mode",
    f"{q.LABELLED}, {_group_mode(q.dup_key('text'))} "
    f"SELECT l.doc_id, l.toxicity_label, m.v AS resolved, (l.toxicity_label IS NULL OR m.v IS NULL OR l.toxicity_label <> m.v) AS changed "
    f"FROM labelled l LEFT JOIN m ON {q.dup_key('l.text')} = m.k",
)
def label_resolve_mode(spark, sf):
    df = lab.with_labels(fx.annotated(spark, sf), ["toxicity"])
    out = lab.resolve_conflicts(df, cleaning.duplicate_key(F.col("text")), "toxicity_label", "doc_id")
    changed = lab.is_changed(F.col("toxicity_label"), F.col("resolved"))
    return out.select("doc_id", "toxicity_label", "resolved", changed.alias("changed"))


_POOL = ", ".join(
    f"CAST(sum({c}_n) AS BIGINT) AS {c}_pooled_votes, {q.majority(f'sum({c}_s)', f'sum({c}_n)')} AS {c}_label" for c in LABELS
)


@query(
    "pool_revote",
    f"{q.LABELLED} SELECT min(doc_id) AS doc_id, count(*) AS copies, {_POOL} FROM labelled GROUP BY {q.dup_key('text')}",
)
def pool_revote(spark, sf):
    return lab.pool_revote(fx.annotated(spark, sf), cleaning.duplicate_key(F.col("text")), "doc_id")


@query(
    "dedup_variants",
    f"{q.LABELLED}, f AS (SELECT min(doc_id) AS doc_id FROM labelled GROUP BY {q.dup_key('text')}), "
    f"p AS (SELECT min(doc_id) AS doc_id, {q.majority('sum(toxicity_s)', 'sum(toxicity_n)')} AS toxicity_label FROM labelled GROUP BY {q.dup_key('text')}) "
    "SELECT 'none' AS variant, doc_id, toxicity_label FROM labelled UNION ALL "
    "SELECT 'first', doc_id, toxicity_label FROM labelled WHERE doc_id IN (SELECT doc_id FROM f) UNION ALL "
    "SELECT 'pool', doc_id, toxicity_label FROM p",
)
def dedup_variants(spark, sf):
    df = fx.annotated(spark, sf)
    key = cleaning.duplicate_key(F.col("text"))
    return sampling.union_all(
        *[
            lab.deduplicate(df, name, key, "doc_id", ["toxicity"]).select(
                F.lit(name).alias("variant"), "doc_id", "toxicity_label"
            )
            for name in ("none", "first", "pool")
        ]
    )


_SPLIT = "CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END"


@query(
    "tie_strategies",
    f"{q.LABELLED}, s AS (SELECT doc_id, toxicity_label, {_SPLIT} AS split FROM labelled) "
    "SELECT 'drop' AS strategy, doc_id, 1.0::DOUBLE AS weight FROM s WHERE toxicity_label IS DISTINCT FROM 0.5 UNION ALL "
    "SELECT 'soft', doc_id, 1.0::DOUBLE FROM s WHERE toxicity_label IS DISTINCT FROM 0.5 OR split = 'train' UNION ALL "
    "SELECT 'weighted', doc_id, CASE WHEN toxicity_label = 0.5 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END FROM s WHERE toxicity_label IS DISTINCT FROM 0.5 OR split = 'train'",
)
def tie_strategies(spark, sf):
    df = labelled(spark, sf).withColumn("split", F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train"))
    return sampling.union_all(
        *[
            lab.tie_strategy(df, s, "toxicity_label").select(F.lit(s).alias("strategy"), "doc_id", "weight")
            for s in ("drop", "soft", "weighted")
        ]
    )


@query(
    "annotator_strategies",
    f"{q.LABELLED} SELECT 'equal' AS strategy, doc_id, 1.0::DOUBLE AS weight, 1 AS phase FROM labelled UNION ALL "
    "SELECT 'confidence', doc_id, CASE WHEN num_annotators >= 2 THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END, 1 FROM labelled UNION ALL "
    "SELECT 'curriculum', doc_id, 1.0::DOUBLE, CASE WHEN num_annotators >= 2 THEN 1 ELSE 2 END FROM labelled UNION ALL "
    "SELECT 'consensus', doc_id, 1.0::DOUBLE, 1 FROM labelled WHERE num_annotators >= 2",
)
def annotator_strategies(spark, sf):
    df = labelled(spark, sf)
    return sampling.union_all(
        *[
            lab.annotator_strategy(df, s).select(F.lit(s).alias("strategy"), "doc_id", "weight", "phase")
            for s in ("equal", "confidence", "curriculum", "consensus")
        ]
    )


@query(
    "unanimous_subset",
    f"{q.LABELLED} SELECT doc_id, toxicity FROM labelled WHERE toxicity_n >= 2 AND (toxicity_s = 0 OR toxicity_s = toxicity_n)",
)
def unanimous_subset(spark, sf):
    return lab.unanimous(fx.annotated(spark, sf)).select("doc_id", "toxicity")


@query(
    "class_weights",
    f"{q.LABELLED} "
    + q.unpivot(
        LABELS,
        lambda c: f"SELECT '{c}_label' AS label, n0, n1, {q.r6('CASE WHEN n1 > 0 THEN n0::DOUBLE / n1 END')} AS pos_weight FROM "
        f"(SELECT count(*) FILTER ({c}_label = 0) AS n0, count(*) FILTER ({c}_label = 1) AS n1 FROM labelled)",
    ),
)
def class_weights(spark, sf):
    return lab.class_weights(labelled(spark, sf), LABEL_COLUMNS)


@query(
    "spam_filter",
    f"{q.LABELLED} SELECT doc_id, is_noise_or_spam_text_label FROM labelled WHERE is_noise_or_spam_text_label IS DISTINCT FROM 1",
)
def spam_filter(spark, sf):
    return lab.drop_spam(labelled(spark, sf)).select("doc_id", "is_noise_or_spam_text_label")


_POLARIZED_ID = "'Nilai polarisasi rata-rata (rentang 0 hingga 1): ' || CAST(polarized_s::DOUBLE / polarized_n AS VARCHAR)"


@query(
    "prompt_polarized",
    f"{q.LABELLED} SELECT doc_id, {_POLARIZED_ID} || ' [SEP] ' || coalesce(text, 'nan') AS prompt, "
    "'Average polarization value (range of 0 to 1): ' || CAST(CASE WHEN polarized_s * 2 > polarized_n THEN 1 ELSE 0 END AS VARCHAR) || ' [SEP] ' || coalesce(text, 'nan') AS prompt_en_bin FROM labelled",
)
def prompt_polarized(spark, sf):
    df = lab.with_votes(fx.annotated(spark, sf), ["polarized"])
    votes = F.col("polarized_votes")
    return df.select(
        "doc_id",
        prompts.polarized_prompt(F.col("text"), v.polarized_value(votes), "id").alias("prompt"),
        prompts.polarized_prompt(F.col("text"), v.polarized_value(votes, "bin"), "en").alias("prompt_en_bin"),
    )


def _lines(language: str) -> str:
    out = []
    for a in ATTRIBUTES:
        name = lex.DEMOGRAPHIC_NAMES[language][a]
        out.append(f"chr(10) || '{name}: ' || coalesce({COLUMNS.get(a, a)}, 'None')")
    return " || ".join(out)


@query(
    "prompt_demographic",
    f"{_EXPLODED} SELECT doc_id, annotator_id, 'Informasi Demografis:' || {_lines('id')} || ' [SEP] ' || coalesce(text, 'nan') AS prompt_id, "
    f"'Demographic Information:' || {_lines('en')} || ' [SEP] ' || coalesce(text, 'nan') AS prompt_en, "
    "'Informasi Demografis: Tidak tersedia' AS prompt_none FROM x",
)
def prompt_demographic(spark, sf):
    rows = exploded(spark, sf)
    return rows.select(
        "doc_id",
        "annotator_id",
        prompts.demographic_prompt(F.col("text"), ATTRIBUTES, "id", COLUMNS).alias("prompt_id"),
        prompts.demographic_prompt(F.col("text"), ATTRIBUTES, "en", COLUMNS).alias("prompt_en"),
        prompts.demographic_prompt(F.col("text"), [], "id").alias("prompt_none"),
    )


@query(
    "prompt_combined",
    f"{_EXPLODED} SELECT x.doc_id, annotator_id, {_POLARIZED_ID} || chr(10) || 'Informasi Demografis:' || {_lines('id')} || ' [SEP] ' || coalesce(x.text, 'nan') AS prompt "
    "FROM x JOIN (SELECT doc_id, polarized_s, polarized_n FROM labelled) l ON x.doc_id = l.doc_id",
)
def prompt_combined(spark, sf):
    df = lab.with_votes(fx.annotated(spark, sf), ["polarized"]).withColumn(
        "polarized_value", v.polarized_value(F.col("polarized_votes"))
    )
    rows = ann.explode_annotations(df.drop("polarized_votes"), dimension(spark, sf))
    prompt = prompts.combined_prompt(F.col("text"), F.col("polarized_value"), ATTRIBUTES, "id", COLUMNS)
    return rows.select("doc_id", "annotator_id", prompt.alias("prompt"))


@query(
    "prompt_strip",
    f"{q.LABELLED} SELECT doc_id, regexp_replace(coalesce(text, 'nan'), '^[{q.S}]+|[{q.S}]+$', '', 'g') AS raw_text FROM labelled",
)
def prompt_strip(spark, sf):
    df = lab.with_votes(fx.annotated(spark, sf), ["polarized"])
    full = prompts.polarized_prompt(F.col("text"), v.polarized_value(F.col("polarized_votes")))
    return df.select("doc_id", cleaning.strip_prompt(full).alias("raw_text"))
