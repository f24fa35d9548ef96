"""Sampling, splits, folds, scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from annospark.functions import lexicons as lex
from annospark.functions import patterns as p
from annospark.operators import labels as lab
from annospark.operators import metrics, sampling, significance, stats
from annospark.plans import baselines, prepare
from annospark.sources import tables
from checks import fixtures as fx
from checks import sql as q
from checks.queries_labels import ATTRIBUTES, COLUMNS, _EXPLODED, _lines, dimension, labelled
from checks.queries_text import _MICROS, micro_events, quota_sql
from checks.registry import query

SUBS = ["insults", "identity_attack", "profanity_obscenity", "threat", "sexually_explicit"]
SUB_PAIRS = {s: (f"y_{s}", f"s_{s}") for s in SUBS}


def md5(seed: int, row: str = "doc_id") -> str:
    return f"md5(CAST({row} AS VARCHAR) || '#{seed}')"


# --- samples, splits, folds ---------------------------------------------------------
@query("seeded_sample", f"{q.ANNOTATED} SELECT doc_id, text FROM annotated ORDER BY {md5(42)}, doc_id LIMIT 50")
def seeded_sample(spark, sf):
    return sampling.seeded_sample(fx.annotated(spark, sf).select("doc_id", "text"), 50, "doc_id")


_SPLIT = (
    f"{quota_sql('labelled', 'toxicity_label', '0.2')}, "
    f"r AS (SELECT doc_id, toxicity_label, row_number() OVER (PARTITION BY toxicity_label ORDER BY {md5(42)}, doc_id) AS rk FROM labelled), "
    "s AS (SELECT doc_id, toxicity_label, CASE WHEN rk <= q THEN 'test' ELSE 'train' END AS split FROM r JOIN quota ON r.toxicity_label = quota.c)"
)


def split(spark, sf):
    df = lab.with_labels(fx.annotated(spark, sf), ["toxicity"])
    return sampling.stratified_split(df, "toxicity_label", "doc_id", classes=lex.VOTE_OUTCOMES)


@query("stratified_split", f"{q.LABELLED}, {_SPLIT} SELECT doc_id, toxicity_label, split FROM s")
def stratified_split(spark, sf):
    return split(spark, sf).select("doc_id", "toxicity_label", "split")


@query(
    "split_shares",
    f"{q.LABELLED}, {_SPLIT} SELECT split, toxicity_label, count(*) AS n, {q.r6('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split)')} AS pct FROM s GROUP BY 1, 2",
)
def split_shares(spark, sf):
    return stats.value_counts(split(spark, sf), "toxicity_label", within=["split"])


_FOLDS = (
    f"f AS (SELECT doc_id, toxicity_label, CAST((row_number() OVER (PARTITION BY toxicity_label ORDER BY {md5(42)}, doc_id) - 1) % 5 AS INTEGER) AS fold FROM labelled)"
)


@query("stratified_folds", f"{q.LABELLED}, {_FOLDS} SELECT doc_id, toxicity_label, fold FROM f")
def stratified_folds(spark, sf):
    df = lab.with_labels(fx.annotated(spark, sf), ["toxicity"])
    return sampling.stratified_folds(df, "toxicity_label", "doc_id").select("doc_id", "toxicity_label", "fold")


@query(
    "experiment_rows",
    f"{_EXPLODED}, {_FOLDS} SELECT x.doc_id, annotator_id, fold, CAST(toxicity AS INTEGER) AS label, "
    f"'Informasi Demografis:' || {_lines('id')} || ' [SEP] ' || coalesce(text, 'nan') AS combined_text FROM x JOIN f ON x.doc_id = f.doc_id",
)
def experiment_rows(spark, sf):
    return prepare.experiment_rows(
        fx.annotated(spark, sf), dimension(spark, sf), "doc_id", ATTRIBUTES, columns=COLUMNS
    )


_RARE = ["sexually_explicit_label", "threat_incitement_to_violence_label", "profanity_obscenity_label", "insults_label", "identity_attack_label"]
_STRATUM = "CASE " + " ".join(f"WHEN {c} = 1 THEN '{c}'" for c in _RARE) + " WHEN toxicity_label = 1 THEN 'toxic' ELSE 'negative' END"
_CLEAN = " AND ".join(f"{c} IN (0.0, 1.0)" for c in ["toxicity_label", *_RARE])
_ORDER = [*_RARE, "toxic", "negative"]


def _part_quota(part: str, cls_order: str) -> str:
    """Quota of one 10 % part: ceil of all rows over the eligible strata."""
    return (
        f"{part}_p AS (SELECT c, n, target * n // total AS base, target * n % total AS rest, target FROM "
        "(SELECT c, n, CAST(sum(n) OVER () AS BIGINT) AS total, (SELECT CAST(ceil(count(*) * 0.1) AS BIGINT) FROM labelled) AS target FROM z)), "
        f"{part}_q AS (SELECT c, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, {cls_order}) <= target - sum(base) OVER () THEN 1 ELSE 0 END AS q FROM {part}_p)"
    )


_POSITION = "CASE c " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(_ORDER)) + " END"


@query(
    "three_way_split",
    f"{q.LABELLED}, e AS (SELECT doc_id, {_STRATUM} AS stratum, num_annotators, ({_CLEAN}) AS ok FROM labelled), "
    "z AS (SELECT stratum AS c, count(*) AS n FROM e WHERE ok GROUP BY 1), "
    f"{_part_quota('a', _POSITION)}, {_part_quota('b', _POSITION)}, "
    f"r AS (SELECT doc_id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY CASE WHEN num_annotators >= 2 THEN 0 ELSE 1 END, {md5(42)}, doc_id) AS rk FROM e WHERE ok) "
    "SELECT e.doc_id, e.stratum, CASE WHEN rk <= a_q.q THEN 'test' WHEN rk <= a_q.q + b_q.q THEN 'val' ELSE 'train' END AS split "
    "FROM e LEFT JOIN r ON e.doc_id = r.doc_id LEFT JOIN a_q ON r.stratum = a_q.c LEFT JOIN b_q ON r.stratum = b_q.c",
)
def three_way_split(spark, sf):
    df = labelled(spark, sf)
    return sampling.three_way_split(df, "doc_id", "toxicity_label", _RARE).select("doc_id", "stratum", "split")


_ALL = ["toxicity_label", *_RARE]


@query(
    "label_split_shares",
    f"{q.LABELLED}, e AS (SELECT * FROM labelled WHERE {_CLEAN}), pt AS (SELECT unnest(['test', 'val']) AS split) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS label, split, (SELECT count(*) FROM e WHERE {c} = 1) AS positives, round((SELECT count(*) FROM e WHERE {c} = 1) * 0.1::DOUBLE, 6) AS quota, TRUE AS within_one FROM pt"
        for c in _ALL
    )
    + " UNION ALL SELECT 'rows', split, (SELECT count(*) FROM e), ceil((SELECT count(*) FROM labelled) * 0.1::DOUBLE), TRUE FROM pt",
)
def label_split_shares(spark, sf):
    """Every label's rows in test and val against its quota; SQL states the quotas and that none is missed by a row or more."""
    df = labelled(spark, sf)
    clean = F.lit(True)
    for c in _ALL:
        clean = clean & F.col(c).isin(0.0, 1.0)
    found = sampling.label_split(df, _ALL, "doc_id", eligible=clean, prefer=F.col("num_annotators") >= 2)
    found = found.where(clean).select("split", *[(F.col(c) == 1).alias(c) for c in _ALL], F.lit(True).alias("rows"))
    rows = df.count()
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("has")) for c in [*_ALL, "rows"]]))
    counts = found.select("split", pairs.alias("x")).where("x.has").groupBy(F.col("x.label").alias("label"))
    counts = counts.agg(F.count(F.lit(1)).alias("positives"), *[F.count(F.when(F.col("split") == s, 1)).alias(s) for s in ("test", "val")])
    quota = F.when(F.col("label") == "rows", F.ceil(F.lit(rows * 0.1)).cast("double")).otherwise(F.col("positives") * F.lit(0.1))
    parts = F.explode(F.array(*[F.struct(F.lit(s).alias("split"), F.col(s).alias("n")) for s in ("test", "val")]))
    counts = counts.withColumn("quota", quota).select("label", "positives", "quota", parts.alias("p"))
    return counts.select("label", "p.split", "positives", "quota", (F.abs(F.col("p.n") - F.col("quota")) < 1).alias("within_one"))


_BALANCED = "SELECT doc_id, CASE WHEN {cond} THEN 1 ELSE 0 END AS label FROM documents"


def _resample_sql(cond: str) -> str:
    return (
        f"WITH l AS ({_BALANCED.format(cond=cond)}), "
        "n AS (SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0) // 3 AS target FROM l), "
        f"r AS (SELECT doc_id, row_number() OVER (ORDER BY {md5(42)}, doc_id) AS rk FROM l WHERE label = 1), "
    )


@query(
    "resample_down",
    _resample_sql("doc_id % 2 = 0")
    + "x AS (SELECT doc_id, 0 AS label, 1 AS copy FROM l WHERE label = 0 UNION ALL SELECT doc_id, 1, 1 FROM r, n WHERE rk <= target) SELECT * FROM x",
)
def resample_down(spark, sf):
    df = fx.table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0).alias("label"))
    return sampling.resample_ratio(df, "label", "doc_id")


@query(
    "resample_up",
    _resample_sql("doc_id % 11 = 0")
    + f"d AS (SELECT CAST('0x' || substr({md5(42, 'i')}, 1, 12) AS BIGINT) % n1 + 1 AS rk, i FROM (SELECT unnest(range(target)) AS i, n1 FROM n)), "
    "x AS (SELECT doc_id, 0 AS label, 1 AS copy FROM l WHERE label = 0 UNION ALL "
    "SELECT doc_id, 1, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INTEGER) FROM d JOIN r ON d.rk = r.rk) SELECT * FROM x",
)
def resample_up(spark, sf):
    df = fx.table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 11 == 0, 1).otherwise(0).alias("label"))
    return sampling.resample_ratio(df, "label", "doc_id")


@query(
    "union_membership",
    f"{q.ANNOTATED} SELECT 'a' AS part, doc_id, topic FROM annotated WHERE topic IN ('src0', 'src7') UNION ALL "
    "SELECT 'b', doc_id, topic FROM annotated WHERE topic NOT IN ('src0', 'src7')",
)
def union_membership(spark, sf):
    df = fx.annotated(spark, sf).select("doc_id", "topic")
    wanted = F.col("topic").isin("src0", "src7")
    return sampling.union_all(
        df.filter(wanted).select(F.lit("a").alias("part"), "*"), df.filter(~wanted).select(F.lit("b").alias("part"), "*")
    )


@query(
    "sort_top_rows",
    f"{q.ANNOTATED} SELECT doc_id, topic, CAST({q.n_words('text')} AS INTEGER) AS words FROM annotated ORDER BY words DESC, topic, doc_id LIMIT 25",
)
def sort_top_rows(spark, sf):
    df = fx.annotated(spark, sf).select("doc_id", "topic", p.word_count(p.filled(F.col("text"))).alias("words"))
    return df.orderBy(F.col("words").desc(), "topic", "doc_id").limit(25)


@query(
    "row_number_in_group",
    "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS row_in_group FROM conversations",
)
def row_number_in_group(spark, sf):
    return sampling.with_row_number(fx.table(spark, sf, "conversations").select("conv_id", "turn"), ["conv_id"], "turn")


@query(
    "row_number_by_time",
    f"WITH e AS ({_MICROS}) SELECT event_id, row_number() OVER (PARTITION BY t ORDER BY event_id) - 1 AS row_in_group FROM e",
)
def row_number_by_time(spark, sf):
    numbered = sampling.with_row_number(micro_events(spark, sf), ["t"], "event_id")
    return numbered.select("event_id", "row_in_group")


# --- scores ------------------------------------------------------------------------------
def _div(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0 END"


CELLS_SQL = (
    "count(*) FILTER ({y} = 1 AND {p} = 1) AS tp, count(*) FILTER ({y} = 0 AND {p} = 1) AS fp, "
    "count(*) FILTER ({y} = 1 AND {p} = 0) AS fn, count(*) FILTER ({y} = 0 AND {p} = 0) AS tn"
)


def _scored(source: str, by: str) -> str:
    """SELECT of all scores over a CTE ``source`` holding tp, fp, fn, tn."""
    p1, r1, f1 = _div("tp", "tp + fp"), _div("tp", "tp + fn"), _div("2 * tp", "2 * tp + fp + fn")
    p0, r0, f0 = _div("tn", "tn + fn"), _div("tn", "tn + fp"), _div("2 * tn", "2 * tn + fp + fn")
    n = "tp + fp + fn + tn"
    classes = "CAST(tp + fp + fn > 0 AS INTEGER) + CAST(tn + fp + fn > 0 AS INTEGER)"
    values = {
        "accuracy": _div("tp + tn", n),
        "macro_f1": _div(f"(({f0}) + ({f1}))", classes),
        "precision": _div(f"(({p0}) + ({p1}))", classes),
        "recall": _div(f"(({r0}) + ({r1}))", classes),
        "precision_class_1": p1,
        "recall_class_1": r1,
        "f1_class_1": f1,
        "precision_class_0": p0,
        "recall_class_0": r0,
        "f1_class_0": f0,
        "roc_auc": f"CASE WHEN tp + fn > 0 AND tn + fp > 0 THEN (({r0}) + ({r1})) / 2 ELSE 0.5 END",
        "precision_recall_auc": f"CASE WHEN tp + fn > 0 THEN ({r1}) * ({p1}) + (1 - ({r1})) * ({_div('tp + fn', n)}) ELSE 0.0 END",
    }
    lead = f"{by}, " if by else ""
    return f"SELECT {lead}tp, fp, fn, tn, " + ", ".join(f"{q.r6(v)} AS {k}" for k, v in values.items()) + f" FROM {source}"


_C = CELLS_SQL.format(y="label", p="pred")


@query("binary_metrics", f"{q.PREDICTIONS}, c AS (SELECT {_C} FROM predictions) {_scored('c', '')}")
def binary_metrics(spark, sf):
    return metrics.binary_metrics(fx.predictions(spark, sf))


@query("metrics_by_fold", f"{q.PREDICTIONS}, c AS (SELECT fold, {_C} FROM predictions GROUP BY fold) {_scored('c', 'fold')}")
def metrics_by_fold(spark, sf):
    return metrics.binary_metrics(fx.predictions(spark, sf), by=["fold"])


@query(
    "metrics_export",
    f"{q.PREDICTIONS}, c AS (SELECT fold, {_C} FROM predictions GROUP BY fold), m AS ({_scored('c', 'fold')}) SELECT * FROM m",
)
def metrics_export(spark, sf):
    path = tables.scratch_path(spark, "metrics-csv")
    tables.write_metrics(metrics.binary_metrics(fx.predictions(spark, sf), by=["fold"]), path)
    schema = "fold int, tp long, fp long, fn long, tn long, " + ", ".join(f"{s} double" for s in metrics.SCORES)
    return spark.read.schema(schema).option("header", "true").csv(path)


def _unrounded(by: str) -> str:
    return _scored("c", by).replace("round(CAST(", "(CAST(").replace(" AS DOUBLE), 6)", " AS DOUBLE))")


@query(
    "metrics_over_folds",
    f"{q.PREDICTIONS}, c AS (SELECT fold, {_C} FROM predictions GROUP BY fold), m AS ({_unrounded('fold')}) "
    + q.unpivot(metrics.SCORES, lambda s: f"SELECT '{s}' AS metric, {q.r6(f'avg({s})')} AS mean, {q.r6(f'stddev_samp({s})')} AS std FROM m"),
)
def metrics_over_folds(spark, sf):
    return metrics.average_over(metrics.binary_metrics(fx.predictions(spark, sf), by=["fold"]))


@query(
    "argmax_class",
    f"{q.PREDICTIONS} SELECT doc_id, CASE WHEN 1 - score >= score THEN 0 ELSE 1 END AS pred_class FROM predictions",
)
def argmax_class(spark, sf):
    scores = F.array(1 - F.col("score"), F.col("score"))
    return fx.predictions(spark, sf).select("doc_id", metrics.argmax(scores).alias("pred_class"))


@query(
    "score_auc",
    f"{q.PREDICTIONS}, s AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM predictions GROUP BY 1), "
    "w AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s) "
    f"SELECT CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives, {q.r6('sum(p * (below + n / 2.0)) / sum(p) / sum(n)')} AS roc_auc FROM w",
)
def score_auc(spark, sf):
    return metrics.score_auc(fx.predictions(spark, sf), "label", "score")


_SUB_PREDICTED = ", ".join(f"CASE WHEN s_{s} > 0.5 THEN 1 ELSE 0 END AS p_{s}" for s in SUBS)
_GATED = ", ".join(f"CASE WHEN score > 0.5 AND s_{s} > 0.5 THEN 1 ELSE 0 END AS p_{s}" for s in SUBS)
_HARD = f"{q.PREDICTIONS}, h AS (SELECT *, {_SUB_PREDICTED} FROM sub_predictions)"
_GATE = f"{q.PREDICTIONS}, h AS (SELECT *, {_GATED} FROM sub_predictions)"
HARD_PAIRS = {s: (f"y_{s}", f"p_{s}") for s in SUBS}


def hard(spark, sf, gated=False):
    df = fx.predictions(spark, sf)
    if gated:
        out = metrics.hierarchical_gate(df, "score", 0.5, {f"s_{s}": 0.5 for s in SUBS})
        return out.withColumnsRenamed({f"s_{s}_pred": f"p_{s}" for s in SUBS})
    return df.withColumns({f"p_{s}": F.when(F.col(f"s_{s}") > 0.5, 1).otherwise(0) for s in SUBS})


@query(
    "confusion",
    f"{_HARD} SELECT 'toxicity' AS label, label AS actual, pred AS predicted, count(*) AS n FROM h GROUP BY 2, 3 UNION ALL "
    + q.unpivot(SUBS, lambda s: f"SELECT '{s}', y_{s}, p_{s}, count(*) FROM h GROUP BY 2, 3"),
)
def confusion(spark, sf):
    return metrics.confusion(hard(spark, sf), {"toxicity": ("label", "pred"), **HARD_PAIRS})


_GRID = ", ".join(f"({t:.2f}::DOUBLE)" for t in lex.BINARY_THRESHOLDS)
_SWEEP = (
    f"{q.PREDICTIONS}, g AS (SELECT * FROM (VALUES {_GRID}) g(threshold)), "
    f"c AS (SELECT threshold, {CELLS_SQL.format(y='label', p='CASE WHEN score > threshold THEN 1 ELSE 0 END')} FROM predictions, g GROUP BY threshold)"
)


@query("threshold_sweep", f"{_SWEEP} {_scored('c', 'threshold')}")
def threshold_sweep(spark, sf):
    return metrics.threshold_sweep(fx.predictions(spark, sf), "label", "score")


@query("threshold_best", f"{_SWEEP}, m AS ({_scored('c', 'threshold')}) SELECT threshold, f1_class_1 FROM m ORDER BY f1_class_1 DESC, threshold LIMIT 1")
def threshold_best(spark, sf):
    return metrics.best_threshold(metrics.threshold_sweep(fx.predictions(spark, sf), "label", "score")).select("threshold", "f1_class_1")


GRID = metrics.threshold_grid(lex.LABEL_THRESHOLD_RANGES)


def _label_sweep(s: str) -> str:
    grid = ", ".join(f"({t:.2f}::DOUBLE)" for t in GRID[s])
    return (
        f"SELECT '{s}' AS label, threshold, tp, fp, fn, tn, {q.r6(_div('2 * tp', '2 * tp + fp + fn'))} AS f1 FROM (SELECT threshold, "
        f"{CELLS_SQL.format(y=f'y_{s}', p=f'CASE WHEN s_{s} > threshold THEN 1 ELSE 0 END')} FROM sub_predictions, (VALUES {grid}) g(threshold) GROUP BY threshold)"
    )


@query("label_threshold_sweep", f"{q.PREDICTIONS} {q.unpivot(SUBS, _label_sweep)}")
def label_threshold_sweep(spark, sf):
    return metrics.label_threshold_sweep(fx.predictions(spark, sf), SUB_PAIRS, GRID)


@query("hierarchical_gate", f"{_GATE} SELECT doc_id, score, {', '.join(f'p_{s}' for s in SUBS)} FROM h")
def hierarchical_gate(spark, sf):
    return hard(spark, sf, gated=True).select("doc_id", "score", *[f"p_{s}" for s in SUBS])


_WRONG = " + ".join(f"CASE WHEN y_{s} <> p_{s} THEN 1 ELSE 0 END" for s in SUBS)
_F1S = ", ".join(
    f"{_div(f'2 * count(*) FILTER (y_{s} = 1 AND p_{s} = 1)', f'count(*) FILTER (y_{s} = 1) + count(*) FILTER (p_{s} = 1)')} AS f1_{s}" for s in SUBS
)


@query(
    "multilabel_metrics",
    f"{_HARD}, m AS (SELECT {_F1S}, avg(({_WRONG}) / 5.0) AS hamming_loss, avg(CASE WHEN ({_WRONG}) = 0 THEN 1 ELSE 0 END) AS subset_accuracy FROM h), "
    f"a AS (SELECT *, ({' + '.join(f'f1_{s}' for s in SUBS)}) / 5 AS macro_f1 FROM m) "
    + q.unpivot([*[f"f1_{s}" for s in SUBS], "macro_f1", "hamming_loss", "subset_accuracy"], lambda c: f"SELECT '{c}' AS metric, {q.r6(c)} AS value FROM a"),
)
def multilabel_metrics(spark, sf):
    return metrics.multilabel_metrics(hard(spark, sf), HARD_PAIRS)


#: ``cell`` has slices of one class in labels and predictions.
SLICES = ["topic", "lang", "word_bin", "annotators", "cell"]
_SLICED = (
    f"{q.PREDICTIONS}, w AS (SELECT p.*, len({q.words('d.text')}) AS words FROM predictions p JOIN documents d ON p.doc_id = d.doc_id), "
    "s AS (SELECT *, CASE WHEN words <= 10 THEN '<=10' WHEN words <= 50 THEN '11-50' WHEN words <= 100 THEN '51-100' ELSE '>100' END AS word_bin, "
    "CASE WHEN doc_id % 20 < 11 THEN 'single' ELSE 'multi' END AS annotators, label * 10 + pred AS cell FROM w)"
)


@query(
    "slice_metrics",
    f"{_SLICED}, c AS ({q.unpivot(SLICES, lambda d: f'SELECT {chr(39)}{d}{chr(39)} AS dimension, CAST({d} AS VARCHAR) AS value, {_C} FROM s GROUP BY 2')}) {_scored('c', 'dimension, value')}",
)
def slice_metrics(spark, sf):
    return metrics.slice_metrics(_sliced(spark, sf), SLICES)


LATTICE = ["topic", "word_bin", "annotators"]


@query(
    "slice_lattice",
    f"{_SLICED}, c AS (SELECT grouping_id({', '.join(LATTICE)}) AS level, {', '.join(LATTICE)}, count(*) AS n, {_C} FROM s GROUP BY CUBE ({', '.join(LATTICE)}) HAVING count(*) >= 5) "
    + _scored("c", f"level, {', '.join(LATTICE)}, n"),
)
def slice_lattice(spark, sf):
    return metrics.slice_lattice(_sliced(spark, sf), LATTICE, min_support=5)


def _sliced(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", p.word_count(F.col("text")).alias("words"))
    return fx.predictions(spark, sf).join(docs, "doc_id").withColumns(
        {
            "word_bin": stats.word_bin(F.col("words")),
            "annotators": F.when(F.col("doc_id") % 20 < 11, "single").otherwise("multi"),
            "cell": F.col("label") * 10 + F.col("pred"),
        }
    )


_CASCADE = (
    f"k AS (SELECT CAST(sum({_WRONG}) AS BIGINT) AS sub_errors, CAST(coalesce(sum({_WRONG}) FILTER (label = 1 AND pred = 0), 0) AS BIGINT) AS cascading_errors FROM h), "
    f"r AS (SELECT *, {_div('cascading_errors', 'sub_errors')} AS cascade_rate FROM k)"
)


@query("cascade_rate", f"{_GATE}, {_CASCADE} SELECT sub_errors, cascading_errors, {q.r6('cascade_rate')} AS cascade_rate FROM r")
def cascade_rate(spark, sf):
    return metrics.cascade_rate(hard(spark, sf, gated=True), "label", "pred", HARD_PAIRS)


@query(
    "iteration_advice",
    f"{_GATE}, {_CASCADE}, c AS (SELECT {_C} FROM predictions), overall AS ({_scored('c', '')}), "
    f"t AS (SELECT topic, {_C} FROM predictions GROUP BY topic), topics AS ({_scored('t', 'topic')}), f AS (SELECT {_F1S} FROM h), v AS (SELECT cascade_rate, {_div('fp', 'fp + tn')} AS fpr, {_div('fn', 'fn + tp')} AS fnr FROM c, r), "
    "u AS (SELECT 'cascading' AS rule, cascade_rate > 0.3 AS fires, 'improve binary recall before sub-labels' AS t FROM v UNION ALL "
    "SELECT 'false_positives', fpr > 0.5, 'lower pos_weight or raise the threshold' FROM v UNION ALL "
    "SELECT 'false_negatives', fnr > 0.5, 'raise pos_weight or lower the threshold' FROM v UNION ALL "
    "SELECT 'topic_drop', (SELECT macro_f1 FROM overall) - (SELECT min(macro_f1) FROM topics) > 0.1, 'sample stratified by topic' UNION ALL "
    "SELECT 'sub_label_near_zero', (SELECT least(" + ", ".join(f"f1_{s}" for s in SUBS) + ") FROM f) <= 0.05, 'use an asymmetric loss or train jointly with the binary task') "
    "SELECT rule, fires, CASE WHEN fires THEN t ELSE 'none' END AS action FROM u",
)
def iteration_advice(spark, sf):
    df = hard(spark, sf, gated=True)
    cascade = metrics.cascade_rate(df, "label", "pred", HARD_PAIRS)
    subs = metrics.multilabel_metrics(df, HARD_PAIRS).where(F.col("metric").startswith("f1_"))
    topics = metrics.binary_metrics(df, by=["topic"])
    return metrics.iteration_advice(metrics.binary_metrics(df), cascade, slices=topics, sub_labels=subs)


@query(
    "error_samples",
    f"{q.PREDICTIONS}, e AS (SELECT doc_id, label, pred, CASE WHEN label = 0 AND pred = 1 THEN 'FP' WHEN label = 1 AND pred = 0 THEN 'FN' END AS error FROM predictions), "
    f"r AS (SELECT *, CAST(row_number() OVER (PARTITION BY error ORDER BY {md5(42)}, doc_id) AS INTEGER) AS rank FROM e WHERE error IS NOT NULL) SELECT * FROM r WHERE rank <= 20",
)
def error_samples(spark, sf):
    df = fx.predictions(spark, sf).select("doc_id", "label", "pred")
    return sampling.error_samples(df, "label", "pred", "doc_id", 20)


#: Predictions of three runs beside those of the control.
RUNS = {
    "low_cut": "CASE WHEN score > 0.3 THEN 1 ELSE 0 END",
    "high_cut": "CASE WHEN score > 0.7 THEN 1 ELSE 0 END",
    "better": "CASE WHEN doc_id % 4 = 0 THEN label ELSE pred END",
}


def _difference_sql(replicates: int = 200, seed: int = 42) -> str:
    draw = "CAST('0x' || substr(md5(concat_ws('#', CAST(doc_id AS VARCHAR), '{seed}', CAST((r - 1) // 8 AS VARCHAR))), 4 * ((r - 1) % 8) + 1, 4) AS INTEGER)"
    weight = " + ".join(f"CAST(u >= {cut} AS INTEGER)" for cut in significance.POISSON_CUTS)

    def sums(pred: str) -> str:
        pairs = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
        return ", ".join(f"coalesce(sum(w) FILTER (label = {a} AND {pred} = {b}), 0) AS {c}" for c, (a, b) in pairs.items())

    f1, f0 = _div("2 * tp", "2 * tp + fp + fn"), _div("2 * tn", "2 * tn + fp + fn")
    classes = "CAST(tp + fp + fn > 0 AS INTEGER) + CAST(tn + fp + fn > 0 AS INTEGER)"
    macro = _div(f"(({f0}) + ({f1}))", classes)
    runs = {"control": "pred", **RUNS}
    lines = [
        f"x AS (SELECT predictions.*, r, {draw.format(seed=seed)} AS u FROM predictions, range(1, {replicates + 1}) t(r))",
        f"y AS (SELECT *, {weight} AS w FROM x UNION ALL SELECT *, 0 AS r, 0 AS u, 1 AS w FROM predictions)",
        "k AS (" + " UNION ALL ".join(f"SELECT '{name}' AS variant, r, {sums(f'({pred})')} FROM y GROUP BY r" for name, pred in runs.items()) + ")",
        f"m AS (SELECT variant, r, {macro} AS f FROM k)",
        "d AS (SELECT a.variant, a.r, a.f AS f, b.f AS c, a.f - b.f AS delta FROM m a JOIN m b ON a.r = b.r AND b.variant = 'control' WHERE a.variant <> 'control')",
        "g AS (SELECT variant, list_sort(list(delta)) AS l, count(*) FILTER (delta <= 0) AS lo, count(*) FILTER (delta >= 0) AS hi FROM d WHERE r > 0 GROUP BY 1)",
    ]
    edge = int(0.025 * replicates)
    low, high = f"l[{edge}]", f"l[{replicates + 1 - edge}]"
    return (
        f"{q.PREDICTIONS}, {', '.join(lines)} SELECT variant, {q.r6('f')} AS score, {q.r6('c')} AS control_score, {q.r6('delta')} AS delta, "
        f"{q.r6(low)} AS low, {q.r6(high)} AS high, {q.r6(f'least(1.0, 2.0 * (least(lo, hi) + 1) / {replicates + 1})')} AS p_value, "
        f"{low} > 0 OR {high} < 0 AS significant FROM d JOIN g USING (variant) WHERE r = 0"
    )


@query("run_significance", _difference_sql())
def run_significance(spark, sf):
    runs = fx.predictions(spark, sf).withColumns({name: F.expr(pred) for name, pred in RUNS.items()})
    return significance.difference_intervals(runs, "doc_id", "label", "pred", list(RUNS))


@query(
    "run_comparison",
    f"{q.PREDICTIONS}, v AS (SELECT lang AS variant, fold AS run, {_C} FROM predictions GROUP BY 1, 2), "
    f"m AS (SELECT variant, run, {_div('2 * tp', '2 * tp + fp + fn')} AS f1 FROM v), "
    "s AS (SELECT variant, count(*) AS runs, avg(f1) AS mean, stddev_samp(f1) AS std FROM m GROUP BY 1) "
    f"SELECT variant, runs, {q.r6('mean')} AS mean, {q.r6('std')} AS std, {q.r6(f'mean - (SELECT mean FROM s WHERE variant = {chr(39)}en{chr(39)})')} AS delta FROM s",
)
def run_comparison(spark, sf):
    runs = metrics.binary_metrics(fx.predictions(spark, sf), by=["lang", "fold"])
    return metrics.run_comparison(runs.withColumnRenamed("lang", "variant"), "variant", "f1_class_1", "en")


@query(
    "severity",
    f"{q.PREDICTIONS} SELECT doc_id, CASE WHEN score >= 0.8 THEN 'High' WHEN score >= 0.5 THEN 'Medium' ELSE 'Low' END AS severity FROM predictions",
)
def severity(spark, sf):
    return fx.predictions(spark, sf).select("doc_id", metrics.severity(F.col("score"), 0.5, 0.8).alias("severity"))


@query(
    "behaviour_accuracy",
    f"{q.PREDICTIONS} SELECT lang AS category, count(*) AS cases, CAST(sum(CASE WHEN label = pred THEN 1 ELSE 0 END) AS BIGINT) AS correct, "
    f"{q.r6('avg(CASE WHEN label = pred THEN 1 ELSE 0 END)')} AS accuracy FROM predictions GROUP BY 1",
)
def behaviour_accuracy(spark, sf):
    df = fx.predictions(spark, sf).withColumnRenamed("lang", "category")
    return metrics.behaviour_accuracy(df, "category", "label", "pred")


def _labelled_parts(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", "text")
    df = docs.join(fx.table(spark, sf, "labels"), "doc_id").withColumnRenamed("toxic", "label")
    return sampling.stratified_split(df, "label", "doc_id", classes=(0, 1))


_PARTS = (
    f"WITH u AS (SELECT doc_id, text, CAST(toxic AS INTEGER) AS y FROM documents JOIN labels USING (doc_id)), {quota_sql('u', 'y', '0.2')}, "
    "k AS (SELECT u.*, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(doc_id AS VARCHAR) || '#42')) AS rk FROM u), "
    "s AS (SELECT doc_id, text, y, CASE WHEN rk <= q THEN 'test' ELSE 'train' END AS split FROM k JOIN quota ON k.y = quota.c)"
)
_VECTOR = q.words(f"lower({q.light('text')})")
_BAYES = (
    f"{_PARTS}, w AS (SELECT doc_id, y, split, unnest({_VECTOR}) AS term FROM s), "
    "tr AS (SELECT term, count(*) FILTER (y = 0) AS c0, count(*) FILTER (y = 1) AS c1 FROM w WHERE split = 'train' GROUP BY term), "
    "tot AS (SELECT sum(c0) AS n0, sum(c1) AS n1, count(*) AS v FROM tr), "
    "pr AS (SELECT ln(count(*) FILTER (y = 0)::DOUBLE / count(*)) AS p0, ln(count(*) FILTER (y = 1)::DOUBLE / count(*)) AS p1 FROM s WHERE split = 'train'), "
    "sc AS (SELECT doc_id, sum(ln((c0 + 1)::DOUBLE / (n0 + v))) AS s0, sum(ln((c1 + 1)::DOUBLE / (n1 + v))) AS s1 FROM w JOIN tr USING (term), tot WHERE split = 'test' GROUP BY doc_id), "
    "nb AS (SELECT s.doc_id, y AS label, CASE WHEN coalesce(s1, 0) + p1 > coalesce(s0, 0) + p0 THEN 1 ELSE 0 END AS pred "
    "FROM (SELECT * FROM s WHERE split = 'test') s LEFT JOIN sc USING (doc_id), pr)"
)


@query("baseline_naive_bayes", f"{_BAYES}, c AS (SELECT {_C} FROM nb), m AS ({_scored('c', '')}) SELECT 'naive_bayes' AS model, * FROM m")
def baseline_naive_bayes(spark, sf):
    found = baselines.naive_bayes(_labelled_parts(spark, sf), "doc_id")
    return metrics.binary_metrics(found).select(F.lit("naive_bayes").alias("model"), "*")


@query("baseline_predictions", f"{_BAYES} SELECT doc_id, label, pred FROM nb")
def baseline_predictions(spark, sf):
    return baselines.naive_bayes(_labelled_parts(spark, sf), "doc_id")



_SVM_ROUNDS = 10


def _svm_sql(rounds: int, ridge: float = 1e-4, step: float = 0.25) -> str:
    """The gradient steps spelled out, one sub-query a round; words are keyed by themselves."""
    parts = [
        f"{_PARTS}, w AS (SELECT doc_id, y, split, unnest({_VECTOR}) AS term FROM s)",
        "tf AS MATERIALIZED (SELECT doc_id, y, split, term, count(*) AS tf FROM w GROUP BY ALL)",
        "n AS (SELECT count(*) AS n, count(*) / (2.0::DOUBLE * count(*) FILTER (y = 0)) AS k0, count(*) / (2.0::DOUBLE * count(*) FILTER (y = 1)) AS k1 FROM s WHERE split = 'train')",
        "vo AS (SELECT term, ln((max(n) + 1)::DOUBLE / (count(*) + 1)) + 1 AS idf FROM tf, n WHERE split = 'train' GROUP BY term)",
        "pw AS (SELECT doc_id, y, split, term, (ln(tf) + 1) * idf AS a FROM tf JOIN vo USING (term))",
        "po AS MATERIALIZED (SELECT doc_id, y, split, term, a / sqrt(sum(a * a) OVER (PARTITION BY doc_id)) AS x FROM pw UNION ALL SELECT doc_id, y, split, ' ', 1.0::DOUBLE FROM s)",
        "w0 AS MATERIALIZED (SELECT DISTINCT term, 0.0::DOUBLE AS w, 0.0::DOUBLE AS v FROM po WHERE split = 'train' OR term = ' ')",
    ]
    for k in range(1, rounds + 1):
        last = f"w{k - 1}"
        parts += [
            f"m{k} AS MATERIALIZED (SELECT doc_id, y * 2 - 1 AS sgn, y, sum(x * v) AS f FROM po JOIN {last} USING (term) WHERE split = 'train' GROUP BY doc_id, y)",
            f"c{k} AS (SELECT doc_id, -2.0::DOUBLE * sgn * greatest(0.0::DOUBLE, 1 - sgn * f) * (CASE WHEN y = 1 THEN k1 ELSE k0 END / n) AS c FROM m{k}, n)",
            f"g{k} AS MATERIALIZED (SELECT term, sum(x * c) AS g FROM po JOIN c{k} USING (doc_id) GROUP BY term)",
            f"u{k} AS (SELECT term, w, v - {step}::DOUBLE * (coalesce(g, 0) + {ridge}::DOUBLE * v) AS u FROM {last} LEFT JOIN g{k} USING (term))",
            f"w{k} AS MATERIALIZED (SELECT term, u AS w, u + ({k - 1}::DOUBLE / {k + 2}) * (u - w) AS v FROM u{k})",
        ]
    parts.append(f"zz AS (SELECT doc_id, y AS label, sum(x * w) AS score FROM po JOIN w{rounds} USING (term) WHERE split = 'test' GROUP BY doc_id, y)")
    parts.append("pr AS (SELECT doc_id, label, score, CASE WHEN score > 0 THEN 1 ELSE 0 END AS pred FROM zz)")
    return ", ".join(parts)


_TREES, _DEPTH = 50, 4


def _hash_sql(value: str, at: int) -> str:
    return f"CAST('0x' || substr(md5({value}), {at}, 8) AS BIGINT)"


def _forest_sql(trees: int, depth: int) -> str:
    """Levels of the forest spelled out; rows of (tree, text) carry the node."""

    def impurity(a: str, b: str) -> str:
        a, b = f"(({a}) * k0)", f"(({b}) * k1)"
        return f"CASE WHEN {a} + {b} > 0 THEN 2.0::DOUBLE * {a} * {b} / ({a} + {b}) ELSE 0.0::DOUBLE END"

    row = "CAST(doc_id AS VARCHAR) || '#42'"
    draws = " + ".join(f"CASE WHEN u >= {x} THEN 1 ELSE 0 END" for x in baselines.POISSON)
    counts = "CAST(sum(CASE WHEN y = 0 THEN n ELSE 0 END) AS BIGINT) AS {0}0, CAST(sum(CASE WHEN y = 1 THEN n ELSE 0 END) AS BIGINT) AS {0}1"
    parts = [
        f"{_PARTS}, w AS MATERIALIZED (SELECT DISTINCT doc_id, split, unnest({_VECTOR}) AS term FROM s)",
        "kw AS (SELECT count(*) / (2.0::DOUBLE * count(*) FILTER (y = 0)) AS k0, count(*) / (2.0::DOUBLE * count(*) FILTER (y = 1)) AS k1 FROM s WHERE split = 'train')",
        "vs AS (SELECT greatest(1, CAST(floor(sqrt(count(DISTINCT term))) AS BIGINT)) AS m FROM w WHERE split = 'train')",
        f"vh AS MATERIALIZED (SELECT term, {_hash_sql('term', 1)} AS h1, {_hash_sql('term', 9)} AS h2 FROM (SELECT DISTINCT term FROM w WHERE split = 'train'))",
        f"d0 AS MATERIALIZED (SELECT tree, doc_id, y, split, 1 AS node, {draws} AS n FROM (SELECT tree, doc_id, y, split, ({_hash_sql(row, 1)} + tree * {_hash_sql(row, 9)}) % 10000 AS u "
        f"FROM s, (SELECT unnest(range({trees})) AS tree)))",
    ]
    for a in range(depth):
        parts += [
            f"q{a} AS (SELECT tree, term FROM vh, vs, (SELECT unnest(range({trees})) AS tree) WHERE (h1 + (tree * {depth} + {a}) * h2) % m = 0)",
            f"f{a} AS (SELECT d.tree, node, w.term, {counts.format('n')} FROM q{a} q JOIN w ON w.term = q.term AND w.split = 'train' "
            f"JOIN d{a} d ON d.tree = q.tree AND d.doc_id = w.doc_id WHERE n > 0 AND node >= {1 << a} GROUP BY ALL)",
            f"t{a} AS (SELECT tree, node, {counts.format('t')} FROM d{a} WHERE n > 0 AND split = 'train' GROUP BY ALL)",
            f"e{a} AS (SELECT tree, node, term, round({impurity('t0', 't1')} - {impurity('n0', 'n1')} - {impurity('t0 - n0', 't1 - n1')}, 9) AS gain FROM f{a} JOIN t{a} USING (tree, node), kw)",
            f"b{a} AS MATERIALIZED (SELECT tree, node, term FROM e{a} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, term) = 1)",
            f"d{a + 1} AS MATERIALIZED (SELECT d.tree, d.doc_id, y, d.split, CASE WHEN b.term IS NULL THEN d.node ELSE d.node * 2 + CASE WHEN w.term IS NULL THEN 0 ELSE 1 END END AS node, n "
            f"FROM d{a} d LEFT JOIN b{a} b ON b.tree = d.tree AND b.node = d.node LEFT JOIN w ON w.doc_id = d.doc_id AND w.term = b.term)",
        ]
    parts += [
        f"lf AS (SELECT tree, node, t1 * k1 / (t0 * k0 + t1 * k1) AS p FROM (SELECT tree, node, {counts.format('t')} FROM d{depth} WHERE n > 0 AND split = 'train' GROUP BY ALL), kw)",
        f"zz AS (SELECT doc_id, y AS label, sum(coalesce(p, 0)) / {trees} AS score FROM d{depth} LEFT JOIN lf USING (tree, node) WHERE split = 'test' GROUP BY doc_id, y)",
        "pr AS (SELECT doc_id, label, score, CASE WHEN round(score, 9) >= 0.5 THEN 1 ELSE 0 END AS pred FROM zz)",
    ]
    return ", ".join(parts)


def _baseline(model: str, learned: str):
    @query(f"baseline_{model}", f"{learned}, c AS (SELECT {_C} FROM pr), mm AS ({_scored('c', '')}) SELECT '{model}' AS model, * FROM mm")
    def run(spark, sf):
        return baselines.fit_and_score(_labelled_parts(spark, sf), model, "doc_id")

    @query(f"baseline_{model}_predictions", f"{learned} SELECT doc_id, label, {q.r6('score')} AS score, pred FROM pr")
    def predictions(spark, sf):
        return baselines.LEARNERS[model](_labelled_parts(spark, sf), "doc_id")

    @query(
        f"baseline_{model}_rows",
        f"{_PARTS} SELECT '{model}' AS model, count(*) AS rows, count(*) FILTER (y = 1) AS positives, count(*) FILTER (y = 0) AS negatives FROM s WHERE split = 'test'",
    )
    def test_rows(spark, sf):
        """The four cells of a model add up to the rows of the test part."""
        found = baselines.fit_and_score(_labelled_parts(spark, sf), model, "doc_id")
        return found.selectExpr("model", "tp + fp + fn + tn AS rows", "tp + fn AS positives", "tn + fp AS negatives")

    return run


_baseline("linear_svm", _svm_sql(_SVM_ROUNDS))
_baseline("random_forest", _forest_sql(_TREES, _DEPTH))
