"""Operators on skewed, empty and edge-case tables."""

import math
import random
import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.functions import lexicons as lex
from annospark.functions import votes as v
from annospark.operators import annotators as ann
from annospark.operators import keys, lexical, metrics, profile, quality, ranks, sampling, stats
from annospark.operators import labels as lab
from annospark.plans import prepare
from annospark.sources import tables
from annospark.streaming import annotate


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows share one text; the rest are mostly unique."""
    df = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "teks panas").otherwise(F.concat(F.lit("teks "), (F.col("id") % 900).cast("string"))).alias("text"),
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 5 == 0, 1.0).otherwise(0.0).alias("label"),
    )
    return df.cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plain_mode(df):
    counted = df.filter("label is not null").groupBy("text", "label").count()
    w = Window.partitionBy("text").orderBy(F.col("count").desc(), "label")
    return counted.withColumn("r", F.row_number().over(w)).filter("r = 1").select("text", F.col("label").alias("resolved"))


def test_resolve_conflicts_on_a_hot_key(hot):
    got = lab.resolve_conflicts(hot, F.col("text"), "label", "id").select("id", "resolved")
    want = hot.join(plain_mode(hot), "text", "left").select("id", "resolved")
    assert rows(got) == rows(want)


@pytest.mark.parametrize("salts", [1, 7, 32])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_by_key(hot, salts, how):
    groups = hot.groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).filter("n > 3")
    got = keys.lookup_by_key(hot, groups, "text", "id", ["first"], how, salts).select("id", "first")
    want = hot.join(groups, "text", how).select("id", "first")
    assert rows(got) == rows(want)


def test_vocabulary_keeps_the_most_frequent_terms(spark):
    df = spark.createDataFrame([(i, " ".join(f"k{j}" for j in range(i))) for i in range(1, 40)], "doc_id int, text string")
    terms = lexical.document_terms(df, "doc_id", lexical.vectorizer_words(F.col("text")), ())
    kept = lexical.tfidf_vocabulary(terms, df, 1, 1.0, 7)
    assert {r["term"] for r in kept.collect()} == {f"k{j}" for j in range(7)}


def test_lookup_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "id int, k string")
    groups = spark.createDataFrame([("a", 1, 9)], "k string, n int, v int")
    assert rows(keys.lookup_by_key(df, groups, "k", "id", ["v"]).select("id", "v")) == [(1, None), (2, 9)]


def test_first_per_key(hot):
    got = lab.first_per_key(hot, F.col("text"), "id").select("id")
    want = hot.groupBy("text").agg(F.min("id").alias("id")).select("id")
    assert rows(got) == rows(want)


def test_mode_ties_and_nulls(spark):
    data = [(1, "a", 0.0), (2, "a", 1.0), (3, "b", 0.5), (4, "b", 1.0), (5, "c", 0.5), (6, "c", 1.0), (7, "c", 1.0), (8, "d", None), (9, "d", None), (10, "e", None), (11, "e", 1.0)]
    df = spark.createDataFrame(data, "id int, text string, label double")
    out = {r["text"]: r["resolved"] for r in lab.resolve_conflicts(df, F.col("text"), "label", "id").collect()}
    assert out == {"a": 0.0, "b": 0.5, "c": 1.0, "d": None, "e": 1.0}


def test_pool_revote(spark):
    df = spark.createDataFrame(
        [(1, "x", "['1']"), (2, "x", "['0', '0']"), (3, "y", "bad")], "id int, text string, toxicity string"
    )
    out = lab.pool_revote(df, F.col("text"), "id", ["toxicity"], ["text"])
    assert rows(out.select("id", "text", "copies", "toxicity_pooled_votes", "toxicity_label")) == [
        (1, "x", 2, 3, 0.0),
        (3, "y", 1, 0, None),
    ]


def test_conflicts_and_duplicates(hot):
    conflicting = quality.conflict_keys(hot, "text", "label", "id")
    want = hot.filter("label is not null").groupBy("text").agg(F.countDistinct("label").alias("c")).filter("c > 1")
    assert conflicting.count() == want.count()
    got = quality.conflict_rows(hot, "text", "label", "id").select("id")
    assert rows(got) == rows(hot.join(want, "text", "left_semi").select("id"))
    summary = {r["metric"]: r["n"] for r in quality.duplicate_summary(hot.select("text")).collect()}
    assert summary["excess_text_copies"] == 3000 - hot.select("text").distinct().count()


def test_class_rank_equals_the_plain_window(hot):
    got = sampling.class_rank(hot, ["label"], "id", 7).select("id", "rank")
    w = Window.partitionBy("label").orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit("#7"))))
    assert rows(got) == rows(hot.withColumn("rank", F.row_number().over(w)).select("id", "rank"))


def test_row_number_on_a_hot_group(spark):
    df = spark.range(5000).select((F.col("id") * 7).alias("pos"), F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"))
    got = sampling.with_row_number(df, ["g"], "pos", ranges=100).select("pos", "row_in_group")
    w = Window.partitionBy("g").orderBy("pos")
    assert rows(got) == rows(df.withColumn("r", F.row_number().over(w) - 1).select("pos", "r"))


def test_split_has_exact_quotas(hot):
    known = hot.filter("label is not null")
    parts = (("test", 0.2), ("val", 0.1))
    out = sampling.stratified_split(known, "label", "id", parts, classes=(0.0, 1.0)).cache()
    n = known.count()
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes["test"] == math.ceil(n * 0.2) and sizes["val"] == math.ceil(n * 0.1)
    assert out.count() == n and out.select("id").distinct().count() == n
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    for r in out.groupBy("split", "label").count().collect():
        share = sizes[r["split"]] * total[r["label"]] / n
        assert abs(r["count"] - share) < 2


def test_split_rejects_an_undeclared_class(hot):
    with pytest.raises(Exception, match="class not declared"):
        sampling.stratified_split(hot.filter("label is not null"), "label", "id", classes=(0.0,)).count()


def test_split_finds_the_classes_itself(hot):
    known = hot.filter("label is not null")
    a = sampling.stratified_split(known, "label", "id").select("id", "split")
    b = sampling.stratified_split(known, "label", "id", classes=(0.0, 1.0)).select("id", "split")
    assert rows(a) == rows(b)


def test_three_way_split_keeps_ties_in_training(spark):
    df = spark.range(2000).select(
        "id",
        F.when(F.col("id") % 10 == 0, 0.5).when(F.col("id") % 10 < 3, 1.0).otherwise(0.0).alias("main"),
        F.when(F.col("id") % 100 == 1, 1.0).otherwise(0.0).alias("rare"),
        (F.col("id") % 3 + 1).cast("int").alias("num_annotators"),
    )
    out = sampling.three_way_split(df, "id", "main", ["rare"]).cache()
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes == {"train": 1600, "val": 200, "test": 200}
    assert out.filter("main = 0.5 and split <> 'train'").count() == 0
    assert out.filter("rare = 1 and split <> 'train'").groupBy("split").count().count() == 2
    assert out.filter("split <> 'train' and num_annotators < 2 and stratum = 'negative'").count() == 0


def test_folds_are_balanced(hot):
    out = sampling.stratified_folds(hot, "label", "id", 5)
    for label in (0.0, 1.0, None):
        counts = [r["count"] for r in out.filter(F.col("label").eqNullSafe(F.lit(label))).groupBy("fold").count().collect()]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_resample_both_ways(spark):
    base = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, 1).otherwise(0).alias("label"))
    down = sampling.resample_ratio(base, "label", "id")
    assert {r["label"]: r["count"] for r in down.groupBy("label").count().collect()} == {0: 500, 1: 166}
    assert down.select("id").distinct().count() == 666
    few = spark.range(1000).select("id", F.when(F.col("id") < 2, 1).otherwise(0).alias("label"))
    up = sampling.resample_ratio(few, "label", "id")
    assert {r["label"]: r["count"] for r in up.groupBy("label").count().collect()} == {0: 998, 1: 332}
    assert up.select("id", "copy").distinct().count() == up.count()


def test_sample_is_reproducible(hot):
    a, b = sampling.seeded_sample(hot, 10, "id"), sampling.seeded_sample(hot.repartition(5), 10, "id")
    assert rows(a.select("id")) == rows(b.select("id")) and a.count() == 10
    assert sampling.seeded_sample(hot.limit(3), 10, "id").count() == 3


def test_annotators_keep_their_own_vote(spark):
    texts = spark.createDataFrame([("t", "isi", "['7', '99', '15']", "['1', '0', '1']")], "text_id string, text string, annotators_id string, toxicity string")
    people = spark.createDataFrame([("7", "F"), ("15", "M")], "annotator_id string, gender string")
    for small in (True, False):
        out = ann.explode_annotations(texts, people, ["toxicity"], small=small)
        assert rows(out.select("annotator_id", "gender", "toxicity", "text_id_index")) == [("15", "M", 1, 2), ("7", "F", 1, 0)]


def test_annotator_dimension(spark):
    data = [(1, "F ", 12, "Ibu Rumah Tangga", "1"), (2, "M", 29, "Pelajar", "x"), (3, "M", 30, "Pelajar", None), (4, "M", 45, "x", "3"), (5, "M", 60, "x", "2")]
    df = spark.createDataFrame(data, "annotator_id int, gender string, age int, `status pekerjaan` string, `president vote leaning` string")
    out = {r["annotator_id"]: r for r in ann.clean_dimension(df).collect()}
    assert [out[str(i)]["age_group"] for i in range(1, 6)] == ["Gen Z", "Gen Z", "Millenials", "Gen X", None]
    assert out["1"]["gender"] == "F" and out["1"]["status pekerjaan"] == "Tidak Bekerja"
    assert out["2"]["president vote leaning"] == "Tidak ada" and out["3"]["president vote leaning"] == "Tidak ada"
    assert out["5"]["president vote leaning"] == lex.CANDIDATES["2"]


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(1, "apel apel jeruk"), (2, "apel mangga"), (3, "jeruk mangga"), (4, "")], "doc_id int, text string")
    out = lexical.tfidf_weights(df, "doc_id", lexical.vectorizer_words(F.col("text")), (), 1, 1.0)
    got = {(r["doc_id"], r["term"]): r["weight"] for r in out.collect()}
    idf = math.log(5 / 3) + 1
    a, b = (1 + math.log(2)) * idf, idf
    assert got[(1, "apel")] == pytest.approx(a / math.hypot(a, b))
    assert got[(3, "mangga")] == pytest.approx(1 / math.sqrt(2))
    means = {r["term"]: r["mean_tfidf"] for r in lexical.tfidf_mean(df, out).collect()}
    assert means["mangga"] == pytest.approx(2 / math.sqrt(2) / 4)


def test_ngrams_form_after_stop_words(spark):
    df = spark.createDataFrame([(1, "makan yang enak makan enak"), (2, "x")], "doc_id int, text string")
    out = lexical.ngram_counts(df, lexical.vectorizer_words(F.col("text")), 2)
    assert rows(out.select("term", "n", "df")) == [("enak makan", 1, 1), ("makan enak", 2, 1)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 10, 10)], "v double")
    counts = [r["n"] for r in stats.histogram(df, "v", 5).orderBy("bin").collect()]
    assert counts == [2, 1, 0, 0, 2]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r["n"] for r in stats.histogram(same, "v", 2).orderBy("bin").collect()] == [0, 2]


def test_describe_exact_and_approximate(spark):
    df = spark.range(1, 1002).select(F.col("id").alias("v"))
    exact = profile.describe_numeric(df, ["v"]).first()
    assert (exact["min"], exact["p25"], exact["p50"], exact["p75"], exact["max"]) == (1.0, 251.0, 501.0, 751.0, 1001.0)
    approx = profile.describe_numeric(df, ["v"], approx=True).first()
    assert abs(approx["p50"] - 501) <= 1


def test_roles_and_time_columns(spark):
    df = spark.createDataFrame([("x", "isi teks yang cukup panjang", "2024-01-02", "n/a", 1.0)], "kode string, body string, created_at string, datetime string, a_label double")
    roles = profile.column_roles(df).first()
    assert roles["text_column"] == "body" and roles["label_columns"] == "a_label" and roles["main_label"] == "a_label"
    found = {r["column"]: r["is_time"] for r in profile.time_columns(df).collect()}
    assert found == {"created_at": True, "datetime": False}
    assert profile.time_columns(df.select("body")).count() == 0


def test_run_comparison_and_rules(spark):
    runs = spark.createDataFrame([("a", 0.5), ("a", 0.7), ("b", 0.8)], "variant string, f1 double")
    out = {r["variant"]: r for r in metrics.run_comparison(runs, "variant", "f1", "a").collect()}
    assert out["b"]["delta"] == pytest.approx(0.2) and out["a"]["std"] == pytest.approx(math.sqrt(0.02)) and out["b"]["std"] is None
    df = spark.createDataFrame([(1, 0, 1, 0), (0, 1, 0, 1), (1, 1, 0, 0)], "label int, pred int, y int, p int")
    cascade = metrics.cascade_rate(df, "label", "pred", {"s": ("y", "p")})
    assert cascade.first()["cascade_rate"] == 0.5
    fired = {r["rule"]: r["fires"] for r in metrics.iteration_advice(metrics.binary_metrics(df), cascade).collect()}
    assert fired == {"cascading": True, "false_positives": True, "false_negatives": False}


def test_strategies(spark):
    df = spark.createDataFrame([(1, 0.5, "train", 1), (2, 0.5, "test", 2), (3, 1.0, "train", 3)], "id int, y double, split string, num_annotators int")
    kept = {s: [(r["id"], r["weight"]) for r in lab.tie_strategy(df, s, "y").orderBy("id").collect()] for s in ("drop", "soft", "weighted")}
    assert kept == {"drop": [(3, 1.0)], "soft": [(1, 1.0), (3, 1.0)], "weighted": [(1, 0.5), (3, 1.0)]}
    phases = {r["id"]: r["phase"] for r in lab.annotator_strategy(df, "curriculum").collect()}
    assert phases == {1: 2, 2: 1, 3: 1}
    for bad in (lambda: lab.tie_strategy(df, "x", "y"), lambda: lab.annotator_strategy(df, "x"), lambda: lab.by_annotator_count(df, "x")):
        with pytest.raises(ValueError):
            bad()


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4, "label int, pred int")
    m = metrics.binary_metrics(df).first()
    assert m["accuracy"] == pytest.approx(0.7)
    assert m["precision_class_1"] == pytest.approx(0.6) and m["recall_class_1"] == pytest.approx(0.75)
    assert m["roc_auc"] == pytest.approx((0.75 + 4 / 6) / 2)
    assert m["precision_recall_auc"] == pytest.approx(0.75 * 0.6 + 0.25 * 0.4)
    single = metrics.binary_metrics(spark.createDataFrame([(1, 1)], "label int, pred int")).first()
    assert single["roc_auc"] == 0.5 and single["f1_class_0"] == 0.0


def test_argmax_takes_the_first_maximum(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],)], "s array<double>")
    assert df.select(metrics.argmax(F.col("s"))).first()[0] == 1


def test_score_auc_counts_ties_as_half(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)], "label int, score double")
    assert metrics.score_auc(df, "label", "score").first()["roc_auc"] == pytest.approx(0.875)


def test_csv_round_trip(spark, tmp_path):
    data = [("1", "['7']", 'kutip "dua", koma\ndan baris', None, "T"), ("2", "['8']", "  tepi  ", "p", "NaN")]
    columns = ["text_id", "annotators_id", "text", "initial_paragraph", "topic"]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns)).withColumns({c: F.lit("['1']") for c in lex.LABELS})
    tables.write_csv(df, str(tmp_path / "a"))
    back = tables.read_annotated(spark, str(tmp_path / "a"))
    got = {r["text_id"]: r for r in back.collect()}
    assert got["1"]["text"] == data[0][2] and got["2"]["text"] == "  tepi  " and got["2"]["topic"] is None
    assert len({r["row_pos"] for r in got.values()}) == 2
    people = spark.createDataFrame([("1", "F ", 20)], "annotator_id string, gender string, age int")
    people.write.json(str(tmp_path / "j"))
    assert tables.read_annotators_json(spark, str(tmp_path / "j")).first()["age"] == 20


def odd_csv(rows, end="\n"):
    """Rows as CSV bytes, values quoted where they hold a quote, a comma or a line break."""

    def value(x):
        return "" if x is None else '"' + x.replace('"', '""') + '"' if any(c in x for c in '",\n') else x

    return "".join(",".join(map(value, row)) + end for row in rows).encode()


@pytest.mark.parametrize(("size", "end"), [(16, "\n"), (57, "\n"), (57, "\r\n"), (1 << 20, "\n")])
def test_csv_in_ranges(spark, tmp_path, size, end):
    """Files cut into ranges of a few bytes: breaks, doubled quotes and empty lines within quotes on their edges."""
    r = random.Random(size)
    parts = ["a", "bc", "\n", '"', ",", " ", "é漢", "\n\n", '""', "x" * 30]
    files = [[("".join(r.choice(parts) for _ in range(r.randrange(9))).strip() or None, f"v{k}") for k in range(n)] for n in (60, 0, 1, 35)]
    for k, rows in enumerate(files):
        (tmp_path / f"f{k}.csv").write_bytes(odd_csv([("left", "right"), *rows], end) + (end.encode() if k == 0 else b""))
    schema = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        found = tables.read_csv(spark, str(tmp_path), schema, "at")
        if size < 100:
            assert spark.read.text(str(tmp_path), lineSep="\n").rdd.getNumPartitions() > 10
        got = sorted((x["at"], x["left"], x["right"]) for x in found.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == [(k, *row) for k, row in enumerate(x for rows in files for x in rows)]


@pytest.mark.parametrize("at_once", [1 << 16, 100])
def test_exact_quantiles(spark, monkeypatch, at_once):
    """Skewed values of two classes, far more of them than one task may order."""
    monkeypatch.setattr(ranks, "AT_ONCE", at_once)
    n = 1_000_000 if at_once > 100 else 30_000
    x = F.exp(F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e8) * F.when(F.col("id") % 2 == 0, 1).otherwise(-1)
    df = spark.range(n).select((F.col("id") % 3 == 0).cast("int").alias("g"), x.alias("x"), F.when(F.col("id") < 5, 1.5).alias("few"))
    shares = (0.0, 0.1, 0.25, 0.5, 0.95, 1.0)
    got = {(r["g"], r["measure"]): r["q"] for r in ranks.exact_quantiles(df, {"x": F.col("x"), "few": F.col("few")}, shares, ["g"]).collect()}
    want = df.groupBy("g").agg(*[F.percentile(c, F.array(*map(F.lit, shares))).alias(c) for c in ("x", "few")])
    for r in want.collect():
        assert got[r["g"], "x"] == pytest.approx(r["x"], rel=1e-12) and got[r["g"], "few"] == r["few"]


def test_quantile_plans_have_no_percentile(spark):
    df = spark.createDataFrame([(0, 1.5, 2), (1, 2.5, 7), (None, 1.0, 1), (0, None, 3)], "label int, chars double, words int")
    plans = [profile.describe_numeric(df, ["chars"]), stats.length_by_label(df, "label"), stats.box_stats(df, "chars"), quality.iqr_outliers(df, "words")]
    for found in plans:
        assert "percentile" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
        found.collect()
    assert stats.box_stats(df.limit(0), "chars").first()["q1"] is None


def test_first_rows(spark):
    df = spark.range(5000).select((F.col("id") % 50).alias("n"), F.col("id").cast("string").alias("term"))
    order = [F.col("n").desc(), F.col("term")]
    for k in (0, 1, 777, 6000):
        got = ranks.first_rows(df, order, k)
        assert "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(got.collect()) == sorted(df.orderBy(*order).limit(k).collect())


def test_metric_and_split_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "id int, split string")
    tables.write_split(df, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).filter("split = 'test'").count() == 1
    tables.write_metrics(metrics.binary_metrics(spark.createDataFrame([(1, 1)], "label int, pred int")), str(tmp_path / "m"))
    assert spark.read.csv(str(tmp_path / "m"), header=True).count() == 1


def test_prepare_has_no_copy_across_splits(spark):
    df = spark.range(600).select(
        "id",
        F.concat(F.lit("Teks "), (F.col("id") % 200).cast("string"), F.when(F.col("id") % 2 == 0, "!").otherwise("")).alias("text"),
        F.when(F.col("id") % 4 == 0, "['1']").otherwise("['0']").alias("toxicity"),
    )
    out = prepare.prepare(df, "id").cache()
    assert out.count() == 200 and out.filter("split = 'test'").count() == 40
    log = {r["step"]: (r["before"], r["after"]) for r in prepare.step_log(df, "id").collect()}
    assert log == {"drop_invalid": (600, 600), "resolve_conflicts": (600, 600), "deduplicate": (600, 200), "drop_unlabelled": (200, 200)}
    mixed = df.withColumn("toxicity", F.when(F.col("id") < 200, "['1']").otherwise("['0']"))
    changed = [prepare.step_log(d, "id").where("step = 'resolve_conflicts'").first()["changed"] for d in (df, mixed)]
    assert changed == [0, 200]


def test_stream_equals_batch(spark, tmp_path):
    data = [("1", "['7', '8']", "Halo @a!!!", None, "T")]
    columns = ["text_id", "annotators_id", "text", "initial_paragraph", "topic"]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns)).withColumns({c: F.lit("['1', '0']") for c in lex.LABELS})
    df.write.parquet(str(tmp_path / "in"))
    stream = annotate.annotate(annotate.read_stream(spark, str(tmp_path / "in")))
    annotate.write_stream(stream, str(tmp_path / "out"), f"annotate-{uuid.uuid4().hex}").awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(annotate.annotate(df))


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, text string, label double, toxicity string")
    assert lab.resolve_conflicts(df, F.col("text"), "label", "id").count() == 0
    assert lab.first_per_key(df, F.col("text"), "id").count() == 0
    assert lab.pool_revote(df, F.col("text"), "id", ["toxicity"]).count() == 0
    assert quality.duplicate_summary(df.select("text")).filter("n = 0").count() == 4
    assert quality.text_validity(df).count() == 6 and profile.missing_table(df).count() == 4
    assert stats.label_stats(df, ["label"]).first()["ratio"] == "N/A"
    assert sampling.stratified_split(df, "label", "id", classes=(0.0, 1.0)).count() == 0
    assert sampling.stratified_folds(df, "label", "id").count() == 0
    assert stats.histogram(df.withColumn("v", F.length("text")), "v").count() == 0
    assert lexical.ngram_counts(df, lexical.vectorizer_words(F.col("text")), 2).count() == 0
    assert lexical.vocabulary_stats(lexical.token_counts(df, lexical.plain_words(F.col("text"))), df).first()["tokens"] == 0
    assert prepare.step_log(df, "id").count() == 4
    assert stats.class_summary(df, "label").count() == 0


def test_rank_limit_is_applied_before_the_shuffle(hot):
    counts = lexical.token_counts(hot.filter("label is not null"), lexical.plain_words(F.col("text")), ["label"])
    plan = lexical.top_by(counts, "label", 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_rows_that_differ_by_a_microsecond(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00.000001' AS ts, 1 AS id, array(1.0D) AS a UNION ALL SELECT timestamp'2024-01-01 00:00:00.000002', 2, NULL")
    assert profile.duplicate_rows(df.select("ts")).first()["duplicate_rows"] == 0
    assert profile.duplicate_rows(df.unionAll(df)).first()["duplicate_rows"] == 2
    assert sampling.with_row_number(df, ["ts"], "id").count() == 2
    assert profile.duplicate_rows(spark.sql("SELECT 'a' AS x, 'b,1:c' AS y UNION ALL SELECT 'a,5:b', 'c'")).first()["duplicate_rows"] == 0


def test_macro_scores_over_occurring_classes(spark):
    df = spark.createDataFrame([(0, 0, "n"), (0, 0, "n"), (1, 1, "p"), (0, 1, "m")], "label int, pred int, g string")
    got = {r["g"]: r for r in metrics.binary_metrics(df, by=["g"]).collect()}
    assert [got[g]["macro_f1"] for g in "npm"] == [1.0, 1.0, 0.0]
    assert got["n"]["precision"] == got["n"]["recall"] == 1.0


def test_long_votes(spark):
    df = spark.createDataFrame([("['1', '1234567890', '0']",), ("['1', '99999999999999999999']",)], "v string")
    assert [list(r[0]) for r in df.select(v.parse_votes(F.col("v"))).collect()] == [[1, 1234567890, 0], [1, None]]
    assert [r[0] for r in df.select(v.vote_sum(v.parse_votes(F.col("v")))).collect()] == [1234567891, 1]


def test_explode_of_a_table_with_other_ids(spark):
    df = spark.createDataFrame([(7, "['a', 'b', 'x']", "['1', '0', '1']")], "doc int, annotators_id string, toxicity string")
    dim = spark.createDataFrame([("a", 1), ("b", 2)], "annotator_id string, age int")
    small = ann.explode_annotations(df, dim, ["toxicity"], small=True)
    large = ann.explode_annotations(df, dim, ["toxicity"])
    assert small.columns == large.columns and rows(small) == rows(large) and len(rows(small)) == 2


def largest_share(df, *columns):
    """Share of the rows that the fullest of the groups of columns has."""
    sizes = [r["count"] for r in df.groupBy(*columns).count().collect()]
    return max(sizes) / sum(sizes)


def test_ranges_follow_the_data(spark):
    scores = spark.range(20_000).select((F.col("id") / 1e8).alias("s"), F.col("id").alias("pos"))
    assert largest_share(scores.select(keys.range_of(scores, "s").alias("b")), "b") < 0.02
    sparse = spark.range(5000).select((F.col("id") * (1 << 33)).alias("pos"), F.lit("g").alias("g"))
    buckets = sparse.select(keys.range_of(sparse, "pos").alias("b"))
    assert largest_share(buckets, "b") < 0.02 and buckets.distinct().count() <= keys.RANGES
    got = sampling.with_row_number(sparse, ["g"], "pos").select("row_in_group", (F.col("pos") / (1 << 33)).cast("long"))
    assert all(a == b for a, b in got.collect())


def test_lookup_copies_only_groups_in_use(spark):
    df = spark.range(100).select("id", F.when(F.col("id") > 9, (F.col("id") % 3).cast("string")).alias("k"))
    groups = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    found = keys.lookup_by_key(df, groups, "k", "id", ["v"])
    assert dict(found.select("id", "v").collect()) == {i: i % 3 if i > 9 else None for i in range(100)}
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_deals_many_heavy_groups(spark):
    df = spark.range(22_000).select("id", (F.col("id") % 1100).cast("string").alias("k"))
    groups = df.groupBy("k").agg(F.max("id").alias("v"))
    assert keys.lookup_by_key(df, groups, "k", "id", ["v"]).where("v % 1100 = id % 1100").count() == 22_000
    one = spark.range(5000).select("id", F.lit("hot").alias("k"))
    dealt = one.select(F.pmod(F.xxhash64("id"), F.lit(keys.SALTS)).alias("salt"))
    assert largest_share(dealt, "salt") < 0.06


def test_resample_one_positive_is_dealt_out(spark):
    df = spark.range(40_001).select("id", (F.col("id") == 0).cast("int").alias("y"))
    drawn = sampling.resample_ratio(df, "y", "id", 3).where("y = 1")
    assert drawn.count() == 13_333 and drawn.select("copy").distinct().count() == 13_333
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert largest_share(drawn.select(F.spark_partition_id().alias("p")), "p") < 0.7
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_conflicts_use_plain_hash_aggregates(spark, hot):
    plan = lab.resolve_conflicts(hot, F.col("text"), "label", "id")._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_vocabulary_without_a_limit(spark):
    df = spark.createDataFrame([(i, f"a b{i % 5} c{i % 2}") for i in range(30)], "doc_id int, text string")
    out = lexical.tfidf_weights(df, "doc_id", lexical.vectorizer_words(F.col("text")), (), 1, 1.0)
    assert out.select("term").distinct().count() > 5


def test_time_formats(spark):
    df = spark.createDataFrame([("31/12/2024", "x"), ("2024-12-31", "y")], "date string, other string")
    assert profile.time_columns(df).first()["parse_rate"] == 0.5
    assert profile.time_columns(df, ["dd/MM/yyyy"]).first()["parse_rate"] == 1.0


def test_sweep_with_nulls_and_a_fine_grid(spark):
    df = spark.createDataFrame([(1, 0.5), (1, None), (0, 0.25), (0, 0.9), (None, 0.7)], "y int, s double")
    got = {r["threshold"]: (r["tp"], r["fp"], r["fn"], r["tn"]) for r in metrics.threshold_sweep(df, "y", "s", [i / 1000 for i in range(1000)]).collect()}
    assert len(got) == 1000 and got[0.0] == (1, 2, 1, 0) and got[0.5] == (0, 1, 2, 1) and got[0.95] == (0, 0, 2, 2)
