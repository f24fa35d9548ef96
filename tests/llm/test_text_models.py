"""Language ID, quality model and quality rules."""

import pytest
from pyspark.sql import functions as F

from llm import language_id, quality_model
from llm.quality_rules import Rule, default_rules, estimate, judge, with_features
from llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    got = QUERIES["op9_language_id"](spark, SF)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(docs, empty):
    rows = docs.withColumn("lang", F.when(F.col("doc_id") < 100, "en").when(F.col("doc_id") < 130, "xx"))
    model = language_id.train(rows)
    got = {r.doc_id: r for r in language_id.identify(rows, "text", model).collect()}
    assert [got[k].lang_pred for k in (5, 6, 7)] == ["und"] * 3 and got[5].score == 0
    assert got[10].lang_pred in ("en", "xx") and got[100].lang_pred == "xx"
    assert language_id.train(empty.withColumn("lang", F.lit("en"))) is None
    assert {r.lang_pred for r in language_id.identify(rows, "text", None).collect()} == {"und"}
    one = language_id.train(rows.withColumn("lang", F.lit("en")))
    assert {r.lang_pred for r in language_id.identify(rows, "text", one).collect()} == {"en", "und"}
    assert language_id.identify(empty, "text", model).count() == 0


def test_language_of_many_families():
    texts = {"en": "the of and that with", "de": "der und nicht zu ein", "fr": "le de et que une", "ru": "и в не на что", "fi": "ja on ei että se"}
    rows = [(k, t + f" x{i}") for k, t in texts.items() for i in range(30)]
    model = language_id.Discriminator(language_id.features([t for _, t in rows]), [k for k, _ in rows])
    assert set(model.families) == {"germanic", "romance", "slavic", "uralic"} and list(model.pairs) == [("de", "en")]
    assert model.predict(language_id.features(list(texts.values())))[0] == list(texts)


def test_quality_held_out(spark):
    got = QUERIES["op4_quality_model"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40 and sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_quality_odd_rows(spark, docs, empty):
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality")).where("doc_id < 60")
    labels = labels.unionAll(spark.createDataFrame([(None, 1), (5, None)], "doc_id bigint, quality bigint"))
    model = quality_model.train(docs, labels, "doc_id", "text", "quality")
    scored = docs.select("doc_id", quality_model.quality(model, F.col("text")).alias("s")).collect()
    assert len(scored) == docs.count() and all(0 < r.s < 1 for r in scored)
    by_id = {}
    for r in scored:
        by_id.setdefault(r.doc_id, set()).add(r.s)
    assert by_id[5] == by_id[6] and by_id[1] == by_id[2] and len(by_id[18]) == 1
    assert quality_model.train(docs, labels.limit(0), "doc_id", "text", "quality") is None
    assert {r[0] for r in docs.select(quality_model.quality(None, F.col("text"))).collect()} == {0.5}
    assert empty.select(quality_model.quality(model, F.col("text"))).count() == 0
    one = quality_model.train(docs, labels.withColumn("quality", F.lit(1)), "doc_id", "text", "quality")
    assert all(r[0] > 0.5 for r in docs.select(quality_model.quality(one, F.col("text"))).collect())


def test_quality_model_learns_an_interaction():
    import numpy as np

    r = np.random.default_rng(1)
    x = r.random((3000, 14))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_model.AdditiveModel(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.85


def test_rule_counts(docs, odd_docs):
    rows = with_features(docs).select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert len(rows) == len(odd_docs)
    for r in rows:
        assert tuple(r)[2:] == brute.counts(r.text)


@pytest.mark.parametrize("text", ["a\na\n\n\na b", "#*$%&|<>", "x y z x y z", "a a a a", "   x", "ab\r\nab\r\n", "a b"])
def test_rule_counts_of(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    assert tuple(with_features(df).select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").first()) == brute.counts(text)


def test_cascade(spark, docs, empty):
    docs = docs.withColumn("text", F.translate("text", "0123456789", "abcdefghij"))
    rows = {r.doc_id: r for r in judge(docs).collect()}
    assert rows[14].base_failed and not rows[14].kept and rows[5].broken_rule == "base"
    assert rows[1].kept and rows[1].broken_rule is None
    assert judge(empty).count() == 0
    symbols = spark.createDataFrame([(" ".join("word" + "abcdefghij"[i % 10] * (i // 10 + 1) + "###" for i in range(60)),)], "text string")
    assert judge(symbols).first().broken_rule == "symbols"
    both = judge(docs, rules=list(reversed(default_rules()))).select("doc_id", "kept")
    assert both.exceptAll(judge(docs).select("doc_id", "kept")).count() == 0
    assert "Python" not in judge(docs)._jdf.queryExecution().executedPlan().toString()


def test_order_by_rejection_per_cost(docs):
    from llm.quality_rules import Estimate

    never, often = Rule("never", F.lit(False)), Rule("often", F.col("n_words") >= 0)
    text = docs.select(F.coalesce("text", F.lit("")).alias("_text"))
    assert [e.rule.name for e in estimate(text, [never, often])] == ["often", "never"]
    assert Estimate(often, 2.0, 1.0).worth == 0.5
