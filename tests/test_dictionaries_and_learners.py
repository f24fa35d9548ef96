"""Dictionaries as tables, splits by label combinations, learners on the whole vocabulary, long top lists."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from annospark.operators import dictionaries, lexical, sampling
from annospark.plans import baselines


def test_slang_of_a_large_table_keeps_spaces_and_order(spark):
    entries = {f"k{i}": f"normal{i}" for i in range(100_000)} | {"gw": "saya"}
    slang = spark.createDataFrame([(k, v) for k, v in entries.items()] + [("gw", "zz"), (None, "n"), ("nol", None)], "word string, replacement string")
    rng = random.Random(3)
    texts = [None, "", " ", "  GW  k5 ", "tanpa", "nol gw\tk1 K77"]
    # A third of all texts hold the same word.
    texts += [("gw " if i % 3 == 0 else "") + " ".join(rng.choice(["a", "k9", "k99999", "K12", ""]) for _ in range(i % 9)) for i in range(600)]
    texts.append(" ".join(f"k{i}" for i in range(20_000)))
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "id long, text string, _word string")
    got = {r["id"]: r for r in dictionaries.normalise_slang(df, "id", "text", slang).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = None if text is None else " ".join(entries.get(w.lower(), w) for w in text.split(" "))
        assert got[i]["cleaned"] == want and got[i]["text"] == text and got[i]["_word"] == "mine"


def test_emoji_table_and_empty_tables(spark):
    aliases = spark.createDataFrame([("😡", ":marah:"), ("☀", ":matahari:")], "word string, replacement string")
    df = spark.createDataFrame([(1, "a😡😡b☀😂"), (2, "polos"), (3, None), (4, "")], "id long, text string")
    out = dict(dictionaries.describe_emoji(df, "id", "text", aliases, into="text").select("id", "text").collect())
    assert out == {1: "a:marah::marah:b:matahari:😂", 2: "polos", 3: None, 4: ""}
    unchanged = dictionaries.describe_emoji(df, "id", "text", aliases.limit(0)).select("id", "cleaned").collect()
    assert dict(unchanged) == {1: "a😡😡b☀😂", 2: "polos", 3: None, 4: ""}
    assert dictionaries.describe_emoji(df.limit(0), "id", "text", aliases).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_label_quotas_hold_for_texts_with_several_rare_labels(seed):
    rng = random.Random(seed)
    labels, sizes = 5, Counter()
    for _ in range(3000):
        sizes[sum(1 << i for i, p in enumerate((0.4, 0.2, 0.08, 0.04, 0.02)) if rng.random() < p)] += 1
    parts = (("test", 0.1), ("val", 0.1))
    for quota in sampling._label_quotas(labels, sizes, 3000, parts):
        assert sum(quota.values()) == 300
        for i in range(labels):
            wanted = sum(n for c, n in sizes.items() if c >> i & 1) / 10
            assert abs(sum(n for c, n in quota.items() if c >> i & 1) - wanted) < 1


def test_label_split_follows_quotas(spark):
    df = spark.range(2000).select("id", *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(m)) == 0).cast("double").alias(c) for c, m in (("a", 2), ("b", 9), ("c", 40))])
    out = sampling.label_split(df, ["a", "b", "c"], "id").collect()
    assert len({r["id"] for r in out}) == 2000
    assert Counter(r["split"] for r in out) == {"train": 1600, "val": 200, "test": 200}
    for c in "abc":
        total = sum(r[c] for r in out)
        for part in ("test", "val"):
            assert abs(sum(r[c] for r in out if r["split"] == part) - total / 10) < 1
    assert sampling.label_split(df.limit(0), ["a", "b", "c"], "id").count() == 0


def test_most_frequent_terms_with_ties(spark):
    counts = spark.range(5000).select(F.format_string("t%04d", "id").alias("term"), (F.col("id") % 7 + 1).alias("cf"))
    rows = sorted(((r["term"], r["cf"]) for r in counts.collect()), key=lambda r: (-r[1], r[0]))
    for k in (0, 1, 714, 715, 2000, 5000, 9000):
        got = lexical.most_frequent(counts, k)
        assert "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, got.select("term", "cf").collect())) == sorted(rows[:k])


def test_term_index_is_dense(spark):
    vocabulary = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("term"))
    rows = lexical.term_index(vocabulary).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(3000))
    assert [r["term"] for r in rows] == sorted(r["term"] for r in rows)


@pytest.fixture(scope="module")
def labelled_texts(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        y = int(i % 4 == 0)
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 25))]
        words += rng.sample(["buruk", "jahat", "benci"], 2) if y else rng.sample(["baik", "indah", "damai"], 2)
        rows.append((i, " ".join(words), y, "test" if i % 5 == 0 else "train"))
    rows += [(1000, None, 0, "test"), (1001, "", 1, "test"), (1002, "takdikenal", 0, "test"), (1003, None, 0, "train")]
    return spark.createDataFrame(rows, "id long, text string, label int, split string")


@pytest.mark.parametrize("model", sorted(baselines.LEARNERS))
def test_learners_find_the_words_that_tell_classes_apart(spark, labelled_texts, model):
    found = {r["id"]: r for r in baselines.LEARNERS[model](labelled_texts, "id").collect()}
    assert len(found) == 83
    right = sum(r["label"] == r["pred"] for r in found.values() if r["id"] < 1000)
    assert right >= (79 if model == "linear_svm" else 70)
    # Texts without a word of the training part have one score.
    assert len({found[i]["score"] for i in (1000, 1001, 1002)}) == 1


@pytest.mark.parametrize("model", sorted(baselines.LEARNERS))
def test_learners_without_training_rows(labelled_texts, model):
    found = baselines.LEARNERS[model](labelled_texts.where("split = 'test'"), "id").collect()
    assert len(found) == 83 and {(r["score"], r["pred"]) for r in found} == {(0.0, 0)}
    assert baselines.LEARNERS[model](labelled_texts.limit(0), "id").count() == 0


def test_forest_tells_once_for_each_word_which_trees_ask_for_it(spark, monkeypatch):
    told = []
    pair = baselines._hash_pair
    monkeypatch.setattr(baselines, "_hash_pair", lambda value, name: told.append(name) or pair(value, name))
    rows = [(i, "baik sekali" if i % 2 else "buruk sekali", i % 2, "train" if i < 40 else "test") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string, label int, split string")
    got = baselines.random_forest(df, "id", trees=20, depth=3).collect()
    assert sorted(told) == ["h", "r"] and all(r["pred"] == r["label"] for r in got) and len(got) == 20


def test_descent_follows_the_words_of_the_nodes(spark):
    rows = [(["a", "b"], [1, 2]), (["c"], [1, 3]), ([], [1, 1]), (None, [1, 1])]
    df = spark.createDataFrame(rows, "words array<string>, nodes array<int>")
    got = baselines._descended(df, {1: "a", 8 + 3: "c", 8 + 2: "b"}, 8, 2).collect()
    assert [r["nodes"] for r in got][:3] == [[3, 5], [2, 7], [2, 1]] and got[3]["words"] is None


def test_csv_parts_have_as_many_files_as_their_rows_need(spark, tmp_path):
    from checks import queries_text

    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.md5(F.col("id").cast("string")), 20).alias("text"), F.lit("s").alias("source"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB"}
    for name, size in sizes.items():
        spark.conf.set(name, size)
    try:
        found = queries_text.csv_first_row(spark, str(tmp_path))
        files = found.inputFiles()
    finally:
        for name in sizes:
            spark.conf.unset(name)
    assert len([f for f in files if "part=2" in f]) > 1
    got = sorted((int(r["row_pos"]), int(r["text_id"])) for r in found.collect())
    extra = [i + 1000000007 for i in range(4000) if 5 <= i % 97 <= 9]
    want = sorted([*range(4000), *extra], key=lambda i: (min(i % 10, 1) + (i % 10 >= 4), i))
    assert got == list(enumerate(want))


def test_svm_scores_do_not_depend_on_the_blocks(spark, labelled_texts):
    whole = {r["id"]: r["score"] for r in baselines.linear_svm(labelled_texts, "id", block=10**9).collect()}
    cut = {r["id"]: r["score"] for r in baselines.linear_svm(labelled_texts, "id", block=150).collect()}
    assert cut.keys() == whole.keys() and all(cut[i] == pytest.approx(whole[i], abs=1e-9) for i in cut)
    assert baselines.linear_svm(labelled_texts, "id", rounds=0).where("score <> 0").count() == 0


def test_dictionary_never_takes_texts_apart_into_rows_of_places(spark):
    df = spark.createDataFrame([(i, "gw suka kopi " * 3, i) for i in range(50)] + [(None, "gw", 7), (60, None, 8)], "id long, text string, more int")
    slang = spark.createDataFrame([("gw", "saya"), ("kopi", "KOPI")], "word string, replacement string")
    out = dictionaries.normalise_slang(df, "id", "text", slang)
    assert "posexplode" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["id"]: (r["cleaned"], r["more"]) for r in out.collect()}
    assert all(got[i] == ("saya suka KOPI " * 3, i) for i in range(50)) and got[None] == ("gw", 7) and got[60] == (None, 8)
