"""Resampled differences, slice lattices, n-grams by levels, votes of any length."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from annospark.functions import votes
from annospark.operators import lexical, metrics, significance


def macro_f1(cells):
    tp, fp, fn, tn = cells
    f1 = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
    f0 = 2 * tn / (2 * tn + fp + fn) if tn else 0.0
    classes = (tp + fp + fn > 0) + (tn + fp + fn > 0)
    return (f0 + f1) / classes if classes else 0.0


def confusion(rows, run, weights):
    cells = [0, 0, 0, 0]
    for row, w in zip(rows, weights, strict=True):
        y, p = row[1], row[run]
        if y is not None and p is not None:
            cells[{(1, 1): 0, (0, 1): 1, (1, 0): 2, (0, 0): 3}[y, p]] += w
    return cells


def weights_of(rows, replicate, seed):
    block, draw = divmod(replicate - 1, 8)
    out = []
    for row in rows:
        digest = hashlib.md5(f"{'' if row[0] is None else row[0]}#{seed}#{block}".encode()).hexdigest()
        number = int(digest[4 * draw : 4 * draw + 4], 16)
        out.append(sum(number >= cut for cut in significance.POISSON_CUTS))
    return out


def test_intervals_are_those_of_a_plain_bootstrap(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        y = rng.random() < 0.4
        noisy = lambda share: int(y if rng.random() < share else not y)
        rows.append((i // 2, int(y), noisy(0.6), noisy(0.9), noisy(0.6)))
    rows += [(None, 1, 0, 1, None), (None, None, 1, 1, 1), (7, 0, None, 0, 0)]
    df = spark.createDataFrame(rows, "id long, label int, control int, better int, block int").withColumn("digest", F.lit("mine")).repartition(5)
    got = {r["variant"]: r for r in significance.difference_intervals(df, "id", "label", "control", ["better", "block", "control"], replicates=50, seed=9).collect()}
    for name, run in (("better", 3), ("block", 4)):
        ones = [1] * len(rows)
        assert got[name]["score"] == pytest.approx(macro_f1(confusion(rows, run, ones)))
        assert got[name]["control_score"] == pytest.approx(macro_f1(confusion(rows, 2, ones)))
        deltas = []
        for r in range(1, 51):
            w = weights_of(rows, r, 9)
            deltas.append(macro_f1(confusion(rows, run, w)) - macro_f1(confusion(rows, 2, w)))
        deltas.sort()
        assert got[name]["low"] == pytest.approx(deltas[0]) and got[name]["high"] == pytest.approx(deltas[-1])
        assert got[name]["significant"] == (deltas[0] > 0 or deltas[-1] < 0)
    assert got["better"]["significant"] and not got["control"]["significant"]
    assert got["control"]["delta"] == 0 and got["control"]["p_value"] == 1
    assert got["better"]["p_value"] == pytest.approx(2 / 51)


def test_draws_have_mean_and_variance_of_one():
    draws = [w for r in range(1, 9) for w in weights_of([(i,) for i in range(3000)], r, 1)]
    mean = sum(draws) / len(draws)
    assert mean == pytest.approx(1, abs=0.03) and sum((d - mean) ** 2 for d in draws) / len(draws) == pytest.approx(1, abs=0.05)


def test_intervals_of_no_rows_and_wrong_arguments(spark):
    df = spark.createDataFrame([], "id long, label int, c int, v int")
    assert significance.difference_intervals(df, "id", "label", "c", ["v"]).count() == 0
    for bad in ({"metric": "f2"}, {"replicates": 1}, {"confidence": 1.0}):
        with pytest.raises(ValueError):
            significance.difference_intervals(df, "id", "label", "c", ["v"], **bad)


def test_lattice_tells_null_values_from_left_out_dimensions(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2]), rng.choice(["a", "b"]), rng.randint(0, 1), rng.randint(0, 1)) for _ in range(200)]
    rows += [("x", 1, "a", None, 1)]
    df = spark.createDataFrame(rows, "tp string, year int, c string, label int, pred int")
    dims = ["tp", "year", "c"]
    want = Counter()
    for *values, y, p in rows:
        if y is not None:
            for level in range(8):
                if bin(level).count("1") >= 1:
                    key = tuple(None if level >> (2 - i) & 1 else (None if v is None else str(v)) for i, v in enumerate(values))
                    want[level, key] += 1
    want = {k: n for k, n in want.items() if n >= 20}
    out = metrics.slice_lattice(df.withColumnRenamed("tp", "topic"), ["topic", "year", "c"], min_support=20, at_most=2)
    got = {(r["level"], (r["topic"], r["year"], r["c"])): r["n"] for r in out.collect()}
    assert got == want and (7, (None, None, None)) in got and len(dims) == 3
    assert metrics.slice_lattice(df.limit(0), ["year", "c"]).count() == 0
    plain = metrics.binary_metrics(df).first()
    whole = metrics.slice_lattice(df, ["year"], at_most=0).first()
    assert whole["macro_f1"] == pytest.approx(plain["macro_f1"]) and whole["n"] == 200


@pytest.mark.parametrize("bits", [25, 7])
def test_levels_give_the_rows_of_plain_counts(spark, bits):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab cd ef gh yang".split() + [f"r{rng.randint(0, 400)}"]) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    texts += [None, "", "yang", "ab ab ab ab", "ab cd " * 5000]
    df = spark.createDataFrame([(i, t, i % 3 or None, "mine") for i, t in enumerate(texts)], "id long, text string, cls int, _at string")
    tokens = lexical.vectorizer_words(F.col("text"))
    for n, by in ((1, []), (2, ["cls"]), (3, []), (4, ["cls", "_at"])):
        want = lexical.ngram_counts(df, tokens, n, ["yang"], by, min_df=3).select(*by, "term", "n", "df")
        got = lexical.level_ngram_counts(df, tokens, n, 3, ["yang"], by, bits).select(*by, "term", "n", "df")
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert lexical.level_ngram_counts(df.limit(0), tokens, 3, 2).count() == 0


def test_votes_of_any_length_keep_their_sign(spark):
    long = "9" * 40
    raws = [f"['{long}', '0', '0']", f"[-{long}, 1, 1]", f"['{2**62}', '{2**62}', '{2**62}']", "['0000000000000000000000001', '0']", "['1', '1', '0']", f"[{long}.5]", None, long]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "id int, raw string")
    parsed = df.withColumn("v", votes.parse_votes(F.col("raw")))
    got = {r["id"]: (r["v"], r["label"]) for r in parsed.withColumn("label", votes.majority(F.col("v"))).collect()}
    top = votes.VOTE_LIMIT
    assert got[0] == ([top, 0, 0], 1.0) and got[1] == ([-top, 1, 1], 0.0) and got[2] == ([top] * 3, 1.0)
    assert got[3][0] == [1, 0] and got[4] == ([1, 1, 0], 1.0) and got[5] == ([top], 1.0)
    assert got[6] == ([], None) and got[7] == ([], None)


def test_ngrams_are_counted_in_batches_before_the_aggregate(spark, monkeypatch):
    rng = random.Random(8)
    texts = [[rng.choice(["a", "b", "the", "", "c d"]) for _ in range(rng.randint(0, 12))] for _ in range(120)] + [None, [], [""], ["a"] * 300]
    rows = [(i, t, rng.choice(["x", "y", None])) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, t array<string>, cls string")
    for size in (5, 10**9):
        monkeypatch.setattr(lexical, "BYTES_AT_ONCE", size)
        for n, by in ((1, ["cls"]), (2, []), (2, ["cls"]), (3, [])):
            times, docs = Counter(), Counter()
            for _, t, c in rows:
                kept = [w for w in t or () if w != "the"]
                grams = [((c,) if by else ()) + (" ".join(kept[i : i + n]),) for i in range(len(kept) - n + 1)]
                times.update(grams)
                docs.update(set(grams))
            found = lexical.ngram_counts(df, F.col("t"), n, ["the"], by)
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert "MapInArrow" in plan and "explode" not in plan
            assert {tuple(r)[:-2]: tuple(r)[-2:] for r in found.collect()} == {k: (times[k], docs[k]) for k in times}


def test_parts_of_documents_grow_in_number_not_in_size(spark, tmp_path):
    from checks import fixtures

    spark.range(70_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text")).write.parquet(str(tmp_path / "documents.parquet"))
    docs = fixtures.documents(spark, str(tmp_path))
    assert docs.rdd.getNumPartitions() >= 9 and docs.count() == 70_000
