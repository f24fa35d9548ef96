"""Substring dedup, n-gram join, line dedup."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm import line_dedup
from llm.line_dedup import dedup_lines
from llm.ngram_join import ngram_components
from llm.substring_dedup import dedup_substrings
from tests.llm import brute


@pytest.mark.parametrize("window", [5, 50])
def test_substrings(docs, odd_docs, window):
    got = dedup_substrings(docs, window=window)
    assert set(docs.columns) <= set(got.columns)
    found = Counter((r.doc_id, r.n_words, r.n_removed, r._kept) for r in got.collect())
    assert found == brute.substrings(odd_docs, window)


def test_substrings_empty(empty):
    assert dedup_substrings(empty).count() == 0


def test_substrings_keep_first_of_hot_passage(docs):
    got = {r.doc_id: r.n_removed for r in dedup_substrings(docs).where("doc_id >= 100").collect()}
    assert got[100] == 0 and all(got[100 + k] == 80 for k in range(1, 60))


@pytest.mark.parametrize(("n", "percent"), [(5, 80), (3, 60)])
def test_near(docs, odd_docs, n, percent):
    got = Counter(tuple(r) for r in ngram_components(docs, n=n, percent=percent).collect())
    assert got == brute.near(odd_docs, n, percent)


def test_near_random(spark):
    import random

    r = random.Random(3)
    rows = []
    for k in range(400):
        text = r.choice(rows)[1].split() if rows and r.random() < 0.8 else [f"v{r.randrange(30)}" for _ in range(r.randrange(1, 40))]
        for _ in range(r.randrange(3)):
            text[r.randrange(len(text))] = f"v{r.randrange(30)}"
        rows.append((k, " ".join(text)))
    got = Counter(tuple(x) for x in ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string"), n=2, percent=70).collect())
    assert got == brute.near(rows, 2, 70)


def test_near_without_links(spark, empty):
    assert ngram_components(empty).count() == 0
    one = spark.createDataFrame([(5, "a b c d e f")], "doc_id bigint, text string")
    assert [tuple(r) for r in ngram_components(one).collect()] == [(5, 2, 5)]


def lines(seed, n):
    return [f"line {seed} {i}" for i in range(n)]


def test_lines(spark):
    shared = lines(0, 40)
    rows = [(1, "\n".join(lines(1, 5) + shared + lines(2, 5))), (2, "\n".join(lines(3, 9) + shared)), (3, "\n".join(shared + lines(4, 3)))]
    rows += [(4, None), (5, ""), (6, "a"), (7, "a"), (None, "\n".join(shared)), (8, "\n".join(lines(5, 30) + lines(5, 30))), (9, "\n\n\n\n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_lines", F.lit("x"))
    got = {r.doc_id: r for r in dedup_lines(df).collect()}
    assert len(got) == len(rows) and got[1].text == rows[0][1] and got[None].text == rows[7][1]
    assert got[4].text is None and got[5].text == "" and got[6].text == got[7].text == "a" and got[4].n_lines == 0
    for k, own in ((2, lines(3, 9)), (3, lines(4, 3))):
        left = got[k].text.split("\n")
        assert [x for x in left if x in own] == own  # its own lines stay, in order
        assert got[k].n_removed_lines >= 24 and len(left) + got[k].n_removed_lines == got[k].n_lines
        assert all(x in shared for x in left if x not in own)
    assert 60 - got[8].n_removed_lines == len(got[8].text.split("\n")) < 45


def test_lines_hot_chunk_and_repeated_rows(spark):
    shared = "\n".join(lines(0, 30))
    rows = [(k, shared) for k in range(50)] + [(0, shared), (0, shared)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == 52 and all(r.text == shared for r in got if r.doc_id == 0)
    left = {r.text for r in got if r.doc_id}
    assert len(left) == 1 and len(left.pop()) < len(shared) / 2
    assert dedup_lines(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_lines_use_no_python(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id bigint, text string")
    assert "Python" not in dedup_lines(df)._jdf.queryExecution().executedPlan().toString()


def test_lines_of_whole_copies_all_go(spark):
    texts = ["\n".join(lines(k, 2 + k % 7)) for k in range(60)]
    df = spark.createDataFrame([*enumerate(texts), *((100 + k, t) for k, t in enumerate(texts))], "doc_id bigint, text string")
    got = {r.doc_id: r for r in dedup_lines(df).collect()}
    assert all(got[k].text == t for k, t in enumerate(texts))
    assert all(got[100 + k].text == "" and got[100 + k].n_removed_lines == got[100 + k].n_lines for k in range(60))


def short_blocks():
    """Rows of blocks of 2 to 8 lines that others have too, own lines between; repeated ids, nulls, overlapping repeats."""
    import random

    r = random.Random(4)
    blocks = [lines(f"b{k}", 2 + k % 7) for k in range(25)]
    rows = [(k, "\n".join(sum(([*r.choice(blocks), *lines(f"{k}.{j}", r.randrange(3))] for j in range(r.randrange(6))), lines(k, 1)))) for k in range(120)]
    rows += [(200 + k, "\n".join(r.choice(["a", "b", ""]) for _ in range(k))) for k in range(12)]
    return [*rows, (220, "c\nc\nc\nc\nc"), (None, rows[3][1]), (5, rows[9][1]), (5, rows[9][1]), (221, None), (222, "\r\n\r\n")]


def test_lines_against_brute_force(spark):
    got = dedup_lines(spark.createDataFrame(short_blocks(), "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed_lines) for r in got) == brute.repeated_lines(short_blocks())


def test_lines_query_against_brute_force(spark):
    from llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_removed_lines) for r in QUERIES["op8_line_dedup"](spark, sf).collect())
    assert got == brute.repeated_lines(rows)


def test_share_of_short_blocks_removed(spark):
    """Lines removed of blocks of several lengths, against a look-up of all pairs of lines."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    pairs = brute.repeated_pairs(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    lost = sum(r.n_removed_lines for r in dedup_lines(df).collect())
    assert lost >= 0.8 * sum(map(len, pairs.values()))
    for size, share in ((3, 0.2), (6, 0.5), (10, 0.7)):
        docs = []
        for k in range(150):
            block = lines(f"b{k}", size)
            docs += [(2 * k + j, "\n".join([*lines(f"x{k}{j}", 2 + k % 3), *block, *lines(f"y{k}{j}", 2 + k % 4)])) for j in (0, 1)]
        got = dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).agg(F.sum("n_removed_lines")).first()[0]
        assert got >= share * 150 * size


def test_every_repeated_pair_of_lines_goes(spark):
    """Blocks of any length at any place: what chunks leave is found by pairs."""
    for size in (2, 3, 6):
        docs = []
        for k in range(100):
            block = lines(f"b{k}", size)
            docs += [(2 * k + j, "\n".join([*lines(f"x{k}{j}", 1 + (k + j) % 5), *block, *lines(f"y{k}{j}", 1 + k % 4)])) for j in (0, 1)]
        got = {r.doc_id: r.n_removed_lines for r in dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
        assert got == {k: size * (k % 2) for k in range(200)}


def test_columns_of_any_name_and_ids_of_text(spark):
    shared = " ".join(f"w{k}" for k in range(60))
    rows = [("a", shared + "\nlast line"), ("b", shared + "\nlast line"), (None, shared)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    names = ["id", "body", "row", "chunks", "hash", "gone", "start", "_id", "_text", "_row", "_runs", "_at", "_n", "first", "piece", "s"]
    df = df.select("*", *[F.lit(n).alias(n) for n in names])
    for got in (dedup_lines(df), dedup_substrings(df.withColumn("_kept", F.lit(1)))):
        assert set(df.columns) < set(got.columns) and len(set(got.columns)) == len(got.columns)
        assert all(r[n] == n for r in got.collect() for n in names)
    assert {r.doc_id: r.text for r in dedup_lines(df).collect()} == {"a": rows[0][1], "b": "", None: shared}
    assert {r.doc_id: r.n_removed for r in dedup_substrings(df).collect()} == {"a": 0, "b": 62, None: 0}


def thue_morse(n: int, a: str, b: str) -> list[str]:
    return [b if bin(k).count("1") % 2 else a for k in range(n)]


def test_sequences_that_polynomials_modulo_a_power_of_two_confuse(spark):
    """Two texts and their copies, alike in every polynomial hash modulo 2**64, without a window in common."""
    one = [f"u{k} {x}" for k, x in enumerate(thue_morse(4096, "alpha", "beta"))]
    other = [f"u{k} {x}" for k, x in enumerate(thue_morse(4096, "beta", "alpha"))]
    rows = [(1, " ".join(one)), (2, " ".join(one)), (3, " ".join(other)), (4, " ".join(other))]
    rows += [(5, " ".join(thue_morse(4096, "alpha", "beta"))), (6, " ".join(thue_morse(4096, "beta", "alpha")))]
    long = ["".join(thue_morse(4096, "a", "b")), "".join(thue_morse(4096, "b", "a"))]  # unlike words of equal polynomials
    rows += [(7 + k, " ".join([long[k // 2], *(f"v{j}" for j in range(49))])) for k in range(4)]
    got = dedup_substrings(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r._kept) for r in got) == brute.substrings(rows)


def test_lines_of_one_hash_are_compared(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_hash", lambda line: F.length(line).cast("long"))
    rows = [(1, "aa\nbbb"), (2, "aa\nccc"), (3, "dddd\neeeee"), (4, "dddd\neeeee")]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == dict(rows) | {4: ""}
