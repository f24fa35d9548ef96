"""What the operators write and leave behind where keys outnumber the sketch's filter."""

import os
import time

import numpy as np
import pyarrow as pa
import pytest

from llm import ngram_join, shared, substring_dedup
from llm.ngram_join import ngram_components
from llm.substring_dedup import dedup_substrings
from tests.llm import brute
from tests.llm.conftest import prose


@pytest.fixture()
def many(spark):
    """Far more n-grams and anchors than 2**16 cells, few of them repeated."""
    shared.ship(spark)
    rows = [(k, prose(1000 + k, 900, 100_000)) for k in range(500)]
    rows += [(500 + k, prose(1000 + k, 850, 100_000) + " " + prose(2000 + k, 50, 100_000)) for k in range(20)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


def counted(monkeypatch, module):
    """Rows of the tables that the module writes, by their names."""
    rows = {}

    def written(df, name):
        out = shared.written(df, name)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(module, "written", written)
    return rows


def test_ngrams_of_one_text_make_no_rows(many, monkeypatch):
    rows, df = many
    tables = counted(monkeypatch, ngram_join)
    monkeypatch.setattr(ngram_join, "SKETCH_BITS", 16)
    got = sorted(tuple(r) for r in ngram_components(df).collect())
    assert got == sorted(brute.near(rows, 5, 80).elements())
    assert tables["joins"] <= 60  # 40 texts have a near copy


def test_windows_of_one_text_make_no_rows(many, monkeypatch):
    rows, df = many
    tables = counted(monkeypatch, substring_dedup)
    monkeypatch.setattr(substring_dedup, "SKETCH_BITS", 16)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r._kept) for r in dedup_substrings(df).collect())
    assert got == sorted(brute.substrings(rows).elements())
    assert tables["found"] <= 200 and tables["windows"] <= 60_000  # of 520 texts and 440,000 windows


@pytest.mark.parametrize("depth", [1, 2])
def test_sketch_of_more_keys_than_cells(spark, depth):
    shared.ship(spark)
    keys = np.random.default_rng(5).integers(0, 2**63, 200_000)
    sketch = shared.Sketch(len(keys), 16, depth, True)
    assert sketch.bits == 16 < sketch.fine
    counts = np.repeat([2, 3, 9, 20], 100)
    table = pa.table({"k": np.r_[keys, np.repeat(keys[:400], counts - 1)]})
    df = spark.createDataFrame(table).repartition(3)

    def cells(batches):
        yield from sketch.batches(b.column(0).to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for b in batches)

    sketch.merged(df.mapInArrow(cells, shared.CELLS))
    spread = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert sketch.repeated(spread[:400]).all() and sketch.repeated(spread[400:]).mean() < 0.3
    assert (sketch.level(spread[:400]) >= np.repeat([1, 2, 2, 3], 100)).all()


def test_steps_over_wide_gaps():
    cells = np.array([0, 65534, 65535, 65536, 400_000, (1 << 20) - 1, 1 << 20, (3 << 20) + 131070], dtype=np.uint64)
    (batch,) = shared.cell_batches([cells], 20)
    found = []
    for row in batch.to_pylist():
        steps = np.frombuffer(row["steps"], dtype="<u2")
        found += [(row["segment"] << 20) + c for c in np.cumsum(steps, dtype=np.int64)[steps < 65535].tolist()]
        assert set(row["counts"]) == {1}
    assert found == cells.tolist()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    before, key = shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    df = shared.written(spark.range(1000).repartition(5, "id"), "t")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and df.count() == 1000 and spark.conf.get(key) == was


def test_forget_deletes_written_tables_only(spark, tmp_path):
    one, other = (shared.written(spark.range(9), "t") for _ in range(2))
    spark.range(9).write.parquet(f"{tmp_path}/t")
    shared.forget(one, spark.read.parquet(f"{tmp_path}/t"))
    assert not os.path.exists(one.inputFiles()[0].removeprefix("file:")) and other.count() == 9 and os.path.exists(f"{tmp_path}/t")


def test_stages_leave_no_tables_that_are_used_up(many, spark, monkeypatch):
    import corpus_pipeline

    _, df = many
    for module in (ngram_join, substring_dedup):
        monkeypatch.setattr(module, "SKETCH_BITS", 16)
    folder = shared.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    stayed = shared.written(corpus_pipeline.near_copy_stage(spark, df, ""), "stayed")
    assert corpus_pipeline.passage_stage(spark, stayed, "").count() == stayed.count() == 500
    left = [name for run in set(os.listdir(folder)) - before for name in os.listdir(f"{folder}/{run}")]
    assert not {"prefixes", "joins", "sets", "postings", "pairs", "grouped", "runs", "windows"} & set(left)
