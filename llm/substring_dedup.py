"""Removal of long passages that an earlier document has, word for word.

A window is ``window`` consecutive words of one document. Words go if a window that covers them also starts in a document
with a smaller id; windows are judged on the input.

1. Sketch. Every window has an anchor, its 36-word run of the smallest hash; equal windows have equal anchors. Each task
   counts, in a count-min sketch, the documents of each anchor, and the merged sketch never gives less than the number of
   documents that hold a window.
2. Windows whose anchor is estimated in two documents or more are grouped exactly, by 96 bits of their words. First come
   runs of such windows, cut where an anchor of a certain kind begins, so that texts with a passage in common have equal runs
   inside it. Of equal runs (a cryptographic digest of all their words), all but those of the smallest id go without a look
   at their windows. Then come the windows of the remaining runs: each passage's once, and those at the ends of passages.
   Many of these share an anchor only, so a sketch of the windows themselves leaves out those that one text has.

Defined results: null text has no words; a null id takes no part, its text stays; rows that share an id don't remove each
other's words; texts shorter than a window stay; ids are of any type that has an order; other columns stay as they are,
whatever their names, but for ``_kept``, ``n_words`` and ``n_removed``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.shared import CELLS, Sketch, forget, free_name, sketch_for, with_first, written
from llm.words import BASES, Block, blocks, mixed, spans_hash

ANCHOR = 36
#: One of 2**CUT_BITS anchors cuts a run where it begins.
CUT_BITS = 3
#: Rows of the sketch, and cells of a row of its filter at most: tasks receive 4 * 2**27 / 8 bytes.
DEPTH, SKETCH_BITS = 4, 27
#: Rows of an output batch, at most.
ROWS = 1000
_RUN = pa.struct([("h1", pa.int64()), ("h2", pa.int32()), ("at", pa.int32()), ("n", pa.int32())])
_RUNS = "array<struct<h1:bigint,h2:int,at:int,n:int>>"


def _smallest(values: np.ndarray, span: int) -> np.ndarray:
    """Smallest of each ``span`` neighbours."""
    have = 1
    while have < span:
        step = min(have, span - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def _anchors(block: Block, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and anchor of each window of the block."""
    text, at = block.windows(window)
    if not len(at):
        return text, at, np.zeros(0, dtype=np.uint64)
    size = min(ANCHOR, window)
    n = len(hashes) - size + 1
    grams = spans_hash(hashes, np.arange(n), np.arange(n) + size, BASES[1])
    return text, at, _smallest(grams, window - size + 1)[at]


def _counted(sketch: Sketch, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def keys():
            for batch in batches:
                for block in blocks(batch.column(0)):
                    text, _, anchor = _anchors(block, block.hashes(), window)
                    fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])][: len(anchor)]
                    pairs = np.unique(np.stack([text[fresh].astype(np.uint64), anchor[fresh]]), axis=1)
                    yield pairs[1]

        yield from sketch.batches(keys())

    return run


def _two_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of values[start:end]."""
    one, two = (spans_hash(values, start, end, b) for b in BASES)
    return one.view(np.int64), (two >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _runs(sketch: Sketch, window: int, column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]] | None:
    """Runs of windows that may be repeated, cut by content: their number in each text, and the fields of all."""

    def digests(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = np.ascontiguousarray(hashes).view(np.uint8)
        found = [hashlib.blake2b(values[8 * a : 8 * b], digest_size=12).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        fields = np.frombuffer(b"".join(found), dtype=[("h1", "<i8"), ("h2", "<i4")])
        return fields["h1"].copy(), fields["h2"].copy()

    def of_block(block: Block) -> tuple[np.ndarray, ...]:
        hashes = block.hashes()
        text, at, anchor = _anchors(block, hashes, window)
        hit = sketch.repeated(anchor)
        text, at, anchor = text[hit], at[hit], anchor[hit]
        cut = (anchor[1:] != anchor[:-1]) & (mixed(anchor[1:]) >> np.uint64(64 - CUT_BITS) == 0)
        start = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (text[1:] != text[:-1]) | cut][: len(at)])
        n = np.diff(np.r_[start, len(at)])
        text, at = text[start], at[start]
        h1, h2 = digests(hashes, at, at + n + window - 1)
        return np.bincount(text, minlength=block.n), h1, h2, (at - block.first[text]).astype(np.int32), n.astype(np.int32)

    parts = [of_block(b) for b in blocks(column)]
    if not parts:
        return None
    per_text, *fields = (np.concatenate(x) for x in zip(*parts, strict=True))
    return per_text, fields


def _found(sketch: Sketch, window: int, id_at: int, text_at: int, repeated: bool, runs: str = "_runs"):
    """Rows that may hold repeated windows, with their runs; or else all other rows, as they come out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if (found := _runs(sketch, window, batch.column(text_at))) is None:
                continue
            per_text, fields = found
            hit = (per_text > 0) & batch.column(id_at).is_valid().to_numpy(zero_copy_only=False)
            if not repeated:
                yield from _without(window, text_at)([_with_none(batch.filter(pa.array(~hit)))])
                continue
            keep = np.repeat(hit, per_text)
            offsets = pa.array(np.r_[0, np.cumsum(per_text[hit])].astype(np.int32))
            values = pa.StructArray.from_arrays([pa.array(x[keep]) for x in fields], fields=list(_RUN))
            rows = batch.filter(pa.array(hit))
            yield pa.record_batch([*rows.columns, pa.ListArray.from_arrays(offsets, values)], names=[*batch.schema.names, runs])

    return run


def _with_none(batch: pa.RecordBatch) -> pa.RecordBatch:
    none = pa.nulls(len(batch), pa.list_(pa.int32()))
    return pa.record_batch([*batch.columns, none, none], names=[*batch.schema.names, "_at", "_n"])


def _expanded(window: int):
    """(row, id, text, at[], n[]) to the windows of those runs, equal ones of a text in one row with all their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, ids = batch.column(0).to_numpy(), batch.column(1)
            starts, counts = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for block in blocks(batch.column(2)):
                hashes, texts, where = block.hashes(), [], []
                for d in range(block.n):
                    at = np.concatenate([np.arange(a, a + n) for a, n in zip(starts[block.row + d], counts[block.row + d], strict=True)])
                    texts.append(np.full(len(at), d))
                    where.append(at)
                d, at = np.concatenate(texts), np.concatenate(where)
                first = block.first[d] + at
                h1, h2 = _two_hashes(hashes, first, first + window)
                order = np.lexsort((h2, h1, d))  # equal windows stay in the order of their places
                same = (d[order][1:] == d[order][:-1]) & (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
                fresh = np.r_[True, ~same][: len(d)]
                leader = np.empty(len(d), dtype=np.int64)  # of each window, the first that equals it
                leader[order] = order[fresh][np.cumsum(fresh) - 1]
                start = np.flatnonzero(leader == np.arange(len(d)))  # in the order of places, which is stored in least room
                by_leader = np.argsort(leader, kind="stable")
                ends = np.cumsum(np.bincount(leader, minlength=len(d))[start])
                places = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(at[by_leader].astype(np.int32)))
                own = d[start] + block.row
                yield pa.record_batch(
                    [pa.array(h1[start]), pa.array(h2[start]), pa.array(row[own]), ids.take(pa.array(own)), places],
                    names=["h1", "h2", "_row", "_id", "at"],
                )

    return run


def _window_cells(sketch: Sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sketch.batches(batch.column(0).to_numpy().view(np.uint64) for batch in batches)

    return run


def _seen_again(sketch: Sketch):
    """Windows that more than one text may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(sketch.repeated(batch.column(0).to_numpy().view(np.uint64))))

    return run


def _without(window: int, text_at: int):
    """Takes the removed windows, in the last two columns (first windows, their number), out of the texts."""

    def kept(text: str | None, at: list[int] | None, n: list[int] | None) -> tuple[str, int, int]:
        words = (text or "").encode().split()
        total = len(words)
        if at:
            edges = np.zeros(total + 1, dtype=np.int64)
            np.add.at(edges, at, 1)
            np.add.at(edges, np.array(at) + np.array(n) + window - 1, -1)
            stays = np.cumsum(edges)[:-1] == 0
            words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
        return b" ".join(words).decode(), total, total - len(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), ROWS):
                batch = whole.slice(start, ROWS)
                columns = (batch.column(i) for i in (text_at, -2, -1))
                found = [kept(*(x.as_py() for x in row)) for row in zip(*columns, strict=True)]
                texts, total, gone = zip(*found, strict=True)
                added = [pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
                yield pa.record_batch([*batch.columns[:-2], *added], names=[*batch.schema.names[:-2], "_kept", "n_words", "n_removed"])

    return run


def dedup_substrings(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """The documents with ``_kept`` (kept words joined by one space), ``n_words`` and ``n_removed``."""
    documents = documents.drop("n_words", "n_removed", "_kept")
    sketch = sketch_for(documents, text_col, 40, SKETCH_BITS, DEPTH)
    sketch.merged(documents.where(F.col(id_col).isNotNull()).select(text_col).mapInArrow(_counted(sketch, window), CELLS))

    id_at, text_at = documents.columns.index(id_col), documents.columns.index(text_col)
    listed, row, at, n = (free_name(documents, x) for x in ("_runs", "_row", "_at", "_n"))
    schema = T.StructType([*documents.schema.fields, *T._parse_datatype_string(f"`{listed}` {_RUNS}").fields])
    found = documents.mapInArrow(_found(sketch, window, id_at, text_at, True, listed), schema)
    found = written(found.withColumn(row, F.monotonically_increasing_id()), "found")

    slim = found.select(F.col(row).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(listed).alias("_runs"))
    runs = written(with_first(slim.select("_row", "_id", F.inline("_runs")), ["h1", "h2"], "_id"), "runs")
    later = F.col("_id") > F.col("first")
    own = runs.where(F.coalesce(~later, F.lit(True))).groupBy("_row").agg(F.collect_list(F.struct("at", "n")).alias("s"))
    windows = slim.select("_row", "_id", "_text").join(own, "_row").select("_row", "_id", "_text", "s.at", "s.n")
    kind = documents.schema[id_col].dataType.simpleString()
    windows = written(windows.mapInArrow(_expanded(window), f"h1 bigint, h2 int, _row bigint, _id {kind}, at array<int>"), "windows")
    again = Sketch(windows.count(), SKETCH_BITS, 2)
    again.merged(windows.select("h1").mapInArrow(_window_cells(again), CELLS))
    repeated = with_first(windows.mapInArrow(_seen_again(again), windows.schema), ["h1", "h2"], "_id")
    repeated = repeated.where(later).select("_row", F.explode("at").alias("at"), F.lit(1).alias("n"))
    gone = repeated.unionAll(runs.where(later).select("_row", "at", "n"))
    gone = written(gone.groupBy("_row").agg(F.collect_list(F.struct("at", "n")).alias("s")), "gone")
    forget(runs, windows)

    rest = [found[f"`{c}`"] for c in documents.columns]
    added = T._parse_datatype_string("_kept string, n_words bigint, n_removed bigint").fields
    schema = T.StructType([*documents.schema.fields, *added])
    changed = found.join(gone, found[row] == gone["_row"], "left").select(*rest, gone["s"]["at"].alias(at), gone["s"]["n"].alias(n))
    changed = changed.mapInArrow(_without(window, text_at), schema)
    # All other texts are looked through again, which takes less room than keeping them meanwhile.
    return documents.mapInArrow(_found(sketch, window, id_at, text_at, False), schema).unionAll(changed)
