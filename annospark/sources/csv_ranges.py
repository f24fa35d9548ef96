"""CSV files of any size by many tasks, line breaks inside quotes and row numbers included.

Spark's text reader cuts a file into blocks. Whether a block begins inside quotes follows from the quotes in all blocks before
it, so a first pass counts, for each block, its quotes and the records that begin in it, under both assumptions, and keeps the
pieces of records that reach over its edges. Running sums over the blocks, one row each, give every block's true state and
its first record's number. A second pass then cuts each block into records alone; the pieces at edges are put together from
the first pass.

Files hold a header line each, quotes only around values, quotes inside values doubled, and lines that end in ``\\n`` or ``\\r\\n``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of an output batch.
ROWS = 5000
_BLOCK = "block bigint, file string, at bigint, quotes bigint, even bigint, odd bigint, head string, tail_even string, tail_odd string, crlf boolean"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(block, file, at, value) of every line, the lines of a block in order; ``block`` names file and offset."""
    file, at = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return spark.read.text(path, lineSep="\n").select(F.xxhash64(file, at).alias("block"), file.alias("file"), at.alias("at"), "value")


class _Scan:
    """State of one block under one assumption: whether it begins inside quotes."""

    def __init__(self, opened: bool):
        self.open, self.starts = opened, 0
        self.head: list[str] | None = [] if opened else None
        self.tail: list[str] = []

    def take(self, line: str, quotes: int) -> None:
        if not self.open:
            if line in ("", "\r"):
                return
            self.starts, self.tail = self.starts + 1, []
        if self.starts:
            self.tail.append(line)
        else:
            self.head.append(line)
        self.open ^= quotes & 1
        if not self.open:
            self.tail = []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to one row for each block."""

    def row() -> pa.RecordBatch:
        block, file, at = place
        values = [block, file, at, quotes, even.starts, odd.starts, "\n".join(odd.head)]
        values += ["\n".join(s.tail) if s.tail else None for s in (even, odd)]
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
        names = [x.split()[0] for x in _BLOCK.split(", ")]
        return pa.record_batch([pa.array([v], t) for v, t in zip([*values, crlf], types, strict=True)], names=names)

    place, quotes, crlf, even, odd = None, 0, False, None, None
    for batch in batches:
        for block, file, at, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if place is None or block != place[0]:
                if place is not None:
                    yield row()
                place, quotes, crlf, even, odd = (block, file, at), 0, at == 0 and line.endswith("\r"), _Scan(False), _Scan(True)
            own = line.count('"')
            quotes += own
            even.take(line, own)
            odd.take(line, own)
    if place is not None:
        yield row()


def _blocks(counted: DataFrame) -> DataFrame:
    """Blocks with their true state: open, starts, before (records of the file), first (rows of all files), crlf."""
    earlier = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    blocks = counted.withColumn("open", opened).withColumn("starts", F.when(F.col("open"), F.col("odd")).otherwise(F.col("even")))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("starts").over(earlier), F.lit(0)))
    files = blocks.groupBy("file").agg(F.greatest(F.sum("starts") - 1, F.lit(0)).alias("rows"), F.bool_or("crlf").alias("crlf"))
    base = F.coalesce(F.sum("rows").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The header is record 0 of its file, so the first record behind it is row ``base``.
    return blocks.drop("crlf").join(files.select("file", "crlf", (base - 1).alias("base")), "file")


def _edges(blocks: DataFrame) -> DataFrame:
    """(record, row, text) of the records that reach over a block's edge."""
    tail = F.when(F.col("open"), F.col("tail_odd")).otherwise(F.col("tail_even"))
    head = blocks.where("open").select("file", "base", "crlf", "at", (F.col("before") - 1).alias("record"), F.lit(0).alias("part"), F.col("head").alias("text"))
    last = blocks.select("file", "base", "crlf", "at", (F.col("before") + F.col("starts") - 1).alias("record"), F.lit(1).alias("part"), tail.alias("text"))
    pieces = head.unionAll(last.where("text IS NOT NULL")).groupBy("file", "base", "crlf", "record")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "part", "text"))), lambda x: x["text"]), "\n")
    found = pieces.agg(text.alias("text"))
    text = F.when(F.col("crlf"), F.regexp_replace("text", "\r(\n|$)", "$1")).otherwise(F.col("text"))
    return found.select("record", (F.col("base") + F.col("record")).alias("row"), text.alias("text"))


def _cut(state):
    """Lines to (record, row, text) of the records that lie in one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, opened, before, base, crlf = state.value
        at, inside, record, held, offset, cr = None, False, 0, None, 0, False
        out: list[tuple[int, int, str]] = []

        def rows() -> pa.RecordBatch:
            records, numbers, texts = zip(*out, strict=True)
            return pa.record_batch([pa.array(records, pa.int64()), pa.array(numbers, pa.int64()), pa.array(texts, pa.string())], names=["record", "row", "text"])

        for batch in batches:
            for block, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block != at:
                    k = int(np.searchsorted(keys, block))
                    if k == len(keys) or keys[k] != block:
                        raise ValueError("the files were cut into other blocks than when they were counted")
                    at, inside, record, offset, cr, held = block, bool(opened[k]), int(before[k]) - 1, int(base[k]), bool(crlf[k]), None
                if not inside:
                    if line in ("", "\r"):
                        continue
                    record, held = record + 1, []
                if cr and line.endswith("\r"):
                    line = line[:-1]
                if held is not None:
                    held.append(line)
                inside ^= line.count('"') & 1
                if not inside and held is not None:
                    out.append((record, offset + record, "\n".join(held)))
                    held = None
            if len(out) >= ROWS:
                yield rows()
                out = []
        if out:
            yield rows()

    return run


def csv_records(spark: SparkSession, path: str, write) -> DataFrame:
    """(row, text) of every record, rows numbered over all files in the order of their paths; ``write`` keeps a small table.

    The counts are taken while the plan is built. Tasks receive 40 bytes for each block, that is for each 128 MB by default.
    """
    lines = _lines(spark, path)
    blocks = write(_blocks(write(lines.mapInArrow(_counted, _BLOCK), "csv-counts")), "csv-blocks")
    found = blocks.select("block", "open", "before", "base", "crlf").orderBy("block").toPandas()
    types = {"block": np.int64, "open": bool, "before": np.int64, "base": np.int64, "crlf": bool}
    state = spark.sparkContext.broadcast(tuple(found[c].to_numpy(dtype=t) for c, t in types.items()))
    whole = lines.select("block", "value").mapInArrow(_cut(state), "record bigint, row bigint, text string")
    return whole.unionAll(_edges(blocks)).where("record > 0").select("row", "text")


def parsed(text: Column, names: list[str]) -> Column:
    """A record's values as a struct of strings."""
    schema = ", ".join(f"`{n}` string" for n in names)
    return F.from_csv(text, schema, {"quote": '"', "escape": '"', "multiLine": "true"})
