"""Helpers of several operators: written intermediate tables, first occurrence of a key, sketches."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key's rows meet in up to so many pieces before their results meet.
PIECES = 64
#: Cells of a sketch's filter that travel together.
SEGMENT_BITS = 16
#: Counters of a sketch that share a cell of its filter, at most, and counters beyond two for each expected key.
MOST_EXTRA_BITS, SPARE_BITS = 10, 2
#: Cells of the filter that share a level.
RANK_BITS = 3
#: Cells that a task counts at a time.
CELLS_AT_ONCE = 1 << 22
#: Level 0 to 3 of a counter: up to 1, 2, up to 8, more.
LEVELS = np.array([0, 0, 1, 2, 2, 2, 2, 2, 2, 3], dtype=np.uint8)

_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder that all machines see: spark.checkpoint.dir, else one below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/llm").rstrip("/")


def ship(spark: SparkSession) -> None:
    """Give the executors this package's modules, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), "llm_modules.zip")
    with zipfile.ZipFile(path, "w") as z:
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                z.write(os.path.join(here, name), f"llm/{name}")
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


@contextlib.contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile leaves no shuffle files: they go when it ends, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: what follows doesn't compute them again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    with released(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder).getParent()
            if path.getName().startswith("llm-"):
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_first(rows: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Rows with ``first``, the smallest id of their key; null where all rows of the key have one id.

    A key's rows are reduced in pieces by id, and the answer goes back to the pieces that exist, so no task receives all
    rows of a frequent key.
    """
    dealt = rows.withColumn("_piece", F.pmod(F.xxhash64(id_col), F.lit(PIECES)).cast("int"))
    pieces = dealt.groupBy(*keys, "_piece").agg(F.min(id_col).alias("_low"), F.max(id_col).alias("_high"))
    first = (
        pieces.groupBy(*keys)
        .agg(F.min("_low").alias("first"), F.max("_high").alias("_high"), F.collect_list("_piece").alias("_pieces"))
        .where("first < _high")
        .select(*keys, "first", F.explode("_pieces").alias("_piece"))
    )
    return dealt.join(first, [*keys, "_piece"], "left").drop("_piece")


def cell_batches(cells: Iterable[np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
    """Counters of a task as rows (segment, steps, counts), counted CELLS_AT_ONCE at a time.

    A segment has 2**width cells. Steps lead from its beginning to one cell after the other; 65535 leads on without a cell.
    """

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        cell, count = np.unique(np.concatenate(parts), return_counts=True)
        segment, count = (cell >> np.uint64(width)).astype(np.int32), np.minimum(count, 9).astype(np.uint8)
        starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        low = (cell & np.uint64((1 << width) - 1)).astype(np.uint32)
        step = np.diff(low, prepend=np.uint32(0))
        step[starts] = low[starts]
        leaps, step = np.divmod(step, np.uint32(65535))
        to = np.cumsum(leaps + 1, dtype=np.int32)
        steps = np.full(to[-1], 65535, dtype="<u2")
        steps[to - 1] = step
        before = np.r_[0, to[starts[1:] - 1]].tolist()
        bounds = zip(before, [*before[1:], len(steps)], strict=True)
        return pa.record_batch(
            [
                pa.array(segment[starts]),
                pa.array([steps[a:b].tobytes() for a, b in bounds], pa.binary()),
                pa.array([count[a:b].tobytes() for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(cell)], strict=True)], pa.binary()),
            ],
            names=["segment", "steps", "counts"],
        )

    held: list[np.ndarray] = []
    for part in cells:
        if len(part):
            held.append(part)
        if sum(map(len, held)) >= CELLS_AT_ONCE:
            yield counted(held)
            held = []
    if held:
        yield counted(held)


CELLS = "segment int, steps binary, counts binary"


def _merge(extra: int):
    """Rows come in order of their segment; one segment is held at a time."""

    def done(segment: int, total: np.ndarray) -> pa.RecordBatch:
        most = total.reshape(-1, 1 << extra).max(axis=1)
        level = LEVELS[most.reshape(-1, 1 << RANK_BITS).max(axis=1)].reshape(-1, 4)
        packed = level[:, 0] | level[:, 1] << 2 | level[:, 2] << 4 | level[:, 3] << 6
        seen = np.packbits(most > 1, bitorder="little")
        return pa.record_batch(
            [pa.array([segment], pa.int32()), pa.array([seen.tobytes()], pa.binary()), pa.array([packed.tobytes()], pa.binary())],
            names=["segment", "seen", "levels"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(1 << SEGMENT_BITS + extra, dtype=np.uint8)
        for batch in batches:
            for segment, steps, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if segment != at:
                    if at is not None:
                        yield done(at, total)
                        total[:] = 0
                    at = segment
                steps = np.frombuffer(steps, dtype="<u2")
                cells = np.cumsum(steps, dtype=np.int64)[steps < 65535]
                total[cells] = np.minimum(total[cells] + np.frombuffer(counts, dtype=np.uint8), 9)
        if at is not None:
            yield done(at, total)

    return run


class Sketch:
    """Which of very many keys are counted twice or more: a count-min sketch of ``depth`` rows of 2**fine saturating counters.

    Only merging tasks hold counters, a segment at a time, so their number follows the keys. Tasks that look keys up receive a filter of
    2**bits cells a row, ``fine`` at most: a bit whether one of the cell's counters is over 1. It fills with repeated keys, not with
    all, and takes depth * 2**bits / 8 bytes whatever the input's size; with levels, a fourth more.
    """

    def __init__(self, keys: int, most_bits: int, depth: int, leveled: bool = False):
        """For so many keys; 2**most_bits cells a row at most."""
        need = (2 * keys).bit_length()
        self.bits = max(SEGMENT_BITS, min(most_bits, need))
        self.fine = max(self.bits, min(need + SPARE_BITS, self.bits + MOST_EXTRA_BITS))
        self.depth, self.leveled, self.filter = depth, leveled, None

    def _turned(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        yield keys
        for r in range(1, self.depth):
            yield (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25 + 2 * r)

    def _at(self, keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
        for r, turned in enumerate(self._turned(keys)):
            yield (turned >> np.uint64(64 - bits)) | np.uint64(r << bits)

    def batches(self, keys: Iterable[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Rows of CELLS for the keys (64 well mixed bits each), as ``merged`` takes them."""
        cells = (np.concatenate(list(self._at(k, self.fine))) for k in keys)
        return cell_batches(cells, SEGMENT_BITS + self.fine - self.bits)

    def merged(self, parts: DataFrame) -> Sketch:
        """Sum of the tasks' counters, as a filter that is sent to all tasks."""
        spark = parts.sparkSession
        rows = parts.repartition("segment").sortWithinPartitions("segment")
        rows = rows.mapInArrow(_merge(self.fine - self.bits), "segment int, seen binary, levels binary")
        rows = rows if self.leveled else rows.drop("levels")
        sizes = [(1 << SEGMENT_BITS) // 8, (1 << SEGMENT_BITS - RANK_BITS) // 4][: 1 + self.leveled]
        parts_of = [np.zeros((self.depth << self.bits - SEGMENT_BITS) * size, dtype=np.uint8) for size in sizes]
        with released(spark):
            found = rows.collect()
        while found:
            segment, *packed = found.pop()
            for part, size, data in zip(parts_of, sizes, packed, strict=True):
                part[segment * size : (segment + 1) * size] = np.frombuffer(data, dtype=np.uint8)
        self.filter = spark.sparkContext.broadcast(parts_of)
        return self

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may have been counted twice or more; true of all that were."""
        seen, found = self.filter.value[0], np.ones(len(keys), dtype=bool)
        for cell in self._at(keys, self.bits):
            found &= (seen[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)
        return found

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key's estimate, never below that of its count; 0 where it is not repeated."""
        levels, found = self.filter.value[1], np.full(len(keys), 3, dtype=np.uint8)
        for cell in self._at(keys, self.bits):
            cell = cell >> np.uint64(RANK_BITS)
            own = levels[cell >> np.uint64(2)] >> ((cell & np.uint64(3)) << np.uint64(1)).astype(np.uint8) & np.uint8(3)
            found = np.minimum(found, own)
        return np.where(self.repeated(keys), np.maximum(found, np.uint8(1)), np.uint8(0))


def sketch_for(documents: DataFrame, text_col: str, bytes_per_key: int, most_bits: int, depth: int, leveled: bool = False) -> Sketch:
    """A sketch for the keys expected in the texts, with a filter of 2**most_bits cells a row at most."""
    total = documents.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return Sketch(int(total / bytes_per_key), most_bits, depth, leveled)
