"""Harmonic packing of tokenised documents into sequences of at most ``capacity`` tokens.

A piece of length n is of class k = capacity // n, the reciprocal class (capacity/(k+1), capacity/k], and a bin of class k
takes k pieces whatever they are. Since documents may be cut, each is cut so that little is lost: into whole sequences,
then into halves, quarters and so on down to ``least`` tokens, whose bins come out full, and one last piece below that,
whose class is so high that its bins are nearly full. Each task fills its own bins while it reads and needs no other task.
At its end, the pieces of its unfinished bins are laid end to end, cut where a sequence is full, and only the last of those
sequences is short.

Defined results: a null or empty text is the closing id alone, so every row has a piece; rows that share an id are packed
one by one; an empty table gives no piece. Sequence ids are unique over the table and don't change when a task runs again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
#: Pieces below this length aren't cut any more.
LEAST = 64
CLOSING = 0
SPECIAL = "<|endoftext|>"
#: Pieces in an output batch, at most.
ROWS = 20_000


class Tokens:
    """Ids of the byte-level vocabulary; both libraries give the same ids, and the ranks' one is four times faster."""

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.path, self.slow = tokenizer_path, None
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special={SPECIAL}, disallowed_special=())
        except BaseException as error:  # its pattern engine gives up on very long runs of spaces
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


_tokens: dict[tuple[str, str, str], Tokens] = {}


def tokens(*paths: str) -> Tokens:
    if paths not in _tokens:
        _tokens[paths] = Tokens(*paths)
    return _tokens[paths]


class Bins:
    """Open bins of one task. A piece is (id, start, ids, tokens of its document)."""

    def __init__(self, first_sequence: int, capacity: int, least: int):
        self.next, self.capacity, self.least = first_sequence, capacity, least
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            self.rows.append((key, start, len(ids), ids.tobytes(), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, key, ids: np.ndarray) -> None:
        at, left = 0, len(ids)
        size = self.capacity
        while left:
            while size > left and size > self.least:
                size //= 2
            length = min(size, left)
            kind = self.capacity // length
            bin_ = self.open.setdefault(kind, [])
            bin_.append((key, at, ids[at : at + length], len(ids)))
            if len(bin_) == kind:
                self._close(self.open.pop(kind))
            at, left = at + length, left - length

    def finish(self) -> None:
        """Unfinished bins, longest pieces first, end to end."""
        held, room = [], self.capacity
        for kind in sorted(self.open):
            for key, start, ids, total in self.open[kind]:
                while len(ids):
                    held.append((key, start, ids[:room], total))
                    start, ids, room = start + len(held[-1][2]), ids[room:], room - len(held[-1][2])
                    if not room:
                        self._close(held)
                        held, room = [], self.capacity
        if held:
            self._close(held)
        self.open = {}


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    least: int = LEAST,
) -> DataFrame:
    """A row per piece: id, start, length, ids (little-endian unsigned 32 bits), doc_tokens, sequence_id, offset."""
    kind = documents.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bins = tokens(tokenizer_path, ranks_path, pattern), Bins(TaskContext.get().partitionId() << 40, capacity, least)
        types = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*bins.rows, strict=True))
            bins.rows = []
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            if types is None:
                long = pa.int64()
                types = [batch.schema.types[0], long, long, pa.binary(), long, long, long]
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                bins.add(key.as_py(), np.append(own.encode(text.as_py() or ""), np.uint32(CLOSING)).astype("<u4"))
                if len(bins.rows) >= ROWS:
                    yield out()
        bins.finish()
        if bins.rows:
            yield out()

    schema = f"`{id_col}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return documents.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
