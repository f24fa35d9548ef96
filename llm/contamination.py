"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts are lower-cased in A-Z and cut into words of letters, digits and code points above 0x7F. The automaton over the items'
words has a state for each set of equally continued sequences; a document's words are streamed through it, each step giving the
longest sequence of some item that ends at the word. Where that has ``window`` words, these are inside a window of the item; an
item of fewer words is one window, found at the states that have it as a suffix. Words inside a window are hit. They are cut
out of the text, and a document of which more than ``max_coverage`` of the words is hit is marked ``dropped``.

Tasks build the automata, of about ``SHARD_WORDS`` words each: items are cut into overlapping stretches, dealt out by their
hash, and each automaton is sent to all tasks alone, so its size is bounded. Benchmarks beyond that take several passes, whose
hits are put together for each document. Words of documents that no item has, or pairs of words, break the stream; they need no
step.

Defined results: null texts have no words, whether of documents or items; items without words have no window; items that share
an id are one item; items without an id hit words but aren't listed; rows of documents are judged one by one, so ids may be
null or repeated; without items nothing is hit; other columns stay as they are, but for those that are added.
"""

from __future__ import annotations

import pickle
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.shared import free_name, written

#: Words of items in one automaton, about.
SHARD_WORDS = 1 << 20
#: Words of an item that stay together.
STRETCH = 1 << 12
#: Rows of an output batch, at most.
ROWS = 1000

#: A-Z to a-z; all that is no word's byte to a blank.
_FOLD = bytes(b | 0x20 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of word sequences, and the items to which its windows belong."""

    def __init__(self, window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self._next: list[dict[int, int]] = [{}]
        self.length, self.link = array("i", [0]), array("i", [-1])
        self._items: dict[tuple[int, int], set] = {}  # by state and number of words
        self.shortest = window
        self._pairs: set[tuple[int, int]] = set()

    def _state(self, length: int, link: int, steps: dict[int, int]) -> int:
        self._next.append(steps)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The state of the longest sequence of p with the word, made of q where q has longer ones too."""
        if self.length[q] == self.length[p] + 1:
            return q
        own = self._state(self.length[p] + 1, self.link[q], dict(self._next[q]))
        self.link[q] = own
        while p >= 0 and self._next[p].get(word) == q:
            self._next[p][word] = own
            p = self.link[p]
        return own

    def _append(self, last: int, word: int) -> int:
        if word in self._next[last]:
            return self._split(last, self._next[last][word], word)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self._next[p]:
            self._next[p][word] = new
            p = self.link[p]
        if p >= 0:
            # _split appends a state and may move links, so its answer comes first.
            self.link[new] = self._split(p, self._next[p][word], word)
        return new

    def add(self, sequences: list[tuple[object, list[bytes]]]) -> None:
        """All (item, words) at once: states first, then the items of each window."""
        coded = [(item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for item, ws in sequences if ws]
        for _, ids in coded:
            last = 0
            for word in ids:
                last = self._append(last, word)
            self._pairs.update(zip(ids, ids[1:]))
        for item, ids in coded:
            size = min(self.window, len(ids))
            self.shortest = min(self.shortest, size)
            state, length = 0, 0
            for word in ids:
                state, length = self._next[state][word], length + 1
                while self.length[self.link[state]] >= size:
                    state, length = self.link[state], self.length[self.link[state]]
                if length >= size:
                    self._items.setdefault((state, size), set()).add(item)

    def packed(self) -> bytes:
        """All that documents need, as bytes."""
        n = len(self.length)
        first, word, to = array("i", [0]), array("i"), array("i")
        for steps in self._next:
            for w in sorted(steps):
                word.append(w)
                to.append(steps[w])
            first.append(len(word))
        # The state of the last ``window`` words, and the nearest state on the links that is a whole short item.
        full, short = array("i", [-1]) * n, array("i", [-1]) * n
        marked = {s for s, size in self._items if size < self.window}
        for s in sorted(range(n), key=self.length.__getitem__):
            up = self.link[s]
            if up >= 0:
                short[s] = s if s in marked else short[up]
                if self.length[s] >= self.window:
                    full[s] = s if self.length[up] < self.window else full[up]
        long = {s: sorted(x, key=repr) for (s, size), x in self._items.items() if size == self.window}
        shorts: dict[int, list] = {}
        for (s, size), x in sorted(self._items.items()):
            if size < self.window:
                shorts.setdefault(s, []).append((size, sorted(x, key=repr)))
        pairs = np.sort(np.array([a << 32 | b for a, b in self._pairs], dtype=np.int64))
        return pickle.dumps((self.window, self.shortest, self.vocabulary, self.length, self.link, first, word, to, full, short, long, shorts, pairs))


class Matcher:
    def __init__(self, packed: bytes):
        parts = pickle.loads(packed)
        self.window, self.shortest, self.vocabulary, self.length, self.link, self.first, self.word, self.to = parts[:8]
        self.full, self.short, self.long, self.shorts, self.pairs = parts[8:]

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Where known words follow each other as in some item, long enough for the shortest window."""
        known = ids >= 0
        if self.shortest > 1 and len(ids) > 1:
            pair = ids[:-1] << 32 | ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined = known[:-1] & known[1:] & (self.pairs[at] == pair) if len(self.pairs) else np.zeros(len(pair), dtype=bool)
        else:
            joined = known[:-1] & known[1:]
        starts = np.flatnonzero(known & np.r_[True, ~joined][: len(ids)])
        ends = np.flatnonzero(known & np.r_[~joined, True][: len(ids)]) + 1
        enough = ends - starts >= self.shortest
        return list(zip(starts[enough].tolist(), ends[enough].tolist(), strict=True))

    def found(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set]:
        """Spans of hit words, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        states: set[int] = set()
        items: set = set()
        length, link, first, word, to = self.length, self.link, self.first, self.word, self.to
        for start, end in self.stretches(ids):
            state, have = 0, 0
            for i, w in enumerate(ids[start:end].tolist(), start):
                while True:
                    a, b = first[state], first[state + 1]
                    at = bisect_left(word, w, a, b)
                    if at < b and word[at] == w:
                        state, have = to[at], have + 1
                        break
                    if state == 0:
                        have = 0
                        break
                    state = link[state]
                    have = length[state]
                if have >= self.window:
                    states.add(self.full[state])
                    spans.append((i + 1 - self.window, i + 1))
                s = self.short[state]
                while s >= 0:
                    for size, own in self.shorts[s]:
                        if size <= have:
                            spans.append((i + 1 - size, i + 1))
                            items.update(own)
                    s = self.short[link[s]]
        for s in states:
            items.update(self.long[s])
        return joined_spans(spans), items


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _built(window: int):
    """(shard, item, words) in order of the shard to (shard, automaton); one automaton is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(shard: int, sequences: list) -> pa.RecordBatch:
            own = Automaton(window)
            own.add(sequences)
            return pa.record_batch([pa.array([shard], pa.int32()), pa.array([own.packed()], pa.binary())], names=["shard", "automaton"])

        at, held = None, []
        for batch in batches:
            for shard, item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != at and held:
                    yield row(at, held)
                    held = []
                at = shard
                held.append((item, text.split(b" ")))
        if held:
            yield row(at, held)

    return run


def _stretched(window: int):
    """(item, text) to (item, words, n): stretches that overlap by a window but one word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, texts, sizes = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ws = words_of(text)
                for start in range(0, max(len(ws) - window + 1, min(len(ws), 1)), STRETCH):
                    part = ws[start : start + STRETCH + window - 1]
                    items.append(item)
                    texts.append(b" ".join(part))
                    sizes.append(len(part))
            yield pa.record_batch([pa.array(items, batch.column(0).type), pa.array(texts, pa.binary()), pa.array(sizes, pa.int64())], names=["item", "words", "n"])

    return run


def automata(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """(shard, automaton) of the items, written."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").alias("text"))
    kind = items.schema["item"].dataType.simpleString()
    parts = written(items.mapInArrow(_stretched(window), f"item {kind}, words binary, n bigint"), "items").distinct()
    total = parts.agg(F.sum("n")).first()[0] or 0
    shards = -(-total // shard_words) or 1
    parts = parts.select(F.pmod(F.xxhash64("words"), F.lit(shards)).cast("int").alias("shard"), "item", "words")
    built = parts.repartition("shard").sortWithinPartitions("shard").mapInArrow(_built(window), "shard int, automaton binary")
    return written(built, "automata")


def _hits(packed, text_at: int, kind: pa.DataType, every: bool):
    """Rows with n_words, _spans and _items; without ``every`` only rows that are hit."""
    held: list[Matcher] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Matcher(packed.value))
        matcher = held[0]
        get = matcher.vocabulary.get
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                counts, spans, items = [], [], []
                for text in batch.column(text_at).to_pylist():
                    ws = words_of(text)
                    ids = np.fromiter(map(get, ws, repeat(-1)), dtype=np.int64, count=len(ws))
                    hit, own = matcher.found(ids)
                    counts.append(len(ws))
                    spans.append([{"start": a, "end": b} for a, b in hit])
                    items.append(sorted(x for x in own if x is not None))
                columns = [*batch.columns, pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(kind))]
                out = pa.record_batch(columns, names=[*batch.schema.names, "n_words", "hit_spans", "items"])
                yield out if every else out.filter(pa.array([bool(s) for s in spans]))

    return run


def _cleaned(text_at: int, span_at: int):
    """Adds the text without the hit words; what stood between two words that stay goes with those between them."""

    def clean(text: str | None, spans: list | None) -> str | None:
        if not spans:
            return text
        raw = text.encode("utf-8", "surrogatepass")
        folded = np.frombuffer(raw.translate(_FOLD), dtype=np.uint8)
        inside = np.r_[False, folded != 32, False]
        starts, ends = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        out, at = [], 0
        for s in spans:
            out.append(raw[at : starts[s["start"]]])
            at = int(ends[s["end"] - 1])
        return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [clean(*x) for x in zip(batch.column(text_at).to_pylist(), batch.column(span_at).to_pylist(), strict=True)]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "clean_text"])

    return run


_ADDED = ("n_words", "hit_spans", "items", "n_hit", "dropped", "clean_text")


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    max_coverage: float = 0.5,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The documents with n_words, hit_spans (places of words), items (their ids), n_hit and dropped."""
    spark = documents.sparkSession
    documents = documents.drop(*_ADDED)
    built = automata(benchmark, window, item_col, item_text, shard_words)
    shards = [r.shard for r in built.select("shard").collect()]
    item_type = benchmark.schema[item_col].dataType
    added = T.StructType(
        [
            T.StructField("n_words", T.LongType()),
            T.StructField("hit_spans", T.ArrayType(T._parse_datatype_string("struct<start:int,end:int>"))),
            T.StructField("items", T.ArrayType(item_type)),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(item_type)

    def packed(shard: int | None):
        found = None if shard is None else bytes(built.where(F.col("shard") == shard).first().automaton)
        return spark.sparkContext.broadcast(found or Automaton(window).packed())

    if len(shards) < 2:
        schema = T.StructType([*documents.schema.fields, *added.fields])
        own = packed(shards[0] if shards else None)
        found = documents.mapInArrow(_hits(own, documents.columns.index(text_col), kind, True), schema)
    else:
        numbered = written(documents.withColumn(free_name(documents, "row"), F.monotonically_increasing_id()), "numbered")
        row = numbered.columns[-1]
        slim = numbered.select(row, text_col)
        schema = T.StructType([*slim.schema.fields, *added.fields])
        parts = [
            written(slim.mapInArrow(_hits(packed(s), 1, kind, False), schema).select(row, "hit_spans", "items"), "hits") for s in sorted(shards)
        ]
        hits = parts[0]
        for more in parts[1:]:
            hits = hits.unionAll(more)
        hits = hits.groupBy(row).agg(F.flatten(F.collect_list("hit_spans")).alias("hit_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        schema = T.StructType([*numbered.schema.fields, *added.fields[1:], added.fields[0]])
        both = numbered.join(hits, row, "left").select(*[F.col(f"`{c}`") for c in numbered.columns], "hit_spans", "items")
        found = both.mapInArrow(_merged(numbered.columns.index(text_col), kind), schema)
        found = found.select(*[F.col(f"`{c}`") for c in documents.columns], "n_words", "hit_spans", "items")
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("n_hit", n_hit).withColumn("dropped", F.col("n_hit") > max_coverage * F.col("n_words"))


def _merged(text_at: int, kind: pa.DataType):
    """Counts the words, and joins the spans of several automata."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [joined_spans([(s["start"], s["end"]) for s in x or ()]) for x in batch.column(-2).to_pylist()]
            structs = pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            items = pa.array([x or [] for x in batch.column(-1).to_pylist()], pa.list_(kind))
            counts = pa.array([len(words_of(t)) for t in batch.column(text_at).to_pylist()], pa.int64())
            yield pa.record_batch([*batch.columns[:-2], structs, items, counts], names=[*batch.schema.names, "n_words"])

    return run


def decontaminate(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """As ``find_contamination``, with ``clean_text``, the text without its hit words."""
    found = find_contamination(documents, benchmark, text_col, **how)
    schema = T.StructType([*found.schema.fields, T.StructField("clean_text", T.StringType())])
    return found.mapInArrow(_cleaned(found.columns.index(text_col), found.columns.index("hit_spans")), schema)
