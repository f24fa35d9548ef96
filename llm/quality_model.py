"""Quality of a text by a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins, and so have a few pairs of features. The tables are learned by cyclic
boosting: round after round, every feature in turn adds a shallow tree over its bins that fits what the sum of all tables
leaves; then the pairs that explain most of the rest get tables of their own the same way. A score is the logistic of the
sum of one entry of each table, so scoring is binning and additions.

The model is trained on the driver on at most ``sample`` labelled rows, drawn by a hash of their ids from all labels.

Defined results: null is the empty text, and the empty text has a score too; rows whose label or id is null, or whose id
has no text, aren't learned from; with a single class in the labels all scores are that class's, without any labels 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.words import BASES, Block, blocks, spans_hash

SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 120, 60, 0.1
NAMES = (
    "words word_bytes symbols_per_word upper_share digit_share shouts_per_word bars_per_word stops_per_word distinct_share"
    " same_as_before repeated_trigrams lines_per_word wide_share short_share"
).split()

_KIND = np.zeros((7, 256), dtype=np.int64)
for _row, _chars in enumerate((b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b"!", b"|", b".,;", b"\n")):
    _KIND[_row, list(_chars)] = 1


def _repeated(text: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Of each text, the keys beyond the first of their kind."""
    order = np.lexsort((key, text))
    t, k = text[order], key[order]
    return np.bincount(t[1:][(t[1:] == t[:-1]) & (k[1:] == k[:-1])], minlength=n)


def features(block: Block) -> np.ndarray:
    n, words = block.n, block.words
    some = np.maximum(words, 1)
    size = np.diff(block.bounds)
    counts = []
    for kind in _KIND:
        total = np.r_[0, np.cumsum(kind[block.data])]
        counts.append(total[block.bounds[1:]] - total[block.bounds[:-1]])
    total = np.r_[0, np.cumsum(block.data >= 128)]
    wide = total[block.bounds[1:]] - total[block.bounds[:-1]]
    hashes = block.hashes()
    text = np.repeat(np.arange(n), words)
    length = block.end - block.start
    tri_text, tri = block.windows(3)
    grams = spans_hash(hashes, tri, tri + 3, BASES[1])
    same = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    return np.stack(
        [
            np.log1p(words),
            np.bincount(text, weights=length, minlength=n) / some,
            counts[0] / some,
            counts[1] / np.maximum(size, 1),
            counts[2] / np.maximum(size, 1),
            counts[3] / some,
            counts[4] / some,
            counts[5] / some,
            1 - _repeated(text, hashes, n) / some,
            np.bincount(text[1:][same], minlength=n) / some,
            _repeated(tri_text, grams, n) / some,
            counts[6] / some,
            wide / np.maximum(size, 1),
            np.bincount(text, weights=length <= 3, minlength=n) / some,
        ],
        axis=1,
    )


def _shallow(grad: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree of three leaves at most over ordered bins: the two best cuts, one after the other."""

    def cut(a: int, b: int) -> tuple[float, int]:
        if b - a < 2:
            return 0.0, a
        g, h = np.cumsum(grad[a:b]), np.cumsum(weight[a:b]) + 1e-3
        gain = g[:-1] ** 2 / h[:-1] + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1e-3) - g[-1] ** 2 / h[-1]
        best = int(gain.argmax())
        return float(gain[best]), a + best + 1

    out, leaves = np.zeros(len(grad)), [(0, len(grad))]
    for _ in range(2):
        (gain, at), leaf = max((cut(*leaf), leaf) for leaf in leaves)
        if gain <= 1e-9:
            break
        leaves.remove(leaf)
        leaves += [(leaf[0], at), (at, leaf[1])]
    for a, b in leaves:
        out[a:b] = grad[a:b].sum() / (weight[a:b].sum() + 1.0)
    return out


def _shallow_pair(grad: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree of four leaves over a table: the cut in one direction and one in the other on each side; and its gain."""
    best: tuple[float, np.ndarray | None] = (-1.0, None)
    for turned in (False, True):
        g, h = (grad.T, weight.T) if turned else (grad, weight)
        cg, ch = np.cumsum(g, axis=0), np.cumsum(h, axis=0)
        for at in range(len(g) - 1):
            gain, parts = 0.0, []
            for pg, ph in ((cg[at], ch[at]), (cg[-1] - cg[at], ch[-1] - ch[at])):
                sg, sh = np.cumsum(pg), np.cumsum(ph)
                gains = sg[:-1] ** 2 / (sh[:-1] + 1) + (sg[-1] - sg[:-1]) ** 2 / (sh[-1] - sh[:-1] + 1)
                k = int(gains.argmax())
                gain += gains[k]
                parts.append((k, sg[k] / (sh[k] + 1), (sg[-1] - sg[k]) / (sh[-1] - sh[k] + 1)))
            if gain > best[0]:
                table = np.zeros(g.shape)
                for rows, (k, low, high) in ((slice(0, at + 1), parts[0]), (slice(at + 1, None), parts[1])):
                    table[rows, : k + 1], table[rows, k + 1 :] = low, high
                best = (gain, table.T if turned else table)
    return best[1], best[0]


class AdditiveModel:
    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        self.coarse = [np.unique(np.quantile(c, np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for c in x.T]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        mean = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(mean / (1 - mean)))
        if len(set(y.tolist())) < 2:
            return
        fine, wide = self._bins(x, self.cuts), self._bins(x, self.coarse)
        total = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for j, table in enumerate(self.tables):
                p = 1 / (1 + np.exp(-total))
                tree = RATE * _shallow(*(np.bincount(fine[j], w, len(table)) for w in (y - p, p * (1 - p))))
                table += tree
                total += tree[fine[j]]
        shapes = [len(c) + 1 for c in self.coarse]

        def sums(a: int, b: int) -> list[np.ndarray]:
            p = 1 / (1 + np.exp(-total))
            at = wide[a] * shapes[b] + wide[b]
            return [np.bincount(at, w, shapes[a] * shapes[b]).reshape(shapes[a], shapes[b]) for w in (y - p, p * (1 - p))]

        both = [(a, b) for a in range(len(shapes)) for b in range(a) if shapes[a] > 1 and shapes[b] > 1]
        both.sort(key=lambda ab: -_shallow_pair(*sums(*ab))[1])
        self.pairs = [(a, b, np.zeros((shapes[a], shapes[b]))) for a, b in both[:PAIRS]]
        for _ in range(PAIR_ROUNDS):
            for a, b, table in self.pairs:
                tree = RATE * _shallow_pair(*sums(a, b))[0]
                table += tree
                total += tree[wide[a], wide[b]]

    def _bins(self, x: np.ndarray, cuts: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for table, at in zip(self.tables, self._bins(x, self.cuts), strict=True):
            total += table[at]
        if self.pairs:
            wide = self._bins(x, self.coarse)
            for a, b, table in self.pairs:
                total += table[wide[a], wide[b]]
        return 1 / (1 + np.exp(-total))


def train(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> AdditiveModel | None:
    """Learn from labelled rows; at most about ``sample`` of them, which are few enough to be sent to all tasks."""
    labels = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col, label_col)
    n, million = labels.count(), 1_000_000
    if n:
        labels = labels.where(F.pmod(F.xxhash64(id_col), F.lit(million)) < min(million, million * sample // n + 1))
    rows = documents.select(id_col, text_col).join(F.broadcast(labels), id_col)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                x = features(block).astype("<f8")
                yield pa.record_batch(
                    [batch.column(0).slice(block.row, block.n), batch.column(2).slice(block.row, block.n), pa.array([v.tobytes() for v in x], pa.binary())],
                    names=["id", "y", "x"],
                )

    kind = rows.schema[id_col].dataType.simpleString()
    rows = rows.select(id_col, text_col, F.col(label_col).cast("double"))
    found = sorted(rows.mapInArrow(measured, f"id {kind}, y double, x binary").collect())
    if not found:
        return None
    return AdditiveModel(np.stack([np.frombuffer(r[2], dtype="<f8") for r in found]), np.array([r[1] for r in found]))


def quality(model: AdditiveModel | None, text: Column) -> Column:
    """Score of each text, 0 to 1."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            column = pa.array(series, pa.large_string())
            parts = [model.score(features(b)) if model is not None else np.full(b.n, 0.5) for b in blocks(column)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return scored(text)
