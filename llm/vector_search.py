"""Nearest neighbours by Euclidean distance over an inverted file with an adaptive dimension scan.

All vectors are turned by one random rotation, so that a few of their leading columns tell much of a distance. Every
vector belongs to the list of its nearest centre; a query probes the lists of its nearest centres. In a list, the vectors
are scanned in column blocks: after each block, the partial distance over d of D columns, scaled by D/d, is tested against
the query's bound, and a vector whose true distance would have to be an outlier (``slack`` / sqrt(d) beyond) is given up.
The bound is the distance of a query's k-th nearest in a sample. Survivors are measured on the original
vectors in double precision.

How many lists are probed is measured: as few as hold ``recall`` of the neighbours of sampled vectors within the sample. Data
without clusters needs most of them, and then the early end of the distances is what saves the time.

Centres, rotation and bounds come from a sample of about ``sample`` vectors, drawn by a hash of their ids; the
vectors of the sample that make a query's bound are candidates too, so no query is short of neighbours. Every vector
is indexed. A list's vectors are dealt into parts of about ``part`` by a hash of their ids, so a vector that a third
of all rows repeat isn't one task's work; queries are
dealt out likewise, and each share of them meets each part.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part, nor do rows without an id; equal distances rank the smaller id first; fewer than ``k`` candidates give fewer rows;
an empty table gives none. Rows that share an id are each candidates where their vectors differ, and one candidate where
these are equal, so a table appended twice has the neighbours of the table; of such queries the smallest vector is taken.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shared import written

SAMPLE = 20_000
PART = 4096
#: Queries that meet a part of a list at a time, about.
QUERIES = 5000
#: Share of a sampled vector's neighbours that the probed lists must hold.
RECALL = 0.97
#: Sampled vectors on which the number of probes is chosen.
TRIALS = 256
BLOCK = 16
SLACK = 2.1


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as doubles) of the rows that take part."""
    v = F.col(vector_col)
    good = v.isNotNull() & F.col(id_col).isNotNull() & F.exists(v, lambda x: x != 0)
    good = good & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(good).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (lengths["n"] if lengths else -1))


def marks(x: np.ndarray) -> np.ndarray:
    """64 bits of each vector's digest, equal for equal vectors."""
    rows = np.ascontiguousarray(x + 0.0)  # -0.0 becomes 0.0
    return np.array([int.from_bytes(hashlib.blake2b(row, digest_size=8).digest(), "little", signed=True) for row in rows], dtype=np.int64)


def unlike(ids: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Places of the rows without those that repeat an id and its vector."""
    return np.sort(np.unique(np.stack([ids, marks], axis=1), axis=0, return_index=True)[1])


class Index:
    """Rotation, centres of the rotated vectors, and what the sample says of distances."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, lists: int, seed: int = 11):
        random = np.random.Generator(np.random.PCG64(seed))
        q, r = np.linalg.qr(random.standard_normal((sample.shape[1], sample.shape[1])))
        self.rotation = q * np.sign(np.diag(r))
        x = sample @ self.rotation
        distinct = np.unique(x, axis=0)
        centres = distinct[random.permutation(len(distinct))[:lists]]
        for _ in range(12):
            near = self._nearest(x, centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, x)
            n = np.bincount(near, minlength=len(centres))
            centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        self.centres, self.ids, self.original, self.sample, self.marks = centres, ids, sample, x, marks(sample)

    @staticmethod
    def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)

    def _nearest(self, x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.concatenate([self._squares(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])

    def lists_of(self, x: np.ndarray) -> np.ndarray:
        return self._nearest(x, self.centres)

    def probes(self, x: np.ndarray) -> np.ndarray:
        """Lists of each vector, nearest centre first."""
        return np.argsort(self._squares(x, self.centres), axis=1, kind="stable")

    def probes_for(self, recall: float, k: int) -> int:
        """Number of lists that hold enough neighbours of vectors of the sample."""
        tried = np.unique(np.linspace(0, len(self.sample) - 1, TRIALS).astype(int))
        squares = self._squares(self.sample[tried], self.sample)
        squares[np.arange(len(tried)), tried] = np.inf
        near = np.argpartition(squares, min(k, len(self.sample)) - 1, axis=1)[:, :k]
        place = np.argsort(self.probes(self.sample[tried]), axis=1)
        ranks = np.sort(np.take_along_axis(place, self.lists_of(self.sample)[near], axis=1).ravel())
        return int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)]) + 1

    def seeds(self, query_id: int, v: np.ndarray, turned: np.ndarray, k: int) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Square distance within which the sample has k vectors besides the query's own (else infinite); these vectors."""
        squares = np.where(self.ids == query_id, np.inf, self._squares(turned[None], self.sample)[0])
        near = np.argpartition(squares, min(k, len(squares)) - 1)[:k]
        near = near[np.isfinite(squares[near])]
        score = distances(self.original[near], v)
        return (float((score**2).max()) * (1 + 1e-9) if len(near) == k else np.inf), self.ids[near], self.marks[near], score


def drawn_at(id_col: str, n: int, sample: int) -> Column:
    """Whether a row of ``n`` is in the sample."""
    million = 1_000_000
    return F.pmod(F.xxhash64(id_col), F.lit(million)) < min(million, million * sample // n + 1)


def distances(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - v) ** 2).sum(1))


def scan(query: np.ndarray, bound: float, x: np.ndarray, slack: float, block: int) -> np.ndarray:
    """Rows of x (rotated) that no test gives up."""
    alive, partial, width = np.arange(len(x)), np.zeros(len(x)), x.shape[1]
    for at in range(0, width, block):
        d = min(at + block, width)
        part = x[alive, at:d] - query[at:d]
        partial = partial + (part * part).sum(1)
        limit = bound if d == width else bound * (1 + slack / np.sqrt(d)) ** 2 * d / width
        stays = partial <= limit * (1 + 1e-9) + 1e-12
        alive, partial = alive[stays], partial[stays]
        if not len(alive):
            break
    return alive


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    sample: int = SAMPLE,
    part: int = PART,
    recall: float = RECALL,
    slack: float = SLACK,
    queries_at_once: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` nearest of the vectors found, itself left out."""
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    rows = usable(vectors, id_col, vector_col)
    n = rows.count()
    if not n:
        return spark.createDataFrame([], schema)
    drawn = rows.where(drawn_at("id", n, sample)).orderBy("id").collect()
    if not drawn:
        drawn = rows.limit(1).collect()
    ids, sampled = np.array([r.id for r in drawn]), np.array([r.v for r in drawn])
    once = unlike(ids, marks(sampled))
    built = Index(ids[once], sampled[once], max(1, min(1024, int(len(once) ** 0.5))))
    probes = built.probes_for(recall, k)
    index = spark.sparkContext.broadcast(built)
    width = len(drawn[0].v)

    @F.pandas_udf("int")
    def list_of(v: pd.Series) -> pd.Series:
        return pd.Series(index.value.lists_of(np.stack(v.to_numpy()) @ index.value.rotation)) if len(v) else pd.Series([], dtype="int32")

    @F.pandas_udf("struct<lists:array<int>,bound:double,ids:array<bigint>,marks:array<bigint>,scores:array<double>>")
    def probed(ids: pd.Series, v: pd.Series) -> pd.DataFrame:
        if not len(v):
            return pd.DataFrame({"lists": [], "bound": [], "ids": [], "marks": [], "scores": []})
        own = index.value
        x = np.stack(v.to_numpy())
        turned = x @ own.rotation
        bound, near, mark, score = zip(*(own.seeds(*row, k) for row in zip(ids, x, turned, strict=True)), strict=True)
        return pd.DataFrame({"lists": list(own.probes(turned)[:, :probes]), "bound": bound, "ids": near, "marks": mark, "scores": score})

    parts = max(1, -(-n // part))
    held = rows.withColumn("list", list_of("v")).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    sizes = held.groupBy("list").count().withColumn("parts", F.ceil(F.col("count") / part).cast("int"))
    held = held.join(F.broadcast(sizes.select("list", "parts")), "list").withColumn("part", F.col("part") % F.col("parts"))
    asked = usable(queries, id_col, vector_col).where(F.size("v") == width).groupBy("id").agg(F.min("v").alias("v"))
    asked = written(asked.withColumn("_p", probed("id", "v")).select("id", "v", "_p.*"), "queries")
    seeds = F.arrays_zip(F.col("ids").alias("vec_id"), F.col("marks").alias("mark"), F.col("scores").alias("score"))
    seeds = asked.select(F.col("id").alias("query_id"), F.inline(seeds))
    n_asked = asked.count()
    asked = asked.select("id", "v", "bound", F.explode("lists").alias("list"))
    shares = max(1, -(-n_asked // queries_at_once))
    asked = asked.withColumn("share", F.pmod(F.xxhash64("id"), F.lit(shares)).cast("int"))
    asked = asked.join(F.broadcast(sizes.select("list", "parts")), "list")
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    held = held.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))

    def searched(key: tuple, own: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(own) and len(wanted):
            ids, x = own["id"].to_numpy(), np.stack(own["v"].to_numpy())
            mark = marks(x)
            once = unlike(ids, mark)  # equal rows are always in one cell
            ids, x, mark = ids[once], x[once], mark[once]
            turned = x @ index.value.rotation
            for query_id, v, bound in zip(wanted["id"], wanted["v"], wanted["bound"], strict=True):
                others = np.flatnonzero(ids != query_id)
                alive = others[scan(v @ index.value.rotation, bound, turned[others], slack, BLOCK)]
                score = distances(x[alive], v)
                best = np.lexsort((ids[alive], score))[:k]
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[alive][best], "mark": mark[alive][best], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "mark": [], "score": []})

    cell = ["list", "part", "share"]
    held, asked = held.select("id", "v", *cell), asked.select("id", "v", "bound", *cell)
    found = held.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInPandas(searched, "query_id bigint, vec_id bigint, mark bigint, score double")
    near = F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id"))), 1, k)
    found = found.unionByName(seeds).groupBy("query_id", "vec_id", "mark").agg(F.min("score").alias("score"))
    found = found.groupBy("query_id").agg(near.alias("near"))
    return found.select("query_id", F.posexplode("near").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score"
    )
