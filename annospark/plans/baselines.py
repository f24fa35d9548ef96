"""Classical baselines on the whole vocabulary, trained by joins and sums: no two words share a weight or a split."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.operators import lexical, metrics
from annospark.sources.tables import materialised

#: Words in more than this share of the postings are sent to every task; there are at most as many as its inverse.
HOT_SHARE = 1 / 4096
#: Id of the intercept, a posting of every text; words are numbered from 0.
INTERCEPT = -1
#: What a block of texts sends for each of its words: its share of the gradient, and the weights that it has.
SENT_DDL = "block long, id long, g double, w double, v double"
SENT = pa.schema([("block", pa.int64()), ("id", pa.int64()), ("g", pa.float64()), ("w", pa.float64()), ("v", pa.float64())])
#: Cumulative probabilities, times 10,000, of a row drawn 0 to 4 times by a Poisson law of mean 1.
POISSON = (3679, 7358, 9197, 9810, 9963)


def naive_bayes(
    df: DataFrame,
    doc_id: str,
    text: str = "text",
    label: str = "label",
    split: str = "split",
    classes: Sequence[int] = (0, 1),
    smoothing: float = 1.0,
) -> DataFrame:
    """``(doc_id, label, pred)`` of the ``test`` rows by multinomial naive Bayes learned from the ``train`` rows.

    Words that training doesn't know add nothing; equal scores go to the class named first. Training is one count per word
    and class, prediction one join on the word and one sum per text.
    """
    rows = df.select(doc_id, text, F.col(label).cast("int").alias("label"), F.col(split).alias("split"))
    terms = lexical.document_terms(rows, doc_id, lexical.vectorizer_words(F.col(text)), (), ["label", "split"])
    own = {c: F.sum(F.when(F.col("label") == c, F.col("tf")).otherwise(0)) for c in classes}
    known = terms.where("split = 'train'").groupBy("term").agg(*[own[c].alias(f"c{c}") for c in classes])
    size = known.agg(F.count(F.lit(1)).alias("n")).scalar()
    logs = [
        F.log((F.col(f"c{c}") + smoothing) / (known.agg(F.sum(f"c{c}").alias("n")).scalar() + smoothing * size)).alias(f"l{c}")
        for c in classes
    ]
    train = rows.where("split = 'train'")
    prior = {c: train.agg(F.log(F.count(F.when(F.col("label") == c, 1)) / F.count(F.lit(1))).alias("p")).scalar() for c in classes}
    sums = terms.where("split = 'test'").join(known.select("term", *logs), "term").groupBy(doc_id)
    sums = sums.agg(*[F.sum(F.col("tf") * F.col(f"l{c}")).alias(f"s{c}") for c in classes])
    scored = rows.where("split = 'test'").select(doc_id, "label").join(sums, doc_id, "left")
    scores = F.array(*[F.coalesce(F.col(f"s{c}"), F.lit(0.0)) + prior[c] for c in classes])
    return scored.select(doc_id, "label", F.get(F.array(*map(F.lit, classes)), metrics.argmax(scores)).alias("pred"))


def _joined(postings: DataFrame, weights: DataFrame) -> DataFrame:
    """Postings with their words' weights: frequent words, of bounded number, reach every task, the others are shuffled."""
    hot = F.broadcast(weights.where("hot").select("id", "w"))
    rare = postings.join(F.broadcast(weights.where("hot").select("id")), "id", "left_anti")
    return postings.join(hot, "id").unionByName(rare.join(weights.where("NOT hot").select("id", "w"), "id"))


def _vectors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written tables ``(_doc, label, split, words, norm)`` and ``(id, df, hot)``: TF-IDF vectors and the words' ids.

    A vector's ``words`` are ``(id, tfidf)``, with an intercept of null; ``norm`` is their length. The vocabulary and its
    document frequencies are those of the ``train`` rows.
    """
    terms = lexical.document_terms(rows, "_doc", lexical.vectorizer_words(F.col("_text")), (), ["label", "split"])
    terms = materialised(terms, "terms")
    train = rows.where("split = 'train'")
    vocabulary = lexical.tfidf_vocabulary(terms.where("split = 'train'"), train, 1, 1.0)
    index = lexical.term_index(vocabulary)
    size = index.agg(F.sum("df").alias("n")).scalar()
    index = materialised(index.withColumn("hot", F.col("df") > size * HOT_SHARE), "index")
    # At most 1 / HOT_SHARE words are hot.
    hot = F.broadcast(index.where("hot").select("term"))
    known = [terms.join(F.broadcast(index.where("hot")), "term"), terms.join(hot, "term", "left_anti").join(index.where("NOT hot"), "term")]
    key = ["_doc", "label", "split"]
    weighted = known[0].unionByName(known[1]).where(F.col("_doc").isNotNull())
    weighted = weighted.select(*key, "id", ((F.log("tf") + 1) * F.col("idf")).alias("tfidf"))
    ones = rows.select(*key, F.lit(INTERCEPT).cast("long").alias("id"), F.lit(None).cast("double").alias("tfidf"))
    # Dealt by text once, for the list, and for the length of a text that occurs with several labels.
    gathered = weighted.unionByName(ones).repartition("_doc").groupBy(*key).agg(
        F.collect_list(F.struct("id", "tfidf")).alias("words"), F.sum(F.col("tfidf") * F.col("tfidf")).alias("square")
    )
    norm = F.sqrt(F.sum("square").over(Window.partitionBy("_doc")))
    vectors = materialised(gathered.select(*key, "words", norm.alias("norm")), "vectors")
    every = rows.sparkSession.range(1).select(F.lit(INTERCEPT).cast("long").alias("id"), F.lit(0).cast("long").alias("df"), F.lit(True).alias("hot"))
    return vectors, index.select("id", "df", "hot").unionByName(every)


def _block_gradient(share: Mapping) -> Callable[[pa.Table, pa.Table | None], pa.Table]:
    """The function that gives ``(block, id, g, w, v)`` of a block of vectors and of the ``(id, w, v)`` of its words, zero at first."""

    def gradient(vectors: pa.Table, sent: pa.Table | None = None) -> pa.Table:
        if not vectors.num_rows:
            return SENT.empty_table()
        words = vectors["words"].combine_chunks()
        row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
        ids = pc.struct_field(words.flatten(), "id").to_numpy(zero_copy_only=False)
        tfidf = pc.struct_field(words.flatten(), "tfidf").to_numpy(zero_copy_only=False)
        norm = vectors["norm"].combine_chunks().to_numpy(zero_copy_only=False).astype(float)
        x = np.where(ids == INTERCEPT, 1.0, tfidf / norm[row])
        known, at = np.unique(ids, return_inverse=True)
        w, v = np.zeros(len(known)), np.zeros(len(known))
        if sent is not None:
            place = np.searchsorted(known, sent["id"].to_numpy())
            w[place], v[place] = sent["w"].to_numpy(), sent["v"].to_numpy()
        label = vectors["label"].combine_chunks().to_numpy(zero_copy_only=False).astype(float)
        sign = label * 2 - 1
        slack = np.maximum(0.0, 1 - sign * np.bincount(row, x * v[at], len(words)))
        pull = -2.0 * sign * slack * np.where(label == 1, share[1], share[0]) / max(share["rows"], 1)
        # A text that occurs with both labels is pulled by both; texts without id or label pull nothing.
        text = pc.fill_null(vectors["_doc"].combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False) + 1
        pulls = np.bincount(text, np.nan_to_num(pull))
        pulls[0] = 0.0
        g = np.bincount(at, x * pulls[text][row], len(known))
        block = np.full(len(known), vectors["block"][0].as_py(), "int64")
        return pa.table([block, known, g, w, v], schema=SENT)

    return gradient


def linear_svm(
    df: DataFrame,
    doc_id: str,
    text: str = "text",
    label: str = "label",
    split: str = "split",
    rounds: int = 10,
    ridge: float = 1e-4,
    step: float = 0.25,
    block: int = 2_000_000,
) -> DataFrame:
    """``(doc_id, label, score, pred)`` of the ``test`` rows by a linear support vector machine learned from the ``train`` rows.

    Squared hinge loss with classes of equal weight, by ``rounds`` accelerated gradient steps over all rows. Texts are dealt once
    into blocks of about ``block`` postings, which stay where they are: in a round, a block gets the weights of the words that
    it has, and sends one sum for each of them. So a round shuffles words of blocks, not of texts, and a vocabulary of any size
    stays distributed. Vectors have unit length beside the intercept, so a step of 0.25 never
    overshoots. ``doc_id`` is unique; a text without known words scores by the intercept. Training runs while the plan is built.
    """
    named = [F.col(doc_id).alias("_doc"), F.col(text).alias("_text")]
    rows = df.select(*named, F.col(label).cast("int").alias("label"), F.col(split).alias("split"))
    vectors, ids = _vectors(rows)
    postings = ids.agg(F.sum("df")).first()[0]
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(postings / block))
    train = vectors.where("split = 'train'").withColumn("block", F.pmod(F.xxhash64("_doc"), F.lit(parts)))
    train = train.repartition(parts, "block").sortWithinPartitions("block").persist(StorageLevel.DISK_ONLY)
    gradient = _block_gradient(class_weights(rows.where("split = 'train'")))
    sent = None
    for k in range(1, rounds + 1):
        blocks = train.groupBy("block")
        if sent is None:
            sums = blocks.applyInArrow(lambda vectors: gradient(vectors), SENT_DDL)
        else:
            sums = blocks.cogroup(sent.groupBy("block")).applyInArrow(lambda vectors, words: gradient(vectors, words), SENT_DDL)
        # Every block that has a word makes the same step.
        u = F.col("v") - step * (F.sum("g").over(Window.partitionBy("id")) + ridge * F.col("v"))
        moved = sums.select("block", "id", "w", u.alias("u"))
        sent = moved.select("block", "id", F.col("u").alias("w"), (F.col("u") + ((k - 1) / (k + 2)) * (F.col("u") - F.col("w"))).alias("v"))
    learned = ids.select("id", "hot")
    if sent is not None:
        learned = learned.join(sent.groupBy("id").agg(F.first("w").alias("w")), "id", "left")
    else:
        learned = learned.withColumn("w", F.lit(0.0))
    weights = materialised(learned.select("id", "hot", F.coalesce("w", F.lit(0.0)).alias("w")), "weights")
    train.unpersist()
    test = vectors.where("split = 'test'").select("_doc", "label", "norm", F.explode("words").alias("word"))
    x = F.when(F.col("word.id") == INTERCEPT, 1.0).otherwise(F.col("word.tfidf") / F.col("norm"))
    scored = _joined(test.select("_doc", "label", "word.id", x.alias("x")), weights).groupBy("_doc", "label").agg(F.sum(F.col("x") * F.col("w")).alias("score"))
    return scored.select(F.col("_doc").alias(doc_id), "label", "score", F.when(F.col("score") > 0, 1).otherwise(0).alias("pred"))


def class_weights(train: DataFrame) -> dict:
    """Weights of the classes 0 and 1 that make them equal, and the number of rows."""
    n, ones = train.agg(F.count(F.lit(1)), F.count(F.when(F.col("label") == 1, 1))).first()
    return {"rows": n, 0: n / (2.0 * (n - ones)) if n > ones else 0.0, 1: n / (2.0 * ones) if ones else 0.0}


def _hash_pair(value: Column, name: str) -> list[Column]:
    """Two numbers below 2**32 of a text's digest."""
    digest = F.md5(value)
    return [F.conv(F.substring(digest, at, 8), 16, 10).cast("long").alias(f"{name}{i}") for i, at in ((1, 1), (2, 9))]


def _bag(h1: Column, h2: Column, trees: int) -> Column:
    """How often each tree draws a row."""

    def draws(tree: Column) -> Column:
        u = (h1 + tree * h2) % 10_000
        return sum((F.when(u >= p, 1).otherwise(0) for p in POISSON[1:]), F.when(u >= POISSON[0], 1).otherwise(0))

    return F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), draws)


def _impurity(c0: Column, c1: Column, share: Mapping) -> Column:
    a, b = c0 * F.lit(share[0]), c1 * F.lit(share[1])
    return F.when(a + b > 0, 2.0 * a * b / (a + b)).otherwise(0.0)


def _asking(level: int, trees: int, depth: int, one_in: int) -> Column:
    """Trees that look at a word, of the hashes h1 and h2, on a level."""
    numbers = F.sequence(F.lit(0), F.lit(trees - 1))
    return F.filter(numbers, lambda t: (F.col("h1") + (t * depth + level) * F.col("h2")) % one_in == 0)


def _descended(df: DataFrame, splits: Mapping[int, str], width: int, trees: int) -> DataFrame:
    """Nodes of the next level: twice the node, plus one where the text has the node's word; leaves stay."""
    if not splits:
        return df
    # An array by place is read in one step, a map by a search of all its entries.
    words = F.array(*[F.lit(splits.get(k)).cast("string") for k in range(trees * width)])
    asked = F.array(*[F.lit(w) for w in sorted(set(splits.values()))])

    def children(has: Column) -> Column:
        def child(node: Column, tree: Column) -> Column:
            word = F.get(words, tree * width + node)
            return F.when(word.isNull(), node).otherwise(node * 2 + F.array_contains(has, word).cast("int"))

        return F.transform("nodes", child)

    # The asked words that a text has are found once by hashing; as the element of an array they aren't computed for each tree.
    return df.withColumn("nodes", F.get(F.transform(F.array(F.array_intersect("words", asked)), children), F.lit(0)))


def random_forest(
    df: DataFrame,
    doc_id: str,
    text: str = "text",
    label: str = "label",
    split: str = "split",
    trees: int = 50,
    depth: int = 4,
    seed: int = 42,
) -> DataFrame:
    """``(doc_id, label, score, pred)`` of the ``test`` rows by a forest of trees that ask whether a text has a word.

    A tree draws every training row as often as a digest of its id says (mean 1) and looks, on each level, at one word in the
    square root of the vocabulary. Which words these are is told once for each word, not for each place, and sent to the tasks.
    All trees grow one level by one aggregate over the words that they look at; what the driver sees is at most one word for each node, ``trees * 2**depth`` in all. Classes weigh the same, the score is the mean share of
    class 1 in the leaves, equal splits go to the smallest word. ``doc_id`` is unique; without training rows scores are 0.
    """
    width = 1 << (depth + 1)
    rows = df.select(
        F.col(doc_id).alias("_doc"),
        F.array_distinct(lexical.vectorizer_words(F.col(text))).alias("words"),
        F.col(label).cast("int").alias("label"),
        F.col(split).alias("split"),
        F.array_repeat(F.lit(1), trees).alias("nodes"),
        *_hash_pair(F.concat(F.col(doc_id).cast("string"), F.lit(f"#{seed}")), "r"),
    )
    rows = materialised(rows.withColumn("bag", _bag(F.col("r1"), F.col("r2"), trees)).drop("r1", "r2"), "bags")
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    share = class_weights(train)
    vocabulary = train.select(F.explode("words").alias("term")).distinct()
    vocabulary = materialised(vocabulary.select("term", *_hash_pair(F.col("term"), "h")), "vocabulary")
    one_in = max(1, math.isqrt(vocabulary.count()))
    of = [F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)]

    def sizes(docs: DataFrame) -> DataFrame:
        drawn = docs.select("label", F.posexplode(F.arrays_zip("bag", "nodes")).alias("tree", "d"))
        return drawn.select("label", "tree", F.col("d.nodes").alias("node"), F.col("d.bag").alias("n")).where("n > 0").groupBy("tree", "node").agg(*of)

    for level in range(depth):
        words = train.select("label", "bag", "nodes", F.explode("words").alias("term"))
        asked = vocabulary.select("term", _asking(level, trees, depth, one_in).alias("asking")).where(F.size("asking") > 0)
        # At most about ``trees`` times the square root of the vocabulary.
        found = words.join(F.broadcast(asked), "term").select("label", "bag", "nodes", "term", F.explode("asking").alias("tree"))
        found = found.select("label", "term", "tree", F.get("nodes", F.col("tree")).alias("node"), F.get("bag", F.col("tree")).alias("n"))
        found = found.where((F.col("n") > 0) & (F.col("node") >= 1 << level)).groupBy("tree", "node", "term").agg(*of)
        totals = sizes(train).select("tree", "node", F.col("n0").alias("t0"), F.col("n1").alias("t1"))
        # One row a node: bounded by the shape of the forest.
        both = found.join(F.broadcast(totals), ["tree", "node"])
        gain = _impurity(F.col("t0"), F.col("t1"), share) - _impurity(F.col("n0"), F.col("n1"), share)
        gain = F.round(gain - _impurity(F.col("t0") - F.col("n0"), F.col("t1") - F.col("n1"), share), 9)
        best = both.withColumn("gain", gain).where("gain > 0").groupBy("tree", "node").agg(F.min(F.struct(-F.col("gain"), "term")).alias("b"))
        splits = {t * width + node: word for t, node, word in best.select("tree", "node", "b.term").collect()}
        train, test = (_descended(part, splits, width, trees) for part in (train, test))
    leaves = {}
    for tree, node, n0, n1 in sizes(train).collect():
        a, b = n0 * share[0], n1 * share[1]
        leaves[tree * width + node] = b / (a + b) if a + b > 0 else 0.0
    if leaves:
        shares = F.array(*[F.lit(leaves.get(k, 0.0)) for k in range(trees * width)])
        votes = F.transform("nodes", lambda node, t: F.get(shares, t * width + node))
        score = F.aggregate(votes, F.lit(0.0), lambda s, x: s + x) / float(trees)
    else:
        score = F.lit(0.0)
    scored = test.select(F.col("_doc").alias(doc_id), "label", score.alias("score"))
    return scored.select("*", F.when(F.round("score", 9) >= 0.5, 1).otherwise(0).alias("pred"))


#: Learners that score test rows.
LEARNERS = {"linear_svm": linear_svm, "random_forest": random_forest}


def fit_and_score(df: DataFrame, model: str, doc_id: str, **settings) -> DataFrame:
    """Train on ``train`` rows and score the ``test`` rows with all binary scores."""
    predicted = LEARNERS[model](df, doc_id, **settings).select("label", "pred")
    return metrics.binary_metrics(predicted).select(F.lit(model).alias("model"), "*")
