"""Prefix trie of conversations, with the totals of every subtree by parallel tree contraction.

1. Names. The prefix of d turns is named by d and two sums of 60 bits, one term a turn: pieces of the SHA-256 of the turn's
   place and content. Sums of prefixes are running sums in chunks of ``CHUNK`` turns, so a long conversation is many tasks' work.
2. Nodes. Equal names are one node, known from then on by its smallest conversation and its depth.
3. Contraction. First, unary chains within a chunk of one conversation shrink to their last node. Then rounds follow: rake
   takes all leaves and adds their totals to their parents; compress takes every unary node whose drawn number is smaller than
   those of its parent and its child, and hangs the child on the parent. Removed leaves have their totals. A removed unary node
   keeps its child's name and what it has itself; joins that double the steps re-expand these to the child's total.

A node's link to its parent carries what the nodes between them, removed by now, add to the parent's total. The rounds grow
with the logarithm of the nodes, also where all turns form one chain.

Defined results: turns are ordered by turn (null first), ties by the SHA-256 of role and text; null role or text is empty;
repeated rows are repeated turns; rows without a conversation id take no part; the root is there if any conversation is, also
one without turns; other columns are left out; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.shared import written

CHUNK = 1024
#: Conversation ids that end in one node travel in strings of at most 2**IDS of them.
IDS = 12
#: Pieces in which the children of one node meet it.
PIECES = 64
_HEX, _MASK = 13, (1 << 52) - 1
_NAME = ["depth", "s1", "s2"]
_SUMS = ("leaves", "saved")


def _text(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def ordered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv, part, at, digest, size) of every turn, at from 0, and (conv, part, n, before, total) of the parts.

    Rows are sorted by ranges, so one conversation may be many parts; the second table, a row for each conversation and part,
    joins the parts' own numbers.
    """
    content = F.concat(F.octet_length(_text(role)).cast("string"), F.lit(":"), _text(role), _text(text))
    rows = conversations.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.octet_length(_text(text)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]
    rows = written(rows.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "turns")
    counts = rows.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("conv")
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = written(counts.select("*", before.alias("before"), F.sum("n").over(own).alias("total")), "parts")
    at = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    rows = rows.select("conv", "part", "digest", "size", (at - 1).cast("long").alias("own"))
    turns = rows.join(parts, ["conv", "part"]).select("conv", "part", (F.col("before") + F.col("own")).alias("at"), "digest", "size")
    return turns, parts


def _named(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, s1, s2, p1, p2, size) of every prefix, the empty one included; p1 and p2 are the sums without its last turn."""
    term = F.sha2(F.concat(F.col("depth").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("digest")), 256)
    terms = [F.conv(F.substring(term, 1 + k * _HEX, _HEX), 16, 10).cast("long").alias(f"t{k + 1}") for k in (0, 1)]
    rows = turns.select("conv", "depth", "size", *terms, F.expr(f"(depth - 1) div {CHUNK}").alias("chunk"))
    rows = written(rows, "terms")
    chunks = rows.groupBy("conv", "chunk").agg(F.sum("t1").alias("t1"), F.sum("t2").alias("t2"))
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)

    def sum_before(k: int) -> Column:
        total = F.sum(F.col(f"t{k}").bitwiseAND(F.lit(_MASK)).cast("decimal(20,0)")).over(earlier)
        return F.coalesce((total % F.lit(_MASK + 1)).cast("long"), F.lit(0))

    chunks = chunks.select("conv", "chunk", sum_before(1).alias("b1"), sum_before(2).alias("b2")).where("chunk > 0")
    running = Window.partitionBy("conv", "chunk").orderBy("depth")
    rows = rows.select("*", *[F.sum(f"t{k}").over(running).bitwiseAND(F.lit(_MASK)).alias(f"r{k}") for k in (1, 2)])
    rows = rows.join(chunks, ["conv", "chunk"], "left")
    sums = [(F.col(f"r{k}") + F.coalesce(f"b{k}", F.lit(0))).bitwiseAND(F.lit(_MASK)) for k in (1, 2)]
    rows = rows.select("conv", "depth", sums[0].alias("s1"), sums[1].alias("s2"), "t1", "t2", "size")
    less = [(F.col(f"s{k}") - F.col(f"t{k}")).bitwiseAND(F.lit(_MASK)).alias(f"p{k}") for k in (1, 2)]
    rows = rows.select("conv", "depth", "s1", "s2", *less, "size")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = convs.select("conv", zero.alias("depth"), zero.alias("s1"), zero.alias("s2"), none.alias("p1"), none.alias("p2"), zero.alias("size"))
    return written(rows.unionAll(roots), "prefixes")


def _tree(prefixes: DataFrame) -> DataFrame:
    """A row for each node: its name, conv, n_convs, n_children, up_conv, and what it saves."""
    nodes = prefixes.groupBy(*_NAME).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), *[F.min(x).alias(x) for x in ("p1", "p2", "size")]
    )
    piece = F.pmod(F.xxhash64("conv"), F.lit(PIECES)).cast("int")
    nodes = written(nodes.withColumn("piece", F.when(F.col("depth") > 0, piece)), "nodes")
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2")]
    children = nodes.where("depth > 0").groupBy(*up, "piece").agg(F.count(F.lit(1)).alias("n"))
    children = children.groupBy(*_NAME).agg(F.sum("n").alias("n_children"), F.collect_list("piece").alias("pieces"))
    children = nodes.select(*_NAME, F.col("conv").alias("up_conv")).join(children, _NAME)
    children = written(children, "children")
    links = children.select((F.col("depth") + 1).alias("depth"), F.col("s1").alias("p1"), F.col("s2").alias("p2"), "up_conv", F.explode("pieces").alias("piece"))
    tree = nodes.join(links, ["depth", "p1", "p2", "piece"], "left").join(children.select(*_NAME, "n_children"), _NAME, "left")
    saved = (F.col("n_convs") - 1) * F.col("size")
    return written(tree.select(*_NAME, "conv", "up_conv", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), saved.alias("saved")), "tree")


def _chains(tree: DataFrame) -> DataFrame:
    """State of the nodes, after the unary chains in a chunk of one conversation have shrunk to their last node.

    Nodes of one conversation are a path, so the row behind a unary node of the same chunk is its child.
    """
    state = tree.select(
        "conv",
        "depth",
        "up_conv",
        F.when(F.col("up_conv").isNotNull(), F.col("depth") - 1).alias("up_depth"),
        F.col("n_children").alias("kids"),
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        "saved",
        F.expr(f"depth div {CHUNK}").alias("chunk"),
    )
    path = Window.partitionBy("conv", "chunk").orderBy("depth")
    linked = (F.col("kids") == 1) & F.col("up_conv").isNotNull() & F.lead("depth").over(path).isNotNull()
    state = state.withColumn("gone", linked)
    run = F.sum((~F.col("gone")).cast("long")).over(path.rowsBetween(Window.unboundedPreceding, -1))
    state = state.withColumn("run", F.coalesce(run, F.lit(0)))
    chain = Window.partitionBy("conv", "chunk", "run").orderBy("depth")
    whole, rest = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), chain.rowsBetween(0, Window.unboundedFollowing)

    def removed(window, name: str) -> Column:
        return F.sum(F.when(F.col("gone"), F.col(name)).otherwise(0)).over(window)

    return state.select(
        "conv",
        "depth",
        "kids",
        *_SUMS,
        "gone",
        F.first("up_conv").over(whole).alias("up_conv"),
        F.first("up_depth").over(whole).alias("up_depth"),
        *[removed(whole, x).alias(f"e_{x}") for x in _SUMS],
        F.col("conv").alias("rep_conv"),
        F.last("depth").over(whole).alias("rep_depth"),
        *[removed(rest, x).alias(f"add_{x}") for x in _SUMS],
    )


_STATE = ["conv", "depth", "kids", *_SUMS, "up_conv", "up_depth", "e_leaves", "e_saved"]
_RECORD = ["conv", "depth", "rep_conv", "rep_depth", "add_leaves", "add_saved"]


def _raked(state: DataFrame) -> DataFrame:
    """The state with ``done`` where a node is a leaf, the totals of these added to their parents."""
    leaves = state.where("kids = 0 AND up_conv IS NOT NULL").groupBy(F.col("up_conv").alias("conv"), F.col("up_depth").alias("depth"))
    added = leaves.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(x) + F.col(f"e_{x}")).alias(f"a_{x}") for x in _SUMS])
    both = state.join(added, ["conv", "depth"], "left")
    return both.select(
        "conv",
        "depth",
        (F.col("kids") - F.coalesce("n", F.lit(0))).alias("kids"),
        *[(F.col(x) + F.coalesce(f"a_{x}", F.lit(0))).alias(x) for x in _SUMS],
        *_STATE[5:],
        (F.col("kids") == 0).alias("done"),
    )


def _chosen(state: DataFrame, turn: int) -> DataFrame:
    """Unary nodes to remove, no two of them neighbours, each with its child and its parent."""
    child = F.struct("conv", "depth", "e_leaves", "e_saved")
    only = state.where("up_conv IS NOT NULL").groupBy(F.col("up_conv").alias("conv"), F.col("up_depth").alias("depth")).agg(F.min(child).alias("child"))

    def drawn(conv: str, depth: str) -> Column:
        return F.xxhash64(F.lit(turn), conv, depth)

    own = drawn("conv", "depth")
    unary = state.where("kids = 1 AND up_conv IS NOT NULL").join(only, ["conv", "depth"])
    unary = unary.where((own < drawn("up_conv", "up_depth")) & (own < drawn("child.conv", "child.depth")))
    return unary.select(
        "conv",
        "depth",
        F.col("child.conv").alias("rep_conv"),
        F.col("child.depth").alias("rep_depth"),
        *[(F.col(x) + F.col(f"child.e_{x}")).alias(f"add_{x}") for x in _SUMS],
        "up_conv",
        "up_depth",
        *[(F.col(x) + F.col(f"e_{x}")).alias(f"x_{x}") for x in _SUMS],
    )


def _compressed(state: DataFrame, chosen: DataFrame) -> DataFrame:
    """The state without the chosen nodes, their children hung on their parents."""
    moved = chosen.select(
        F.col("rep_conv").alias("conv"), F.col("rep_depth").alias("depth"), F.struct("up_conv", "up_depth").alias("to"), *[f"x_{x}" for x in _SUMS]
    )
    rest = state.join(chosen.select("conv", "depth"), ["conv", "depth"], "left_anti").join(moved, ["conv", "depth"], "left")
    return rest.select(
        *_STATE[:5],
        F.coalesce("to.up_conv", "up_conv").alias("up_conv"),
        F.coalesce("to.up_depth", "up_depth").alias("up_depth"),
        *[(F.col(f"e_{x}") + F.coalesce(f"x_{x}", F.lit(0))).alias(f"e_{x}") for x in _SUMS],
    )


def _expanded(records: list[DataFrame], totals: DataFrame) -> DataFrame:
    """Totals of the removed nodes: each names a node that was removed later or raked."""
    found = records[0]
    for more in records[1:]:
        found = found.unionAll(more)
    found = written(found, "removed")
    for _ in range(len(records).bit_length()):
        far = found.select(F.col("conv").alias("rep_conv"), F.col("depth").alias("rep_depth"), F.struct(*_RECORD[2:]).alias("far"))
        joined = found.join(far, ["rep_conv", "rep_depth"], "left")
        found = written(
            joined.select(
                "conv",
                "depth",
                F.coalesce("far.rep_conv", "rep_conv").alias("rep_conv"),
                F.coalesce("far.rep_depth", "rep_depth").alias("rep_depth"),
                *[(F.col(f"add_{x}") + F.coalesce(f"far.add_{x}", F.lit(0))).alias(f"add_{x}") for x in _SUMS],
            ),
            "removed",
        )
    rep = totals.select(F.col("conv").alias("rep_conv"), F.col("depth").alias("rep_depth"), *_SUMS)
    return found.join(rep, ["rep_conv", "rep_depth"]).select("conv", "depth", *[(F.col(x) + F.col(f"add_{x}")).alias(x) for x in _SUMS])


def subtree_totals(tree: DataFrame) -> DataFrame:
    """(conv, depth, leaves, saved): sums over the subtree of each node of a written tree, by contraction."""
    first = written(_chains(tree), "state")
    records, done = [first.where("gone").select(*_RECORD)], []
    state, turn = first.where("NOT gone").select(*_STATE), 0
    while True:
        raked = written(_raked(state), "state")
        done.append(raked.where("done").select("conv", "depth", *_SUMS))
        state, turn = raked.where("NOT done").select(*_STATE), turn + 1
        if state.isEmpty():
            break
        chosen = written(_chosen(state, turn), "chosen")
        records.append(chosen.select(*_RECORD))
        state = _compressed(state, chosen)
    totals = done[0]
    for more in done[1:]:
        totals = totals.unionAll(more)
    totals = written(totals, "totals")
    return totals.unionAll(_expanded(records, totals))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, s1, s2, piece, ids) in order to one digest a name; one string of ids is held at a time."""
    at, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.record_batch([pa.array([x], pa.int64()) for x in at] + [pa.array([digest.hexdigest()])], names=[*_NAME, "ends_sha256"])

    for batch in batches:
        for *name, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if name != at:
                if at is not None:
                    yield row()
                at, digest = name, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if at is not None:
        yield row()


def _ends(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, s1, s2, ends_sha256) of the nodes in which conversations end."""
    last = prefixes.join(convs.select("conv", F.col("turns").alias("depth")), ["conv", "depth"])
    pieces = last.groupBy(*_NAME, F.shiftright("conv", IDS).alias("piece")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    pieces = pieces.select(*_NAME, "piece", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    pieces = pieces.repartition(*_NAME).sortWithinPartitions(*_NAME, "piece")
    return pieces.mapInArrow(_hashed, "depth bigint, s1 bigint, s2 bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Every node of the trie of conversations: ``turns`` (conv, depth from 1, digest, size), ``convs`` (conv, turns)."""
    prefixes = _named(turns, convs)
    tree = _tree(prefixes)
    totals = subtree_totals(tree)
    found = tree.join(totals.withColumnRenamed("saved", "saved_tokens"), ["conv", "depth"]).join(_ends(prefixes, convs), _NAME, "left")
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("up_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def rebuilt(turns: DataFrame, parts: DataFrame, family: int, shared: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations begun like the first of their family: turns and conversations for ``prefix_trie``.

    Conversation c has the first ``shared`` (a column of ``conv``, bounded) turns of c - c % family in place of its own.
    """
    sizes = parts.groupBy("conv").agg(F.max("total").alias("total"))
    base = (F.col("conv") - F.col("conv") % family).alias("base")
    heads = sizes.select("conv", "total", base, shared.cast("long").alias("shared"))
    heads = heads.join(sizes.select(F.col("conv").alias("base"), F.col("total").alias("there")), "base", "left")
    taken = F.least("shared", F.coalesce("there", F.lit(0)))
    heads = written(heads.select("conv", "base", "shared", "total", taken.cast("long").alias("taken")), "heads")
    convs = heads.select("conv", (F.col("taken") + F.greatest(F.col("total") - F.col("shared"), F.lit(0))).alias("turns"))

    most = heads.agg(F.max("shared")).first()[0] or 0
    first = turns.where(F.col("at") < most).select(F.col("conv").alias("base"), "at", "digest", "size")
    first = first.join(heads.select("conv", "base", "taken"), "base").where(F.col("at") < F.col("taken"))
    placed = parts.select("conv", "part").join(heads.select("conv", "shared", "taken"), "conv")
    own = turns.join(placed, ["conv", "part"]).where(F.col("at") >= F.col("shared"))
    own = own.select("conv", (F.col("at") - F.col("shared") + F.col("taken") + 1).alias("depth"), "digest", "size")
    return own.unionAll(first.select("conv", (F.col("at") + 1).alias("depth"), "digest", "size")), convs


def whole(turns: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are, for ``prefix_trie``."""
    convs = parts.groupBy("conv").agg(F.max("total").alias("turns"))
    return turns.select("conv", (F.col("at") + 1).alias("depth"), "digest", "size"), convs
