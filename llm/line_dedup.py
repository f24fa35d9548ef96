"""Removal of repeated blocks of lines, in DataFrame functions only.

A block is two neighbouring lines or more. Texts are cut into chunks of lines where their content says so: a rolling hash over
the hashes of the last two lines proposes a boundary where its lowest bit is set, at every other line on average; a chunk has
two lines at least, so of proposals in a row every other one counts. Chunks are looked up over all documents by their hash,
which finds whole copies and long blocks with few rows. What chunks leave, as a block rarely begins and ends at boundaries, is
settled by the pairs of neighbouring lines outside the chunks that go: every other pair is looked up as well, so no line of a
repeated block is left over, however short the block is. A chunk or pair goes if a document with a smaller id has it, or
its own document has it before without overlap, and a line goes with a chunk or pair that it belongs to. Pairs inside a chunk
that goes would go as well, and of every pair the first place is in no such chunk, so the look-ups give what one of all pairs
would. The bytes of all chunks and pairs of one hash are compared before any goes: those with a hash that unlike ones share stay.

Defined results: null texts stay null; rows without an id keep their text and remove nothing; rows of one id don't remove
each other's chunks; texts of one line stay; chunks are looked up in the texts as they came; a text that loses all its lines is
empty; lines end at \\n only and are compared as they are, an empty line being a line; other columns stay as they are,
whatever their names, but for ``n_lines`` and ``n_removed_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.shared import PIECES, written

_KEY = ["id", "body"]


def _hash(line: Column) -> Column:
    """60 bits of a line."""
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("long")


def _starts(rolled: Column, lines: Column) -> Column:
    """First lines of the chunks; ``rolled`` holds the rolling hash of lines i and i + 1 at i.

    Arrays are arguments of their functions and never read inside a lambda, where they would be computed for each element.
    """
    places = F.transform(rolled, lambda h, i: F.when((h.bitwiseAND(F.lit(1)) == 0) & (i <= lines - 4), i + 2))
    refused = F.concat(F.array(F.lit(1)), F.filter(places, lambda i: i.isNotNull()), F.array(lines - 1))
    none = F.array().cast("array<int>")

    def between(at: Column, to: Column) -> Column:
        return F.when(to > at + 1, F.sequence(at + 1, to - 1, F.lit(2))).otherwise(none)

    # The last place has no end: null, and so no start behind it.
    inner = F.zip_with(refused, F.slice(refused, F.lit(2), lines), between)
    return F.concat(F.array(F.lit(0)), F.flatten(inner))


def _placed(n: Column) -> list[Column]:
    """The columns (key, start, n, hash) of ``n`` lines from ``start`` on."""
    return [*_KEY, "start", n.alias("n"), F.xxhash64(F.slice("hashes", F.col("start") + 1, n)).alias("hash")]


def chunks(hashed: DataFrame) -> DataFrame:
    """A row (key, start, n, hash) for each chunk of the texts with the line hashes ``hashes``."""
    neighbours = F.sequence(F.lit(1), F.size("hashes") - 1)
    roll = F.transform(neighbours, lambda i: F.get("hashes", i).bitwiseXOR(F.shiftright(F.get("hashes", i - 1), 1)))
    rows = hashed.select(*_KEY, "hashes", F.size("hashes").alias("lines"), roll.alias("rolled"))
    rows = rows.select(*_KEY, "hashes", "lines", _starts(F.col("rolled"), F.col("lines")).alias("starts"))
    rows = rows.select("*", F.posexplode("starts").alias("i", "start"))
    return rows.select(*_placed(F.coalesce(F.get("starts", F.col("i") + 1), F.col("lines")) - F.col("start")))


def pairs(hashed: DataFrame, repeated: DataFrame) -> DataFrame:
    """A row (key, start, n, hash) for each pair of neighbouring lines that is in no chunk that goes."""
    inside = F.sequence(F.col("chunk.start"), F.col("chunk.start") + F.col("chunk.n") - 2)
    going = repeated.where("chunk.goes").select(*_KEY, inside.alias("inside")).groupBy(*_KEY).agg(F.flatten(F.collect_set("inside")).alias("inside"))
    every = F.sequence(F.lit(0), F.size("hashes") - 2)
    left = F.when(F.col("inside").isNull(), every).otherwise(F.array_except(every, "inside"))
    rows = hashed.join(going, _KEY, "left").select(*_KEY, "hashes", F.explode(left).alias("start"))
    return rows.select(*_placed(F.lit(2)))


def _repeated(rows: DataFrame) -> DataFrame:
    """The chunks that occur more than once, with ``goes`` unless they are the first.

    A hash's rows meet in pieces by id, and the smallest id goes back to the pieces that exist, so no task has all of a
    frequent chunk.
    """
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("id"), F.lit(PIECES)).cast("int"))
    pieces = rows.groupBy("hash", "piece").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("times"))
    first = pieces.groupBy("hash").agg(F.min("low").alias("first"), F.sum("times").alias("times"), F.collect_list("piece").alias("pieces"))
    first = first.where("times > 1").select("hash", "first", F.explode("pieces").alias("piece"))
    own = Window.partitionBy("hash", "piece", *_KEY).orderBy("start")
    found = rows.join(first, ["hash", "piece"]).withColumn("before", F.min("start").over(own))
    goes = (F.col("first") < F.col("id")) | (F.col("start") >= F.col("before") + F.col("n"))
    return found.select(*_KEY, F.struct("start", "n", "hash", goes.alias("goes")).alias("chunk"))


def dedup_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without repeated blocks of lines, with ``n_lines`` and ``n_removed_lines``."""
    documents = documents.drop("n_lines", "n_removed_lines")
    keyed = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("body"),
        F.col(f"`{text_col}`").alias("text"),
    )
    hashes = F.transform(F.split("text", "\n", -1), _hash)
    hashed = written(keyed.where(F.col("id").isNotNull() & F.contains("text", F.lit("\n"))).select(*_KEY, hashes.alias("hashes")), "hashes")
    text = F.col("row").getField(text_col)
    split = F.split(text, "\n", -1)

    unlike = None
    while True:
        alike = (lambda rows: rows) if unlike is None else (lambda rows, u=unlike: rows.join(u, "hash", "left_anti"))
        repeated = written(_repeated(alike(chunks(hashed))), "chunks")
        hits = repeated.unionAll(_repeated(alike(pairs(hashed, repeated)))).groupBy(*_KEY).agg(F.collect_list("chunk").alias("chunks"))
        found = written(keyed.drop("text").join(hits, _KEY, "left"), "documents")

        # Chunks of one hash with unlike bytes: about none, as 64 bits tell apart all but few of 10**9 chunks.
        touched = found.where("chunks IS NOT NULL").select("chunks", split.alias("lines"))
        bodies = touched.select("lines", F.explode("chunks").alias("c"))
        bodies = bodies.select("c.hash", F.array_join(F.slice("lines", F.col("c.start") + 1, F.col("c.n")), "\n").alias("bytes"))
        more = bodies.groupBy("hash").agg(F.min("bytes").alias("low"), F.max("bytes").alias("high")).where("low < high").select("hash")
        more = written(more, "unlike")
        if more.isEmpty():
            break
        unlike = more if unlike is None else unlike.unionAll(more)

    going = F.transform(F.filter("chunks", lambda c: c["goes"]), lambda c: F.sequence(c["start"], c["start"] + c["n"] - 1))
    gone = F.when(F.col("chunks").isNotNull(), F.array_distinct(F.flatten(going)))
    found = found.select("row", gone.alias("gone"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
    left = F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    changed = F.when(F.size("gone") > 0, left).otherwise(text)
    columns = [changed.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in documents.columns]
    lost, total = F.when(F.col("gone").isNotNull(), F.size("gone")).otherwise(0), F.when(text.isNotNull(), F.size(split)).otherwise(0)
    return found.select(*columns, total.cast("long").alias("n_lines"), lost.cast("long").alias("n_removed_lines"))
