"""Slang and emoji dictionaries of any size, held as tables.

Texts are dealt into blocks. The distinct pieces of a block meet the dictionary in one join, and the entries found come back to
the block, whose texts are rewritten by Arrow's kernels: pieces of texts are never shuffled one by one.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.functions import patterns as p

#: Texts in a block: enough for a frequent word to be asked for once for many texts.
BLOCK_ROWS = 2048


def space_pieces(text: Column) -> Column:
    """What single spaces separate; several spaces leave empty pieces, so joining by a space gives the text back."""
    return F.split(text, " ", -1)


def emoji_pieces(text: Column) -> Column:
    """Single emoji and the runs between them; joined by nothing they give the text back."""
    return F.regexp_extract_all(text, F.lit(rf"{p.EMOJI}|[^\x{{1F300}}-\x{{1FAFF}}\x{{2600}}-\x{{27BF}}]+"), F.lit(0))


def _rewriter(kept: list[str], into: str, separator: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The function that gives the rows of a block with ``into``, from its rows and the dictionary entries of its pieces.

    What runs in tasks is defined inside, so that executors don't need this module.
    """

    def of_repeated_ids(ids: list, pieces: list, keys: list, entries: dict) -> dict:
        """Texts by id where an id has several rows: the pieces of all of them, by place, a match as often as rows with it."""
        rows: dict = {}
        for i, id_ in enumerate(ids):
            rows.setdefault(id_, []).append(i)
        out = {}
        for id_, places in rows.items():
            having: dict = {}
            for word in (w for i in places for w in set(keys[i] or ()) if w in entries):
                having[word] = having.get(word, 0) + 1
            every = [(at, entries.get(k, piece)) for i in places for at, (piece, k) in enumerate(zip(pieces[i] or (), keys[i] or (), strict=True)) for _ in range(having.get(k, 1))]
            if having:
                out[id_] = separator.join(piece for _, piece in sorted(every, key=lambda x: (x[0], x[1].encode())))
        return out

    def rewrite(rows: pa.Table, found: pa.Table) -> pa.Table:
        pieces, keys, ids = (rows[c].combine_chunks() for c in ("_d_pieces", "_d_keys", "_d_row"))
        text = rows["_d_text"].combine_chunks()
        words, new = (found[c].combine_chunks() for c in ("_word", "_new"))
        sizes = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False)
        at = pc.index_in(keys.flatten(), value_set=words)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("int32"))
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, pc.coalesce(new.take(at), pieces.flatten())), separator)
        hit = np.bincount(np.repeat(np.arange(len(sizes)), sizes), pc.is_valid(at).to_numpy(zero_copy_only=False), len(sizes)) > 0
        text = pc.if_else(pa.array(hit & pc.is_valid(ids).to_numpy(zero_copy_only=False)), joined, text)
        counts = pc.value_counts(ids.drop_null())
        if pc.any(pc.greater(counts.field("counts"), 1)).as_py():
            twice = counts.field("values").filter(pc.greater(counts.field("counts"), 1))
            mask = pc.is_in(ids, value_set=twice)
            own = [x.filter(mask).to_pylist() for x in (ids, pieces, keys)]
            merged = of_repeated_ids(*own, dict(zip(words.to_pylist(), new.to_pylist(), strict=True)))
            text = pa.array([merged.get(i, t) if i is not None else t for i, t in zip(ids.to_pylist(), text.to_pylist(), strict=True)], pa.string())
        return rows.select(kept).append_column(into, text)

    return rewrite


def translated(
    df: DataFrame,
    row_id: str,
    text: str,
    dictionary: DataFrame,
    pieces: Callable[[Column], Column],
    separator: str,
    key: Callable[[Column], Column] = lambda piece: piece,
    word: str = "word",
    replacement: str = "replacement",
    into: str = "cleaned",
) -> DataFrame:
    """``df`` with ``into``: ``text`` whose pieces are replaced where ``key(piece)`` is a word of the dictionary.

    ``row_id`` is unique and not null. A word listed twice takes its smallest replacement; null words and null replacements
    are left out. Null texts stay null, texts without a match stay as they are. Texts are dealt by their id into blocks of about
    ``BLOCK_ROWS``; a word is looked up once for a block, so no word is in more rows than there are blocks. Rows are counted
    while the plan is built.
    """
    entries = dictionary.select(F.col(f"`{word}`").alias("_word"), F.col(f"`{replacement}`").alias("_new")).dropna()
    entries = entries.groupBy("_word").agg(F.min("_new").alias("_new"))
    blocks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / BLOCK_ROWS))
    kept = [c for c in df.columns if c != into]
    block = F.pmod(F.xxhash64(f"`{row_id}`"), F.lit(blocks)).alias("_d_block")
    dealt = df.select(*[F.col(f"`{c}`") for c in kept], block, F.col(f"`{row_id}`").alias("_d_row"), F.col(f"`{text}`").alias("_d_text")).repartition("_d_block")
    cut = dealt.withColumn("_d_pieces", pieces(F.col("_d_text")))
    wanted = cut.select("_d_block", F.explode(F.array_distinct(F.transform("_d_pieces", key))).alias("_word")).distinct()
    # Entries have no known bound; a file's size, by which Spark would broadcast them, says little about their rows.
    found = wanted.join(entries.hint("merge"), "_word").select(F.col("_d_block").alias("_f_block"), "_word", "_new")
    keyed = cut.withColumn("_d_keys", F.transform("_d_pieces", key))
    schema = T.StructType([df.schema[c] for c in kept]).add(into, "string")
    rewrite = _rewriter(kept, into, separator)
    return keyed.groupBy("_d_block").cogroup(found.groupBy("_f_block")).applyInArrow(lambda rows, words: rewrite(rows, words), schema)


def normalise_slang(df: DataFrame, row_id: str, text: str, slang: DataFrame, **names) -> DataFrame:
    """Single-space tokens found in a slang table, whatever their case, are replaced; see :func:`translated`."""
    return translated(df, row_id, text, slang, space_pieces, " ", F.lower, **names)


def describe_emoji(df: DataFrame, row_id: str, text: str, aliases: DataFrame, **names) -> DataFrame:
    """Emoji found in a table of aliases are replaced; see :func:`translated`."""
    return translated(df, row_id, text, aliases, emoji_pieces, "", **names)


def slang_found(counts: DataFrame, slang: DataFrame, word: str = "word", replacement: str = "replacement") -> DataFrame:
    """``(token, n, normal_form)``: the counted tokens that a slang table lists; a word listed twice takes its smallest form."""
    entries = slang.select(F.col(f"`{word}`").alias("token"), F.col(f"`{replacement}`").alias("_new")).dropna()
    return counts.select("token", "n").join(entries.groupBy("token").agg(F.min("_new").alias("normal_form")), "token")
