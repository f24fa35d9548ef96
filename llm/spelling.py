"""Grouping of spelling variants: words that differ by one inserted, deleted or replaced code point.

1. Dictionary. Grams of 2 to 6 code points are counted over all words. A gram is frequent beyond a share of all places, so
   at most ``FREQUENT`` grams of each length are, however many words there are; only these are sent to tasks.
2. Decomposition. At every place of a word starts one gram: two code points, lengthened while the gram is frequent, up to the
   limit of its length class. What a gram is depends on its own letters alone, and on the word's end if it is cut there.
3. Bound. One edit affects only grams that cover its place, or those cut by the end. The most that one place has is the
   word's bound; every other gram is found in the other word, too, so both words have a common gram among their bound + 1
   rarest (all places of each such gram are taken). On one side of a common gram nothing is edited: the lists are those of
   the gram with all that is left of it, and of the gram with all that is right of it.
4. Words that meet in a list, of equal length or one longer than the other, are verified by their edit distance.

Classes are the shorter length m of a pair. A class below ``HALVES`` has too few grams for the bound, and words of a class
above ``LONG`` would be in very many lists; there the lists are those of the words' first and last m // 2 code points, one of
which one edit leaves alone.

Defined results: null words and words without a count take no part; rows of one word add up; the empty word and other words
below ``min_length`` are left out; a word without a near one has n_near 0, no form, and is its own root; words are compared
by code points as they are, without regard to case or composed forms; other columns than ``word`` and ``n`` are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shared import written

SHORTEST, LONGEST = 2, 6
#: Most frequent grams of one length.
FREQUENT = 1 << 16
#: Classes below have no bound of use.
HALVES = 5
#: Classes above are verified in time that grows with the word, not with its square.
LONG = 64
#: Grams that a task counts before it passes them on.
AT_ONCE = 1 << 18
#: Rows of an output batch, about.
ROWS = 20_000


def longest_gram(m: int) -> int:
    """Longest gram of a length class: below m - 1, so that a word has more grams than one edit affects."""
    return min(LONGEST, max(3, m // 3 + 1))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(found: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["gram", "n"])

    found: Counter = Counter()
    for batch in batches:
        for w in batch.column(0).to_pylist():
            for q in range(SHORTEST, LONGEST + 1):
                found.update([w[p : p + q] for p in range(len(w) - q + 1)])
            if len(found) > AT_ONCE:
                yield rows(found)
                found = Counter()
    if found:
        yield rows(found)


def frequent_grams(words: DataFrame, most: int = FREQUENT) -> dict[str, int]:
    """Counts of the grams that have more than one ``most``-th of all places; at most ``most`` of each length."""
    places = words.agg(F.sum(F.length("word"))).first()[0] or 0
    grams = words.select("word").mapInArrow(_counted, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in grams.where(F.col("n") > places // most).collect()}


def decompose(word: str, frequent: dict[str, int], longest: int) -> list[tuple[int, int, bool]]:
    """(start, end, cut) of the gram at each place; cut: the word's end kept it from being longer."""
    out, size = [], len(word)
    for p in range(size - SHORTEST + 1):
        end = p + SHORTEST
        while word[p:end] in frequent and end - p < longest and end < size:
            end += 1
        out.append((p, end, end == size and end - p < longest and word[p:end] in frequent))
    return out


def affected(grams: list[tuple[int, int, bool]], size: int) -> int:
    """The most grams that one edit can affect."""
    steps = [0] * (size + 1)
    for start, end, _ in grams:
        steps[start] += 1
        steps[end] -= 1
    most, open_now = sum(cut for _, _, cut in grams), 0
    for step in steps:
        open_now += step
        most = max(most, open_now)
    return most


def lists_of(word: str, m: int, frequent: dict[str, int]) -> set[tuple[str, str]]:
    """Lists (side, letters) in which the word meets its near words of class m."""
    if not HALVES <= m <= LONG:
        return {("<", word[: m // 2]), (">", word[len(word) - m // 2 :])}
    grams = decompose(word, frequent, longest_gram(m))
    ranked = sorted((frequent.get(word[a:b], 0), word[a:b], a, b) for a, b, _ in grams)
    bound = affected(grams, len(word))
    last = ranked[bound][:2]
    return {key for n, gram, a, b in ranked if (n, gram) <= last for key in (("<", word[:b]), (">", word[a:]))}


def _listed(frequent):
    """(word, n) to a row for each list of the word, in its own class and, as the longer word, in the one below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, keys, longer, long, words, counts = frequent.value, [], [], [], [], []

        def rows() -> pa.RecordBatch:
            types = (pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.int64())
            columns = [pa.array(x, t) for x, t in zip((keys, longer, long, words, counts), types, strict=True)]
            for x in (keys, longer, long, words, counts):
                x.clear()
            return pa.record_batch(columns, names=["list", "longer", "long", "word", "n"])

        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for m in (len(word), len(word) - 1):
                    for side, letters in lists_of(word, m, grams) if m else ():
                        keys.append(xxhash.xxh64_intdigest(f"{m}{side}{letters}") - (1 << 63))
                        longer.append(m < len(word))
                        long.append(m > LONG)
                        words.append(word)
                        counts.append(n)
                if len(keys) >= ROWS:
                    yield rows()
        if keys:
            yield rows()

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether b, as long as a or one longer, is a with one edit."""
    low, high = 0, len(a)  # of the common beginning
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return a[low + 1 :] == b[low + 1 :] and a != b if len(a) == len(b) else a[low:] == b[low + 1 :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([one_edit(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)], pa.bool_()))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n), once for each pair of a written table of distinct words, the shorter or smaller word first."""
    spark = words.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_grams(words))
    rows = words.select("word", "n").mapInArrow(_listed(frequent), "list bigint, longer boolean, long boolean, word string, n bigint")
    rows = written(rows, "lists")

    def met(part: DataFrame) -> DataFrame:
        ordered = F.col("b.longer") | (F.col("a.word") < F.col("b.word"))
        pairs = part.where("NOT longer").alias("a").join(part.alias("b"), (F.col("a.list") == F.col("b.list")) & ordered)
        return pairs.select("a.word", "a.n", F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))

    near = met(rows.where("NOT long")).where(F.levenshtein("word", "near", 1) == 1)
    long = met(rows.where("long")).mapInArrow(_verified, "word string, n bigint, near string, near_n bigint")
    return near.unionAll(long).dropDuplicates(["word", "near"])


def _roots(forms: DataFrame, most: int, times: int) -> DataFrame:
    """(word, root) of words with a form: each join round doubles the forms that were followed.

    A form is ``times`` as frequent as its word, so there are few rounds whatever the table.
    """
    steps = 1
    while times**steps <= most:
        steps += 1
    out = forms.select("word", F.col("form").alias("root"))
    for _ in range(steps.bit_length()):
        far = out.select(F.col("word").alias("root"), F.col("root").alias("_far"))
        out = written(out.join(far, "root", "left").select("word", F.coalesce("_far", "root").alias("root")), "roots")
    return out


def spelling_variants(words: DataFrame, min_length: int = 7, min_count: int = 2, times: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``words`` (word, n) that are long and frequent enough.

    The form of a word is its near word of largest n, the first in code-point order of several, if it has ``times`` (2 at
    least) the word's n; the root is where following forms ends.
    """
    if times < 2:
        raise ValueError("times must be 2 at least")
    words = words.groupBy("word").agg(F.sum("n").alias("n"))
    words = written(words.where((F.length("word") >= max(min_length, 1)) & (F.col("n") >= min_count)), "words")
    pairs = written(near_pairs(words), "pairs")
    both = pairs.unionAll(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    enough: Column = -F.col("best.minus") >= times * F.col("n")
    found = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.minus")).alias("form_n"),
    )
    found = written(found, "forms")
    most = found.agg(F.max("form_n")).first()[0] or 0
    roots = _roots(found.where("form IS NOT NULL"), most, times) if most else found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    found = found.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
