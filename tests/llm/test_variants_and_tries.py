"""Spelling variants, decontamination, prefix trie."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm import prefix_trie as trie
from llm import spelling
from llm.contamination import Automaton, decontaminate, find_contamination
from llm.queries import QUERIES
from llm.shared import ship
from llm.spelling import spelling_variants
from tests.llm import brute

SF = "/root/testdata/sf0.001"


# --- spelling variants ---------------------------------------------------------------------------------------------------
def edited(word: str, r: random.Random, letters: str) -> str:
    at = r.randrange(len(word) + 1)
    return r.choice([word[:at] + r.choice(letters) + word[at:], word[:at] + word[at + 1 :], word[:at] + r.choice(letters) + word[at + 1 :]])


def random_words(seed: int, letters: str, shortest: int) -> dict[str, int]:
    r = random.Random(seed)
    words: dict[str, int] = {}
    while len(words) < 260:
        w = "".join(r.choice(letters) for _ in range(r.randrange(shortest, 14)))
        for _ in range(r.randrange(6)):
            words[w] = r.choice([1, 2, 3, 25, 25, 400, 5000])
            w = edited(w, r, letters)
    return words


@pytest.mark.parametrize(("letters", "shortest", "frequent"), [("abc", 7, 1 << 16), ("ab", 1, 40), ("aé漢🙂", 1, 1 << 16), ("abcdefgh", 5, 100)])
def test_variants(spark, monkeypatch, letters, shortest, frequent):
    ship(spark)
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    words = random_words(len(letters), letters, shortest)
    df = spark.createDataFrame([*words.items(), (None, 9), ("xxxxxxxx", None), ("", 7)], "word string, n bigint").withColumn("form", F.lit("x"))
    got = spelling_variants(df.repartition(3), min_length=shortest, times=5).collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    assert len(found) == len(got) and found == brute.variants(words, shortest, 2, 5)


def test_bound_holds():
    """Every gram but those counted as affected is in the edited word, too."""
    r = random.Random(1)
    for letters in ("ab", "abcd"):
        for _ in range(400):
            w = "".join(r.choice(letters) for _ in range(r.randrange(5, 15)))
            v = edited(w, r, letters)
            frequent = {"".join(r.choice(letters) for _ in range(r.randrange(2, 6))): 1 for _ in range(12)}
            m = min(len(v), len(w))
            assert spelling.one_edit(*sorted((w, v), key=len)) == (v != w)
            if m < spelling.HALVES:
                continue
            longest = spelling.longest_gram(m)
            for a, b in ((w, v), (v, w)):
                grams, others = spelling.decompose(a, frequent, longest), spelling.decompose(b, frequent, longest)
                common = Counter(a[x:y] for x, y, _ in grams) & Counter(b[x:y] for x, y, _ in others)
                assert len(grams) > spelling.affected(grams, len(a)) >= len(grams) - sum(common.values())
            if v != w:
                assert spelling.lists_of(w, m, frequent) & spelling.lists_of(v, m, frequent)


def test_long_words_and_hot_prefix(spark):
    words = {"q" * 3000: 50, "q" * 2999: 2, "ab" * 50 + "c": 30, "ab" * 50: 3, "ab" * 49 + "ac": 2, **{"internationa" + a + b: 2 for a in "abcdefgh" for b in "abcdefgh"}, "internationaaa": 20}
    got = spelling_variants(spark.createDataFrame([*words.items()], "word string, n bigint")).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute.variants(words)


def test_roots_follow_forms(spark):
    words = {"abcdefg" + "x" * k: 2 * 10**k for k in range(9)}
    got = {r.word: r.root for r in spelling_variants(spark.createDataFrame([*words.items()], "word string, n bigint")).collect()}
    assert set(got.values()) == {"abcdefg" + "x" * 8}


def test_no_words(spark):
    assert spelling_variants(spark.createDataFrame([], "word string, n bigint")).count() == 0


def test_variants_query_against_brute_force(spark):
    import re

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words: Counter = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            words[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in QUERIES["op11_spelling_variants"](spark, SF).collect()}
    assert got == brute.variants(words)


# --- decontamination -----------------------------------------------------------------------------------------------------
def test_automaton_knows_every_sequence():
    r = random.Random(2)
    texts = [(k, [b"%d" % r.randrange(4) for _ in range(r.randrange(1, 40))]) for k in range(30)]
    own = Automaton(5)
    own.add(texts)
    code = own.vocabulary
    for _, ws in texts:
        for a in range(len(ws)):
            state = 0
            for w in ws[a:]:
                state = own._next[state][code[w]]
    states = len(own.length)
    assert states <= 2 * sum(len(w) for _, w in texts)
    for s in range(1, states):
        assert own.length[own.link[s]] < own.length[s]


def contaminated_rows():
    r = random.Random(7)

    def prose(n, size=30):
        return " ".join(f"w{r.randrange(size)}" for _ in range(n))

    items = [(k, prose(r.randrange(1, 60))) for k in range(40)]
    items += [(50, None), (51, ""), (52, " . ,"), (53, "w1 w2"), (54, "W1-w2"), (None, "lone words here"), (55, items[3][1]), (3, items[4][1]), (56, "é漢 ½x")]
    docs = [(k, prose(r.randrange(80), 45)) for k in range(150)]
    for k in range(60):
        text = items[r.randrange(40)][1].split()
        a = r.randrange(len(text))
        docs.append((200 + k, f"{prose(5, 90)}, {' '.join(text[a : a + r.randrange(5, 40)]).upper()}! {prose(4, 90)}"))
    docs += [(300, None), (301, ""), (302, "lone Words, HERE é漢 ½x"), (None, items[5][1]), (303, items[6][1]), (303, items[7][1]), (304, (prose(30, 90) + " ") * 900)]
    return docs, items


@pytest.mark.parametrize(("window", "shard_words"), [(10, 1 << 20), (4, 1 << 20), (10, 200), (3, 100), (1, 1 << 20)])
def test_contamination(spark, window, shard_words):
    ship(spark)
    docs, items = contaminated_rows()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    for name in ("n_words", "row", "items", "_row", "shard", "item"):
        df = df.withColumn(name, F.lit("x"))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("n", F.lit(1))
    got = find_contamination(df, benchmark, window=window, shard_words=shard_words)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()) == brute.contamination(docs, items, window)
    assert {"row", "_row", "shard", "item"} <= set(got.columns)


def test_long_items_are_cut_with_overlap(spark, monkeypatch):
    from llm import contamination

    monkeypatch.setattr(contamination, "STRETCH", 8)
    docs, items = contaminated_rows()
    got = find_contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), window=6, shard_words=300)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()) == brute.contamination(docs, items, 6)


def test_clean_texts_and_coverage(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, "Before it: ONE, two three-four five six seven eight nine ten. After"), (2, item), (3, "clean é text"), (4, None)]
    got = decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([("x", item)], "item_id string, text string"))
    found = {r.doc_id: r for r in got.collect()}
    assert found[1].clean_text == "Before it: . After" and found[1]["items"] == ["x"] and found[1].dropped
    assert found[2].clean_text == "" and found[2].dropped and found[3].clean_text == "clean é text" and found[4].clean_text is None
    assert [r.dropped for r in (found[3], found[4])] == [False, False]


def test_contamination_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [(r.n_words, r.n_hit, r["items"]) for r in find_contamination(docs, none).collect()] == [(2, 0, [])]
    assert find_contamination(docs.limit(0), none).count() == 0


# --- prefix trie ---------------------------------------------------------------------------------------------------------
def as_rows(convs: dict, r: random.Random) -> list[tuple]:
    rows = [(c, t, role, text) for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    r.shuffle(rows)
    return rows


def of_trie(spark, rows) -> Counter:
    ship(spark)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    df = df.withColumn("depth", F.lit("x")).withColumn("row", F.lit("x")).withColumn("part", F.lit("x"))
    return Counter(tuple(x) for x in trie.prefix_trie(*trie.whole(*trie.ordered_turns(df))).collect())


@pytest.mark.parametrize("chunk", [4, 1024])
def test_trie(spark, monkeypatch, chunk):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    r = random.Random(3)
    convs = {c * 3: [(r.choice(["user", "bot"]), r.choice(["", "a", "é漢"])) for _ in range(r.randrange(1, 9))] for c in range(150)}
    long = [("user", f"t{k}") for k in range(70)]
    convs |= {1000: long, 1001: long[:40], 1002: long[:40] + [("bot", "x")], 999: long[:69], 998: long}
    # Each conversation is one turn longer: a unary chain whose nodes all belong to different conversations.
    convs |= {2000 + k: [("snapshot", str(j)) for j in range(k)] for k in range(1, 40)}
    convs |= {5000 + k: long[:3] for k in range(60)}
    assert of_trie(spark, as_rows(convs, r)) == brute.trie(convs)


def test_trie_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "a", None), (1, 0, "a", None), (2, None, "", ""), (None, 1, "a", "b"), (-7, 3, "a", "b")]
    convs = {1: [("", ""), ("a", ""), ("a", "")], 2: [("", "")], -7: [("a", "b")]}
    assert of_trie(spark, rows) == brute.trie(convs)
    assert not of_trie(spark, rows[4:5])


def test_trie_query_against_brute_force(spark):
    own: dict[int, list] = {}
    for r in sorted(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        own.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    got = Counter(tuple(r) for r in QUERIES["op13_prefix_trie"](spark, "/root/testdata/sf0.01").collect())
    assert got == brute.trie(convs)


def test_trie_query_without_first_of_family(spark, tmp_path):
    """Turnless conversations, families whose first has fewer turns or is absent."""
    own = {c: [("u", f"{c % 5}{k}") for k in range(c % 7 + 1)] for c in (*range(1, 5), *range(10, 40), *range(56, 60))}
    rows = [(c, k, *t) for c, turns in own.items() for k, t in enumerate(turns)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    assert any(not t for t in convs.values())
    assert Counter(tuple(r) for r in QUERIES["op13_prefix_trie"](spark, str(tmp_path)).collect()) == brute.trie(convs)
