"""Packing, piece codec, WARC, vector search."""

import hashlib
import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from llm import warc
from llm.packing import Bins
from llm.piece_codec import codec, encode_texts
from llm.queries import packed, vocabulary
from llm.vector_search import drawn_at, nearest


def check_pieces(rows, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length > 0
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    for key, text in docs:
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted(by_doc[key], key=lambda r: r.start)
        assert own[0].start == 0 and {r.doc_tokens for r in own} == {len(want)}
        assert b"".join(r.ids for r in own) == np.array(want, dtype="<u4").tobytes()
    return sequences


def test_packing(spark, docs, odd_docs):
    unique = list({key: (key, text) for key, text in odd_docs if key not in (None, 18, 19)}.values())
    df = docs.where("doc_id NOT IN (18, 19)")
    rows = packed(df.coalesce(1)).collect()
    sequences = check_pieces(rows, unique)
    sizes = [sum(n for _, n in s) for s in sequences.values()]
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in sizes)
    assert padding < 1024 + 0.01 * sum(sizes)


def test_packing_repeated_rows_and_empty(spark, docs, empty):
    rows = packed(docs).collect()
    assert sum(r.length for r in rows if r.doc_id == 18) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 18)
    assert packed(empty).count() == 0
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


@pytest.mark.parametrize("lengths", [[1], [1024], [1025], [63] * 40, [700, 300, 24], [1] * 3000, [2048 + 17] * 9])
def test_bins(lengths):
    bins = Bins(7 << 40, 1024, 64)
    for k, n in enumerate(lengths):
        bins.add(k, np.arange(n, dtype="<u4"))
    bins.finish()
    total, fill = defaultdict(int), defaultdict(int)
    for key, _, n, ids, doc, sequence, offset in bins.rows:
        assert offset == fill[sequence] and len(ids) == 4 * n and doc == lengths[key]
        total[key] += n
        fill[sequence] += n
    assert [total[k] for k in range(len(lengths))] == lengths and max(fill.values()) <= 1024
    assert sum(n < 1024 - 64 for n in fill.values()) <= 1


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def test_codec_like_the_library(sf_dir):
    import duckdb

    theirs, own = library(), codec(P.path("piece_bpe_32k.model"))
    r = random.Random(5)
    letters = list(" ▁ab\n\t.,éß漢字🙂\u0000 #<s>0123ABthe ing tion")
    pieces = list(own.ids)
    texts = [t for (t,) in duckdb.connect().execute(f"SELECT text FROM '{sf_dir}/documents.parquet'").fetchall()]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(r.choice(pieces) for _ in range(r.randint(1, 6))).replace("▁", " ") for _ in range(1500)]
    texts += ["", " ", "a" * 3000, " " * 2000, "<s> </s> <unk> <0x0A>", "ab" * 2000]
    for text in texts:
        ids = theirs.encode(text, add_bos=True, add_eos=True)
        mine = own.encode(text)
        assert np.frombuffer(mine, dtype="<u4").tolist() == ids
        assert own.decode(mine) == theirs.decode(ids)
    for ids in ([29871, 10], [231, 260, 5, 6], [1, 2], [0, 5], [1, 29871, 3, 4, 2], [200, 201, 202, 300]):
        assert own.decode(np.array(ids, dtype="<u4").tobytes()) == theirs.decode(ids)


def test_encode_table(docs, odd_docs, empty):
    theirs = library()
    got = encode_texts(docs, vocabulary("piece_bpe_32k.model")).collect()
    want = sorted(((k is not None, k), np.array(theirs.encode(t or "", add_bos=True, add_eos=True), dtype="<u4").tobytes()) for k, t in odd_docs if k is not None)
    assert sorted(((r.doc_id is not None, r.doc_id), bytes(r.ids)) for r in got if r.doc_id is not None) == want
    assert len(got) == len(odd_docs) and encode_texts(empty, vocabulary("piece_bpe_32k.model")).count() == 0


def test_warc(spark, tmp_path):
    long, big = "x" * 100, "".join(chr(97 + i % 26) * 3 for i in range(400_000))
    pages = [(1, "http://a", "short"), (2, None, "short"), (5, "http://b\r\nInjected: 1", long), (4, "u", long), (6, "u", None), (7, "u", ""), (8, "u", big), (9, "u", "é\r\n\r\nWARC/1.1\r\n漢" * 20)]
    pages += [(20 + k, f"http://x/{k}", "hot page " * 30) for k in range(40)] + [(None, "u", long)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3).withColumn("first", F.lit(1)).withColumn("digest", F.lit(2))
    got = {r.page_id: r for r in warc.archived(df).collect()}
    assert len(got) == len(pages) - 1
    for key, _, html in pages[:-1]:
        payload = (html or "").encode()
        first = min(k for k, _, h in pages[:-1] if h == html) if len(payload) >= 100 else key
        r = got[key]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.record_type, r.refers_to) == (("response", None) if first == key else ("revisit", first))
        assert r.payload is None if first != key else bytes(r.payload) == payload
    assert warc.archived(df.limit(0)).count() == 0


def test_warc_members_are_gzip(spark, tmp_path):
    import gzip

    df = spark.createDataFrame([(k, "u", f"page {k} " * 50) for k in range(30)], "page_id bigint, url string, html string").coalesce(1)
    warc.monolithic(df, f"{tmp_path}/whole", "page_id", "url", "html", archive_bytes=4000)
    whole = sorted(tmp_path.glob("whole/kind=whole/archive=*/part-*"))
    assert len(whole) > 2
    for path in whole:  # one member each
        member = zlib.decompressobj(wbits=31)
        member.decompress(path.read_bytes())
        assert member.eof and not member.unused_data
    warc.normalise(spark, f"{tmp_path}/whole", f"{tmp_path}/normal")
    files = {p.parent.name: p.read_bytes() for p in tmp_path.glob("normal/kind=archives/archive=*/part-*")}
    indexes = {p.parent.name: p.read_bytes().rstrip(b"\0").decode() for p in tmp_path.glob("normal/kind=index/archive=*/part-*")}
    entries = [(name, json.loads(line)) for name, text in indexes.items() for line in text.split("\n")]
    assert sum(e["length"] for _, e in entries) == sum(map(len, files.values())) and len(entries) == 30
    for name, e in entries:
        member = gzip.decompress(files[name][e["offset"] : e["offset"] + e["length"]])
        assert f"X-Page-Id: {e['page_id']}\r\n".encode() in member


def brute_nearest(rows, k=10):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8]
    out = {}
    for i, v in good:
        if i % 100 == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in good if j != i)[:k]
            out[i] = [(r + 1, j, s) for r, (s, j) in enumerate(near)]
    return out


def test_vectors(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.standard_normal(8).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[100][1]) for i in range(200)]  # a vector that a third of all rows repeat
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] + [1.0] * 7), (2003, [None] + [1.0] * 7), (2004, [float("inf")] * 8), (2005, [1.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("list", F.lit(1)).withColumn("part", F.lit(1))
    rows = [(x.vec_id, x.embedding) for x in df.collect()]
    got = defaultdict(list)
    for x in nearest(df, df.where("vec_id % 100 = 0"), part=64, queries_at_once=2).collect():
        got[x.query_id].append((x.rank, x.vec_id, x.score))
    want = brute_nearest(rows)
    assert {q: [(a, b) for a, b, _ in sorted(v)] for q, v in got.items()} == {q: [(a, b) for a, b, _ in v] for q, v in want.items()}
    assert all(abs(s - t) < 1e-12 for q in want for (_, _, s), (_, _, t) in zip(sorted(got[q]), want[q], strict=True))
    assert nearest(df.limit(0), df).count() == 0
    few = df.where("vec_id < 3")
    assert sorted((x.query_id, x.rank) for x in nearest(few, few.where("vec_id = 0")).collect()) == [(0, 1), (0, 2)]


def test_vectors_beyond_the_sample(spark):
    r = np.random.default_rng(4)
    centres = r.standard_normal((20, 8)) * 5
    rows = [(i, (centres[i % 20] + r.standard_normal(8)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = defaultdict(set)
    for x in nearest(df, df.where("vec_id % 100 = 0"), sample=500).collect():
        got[x.query_id].add(x.vec_id)
    want = brute_nearest(rows)
    assert all(len(got[q]) == 10 for q in want)
    assert sum(len(got[q] & {j for _, j, _ in v}) for q, v in want.items()) >= 0.9 * sum(map(len, want.values()))


def test_vectors_of_repeated_rows(spark):
    r = np.random.default_rng(5)
    rows = [(i, r.standard_normal(8).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows + rows, "vec_id bigint, embedding array<double>")
    want = {q: [(a, b) for a, b, _ in v] for q, v in brute_nearest(rows).items()}
    got = defaultdict(list)
    for x in nearest(df, df.where("vec_id % 100 = 0"), part=64).collect():
        got[x.query_id].append((x.rank, x.vec_id))
    assert {q: sorted(v) for q, v in got.items()} == want
    # Vectors of one id at equal distances are two candidates, each once.
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [4.0, 0.0])], "vec_id bigint, embedding array<double>")
    assert sorted((x.rank, x.vec_id, x.score) for x in nearest(few, few.where("vec_id = 0")).collect()) == [(1, 1, 1.0), (2, 1, 1.0), (3, 2, 3.0)]


def test_vectors_recall_of_the_lists(spark):
    """Only the lists and the early end of the distances can find neighbours outside the sample."""
    r = np.random.default_rng(6)
    x = r.standard_normal((40, 64))[np.arange(4000) % 40] + r.standard_normal((4000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    drawn = {row.vec_id for row in df.where(drawn_at("vec_id", 4000, 400)).collect()}
    assert 300 < len(drawn) < 500
    found = {(row.query_id, row.vec_id) for row in nearest(df, df.where("vec_id % 100 = 0"), sample=400).collect()}
    outside = []
    for q in range(0, 4000, 100):
        squares = ((x - x[q]) ** 2).sum(1)
        squares[q] = np.inf
        outside += [(q, int(j)) for j in np.argsort(squares)[:10] if int(j) not in drawn]
    assert len(outside) > 300 and sum(pair in found for pair in outside) >= 0.94 * len(outside)
