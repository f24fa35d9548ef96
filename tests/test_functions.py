"""Row-local functions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from annospark.functions import cleaning as clean
from annospark.functions import patterns as p
from annospark.functions import prompts
from annospark.functions import votes as v


def one(spark, value, fn, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "raw, votes",
    [
        ("['1', '0']", [1, 0]),
        ("[1, 0]", [1, 0]),
        ('["1", "0"]', [1, 0]),
        ("[' 1 ']", [1]),
        ("['1', '0',]", [1, 0]),
        ("('1', '0')", [1, 0]),
        ("[1.7]", [1]),
        ("[]", []),
        ("['a','1']", []),
        ("['1','0'", []),
        ("['1'] x", []),
        ("['1' '0']", []),
        ("['1.5']", []),
        ("nan", []),
        ("", []),
        (None, []),
    ],
)
def test_parse_votes(spark, raw, votes):
    assert one(spark, raw, v.parse_votes) == votes


@pytest.mark.parametrize("raw, ids", [("['7', '15']", ["7", "15"]), ("[7, 15]", ["7", "15"]), ("[]", []), ("7", []), (None, [])])
def test_parse_ids(spark, raw, ids):
    assert one(spark, raw, v.parse_ids) == ids


@pytest.mark.parametrize(
    "raw, label", [("['1', '1']", 1.0), ("['0', '0']", 0.0), ("['1', '1', '0']", 1.0), ("['1', '0']", 0.5), ("[]", None)]
)
def test_majority(spark, raw, label):
    assert one(spark, raw, lambda c: v.majority(v.parse_votes(c))) == label


@pytest.mark.parametrize(
    "raw, group",
    [
        ("['1']", "Tanpa Disagreement"),
        ("['1', '1']", "Tanpa Disagreement"),
        ("['1', '0']", "Disagreement (50:50)"),
        ("['1', '1', '0']", "Disagreement (Tidak 50:50)"),
        ("bad", "Unknown"),
        ("[]", "Unknown"),
    ],
)
def test_agreement(spark, raw, group):
    assert one(spark, raw, lambda c: v.agreement_group(v.parse_votes(c))) == group


@pytest.mark.parametrize(
    "raw, method, value",
    [
        ("['1', '0']", "agg", 0.5),
        ("['1', '0']", "bin", 0),
        ("['1', '0']", "bin-ceil", 1),
        ("['1', '0']", "any", 1),
        ("['0']", "any", 0),
        ("['0']", "agg", 0.0),
        (None, "agg", 0.0),
    ],
)
def test_polarized(spark, raw, method, value):
    assert one(spark, raw, lambda c: v.polarized_value(v.parse_votes(c), method)) == value


def test_polarized_rejects_unknown_method(spark):
    with pytest.raises(ValueError):
        v.polarized_value(F.col("x"), "mode")


@pytest.mark.parametrize(
    "fn, text, expected",
    [
        (clean.duplicate_key, "Cek https://a.b @x  Halo!!", "cek URL USER halo"),
        (clean.duplicate_key, "a - b", "a  b"),
        (clean.duplicate_key, "😡!!", ""),
        (clean.duplicate_key, None, ""),
        (clean.duplicate_key, "a  b\x1cc", "a b c"),
        (clean.mask_links, "#kata @a www.x.y", "kata <USER> <URL>"),
        (clean.mask_links, "satu\r\n\ndua", "satu dua"),
        (clean.cap_punctuation, "a!!!! b?? c,,,d", "a!! b?? c,,d"),
        (clean.normalise_slang, "YG udah yg, gak", "yang sudah yg, gak"),
        (clean.normalise_slang, "yg  yg ", "yang  yang "),
        (clean.preprocess, "Lihat https://t.co/x @budi #Topik YG!!!!", "Lihat <URL> <USER> Topik YG!!"),
        (lambda c: clean.preprocess(c, lowercase=True), "Cek https://t.co/x YG", "cek <url> yang"),
        (clean.light_clean, "Halo  @Budi www.a.b", "halo USER URL"),
        (clean.minimal_clean, "GILAAA!!! @a", "GILAA!! [USER]"),
        (clean.minimal_clean, "1000", "100"),
        (clean.minimal_clean, None, ""),
        (clean.heavy_clean, "Yang KEREN, 123 banget 😡!", "keren banget"),
        (clean.strip_prompt, "x [SEP] y [SEP] \n isi teks \n", "isi teks"),
        (clean.strip_prompt, "tanpa penanda", "tanpa penanda"),
        (clean.preview, "a" * 400, "a" * 300),
        (lambda c: clean.describe_emoji(c, {"😡": ":marah:"}), "x😡😂y", "x:marah:😂y"),
        (clean.describe_emoji, "x😡", "x😡"),
    ],
)
def test_cleaning(spark, fn, text, expected):
    assert one(spark, text, fn) == expected


@pytest.mark.parametrize(
    "fn, text, expected",
    [
        (p.space_word_count, "", 0),
        (p.space_word_count, "  \n ", 0),
        (p.space_word_count, "a b c", 3),
        (p.word_count, "é_1 x-y 😡", 3),
        (p.sentence_count, "Satu. Dua!? Tiga", 3),
        (p.sentence_count, "... !", 0),
        (p.char_count, "a😡", 2),
        (p.words_with_apostrophes, "'jum'at' it''s", ["jum'at", "it''s"]),
        (lambda c: p.has(c, p.ALLCAPS), "x GILA!", True),
        (lambda c: p.has(c, p.ALLCAPS), "éGILA", False),
        (lambda c: p.has(c, p.REPEATED_PUNCTUATION), "a!?!", False),
        (p.is_all_upper, "GILA", True),
        (p.is_all_upper, "123", False),
        (p.is_all_upper, "GILa", False),
    ],
)
def test_measures(spark, fn, text, expected):
    assert one(spark, text, fn) == expected


@pytest.mark.parametrize(
    "text, kinds",
    [
        (None, {"null", "empty", "invalid"}),
        ("", {"empty", "invalid"}),
        (" \n", {"whitespace_only", "invalid"}),
        ("?!", {"symbol_only", "invalid"}),
        ("?!\n", set()),
        (" NaN ", {"null_literal", "invalid"}),
        ("teks", set()),
    ],
)
def test_validity(spark, text, kinds):
    df = spark.createDataFrame([(text,)], "x string")
    row = df.select(*[c.alias(k) for k, c in p.validity_flags(F.col("x")).items()]).first().asDict()
    assert {k for k, hit in row.items() if hit} == kinds


def test_prompts(spark):
    df = spark.createDataFrame([("isi", "Sunda", None, 2 / 3)], "text string, ethnicity string, age_group string, v double")
    text = F.col("text")
    row = df.select(
        prompts.demographic_prompt(text, ["ethnicity", "age_group"], "id").alias("a"),
        prompts.demographic_prompt(text, [], "en").alias("b"),
        prompts.polarized_prompt(text, F.col("v"), "en").alias("c"),
        prompts.combined_prompt(text, F.col("v"), ["ethnicity"], "id").alias("d"),
        prompts.combined_prompt(text, F.col("v"), [], "id").alias("e"),
    ).first()
    assert row["a"] == "Informasi Demografis:\netnisitas: Sunda\ngenerasi: None [SEP] isi"
    assert row["b"] == "Demographic Information: Not available"
    assert row["c"] == "Average polarization value (range of 0 to 1): 0.6666666666666666 [SEP] isi"
    assert row["d"] == (
        "Nilai polarisasi rata-rata (rentang 0 hingga 1): 0.6666666666666666\nInformasi Demografis:\netnisitas: Sunda [SEP] isi"
    )
    assert row["e"] == "Informasi Demografis dan Toksisitas: Tidak tersedia"
    with pytest.raises(ValueError):
        prompts.demographic_prompt(text, [], "fr")
