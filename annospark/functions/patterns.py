"""Character classes, patterns and row-local text measures.

Python, Java and RE2 disagree on ``\\w``, ``\\s``, ``\\b``, ``.`` and ``$``, so
every pattern here is written with explicit Unicode classes:

* ``W``  letters, numbers and underscore, what Python's ``\\w`` matches;
* ``WS`` separators and control blanks, what Python's ``\\s`` matches;
* ``\\z`` for the end of the text, and look-arounds over ``W`` for ``\\b``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

W = r"\p{L}\p{N}_"
WS = r"\p{Z}\t-\r\x{1c}-\x{1f}\x{85}"

URL = rf"https?://[^{WS}]+|www\.[^{WS}]+"
URL_LOOSE = rf"http[^{WS}]+|www[^{WS}]+"
MENTION = rf"@[{W}]+"
HASHTAG = rf"#[{W}]+"
DIGIT = r"\p{Nd}"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"
REPEATED_PUNCTUATION = r"([!?.,])\1{2,}"
ELONGATION = r"([^\n])\1{2,}"
ALLCAPS = rf"(?<![{W}])[A-Z]{{4,}}(?![{W}])"
NEWLINE = r"\n|\r"
NON_ALPHANUMERIC = rf"[^{W}{WS}]"

#: Digital and emotional elements of a text, in report order.
ELEMENTS = {
    "url": URL,
    "mention": MENTION,
    "hashtag": HASHTAG,
    "digit": DIGIT,
    "emoji": EMOJI,
    "repeated_punctuation": REPEATED_PUNCTUATION,
    "allcaps": ALLCAPS,
    "newline": NEWLINE,
    "non_alphanumeric": NON_ALPHANUMERIC,
}


def filled(text: Column, null_as: str = "") -> Column:
    """Text with nulls replaced, so that lengths and matches are never null."""
    return F.coalesce(text, F.lit(null_as))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{WS}]+|[{WS}]+\z", "")


def collapse_spaces(text: Column) -> Column:
    """Every run of whitespace becomes one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(text, rf"[{WS}]+", " "))


def words(text: Column) -> Column:
    """Maximal runs of word characters."""
    return F.regexp_extract_all(text, F.lit(f"[{W}]+"), F.lit(0))


def words_with_apostrophes(text: Column) -> Column:
    """Runs of word characters and apostrophes that begin and end in a word character."""
    return F.regexp_extract_all(text, F.lit(f"[{W}]+(?:'+[{W}]+)*"), F.lit(0))


def space_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"[^{WS}]+"), F.lit(0))


def char_count(text: Column) -> Column:
    return F.length(text)


def space_word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{WS}]+"))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{W}]+"))


def sentence_count(text: Column) -> Column:
    """Non-blank stretches between runs of ``.``, ``!`` and ``?``."""
    return F.regexp_count(text, F.lit(rf"[^.!?]*[^.!?{WS}][^.!?]*"))


def has(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


def element_flags(text: Column) -> dict[str, Column]:
    return {name: has(text, pattern) for name, pattern in ELEMENTS.items()}


def is_all_upper(token: Column) -> Column:
    """At least one upper-case letter and no lower-case or title-case letter."""
    return token.rlike(r"\p{IsUppercase}") & ~token.rlike(r"[\p{IsLowercase}\p{Lt}]")


def validity_flags(text: Column) -> dict[str, Column]:
    """Why a text is unusable; the flags overlap and ``invalid`` is their union."""
    body = filled(text)
    flags = {
        "null": text.isNull(),
        "empty": body == "",
        "whitespace_only": body.rlike(rf"^[{WS}]+\z"),
        "symbol_only": body.rlike(rf"^[^{W}{WS}]+\z"),
        "null_literal": F.lower(strip(body)).isin("none", "null", "nan"),
    }
    union = flags["null"]
    for name in ("empty", "whitespace_only", "symbol_only", "null_literal"):
        union = union | flags[name]
    return {**flags, "invalid": union}
