"""Text cleaning as column expressions; the order of steps is part of the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from annospark.functions import lexicons as lex
from annospark.functions import patterns as p


def literal_map(entries: Mapping[str, str]) -> Column:
    """Dictionary literal for lookups inside an expression."""
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def duplicate_key(text: Column, null_as: str = "") -> Column:
    """Key under which near copies of a text meet."""
    t = F.lower(p.filled(text, null_as))
    t = F.regexp_replace(t, p.URL, " URL ")
    t = F.regexp_replace(t, p.MENTION, " USER ")
    t = F.regexp_replace(t, f"[{p.WS}]+", " ")
    t = F.regexp_replace(t, p.NON_ALPHANUMERIC, "")
    return F.trim(t)


def mask_links(text: Column) -> Column:
    """Links and mentions become markers, ``#word`` becomes ``word``, blanks collapse."""
    t = F.regexp_replace(text, p.URL, " <URL> ")
    t = F.regexp_replace(t, p.MENTION, " <USER> ")
    t = F.regexp_replace(t, f"#([{p.W}]+)", "$1")
    return p.collapse_spaces(t)


def cap_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, p.REPEATED_PUNCTUATION, "$1$1")


def describe_emoji(text: Column, aliases: Mapping[str, str] | None = None) -> Column:
    """Replace each emoji by its alias; without aliases the text is unchanged."""
    if not aliases:
        return text
    pieces = F.regexp_extract_all(text, F.lit(rf"{p.EMOJI}|[^\x{{1F300}}-\x{{1FAFF}}\x{{2600}}-\x{{27BF}}]+"), F.lit(0))
    names = literal_map(aliases)
    return F.array_join(F.transform(pieces, lambda x: F.coalesce(F.try_element_at(names, x), x)), "")


def normalise_slang(text: Column, slang: Mapping[str, str] = lex.SLANG_NORMAL) -> Column:
    """Replace whole single-space tokens found in the dictionary, whatever their case."""
    names = literal_map(slang)
    tokens = F.split(text, " ", -1)
    return F.array_join(
        F.transform(tokens, lambda x: F.coalesce(F.try_element_at(names, F.lower(x)), x)), " "
    )


def preprocess(
    text: Column,
    lowercase: bool = False,
    slang: Mapping[str, str] | None = lex.SLANG_NORMAL,
    emoji: Mapping[str, str] | None = None,
) -> Column:
    """Full cleaning: links, punctuation, emoji, slang, case, blanks."""
    t = cap_punctuation(mask_links(p.filled(text, "nan")))
    t = describe_emoji(t, emoji)
    if slang:
        t = normalise_slang(t, slang)
    if lowercase:
        t = F.lower(t)
    return p.collapse_spaces(t)


def light_clean(text: Column) -> Column:
    """Lower case with ``URL`` and ``USER`` markers and single spaces."""
    t = F.lower(p.filled(text))
    t = F.regexp_replace(t, p.URL, " URL ")
    t = F.regexp_replace(t, p.MENTION, " USER ")
    return p.collapse_spaces(t)


def without_links(text: Column, replacement: str = " ", url: str = p.URL) -> Column:
    """Lower case with links and mentions replaced, before words are counted."""
    t = F.regexp_replace(F.lower(p.filled(text)), url, replacement)
    return F.regexp_replace(t, p.MENTION, replacement)


def minimal_clean(text: Column) -> Column:
    """Markers for links and mentions, any character at most twice in a row."""
    t = F.regexp_replace(p.filled(text), p.URL, "[URL]")
    t = F.regexp_replace(t, p.MENTION, "[USER]")
    t = F.regexp_replace(t, p.ELONGATION, "$1$1")
    return p.collapse_spaces(t)


def heavy_clean(text: Column, stop_words: Sequence[str] = lex.STOP_WORDS) -> Column:
    """Lower-case words only: no punctuation, digits, emoji or stop words."""
    t = F.regexp_replace(F.lower(p.filled(text)), f"[^{p.W}{p.WS}]|{p.DIGIT}", "")
    return F.array_join(F.filter(p.space_tokens(t), lambda x: ~x.isin(*stop_words)), " ")


def strip_prompt(text: Column) -> Column:
    """The raw text behind the last ``[SEP]``."""
    return p.strip(F.element_at(F.split(text, r"\[SEP\]", -1), -1))


def preview(text: Column, n: int = 300) -> Column:
    return F.substring(text, 1, n)
