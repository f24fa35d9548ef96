"""Model input texts built from a text and its annotation context."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from annospark.functions import lexicons as lex

SEPARATOR = " [SEP] "


def _check(language: str) -> None:
    if language not in lex.POLARIZATION_PREFIX:
        raise ValueError(f"Unsupported language: {language}")


def _shown(value: Column, missing: str = "None") -> Column:
    return F.coalesce(value.cast("string"), F.lit(missing))


def polarization(value: Column, language: str = "id") -> Column:
    _check(language)
    return F.concat(F.lit(lex.POLARIZATION_PREFIX[language]), _shown(value))


def polarized_prompt(text: Column, value: Column, language: str = "id") -> Column:
    return F.concat(polarization(value, language), F.lit(SEPARATOR), _shown(text, "nan"))


def demographic_prompt(
    text: Column,
    attributes: Sequence[str],
    language: str = "id",
    columns: Mapping[str, str] | None = None,
) -> Column:
    """Header, one ``name: value`` line per attribute, and the text.

    ``columns`` maps an attribute to the column that holds it when the names
    differ. Without attributes the prompt is a fixed sentence and no text.
    """
    _check(language)
    if not attributes:
        return F.lit(lex.DEMOGRAPHIC_ABSENT[language])
    lines = [F.lit(lex.DEMOGRAPHIC_HEADER[language])]
    for attribute in attributes:
        source = (columns or {}).get(attribute, attribute)
        name = lex.DEMOGRAPHIC_NAMES[language][attribute]
        lines.append(F.concat(F.lit(f"{name}: "), _shown(F.col(f"`{source}`"))))
    head = F.regexp_replace(F.concat_ws("\n", *lines), r"^\n+|\n+\z", "")
    return F.concat(head, F.lit(SEPARATOR), _shown(text, "nan"))


def combined_prompt(
    text: Column,
    value: Column,
    attributes: Sequence[str],
    language: str = "id",
    columns: Mapping[str, str] | None = None,
) -> Column:
    """Polarization line followed by the demographic prompt."""
    _check(language)
    if not attributes:
        return F.lit(lex.COMBINED_ABSENT[language])
    return F.concat(
        polarization(value, language), F.lit("\n"), demographic_prompt(text, attributes, language, columns)
    )
