"""DuckDB SQL fragments the checking queries share.

They restate the semantics in RE2 and list functions, independently of the
Spark expressions: RE2 has no look-around and no backreference, so those
patterns are spelled out.
"""

from __future__ import annotations

from annospark.functions.lexicons import LABELS
from checks.fixtures import annotated_cte, annotators_cte, predictions_cte

W = r"\p{L}\p{N}_"
S = r"\p{Z}\t-\r\x{1c}-\x{1f}\x{85}"
URL = rf"https?://[^{S}]+|www\.[^{S}]+"
MENTION = rf"@[{W}]+"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"
REPEATED = r"!{3,}|\?{3,}|\.{3,}|,{3,}"
ALLCAPS = rf"(^|[^{W}])[A-Z]{{4,}}($|[^{W}])"

ELEMENTS = {
    "url": URL,
    "mention": MENTION,
    "hashtag": rf"#[{W}]+",
    "digit": r"\p{Nd}",
    "emoji": EMOJI,
    "repeated_punctuation": REPEATED,
    "allcaps": ALLCAPS,
    "newline": r"\n|\r",
    "non_alphanumeric": rf"[^{W}{S}]",
}


def sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def collapse(x: str) -> str:
    return f"trim({sub(x, f'[{S}]+', ' ')}, ' ')"


def filled(x: str) -> str:
    return f"coalesce({x}, '')"


def dup_key(x: str) -> str:
    t = sub(f"lower({filled(x)})", URL, " URL ")
    t = sub(t, MENTION, " USER ")
    t = sub(t, f"[{S}]+", " ")
    return f"trim({sub(t, f'[^{W}{S}]', '')}, ' ')"


def light(x: str) -> str:
    t = sub(f"lower({filled(x)})", URL, " URL ")
    return collapse(sub(t, MENTION, " USER "))


def links_blank(x: str, to: str = " ") -> str:
    return sub(sub(f"lower({filled(x)})", URL, to), MENTION, to)


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '[{W}]+')"


def apostrophe_words(x: str) -> str:
    return f"regexp_extract_all({x}, '[{W}]+(?:''+[{W}]+)*')"


def space_words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{S}]+')"


def n_words(x: str) -> str:
    return f"len({words(filled(x))})"


def mask_links(x: str) -> str:
    t = sub(x, URL, " <URL> ")
    t = sub(t, MENTION, " <USER> ")
    return collapse(sub(t, f"#([{W}]+)", r"\1"))


def cap_punct(x: str) -> str:
    for ch in ("!", r"\?", r"\.", ","):
        x = sub(x, ch + "{3,}", ch.replace("\\", "") * 2)
    return x


def case_map(x: str, entries: dict[str, str], default: str = "NULL") -> str:
    body = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in entries.items())
    return f"CASE {x} {body} ELSE {default} END"


def slang(x: str, entries: dict[str, str]) -> str:
    inner = case_map("lower(w)", entries, "w")
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: {inner}), ' ')"


def clean_cased(x: str, entries: dict[str, str]) -> str:
    return collapse(slang(cap_punct(mask_links(f"coalesce({x}, 'nan')")), entries))


def clean_lower(x: str, entries: dict[str, str]) -> str:
    return collapse(f"lower({slang(cap_punct(mask_links(f'coalesce({x}, {chr(39)}nan{chr(39)})')), entries)})")


def quoted(items) -> str:
    return ", ".join(f"'{i}'" for i in items)


def votes(c: str) -> str:
    return f"list_transform(string_split(regexp_replace({c}, '[^0-9,]', '', 'g'), ','), lambda v: CAST(v AS BIGINT))"


def ids(c: str) -> str:
    return f"string_split(regexp_replace({c}, '[^0-9a-z,]', '', 'g'), ',')"


def majority(total: str, n: str) -> str:
    return f"CASE WHEN {n} = 0 THEN NULL WHEN {total} * 2 > {n} THEN 1.0::DOUBLE WHEN {total} * 2 < {n} THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END"


def r6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


_SUMS = ", ".join(f"list_sum({votes(c)}) AS {c}_s, len({votes(c)}) AS {c}_n" for c in LABELS)
_LABELS = ", ".join(f"{majority(f'{c}_s', f'{c}_n')} AS {c}_label" for c in LABELS)

#: ``labelled``: annotated texts with sums, sizes and majority labels.
LABELLED = f"""WITH {annotated_cte()},
voted AS (SELECT *, {_SUMS}, len({ids('annotators_id')}) AS num_annotators FROM annotated),
labelled AS (SELECT *, {_LABELS} FROM voted)"""

ANNOTATED = f"WITH {annotated_cte()}"
ANNOTATORS = f"WITH {annotators_cte()}"
PREDICTIONS = f"WITH {predictions_cte()}"

AGREEMENT = (
    "CASE WHEN toxicity_n = 1 OR toxicity_s = 0 OR toxicity_s = toxicity_n THEN 'Tanpa Disagreement' "
    "WHEN toxicity_s * 2 = toxicity_n THEN 'Disagreement (50:50)' ELSE 'Disagreement (Tidak 50:50)' END"
)
INVALID_PARTS = {
    "null": "text IS NULL",
    "empty": "coalesce(text, '') = ''",
    "whitespace_only": f"regexp_full_match(coalesce(text, ''), '[{S}]+')",
    "symbol_only": f"regexp_full_match(coalesce(text, ''), '[^{W}{S}]+')",
    "null_literal": f"lower(regexp_replace(coalesce(text, ''), '^[{S}]+|[{S}]+$', '', 'g')) IN ('none', 'null', 'nan')",
}
VALID = "NOT (" + " OR ".join(INVALID_PARTS[k] for k in ("null", "empty", "whitespace_only", "symbol_only")) + ")"
INVALID = "(" + " OR ".join(INVALID_PARTS.values()) + ")"


def counts_of(tokens: str, source: str = "labelled", by: str = "", where: str = "TRUE") -> str:
    """Sub-query of (by, token, n)."""
    lead = f"{by}, " if by else ""
    group = f"{by}, token" if by else "token"
    return (
        f"(SELECT {lead}token, count(*) AS n FROM (SELECT {lead}unnest({tokens}) AS token FROM {source} WHERE {where}) "
        f"GROUP BY {group})"
    )


def unpivot(names, entry) -> str:
    """UNION ALL of one SELECT per name."""
    return " UNION ALL ".join(entry(n) for n in names)
