"""Language of a text by hierarchical discrimination.

A linear classifier over families names the family first; within it, one linear support vector machine for each two
languages votes. Features are the shares of hashed byte n-grams of one to three bytes, ASCII lower-cased, of the whole
text. The machines are trained on the driver, on at most ``per_language`` texts of each language, drawn by a hash of their
ids from all of the table; everything else runs over all rows.

Defined results: ``und`` and score 0 for texts that are null or have no letter; rows without a language or an id aren't
learned from; with one language in the training rows, it is predicted for every text with a letter; without any, all are
``und``. The prediction is a column, so rows, order and other columns stay as they are.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.words import BLOCK_BYTES

UNKNOWN = "und"
DIMENSIONS = 4096
PER_LANGUAGE = 800
RESULT = "lang_pred string, score double"
#: Letters, and numerals that are no decimal digits.
_LETTER_OR_NUMERAL = re.compile(r"[^\W\d_]")

# Language codes of the larger families.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc ast",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "indic": "hi bn mr gu pa ur ne si or as",
    "turkic": "tr az kk uz ky tk tt",
    "uralic": "fi et hu",
    "semitic": "ar he mt am",
    "austronesian": "id ms tl jv su mg",
    "dravidian": "ta te kn ml",
    "baltic": "lt lv",
    "celtic": "ga cy br gd",
}


def family(language: str) -> str:
    """Family of a language; one that isn't listed is a family of its own."""
    return next((name for name, codes in FAMILIES.items() if language in codes.split()), language)


def has_letter(text: str) -> bool:
    """Whether a code point of the text is a letter by its Unicode category."""
    return any(unicodedata.category(m[0])[0] == "L" for m in _LETTER_OR_NUMERAL.finditer(text))


def features(texts: list[str]) -> np.ndarray:
    """Square roots of n-gram shares, one row per text."""
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    for i, text in enumerate(texts):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        counts = np.zeros(DIMENSIONS, dtype=np.int64)
        for at in range(0, len(data), BLOCK_BYTES):
            part = data[at : at + BLOCK_BYTES + 2]
            part = np.where((part >= 65) & (part <= 90), part | 32, part).astype(np.uint32)
            two = part[:-1] | part[1:] << np.uint32(8)
            three = two[:-1] | part[2:] << np.uint32(16)
            for gram in (part, two | np.uint32(1 << 24), three | np.uint32(1 << 25)):
                counts += np.bincount(gram * np.uint32(2654435761) >> np.uint32(20), minlength=DIMENSIONS)
        if total := counts.sum():
            out[i] = np.sqrt(counts / total)
    return out


def machine(x: np.ndarray, positive: np.ndarray, rounds: int = 12, penalty: float = 1e-4) -> np.ndarray:
    """Weights, the bias last, of a linear support vector machine: averaged subgradient steps, seeded."""
    y = np.where(positive, 1.0, -1.0)
    x = np.hstack([x, np.full((len(x), 1), 0.1, dtype=x.dtype)])
    share = np.where(positive, 0.5 / max(positive.mean(), 1e-9), 0.5 / max((~positive).mean(), 1e-9))
    w, mean, step = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0
    random = np.random.Generator(np.random.PCG64(7))
    for r in range(rounds):
        for i in random.permutation(len(x)):
            step += 1
            rate = 1 / (penalty * (step + 1 / penalty))
            w *= 1 - rate * penalty
            if y[i] * (x[i] @ w) < 1:
                w += rate * share[i] * y[i] * x[i] * 20
            if r * 2 >= rounds:
                mean += w
    mean /= max(1, step - step // 2)
    mean[-1] *= 0.1
    return mean.astype(np.float32)


class Discriminator:
    def __init__(self, x: np.ndarray, languages: list[str]):
        labels = np.array(languages)
        self.families: dict[str, list[str]] = {}
        for language in sorted(set(languages)):
            self.families.setdefault(family(language), []).append(language)
        kin = np.array([family(x) for x in languages])
        self.top = {f: machine(x, kin == f) for f in self.families} if len(self.families) > 1 else {}
        self.pairs = {
            (a, b): machine(x[(labels == a) | (labels == b)], labels[(labels == a) | (labels == b)] == a)
            for own in self.families.values()
            for i, a in enumerate(own)
            for b in own[i + 1 :]
        }

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        def margin(w: np.ndarray) -> np.ndarray:
            return x @ w[:-1] + w[-1]

        def chance(m: np.ndarray) -> np.ndarray:
            return 1 / (1 + np.exp(-np.clip(2 * m, -30, 30)))

        names = list(self.families)
        if self.top:
            margins = np.stack([margin(w) for w in self.top.values()])
            chosen, score = margins.argmax(axis=0), chance(margins.max(axis=0))
        else:
            chosen, score = np.zeros(len(x), dtype=int), np.ones(len(x))
        votes = {pair: margin(w) for pair, w in self.pairs.items()}
        best, chances = np.empty(len(x), dtype=object), np.ones(len(x))
        for k, name in enumerate(names):
            own, rows = self.families[name], chosen == k
            if not rows.any():
                continue
            won, worst = np.zeros((len(own), len(x))), np.full((len(own), len(x)), np.inf)
            for i, a in enumerate(own):
                for j in range(i + 1, len(own)):
                    m = votes[a, own[j]]
                    won[i] += m > 0
                    won[j] += m <= 0
                    worst[i], worst[j] = np.minimum(worst[i], m), np.minimum(worst[j], -m)
            first = (won + np.tanh(np.clip(worst, -9, 9)) * 0.1).argmax(axis=0)  # equal votes: the clearer one
            best[rows] = np.array(own, dtype=object)[first[rows]]
            low = np.take_along_axis(worst, first[None], axis=0)[0]
            chances[rows] = chance(np.minimum(low, 15))[rows]
        return best.tolist(), score * chances


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Discriminator | None:
    """Learn from rows with a language; at most ``per_language`` texts of each are read, drawn by a hash of the id."""
    rows = rows.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    if not counts:
        return None
    million = 1_000_000
    cut = F.create_map(*[F.lit(v) for k, n in sorted(counts.items()) for v in (k, min(million, million * per_language // n + 1))])
    drawn = rows.where(F.pmod(F.xxhash64(id_col), F.lit(million)) < cut[F.col(lang_col)]).select(lang_col, text_col)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features([t.as_py() for t in batch.column(1)])
            yield pa.record_batch([batch.column(0), pa.array([v.tobytes() for v in x], pa.binary())], names=["lang", "x"])

    found = drawn.mapInArrow(vectors, "lang string, x binary").collect()
    found = sorted(found, key=lambda r: (r[0], r[1]))
    return Discriminator(np.stack([np.frombuffer(r[1], dtype=np.float32) for r in found]), [r[0] for r in found])


def language(model: Discriminator | None, text: Column) -> Column:
    """Struct (lang_pred, score) of each text."""

    @F.pandas_udf(RESULT)
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            names, scores = [UNKNOWN] * len(series), np.zeros(len(series))
            real = [i for i, t in enumerate(series) if t is not None and has_letter(t)] if model is not None else []
            for at in range(0, len(real), 256):
                own = real[at : at + 256]
                lang, score = model.predict(features([series.iat[i] for i in own]))
                scores[own] = score
                for i, name in zip(own, lang, strict=True):
                    names[i] = name
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return predicted(text)


def identify(documents: DataFrame, text_col: str, model: Discriminator | None) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``, in place of columns of these names."""
    kept = [F.col(f"`{c}`") for c in documents.columns if c not in ("lang_pred", "score")]
    return documents.select(*kept, language(model, F.col(text_col)).alias("_found")).select(*kept, "_found.*")
