import random

import pytest


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs():
    """Rows (doc_id, text): nulls, empty and long texts, copies, near copies, shared passages, repeated rows."""
    base, passage = prose(1, 120), prose(2, 60)
    near = base.split()
    near[7] = "changed"
    upper = " ".join(near).upper()
    rows = [
        (1, base),
        (2, base),
        (3, " ".join(near)),
        (4, upper),
        (5, None),
        (6, ""),
        (7, " \t\n\u000b "),
        (8, "one two"),
        (9, "One  two"),
        (10, "é ü x 漢字 🙂"),
        (11, prose(3, 30) + " " + passage + " " + prose(4, 30)),
        (12, prose(5, 10) + "\n" + passage),
        (13, passage + "\t" + passage),
        (14, "same " * 200),
        (15, "same " * 120),
        (None, base),
        (None, None),
        (16, prose(6, 30_000, 50)),
        (17, prose(6, 30_000, 50)[:90_000]),
        (18, base),
        (18, base),
        (19, prose(7, 70)),
        (19, prose(8, 70)),
        (20, prose(7, 70)),
    ]
    # A chain of copies, each a few words further from the first one.
    chain = prose(9, 150).split()
    for k in range(12):
        rows.append((30 + k, " ".join(chain)))
        for j in range(4):
            chain[(k * 11 + j * 37) % 150] = f"new{k}_{j}"
    # A hot passage with different surroundings, and a hot document.
    rows += [(50 + k, prose(100 + k, 8) + " " + passage + " " + prose(200 + k, 8)) for k in range(40)]
    rows += [(100 + k, prose(10, 80)) for k in range(60)]
    return rows


@pytest.fixture()
def docs(spark, odd_docs):
    from pyspark.sql import functions as F

    from llm.shared import ship

    ship(spark)
    df = spark.createDataFrame(odd_docs, "doc_id bigint, text string").repartition(5)
    # Names that the operators use for their own columns.
    for name in ("n_words", "kept", "score", "lang_pred", "first", "id", "gram", "component_id", "_hash", "n_lines"):
        df = df.withColumn(name, F.lit(None).cast("string"))
    return df


@pytest.fixture()
def empty(docs):
    return docs.limit(0)
