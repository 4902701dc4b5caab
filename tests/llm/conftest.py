import random

import pytest
from pyspark.sql import types as T

WORDS = "the of and to in river stone market garden winter letter music silver morning road house tree light sea wind".split()


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "ed"]) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words)).replace(". ", ".\n", 2)


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Columns of other tables with the names that operators use themselves.
    *[T.StructField(c, T.StringType()) for c in ("size", "id", "row_key", "_uid", "kept", "a.b", "value")]])


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty and very long texts, repeated rows, ties."""
    rng = random.Random(5)
    texts = [(0, None, None, None), (1, "", "en", "a"), (2, " \n\t ", "en", "a"), (3, "one two", "en", None),
             (4, "ONE  two\n", "de", "b"), (4, "ONE  two\n", "de", "b"), (None, "one two", "en", "a"),
             (5, prose(rng, 40_000), "en", "a"), (6, "x" * 300_000, "en", "a"), (7, "é́ 😀 ß x\x1cy z", "fr", "\U0001f600")]
    for i in range(10, 60):
        texts.append((i, prose(rng, rng.randint(60, 200)), "en", f"s{i % 3}"))
    base = prose(rng, 300).split(" ")
    for i in range(60, 70):
        words = list(base)
        words[10 * (i - 59)] = "changed"
        texts.append((i, " ".join(words), "en", "s0"))
    return [(*t, None if t[1] is None else len(t[1]), *["z"] * 7) for t in texts]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
