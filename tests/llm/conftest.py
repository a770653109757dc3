import random

import pytest

from tidelog.llm.registry import BATCH_CONF

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as columns of their input.
CLASHES = ("n_words", "key", "bucket", "blob", "spans", "size", "name", "v", "c", "h", "copy", "clean", "distance", "_id")


@pytest.fixture(autouse=True)
def batches(spark):
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Random prose with nulls, blanks, a very long text, exact and near copies, repeats."""
    rng = random.Random(5)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(60)]
    base = words(rng, 200)
    for k in range(12):
        w = base.split()
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = "edit" + str(rng.random())[2:5]
        texts.append(" ".join(w))
    texts += [texts[3], texts[3], "", "   \n\t", None, None, "x", "one two three four", "one two three four"]
    texts += [words(rng, 30_000)]
    texts += [texts[5].upper(), texts[7] + "\n" + texts[8], "tab\tsep\x0bvt\x0cff\rcr nb sp é ß 漢字 \U0001f600 " * 5]
    rows = [(i * 3 + 1, t, ("en", "de", None)[i % 3], ("a", "b", "c", None)[i % 4], len(t or "")) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def frame(spark, docs):
    return spark.createDataFrame(docs, DOCS).repartition(5)


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASHES if c not in df.columns})


def as_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
