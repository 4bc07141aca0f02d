import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for columns of their own.
CLASHES = "node string, digest string, file string, row string, key string, k int, host string, path string, kind string, held int"


def sentence(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source): copies, near copies, nulls, empties, a long text, repeated rows."""
    rng = random.Random(11)
    base = [sentence(rng, rng.randrange(3, 120)) for _ in range(60)]
    texts = [None, "", " \n\t", "one", "one two three four", None, ""]
    texts += base + base[:10] + [base[0]] * 12
    for k in range(20):
        own = base[k].split()
        if own:
            own[rng.randrange(len(own))] = "changed"
        texts.append(" ".join(own))
    family = sentence(rng, 90)
    for _ in range(40):
        own = family.split()
        for _ in range(rng.randrange(0, 7)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    texts.append(sentence(rng, 30_000))
    rows = [(k, t, "en", f"s{k % 3}") for k, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus, tmp_path_factory):
    return stored(spark, corpus, tmp_path_factory.mktemp("docs"))


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return stored(spark, [], tmp_path_factory.mktemp("empty"))


def stored(spark, rows, folder):
    """The rows as a table of files, with columns whose names clash with those of operators."""
    full = [(i, t, x, s, len(t) if t else 0) for i, t, x, s in rows]
    frame = spark.createDataFrame(full, SCHEMA).repartition(3)
    for part in CLASHES.split(", "):
        name, kind = part.split()
        frame = frame.selectExpr("*", f"CAST(7 AS {kind}) AS {name}")
    frame.write.mode("overwrite").parquet(str(folder / "documents.parquet"))
    return spark.read.parquet(str(folder / "documents.parquet"))
