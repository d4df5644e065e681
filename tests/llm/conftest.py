import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def rows_of(texts):
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def edge_texts():
    """Null, empty, white space, ties, repeated rows, one long text, near copies and a shared passage."""
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base, shared = prose(120).split(), prose(60)
    near = [list(base) for _ in range(6)]
    for own in near[1:]:
        for _ in range(6):
            own[rng.randrange(len(own))] = rng.choice(vocab)
    texts = [None, "", " \n\t ", "one", "one", None, "", prose(20_000), prose(400) + " " + shared + " " + prose(30), shared + " " + prose(80), "a b c d", "a b c d"]
    texts += [" ".join(x) for x in near] + [" ".join(base)] * 3 + ["the cat " * 200, "x\ny\nx\nx", "Ärger über Öl & $5 # |\n\nnaïve café <b>"]
    return texts


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(rows_of(edge_texts()), SCHEMA).selectExpr("*", "'x' as row_key", "1 as n_words", "2 as text_hash")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
