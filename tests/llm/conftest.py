import pytest

from orderflow.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard string, size string, component_id string"


def odd_rows():
    """Nulls, empty and blank texts, a very long one, ties, copies, repeated rows and columns with clashing names."""
    long_text = " ".join(f"word{k % 977} Sie{k % 13}," for k in range(60_000))
    texts = [
        (1, "one two three four five six seven"), (2, "one two three four five six seven"),
        (3, "One  two\tthree four\nfive six seven"), (4, None), (5, ""), (6, " \t\n"), (7, "solo"), (8, "two words"),
        (9, long_text), (10, long_text), (None, "a row without an id but with some words"), (None, None),
        (11, "repeated row"), (11, "repeated row"), (12, "a b a b a b a b a b"), (13, "É ü 漢字 𝄞 ñ"), (14, "  solo "),
    ]
    sources = ["s1", None, "s2", "é", "S1"]
    return [(i, t, None if k == 3 else "en", sources[k % 5], None if t is None else len(t), 0.5, "x", None, "c")
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark):
    return stored(spark.createDataFrame(odd_rows(), SCHEMA).repartition(3))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
