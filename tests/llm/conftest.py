import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, kept int, fingerprint string, epoch double"
LONG = " ".join(f"w{i % 977} x{i % 31}." for i in range(40_000))
PROSE = " ".join(f"alpha{i} beta{i * 7 % 50}" for i in range(60)) + "."


def edge_rows():
    """Nulls everywhere, empty and blank texts, a very long one, ties, repeated rows; other columns have operators' names."""
    rows = [
        (1, None, "en", "a"),
        (2, "", None, "a"),
        (3, " \t\n\x0b\f\r ", "en", None),
        (4, LONG, "en", "a"),
        (5, PROSE, None, None),
        (5, PROSE, None, None),
        (5, PROSE + " more", "de", "b"),
        (None, PROSE, "de", "b"),
        (None, None, None, None),
        (6, "one", "de", "b"),
        (7, "Ünï cödé 日本語 🙂 <|endoftext|>\x1cb", "de", "b"),
        (8, "line of more than forty characters, said often\n" * 3 + "own", "en", "a"),
    ]
    return [(*r, 7, "x", 1, "f", 0.5) for r in rows]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
