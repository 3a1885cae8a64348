import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i * 7919 % 3000}" for i in range(30_000))
EDGES = [
    (None, None), (None, "no id at all"), (9000, None), (9001, ""), (9002, " \n\t "), (9003, "one"), (9004, "A b C d"),
    (9005, "tie tie tie tie tie tie tie tie tie tie tie tie"), (9006, LONG), (9007, "same row again " * 12), (9007, "same row again " * 12),
    (9007, "same id, another text"), (9008, "ünïcödé ßtraße 日本語 x　y\x1c\x85z\r\n" * 9), (9009, "x" * 5000), (9010, "\x00 nul \x00"),
]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of the driver's documents and the edge cases, as a list."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    return rows + EDGES


@pytest.fixture
def frame(spark, documents):
    return spark.createDataFrame(documents, SCHEMA).repartition(3)


@pytest.fixture
def clashing(spark):
    """A document among columns named like everything that the operators make."""
    names = ("N_Words", "score", "__text", "row_key", "shingles", "features", "held_out", "class", "base", "kept", "n", "rule", "host")
    return spark.createDataFrame([(1, "a clashing row of some nine plain words here", *names)], SCHEMA + "".join(f", `{c}` string" for c in names))


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
