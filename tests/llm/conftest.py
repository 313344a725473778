import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # extra columns whose names the operators use themselves
    " size long, row string, key string, node long, target double, cluster string, copies int, item long"
)
LONG = "long words " * 12_000
#: Nulls in any column, empty and very long texts, ties, repeated rows, strange spaces.
EDGE_ROWS = [
    (1, "one two three four five six", "en", "a"),
    (2, "one two three four five six", "en", "a"),
    (2, "one two three four five six", "en", "a"),
    (3, None, "en", "b"),
    (4, "", None, "b"),
    (5, " \n\t ", "fr", None),
    (None, "no identifier here but words", None, None),
    (None, None, None, None),
    (6, LONG, "de", "c"),
    (7, "a", "de", "c"),
    (8, "É x y \x1f z\r\n\x0bend", "es", "c"),
    (9, "x\U0001f600" * 40, "es", "c"),
]


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    """The session names no shared folder; tests run on one machine."""
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def make(spark):
    def build(rows):
        full = [(*r, len(r[1] or ""), 7, "row", "key", 1, 0.5, "c", 2, 3) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def edges(make):
    return make(EDGE_ROWS)


@pytest.fixture(scope="session")
def empty(make):
    return make([])


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
