"""Fixtures of these tests, imported by name: awkward tables, query rows."""

import pytest

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    """A folder of small tables full of awkward rows, named like the given ones."""
    root = tmp_path_factory.mktemp("edge")
    words = [f"w{i}" for i in range(60)]
    body = " ".join(words)
    near = body.replace("w30 ", "x30 ")
    docs = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, None), (4, "One", "en", "b"),
        (5, "one", "fr", "b"), (6, body, "en", "a"), (7, body.upper(), "en", "c"), (8, near, "en", "a"),
        (9, near, "en", "a"), (10, body + " " + body, "en", "Ä"), (11, "a b c d", "en", "b"),
        (12, "A  b\u00a0c\td", "en", "b"), (13, "é" * 5000, "fr", "d"), (14, ("long " + body + "\n") * 300, "en", "d"),
        (15, "x" * 200_000, "en", "e"), (16, "password = hunter2hunter2", "en", None), (16, "password = hunter2hunter2", "en", None),
        (None, "no id", "en", "a"), (17, "A\x00B \U0001F600 z", "en", "a"), (100, "far away id", "en", "f"),
    ]
    (spark.createDataFrame([(*r, len(r[1] or "")) for r in docs], DOC_SCHEMA)
     .write.parquet(str(root / "documents.parquet")))
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(str(root / "none" / "documents.parquet"))
    return str(root)


@pytest.fixture(scope="session")
def rows(spark):
    """Rows of a registered query on a folder of tables, as dicts."""
    from cellfold.llm.queries import QUERIES

    def run(name, folder):
        full = next(k for k in QUERIES if k.startswith(name + "_"))
        return [r.asDict(recursive=True) for r in QUERIES[full](spark, folder).collect()]
    return run


@pytest.fixture(scope="session")
def docs_of(spark):
    def read(folder):
        return [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    return read
