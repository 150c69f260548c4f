import os
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def _ready(spark):
    """Workers find the repository; checkpoints go to a fresh folder."""
    env = spark.sparkContext.environment
    env["PYTHONPATH"] = os.pathsep.join([ROOT, env.get("PYTHONPATH", "")])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank and very long texts, repeated rows, null keys, and extra columns that clash with inner names."""
    long_text = " ".join(f"word{i % 997} of{i % 13}" for i in range(20_000))
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "one two", "en", "a"), (4, "one two", "en", "a"),
            (5, long_text, "en", None), (6, long_text, "en", "b"), (7, "x" * 50_000, "de", "b"), (8, "12345 !!! ???", "de", "b"), (None, "a text without an id", "en", "b")]
    rows = [(i, t, lang, s, len(t or ""), "k", 1, 2, [3], 4.0, True, "t") for i, t, lang, s in rows]
    return spark.createDataFrame(rows, DOCS + ", key string, n long, pos long, ids array<long>, distance double, kept boolean, g string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
