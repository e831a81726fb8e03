import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """A shared folder for the session, as a cluster would name one."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, hits int, node int, entity_h int"


@pytest.fixture
def make_docs(spark):
    """Documents with extra columns whose names clash with those the operators use."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "own", 1, 2, 3) for i, t in rows], DOC)

    return make


@pytest.fixture
def edge_rows():
    """Null, empty, blank, very long, tied and repeated rows, a null id."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, "same text here for all of us"), (6, "same text here for all of us"), (6, "same text here for all of us"), (None, "no id"), (7, "日本語 text é"), (8, "x" * 50_000)]
