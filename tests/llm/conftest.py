import os
import zlib

import pytest

TABLES = "/root/testdata/sf0.001"


def pytest_collection_modifyitems(items):
    if not os.path.isdir(TABLES):
        for item in items:
            if "folder" in getattr(item, "fixturenames", ()):
                item.add_marker(pytest.mark.skip(reason="no test tables"))


@pytest.fixture(scope="session")
def folder():
    return TABLES


DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first=1, ids=None):
    """Rows of the documents table, with an extra column whose name operators use inside."""
    ids = list(range(first, first + len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOC).selectExpr("*", "'x' AS digest", "0 AS label")


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def prose(seed, words=60):
    """Words that depend on a number only."""
    return " ".join(f"w{(seed * 7919 + k * k * 31 + k * seed) % 997}" for k in range(words))
