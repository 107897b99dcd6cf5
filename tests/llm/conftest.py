import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

TABLES = "/root/testdata/sf0.001"


@pytest.fixture
def tables():
    return TABLES


@pytest.fixture
def docs_of(spark):
    """Documents of (doc_id, text) rows, with columns whose names clash with the operators' own."""

    def make(rows):
        data = [(i, t, "en", "s", "n", 1, "x") for i, t in rows]
        return spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars string, digest int, group_size string")

    return make
