import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
# Extra columns whose names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep long, kept string, n long, th string"


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text[, lang]) rows with extra columns of clashing names."""
    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "s", 0, 7, "x", -1, "y") for r in rows], SCHEMA)
    return make
