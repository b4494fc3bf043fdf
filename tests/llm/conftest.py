from __future__ import annotations

import pytest

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Frame of documents from (doc_id, text) rows, with columns whose names could clash."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, 0, "x", 1) for i, t, *s_ in rows for s in [s_[0] if s_ else "s"]],
            "doc_id bigint, text string, lang string, source string, n_chars bigint, row_hash string, score int")
    return make
