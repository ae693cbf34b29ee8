from __future__ import annotations

import pytest

from perennia.llm.common import prepare


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def vocabulary(spark):
    from perennia.llm import bpe
    from perennia.llm.catalog import VOCABULARY

    return bpe.vocabulary(spark, VOCABULARY)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, keys string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, with two extra columns whose names operators use inside."""

    def make(pairs, langs=None):
        rows = [
            (i, t, langs[k] if langs else "en", f"src{k % 3}", len(t or ""), 0.5, "x") for k, (i, t) in enumerate(pairs)
        ]
        return spark.createDataFrame(rows, DOCS)

    return make
