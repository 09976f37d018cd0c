from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark: SparkSession):
    """A maker of documents tables from texts or (id, text) pairs; extra columns may follow."""

    def make(texts, extra: str = ""):
        rows = []
        for k, text in enumerate(texts):
            doc, text = text if isinstance(text, tuple) else (k, text)
            rows.append((doc, text, None if k % 3 else "en", None, None) + (("x",) * bool(extra)))
        return spark.createDataFrame(rows, SCHEMA + (f", {extra} string" if extra else ""))

    return make
