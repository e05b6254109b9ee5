from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

from tagquality.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `_ord` string, blob string, fp string"


@pytest.fixture(scope="session")
def llm(spark: SparkSession) -> SparkSession:
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def make(llm: SparkSession):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use inside."""
    def docs(rows: list[tuple], lang: str | None = "en") -> DataFrame:
        return llm.createDataFrame([(i, t, lang, "s", None, "o", "b", "f") for i, t in rows], DOCS)

    return docs
