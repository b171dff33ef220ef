import pytest
from pyspark.sql import Row

from tubetrace.llm.common import package_for_workers

LONG = "word after word goes on and on, line by line.\n" * 3000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept int"


@pytest.fixture(scope="session")
def spark_llm(spark):
    package_for_workers(spark)
    return spark


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, columns that clash."""
    texts = ["", None, "   \n ", LONG, "one", "One  TWO\tthree", "é 你好 \x1c x ² <|endoftext|> y",
             "the same text here again and again", "the same text here again and again",
             "a" * 3000, " lead", "trail \n", "x  y   z"]
    rows = [Row(doc_id=i, text=t, lang="en", source="s", n_chars=len(t or ""), score=.1, kept=7)
            for i, t in enumerate(texts)]
    return [*rows, rows[7], rows[7].__class__(**{**rows[7].asDict(), "doc_id": None})]


@pytest.fixture(scope="session")
def odd(spark_llm, odd_rows):
    return spark_llm.createDataFrame([tuple(r) for r in odd_rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark_llm):
    return spark_llm.createDataFrame([], SCHEMA)
