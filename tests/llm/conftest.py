import pytest
from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
LONG = "The long text goes on and on. " * 20_000

#: doc_id, text, lang, source, n_chars: nulls in every column, empty and very long texts, ties, repeated rows.
EDGE_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44),
    (2, "The quick brown fox jumps over the lazy dog.", "en", "b", 44),
    (3, None, "en", "a", None),
    (4, "", None, None, 0),
    (5, LONG, "en", "a", len(LONG)),
    (6, "\n \t\n", "de", "a", 4),
    (7, "日本語 テスト 🙂 é\u0000x", "ja", "a", 1),
    (7, "日本語 テスト 🙂 é\u0000x", "ja", "a", 1),
    (None, "Nothing is known of this one.", "en", "a", 1),
    (None, None, None, None, None),
    (8, "12345 !!! ...", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge(spark: SparkSession) -> DataFrame:
    """Awkward documents, with further columns named like the operators' own."""
    docs = spark.createDataFrame(EDGE_ROWS, SCHEMA)
    return docs.selectExpr("*", "doc_id AS id", "'x' AS score", "1 AS label", "2 AS bucket", "3 AS length", "4 AS piece", "5 AS node", "6 AS kept")


@pytest.fixture(scope="session")
def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(df: DataFrame) -> list[tuple[int, str]]:
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
