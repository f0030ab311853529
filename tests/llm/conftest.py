import pytest

from ledgersieve.llm.shipping import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs or fuller rows, with a further column that no operator knows."""

    def make(rows, parts=3):
        full = [(*row, "en", "s0")[:4] if len(row) < 4 else row for row in rows]
        frame = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        return frame.selectExpr("*", "CAST(length(text) AS BIGINT) AS n_chars", "'x' AS size", "'y' AS fingerprint").repartition(parts)

    return make
