import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Small texts with what goes wrong: nulls, no words, repeats, a very long word, clashing extra columns."""

    def make(texts, **extra):
        rows = [(i, x, "en" if i % 3 else None, f"src{i % 4}", i, i * 2) for i, x in enumerate(texts)]
        columns = "doc_id long, text string, lang string, source string, n_words long, row long"
        return spark.createDataFrame(rows, columns).repartition(3)

    return make
