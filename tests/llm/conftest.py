import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture
def documents(spark):
    """documents([(doc_id, text), ...]) or documents([(doc_id, text, lang), ...]) -> DataFrame of the full table."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build


@pytest.fixture
def labels(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return build


@pytest.fixture(scope="session")
def long_text():
    """40,000 words, in which one sentence keeps coming back."""
    return " ".join(f"w{i % 997} x{i}" if i % 10 else "the same sentence" for i in range(20_000))
