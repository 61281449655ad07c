import pytest

from fieldcast.llm.common import ship_package


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a table of documents with a repeated, a null and a clashing column."""

    def build(texts, ids=None, **more):
        rows = [
            (i, t, "en", "src0", None if t is None else len(t), 1.0, "x")
            for i, t in zip(ids or range(len(texts)), texts)]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, score double, spans string")

    return build
