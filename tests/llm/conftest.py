import pytest

from wayside.llm.queries import reach


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    reach(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of (doc_id, text, source), with columns whose names operators use inside."""
    schema = "doc_id long, text string, source string, row string, n long, score string, __n int, rep int, lang string"

    def make(rows):
        full = [(i, t, s, "r", 7, "s", 1, 2, "en") for i, t, s in ((*r, "a")[:3] for r in rows)]
        return spark.createDataFrame(full, schema)

    return make
