import pytest

from . import cases


@pytest.fixture(scope="session")
def docs(spark):
    return cases.documents(spark).persist()


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
