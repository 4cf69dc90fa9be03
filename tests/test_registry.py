"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as registry
from checks import queries
from tests.compare import connect, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module", autouse=True)
def trained_once():
    """Many queries train the same small vocabularies; here each is trained once."""
    patch, known = pytest.MonkeyPatch(), {}

    def once(train):
        def cached(spark, sf_dir, *size):
            key = (train.__name__, sf_dir, *size)
            if key not in known:
                known[key] = train(spark, sf_dir, *size)
            return known[key]

        return cached

    for name in ("pair_merges", "document_merges"):
        patch.setattr(queries, name, once(getattr(queries, name)))
    yield
    patch.undo()


def test_registry_is_consistent():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).count() == 20


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    columns, rows = spark_rows(registry.queries()[name](spark, SF_DIR))
    if name in registry.oracle_sql():
        assert (columns, rows) == oracle_rows(duck, registry.oracle_sql()[name])
    else:
        assert rows
