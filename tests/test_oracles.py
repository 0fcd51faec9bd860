import pytest
from oracle import DATA, assert_same

from netloom.plans import queries as q


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    assert_same(q.QUERIES[name](spark, DATA), q.ORACLE_SQL[name], DATA)


def test_every_query_runs_and_most_have_sql():
    assert set(q.ORACLE_SQL) <= set(q.QUERIES)
    assert set(q.ORACLE_SQL) == set(q.QUERIES)


def test_entry_works_without_the_optional_package(monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as e

    full = set(e.queries())
    for gone in [m for m in sys.modules if m.startswith("netloom.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, gone)

    class Gone(importlib.abc.MetaPathFinder):
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.startswith("netloom.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    assert set(e.queries()) == set(q.QUERIES) <= full
    assert set(e.oracle_sql()) == set(q.ORACLE_SQL)


def test_entry_gives_rows(spark):
    import __spark_entry__ as e
    from netloom.schemas import SERIES_COLUMNS

    df = e.entry(spark)
    assert df.columns == SERIES_COLUMNS and df.count() > 0
