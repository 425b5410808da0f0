import pytest
from sqlcheck import SF, compare

from ambitus.plans import data_queries, map_queries, place_queries, stage_queries

MODULES = (place_queries, map_queries, data_queries, stage_queries)
WITH_SQL = [(n, m) for m in MODULES for n in m.SQL]
WITHOUT = [(n, m) for m in MODULES for n in m.QUERIES if n not in m.SQL]


@pytest.mark.parametrize("name,module", WITH_SQL, ids=[n for n, _ in WITH_SQL])
def test_same_as_sql(spark, name, module):
    compare(spark, module.QUERIES[name], module.SQL[name])


@pytest.mark.parametrize("name,module", WITHOUT, ids=[n for n, _ in WITHOUT])
def test_runs(spark, name, module):
    assert module.QUERIES[name](spark, SF).limit(1).count() == 1


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["row", "col"] and e.entry(spark).count() > 0
