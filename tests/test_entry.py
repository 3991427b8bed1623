import importlib

from dataloom.plans import REGISTRY


def test_entry_contract(spark):
    m = importlib.import_module("__spark_entry__")
    df = m.entry(spark)
    assert df.count() > 0
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) == set(REGISTRY) | set(m.QUERIES)
