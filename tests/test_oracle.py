"""Every query with an oracle matches DuckDB on the smallest test tables, and
every rows-only query runs in full (values of those: test_models, test_semantics)."""

import pytest

from conftest import SF_SMALL
from dataloom.plans import REGISTRY
from dataloom.plans.oracle import compare

SQL = sorted(n for n, e in REGISTRY.items() if e.sql)
ROWS = sorted(n for n, e in REGISTRY.items() if not e.sql)


@pytest.mark.parametrize("name", SQL)
def test_query_matches_oracle(spark, duck_small, name):
    e = REGISTRY[name]
    res = compare(e.fn(spark, SF_SMALL), e.sql, duck_small)
    assert res["ok"], res


@pytest.mark.parametrize("name", ROWS)
def test_rows_only_query_runs(spark, name):
    df = REGISTRY[name].fn(spark, SF_SMALL)
    assert len(df.columns) > 0
    df.write.format("noop").mode("overwrite").save()


WINDOW_ROWS = ["win_row_number_rank", "win_ntile", "win_percent_rank_cume_dist", "win_lead_lag", "win_first_last_nth",
               "win_rows_frame", "win_stitch", "win_rolling", "win_expanding", "win_diff_pct"]


@pytest.mark.parametrize("name", WINDOW_ROWS)
def test_window_rows_over_many_ranges(spark, duck_small, name):
    """More ranges than suppliers: every supplier spans several, and some ranges hold next to no rows."""
    e = REGISTRY[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        res = compare(e.fn(spark, SF_SMALL), e.sql, duck_small)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert res["ok"], res
