import duckdb

import __spark_entry__ as E
from conftest import SF001
from tablesync.plans.registry import all_oracles, all_queries
from tablesync.sources.tables import TEST_TABLES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "issue_type"
    assert df.count() > 0


def test_every_query_of_the_library_has_an_oracle():
    q, o = all_queries(), all_oracles()
    assert set(o) <= set(q) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(q) == set(o)


def test_oracles_agree_on_smallest_data(spark):
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    for name in ["recon_missing_rows", "recon_missing_summary", "tag_plan_overwrite", "grant_plan", "snapshot_changes", "effective_settings"]:
        s = E.queries()[name](spark, SF001)
        n_spark = s.count()
        n_duck = con.execute(f"select count(*) from ({E.oracle_sql()[name]})").fetchone()[0]
        assert n_spark == n_duck, name
