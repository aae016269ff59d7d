import duckdb
import pytest

from connscore.plans import learned

SF0001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["learned_tree", "learned_depths", "learned_tree_rule"])
def test_fitted_model_gives_what_the_rule_gives(spark, name):
    got = learned.QUERIES[name](spark, SF0001)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF0001}/lineitem.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({learned.ORACLE_SQL[name]}) ORDER BY ALL").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == want
