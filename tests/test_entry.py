import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert {"tp", "tn", "fp", "fn", "precision", "recall", "f1", "error"} <= set(df.columns)


def test_oracle_keys_are_query_keys():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


def test_queries_smoke_sf0001(spark):
    """Every registered query plans and runs on the smallest tables."""
    qs = E.queries()
    for name in ["ingest_records", "category_index", "malformed_quarantine",
                 "f_by_threshold", "cluster_label_join", "scaled_features"]:
        assert qs[name](spark, "/root/testdata/sf0.001").count() >= 0, name
