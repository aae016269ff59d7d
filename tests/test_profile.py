from pyspark.sql import functions as F

from connscore.operators import profile as PR
from connscore.operators.features import vector_index


def test_label_counts_sorted_and_dot_kept(spark):
    df = spark.createDataFrame([(x,) for x in ["smurf.", " smurf.", "normal.", "smurf.",
                                                "normal.", "back."]], "label string")
    rows = [(r.label, r.n) for r in PR.label_counts(df, "label").collect()]
    assert rows == [("smurf.", 3), ("normal.", 2), ("back.", 1)]
    assert [r.label for r in PR.top_labels(df, "label", 2).collect()] == ["smurf.", "normal."]


def test_index_by_frequency_breaks_ties_by_label(spark):
    kinds = ["ftp", "ssh", "dns", "ssh", "web", "web", "web", "dns"]
    df = spark.createDataFrame([(10 * i, k) for i, k in enumerate(kinds)], "row int, kind string")
    out = PR.label_index_by_frequency(df, "kind", "place")
    assert {r.kind: r.place for r in out.collect()} == {"web": 0.0, "dns": 1.0, "ssh": 2.0, "ftp": 3.0}


def test_vocabulary_and_cardinality_one_pass(spark):
    df = spark.createDataFrame([("tcp", "http", "SF"), ("udp", "private", "SF"),
                                ("tcp", "http", "REJ"), ("icmp", "ecr_i", "SF")],
                               "protocol_type string, service string, flag string")
    cols = ["protocol_type", "service", "flag"]
    card = {r.column_name: (r.n_values, r.values_joined)
            for r in PR.category_cardinality(df, cols).collect()}
    assert card["protocol_type"] == (3, 'icmp","tcp","udp')
    assert card["flag"] == (2, 'REJ","SF')
    vocab = {(r.column_name, r.value): r.value_idx
             for r in PR.category_vocabulary(df, cols).collect()}
    assert vocab[("service", "ecr_i")] == 0 and vocab[("service", "private")] == 2
    plan = PR.category_cardinality(df, cols)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 or plan.count("LocalTableScan") <= 1


def test_vector_indexer_small_slots_become_categories(spark):
    df = spark.createDataFrame([(float(i % 3) * 0.01, float(i)) for i in range(40)],
                               "tax double, qty double")
    out = vector_index(df, ["tax", "qty"], max_categories=10)
    rows = out.select("tax", F.col("indexed")).collect()
    for r in rows:
        assert r.indexed[0] == round(r.tax / 0.01)   # 0.0 -> 0, 0.01 -> 1, 0.02 -> 2
        assert r.indexed[1] in range(40)              # continuous slot passes through


def test_label_counts_from_raw_lines(spark):
    from conftest import LINE_A, LINE_B
    lines = [LINE_A, LINE_A + "\r", "  " + LINE_B + " \t", "1,2,3", LINE_A.replace("normal.", " normal.")]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.label: r.n for r in PR.label_counts_from_lines(df).collect()}
    # whole-line strip, then the last field as is (a space after the comma stays)
    assert got == {"normal.": 2, "neptune.": 1, "3": 1, " normal.": 1}
    plan = PR.label_counts_from_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan


def test_learned_vocabularies_drive_tree_indexing(spark):
    import pytest
    from connscore.plans import jobs
    from connscore.plans.roles import L_ROLES, lineitem
    from connscore.session import scratch_path
    li = lineitem(spark, "/root/testdata/sf0.001")
    vocab = PR.learned_vocabularies(li, ["l_linestatus", "l_returnflag"])
    assert vocab == {"l_linestatus": ["F", "O"], "l_returnflag": ["A", "N", "R"]}
    roles = L_ROLES.with_vocabularies({"l_linestatus": vocab["l_linestatus"]})
    model = jobs.tree_train(li, roles, scratch_path(spark, "learned-tree"), "binary", 3)
    assert model.stages[0].labels == ["F", "O"]
    with pytest.raises(ValueError):
        PR.learned_vocabularies(li, ["l_orderkey"], max_values=10)
