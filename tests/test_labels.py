from conftest import LINE_A, LINE_B, LINE_C
from connscore.functions.labels import binary_label, clean_label, vocabulary_index
from connscore.operators.labels import index_categories
from connscore.plans import jobs
from connscore.plans.roles import CONNECTION_ROLES
from connscore.schema import ATTACK_NAMES, CONNECTION_VOCABULARIES
from connscore.sources.records import parse_lines, well_formed


def _records(spark, lines):
    return well_formed(parse_lines(spark.createDataFrame([(x,) for x in lines], "value string")))


def test_binary_label_lines(spark):
    df = jobs.with_binary_target(_records(spark, [LINE_A, LINE_B]), CONNECTION_ROLES, "y")
    got = {r["label"]: r["y"] for r in df.collect()}
    assert got == {"normal.": 0.0, "neptune.": 1.0}


def test_class_index_lines(spark):
    df = jobs.with_class_target(_records(spark, [LINE_C, LINE_B]), CONNECTION_ROLES, "y")
    got = {r["label"]: r["y"] for r in df.collect()}
    assert got == {"normal.": 0.0, "neptune.": 10.0}


def test_label_edge_cases(spark):
    df = spark.createDataFrame([("abnormal.",), ("newattack.",), ("a.b.",), (None,)], "s string")
    rows = df.select(
        "s",
        binary_label(clean_label("s"), "normal").alias("b"),
        vocabulary_index(clean_label("s"), ATTACK_NAMES).alias("c"),
        clean_label("s").alias("clean"),
    ).collect()
    got = {r["s"]: (r["b"], r["c"], r["clean"]) for r in rows}
    assert got["abnormal."] == (0.0, 23.0, "abnormal")   # substring rule
    assert got["newattack."] == (1.0, 23.0, "newattack")  # unknown -> class count
    assert got["a.b."][2] == "ab"
    assert got[None] == (None, None, None)


def test_category_codes_with_source_vocabulary(spark):
    recs = _records(spark, [LINE_A, LINE_B])
    coded = index_categories(recs, CONNECTION_VOCABULARIES)
    got = {r["label"]: (r["protocol_type_idx"], r["service_idx"], r["flag_idx"])
           for r in coded.collect()}
    assert got["normal."] == (1.0, 2.0, 10.0)    # tcp, http, SF
    assert got["neptune."] == (2.0, 9.0, 10.0)   # udp, private, SF


def test_unknown_category_gets_vocabulary_size(spark):
    df = spark.createDataFrame([("zzz",), ("http",)], "service string")
    coded = index_categories(df, {"service": CONNECTION_VOCABULARIES["service"]})
    got = {r["service"]: r["service_idx"] for r in coded.collect()}
    assert got == {"zzz": 66.0, "http": 2.0}
    meta = coded.schema["service_idx"].metadata["ml_attr"]
    assert meta["type"] == "nominal"


def test_vocabulary_index_matches_list_position(spark):
    vocab = ["x", "y", "z"]
    df = spark.createDataFrame([(v,) for v in ["z", "x", "q", "y"]], "v string")
    got = {r["v"]: r["i"] for r in df.select("v", vocabulary_index("v", vocab).alias("i")).collect()}
    assert got == {"x": 0.0, "y": 1.0, "z": 2.0, "q": 3.0}
    plan = df.select(vocabulary_index("v", vocab))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
