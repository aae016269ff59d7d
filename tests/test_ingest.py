
import pytest

from conftest import LINE_A, LINE_B, LINE_C, numbers
from connscore.operators.features import numeric_projection
from connscore.schema import CONNECTION_LAYOUT
from connscore.session import scratch_path
from connscore.sources.records import (
    parse_lines, quarantined, read_lines, read_records, to_lines, well_formed,
    write_with_quarantine,
)

NUMERIC = CONNECTION_LAYOUT.numeric


def _write(tmp_path, lines, name="conn.csv"):
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def test_layout_roles():
    assert len(CONNECTION_LAYOUT.names) == 42
    assert len(NUMERIC) == 38
    assert CONNECTION_LAYOUT.categories == ["protocol_type", "service", "flag"]
    assert CONNECTION_LAYOUT.label == "label"


@pytest.mark.parametrize("reader", ["csv", "text"])
def test_raw_label_and_numbers(spark, tmp_path, reader):
    path = _write(tmp_path, [LINE_A, LINE_B, LINE_C])
    if reader == "csv":
        df = read_records(spark, path)
    else:
        df = parse_lines(read_lines(spark, path))
    rows = well_formed(df).collect()
    assert len(rows) == 3
    got = {(r["label"], tuple(r[c] for c in NUMERIC)) for r in rows}
    assert ("normal.", tuple(numbers(LINE_A))) in got
    assert ("neptune.", tuple(numbers(LINE_B))) in got
    # line C differs only by "1" vs "1.00": same numeric vector
    assert numbers(LINE_C) == numbers(LINE_A)


@pytest.mark.parametrize("reader", ["csv", "text"])
def test_malformed_rows_are_quarantined(spark, tmp_path, reader):
    fields = LINE_A.split(",")
    bad_number = ",".join(fields[:4] + ["abc"] + fields[5:])
    short = ",".join(fields[:40] + fields[41:])
    long = ",".join(fields[:41] + ["7", fields[41]])
    path = _write(tmp_path, [LINE_A, bad_number, short, long])
    df = read_records(spark, path) if reader == "csv" else parse_lines(read_lines(spark, path))
    assert well_formed(df).count() == 1
    assert quarantined(df).count() == 3


def test_parse_lines_reasons(spark):
    fields = LINE_A.split(",")
    bad = ",".join(fields[:4] + ["x1"] + fields[5:])
    df = spark.createDataFrame([(LINE_A,), (bad,), ("1,2,3",)], "value string")
    out = parse_lines(df, keep_line=True)
    reasons = {r["value"]: (r["malformed"], r["reason"], r["n_fields"]) for r in out.collect()}
    assert reasons[LINE_A] == (False, None, 42)
    assert reasons[bad] == (True, "bad_number", 42)
    assert reasons["1,2,3"] == (True, "field_count", 3)


def test_to_lines_roundtrip(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, 3.0)], "x long, s string, v double")
    lines = [r["value"] for r in to_lines(df, ["x", "s", "v"]).orderBy("value").collect()]
    assert lines == ["1,a,2.5", "2,,3.0"]


def test_write_with_quarantine_one_pass(spark, tmp_path):
    fields = LINE_A.split(",")
    bad = ",".join(fields[:4] + ["abc"] + fields[5:])
    df = read_records(spark, _write(tmp_path, [LINE_A, LINE_B, bad]))
    out = scratch_path(spark, "quarantine-test")
    write_with_quarantine(df, out)
    back = spark.read.parquet(out)
    counts = {str(r["malformed"]).lower(): r["count"]
              for r in back.groupBy("malformed").count().collect()}
    assert counts == {"false": 2, "true": 1}


def test_numeric_projection_pushdown(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    out = numeric_projection(li, ["l_quantity", "l_tax"], keep=["l_orderkey"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_tax:double>" in plan
    assert out.count() == li.count()


def test_all_string_layout(spark, tmp_path):
    from connscore.schema import CONNECTION_COLUMNS, TEXT, Layout
    all_text = Layout(tuple((c, TEXT) for c in CONNECTION_COLUMNS))
    df = read_records(spark, _write(tmp_path, [LINE_A, LINE_B]), all_text)
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields[:42])
    rows = {r["service"]: r["label"] for r in df.collect()}
    assert rows == {"http": "normal.", "private": "neptune."}


def test_text_round_trip_of_a_whole_table(spark, tmp_path):
    """lineitem -> comma lines on disk -> read_records: the same rows, exactly."""
    from pyspark.sql import functions as F
    from connscore.schema import CATEGORY, LABEL, NUMERIC, layout
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lay = layout(*[(c, NUMERIC) for c in cols], ("l_linestatus", CATEGORY),
                 ("l_returnflag", LABEL))
    out = str(tmp_path / "lines")
    to_lines(li, lay.names).repartition(4).write.text(out)
    back = read_records(spark, out, lay)
    assert quarantined(back).count() == 0
    src = li.select(*[F.col(c).cast("double").alias(c) for c in cols],
                    "l_linestatus", "l_returnflag")
    got = well_formed(back).select(*lay.names)
    assert got.count() == src.count()
    assert got.exceptAll(src).count() == 0 and src.exceptAll(got).count() == 0


def test_line_numbers_over_splits_and_files(spark, tmp_path):
    from connscore.sources.records import read_numbered
    for name, n in (("a.txt", 5000), ("b.txt", 1), ("c.txt", 700)):
        (tmp_path / name).write_text("".join(f"{name} {i + 1} {'x' * (i % 90)}\n" for i in range(n)))
    (tmp_path / "empty.txt").write_text("")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        rows = read_numbered(spark, str(tmp_path)).collect()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == 5701
    assert all(r.value.split()[:2] == [r.file.rsplit("/", 1)[1], str(r.line_no)] for r in rows)


def test_quarantined_lines_name_file_and_line(spark, tmp_path):
    from connscore.sources.records import quarantined, read_numbered_records
    from conftest import LINE_A, LINE_B
    (tmp_path / "log").write_text(f"{LINE_A}\n1,2,3\n{LINE_B}\n{LINE_B.replace('udp', 'udp,x')}\n")
    bad = quarantined(read_numbered_records(spark, str(tmp_path / "log"))).collect()
    assert sorted((r.line_no, r.reason) for r in bad) == [(2, "field_count"), (4, "field_count")]
    assert all(r.file.endswith("/log") for r in bad)


def test_ingest_query_scans_text(spark):
    from connscore.plans.queries import ingest_records
    plan = ingest_records(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" in plan or "FileScan text" in plan
