import os

from connscore.plans import jobs
from connscore.plans.roles import L_ROLES, lineitem
from connscore.schema import CATEGORY, LABEL, NUMERIC, layout
from connscore.session import scratch_path
from connscore.sources.model_store import load_pipeline
from connscore.sources.records import parse_lines, to_lines, well_formed
from connscore.streaming import (
    record_stream, running_metrics, scored_stream, start_metrics, start_quarantine,
)

SF0001 = "/root/testdata/sf0.001"
L_LINE = layout(("l_orderkey", NUMERIC), ("l_linenumber", NUMERIC), ("l_quantity", NUMERIC),
                ("l_extendedprice", NUMERIC), ("l_discount", NUMERIC), ("l_tax", NUMERIC),
                ("l_linestatus", CATEGORY), ("l_returnflag", LABEL))


def test_stream_scoring_matches_batch(spark, tmp_path):
    li = lineitem(spark, SF0001)
    model_path = scratch_path(spark, "stream-lr")
    jobs.logreg_binary_train(li, L_ROLES, model_path, max_iter=5)

    # land the table as comma-separated files, plus one malformed file
    src = str(tmp_path / "landing")
    to_lines(li, L_LINE.names).repartition(3).write.text(src)
    with open(os.path.join(src, "part-bad.txt"), "w") as fh:
        fh.write("1,2,x,4,5,6,O,N\n1,2,3\n")

    records = record_stream(spark, src, L_LINE, max_files_per_trigger=2)
    scored = scored_stream(records, model_path,
                           prepare=lambda d: jobs.with_binary_target(d, L_ROLES))
    q = start_metrics(running_metrics(scored), "stream_metrics_test",
                      scratch_path(spark, "ckpt-metrics"))
    qq = start_quarantine(records, str(tmp_path / "quarantine"), scratch_path(spark, "ckpt-quarantine"))
    try:
        q.processAllAvailable()
        qq.processAllAvailable()
    finally:
        q.stop()
        qq.stop()
    got = spark.sql("SELECT * FROM stream_metrics_test").first()

    batch_records = well_formed(parse_lines(spark.read.text(src), L_LINE))
    batch = jobs.logreg_binary_test(spark, batch_records, L_ROLES, model_path).first()
    assert (got.tp, got.tn, got.fp, got.fn, got.n) == (batch.tp, batch.tn, batch.fp, batch.fn, batch.n)
    assert got.n == li.count()
    bad = spark.read.parquet(str(tmp_path / "quarantine"))
    assert sorted(r.reason for r in bad.collect()) == ["bad_number", "field_count"]


def test_stream_restarts_from_checkpoint(spark, tmp_path):
    """A stopped query resumes from its checkpoint: no file is counted twice."""
    li = lineitem(spark, SF0001)
    model_path = scratch_path(spark, "stream-lr-restart")
    jobs.logreg_binary_train(li, L_ROLES, model_path, max_iter=3)
    src = str(tmp_path / "landing")
    lines = to_lines(li, L_LINE.names)
    lines.limit(2000).coalesce(1).write.text(src + "/batch1")
    ckpt = scratch_path(spark, "ckpt-restart")

    def run():
        recs = record_stream(spark, src + "/*", L_LINE)
        scored = scored_stream(recs, model_path,
                               prepare=lambda d: jobs.with_binary_target(d, L_ROLES))
        q = start_metrics(running_metrics(scored), "restart_metrics", checkpoint=ckpt)
        q.processAllAvailable()
        q.stop()
        return spark.sql("SELECT n FROM restart_metrics").first().n

    assert run() == 2000
    lines.coalesce(1).write.text(src + "/batch2")
    assert run() == 2000 + li.count()


def test_scored_rows_sink_matches_batch(spark, tmp_path):
    from connscore.streaming import start_scored_sink
    li = lineitem(spark, SF0001)
    model_path = scratch_path(spark, "stream-lr-sink")
    jobs.logreg_binary_train(li, L_ROLES, model_path, max_iter=3)
    src = str(tmp_path / "landing")
    to_lines(li, L_LINE.names).repartition(2).write.text(src)
    recs = record_stream(spark, src, L_LINE)
    scored = scored_stream(recs, model_path,
                           prepare=lambda d: jobs.with_binary_target(d, L_ROLES))
    out = str(tmp_path / "scored")
    q = start_scored_sink(scored, out, ["l_orderkey", "l_linenumber", "label", "prediction"],
                          scratch_path(spark, "ckpt-scored"), trigger_once=True)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == li.count()
    batch = load_pipeline(model_path).transform(
        jobs.with_binary_target(well_formed(parse_lines(spark.read.text(src), L_LINE)), L_ROLES)
    ).select("l_orderkey", "l_linenumber", "label", "prediction")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_restarted_quarantine_keeps_new_bad_lines(spark, tmp_path):
    src, out = tmp_path / "landing", str(tmp_path / "quarantine")
    src.mkdir()
    ckpt = scratch_path(spark, "ckpt-quarantine-restart")
    for name, lines in (("a.txt", "1,2,x,4,5,6,O,N\n1,2,3\n"), ("b.txt", "1,2\n1,2,8d,4,5,6,O,N\n")):
        (src / name).write_text(lines)
        start_quarantine(record_stream(spark, str(src), L_LINE), out, ckpt,
                         trigger_once=True).awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == [
        "1,2", "1,2,3", "1,2,8d,4,5,6,O,N", "1,2,x,4,5,6,O,N"]
