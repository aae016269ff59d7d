"""Driver queries: every operator run over the supplied parquet tables.

Queries that fit a model are in ``learned`` and ``planted``.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables.  Doubles that an independent SQL engine recomputes are rounded to
6 places (9 where exact inputs put values on 6-place half boundaries; sums
of rounded distances to 3), counts are BIGINT, and every
computed column is aliased to the name the oracle SQL uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connscore.functions.labels import binary_label, clean_label, vocabulary_index
from connscore.operators import clusters as C
from connscore.operators import features as FE
from connscore.operators import labels as LB
from connscore.operators import metrics as M
from connscore.operators import models as MD
from connscore.operators import profile as PR
from connscore.operators.prepare import materialize
from connscore.plans.roles import (
    CONV_LINE_COLUMNS, CONV_LINE_LAYOUT, CUSTOMER_LINE_COLUMNS, CUSTOMER_LINE_LAYOUT, EVENT_CLASSES, EVENT_LINE_COLUMNS,
    EVENT_LINE_LAYOUT, EVENT_NORMAL, EVENT_VALUE_SPLITS, L_KEYS, L_NORMAL,
    L_NUMERIC, LO_CATEGORY_COLUMNS, LO_VOCABULARIES, LOGIT_INTERCEPT,
    LOGIT_WEIGHTS, OVR_INTERCEPTS, OVR_WEIGHTS, STUMP_RULE, embeddings, events,
    lineitem, lineitem_orders_part,
)
from connscore.session import scratch_path
from connscore.sources.cluster_dict import read_cluster_dict, write_cluster_dict
from connscore.sources.records import (
    parse_lines, quarantined, read_numbered_records, read_records, to_lines, well_formed,
)
from connscore.sources.scratch import scratch_folder
from connscore.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

#: Lines of a text file that a query writes to read it again.
LINES_PER_FILE = 100_000


def _r(df: DataFrame, cols, places: int = 6) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), places))
    return df


# ---- ingest -----------------------------------------------------------------------

def _as_text(spark, df, columns, name):
    """A table's rows as comma lines in text files: what the source application reads."""
    path = scratch_folder(spark, name)
    to_lines(df, columns).write.text(path)
    return path


def ingest_records(spark, sf):
    """events as text files -> scan, split, type, quarantine check (S1 P1 P6)."""
    path = _as_text(spark, events(spark, sf), EVENT_LINE_COLUMNS, "event-lines")
    return well_formed(read_records(spark, path, EVENT_LINE_LAYOUT))


def ingest_text_layout(spark, sf):
    """A layout of text and category fields beside numbers, read from files (S3)."""
    path = _as_text(spark, table(spark, sf, "customer"), CUSTOMER_LINE_COLUMNS, "customer-lines")
    return well_formed(read_records(spark, path, CUSTOMER_LINE_LAYOUT))


def quarantine_by_line(spark, sf):
    """Bad lines of text files with file and line number; the files hold conversation lines in order."""
    conv = table(spark, sf, "conversations")
    files = max(4, -(-conv.count() // LINES_PER_FILE))
    # line breaks inside a text would make more lines than rows
    flat = conv.withColumn("text", F.translate("text", "\n\r", "  ")).withColumn(
        "part", F.pmod("conv_id", F.lit(files)))
    path = scratch_folder(spark, "conversation-lines")
    order = ["part", "conv_id", "turn"]
    (to_lines(flat, CONV_LINE_COLUMNS, keep_cols=order).repartition(files, "part").sortWithinPartitions(*order)
     .select("part", "value").write.partitionBy("part").text(path))
    bad = quarantined(read_numbered_records(spark, path, CONV_LINE_LAYOUT))
    return bad.select(F.regexp_extract("file", "/part=([0-9]+)/", 1).cast("long").alias("part"), "line_no",
                      F.col("value").alias("line"), F.col("n_fields").cast("long").alias("n_fields"), "reason")


def numeric_projection(spark, sf):
    return FE.numeric_projection(lineitem(spark, sf), L_NUMERIC, keep=L_KEYS)


def label_clean(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", "p_brand", clean_label("p_brand", "#").alias("brand_clean"))


def binary_label_q(spark, sf):
    ev = events(spark, sf)
    return ev.select("event_id", "event_type",
                     binary_label("event_type", EVENT_NORMAL).alias("label"))


def class_index(spark, sf):
    ev = events(spark, sf)
    return ev.select("event_id", "event_type",
                     vocabulary_index(clean_label("event_type", "."), EVENT_CLASSES)
                     .alias("class_index"))


def category_index(spark, sf):
    """Full record encoding for trees: numerics, category codes, label."""
    lop = lineitem_orders_part(spark, sf)
    coded = LB.index_categories(lop, LO_VOCABULARIES)
    return coded.select(*L_KEYS, *L_NUMERIC,
                        *[f"{c}_idx" for c in LO_VOCABULARIES],
                        binary_label("l_returnflag", L_NORMAL).alias("label"))


def feature_vector(spark, sf):
    v = FE.assemble(lineitem(spark, sf), L_NUMERIC, "features")
    return FE.vector_columns(v, "features", [f"f{i}" for i in range(len(L_NUMERIC))],
                             keep=L_KEYS)


def _conversation_records(spark, sf):
    conv = table(spark, sf, "conversations")
    return parse_lines(to_lines(conv, CONV_LINE_COLUMNS), CONV_LINE_LAYOUT, keep_line=True)


def malformed_filter(spark, sf):
    return well_formed(_conversation_records(spark, sf)).select(*CONV_LINE_LAYOUT.names)


def malformed_quarantine(spark, sf):
    return quarantined(_conversation_records(spark, sf)).select(
        F.col("value").alias("line"), F.col("n_fields").cast("long").alias("n_fields"), "reason")


# ---- profile ----------------------------------------------------------------------

def label_counts(spark, sf):
    return PR.label_counts(events(spark, sf), "event_type")


def label_counts_from_lines(spark, sf):
    """Label counts from comma lines, reading only the last field."""
    return PR.label_counts_from_lines(to_lines(events(spark, sf), EVENT_LINE_COLUMNS))


def top_labels(spark, sf):
    return PR.top_labels(events(spark, sf), "event_type", 3)


def category_vocabulary(spark, sf):
    return PR.category_vocabulary(lineitem_orders_part(spark, sf), LO_CATEGORY_COLUMNS)


def category_cardinality(spark, sf):
    return PR.category_cardinality(lineitem_orders_part(spark, sf), LO_CATEGORY_COLUMNS)


def label_index_by_frequency(spark, sf):
    out = PR.label_index_by_frequency(events(spark, sf), "event_type", "label_idx")
    return out.select("event_id", "event_type", "label_idx")


def vector_index(spark, sf):
    out = FE.vector_index(lineitem(spark, sf), ["l_tax", "l_quantity"], 10, "indexed")
    return FE.vector_columns(out, "indexed", ["tax_idx", "quantity"], keep=L_KEYS)


# ---- clusters on fixed centres (one exemplar per label) ---------------------------

def _exemplar_assignment(spark, sf, reused: bool = False):
    """Nearest exemplar per row (narrow rows: the vectors are dropped).

    When several branches of one query read the assignment (``reused``), it
    is computed once and checkpointed instead of being recomputed per branch.
    """
    emb = embeddings(spark, sf)
    ids, centers = C.collect_centers(C.class_exemplars(emb, "label", "embedding", "vec_id"))
    a = C.assign_nearest(emb.select("vec_id", "embedding", "label"), "embedding", ids, centers)
    a = a.select("vec_id", "label", "prediction", "distance")
    return (materialize(a) if reused else a), len(ids)


def nearest_center_fixed(spark, sf):
    a, _ = _exemplar_assignment(spark, sf)
    return _r(a.select("vec_id", "label", "prediction", "distance"), ["distance"])


def kmeans_cost_fixed(spark, sf):
    a, k = _exemplar_assignment(spark, sf)
    return a.agg(F.lit(k).cast("long").alias("k"),
                 F.round(F.sum(F.round("distance", 6)), 3).alias("cost"))


def cluster_label_counts(spark, sf):
    a, _ = _exemplar_assignment(spark, sf)
    return C.cluster_label_counts(a)


def cluster_majority_label(spark, sf):
    a, _ = _exemplar_assignment(spark, sf)
    return C.cluster_majority(a)


def _pruned_dictionary(a):
    """Majority dictionary without its smallest cluster (fewest rows, lowest id)."""
    smallest = C.cluster_sizes(a).orderBy("size", "prediction").limit(1).select("prediction")
    return C.cluster_majority(a).join(F.broadcast(smallest), "prediction", "left_anti")


def cluster_label_join(spark, sf):
    a, k = _exemplar_assignment(spark, sf, reused=True)
    return C.join_cluster_labels(a, _pruned_dictionary(a), keep=["vec_id"],
                                 max_dictionary_rows=k)


def cluster_uncovered(spark, sf):
    a, k = _exemplar_assignment(spark, sf, reused=True)
    lost = C.uncovered_rows(a, _pruned_dictionary(a), max_dictionary_rows=k)
    return lost.select("vec_id", F.col("label").alias("actual_label"), "prediction")


def cluster_coverage(spark, sf):
    a, _ = _exemplar_assignment(spark, sf)
    return C.cluster_coverage(C.cluster_majority(a))


def cluster_sizes(spark, sf):
    a, _ = _exemplar_assignment(spark, sf)
    return C.cluster_sizes(a)


def cluster_dict_roundtrip(spark, sf):
    a, _ = _exemplar_assignment(spark, sf)
    path = write_cluster_dict(C.cluster_majority(a), scratch_path(spark, "cluster-dict"))
    return read_cluster_dict(spark, path, "prediction INT, label INT")


# ---- metrics ----------------------------------------------------------------------

def _lineitem_pairs(spark, sf):
    li = lineitem(spark, sf)
    return li.select(
        binary_label("l_returnflag", L_NORMAL).alias("label"),
        F.when(F.col("l_discount") > F.lit(0.05), F.lit(1.0)).otherwise(F.lit(0.0))
         .alias("prediction"),
        F.col("l_discount").alias("score"))


def _event_pairs(spark, sf):
    ev = events(spark, sf).select(
        vocabulary_index(clean_label("event_type", "."), EVENT_CLASSES).alias("label"),
        F.col("value").cast("double").alias("value"))
    return Bucketizer(splits=EVENT_VALUE_SPLITS, inputCol="value", outputCol="prediction",
                      handleInvalid="keep").transform(ev)


_PRF = ["precision", "recall", "f1", "error", "accuracy"]


def confusion_binary(spark, sf):
    return M.confusion_counts(_lineitem_pairs(spark, sf), mode="binary")


def prf1_binary(spark, sf):
    return _r(M.binary_metrics(_lineitem_pairs(spark, sf)), _PRF)


def confusion_collapsed(spark, sf):
    return M.confusion_counts(_event_pairs(spark, sf), mode="collapsed")


def prf1_collapsed(spark, sf):
    return _r(M.collapsed_metrics(_event_pairs(spark, sf)), _PRF)


def error_rate(spark, sf):
    return _r(M.error_rate(_event_pairs(spark, sf)), ["error", "accuracy"])


def per_class_prf(spark, sf):
    return _r(M.per_class_metrics(_event_pairs(spark, sf)), ["precision", "recall", "f1"])


def f_by_threshold(spark, sf):
    curve = M.f_measure_by_threshold(_lineitem_pairs(spark, sf), "score")
    return _r(curve, ["precision", "recall", "f_measure"])


def best_f_threshold(spark, sf):
    return _r(M.best_threshold(_lineitem_pairs(spark, sf), "score"), ["f_measure"])


def area_under_roc(spark, sf):
    return _r(M.area_under_roc(_lineitem_pairs(spark, sf), "score"), ["auc"])


# ---- scaler and fixed-parameter scoring -------------------------------------------

def scaler_moments(spark, sf):
    model = FE.fit_scaler(lineitem(spark, sf), L_NUMERIC)
    return _r(FE.scaler_moments(spark, model, L_NUMERIC), ["mean", "std"], 7)


def scaled_features(spark, sf):
    li = lineitem(spark, sf)
    model = FE.fit_scaler(li, L_NUMERIC)
    names = [f"s{i}" for i in range(len(L_NUMERIC))]
    return _r(FE.vector_columns(model.transform(li), "features", names, keep=L_KEYS), names)


def logistic_score_fixed(spark, sf):
    s = MD.logistic_score_fixed(lineitem(spark, sf), L_NUMERIC, LOGIT_WEIGHTS, LOGIT_INTERCEPT)
    return _r(s.select(*L_KEYS, "margin", "probability", "prediction"),
              ["margin", "probability"], 9)


def ovr_argmax_fixed(spark, sf):
    s = MD.ovr_score_fixed(lineitem(spark, sf), L_NUMERIC, OVR_WEIGHTS, OVR_INTERCEPTS)
    return _r(s.select(*L_KEYS, "prediction", "max_margin"), ["max_margin"], 9)


def tree_stump_score(spark, sf):
    li = lineitem(spark, sf)
    s = MD.tree_rule_score(li, STUMP_RULE)
    return s.select(*L_KEYS, binary_label("l_returnflag", L_NORMAL).alias("label"),
                    "prediction")


QUERIES: dict[str, Query] = {
    "ingest_records": ingest_records,
    "ingest_text_layout": ingest_text_layout,
    "quarantine_by_line": quarantine_by_line,
    "numeric_projection": numeric_projection,
    "label_clean": label_clean,
    "binary_label": binary_label_q,
    "class_index": class_index,
    "category_index": category_index,
    "feature_vector": feature_vector,
    "malformed_filter": malformed_filter,
    "malformed_quarantine": malformed_quarantine,
    "label_counts": label_counts,
    "label_counts_from_lines": label_counts_from_lines,
    "top_labels": top_labels,
    "category_vocabulary": category_vocabulary,
    "category_cardinality": category_cardinality,
    "label_index_by_frequency": label_index_by_frequency,
    "vector_index": vector_index,
    "nearest_center_fixed": nearest_center_fixed,
    "kmeans_cost_fixed": kmeans_cost_fixed,
    "cluster_label_counts": cluster_label_counts,
    "cluster_majority_label": cluster_majority_label,
    "cluster_label_join": cluster_label_join,
    "cluster_uncovered": cluster_uncovered,
    "cluster_coverage": cluster_coverage,
    "cluster_sizes": cluster_sizes,
    "cluster_dict_roundtrip": cluster_dict_roundtrip,
    "confusion_binary": confusion_binary,
    "prf1_binary": prf1_binary,
    "confusion_collapsed": confusion_collapsed,
    "prf1_collapsed": prf1_collapsed,
    "error_rate": error_rate,
    "per_class_prf": per_class_prf,
    "f_by_threshold": f_by_threshold,
    "best_f_threshold": best_f_threshold,
    "area_under_roc": area_under_roc,
    "scaler_moments": scaler_moments,
    "scaled_features": scaled_features,
    "logistic_score_fixed": logistic_score_fixed,
    "ovr_argmax_fixed": ovr_argmax_fixed,
    "tree_stump_score": tree_stump_score,
}
