"""Independent SQL for each SQL-expressible driver query (DuckDB dialect).

Written from the operator definitions, not from the Spark plans: lookups
are joins against VALUES lists, running sums are SQL windows, nearest
centres are brute force over all (row, centre) pairs.  Fitted-model
queries have no entry (their results depend on solver and partitioning).
"""

from __future__ import annotations

from connscore.plans.roles import (
    EVENT_CLASSES, EVENT_NORMAL, EVENT_VALUE_SPLITS, L_NORMAL, L_NUMERIC,
    LO_CATEGORY_COLUMNS, LO_VOCABULARIES, LOGIT_INTERCEPT, LOGIT_WEIGHTS,
    OVR_INTERCEPTS, OVR_WEIGHTS, STUMP_RULE,
)


def _d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _values(vocab) -> str:
    rows = ", ".join(f"('{v}', {i})" for i, v in enumerate(vocab))
    return f"(VALUES {rows})"


def _margin(weights, intercept) -> str:
    terms = [f"(CAST({c} AS DOUBLE) * {_d(w)})" for c, w in zip(L_NUMERIC, weights)]
    acc = terms[0]
    for t in terms[1:]:
        acc = f"({acc} + {t})"
    return f"({acc} + {_d(intercept)})"


def _rule_sql(rule) -> str:
    if "prediction" in rule:
        return _d(rule["prediction"])
    return (f"CASE WHEN {rule['feature']} <= {_d(rule['threshold'])} "
            f"THEN {_rule_sql(rule['left'])} ELSE {_rule_sql(rule['right'])} END")


def _bucket_sql(col: str, splits) -> str:
    inner = [s for s in splits if s not in (float("-inf"), float("inf"))]
    whens = " ".join(f"WHEN {col} < {_d(s)} THEN {float(i)!r}" for i, s in enumerate(inner))
    return f"CAST(CASE {whens} ELSE {float(len(inner))!r} END AS DOUBLE)"


_L_BIN = f"CAST(CASE WHEN contains(l_returnflag, '{L_NORMAL}') THEN 0.0 ELSE 1.0 END AS DOUBLE)"
_E_CLASS = (f"CAST(COALESCE((SELECT v.idx FROM {_values(EVENT_CLASSES)} v(name, idx) "
            f"WHERE v.name = replace(e.event_type, '.', '')), {len(EVENT_CLASSES)}) AS DOUBLE)")

_LOP = """(SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount,
        l.l_tax, l.l_returnflag, l.l_linestatus, o.o_orderpriority, p.p_brand
   FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
   JOIN part p ON l.l_partkey = p.p_partkey)"""

_EVENT_PAIRS = f"""(SELECT {_E_CLASS} AS v, {_bucket_sql('e.value', EVENT_VALUE_SPLITS)} AS p
   FROM events e)"""

_L_PAIRS = f"""(SELECT {_L_BIN} AS v,
        CAST(CASE WHEN l_discount > {_d(0.05)} THEN 1.0 ELSE 0.0 END AS DOUBLE) AS p,
        CAST(l_discount AS DOUBLE) AS score
   FROM lineitem)"""

_CONV = """(SELECT line, string_split(line, ',') AS parts FROM (
     SELECT concat_ws(',', COALESCE(CAST(conv_id AS VARCHAR), ''), COALESCE(text, ''),
                      COALESCE(CAST(turn AS VARCHAR), ''), COALESCE(role, '')) AS line
     FROM conversations))"""
_CONV_BAD = ("(len(parts) <> 4 OR TRY_CAST(trim(parts[1]) AS DOUBLE) IS NULL "
             "OR TRY_CAST(trim(parts[3]) AS DOUBLE) IS NULL)")

# Brute-force twin of the nearest-centre operator: every row against every
# centre (one centre per label, so rows x labels pairs).  The Spark side
# scores each row against the centres carried in the plan, with no join.
_ASSIGNED = """WITH c AS (
  SELECT label AS cid, arg_min(embedding, vec_id) AS center FROM embeddings GROUP BY label),
d AS (
  SELECT e.vec_id, e.label, c.cid,
         list_sum(list_transform(generate_series(1, len(e.embedding)),
           lambda i: (CAST(e.embedding[i] AS DOUBLE) - CAST(c.center[i] AS DOUBLE))
              * (CAST(e.embedding[i] AS DOUBLE) - CAST(c.center[i] AS DOUBLE)))) AS dist
  FROM embeddings e CROSS JOIN c),
a AS (
  SELECT vec_id, label, cid AS prediction, dist AS distance FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cid) AS rn FROM d)
  WHERE rn = 1),
counts AS (SELECT prediction, label, count(*) AS n FROM a GROUP BY prediction, label),
majority AS (
  SELECT prediction, label FROM (
    SELECT *, row_number() OVER (PARTITION BY prediction ORDER BY n DESC, label DESC) AS r
    FROM counts) WHERE r = 1),
sizes AS (SELECT prediction, count(*) AS size FROM a GROUP BY prediction),
pruned AS (
  SELECT * FROM majority WHERE prediction NOT IN (
    SELECT prediction FROM sizes ORDER BY size, prediction LIMIT 1))
"""

_THRESH = f"""WITH s AS (SELECT score, v FROM {_L_PAIRS}),
g AS (SELECT score AS threshold, count_if(v > 0.5) AS pos, count_if(v <= 0.5) AS neg
      FROM s GROUP BY score),
c AS (SELECT threshold, pos, neg,
        sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
        sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
        sum(pos) OVER () AS total_pos, sum(neg) OVER () AS total_neg
      FROM g),
m AS (SELECT threshold, pos, neg, tp, fp, total_pos, total_neg,
        CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
        CAST(tp AS DOUBLE) / CAST(total_pos AS DOUBLE) AS recall
      FROM c),
f AS (SELECT *, 2.0 * precision * recall / (precision + recall) AS f_measure FROM m)
"""


def _prf(counts_sql: str) -> str:
    return f"""WITH c AS ({counts_sql})
SELECT tp, tn, fp, fn, n, n_mismatch,
  round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
  round(CAST(tp AS DOUBLE) / (tp + fn), 6) AS recall,
  round(2.0 * (CAST(tp AS DOUBLE) / (tp + fp)) * (CAST(tp AS DOUBLE) / (tp + fn))
        / ((CAST(tp AS DOUBLE) / (tp + fp)) + (CAST(tp AS DOUBLE) / (tp + fn))), 6) AS f1,
  round(CAST(n_mismatch AS DOUBLE) / n, 6) AS error,
  round(1.0 - CAST(n_mismatch AS DOUBLE) / n, 6) AS accuracy
FROM c"""


def _counts(pairs: str, pos: str) -> str:
    v_pos, p_pos = pos.format(x="v"), pos.format(x="p")
    return f"""SELECT
  CAST(count_if({v_pos} AND {p_pos}) AS BIGINT) AS tp,
  CAST(count_if(v = 0 AND p = 0) AS BIGINT) AS tn,
  CAST(count_if(v = 0 AND {p_pos}) AS BIGINT) AS fp,
  CAST(count_if({v_pos} AND p = 0) AS BIGINT) AS fn,
  CAST(count(*) AS BIGINT) AS n,
  CAST(count_if(v <> p) AS BIGINT) AS n_mismatch
FROM {pairs}"""


_BIN_COUNTS = _counts(_L_PAIRS, "{x} = 1")
_COL_COUNTS = _counts(_EVENT_PAIRS, "{x} >= 1")


def _vocab_union() -> str:
    parts = [f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM lop"
             for c in LO_CATEGORY_COLUMNS]
    return " UNION ".join(parts)


def _moments() -> str:
    parts = [f"SELECT '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS mean, "
             f"stddev_samp(CAST({c} AS DOUBLE)) AS std FROM lineitem" for c in L_NUMERIC]
    return " UNION ALL ".join(parts)


def _scaled() -> str:
    cols = []
    for i, c in enumerate(L_NUMERIC):
        cols.append(
            f"round(CASE WHEN m{i}.std = 0 THEN 0.0 ELSE (CAST(l.{c} AS DOUBLE) - m{i}.mean)"
            f" * (1.0 / m{i}.std) END, 6) AS s{i}")
    joins = " ".join(f"JOIN m m{i} ON m{i}.feature = '{c}'" for i, c in enumerate(L_NUMERIC))
    return (f"WITH m AS ({_moments()}) SELECT l.l_orderkey, l.l_linenumber, "
            f"{', '.join(cols)} FROM lineitem l {joins}")


def _ovr() -> str:
    ms = [_margin(w, b) for w, b in zip(OVR_WEIGHTS, OVR_INTERCEPTS)]
    return f"""SELECT l_orderkey, l_linenumber,
  CAST(CASE WHEN m0 >= m1 AND m0 >= m2 THEN 0.0 WHEN m1 >= m2 THEN 1.0 ELSE 2.0 END AS DOUBLE)
    AS prediction,
  round(greatest(m0, m1, m2), 9) AS max_margin
FROM (SELECT l_orderkey, l_linenumber, {ms[0]} AS m0, {ms[1]} AS m1, {ms[2]} AS m2
      FROM lineitem)"""


def _category_index() -> str:
    codes = []
    joins = []
    for i, (c, vocab) in enumerate(LO_VOCABULARIES.items()):
        joins.append(f"LEFT JOIN {_values(vocab)} v{i}(name, idx) ON lop.{c} = v{i}.name")
        codes.append(f"CAST(COALESCE(v{i}.idx, {len(vocab)}) AS DOUBLE) AS {c}_idx")
    nums = ", ".join(f"CAST(lop.{c} AS DOUBLE) AS {c}" for c in L_NUMERIC)
    return (f"SELECT lop.l_orderkey, lop.l_linenumber, {nums}, {', '.join(codes)}, "
            f"CAST(CASE WHEN contains(lop.l_returnflag, '{L_NORMAL}') THEN 0.0 ELSE 1.0 END "
            f"AS DOUBLE) AS label FROM {_LOP} lop {' '.join(joins)}")


ORACLE_SQL: dict[str, str] = {
    "ingest_records": """SELECT CAST(event_id AS DOUBLE) AS event_id, trim(event_type) AS kind,
  CAST(user_id AS DOUBLE) AS user_id, CAST(value AS DOUBLE) AS value,
  trim(event_type) AS label FROM events""",
    "ingest_text_layout": """SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, trim(c_name) AS c_name,
  trim(c_mktsegment) AS c_mktsegment, CAST(c_acctbal AS DOUBLE) AS c_acctbal,
  CAST(c_nationkey AS VARCHAR) AS label FROM customer WHERE NOT contains(c_name, ',')""",
    "quarantine_by_line": f"""WITH l AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY conv_id, turn) AS line_no,
         concat_ws(',', COALESCE(CAST(conv_id AS VARCHAR), ''), COALESCE(translate(text, chr(10) || chr(13), '  '), ''),
                   COALESCE(CAST(turn AS VARCHAR), ''), COALESCE(role, '')) AS line
  FROM (SELECT *, conv_id % greatest(4, (SELECT (count(*) + 99999) // 100000 FROM conversations)) AS part
        FROM conversations)),
p AS (SELECT part, line_no, line, string_split(line, ',') AS parts FROM l)
SELECT part, line_no, line, CAST(len(parts) AS BIGINT) AS n_fields,
  CASE WHEN len(parts) <> 4 THEN 'field_count' ELSE 'bad_number' END AS reason
FROM p WHERE {_CONV_BAD}""",
    "numeric_projection": "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" for c in L_NUMERIC) + " FROM lineitem",
    "label_clean": "SELECT p_partkey, p_brand, replace(p_brand, '#', '') AS brand_clean FROM part",
    "binary_label": f"""SELECT event_id, event_type,
  CAST(CASE WHEN contains(event_type, '{EVENT_NORMAL}') THEN 0.0 ELSE 1.0 END AS DOUBLE) AS label
FROM events""",
    "class_index": f"SELECT e.event_id, e.event_type, {_E_CLASS} AS class_index FROM events e",
    "category_index": _category_index(),
    "feature_vector": "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(L_NUMERIC)) + " FROM lineitem",
    "malformed_filter": f"""SELECT TRY_CAST(trim(parts[1]) AS DOUBLE) AS conv_id,
  trim(parts[2]) AS text, TRY_CAST(trim(parts[3]) AS DOUBLE) AS turn, trim(parts[4]) AS role
FROM {_CONV} WHERE NOT {_CONV_BAD}""",
    "malformed_quarantine": f"""SELECT line, CAST(len(parts) AS BIGINT) AS n_fields,
  CASE WHEN len(parts) <> 4 THEN 'field_count' ELSE 'bad_number' END AS reason
FROM {_CONV} WHERE {_CONV_BAD}""",
    "label_counts": """SELECT trim(event_type) AS label, count(*) AS n FROM events
GROUP BY trim(event_type) ORDER BY n DESC, label""",
    "label_counts_from_lines": """SELECT event_type AS label, count(*) AS n FROM events
GROUP BY event_type ORDER BY n DESC, label""",
    "top_labels": """SELECT trim(event_type) AS label, count(*) AS n FROM events
GROUP BY trim(event_type) ORDER BY n DESC, label LIMIT 3""",
    "category_vocabulary": f"""WITH lop AS {_LOP}, d AS ({_vocab_union()})
SELECT column_name, value,
  CAST(row_number() OVER (PARTITION BY column_name ORDER BY value NULLS LAST) - 1 AS BIGINT)
    AS value_idx
FROM d""",
    "category_cardinality": f"""WITH lop AS {_LOP}, d AS ({_vocab_union()})
SELECT column_name, count(*) AS n_values,
  string_agg(value, '","' ORDER BY value) AS values_joined
FROM d GROUP BY column_name""",
    "label_index_by_frequency": """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
r AS (SELECT event_type, row_number() OVER (ORDER BY n DESC, event_type) - 1 AS idx FROM c)
SELECT e.event_id, e.event_type, CAST(r.idx AS DOUBLE) AS label_idx
FROM events e JOIN r ON e.event_type = r.event_type""",
    "vector_index": """SELECT l_orderkey, l_linenumber,
  CAST(dense_rank() OVER (ORDER BY l_tax) - 1 AS DOUBLE) AS tax_idx,
  CAST(l_quantity AS DOUBLE) AS quantity
FROM lineitem""",
    "nearest_center_fixed": _ASSIGNED + """SELECT vec_id, label, prediction,
  round(distance, 6) AS distance FROM a""",
    "kmeans_cost_fixed": _ASSIGNED + """SELECT (SELECT count(*) FROM c) AS k,
  round(sum(round(distance, 6)), 3) AS cost FROM a""",
    "cluster_label_counts": _ASSIGNED + "SELECT prediction, label, n FROM counts",
    "cluster_majority_label": _ASSIGNED + "SELECT prediction, label FROM majority",
    "cluster_label_join": _ASSIGNED + """SELECT a.vec_id, a.label AS actual_label, p.label AS label
FROM a JOIN pruned p ON a.prediction = p.prediction""",
    "cluster_uncovered": _ASSIGNED + """SELECT a.vec_id, a.label AS actual_label, a.prediction
FROM a WHERE a.prediction NOT IN (SELECT prediction FROM pruned)""",
    "cluster_coverage": _ASSIGNED + """SELECT label, count(*) AS n_clusters
FROM majority GROUP BY label""",
    "cluster_sizes": _ASSIGNED + "SELECT prediction, size FROM sizes",
    "cluster_dict_roundtrip": _ASSIGNED + "SELECT prediction, label FROM majority",
    "confusion_binary": _BIN_COUNTS,
    "prf1_binary": _prf(_BIN_COUNTS),
    "confusion_collapsed": _COL_COUNTS,
    "prf1_collapsed": _prf(_COL_COUNTS),
    "error_rate": f"""SELECT CAST(count(*) AS BIGINT) AS n,
  CAST(count_if(v <> p) AS BIGINT) AS n_mismatch,
  round(CAST(count_if(v <> p) AS DOUBLE) / count(*), 6) AS error,
  round(1.0 - CAST(count_if(v <> p) AS DOUBLE) / count(*), 6) AS accuracy
FROM {_EVENT_PAIRS}""",
    "per_class_prf": f"""WITH pr AS {_EVENT_PAIRS},
e AS (SELECT v AS cls, 1 AS a, 0 AS pp, CASE WHEN v = p THEN 1 ELSE 0 END AS h FROM pr
      UNION ALL SELECT p AS cls, 0 AS a, 1 AS pp, 0 AS h FROM pr),
g AS (SELECT cls, CAST(sum(a) AS BIGINT) AS n_actual, CAST(sum(pp) AS BIGINT) AS n_predicted,
        CAST(sum(h) AS BIGINT) AS tp FROM e GROUP BY cls)
SELECT cls, n_actual, n_predicted, tp,
  round(CAST(tp AS DOUBLE) / n_predicted, 6) AS precision,
  round(CAST(tp AS DOUBLE) / n_actual, 6) AS recall,
  round(2.0 * (CAST(tp AS DOUBLE) / n_predicted) * (CAST(tp AS DOUBLE) / n_actual)
        / ((CAST(tp AS DOUBLE) / n_predicted) + (CAST(tp AS DOUBLE) / n_actual)), 6) AS f1
FROM g""",
    "f_by_threshold": _THRESH + """SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f_measure, 6) AS f_measure FROM f""",
    "best_f_threshold": _THRESH + """SELECT threshold, round(f_measure, 6) AS f_measure
FROM f ORDER BY f_measure DESC, threshold DESC LIMIT 1""",
    "area_under_roc": _THRESH + """SELECT CAST(max(total_pos) AS BIGINT) AS n_pos,
  CAST(max(total_neg) AS BIGINT) AS n_neg,
  round(sum(CAST(pos AS DOUBLE) * ((total_neg - fp) + neg / 2.0))
        / (CAST(max(total_pos) AS DOUBLE) * max(total_neg)), 6) AS auc
FROM f""",
    "scaler_moments": f"SELECT feature, round(mean, 7) AS mean, round(std, 7) AS std "
                      f"FROM ({_moments()})",
    "scaled_features": _scaled(),
    "logistic_score_fixed": f"""SELECT l_orderkey, l_linenumber, round(margin, 9) AS margin,
  round(probability, 9) AS probability,
  CAST(CASE WHEN probability > 0.5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction
FROM (SELECT l_orderkey, l_linenumber, margin, 1.0 / (1.0 + exp(-margin)) AS probability
      FROM (SELECT l_orderkey, l_linenumber,
              {_margin(LOGIT_WEIGHTS, LOGIT_INTERCEPT)} AS margin FROM lineitem))""",
    "ovr_argmax_fixed": _ovr(),
    # a saved and reloaded model must reproduce every prediction exactly
    "model_roundtrip": """SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_prediction_diff,
  CAST(0.0 AS DOUBLE) AS max_probability_diff FROM lineitem""",
    "tree_stump_score": f"""SELECT l_orderkey, l_linenumber, {_L_BIN} AS label,
  {_rule_sql(STUMP_RULE)} AS prediction FROM lineitem""",
}
