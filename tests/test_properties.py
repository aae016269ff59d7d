"""Property tests: the expression parser against a plain split, metric invariants."""

import math

from hypothesis import given, settings, strategies as st

from connscore.operators import metrics as M
from connscore.schema import CATEGORY, LABEL, NUMERIC, layout
from connscore.sources.records import parse_lines

LAYOUT = layout(("a", NUMERIC), ("kind", CATEGORY), ("b", NUMERIC), ("label", LABEL))

numbers = st.one_of(st.integers(-10**6, 10**6).map(str),
                    st.floats(-1e6, 1e6, allow_nan=False).map(lambda f: f"{f:.4f}"))
tokens = st.one_of(numbers, st.text("abcxyz. ", min_size=0, max_size=6))
lines = st.lists(tokens, min_size=1, max_size=6).map(",".join)


def _expected(line):
    parts = line.split(",")
    bad = len(parts) != 4
    vals = {}
    for i, (name, role) in enumerate(LAYOUT.fields):
        raw = parts[i].strip(" ") if i < len(parts) else None
        if role == NUMERIC:
            try:
                v = float(raw) if raw not in (None, "") else None
            except ValueError:
                v = None
            if v is None or (raw is not None and not _plain_number(raw)):
                bad = True
                v = None
            vals[name] = v
        else:
            vals[name] = raw
    return bad, vals


def _plain_number(s):
    try:
        float(s)
    except ValueError:
        return False
    return all(ch in "+-0123456789.eE" for ch in s)


@settings(max_examples=25, deadline=None)
@given(st.lists(lines, min_size=1, max_size=25))
def test_parse_matches_python_split(spark, batch):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(batch)], "i int, value string")
    got = {r["i"]: r for r in parse_lines(df, LAYOUT, keep_cols=["i"]).collect()}
    for i, line in enumerate(batch):
        bad, vals = _expected(line)
        r = got[i]
        assert r["malformed"] == bad, line
        if not bad:
            assert r["a"] == vals["a"] and r["b"] == vals["b"], line
            assert r["kind"] == vals["kind"] and r["label"] == vals["label"], line


pairs = st.lists(st.tuples(st.sampled_from([0.0, 1.0, 2.0, 3.0]),
                           st.sampled_from([0.0, 1.0, 2.0, 3.0])), min_size=1, max_size=60)


@settings(max_examples=10, deadline=None)
@given(pairs)
def test_metric_invariants(spark, rows):
    df = spark.createDataFrame(rows, "label double, prediction double")
    c = M.collapsed_metrics(df).first()
    assert c.tp + c.tn + c.fp + c.fn == c.n == len(rows)
    assert c.n_mismatch == sum(1 for v, p in rows if v != p)
    if c.precision is not None and c.recall is not None and c.f1 is not None:
        assert min(c.precision, c.recall) - 1e-12 <= c.f1 <= max(c.precision, c.recall) + 1e-12
    per = M.per_class_metrics(df).collect()
    assert sum(r.n_actual for r in per) == len(rows)
    assert sum(r.tp for r in per) == len(rows) - c.n_mismatch
    acc = 1 - c.n_mismatch / len(rows)
    assert math.isclose(c.accuracy, acc, abs_tol=1e-12)
