"""Column roles: which columns are features, categories and labels.

``CONNECTION_ROLES`` describes the 42-field connection record.  The other
role sets map the same operators onto the driver's parquet tables:

* E  -- ``events``: label ``event_type``, normal token ``view``, classes
  view / click / signup / purchase (so ``error`` is the unknown class).
* L  -- ``lineitem``: numeric quantity, price, discount, tax; category
  ``l_linestatus``; label ``l_returnflag`` with normal token ``N``.
* LO -- lineitem joined with orders and part, adding ``o_orderpriority``
  and ``p_brand`` as categories.
* V  -- ``embeddings``: 64 floats, integer label 0-9.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connscore.schema import (
    ATTACK_NAMES, CATEGORY, CONNECTION_LAYOUT, CONNECTION_VOCABULARIES, LABEL,
    LABEL_STRIP_CHARS, NORMAL_TOKEN, NUMERIC, TEXT, layout,
)
from connscore.sources.tables import table


@dataclass(frozen=True)
class Roles:
    feature_order: tuple[str, ...]          # numeric and category slots, in order
    numeric: tuple[str, ...]
    vocabularies: dict = field(default_factory=dict)   # category col -> vocabulary
    label: str = "label"
    normal_token: str = "normal"
    classes: tuple[str, ...] = ()
    strip_chars: str = "."

    def with_vocabularies(self, vocabularies: dict) -> "Roles":
        """The same roles with other category vocabularies (e.g. learned ones)."""
        return replace(self, vocabularies={k: list(v) for k, v in vocabularies.items()})


CONNECTION_ROLES = Roles(
    feature_order=tuple(n for n in CONNECTION_LAYOUT.names if n != "label"),
    numeric=tuple(CONNECTION_LAYOUT.numeric),
    vocabularies={k: list(v) for k, v in CONNECTION_VOCABULARIES.items()},
    label="label",
    normal_token=NORMAL_TOKEN,
    classes=tuple(ATTACK_NAMES),
    strip_chars=LABEL_STRIP_CHARS,
)

# ---- fixture parameters for the driver tables --------------------------------------
EVENT_NORMAL = "view"
EVENT_CLASSES = ["view", "click", "signup", "purchase"]
# a fixed one-feature "classifier" for events: value bucket -> class
EVENT_VALUE_SPLITS = [float("-inf"), 11.0, 25.0, 45.0, 80.0, float("inf")]

L_KEYS = ["l_orderkey", "l_linenumber"]
L_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
L_NORMAL = "N"
L_CLASSES = ["N", "R", "A"]
L_ROLES = Roles(
    feature_order=("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"),
    numeric=tuple(L_NUMERIC),
    vocabularies={"l_linestatus": ["O", "F"]},
    label="l_returnflag",
    normal_token=L_NORMAL,
    classes=tuple(L_CLASSES),
    strip_chars="",
)
# truncated vocabularies, so that unknown values take the "unknown" code
LO_VOCABULARIES = {
    "l_linestatus": ["O"],
    "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"],
    "p_brand": [f"Brand#{i}" for i in range(1, 21)],
}
LO_CATEGORY_COLUMNS = ["l_returnflag", "l_linestatus", "o_orderpriority", "p_brand"]

# fixed model parameters scored with expressions
LOGIT_WEIGHTS = [0.02, -1e-05, 5.0, -3.0]
LOGIT_INTERCEPT = -0.1
OVR_WEIGHTS = [[0.03, -2e-05, 4.0, 1.0], [-0.01, 1e-05, -6.0, 8.0], [0.0, 0.0, 2.0, -2.0]]
OVR_INTERCEPTS = [-0.5, 0.2, 0.0]
STUMP_RULE = {
    "feature": "l_discount", "threshold": 0.045,
    "left": {"feature": "l_quantity", "threshold": 25.5,
             "left": {"prediction": 0.0}, "right": {"prediction": 1.0}},
    "right": {"feature": "l_tax", "threshold": 0.035,
              "left": {"prediction": 1.0}, "right": {"prediction": 0.0}},
}

# comma-line layouts used to exercise the text ingest on driver tables
EVENT_LINE_LAYOUT = layout(("event_id", NUMERIC), ("kind", CATEGORY), ("user_id", NUMERIC),
                           ("value", NUMERIC), ("label", LABEL))
EVENT_LINE_COLUMNS = ["event_id", "event_type", "user_id", "value", "event_type"]
CONV_LINE_LAYOUT = layout(("conv_id", NUMERIC), ("text", TEXT), ("turn", NUMERIC),
                          ("role", LABEL))
CONV_LINE_COLUMNS = ["conv_id", "text", "turn", "role"]
CUSTOMER_LINE_LAYOUT = layout(("c_custkey", NUMERIC), ("c_name", TEXT), ("c_mktsegment", CATEGORY),
                              ("c_acctbal", NUMERIC), ("label", LABEL))
CUSTOMER_LINE_COLUMNS = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey"]


# ---- table accessors (column-pruned at the scan) -----------------------------------

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *L_KEYS, *L_NUMERIC, "l_returnflag", "l_linestatus")


def lineitem_orders_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L joined with orders (priority) and part (brand).

    Both joins are equi-joins on keys; Catalyst/AQE choose the strategy
    (sort-merge at scale, broadcast only when runtime size is small).
    """
    li = table(spark, sf_dir, "lineitem").select(
        *L_KEYS, "l_partkey", *L_NUMERIC, "l_returnflag", "l_linestatus")
    od = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    pt = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return li.join(od, "l_orderkey").join(pt, "l_partkey")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")
