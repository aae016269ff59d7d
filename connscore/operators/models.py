"""Model operators: spark.ml pipelines, fixed-parameter scoring, explanations.

Fitting uses MLlib estimators (logistic regression, one-vs-rest, decision
tree, k-means) inside a ``Pipeline`` together with the feature stages, so
one saved ``PipelineModel`` holds scaler and model and scoring is a single
``transform``.  Models given by literal parameters (weights, a rule tree)
are scored with built-in expressions instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, OneVsRest,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from connscore.functions.vectors import argmax_index, linear_margin, sigmoid
from connscore.operators.features import assembler, scaler
from connscore.operators.labels import category_indexers
from connscore.operators.prepare import Spread, spread_input


# Instances are stacked into blocks of up to this size for the block-based
# solvers (logistic regression, k-means "block"): fewer, larger matrix
# operations per pass; 16 MB per block is small against executor memory.
BLOCK_MB = 16.0


def with_label_classes(df: DataFrame, label_col: str, num_classes: int) -> DataFrame:
    """Attach nominal metadata so classifiers see ``num_classes`` classes."""
    meta = {"ml_attr": {"type": "nominal", "name": label_col,
                        "vals": [str(i) for i in range(num_classes)]}}
    return df.withColumn(label_col, F.col(label_col).cast("double").alias(label_col, metadata=meta))


def logistic_pipeline(feature_cols: Sequence[str], label_col: str = "label",
                      reg_param: float = 0.01, max_iter: int = 20,
                      elastic_net: float = 0.2, family: str = "binomial") -> Pipeline:
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter,
                            regParam=reg_param, elasticNetParam=elastic_net, family=family,
                            maxBlockSizeInMB=BLOCK_MB)
    return Pipeline(stages=[assembler(feature_cols, "raw_features"),
                            scaler("raw_features", "features"), lr])


def one_vs_rest_pipeline(feature_cols: Sequence[str], label_col: str = "label",
                         reg_param: float = 0.01, max_iter: int = 10,
                         elastic_net: float = 0.2, parallelism: int = 1) -> Pipeline:
    """Scaler + one-vs-rest of binary logistic regressions.

    Each binary fit caches its own copy of the features (MLlib derives a
    per-class frame), so ``parallelism`` is also the number of extra copies
    held at once.  One class at a time is the default: every binary fit is
    already distributed over the whole cluster.
    """
    lr = LogisticRegression(maxIter=max_iter, regParam=reg_param, elasticNetParam=elastic_net)
    ovr = OneVsRest(classifier=lr, featuresCol="features", labelCol=label_col,
                    parallelism=parallelism)
    return Pipeline(stages=[assembler(feature_cols, "raw_features"),
                            scaler("raw_features", "features"), ovr])


def tree_pipeline(feature_cols: Sequence[str], vocabularies: Mapping[str, Sequence[str]],
                  label_col: str = "label", max_depth: int = 4, max_bins: int = 100,
                  min_instances: int = 1, impurity: str = "gini") -> Pipeline:
    """Index-code category slots in place, assemble, fit a decision tree.

    Category slots keep nominal metadata (arity = vocabulary + unknown), so
    the tree splits them as categories.  maxBins is raised to the largest
    arity when needed.
    """
    indexers = category_indexers(vocabularies)
    cols = [f"{c}_idx" if c in vocabularies else c for c in feature_cols]
    largest = max([len(v) + 1 for v in vocabularies.values()], default=2)
    dt = DecisionTreeClassifier(featuresCol="features", labelCol=label_col,
                                maxDepth=max_depth, maxBins=max(max_bins, largest),
                                minInstancesPerNode=min_instances, impurity=impurity)
    return Pipeline(stages=[*indexers, assembler(cols, "features"), dt])


def kmeans_pipeline(k: int, feature_cols: Sequence[str] | None = None,
                    seed: int = 1, max_iter: int = 20, scale: bool = True,
                    solver: str = "block") -> Pipeline:
    """Optional assembly (when given scalar columns), scaling, k-means.

    Without ``feature_cols`` the input must carry a vector ``raw_features``.
    Centred features are dense, so the block solver (distances of stacked
    instances by matrix multiplication) is the default; it reaches the same
    clustering as the row solver with fewer per-point operations.
    """
    stages = []
    if feature_cols:
        stages.append(assembler(feature_cols, "raw_features"))
    if scale:
        stages.append(scaler("raw_features", "features"))
        feats = "features"
    else:
        feats = "raw_features"
    stages.append(KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=feats,
                         predictionCol="prediction", solver=solver,
                         maxBlockSizeInMB=BLOCK_MB))
    return Pipeline(stages=stages)


def positive_score(df: DataFrame, probability_col: str = "probability",
                   out_col: str = "score") -> DataFrame:
    """Probability of class 1 as a plain double column."""
    return df.withColumn(out_col, vector_to_array(F.col(probability_col))[1])


# ---- models given by literal parameters --------------------------------------------

def logistic_score_fixed(df: DataFrame, feature_cols: Sequence[str],
                         weights: Sequence[float], intercept: float,
                         threshold: float = 0.5) -> DataFrame:
    """margin = w.x + b; probability = 1/(1+exp(-margin)); prediction p > t."""
    m = linear_margin(feature_cols, weights, intercept)
    return (df.withColumn("margin", m)
              .withColumn("probability", sigmoid(F.col("margin")))
              .withColumn("prediction",
                          F.when(F.col("probability") > F.lit(threshold), F.lit(1.0))
                           .otherwise(F.lit(0.0))))


def ovr_score_fixed(df: DataFrame, feature_cols: Sequence[str],
                    weight_rows: Sequence[Sequence[float]],
                    intercepts: Sequence[float]) -> DataFrame:
    """One binary margin per class; prediction = argmax (ties: lower class)."""
    margins = [linear_margin(feature_cols, w, b) for w, b in zip(weight_rows, intercepts)]
    out = df
    for i, m in enumerate(margins):
        out = out.withColumn(f"margin_{i}", m)
    cols = [F.col(f"margin_{i}") for i in range(len(margins))]
    return (out.withColumn("prediction", argmax_index(cols))
               .withColumn("max_margin", F.greatest(*cols)))


def rule_expression(rule: Mapping[str, Any]) -> Column:
    """Compile a rule tree to nested CASE expressions.

    A node is either ``{"prediction": v}`` or ``{"feature": name,
    "threshold": t, "left": node, "right": node}`` (continuous split,
    ``feature <= t`` goes left) or ``{"feature": name, "categories": [...],
    "left": node, "right": node}`` (category in the set goes left).
    """
    if "prediction" in rule:
        return F.lit(float(rule["prediction"]))
    f = F.col(rule["feature"])
    if "categories" in rule:
        cond = f.isin(list(rule["categories"]))
    else:
        cond = f <= F.lit(float(rule["threshold"]))
    return F.when(cond, rule_expression(rule["left"])).otherwise(rule_expression(rule["right"]))


def tree_rule_score(df: DataFrame, rule: Mapping[str, Any],
                    out_col: str = "prediction") -> DataFrame:
    return df.withColumn(out_col, rule_expression(rule))


def tree_debug_rows(spark: SparkSession, model) -> DataFrame:
    """The fitted tree's explanation, one row per line (size bounded by depth)."""
    tree = model.stages[-1] if isinstance(model, PipelineModel) else model
    lines = tree.toDebugString.splitlines()
    return spark.createDataFrame([(i, line) for i, line in enumerate(lines)],
                                 "line_no int, rule string")


def feature_importances(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    tree = model.stages[-1] if isinstance(model, PipelineModel) else model
    imp = tree.featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)],
                                 "feature string, importance double")


# ---- fitted linear pipelines as column expressions --------------------------------

def _linear_parts(model: PipelineModel):
    """(input cols, mean, scale, coefficients, intercept, threshold) or None.

    Recognises [VectorAssembler, StandardScalerModel, binomial
    LogisticRegressionModel] whose assembler reads scalar columns.
    """
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.feature import StandardScalerModel, VectorAssembler

    st = model.stages
    if (len(st) != 3 or not isinstance(st[0], VectorAssembler)
            or not isinstance(st[1], StandardScalerModel)
            or not isinstance(st[2], LogisticRegressionModel)
            or st[2].numClasses != 2 or st[2].getFamily() == "multinomial"):
        return None
    cols = st[0].getInputCols()
    mean = st[1].mean.toArray() if st[1].getWithMean() else [0.0] * len(cols)
    std = st[1].std.toArray()
    scale = [(0.0 if s == 0 else 1.0 / s) if st[1].getWithStd() else 1.0 for s in std]
    lr = st[2]
    return cols, list(mean), scale, list(lr.coefficients.toArray()), lr.intercept, lr.getThreshold()


def linear_score(model: PipelineModel, df: DataFrame,
                 score_col: str = "score", prediction_col: str = "prediction") -> DataFrame | None:
    """Score a fitted scaler + binomial logistic pipeline with built-in expressions.

    Same arithmetic as the fitted stages ((x - mean) * (1/std), dot product
    in feature order, + intercept, sigmoid, probability > threshold), but
    evaluated inside whole-stage codegen instead of per-row vector UDFs.
    Returns None when the pipeline has another shape (use ``transform``).
    """
    parts = _linear_parts(model)
    if parts is None:
        return None
    cols, mean, scale, coef, intercept, threshold = parts
    scaled = [(F.col(c).cast("double") - F.lit(float(m))) * F.lit(float(s))
              for c, m, s in zip(cols, mean, scale)]
    terms = [x * F.lit(float(w)) for x, w in zip(scaled, coef)]
    margin = terms[0]
    for t in terms[1:]:
        margin = margin + t
    margin = margin + F.lit(float(intercept))
    prob = sigmoid(margin)
    return (df.withColumn(score_col, prob)
              .withColumn(prediction_col,
                          F.when(F.col(score_col) > F.lit(float(threshold)), F.lit(1.0))
                           .otherwise(F.lit(0.0))))


#: Feature name of a class's constant term in a weight table.
INTERCEPT = "(intercept)"


def _ovr_parts(model: PipelineModel):
    """(input cols, weights per class, intercept per class) in units of the raw columns, or None.

    Recognises [VectorAssembler, StandardScalerModel, OneVsRestModel of
    logistic regressions]; the scaler is folded into the weights.
    """
    from pyspark.ml.classification import LogisticRegressionModel, OneVsRestModel
    from pyspark.ml.feature import StandardScalerModel, VectorAssembler

    st = model.stages
    if (len(st) != 3 or not isinstance(st[0], VectorAssembler) or not isinstance(st[1], StandardScalerModel)
            or not isinstance(st[2], OneVsRestModel)
            or not all(isinstance(m, LogisticRegressionModel) for m in st[2].models)):
        return None
    cols = st[0].getInputCols()
    mean = st[1].mean.toArray() if st[1].getWithMean() else [0.0] * len(cols)
    scale = [(0.0 if s == 0 else 1.0 / s) if st[1].getWithStd() else 1.0 for s in st[1].std.toArray()]
    weights, intercepts = [], []
    for m in st[2].models:
        raw = [float(w) * float(f) for w, f in zip(m.coefficients.toArray(), scale)]
        weights.append(raw)
        intercepts.append(float(m.intercept) - sum(w * float(c) for w, c in zip(raw, mean)))
    return cols, weights, intercepts


def one_vs_rest_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(class, position, feature, weight): a fitted one-vs-rest pipeline as a table, a margin a class.

    A class's margin is the sum of weight * column over its rows, its
    ``(intercept)`` row (position -1) taken with 1.  The table has classes x
    (features + 1) rows and can be saved, read and compared like any other.
    """
    parts = _ovr_parts(model)
    if parts is None:
        raise ValueError("not a scaler and one-vs-rest pipeline of logistic regressions")
    cols, weights, intercepts = parts
    rows = [(k, i, c, w) for k, per_class in enumerate(weights) for i, (c, w) in enumerate(zip(cols, per_class))]
    rows += [(k, -1, INTERCEPT, b) for k, b in enumerate(intercepts)]
    return spark.createDataFrame(rows, "class int, position int, feature string, weight double")


def score_one_vs_rest_table(df: DataFrame, table: DataFrame, margins: bool = False) -> DataFrame:
    """``df`` with prediction (largest margin, ties to the lower class) and max_margin from a weight table.

    The table is a model's parameters; it becomes expressions, so rows are
    scored where they lie, in one pass for all classes and inside generated code.
    A row without one of the columns' values has no prediction.
    ``margins`` adds margin_<class>.
    """
    weights: dict[int, dict] = {}
    for r in table.collect():
        weights.setdefault(r["class"], {})[r["position"]] = (r["feature"], r["weight"])
    classes = sorted(weights)
    per_class = []
    for k in classes:
        terms = sorted((p, f, w) for p, (f, w) in weights[k].items() if p >= 0)
        per_class.append(linear_margin([F.col(f"`{f}`") for _, f, _ in terms], [w for _, _, w in terms],
                                       weights[k].get(-1, (INTERCEPT, 0.0))[1]))
    out = df.select("*", *[m.alias(f"__margin_{k}") for k, m in zip(classes, per_class)])
    named = [F.col(f"__margin_{k}") for k in classes]
    best = F.greatest(*named) if len(named) > 1 else named[0]
    prediction = F.lit(None).cast("double")
    for k, m in reversed(list(zip(classes, named))):
        prediction = F.when(m == best, F.lit(float(k))).otherwise(prediction)
    complete = F.lit(True)
    for m in named:
        complete = complete & m.isNotNull()
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.when(complete, prediction).alias("prediction"),
                      F.when(complete, best).alias("max_margin"),
                      *([m.alias(f"margin_{k}") for k, m in zip(classes, named)] if margins else []))


def one_vs_rest_score(model: PipelineModel, df: DataFrame) -> DataFrame | None:
    """A fitted one-vs-rest pipeline scored by expressions; None when the pipeline has another shape."""
    if _ovr_parts(model) is None:
        return None
    return score_one_vs_rest_table(df, one_vs_rest_table(df.sparkSession, model))


def prediction_only(model: PipelineModel) -> PipelineModel:
    """The same pipeline, with a probabilistic classifier told to compute
    only ``prediction`` (no raw-prediction or probability vectors per row)."""
    last = model.stages[-1]
    if hasattr(last, "setProbabilityCol") and hasattr(last, "setRawPredictionCol"):
        last = last.copy()
        last.setRawPredictionCol("")
        last.setProbabilityCol("")
        return PipelineModel(stages=[*model.stages[:-1], last])
    return model


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``prediction`` (and ``score`` for linear models) for every row.

    Binary and one-vs-rest linear pipelines are evaluated as codegen
    expressions; other classifiers compute only the prediction column.
    """
    for fast in (linear_score(model, df), one_vs_rest_score(model, df)):
        if fast is not None:
            return fast
    return prediction_only(model).transform(df)


# ---- fitting with one cached copy of the estimator's input -------------------------

def estimator_columns(est, extra: Sequence[str] = ()) -> list[str]:
    """The columns an estimator reads (features, label, weight) plus extras."""
    cols = [est.getFeaturesCol()]
    for p in ("labelCol", "weightCol"):
        if est.hasParam(p) and est.isDefined(est.getParam(p)):
            v = est.getOrDefault(est.getParam(p))
            if v:
                cols.append(v)
    return list(dict.fromkeys([*cols, *extra]))


def fit_pipeline(pipeline: Pipeline, df: DataFrame, cache_input: bool = True,
                 spread: Spread | None = None) -> PipelineModel:
    """Fit feature stages, then the final estimator on a cached, narrow input.

    Estimators such as logistic regression and k-means cache their own copy
    of any uncached input.  Caching exactly the frame they read (features and
    label, after the feature stages) means one cached copy instead of two.
    Trees bin and cache their input themselves: use ``cache_input=False``.
    A narrow input is spread over the cluster first if the caller says how
    (see ``prepare``).
    """
    from pyspark import StorageLevel

    stages = pipeline.getStages()
    est = stages[-1]
    with spread_input(df, spread) as src:
        prefix = Pipeline(stages=stages[:-1]).fit(src.df)
        feats = prefix.transform(src.df).select(*estimator_columns(est))
        if not cache_input:
            model = est.fit(feats)
        else:
            # the first estimator pass fills the cache; a spread copy (narrow,
            # hence small, inputs only) is dropped when the block exits
            feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                model = est.fit(feats)
            finally:
                feats.unpersist()
    return PipelineModel(stages=[*prefix.stages, model])
