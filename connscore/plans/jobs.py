"""Train and test jobs: fit on one table, save, reload, score another.

Each job is ``*_train(records, roles, path, ...) -> PipelineModel`` (fit and
save) plus ``*_test(spark, records, roles, path, ...) -> DataFrame`` (load,
transform, one aggregate of metrics).  The filesystem is the boundary
between the two phases, so they can run as separate applications.
``records`` is any DataFrame carrying the role columns (e.g. the
well-formed output of ``read_records``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connscore.functions.labels import binary_label, clean_label, vocabulary_index
from connscore.operators import clusters as C
from connscore.operators import metrics as M
from connscore.operators import models as MD
from connscore.operators import profile as PR
from connscore.operators.kmeans_path import kmeans_models
from connscore.operators.prepare import Spread
from connscore.operators.sweeps import k_values, select_best
from connscore.plans.roles import Roles
from connscore.sources.cluster_dict import checked_cluster_dict, read_cluster_dict, write_cluster_dict
from connscore.sources.model_store import load_pipeline, save_model


# Fits persist only the columns they read (features and label), so the
# spread/cache step moves and stores as little as possible.  ``spread`` says
# how a narrow input is dealt first; without it the input's partitions stay.

def _training_rows(df: DataFrame, cols, spread: Spread | None) -> DataFrame:
    """The columns of a fit, of rows that have a label, and what they are dealt by.

    Every classifier job leaves rows without a label out of the fit in this one
    place; ``unlabelled_rows`` counts them.
    """
    keys = [k for k in (spread.keys if spread else ()) if k not in cols and k != "label"]
    return df.filter(F.col("label").isNotNull()).select(*cols, "label", *keys)


def unlabelled_rows(records: DataFrame, roles: Roles) -> DataFrame:
    """(n, n_unlabelled): rows, and those that no fit takes because their label is null."""
    return records.agg(F.count("*").alias("n"), F.count_if(F.col(roles.label).isNull()).alias("n_unlabelled"))

# ---- labels ------------------------------------------------------------------------

def with_binary_target(df: DataFrame, roles: Roles, out_col: str = "label") -> DataFrame:
    lab = clean_label(roles.label, roles.strip_chars) if roles.strip_chars else F.col(roles.label)
    return df.withColumn(out_col, binary_label(lab, roles.normal_token))


def with_class_target(df: DataFrame, roles: Roles, out_col: str = "label") -> DataFrame:
    lab = clean_label(roles.label, roles.strip_chars) if roles.strip_chars else F.col(roles.label)
    return df.withColumn(out_col, vocabulary_index(lab, roles.classes))


# ---- statistics --------------------------------------------------------------------

def statistics(records: DataFrame, roles: Roles) -> DataFrame:
    """Label frequency, highest first (raw label text kept)."""
    return PR.label_counts(records, roles.label)


def statistics_from_lines(spark: SparkSession, path) -> DataFrame:
    """Label frequency of a raw log without parsing its records."""
    from connscore.sources.records import read_lines
    return PR.label_counts_from_lines(read_lines(spark, path))


def categorical_values(records: DataFrame, roles: Roles) -> DataFrame:
    return PR.category_cardinality(records, list(roles.vocabularies))


# ---- binary logistic regression ----------------------------------------------------

def logreg_binary_train(records: DataFrame, roles: Roles, path: str,
                        reg_param: float = 0.01, max_iter: int = 20,
                        spread: Spread | None = None) -> PipelineModel:
    train = with_binary_target(records, roles)
    model = MD.fit_pipeline(MD.logistic_pipeline(list(roles.numeric), reg_param=reg_param,
                                                 max_iter=max_iter),
                            _training_rows(train, roles.numeric, spread), spread=spread)
    save_model(model, path)
    return model


def logreg_binary_test(spark: SparkSession, records: DataFrame, roles: Roles,
                       path: str) -> DataFrame:
    scored = MD.score(load_pipeline(path), with_binary_target(records, roles))
    return M.binary_metrics(scored)


def training_summary(model: PipelineModel, records: DataFrame, roles: Roles) -> DataFrame:
    """Exact AUC and best F-measure of a binary model on its training rows."""
    scored = MD.linear_score(model, with_binary_target(records, roles))
    if scored is None:
        scored = MD.positive_score(model.transform(with_binary_target(records, roles)))
    return M.threshold_summary(scored, "score")


# ---- one-vs-rest logistic regression ----------------------------------------------

def logreg_multiclass_train(records: DataFrame, roles: Roles, path: str,
                            reg_param: float = 0.01, max_iter: int = 10,
                            parallelism: int = 1, spread: Spread | None = None) -> PipelineModel:
    train = with_class_target(records, roles)
    model = MD.fit_pipeline(MD.one_vs_rest_pipeline(list(roles.numeric), reg_param=reg_param,
                                                    max_iter=max_iter, parallelism=parallelism),
                            _training_rows(train, roles.numeric, spread), spread=spread)
    save_model(model, path)
    return model


def logreg_multiclass_test(spark: SparkSession, records: DataFrame, roles: Roles,
                           path: str) -> DataFrame:
    scored = MD.score(load_pipeline(path), with_class_target(records, roles))
    return M.collapsed_metrics(scored)


def logreg_multiclass_table(spark: SparkSession, path: str) -> DataFrame:
    """(class, position, feature, weight) of a saved one-vs-rest model."""
    return MD.one_vs_rest_table(spark, load_pipeline(path))


def multiclass_per_class_test(spark: SparkSession, records: DataFrame, roles: Roles,
                              path: str) -> DataFrame:
    """Per-class precision / recall / F1 of a saved multi-class model
    (one-vs-rest or multiClass tree) on class-index labels."""
    scored = MD.score(load_pipeline(path), with_class_target(records, roles))
    return M.per_class_metrics(scored)


# ---- decision tree ------------------------------------------------------------------

def tree_train(records: DataFrame, roles: Roles, path: str, mode: str = "binary",
               max_depth: int = 4, max_bins: int = 100, spread: Spread | None = None) -> PipelineModel:
    if mode == "binary":
        train = with_binary_target(records, roles)
    elif mode == "multiClass":
        train = MD.with_label_classes(with_class_target(records, roles), "label",
                                      len(roles.classes) + 1)
    else:
        raise ValueError("mode must be 'binary' or 'multiClass'")
    # trees bin and cache their input themselves: spread only, no extra copy
    model = MD.fit_pipeline(MD.tree_pipeline(list(roles.feature_order), roles.vocabularies,
                                             max_depth=max_depth, max_bins=max_bins),
                            _training_rows(train, roles.feature_order, spread), cache_input=False,
                            spread=spread)
    save_model(model, path)
    return model


def tree_test(spark: SparkSession, records: DataFrame, roles: Roles, path: str,
              mode: str = "binary") -> DataFrame:
    target = with_binary_target if mode == "binary" else with_class_target
    scored = MD.score(load_pipeline(path), target(records, roles))
    return M.binary_metrics(scored) if mode == "binary" else M.collapsed_metrics(scored)


# ---- k-means ----------------------------------------------------------------------

def centres_cost(km_model, features: DataFrame) -> float:
    """Sum of squared distances of the rows of ``features`` (the k-means
    model's features column) to the model's final centres."""
    ids, centers = C.model_centers(km_model)
    vectors = features.select(vector_to_array(F.col(km_model.getFeaturesCol())).alias("__f"))
    assigned = C.assign_nearest(vectors, "__f", ids, centers)
    return float(C.clustering_cost(assigned).first()["cost"] or 0.0)


def kmeans_cost(model: PipelineModel, df: DataFrame) -> float:
    """Cost on the model's final centres (not the lagging training summary)."""
    prepared = PipelineModel(stages=model.stages[:-1]).transform(df)
    return centres_cost(model.stages[-1], prepared)


def kmeans_sweep(spark: SparkSession, vectors: DataFrame, ks, seed: int = 1,
                 max_iter: int = 20, feature_cols=None, label_col: str | None = None,
                 spread: Spread | None = None) -> tuple[DataFrame, dict]:
    """One k-means fit per k; (k, cost, silhouette[, f1]) table and the fitted pipelines.

    The scaler is fitted once, the scaled vectors are cached once in blocks, and
    all k are fitted and judged in shared passes over them (``kmeans_path``).  With
    ``label_col`` the clusters are labelled by majority, which gives the collapsed F1.
    """
    models, facts = kmeans_fits(spark, vectors, ks, seed, max_iter, feature_cols, label_col, spread)
    quality = {r["k"]: r for r in facts.groupBy("k").agg(
        F.sum("cost").alias("cost"), (F.sum("inside") / F.sum("n")).alias("silhouette")).collect()}   # a row a k
    rows = [(k, quality[k]["cost"], quality[k]["silhouette"],
             *([cluster_label_metrics(facts, k)["f1"]] if label_col else [])) for k in models]
    schema = "k int, cost double, silhouette double" + (", f1 double" if label_col else "")
    return spark.createDataFrame(rows, schema), models


def kmeans_fits(spark: SparkSession, vectors: DataFrame, ks, seed: int = 1, max_iter: int = 20, feature_cols=None,
                label_col: str | None = None, spread: Spread | None = None) -> tuple[dict, DataFrame]:
    """The fitted pipeline of each k and the facts of their clusters (``kmeans_path.cluster_facts``)."""
    stages = {k: MD.kmeans_pipeline(k, feature_cols, seed=seed, max_iter=max_iter).getStages() for k in ks}
    prefix = Pipeline(stages=next(iter(stages.values()))[:-1]).fit(vectors)
    models, facts = kmeans_models(spark, prefix.transform(spread.apply(vectors) if spread else vectors),
                                  {k: s[-1] for k, s in stages.items()}, label_col)
    return {k: PipelineModel(stages=[*prefix.stages, m]) for k, m in models.items()}, facts


def cluster_label_metrics(facts: DataFrame, k: int):
    """Collapsed metrics of the clusters of one k, labelled by majority (one row)."""
    counts = facts.filter(F.col("k") == k).select("prediction", "label", "n")
    pairs = C.join_cluster_labels(counts, C.majority_of_counts(counts), keep=["n"], max_dictionary_rows=k)
    return M.collapsed_metrics(pairs, "actual_label", "label", weight="n").first()


def kmeans_train(spark: SparkSession, records: DataFrame, roles: Roles, model_path: str,
                 dict_path: str, min_k: int, max_k: int, step: int = 10, choose: str = "cost",
                 spread: Spread | None = None) -> DataFrame:
    """Sweep k, keep the best model, save it and its cluster labels.

    ``choose``: ``cost`` (lowest; falls with k, so it takes a large one), ``silhouette`` or ``f1`` (highest;
    the F1 of normal against the rest after labelling).  Ties go to the smaller k.
    """
    train = _training_rows(with_class_target(records, roles), roles.numeric, spread)
    table, models = kmeans_sweep(spark, train, k_values(min_k, max_k, step),
                                 feature_cols=list(roles.numeric), label_col="label" if choose == "f1" else None,
                                 spread=spread)
    best_k = int(select_best(table, choose).first()["k"])
    best = models[best_k]
    save_model(best, model_path)
    write_cluster_dict(C.cluster_majority(best.transform(train)), dict_path)
    return table


def kmeans_relabel(spark: SparkSession, records: DataFrame, roles: Roles,
                   model_path: str, dict_path: str, counts_path: str | None = None,
                   batch: str = "all") -> DataFrame:
    """Recompute cluster labels from a saved model without refitting.

    With ``counts_path`` only ``records`` are scored: their (cluster, label)
    counts are kept there as ``batch`` (a repeated batch replaces itself), and the
    labels are the majority over the counts of all batches kept so far.
    """
    scored = load_pipeline(model_path).transform(with_class_target(records, roles))
    if counts_path is None:
        dictionary = C.cluster_majority(scored)
    else:
        C.keep_label_counts(scored, counts_path, batch)
        dictionary = C.majority_of_counts(C.kept_label_counts(spark, counts_path))
    write_cluster_dict(dictionary, dict_path)
    return dictionary


def kmeans_test(spark: SparkSession, records: DataFrame, roles: Roles,
                model_path: str, dict_path: str) -> DataFrame:
    """Score rows, map clusters to labels, collapsed normal/attack metrics.

    The dictionary is checked first: one label a cluster, clusters of this
    model only.  ``n_uncovered`` rows fell into a cluster without a label (no
    training row was there) and are in no other figure.
    """
    model = load_pipeline(model_path)
    k = model.stages[-1].getK()
    dictionary = checked_cluster_dict(read_cluster_dict(spark, dict_path), k)
    scored = model.transform(with_class_target(records, roles))
    pairs = C.join_cluster_labels(scored, dictionary, how="left", max_dictionary_rows=k)
    covered = F.col("__covered")
    return M.prf1(M.confusion_counts(pairs, "actual_label", "label", "collapsed", rows=covered,
                                     extra=[F.count_if(~covered).alias("n_uncovered")]))
