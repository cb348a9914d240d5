"""Cross-validated training with Spark ML trees, and what comes out of it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from inspect import signature

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelwise.functions.scalar import nan_to_null
from panelwise.operators.blend import mean_prediction
from panelwise.operators.folds import stratified_folds
from panelwise.operators.metrics import default_metric, threshold_flags
from panelwise.plans.pool import AT_ONCE, side_by_side

FEATURES = "_features"


def _below(low: float | None) -> float:
    return 0.0 if low is None else low - abs(low) - 1.0


def fit_sentinels(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """A value below each column's minimum, to stand for a missing number (one aggregate job)."""
    lows = df.agg(*[F.min(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(features)]).first()
    return {c: _below(lows[i]) for i, c in enumerate(features)}


def fold_sentinels(folded: DataFrame, features: Sequence[str], k: int) -> list[dict[str, float]]:
    """``fit_sentinels`` of each fold's training rows: one aggregate job for all, which never looks at held-out rows."""
    lows = folded.groupBy("fold").agg(*[F.min(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(features)]).collect()
    out = []
    for held_out in range(k):
        known = [[r[1 + i] for r in lows if r["fold"] != held_out and r[1 + i] is not None] for i in range(len(features))]
        out.append({c: _below(min(v, default=None)) for c, v in zip(features, known)})
    return out


def vectorize(df: DataFrame, features: Sequence[str], sentinels: dict[str, float], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and one feature vector; missing numbers become the column's sentinel."""
    filled = df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(sentinels[c])).alias(f"_f_{c}") for c in features])
    assembler = VectorAssembler(inputCols=[f"_f_{c}" for c in features], outputCol=FEATURES)
    return assembler.transform(filled).select(*keep, FEATURES)


@dataclass
class Model:
    """A fitted model with what is needed to score a table of named columns."""

    tree: GBTClassificationModel
    features: list[str]
    sentinels: dict[str, float]


def save_models(spark: SparkSession, models: Sequence[Model], path: str) -> None:
    """Write fold models, and next to them the record of the features each was trained on, with their sentinels."""
    rows = [(i, p, f, float(m.sentinels[f])) for i, m in enumerate(models) for p, f in enumerate(m.features)]
    record = spark.createDataFrame(rows, "fold int, position int, feature string, sentinel double")
    record.write.mode("overwrite").parquet(f"{path}/features")
    for i, m in enumerate(models):
        m.tree.write().overwrite().save(f"{path}/fold_{i}")


def load_models(spark: SparkSession, path: str) -> list[Model]:
    """The fold models of ``save_models``, in another session too (one row per fold and feature is read)."""
    folds: dict[int, list] = {}
    for r in spark.read.parquet(f"{path}/features").orderBy("fold", "position").collect():
        folds.setdefault(r["fold"], []).append((r["feature"], r["sentinel"]))
    return [
        Model(GBTClassificationModel.load(f"{path}/fold_{i}"), [f for f, _ in found], dict(found)) for i, found in sorted(folds.items())
    ]


@dataclass
class CrossValidation:
    oof: DataFrame  # key, target, predicted, predicted_09 ..., fold
    scores: DataFrame  # fold, metric
    importances: DataFrame  # fold, feature, importance
    models: list[Model]
    cached: list[DataFrame]
    stages: DataFrame | None = None  # fold, stage, loss, is_chosen; only with patience

    def release(self) -> None:
        """Free the cached fold predictions; ``oof`` is then computed again if used."""
        for part in self.cached:
            part.unpersist()

    def mean_score(self) -> float:
        return self.scores.agg(F.avg("metric")).first()[0]


def _probability() -> Column:
    return vector_to_array("probability")[1]


def _estimator(target: str, params: dict | None, **fixed) -> GBTClassifier:
    return GBTClassifier(featuresCol=FEATURES, labelCol=target, **{"seed": 42, **(params or {}), **fixed})


def best_stage(losses: Sequence[float], patience: int) -> int:
    """The stage (from 0) of the least loss before ``patience`` stages in a row have brought no lower one."""
    best = 0
    for stage, loss in enumerate(losses):
        if loss < losses[best]:
            best = stage
        elif stage - best >= patience:
            break
    return best


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The ensemble cut after its first ``n`` trees, which boosting would have given if stopped there."""
    context = SparkSession.active().sparkContext
    java, jvm = model._java_obj, context._jvm
    trees = context._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = context._gateway.new_array(jvm.double, n)
    all_trees, all_weights = java.trees(), java.treeWeights()
    for i in range(n):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    cut = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights))
    return cut.setFeaturesCol(model.getFeaturesCol())


@dataclass
class _Fold:
    """One fold's model, its held-out predictions, and the staged losses if there was patience."""

    model: Model
    part: DataFrame
    importances: list[float]
    stages: list[tuple[int, float, int]]


def _fit_fold(
    folded: DataFrame, i: int, features: list[str], sentinels: dict[str, float], target: str, key: str, params: dict | None,
    early_stopping: bool, patience: int | None,
) -> _Fold:
    data = vectorize(folded, features, sentinels, [key, target, "fold"])
    held_out = F.col("fold") == i
    stages = []
    if early_stopping and patience is None:
        flagged = data.withColumn("_held_out", held_out)
        tree = _estimator(target, params, validationIndicatorCol="_held_out").fit(flagged)
    else:
        tree = _estimator(target, params).fit(data.where(~held_out))
    if patience is not None:
        losses = tree.evaluateEachIteration(data.where(held_out))
        best = best_stage(losses, patience)
        stages = [(stage, float(loss), int(stage == best)) for stage, loss in enumerate(losses)]
        tree = first_trees(tree, best + 1)
    part = tree.transform(data.where(held_out)).select(key, target, _probability().alias("predicted"), "fold")
    part.persist()  # four narrow columns, read several times by the score
    part.count()
    found = tree.featureImportances.toArray()
    importances = [*map(float, found), *[0.0] * (len(features) - len(found))]
    return _Fold(Model(tree, features, sentinels), part, importances, stages)


def _folded(df: DataFrame, features: list[str], target: str, key: str, k: int, seed: int | None) -> DataFrame:
    known = nan_to_null(df.select(key, target, *features), features)
    return stratified_folds(known, target, key, k, seed).persist()


def _scores(parts: DataFrame, target: str, key: str, score, by: str, values: Sequence[int]) -> dict[int, float]:
    """The score of every value of ``by``: in one pass if ``score`` can do that, else one by one."""
    if "by" in signature(score).parameters:
        return {r[0]: r[1] for r in score(parts, target, "predicted", key, by=by).collect()}
    return {v: score(parts.where(F.col(by) == v), target, "predicted", key).first()[0] for v in values}


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    k: int = 5,
    params: dict | None = None,
    seed: int | None = None,
    early_stopping: bool = False,
    first_fold_only: bool = False,
    score=default_metric,
    patience: int | None = None,
    at_once: int = AT_ONCE,
) -> CrossValidation:
    """Fit on k-1 folds, predict and score the held-out one, keep models and importances.

    With ``early_stopping`` boosting ends when the held-out fold stops improving (``validationTol`` in
    ``params`` sets by how much). With ``patience`` all stages are fitted and the ensemble is cut at the stage of the
    least held-out log loss before so many stages in a row have brought no lower one. ``score`` is called like
    ``default_metric`` and returns one row whose first column is the score; if it takes ``by``, all folds are scored
    in one pass. ``at_once`` folds are fitted side by side.
    """
    features = list(features)
    folded = _folded(df, features, target, key, k, seed)
    count = 1 if first_fold_only else k
    sentinels = fold_sentinels(folded, features, k)

    def fold(i: int):
        return lambda: _fit_fold(folded, i, features, sentinels[i], target, key, params, early_stopping, patience)

    spark = df.sparkSession
    folds = side_by_side(spark, [fold(i) for i in range(count)], at_once)
    folded.unpersist()
    parts = reduce(DataFrame.unionByName, [f.part for f in folds])
    by_fold = _scores(parts, target, key, score, "fold", range(count))
    stages = [(i, *s) for i, f in enumerate(folds) for s in f.stages]
    return CrossValidation(
        threshold_flags(parts, "predicted"),
        spark.createDataFrame([(i, by_fold.get(i)) for i in range(count)], "fold int, metric double"),
        spark.createDataFrame([(i, n, v) for i, f in enumerate(folds) for n, v in zip(features, f.importances)], "fold int, feature string, importance double"),
        [f.model for f in folds],
        [f.part for f in folds],
        spark.createDataFrame(stages, "fold int, stage int, loss double, is_chosen int") if stages else None,
    )


def predict(df: DataFrame, models: Sequence[Model], key: str, space: str = "prob") -> DataFrame:
    """``(key, prediction_0, prediction_1, ...)``: every model in one pass, no joins.

    Each model sees its own features, with its own values for missing numbers (NULL or NaN).
    """
    every = list(dict.fromkeys(f for m in models for f in m.features))
    out = nan_to_null(df.select(key, *every), every)
    names, vectors = [], {}
    for i, m in enumerate(models):
        seen = (tuple(m.features), tuple(m.sentinels[f] for f in m.features))
        if seen not in vectors:  # models that see the same share a vector
            vectors[seen] = f"_x_{i}"
            filled = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(m.sentinels[f])) for f in m.features])
            out = out.withColumn(vectors[seen], array_to_vector(filled))
        tree = m.tree.copy()
        tree.setFeaturesCol(vectors[seen]).setPredictionCol("").setRawPredictionCol("_raw").setProbabilityCol("probability")
        names.append(f"prediction_{i}")
        # a tree's raw margin is half the log odds
        score = _probability() if space == "prob" else 2 * vector_to_array("_raw")[1]
        out = tree.transform(out).withColumn(names[-1], score).drop("_raw", "probability")
    return out.select(key, *names)


def predict_mean(df: DataFrame, models: Sequence[Model], key: str, space: str = "prob") -> DataFrame:
    """Per-model scores and their mean: of probabilities, or of log odds."""
    each = predict(df, models, key, space)
    return each.withColumn("prediction", mean_prediction(each.columns[1:]))


def rank_importance(importances: DataFrame) -> DataFrame:
    """``(feature, importance)``: mean over folds, largest first."""
    return (
        importances.groupBy("feature")
        .agg(F.avg("importance").alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
    )


def top_features(importances: DataFrame, n: int) -> list[str]:
    """Names of the n most important features."""
    return [r["feature"] for r in rank_importance(importances).limit(n).collect()]


# Search space: name -> (kind, low, high) with kind "int", "float" or "log", or ("choice", [values]).
DEFAULT_SPACE = {
    "maxDepth": ("int", 1, 6),
    "stepSize": ("log", 0.01, 1.0),
    "subsamplingRate": ("float", 0.5, 0.8),
    "minInstancesPerNode": ("int", 1, 50),
}


def _draw(rng: np.random.RandomState, space: dict) -> dict:
    def one(kind, *args):
        if kind == "int":
            return int(rng.randint(args[0], args[1] + 1))
        if kind == "float":
            return float(rng.uniform(*args))
        if kind == "log":
            return float(np.exp(rng.uniform(np.log(args[0]), np.log(args[1]))))
        return args[0][rng.randint(len(args[0]))]

    return {name: one(*spec) for name, spec in space.items()}


def random_search(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    trials: int,
    space: dict | None = None,
    k: int = 5,
    fixed: dict | None = None,
    first_fold_only: bool = True,
    seed: int = 42,
) -> tuple[dict, list[dict]]:
    """Best parameters over seeded random draws, and all trials with their scores.

    Trials and their folds are fitted side by side on one table, and all of them are scored in one pass. A trial that
    fails ends the search.
    """
    rng = np.random.RandomState(seed)
    drawn = [{**(fixed or {}), **_draw(rng, space or DEFAULT_SPACE)} for _ in range(trials)]
    features = list(features)
    folded = _folded(df, features, target, key, k, None)
    sentinels = fold_sentinels(folded, features, k)
    count = 1 if first_fold_only else k

    def fold(t: int, i: int):
        return lambda: _fit_fold(folded, i, features, sentinels[i], target, key, drawn[t], False, None).part

    runs = [(t, i) for t in range(trials) for i in range(count)]
    parts = side_by_side(df.sparkSession, [fold(t, i) for t, i in runs])
    folded.unpersist()
    tagged = reduce(DataFrame.unionByName, [p.withColumn("_run", F.lit(n)) for n, p in enumerate(parts)])
    scores = _scores(tagged, target, key, default_metric, "_run", range(len(runs)))
    for p in parts:
        p.unpersist()
    results = []
    for t in range(trials):
        own = [scores[n] for n, (trial, _) in enumerate(runs) if trial == t and scores.get(n) is not None]
        results.append({"trial": t, "score": sum(own) / len(own) if own else None, "params": drawn[t]})
    best = max(results, key=lambda r: -np.inf if r["score"] is None else r["score"])
    return best["params"], results
