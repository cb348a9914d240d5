"""Training, scoring and selection queries on Spark ML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.operators import cv, drift, families as fam, selection
from panelwise.sources import tables
from panelwise.sources.workdir import fresh_folder
from workload.fixtures import STATEMENTS, by_split, scored, statements

KEY = "o_custkey"
TREES = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.2}
PATIENCE = 3
DRIFT = 0.55


def features(spark: SparkSession, sf_dir: str, panel: DataFrame | None = None) -> DataFrame:
    """Seventeen features per customer: means and last values, and all statistics of the gaps between orders."""
    return fam.build(
        statements(spark, sf_dir) if panel is None else panel,
        STATEMENTS,
        [("basic_stat", {"stats": ("mean", "last"), "categorical_stats": ()}), "date_gaps"],
    )


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a feature table once; training reads it many times."""
    path = fresh_folder(df.sparkSession, purpose)
    tables.write_wide(df, path)
    return tables.read_panel(df.sparkSession, path)


def training_table(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    table = features(spark, sf_dir)
    labels = scored(spark, sf_dir).select(F.col("key").alias(KEY), "target")
    names = [c for c in table.columns if c != KEY]
    return _stored(tables.attach_labels(table, labels, KEY, "inner"), "train"), names


def _validated(spark, sf_dir, k=3, params=None, **options) -> cv.CrossValidation:
    table, names = training_table(spark, sf_dir)
    return cv.cross_validate(table, names, "target", KEY, k, params or TREES, **options)


def cv_oof(spark, sf_dir):
    """Out-of-fold predictions of all folds, written by fold and read back."""
    path = fresh_folder(spark, "oof")
    tables.write_oof(_validated(spark, sf_dir).oof, path)
    return spark.read.parquet(path)


def cv_coverage(spark, sf_dir):
    """Every training row is predicted once, by the model that did not see its fold."""
    oof = _validated(spark, sf_dir, k=5).oof
    inside = F.col("predicted").between(0, 1).cast("int")
    flags = [(F.col(f"predicted_0{d}") == (F.col("predicted") > d / 10).cast("int")).cast("int").alias(f"flag_0{d}_follows") for d in (9, 8, 7, 6, 5)]
    return oof.select(KEY, "target", "fold", inside.alias("is_probability"), *flags)


def cv_scores(spark, sf_dir):
    return _validated(spark, sf_dir).scores


def cv_early_stopping(spark, sf_dir):
    return _validated(spark, sf_dir, early_stopping=True).scores


def feature_importance(spark, sf_dir):
    """Mean importance over folds, written as CSV and read back."""
    path = fresh_folder(spark, "importance")
    tables.write_importance(cv.rank_importance(_validated(spark, sf_dir).importances), path)
    return spark.read.schema("feature string, importance double").option("header", True).csv(path)


def importance_by_fold(spark, sf_dir):
    """Importances stored fold by fold and read back: how many features each fold has, and whether they sum to one."""
    path = fresh_folder(spark, "importances")
    tables.write_fold_importances(_validated(spark, sf_dir).importances, path)
    back = spark.read.schema("feature string, importance double, fold int").option("header", True).csv(path)
    whole = (F.abs(F.sum("importance") - 1) < 1e-9) & (F.min("importance") >= 0)
    return back.groupBy("fold").agg(F.count("feature").alias("features"), whole.cast("int").alias("sums_to_one"))


def cv_stages(spark, sf_dir):
    """Staged losses of each fold: how many, and whether the chosen stage is the least before patience ran out."""
    stages = _validated(spark, sf_dir, params={**TREES, "maxIter": 10, "stepSize": 0.6}, patience=PATIENCE).stages
    listed = stages.groupBy("fold").agg(
        F.sort_array(F.collect_list(F.struct("stage", "loss"))).alias("s"), F.max(F.when(F.col("is_chosen") == 1, F.col("stage"))).alias("chosen")
    )
    # a stage may be chosen if it beats all before it, and no earlier stage has gone so long without being beaten
    lower = "aggregate(slice(s, 1, {n}), DOUBLE('inf'), (a, x) -> least(a, x.loss))"
    right = (
        f"forall(s, x -> x.stage > chosen + {PATIENCE} OR x.loss >= s[chosen].loss) AND s[chosen].loss < {lower.format(n='chosen')}"
        f" AND forall(s, x -> x.stage + {PATIENCE} >= chosen OR {lower.format(n=f'x.stage + 1 + {PATIENCE}')} < {lower.format(n='x.stage + 1')})"
    )
    return listed.select("fold", F.size("s").alias("stages"), F.expr(f"CAST({right} AS INT)").alias("is_best"))


def predict_mixed(spark, sf_dir):
    """Models of different features asked together, for rows with NaN: the same as each of them alone."""
    table, names = training_table(spark, sf_dir)
    holes = table.withColumns({c: F.when(F.col(KEY) % 5 == 0, F.lit(float("nan"))).otherwise(F.col(c)) for c in ("qty_mean", "avg_tax_last")})
    models = [cv.cross_validate(holes, chosen, "target", KEY, 2, TREES, first_fold_only=True).models[0] for chosen in (names, names[:4][::-1])]
    both = cv.predict(holes, models, KEY)
    for i, m in enumerate(models):
        both = both.join(cv.predict(holes, [m], KEY).withColumnRenamed("prediction_0", f"alone_{i}"), KEY)
    same = (F.col("prediction_0") == F.col("alone_0")) & (F.col("prediction_1") == F.col("alone_1"))
    return both.select(KEY, same.cast("int").alias("is_same"))


def top_features(spark, sf_dir):
    """The five most important features as a feature group, and the table reduced to them."""
    table, names = training_table(spark, sf_dir)
    fitted = cv.cross_validate(table, names, "target", KEY, 3, TREES)
    chosen = cv.top_features(fitted.importances, 5)
    fitted.release()
    return table.select(KEY, F.create_map(*[x for c in chosen for x in (F.lit(c), F.col(c).cast("double"))]).alias("chosen")).select(
        KEY, F.explode("chosen").alias("feature", "value")
    )


def fold_mean_predict(spark, sf_dir):
    """Models of three folds trained on one population and averaged on the other."""
    parts = by_split(spark, sf_dir, statements(spark, sf_dir))
    labels = scored(spark, sf_dir).select(F.col("key").alias(KEY), "target")
    train = _stored(tables.attach_labels(features(spark, sf_dir, parts["train"]), labels, KEY, "inner"), "train")
    names = [c for c in train.columns if c not in (KEY, "target")]
    fitted = cv.cross_validate(train, names, "target", KEY, 3, TREES)
    test = features(spark, sf_dir, parts["test"])
    prob = cv.predict_mean(test, fitted.models, KEY)
    odds = cv.predict_mean(test, fitted.models, KEY, "logodds").select(KEY, F.col("prediction").alias("mean_log_odds"))
    return prob.join(odds, KEY)


def saved_models(spark, sf_dir):
    """Models written, read again and asked for every customer: the same scores as from memory, fold by fold."""
    table, names = training_table(spark, sf_dir)
    fitted = cv.cross_validate(table, names, "target", KEY, 2, TREES)
    path = fresh_folder(spark, "models")
    cv.save_models(spark, fitted.models, path)
    before = cv.predict(table, fitted.models, KEY)
    after = cv.predict_mean(table, cv.load_models(spark, path), KEY)
    both = before.join(after.select(KEY, *[F.col(f"prediction_{i}").alias(f"loaded_{i}") for i in range(2)], "prediction"), KEY)
    same = F.forall(F.array(*[F.col(f"prediction_{i}") == F.col(f"loaded_{i}") for i in range(2)]), lambda x: x)
    mean = F.abs(F.col("prediction") - (F.col("loaded_0") + F.col("loaded_1")) / 2) < 1e-12
    return both.select(KEY, same.cast("int").alias("is_same"), mean.cast("int").alias("is_fold_mean"))


def random_search(spark, sf_dir):
    table, names = training_table(spark, sf_dir)
    space = {"maxDepth": ("int", 1, 3), "stepSize": ("log", 0.05, 0.5)}
    _, trials = cv.random_search(table, names, "target", KEY, 4, space, k=3, fixed={"maxIter": 5}, first_fold_only=False)
    rows = [(r["trial"], r["score"], r["params"]["maxDepth"], r["params"]["stepSize"]) for r in trials]
    return spark.createDataFrame(rows, "trial int, score double, max_depth int, step_size double")


def drift_features(spark, sf_dir):
    """Features that tell the train from the test customers."""
    panel = statements(spark, sf_dir)
    parts = by_split(spark, sf_dir, panel.select("o_custkey", "o_orderdate", "o_orderkey"))
    who = drift.population(parts["train"], parts["test"], STATEMENTS, "train_vs_private")
    table = _stored(features(spark, sf_dir).join(who, KEY), "drift")
    names = [c for c in table.columns if c not in (KEY, "month", "target")]
    found = drift.drift_features(table, names, "target", KEY, threshold=DRIFT, step=4, params=TREES)
    path = fresh_folder(spark, "drift-report")
    kept = spark.createDataFrame([(f,) for f in found.kept], "feature string")
    tables.write_drift_report(found.report, kept, path)
    return spark.read.schema("round int, auc double, feature string, status string").json(f"{path}/report")


def oof_stored(spark, sf_dir):
    """Out-of-fold rows as stored by fold and read back: each training row once, in its fold, with a probability."""
    inside = F.col("predicted").between(0, 1).cast("int")
    return cv_oof(spark, sf_dir).select(KEY, "target", "fold", inside.alias("is_probability"))


def importance_mean(spark, sf_dir):
    """The stored mean importances: as many as features, in falling order, none negative, one in all."""
    stored = feature_importance(spark, sf_dir)
    return stored.agg(
        F.count("feature").alias("features"), (F.abs(F.sum("importance") - 1) < 1e-9).cast("int").alias("sums_to_one"),
        (F.min("importance") >= 0).cast("int").alias("none_negative"),
    )


def drift_rounds(spark, sf_dir):
    """The stored drift search: features go only while the AUC is above the threshold, each once, and it ends below it."""
    report = drift_features(spark, sf_dir)
    gone = F.col("status") == "dropped"
    last = F.max_by(F.struct("status", "auc"), F.struct("round", F.col("status") == "done"))
    return report.agg(
        F.coalesce(F.min(F.when(gone, (F.col("auc") > DRIFT).cast("int"))), F.lit(1)).alias("drops_above"),
        (F.count(F.when(gone, F.col("feature"))) - F.count(F.when(F.col("status") == "restored", 1)) >= 0).cast("int").alias("restores_dropped"),
        F.when(last["status"] == "done", F.coalesce(last["auc"] <= DRIFT, F.lit(True))).cast("int").alias("ends_below"),
    )


def search_trials(spark, sf_dir):
    """All trials of the search: parameters inside the space, a score of at most one."""
    inside = F.col("max_depth").between(1, 3) & F.col("step_size").between(0.05, 0.5) & (F.col("score") <= 1)
    return random_search(spark, sf_dir).select("trial", inside.cast("int").alias("is_inside"))


def corr_filter(spark, sf_dir):
    """Feature table without columns correlated above 0.9 with an earlier one."""
    table = _stored(features(spark, sf_dir), "corr")
    names = [c for c in table.columns if c != KEY]
    kept = selection.correlation_filter(table, names, 0.9)
    return table.select(KEY, *kept)


def corr_filter_kept(spark, sf_dir):
    """Which features the correlation filter keeps."""
    table = _stored(features(spark, sf_dir), "corr")
    names = [c for c in table.columns if c != KEY]
    kept = selection.correlation_filter(table, names, 0.9)
    return spark.createDataFrame([(n, int(n in kept)) for n in names], "feature string, is_kept int")


def pca_variance(spark, sf_dir):
    """All principal axes: their variances fall, and sum up to that of the features; projections have them."""
    table = _stored(features(spark, sf_dir), "pca")
    names = [c for c in table.columns if c != KEY]
    axes = selection.principal_axes(table, names, len(names))
    falls = all(a >= b >= 0 for a, b in zip(axes.variances, axes.variances[1:]))
    on = selection.project(table, axes, KEY)
    seen = on.agg(*[F.var_samp(f"pca_{i}").alias(f"v{i}") for i in range(3)])
    same = F.forall(F.array(*[F.abs(F.col(f"v{i}") / F.lit(float(axes.variances[i])) - 1) < 1e-6 for i in range(3)]), lambda x: x)
    total = F.lit(float(axes.variances.sum())).cast("float")
    return seen.select(F.lit(len(names)).alias("axes"), F.lit(int(falls)).alias("falls"), same.cast("int").alias("is_projected"), total.alias("total"))


def pca(spark, sf_dir):
    table = _stored(features(spark, sf_dir), "pca")
    return selection.pca(table, [c for c in table.columns if c != KEY], KEY, 3)


def queries() -> dict:
    found = (
        cv_oof, cv_coverage, cv_scores, cv_early_stopping, feature_importance, top_features, fold_mean_predict,
        saved_models, random_search, drift_features, corr_filter, pca, importance_by_fold, cv_stages, predict_mixed,
        corr_filter_kept, pca_variance, oof_stored, importance_mean, drift_rounds, search_trials,
    )
    return {f.__name__: f for f in found}
