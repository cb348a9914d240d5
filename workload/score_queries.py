"""Metric, profile, encoding, fold, blend, store and drift queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.functions.scalar import sigmoid, within_days_sql
from panelwise.operators import blend, drift, encode, families as fam, folds, metrics, profile, pseudo, selection
from panelwise.plans.ordering import order_statistics, split_points, with_position
from panelwise.sources import store, tables
from panelwise.sources.workdir import fresh_folder
from workload.fixtures import EVENTS, STATEMENTS, as_float, by_split, scored, statements, table

KEY, TARGET = "key", "target"


def _on_scores(operator, *args, **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_float(operator(scored(spark, sf_dir), *args, **options))

    return run


def _log_odds(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("x", F.col("score_a") * 8 - 4)


def log_loss(spark, sf_dir):
    return as_float(metrics.log_loss(_log_odds(spark, sf_dir), TARGET, "x"))


def focal_loss(spark, sf_dir):
    out = metrics.focal_loss_value(_log_odds(spark, sf_dir), TARGET, "x", alpha=0.25, gamma=2.0, balance=True)
    return as_float(out)


def focal_loss_unbalanced(spark, sf_dir):
    return as_float(metrics.focal_loss_value(_log_odds(spark, sf_dir), TARGET, "x", gamma=2.0))


def probability(spark, sf_dir):
    return as_float(_log_odds(spark, sf_dir).select(KEY, sigmoid(F.col("x")).alias("p")))


def score_rank(spark, sf_dir):
    return metrics.score_rank(scored(spark, sf_dir), "score_b", KEY).select(KEY, "place")


def score_rank_buckets(spark, sf_dir):
    """The same over many buckets of the order, however small the table."""
    rows, order = scored(spark, sf_dir), ["-score_b", "key"]
    points = split_points(rows, order, rows_per_bucket=100)
    return with_position(rows, order, "place", points).select(KEY, "place")


def order_statistic(spark, sf_dir):
    """Median and deciles of order totals by place, exact."""
    orders = table(spark, sf_dir, "orders")
    n = orders.count()
    places = [i * (n - 1) // 10 for i in range(11)]
    values = order_statistics(orders, "o_totalprice", "o_orderkey", places)
    return spark.createDataFrame(sorted(values.items()), "place long, o_totalprice double")


def _labelled(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return customers.select(F.col("c_custkey").alias("o_custkey"), (F.col("c_acctbal") < 0).cast("int").alias("target"))


def target_profile(spark, sf_dir):
    return as_float(profile.target_profile(statements(spark, sf_dir), _labelled(spark, sf_dir), STATEMENTS))


def value_counts(spark, sf_dir):
    return profile.value_counts(statements(spark, sf_dir), "last_flag")


def value_counts_events(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "events"), "event_type")


def rows_per_key_hist(spark, sf_dir):
    return profile.rows_per_key_histogram(table(spark, sf_dir, "orders"), STATEMENTS)


def rows_per_date(spark, sf_dir):
    out = profile.rows_per_date(table(spark, sf_dir, "events"), EVENTS)
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def role_split(spark, sf_dir):
    """Role of every panel column, with the number of known values in it."""
    panel = statements(spark, sf_dir)
    roles = STATEMENTS.roles(panel)
    known = panel.agg(*[F.count(c).alias(c) for c in roles])
    cells = [F.struct(F.lit(c).alias("column"), F.lit(r).alias("role"), F.col(c).alias("known")) for c, r in roles.items()]
    return known.select(F.inline(F.array(*cells)))


def period_rows(spark, sf_dir):
    """Rows of the last 100 days of each customer."""
    panel = table(spark, sf_dir, "orders")
    newest = panel.groupBy("o_custkey").agg(F.max("o_orderdate").alias("newest"))
    return (
        panel.join(newest, "o_custkey")
        .where(within_days_sql("newest", "o_orderdate", 100))
        .select("o_custkey", "o_orderkey")
    )


def _last_categories(spark, sf_dir):
    """Newest categories, with NULL where a customer's newest order has no lines."""
    return fam.last_row(statements(spark, sf_dir), STATEMENTS).select(
        "o_custkey", "o_orderstatus", "o_orderpriority", "last_flag", F.col("n_lines").cast("string").alias("n_lines")
    )


def mode_impute(spark, sf_dir):
    df = _last_categories(spark, sf_dir)
    return encode.impute_modes(df, encode.fit_modes(df, ["last_flag", "o_orderpriority", "n_lines"]))


def label_encode(spark, sf_dir):
    """Fitted on all statements, applied to each customer's newest one."""
    columns = ["o_orderstatus", "o_orderpriority", "last_flag"]
    labels = encode.fit_labels(statements(spark, sf_dir), columns)
    return encode.apply_labels(_last_categories(spark, sf_dir), labels, columns)


def label_encode_large(spark, sf_dir):
    """Codes of names that differ in every row, and of a column that is NULL in two rows of three."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("segment"), "c_nationkey"
    )
    columns = ["c_name", "segment", "c_nationkey"]
    labels = encode.fit_labels(customers, columns)
    return encode.apply_labels(customers, encode.LabelMap(labels.table, encode.BROADCAST_ROWS + labels.number), columns)


def _basic(spark, sf_dir, stats=("mean", "last"), categorical_stats=()):
    return fam.family(
        "basic_stat", statements(spark, sf_dir), STATEMENTS, stats=stats, categorical_stats=categorical_stats
    )


def round_last(spark, sf_dir):
    out = encode.round_last(_basic(spark, sf_dir, ("last",)))
    return as_float(out.select("o_custkey", *[c for c in out.columns if c.endswith("_round2")]))


def downcast_plan(spark, sf_dir):
    return as_float(encode.downcast_plan(table(spark, sf_dir, "lineitem")))


def downcast(spark, sf_dir):
    """All columns, the numeric ones in their narrowest types."""
    return encode.downcast(table(spark, sf_dir, "lineitem"))


def fixed_downcast(spark, sf_dir):
    return encode.fixed_downcast(table(spark, sf_dir, "orders"))


def threshold_flags(spark, sf_dir):
    return metrics.threshold_flags(scored(spark, sf_dir).select(KEY, F.col("score_b").alias("predicted")), "predicted").drop("predicted")


def _folds(k, seed=None):
    def run(spark, sf_dir):
        out = folds.stratified_folds(scored(spark, sf_dir), TARGET, KEY, k, seed)
        return out.select(KEY, TARGET, "fold")

    return run


def stratified_sample(spark, sf_dir):
    return folds.stratified_sample(scored(spark, sf_dir), TARGET, KEY, 0.3).select(KEY, TARGET)


def _by_fold(operator, *args):
    """A score of every stratified fold, all in one pass."""

    def run(spark, sf_dir):
        folded = folds.stratified_folds(scored(spark, sf_dir), TARGET, KEY, 5)
        return as_float(operator(folded, *args, by="fold"))

    return run


def pred_hist_unknown(spark, sf_dir):
    """Scores of which some are unknown and some lie outside [0, 1]."""
    odd = scored(spark, sf_dir).withColumn("p", F.when(F.col(KEY) % 7 != 0, F.col("score_a") * 1.5 - 0.25))
    return as_float(metrics.prediction_histogram(odd, TARGET, "p"))


def ensemble_lacking(spark, sf_dir):
    """Largest prediction of two models, one of which lacks a third of the keys."""
    models = _predictions(spark, sf_dir)
    return as_float(blend.ensemble({"a": models["a"], "b": models["b"].where(F.col(KEY) % 3 != 0)}, KEY, method="max"))


def submission_checked(spark, sf_dir):
    """A submission that is written only because its keys are those asked for, one to one."""
    path = fresh_folder(spark, "submission")
    blended = blend.ensemble(_predictions(spark, sf_dir), KEY)
    tables.write_submission(blended, KEY, path, keys=scored(spark, sf_dir))
    return as_float(tables.read_predictions(spark, path, KEY, "bigint"))


def _predictions(spark, sf_dir):
    s = scored(spark, sf_dir)
    third = ((F.col(KEY) * 104729) % 9973) / F.lit(9973.0)
    return {
        "a": s.select(KEY, F.col("score_a").alias("prediction")),
        "b": s.select(KEY, F.col("score_b").alias("prediction")),
        "c": s.select(KEY, third.alias("prediction")),
    }


def _ensemble(method, weights=None):
    def run(spark, sf_dir):
        return as_float(blend.ensemble(_predictions(spark, sf_dir), KEY, weights, method))

    return run


def fold_mean(spark, sf_dir):
    """Mean of stored per-fold log odds and the probability it stands for."""
    wide = blend.align(_predictions(spark, sf_dir), KEY)
    odds = wide.select(KEY, *[(F.col(c) * 8 - 4).alias(c) for c in ("a", "b", "c")])
    mean = blend.mean_prediction(["a", "b", "c"])
    return as_float(odds.select(KEY, mean.alias("prediction"), sigmoid(mean).alias("probability")))


def _halves(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.where("split = 'train'"), s.where("split = 'test'")


def pseudo_label(spark, sf_dir):
    train, test = _halves(spark, sf_dir)
    out = pseudo.pseudo_label(train.select(KEY, TARGET, "score_a"), test, KEY, TARGET, "score_a", upper=0.99)
    return out.select(KEY, TARGET, "origin")


def _population(mode):
    def run(spark, sf_dir):
        parts = by_split(spark, sf_dir, table(spark, sf_dir, "orders"))
        return drift.population(parts["train"], parts["test"], STATEMENTS, mode)

    return run


def month_flag(spark, sf_dir):
    months = drift.newest_month(table(spark, sf_dir, "orders"), STATEMENTS)
    part = F.when(F.col("month") == drift.PRIVATE_MONTH, "private").when(F.col("month") == drift.PUBLIC_MONTH, "public")
    return months.withColumn("part", part)


def tagged_union(spark, sf_dir):
    train, test = _halves(spark, sf_dir)
    return tables.tagged_union(train.select(KEY, "score_b"), test.select(KEY, "score_b"), "origin").drop("score_b")


def corr_pairs(spark, sf_dir):
    out = selection.correlation_pairs(statements(spark, sf_dir), STATEMENTS.numeric)
    return out.withColumn("corr", F.round("corr", 6))


def pruned_scan(spark, sf_dir):
    return tables.read_panel(spark, f"{sf_dir}/orders.parquet", ["o_custkey", "o_orderkey"])


def panel_scan(spark, sf_dir):
    out = tables.read_panel(spark, f"{sf_dir}/customer.parquet")
    return as_float(out, digits=None)


def label_scan(spark, sf_dir):
    """Labels written as CSV and read back by column name."""
    path = fresh_folder(spark, "labels")
    _labelled(spark, sf_dir).select("target", "o_custkey").write.option("header", True).csv(path)
    return tables.read_labels(spark, path, "o_custkey", "bigint")


def _store(spark, sf_dir):
    """Three families written for the train and the test split."""
    root = fresh_folder(spark, "store")
    tables.write_wide(statements(spark, sf_dir), f"{root}/panel")
    panel = tables.read_panel(spark, f"{root}/panel")
    for split, rows in by_split(spark, sf_dir, panel).items():
        store.write_family(
            fam.family("basic_stat", rows, STATEMENTS, stats=fam.FIVE_STATS), root, "basic_stat", split
        )
        store.write_family(fam.family("last_mean_diff", rows, STATEMENTS), root, "last_mean_diff", split)
        store.write_family(
            fam.family("avg_max_last", rows, STATEMENTS, avg=["qty"], last=["qty"]), root, "avg_max_last", split
        )
    groups = f"{root}/groups"
    spark.createDataFrame([("o_custkey",), ("qty_last_mean_diff",), ("n_lines_last_mean_diff",)], "n string").coalesce(
        1
    ).write.text(f"{groups}/last_mean_diff/chosen.txt")
    return root, groups


def assemble_features(spark, sf_dir):
    root, groups = _store(spark, sf_dir)
    chosen = {"basic_stat": ["o_totalprice_mean", "last_flag_last"], "last_mean_diff": "chosen", "avg_max_last": "all"}
    wide = [
        store.assemble(spark, root, split, chosen, "o_custkey", groups).withColumn("split", F.lit(split))
        for split in ("train", "test")
    ]
    return as_float(tables.attach_labels(wide[0].unionByName(wide[1]), _labelled(spark, sf_dir), "o_custkey"))


def consolidated_features(spark, sf_dir):
    root, _ = _store(spark, sf_dir)
    for split in ("train", "test"):
        store.consolidate(spark, root, ["basic_stat", "last_mean_diff", "avg_max_last"], split, "o_custkey")
    train, test = (store.read_family(spark, root, "all_features", split) for split in ("train", "test"))
    out = train.unionByName(test)
    return as_float(out)


def assemble_bucketed(spark, sf_dir):
    """Three families stored in buckets by key and joined where they lie, opened by what their manifests say."""
    root = fresh_folder(spark, "buckets")
    panel = statements(spark, sf_dir)
    for name, options in (("basic_stat", {"stats": fam.FIVE_STATS}), ("last_mean_diff", {}), ("avg_max_last", {"avg": ["qty"], "last": ["qty"], "last_suffix": "newest"})):
        store.write_family(fam.family(name, panel, STATEMENTS, **options), root, name, "train", "o_custkey", 8)
    chosen = {"basic_stat": ["o_totalprice_mean", "last_flag_last"], "last_mean_diff": "all", "avg_max_last": "all"}
    return as_float(store.assemble(spark, root, "train", chosen, "o_custkey"))


def resolved_features(spark, sf_dir):
    root, groups = _store(spark, sf_dir)
    chosen = {"basic_stat": ["qty_last"], "last_mean_diff": "chosen", "avg_max_last": "all"}
    names = store.resolved_features(spark, root, "train", chosen, "o_custkey", groups)
    return store.feature_record(spark, names)


def inner_chain(spark, sf_dir):
    """Numeric, categorical, difference and label tables joined one to one by key."""
    panel = statements(spark, sf_dir)
    parts = [
        fam.family("basic_stat", panel, STATEMENTS, stats=("mean",), categorical_stats=()),
        fam.family("basic_stat", panel, STATEMENTS, stats=(), categorical_stats=("last",)),
        fam.family("lag_diff", panel, STATEMENTS, lags=(1,), as_float=False),
        _labelled(spark, sf_dir),
    ]
    return as_float(tables.join_on_key(parts, "o_custkey"))


def submission(spark, sf_dir):
    """Mean of three models written as CSV and read back."""
    path = fresh_folder(spark, "submission")
    blended = blend.ensemble(_predictions(spark, sf_dir), KEY)
    tables.write_submission(blended, KEY, path)
    return as_float(tables.read_predictions(spark, path, KEY, "bigint"))


def queries() -> dict:
    q = {
        "default_metric": _on_scores(metrics.default_metric, TARGET, "score_a", KEY),
        "default_metric_ties": _on_scores(metrics.default_metric, TARGET, "score_b", KEY),
        "default_metric_int_cutoff": _on_scores(metrics.default_metric, TARGET, "score_a", KEY, cutoff="int"),
        "lorenz_curve": _on_scores(metrics.lorenz_curve, TARGET, "score_b", KEY),
        "roc_auc": _on_scores(metrics.roc_auc, TARGET, "score_a"),
        "roc_auc_ties": _on_scores(metrics.roc_auc, TARGET, "score_b"),
        "pred_hist": _on_scores(metrics.prediction_histogram, TARGET, "score_a"),
        "calibration": _on_scores(metrics.calibration, TARGET, "score_a", KEY),
        "threshold_counts": _on_scores(metrics.threshold_counts, "score_a"),
        "metric_by_fold": _by_fold(metrics.default_metric, TARGET, "score_b", KEY),
        "auc_by_fold": _by_fold(metrics.roc_auc, TARGET, "score_b"),
        "stratified_folds": _folds(5),
        "stratified_folds_2": _folds(2),
        "stratified_folds_8": _folds(8),
        "shuffled_folds": _folds(5, seed=42),
        "ensemble_avg": _ensemble("avg", {"a": 1, "b": 2, "c": 3}),
        "ensemble_min": _ensemble("min"),
        "ensemble_max": _ensemble("max"),
        "seed_blend": _ensemble("avg"),
    }
    for f in (
        log_loss, focal_loss, focal_loss_unbalanced, probability, score_rank, score_rank_buckets, order_statistic, target_profile,
        value_counts, value_counts_events, rows_per_key_hist, rows_per_date, role_split, period_rows, mode_impute,
        label_encode, label_encode_large, round_last, downcast_plan, downcast, fixed_downcast, threshold_flags, stratified_sample,
        fold_mean, pseudo_label, month_flag, tagged_union, corr_pairs, panel_scan, pruned_scan, label_scan,
        assemble_features, assemble_bucketed, consolidated_features, resolved_features, inner_chain, submission,
        submission_checked, pred_hist_unknown, ensemble_lacking,
    ):
        q[f.__name__] = f
    for mode in drift.MODES:
        q[f"population_{mode}"] = _population(mode)
    return q
