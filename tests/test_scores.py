"""Metrics, order, folds, encoders, store and models against direct evaluation."""

import bisect

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwise.operators import blend, cv, drift, encode, folds, metrics, pseudo, selection
from panelwise.plans import ordering
from panelwise.sources import store, tables
from panelwise.sources.workdir import fresh_folder
from panelwise.spec import PanelSpec


@pytest.fixture(params=[None, 50])
def bucket_rows(request, monkeypatch):
    """Run with one bucket and with many."""
    if request.param:
        monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", request.param)


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.RandomState(5)
    n = 1000
    target = (rng.rand(n) < 0.2).astype(int)
    score = np.round(np.clip(rng.rand(n) * 0.7 + 0.3 * target, 0, 1), 2)
    score[: n // 3] = 0.5  # a third of the rows share one score
    pdf = pd.DataFrame({"key": np.arange(n), "target": target, "score": score})
    return spark.createDataFrame(pdf).repartition(7), pdf


def direct_metric(pdf):
    p = pdf.sort_values(["score", "key"], ascending=[False, True])
    t = p["target"].to_numpy(float)
    w = 20 - 19 * t
    share, found = np.cumsum(w) / w.sum(), np.cumsum(t) / t.sum()
    capture = t[share <= 0.04].sum() / t.sum()
    q = np.sort(t)[::-1]
    v = 20 - 19 * q
    best = ((np.cumsum(q) / q.sum() - np.cumsum(v) / v.sum()) * v).sum()
    return 0.5 * (((found - share) * w).sum() / best + capture)


def direct_auc(pdf):
    r = pdf["score"].rank()
    p = pdf["target"].sum()
    return (r[pdf["target"] == 1].sum() - p * (p + 1) / 2) / (p * (len(pdf) - p))


def test_metric(scored, bucket_rows):
    df, pdf = scored
    assert metrics.default_metric(df, "target", "score", "key").first()["metric"] == pytest.approx(direct_metric(pdf), abs=1e-12)


def test_metric_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0, 0.1), (2, 0, 0.2)], "key int, target int, score double")
    assert metrics.default_metric(df, "target", "score", "key").first()["metric"] is None
    assert metrics.roc_auc(df, "target", "score").first()["auc"] is None


def test_auc(scored, bucket_rows):
    df, pdf = scored
    assert metrics.roc_auc(df, "target", "score").first()["auc"] == pytest.approx(direct_auc(pdf), abs=1e-12)


def test_rank_and_order_statistics(scored, bucket_rows):
    df, pdf = scored
    place = {r["key"]: r["place"] for r in metrics.score_rank(df, "score", "key").collect()}
    order = pdf.sort_values(["score", "key"], ascending=[False, True])["key"].tolist()
    assert [place[k] for k in order] == list(range(len(pdf)))
    values = ordering.order_statistics(df, "score", "key", [0, 17, 999])
    assert values == {i: np.sort(pdf["score"])[i] for i in (0, 17, 999)}
    with pytest.raises(IndexError):
        ordering.order_statistics(df, "score", "key", [1000])


def test_quantiles(scored, bucket_rows):
    df, pdf = scored
    p = [0.0, 0.013, 0.5, 0.87, 1.0]
    assert ordering.quantiles(df, "score", "key", p) == pytest.approx(list(np.quantile(pdf["score"], p)))


def test_order_by_text_and_time(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 10)
    df = spark.range(300).selectExpr(
        "concat('it''s \"', CAST(id % 7 AS STRING), '\\\\') AS s", "TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_dt_interval(CAST(id AS INT)) AS t", "id"
    )
    rows = ordering.with_position(df.repartition(5), ["s", "t", "id"]).orderBy("s", "t", "id").collect()
    assert [r["position"] for r in rows] == list(range(300))


def test_order_never_uses_one_task_for_rows(scored, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 50)
    plan = ordering.with_position(scored[0], ["score", "key"])._jdf.queryExecution().executedPlan().toString()
    above_single = plan[plan.index("Exchange SinglePartition") :]
    assert plan.count("Exchange SinglePartition") == 1 and "HashAggregate(keys=[_bucket" in above_single.split("\n")[1]


def test_buckets_stay_balanced_under_ties(scored, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 100)
    df, _ = scored
    cut = ordering.split_points(df, ["score", "key"]).add_bucket(df, ["score", "key"])
    sizes = [r["count"] for r in cut.groupBy("_bucket").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 250


def test_many_buckets_bring_only_their_splits_to_the_driver(spark, monkeypatch):
    df = spark.range(6000).selectExpr("id AS k", "IF(id % 7 = 0, NULL, pmod(id * 31, 97)) AS s")
    kind, brought = type(df), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: brought.append(collect(self)) or brought[-1])
    points = ordering.split_points(df, ["s", "k"], rows_per_bucket=10)
    assert 400 <= len(points.splits) and max(map(len, brought)) <= 700
    monkeypatch.undo()
    cut = points.add_bucket(df, ["s", "k"])
    key = lambda row: tuple((v is not None, v) for v in row)
    splits = [key(p) for p in points.splits]
    assert all(r[ordering.BUCKET] == bisect.bisect_right(splits, key((r.s, r.k))) for r in cut.collect())
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan  # no walk along all splits of a group
    placed = ordering.with_position(df, ["s", "k"], "place", points)
    assert [r.place for r in placed.orderBy("s", "k").collect()] == list(range(6000))


def direct_folds(target, k):
    """Deal the class-sorted rows to folds by position; blocks per class in row order."""
    codes = pd.factorize(target)[0]
    ordered = np.sort(codes)
    out = np.empty(len(codes), int)
    for c in np.unique(codes):
        sizes = [np.sum(ordered[i::k] == c) for i in range(k)]
        out[codes == c] = np.repeat(np.arange(k), sizes)
    return out


@pytest.mark.parametrize("k", [2, 5, 8])
def test_stratified_folds(scored, bucket_rows, k):
    df, pdf = scored
    got = folds.stratified_folds(df, "target", "key", k).toPandas().sort_values("key")
    assert got["fold"].tolist() == direct_folds(pdf["target"].to_numpy(), k).tolist()


def test_shuffled_folds_are_balanced_and_repeatable(scored):
    df, _ = scored
    a, b, c = (
        folds.stratified_folds(x, "target", "key", 5, seed).toPandas().sort_values("key")
        for x, seed in ((df, 1), (df.repartition(3), 1), (df, 2))
    )
    assert a["fold"].tolist() == b["fold"].tolist() != c["fold"].tolist()
    sizes = a.groupby(["target", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1)).max() <= 1


def test_sample_keeps_class_shares(scored):
    df, pdf = scored
    kept = folds.stratified_sample(df, "target", "key", 0.25).toPandas()
    assert len(kept) == 250
    assert kept["target"].sum() == pytest.approx(pdf["target"].sum() / 4, abs=1)


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (0, 0.95)], "target int, p double")
    out = {r["bin"]: (r["n"], r["density"]) for r in metrics.prediction_histogram(df, "target", "p").collect()}
    assert len(out) == 20 and out[19] == (2, pytest.approx(2 / 3 * 20)) and out[5] == (0, 0.0)


def test_losses_do_not_overflow(spark):
    df = spark.createDataFrame([(1, 800.0), (0, -800.0), (1, 0.0)], "target int, x double")
    assert metrics.log_loss(df, "target", "x").first()[0] == pytest.approx(np.log(2) / 3)
    assert metrics.focal_loss_value(df, "target", "x", gamma=2.0).first()[0] == pytest.approx(np.log(2) / 12)


# --- encoders ---------------------------------------------------------------------------------


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b", "2", 2.0), ("a", "10", 1.0), ("b", "10", 1.0), ("a", None, 2.0), (None, "2", None)], "c string, d string, e double")
    modes = encode.fit_modes(df, ["c", "d", "e"])
    assert {c: m.value for c, m in modes.items()} == {"c": "a", "d": "10", "e": "1.0"}
    out = encode.impute_modes(df, modes)
    assert dict(out.dtypes) == {"c": "string", "d": "bigint", "e": "bigint"}
    assert out.where("c IS NULL OR d IS NULL OR e IS NULL").count() == 0


@pytest.mark.parametrize("small", [True, False])
def test_labels(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(encode, "BROADCAST_ROWS", 1)
    train = spark.createDataFrame([("b", 10.0), ("a", 9.0), (None, 10.0)], "c string, d double")
    test = spark.createDataFrame([("a", 10.0), (None, 9.0)], "c string, d double")
    labels = encode.fit_labels(train, ["c", "d"])
    out = encode.apply_labels(test, labels, ["c", "d"]).collect()
    assert sorted(map(tuple, out)) == [(0, 1), (2, 0)]
    unseen = spark.createDataFrame([("z", 9.0)], "c string, d double")
    with pytest.raises(Exception, match="unseen value in c: z"):
        encode.apply_labels(unseen, labels, ["c"]).collect()


def test_many_labels_are_not_broadcast(spark, monkeypatch, capsys):
    """Files of numbered values are far smaller than their rows; Spark must not choose by them."""
    monkeypatch.setattr(encode, "BROADCAST_ROWS", 100)
    df = spark.range(2000).selectExpr("id", "concat('v', id) AS c", "IF(id % 3 = 0, 'x', NULL) AS d")
    labels = encode.fit_labels(df, ["c", "d"])
    out = encode.apply_labels(df, labels, ["c", "d"])
    out.explain()
    assert "Broadcast" not in capsys.readouterr().out
    place = {c: i for i, c in enumerate(sorted(f"v{i}" for i in range(2000)))}
    assert sorted(map(tuple, out.collect())) == [(i, place[f"v{i}"], int(i % 3 > 0)) for i in range(2000)]


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (-0.125,)], "x_last double")
    out = encode.round_last(df).collect()
    assert [r["x_last_round2"] for r in out] == [0.12, 0.38, -0.12]


def test_downcast_limits_are_exclusive(spark):
    df = spark.createDataFrame([(126, 127, 1.0, 1e39), (-127, 0, 2.0, 0.0)], "a bigint, b bigint, c double, d double")
    assert dict(encode.downcast(df).dtypes) == {"a": "tinyint", "b": "smallint", "c": "float", "d": "double"}


# --- blends, pseudo-labels, populations --------------------------------------------------------


def test_min_and_max_use_every_model(spark):
    tables_ = {n: spark.createDataFrame([(1, v)], "key int, prediction double") for n, v in (("a", 0.5), ("b", 0.6), ("c", 0.1))}
    assert blend.ensemble(tables_, "key", method="min").first()["prediction"] == 0.1
    assert blend.ensemble(tables_, "key", method="max").first()["prediction"] == 0.6
    got = blend.ensemble(tables_, "key", {"a": 1, "b": 1, "c": 2}).first()["prediction"]
    assert got == pytest.approx(1.3 / 4)


def test_pseudo_labels(spark):
    train = spark.createDataFrame([(i, int(i < 2)) for i in range(6)], "key long, target int")
    scored = spark.range(100, 120).selectExpr("id AS key", "(id - 100) / 20 AS prediction")
    out = pseudo.pseudo_label(train, scored, "key", upper=0.9).toPandas()
    assert (out["origin"] == "pseudo_1").sum() == 1  # only 0.95 is above
    assert (out["origin"] == "pseudo_0").sum() == 2  # ratio 2, so the two lowest
    assert out[out["origin"] == "pseudo_0"]["target"].eq(0).all()


def test_population_modes(spark):
    spec = PanelSpec(key="k", ts="t")
    train = spark.createDataFrame([(1, "2018-03-01"), (1, "2018-03-31")], "k int, t string")
    test = spark.createDataFrame([(2, "2019-04-02"), (3, "2019-10-05"), (3, "2019-04-01")], "k int, t string")
    rows = lambda mode: sorted((r["k"], r["month"], r["target"]) for r in drift.population(train, test, spec, mode).collect())
    assert rows("public_vs_private") == [(2, 4, 1), (3, 10, 0)]
    assert rows("train_vs_public") == [(1, 3, 0), (3, 10, 1)]
    assert rows("train_vs_private") == [(1, 3, 0), (2, 4, 1)]


# --- store ----------------------------------------------------------------------------------


def test_store_round_trip(spark):
    root = fresh_folder(spark, "test-store")
    store.write_family(spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0)], "k int, a double, b double"), root, "one", "train")
    store.write_family(spark.createDataFrame([(2, 30.0, 5.0), (1, 10.0, 6.0)], "k int, a double, c double"), root, "two", "train")
    wide = store.assemble(spark, root, "train", {"one": "all", "two": ["c"]}, "k")
    assert sorted(map(tuple, wide.collect())) == [(1, 1.0, 2.0, 6.0), (2, 3.0, 4.0, 5.0)]
    store.consolidate(spark, root, ["one", "two"], "train", "k")
    merged = store.read_family(spark, root, "all_features", "train").select("k", "a", "b", "c")
    assert sorted(map(tuple, merged.collect())) == [(1, 10.0, 2.0, 6.0), (2, 30.0, 4.0, 5.0)]
    names = store.resolved_features(spark, root, "train", {"one": "all", "two": ["c"]}, "k")
    assert store.read_record(store.feature_record(spark, names)) == {"one": ["a", "b"], "two": ["c"]}


def test_bucketed_families_join_without_shuffle(spark):
    root = fresh_folder(spark, "test-buckets")
    for family in ("one", "two"):
        df = spark.range(100).selectExpr("id AS k", f"id * 2 AS {family}_x")
        store.write_family(df, root, family, "train", key="k", buckets=4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wide = store.assemble(spark, root, "train", {"one": "all", "two": "all"}, "k")
        assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
        assert wide.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_csv_round_trips(spark):
    path = fresh_folder(spark, "test-csv")
    scored = spark.createDataFrame([("x", 0.25), ("y", 0.5)], "id string, p double")
    tables.write_submission(scored, "id", f"{path}/sub", "p")
    back = tables.read_predictions(spark, f"{path}/sub", "id")
    assert back.columns == ["id", "prediction"] and sorted(map(tuple, back.collect())) == [("x", 0.25), ("y", 0.5)]
    tables.write_fold_predictions(scored.withColumn("q", F.col("p") / 2), "id", ["p", "q"], f"{path}/folds")
    assert tables.read_predictions(spark, f"{path}/folds", "id").columns == ["id", "prediction_0", "prediction_1"]


# --- models ------------------------------------------------------------------------------------

TREES = {"maxIter": 2, "maxDepth": 2}


@pytest.fixture(scope="module")
def learnable(spark):
    return spark.range(300).selectExpr(
        "id AS key", "CAST(id % 5 = 0 AS INT) AS target",
        "IF(id % 11 = 0, NULL, CAST(id % 5 AS DOUBLE)) AS good", "CAST(pmod(xxhash64(id), 50) AS DOUBLE) AS noise",
    )


def test_cross_validation(spark, learnable):
    got = cv.cross_validate(learnable, ["good", "noise"], "target", "key", 3, TREES)
    oof = got.oof.toPandas()
    assert sorted(oof["key"]) == list(range(300)) and oof["predicted"].between(0, 1).all()
    assert {"predicted_09", "predicted_05", "fold"} <= set(oof.columns)
    assert got.mean_score() > 0.5
    assert cv.top_features(got.importances, 1) == ["good"]
    each = cv.predict_mean(learnable, got.models, "key").toPandas()
    assert np.allclose(each["prediction"], each[["prediction_0", "prediction_1", "prediction_2"]].mean(axis=1))
    odds = cv.predict(learnable, got.models, "key", "logodds").toPandas()
    both = each.merge(odds, on="key")
    assert np.allclose(both["prediction_0_x"], 1 / (1 + np.exp(-both["prediction_0_y"])))
    got.release()


def test_drift_search_finds_the_telling_feature(spark, learnable):
    found = drift.drift_features(learnable, ["good", "noise"], "target", "key", threshold=0.7, step=2, params=TREES)
    assert found.drifting == ["good"] and found.kept == ["noise"]
    assert [r["status"] for r in found.report.orderBy("round").collect()][-1] == "done"


def test_correlated_columns_are_dropped(spark):
    df = spark.range(50).selectExpr("id", "id * 1.0D AS a", "id * 2.0D + 1 AS b", "CAST(pmod(xxhash64(id), 9) AS DOUBLE) AS c")
    assert selection.correlation_filter(df, ["a", "b", "c"]) == ["a", "c"]
    out = selection.pca(df, ["a", "b", "c"], "id", 2)
    assert out.columns == ["id", "pca_0", "pca_1"] and out.count() == 50


def test_whole_numbers_beyond_32_bits_are_kept(spark):
    df = spark.createDataFrame([("3000000000", "99999999999999999999"), (None, None), ("7", "1")], "a string, b string")
    out = encode.impute_modes(df, encode.fit_modes(df, ["a", "b"]))
    assert dict(out.dtypes) == {"a": "bigint", "b": "string"}
    assert {r.a for r in out.collect()} == {3000000000, 7}


def test_calibration_counts_only_known_scores(spark):
    df = spark.createDataFrame([(i, 0, i / 10) for i in range(10)] + [(100 + i, 1, None) for i in range(4)], "k int, y int, s double")
    out = metrics.calibration(df, "y", "s", "k", bins=2).collect()
    assert sum(r.n for r in out) == 10 and all(r.observed_rate == 0 for r in out)


def test_any_number_of_classes(spark):
    df = spark.createDataFrame([(i, i % 1500) for i in range(4500)], "k int, y int")
    out = folds.stratified_folds(df, "y", "k", 3)
    assert {r["count"] for r in out.groupBy("fold").count().collect()} == {1500}
    assert out.groupBy("y").agg({"fold": "count"}).count() == 1500


def test_null_scores_spread_over_buckets(spark):
    from panelwise.plans import ordering

    df = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, NULL, id) AS s")
    points = ordering.split_points(df, ["s", "id"], rows_per_bucket=300)
    largest = points.add_bucket(df, ["s", "id"]).groupBy(ordering.BUCKET).count().agg({"count": "max"}).first()[0]
    assert largest < 900
    ranked = ordering.with_position(df, ["s", "id"], points=points)
    assert sorted(r.position for r in ranked.collect()) == list(range(3000))


def test_a_key_with_several_labels_is_an_error(spark):
    from pyspark.errors import PySparkException

    from panelwise.sources import tables

    features = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    good = spark.createDataFrame([("a", 1)], "k string, target int")
    assert {(r.k, r.target) for r in tables.attach_labels(features, good, "k").collect()} == {("a", 1), ("b", None)}
    with pytest.raises(PySparkException):
        tables.attach_labels(features, good.union(good), "k").collect()


def test_store_keeps_paths_keys_and_parts_apart(spark, tmp_path):
    from panelwise.sources import store

    first, second = f"{tmp_path}/st-one", f"{tmp_path}/st_one"
    store.write_family(spark.range(5).withColumnRenamed("id", "k"), first, "f", "train", "k", 2)
    store.write_family(spark.range(7).withColumnRenamed("id", "k"), second, "f", "train", "k", 2)
    assert (store.read_family(spark, first, "f", "train").count(), store.read_family(spark, second, "f", "train").count()) == (5, 7)
    store.write_family(spark.range(3).selectExpr("id AS k", "id AS extra"), first, "f", "train")
    assert store.read_family(spark, first, "f", "train").groupBy("extra").count().count() == 3
    store.write_family(spark.range(9).selectExpr("id AS k", "-id AS other"), first, "g", "train")
    both = store.assemble(spark, first, "train", {"f": "all", "g": "all"}, "k")
    assert both.count() == 9 and both.where("extra IS NULL").count() == 6
    names = [f"c{i}" for i in range(8)]
    spark.createDataFrame([(n,) for n in names], "value string").repartitionByRange(4, "value").write.text(f"{tmp_path}/g/f/all.txt")
    assert store.read_group(spark, f"{tmp_path}/g", "f", "all") == names
    store.write_group(spark, f"{tmp_path}/g", "f", "few", ["z", "a"])
    assert store.read_group(spark, f"{tmp_path}/g", "f", "few") == ["z", "a"]
