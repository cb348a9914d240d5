"""Sorted segments, grouped order, pair sums, staged fits and the store's manifest against direct evaluation."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwise.operators import blend, cv, families as fam, metrics, selection
from panelwise.plans import gramian, measures, ordering, pool, segments
from panelwise.plans.measures import Measure, Recipe
from panelwise.plans.skew import consecutive_gaps
from panelwise.sources import store, tables
from panelwise.spec import PanelSpec

SPEC = PanelSpec(key="k", ts="t", tiebreak=("i",), categorical=("c",))
MOST = [
    "basic_stat", ("period_stat", {"periods": (3, 20)}), "max_min_diff", "last_mean_diff", "div", "div_min_max", "date_gaps",
    ("shift", {"lags": (1, 2)}), "lag_diff", ("important_cross", {"columns": ("x", "n")}), ("important_double", {"columns": ("x",)}),
    ("important_mix", {"columns": ("x", "n")}),
    ("avg_max_last", {"avg": ("x",), "max": ("n",), "last": ("x", "c"), "last_suffix": "newest"}),
]


@pytest.fixture(scope="module")
def ragged(spark):
    """Keys of 1 to 400 rows with missing values of every kind, a key without any, and one that fills many batches."""
    rng = np.random.RandomState(3)
    sizes = [1, 2, 3, 5, 8, 13, 60, 400] * 6
    n = sum(sizes)
    pdf = pd.DataFrame({"k": np.repeat([f"key {i}" for i in range(len(sizes))], sizes), "i": rng.permutation(n)})
    pdf["t"] = (pd.Timestamp("2020-01-01") + pd.to_timedelta(rng.randint(0, 60 * 24 * 40, n), unit="m")).astype(str)
    df = spark.createDataFrame(pdf).selectExpr(
        "k", "CAST(i AS BIGINT) AS i", "CAST(IF(i % 37 = 0, NULL, t) AS TIMESTAMP_NTZ) AS t",
        "IF(pmod(xxhash64(i), 4) = 0 OR k = 'key 7', NULL, CASE WHEN i % 211 = 0 THEN DOUBLE('NaN') ELSE pmod(xxhash64(i, 1), 1000) / 7 - 50 END) AS x",
        "IF(i % 5 = 0, NULL, CAST(pmod(xxhash64(i, 2), 9) AS INT)) AS n", "CAST(i AS FLOAT) / 3 AS f",
        "IF(i % 3 = 0, NULL, concat('c', CAST(pmod(xxhash64(i, 3), 4) AS STRING))) AS c",
    )
    return df.repartition(5).cache()


def as_frame(df):
    out = df.toPandas().sort_values("k").reset_index(drop=True)
    return out[sorted(out.columns)]


def sql_only(monkeypatch):
    monkeypatch.setattr(measures, "_batched", lambda rows, spec, wanted: None)


@pytest.mark.parametrize("cells", [None, 64])
def test_batches_equal_aggregates(spark, ragged, monkeypatch, cells):
    if cells:
        monkeypatch.setattr(segments, "CELLS_AT_ONCE", cells)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        batched = fam.build(ragged, SPEC, MOST)
        got = as_frame(batched)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sql_only(monkeypatch)
    plain = fam.build(ragged, SPEC, MOST)
    assert dict(batched.dtypes) == dict(plain.dtypes)
    pd.testing.assert_frame_equal(got, as_frame(plain), check_exact=False, rtol=1e-9, atol=1e-9)


def test_large_keys_equal_batches(ragged):
    finite = ragged.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    pd.testing.assert_frame_equal(as_frame(fam.build(finite, SPEC, MOST)), as_frame(fam.build(finite, SPEC, MOST, rows_per_key=50)), rtol=1e-9, atol=1e-9)


def test_values_of_other_types(spark):
    df = spark.createDataFrame([("a", 1, True, "z"), ("a", 2, False, "é"), ("a", 3, None, None), ("b", 1, None, None)], "k string, t int, b boolean, s string")
    spec = PanelSpec(key="k", ts="t")
    names = [("first", "s"), ("last", "s"), ("last_row", "s"), ("min", "s"), ("max", "s"), ("count", "s"), ("nunique", "b"), ("max", "b"), ("min", "b"), ("median", "t")]
    recipe = Recipe([Measure(f"{c}_{s}", s, c) for s, c in names], {f"{c}_{s}": f"{c}_{s}" for s, c in names})
    rows = {r.k: tuple(r)[1:] for r in measures.reduce_panel(df, spec, [recipe]).collect()}
    assert rows == {"a": ("z", "é", None, "z", "é", 2, 2, True, False, 2.0), "b": (None, None, None, None, None, 0, 0, None, None, 1.0)}


def test_decimals_take_the_plain_way(spark):
    df = spark.sql("SELECT 1 AS k, id AS t, CAST(id AS DECIMAL(10, 2)) AS x FROM range(4)")
    row = fam.family("basic_stat", df, PanelSpec(key="k", ts="t"), stats=("mean", "median", "last")).first()
    assert [float(v) for v in row[1:]] == [1.5, 1.5, 3.0]


def test_many_cells_make_a_key_hot(spark, monkeypatch):
    limits = []
    monkeypatch.setattr(measures, "find_hot_keys", lambda rows, key, limit: limits.append(limit) or measures.HotKeys(None))
    df = spark.createDataFrame([(1, 1, *[0.0] * 200)], "k int, t int, " + ", ".join(f"x{i} double" for i in range(200)))
    fam.family("basic_stat", df, PanelSpec(key="k", ts="t"))
    assert limits == [measures.CELLS_PER_KEY // 200]


def test_no_value_lists_in_the_plan(ragged):
    plan = fam.build(ragged, SPEC, MOST)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "MapInArrow" in plan


# measures that share a name


def test_one_name_with_two_meanings(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 7.0), (1, 3, None)], "k int, t int, x double")
    spec = PanelSpec(key="k", ts="t")
    both = ["max_min_diff", ("avg_max_last", {"last": ("x",)})]
    for order in (both, both[::-1]):
        row = fam.build(df, spec, order).first()
        assert row["x_last_min_diff"] == 2.0 and row["x_last"] is None
    for order in (["basic_stat", both[1]], [both[1], "basic_stat"]):
        with pytest.raises(ValueError, match="x_last"):
            fam.build(df, spec, order)
    row = fam.build(df, spec, ["basic_stat", ("avg_max_last", {"last": ("x",), "max": ("x",), "last_suffix": "newest"})]).first()
    assert (row["x_last"], row["x_newest"], row["x_max"]) == (7.0, None, 7.0)


def test_renaming_leaves_literals(spark):
    got = measures._renamed("IF(hi > 0, 'hi `hi`', `hi`) + hi_2 + `a``b`", {"hi": "_m0", "a`b": "_m1"})
    assert got == "IF(_m0 > 0, 'hi `hi`', _m0) + hi_2 + _m1"


def test_apostrophe_in_a_column_name_of_a_large_key(spark):
    df = spark.range(300).selectExpr("1 AS k", "id AS t", "CAST(pmod(xxhash64(id), 101) AS DOUBLE) AS `it's`")
    small, large = (fam.family("basic_stat", df, PanelSpec(key="k", ts="t"), rows_per_key=n).first() for n in (None, 100))
    assert small["it's_median"] == large["it's_median"] == np.median([r[0] for r in df.select("it's").collect()])


# order


@pytest.mark.parametrize("rows", [10_000, 40])
def test_running_sums_by_group(spark, monkeypatch, rows):
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", rows)
    monkeypatch.setattr(ordering, "GROUP", 3)
    df = spark.range(1500).selectExpr("id", "IF(id % 3 = 0, 7, IF(id % 100 = 1, NULL, id % 5)) AS g", "pmod(xxhash64(id), 50) AS s", "IF(id % 9 = 0, NULL, id % 4) AS v")
    got = ordering.with_running(df.repartition(4), ["s", "id"], {"run": "v", "half": "v / 2"}, by="g").toPandas()
    want = df.toPandas().sort_values(["s", "id"])
    want["v"] = want["v"].fillna(0)
    group = want.groupby("g", dropna=False)["v"]
    want["run"], want["run_total"] = group.cumsum(), group.transform("sum")
    both = want.merge(got, on="id")
    assert len(got) == 1500
    assert np.array_equal(both["run_x"], both["run_y"]) and np.array_equal(both["run_total_x"], both["run_total_y"])
    assert np.allclose(both["half"], both["run_x"] / 2)


def test_input_of_an_order_is_computed_once(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 50)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(400).mapInArrow(count, "id long")
    assert ordering.with_position(df, ["id"]).agg(F.sum("position")).first()[0] == 400 * 399 // 2
    assert seen.value == 400


def test_gaps_over_many_buckets(spark, monkeypatch):
    df = spark.range(500).selectExpr("id % 3 AS k", "TIMESTAMP_NTZ'2020-01-01' + make_dt_interval(CAST(id * id % 997 AS INT)) AS t", "id")
    spec = PanelSpec(key="k", ts="t", tiebreak=("id",))
    one = {r.id: r.gap for r in consecutive_gaps(df, spec, "gap").collect()}
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 20)
    monkeypatch.setattr(ordering, "GROUP", 4)
    assert {r.id: r.gap for r in consecutive_gaps(df, spec, "gap").collect()} == one
    assert sum(v is None for v in one.values()) == 3


@pytest.mark.parametrize("rows", [10_000, 60])
def test_scores_by_group_in_one_pass(spark, monkeypatch, rows):
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", rows)
    df = spark.range(900).selectExpr(
        "id AS key", "CAST(id % 4 AS INT) AS fold", "CAST(pmod(xxhash64(id), 5) = 0 AND id % 4 < 3 AS INT) AS target", "round(pmod(xxhash64(id, 1), 100) / 100, 1) AS p"
    ).cache()
    for score in (lambda d, by=None: metrics.default_metric(d, "target", "p", "key", by=by), lambda d, by=None: metrics.roc_auc(d, "target", "p", by)):
        got = {r[0]: r[1] for r in score(df, "fold").collect()}
        assert set(got) == {0, 1, 2, 3} and got[3] is None
        for fold in (0, 1, 2):
            assert got[fold] == pytest.approx(score(df.where(f"fold = {fold}")).first()[0], abs=1e-12)


def test_histogram_ignores_unknown_and_outside_scores(spark):
    df = spark.createDataFrame([(0, 0.1), (0, None), (0, 1.5), (0, -0.3), (0, 0.99)], "target int, p double")
    out = {r["bin"]: r["n"] for r in metrics.prediction_histogram(df, "target", "p").collect()}
    assert {b: n for b, n in out.items() if n} == {2: 1, 19: 1}


# pairs of columns


@pytest.mark.parametrize("tile", [256, 2])
def test_pair_sums(spark, monkeypatch, tile):
    monkeypatch.setattr(gramian, "TILE", tile)
    rng = np.random.RandomState(1)
    x = rng.randn(400, 5) @ rng.randn(5, 5) + 1e6
    x[rng.rand(400, 5) < 0.2] = np.nan
    x[:, 3] = 2.0
    pdf = pd.DataFrame(x, columns=list("abcde"))
    df = spark.createDataFrame(pdf).repartition(6)
    got = {(r.a, r.b): r.corr for r in selection.correlation_pairs(df, list("abcde")).collect()}
    want = pdf.corr(min_periods=2)
    assert len(got) == 10
    for (a, b), v in got.items():
        assert (v is None) if "d" in (a, b) else v == pytest.approx(want.loc[a, b], abs=1e-9)
    filled = pdf.fillna(pdf.mean())
    means, moments = gramian.mean_filled(gramian.gramian(df, list("abcde")))
    assert np.allclose(means, filled.mean()) and np.allclose(moments / 399, filled.cov(), atol=1e-8)
    axes = selection.principal_axes(df, list("abcde"), 3)
    assert np.allclose(axes.variances, np.sort(np.linalg.eigvalsh(filled.cov()))[::-1][:3])
    keyed = df.withColumn("key", F.monotonically_increasing_id())
    on = selection.project(keyed, axes, "key").toPandas()
    assert np.allclose(on[["pca_0", "pca_1", "pca_2"]].var(), axes.variances)


def test_wide_correlations_take_one_scan(spark):
    df = spark.range(300).select("id", *[F.rand(i).alias(f"x{i}") for i in range(300)])
    names = [f"x{i}" for i in range(300)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = df.mapInArrow(count, df.schema)
    found = gramian.gramian(counted, names)
    assert seen.value <= 300 + gramian.HEAD
    assert gramian.correlations(found).count() == 300 * 299 // 2 and gramian.correlations(found, above=0.5).count() == 0


# models


@pytest.fixture(scope="module")
def learnable(spark):
    return spark.range(400).selectExpr(
        "id AS key", "CAST(pmod(xxhash64(id), 10) < 1 + 7 * (id % 2) AS INT) AS target",
        "IF(id % 11 = 0, DOUBLE('NaN'), CAST(id % 2 AS DOUBLE)) AS good", "CAST(pmod(xxhash64(id, 5), 50) AS DOUBLE) AS noise",
    ).cache()


def test_patience_cuts_at_the_best_stage(spark, learnable):
    got = cv.cross_validate(learnable, ["good", "noise"], "target", "key", 2, {"maxIter": 12, "maxDepth": 4, "stepSize": 0.5}, patience=3)
    folded = cv.stratified_folds(learnable, "target", "key", 2)
    for i, model in enumerate(got.models):
        losses = [r.loss for r in got.stages.where(f"fold = {i}").orderBy("stage").collect()]
        chosen = [r.stage for r in got.stages.where(f"fold = {i} AND is_chosen = 1").collect()]
        stop = next((s for s in range(3, 12) if min(losses[s - 2 : s + 1]) >= min(losses[: s - 2])), 11)
        assert chosen == [int(np.argmin(losses[: stop + 1]))]
        assert model.tree.getNumTrees == chosen[0] + 1 and len(losses) == 12
        part = folded.where(f"fold = {i}").select("key", "target").join(cv.predict(learnable, [model], "key"), "key").toPandas()
        p = part["prediction_0"].clip(1e-15, 1 - 1e-15)
        loss = -2 * np.mean(part["target"] * np.log(p) + (1 - part["target"]) * np.log(1 - p)) / 2
        assert losses[chosen[0]] == pytest.approx(2 * loss, rel=1e-6)


def test_best_stage():
    assert cv.best_stage([5, 4, 3, 4, 4, 1], 2) == 2
    assert cv.best_stage([5, 4, 3, 4, 4, 1], 3) == 5
    assert cv.best_stage([1.0], 50) == 0


def test_models_with_their_own_features(spark, learnable):
    one = cv.cross_validate(learnable, ["good"], "target", "key", 2, {"maxIter": 2, "maxDepth": 2}, first_fold_only=True).models
    two = cv.cross_validate(learnable, ["noise", "good"], "target", "key", 2, {"maxIter": 2, "maxDepth": 2}, first_fold_only=True).models
    both = cv.predict(learnable, one + two, "key").toPandas().sort_values("key")
    for i, m in enumerate(one + two):
        alone = cv.predict(learnable, [m], "key").toPandas().sort_values("key")
        assert np.array_equal(both[f"prediction_{i}"], alone["prediction_0"])
    assert both["prediction_0"].nunique() <= 3 and both["prediction_1"].nunique() > 3


def test_sentinels_do_not_see_held_out_rows(spark):
    df = spark.createDataFrame([(0, -100.0, 0), (1, 5.0, 1), (2, 7.0, 1)], "key int, x double, fold int")
    assert cv.fold_sentinels(df, ["x"], 2) == [{"x": 5.0 - 5.0 - 1}, {"x": -100.0 - 100.0 - 1}]


def test_side_by_side_keeps_order_and_stops_at_a_failure(spark):
    assert pool.side_by_side(spark, [lambda i=i: spark.range(10 * i).count() for i in range(6)]) == [0, 10, 20, 30, 40, 50]
    begun = []

    def slow(i):
        begun.append(i)
        return spark.range(4).mapInArrow(lambda batches: (time.sleep(20) or b for b in batches), "id long").count()

    def fails():
        raise KeyError("trial")

    start = time.time()
    with pytest.raises(KeyError):
        pool.side_by_side(spark, [lambda: slow(0), fails, *[lambda i=i: slow(i) for i in range(1, 6)]], at_once=2)
    assert time.time() - start < 60 and len(begun) <= 2


def test_ensemble_of_models_that_lack_a_key(spark):
    models = {n: spark.createDataFrame(rows, "key int, prediction double") for n, rows in (("a", [(1, 0.5), (2, 0.4)]), ("b", [(1, 0.6)]))}
    for method, want in (("avg", 0.55), ("min", 0.5), ("max", 0.6)):
        got = {r.key: r.prediction for r in blend.ensemble(models, "key", method=method).collect()}
        assert got == {1: pytest.approx(want), 2: None}


# store


def test_manifest_opens_a_family_in_a_new_session(spark, tmp_path):
    root = str(tmp_path)
    for family in ("one", "two"):
        store.write_family(spark.range(200).selectExpr("id AS k", f"id * 2 AS {family}_x"), root, family, "train", "k", 4)
    for family in ("one", "two"):  # as if no session had ever seen it
        spark.sql(f"DROP TABLE {store._table_name(root, family, 'train')}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wide = store.assemble(spark, root, "train", {"one": "all", "two": "all"}, "k")
        assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
        assert wide.where("two_x = 2 * k AND one_x = 2 * k").count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        store.open_bucketed(spark, root, "one", "train", "k", 8)


def test_manifest_refuses_other_files(spark, tmp_path):
    root = str(tmp_path)
    store.write_family(spark.range(20).selectExpr("id AS k"), root, "f", "train", "k", 2)
    spark.range(30).selectExpr("id AS k").write.mode("overwrite").parquet(f"{root}/f/train")
    with pytest.raises(ValueError, match="manifest"):
        store.read_family(spark, root, "f", "train")


def test_submission_must_match_the_keys(spark, tmp_path):
    from pyspark.errors import PySparkException

    keys = spark.createDataFrame([("x",), ("y",)], "id string")
    good = spark.createDataFrame([("x", 0.25), ("y", 0.5)], "id string, p double")
    tables.write_submission(good, "id", f"{tmp_path}/good", "p", keys)
    assert tables.read_predictions(spark, f"{tmp_path}/good", "id").count() == 2
    for bad in (good.limit(1), good.union(good.limit(1)), good.union(spark.createDataFrame([("z", 0.1)], good.schema))):
        with pytest.raises(PySparkException):
            tables.write_submission(bad, "id", f"{tmp_path}/bad", "p", keys)
    with pytest.raises(PySparkException):
        tables.write_submission(good, "id", f"{tmp_path}/bad", "p", keys.union(keys.limit(1)))
