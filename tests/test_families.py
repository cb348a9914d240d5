"""Hand-computed panels for NULL, tie and zero rules, and the shape of the plans."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwise.operators import families as fam
from panelwise.operators.families import Recipe
from panelwise.plans.measures import Measure
from panelwise.spec import PanelSpec

SPEC = PanelSpec(key="k", ts="t", tiebreak=("id",), categorical=("c",), numeric=("x",))


def panel(spark, rows):
    """rows: (k, day, x, c); id is the place in the list."""
    data = [(k, f"2020-01-{d:02d}", i, x, c) for i, (k, d, x, c) in enumerate(rows)]
    return spark.createDataFrame(data, "k int, t string, id int, x double, c string")


def by_key(df):
    return {r[0]: r.asDict() for r in df.collect()}


NULLS = [(1, 1, 1.0, "a"), (1, 2, 4.0, "b"), (1, 3, None, None), (2, 1, 5.0, "a"), (3, 1, None, None), (3, 2, None, None)]


@pytest.mark.parametrize("limit", [None, 0])
def test_nulls(spark, limit):
    out = by_key(fam.family("basic_stat", panel(spark, NULLS), SPEC, rows_per_key=limit))
    assert [out[k]["x_last"] for k in (1, 2, 3)] == [4.0, 5.0, None]
    assert [out[k]["x_sum"] for k in (1, 2, 3)] == [5.0, 5.0, 0.0]
    assert [out[k]["x_mean"] for k in (1, 2, 3)] == [2.5, 5.0, None]
    assert [out[k]["x_median"] for k in (1, 2, 3)] == [2.5, 5.0, None]
    assert out[1]["x_std"] == pytest.approx(2.1213, abs=1e-4) and out[2]["x_std"] is None and out[3]["x_std"] is None
    assert [out[k]["c_count"] for k in (1, 2, 3)] == [2, 1, 0]
    assert [out[k]["c_nunique"] for k in (1, 2, 3)] == [2, 1, 0]
    assert [out[k]["c_last"] for k in (1, 2, 3)] == ["b", "a", None]


def test_newest_row_keeps_null(spark):
    out = by_key(fam.family("avg_max_last", panel(spark, NULLS), SPEC, last=["x"]))
    assert [out[k]["x_last"] for k in (1, 2, 3)] == [None, 5.0, None]


@pytest.mark.parametrize("limit", [None, 0])
def test_shift_takes_last_known_earlier_value(spark, limit):
    out = by_key(fam.family("shift", panel(spark, NULLS), SPEC, rows_per_key=limit))
    assert [out[k]["x_shift1_last"] for k in (1, 2, 3)] == [4.0, None, None]
    assert [out[k]["x_shift2_last"] for k in (1, 2, 3)] == [1.0, None, None]


def test_zero_divisor_gives_null(spark):
    rows = [(1, 1, 3.0, "a"), (1, 2, 0.0, "a"), (2, 1, 0.0, "a")]
    out = by_key(fam.family("div", panel(spark, rows), SPEC))
    assert out[1]["x_div_first_last"] is None and out[2]["x_div_mean_last"] is None
    out = by_key(fam.family("div_min_max", panel(spark, rows), SPEC))
    assert out[1]["x_div_min_max"] == 0.0 and out[2]["x_div_min_max"] is None


def test_equal_dates_follow_the_tiebreak(spark):
    rows = [(1, 5, 1.0, "a"), (1, 5, 2.0, "b"), (1, 5, 3.0, "c")]
    df = panel(spark, rows)
    for shown in (df, df.orderBy(F.col("id").desc())):
        out = by_key(fam.family("basic_stat", shown, SPEC, stats=("last", "first")))
        assert (out[1]["x_first"], out[1]["x_last"], out[1]["c_last"]) == (1.0, 3.0, "c")


def test_lag_diff_needs_enough_rows(spark):
    rows = [(1, 1, 1.0, "a"), (1, 2, 4.0, "a"), (1, 3, 9.0, "a"), (2, 1, 1.0, "a"), (2, 2, 3.0, "a")]
    df = fam.family("lag_diff", panel(spark, rows), SPEC)
    out = by_key(df)
    assert (out[1]["x_diff1"], out[1]["x_diff2"]) == (5.0, 8.0)
    assert (out[2]["x_diff1"], out[2]["x_diff2"]) == (2.0, None)
    assert dict(df.dtypes)["x_diff1"] == "float"


def test_period_is_strict_and_in_24_hour_days(spark):
    rows = [(1, "2020-01-01 00:00:00", 1.0), (1, "2020-01-01 00:00:01", 2.0), (1, "2020-01-11 00:00:00", 4.0)]
    df = spark.createDataFrame(rows, "k int, t string, x double")
    spec = PanelSpec(key="k", ts="t", numeric=("x",))
    out = by_key(fam.family("period_stat", df, spec, periods=(10,), stats=("sum",)))
    assert out[1]["x_sum_10days"] == 6.0


def test_gap_days_are_floored(spark):
    rows = [(1, "2020-01-01 12:00:00", 1.0), (1, "2020-01-03 11:59:59", 2.0), (2, "2020-01-01", 1.0)]
    df = spark.createDataFrame(rows, "k int, t string, x double")
    out = by_key(fam.family("date_gaps", df, PanelSpec(key="k", ts="t", numeric=("x",))))
    assert (out[1]["diff_days_max"], out[1]["diff_first_last_day"]) == (1, 1)
    assert (out[2]["diff_days_max"], out[2]["diff_days_sum"], out[2]["diff_first_last_day"]) == (None, 0, 0)


def test_rows_without_key_are_ignored(spark):
    df = panel(spark, NULLS).unionByName(panel(spark, [(None, 1, 7.0, "z")]))
    assert sorted(by_key(fam.family("basic_stat", df, SPEC))) == [1, 2, 3]


def test_own_family(spark):
    fam.register("spread", lambda p, s: Recipe([Measure("hi", "max", "x"), Measure("lo", "min", "x")], {"spread": "hi - lo"}))
    try:
        out = by_key(fam.build(panel(spark, NULLS), SPEC, ["spread", "last_mean_diff"]))
        assert out[1] == {"k": 1, "spread": 3.0, "x_last_mean_diff": 1.5}
    finally:
        del fam.RECIPES["spread"]


def test_mix_weights_follow_the_generator():
    ratios = list(fam.mix_ratios(["a", "b", "c"], 32).values())
    assert [round(r, 8) for r in ratios] == [0.85888927, 0.37271115, 0.55512878]


# --- one key with a third of all rows -----------------------------------------------------------

ALL = ["basic_stat", "period_stat", "div", "date_gaps", "shift", "lag_diff", ("avg_max_last", {"last": ["x", "c"], "last_suffix": "newest"})]


@pytest.fixture(scope="module")
def skewed(spark):
    n = 3000
    return spark.range(n).selectExpr(
        f"IF(id % 3 = 0, -1, CAST(pmod(xxhash64(id), 40) AS INT)) AS k",
        "TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_dt_interval(CAST(pmod(xxhash64(id, 1), 400) AS INT), CAST(pmod(id, 24) AS INT)) AS t",
        "id",
        "IF(pmod(xxhash64(id, 2), 7) = 0, NULL, round(pmod(xxhash64(id, 3), 1000) / 8, 3)) AS x",
        "IF(pmod(xxhash64(id, 4), 5) = 0, NULL, CAST(pmod(xxhash64(id, 5), 6) AS STRING)) AS c",
    )


@pytest.mark.parametrize("limit", [0, 60, 500])
def test_split_keys_give_the_same_features(spark, skewed, limit, monkeypatch):
    from panelwise.plans import ordering

    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 200)
    frames = [
        fam.build(skewed, SPEC, ALL, rows_per_key=n).toPandas().sort_values("k").reset_index(drop=True)
        for n in (10**9, limit)
    ]
    pd.testing.assert_frame_equal(frames[0], frames[1][frames[0].columns], rtol=1e-9)


def test_many_split_keys_without_broadcast(spark, skewed, monkeypatch):
    from panelwise.plans import skew

    monkeypatch.setattr(skew, "BROADCAST_ROWS", 5)
    frames = [
        fam.build(skewed, SPEC, ALL, rows_per_key=n).toPandas().sort_values("k").reset_index(drop=True)
        for n in (10**9, 30)
    ]
    pd.testing.assert_frame_equal(frames[0], frames[1][frames[0].columns], rtol=1e-9)


def test_split_plans_take_tasks_by_their_rows(spark, skewed, monkeypatch):
    from panelwise.plans import skew

    monkeypatch.setattr(skew, "ROWS_PER_TASK", 200)
    settings = (skew.PARTITIONS, skew.COALESCE, skew.READ)
    before = [spark.conf.get(n) for n in settings]
    out = fam.build(skewed, SPEC, ALL, rows_per_key=30)
    assert [spark.conf.get(n) for n in settings] == before
    assert len(out.inputFiles()) > int(before[0])  # 3000 rows: more tasks than the session's 8
    frames = [f.toPandas().sort_values("k").reset_index(drop=True) for f in (fam.build(skewed, SPEC, ALL, rows_per_key=10**9), out)]
    pd.testing.assert_frame_equal(frames[0], frames[1][frames[0].columns], rtol=1e-9)


def test_overlapping_sizes_go_back_to_the_session(spark, monkeypatch):
    from panelwise.plans import skew

    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    before, seen = spark.conf.get(skew.PARTITIONS), []
    first, second = skew.tasks_sized(spark, 300), skew.tasks_sized(spark, 205)
    for step in (first.__enter__, second.__enter__, lambda: first.__exit__(None, None, None), lambda: second.__exit__(None, None, None)):
        step()
        seen.append(spark.conf.get(skew.PARTITIONS))
    assert seen == ["30", "30", "21", before]


# --- plans ----------------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_families_share_one_shuffle(spark):
    text = plan(fam.build(panel(spark, NULLS), SPEC, ["basic_stat", "period_stat", "shift", "date_gaps", "lag_diff"]))
    assert text.count("Exchange hashpartitioning(k") == 1 and text.count("Exchange") == 1
    assert text.count("- Window ") == 0 and text.count("- Sort ") == 1


def test_order_free_statistics_aggregate_before_the_shuffle(spark):
    options = {"stats": ("mean", "std", "min", "max", "sum"), "categorical_stats": ("count",)}
    text = plan(fam.build(panel(spark, NULLS), SPEC, [("basic_stat", options), ("avg_max_last", {"max": ["x"]})]))
    assert "partial_max" in text and "Window" not in text and text.count("Exchange") == 1


def test_differences_share_one_shuffle(spark):
    text = plan(fam.build(panel(spark, NULLS), SPEC, ["max_min_diff", "last_mean_diff", "div_min_max", "div"]))
    assert text.count("Exchange") == 1 and text.count("- Window ") == 1


def test_newest_rows_are_cut_before_the_shuffle(spark):
    text = plan(fam.family("lag_diff", panel(spark, NULLS), SPEC))
    below_shuffle = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below_shuffle


def test_only_needed_columns_are_read(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    spec = PanelSpec(key="o_custkey", ts="o_orderdate", tiebreak=("o_orderkey",), numeric=("o_totalprice",))
    text = plan(fam.family("basic_stat", df, spec))
    schema = text[text.index("ReadSchema") :].split("\n")[0]
    assert "o_totalprice" in schema and "o_orderstatus" not in schema and "o_orderpriority" not in schema


# --- the full-width panel -----------------------------------------------------------------------

IMPORTANT = [f"n{i}" for i in range(14)]


@pytest.fixture(scope="module")
def wide(spark):
    numeric = [f"CAST(pmod(xxhash64(id, {i}), 97) AS DOUBLE) AS n{i}" for i in range(177)]
    categorical = [f"CAST(pmod(id, {i + 2}) AS STRING) AS c{i}" for i in range(11)]
    df = spark.range(40).selectExpr(
        "id % 4 AS k", "TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_dt_interval(CAST(id * 5 AS INT)) AS t", "id", *numeric, *categorical
    )
    return df, PanelSpec(key="k", ts="t", tiebreak=("id",), categorical=tuple(f"c{i}" for i in range(11)))


def test_width_of_the_feature_tables(wide):
    df, spec = wide
    five = ["basic_stat", "period_stat", "date_gaps", "last_mean_diff", "lag_diff"]
    rest = ["div_min_max", "max_min_diff"] + [
        ("important_double", {"columns": IMPORTANT}),
        ("important_cross", {"columns": IMPORTANT}),
        ("important_mix", {"columns": IMPORTANT, "seed": 32}),
        ("important_mix", {"columns": IMPORTANT, "seed": 42}),
    ]
    assert len(fam.build(df, spec, ["basic_stat"]).columns) == 1273
    assert len(fam.build(df, spec, five).columns) == 3935
    assert len(fam.build(df, spec, five + rest).columns) == 5326


def test_wide_panel_runs(wide):
    df, spec = wide
    rows = fam.build(df, spec, ["basic_stat"]).collect()
    assert len(rows) == 4 and all(len(r) == 1273 for r in rows)
