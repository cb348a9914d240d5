"""Family queries over the statement and event panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.operators import families as fam
from panelwise.plans.skew import consecutive_gaps
from workload.fixtures import EVENTS, IMPORTANT, STATEMENTS, as_float, statements, table


def _family(name: str, digits: int | None = 9, **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = fam.family(name, statements(spark, sf_dir), STATEMENTS, **options)
        return as_float(out, digits=digits)

    return run


def _whole_days(df: DataFrame) -> DataFrame:
    return as_float(df).withColumns(
        {f"diff_days_{s}": F.col(f"diff_days_{s}").cast("long") for s in ("min", "max", "sum")}
    )


def basic_stat_cat(spark, sf_dir):
    spec = STATEMENTS.__class__(**{**STATEMENTS.__dict__, "numeric": ()})
    return fam.family("basic_stat", statements(spark, sf_dir), spec)


def basic_stat_five(spark, sf_dir):
    out = fam.family(
        "basic_stat", statements(spark, sf_dir), STATEMENTS, stats=fam.FIVE_STATS, categorical_stats=()
    )
    return as_float(out)


def last_mean_from_columns(spark, sf_dir):
    base = fam.family(
        "basic_stat", statements(spark, sf_dir), STATEMENTS, stats=("mean", "last"), categorical_stats=()
    )
    return as_float(fam.last_mean_from_columns(base))


def date_gaps(spark, sf_dir):
    return _whole_days(fam.family("date_gaps", statements(spark, sf_dir), STATEMENTS))


def event_gaps(spark, sf_dir):
    return _whole_days(fam.family("date_gaps", table(spark, sf_dir, "events"), EVENTS))


def event_stat(spark, sf_dir):
    return as_float(fam.family("basic_stat", table(spark, sf_dir, "events"), EVENTS))


def row_gaps(spark, sf_dir):
    gaps = consecutive_gaps(statements(spark, sf_dir), STATEMENTS, "gap")
    return gaps.select("o_custkey", "o_orderkey", "gap")


def lag_diff_float(spark, sf_dir):
    return fam.family("lag_diff", statements(spark, sf_dir), STATEMENTS)


def avg_max_last(spark, sf_dir):
    return as_float(
        fam.family(
            "avg_max_last", statements(spark, sf_dir), STATEMENTS,
            avg=("o_totalprice", "qty"), max=("o_totalprice", "disc_price"), last=("qty", "avg_tax", "last_flag"),
        )
    )


def last_row(spark, sf_dir):
    out = as_float(fam.last_row(statements(spark, sf_dir), STATEMENTS))
    return out.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


ALL = (
    "basic_stat", "period_stat", "max_min_diff", "last_mean_diff", "div", "div_min_max", "date_gaps", "shift",
    ("lag_diff", {"as_float": False}), ("important_double", {"columns": IMPORTANT}), ("important_cross", {"columns": IMPORTANT}),
    *[("important_mix", {"columns": IMPORTANT, "seed": seed}) for seed in fam.MIX_SEEDS],
    ("avg_max_last", {"avg": ("o_totalprice", "qty"), "max": ("o_totalprice", "disc_price"), "last": ("qty", "avg_tax", "last_flag"), "last_suffix": "newest"}),
)


def all_families(spark, sf_dir, rows_per_key=None):
    """All 13 families with all their statistics, periods and lags in one plan: one shuffle by key serves them all."""
    out = fam.build(statements(spark, sf_dir), STATEMENTS, ALL, rows_per_key)
    return _whole_days(as_float(out, only=[c for c in out.columns if c.endswith("_double")], digits=None))


def all_families_split_keys(spark, sf_dir):
    """The same with every customer of more than 12 orders treated as too large for one task."""
    return all_families(spark, sf_dir, rows_per_key=12)


def queries() -> dict:
    q = {n: _family(n) for n in ("basic_stat", "period_stat", "max_min_diff", "last_mean_diff", "div", "div_min_max", "shift")}
    q |= {
        "basic_stat_cat": basic_stat_cat,
        "basic_stat_five": basic_stat_five,
        "last_mean_from_columns": last_mean_from_columns,
        "date_gaps": date_gaps,
        "row_gaps": row_gaps,
        "lag_diff": _family("lag_diff", as_float=False),
        "lag_diff_float": lag_diff_float,
        "important_double": _family("important_double", digits=None, columns=IMPORTANT),
        "important_cross": _family("important_cross", columns=IMPORTANT),
        "avg_max_last": avg_max_last,
        "last_row": last_row,
        "all_families": all_families,
        "all_families_split_keys": all_families_split_keys,
        "event_gaps": event_gaps,
        "event_stat": event_stat,
    }
    for seed in fam.MIX_SEEDS:
        q[f"important_mix{seed}"] = _family("important_mix", columns=IMPORTANT, seed=seed)
    return q
