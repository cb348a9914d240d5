"""Feature families: each turns a panel into one row per key.

Every family has a recipe function ``*_recipe(panel, spec, ...)``. ``family`` runs one recipe,
``build`` runs any number of them in one shared plan, ``register`` adds your own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame

from panelwise.functions.scalar import day_gap_sql, quoted, ratio_sql
from panelwise.plans.measures import AGE, GAP, Measure, Recipe, newest_rows, reduce_panel
from panelwise.plans.segments import RowSet
from panelwise.spec import PanelSpec

# Statistics, periods, lags and seeds of the families.
NUMERIC_STATS = ("mean", "std", "min", "max", "last", "sum", "median")
FIVE_STATS = ("mean", "std", "min", "max", "last")
CATEGORICAL_STATS = ("count", "last", "nunique")
PERIOD_STATS = ("mean", "std", "min", "max", "sum", "median")
PERIODS = (100, 200)
LAGS = (1, 2)
MIX_SEEDS = (32, 42)


def _stat(column: str, stat: str) -> Measure:
    return Measure(f"{column}_{stat}", stat, quoted(column))


def _as_outputs(measures: list[Measure]) -> Recipe:
    return Recipe(measures, {m.name: quoted(m.name) for m in measures})


def _of(column: str, *stats: str) -> list[str]:
    return [quoted(f"{column}_{s}") for s in stats]


def basic_stat_recipe(
    panel: DataFrame,
    spec: PanelSpec,
    stats: Sequence[str] = NUMERIC_STATS,
    categorical_stats: Sequence[str] = CATEGORICAL_STATS,
) -> Recipe:
    """``{column}_{stat}`` for every numeric and every categorical column."""
    return _as_outputs(
        [_stat(c, s) for c in spec.numeric_columns(panel) for s in stats]
        + [_stat(c, s) for c in spec.categorical_columns(panel) for s in categorical_stats]
    )


def period_stat_recipe(
    panel: DataFrame,
    spec: PanelSpec,
    periods: Sequence[int] = PERIODS,
    stats: Sequence[str] = PERIOD_STATS,
) -> Recipe:
    """``{column}_{stat}_{n}days`` over the rows less than n days older than the key's newest row."""
    return _as_outputs(
        [
            Measure.over(f"{c}_{s}_{n}days", s, quoted(c), RowSet("within", n), spec.ts)
            for n in periods
            for c in spec.numeric_columns(panel)
            for s in stats
        ]
    )


def max_min_diff_recipe(panel: DataFrame, spec: PanelSpec) -> Recipe:
    columns = spec.numeric_columns(panel)
    outputs = {}
    for c in columns:
        last, low, high = _of(c, "last", "min", "max")
        outputs[f"{c}_last_min_diff"] = f"{last} - {low}"
        outputs[f"{c}_last_max_diff"] = f"{last} - {high}"
        outputs[f"{c}_max_min_diff"] = f"{high} - {low}"
    return Recipe([_stat(c, s) for c in columns for s in ("last", "min", "max")], outputs)


def last_mean_diff_recipe(panel: DataFrame, spec: PanelSpec) -> Recipe:
    columns = spec.numeric_columns(panel)
    return Recipe(
        [_stat(c, s) for c in columns for s in ("last", "mean")],
        {f"{c}_last_mean_diff": " - ".join(_of(c, "last", "mean")) for c in columns},
    )


def _last_before(column: str, k: int, spec: PanelSpec) -> Measure:
    """Last known value of the column shifted by k rows: the newest k rows are left out."""
    return Measure.over(f"{column}_shift{k}_last", "last", quoted(column), RowSet("older", k), spec.ts)


def div_recipe(panel: DataFrame, spec: PanelSpec) -> Recipe:
    """First, mean and previous value relative to the last one; NULL where the last one is zero."""
    columns = spec.numeric_columns(panel)
    outputs = {}
    for c in columns:
        first, last, mean, previous = _of(c, "first", "last", "mean", "shift1_last")
        outputs[f"{c}_div_first_last"] = ratio_sql(first, last)
        outputs[f"{c}_div_mean_last"] = ratio_sql(mean, last)
        outputs[f"{c}_div_last1_last"] = ratio_sql(previous, last)
    measures = [_stat(c, s) for c in columns for s in ("first", "last", "mean")]
    return Recipe(measures + [_last_before(c, 1, spec) for c in columns], outputs)


def div_min_max_recipe(panel: DataFrame, spec: PanelSpec) -> Recipe:
    columns = spec.numeric_columns(panel)
    outputs = {}
    for c in columns:
        last, low, high = _of(c, "last", "min", "max")
        outputs[f"{c}_div_min_last"] = ratio_sql(low, last)
        outputs[f"{c}_div_max_last"] = ratio_sql(high, last)
        outputs[f"{c}_div_min_max"] = ratio_sql(low, high)
    return Recipe([_stat(c, s) for c in columns for s in ("last", "min", "max")], outputs)


def date_gaps_recipe(panel: DataFrame, spec: PanelSpec) -> Recipe:
    """Statistics of the whole days between consecutive rows, and days from first to last row."""
    gaps = [
        Measure(f"diff_days_{s}", s, GAP, frozenset({GAP}))
        for s in ("mean", "std", "min", "max", "sum", "median")
    ]
    ends = [Measure(f"_ts_{s}", s, quoted(spec.ts)) for s in ("min", "max")]
    outputs = {m.name: quoted(m.name) for m in gaps}
    outputs["diff_first_last_day"] = day_gap_sql("_ts_max", "_ts_min")
    return Recipe(gaps + ends, outputs)


def shift_recipe(panel: DataFrame, spec: PanelSpec, lags: Sequence[int] = LAGS) -> Recipe:
    """``{column}_shift{k}_last``: last known value of every column after shifting it by k rows."""
    columns = spec.numeric_columns(panel) + spec.categorical_columns(panel)
    return _as_outputs([_last_before(c, k, spec) for k in lags for c in columns])


def lag_diff_recipe(
    panel: DataFrame, spec: PanelSpec, lags: Sequence[int] = LAGS, as_float: bool = True
) -> Recipe:
    """``{column}_diff{k}``: newest row minus the row k before it; NULL if either value is missing."""
    columns = spec.numeric_columns(panel)
    depth = 1 + max(lags)

    def at(c: str, age: int) -> Measure:
        return Measure.over(f"{c}_age{age}", "max", quoted(c), RowSet("at", age), spec.ts, newest=depth)

    outputs = {}
    for k in lags:
        for c in columns:
            diff = " - ".join(_of(c, "age1", f"age{1 + k}"))
            outputs[f"{c}_diff{k}"] = f"CAST({diff} AS FLOAT)" if as_float else diff
    return Recipe([at(c, a) for c in columns for a in sorted({1, *[1 + k for k in lags]})], outputs)


def important_double_recipe(panel: DataFrame, spec: PanelSpec, columns: Sequence[str]) -> Recipe:
    """Squares of std, min, max and last of chosen columns."""
    measures = [_stat(c, s) for c in columns for s in ("std", "min", "max", "last")]
    return Recipe(measures, {f"{m.name}_double": f"{quoted(m.name)} * {quoted(m.name)}" for m in measures})


def important_cross_recipe(panel: DataFrame, spec: PanelSpec, columns: Sequence[str]) -> Recipe:
    """Product of the last values of every pair of chosen columns, in list order."""
    return Recipe(
        [_stat(c, "last") for c in columns],
        {
            f"cross_{a}_{b}": f"{quoted(a + '_last')} * {quoted(b + '_last')}"
            for a, b in combinations(columns, 2)
        },
    )


def mix_ratios(columns: Sequence[str], seed: int) -> dict[tuple[str, str], float]:
    """One weight per pair, drawn in pair order from the legacy NumPy generator."""
    pairs = list(combinations(columns, 2))
    return dict(zip(pairs, map(float, np.random.RandomState(seed).rand(len(pairs)))))


def important_mix_recipe(
    panel: DataFrame, spec: PanelSpec, columns: Sequence[str], seed: int = MIX_SEEDS[0]
) -> Recipe:
    """Weighted sum of the last values of every pair of chosen columns."""
    return Recipe(
        [_stat(c, "last") for c in columns],
        {
            f"mix_{a}_{b}_{seed}": f"{quoted(a + '_last')} * {r}D + {quoted(b + '_last')} * {1 - r}D"
            for (a, b), r in mix_ratios(columns, seed).items()
        },
    )


def avg_max_last_recipe(
    panel: DataFrame,
    spec: PanelSpec,
    avg: Sequence[str] = (),
    max: Sequence[str] = (),
    last: Sequence[str] = (),
    last_suffix: str = "last",
) -> Recipe:
    """Chosen averages and maxima, and chosen columns of the newest row (NULL stays NULL).

    Beside a family that has ``{column}_last`` as the last known value, give ``last_suffix`` another name.
    """
    return _as_outputs(
        [Measure(f"{c}_{last_suffix}", "last_row", quoted(c)) for c in last]
        + [Measure(f"{c}_max", "max", quoted(c)) for c in max]
        + [Measure(f"{c}_avg", "mean", quoted(c)) for c in avg]
    )


RECIPES: dict[str, Callable[..., Recipe]] = {
    "basic_stat": basic_stat_recipe,
    "period_stat": period_stat_recipe,
    "max_min_diff": max_min_diff_recipe,
    "last_mean_diff": last_mean_diff_recipe,
    "div": div_recipe,
    "div_min_max": div_min_max_recipe,
    "date_gaps": date_gaps_recipe,
    "shift": shift_recipe,
    "lag_diff": lag_diff_recipe,
    "important_double": important_double_recipe,
    "important_cross": important_cross_recipe,
    "important_mix": important_mix_recipe,
    "avg_max_last": avg_max_last_recipe,
}


def register(name: str, recipe: Callable[..., Recipe]) -> None:
    """Add a family of your own: a function ``(panel, spec, **options) -> Recipe``."""
    RECIPES[name] = recipe


def family(
    name: str, panel: DataFrame, spec: PanelSpec, rows_per_key: int | None = None, **options
) -> DataFrame:
    """One family as a table ``(key, features...)``."""
    return reduce_panel(panel, spec, [RECIPES[name](panel, spec, **options)], rows_per_key)


def build(
    panel: DataFrame,
    spec: PanelSpec,
    families: Sequence[str | tuple[str, dict]],
    rows_per_key: int | None = None,
) -> DataFrame:
    """Several families side by side in one plan, e.g. ``["basic_stat", ("shift", {"lags": [1]})]``."""
    chosen = [(f, {}) if isinstance(f, str) else f for f in families]
    return reduce_panel(panel, spec, [RECIPES[n](panel, spec, **o) for n, o in chosen], rows_per_key)


def last_mean_from_columns(features: DataFrame) -> DataFrame:
    """Add ``X_last_mean_diff`` for every X that has both ``X_last`` and ``X_mean`` in the table."""
    stems = [c.removesuffix("_last") for c in features.columns if c.endswith("_last")]
    return features.selectExpr(
        "*",
        *[
            f"{' - '.join(_of(x, 'last', 'mean'))} AS {quoted(x + '_last_mean_diff')}"
            for x in stems
            if f"{x}_mean" in features.columns
        ],
    )


def last_row(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """The newest row of every key, whole."""
    return newest_rows(spec.prepare(panel), spec, 1).drop(AGE)
