"""Reduce a panel to one row per key, in one plan for any set of feature families.

A family is a ``Recipe``: the measures it needs per key and the output columns computed from them.
``reduce_panel`` merges the measures of all recipes and picks the cheapest plan that is safe when one
key holds a large share of the rows:

* only measures with small, order-free states (sums, extremes): a plain ``GROUP BY key``, combined
  map-side. States that carry the row order are several times larger than the value they stand for and
  force a map-side sort, so with them it is cheaper to ship the rows of ordinary keys themselves;
* only measures over the newest rows of each key: a per-key top-n (cut map-side) and a ``GROUP BY``;
* otherwise rows are shuffled by key once. Medians, and any ``WIDE`` set of measures, are computed from rows
  sorted by key, whole Arrow batches at a time (``plans.segments``); fewer measures by one window and one aggregate.
  Keys with more rows or cells than fit one task are kept out of that shuffle and reduced by ``_reduce_hot``.

Measures and outputs are SQL expressions, not Column objects: a wide panel has thousands of them, and
one SQL statement is much cheaper to build than as many Column calls. Measures are told apart by what they compute;
their names only serve the outputs of their own recipe.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from panelwise.functions.scalar import day_gap, quoted, within_days_sql
from panelwise.plans.ordering import written
from panelwise.plans.segments import GAP_COLUMN, RowSet, Wanted, reduce_sorted, suits
from panelwise.plans.skew import ROWS_PER_KEY, HotKeys, consecutive_gaps, find_hot_keys, tasks_sized
from panelwise.spec import PanelSpec

# columns a measure may read besides the panel's own
AGE = "_age"  # 1 for the newest row of a key, 2 for the one before, ...
NEWEST = "_newest"  # ts of the key's newest row
GAP = "_gap"  # whole days since the key's previous row
ROW = "_row"  # true for rows of the panel, NULL for rows that only carry a gap

ORDER_FREE = {"mean", "std", "min", "max", "sum", "count"}
COMBINING = ORDER_FREE | {"first", "last", "last_row"}

# SQL per statistic; {o} is the row order. first and last skip NULL values, last_row does not.
SQL = {
    "mean": "avg({x})",
    "std": "stddev_samp({x})",
    "min": "min({x})",
    "max": "max({x})",
    "sum": "coalesce(sum({x}), 0)",
    "count": "count({x})",
    "first": "min_by({x}, IF({x} IS NOT NULL, {o}, NULL))",
    "last": "max_by({x}, IF({x} IS NOT NULL, {o}, NULL))",
    "last_row": "max_by({x}, {o})",
    "median": "median({x})",
    "nunique": "CAST(size(collect_set({x})) AS BIGINT)",
}

WIDE = 100  # so many measures are computed batch by batch, not by one aggregate each
CELLS_PER_KEY = 1 << 24  # rows times measured columns of a key that one task may hold (8 bytes each)


@dataclass(frozen=True)
class Measure:
    """One aggregate per key: ``stat`` over the SQL expression ``value`` of a row.

    ``reads`` names the annotations used by ``value``; ``newest`` is set when the measure looks only
    at that many newest rows; ``older_than`` is set when it skips that many newest rows. A measure made by ``over``
    also says which ``column`` it reads from which ``rows``, so that it can be computed without annotations.
    """

    name: str
    stat: str
    value: str
    reads: frozenset[str] = frozenset()
    newest: int | None = None
    older_than: int = 0
    column: str | None = None
    rows: RowSet | None = None

    @staticmethod
    def over(name: str, stat: str, column: str, rows: RowSet, ts: str, newest: int | None = None) -> Measure:
        """``stat`` of the SQL expression ``column`` over some rows of each key."""
        reads, test = {
            "older": (AGE, f"{AGE} > {rows.n}"),
            "at": (AGE, f"{AGE} = {rows.n}"),
            "within": (NEWEST, within_days_sql(NEWEST, quoted(ts), rows.n)),
        }[rows.kind]
        older_than = {"older": rows.n, "at": (newest or rows.n) - 1, "within": 0}[rows.kind]
        return Measure(name, stat, f"IF({test}, {column}, NULL)", frozenset({reads}), newest, older_than, column, rows)

    @property
    def meaning(self) -> tuple[str, str]:
        return self.stat, self.value

    def sql(self, order: str) -> str:
        return f"{SQL[self.stat].format(x=self.value, o=order)} AS {quoted(self.name)}"


@dataclass
class Recipe:
    measures: list[Measure]
    outputs: dict[str, str]  # column name -> SQL over measure names


_TOKENS = re.compile(r"'(?:[^'\\]|\\.)*'|`((?:[^`]|``)+)`|[A-Za-z_]\w*")


def _renamed(sql: str, names: dict[str, str]) -> str:
    """The expression with measure names replaced, quoted or bare; string literals stay."""

    def other(token: re.Match) -> str:
        name = (token[1] or token[0]).replace("``", "`")
        return names.get(name, token[0]) if token[0][0] != "'" else token[0]

    return _TOKENS.sub(other, sql)


def merged(recipes: Sequence[Recipe]) -> tuple[list[Measure], dict[str, str]]:
    """The distinct measures of all recipes under names of their own, and the outputs over those names.

    Measures that compute the same are one. Recipes may use one name for different measures, but not for different
    output columns: that is an error.
    """
    known: dict[tuple[str, str], Measure] = {}
    outputs: dict[str, str] = {}
    for recipe in recipes:
        names = {}
        for m in recipe.measures:
            own = known.setdefault(m.meaning, replace(m, name=f"_m{len(known)}"))
            if (own.newest, own.older_than) != (m.newest, m.older_than):  # looks at as many rows as any of its users
                wide = None if None in (own.newest, m.newest) else max(own.newest, m.newest)
                known[m.meaning] = replace(own, newest=wide, older_than=max(own.older_than, m.older_than))
            names[m.name] = own.name
        for name, sql in recipe.outputs.items():
            own = _renamed(sql, names)
            if outputs.setdefault(name, own) != own:
                raise ValueError(f"two families give column {name!r} different meanings; rename it in one of them")
    return list(known.values()), outputs


def reduce_panel(
    panel: DataFrame, spec: PanelSpec, recipes: Sequence[Recipe], rows_per_key: int | None = None
) -> DataFrame:
    """One row per key with the outputs of all recipes (a repeated output is kept once)."""
    measures, outputs = merged(recipes)
    rows = spec.prepare(panel)
    if all(m.newest for m in measures):
        kept = newest_rows(rows, spec, max((m.newest for m in measures), default=1))
        reduced = _grouped(kept, spec.key, measures, f"-{AGE}")
    elif all(m.stat in ORDER_FREE and not m.reads for m in measures):
        reduced = _grouped(rows, spec.key, measures, _order(spec))
    else:
        reduced = _reduce_any(rows, spec, measures, rows_per_key)
    return reduced.selectExpr(quoted(spec.key), *[f"{e} AS {quoted(n)}" for n, e in outputs.items()])


def _order(spec: PanelSpec) -> str:
    return f"struct({', '.join(quoted(c) for c in spec.order)})"


def _grouped(rows: DataFrame, key: str, measures: Iterable[Measure], order: str) -> DataFrame:
    columns = ",\n".join([quoted(key), *[m.sql(order) for m in measures]])
    return rows.sparkSession.sql(f"SELECT {columns} FROM {{rows}} GROUP BY {quoted(key)}", rows=rows)


def _batched(rows: DataFrame, spec: PanelSpec, measures: Sequence[Measure]) -> DataFrame | None:
    """Like ``_grouped`` for keys of limited size, from sorted rows; None if a column's type does not allow it."""
    unsplit = [m for m in measures if m.rows is None and m.reads and m.value != GAP]
    if unsplit:
        rows = _annotated(rows, spec, frozenset().union(*[m.reads for m in unsplit]))
    read = [m.value if m.rows is None else m.column for m in measures]
    columns = list(dict.fromkeys(x for x in read if x != GAP))
    at = {x: i for i, x in enumerate(columns)} | {GAP: GAP_COLUMN}
    types = rows.selectExpr(*[f"{x} AS _v{i}" for i, x in enumerate(columns)]).schema
    if not all(x == GAP or suits(m.stat, types[at[x]].dataType) for m, x in zip(measures, read)):
        return None
    wanted = [Wanted(m.stat, at[x], m.rows) for m, x in zip(measures, read)]
    return reduce_sorted(rows, spec.key, spec.order, spec.ts, columns, wanted, [m.name for m in measures])


def _newest_first(spec: PanelSpec):
    return Window.partitionBy(spec.key).orderBy(*[F.col(c).desc() for c in spec.order])


def newest_rows(rows: DataFrame, spec: PanelSpec, n: int) -> DataFrame:
    """The ``n`` newest rows of each key, with their age. Each map task ships at most n rows per key."""
    return rows.withColumn(AGE, F.row_number().over(_newest_first(spec))).where(F.col(AGE) <= n)


def _annotated(rows: DataFrame, spec: PanelSpec, reads: frozenset[str]) -> DataFrame:
    w = _newest_first(spec)
    notes = {
        AGE: lambda: F.row_number().over(w),
        NEWEST: lambda: F.first(spec.ts).over(w),
        GAP: lambda: day_gap(F.col(spec.ts), F.lead(spec.ts).over(w)),
    }
    return rows.select("*", *[notes[n]().alias(n) for n in notes if n in reads])


def _reduce_any(
    rows: DataFrame, spec: PanelSpec, measures: list[Measure], rows_per_key: int | None
) -> DataFrame:
    batched = len(measures) >= WIDE or any(m.stat == "median" for m in measures)
    if rows_per_key is None and batched:
        width = len({m.column or m.value for m in measures})
        rows_per_key = max(1, min(ROWS_PER_KEY, CELLS_PER_KEY // width))
    hot = find_hot_keys(rows, spec.key, rows_per_key)
    ordinary, crowded = hot.split(rows, spec.key)
    reads = frozenset().union(*[m.reads for m in measures])
    reduced = _batched(ordinary, spec, measures) if batched else None
    if reduced is None:
        reduced = _grouped(_annotated(ordinary, spec, reads | {AGE}), spec.key, measures, f"-{AGE}")
    if crowded is None:
        return reduced
    # medians and distinct counts of large keys make a row of every value
    values = len({m.value for m in measures if m.stat in ("median", "nunique")})
    with tasks_sized(rows.sparkSession, hot.total + hot.rows * values):
        return written(reduced.unionByName(_reduce_hot(crowded, spec, measures, reads, hot)), "large-keys")


def _reduce_hot(
    rows: DataFrame, spec: PanelSpec, measures: list[Measure], reads: frozenset[str], hot: HotKeys
) -> DataFrame:
    """Same result for keys whose rows must stay spread over many tasks.

    The rows of large keys are written once, and once more with what the measures read of a row's place: per-key facts
    (newest timestamp, order of the n-th newest row) come from a per-key top-n and are joined back, day gaps from the
    bucketed order. From there most measures combine map-side; medians and distinct counts, all columns at a time, get
    their own distributed plans over the written rows.
    """
    rows = written(rows, "large-keys")
    depth = 1 + max(m.older_than for m in measures)
    order = spec.order_struct()
    cuts = (
        newest_rows(rows.select(spec.key, *spec.order), spec, depth)
        .groupBy(spec.key)
        .agg(*[F.max(F.when(F.col(AGE) == i, order)).alias(f"_cut{i}") for i in range(1, depth + 1)])
    )
    # exact for the newest rows, depth + 1 for all older ones; that is all the measures compare with
    age = reduce(
        lambda rest, i: F.when(order >= F.col(f"_cut{i}"), i).otherwise(rest),
        range(depth, 0, -1),
        F.lit(depth + 1),
    )
    annotated = (
        rows.join(hot.hint(cuts, depth * len(spec.order)), spec.key)
        .withColumn(AGE, age)
        .withColumn(NEWEST, F.col("_cut1")[spec.ts])
        .drop(*[f"_cut{i}" for i in range(1, depth + 1)])
    )
    if GAP in reads:
        # gap rows carry only the key and the gap: every aggregate skips their NULLs
        gaps = consecutive_gaps(rows, spec, GAP).select(spec.key, GAP)
        annotated = annotated.withColumns({GAP: F.lit(None).cast("int"), ROW: F.lit(True)}).unionByName(
            gaps, allowMissingColumns=True
        )
    annotated = written(annotated, "large-keys")
    # a NULL order keeps gap rows out of first, last and last_row
    known_order = f"IF({ROW}, {_order(spec)}, NULL)" if GAP in reads else _order(spec)
    result = _grouped(annotated, spec.key, [m for m in measures if m.stat in COMBINING], known_order)
    medians = [m for m in measures if m.stat == "median"]
    if medians:
        result = result.join(hot.hint(_spread_medians(annotated, spec.key, medians, hot), len(medians)), spec.key, "left")
    counted = [m for m in measures if m.stat == "nunique"]
    if counted:
        result = result.join(hot.hint(_spread_nunique(annotated, spec.key, counted), len(counted)), spec.key, "left")
        result = result.withColumns({m.name: F.coalesce(m.name, F.lit(0).cast("long")) for m in counted})
    return result.select(spec.key, *[m.name for m in measures])


def _spread_nunique(rows: DataFrame, key: str, measures: list[Measure]) -> DataFrame:
    """Distinct values of all columns from one scan: one row per key, column and value, combined map-side."""
    kinds = rows.selectExpr(*[f"{m.value} AS {m.name}" for m in measures]).schema

    def text(m: Measure) -> str:
        if isinstance(kinds[m.name].dataType, (T.FloatType, T.DoubleType)):
            return f"CAST(({m.value}) + 0D AS STRING)"  # no negative zero
        return f"hex({m.value})" if isinstance(kinds[m.name].dataType, T.BinaryType) else f"CAST({m.value} AS STRING)"

    cells = ", ".join(f"named_struct('name', '{m.name}', 'v', {text(m)})" for m in measures)
    values = rows.selectExpr(quoted(key), f"inline(array({cells}))").where("v IS NOT NULL").distinct()
    return values.groupBy(key).pivot("name", [m.name for m in measures]).agg(F.count(F.lit(1)))


def _spread_medians(rows: DataFrame, key: str, measures: list[Measure], hot: HotKeys) -> DataFrame:
    """Exact medians of large groups: narrow the middle with a sketch, then sort only that part.

    Pass 1 sketches a bracket around the middle of every (key, measure). Pass 2 counts the values
    below, in and above the bracket, which tells where the middle ranks are even if the sketch was
    off. Pass 3 counts equal values of that part and walks them in order.
    """
    names = [m.name for m in measures]
    accuracy = 10_000
    around = f"array(0.5 - {2 / accuracy}, 0.5 + {2 / accuracy})"
    wide = rows.selectExpr(quoted(key), *[f"CAST({m.value} AS DOUBLE) AS {quoted(m.name)}" for m in measures])
    brackets = wide.groupBy(key).agg(
        *[F.expr(f"percentile_approx({quoted(n)}, {around}, {accuracy}) AS {quoted('_b_' + n)}") for n in names]
    )
    brackets = written(brackets, "brackets")
    cells = ", ".join(
        f"named_struct('name', '{n}', 'v', {quoted(n)}, 'lo', {quoted('_b_' + n)}[0], 'hi', {quoted('_b_' + n)}[1])"
        for n in names
    )
    long = (
        wide.join(hot.hint(brackets, 2 * len(names)), key)
        .selectExpr(quoted(key), f"inline(array({cells}))")
        .where("v IS NOT NULL")
        .selectExpr(quoted(key), "name", "v", "CASE WHEN v < lo THEN 0 WHEN v <= hi THEN 1 ELSE 2 END AS part")
    )
    # place of the first value of every part, and the (0-based) places of the two middle values
    parts = long.groupBy(key, "name").agg(
        *[F.expr(f"count_if(part < {p}) AS start{p}") for p in range(4)],
        F.expr("(count(*) - 1) div 2 AS low"),
        F.expr("count(*) div 2 AS high"),
    )
    parts = written(parts, "brackets")
    middle = (
        long.join(hot.hint(parts, 6 * len(names)), [key, "name"])
        .selectExpr(
            quoted(key), "name", "v", "part", "low", "high",
            "element_at(array(start0, start1, start2), part + 1) AS start",
            "element_at(array(start1, start2, start3), part + 1) AS stop",
        )
        .where("low < stop AND high >= start")
    )
    counted = middle.groupBy(key, "name", "part", "v", "start", "low", "high").agg(F.expr("count(*) AS n"))
    upto = F.sum("n").over(
        Window.partitionBy(key, "name", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    )
    medians = (
        counted.withColumn("upto", F.col("start") + upto)
        .groupBy(key, "name")
        .agg(
            F.expr(
                "(max(CASE WHEN upto - n <= low AND low < upto THEN v END)"
                " + max(CASE WHEN upto - n <= high AND high < upto THEN v END)) / 2 AS median"
            )
        )
    )
    return medians.groupBy(key).pivot("name", names).agg(F.first("median"))
