"""SQL for the family queries, written from the definitions and run by another engine."""

from __future__ import annotations

from itertools import combinations

import numpy as np

from workload.fixtures import IMPORTANT, STATEMENTS

PANEL = """l AS (SELECT l_orderkey, sum(l_quantity) qty, sum(l_extendedprice * (1 - l_discount)) disc_price,
  avg(l_tax) avg_tax, count(*) n_lines, max(l_returnflag) last_flag FROM lineitem GROUP BY l_orderkey),
s AS (SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, qty, disc_price, avg_tax, n_lines, last_flag,
  o_orderstatus, o_orderpriority FROM orders LEFT JOIN l ON o_orderkey = l_orderkey)"""
NUM = list(STATEMENTS.numeric)
CAT = list(STATEMENTS.categorical)
ORD = "(o_orderdate, o_orderkey)"


def agg(stat: str, x: str, where: str = "true", order: str = ORD) -> str:
    known = f"FILTER (WHERE {x} IS NOT NULL AND {where})"
    f = f"FILTER (WHERE {where})"
    return {
        "mean": f"avg({x}) {f}",
        "std": f"stddev_samp({x}) {f}",
        "min": f"min({x}) {f}",
        "max": f"max({x}) {f}",
        "sum": f"coalesce(sum({x}) {f}, 0)",
        "median": f"median({x}) {f}",
        "count": f"count({x}) {f}",
        "nunique": f"count(DISTINCT {x}) {f}",
        "first": f"arg_min({x}, {order}) {known}",
        "last": f"arg_max({x}, {order}) {known}",
    }[stat]


ROUND = ("mean", "std", "sum", "median", "last", "first", "min", "max")


def single(e: str) -> str:
    return f"CAST(round({e}, 9) AS FLOAT)"


def stat(x: str, s: str, where: str = "true") -> str:
    """An aggregate rounded like the Spark side rounds doubles."""
    body = agg(s, x, where)
    if x == "n_lines" and s not in ("mean", "std", "median"):
        return f"CAST({body} AS BIGINT)"
    return single(body) if x in NUM and s in ROUND else body


def per_key(columns: list[tuple[str, str]], source: str = "s", ctes: str = "") -> str:
    body = ",\n  ".join(f"{e} AS {n}" for n, e in columns)
    return f"WITH {PANEL}{ctes}\nSELECT o_custkey,\n  {body}\nFROM {source} GROUP BY o_custkey"


def _ratio(a: str, b: str) -> str:
    return single(f"CAST({a} AS DOUBLE) / nullif({b}, 0)")


def _diff(a: str, b: str, x: str, exact: bool) -> str:
    return f"CAST({a} - {b} AS BIGINT)" if x == "n_lines" and exact else single(f"{a} - {b}")


AGED = """,
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) age,
  max(o_orderdate) OVER (PARTITION BY o_custkey) newest,
  lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) previous FROM s)"""


def families() -> dict[str, str]:
    q: dict[str, str] = {}
    every: list[tuple[str, str]] = []  # the columns of all families, for the query of all of them

    def family(columns: list[tuple[str, str]], source: str = "s", ctes: str = "") -> str:
        every.extend(columns)
        return per_key(columns, source, ctes)

    stats = ("mean", "std", "min", "max", "last", "sum", "median")
    cats = [(f"{c}_{s}", agg(s, c)) for c in CAT for s in ("count", "last", "nunique")]
    q["basic_stat"] = family([(f"{x}_{s}", stat(x, s)) for x in NUM for s in stats] + cats)
    q["basic_stat_cat"] = per_key(cats)
    q["basic_stat_five"] = per_key([(f"{x}_{s}", stat(x, s)) for x in NUM for s in stats[:5]])
    near = {n: f"newest - o_orderdate < INTERVAL {n} DAY" for n in (100, 200)}
    q["period_stat"] = family(
        [
            (f"{x}_{s}_{n}days", stat(x, s, near[n]))
            for n in near
            for x in NUM
            for s in ("mean", "std", "min", "max", "sum", "median")
        ],
        "r",
        AGED,
    )
    a = {(x, s): agg(s, x) for x in NUM for s in ("first", "last", "min", "max", "mean")}
    q["max_min_diff"] = family(
        [
            (f"{x}_{n}", _diff(a[x, p], a[x, m], x, True))
            for x in NUM
            for n, p, m in (
                ("last_min_diff", "last", "min"),
                ("last_max_diff", "last", "max"),
                ("max_min_diff", "max", "min"),
            )
        ]
    )
    last_mean = [(f"{x}_last_mean_diff", _diff(a[x, "last"], a[x, "mean"], x, False)) for x in NUM]
    q["last_mean_diff"] = family(last_mean)
    q["last_mean_from_columns"] = per_key(
        [(f"{x}_{s}", stat(x, s)) for x in NUM for s in ("mean", "last")] + last_mean
    )
    q["div"] = family(
        [
            (f"{x}_div_{n}", _ratio(top, a[x, "last"]))
            for x in NUM
            for n, top in (
                ("first_last", a[x, "first"]),
                ("mean_last", a[x, "mean"]),
                ("last1_last", agg("last", x, "age > 1")),
            )
        ],
        "r",
        AGED,
    )
    q["div_min_max"] = family(
        [
            (f"{x}_div_{n}", _ratio(a[x, t], a[x, b]))
            for x in NUM
            for n, t, b in (("min_last", "min", "last"), ("max_last", "max", "last"), ("min_max", "min", "max"))
        ]
    )
    days = "CAST(floor(date_diff('microsecond', previous, o_orderdate) / 86400000000.0) AS INTEGER)"
    q["date_gaps"] = family(
        [(f"diff_days_{s}", single(agg(s, "g"))) for s in ("mean", "std", "median")]
        + [(f"diff_days_{s}", f"CAST({agg(s, 'g')} AS BIGINT)") for s in ("min", "max", "sum")]
        + [
            (
                "diff_first_last_day",
                "CAST(floor(date_diff('microsecond', min(o_orderdate), max(o_orderdate)) / 86400000000.0) AS INTEGER)",
            )
        ],
        "g",
        f"{AGED},\ng AS (SELECT *, {days} g FROM r)",
    )
    q["row_gaps"] = f"WITH {PANEL}{AGED}\nSELECT o_custkey, o_orderkey, {days} AS gap FROM r"
    q["shift"] = family(
        [
            (f"{x}_shift{k}_last", stat(x, "last", f"age > {k}"))
            for k in (1, 2)
            for x in NUM + CAT
        ],
        "r",
        AGED,
    )
    at = lambda x, k: f"max({x}) FILTER (WHERE age = {k})"
    q["lag_diff"] = family(
        [
            (f"{x}_diff{k}", single(f"{at(x, 1)} - {at(x, 1 + k)}") if x != "n_lines" else f"{at(x, 1)} - {at(x, 1 + k)}")
            for k in (1, 2)
            for x in NUM
        ],
        "r",
        AGED,
    )
    q["lag_diff_float"] = per_key(
        [(f"{x}_diff{k}", f"CAST({at(x, 1)} - {at(x, 1 + k)} AS FLOAT)") for k in (1, 2) for x in NUM],
        "r",
        AGED,
    )
    q["important_double"] = per_key(
        [(f"{x}_{s}_double", f"CAST(({agg(s, x)}) * ({agg(s, x)}) AS FLOAT)") for x in IMPORTANT for s in ("std", "min", "max", "last")]
    )
    last = {x: f"({agg('last', x)})" for x in IMPORTANT}
    pairs = list(combinations(IMPORTANT, 2))
    q["important_cross"] = family(
        [(f"cross_{x}_{y}", single(f"{last[x]} * {last[y]}")) for x, y in pairs]
    )
    for seed in (32, 42):
        draws = np.random.RandomState(seed).rand(len(pairs))
        q[f"important_mix{seed}"] = family(
            [
                (f"mix_{x}_{y}_{seed}", single(f"{last[x]} * {float(r)!r}::DOUBLE + {last[y]} * {float(1 - r)!r}::DOUBLE"))
                for (x, y), r in zip(pairs, draws)
            ]
        )
    newest = lambda x: f"last({x} ORDER BY o_orderdate, o_orderkey)"
    q["avg_max_last"] = per_key(
        [("qty_last", single(newest("qty"))), ("avg_tax_last", single(newest("avg_tax"))), ("last_flag_last", newest("last_flag"))]
        + [(f"{x}_max", single(f"max({x})")) for x in ("o_totalprice", "disc_price")]
        + [(f"{x}_avg", single(f"avg({x})")) for x in ("o_totalprice", "qty")]
    )
    q["last_row"] = f"""WITH {PANEL}{AGED}
SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderkey, o_totalprice::FLOAT AS o_totalprice, qty::FLOAT AS qty,
  CAST(round(disc_price, 9) AS FLOAT) AS disc_price, CAST(round(avg_tax, 9) AS FLOAT) AS avg_tax, n_lines, last_flag, o_orderstatus, o_orderpriority
FROM r WHERE age = 1"""
    squares = [(f"{x}_{s}_double", f"CAST(({agg(s, x)}) * ({agg(s, x)}) AS FLOAT)") for x in IMPORTANT for s in ("std", "min", "max", "last")]
    chosen = [("qty_newest", single(newest("qty"))), ("avg_tax_newest", single(newest("avg_tax"))), ("last_flag_newest", newest("last_flag"))]
    chosen += [(f"{x}_avg", single(f"avg({x})")) for x in ("o_totalprice", "qty")]
    q["all_families"] = per_key(
        list(dict((every + squares + chosen)).items()), "g", f"{AGED},\ng AS (SELECT *, {days} g FROM r)"
    )
    q["all_families_split_keys"] = q["all_families"]
    q["event_gaps"] = """WITH r AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) previous FROM events),
g AS (SELECT *, CAST(floor(date_diff('microsecond', previous, ts) / 86400000000.0) AS INTEGER) g FROM r)
SELECT user_id, CAST(round(avg(g), 9) AS FLOAT) AS diff_days_mean, CAST(round(stddev_samp(g), 9) AS FLOAT) AS diff_days_std,
  CAST(min(g) AS BIGINT) AS diff_days_min, CAST(max(g) AS BIGINT) AS diff_days_max,
  CAST(coalesce(sum(g), 0) AS BIGINT) AS diff_days_sum, CAST(round(median(g), 9) AS FLOAT) AS diff_days_median,
  CAST(floor(date_diff('microsecond', min(ts), max(ts)) / 86400000000.0) AS INTEGER) AS diff_first_last_day
FROM g GROUP BY user_id"""
    q["event_stat"] = """SELECT user_id, CAST(round(avg(value), 9) AS FLOAT) AS value_mean, CAST(round(stddev_samp(value), 9) AS FLOAT) AS value_std,
  CAST(round(min(value), 9) AS FLOAT) AS value_min, CAST(round(max(value), 9) AS FLOAT) AS value_max,
  CAST(round(arg_max(value, (ts, event_id)) FILTER (WHERE value IS NOT NULL), 9) AS FLOAT) AS value_last,
  CAST(round(coalesce(sum(value), 0), 9) AS FLOAT) AS value_sum, CAST(round(median(value), 9) AS FLOAT) AS value_median,
  count(event_type) AS event_type_count,
  arg_max(event_type, (ts, event_id)) FILTER (WHERE event_type IS NOT NULL) AS event_type_last,
  count(DISTINCT event_type) AS event_type_nunique
FROM events GROUP BY user_id"""
    return q
