"""SQL for facts about models and feature selection."""

from __future__ import annotations

from workload.oracle_families import AGED, NUM, PANEL, agg
from workload.oracle_scores import _folds as folds

DAYS = "CAST(floor(date_diff('microsecond', previous, o_orderdate) / 86400000000.0) AS INTEGER)"
#: The features of the model queries, in their order.
COLUMNS = [(f"{x}_{s}", agg(s, x)) for x in NUM for s in ("mean", "last")]
COLUMNS += [(f"diff_days_{s}", agg(s, "g")) for s in ("mean", "std", "min", "max", "sum", "median")]
COLUMNS += [("diff_first_last_day", "CAST(floor(date_diff('microsecond', min(o_orderdate), max(o_orderdate)) / 86400000000.0) AS INTEGER)")]
NAMES = [n for n, _ in COLUMNS]
FILLED = f"""WITH RECURSIVE {PANEL}{AGED},
g AS (SELECT *, {DAYS} g FROM r),
f AS MATERIALIZED (SELECT o_custkey, {", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in COLUMNS)} FROM g GROUP BY o_custkey),
m AS MATERIALIZED (SELECT {", ".join(f"coalesce({n}, avg({n}) OVER ()) AS {n}" for n in NAMES)} FROM f)"""


def models() -> dict[str, str]:
    customers = "FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)"
    pairs = "\nUNION ALL ".join(f"SELECT {i} AS i, {j} AS j, corr({a}, {b}) AS c FROM m" for j, b in enumerate(NAMES) for i, a in enumerate(NAMES[:j]))
    return {
        "oof_stored": folds(3, "(SELECT * FROM s WHERE key IN (SELECT o_custkey FROM orders))").replace(
            "SELECT p.key, p.target, CAST", "SELECT p.key AS o_custkey, p.target, 1 AS is_probability, CAST"
        ),
        "importance_mean": f"SELECT {len(NAMES)} AS features, 1 AS sums_to_one, 1 AS none_negative",
        "drift_rounds": "SELECT 1 AS drops_above, 1 AS restores_dropped, 1 AS ends_below",
        "search_trials": "SELECT CAST(i AS INTEGER) AS trial, 1 AS is_inside FROM range(4) t(i)",
        "importance_by_fold": f"SELECT CAST(i AS INTEGER) AS fold, {len(NAMES)} AS features, 1 AS sums_to_one FROM range(3) t(i)",
        "cv_stages": "SELECT CAST(i AS INTEGER) AS fold, 10 AS stages, 1 AS is_best FROM range(3) t(i)",
        "predict_mixed": f"SELECT c_custkey AS o_custkey, 1 AS is_same {customers}",
        "corr_filter_kept": f"""{FILLED},
p AS MATERIALIZED (SELECT i, j FROM ({pairs}) WHERE abs(c) > 0.9),
k AS (SELECT 0 AS n, []::INTEGER[] AS kept UNION ALL
  SELECT n + 1, CASE WHEN EXISTS (SELECT 1 FROM p WHERE p.j = k.n AND list_contains(k.kept, p.i)) THEN kept ELSE list_append(kept, n) END FROM k WHERE n < {len(NAMES)})
SELECT feature, CAST(list_contains((SELECT kept FROM k WHERE n = {len(NAMES)}), i) AS INTEGER) AS is_kept
FROM (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(NAMES))}) v(i, feature)""",
        "pca_variance": f"""{FILLED}
SELECT {len(NAMES)} AS axes, 1 AS falls, 1 AS is_projected, CAST({" + ".join(f"var_samp({n})" for n in NAMES)} AS FLOAT) AS total FROM m""",
    }
