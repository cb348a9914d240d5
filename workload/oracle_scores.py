"""SQL for the score, profile, encoding, fold, blend, store and drift queries."""

from __future__ import annotations

from workload.fixtures import STATEMENTS
from workload.oracle_families import AGED, CAT, NUM, PANEL, agg, per_key, single, stat

SCORED = """sc AS (SELECT c_custkey AS key, CAST(c_acctbal < 0 AS INTEGER) AS target,
  ((c_custkey * 7919) % 10007) / 10007.0::DOUBLE AS score_a,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN 'test' ELSE 'train' END AS split FROM customer),
s AS (SELECT *, floor(score_a * 50) / 50 AS score_b FROM sc)"""
LABELLED = "lab AS (SELECT c_custkey AS o_custkey, CAST(c_acctbal < 0 AS INTEGER) AS target FROM customer)"
ODDS = f"{SCORED},\nx AS (SELECT *, score_a * 8 - 4 AS x, 1 / (1 + exp(-(score_a * 8 - 4))) AS p FROM s)"
PRED = f"""{SCORED},
m AS (SELECT key, score_a AS a, score_b AS b, ((key * 104729) % 9973) / 9973.0::DOUBLE AS c FROM s)"""


def _metric(score: str, top: str, best: str = "10 * nn * (1 - 19 / (np + 20 * nn))") -> str:
    return f"""WITH {SCORED},
w AS (SELECT *, 20 - 19 * target AS w FROM s),
u AS (SELECT *, sum(w) OVER o AS cw, sum(w) OVER () AS tw, sum(target) OVER o AS ct, sum(target) OVER () AS tt
  FROM w WINDOW o AS (ORDER BY {score} DESC, key ROWS UNBOUNDED PRECEDING)),
a AS (SELECT sum(target)::DOUBLE AS np, count(*) - sum(target)::DOUBLE AS nn,
  sum(CASE WHEN {top} THEN target ELSE 0 END)::DOUBLE / sum(target) AS d,
  sum((ct::DOUBLE / tt - cw::DOUBLE / tw) * w) AS g FROM u)
SELECT {single(f"0.5 * (g / ({best}) + d)")} AS metric, {single(f"g / ({best})")} AS gini, {single("d")} AS capture FROM a"""


def _metric_int(score: str) -> str:
    """The best possible gini from a second ordering, by the label itself."""
    return f"""WITH {SCORED},
w AS (SELECT *, 20 - 19 * target AS w FROM s),
u AS (SELECT *, sum(w) OVER o AS cw, sum(w) OVER () AS tw, sum(target) OVER o AS ct, sum(target) OVER () AS tt,
  sum(w) OVER q AS pw, sum(target) OVER q AS pt
  FROM w WINDOW o AS (ORDER BY {score} DESC, key ROWS UNBOUNDED PRECEDING),
    q AS (ORDER BY target DESC, key ROWS UNBOUNDED PRECEDING)),
a AS (SELECT sum(CASE WHEN cw <= floor(0.04::DOUBLE * tw) THEN target ELSE 0 END)::DOUBLE / sum(target) AS d,
  sum((ct::DOUBLE / tt - cw::DOUBLE / tw) * w) AS g, sum((pt::DOUBLE / tt - pw::DOUBLE / tw) * w) AS best FROM u)
SELECT {single("0.5 * (g / best + d)")} AS metric, {single("g / best")} AS gini, {single("d")} AS capture FROM a"""


def _auc(score: str) -> str:
    return f"""WITH {SCORED},
g AS (SELECT {score} AS v, count(*) AS n, sum(target) AS p FROM s GROUP BY 1),
r AS (SELECT p, sum(n) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) - n + (n + 1) / 2.0::DOUBLE AS rank, n FROM g),
a AS (SELECT sum(p * rank) AS ranks, sum(p)::DOUBLE AS np, (sum(n) - sum(p))::DOUBLE AS nn FROM r)
SELECT {single("(ranks - np * (np + 1) / 2) / (np * nn)")} AS auc FROM a"""


def _folds(k: int, source: str = "(SELECT * FROM s)") -> str:
    return f"""WITH {SCORED},
y AS {source},
c AS (SELECT target, min(key) AS first FROM y GROUP BY target),
p AS (SELECT y.key, y.target, row_number() OVER (ORDER BY c.first, y.key) - 1 AS j,
  row_number() OVER (PARTITION BY y.target ORDER BY y.key) - 1 AS r FROM y JOIN c USING (target)),
z AS (SELECT target, j % {k} AS f, count(*) AS n FROM p GROUP BY ALL),
e AS (SELECT target, f, sum(n) OVER (PARTITION BY target ORDER BY f) AS upto FROM z)
SELECT p.key, p.target, CAST(min(e.f) AS INTEGER) AS fold FROM p JOIN e ON p.target = e.target AND p.r < e.upto
GROUP BY p.key, p.target"""


def _shuffled(k: int, seed: int) -> str:
    return f"""WITH {SCORED},
c AS (SELECT target, min(key) AS first FROM s GROUP BY target),
p AS (SELECT s.key, s.target, row_number() OVER (ORDER BY c.first, s.key) - 1 AS j,
  row_number() OVER (PARTITION BY s.target ORDER BY md5('{seed}:' || s.key)) - 1 AS r FROM s JOIN c USING (target)),
z AS (SELECT target, j % {k} AS f, count(*) AS n FROM p GROUP BY ALL),
e AS (SELECT target, f, sum(n) OVER (PARTITION BY target ORDER BY f) AS upto FROM z)
SELECT p.key, p.target, CAST(min(e.f) AS INTEGER) AS fold FROM p JOIN e ON p.target = e.target AND p.r < e.upto
GROUP BY p.key, p.target"""


#: Folds as a CTE ``fo`` beside the scores.
FOLDED = f"WITH {SCORED},\nfo AS ({_folds(5)})"
NEWEST = f"""WITH {PANEL}{AGED},
n AS (SELECT o_custkey, o_orderstatus, o_orderpriority, last_flag, CAST(n_lines AS VARCHAR) AS n_lines FROM r WHERE age = 1)"""


def _population(mode: str) -> str:
    months = f"""WITH {SCORED}, d AS (SELECT o_custkey, coalesce(any_value(split), 'train') AS split,
  CAST(month(max(o_orderdate)) AS INTEGER) AS month FROM orders LEFT JOIN s ON o_custkey = key GROUP BY o_custkey)
"""
    if mode == "public_vs_private":
        return months + "SELECT o_custkey, month, CAST(month = 4 AS INTEGER) AS target FROM d WHERE split = 'test'"
    m = 10 if mode == "train_vs_public" else 4
    return months + f"""SELECT o_custkey, month, 0 AS target FROM d WHERE split = 'train'
UNION ALL SELECT o_custkey, month, 1 FROM d WHERE split = 'test' AND month = {m}"""


def scores() -> dict[str, str]:
    q: dict[str, str] = {}
    q["default_metric"] = _metric("score_a", "cw::DOUBLE / tw <= 0.04")
    q["default_metric_ties"] = _metric("score_b", "cw::DOUBLE / tw <= 0.04")
    q["default_metric_int_cutoff"] = _metric_int("score_a")
    q["metric_by_fold"] = f"""{FOLDED},
w AS (SELECT *, 20 - 19 * target AS w FROM s JOIN fo USING (key, target)),
u AS (SELECT *, sum(w) OVER o AS cw, sum(w) OVER (PARTITION BY fold) AS tw, sum(target) OVER o AS ct, sum(target) OVER (PARTITION BY fold) AS tt
  FROM w WINDOW o AS (PARTITION BY fold ORDER BY score_b DESC, key ROWS UNBOUNDED PRECEDING)),
a AS (SELECT fold, sum(target)::DOUBLE AS np, count(*) - sum(target)::DOUBLE AS nn,
  sum(CASE WHEN cw::DOUBLE / tw <= 0.04 THEN target ELSE 0 END)::DOUBLE / sum(target) AS d,
  sum((ct::DOUBLE / tt - cw::DOUBLE / tw) * w) / (10 * nn * (1 - 19 / (np + 20 * nn))) AS g FROM u GROUP BY fold)
SELECT fold, {single("0.5 * (g + d)")} AS metric, {single("g")} AS gini, {single("d")} AS capture FROM a"""
    q["auc_by_fold"] = f"""{FOLDED},
v AS (SELECT fold, score_b AS v, count(*) AS n, sum(target) AS p FROM s JOIN fo USING (key, target) GROUP BY ALL),
r AS (SELECT fold, p, sum(n) OVER (PARTITION BY fold ORDER BY v ROWS UNBOUNDED PRECEDING) - n + (n + 1) / 2.0::DOUBLE AS rank, n FROM v),
a AS (SELECT fold, sum(p * rank) AS ranks, sum(p)::DOUBLE AS np, (sum(n) - sum(p))::DOUBLE AS nn FROM r GROUP BY fold)
SELECT fold, {single("(ranks - np * (np + 1) / 2) / (np * nn)")} AS auc FROM a"""
    q["lorenz_curve"] = f"""WITH {SCORED},
w AS (SELECT *, 20 - 19 * target AS w FROM s)
SELECT key, {single("sum(w) OVER o / (sum(w) OVER ())::DOUBLE")} AS weight_share,
  {single("sum(target) OVER o / (sum(target) OVER ())::DOUBLE")} AS positive_share
FROM w WINDOW o AS (ORDER BY score_b DESC, key ROWS UNBOUNDED PRECEDING)"""
    q["roc_auc"] = _auc("score_a")
    q["roc_auc_ties"] = _auc("score_b")
    q["log_loss"] = f"""WITH {ODDS}
SELECT {single("avg(-(target * ln(p) + (1 - target) * ln(1 - p)))")} AS log_loss FROM x"""
    q["focal_loss"] = f"""WITH {ODDS}
SELECT {single("avg(-(target * (1 - p) ** 2 * ln(p) * 0.25 + p ** 2 * (1 - target) * ln(1 - p) * 0.75))")} AS focal_loss FROM x"""
    q["focal_loss_unbalanced"] = f"""WITH {ODDS}
SELECT {single("avg(-(target * (1 - p) ** 2 * ln(p) + p ** 2 * (1 - target) * ln(1 - p)))")} AS focal_loss FROM x"""
    q["probability"] = f"WITH {ODDS}\nSELECT key, {single('p')} AS p FROM x"
    q["score_rank"] = f"WITH {SCORED}\nSELECT key, row_number() OVER (ORDER BY score_b DESC, key) - 1 AS place FROM s"
    q["score_rank_buckets"] = q["score_rank"]
    q["order_statistic"] = """WITH r AS (SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS place,
  count(*) OVER () AS n FROM orders)
SELECT place, o_totalprice FROM r WHERE place IN (SELECT i * (n - 1) // 10 FROM range(11) t(i), (SELECT any_value(n) AS n FROM r))"""
    q["pred_hist"] = f"""WITH {SCORED},
b AS (SELECT target, CAST(least(floor(score_a * 20), 19) AS INTEGER) AS bin, count(*) AS n FROM s GROUP BY 1, 2),
t AS (SELECT target, count(*) AS total FROM s GROUP BY 1)
SELECT t.target, CAST(i AS INTEGER) AS bin, coalesce(n, 0) AS n, {single("coalesce(n, 0) * 20.0::DOUBLE / total")} AS density
FROM t CROSS JOIN range(20) r(i) LEFT JOIN b ON b.target = t.target AND b.bin = i"""
    q["pred_hist_unknown"] = f"""WITH {SCORED},
y AS (SELECT target, score_a * 1.5 - 0.25 AS p FROM s WHERE key % 7 != 0 AND score_a * 1.5 - 0.25 BETWEEN 0 AND 1),
b AS (SELECT target, CAST(least(floor(p * 20), 19) AS INTEGER) AS bin, count(*) AS n FROM y GROUP BY 1, 2),
t AS (SELECT target, count(*) AS total FROM y GROUP BY 1)
SELECT c.target, CAST(i AS INTEGER) AS bin, coalesce(n, 0) AS n, {single("coalesce(n, 0) * 20.0::DOUBLE / total")} AS density
FROM (SELECT DISTINCT target FROM s) c CROSS JOIN range(20) r(i) LEFT JOIN t ON t.target = c.target LEFT JOIN b ON b.target = c.target AND b.bin = i"""
    q["ensemble_lacking"] = f"WITH {PRED}\nSELECT key, CASE WHEN key % 3 != 0 THEN {single('greatest(a, b)')} END AS prediction FROM m"
    q["calibration"] = f"""WITH {SCORED},
e AS (SELECT unnest(quantile_cont(score_a, [{", ".join(f"{i / 50!r}" for i in range(1, 50))}])) AS edge FROM s),
b AS (SELECT s.key, any_value(s.score_a) AS score, any_value(s.target) AS target, CAST(count(edge) AS INTEGER) AS bin
  FROM s LEFT JOIN e ON edge < score_a GROUP BY s.key)
SELECT bin, count(*) AS n, {single("avg(score)")} AS mean_predicted, {single("avg(target)")} AS observed_rate FROM b GROUP BY bin"""
    q["threshold_counts"] = f"""WITH {SCORED}
SELECT CAST(t AS FLOAT) AS threshold, count(*) FILTER (WHERE score_a > t) AS n_true,
  count(*) FILTER (WHERE NOT score_a > t) AS n_false
FROM s, (VALUES (0.9::DOUBLE), (0.8::DOUBLE), (0.7::DOUBLE), (0.6::DOUBLE), (0.5::DOUBLE)) v(t) GROUP BY t"""
    for k, name in ((5, "stratified_folds"), (2, "stratified_folds_2"), (8, "stratified_folds_8")):
        q[name] = _folds(k)
    # every training row predicted once, in its stratified fold; rows are the customers with statements
    q["cv_coverage"] = _folds(5, "(SELECT * FROM s WHERE key IN (SELECT o_custkey FROM orders))").replace(
        "SELECT p.key, p.target, CAST",
        "SELECT p.key AS o_custkey, p.target, 1 AS is_probability, "
        + "".join(f"1 AS flag_0{d}_follows, " for d in (9, 8, 7, 6, 5)) + "CAST",
    )
    q["saved_models"] = f"WITH {SCORED}\nSELECT key AS o_custkey, 1 AS is_same, 1 AS is_fold_mean FROM s WHERE key IN (SELECT o_custkey FROM orders)"
    q["shuffled_folds"] = _shuffled(5, 42)
    q["stratified_sample"] = f"""WITH {SCORED},
c AS (SELECT target, min(key) AS first, count(*) AS n FROM s GROUP BY target),
t AS (SELECT *, CAST(floor(0.3::DOUBLE * sum(n) OVER ()) AS BIGINT) AS keep, sum(n) OVER () AS total FROM c),
e AS (SELECT *, n * keep // total AS quota, n * keep % total AS rest FROM t),
f AS (SELECT *, quota + CASE WHEN row_number() OVER (ORDER BY rest DESC, first) <= keep - sum(quota) OVER () THEN 1 ELSE 0 END AS take FROM e),
p AS (SELECT key, target, row_number() OVER (PARTITION BY target ORDER BY md5('42:' || key)) AS r FROM s)
SELECT p.key, p.target FROM p JOIN f USING (target) WHERE r <= take"""
    q["ensemble_avg"] = f"WITH {PRED}\nSELECT key, {single('(a + 2 * b + 3 * c) / 6')} AS prediction FROM m"
    q["seed_blend"] = f"WITH {PRED}\nSELECT key, {single('(a + b + c) / 3')} AS prediction FROM m"
    for f, name in (("least", "ensemble_min"), ("greatest", "ensemble_max")):
        q[name] = f"WITH {PRED}\nSELECT key, {single(f'{f}(a, b, c)')} AS prediction FROM m"
    q["submission"] = q["submission_checked"] = q["seed_blend"]
    odds = "((a * 8 - 4) + (b * 8 - 4) + (c * 8 - 4)) / 3"
    q["fold_mean"] = f"""WITH {PRED}
SELECT key, {single(odds)} AS prediction, {single(f"1 / (1 + exp(-({odds})))")} AS probability FROM m"""
    q["pseudo_label"] = f"""WITH {SCORED},
tr AS (SELECT * FROM s WHERE split = 'train'), te AS (SELECT * FROM s WHERE split = 'test'),
k AS (SELECT CAST(floor((SELECT count(*) FILTER (WHERE target = 0) / count(*) FILTER (WHERE target = 1)::DOUBLE FROM tr)
  * (SELECT count(*) FROM te WHERE score_a > 0.99)) AS BIGINT) AS place),
lo AS (SELECT score_a AS cut FROM (SELECT score_a, row_number() OVER (ORDER BY score_a, key) - 1 AS j FROM te) WHERE j = (SELECT place FROM k))
SELECT key, target, 'train' AS origin FROM tr
UNION ALL SELECT key, 1, 'pseudo_1' FROM te WHERE score_a > 0.99
UNION ALL SELECT key, 0, 'pseudo_0' FROM te WHERE score_a < (SELECT cut FROM lo)"""
    means = {c: [f"avg({c}) FILTER (WHERE target = {k})" for k in (0, 1)] for c in NUM}
    q["target_profile"] = f"WITH {PANEL}, {LABELLED}, j AS (SELECT * FROM s JOIN lab USING (o_custkey))\n" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, {single(m0)} AS mean_0, {single(m1)} AS mean_1, {single(f'{m1} / nullif({m0}, 0)')} AS ratio FROM j"
        for c, (m0, m1) in means.items()
    )
    q["value_counts"] = f"WITH {PANEL}\nSELECT last_flag, count(*) AS n FROM s GROUP BY last_flag"
    q["value_counts_events"] = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"
    q["rows_per_key_hist"] = """SELECT rows, count(*) AS keys
FROM (SELECT o_custkey, count(*) AS rows FROM orders GROUP BY o_custkey) GROUP BY rows"""
    q["rows_per_date"] = "SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM events GROUP BY 1 ORDER BY 1"
    role = {STATEMENTS.key: "key", **{c: "order" for c in STATEMENTS.order}, **{c: "numeric" for c in NUM}, **{c: "categorical" for c in CAT}}
    # the panel's columns as this engine sees them, with the role the reader of the data would give
    q["role_split"] = f"""WITH {PANEL},
k AS (SELECT count(COLUMNS(*)) FROM s), u AS (UNPIVOT k ON COLUMNS(*) INTO NAME c VALUE known)
SELECT c AS "column", CASE {" ".join(f"WHEN c = '{c}' THEN '{r}'" for c, r in role.items())} ELSE 'unused' END AS role, known FROM u"""
    q["period_rows"] = """SELECT o_custkey, o_orderkey FROM
(SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS newest FROM orders)
WHERE newest - o_orderdate < INTERVAL 100 DAY"""
    q["mode_impute"] = f"""{NEWEST},
f AS (SELECT last_flag AS v FROM n WHERE last_flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
p AS (SELECT o_orderpriority AS v FROM n WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
k AS (SELECT n_lines AS v FROM n WHERE n_lines IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_custkey, o_orderstatus, coalesce(o_orderpriority, (SELECT v FROM p)) AS o_orderpriority,
  coalesce(last_flag, (SELECT v FROM f)) AS last_flag, CAST(coalesce(n_lines, (SELECT v FROM k)) AS INTEGER) AS n_lines FROM n"""
    code = lambda c: f"""(SELECT CAST(d.code AS INTEGER) FROM (SELECT v, row_number() OVER (ORDER BY v NULLS LAST) - 1 AS code
    FROM (SELECT DISTINCT {c} AS v FROM s)) d WHERE d.v IS NOT DISTINCT FROM n.{c}) AS {c}"""
    q["label_encode"] = f"""{NEWEST}
SELECT o_custkey, {", ".join(code(c) for c in CAT)}, n_lines FROM n"""
    q["label_encode_large"] = """WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS segment, c_nationkey FROM customer)
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS c_name,
  CAST(dense_rank() OVER (ORDER BY segment NULLS LAST) - 1 AS INTEGER) AS segment, CAST(dense_rank() OVER (ORDER BY c_nationkey) - 1 AS INTEGER) AS c_nationkey FROM c"""
    q["round_last"] = per_key(
        [(f"{x}_last_round2", single(f"round_even({agg('last', x)} * 100, 0) / 100")) for x in NUM if x != "n_lines"]
    )
    ints = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int")]
    narrow = lambda c: (
        f"CASE WHEN min({c}) > -128 AND max({c}) < 127 THEN 'tinyint' WHEN min({c}) > -32768 AND max({c}) < 32767 THEN 'smallint' "
        f"WHEN min({c}) > -2147483648 AND max({c}) < 2147483647 THEN 'int' ELSE 'bigint' END"
    )
    span = lambda c: f"CAST(min({c}) AS FLOAT) AS low, CAST(max({c}) AS FLOAT) AS high"
    q["downcast_plan"] = "\nUNION ALL ".join(
        [f"SELECT '{c}' AS \"column\", {span(c)}, {narrow(c)} AS type FROM lineitem" for c, _ in ints]
        + [
            f"SELECT '{c}' AS \"column\", {span(c)}, CASE WHEN min({c}) > -3.4028234663852886e38::DOUBLE AND max({c}) < 3.4028234663852886e38::DOUBLE "
            f"THEN 'float' ELSE 'double' END AS type FROM lineitem"
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ]
    )
    # the narrowest types at scale 0.01; values are the same at any scale
    q["downcast"] = """SELECT * REPLACE (CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS SMALLINT) AS l_partkey,
  CAST(l_suppkey AS TINYINT) AS l_suppkey, CAST(l_linenumber AS TINYINT) AS l_linenumber, CAST(l_quantity AS FLOAT) AS l_quantity,
  CAST(l_extendedprice AS FLOAT) AS l_extendedprice, CAST(l_discount AS FLOAT) AS l_discount, CAST(l_tax AS FLOAT) AS l_tax) FROM lineitem"""
    q["fixed_downcast"] = """SELECT * REPLACE (CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
  CAST(o_totalprice AS FLOAT) AS o_totalprice) FROM orders"""
    flags = ", ".join(f"CAST(score_b > {t}::DOUBLE AS INTEGER) AS predicted_0{str(t)[2:]}" for t in (0.9, 0.8, 0.7, 0.6, 0.5))
    q["threshold_flags"] = f"WITH {SCORED}\nSELECT key, {flags} FROM s"
    q["month_flag"] = """WITH d AS (SELECT o_custkey, CAST(month(max(o_orderdate)) AS INTEGER) AS month FROM orders GROUP BY o_custkey)
SELECT o_custkey, month, CASE month WHEN 4 THEN 'private' WHEN 10 THEN 'public' END AS part FROM d"""
    q["tagged_union"] = f"WITH {SCORED}\nSELECT key, CAST(split = 'test' AS INTEGER) AS origin FROM s"
    pairs = [(a, b) for i, a in enumerate(NUM) for b in NUM[i + 1 :]]
    q["corr_pairs"] = f"WITH {PANEL}\n" + "\nUNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM s" for a, b in pairs
    )
    q["panel_scan"] = "SELECT * REPLACE (CAST(c_acctbal AS FLOAT) AS c_acctbal) FROM customer"
    q["pruned_scan"] = "SELECT o_custkey, o_orderkey FROM orders"
    q["label_scan"] = f"WITH {LABELLED}\nSELECT o_custkey, target FROM lab"
    newest = "last(qty ORDER BY o_orderdate, o_orderkey)"
    mean_diff = lambda x: single(f"{agg('last', x)} - {agg('mean', x)}")
    features = per_key(
        [
            ("o_totalprice_mean", single(agg("mean", "o_totalprice"))),
            ("last_flag_last", agg("last", "last_flag")),
            ("qty_last_mean_diff", mean_diff("qty")),
            ("n_lines_last_mean_diff", mean_diff("n_lines")),
            ("qty_last", single(newest)),
            ("qty_avg", single("avg(qty)")),
        ]
    )
    q["assemble_features"] = f"WITH {LABELLED}, {SCORED}, sp AS (SELECT key AS o_custkey, split FROM s), f AS ({features})\nSELECT f.*, target, coalesce(split, 'train') AS split FROM f LEFT JOIN lab USING (o_custkey) LEFT JOIN sp USING (o_custkey)"
    every = [(f"{x}_{s}", stat(x, s)) for x in NUM for s in ("mean", "std", "min", "max", "last") if (x, s) != ("qty", "last")]
    every += [(f"{c}_{s}", agg(s, c)) for c in CAT for s in ("count", "last", "nunique")] + [(f"{x}_last_mean_diff", mean_diff(x)) for x in NUM]
    q["consolidated_features"] = per_key([*every, ("qty_last", single(newest)), ("qty_avg", single("avg(qty)"))])
    q["assemble_bucketed"] = per_key(
        [("o_totalprice_mean", single(agg("mean", "o_totalprice"))), ("last_flag_last", agg("last", "last_flag"))]
        + [(f"{x}_last_mean_diff", mean_diff(x)) for x in NUM]
        + [("qty_newest", single(newest)), ("qty_avg", single("avg(qty)"))]
    )
    q["resolved_features"] = """SELECT * FROM (VALUES ('basic_stat', 0, 'qty_last'), ('last_mean_diff', 0, 'qty_last_mean_diff'),
  ('last_mean_diff', 1, 'n_lines_last_mean_diff'), ('avg_max_last', 0, 'qty_last'), ('avg_max_last', 1, 'qty_avg')) v(family, position, feature)"""
    at = lambda x, k: f"max({x}) FILTER (WHERE age = {k})"
    chain = per_key(
        [(f"{x}_mean", single(agg("mean", x))) for x in NUM]
        + [(f"{c}_last", agg("last", c)) for c in CAT]
        + [(f"{x}_diff1", single(f"{at(x, 1)} - {at(x, 2)}") if x != "n_lines" else f"{at(x, 1)} - {at(x, 2)}") for x in NUM],
        "r",
        AGED,
    )
    q["inner_chain"] = f"WITH {LABELLED}, f AS ({chain})\nSELECT f.*, target FROM f JOIN lab USING (o_custkey)"
    for mode in ("public_vs_private", "train_vs_public", "train_vs_private"):
        q[f"population_{mode}"] = _population(mode)
    return q
