"""Scoring metrics and the tables behind the usual score charts. All return DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelwise.functions.scalar import above, quoted, sigmoid
from panelwise.plans.ordering import quantiles, with_position, with_running

# Fixed values of the capture-and-gini metric and the reported thresholds.
NEGATIVE_WEIGHT = 20
CAPTURE_SHARE = 0.04
THRESHOLDS = (0.9, 0.8, 0.7, 0.6, 0.5)


def row_weight(target: str) -> str:
    """Each negative stands for twenty rows: they were sampled down by that factor."""
    return f"IF({target} = 1, 1, {NEGATIVE_WEIGHT})"


def _cumulated(scored: DataFrame, target: str, score: str, key: str, by: str | None = None) -> DataFrame:
    named = [f"{quoted(by)} AS by"] if by else []
    rows = scored.selectExpr(
        *named, f"{quoted(key)} AS key", f"CAST({quoted(target)} AS BIGINT) AS t", f"{quoted(score)} AS s"
    ).selectExpr("*", f"{row_weight('t')} AS w")
    return with_running(rows, ["-s", "key"], {"cum_w": "w", "cum_t": "t"}, by="by" if by else None)


def _summed(rows: DataFrame, by: str | None, **sums: str) -> DataFrame:
    """One row of aggregates, or one per value of the column ``by``."""
    columns = [F.expr(f"{e} AS {n}") for n, e in sums.items()]
    return rows.groupBy(F.col("by").alias(by)).agg(*columns) if by else rows.agg(*columns)


def lorenz_curve(scored: DataFrame, target: str, score: str, key: str) -> DataFrame:
    """Per row, by descending score: share of weight and share of positives seen so far."""
    return _cumulated(scored, target, score, key).selectExpr(
        f"key AS {quoted(key)}",
        "cum_w / cum_w_total AS weight_share",
        "try_divide(cum_t, cum_t_total) AS positive_share",
    )


def default_metric(
    scored: DataFrame, target: str, score: str, key: str, cutoff: str = "norm", by: str | None = None
) -> DataFrame:
    """One row ``(metric, gini, capture)``: mean of normalised weighted gini and capture in the top 4 %.

    ``cutoff="norm"`` compares the weight share with 4 %; ``"int"`` compares the running weight with
    4 % of the total cut to a whole number. Ties in the score are ordered by key. NULL if only one
    class is present. With ``by``, one row per value of that column (fold, model, trial), all in one pass.
    """
    top = {
        "norm": f"cum_w / cum_w_total <= {CAPTURE_SHARE}D",
        "int": f"cum_w <= floor({CAPTURE_SHARE}D * cum_w_total)",
    }[cutoff]
    sums = _summed(
        _cumulated(scored, target, score, key, by),
        by,
        p="max(cum_t_total)",
        w="max(cum_w_total)",
        captured=f"sum(IF({top}, t, 0))",
        area="sum((try_divide(cum_t, cum_t_total) - cum_w / cum_w_total) * w)",
    )
    group = [quoted(by)] if by else []
    best = f"{NEGATIVE_WEIGHT / 2} * (w - p) / {NEGATIVE_WEIGHT} * (1 - {NEGATIVE_WEIGHT - 1}D / w)"
    return sums.selectExpr(
        *group, f"try_divide(area, CAST({best} AS DOUBLE)) AS gini", "try_divide(captured, p) AS capture"
    ).selectExpr(*group, "(gini + capture) / 2 AS metric", "gini", "capture")


def score_rank(scored: DataFrame, score: str, key: str) -> DataFrame:
    """Rows with their 0-based place by descending score; equal scores are ordered by key."""
    return with_position(scored, [f"-{quoted(score)}", quoted(key)], "place").drop("place_total")


def roc_auc(scored: DataFrame, target: str, score: str, by: str | None = None) -> DataFrame:
    """Exact area under the ROC curve; a tie counts one half. NULL if only one class is present.

    With ``by``, one row per value of that column, all in one pass.
    """
    groups = [F.expr(f"{quoted(by)} AS by")] if by else []
    per_score = (
        scored.groupBy(*groups, F.expr(f"{quoted(score)} AS s"))
        .agg(F.expr("count(*) AS n"), F.expr(f"sum(CAST({quoted(target)} AS BIGINT)) AS pos"))
        .selectExpr(*(["by"] if by else []), "s", "pos", "n - pos AS neg")
    )
    # equal scores are one row now, so the score alone orders them
    ranked = with_running(per_score, ["s"], {"cum_neg": "neg", "cum_pos": "pos"}, by="by" if by else None)
    area = "try_divide(sum(pos * (cum_neg - neg / 2)), CAST(max(cum_pos_total) AS DOUBLE) * max(cum_neg_total))"
    return _summed(ranked, by, auc=area)


def _softplus(x: Column) -> Column:
    """ln(1 + exp(x)) without overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def log_loss(scored: DataFrame, target: str, log_odds: str) -> DataFrame:
    x, t = F.col(log_odds), F.col(target)
    return scored.agg(F.avg(t * _softplus(-x) + (1 - t) * _softplus(x)).alias("log_loss"))


def focal_loss_value(
    scored: DataFrame, target: str, log_odds: str, alpha: float = 1.0, gamma: float = 0.0, balance: bool = False
) -> DataFrame:
    """Mean focal loss; ``balance`` weighs positives by alpha and negatives by 1 - alpha."""
    x, t = F.col(log_odds), F.col(target)
    p = sigmoid(x)
    positive = t * F.pow(1 - p, F.lit(gamma)) * _softplus(-x)
    negative = (1 - t) * F.pow(p, F.lit(gamma)) * _softplus(x)
    loss = positive * alpha + negative * (1 - alpha) if balance else positive + negative
    return scored.agg(F.avg(loss).alias("focal_loss"))


def threshold_flags(
    df: DataFrame, score: str, thresholds: Sequence[float] = THRESHOLDS, prefix: str = "predicted"
) -> DataFrame:
    """Add ``predicted_09`` ... ``predicted_05``: 1 where the score is strictly above the threshold."""
    return df.withColumns(
        {f"{prefix}_{str(t).replace('.', '')}": above(F.col(score), t) for t in thresholds}
    )


def threshold_counts(df: DataFrame, score: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """``(threshold, n_true, n_false)``."""
    one = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(above(F.col(score), t)).alias(f"t{i}") for i, t in enumerate(thresholds)]
    )
    rows = [
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{i}").alias("n_true"), (F.col("n") - F.col(f"t{i}")).alias("n_false"))
        for i, t in enumerate(thresholds)
    ]
    return one.select(F.inline(F.array(*rows)))


def prediction_histogram(df: DataFrame, target: str, score: str, bins: int = 20) -> DataFrame:
    """``(target, bin, n, density)`` over equal bins of [0, 1]; the last bin is closed, empty bins stay.

    Unknown scores and scores outside [0, 1] count nowhere.
    """
    inside = F.col(score).between(0, 1)
    place = F.when(inside, F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)))
    counts = df.groupBy(target).agg(
        F.count(F.when(inside, 1)).alias("total"), *[F.count(F.when(place == i, 1)).alias(f"n{i}") for i in range(bins)]
    )
    rows = [
        F.struct(
            F.lit(i).alias("bin"),
            F.col(f"n{i}").alias("n"),
            F.try_divide(F.col(f"n{i}") * F.lit(float(bins)), F.col("total")).alias("density"),
        )
        for i in range(bins)
    ]
    return counts.select(target, F.inline(F.array(*rows)))


def calibration(df: DataFrame, target: str, score: str, key: str, bins: int = 50) -> DataFrame:
    """``(bin, n, mean_predicted, observed_rate)`` over exact quantile bins of known scores, open on the left."""
    df = df.where(F.col(score).isNotNull())
    edges = quantiles(df, score, key, [i / bins for i in range(1, bins)])
    inner = F.array(*[F.lit(float(e)) for e in edges])
    place = F.size(F.filter(inner, lambda e: e < F.col(score)))
    return (
        df.groupBy(place.alias("bin"))
        .agg(F.count(score).alias("n"), F.avg(score).alias("mean_predicted"), F.avg(target).alias("observed_rate"))
    )
