"""Do two populations differ, and which features tell them apart?"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from panelwise.operators.cv import cross_validate, top_features
from panelwise.operators.folds import stratified_sample
from panelwise.operators.metrics import roc_auc
from panelwise.spec import PanelSpec

# Months of the newest row that mark the two parts of the test population.
PUBLIC_MONTH = 10
PRIVATE_MONTH = 4
MODES = ("public_vs_private", "train_vs_public", "train_vs_private")


def newest_month(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """``(key, month)`` of each key's newest row; reads two columns."""
    return spec.prepare(panel.select(spec.key, spec.ts)).groupBy(spec.key).agg(F.month(F.max(spec.ts)).alias("month"))


def population(
    train: DataFrame,
    test: DataFrame,
    spec: PanelSpec,
    mode: str,
    public_month: int = PUBLIC_MONTH,
    private_month: int = PRIVATE_MONTH,
) -> DataFrame:
    """``(key, month, target)`` of the two populations to tell apart, from their panels."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, use one of {MODES}")
    tested = newest_month(test, spec)
    if mode == "public_vs_private":
        return tested.withColumn("target", (F.col("month") == private_month).cast("int"))
    month = public_month if mode == "train_vs_public" else private_month
    return (
        newest_month(train, spec)
        .withColumn("target", F.lit(0))
        .unionByName(tested.where(F.col("month") == month).withColumn("target", F.lit(1)))
    )


@dataclass
class Drift:
    report: DataFrame  # round, auc, feature, status
    drifting: list[str]
    kept: list[str]


def _auc(part: DataFrame, target: str, score: str, key: str, by: str | None = None) -> DataFrame:
    return roc_auc(part, target, score, by)


@dataclass
class _Round:
    score: float
    importances: DataFrame


def _told_apart(
    rows: DataFrame, features: list[str], target: str, key: str, params: dict | None, first_fold_only: bool
) -> _Round | None:
    """How well two-fold models tell the classes apart; None if a fold holds one class only."""
    cv = cross_validate(rows, features, target, key, 2, params, first_fold_only=first_fold_only, score=_auc)
    mean = cv.mean_score()
    cv.release()
    return None if mean is None else _Round(mean, cv.importances)


def drift_features(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    threshold: float = 0.7,
    step: int = 5,
    rate: float = 1.0,
    params: dict | None = None,
    first_fold_only: bool = False,
) -> Drift:
    """Drop the most telling features until two-fold AUC is no longer above the threshold.

    Features go ``step`` at a time. Once the AUC has fallen, the last batch is put back and the search
    goes on one feature at a time. Importance is the mean over folds. No features at all count as an
    AUC that has fallen, so the search ends after at most two passes over the features.
    """
    rows = stratified_sample(df, target, key, rate) if rate < 1.0 else df
    kept, drifting, batch, log = list(features), [], [], []
    round_no = 0
    while True:
        told = _told_apart(rows, kept, target, key, params, first_fold_only) if kept else None
        score = told.score if told else None
        if told and told.score > threshold:
            batch = top_features(told.importances, min(step, len(kept)))
            drifting += batch
            kept = [f for f in kept if f not in batch]
            log += [(round_no, score, f, "dropped") for f in batch]
        elif len(batch) > 1:
            drifting = [f for f in drifting if f not in batch]
            kept += batch
            log += [(round_no, score, f, "restored") for f in batch]
            batch, step = [], 1
        else:
            log.append((round_no, score, None, "done"))
            break
        round_no += 1
    report = df.sparkSession.createDataFrame(log, "round int, auc double, feature string, status string")
    return Drift(report, drifting, kept)
