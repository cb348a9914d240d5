"""All registered queries and their SQL."""

from __future__ import annotations

from workload import family_queries, model_queries, oracle_families, oracle_models, oracle_scores, score_queries


def queries() -> dict:
    return {**family_queries.queries(), **score_queries.queries(), **model_queries.queries()}


def oracle_sql() -> dict[str, str]:
    return {**oracle_families.families(), **oracle_scores.scores(), **oracle_models.models()}
