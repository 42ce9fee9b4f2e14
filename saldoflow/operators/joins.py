"""Totals of entities with a distinct count of their audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audited_totals(
    entities: DataFrame, audits: DataFrame, key: str, name: str, measure: str, audit_key: str, audit_value: str
) -> DataFrame:
    """Sum of ``measure`` per entity and its number of distinct audits, one row per audit row of the entity.

    The distinct count is taken per audit key before the left join, so the join has at most one match per
    entity and a key with very many audits is counted in parallel by (key, value) first. Entities without
    audits have a count of zero and drop out in the last join.
    """
    totals = entities.groupBy(key, name).agg(F.sum(measure).alias("total"))
    counted = audits.groupBy(audit_key).agg(F.count_distinct(audit_value).alias("total_auditorias"))
    summary = totals.join(counted, F.col(key) == F.col(audit_key), "left").select(
        key, name, "total", F.coalesce("total_auditorias", F.lit(0)).alias("total_auditorias")
    )
    return summary.join(audits.select(F.col(audit_key).alias(key)), key)
