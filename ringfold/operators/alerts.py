"""From scores to alerts: gate, severity tiers, recommended action and rate limit."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringfold.functions.settings import group
from ringfold.operators.gaps import keep_after_gap

# The gap of the rate limit, and what is recommended at each severity.
GAP_US = 600_000_000
ACTIONS = {"critical": "block_and_review", "high": "step_up_auth", "medium": "flag_for_review", "low": "monitor"}


def severity(score: Column, a: SimpleNamespace | None = None) -> Column:
    a = a or group("ALERT")
    return F.when(score >= a.score_threshold_critical, "critical").when(score >= a.score_threshold_high, "high").when(score >= a.score_threshold_medium, "medium").otherwise("low")


def action(level: Column) -> Column:
    return F.when(level == "critical", ACTIONS["critical"]).when(level == "high", ACTIONS["high"]).when(level == "medium", ACTIONS["medium"]).otherwise(ACTIONS["low"])


def size_tier(size: Column, a: SimpleNamespace | None = None) -> Column:
    """The tier of a component by its size alone, null below the smallest."""
    a = a or group("ALERT")
    return F.when(size >= a.component_size_critical, "critical").when(size >= a.component_size_high, "high").when(size >= a.component_size_medium, "medium")


def alerts(scored: DataFrame, a: SimpleNamespace | None = None) -> DataFrame:
    """Scores of `low` or more as alerts, before the rate limit."""
    a = a or group("ALERT")
    level = severity(F.col("composite_score"), a)
    d = scored.where(F.col("composite_score") >= a.score_threshold_low).withColumn("severity", level)
    if "component_size" not in d.columns:
        d = d.withColumn("component_size", F.lit(1).cast("long"))
    return d.withColumns({"component_size": F.coalesce("component_size", F.lit(1)).cast("long"), "recommended_action": action(F.col("severity"))})


def rate_limited(found: DataFrame, a: SimpleNamespace | None = None) -> DataFrame:
    """High and critical alerts at most one an account in 10 minutes, later ones dropped; low and medium ones all pass."""
    a = a or group("ALERT")
    return keep_after_gap(found, "account_id", "ts_us", "transaction_id", GAP_US, free=F.col("composite_score") < a.score_threshold_high)
