"""Aggregates of a monitoring board."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def alerts_by_severity(found: DataFrame) -> DataFrame:
    return found.groupBy("severity").agg(F.count("*").alias("n_alerts"))


def score_percentiles(scored: DataFrame, exact: bool = False) -> DataFrame:
    """p50, p95 and p99 of the composite score; exact ones hold the distinct scores, of which there are at most 10,001."""
    at = [0.5, 0.95, 0.99]
    p = F.percentile("composite_score", F.array(*map(F.lit, at))) if exact else F.percentile_approx("composite_score", at, 10_000)
    return scored.agg(p.alias("p")).select(*[F.col("p")[i].cast("double").alias(n) for i, n in enumerate(("p50", "p95", "p99"))])


def rule_triggers(scored: DataFrame) -> DataFrame:
    return scored.select(F.explode("triggered").alias("rule")).groupBy("rule").agg(F.count("*").alias("n_triggers"))


def component_sizes(snaps: DataFrame, exact: bool = True) -> DataFrame:
    p = F.percentile("size", F.array(F.lit(0.5), F.lit(0.95))) if exact else F.percentile_approx("size", [0.5, 0.95], 10_000)
    return snaps.agg(F.count("*").alias("n_components"), F.sum("size").alias("n_entities"), F.max("size").alias("max_size"), p.alias("p")).select("n_components", "n_entities", "max_size", F.col("p")[0].cast("double").alias("p50"), F.col("p")[1].cast("double").alias("p95"))


def observed(rows: DataFrame, name: str = "ringfold") -> DataFrame:
    """rows with a count that a StreamingQueryListener or Observation can read."""
    return rows.observe(name, F.count(F.lit(1)).alias("rows"))
