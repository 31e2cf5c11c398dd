"""Analyst labels: written from confirmations, valid for 90 days, looked up by equality joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VALID_US = 90 * 24 * 3_600_000_000


def labels(confirmations: DataFrame) -> DataFrame:
    """One component label and one label a member from (component_id, member_ids, reason, analyst, confirmed_us)."""
    keys = F.concat(F.array(F.struct(F.lit("component").alias("kind"), F.col("component_id").alias("key"))), F.transform(F.coalesce("member_ids", F.array().cast("array<string>")), lambda m: F.struct(F.lit("entity").alias("kind"), m.alias("key"))))
    c = confirmations.where("component_id IS NOT NULL")
    rows = c.select("component_id", "reason", "analyst", "confirmed_us", F.size(F.coalesce("member_ids", F.array().cast("array<string>"))).alias("member_count"), F.explode(keys).alias("k"))
    return rows.select("k.kind", "k.key", "component_id", "confirmed_us", (F.col("confirmed_us") + VALID_US).alias("expires_us"), "reason", "analyst", "member_count")


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """The latest label of each (kind, key): a repeated confirmation renews its time."""
    last = Window.partitionBy("kind", "key").orderBy(F.col("confirmed_us").desc(), "component_id")
    return old.unionByName(new).withColumn("__r", F.row_number().over(last)).where("__r = 1").drop("__r")


def lookup(found: DataFrame, kind: str, key: str) -> DataFrame:
    """The label of a component or entity, if any."""
    return found.where((F.col("kind") == kind) & (F.col("key") == key))


def known(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with `known`: its component or its account has a valid label at ts_us.

    found has one label for each (kind, key), as upsert leaves them, so two equality joins keep the rows as they are.
    """
    flag = F.lit(False)
    for kind, column in (("component", "component_id"), ("entity", "account_id")):
        mine = found.where(F.col("kind") == kind).select(F.col("key").alias(f"__{kind}"), F.col("confirmed_us").alias(f"__{kind}_from"), F.col("expires_us").alias(f"__{kind}_to"))
        rows = rows.join(mine, F.col(column) == F.col(f"__{kind}"), "left")
        flag = flag | F.coalesce((F.col("ts_us") >= F.col(f"__{kind}_from")) & (F.col("ts_us") < F.col(f"__{kind}_to")), F.lit(False))
    return rows.withColumn("known", flag).drop(*[f"__{kind}{end}" for kind in ("component", "entity") for end in ("", "_from", "_to")])
