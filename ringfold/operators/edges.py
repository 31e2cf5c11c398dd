"""Entity edges of transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_key(source: Column, target: Column, relationship: Column) -> Column:
    """The same key for an edge and its reverse."""
    return F.concat_ws("|", F.least(source, target), F.greatest(source, target), relationship)


def shard(a: Column, b: Column, shards: int) -> Column:
    """Shard of an edge, equal for both directions: by the first 32 bits of the smaller end's md5."""
    return (F.conv(F.substring(F.md5(F.least(a, b).cast("binary")), 1, 8), 16, 10).cast("long") % shards).cast("int")


def entity_edges(txns: DataFrame) -> DataFrame:
    """One to four edges a transaction: to its merchant always, to device, address and card if given and not empty."""
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    usd = F.col("amount_cents") / 100

    def edge(target: Column, kind: str, relation: str, weight: Column) -> Column:
        return F.struct(target.alias("target_id"), F.lit(kind).alias("target_type"), F.lit(relation).alias("relationship"), weight.cast("double").alias("weight"))

    made = F.array(
        edge(F.col("merchant_id"), "merchant", "transacted_at", usd),
        edge(filled("device_id"), "device", "used_device", F.lit(1.0)),
        edge(F.concat(F.lit("ip:"), filled("ip_address")), "ip_address", "used_ip", F.lit(1.0)),
        edge(F.concat(F.lit("card:"), filled("card_last4")), "card", "linked_card", F.lit(1.0)),
    )
    e = txns.select("transaction_id", "ts_us", F.col("account_id").alias("source_id"), F.explode(F.filter(made, lambda x: x["target_id"].isNotNull())).alias("x"))
    e = e.select("transaction_id", "ts_us", "source_id", F.lit("account").alias("source_type"), "x.*")
    return e.withColumn("edge_key", canonical_key(F.col("source_id"), F.col("target_id"), F.col("relationship")))


def edge_id() -> Column:
    """A deterministic id of an edge."""
    return F.substring(F.sha2(F.concat_ws("|", "transaction_id", "edge_key"), 256), 1, 32)


def type_of_id(node: Column) -> Column:
    """Entity type by the look of an id: ip: and card: prefixes, 36 characters for devices, otherwise account."""
    return F.when(node.startswith("ip:"), "ip_address").when(node.startswith("card:"), "card").when(F.length(node) == 36, "device").otherwise("account")


def density(edges: Column, size: Column) -> Column:
    return F.when(size <= 1, 0.0).otherwise(2.0 * edges / (size * (size - 1)))
