"""Synthetic traffic from row numbers and hashes: the same seed gives the same rows on any cluster, without a driver loop."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.functions.settings import group

PATTERNS = ("star", "chain", "cycle", "dense")
T0 = 1_704_067_200_000_000


def pick(n: int | Column, *cols) -> Column:
    """A hash of the columns as a number from 0 to n - 1."""
    return F.pmod(F.xxhash64(*[c if isinstance(c, Column) else F.lit(c) for c in cols]), F.lit(n) if isinstance(n, int) else n)


def unit(*cols) -> Column:
    return (pick(1 << 30, *cols) + 0.5) / float(1 << 30)


def pool(spark: SparkSession, g: SimpleNamespace | None = None) -> dict[str, DataFrame]:
    """Entity pools: accounts, merchants, devices, ips, cards."""
    g = g or group("GENERATOR")
    named = lambda prefix, n: spark.range(n).select(F.concat(F.lit(prefix), F.lpad(F.hex(F.xxhash64(F.lit(prefix), F.lit(g.seed), "id")), 16, "0")).alias("id"))
    return {"accounts": named("acct_", g.num_legitimate_accounts), "merchants": named("merch_", g.num_merchants), "devices": named("dev_", g.num_legitimate_accounts * 3 // 4), "ips": named("ip_", g.num_legitimate_accounts // 2), "cards": named("card_", g.num_legitimate_accounts)}


def _id(prefix: str, seed: int, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.hex(F.xxhash64(F.lit(prefix), F.lit(seed), number.cast("long"))), 16, "0"))


def rings(spark: SparkSession, g: SimpleNamespace | None = None) -> DataFrame:
    """ring_id, pattern, size, first (number of its first account); rings take disjoint stretches of the pool while it lasts."""
    g = g or group("GENERATOR")
    size = (F.lit(g.ring_min_size) + pick(g.ring_max_size - g.ring_min_size + 1, "size", g.seed, F.col("id"))).cast("int")
    pattern = F.element_at(F.array(*map(F.lit, PATTERNS)), (pick(len(PATTERNS), "pattern", g.seed, F.col("id")) + 1).cast("int"))
    return spark.range(g.num_fraud_rings).select(F.col("id").alias("ring_id"), pattern.alias("pattern"), size.alias("size"), F.pmod(F.col("id") * g.ring_max_size, F.lit(g.num_legitimate_accounts)).alias("first"))


def legitimate(spark: SparkSession, n: int, g: SimpleNamespace | None = None) -> DataFrame:
    """n ordinary transactions: log-normal amounts from 1 to 5,000, one device and address an account."""
    g = g or group("GENERATOR")
    i, seed = F.col("id"), g.seed
    account = pick(g.num_legitimate_accounts, "account", seed, i)
    normal = F.sqrt(-2 * F.log(unit("u", seed, i))) * F.cos(2 * 3.141592653589793 * unit("v", seed, i))
    cents = F.floor(F.least(F.greatest(F.exp(3.5 + 1.2 * normal), F.lit(1.0)), F.lit(5000.0)) * 100)
    return spark.range(n).select(
        F.concat(F.lit("gen_"), i).alias("transaction_id"), (F.lit(T0) + F.floor(i * (1e6 / g.events_per_second))).cast("long").alias("ts_us"),
        _id("acct_", seed, account).alias("account_id"), _id("merch_", seed, pick(g.num_merchants, "merchant", seed, i)).alias("merchant_id"), cents.cast("long").alias("amount_cents"), F.lit("approved").alias("status"),
        _id("dev_", seed, account).alias("device_id"), F.concat(F.lit("10."), (account / 65536).cast("int"), F.lit("."), F.pmod((account / 256).cast("int"), F.lit(256)), F.lit("."), F.pmod(account, F.lit(256))).alias("ip_address"),
        F.lpad(F.pmod(account, F.lit(10000)).cast("string"), 4, "0").alias("card_last4"), F.when(pick(10, "country", seed, i) < 9, "US").otherwise("CA").alias("country_code"), (5400 + pick(7, "mcc", seed, i)).cast("string").alias("mcc"), F.lit(None).cast("long").alias("ring_id"), F.lit(None).cast("string").alias("pattern"),
    )


def fraudulent(spark: SparkSession, rounds: int = 1, g: SimpleNamespace | None = None) -> DataFrame:
    """Ring transactions. star: members share the hub's device; chain: neighbours share one; cycle: the last shares with the first; dense: one device, address and card testing under 5."""
    g = g or group("GENERATOR")
    seed = g.seed
    r = rings(spark, g).select("*", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round")).select("*", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("m"))
    # each member trades on its own link and, in chain and cycle, on the next member's
    r = r.select("*", F.explode(F.when(F.col("pattern").isin("chain", "cycle"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("side"))
    link = F.when(F.col("pattern").isin("star", "dense"), 0).when(F.col("pattern") == "cycle", F.pmod(F.col("m") + F.col("side"), F.col("size"))).otherwise(F.col("m") + F.col("side"))
    account = F.pmod(F.col("first") + F.col("m"), F.lit(g.num_legitimate_accounts))
    key = [F.col(c) for c in ("ring_id", "round", "m", "side")]
    cents = F.when(F.col("pattern") == "dense", 1 + pick(500, "small", seed, *key)).otherwise(10_000 + pick(190_000, "large", seed, *key))
    ring = F.col("ring_id").cast("string")
    return r.select(
        F.concat_ws("_", F.lit("ring"), *key).alias("transaction_id"), (F.lit(T0) + F.col("round") * 3_600_000_000 + F.col("ring_id") * 1_000_000 + F.col("m") * 1000 + F.col("side")).cast("long").alias("ts_us"),
        _id("acct_", seed, account).alias("account_id"), _id("merch_", seed, pick(g.num_merchants, "ring", seed, F.col("ring_id"))).alias("merchant_id"), cents.cast("long").alias("amount_cents"), F.lit("approved").alias("status"),
        F.concat_ws("_", F.lit("ringdev"), ring, link).alias("device_id"), F.concat(F.lit("172.16."), ring, F.lit("."), F.when(F.col("pattern") == "dense", 0).otherwise(link)).alias("ip_address"),
        F.lpad(F.pmod(account, F.lit(10000)).cast("string"), 4, "0").alias("card_last4"), F.lit("US").alias("country_code"), F.lit("5999").alias("mcc"), "ring_id", "pattern",
    )


def traffic(spark: SparkSession, n: int, g: SimpleNamespace | None = None) -> DataFrame:
    """About n transactions, fraud_ring_ratio of them from rings, in a seeded random order."""
    g = g or group("GENERATOR")
    bad = int(n * g.fraud_ring_ratio)
    rounds = max(1, -(-bad // max(1, g.num_fraud_rings * g.ring_min_size)))
    fraud = fraudulent(spark, rounds, g).orderBy(F.xxhash64(F.lit(g.seed), "transaction_id")).limit(bad)
    return legitimate(spark, n - bad, g).unionByName(fraud)


def shuffled(rows: DataFrame, seed: int = 42) -> DataFrame:
    return rows.orderBy(F.rand(seed))


def pattern_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("pattern", F.lit("legitimate")).alias("pattern")).agg(F.count("*").alias("n"))


def rate_stream(spark: SparkSession, per_second: int = 200) -> DataFrame:
    """An endless paced stream of row numbers to map generators over."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
