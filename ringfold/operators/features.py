"""Behavioural features of each transaction over its account's past, as windows that share one sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringfold.functions.numbers import DAY, HOUR, mean_cents, ratio, round4, stddev_cents, zscore

FEATURES = (
    "txn_velocity_1h", "txn_velocity_24h", "amount_mean_30d", "amount_stddev_30d", "amount_zscore", "unique_merchants_30d",
    "unique_devices_30d", "unique_ips_30d", "cross_border_ratio", "night_txn_ratio", "card_testing_score", "mule_account_score",
)


def flags(txns: DataFrame) -> DataFrame:
    """is_micro (under one unit), is_night (23 to 5 UTC), is_cross_border (country given and not US)."""
    hour = F.pmod(F.floor(F.col("ts_us") / HOUR), F.lit(24))
    country = F.upper(F.coalesce(F.nullif("country_code", F.lit("")), F.lit("US")))
    return txns.withColumns({"is_micro": F.col("amount_cents") < 100, "is_night": (hour >= 23) | (hour < 5), "is_cross_border": country != "US"})


def account_features(txns: DataFrame) -> DataFrame:
    """transaction_id, account_id, ts_us, amount_cents and FEATURES; an event's own row is in its windows."""
    w = Window.partitionBy("account_id").orderBy("ts_us")
    hour, day = w.rangeBetween(-HOUR, 0), w.rangeBetween(-DAY, 0)
    past = Window.partitionBy("account_id").orderBy("ts_us", "transaction_id").rowsBetween(Window.unboundedPreceding, 0)
    cents = F.col("amount_cents")
    count = lambda c, frame: F.sum(F.col(c).cast("int")).over(frame)
    distinct = lambda c: F.size(F.collect_set(F.nullif(c, F.lit(""))).over(hour)).cast("long")
    d = flags(txns).withColumns(
        {
            "txn_velocity_1h": F.count("*").over(hour),
            "txn_velocity_24h": F.count("*").over(day),
            "__micro": count("is_micro", hour),
            "__night": count("is_night", day),
            "__cross": count("is_cross_border", day),
            "unique_devices_30d": distinct("device_id"),
            "unique_ips_30d": distinct("ip_address"),
            "__n": F.count("*").over(past),
            "__s": F.sum(cents).over(past),
            "__q": F.sum((cents * cents).cast("decimal(20,0)")).over(past),
        }
    )
    n, s, q = F.col("__n"), F.col("__s"), F.col("__q")
    d = d.withColumns(
        {
            "amount_mean_30d": round4(mean_cents(s, n)),
            "amount_stddev_30d": round4(stddev_cents(n, s, q)),
            "amount_zscore": round4(zscore(cents, n, s, q)),
            "unique_merchants_30d": F.lit(0).cast("long"),
            "cross_border_ratio": round4(ratio(F.col("__cross"), F.col("txn_velocity_24h"))),
            "night_txn_ratio": round4(ratio(F.col("__night"), F.col("txn_velocity_24h"))),
            "card_testing_score": round4(ratio(F.col("__micro"), F.col("txn_velocity_1h"))),
            "mule_account_score": F.lit(0.0),
        }
    )
    return d.select("transaction_id", "account_id", "ts_us", "amount_cents", *FEATURES)


def accounts_per_device(txns: DataFrame) -> DataFrame:
    """device_id, accounts: how many accounts truly share a device."""
    return txns.where(F.col("device_id") != "").groupBy("device_id").agg(F.countDistinct("account_id").alias("accounts"))


def feature(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))
