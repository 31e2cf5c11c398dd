"""Feature views computed in batch, point-in-time lookup, latest values and feature services."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringfold.functions.numbers import DAY, HOUR, mean_cents, ratio, round4, stddev_cents
from ringfold.functions.schemas import FEATURE_SERVICES, FEATURE_VIEWS
from ringfold.functions.settings import get
from ringfold.operators.features import flags
from ringfold.plans.shared import publish, published


def _within(as_of: int, days: float):
    return (F.col("ts_us") > as_of - int(days * DAY)) & (F.col("ts_us") <= as_of)


def account_stats(txns: DataFrame, as_of: int) -> DataFrame:
    """account_txn_stats at a time (microseconds): one aggregation, conditional sums."""
    t = flags(txns.where(F.col("ts_us") <= as_of))
    month, week, day, hour = _within(as_of, 30), _within(as_of, 7), _within(as_of, 1), F.col("ts_us") > as_of - HOUR
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    cents = F.when(month, F.col("amount_cents"))
    kinds = lambda c: F.countDistinct(F.when(month, F.nullif(c, F.lit(""))))
    g = t.groupBy("account_id").agg(
        n(hour).alias("txn_velocity_1h"), n(day).alias("txn_velocity_24h"), n(month).alias("n"), F.sum(cents).alias("s"), F.sum((cents * cents).cast("decimal(20,0)")).alias("q"),
        kinds("merchant_id").alias("unique_merchants_30d"), kinds("device_id").alias("unique_devices_30d"), kinds("ip_address").alias("unique_ips_30d"),
        n(month & F.col("is_cross_border")).alias("cross"), n(month & F.col("is_night")).alias("night"), n(week & (F.col("status") == "declined")).alias("declined"), n(week).alias("in_week"), F.min("ts_us").alias("first_seen_us"),
    )
    s, some = F.coalesce("s", F.lit(0)), F.col("n") > 0
    return g.select(
        "account_id", F.lit(as_of).cast("long").alias("event_us"), "txn_velocity_1h", "txn_velocity_24h",
        round4(F.when(some, mean_cents(s, F.col("n"))).otherwise(0.0)).alias("amount_mean_30d"), round4(F.when(some, stddev_cents(F.col("n"), s, F.coalesce("q", F.lit(0)))).otherwise(0.0)).alias("amount_stddev_30d"), (s / 100).alias("amount_total_30d"),
        "unique_merchants_30d", "unique_devices_30d", "unique_ips_30d", round4(ratio(F.col("cross"), F.col("n"))).alias("cross_border_ratio"), round4(ratio(F.col("night"), F.col("n"))).alias("night_txn_ratio"),
        round4(ratio(F.col("declined"), F.col("in_week"))).alias("declined_ratio_7d"), F.floor((F.lit(as_of) - F.col("first_seen_us")) / DAY).alias("account_age_days"), "first_seen_us",
    )


def merchant_stats(txns: DataFrame, as_of: int) -> DataFrame:
    """merchant_stats; reversed transactions stand for chargebacks, mcc is the latest; risk_category is an outside input and null here."""
    t = txns.where(F.col("ts_us") <= as_of)
    month, quarter = _within(as_of, 30), _within(as_of, 90)
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    g = t.groupBy("merchant_id").agg(n(month).alias("txn_volume_30d"), F.countDistinct(F.when(month, F.col("account_id"))).alias("unique_accounts_30d"), n(quarter & (F.col("status") == "reversed")).alias("r"), n(quarter).alias("q"), F.sum("amount_cents").alias("s"), F.count("*").alias("n"), F.max(F.struct("ts_us", "transaction_id", "mcc")).alias("last"))
    return g.select("merchant_id", F.lit(as_of).cast("long").alias("event_us"), "txn_volume_30d", "unique_accounts_30d", round4(ratio(F.col("r"), F.col("q"))).alias("chargeback_ratio_90d"), round4(mean_cents(F.col("s"), F.col("n"))).alias("avg_txn_amount"), F.col("last.mcc").alias("mcc"), F.lit(None).cast("string").alias("risk_category"))


def device_stats(txns: DataFrame, as_of: int) -> DataFrame:
    t = txns.where((F.col("ts_us") <= as_of) & (F.col("device_id") != ""))
    g = t.groupBy("device_id").agg(F.countDistinct("account_id").alias("linked_accounts_count"), F.min("ts_us").alias("first_seen_us"), F.sum(F.when(_within(as_of, 1), 1).otherwise(0)).alias("txn_velocity_24h"), F.countDistinct(F.when(_within(as_of, 30), F.upper("country_code"))).alias("countries_30d"))
    return g.select("device_id", F.lit(as_of).cast("long").alias("event_us"), "linked_accounts_count", "first_seen_us", "txn_velocity_24h", "countries_30d", F.lit(None).cast("long").alias("emulator_flag"))


def ip_stats(txns: DataFrame, as_of: int) -> DataFrame:
    t = txns.where((F.col("ts_us") <= as_of) & (F.col("ip_address") != ""))
    g = t.groupBy("ip_address").agg(F.countDistinct("account_id").alias("linked_accounts_count"), F.max(F.when(F.col("country_code").isNotNull(), F.struct("ts_us", "transaction_id", "country_code"))).alias("last"))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return g.select("ip_address", F.lit(as_of).cast("long").alias("event_us"), "linked_accounts_count", none("long", "is_vpn"), none("long", "is_tor"), none("long", "is_datacenter"), F.col("last.country_code").alias("country_code"), none("double", "abuse_score"))


def read_view(spark: SparkSession, view: str, folder: str | None = None) -> DataFrame:
    """A feature view's Parquet files with its declared schema, below FEAST_REPO_PATH unless a folder is given."""
    key, _, columns = FEATURE_VIEWS[view]
    return spark.read.schema(f"{key} string, event_timestamp timestamp, {columns}").parquet(f"{folder or get('FEAST_REPO_PATH')}/{view}")


def latest(view: DataFrame, key: str, time: str = "event_us") -> DataFrame:
    """The newest row of each key: what an online store holds. Of rows of equal time the one with the largest values stays."""
    w = Window.partitionBy(key).orderBy(F.col(time).desc(), *[F.col(c).desc() for c in view.columns if c not in (key, time)])
    return view.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def materialise(view: DataFrame, key: str, path: str, time: str = "event_us") -> None:
    """Publish the newest row of each key, merged with what the path has."""
    publish(latest(published(view.sparkSession, path, view.schema).unionByName(view), key, time), path)


def point_in_time(rows: DataFrame, view: DataFrame, key: str, days: int, time: str = "ts_us", view_time: str = "event_us") -> DataFrame:
    """rows with the view's columns as they were at each row's time, null if older than `days`.

    An as-of join by one sort: both sides are stacked, and the last feature row
    before each row is carried forward in a window. No pair of rows is ever formed.
    """
    values = [c for c in view.columns if c not in (key, view_time)]
    left = rows.select(F.col(key).alias("__k"), F.col(time).alias("__t"), F.lit(1).alias("__side"), F.struct(*rows.columns).alias("__row"), F.lit(None).cast(view.select(F.struct(view_time, *values).alias("v")).schema["v"].dataType).alias("__f"))
    right = view.select(F.col(key).alias("__k"), F.col(view_time).alias("__t"), F.lit(0).alias("__side"), F.lit(None).cast(left.schema["__row"].dataType).alias("__row"), F.struct(view_time, *values).alias("__f"))
    w = Window.partitionBy("__k").orderBy("__t", "__side", "__f").rowsBetween(Window.unboundedPreceding, 0)
    d = left.unionByName(right).withColumn("__last", F.last("__f", ignorenulls=True).over(w)).where("__side = 1")
    fresh = F.col(f"__last.{view_time}") > F.col("__t") - days * DAY
    return d.select("__row.*", *[F.when(fresh, F.col(f"__last.{c}")).alias(c) for c in [view_time, *values]])


def service(rows: DataFrame, name: str, views: dict[str, DataFrame]) -> DataFrame:
    """rows with the columns of a feature service from the newest rows of its views; absent numbers are 0."""
    out = rows
    for view, columns in FEATURE_SERVICES[name].items():
        if view not in views:
            continue
        key = FEATURE_VIEWS[view][0]
        have = [c for c in columns if c in views[view].columns]
        f = latest(views[view], key).select(F.col(key).alias("__k"), *have)
        out = out.join(f, F.col(key) == F.col("__k"), "left").drop("__k")
        numeric = [c for c in have if f.schema[c].dataType.typeName() in ("long", "integer", "double")]
        out = out.withColumns({c: F.coalesce(c, F.lit(0).cast(f.schema[c].dataType)) for c in numeric})
    return out


def enrich(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """rows with their account's newest statistics, zeros where there are none, and the z-score they imply."""
    out = service(rows, "fraud_detection_v1", {"account_txn_stats": stats})
    z = F.when(F.col("amount_stddev_30d") > 0, (F.col("amount_cents") / 100 - F.col("amount_mean_30d")) / F.col("amount_stddev_30d")).otherwise(0.0)
    return out.withColumns({"amount_zscore": round4(z), "card_testing_score": F.lit(0.0), "mule_account_score": F.lit(0.0)})
