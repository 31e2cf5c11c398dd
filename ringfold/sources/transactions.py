"""Transactions: the test tables' adapter, JSON parsing with a quarantine, brokers and files."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.functions.schemas import CONFIRMATION_DDL, STATUSES, TRANSACTION_DDL
from ringfold.functions.settings import group

T0 = 1_704_067_200_000_000  # 2024-01-01 UTC


def adapter(events: DataFrame, squeeze: int = 1) -> DataFrame:
    """The `events` table as transactions, invalid ones included; squeeze divides the time since T0.

    Users stand in blocks of 2, 3, 6, 14 and 29 that share devices, addresses and merchants.
    """
    e = events.select("event_id", "user_id", "event_type", "value", F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    r = F.col("user_id") % 54
    step = F.when(r < 2, 0).when(r < 5, 1).when(r < 11, 2).when(r < 25, 3).otherwise(4)
    e = e.withColumn("block", (F.floor(F.col("user_id") / 54) * 5 + step).cast("long"))
    us = F.lit(T0) + F.floor((F.col("us") - T0) / squeeze) if squeeze > 1 else F.col("us")
    k, block = F.col("k"), F.col("block").cast("string")
    return e.select(
        F.concat(F.lit("txn_"), "event_id").alias("transaction_id"),
        us.cast("long").alias("ts_us"),
        F.concat(F.lit("acct_"), "user_id").alias("account_id"),
        F.concat(F.lit("merch_"), block, F.lit("_"), (k % 5).cast("string")).alias("merchant_id"),
        F.col("value").alias("amount_raw"),
        F.floor(F.col("value") * 100 + 0.5).cast("long").alias("amount_cents"),
        F.when(F.col("event_type") == "purchase", "approved").when(F.col("event_type") == "error", "declined").when(F.col("event_type") == "logout", "reversed").otherwise("pending").alias("status"),
        F.when(k % 10 == 0, F.lit(None).cast("string")).when(k % 10 == 1, "").otherwise(F.concat(F.lit("dev_"), block)).alias("device_id"),
        F.when(k % 4 != 0, F.concat(F.lit("10.0."), block, F.lit("."), (k % 3).cast("string"))).alias("ip_address"),
        F.when(k % 2 == 0, F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("card_last4"),
        F.when(k < 70, "US").when(k < 80, F.lit(None).cast("string")).when(k < 90, "CA").otherwise("gb").alias("country_code"),
        (5400 + k % 7).cast("string").alias("mcc"),
    )


def valid() -> Column:
    """A transaction that counts: an amount over zero before rounding, an account and a merchant."""
    return (F.col("amount_raw") > 0) & F.col("account_id").isNotNull() & F.col("merchant_id").isNotNull()


def transactions(spark: SparkSession, sf_dir: str, squeeze: int = 1) -> DataFrame:
    return adapter(spark.read.parquet(f"{sf_dir}/events.parquet"), squeeze).where(valid()).drop("amount_raw")


def parse(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines to transactions plus `error`: null, or why the line is no transaction. Split with good() and bad()."""
    r = F.from_json(F.col(column).cast("string"), TRANSACTION_DDL + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    d = lines.select(F.col(column).cast("string").alias("raw"), r.alias("r")).select("raw", "r.*")
    status = F.coalesce("status", F.lit("pending"))
    error = (
        F.when(F.col("_corrupt").isNotNull() | F.col("raw").isNull(), "malformed")
        .when(F.col("account_id").isNull() | F.col("merchant_id").isNull() | F.col("amount_usd").isNull(), "missing field")
        .when(~(F.col("amount_usd") > 0), "amount not above zero")
        .when(F.length(F.coalesce("currency", F.lit("USD"))) > 3, "currency too long")
        .when(~status.isin(*STATUSES), "unknown status")
    )
    cents = F.floor(F.col("amount_usd") * 100 + 0.5).cast("long")
    key = F.coalesce("transaction_id", F.sha2("raw", 256))
    return d.select(
        key.alias("transaction_id"), F.coalesce("timestamp", F.timestamp_micros(F.lit(0))).alias("timestamp"), F.unix_micros(F.coalesce("timestamp", F.timestamp_micros(F.lit(0)))).alias("ts_us"), "account_id", "merchant_id",
        (cents / 100).alias("amount_usd"), cents.alias("amount_cents"), F.coalesce("currency", F.lit("USD")).alias("currency"), status.alias("status"),
        "device_id", "ip_address", "card_last4", "phone_number", "email", "mcc", "country_code", "metadata", "raw", error.alias("error"),
    )


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where("error IS NULL").drop("error", "raw")


def bad(parsed: DataFrame) -> DataFrame:
    return parsed.where("error IS NOT NULL").select("raw", "error")


def broker_stream(spark: SparkSession, topic: str, broker: SimpleNamespace | None = None, earliest: bool | None = None, most: int = 1_000_000) -> DataFrame:
    """`value` strings of a Kafka topic; needs Spark's Kafka connector on the class path."""
    broker = broker or group("KAFKA")
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", broker.bootstrap_servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", broker.auto_offset_reset if earliest is None else "earliest" if earliest else "latest").option("maxOffsetsPerTrigger", most).option("kafka.group.id", broker.consumer_group)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def transaction_stream(spark: SparkSession, broker: SimpleNamespace | None = None, earliest: bool = False) -> DataFrame:
    broker = broker or group("KAFKA")
    return broker_stream(spark, broker.transactions_topic, broker, earliest)


def confirmation_stream(spark: SparkSession, broker: SimpleNamespace | None = None) -> DataFrame:
    broker = broker or group("KAFKA")
    return broker_stream(spark, broker.confirmations_topic, SimpleNamespace(**{**vars(broker), "consumer_group": f"{broker.consumer_group}-confirmations"}), True)


def component_stream(spark: SparkSession, broker: SimpleNamespace | None = None) -> DataFrame:
    broker = broker or group("KAFKA")
    return broker_stream(spark, broker.components_topic, broker, True)


def file_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """`value` strings of JSON-lines files as they arrive in a folder."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(folder)


def parse_confirmations(lines: DataFrame, column: str = "value") -> DataFrame:
    """Confirmations with their raw line; malformed ones have a null component_id and are passed on by the audit sink."""
    r = F.from_json(F.col(column).cast("string"), CONFIRMATION_DDL)
    return lines.select(F.col(column).cast("string").alias("raw"), r.alias("r")).select("raw", "r.component_id", F.coalesce("r.member_ids", F.array().cast("array<string>")).alias("member_ids"), F.coalesce("r.reason", F.lit("")).alias("reason"), F.coalesce("r.analyst", F.lit("system")).alias("analyst"), "r.confirmed_at")


#: Times keep their microseconds on the wire.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def as_json(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct("*"), JSON).alias("value"))


def broker_sink(rows: DataFrame, topic: str, checkpoint: str, broker: SimpleNamespace | None = None):
    """A writer of rows as JSON to a topic, at least once; call start() on it."""
    broker = broker or group("KAFKA")
    writer = as_json(rows).writeStream.format("kafka").option("kafka.bootstrap.servers", broker.bootstrap_servers).option("topic", topic).option("checkpointLocation", checkpoint)
    return writer.option("kafka.batch.size", broker.batch_size).option("kafka.linger.ms", broker.linger_ms).option("kafka.compression.type", broker.compression_type)


def alert_sink(alerts: DataFrame, checkpoint: str, broker: SimpleNamespace | None = None):
    return broker_sink(alerts, (broker or group("KAFKA")).alerts_topic, checkpoint, broker)


def component_sink(snapshots: DataFrame, checkpoint: str, broker: SimpleNamespace | None = None):
    return broker_sink(snapshots, (broker or group("KAFKA")).components_topic, checkpoint, broker)


def audit_sink(confirmations: DataFrame, checkpoint: str, broker: SimpleNamespace | None = None):
    return broker_sink(confirmations, (broker or group("KAFKA")).confirmations_topic + "-audit", checkpoint, broker)


def json_sink(rows: DataFrame, folder: str) -> None:
    """Rows as JSON lines in a folder."""
    rows.write.mode("append").json(folder)


def confirmation(spark: SparkSession, component_id: str, member_ids: list[str], reason: str = "", analyst: str = "system") -> DataFrame:
    """One confirmation event as a JSON line, stamped now."""
    row = spark.createDataFrame([(component_id, member_ids, reason, analyst)], "component_id string, member_ids array<string>, reason string, analyst string")
    return as_json(row.withColumn("confirmed_at", F.current_timestamp()))


def confirmation_of(snapshots: DataFrame, reason: str = "", analyst: str = "system") -> DataFrame:
    """Confirmation events as JSON lines for component snapshots."""
    return as_json(snapshots.select("component_id", "member_ids", F.lit(reason).alias("reason"), F.lit(analyst).alias("analyst"), F.current_timestamp().alias("confirmed_at")))
