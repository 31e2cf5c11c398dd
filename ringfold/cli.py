"""Command lines: python -m ringfold.cli pipeline | generate | confirm. Options default to the settings."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.functions.settings import get, group
from ringfold.operators import generator
from ringfold.plans.session import SETTINGS
from ringfold.sources import transactions as tx
from ringfold.streaming import pipelines


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ringfold")
    commands = p.add_subparsers(dest="command", required=True)
    run = commands.add_parser("pipeline", help="transactions and confirmations to components, labels, scores and alerts")
    run.add_argument("--parallelism", type=int, default=get("FLINK_PARALLELISM"))
    run.add_argument("--dry-run", action="store_true", help="print the plan of the alerts and end")
    run.add_argument("--transactions", help="folder of JSON lines; without it, the topic")
    run.add_argument("--confirmations", help="folder of JSON lines; without it, the topic")
    run.add_argument("--out", required=True, help="folder of the results")
    run.add_argument("--once", action="store_true", help="what the sources have now, then end")
    make = commands.add_parser("generate", help="synthetic transactions as JSON lines")
    make.add_argument("--out", required=True)
    make.add_argument("--events", type=int, default=10_000)
    for name, value in vars(group("GENERATOR")).items():
        make.add_argument("--" + name.replace("_", "-"), type=type(value), default=value)
    say = commands.add_parser("confirm", help="a confirmation as a JSON line")
    say.add_argument("component_id")
    say.add_argument("--members", nargs="*", default=[])
    say.add_argument("--reason", default="")
    say.add_argument("--analyst", default="system")
    say.add_argument("--out", required=True)
    return p


def wire(rows: DataFrame) -> DataFrame:
    """Generated transactions as they are sent."""
    return rows.select("transaction_id", F.timestamp_micros("ts_us").alias("timestamp"), "account_id", "merchant_id", (F.col("amount_cents") / 100).alias("amount_usd"), "status", "device_id", "ip_address", "card_last4", "country_code", "mcc")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("ringfold").config(map=SETTINGS).getOrCreate()
    if a.command == "confirm":
        tx.confirmation(spark, a.component_id, a.members, a.reason, a.analyst).write.mode("append").text(a.out)
        return
    if a.command == "generate":
        g = group("GENERATOR", **{n: getattr(a, n) for n in vars(group("GENERATOR"))})
        tx.json_sink(wire(generator.traffic(spark, a.events, g)), a.out)
        return
    spark.conf.set("spark.sql.shuffle.partitions", a.parallelism)
    txns = tx.file_stream(spark, a.transactions) if a.transactions else tx.transaction_stream(spark)
    said = tx.file_stream(spark, a.confirmations) if a.confirmations else tx.confirmation_stream(spark)
    if a.dry_run:
        pipelines.found_alerts(pipelines.scored(pipelines.features(tx.good(tx.parse(txns))))).explain("formatted")
        return
    for q in pipelines.topology(txns, said, a.out, {"availableNow": True} if a.once else None, None if a.once else 30_000):
        q.awaitTermination()


if __name__ == "__main__":
    main()
