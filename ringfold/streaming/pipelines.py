"""Streaming topologies: transactions to snapshots, to alerts, and confirmations to labels.

The batch operators do the stateless work on the stream as well; only dedup,
features, rate limit and component merging need state. All three steps from a
transaction to an alert are keyed by account.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ringfold.functions.settings import get
from ringfold.operators.alerts import GAP_US, alerts
from ringfold.operators.edges import entity_edges, shard
from ringfold.operators.labels import known, labels, upsert
from ringfold.operators.rules import score
from ringfold.plans.shared import exists, publish, published, shared_dir
from ringfold.sources.transactions import good, parse, parse_confirmations
from ringfold.streaming.processors import BUCKET, DAY, FEATURE_SCHEMA, RUN_SCHEMA, SNAPSHOT_COLUMNS, SNAPSHOT_SCHEMA, Features, GapFilter, Resolver

#: Groups that the keys of a stateful step are dealt to. State is kept by bucket, so a running stream's checkpoint is of one number.
BUCKETS = 1024
PACKED_SCHEMA = "edge_key string, source_id string, target_id string, ts_us array<long>, transaction_id array<string>"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed(rows: DataFrame, key: str, processor: StatefulProcessor, schema, clock: bool = False) -> DataFrame:
    """rows through a processor, stream or batch alike. clock: processing time runs, for expiry and timers; such a query goes on
    until it is stopped, so a batch, or a stream over all that its source has now, does without.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows.sparkSession.streams.active  # starts the coordinator of state stores, which a batch run needs too
    return rows.groupBy(key).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="ProcessingTime" if clock else "None")


def late_ms() -> int:
    return get("FLINK_MAX_OUT_OF_ORDERNESS_MS")


def bucketed(rows: DataFrame, key: str, processor: StatefulProcessor, schema, clock: bool = False) -> DataFrame:
    """keyed(), with the keys in BUCKETS groups by hash, for processors that tell the keys of a group apart."""
    return keyed(rows.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")), BUCKET, processor, schema, clock)


def gap_filter(gap: int, tie: str, inclusive: bool = True, clock: bool = False, **more) -> GapFilter:
    """A GapFilter whose state lives as long as the gap and the bound on lateness, if there is a clock."""
    return GapFilter(gap, tie, inclusive, gap // 1000 + late_ms() if clock else None, **more)


def deduplicated(edges: DataFrame, gap: int = DAY, clock: bool = False) -> DataFrame:
    """Edges whose canonical key was not emitted in the last 24 hours."""
    return bucketed(edges, "edge_key", gap_filter(gap, "transaction_id", False, clock, by="edge_key"), edges.schema, clock)


def features(txns: DataFrame, clock: bool = False) -> DataFrame:
    rows = txns.select("transaction_id", "account_id", "ts_us", "amount_cents", "device_id", "ip_address", "country_code")
    return bucketed(rows, "account_id", Features(late_ms() * 1000, DAY // 1000 + late_ms() if clock else None), FEATURE_SCHEMA, clock)


def limited(found: DataFrame, clock: bool = False) -> DataFrame:
    """High alerts of an account at most once in GAP_US, others unlimited. All go through one filter: a union of two would compute what is before it twice."""
    rows = found.withColumn("free_of_limit", ~F.coalesce(F.col("composite_score") >= get("ALERT_SCORE_THRESHOLD_HIGH"), F.lit(False)))
    return bucketed(rows, "account_id", gap_filter(GAP_US, "transaction_id", clock=clock, by="account_id", free="free_of_limit"), rows.schema, clock).drop("free_of_limit")


def scored(features_: DataFrame, found: DataFrame | None = None, snapshots: DataFrame | None = None) -> DataFrame:
    """Feature rows to scores. found: labels, valid at each row's own time. snapshots: of components; the newest one that names an account gives its size."""
    rows = features_
    if snapshots is not None:
        named = snapshots.select(F.explode("member_ids").alias("__member"), F.struct("last_us", "size", "component_id").alias("s")).groupBy("__member").agg(F.max("s").alias("__s"))
        rows = rows.join(named, F.col("account_id") == F.col("__member"), "left").withColumns({"component_id": F.col("__s.component_id"), "component_size": F.col("__s.size")}).drop("__member", "__s")
    else:
        rows = rows.withColumns({"component_id": F.col("account_id"), "component_size": F.lit(None).cast("long")})
    if found is None:
        return score(rows, F.col("component_size"))
    return score(known(rows, found), F.col("component_size"), F.col("known"))


def found_alerts(scores: DataFrame) -> DataFrame:
    return alerts(scores).select("transaction_id", "account_id", "ts_us", "composite_score", "severity", "recommended_action", "component_size", F.concat_ws(",", "triggered").alias("triggered"))


def alert_stream(txns: DataFrame, found: DataFrame | None = None, snapshots: DataFrame | None = None) -> DataFrame:
    """Transactions to rate-limited alerts, with static tables of labels and snapshots; topology() reads these anew in each batch."""
    return limited(found_alerts(scored(features(txns), found, snapshots)))


def component_stream(txns: DataFrame, shards: int = 1, heartbeat_ms: int | None = None) -> DataFrame:
    """Transactions to component snapshots, one for each merge, and with heartbeat_ms, on a stream, all of them again and again. Edges repeat within 24 hours without effect, so dedup comes first.

    With several shards, which run side by side, a component is one of its shard: crossing() has the edges that concern
    two of them, and connected_components() over the edges has the components of all.
    """
    clock = heartbeat_ms is not None
    edges = entity_edges(txns).select("edge_key", "source_id", "target_id", "ts_us", "transaction_id")
    edges = bucketed(edges, "edge_key", gap_filter(DAY, "transaction_id", False, clock, by="edge_key", packed=True), PACKED_SCHEMA, clock)
    edges = edges.withColumn("shard", shard(F.col("source_id"), F.col("target_id"), shards))
    return unrolled(keyed(edges, "shard", Resolver(heartbeat_ms=heartbeat_ms), RUN_SCHEMA, clock))


def unrolled(runs: DataFrame) -> DataFrame:
    """A row a snapshot from a Resolver's runs, dealt out first, as all come from the task of their shard."""
    changing = ["size", "edge_count", "first_us", "last_us", "absorbed"]
    dealt = runs.repartition(F.col("component_id"), F.col("size")[0], F.col("last_us")[0])
    rows = dealt.select("component_id", "member_ids", "transaction_ids", F.explode(F.arrays_zip(*changing)).alias("s"))
    return rows.select("component_id", "member_ids", "transaction_ids", "s.*").select(*SNAPSHOT_COLUMNS)


def crossing(edges: DataFrame, shards: int) -> DataFrame:
    """Edges whose ends belong to different shards by their own ids: the side output of sharded resolution."""
    own = lambda c: shard(F.col(c), F.col(c), shards)
    return edges.withColumns({"source_shard": own("source_id"), "target_shard": own("target_id")}).where("source_shard <> target_shard")


def heartbeat(snapshots: DataFrame, least: int = 3) -> DataFrame:
    """The newest snapshot of each component of `least` nodes or more that no later merge ended."""
    order = ["size", "edge_count", "last_us"]
    newest = snapshots.groupBy("component_id").agg(F.max(F.struct(*order)).alias("s")).select("component_id", "s.*").where(F.col("size") >= least)
    ended = snapshots.where("absorbed IS NOT NULL").select(F.col("absorbed").alias("component_id")).distinct()
    left = newest.join(ended, "component_id", "left_anti")  # without the lists, which only the rows that are left need
    rows = snapshots.select(*(F.col(c).alias(c) for c in ("component_id", "size", "edge_count", "member_ids", "transaction_ids", "first_us", "last_us")))
    return rows.join(left, ["component_id", *order], "left_semi").dropDuplicates(["component_id"])


LABEL_SCHEMA = "kind string, key string, component_id string, confirmed_us long, expires_us long, reason string, analyst string, member_count int"


def label_writer(path: str, audit: str | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: valid confirmations renew the labels published at path, all lines go on to the audit folder unchanged."""

    def write(batch: DataFrame, batch_id: int) -> None:
        new = labels(batch.where("component_id IS NOT NULL").withColumn("confirmed_us", F.unix_micros(F.coalesce("confirmed_at", F.current_timestamp()))))
        publish(upsert(published(batch.sparkSession, f"{path}/labels", new.schema), new), f"{path}/labels")
        if audit:
            batch.select("raw").write.mode("append").text(audit)

    return write


def topology(transactions: DataFrame, confirmations: DataFrame, folder: str, trigger: dict | None = None, heartbeat_ms: int | None = 30_000) -> list[StreamingQuery]:
    """The whole flow from two streams of JSON lines to components, labels, scores and alerts below `folder`, as started queries.

    Each query has its own checkpoint and meets the others at tables: scores read the newest labels and snapshots in every
    batch, and a batch that is run again writes the same rows to the same place. trigger: as of writeStream, by default one each
    FLINK_CHECKPOINT_INTERVAL_MS. With heartbeat_ms state expires and components come again by the clock; None is for trigger availableNow.
    """
    spark, trigger = transactions.sparkSession, trigger or {"processingTime": f"{get('FLINK_CHECKPOINT_INTERVAL_MS')} milliseconds"}
    base = get("FLINK_CHECKPOINT_DIR") or f"{folder}/checkpoints"
    txns = good(parse(transactions))

    def start(rows: DataFrame, name: str, write: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
        w = rows.writeStream.queryName(f"{name}-{uuid.uuid4().hex[:8]}").option("checkpointLocation", f"{base}/{name}").trigger(**trigger)
        return (w.foreachBatch(write) if write else w.format("parquet").option("path", f"{folder}/{name}")).start()

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        found = published(spark, f"{folder}/labels", LABEL_SCHEMA)
        snapshots = spark.read.schema(SNAPSHOT_SCHEMA).parquet(f"{folder}/components") if exists(spark, f"{folder}/components/_spark_metadata") else None
        found_alerts(scored(batch, found, snapshots)).write.mode("overwrite").parquet(f"{folder}/scores/batch={batch_id}")

    started = [start(parse_confirmations(confirmations), "labels", label_writer(folder, f"{folder}/audit")), start(component_stream(txns, heartbeat_ms=heartbeat_ms), "components"), start(features(txns, heartbeat_ms is not None), "scores", score_batch)]
    return started


def alerts_of(spark: SparkSession, folder: str, clock: bool = False) -> DataFrame:
    """The stream of rate-limited alerts from the scores that topology() writes."""
    schema = "transaction_id string, account_id string, ts_us long, composite_score double, severity string, recommended_action string, component_size long, triggered string"
    return limited(spark.readStream.schema(schema).parquet(f"{folder}/scores/batch=*"), clock)


def run_to_table(stream: DataFrame, name: str, partitions: int = 8) -> DataFrame:
    """Run a stream over all that its source has now into a Parquet table in the shared folder, and read that."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/ringfold-stream-{name}-{uuid.uuid4().hex}"
    query = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
