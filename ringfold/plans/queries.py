"""Registered queries over the test tables, each with its DuckDB twin where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.functions.numbers import DAY, HOUR, round4
from ringfold.functions.settings import group
from ringfold.operators import alerts as al
from ringfold.operators import components as cc
from ringfold.operators import edges as ed
from ringfold.operators import feature_store as fs
from ringfold.operators import features as ft
from ringfold.operators import gaps, generator, labels, metrics, rules
from ringfold.plans.shared import cut
from ringfold.sources import transactions as tx
from ringfold.streaming import pipelines as st

SQUEEZE = 60  # as many times faster than recorded, so that velocity rules have work
AS_OF = tx.T0 + 20 * DAY
GAP_12H = 12 * HOUR


def fast(spark: SparkSession, d: str) -> DataFrame:
    return tx.transactions(spark, d, SQUEEZE)


def q_transactions(spark, d):
    return tx.transactions(spark, d)


def q_invalid_transactions(spark, d):
    return tx.adapter(spark.read.parquet(f"{d}/events.parquet")).where(~tx.valid()).select("transaction_id", "amount_raw")


def q_parse_json(spark, d):
    """The transactions written as JSON lines and parsed again, with the invalid ones in quarantine."""
    t = tx.adapter(spark.read.parquet(f"{d}/events.parquet"))
    p = tx.parse(tx.as_json(t.select("transaction_id", F.timestamp_micros("ts_us").alias("timestamp"), "account_id", "merchant_id", F.col("amount_raw").alias("amount_usd"), "status", "device_id", "country_code")))
    return p.select("transaction_id", "ts_us", "account_id", "amount_cents", "status", F.coalesce("error", F.lit("")).alias("error"))


def edges(spark, d):
    return ed.entity_edges(tx.transactions(spark, d))


def q_entity_edges(spark, d):
    return edges(spark, d).drop("edge_key")


def q_edge_keys(spark, d):
    return edges(spark, d).groupBy("edge_key").agg(F.count("*").alias("n"))


def deduped(spark, d):
    return gaps.keep_after_gap(edges(spark, d), "edge_key", "ts_us", "transaction_id", DAY, inclusive=False)


def q_edge_dedup_24h(spark, d):
    e = edges(spark, d).select("edge_key", "ts_us", "transaction_id")
    return gaps.keep_after_gap(e, "edge_key", "ts_us", "transaction_id", DAY, inclusive=False)


def q_components(spark, d):
    return cc.connected_components(edges(spark, d), "source_id", "target_id")


LARGE = 120_000


def q_components_large(spark, d):
    """Chains of 1,000 nodes with scattered names, more edges than a task is given here: the rounds between tasks do the rest."""
    name = lambda i: F.pmod(i * 611_953, F.lit(1_000_003))
    e = spark.range(LARGE).where("id % 1000 <> 999").select(name(F.col("id")).alias("a"), name(F.col("id") + 1).alias("b"))
    return cc.connected_components(e, per_task=40_000).groupBy("component").agg(F.count("*").alias("n"), F.sum("node").alias("nodes"))


def snaps(spark, d):
    return cc.snapshots(cut(deduped(spark, d), "edges-deduped"))


def q_component_stats(spark, d):
    return snaps(spark, d).select("component_id", "size", "edge_count", "first_us", "last_us", F.concat_ws(",", "entity_types").alias("entity_types"), F.concat_ws(",", "member_ids").alias("members"), F.concat_ws(",", "transaction_ids").alias("transactions"))


def q_density(spark, d):
    return snaps(spark, d).select("component_id", round4(ed.density(F.col("edge_count"), F.col("size"))).alias("density"))


def q_top_components(spark, d):
    return snaps(spark, d).where("size >= 3").orderBy(F.col("size").desc(), "component_id").limit(20).select("component_id", "size")


def q_component_types(spark, d):
    n = q_components(spark, d)
    return n.groupBy("component").agg(F.concat_ws(",", F.array_sort(F.collect_set(ed.type_of_id(F.col("node"))))).alias("types"))


def q_shards(spark, d):
    e = edges(spark, d)
    return e.select(ed.shard(F.col("source_id"), F.col("target_id"), 8).alias("shard")).groupBy("shard").agg(F.count("*").alias("n"))


def feats(spark, d):
    return ft.account_features(fast(spark, d))


def q_velocity(spark, d):
    return feats(spark, d).select("transaction_id", "txn_velocity_1h", "txn_velocity_24h")


def q_amount_stats(spark, d):
    return feats(spark, d).select("transaction_id", "amount_mean_30d", "amount_stddev_30d", "amount_zscore")


def q_ratios(spark, d):
    return feats(spark, d).select("transaction_id", "card_testing_score", "night_txn_ratio", "cross_border_ratio")


def q_unique_devices_ips(spark, d):
    return feats(spark, d).select("transaction_id", "unique_devices_30d", "unique_ips_30d")


def q_accounts_per_device(spark, d):
    return ft.accounts_per_device(tx.transactions(spark, d))


def scored(spark, d):
    return rules.score(feats(spark, d))


def q_rule_contributions(spark, d):
    return scored(spark, d).select("transaction_id", F.explode("contributions").alias("rule", "contribution"))


def q_rule_triggers(spark, d):
    return scored(spark, d).select("transaction_id", F.concat_ws(",", "triggered").alias("triggered"))


def q_risk_score(spark, d):
    return scored(spark, d).select("transaction_id", "account_id", "composite_score")


def with_components(spark, d):
    """Scores with the size of the account's component in R01."""
    e = ed.entity_edges(fast(spark, d))
    nodes = cut(cc.connected_components(e, "source_id", "target_id"), "nodes")
    sizes = nodes.groupBy("component").agg(F.count("*").alias("component_size"))
    f = feats(spark, d).join(nodes.join(sizes, "component"), F.col("account_id") == F.col("node"), "left").drop("node")
    return rules.score(f, F.col("component_size")).withColumnRenamed("component", "component_id")


def q_score_with_component(spark, d):
    return with_components(spark, d).select("transaction_id", "component_id", "component_size", "composite_score")


def confirmations(spark, d):
    """Deterministic confirmations: every user divisible by 9 is confirmed, as component and as member, on day 5, and those divisible by 18 again on day 6."""
    users = spark.read.parquet(f"{d}/events.parquet").select("user_id").distinct().where("user_id % 9 = 0")
    days = F.explode(F.when(F.col("user_id") % 18 == 0, F.array(F.lit(5), F.lit(6))).otherwise(F.array(F.lit(5)))).alias("day")
    u = users.select("user_id", days)
    name = F.concat(F.lit("acct_"), "user_id")
    return u.select(F.concat(F.lit("comp_"), "user_id").alias("component_id"), F.array(name).alias("member_ids"), F.lit("ring").alias("reason"), F.lit("system").alias("analyst"), (F.lit(tx.T0) + F.col("day").cast("long") * (DAY // SQUEEZE)).cast("long").alias("confirmed_us"))


def current_labels(spark, d):
    new = labels.labels(confirmations(spark, d))
    return labels.upsert(new.limit(0), new)


def q_labels(spark, d):
    return current_labels(spark, d).select("kind", "key", "component_id", "confirmed_us", "expires_us", "member_count")


def known(spark, d):
    rows = feats(spark, d).withColumn("component_id", F.col("account_id"))
    return rules.score(labels.known(rows, current_labels(spark, d)), known=F.col("known"))


def q_known_fraud_override(spark, d):
    return known(spark, d).select("transaction_id", "known", "composite_score")


def found(spark, d):
    return al.alerts(known(spark, d)).select("transaction_id", "account_id", "ts_us", "composite_score", "severity", "recommended_action", "component_size", F.concat_ws(",", "triggered").alias("triggered"))


def q_alerts(spark, d):
    return found(spark, d)


def q_alerts_rate_limited(spark, d):
    return al.rate_limited(found(spark, d))


def q_account_stats(spark, d):
    return fs.account_stats(tx.transactions(spark, d), AS_OF)


def q_merchant_stats(spark, d):
    return fs.merchant_stats(tx.transactions(spark, d), AS_OF)


def q_device_stats(spark, d):
    return fs.device_stats(tx.transactions(spark, d), AS_OF)


def q_ip_stats(spark, d):
    return fs.ip_stats(tx.transactions(spark, d), AS_OF)


def view(spark, d):
    """A view with many rows a key: the first transaction of each account and day."""
    t = tx.transactions(spark, d)
    return t.groupBy("account_id", F.floor(F.col("ts_us") / DAY).alias("day")).agg(F.min("ts_us").alias("event_us"), F.max("amount_cents").alias("max_cents")).drop("day")


def q_point_in_time_features(spark, d):
    rows = tx.transactions(spark, d).select("transaction_id", "account_id", "ts_us")
    return fs.point_in_time(rows, view(spark, d).withColumn("event_us", F.col("event_us") + HOUR), "account_id", 2)


def q_latest_features(spark, d):
    return fs.latest(view(spark, d), "account_id")


def q_feature_service(spark, d):
    t = tx.transactions(spark, d)
    rows = t.where(F.col("ts_us") > AS_OF).select("transaction_id", "account_id", "merchant_id", "device_id", "ip_address")
    views = {"account_txn_stats": fs.account_stats(t, AS_OF), "merchant_stats": fs.merchant_stats(t, AS_OF), "device_stats": fs.device_stats(t, AS_OF)}
    return fs.service(rows, "fraud_detection_v2", views).select("transaction_id", "txn_velocity_24h", "unique_merchants_30d", "chargeback_ratio_90d", "linked_accounts_count")


def q_enriched_scores(spark, d):
    t = tx.transactions(spark, d)
    rows = t.where(F.col("ts_us") > AS_OF)
    return rules.score(fs.enrich(rows, fs.account_stats(t, AS_OF))).select("transaction_id", "amount_zscore", "composite_score")


def q_alert_metrics(spark, d):
    return metrics.alerts_by_severity(found(spark, d))


def q_rule_trigger_counts(spark, d):
    return metrics.rule_triggers(known(spark, d))


def q_score_percentiles(spark, d):
    return metrics.score_percentiles(known(spark, d), exact=True)


def q_component_size_pctl(spark, d):
    return metrics.component_sizes(snaps(spark, d))


def q_generator_mix(spark, d):
    return generator.pattern_counts(generator.traffic(spark, 5000, group("GENERATOR")))


def q_generator_rings(spark, d):
    g = group("GENERATOR")
    t = generator.fraudulent(spark, 1, g)
    return t.groupBy("ring_id", "pattern").agg(F.countDistinct("account_id").alias("members"), F.countDistinct("device_id").alias("devices"), F.max("amount_cents").alias("max_cents"))


def q_stream_dedup(spark, d):
    e = ed.entity_edges(tx.adapter(st.events_stream(spark, d)).where(tx.valid()).drop("amount_raw")).select("edge_key", "ts_us", "transaction_id")
    return st.run_to_table(st.deduplicated(e), "dedup")


def q_stream_features(spark, d):
    t = tx.adapter(st.events_stream(spark, d), SQUEEZE).where(tx.valid()).drop("amount_raw")
    return st.run_to_table(st.features(t), "features")


def q_stream_alerts(spark, d):
    t = tx.adapter(st.events_stream(spark, d), SQUEEZE).where(tx.valid()).drop("amount_raw")
    return st.run_to_table(st.alert_stream(t, cut(current_labels(spark, d), "labels")), "alerts").select("transaction_id", "account_id", "ts_us", "composite_score", "severity")


def stream_snapshots(spark, d):
    t = tx.adapter(st.events_stream(spark, d)).where(tx.valid()).drop("amount_raw")
    return st.run_to_table(st.component_stream(t), "components")


def q_stream_components(spark, d):
    """The last snapshot of each component that is left, named by its smallest member."""
    s = st.heartbeat(stream_snapshots(spark, d), 2)
    return s.select(F.element_at("member_ids", 1).alias("component_id"), "size", F.concat_ws(",", "member_ids").alias("members"))


def q_stream_merges(spark, d):
    return stream_snapshots(spark, d).agg(F.count("*").alias("n_merges"), F.countDistinct("absorbed").alias("n_absorbed"))


def q_stream_enriched(spark, d):
    t = tx.adapter(st.events_stream(spark, d)).where(tx.valid()).drop("amount_raw").where(F.col("ts_us") > AS_OF)
    stats = cut(fs.account_stats(tx.transactions(spark, d), AS_OF), "stats")
    return st.run_to_table(rules.score(fs.enrich(t, stats)).select("transaction_id", "amount_zscore", "composite_score"), "enriched")


QUERIES = {k: v for k, v in globals().items() if k.startswith("q_")}

# --- DuckDB twins -----------------------------------------------------------------


def _txn(squeeze: int = 1) -> str:
    us = f"{tx.T0} + (epoch_us(ts) - {tx.T0}) // {squeeze}" if squeeze > 1 else "epoch_us(ts)"
    return f"""
e AS (SELECT event_id, user_id, event_type, value, regexp_extract(props, '([0-9]+)', 1)::INT AS k, ({us})::BIGINT AS us,
  ((user_id // 54) * 5 + CASE WHEN user_id % 54 < 2 THEN 0 WHEN user_id % 54 < 5 THEN 1 WHEN user_id % 54 < 11 THEN 2 WHEN user_id % 54 < 25 THEN 3 ELSE 4 END)::BIGINT AS block FROM events),
raw AS (SELECT 'txn_' || event_id AS transaction_id, us AS ts_us, 'acct_' || user_id AS account_id, 'merch_' || block || '_' || (k % 5) AS merchant_id, value AS amount_raw,
  floor(value * 100 + 0.5)::BIGINT AS amount_cents, CASE event_type WHEN 'purchase' THEN 'approved' WHEN 'error' THEN 'declined' WHEN 'logout' THEN 'reversed' ELSE 'pending' END AS status,
  CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'dev_' || block END AS device_id, CASE WHEN k % 4 <> 0 THEN '10.0.' || block || '.' || (k % 3) END AS ip_address,
  CASE WHEN k % 2 = 0 THEN CASE WHEN length(user_id::VARCHAR) > 4 THEN (user_id::VARCHAR)[1:4] ELSE lpad(user_id::VARCHAR, 4, '0') END END AS card_last4,
  CASE WHEN k < 70 THEN 'US' WHEN k < 80 THEN NULL WHEN k < 90 THEN 'CA' ELSE 'gb' END AS country_code, (5400 + k % 7)::VARCHAR AS mcc FROM e),
txn AS (SELECT * EXCLUDE (amount_raw) FROM raw WHERE amount_raw > 0)"""


_R4 = "floor(({}) * 10000 + 0.5) / 10000"
_EDGES = """
edge AS (SELECT transaction_id, ts_us, account_id AS source_id, 'account' AS source_type, merchant_id AS target_id, 'merchant' AS target_type, 'transacted_at' AS relationship, amount_cents / 100 AS weight FROM txn
UNION ALL SELECT transaction_id, ts_us, account_id, 'account', device_id, 'device', 'used_device', 1.0 FROM txn WHERE device_id <> ''
UNION ALL SELECT transaction_id, ts_us, account_id, 'account', 'ip:' || ip_address, 'ip_address', 'used_ip', 1.0 FROM txn WHERE ip_address <> ''
UNION ALL SELECT transaction_id, ts_us, account_id, 'account', 'card:' || card_last4, 'card', 'linked_card', 1.0 FROM txn WHERE card_last4 <> ''),
keyed AS (SELECT *, least(source_id, target_id) || '|' || greatest(source_id, target_id) || '|' || relationship AS edge_key FROM edge)"""
_CC = """
pair AS (SELECT DISTINCT source_id AS a, target_id AS b FROM edge UNION SELECT DISTINCT target_id, source_id FROM edge),
walk AS (SELECT a AS node, a AS reached FROM pair UNION SELECT w.node, p.b FROM walk w JOIN pair p ON w.reached = p.a),
node AS (SELECT node, min(reached) AS component FROM walk GROUP BY node)"""
_SNAP = """
kind AS (SELECT source_id AS node, source_type AS type FROM edge UNION SELECT target_id, target_type FROM edge),
snap AS (SELECT component AS component_id, count(DISTINCT node) AS size, string_agg(DISTINCT type, ',' ORDER BY type) AS entity_types, list_sort(list(DISTINCT node)) AS member_ids FROM kind JOIN node USING (node) GROUP BY 1),
part AS (SELECT component AS component_id, count(*) AS edge_count, min(ts_us) AS first_us, max(ts_us) AS last_us, list_sort(list(DISTINCT transaction_id)) AS transaction_ids FROM k JOIN node ON source_id = node WHERE kept GROUP BY 1),
snaps AS (SELECT * FROM snap JOIN part USING (component_id))"""
_FEAT = f"""
flag AS (SELECT *, amount_cents < 100 AS is_micro, ((ts_us // {HOUR}) % 24 >= 23 OR (ts_us // {HOUR}) % 24 < 5) AS is_night, upper(coalesce(nullif(country_code, ''), 'US')) <> 'US' AS is_cross FROM txn),
win AS (SELECT *, count(*) OVER h AS v1, count(*) OVER d AS v24, sum(is_micro::INT) OVER h AS micro, sum(is_night::INT) OVER d AS night, sum(is_cross::INT) OVER d AS crossb,
  count(*) OVER p AS n, sum(amount_cents) OVER p AS s, sum(amount_cents::HUGEINT * amount_cents) OVER p AS q FROM flag
  WINDOW h AS (PARTITION BY account_id ORDER BY ts_us RANGE BETWEEN {HOUR} PRECEDING AND CURRENT ROW), d AS (PARTITION BY account_id ORDER BY ts_us RANGE BETWEEN {DAY} PRECEDING AND CURRENT ROW),
  p AS (PARTITION BY account_id ORDER BY ts_us, transaction_id ROWS UNBOUNDED PRECEDING)),
spread AS (SELECT *, sqrt((n::HUGEINT * q)::DOUBLE - (s::HUGEINT * s::HUGEINT)::DOUBLE) AS sp FROM win),
uniq AS (SELECT a.transaction_id, count(DISTINCT nullif(b.device_id, '')) AS devices, count(DISTINCT nullif(b.ip_address, '')) AS ips FROM txn a JOIN txn b ON a.account_id = b.account_id AND b.ts_us BETWEEN a.ts_us - {HOUR} AND a.ts_us GROUP BY 1),
feat AS (SELECT transaction_id, account_id, ts_us, amount_cents, v1 AS txn_velocity_1h, v24 AS txn_velocity_24h, {_R4.format("s::DOUBLE / n / 100")} AS amount_mean_30d,
  {_R4.format("CASE WHEN n > 1 THEN sp / n / 100 ELSE 0 END")} AS amount_stddev_30d, {_R4.format("CASE WHEN n > 1 AND sp > 0 THEN (amount_cents::DOUBLE * n - s::DOUBLE) / sp ELSE 0 END")} AS amount_zscore,
  0::BIGINT AS unique_merchants_30d, devices AS unique_devices_30d, ips AS unique_ips_30d, {_R4.format("crossb::DOUBLE / greatest(v24, 1)")} AS cross_border_ratio,
  {_R4.format("night::DOUBLE / greatest(v24, 1)")} AS night_txn_ratio, {_R4.format("micro::DOUBLE / greatest(v1, 1)")} AS card_testing_score, 0::DOUBLE AS mule_account_score FROM spread JOIN uniq USING (transaction_id))"""


def _tiers(value: str, rule: str) -> str:
    return "CASE " + " ".join(f"WHEN {value} >= {a} THEN {b}::DOUBLE" for a, b in rules.TIERS[rule]) + " ELSE 0::DOUBLE END"


def _rules(size: str = "0", frm: str = "feat") -> str:
    raw = {
        "R01_large_component": _tiers(size, "R01_large_component"), "R02_high_velocity": _tiers("txn_velocity_1h", "R02_high_velocity"), "R03_amount_anomaly": _tiers("abs(amount_zscore)", "R03_amount_anomaly"),
        "R04_card_testing": "least(card_testing_score, 1::DOUBLE)", "R05_cross_border": _tiers("cross_border_ratio", "R05_cross_border"), "R06_night_activity": _tiers("night_txn_ratio", "R06_night_activity"),
        "R07_device_sharing": _tiers("unique_devices_30d", "R07_device_sharing"), "R08_new_account_burst": "least(txn_velocity_24h / 100 * 0.5::DOUBLE + mule_account_score * 0.5::DOUBLE, 1::DOUBLE)",
    }
    cols = ", ".join(f"{v} AS {k}" for k, v in raw.items())
    total = "0::DOUBLE + " + " + ".join(f"{k} * {w}::DOUBLE" for k, w in rules.WEIGHTS.items())
    fired = ", ".join(f"CASE WHEN {k} {'>= 0.5' if k in ('R04_card_testing', 'R08_new_account_burst') else '> 0'} THEN '{k}' END" for k in raw)
    return f"rule AS (SELECT *, {cols} FROM {frm}),\nscore AS (SELECT *, {_R4.format(f'least({total}, 1::DOUBLE)')} AS composite, [x FOR x IN [{fired}] IF x IS NOT NULL] AS fired FROM rule)"


_FAST = "WITH " + _txn(SQUEEZE) + "," + _FEAT
_SLOW = "WITH " + _txn()
_LABEL = f"""
conf AS (SELECT DISTINCT user_id, d.day FROM events, (VALUES (5), (6)) d(day) WHERE user_id % 9 = 0 AND (d.day = 5 OR user_id % 18 = 0)),
lab AS (SELECT kind, CASE kind WHEN 'component' THEN 'comp_' ELSE 'acct_' END || user_id AS key, 'comp_' || user_id AS component_id, ({tx.T0} + max(day)::BIGINT * {DAY // SQUEEZE})::BIGINT AS confirmed_us FROM conf, (VALUES ('component'), ('entity')) k(kind) GROUP BY kind, user_id)"""
_KNOWN = f"""{_FAST},{_rules()},{_LABEL},
known AS (SELECT s.*, (l.key IS NOT NULL) AS known, CASE WHEN l.key IS NOT NULL THEN 1::DOUBLE ELSE composite END AS composite_score,
  CASE WHEN l.key IS NOT NULL THEN list_append(fired, '{rules.KNOWN}') ELSE fired END AS triggered FROM score s LEFT JOIN lab l ON kind = 'entity' AND key = account_id AND ts_us >= confirmed_us AND ts_us < confirmed_us + {labels.VALID_US}),
alert AS (SELECT transaction_id, account_id, ts_us, composite_score, CASE WHEN composite_score >= 0.9 THEN 'critical' WHEN composite_score >= 0.75 THEN 'high' WHEN composite_score >= 0.5 THEN 'medium' ELSE 'low' END AS severity,
  CASE WHEN composite_score >= 0.9 THEN 'block_and_review' WHEN composite_score >= 0.75 THEN 'step_up_auth' WHEN composite_score >= 0.5 THEN 'flag_for_review' ELSE 'monitor' END AS recommended_action,
  1::BIGINT AS component_size, array_to_string(triggered, ',') AS triggered FROM known WHERE composite_score >= 0.35)"""


def _greedy(source: str, key: str, gap: int, op: str) -> str:
    return f"""o AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ts_us, transaction_id) AS i FROM {source}),
k AS (SELECT *, ts_us AS held, true AS kept FROM o WHERE i = 1 UNION ALL SELECT o.*, CASE WHEN o.ts_us - k.held {op} {gap} THEN o.ts_us ELSE k.held END, o.ts_us - k.held {op} {gap} FROM k JOIN o ON o.{key} = k.{key} AND o.i = k.i + 1)"""


_PLAIN = _SLOW.replace("WITH", "WITH RECURSIVE", 1) + "," + _EDGES + "," + _CC
_GRAPH = _PLAIN + "," + _greedy("keyed", "edge_key", DAY, ">") + "," + _SNAP
_MONTH, _WEEK, _DAY1 = (f"ts_us > {AS_OF - n * DAY}" for n in (30, 7, 1))
_SPREAD = "sqrt((n::HUGEINT * q)::DOUBLE - (s::HUGEINT * s::HUGEINT)::DOUBLE)"
_ACCOUNT = f"""acc AS (SELECT account_id, {AS_OF}::BIGINT AS event_us, count(*) FILTER (ts_us > {AS_OF - HOUR}) AS txn_velocity_1h, count(*) FILTER ({_DAY1}) AS txn_velocity_24h, count(*) FILTER ({_MONTH}) AS n, coalesce(sum(amount_cents) FILTER ({_MONTH}), 0) AS s, coalesce(sum(amount_cents::HUGEINT * amount_cents) FILTER ({_MONTH}), 0) AS q,
  count(DISTINCT nullif(merchant_id, '')) FILTER ({_MONTH}) AS unique_merchants_30d, count(DISTINCT nullif(device_id, '')) FILTER ({_MONTH}) AS unique_devices_30d, count(DISTINCT nullif(ip_address, '')) FILTER ({_MONTH}) AS unique_ips_30d,
  count(*) FILTER ({_MONTH} AND upper(coalesce(nullif(country_code, ''), 'US')) <> 'US') AS c, count(*) FILTER ({_MONTH} AND ((ts_us // {HOUR}) % 24 >= 23 OR (ts_us // {HOUR}) % 24 < 5)) AS nt, count(*) FILTER ({_WEEK} AND status = 'declined') AS de, count(*) FILTER ({_WEEK}) AS wk, min(ts_us) AS first_seen_us FROM txn WHERE ts_us <= {AS_OF} GROUP BY 1),
stats AS (SELECT account_id, event_us, txn_velocity_1h, txn_velocity_24h, {_R4.format("CASE WHEN n > 0 THEN s::DOUBLE / n / 100 ELSE 0 END")} AS amount_mean_30d, {_R4.format(f"CASE WHEN n > 1 THEN {_SPREAD} / n / 100 ELSE 0 END")} AS amount_stddev_30d, s::DOUBLE / 100 AS amount_total_30d,
  unique_merchants_30d, unique_devices_30d, unique_ips_30d, {_R4.format("c::DOUBLE / greatest(n, 1)")} AS cross_border_ratio, {_R4.format("nt::DOUBLE / greatest(n, 1)")} AS night_txn_ratio, {_R4.format("de::DOUBLE / greatest(wk, 1)")} AS declined_ratio_7d, ({AS_OF} - first_seen_us) // {DAY} AS account_age_days, first_seen_us FROM acc)"""
_MERCHANT = f"""mer AS (SELECT merchant_id, {AS_OF}::BIGINT AS event_us, count(*) FILTER ({_MONTH}) AS txn_volume_30d, count(DISTINCT account_id) FILTER ({_MONTH}) AS unique_accounts_30d, {_R4.format(f"count(*) FILTER (status = 'reversed' AND ts_us > {AS_OF - 90 * DAY})::DOUBLE / greatest(count(*) FILTER (ts_us > {AS_OF - 90 * DAY}), 1)")} AS chargeback_ratio_90d,
  {_R4.format("sum(amount_cents)::DOUBLE / count(*) / 100")} AS avg_txn_amount, arg_max(mcc, (ts_us, transaction_id)) AS mcc, NULL::VARCHAR AS risk_category FROM txn WHERE ts_us <= {AS_OF} GROUP BY 1)"""
_DEVICE = f"""dev AS (SELECT device_id, {AS_OF}::BIGINT AS event_us, count(DISTINCT account_id) AS linked_accounts_count, min(ts_us) AS first_seen_us, count(*) FILTER ({_DAY1}) AS txn_velocity_24h, count(DISTINCT upper(country_code)) FILTER ({_MONTH}) AS countries_30d, NULL::BIGINT AS emulator_flag FROM txn WHERE ts_us <= {AS_OF} AND device_id <> '' GROUP BY 1)"""
_VIEW = f"""vw AS (SELECT account_id, min(ts_us) AS event_us, max(amount_cents) AS max_cents FROM txn GROUP BY account_id, ts_us // {DAY})"""

ORACLE_SQL = {
    "q_transactions": f"{_SLOW} SELECT * FROM txn",
    "q_invalid_transactions": f"{_SLOW} SELECT transaction_id, amount_raw FROM raw WHERE NOT amount_raw > 0",
    "q_parse_json": f"{_SLOW} SELECT transaction_id, ts_us, account_id, amount_cents, status, CASE WHEN amount_raw > 0 THEN '' ELSE 'amount not above zero' END AS error FROM raw",
    "q_entity_edges": f"{_SLOW},{_EDGES} SELECT * FROM edge",
    "q_edge_keys": f"{_SLOW},{_EDGES} SELECT edge_key, count(*) AS n FROM keyed GROUP BY 1",
    "q_shards": f"{_SLOW},{_EDGES} SELECT ('0x' || md5(least(source_id, target_id))[1:8])::BIGINT % 8 AS shard, count(*) AS n FROM edge GROUP BY 1",
    "q_edge_dedup_24h": f"{_SLOW.replace('WITH', 'WITH RECURSIVE', 1)},{_EDGES},{_greedy('keyed', 'edge_key', DAY, '>')} SELECT edge_key, ts_us, transaction_id FROM k WHERE kept",
    "q_components": f"{_PLAIN} SELECT node, component FROM node",
    "q_components_large": f"SELECT min(a) AS component, count(*) AS n, sum(a)::BIGINT AS nodes FROM (SELECT i // 1000 AS c, (i * 611953) % 1000003 AS a FROM range({LARGE}) t(i)) GROUP BY c",
    "q_component_stats": f"{_GRAPH} SELECT component_id, size, edge_count, first_us, last_us, entity_types, array_to_string(member_ids[1:500], ',') AS members, array_to_string(transaction_ids[1:500], ',') AS transactions FROM snaps",
    "q_density": f"{_GRAPH} SELECT component_id, {_R4.format('CASE WHEN size <= 1 THEN 0 ELSE 2::DOUBLE * edge_count / (size * (size - 1)) END')} AS density FROM snaps",
    "q_top_components": f"{_GRAPH} SELECT component_id, size FROM snaps WHERE size >= 3 ORDER BY size DESC, component_id LIMIT 20",
    "q_component_types": f"{_PLAIN} SELECT component, string_agg(DISTINCT t, ',' ORDER BY t) AS types FROM (SELECT component, CASE WHEN node LIKE 'ip:%' THEN 'ip_address' WHEN node LIKE 'card:%' THEN 'card' WHEN length(node) = 36 THEN 'device' ELSE 'account' END AS t FROM node) GROUP BY 1",
    "q_velocity": f"{_FAST} SELECT transaction_id, txn_velocity_1h, txn_velocity_24h FROM feat",
    "q_amount_stats": f"{_FAST} SELECT transaction_id, amount_mean_30d, amount_stddev_30d, amount_zscore FROM feat",
    "q_ratios": f"{_FAST} SELECT transaction_id, card_testing_score, night_txn_ratio, cross_border_ratio FROM feat",
    "q_unique_devices_ips": f"{_FAST} SELECT transaction_id, unique_devices_30d, unique_ips_30d FROM feat",
    "q_accounts_per_device": f"{_SLOW} SELECT device_id, count(DISTINCT account_id) AS accounts FROM txn WHERE device_id <> '' GROUP BY 1",
    "q_rule_contributions": f"{_FAST},{_rules()} SELECT transaction_id, r.rule, r.contribution FROM score, unnest([" + ", ".join(f"{{'rule': '{k}', 'contribution': {_R4.format(f'{k} * {w}::DOUBLE')}}}" for k, w in rules.WEIGHTS.items()) + "]) u(r)",
    "q_rule_triggers": f"{_FAST},{_rules()} SELECT transaction_id, array_to_string(fired, ',') AS triggered FROM score",
    "q_risk_score": f"{_FAST},{_rules()} SELECT transaction_id, account_id, composite AS composite_score FROM score",
    "q_score_with_component": f"{_FAST.replace('WITH', 'WITH RECURSIVE', 1)},{_EDGES},{_CC},sizes AS (SELECT component AS component_id, count(*) AS component_size FROM node GROUP BY 1),fc AS (SELECT feat.*, component_id, component_size FROM feat JOIN node ON node = account_id JOIN sizes ON component_id = component),{_rules('component_size', 'fc')} SELECT transaction_id, component_id, component_size, composite AS composite_score FROM score",
    "q_labels": f"WITH {_LABEL} SELECT kind, key, component_id, confirmed_us, confirmed_us + {labels.VALID_US} AS expires_us, 1 AS member_count FROM lab",
    "q_known_fraud_override": f"{_KNOWN} SELECT transaction_id, known, composite_score FROM known",
    "q_alerts": f"{_KNOWN} SELECT * FROM alert",
    "q_alerts_rate_limited": f"{_KNOWN.replace('WITH', 'WITH RECURSIVE', 1)},high AS (SELECT * FROM alert WHERE composite_score >= 0.75),{_greedy('high', 'account_id', 600_000_000, '>=')} SELECT * FROM alert WHERE composite_score < 0.75 UNION ALL SELECT transaction_id, account_id, ts_us, composite_score, severity, recommended_action, component_size, triggered FROM k WHERE kept",
    "q_account_stats": f"{_SLOW},{_ACCOUNT} SELECT * FROM stats",
    "q_merchant_stats": f"{_SLOW},{_MERCHANT} SELECT * FROM mer",
    "q_device_stats": f"{_SLOW},{_DEVICE} SELECT * FROM dev",
    "q_ip_stats": f"{_SLOW} SELECT ip_address, {AS_OF}::BIGINT AS event_us, count(DISTINCT account_id) AS linked_accounts_count, NULL::BIGINT AS is_vpn, NULL::BIGINT AS is_tor, NULL::BIGINT AS is_datacenter, arg_max(country_code, (ts_us, transaction_id)) FILTER (country_code IS NOT NULL) AS country_code, NULL::DOUBLE AS abuse_score FROM txn WHERE ts_us <= {AS_OF} AND ip_address <> '' GROUP BY 1",
    "q_point_in_time_features": f"{_SLOW},{_VIEW} SELECT t.transaction_id, t.account_id, t.ts_us, CASE WHEN v.event_us > t.ts_us - {2 * DAY} THEN v.event_us END AS event_us, CASE WHEN v.event_us > t.ts_us - {2 * DAY} THEN v.max_cents END AS max_cents FROM txn t ASOF LEFT JOIN (SELECT account_id, event_us + {HOUR} AS event_us, max_cents FROM vw) v ON t.account_id = v.account_id AND t.ts_us >= v.event_us",
    "q_latest_features": f"{_SLOW},{_VIEW} SELECT account_id, max(event_us) AS event_us, arg_max(max_cents, event_us) AS max_cents FROM vw GROUP BY 1",
    "q_feature_service": f"{_SLOW},{_ACCOUNT},{_MERCHANT},{_DEVICE} SELECT transaction_id, coalesce(s.txn_velocity_24h, 0) AS txn_velocity_24h, coalesce(unique_merchants_30d, 0) AS unique_merchants_30d, coalesce(chargeback_ratio_90d, 0) AS chargeback_ratio_90d, coalesce(linked_accounts_count, 0) AS linked_accounts_count FROM txn LEFT JOIN stats s USING (account_id) LEFT JOIN mer USING (merchant_id) LEFT JOIN dev USING (device_id) WHERE ts_us > {AS_OF}",
    "q_enriched_scores": f"{_SLOW},{_ACCOUNT},en AS (SELECT transaction_id, coalesce(s.txn_velocity_1h, 0) AS txn_velocity_1h, coalesce(s.txn_velocity_24h, 0) AS txn_velocity_24h, {_R4.format('CASE WHEN coalesce(amount_stddev_30d, 0) > 0 THEN (amount_cents / 100 - amount_mean_30d) / amount_stddev_30d ELSE 0 END')} AS amount_zscore, coalesce(unique_devices_30d, 0) AS unique_devices_30d, coalesce(cross_border_ratio, 0) AS cross_border_ratio, coalesce(night_txn_ratio, 0) AS night_txn_ratio, 0::DOUBLE AS card_testing_score, 0::DOUBLE AS mule_account_score FROM txn LEFT JOIN stats s USING (account_id) WHERE ts_us > {AS_OF}),{_rules(frm='en')} SELECT transaction_id, amount_zscore, composite AS composite_score FROM score",
    "q_alert_metrics": f"{_KNOWN} SELECT severity, count(*) AS n_alerts FROM alert GROUP BY 1",
    "q_rule_trigger_counts": f"{_KNOWN} SELECT rule, count(*) AS n_triggers FROM (SELECT unnest(triggered) AS rule FROM known) GROUP BY 1",
    "q_score_percentiles": f"{_KNOWN} SELECT quantile_cont(composite_score, 0.5) AS p50, quantile_cont(composite_score, 0.95) AS p95, quantile_cont(composite_score, 0.99) AS p99 FROM known",
    "q_component_size_pctl": f"{_GRAPH} SELECT count(*) AS n_components, sum(size)::BIGINT AS n_entities, max(size) AS max_size, quantile_cont(size, 0.5)::DOUBLE AS p50, quantile_cont(size, 0.95)::DOUBLE AS p95 FROM snaps",
    "q_stream_merges": f"{_PLAIN} SELECT (count(*) - count(DISTINCT component))::BIGINT AS n_merges, (count(*) - count(DISTINCT component))::BIGINT AS n_absorbed FROM node",
    "q_stream_components": f"{_GRAPH} SELECT component_id, size, array_to_string(member_ids[1:500], ',') AS members FROM snaps",
}
ORACLE_SQL["q_stream_dedup"] = ORACLE_SQL["q_edge_dedup_24h"]
ORACLE_SQL["q_stream_features"] = f"{_FAST} SELECT * FROM feat"
ORACLE_SQL["q_stream_alerts"] = f"SELECT transaction_id, account_id, ts_us, composite_score, severity FROM ({ORACLE_SQL['q_alerts_rate_limited']})"
ORACLE_SQL["q_stream_enriched"] = ORACLE_SQL["q_enriched_scores"]
