"""Behaviour of the engine's operators on small rows."""

from __future__ import annotations

import itertools
import json
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ringfold.functions.numbers import DAY, HOUR
from ringfold import cli
from ringfold.functions import settings
from ringfold.operators import alerts, components, edges, feature_store, features, gaps, generator, labels, metrics, rules
from ringfold.plans.shared import published
from ringfold.sources import transactions as tx
from ringfold.streaming import pipelines, processors

T0 = tx.T0
TXN = "transaction_id string, ts_us long, account_id string, merchant_id string, amount_cents long, status string, device_id string, ip_address string, card_last4 string, country_code string, mcc string"


def txn(i, us, account="a", merchant="m", cents=1000, status="approved", device=None, ip=None, card=None, country=None, mcc=None):
    return (f"t{i}", us, account, merchant, cents, status, device, ip, card, country, mcc)


def frame(spark, rows):
    return spark.createDataFrame(rows, TXN)


def test_weights_sum_to_one():
    assert sum(rules.WEIGHTS.values()) == pytest.approx(1)


def test_minimal_transaction_has_one_edge(spark):
    assert edges.entity_edges(frame(spark, [txn(1, T0)])).count() == 1


def test_full_transaction_has_four_edges_and_prefixes(spark):
    e = edges.entity_edges(frame(spark, [txn(1, T0, device="d", ip="10.0.0.1", card="1234")])).collect()
    assert {x.target_id for x in e} == {"m", "d", "ip:10.0.0.1", "card:1234"}
    assert next(x for x in e if x.target_id == "m").weight == 10.0


def test_empty_device_gives_no_edge(spark):
    assert edges.entity_edges(frame(spark, [txn(1, T0, device="")])).count() == 1


def test_canonical_key_is_symmetric(spark):
    d = spark.createDataFrame([("a", "b"), ("b", "a")], "x string, y string").select(edges.canonical_key(F.col("x"), F.col("y"), F.lit("r")).alias("k"), edges.shard(F.col("x"), F.col("y"), 8).alias("s")).distinct()
    assert d.count() == 1


@pytest.mark.parametrize(("n", "e", "want"), [(1, 0, 0.0), (4, 6, 1.0), (5, 4, 0.4)])
def test_density(spark, n, e, want):
    assert spark.range(1).select(edges.density(F.lit(e), F.lit(n)).alias("d")).first().d == pytest.approx(want)


def parsed(spark, *lines):
    return tx.parse(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_parse_rounds_and_quarantines(spark):
    ok = {"transaction_id": "1", "account_id": "a", "merchant_id": "m", "amount_usd": 10.1234567}
    lines = [json.dumps(ok), json.dumps(ok | {"amount_usd": -1}), "{no json", json.dumps(ok | {"currency": "EURO"}), json.dumps({"account_id": "a"}), json.dumps(ok | {"status": "odd"}), json.dumps(ok | {"amount_usd": 0.001})]
    p = parsed(spark, *lines)
    good = tx.good(p).collect()
    assert [r.amount_usd for r in good] == [10.12, 0.0]
    assert good[0].currency == "USD" and good[0].status == "pending"
    assert tx.bad(p).count() == 5


def test_confirmation_defaults(spark):
    lines = spark.createDataFrame([('{"component_id": "c"}',), ("{bad",)], "value string")
    good, bad = tx.parse_confirmations(lines).orderBy("raw").collect()
    assert good.component_id == "c" and good.member_ids == [] and good.analyst == "system"
    assert bad.component_id is None and bad.raw == "{bad"


def brute_components(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("pairs", [[("a", "a")], [("a", "b"), ("b", "c"), ("x", "y")], [(f"n{i:04}", f"n{i + 1:04}") for i in range(150)], [("a", "b"), ("b", "a"), ("c", "c")]])
@pytest.mark.parametrize("per_task", [7, components.PER_TASK])
def test_components(spark, pairs, per_task):
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(pairs, "a string, b string").repartition(5), per_task=per_task).collect()}
    assert got == brute_components(pairs)


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    pairs = [(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") + str(g), rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") + str(g)) for g in range(20) for _ in range(rng.randint(1, 20))]
    for per_task in (40, components.PER_TASK):
        got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(pairs, "a string, b string").repartition(5), per_task=per_task).collect()}
        assert got == brute_components(pairs)


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def greedy(times, gap, inclusive):
    out, last = [], None
    for t in sorted(times):
        if last is None or (t - last >= gap if inclusive else t - last > gap):
            out.append(t)
            last = t
    return out


@pytest.mark.parametrize("inclusive", [True, False])
def test_gap_filter_boundaries_batch_and_state(spark, inclusive):
    rng = random.Random(3)
    times = {"k": [0, DAY - 1000, DAY, DAY + 1000, 2 * DAY + 1000, 5 * DAY], "r": sorted(rng.sample(range(10 * DAY), 60))}
    rows = spark.createDataFrame([(k, t, f"{k}{i:03}") for k, ts in times.items() for i, t in enumerate(ts)], "key string, ts_us long, id string")
    want = sorted((k, t) for k, ts in times.items() for t in greedy(ts, DAY, inclusive))
    assert sorted((r.key, r.ts_us) for r in gaps.keep_after_gap(rows, "key", "ts_us", "id", DAY, inclusive).collect()) == want
    state = pipelines.keyed(rows, "key", pipelines.gap_filter(DAY, "id", inclusive), rows.schema)
    assert sorted((r.key, r.ts_us) for r in state.collect()) == want


def test_velocity_window_edges(spark):
    rows = [txn(0, T0), txn(1, T0 + HOUR), txn(2, T0 + HOUR + 1), txn(3, T0 + DAY)]
    got = {r.transaction_id: (r.txn_velocity_1h, r.txn_velocity_24h) for r in features.account_features(frame(spark, rows)).collect()}
    assert got == {"t0": (1, 1), "t1": (2, 2), "t2": (2, 3), "t3": (1, 4)}


def test_ratios_and_distinct_devices(spark):
    rows = [txn(0, T0 + 12 * HOUR, cents=50, device="a", country="US"), txn(1, T0 + 12 * HOUR + 1, cents=99, device="b", country="gb"), txn(2, T0 + 12 * HOUR + 2, cents=100, device="a", country=""), txn(3, T0 + 12 * HOUR + 3, cents=100, device="")]
    last = {r.transaction_id: r for r in features.account_features(frame(spark, rows)).collect()}["t3"]
    assert (last.card_testing_score, last.cross_border_ratio, last.unique_devices_30d, last.night_txn_ratio) == (0.5, 0.25, 2, 0.0)


def test_stateful_features_equal_batch(spark):
    rng = random.Random(1)
    rows = [txn(i, T0 + rng.randrange(3 * DAY), rng.choice("ab"), cents=rng.randrange(1, 90000), device=rng.choice(["x", "y", "", None]), ip=rng.choice(["1", None]), country=rng.choice(["US", "gb", None])) for i in range(80)]
    want = sorted(map(tuple, features.account_features(frame(spark, rows)).collect()))
    assert sorted(map(tuple, pipelines.features(frame(spark, rows)).collect())) == want


def scored(spark, size=None, known=False, **values):
    base = dict.fromkeys(features.FEATURES, 0.0) | values
    d = spark.createDataFrame([("t", *map(float, base.values()))], "transaction_id string, " + ", ".join(f"{k} double" for k in base))
    return rules.score(d, F.lit(size).cast("long"), F.lit(known)).first()


@pytest.mark.parametrize(
    ("values", "size", "rule"),
    [({}, 35, "R01_large_component"), ({"txn_velocity_1h": 60}, None, "R02_high_velocity"), ({"amount_zscore": 6}, None, "R03_amount_anomaly"), ({"amount_zscore": -6}, None, "R03_amount_anomaly"), ({"card_testing_score": 0.95}, None, "R04_card_testing"), ({"unique_devices_30d": 12}, None, "R07_device_sharing"), ({"txn_velocity_24h": 100}, None, "R08_new_account_burst")],
)
def test_rule_fires(spark, values, size, rule):
    r = scored(spark, size, **values)
    assert rule in r.triggered
    assert sum(r.contributions.values()) == pytest.approx(r.composite_score, abs=1e-3)


def test_no_features_no_score(spark):
    r = scored(spark)
    assert r.composite_score == 0 and r.triggered == []


def test_score_is_capped_and_monotone(spark):
    top = scored(spark, 50, txn_velocity_1h=99, amount_zscore=9, card_testing_score=1, cross_border_ratio=1, night_txn_ratio=1, unique_devices_30d=99, txn_velocity_24h=999, mule_account_score=1)
    assert top.composite_score <= 1
    by_size = [scored(spark, n).composite_score for n in (0, 4, 7, 15, 30)]
    assert by_size == sorted(by_size)


def test_known_network_overrides(spark):
    r = scored(spark, known=True)
    assert r.composite_score == 1 and r.triggered == [rules.KNOWN] and r.contributions[rules.KNOWN] == 1


@pytest.mark.parametrize(("score", "level", "act"), [(0.95, "critical", "block_and_review"), (0.9, "critical", "block_and_review"), (0.75, "high", "step_up_auth"), (0.5, "medium", "flag_for_review"), (0.35, "low", "monitor"), (0.3499, None, None)])
def test_alert_tiers(spark, score, level, act):
    d = spark.createDataFrame([("t", "a", T0, score)], "transaction_id string, account_id string, ts_us long, composite_score double")
    got = alerts.alerts(d).collect()
    assert [(r.severity, r.recommended_action, r.component_size) for r in got] == ([(level, act, 1)] if level else [])


def test_rate_limit(spark):
    m = 60_000_000
    rows = [("a", 0, 0.8), ("b", 10 * m - 1000, 0.8), ("c", 10 * m, 0.9), ("d", 10 * m + 1, 0.4), ("e", 10 * m + 2, 0.4)]
    d = spark.createDataFrame([(i, "acct", t, s) for i, t, s in rows], "transaction_id string, account_id string, ts_us long, composite_score double")
    assert sorted(r.transaction_id for r in alerts.rate_limited(d).collect()) == ["a", "c", "d", "e"]


def test_labels_are_written_renewed_and_expire(spark):
    c = spark.createDataFrame([("c1", ["a", "b"], "r", "me", T0), ("c1", ["a"], "r", "me", T0 + DAY), (None, ["x"], "r", "me", T0)], "component_id string, member_ids array<string>, reason string, analyst string, confirmed_us long")
    new = labels.labels(c)
    assert new.count() == 5
    now = labels.upsert(new.limit(0), new)
    assert {(r.kind, r.key): r.confirmed_us for r in now.collect()} == {("component", "c1"): T0 + DAY, ("entity", "a"): T0 + DAY, ("entity", "b"): T0}
    rows = spark.createDataFrame([("1", "a", "z", T0 + DAY), ("2", "a", "z", T0 + DAY - 1), ("3", "a", "z", T0 + 91 * DAY), ("4", "q", "c1", T0 + 2 * DAY), ("5", "q", "z", T0 + 2 * DAY)], "transaction_id string, account_id string, component_id string, ts_us long")
    assert {r.transaction_id for r in labels.known(rows, now).collect() if r.known} == {"1", "4"}


def test_point_in_time_takes_the_last_fresh_row(spark):
    view = spark.createDataFrame([("a", T0, 1), ("a", T0 + DAY, 2)], "account_id string, event_us long, v int")
    rows = spark.createDataFrame([("1", "a", T0 - 1), ("2", "a", T0), ("3", "a", T0 + DAY), ("4", "a", T0 + 9 * DAY), ("5", "b", T0)], "id string, account_id string, ts_us long")
    assert {r.id: r.v for r in feature_store.point_in_time(rows, view, "account_id", 2).collect()} == {"1": None, "2": 1, "3": 2, "4": None, "5": None}


def test_materialise_keeps_the_newest(spark, tmp_path):
    path = f"file://{tmp_path}/view"
    first = spark.createDataFrame([("a", 1, 1), ("b", 5, 2)], "account_id string, event_us long, v int")
    feature_store.materialise(first, "account_id", path)
    feature_store.materialise(spark.createDataFrame([("a", 2, 9), ("b", 4, 8)], first.schema), "account_id", path)
    assert {r.account_id: r.v for r in published(spark, path, first.schema).collect()} == {"a": 9, "b": 2}


def test_generator_is_deterministic_and_rings_keep_their_shape(spark):
    g = settings.group("GENERATOR", num_legitimate_accounts=500, num_merchants=50, num_fraud_rings=8)
    a, b = (sorted(map(str, generator.traffic(spark, 400, g).collect())) for _ in range(2))
    assert a == b and len(a) == 400
    r = generator.fraudulent(spark, 1, g)
    assert r.where("pattern = 'dense' AND amount_cents > 500").count() == 0
    known = {x.id for x in generator.pool(spark, g)["accounts"].collect()}
    assert {x.account_id for x in r.collect()} <= known
    e = edges.entity_edges(r)
    parts = {x.node: x.component for x in components.connected_components(e, "source_id", "target_id").collect()}
    assert all(len({parts[x.account_id] for x in group}) == 1 for _, group in itertools.groupby(sorted(r.collect(), key=lambda x: x.ring_id), key=lambda x: x.ring_id))


def test_resolver_emits_nodes_minus_components(spark):
    rng = random.Random(2)
    rows = [txn(i, T0 + i, f"a{rng.randrange(12)}", f"m{rng.randrange(12)}", device=rng.choice(["d1", "d2", None])) for i in range(40)]
    n = pipelines.component_stream(frame(spark, rows)).count()
    parts = components.connected_components(edges.entity_edges(frame(spark, rows)), "source_id", "target_id")
    assert n == parts.count() - parts.select("component").distinct().count()


def test_label_writer(spark, tmp_path):
    lines = spark.createDataFrame([('{"component_id": "c", "member_ids": ["a"]}',), ("{bad",)], "value string")
    write = pipelines.label_writer(f"file://{tmp_path}", f"file://{tmp_path}/audit")
    for k in range(2):
        write(tx.parse_confirmations(lines), k)
    assert published(spark, f"file://{tmp_path}/labels", pipelines.LABEL_SCHEMA).count() == 2
    assert spark.read.text(f"file://{tmp_path}/audit").count() == 4


def test_settings_come_from_environment_file_and_defaults(monkeypatch, tmp_path):
    monkeypatch.chdir(tmp_path)
    (tmp_path / ".env").write_text("# own values\nALERT_SCORE_THRESHOLD_LOW=0.2\nALERT_SCORE_THRESHOLD_HIGH='0.8'\n")
    monkeypatch.setenv("ALERT_SCORE_THRESHOLD_LOW", "0.4")
    a = settings.group("ALERT")
    assert (a.score_threshold_low, a.score_threshold_high, a.score_threshold_medium, a.component_size_high) == (0.4, 0.8, 0.5, 15)
    with pytest.raises(TypeError):
        settings.group("ALERT", gap=1)


def test_alerts_read_the_settings(spark, monkeypatch):
    monkeypatch.setenv("ALERT_SCORE_THRESHOLD_LOW", "0.95")
    d = spark.createDataFrame([("t", "a", T0, 0.94)], "transaction_id string, account_id string, ts_us long, composite_score double")
    assert alerts.alerts(d).count() == 0


def json_folder(spark, path, rows):
    tx.json_sink(rows, path)
    return spark.readStream.text(path)


def test_topology_from_files_to_alerts(spark, tmp_path):
    """Confirmed accounts give R09, accounts of a large component R01, and the alerts are limited."""
    minute = 60_000_000
    rows = [txn(i, T0 + i * minute, f"a{i % 12}", "m", cents=50, device="shared") for i in range(60)]
    wire = frame(spark, rows).select("transaction_id", F.timestamp_micros("ts_us").alias("timestamp"), "account_id", "merchant_id", (F.col("amount_cents") / 100).alias("amount_usd"), "status", "device_id")
    said = tx.confirmation(spark, "c", ["a3"]).select(F.from_json("value", "component_id string, member_ids array<string>, reason string, analyst string").alias("r")).select("r.*", F.timestamp_micros(F.lit(T0)).alias("confirmed_at"))
    home = f"file://{tmp_path}/out"
    streams = json_folder(spark, f"file://{tmp_path}/txns", wire), json_folder(spark, f"file://{tmp_path}/said", said)
    for _ in range(2):  # the second start finds nothing new and writes nothing twice
        for q in pipelines.topology(*streams, home, {"availableNow": True}, heartbeat_ms=None):
            q.awaitTermination()
    scores = spark.read.parquet(f"{home}/scores").collect()
    assert len({r.transaction_id for r in scores}) == len(scores)
    assert {r.account_id for r in scores if "R09" in r.triggered} == {"a3"}
    assert published(spark, f"{home}/labels", pipelines.LABEL_SCHEMA).count() == 2 and spark.read.text(f"{home}/audit").count() == 1
    got = pipelines.run_to_table(pipelines.alerts_of(spark, home), "alerts")
    times = sorted(r.ts_us for r in got.where("account_id = 'a3'").collect())
    assert times == greedy([r.ts_us for r in scores if r.account_id == "a3"], 10 * minute, True)


def test_late_rows_count_only_their_past(spark):
    """Two batches, the second with a row older than all of the first."""
    first = frame(spark, [txn(i, T0 + 10 * HOUR + i) for i in range(5)])
    rows = first.unionByName(frame(spark, [txn(9, T0 + 10 * HOUR - 1)]))
    got = {r.transaction_id: r.txn_velocity_1h for r in pipelines.features(rows).collect()}
    assert got["t9"] == 1 and got["t4"] == 6


def test_heartbeat_leaves_out_ended_components(spark):
    rows = [txn(1, T0, "a", "m"), txn(2, T0 + 1, "b", "n"), txn(3, T0 + 2, "a", "n"), txn(4, T0 + 3, "z", "y")]
    got = pipelines.heartbeat(pipelines.component_stream(frame(spark, rows))).collect()
    assert [(sorted(r.member_ids), r["size"]) for r in got] == [(["a", "b", "m", "n"], 4)]


def test_crossing_edges(spark):
    e = edges.entity_edges(frame(spark, [txn(i, T0 + i, f"a{i}", f"m{i}") for i in range(40)]))
    got = pipelines.crossing(e, 4)
    assert 0 < got.count() < 40 and got.where("source_shard = target_shard").count() == 0


def test_components_come_again_by_the_clock(spark, tmp_path):
    rows = frame(spark, [txn(i, T0 + i, f"a{i}", "m") for i in range(4)])
    path = f"file://{tmp_path}/in"
    rows.write.parquet(path)
    stream = pipelines.component_stream(spark.readStream.schema(rows.schema).parquet(path), heartbeat_ms=500)
    q = stream.writeStream.format("memory").queryName("beats").outputMode("append").trigger(processingTime="1 second").start()
    try:
        until = time.time() + 100
        while time.time() < until and spark.table("beats").where("absorbed IS NULL").count() < 2:
            time.sleep(1)
        beats = spark.table("beats").where("absorbed IS NULL").collect()
        assert len(beats) >= 2 and {(r["size"], r.edge_count) for r in beats} == {(5, 4)}
    finally:
        q.stop()


def test_command_lines(spark, tmp_path, capsys):
    home = f"file://{tmp_path}"
    cli.main(["generate", "--out", f"{home}/txns", "--events", "50", "--num-fraud-rings", "2"], spark)
    cli.main(["confirm", "c1", "--members", "a", "b", "--out", f"{home}/said"], spark)
    assert tx.good(tx.parse(spark.read.text(f"{home}/txns"))).count() == 50
    (c,) = tx.parse_confirmations(spark.read.text(f"{home}/said")).collect()
    assert (c.component_id, c.member_ids, c.analyst) == ("c1", ["a", "b"], "system")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cli.main(["pipeline", "--dry-run", "--transactions", f"{home}/txns", "--confirmations", f"{home}/said", "--out", f"{home}/out"], spark)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "composite_score" in capsys.readouterr().out


def test_size_tiers(spark):
    got = [r.t for r in spark.range(40).select(alerts.size_tier(F.col("id")).alias("t")).collect()]
    assert [got[i] for i in (4, 5, 15, 30)] == [None, "medium", "high", "critical"]


def test_generator_stream_and_shuffle_and_observation(spark):
    d = generator.shuffled(spark.range(30))
    assert sorted(r.id for r in d.collect()) == list(range(30))
    assert generator.rate_stream(spark, 5).isStreaming and metrics.observed(d).count() == 30


class FakeMap:
    """Map state in memory that counts its reads."""

    def __init__(self):
        self.rows, self.reads = {}, 0

    def exists(self):
        return bool(self.rows)

    def containsKey(self, key):
        self.reads += 1
        return key in self.rows

    def getValue(self, key):
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        del self.rows[key]


class FakeHandle:
    def __init__(self):
        self.maps = {}

    def getMapState(self, name, key, value, ttl_ms=None):
        return self.maps.setdefault(name, FakeMap())


def two_batches(spark, rows, tmp_path):
    """rows as a stream of two files, one in each micro-batch, by time."""
    cut = sorted(r.ts_us for r in rows.select("ts_us").collect())[rows.count() // 2]
    for k, part in enumerate((rows.where(F.col("ts_us") < cut), rows.where(F.col("ts_us") >= cut))):
        part.coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in{k}")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in*")


def test_gap_filter_takes_many_keys_in_a_group():
    """One group holds a bucket of keys: one call for all, no read of state that is not there, and one a key once it is."""
    f, handle = processors.GapFilter(DAY, "id", False, by="key"), FakeHandle()
    f.init(handle)
    batch = lambda day: pd.DataFrame([(f"k{i}", day * DAY + i, f"{i}") for i in range(300)], columns=["key", "ts_us", "id"])
    assert len(next(f.handleInputRows(1, iter([batch(0)]), None))) == 300 and handle.maps["last"].reads == 0
    assert not list(f.handleInputRows(1, iter([batch(1)]), None)) and handle.maps["last"].reads == 300
    assert len(next(f.handleInputRows(1, iter([batch(2)]), None))) == 300


def test_gap_filter_of_buckets_over_two_batches(spark, tmp_path):
    rng = random.Random(4)
    rows = spark.createDataFrame([(f"k{rng.randrange(40)}", rng.randrange(6 * DAY), f"{i:04}") for i in range(900)], "edge_key string, ts_us long, transaction_id string")
    want = sorted(map(tuple, gaps.keep_after_gap(rows, "edge_key", "ts_us", "transaction_id", DAY, inclusive=False).collect()))
    stream = pipelines.deduplicated(two_batches(spark, rows, tmp_path))
    assert sorted(map(tuple, pipelines.run_to_table(stream, "two").collect())) == want


def test_features_take_many_accounts_in_a_group():
    """A group is a bucket of accounts; the second batch counts what the first left in state."""
    f, handle = processors.Features(), FakeHandle()
    f.init(handle)
    batch = lambda us: pd.DataFrame([(f"t{us}-{i}", f"a{i}", us, 50, "d", None, None) for i in range(200)], columns=["transaction_id", "account_id", "ts_us", "amount_cents", "device_id", "ip_address", "country_code"])
    first = next(f.handleInputRows(1, iter([batch(0)]), None))
    assert set(first.txn_velocity_1h) == {1} and sum(m.reads for m in handle.maps.values()) == 0
    second = next(f.handleInputRows(1, iter([batch(HOUR)]), None))
    assert (set(second.txn_velocity_1h), set(second.txn_velocity_24h), len(second)) == ({2}, {2}, 200)


def test_features_of_buckets_over_two_batches(spark, tmp_path):
    rng = random.Random(5)
    rows = frame(spark, [txn(i, T0 + rng.randrange(3 * DAY), f"a{rng.randrange(9)}", cents=rng.randrange(1, 90000), device=rng.choice(["x", "y", "", None]), ip=rng.choice(["1", None]), country=rng.choice(["US", "gb", None])) for i in range(300)])
    want = sorted(map(tuple, features.account_features(rows).collect()))
    assert sorted(map(tuple, pipelines.run_to_table(pipelines.features(two_batches(spark, rows, tmp_path)), "two").collect())) == want


def test_alert_stream_computes_features_once(spark):
    """Two stateful steps, features and rate limit; a union of free and limited alerts would have the features twice."""
    plan = pipelines.alert_stream(frame(spark, [txn(1, T0)]))._jdf.queryExecution().analyzed().toString()
    assert plan.count("TransformWithState") == 2


def test_limit_lets_other_alerts_pass(spark):
    minute = 60_000_000
    rows = spark.createDataFrame([(f"{i}", f"a{i % 3}", T0 + i * minute, 0.9 if i % 2 else 0.4) for i in range(60)], "transaction_id string, account_id string, ts_us long, composite_score double")
    want = sorted(map(tuple, alerts.rate_limited(rows).collect()))
    assert sorted(map(tuple, pipelines.limited(rows).collect())) == want


def resolved(resolver, edges_):
    """The snapshots of a micro-batch of (key, source, target, us, id), and how many runs they came in."""
    packed = {}
    for k, a, b, us, i in sorted(edges_, key=lambda e: e[3:]):
        packed.setdefault(k, (k, a, b, [], []))
        packed[k][3].append(us)
        packed[k][4].append(i)
    rows = pd.DataFrame(list(packed.values()), columns=["edge_key", "source_id", "target_id", "ts_us", "transaction_id"])
    runs = [r for d in resolver.handleInputRows(1, iter([rows]), None) for r in d.itertuples(index=False)]
    return [(r.component_id, tuple(r.member_ids), tuple(r.transaction_ids), *x) for r in runs for x in zip(*r[3:], strict=True)], len(runs)


def test_resolver_equals_sets_over_two_batches():
    """Each snapshot against plain sets, with lists of 5; the second batch goes on from state."""
    rng, most = random.Random(6), 5
    made = [(us, rng.randrange(40), rng.randrange(40)) for us in range(400)]
    rows = [(f"a{a:02}|b{b:02}", f"a{a:02}", f"b{b:02}", us, f"t{rng.randrange(300):03}") for us, a, b in made]
    parts, want = {}, []
    for _, a, b, us, i in rows:
        x, y = (parts.setdefault(n, {"name": n, "nodes": {n}, "ids": set(), "edges": 0, "first": us}) for n in (a, b))
        if x is not y:
            x, y = (y, x) if len(y["nodes"]) > len(x["nodes"]) else (x, y)
            x["nodes"], x["ids"], x["edges"], x["first"] = x["nodes"] | y["nodes"], x["ids"] | y["ids"], x["edges"] + y["edges"], min(x["first"], y["first"])
            parts |= dict.fromkeys(y["nodes"], x)
        x["ids"].add(i)
        x["edges"] += 1
        if x is not y:
            want.append((x["name"], tuple(sorted(x["nodes"])[:most]), tuple(sorted(x["ids"])[:most]), len(x["nodes"]), x["edges"], x["first"], us, y["name"]))
    r, handle = processors.Resolver(most), FakeHandle()
    r.init(handle)
    got = resolved(r, rows[:60])[0] + resolved(r, rows[60:])[0]
    assert sorted(got) == sorted(want)
    assert len(handle.maps["record"].rows) == len({id(p) for p in parts.values()})


def test_resolver_does_not_repeat_lists_for_each_merge():
    """3,000 accounts of one merchant: 3,000 snapshots of a component whose smallest 500 soon stay as they are."""
    r = processors.Resolver()
    r.init(FakeHandle())
    got, runs = resolved(r, [(f"a{i:04}|m", f"a{i:04}", "m", i, f"t{i:04}") for i in range(3000)])
    assert len(got) == 3000 and runs < 520 and {len(x[1]) for x in got[600:]} == {500}
