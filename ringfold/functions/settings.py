"""Settings by their environment names: the environment first, then a `.env` file, then the defaults below."""

from __future__ import annotations

import os
from types import SimpleNamespace

# The public environment names with their defaults. A group is what stands before the first underscore.
DEFAULTS: dict[str, str | int | float] = {
    "KAFKA_BOOTSTRAP_SERVERS": "localhost:9092",
    "KAFKA_TRANSACTIONS_TOPIC": "raw-transactions",
    "KAFKA_ALERTS_TOPIC": "fraud-alerts",
    "KAFKA_COMPONENTS_TOPIC": "entity-components",
    "KAFKA_CONFIRMATIONS_TOPIC": "fraud-confirmations",
    "KAFKA_CONSUMER_GROUP": "ringfold",
    "KAFKA_AUTO_OFFSET_RESET": "earliest",
    "KAFKA_BATCH_SIZE": 65536,
    "KAFKA_LINGER_MS": 5,
    "KAFKA_COMPRESSION_TYPE": "lz4",
    "FLINK_PARALLELISM": 4,
    "FLINK_CHECKPOINT_DIR": "",
    "FLINK_CHECKPOINT_INTERVAL_MS": 60_000,
    "FLINK_MAX_OUT_OF_ORDERNESS_MS": 10_000,
    "FEAST_REPO_PATH": "./feast",
    "FEAST_TTL_SECONDS": 2_592_000,
    "ALERT_SCORE_THRESHOLD_LOW": 0.35,
    "ALERT_SCORE_THRESHOLD_MEDIUM": 0.50,
    "ALERT_SCORE_THRESHOLD_HIGH": 0.75,
    "ALERT_SCORE_THRESHOLD_CRITICAL": 0.90,
    "ALERT_COMPONENT_SIZE_MEDIUM": 5,
    "ALERT_COMPONENT_SIZE_HIGH": 15,
    "ALERT_COMPONENT_SIZE_CRITICAL": 30,
    "GENERATOR_EVENTS_PER_SECOND": 200.0,
    "GENERATOR_FRAUD_RING_RATIO": 0.08,
    "GENERATOR_NUM_LEGITIMATE_ACCOUNTS": 10_000,
    "GENERATOR_NUM_MERCHANTS": 2_000,
    "GENERATOR_NUM_FRAUD_RINGS": 20,
    "GENERATOR_RING_MIN_SIZE": 4,
    "GENERATOR_RING_MAX_SIZE": 25,
    "GENERATOR_SEED": 42,
    "LOG_LEVEL": "INFO",
}


def from_file(path: str = ".env") -> dict[str, str]:
    """NAME=value lines of a file; comments and other lines count for nothing, and neither does a missing file."""
    if not os.path.isfile(path):
        return {}
    with open(path, encoding="utf-8") as f:
        pairs = (line.strip().split("=", 1) for line in f if "=" in line and not line.lstrip().startswith("#"))
        return {k.strip(): v.strip().strip("\"'") for k, v in pairs}


def get(name: str) -> str | int | float:
    default = DEFAULTS[name]
    given = os.environ.get(name, from_file().get(name))
    return default if given is None else type(default)(given)


def group(prefix: str, **given) -> SimpleNamespace:
    """The settings of a group as attributes in lower case; keywords replace single ones."""
    names = {n[len(prefix) + 1 :].lower(): n for n in DEFAULTS if n.startswith(f"{prefix}_")}
    unknown = given.keys() - names.keys()
    if unknown:
        raise TypeError(f"no such settings in {prefix}: {sorted(unknown)}")
    return SimpleNamespace(**{k: given.get(k, get(n)) for k, n in names.items()})
