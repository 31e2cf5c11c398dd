"""Weighted risk rules as Column expressions, and the composite score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringfold.functions.numbers import round4
from ringfold.operators.features import feature

# Weights, and tiers as (at least, score); R04 and R08 are linear and fire from 0.5.
WEIGHTS = {
    "R01_large_component": 0.30, "R02_high_velocity": 0.20, "R03_amount_anomaly": 0.15, "R04_card_testing": 0.15,
    "R05_cross_border": 0.05, "R06_night_activity": 0.05, "R07_device_sharing": 0.05, "R08_new_account_burst": 0.05,
}
TIERS = {
    "R01_large_component": ((30, 1.0), (15, 0.8), (7, 0.5), (4, 0.25)),
    "R02_high_velocity": ((50, 1.0), (20, 0.75), (10, 0.4)),
    "R03_amount_anomaly": ((5.0, 1.0), (3.5, 0.7), (2.5, 0.4)),
    "R05_cross_border": ((0.9, 0.8), (0.7, 0.4)),
    "R06_night_activity": ((0.9, 0.7), (0.7, 0.35)),
    "R07_device_sharing": ((10, 0.8), (5, 0.4)),
}
KNOWN = "R09_known_fraud_network"
MODEL = "rules-v1"


def tiered(value: Column, tiers: tuple) -> Column:
    out = F.when(value >= tiers[0][0], F.lit(tiers[0][1]))
    for least, score in tiers[1:]:
        out = out.when(value >= least, F.lit(score))
    return out.otherwise(F.lit(0.0))


def raw_scores(size: Column | None = None) -> dict[str, Column]:
    """Raw score of each rule from the feature columns; size: of the account's component, null or none for unknown."""
    size = F.coalesce(size, F.lit(0)) if size is not None else F.lit(0)
    return {
        "R01_large_component": tiered(size, TIERS["R01_large_component"]),
        "R02_high_velocity": tiered(feature("txn_velocity_1h"), TIERS["R02_high_velocity"]),
        "R03_amount_anomaly": tiered(F.abs(feature("amount_zscore")), TIERS["R03_amount_anomaly"]),
        "R04_card_testing": F.least(feature("card_testing_score").cast("double"), F.lit(1.0)),
        "R05_cross_border": tiered(feature("cross_border_ratio"), TIERS["R05_cross_border"]),
        "R06_night_activity": tiered(feature("night_txn_ratio"), TIERS["R06_night_activity"]),
        "R07_device_sharing": tiered(feature("unique_devices_30d"), TIERS["R07_device_sharing"]),
        "R08_new_account_burst": F.least(feature("txn_velocity_24h") / 100 * 0.5 + feature("mule_account_score") * 0.5, F.lit(1.0)),
    }


def score(features: DataFrame, size: Column | None = None, known: Column | None = None) -> DataFrame:
    """features with contributions (map), triggered (array, in rule order) and composite_score.

    known: true where the component or the account is labelled; it sets the score to 1.
    """
    raw = raw_scores(size)
    d = features.withColumns({f"__{k}": v for k, v in raw.items()})
    fires = lambda k: F.col(f"__{k}") >= 0.5 if k in ("R04_card_testing", "R08_new_account_burst") else F.col(f"__{k}") > 0
    total = sum((F.col(f"__{k}") * w for k, w in WEIGHTS.items()), F.lit(0.0))
    known = F.coalesce(known, F.lit(False)) if known is not None else F.lit(False)
    shares = [x for k, w in WEIGHTS.items() for x in (F.lit(k), round4(F.col(f"__{k}") * w))]
    fired = F.filter(F.array(*[F.when(fires(k), F.lit(k)) for k in WEIGHTS], F.when(known, F.lit(KNOWN))), lambda x: x.isNotNull())
    contributions = F.create_map(*shares)
    contributions = F.when(known, F.map_concat(contributions, F.create_map(F.lit(KNOWN), F.lit(1.0)))).otherwise(contributions)
    d = d.withColumns({"contributions": contributions, "triggered": fired, "composite_score": F.when(known, F.lit(1.0)).otherwise(round4(F.least(total, F.lit(1.0))))})
    return d.drop(*[f"__{k}" for k in raw])


def score_id() -> Column:
    return F.substring(F.sha2(F.concat_ws("|", F.lit(MODEL), "transaction_id"), 256), 1, 32)
