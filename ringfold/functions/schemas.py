"""Record types of the engine as explicit Spark schemas."""

from __future__ import annotations

# Names and types of the data model.
STATUSES = ("pending", "approved", "declined", "reversed", "flagged")

TRANSACTION_DDL = (
    "transaction_id string, timestamp timestamp, account_id string, merchant_id string, amount_usd double, currency string, status string, "
    "device_id string, ip_address string, card_last4 string, phone_number string, email string, mcc string, country_code string, metadata map<string,string>"
)
CONFIRMATION_DDL = "component_id string, member_ids array<string>, reason string, analyst string, confirmed_at timestamp"

# The feature views (entity key, days that a row stays valid, columns). The scores and flags that models make are inputs.
FEATURE_VIEWS: dict[str, tuple[str, int, str]] = {
    "account_txn_stats": ("account_id", 30, "txn_velocity_1h bigint, txn_velocity_24h bigint, amount_mean_30d double, amount_stddev_30d double, amount_total_30d double, unique_merchants_30d bigint, unique_devices_30d bigint, unique_ips_30d bigint, cross_border_ratio double, night_txn_ratio double, declined_ratio_7d double, account_age_days bigint, first_seen_ts timestamp"),
    "account_risk_scores": ("account_id", 7, "card_testing_score double, mule_account_score double, synthetic_id_score double, ato_score double, model_version string, scored_at timestamp"),
    "merchant_stats": ("merchant_id", 30, "txn_volume_30d bigint, unique_accounts_30d bigint, chargeback_ratio_90d double, avg_txn_amount double, mcc string, risk_category string"),
    "device_stats": ("device_id", 90, "linked_accounts_count bigint, first_seen_ts timestamp, txn_velocity_24h bigint, countries_30d bigint, emulator_flag bigint"),
    "ip_stats": ("ip_address", 14, "linked_accounts_count bigint, is_vpn bigint, is_tor bigint, is_datacenter bigint, country_code string, abuse_score double"),
}
# The feature services, columns by view.
FEATURE_SERVICES: dict[str, dict[str, tuple[str, ...]]] = {
    "fraud_detection_v1": {
        "account_txn_stats": ("txn_velocity_1h", "txn_velocity_24h", "amount_mean_30d", "amount_stddev_30d", "unique_merchants_30d", "unique_devices_30d", "unique_ips_30d", "cross_border_ratio", "night_txn_ratio", "declined_ratio_7d", "account_age_days"),
        "account_risk_scores": ("card_testing_score", "mule_account_score", "synthetic_id_score", "ato_score"),
    },
    "fraud_detection_v2": {
        "account_txn_stats": ("txn_velocity_1h", "txn_velocity_24h", "amount_mean_30d", "amount_stddev_30d", "amount_total_30d", "unique_merchants_30d", "unique_devices_30d", "unique_ips_30d", "cross_border_ratio", "night_txn_ratio", "declined_ratio_7d", "account_age_days", "first_seen_ts"),
        "account_risk_scores": ("card_testing_score", "mule_account_score", "synthetic_id_score", "ato_score", "model_version", "scored_at"),
        "merchant_stats": ("chargeback_ratio_90d", "risk_category"),
        "device_stats": ("linked_accounts_count", "emulator_flag"),
        "ip_stats": ("is_vpn", "is_tor", "abuse_score"),
    },
}
