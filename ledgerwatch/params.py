"""Policy constants and fixed values.

FIXED VALUES: the numbers, column lists and texts below must equal the
ones the original pipeline uses so that results agree. They are stated
plainly, in their natural order, in one place.
"""

from __future__ import annotations

# --- fixed values: governance policy -------------------------------------
MIN_DATA_COMPLETENESS = 0.95
MAX_CLASS_IMBALANCE_RATIO = 10.0
GOVERNANCE_REQUIRED_FEATURES = [
    "transaction_amount",
    "merchant_category",
    "customer_age_days",
    "hour_of_day",
    "device_fingerprint",
]
FAIRNESS_THRESHOLD = 0.1
MIN_MODEL_ACCURACY = 0.88
MAX_FALSE_POSITIVE_RATE = 0.08
GREEN_COMPUTE_LIMIT_KWH = 50.0

# --- fixed values: feature table -----------------------------------------
FEATURE_COLUMNS = [
    "customer_id",
    "transaction_id",
    "transaction_timestamp",
    "transaction_amount",
    "merchant_category",
    "merchant_country",
    "customer_country",
    "device_fingerprint",
    "tx_count_7d",
    "avg_amount_30d",
    "amount_deviation_ratio",
    "hour_of_day",
    "is_weekend",
    "is_new_merchant",
    "is_cross_border",
    "rule_based_risk",
    "is_fraud",
    "feature_version",
    "feature_timestamp",
]
# Minimal local validation set.
LOCAL_REQUIRED_COLUMNS = [
    "customer_id",
    "transaction_amount",
    "is_fraud",
    "rule_based_risk",
]
# Existence checks of the expectation suite, in order.
SUITE_EXISTENCE_COLUMNS = ["customer_id", "transaction_amount", "is_fraud", "rule_based_risk"]
# Not-null checks of both suites, in order.
NOT_NULL_COLUMNS = ["customer_id", "transaction_amount", "is_fraud"]
# Model features in their fixed order.
MODEL_FEATURES = [
    "transaction_amount",
    "tx_count_7d",
    "avg_amount_30d",
    "amount_deviation_ratio",
    "hour_of_day",
    "is_weekend",
    "is_new_merchant",
    "is_cross_border",
    "rule_based_risk",
]
FEATURE_VERSION = "v1.0"
FEATURE_VERSION_LOCAL = "v1.0-local"
AMOUNT_DEVIATION_EPS = 0.01
VELOCITY_LIMIT_7D = 20

# Rule-risk weights (deviation, new merchant, cross border, velocity).
RISK_WEIGHTS_NOTEBOOK = (0.3, 0.25, 0.25, 0.2)
RISK_WEIGHTS_LOCAL = (0.1, 0.3, 0.25, 0.2)
LOCAL_DEVIATION_CLIP = 3.0

# --- fixed values: expectation suite --------------------------------------
AMOUNT_MIN = 0.01
AMOUNT_MAX = 1_000_000.0
RISK_MIN = 0.0
RISK_MAX = 1.0
FRAUD_RATE_MIN = 0.005
FRAUD_RATE_MAX = 0.05
MEAN_SHIFT_LIMIT = 0.15

# --- fixed values: scoring and decisions -----------------------------------
DECISION_THRESHOLD = 0.65
TIER_HIGH = 0.7
TIER_MEDIUM = 0.3
EXPLAIN_HIGH = 0.7
EXPLAIN_MODERATE = 0.4
EXPLAIN_BLOCK = 0.8

# --- fixed values: drift ------------------------------------------------
PSI_BINS = 10
KL_BINS = 20
PSI_EPS = 1e-6
KL_EPS = 1e-10
PSI_DRIFT = 0.25
PSI_MEDIUM = 0.1
RETRAIN_ACCURACY_DROP = 0.02
RETRAIN_KL = 0.1
ROLLBACK_FPR_FACTOR = 1.5
CONSECUTIVE_DAYS = 3

# --- fixed values: dashboard analytics ----------------------------------------
BASELINE_FPR = 0.12
COST_PER_FP = 5.0
COST_PER_FN = 250.0
SLA_TARGET_MS = 100.0
SLA_PERCENTILE = 0.95
REGIONS = ["Domestic", "International", "Cross-Border"]
SEGMENTS = ["High Value", "Mid Value", "Low Value", "New Customer"]

# --- fixed values: green metrics ----------------------------------------------
KW_PER_CORE = 0.095
CO2_GRAMS_PER_KWH = 475.0
MIN_KWH_FLOOR = 0.001
CARBON_RED_PCT = 80.0
CARBON_AMBER_PCT = 60.0

# --- fixed values: model health defaults ----------------------------------
HEALTH_DEFAULT_ACCURACY = 0.924
HEALTH_DEFAULT_FPR = 0.051
HEALTH_DEFAULT_F1 = 0.89
TARGET_ACCURACY = 0.924
TARGET_FPR = 0.051

# --- fixed values: explanation texts --------------------------------------------
FEATURE_DESCRIPTIONS = [
    ("amount_deviation_ratio", "Amount is unusually high vs the customer's 30-day average"),
    ("is_new_merchant", "First transaction at this merchant"),
    ("tx_count_7d", "Unusually high transaction velocity in the last 7 days"),
    ("hour_of_day", "Transaction time outside customer's normal pattern"),
    ("is_weekend", "Weekend transaction inconsistent with history"),
    ("is_cross_border", "International transaction from new location"),
    ("rule_based_risk", "Multiple rule-based risk flags triggered"),
    ("avg_amount_30d", "Transaction amount deviates from 30-day average"),
]
# Executive pattern per top factor: (substrings, pattern text, action text).
EXECUTIVE_PATTERNS = [
    (["amount_deviation", "avg_amount"],
     "amount is unusually high vs the customer's 30-day average. This pattern suggests possible account takeover or unauthorized card use.",
     "Verify cardholder identity before approving."),
    (["new_merchant"],
     "first transaction at an unfamiliar merchant combined with unusual amount. This pattern is common in card-not-present fraud.",
     "Contact customer to confirm transaction legitimacy."),
    (["tx_count", "velocity"],
     "unusually high transaction velocity in a short time window. This suggests possible card testing or account compromise.",
     "Temporarily suspend card and contact customer."),
    (["hour_of_day"],
     "transaction occurred at an unusual time for this customer. This may indicate unauthorized access.",
     "Flag for manual review in fraud operations queue."),
    (["cross_border"],
     "international transaction from new location. This pattern is common in stolen card fraud.",
     "Apply enhanced verification for cross-border activity."),
]
EXECUTIVE_DEFAULT = (
    "multiple risk indicators present. This transaction deviates from the customer's normal behavior profile.",
    "Escalate to fraud investigation team.",
)
# Question intents, checked in this order; the first match wins.
QUESTION_INTENTS = [
    ("fraud_patterns", ["fraud pattern", "top feature", "shap", "important feature", "driver"]),
    ("drift", ["drift", "psi", "data quality", "distribution"]),
    ("performance", ["performance", "accuracy", "metric", "confusion matrix"]),
    ("green", ["energy", "green", "carbon", "co2", "kwh"]),
    ("retraining", ["retrain", "pipeline", "automation", "trigger"]),
    ("explainability", ["explain", "shap", "xai", "interpretability"]),
]
CONTEXT_SECTION_SEPARATOR = "\n\n---\n\n"

# What an analyst reads about a factor, by the first name part
# that occurs in the feature's name, and the two actions (block, review).
ANALYST_INTERPRETATIONS = [
    (("amount_deviation", "avg_amount"), "Amount is unusually high vs customer's 30-day average"),
    (("new_merchant",), "First transaction at this merchant"),
    (("tx_count",), "Unusually high transaction velocity in the last 7 days"),
    (("hour_of_day",), "Transaction time outside customer's normal pattern"),
    (("is_weekend",), "Weekend transaction inconsistent with history"),
    (("cross_border",), "International transaction from new location"),
    (("rule_based_risk",), "Multiple rule-based risk flags triggered"),
]
ANALYST_INTERPRETATION_DEFAULT = "Feature value outside normal range"
ANALYST_ACTIONS = ("Block transaction and notify customer", "Flag for manual review in fraud operations queue.")
