"""Column profiles: which columns are target, identifiers, categorical, numeric.

Operators never hard-code a schema; they take a :class:`Profile`.  Two
profiles ship: ``TELCO`` (the 21-column customer record of the original
churn data) and ``CHURN_BASE`` (the churn view derived from the TPC-H-like
driver tables, see :mod:`churnspark.plans.fixtures`).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RangeRule:
    """Domain rule for one request field (inclusive bounds, ``None`` = open)."""

    column: str
    lo: float | None = None
    hi: float | None = None
    required: bool = True


@dataclass(frozen=True)
class Profile:
    target: str
    key: str | None
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    drop: tuple[str, ...] = ()
    # column -> nullable?  (the data contract checked by dq_null_rate)
    contract: tuple[tuple[str, bool], ...] = ()
    # serving order of the feature columns
    feature_order: tuple[str, ...] = ()
    rules: tuple[RangeRule, ...] = field(default=())

    @property
    def features(self) -> list[str]:
        if self.feature_order:
            return list(self.feature_order)
        return list(self.categorical) + list(self.numeric)

    @property
    def expected_columns(self) -> list[str]:
        return [c for c, _ in self.contract]


# --- Fixed values that must equal the original project's data contract -----
# Raw telco record: column -> nullable, in file order.
TELCO_CONTRACT = (
    ("customerID", False), ("gender", False), ("SeniorCitizen", False),
    ("Partner", False), ("Dependents", False), ("tenure", False),
    ("PhoneService", False), ("MultipleLines", True), ("InternetService", False),
    ("OnlineSecurity", True), ("OnlineBackup", True), ("DeviceProtection", True),
    ("TechSupport", True), ("StreamingTV", True), ("StreamingMovies", True),
    ("Contract", False), ("PaperlessBilling", False), ("PaymentMethod", False),
    ("MonthlyCharges", False), ("TotalCharges", True), ("Churn", False),
)
TELCO_CATEGORICAL = (
    "gender", "Partner", "Dependents", "PhoneService", "MultipleLines",
    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
    "PaperlessBilling", "PaymentMethod",
)
TELCO_NUMERIC = ("SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges")
# Serving feature order (19 columns).
TELCO_FEATURE_ORDER = (
    "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges",
)
# Request field domains (all required).
TELCO_RULES = (
    RangeRule("gender", 0, 1), RangeRule("SeniorCitizen", 0, 1),
    RangeRule("Partner", 0, 1), RangeRule("Dependents", 0, 1),
    RangeRule("tenure", 0, 72), RangeRule("PhoneService", 0, 1),
    RangeRule("MultipleLines", 0, 1), RangeRule("InternetService", 0, 2),
    RangeRule("OnlineSecurity", 0, 1), RangeRule("OnlineBackup", 0, 1),
    RangeRule("DeviceProtection", 0, 1), RangeRule("TechSupport", 0, 1),
    RangeRule("StreamingTV", 0, 1), RangeRule("StreamingMovies", 0, 1),
    RangeRule("Contract", 0, 2), RangeRule("PaperlessBilling", 0, 1),
    RangeRule("PaymentMethod", 0, 3), RangeRule("MonthlyCharges", 0, 200),
    RangeRule("TotalCharges", 0, None),
)
# Scoring-form label -> code dictionaries (not the fitted encoders: see
# functions.scalar.request_codes).  Binary fields: "Yes" -> 1, else 0;
# gender: "Male" -> 1, else 0.
TELCO_YES_FIELDS = (
    "SeniorCitizen", "Partner", "Dependents", "PhoneService", "MultipleLines",
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies", "PaperlessBilling",
)
TELCO_CODE_DICTIONARIES = {
    "gender": {"Female": 0, "Male": 1},
    "InternetService": {"DSL": 0, "Fiber optic": 1, "No": 2},
    "Contract": {"Month-to-month": 0, "One year": 1, "Two year": 2},
    "PaymentMethod": {"Electronic check": 0, "Mailed check": 1,
                      "Bank transfer (automatic)": 2, "Credit card (automatic)": 3},
}
# ---------------------------------------------------------------------------

TELCO = Profile(
    target="Churn",
    key="customerID",
    categorical=TELCO_CATEGORICAL,
    numeric=TELCO_NUMERIC,
    drop=("customerID",),
    contract=TELCO_CONTRACT,
    feature_order=TELCO_FEATURE_ORDER,
    rules=TELCO_RULES,
)

# Churn view over the driver tables (see plans.fixtures.churn_base).
CHURN_BASE = Profile(
    target="churn",
    key="c_custkey",
    categorical=("c_mktsegment", "n_name"),
    numeric=("tenure", "total", "n_orders", "c_acctbal"),
    drop=("c_custkey",),
    contract=(
        ("c_custkey", False), ("c_mktsegment", False), ("n_name", False),
        ("c_acctbal", False), ("n_orders", False), ("tenure", False),
        ("total", True), ("churn", False),
    ),
    feature_order=("c_mktsegment", "n_name", "tenure", "total", "n_orders", "c_acctbal"),
    rules=(
        RangeRule("tenure", 0, 72),
        RangeRule("c_acctbal", 0, None),
        RangeRule("n_orders", 1, 30),
        RangeRule("total", 0, None),
    ),
)
