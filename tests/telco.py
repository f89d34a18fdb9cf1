"""Telco-like literal frames (the original project's record shape)."""

import numpy as np

from churnspark.profile import TELCO_CONTRACT

YES_NO = ["Yes", "No"]
SERVICE = ["Yes", "No", "No internet service"]


def valid_row(i=0):
    """One record, every field filled (the 'all Yes / 1' builder)."""
    return {
        "customerID": f"C{i:04d}", "gender": "Male", "SeniorCitizen": "1", "Partner": "Yes",
        "Dependents": "Yes", "tenure": "12", "PhoneService": "Yes", "MultipleLines": "Yes",
        "InternetService": "DSL", "OnlineSecurity": "Yes", "OnlineBackup": "Yes", "DeviceProtection": "Yes",
        "TechSupport": "Yes", "StreamingTV": "Yes", "StreamingMovies": "Yes", "Contract": "One year",
        "PaperlessBilling": "Yes", "PaymentMethod": "Mailed check", "MonthlyCharges": "50.5",
        "TotalCharges": "606.0", "Churn": "Yes",
    }


def random_rows(n=100, seed=42):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        r = {
            "customerID": f"C{i:04d}",
            "gender": rng.choice(["Male", "Female"]),
            "SeniorCitizen": int(rng.integers(0, 2)),
            "Partner": rng.choice(YES_NO), "Dependents": rng.choice(YES_NO),
            "tenure": int(rng.integers(1, 72)),
            "PhoneService": rng.choice(YES_NO),
            "MultipleLines": rng.choice(["Yes", "No", "No phone service", None]),
            "InternetService": rng.choice(["DSL", "Fiber optic", "No"]),
            "OnlineSecurity": rng.choice(SERVICE + [None]), "OnlineBackup": rng.choice(SERVICE),
            "DeviceProtection": rng.choice(SERVICE), "TechSupport": rng.choice(SERVICE),
            "StreamingTV": rng.choice(SERVICE), "StreamingMovies": rng.choice(SERVICE),
            "Contract": rng.choice(["Month-to-month", "One year", "Two year"]),
            "PaperlessBilling": rng.choice(YES_NO),
            "PaymentMethod": rng.choice(["Electronic check", "Mailed check", "Bank transfer", "Credit card"]),
            "MonthlyCharges": float(np.round(rng.uniform(18, 120), 2)),
            "TotalCharges": None if rng.random() < 0.05 else float(np.round(rng.uniform(18, 8000), 2)),
            "Churn": int(rng.random() < 0.27),
        }
        rows.append({k: (v.item() if hasattr(v, "item") else v) for k, v in r.items()})
    return rows


TELCO_TYPES = {"SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double", "TotalCharges": "double",
               "Churn": "int"}


def schema_ddl():
    return ", ".join(f"{c} {TELCO_TYPES.get(c, 'string')}" for c, _ in TELCO_CONTRACT)


def text_ddl():
    return ", ".join(f"{c} string" for c, _ in TELCO_CONTRACT)
