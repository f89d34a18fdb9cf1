from churnspark.functions.scalar import (  # noqa: F401
    NA_TOKENS, coerce_numeric, code_dictionary, drift_status, map_binary,
    nan_to_null, null_tokens_to_null, pred_label, request_codes, risk_band, threshold_predict,
    ts_display, ts_path,
)
