"""Column-expression builders (all JVM side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values ------------------------------------------------------------
# Text a pandas CSV reader turns into a missing value (pandas default
# ``na_values`` plus the empty field).  Compared exactly, without trimming,
# so a lone blank ``' '`` stays text.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Risk bands: probability >= 0.7 High, >= 0.4 Medium, otherwise Low.
RISK_HIGH = 0.7
RISK_MEDIUM = 0.4
# Decision threshold of the positive class (inclusive).
DECISION_THRESHOLD = 0.5
# Drift alert threshold (strictly greater is drift).
DRIFT_THRESHOLD = 0.20
# -----------------------------------------------------------------------------

# Plain decimal number with optional sign, exponent and surrounding blanks.
_NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_tokens_to_null(col: str | Column, tokens=NA_TOKENS) -> Column:
    c = _c(col)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def nan_to_null(col: str | Column) -> Column:
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def coerce_numeric(col: str | Column) -> Column:
    """Text -> double; anything that is not a plain decimal number -> NULL.

    ``try_cast`` alone would accept Java suffixes such as ``'1d'``/``'1f'``;
    the regex guard rejects them (pandas/SQL semantics).
    """
    c = _c(col).cast("string")
    return F.when(c.rlike(_NUMERIC_TEXT), F.trim(c).try_cast("double"))


def map_binary(col: str | Column, positive: str = "Yes", negative: str = "No") -> Column:
    c = _c(col)
    return F.when(c == positive, F.lit(1)).when(c == negative, F.lit(0)).otherwise(F.lit(None).cast("int"))


def threshold_predict(prob: str | Column, threshold: float = DECISION_THRESHOLD) -> Column:
    """1 iff probability >= threshold (inclusive, unlike Spark ML's ``>``)."""
    p = _c(prob)
    return F.when(p.isNull(), F.lit(None).cast("int")).otherwise((p >= F.lit(threshold)).cast("int"))


def risk_band(prob: str | Column, high: float = RISK_HIGH, medium: float = RISK_MEDIUM) -> Column:
    p = _c(prob)
    return (F.when(p.isNull(), F.lit(None).cast("string"))
            .when(p >= F.lit(high), F.lit("High"))
            .when(p >= F.lit(medium), F.lit("Medium"))
            .otherwise(F.lit("Low")))


def pred_label(pred: str | Column, positive: str = "Churn", negative: str = "Stay") -> Column:
    p = _c(pred)
    return F.when(p == 1, F.lit(positive)).when(p == 0, F.lit(negative))


def drift_status(score: str | Column, threshold: float = DRIFT_THRESHOLD) -> Column:
    s = _c(score)
    return F.when(s > F.lit(threshold), F.lit("Drifted")).otherwise(F.lit("OK"))


def code_dictionary(col: str | Column, mapping: Mapping[str, int]) -> Column:
    """Fixed label -> integer code via a literal map (no join); unknown -> NULL."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(int(v))]
    return F.element_at(F.create_map(*items), _c(col).cast("string")) if items else F.lit(None).cast("int")


def ts_display(ts: str | Column) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def ts_path(ts: str | Column) -> Column:
    return F.date_format(_c(ts), "yyyy/MM/dd")


def request_codes(df, yes_fields=None, dictionaries=None):
    """Human-readable request fields -> the integer codes of the scoring form.

    Binary fields: ``'Yes'`` -> 1, any other text -> 0; dictionary fields
    through fixed literal maps (an unknown label -> NULL, so the range check
    rejects it); NULL stays NULL.  Other columns pass through.
    """
    from churnspark.profile import TELCO_CODE_DICTIONARIES, TELCO_YES_FIELDS
    yes_fields = TELCO_YES_FIELDS if yes_fields is None else yes_fields
    dictionaries = TELCO_CODE_DICTIONARIES if dictionaries is None else dictionaries
    out = []
    for c in df.columns:
        if c in yes_fields:
            col = F.col(c).cast("string")
            out.append(F.when(col.isNull(), F.lit(None).cast("int"))
                       .otherwise((col == "Yes").cast("int")).alias(c))
        elif c in dictionaries:
            out.append(code_dictionary(c, dictionaries[c]).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
