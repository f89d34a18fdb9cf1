"""Scoring request bodies -> typed feature rows, with an error output.

Accepted bodies: ``{"input_data": {"columns": [...], "data": [[...]]}}`` or
``{"columns": [...], "data": [[...]]}`` (columns optional: default order).
A body that is not a JSON object, has no ``data``, or has a row whose width
differs from the columns lands in the error output with a message.  Parsing
is ``from_json`` + ``posexplode``: per-row JVM work, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MATRIX = T.ArrayType(T.ArrayType(T.StringType()))
CORRUPT = "_corrupt_record"
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("input_data", T.StructType([
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("data", _MATRIX)])),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("data", _MATRIX),
    T.StructField(CORRUPT, T.StringType()),
])


def _resolved(requests: DataFrame, body: str, default_columns: Sequence[str]) -> DataFrame:
    """Parse each body ONCE into a struct column; every later expression
    reads that column (``from_json`` is never duplicated by the optimizer
    because the outputs below are produced by generators, not filters)."""
    parsed = requests.select("*", F.from_json(F.col(body), PAYLOAD_SCHEMA,
                                              {"mode": "PERMISSIVE",
                                               "columnNameOfCorruptRecord": CORRUPT}).alias("__p"))
    p = F.col("__p")
    default = F.array(*[F.lit(c) for c in default_columns])
    has_input = p["input_data"].isNotNull()
    cols = F.when(has_input, F.coalesce(p["input_data"]["columns"], default)) \
        .otherwise(F.coalesce(p["columns"], default))
    data = F.when(has_input, p["input_data"]["data"]).otherwise(p["data"])
    not_obj = F.col(body).isNull() | p.isNull() | p[CORRUPT].isNotNull()
    resolved = parsed.select(*requests.columns, not_obj.alias("__bad"), cols.alias("__cols"),
                             data.alias("__data"))
    bad_width = F.exists(F.col("__data"), lambda r: F.size(r) != F.size(F.col("__cols")))
    error = (F.when(F.col("__bad"), F.lit("body is not a JSON object"))
             .when(F.col("__data").isNull(), F.lit("missing 'data'"))
             .when(bad_width, F.lit("row width differs from columns")))
    return resolved.select(*requests.columns, "__cols", "__data", error.alias("error"))


def parse_payload(requests: DataFrame, body: str, default_columns: Sequence[str],
                  key: str = "request_id", value_type: str = "string") -> tuple[DataFrame, DataFrame]:
    """Return ``(rows, errors)``.

    rows: ``(key, row_idx, *default_columns)`` one per data row, values cast
    to ``value_type`` (try_cast: bad text -> NULL); a column missing from
    the request is NULL.  errors: ``(key, error)``.
    """
    r = _resolved(requests, body, default_columns)
    good = F.when(F.col("error").isNull(), F.col("__data"))
    exploded = r.select(key, "__cols", F.posexplode(good).alias("row_idx", "__row"))
    fields = []
    for c in default_columns:
        pos = F.array_position(F.col("__cols"), F.lit(c)).cast("int")
        v = F.when(pos > 0, F.try_element_at(F.col("__row"), pos))
        fields.append((v.try_cast(value_type) if value_type != "string" else v).alias(c))
    rows = exploded.select(key, F.col("row_idx").cast("int").alias("row_idx"), *fields)
    errors = r.select(key, F.explode(F.when(F.col("error").isNotNull(), F.array("error"))).alias("error"))
    return rows, errors
