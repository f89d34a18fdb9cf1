"""DuckDB oracle SQL for the registered queries (same column names).

Views ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are registered
by the checker.  Shared fixture views are spelled out once as CTE text and
prefixed to the queries that need them.
"""

from __future__ import annotations

# ------------------------------------------------------------ shared CTEs
CHURN_BASE = """
cb_h AS (SELECT max(o_orderdate) - INTERVAL 365 DAYS AS cutoff FROM orders),
cb_f AS (SELECT o_custkey, min(o_orderdate) AS first_d, sum(o_totalprice) AS total, count(*) AS n_orders
         FROM orders, cb_h WHERE o_orderdate <= cutoff GROUP BY o_custkey),
cb_l AS (SELECT DISTINCT o_custkey FROM orders, cb_h WHERE o_orderdate > cutoff),
churn_base AS (
  SELECT c.c_custkey, c.c_mktsegment, n.n_name, c.c_acctbal, f.n_orders,
         CAST(floor(date_diff('day', f.first_d, h.cutoff) / 30) AS INTEGER) AS tenure,
         f.total, CASE WHEN l.o_custkey IS NULL THEN 1 ELSE 0 END AS churn
  FROM customer c JOIN cb_f f ON c.c_custkey = f.o_custkey CROSS JOIN cb_h h
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN cb_l l ON l.o_custkey = c.c_custkey)"""

SPLIT_OF = """
{name} AS (
  SELECT * EXCLUDE (__rn, __cnt),
         CASE WHEN __rn <= round(0.7 * __cnt) THEN 'train'
              WHEN __rn <= round(0.85 * __cnt) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)), c_custkey)
                  AS __rn,
               count(*) OVER (PARTITION BY churn) AS __cnt FROM {src}))"""

CHURN_SPLIT = CHURN_BASE + "," + SPLIT_OF.format(name="churn_split", src="churn_base")

CHURN_NULLS = CHURN_BASE + """,
churn_nulls AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
         CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE n_name END AS n_name,
         c_acctbal, n_orders,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE tenure END AS tenure,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE total END AS total,
         churn
  FROM churn_base)""" + "," + SPLIT_OF.format(name="nulls_split", src="churn_nulls")

SCORED = CHURN_BASE + """,
scored AS (
  SELECT *, CAST((c_custkey * 37 % 101) / 100.0 AS DOUBLE) AS score,
         CAST(1.0 - least(tenure, 72) / 72.0 AS DOUBLE) AS score_tenure,
         CAST(1.0 / (1.0 + n_orders) AS DOUBLE) AS score_orders
  FROM churn_base)"""

CUSTOMER_NULLS = """
cnull AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
         CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer)"""

CUSTOMER_TEXT = """
ctext AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
         CASE WHEN c_custkey % 10 = 0 THEN ' ' WHEN c_custkey % 10 = 5 THEN '1d'
              ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS acctbal_text,
         CASE WHEN c_custkey % 7 = 0 THEN 'NA' WHEN c_custkey % 7 = 1 THEN 'null' WHEN c_custkey % 7 = 2 THEN 'nan'
              ELSE c_mktsegment END AS segment
  FROM customer)"""

NA_LIST = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', "
           "'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")


def _na(col: str) -> str:
    return f"CASE WHEN {col} IN ({NA_LIST}) THEN NULL ELSE {col} END"


NUMERIC_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _coerce(col: str) -> str:
    return f"CASE WHEN regexp_matches({col}, '{NUMERIC_RE}') THEN TRY_CAST(trim({col}) AS DOUBLE) END"


LOG = """
log AS (
  SELECT event_id AS id, CAST(ts AS TIMESTAMP) AS timestamp, event_type AS model, user_id, value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         value / (value + 50.0) AS probability,
         CASE WHEN value / (value + 50.0) >= 0.5 THEN 1 ELSE 0 END AS prediction,
         CASE WHEN value / (value + 50.0) >= 0.7 THEN 'High'
              WHEN value / (value + 50.0) >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_level
  FROM events)"""

DRIFT = """
li_base AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'),
li_live AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01')"""

NUMS = ["tenure", "total", "n_orders", "c_acctbal"]
CATS = ["c_mktsegment", "n_name"]
DRIFT_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DRIFT_CAT = ["l_returnflag", "l_linestatus"]
MODELS = ["click", "error", "purchase", "signup", "view"]


def W(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


def _median_union(src: str, cols, alias="median") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS {alias} FROM {src}" for c in cols)


def _mode_union(src: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (SELECT CAST({c} AS VARCHAR) FROM {src} WHERE {c} IS NOT NULL "
        f"GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode_value" for c in cols)


def _fills(src: str) -> str:
    """fills(col_name, num_fill, cat_fill) fitted on ``src``."""
    num = " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS num_fill, "
        f"CAST(NULL AS VARCHAR) AS cat_fill FROM {src}" for c in NUMS)
    cat = " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, CAST(NULL AS DOUBLE) AS num_fill, coalesce((SELECT {c} FROM {src} "
        f"WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), 'Unknown') AS cat_fill"
        for c in CATS)
    return f"{num} UNION ALL {cat}"


def _filled(src: str, fills: str) -> str:
    nums = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT num_fill FROM {fills} WHERE col_name = '{c}')) AS {c}"
                     for c in NUMS)
    cats = ", ".join(f"coalesce({c}, (SELECT cat_fill FROM {fills} WHERE col_name = '{c}')) AS {c}" for c in CATS)
    return f"SELECT * REPLACE ({cats}, {nums}) FROM {src}"


def _encoders(src: str, cols) -> str:
    parts = " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS col_name, CAST({c} AS VARCHAR) AS value FROM {src} WHERE {c} IS NOT NULL"
        for c in cols)
    return (f"SELECT col_name, value, CAST(row_number() OVER (PARTITION BY col_name ORDER BY value) - 1 AS INTEGER)"
            f" AS code FROM ({parts})")


def _scaler(src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, avg({c}) AS mean, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 "
        f"ELSE stddev_pop({c}) END AS scale FROM {src}" for c in NUMS)


def _scaled(src: str, scaler: str, cols=NUMS) -> str:
    exprs = ", ".join(
        f"round((CAST({c} AS DOUBLE) - (SELECT mean FROM {scaler} WHERE col_name = '{c}')) / "
        f"(SELECT scale FROM {scaler} WHERE col_name = '{c}'), 6) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({exprs}) FROM {src}"


def _codes(src: str, enc: str, cols) -> str:
    exprs = ", ".join(
        f"CASE WHEN {c} IS NULL THEN -1 ELSE coalesce((SELECT code FROM {enc} e WHERE e.col_name = '{c}' "
        f"AND e.value = CAST({src}.{c} AS VARCHAR)), -1) END AS {c}" for c in cols)
    return f"SELECT * REPLACE ({exprs}) FROM {src}"


def _auc_by_model(src: str, models) -> str:
    """Exact AUC (+ confusion at 0.5) per model_key over ``src(churn, <score cols>)``."""
    long = " UNION ALL ".join(f"SELECT '{m}' AS model_key, churn, {m} AS score FROM {src}" for m in models)
    return f"""
long AS ({long}),
sc AS (SELECT model_key, score, sum(CASE WHEN churn = 1 THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN churn = 1 THEN 0 ELSE 1 END) AS neg
       FROM long WHERE score IS NOT NULL AND churn IS NOT NULL GROUP BY model_key, score),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model_key ORDER BY score
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cneg FROM sc),
agg AS (SELECT model_key, sum(CAST(pos AS DOUBLE) * (CAST(cneg AS DOUBLE) + 0.5 * CAST(neg AS DOUBLE))) AS s,
               sum(pos) AS n_pos, sum(neg) AS n_neg,
               coalesce(sum(CASE WHEN score >= 0.5 THEN pos END), 0) AS tp,
               coalesce(sum(CASE WHEN score >= 0.5 THEN neg END), 0) AS fp
        FROM cum GROUP BY model_key),
met AS (SELECT model_key,
               CASE WHEN n_pos > 0 AND n_neg > 0 THEN s / (CAST(n_pos AS DOUBLE) * CAST(n_neg AS DOUBLE)) END AS roc_auc,
               CASE WHEN 2 * tp + fp + (n_pos - tp) = 0 THEN 0.0
                    ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + (n_pos - tp)) END AS f1,
               CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
               CASE WHEN n_pos = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / n_pos END AS recall,
               n_pos, n_neg
        FROM agg)"""


REGISTRY = """
reg AS (SELECT * FROM (VALUES ('score_orders', 'churn', 1, 'archived'), ('score_tenure', 'churn', 2, 'production'),
                              ('score', 'churn', 3, 'candidate'), ('score_orders', 'churn_orders', 1, 'candidate'))
        t(model_key, name, version, stage)),
versions AS (SELECT r.name, CAST(r.version AS INTEGER) AS version, r.stage, m.roc_auc, m.f1, m.precision, m.recall
             FROM reg r JOIN met m USING (model_key)),
cands AS (SELECT * FROM versions WHERE stage = 'candidate'
          QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1),
prods AS (SELECT * FROM versions WHERE stage = 'production'
          QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1),
champ AS (SELECT c.name, c.version, c.roc_auc AS cand_roc_auc, c.f1 AS cand_f1, c.precision AS cand_precision,
                 c.recall AS cand_recall, coalesce(p.roc_auc, 0.0) AS prod_roc_auc, coalesce(p.f1, 0.0) AS prod_f1,
                 coalesce(p.precision, 0.0) AS prod_precision, coalesce(p.recall, 0.0) AS prod_recall,
                 p.name IS NOT NULL AS has_production
          FROM cands c LEFT JOIN prods p USING (name)),
dec AS (SELECT *, cand_roc_auc - prod_roc_auc AS auc_delta,
               (NOT has_production) OR coalesce(cand_roc_auc - prod_roc_auc > 0.01, false) AS promote FROM champ)"""


def _test_scored() -> str:
    return SCORED + "," + SPLIT_OF.format(name="scored_split", src="scored") + \
        ",\ntest_scored AS (SELECT * FROM scored_split WHERE split = 'test')"


def _mean_shift_sql() -> str:
    base = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_pop({c}) AS std FROM li_base" for c in DRIFT_NUM)
    live = " UNION ALL ".join(f"SELECT '{c}' AS feature, avg({c}) AS live_mean FROM li_live" for c in DRIFT_NUM)
    return f"""
np AS ({base}),
lm AS ({live}),
ms AS (SELECT feature, 'numeric' AS type,
              round(CASE WHEN sh IS NULL OR isnan(sh) THEN NULL WHEN sh > 2.0 THEN 2.0 ELSE sh END, 4) AS drift_score,
              round(mean, 3) AS baseline_mean, round(live_mean, 3) AS live_mean
       FROM (SELECT np.feature, mean, live_mean, abs(live_mean - mean) / (std + 1e-9) AS sh
             FROM np JOIN lm USING (feature)))"""


def _props(src: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n, "
        f"count(*) / sum(count(*)) OVER () AS p FROM {src} WHERE {c} IS NOT NULL GROUP BY 2" for c in cols)


def _psi_sql() -> str:
    return f"""
cp AS ({_props('li_base', DRIFT_CAT)}),
lp AS ({_props('li_live', DRIFT_CAT)}),
pt AS (SELECT cp.feature, cp.value, greatest(cp.p, 1e-4) AS base_p, coalesce(lp.p, 1e-4) AS live_p
       FROM cp LEFT JOIN lp ON cp.feature = lp.feature AND cp.value = lp.value),
psi AS (SELECT feature, 'categorical' AS type,
               round(abs(sum((live_p - base_p) * ln(live_p / base_p))), 4) AS drift_score,
               CAST(NULL AS DOUBLE) AS baseline_mean, CAST(NULL AS DOUBLE) AS live_mean
        FROM pt GROUP BY feature)"""


def _report_sql() -> str:
    return W(DRIFT, _mean_shift_sql(), _psi_sql(), """
rep AS (SELECT *, CASE WHEN drift_score > 0.2 THEN 'Drifted' ELSE 'OK' END AS status
        FROM (SELECT * FROM ms UNION ALL SELECT * FROM psi))""")


def _js_sql(base: str, live: str, num, cat) -> str:
    ctes = []
    shares = []
    for c in num:
        ctes.append(f"mm_{c} AS (SELECT min({c}) AS lo, max({c}) AS hi, (max({c}) - min({c})) / 10 AS w FROM {base})")
        binexpr = (f"CASE WHEN {c} < lo THEN -1 WHEN {c} > hi THEN 10 WHEN w = 0 THEN 0 "
                   f"ELSE CAST(least(floor(({c} - lo) / w), 9) AS INTEGER) END")
        for side, src in (("p", base), ("q", live)):
            ctes.append(f"{side}_{c} AS (SELECT '{c}' AS feature, CAST({binexpr} AS VARCHAR) AS bin, count(*) AS n "
                        f"FROM {src}, mm_{c} WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)) GROUP BY 2)")
        shares.append((c, "numeric"))
    for c in cat:
        for side, src in (("p", base), ("q", live)):
            ctes.append(f"{side}_{c} AS (SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS bin, count(*) AS n "
                        f"FROM {src} WHERE {c} IS NOT NULL GROUP BY 2)")
        shares.append((c, "categorical"))
    joins = []
    for c, kind in shares:
        joins.append(
            f"SELECT '{c}' AS feature, '{kind}' AS type, "
            f"coalesce(p.n / (SELECT sum(n) FROM p_{c}), 0.0) AS p, coalesce(q.n / (SELECT sum(n) FROM q_{c}), 0.0) AS q "
            f"FROM p_{c} p FULL OUTER JOIN q_{c} q ON p.bin = q.bin")
    ctes.append("sh AS (" + " UNION ALL ".join(joins) + ")")
    ctes.append("""js AS (SELECT feature, type, round(0.5 * sum(
                 CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0.0 END +
                 CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0.0 END), 10) AS js
               FROM sh GROUP BY feature, type)""")
    return ",\n".join(ctes)


ORACLES: dict[str, str] = {}

# ------------------------------------------------------------ 2.1 sources
_CSV_BACK = f"""SELECT {_na('customer_id')} AS customer_id, {_na('name')} AS name, {_na('nation')} AS nation,
       {_na('acctbal_text')} AS acctbal_text, {_na('segment')} AS segment FROM ctext"""
ORACLES["scan_csv"] = W(CUSTOMER_TEXT) + _CSV_BACK
ORACLES["scan_parquet"] = "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem"
ORACLES["sink_curated"] = W(CUSTOMER_TEXT) + f"""
SELECT customer_id, name, nation, {_coerce('acctbal_text')} AS acctbal, segment FROM ctext"""
ORACLES["sink_splits"] = W(CHURN_SPLIT) + "SELECT c_custkey, churn, split FROM churn_split"
ORACLES["sink_train_val_dirs"] = W(CHURN_SPLIT) + \
    "SELECT c_custkey, churn, split FROM churn_split WHERE split IN ('train', 'val')"

_TRAIN_NULLS = CHURN_NULLS + ",\ntr AS (SELECT * FROM nulls_split WHERE split = 'train')"
_FILLS = _TRAIN_NULLS + f",\nfills AS ({_fills('tr')}),\ntr_filled AS ({_filled('tr', 'fills')})"
ORACLES["sink_fitted_state"] = W(_FILLS) + _encoders("tr_filled", CATS)
ORACLES["scan_fitted_state"] = W(_FILLS) + "SELECT col_name, round(num_fill, 6) AS num_fill, cat_fill FROM fills"
ORACLES["sink_inference_log"] = W(LOG) + \
    "SELECT model, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, count(*) AS n FROM log GROUP BY ALL"
ORACLES["scan_inference_log"] = W(LOG) + """SELECT id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS ts, model,
       prediction, probability, risk_level FROM log"""
ORACLES["scan_baseline"] = W(DRIFT) + \
    f"SELECT feature, value, round(p, 10) AS p FROM ({_props('li_base', DRIFT_CAT)})"

_PAYLOAD = """
pay AS (SELECT event_id AS request_id, event_type, user_id, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS value
        FROM events)"""
ORACLES["parse_score_payload"] = W(_PAYLOAD) + """
SELECT request_id, 0 AS row_idx, CAST(user_id AS DOUBLE) AS user_id, value FROM pay WHERE event_type <> 'click'"""
ORACLES["error_rows"] = W(_PAYLOAD) + """
SELECT request_id, 'missing ''data''' AS error FROM pay WHERE event_type = 'click'"""

# ------------------------------------------------------- 2.2 projections/DQ
_EXPECTED = ["c_custkey", "c_name", "c_address", "c_nationkey", "c_phone", "c_acctbal", "c_mktsegment"]
ORACLES["dq_required_columns"] = "SELECT e.column_name, CAST(e.ordinal AS INTEGER) AS ordinal, " \
    "c.column_name IS NOT NULL AS present FROM (VALUES " + \
    ", ".join(f"('{c}', {i + 1})" for i, c in enumerate(_EXPECTED)) + \
    ") e(column_name, ordinal) LEFT JOIN (SELECT column_name FROM (DESCRIBE customer)) c " \
    "ON c.column_name = e.column_name"

_CONTRACT = [("c_custkey", False), ("c_name", False), ("c_nationkey", False), ("c_acctbal", False),
             ("c_mktsegment", True)]


def _null_long(src: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null FROM {src}" for c in cols)


ORACLES["dq_null_rate"] = W(CUSTOMER_NULLS) + f"""
SELECT column_name, n_rows, n_null, round(CAST(n_null AS DOUBLE) / n_rows, 10) AS null_rate, nullable,
       coalesce(NOT nullable AND CAST(n_null AS DOUBLE) / n_rows > 0.05, false) AS violation
FROM ({_null_long('cnull', [c for c, _ in _CONTRACT])}) JOIN (VALUES {', '.join(f"('{c}', {str(n).lower()})"
                                                                                for c, n in _CONTRACT)})
     t(cn, nullable) ON cn = column_name"""
ORACLES["coerce_numeric"] = W(CUSTOMER_TEXT) + \
    f"SELECT CAST(customer_id AS BIGINT) AS c_custkey, {_coerce('acctbal_text')} AS acctbal FROM ctext"
ORACLES["map_binary"] = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0
       END AS status_code FROM orders"""
ORACLES["drop_columns"] = "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer"
ORACLES["split_target"] = W(CHURN_BASE) + """SELECT c_mktsegment, n_name, c_acctbal, n_orders, tenure,
       round(total, 6) AS total, CAST(churn AS INTEGER) AS label FROM churn_base"""
ORACLES["select_features"] = W(CHURN_BASE) + """SELECT c_custkey, c_mktsegment, n_name, tenure, round(total, 6) AS total,
       n_orders, c_acctbal FROM churn_base"""
ORACLES["fill_nulls_fit"] = W(_FILLS) + "SELECT col_name, round(num_fill, 6) AS num_fill, cat_fill FROM fills"

_NUM6 = ", ".join(f"round({c}, 6) AS {c}" for c in NUMS)
ORACLES["fill_nulls_apply"] = W(_FILLS, f"allf AS ({_filled('nulls_split', 'fills')})") + \
    f"SELECT c_custkey, split, c_mktsegment, n_name, {_NUM6} FROM allf"
ORACLES["impute_self"] = W(CHURN_NULLS, f"fills AS ({_fills('churn_nulls')})",
                           f"allf AS ({_filled('churn_nulls', 'fills')})") + \
    f"SELECT c_custkey, c_mktsegment, n_name, {_NUM6} FROM allf"

_PART_TEXT = """
pt AS (SELECT p_partkey, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part)"""
_PCAT = ["p_brand", "p_type", "p_size"]
ORACLES["label_encode_fit"] = W(_PART_TEXT) + _encoders("pt", _PCAT)
_PART_ENC = W(_PART_TEXT, f"enc AS ({_encoders('(SELECT * FROM pt WHERE CAST(p_size AS INTEGER) <= 40)', _PCAT)})")
ORACLES["label_encode_apply"] = _PART_ENC + _codes("pt", "enc", _PCAT)
ORACLES["join_encoder_lookup"] = ORACLES["label_encode_apply"]

_TRAIN = CHURN_SPLIT + ",\ntr AS (SELECT * FROM churn_split WHERE split = 'train')"
ORACLES["standard_scale_fit"] = W(_TRAIN, f"sc AS ({_scaler('tr')})") + \
    "SELECT col_name, round(mean, 6) AS mean, round(scale, 6) AS scale FROM sc"
ORACLES["standard_scale_apply"] = W(_TRAIN, f"sc AS ({_scaler('tr')})") + \
    f"SELECT c_custkey, split, {', '.join(NUMS)} FROM ({_scaled('churn_split', 'sc')})"
ORACLES["join_param_cross"] = W(_FILLS, f"sc AS ({_scaler('tr_filled')})",
                                f"allf AS ({_filled('nulls_split', 'fills')})") + \
    f"SELECT c_custkey, split, {', '.join(NUMS)} FROM ({_scaled('allf', 'sc')})"
ORACLES["union_splits_apply"] = W(_FILLS, f"sc AS ({_scaler('tr_filled')})", f"enc AS ({_encoders('tr_filled', CATS)})",
                                  f"allf AS ({_filled('nulls_split', 'fills')})",
                                  f"coded AS ({_codes('allf', 'enc', CATS)})") + \
    f"SELECT c_custkey, split, {', '.join(CATS)}, {', '.join(NUMS)}, churn FROM ({_scaled('coded', 'sc')})"

ORACLES["threshold_predict"] = W(SCORED) + \
    "SELECT c_custkey, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM scored"
ORACLES["risk_band"] = W(SCORED) + """SELECT c_custkey, score, CASE WHEN score >= 0.7 THEN 'High'
       WHEN score >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_level FROM scored"""
ORACLES["pred_label_map"] = W(SCORED) + \
    "SELECT c_custkey, CASE WHEN score >= 0.5 THEN 'Churn' ELSE 'Stay' END AS label FROM scored"
ORACLES["range_check"] = W(CHURN_BASE) + """
SELECT c_custkey, v AS violations, v = '' AS accepted FROM (
  SELECT c_custkey, concat_ws(',',
    CASE WHEN tenure IS NULL THEN 'tenure:missing' END, CASE WHEN tenure < 0 THEN 'tenure:below' END,
    CASE WHEN tenure > 72 THEN 'tenure:above' END,
    CASE WHEN c_acctbal IS NULL THEN 'c_acctbal:missing' END, CASE WHEN c_acctbal < 0 THEN 'c_acctbal:below' END,
    CASE WHEN n_orders IS NULL THEN 'n_orders:missing' END, CASE WHEN n_orders < 1 THEN 'n_orders:below' END,
    CASE WHEN n_orders > 30 THEN 'n_orders:above' END,
    CASE WHEN total IS NULL THEN 'total:missing' END, CASE WHEN total < 0 THEN 'total:below' END) AS v
  FROM churn_base)"""
ORACLES["code_dictionary"] = """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
       WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 3 WHEN '5-LOW' THEN 4 END AS priority_code FROM orders"""
ORACLES["drift_status"] = _report_sql() + """
SELECT count(*) AS n_features, count(*) FILTER (WHERE drift_score > 0.2) AS n_drifted,
       coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drift_score > 0.2), '') AS drifted,
       CASE WHEN count(*) FILTER (WHERE drift_score > 0.2) = 0
            THEN 'No drift detected - all ' || count(*) || ' features within threshold (0.2)'
            ELSE 'Drift detected in ' || count(*) FILTER (WHERE drift_score > 0.2) || ' feature(s): ' ||
                 string_agg(feature, ', ' ORDER BY feature) FILTER (WHERE drift_score > 0.2) END AS message
FROM rep"""

# ---------------------------------------------------------------- 2.3 joins
ORACLES["join_psi"] = W(DRIFT, _psi_sql()) + \
    "SELECT feature, value, round(base_p, 10) AS base_p, round(live_p, 10) AS live_p FROM pt"
_METRICS3 = W(_test_scored(), _auc_by_model("test_scored", ["score", "score_tenure", "score_orders"]), REGISTRY)
ORACLES["join_champion"] = _METRICS3 + """
SELECT name, round(cand_roc_auc, 10) AS cand_roc_auc, round(cand_f1, 10) AS cand_f1,
       round(cand_precision, 10) AS cand_precision, round(cand_recall, 10) AS cand_recall,
       round(prod_roc_auc, 10) AS prod_roc_auc, round(prod_f1, 10) AS prod_f1,
       round(prod_precision, 10) AS prod_precision, round(prod_recall, 10) AS prod_recall, has_production
FROM champ"""
ORACLES["promote_decision"] = _METRICS3 + """
SELECT name, version, round(cand_roc_auc, 10) AS cand_roc_auc, round(prod_roc_auc, 10) AS prod_roc_auc,
       has_production, round(auc_delta, 10) AS auc_delta, promote FROM dec"""
ORACLES["promote_transition"] = _METRICS3 + """
SELECT v.name, v.version,
       CASE WHEN coalesce(d.promote, false) AND v.version = d.version THEN 'production'
            WHEN coalesce(d.promote, false) AND v.stage = 'production' THEN 'archived'
            ELSE v.stage END AS stage,
       round(v.roc_auc, 10) AS roc_auc
FROM versions v LEFT JOIN dec d USING (name)"""
ORACLES["latest_version"] = _METRICS3 + """
SELECT name, max(version) AS version, max(version) FILTER (WHERE stage = 'production') AS production_version
FROM versions GROUP BY name"""
ORACLES["best_run"] = W(_test_scored(), _auc_by_model("test_scored", ["score", "score_tenure", "score_orders"])) + """
SELECT 'churn' AS experiment, model_key AS run_id, round(roc_auc, 10) AS auc_weighted FROM met
WHERE roc_auc IS NOT NULL ORDER BY roc_auc DESC, model_key LIMIT 1"""

# --------------------------------------------------------- 2.4 aggregations
_CN_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
ORACLES["agg_null_rate"] = W(CUSTOMER_NULLS) + \
    f"SELECT column_name, round(CAST(n_null AS DOUBLE) / n_rows, 10) AS null_rate FROM ({_null_long('cnull', _CN_COLS)})"
ORACLES["agg_null_count"] = W(CUSTOMER_NULLS) + \
    f"SELECT column_name, n_null FROM ({_null_long('cnull', _CN_COLS)})"
ORACLES["agg_median"] = W(CHURN_BASE) + \
    f"SELECT feature, round(median, 6) AS median FROM ({_median_union('churn_base', NUMS)})"
ORACLES["agg_mode"] = W(_PART_TEXT) + _mode_union("pt", _PCAT)
ORACLES["agg_distinct_sorted"] = W(_PART_TEXT) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM pt WHERE {c} IS NOT NULL GROUP BY 2"
    for c in ["p_brand", "p_type"])
ORACLES["agg_row_counts"] = W(CHURN_SPLIT) + """
SELECT (SELECT count(*) FROM orders) AS rows_loaded, (SELECT count(DISTINCT o_custkey) +
        max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) FROM orders) AS rows_saved,
       (SELECT count(*) FROM orders) - (SELECT count(DISTINCT o_custkey) +
        max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) FROM orders) AS duplicates_dropped,
       (SELECT count(*) FROM churn_split WHERE split = 'train') AS n_train,
       (SELECT count(*) FROM churn_split WHERE split = 'val') AS n_val,
       (SELECT count(*) FROM churn_split WHERE split = 'test') AS n_test"""
ORACLES["agg_mean_std_profile"] = W(DRIFT) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM li_base"
    for c in DRIFT_NUM)
ORACLES["agg_value_proportions"] = W(DRIFT) + \
    f"SELECT feature, value, n, round(p, 10) AS p FROM ({_props('li_base', DRIFT_CAT)})"
ORACLES["agg_daily_rate"] = W(LOG) + """SELECT CAST(timestamp AS DATE) AS date, model,
       round(avg(prediction), 10) AS churn_rate FROM log GROUP BY ALL"""
ORACLES["agg_daily_volume"] = W(LOG) + "SELECT CAST(timestamp AS DATE) AS date, model, count(*) AS n FROM log GROUP BY ALL"
ORACLES["pivot_rate"] = W(LOG) + "SELECT CAST(timestamp AS DATE) AS date, " + ", ".join(
    f"round(avg(prediction) FILTER (WHERE model = '{m}'), 10) AS \"{m}\"" for m in MODELS) + " FROM log GROUP BY 1"
ORACLES["pivot_volume"] = W(LOG) + "SELECT CAST(timestamp AS DATE) AS date, " + ", ".join(
    f"count(*) FILTER (WHERE model = '{m}') AS \"{m}\"" for m in MODELS) + " FROM log GROUP BY 1"
ORACLES["agg_risk_distribution"] = W(LOG) + "SELECT model, risk_level, count(*) AS n FROM log GROUP BY ALL"
ORACLES["agg_avg_probability"] = W(LOG) + \
    "SELECT model, round(avg(probability), 4) AS avg_probability FROM log GROUP BY model"
ORACLES["agg_log_summary"] = W(LOG) + "SELECT count(*) AS total, " + ", ".join(
    f"count(*) FILTER (WHERE model = '{m}') AS n_{m}" for m in MODELS) + \
    ", round(avg(prediction), 10) AS churn_rate FROM log"
ORACLES["agg_batch_rate"] = W(SCORED) + """SELECT count(*) AS n_inputs,
       round(avg(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END), 10) AS positive_rate FROM scored"""
ORACLES["class_weights"] = W(CHURN_BASE) + """SELECT churn AS label, count(*) AS n,
       round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 10) AS weight
FROM churn_base GROUP BY churn"""
ORACLES["pos_weight"] = W(CHURN_BASE) + \
    "SELECT c_custkey, churn, CASE WHEN churn = 1 THEN 3.0 ELSE 1.0 END AS weight FROM churn_base"
_CONF = W(SCORED, """
cc AS (SELECT count(*) FILTER (WHERE churn = 1 AND score >= 0.5) AS tp,
              count(*) FILTER (WHERE churn <> 1 AND score >= 0.5) AS fp,
              count(*) FILTER (WHERE churn = 1 AND score < 0.5) AS fn,
              count(*) FILTER (WHERE churn <> 1 AND score < 0.5) AS tn FROM scored)""")
ORACLES["confusion_matrix"] = _CONF + """
SELECT 0 AS actual, 0 AS predicted, tn AS n FROM cc UNION ALL SELECT 0, 1, fp FROM cc
UNION ALL SELECT 1, 0, fn FROM cc UNION ALL SELECT 1, 1, tp FROM cc"""


def _d(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


ORACLES["precision_recall_f1"] = _CONF + f"""
SELECT tp, fp, fn, tn, round({_d('tp', 'tp + fp')}, 10) AS precision, round({_d('tp', 'tp + fn')}, 10) AS recall,
       round({_d('2 * tp', '2 * tp + fp + fn')}, 10) AS f1 FROM cc"""
ORACLES["classification_report"] = _CONF + f""",
w AS (SELECT {_d('tn', 'tn + fn')} AS p0, {_d('tn', 'tn + fp')} AS r0, {_d('2 * tn', '2 * tn + fn + fp')} AS f0,
             tn + fp AS s0, {_d('tp', 'tp + fp')} AS p1, {_d('tp', 'tp + fn')} AS r1,
             {_d('2 * tp', '2 * tp + fp + fn')} AS f1, tp + fn AS s1, {_d('tp + tn', 'tp + fp + fn + tn')} AS acc,
             tp + fp + fn + tn AS n FROM cc)
SELECT class_label, round(precision, 10) AS precision, round(recall, 10) AS recall, round(f1, 10) AS f1, support
FROM (SELECT '0' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM w
      UNION ALL SELECT '1', p1, r1, f1, s1 FROM w
      UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM w
      UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM w
      UNION ALL SELECT 'weighted avg', CASE WHEN n = 0 THEN 0.0 ELSE (p0 * s0 + p1 * s1) / n END,
                       CASE WHEN n = 0 THEN 0.0 ELSE (r0 * s0 + r1 * s1) / n END,
                       CASE WHEN n = 0 THEN 0.0 ELSE (f0 * s0 + f1 * s1) / n END, n FROM w)"""
ORACLES["roc_auc"] = W(SCORED, _auc_by_model("scored", ["score", "score_tenure", "score_orders"])) + \
    "SELECT model_key, round(roc_auc, 10) AS roc_auc, n_pos, n_neg FROM met"
ORACLES["auc_weighted"] = W(SCORED, _auc_by_model("scored", ["score"])) + \
    "SELECT round(roc_auc, 10) AS auc_weighted FROM met"

# ----------------------------------------------------------- 2.6 sort/top-k
ORACLES["sort_newest_first"] = W(LOG) + """SELECT id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS ts, model, probability
FROM log ORDER BY timestamp DESC NULLS LAST, id DESC"""
ORACLES["recent_topk"] = W(LOG) + """SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, model,
       CASE WHEN prediction = 1 THEN 'Churn' WHEN prediction = 0 THEN 'Stay' END AS prediction, probability, risk_level
FROM log ORDER BY log.timestamp DESC NULLS LAST, id DESC LIMIT 20"""
ORACLES["drift_ranking"] = _report_sql() + "SELECT feature, type, drift_score, status FROM rep " \
    "ORDER BY drift_score DESC NULLS LAST, feature"

# -------------------------------------------------------------- 2.7 dedup
ORACLES["dedup_keep_first"] = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1"""
ORACLES["union_logs"] = W(LOG) + "SELECT id, model, prediction FROM log"

# ------------------------------------------------------------- 2.8 scalars
ORACLES["scalar_ts_format"] = W(LOG) + """SELECT id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS ts_display,
       strftime(timestamp, '%Y/%m/%d') AS ts_path FROM log"""
ORACLES["scalar_json_roundtrip"] = """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(to_json({'k': CAST(json_extract(props, '$.k') AS INTEGER)}) AS VARCHAR) AS props_out FROM events"""

# --------------------------------------------------------------- 2.9 split
ORACLES["stratified_split"] = ORACLES["sink_splits"]

# -------------------------------------------------------------- 2.11 drift
ORACLES["drift_mean_shift"] = W(DRIFT, _mean_shift_sql()) + "SELECT * FROM ms"
ORACLES["drift_psi"] = W(DRIFT, _psi_sql()) + "SELECT feature, type, drift_score FROM psi"
ORACLES["drift_report"] = _report_sql() + "SELECT * FROM rep"
ORACLES["drift_js_divergence"] = W(DRIFT, _js_sql("li_base", "li_live", DRIFT_NUM, DRIFT_CAT)) + \
    "SELECT feature, type, js, CASE WHEN js > 0.2 THEN 'Drifted' ELSE 'OK' END AS status FROM js"
ORACLES["drift_prediction"] = W(LOG, """
lb AS (SELECT * FROM log WHERE timestamp < TIMESTAMP '2024-01-16'),
ll AS (SELECT * FROM log WHERE timestamp >= TIMESTAMP '2024-01-16')""",
                                _js_sql("lb", "ll", ["probability"], ["risk_level"])) + \
    "SELECT feature, type, js, CASE WHEN js > 0.2 THEN 'Drifted' ELSE 'OK' END AS status FROM js"
_DQ_NUM = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 'numeric' AS kind, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
    f"count(*) FILTER (WHERE {c} < (SELECT min({c}) FROM li_base) OR {c} > (SELECT max({c}) FROM li_base)) "
    f"AS n_out_of_range FROM li_live" for c in DRIFT_NUM)
_DQ_CAT = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 'categorical' AS kind, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
    f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM li_base WHERE {c} IS NOT NULL)) "
    f"AS n_out_of_range FROM li_live" for c in DRIFT_CAT)
ORACLES["dq_production"] = W(DRIFT) + f"""
SELECT feature, kind, n_rows, n_null, n_out_of_range,
       round(CASE WHEN n_rows > 0 THEN CAST(n_null AS DOUBLE) / n_rows END, 10) AS null_rate,
       round(CASE WHEN n_rows > 0 THEN CAST(n_out_of_range AS DOUBLE) / n_rows END, 10) AS out_of_range_rate,
       false AS type_violation
FROM ({_DQ_NUM} UNION ALL {_DQ_CAT})"""
ORACLES["baseline_profile"] = W(DRIFT) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(NULL AS VARCHAR) AS value, round(avg({c}), 6) AS mean, "
    f"round(stddev_pop({c}), 6) AS std, CAST(NULL AS DOUBLE) AS p FROM li_base" for c in DRIFT_NUM) + \
    " UNION ALL SELECT feature, value, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), round(p, 10) FROM (" + \
    _props("li_base", DRIFT_CAT) + ")"

# ---------------------------------------------------------- 2.12 streaming
ORACLES["stream_daily_rate"] = ORACLES["agg_daily_rate"]

# ------------------------------------------- deterministic jobs and streams
ORACLES["auto_featurize"] = W(CHURN_BASE) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{k}' AS kind, count(DISTINCT {c}) AS n_distinct FROM churn_base"
    for c, k in [("c_mktsegment", "categorical"), ("n_name", "categorical"), ("c_acctbal", "numeric"),
                 ("n_orders", "numeric"), ("tenure", "numeric"), ("total", "numeric")])
ORACLES["job_ingest"] = W(CHURN_BASE) + """
SELECT count(*) AS rows_saved, count(*) FILTER (WHERE c_custkey % 10 = 0) AS null_total,
       sum(churn) AS churned, count(*) AS rows_loaded FROM churn_base"""
ORACLES["job_prepare"] = W(CHURN_SPLIT) + "SELECT split, churn, count(*) AS n FROM churn_split GROUP BY ALL"
ORACLES["stream_drift"] = _report_sql() + "SELECT 0 AS batch_id, feature, type, drift_score, status FROM rep"
ORACLES["job_monitor"] = W(LOG, "live AS (SELECT * FROM log WHERE timestamp >= TIMESTAMP '2024-01-16')") + """
SELECT 'summary' AS table_name, 1 AS n_rows
UNION ALL SELECT 'daily_rate', count(DISTINCT (CAST(timestamp AS DATE), model)) FROM live
UNION ALL SELECT 'daily_volume', count(DISTINCT (CAST(timestamp AS DATE), model)) FROM live
UNION ALL SELECT 'pivot_rate', count(DISTINCT CAST(timestamp AS DATE)) FROM live
UNION ALL SELECT 'pivot_volume', count(DISTINCT CAST(timestamp AS DATE)) FROM live
UNION ALL SELECT 'risk', count(DISTINCT (model, risk_level)) FROM live
UNION ALL SELECT 'avg_probability', count(DISTINCT model) FROM live
UNION ALL SELECT 'recent', least(count(*), 20) FROM live
UNION ALL SELECT 'drift', 2"""

_DAY = "CAST(CAST(timestamp AS DATE) AS VARCHAR)"
ORACLES["job_dashboard"] = W(LOG, """
base AS (SELECT * FROM log WHERE timestamp < TIMESTAMP '2024-01-16'),
live AS (SELECT * FROM log WHERE timestamp >= TIMESTAMP '2024-01-16'),
shares AS (SELECT greatest(b.p, 0.0001) AS bp, coalesce(l.p, 0.0001) AS lp
           FROM (SELECT k, count(*) / (SELECT count(k) FROM base) AS p FROM base WHERE k IS NOT NULL GROUP BY k) b
           LEFT JOIN (SELECT k, count(*) / (SELECT count(k) FROM live) AS p FROM live WHERE k IS NOT NULL GROUP BY k) l
           ON b.k = l.k),
drift AS (SELECT 'value|numeric' AS f, round(least(abs((SELECT avg(value) FROM live) - avg(value))
                                                   / (stddev_pop(value) + 1e-9), 2.0), 4) AS s FROM base
          UNION ALL SELECT 'k|categorical', round(abs(sum((lp - bp) * ln(lp / bp))), 4) FROM shares),
newest AS (SELECT * FROM log ORDER BY timestamp DESC NULLS LAST, id DESC LIMIT 20)""") + f"""
SELECT 'summary' AS table_name, 'all' AS key, 'total' AS metric, CAST(count(*) AS DOUBLE) AS value FROM log
UNION ALL SELECT 'summary', 'all', 'churn_rate', round(avg(prediction), 10) FROM log
UNION ALL SELECT 'daily_rate', {_DAY} || '|' || model, 'churn_rate', round(avg(prediction), 10) FROM log GROUP BY 2
UNION ALL SELECT 'daily_volume', {_DAY} || '|' || model, 'n', count(*) FROM log GROUP BY 2
UNION ALL SELECT 'risk', model || '|' || risk_level, 'n', count(*) FROM log GROUP BY 2
UNION ALL SELECT 'avg_probability', model, 'avg_probability', round(avg(probability), 4) FROM log GROUP BY 2
UNION ALL SELECT 'recent', strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '|' || model || '|' ||
                 CASE prediction WHEN 1 THEN 'Churn' ELSE 'Stay' END || '|' || risk_level, 'probability',
                 round(probability, 10) FROM newest
UNION ALL SELECT 'drift', f || '|' || CASE WHEN s > 0.2 THEN 'Drifted' ELSE 'OK' END, 'drift_score', s FROM drift
""" + "".join(f"""UNION ALL SELECT 'summary', 'all', 'n_{m}', count(*) FILTER (WHERE model = '{m}') FROM log
UNION ALL SELECT 'pivot_rate', {_DAY}, '{m}', round(avg(prediction) FILTER (WHERE model = '{m}'), 10) FROM log GROUP BY 2
UNION ALL SELECT 'pivot_volume', {_DAY}, '{m}', count(*) FILTER (WHERE model = '{m}') FROM log GROUP BY 2
""" for m in MODELS)


# ------------------- stored models, runs, reports and scored requests
_TEST_KEYS = "SELECT c_custkey, true AS {flag}{more} FROM nulls_split WHERE split = 'test'"
ORACLES["sink_model"] = W(CHURN_NULLS) + _TEST_KEYS.format(flag="same_score", more="")
ORACLES["scan_model"] = W(CHURN_NULLS) + _TEST_KEYS.format(flag="same_score", more=", CAST(5 AS BIGINT) AS n_trees")
ORACLES["ensemble_vote"] = W(CHURN_NULLS) + _TEST_KEYS.format(flag="same_vote", more="")
ORACLES["ensemble_stack"] = W(CHURN_NULLS) + _TEST_KEYS.format(flag="same_score", more="")
ORACLES["batch_score"] = W(CHURN_NULLS) + " UNION ALL ".join(
    _TEST_KEYS.format(flag="consistent", more=f", '{m}' AS model") for m in ("logreg", "boosted"))
ORACLES["train_logreg"] = W(CHURN_NULLS) + """
SELECT t.term, (SELECT count(*) FROM nulls_split WHERE split = 'train') AS n_rows, true AS at_optimum
FROM (VALUES ('c_mktsegment'), ('n_name'), ('tenure'), ('total'), ('n_orders'), ('c_acctbal'), ('(intercept)')) t(term)"""
_VAL_SCORED = SCORED + "," + SPLIT_OF.format(name="scored_split", src="scored") + \
    ",\nval_scored AS (SELECT * FROM scored_split WHERE split = 'val')"
ORACLES["sink_run_metrics"] = W(_VAL_SCORED, _auc_by_model("val_scored", ["score_tenure"])) + """
SELECT 'churn-tenure' AS run_id, 'manual' AS experiment, '1.0' AS C, '6' AS n_features, round(roc_auc, 10) AS roc_auc,
       round(f1, 10) AS f1, round(precision, 10) AS precision, round(recall, 10) AS recall,
       (SELECT CAST(count(*) AS DOUBLE) FROM scored_split WHERE split = 'train') AS n_train,
       (SELECT CAST(count(*) AS DOUBLE) FROM scored_split WHERE split = 'val') AS n_val FROM met"""
ORACLES["sink_eval_report"] = _METRICS3 + "SELECT name AS registered_model, promote, " + ", ".join(
    f"round({a}_{m}, 10) AS {b}_{m}" for a, b in (("cand", "candidate"), ("prod", "production"))
    for m in ("roc_auc", "f1", "precision", "recall")) + " FROM dec"
_RULES = [("tenure", 0, 72), ("c_acctbal", 0, None), ("n_orders", 1, 30), ("total", 0, None)]
ORACLES["stream_score"] = W(CHURN_NULLS) + f"""
SELECT c_custkey AS id, CASE WHEN error = '' THEN 'scored' ELSE 'rejected' END AS outcome,
       CASE WHEN error = '' THEN 'logreg' END AS model, nullif(error, '') AS error, CASE WHEN error = '' THEN true END AS as_trained
FROM (SELECT c_custkey, CASE WHEN c_custkey % 23 = 0 THEN 'body is not a JSON object'
                             WHEN c_custkey % 31 = 0 THEN 'no data rows'
                             WHEN c_custkey % 29 = 0 THEN 'row width differs from columns'
                             ELSE concat_ws(',', {", ".join(
    f"CASE WHEN {c} IS NULL THEN '{c}:missing' END, CASE WHEN {c} < {lo} THEN '{c}:below' END"
    + (f", CASE WHEN {c} > {hi} THEN '{c}:above' END" if hi is not None else "") for c, lo, hi in _RULES)}) END AS error
      FROM churn_nulls)"""
_PERMUTED = ["tenure", "n_orders", "total", "c_acctbal"]


def _permutation_sql() -> str:
    cols = ", ".join(f"""coalesce(lag({c}) OVER p_{c}, last_value({c}) OVER (ORDER BY md5('42:{c}:' || CAST(c_custkey AS VARCHAR)), c_custkey
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS p_{c}""" for c in _PERMUTED)
    windows = ", ".join(f"p_{c} AS (ORDER BY md5('42:{c}:' || CAST(c_custkey AS VARCHAR)), c_custkey)" for c in _PERMUTED)
    score = "{n} * 0.125 + {t} * 0.0625 - {o} / 1048576.0"
    names = {"tenure": "t", "n_orders": "n", "total": "o"}

    def of(f: str | None) -> str:
        return score.format(**{v: (f"p_{k}" if k == f else k) for k, v in names.items()})
    scores = ", ".join([f"CAST({of(None)} AS DOUBLE) AS s_"] + [f"CAST({of(f)} AS DOUBLE) AS s_{f}" for f in _PERMUTED])
    drift = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(least(abs((SELECT avg({c}) FROM churn_base WHERE c_custkey % 2 <> 0) - avg({c}))"
        f" / (stddev_pop({c}) + 1e-9), 2.0), 4) AS drift_score FROM churn_base WHERE c_custkey % 2 = 0" for c in _PERMUTED)
    return W(CHURN_BASE, f"moved AS (SELECT *, {cols} FROM churn_base WINDOW {windows})", f"perm AS (SELECT churn, {scores} FROM moved)",
             _auc_by_model("perm", ["s_"] + [f"s_{f}" for f in _PERMUTED]),
             """imp AS (SELECT substr(m.model_key, 3) AS feature, b.roc_auc AS base_auc, m.roc_auc AS auc, b.roc_auc - m.roc_auc AS importance
        FROM met m, met b WHERE b.model_key = 's_' AND m.model_key <> 's_')""", f"shift AS ({drift})",
             "top AS (SELECT feature FROM imp ORDER BY importance DESC, feature LIMIT 2)") + """
SELECT i.feature, round(base_auc, 10) AS base_auc, round(auc, 10) AS auc, round(importance, 10) AS importance,
       CASE WHEN t.feature IS NOT NULL THEN s.drift_score END AS drift_score
FROM imp i JOIN shift s USING (feature) LEFT JOIN top t ON t.feature = i.feature"""


ORACLES["permutation_importance"] = _permutation_sql()
_BROKEN = {
    "c_mktsegment:missing": "c_mktsegment IS NULL", "n_name:missing": "n_name IS NULL", "tenure:missing": "tenure IS NULL",
    "tenure:above": "tenure > 60", "c_acctbal:below": "c_acctbal < 0", "n_orders:above": "n_orders > 20",
    "c_mktsegment:unknown": "coalesce(c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'), true)"}
_ALLOWED = {"c_mktsegment:missing": 0.05, "n_name:missing": 0.1}
ORACLES["dq_rules"] = W(CHURN_NULLS) + "SELECT rule, n_rows, n_violations, round(n_violations / n_rows, 10) AS share, " \
    "coalesce(n_violations / n_rows > allowed, false) AS failed FROM (" + " UNION ALL ".join(
        f"SELECT '{k}' AS rule, count(*) AS n_rows, count(*) FILTER (WHERE {v}) AS n_violations, "
        f"CAST({_ALLOWED.get(k, 'NULL')} AS DOUBLE) AS allowed FROM churn_nulls" for k, v in _BROKEN.items()) + ")"
ORACLES["dq_rejected"] = W(CHURN_NULLS) + "SELECT * FROM (SELECT c_custkey, concat_ws(',', " + ", ".join(
    f"CASE WHEN {v} THEN '{k}' END" for k, v in _BROKEN.items() if k not in _ALLOWED) + ") AS violations FROM churn_nulls) WHERE violations <> ''"
ORACLES["job_manual"] = """SELECT 'churn' AS name, 4 AS version, true AS has_production, false AS promote, CAST(4 AS BIGINT) AS n_versions, 2 AS production_version"""
ORACLES["job_retrain"] = """SELECT 'churn' AS name, 2 AS version, true AS has_production, false AS promote, CAST(2 AS BIGINT) AS n_versions, 1 AS production_version"""
ORACLES["job_search"] = """SELECT 'churn' AS name, 1 AS version, false AS has_production, true AS promote, CAST(3 AS BIGINT) AS n_trials, CAST(1 AS BIGINT) AS n_finished"""


def oracles() -> dict[str, str]:
    return dict(ORACLES)
