"""Reference SQL for the registered queries (DuckDB dialect).

The driver's tables are views of the same names. Each statement derives
its inputs with the same rules as `wardstat.sources.derived` and computes
the operator independently of Spark, with the same output column names;
doubles are rounded to 6 decimals like `catalog.finish`.
"""

from __future__ import annotations

import json

from wardstat.functions.numeric import NUMBER_PATTERN
from wardstat.functions.trees import number_sql, probability_sql
from wardstat.operators.boosting import Booster
from wardstat.operators.drift import BINS as DRIFT_BINS
from wardstat.operators.drift import FLOOR as DRIFT_FLOOR
from wardstat.plans.model import SERVING_MODEL
from wardstat.schemas import (
    AGGREGATE_FEATURES, DISCHARGE_COLUMNS, EXCESS_COLUMNS, FEATURE_TABLE_COLUMNS, ID_COLUMNS,
    MEASURE_CODES, MEASURE_FEATURES, MODEL_FEATURES, PREDICTED_COLUMNS, RAW_FIELDS, RAW_NUMERIC,
    REQUEST_BOUNDS, SERVING_FEATURES, STATES, TARGET, TIERS, WIDE_MEASURE_COLUMNS, METRIC_SUFFIX,
    MEASURES,
)

DIGITS = 6
STATES_SQL = "[" + ", ".join(f"'{s}'" for s in STATES) + "]"
MEASURE_IN = ", ".join(f"'{c}'" for c in MEASURE_CODES)
DOUBLE_FEATURES = set(WIDE_MEASURE_COLUMNS) | {
    "mean_excess_ratio", "max_excess_ratio", "min_excess_ratio",
    "mean_predicted_rate", "total_discharges"}


def r(expr: str, name: str | None = None, digits: int = DIGITS) -> str:
    out = f"round({expr}, {digits})"
    return f"{out} AS {name}" if name else out


def d(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def num(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{NUMBER_PATTERN}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


def tier(s: str) -> str:
    return (f"CASE WHEN {s} IS NULL THEN NULL WHEN {s} >= {d(0.65)} THEN 'high' "
            f"WHEN {s} >= {d(0.40)} THEN 'medium' ELSE 'low' END")


def cnt(cols: list[str]) -> str:
    return "(" + " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in cols) + ")"


def above(cols: list[str], t: float) -> str:
    return "(" + " + ".join(f"(CASE WHEN {c} > {d(t)} THEN 1 ELSE 0 END)" for c in cols) + ")"


def ssum(cols: list[str]) -> str:
    return "(" + " + ".join(f"coalesce({c}, {d(0.0)})" for c in cols) + ")"


def mean(cols: list[str]) -> str:
    return f"CASE WHEN {cnt(cols)} > 0 THEN {ssum(cols)} / {cnt(cols)} END"


def sel(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(r(c, c) if c in doubles else c for c in cols)


# ---------------------------------------------------------------------------
# Derived inputs
# ---------------------------------------------------------------------------

def _measure_case(ln: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(MEASURE_CODES, start=1))
    return f"CASE {ln} {whens} WHEN 7 THEN 'READM-30-UNKNOWN-HRRP' END"


_SUP = "((l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_linenumber <= 3) OR c.c_custkey % 97 = 0)"
_ST = f"{STATES_SQL}[n.n_nationkey * 2 + 1]"

RAW = f"""raw AS (
  SELECT
    lpad(CAST(c.c_custkey AS VARCHAR), 6, '0') AS facility_id,
    CASE WHEN c.c_custkey % 50 = 0 AND l.l_linenumber = 1 THEN NULL ELSE c.c_name END AS facility_name,
    CASE WHEN n.n_nationkey = 7 THEN NULL WHEN n.n_nationkey = 3 THEN lower({_ST}) ELSE {_ST} END AS state,
    {_measure_case('l.l_linenumber')} AS measure_name,
    CASE WHEN l.l_quantity < 3 OR c.c_custkey % 97 = 0 THEN 'Too Few to Report'
         ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS number_of_discharges,
    '' AS footnote,
    CASE WHEN {_SUP} THEN 'N/A' ELSE CAST(CAST({d(0.70037)} + 5 * l.l_discount + l.l_tax AS DECIMAL(8,5)) AS VARCHAR) END
      AS excess_readmission_ratio,
    CASE WHEN {_SUP} THEN 'N/A' ELSE CAST(CAST(10 + 20 * l.l_discount + 50 * l.l_tax AS DECIMAL(6,2)) AS VARCHAR) END
      AS predicted_readmission_rate,
    CASE WHEN {_SUP} THEN 'N/A' ELSE CAST(CAST(12 + 10 * l.l_discount + 20 * l.l_tax AS DECIMAL(6,2)) AS VARCHAR) END
      AS expected_readmission_rate,
    '20' AS number_of_readmissions,
    '07/01/2021' AS start_date,
    '06/30/2024' AS end_date,
    l.l_orderkey, l.l_linenumber
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

_SHORT = "CASE measure_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MEASURE_CODES.items()) + " END"
_COERCED = ", ".join(f"{num(c)} AS {c}" for c in RAW_NUMERIC)
_TEXT = ", ".join(c for c in RAW_FIELDS if c not in RAW_NUMERIC)

COERCED = f"coerced AS (SELECT {_TEXT}, {_COERCED} FROM raw)"
CLEAN = f"cln AS (SELECT *, {_SHORT} AS measure_short FROM coerced WHERE measure_name IN ({MEASURE_IN}))"

_PIVOT = ", ".join(
    f"avg(CASE WHEN measure_short = '{m}' THEN {rawc} END) AS {m}_{suf}"
    for rawc, suf in METRIC_SUFFIX.items() for m in MEASURES)
WIDE = f"""wide0 AS (
  SELECT facility_id, min(facility_name) AS facility_name, min(state) AS state, {_PIVOT}
  FROM cln WHERE facility_id IS NOT NULL GROUP BY facility_id
), wide AS (
  SELECT * FROM wide0 WHERE coalesce({', '.join(WIDE_MEASURE_COLUMNS)}) IS NOT NULL
)"""


def _aggs(null_counts: bool) -> dict[str, str]:
    n_valid = f"CAST({cnt(EXCESS_COLUMNS)} AS BIGINT)"
    n_over = f"CAST({above(EXCESS_COLUMNS, 1.0)} AS BIGINT)"
    if null_counts:
        n_valid = f"CASE WHEN {cnt(EXCESS_COLUMNS)} > 0 THEN {n_valid} END"
        n_over = f"CASE WHEN {cnt(EXCESS_COLUMNS)} > 0 THEN {n_over} END"
    return {
        "mean_excess_ratio": mean(EXCESS_COLUMNS),
        "max_excess_ratio": f"greatest({', '.join(EXCESS_COLUMNS)})",
        "min_excess_ratio": f"least({', '.join(EXCESS_COLUMNS)})",
        "n_measures_over_threshold": n_over,
        "n_valid_measures": n_valid,
        "mean_predicted_rate": mean(PREDICTED_COLUMNS),
        "total_discharges": f"CASE WHEN {cnt(DISCHARGE_COLUMNS)} > 0 THEN {ssum(DISCHARGE_COLUMNS)} END",
    }


AGG = "agg AS (SELECT *, " + ", ".join(f"{e} AS {k}" for k, e in _aggs(False).items()) + " FROM wide)"
ENC = ("enc AS (SELECT *, CAST(dense_rank() OVER (ORDER BY coalesce(state, 'Unknown')) - 1 AS INTEGER)"
       " AS state_encoded FROM agg)")
FEAT = (f"feat AS (SELECT {', '.join(c for c in FEATURE_TABLE_COLUMNS if c != TARGET)}, "
        f"CAST(mean_excess_ratio > {d(1.0)} AS INTEGER) AS {TARGET} FROM enc WHERE mean_excess_ratio IS NOT NULL)")


def _req_col(c: str) -> str:
    rid = "CAST(facility_id AS BIGINT)"
    if c == "state":
        return f"CASE WHEN {rid} % 43 = 0 THEN 'XYZ' ELSE state END AS state"
    if c == "ami_excess_ratio":
        return f"CASE WHEN {rid} % 37 = 0 THEN NULL WHEN {rid} % 31 = 0 THEN {d(99.9)} ELSE {c} END AS {c}"
    if c in EXCESS_COLUMNS:
        return f"CASE WHEN {rid} % 37 = 0 THEN NULL ELSE {c} END AS {c}"
    if c == "hf_discharges":
        return f"CASE WHEN {rid} % 41 = 0 THEN {d(-1.0)} ELSE {c} END AS {c}"
    return c


REQ = "req AS (SELECT " + ", ".join(_req_col(c) for c in ID_COLUMNS + MEASURE_FEATURES) + " FROM wide)"

_SCORE = f"round(least(value, {d(100)}) / {d(100)}, 4)"
LOG = f"""log AS (
  SELECT event_id AS id, ts AS timestamp,
    lpad(CAST(user_id AS VARCHAR), 6, '0') AS facility_id,
    'Hospital ' || CAST(user_id AS VARCHAR) AS facility_name,
    CASE WHEN user_id % 11 = 0 THEN NULL ELSE {STATES_SQL}[user_id % 54 + 1] END AS state,
    CASE WHEN event_id % 101 = 0 THEN 'not json' ELSE props END AS input_features,
    {_SCORE} AS risk_score,
    {tier(_SCORE)} AS risk_level,
    CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'v1' ELSE 'v2' END AS model_version
  FROM events
)"""

SCORED = (f"scored AS (SELECT facility_id, {TARGET} AS label, round(least({d(1.0)}, greatest({d(0.0)}, "
          f"(ami_excess_ratio - {d(0.70037)}) / {d(0.58)})), 3) AS score FROM feat "
          f"WHERE ami_excess_ratio IS NOT NULL)")

SPLIT = f"""rk AS (
  SELECT facility_id, {TARGET},
    row_number() OVER (PARTITION BY {TARGET} ORDER BY md5(facility_id || ':42'), facility_id) AS rn,
    count(*) OVER (PARTITION BY {TARGET}) AS n_label
  FROM feat
), split AS (
  SELECT facility_id, {TARGET},
    CASE WHEN rn <= ceil(n_label * {d(0.2)}) THEN 'test' ELSE 'train' END AS split,
    CASE WHEN rn <= ceil(n_label * {d(0.2)}) THEN NULL
         ELSE CAST((rn - ceil(n_label * {d(0.2)}) - 1) % 5 AS INTEGER) END AS fold
  FROM rk
)"""

FOLD_SCORED = "fscored AS (SELECT s.facility_id, s.label, s.score, f.fold FROM scored s JOIN split f ON s.facility_id = f.facility_id WHERE f.split = 'train')"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE_FEAT = (RAW, COERCED, CLEAN, WIDE, AGG, ENC, FEAT)


def _auc_sql(src: str, by: list[str]) -> str:
    byc = ", ".join(by)
    part = f"PARTITION BY {byc} " if by else ""
    lead = f"{byc}, " if by else ""
    return f"""ps AS (
  SELECT {lead}score, CAST(count_if(label = 1) AS DOUBLE) AS pos, CAST(count_if(label <> 1) AS DOUBLE) AS neg
  FROM {src} GROUP BY {lead}score
), run AS (
  SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
  FROM ps
), auc AS (
  SELECT {lead}CASE WHEN sum(pos) > 0 AND sum(neg) > 0
    THEN sum(pos * (neg_below + neg * 0.5)) / (sum(pos) * sum(neg)) END AS auc
  FROM run {('GROUP BY ' + byc) if by else ''}
)"""


def _confusion(src: str) -> str:
    return f"""cm AS (
  SELECT CAST(count_if(score >= {d(0.5)} AND label = 1) AS BIGINT) AS tp,
         CAST(count_if(score >= {d(0.5)} AND label <> 1) AS BIGINT) AS fp,
         CAST(count_if(score < {d(0.5)} AND label = 1) AS BIGINT) AS fn,
         CAST(count_if(score < {d(0.5)} AND label <> 1) AS BIGINT) AS tn,
         avg(pow(score - CAST(label AS DOUBLE), 2)) AS brier_score
  FROM {src}
)"""


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE {d(0.0)} END"


def _bounds(c: str):
    for suf, b in REQUEST_BOUNDS.items():
        if c.endswith(suf):
            return b
    return (None, None)


def _req_error_terms() -> list[str]:
    terms = []
    for c in MEASURE_FEATURES:
        lo, hi = _bounds(c)
        conds = []
        if lo is not None:
            conds.append(f"{c} < {d(lo)}")
        if hi is not None:
            conds.append(f"{c} > {d(hi)}")
        conds.append(f"isnan({c})")
        terms.append(f"CASE WHEN {c} IS NOT NULL AND ({' OR '.join(conds)}) THEN '{c}_out_of_range' END")
    terms.append("CASE WHEN length(state) > 2 THEN 'state_too_long' END")
    terms.append(f"CASE WHEN coalesce({', '.join(EXCESS_COLUMNS)}) IS NULL THEN 'no_excess_ratio' END")
    return terms


REQ_ERR = "reqerr AS (SELECT *, concat_ws(';', " + ", ".join(_req_error_terms()) + ") AS errors FROM req)"


def _serving_state(s: str) -> str:
    whens = " ".join(f"WHEN '{st}' THEN {i}" for i, st in enumerate(STATES))
    return f"CAST(coalesce(CASE upper({s}) {whens} END, 0) AS INTEGER)"


def _clip(c: str) -> str:
    lo, hi = _bounds(c)
    e = c
    if lo is not None:
        e = f"greatest({e}, {d(lo)})"
    if hi is not None:
        e = f"least({e}, {d(hi)})"
    return f"CASE WHEN {c} IS NOT NULL AND NOT isnan({c}) THEN {e} END"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    raw_cols = ", ".join(RAW_FIELDS)

    q["scan_raw"] = with_(RAW) + f"SELECT {raw_cols} FROM raw"
    q["ingest_pages"] = q["scan_raw"]
    q["ingest_stream"] = q["scan_raw"]
    q["ingest_capped_then_full"] = q["scan_raw"]
    q["serving_vocabulary"] = with_(*BASE_FEAT) + (
        "SELECT DISTINCT coalesce(enc.state, 'Unknown') AS state_key, enc.state_encoded, f.state_encoded AS trained "
        "FROM enc LEFT JOIN (SELECT DISTINCT coalesce(state, 'Unknown') AS k, state_encoded FROM feat) f "
        "ON f.k = coalesce(enc.state, 'Unknown')")
    q["ingest_capped"] = with_(RAW) + (
        f"SELECT {raw_cols} FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS rn FROM raw) "
        f"WHERE ((rn - 1) // 500) * 500 < 1200")
    q["page_source"] = q["page_source_stream"] = q["scan_raw"]
    q["page_source_capped"] = q["ingest_capped"]
    q["coerce_numeric"] = with_(RAW, COERCED) + f"SELECT {sel(RAW_FIELDS, set(RAW_NUMERIC))} FROM coerced"
    q["known_measures"] = with_(RAW) + f"SELECT {raw_cols} FROM raw WHERE measure_name IN ({MEASURE_IN})"
    q["measure_short"] = with_(RAW, COERCED, CLEAN) + (
        f"SELECT {sel(RAW_FIELDS + ['measure_short'], set(RAW_NUMERIC))} FROM cln")
    wide_cols = ID_COLUMNS + WIDE_MEASURE_COLUMNS
    q["pivot_wide"] = with_(RAW, COERCED, CLEAN, WIDE) + f"SELECT {sel(wide_cols, DOUBLE_FEATURES)} FROM wide"
    q["wide_with_meta"] = q["pivot_wide"]
    q["facility_meta"] = with_(RAW, COERCED, CLEAN) + (
        "SELECT facility_id, min(facility_name) AS facility_name, min(state) AS state "
        "FROM cln WHERE facility_id IS NOT NULL GROUP BY facility_id")
    q["ingest_report"] = with_(RAW) + (
        f"SELECT count(*) AS n_rows, CAST({len(RAW_FIELDS)} AS BIGINT) AS n_columns, "
        f"'{','.join(RAW_FIELDS)}' AS columns, count(DISTINCT facility_id) AS n_hospitals FROM raw")

    agg_cols = wide_cols + AGGREGATE_FEATURES
    q["aggregate_features"] = with_(RAW, COERCED, CLEAN, WIDE, AGG) + f"SELECT {sel(agg_cols, DOUBLE_FEATURES)} FROM agg"
    q["encode_state"] = with_(RAW, COERCED, CLEAN, WIDE, AGG, ENC) + "SELECT facility_id, state, state_encoded FROM enc"
    q["labelled"] = with_(*BASE_FEAT) + f"SELECT facility_id, {r('mean_excess_ratio', 'mean_excess_ratio')}, {TARGET} FROM feat"
    q["feature_table"] = with_(*BASE_FEAT) + f"SELECT {sel(FEATURE_TABLE_COLUMNS, DOUBLE_FEATURES)} FROM feat"
    q["feature_build"] = q["feature_table"]
    q["model_input"] = with_(*BASE_FEAT) + f"SELECT {sel(MODEL_FEATURES, DOUBLE_FEATURES)} FROM feat"

    q["state_codes"] = with_(RAW, COERCED, CLEAN, WIDE, REQ) + (
        f"SELECT facility_id, state, {_serving_state('state')} AS state_code FROM req")
    serving = _aggs(True)
    assembled = ["facility_id"] + [f"{r(d(c))} AS {c}" for c in MEASURE_FEATURES]
    assembled += [f"{r(d(serving[c]))} AS {c}" for c in AGGREGATE_FEATURES]
    assembled += [f"{r(d(_serving_state('state')))} AS state_encoded"]
    q["assemble_features"] = with_(RAW, COERCED, CLEAN, WIDE, REQ) + f"SELECT {', '.join(assembled)} FROM req"
    asm = dict(zip(["facility_id"] + SERVING_FEATURES, assembled))
    q["align_features"] = with_(RAW, COERCED, CLEAN, WIDE, REQ) + (
        "SELECT " + ", ".join(asm[c] for c in ["facility_id"] + MODEL_FEATURES) + " FROM req")

    q["class_balance"] = with_(*BASE_FEAT) + (
        f"SELECT count(*) AS n, CAST(coalesce(sum({TARGET}), 0) AS BIGINT) AS positives, "
        f"CAST(count_if({TARGET} = 0) AS BIGINT) AS negatives, "
        f"{r(f'avg(CAST({TARGET} AS DOUBLE))', 'positive_rate')} FROM feat")
    q["class_weight"] = with_(*BASE_FEAT, SPLIT) + (
        f"SELECT CAST(count_if({TARGET} = 0) AS BIGINT) AS negatives, CAST(count_if({TARGET} = 1) AS BIGINT) AS positives, "
        f"CASE WHEN count_if({TARGET} = 1) > 0 THEN round(CAST(count_if({TARGET} = 0) AS DOUBLE) / count_if({TARGET} = 1), 4) "
        f"ELSE {d(1.0)} END AS scale_pos_weight FROM split WHERE split = 'train'")
    comp_cols = [c for c in FEATURE_TABLE_COLUMNS if c not in ("facility_id", "facility_name", "state", TARGET)]
    q["completeness"] = with_(*BASE_FEAT) + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) AS total, "
        f"{r(f'CASE WHEN count(*) > 0 THEN count({c}) * {d(100.0)} / count(*) END', 'pct_non_null')} FROM feat"
        for c in comp_cols)

    from wardstat.operators.features import feature_descriptions
    dim = " UNION ALL ".join("SELECT '{}' AS column_name, '{}' AS description".format(
        f, t.replace("'", "''")) for f, t in feature_descriptions())
    comp = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) AS total, "
        f"{r(f'CASE WHEN count(*) > 0 THEN count({c}) * {d(100.0)} / count(*) END', 'pct_non_null')} FROM feat"
        for c in comp_cols)
    q["feature_dictionary"] = with_(*BASE_FEAT, f"comp AS ({comp})", f"dim AS ({dim})") + (
        "SELECT c.column_name, c.non_null, c.total, c.pct_non_null, coalesce(d.description, '') AS description "
        "FROM comp c LEFT JOIN dim d ON c.column_name = d.column_name")

    rules = []
    for c in ["facility_id", "state_encoded", "mean_excess_ratio", "n_valid_measures", TARGET]:
        rules.append(("not_null", c, f"CAST(count_if({c} IS NULL) AS DOUBLE)", 0.0, 0.0))
    for c, (lo, hi) in {"mean_excess_ratio": (0.1, 3.0), "max_excess_ratio": (0.1, 3.0),
                        "mean_predicted_rate": (0.0, 50.0), "n_valid_measures": (1.0, 6.0)}.items():
        rules.append(("min_in_range", c, f"CAST(min({c}) AS DOUBLE)", lo, hi))
        rules.append(("max_in_range", c, f"CAST(max({c}) AS DOUBLE)", lo, hi))
    rules.append(("label_binary", TARGET, f"CAST(count_if({TARGET} NOT IN (0, 1) OR {TARGET} IS NULL) AS DOUBLE)", 0.0, 0.0))
    body = "\nUNION ALL\n".join(
        f"SELECT '{a}' AS rule, '{c}' AS column_name, {e} AS observed, {d(lo)} AS lo, {d(hi)} AS hi FROM feat"
        for a, c, e, lo, hi in rules)
    q["validate_features"] = with_(*BASE_FEAT, f"rules AS ({body})") + (
        "SELECT rule, column_name, round(observed, 6) AS observed, round(lo, 6) AS lo, round(hi, 6) AS hi, "
        "(observed IS NOT NULL AND observed >= lo AND observed <= hi) AS ok FROM rules")

    q["observed_rules"], q["observed_completeness"] = q["validate_features"], q["completeness"]

    req_cols = ID_COLUMNS + MEASURE_FEATURES
    reqd = set(MEASURE_FEATURES)
    q["scorable_rows"] = with_(RAW, COERCED, CLEAN, WIDE, REQ) + (
        f"SELECT {sel(req_cols, reqd)} FROM req WHERE coalesce({', '.join(EXCESS_COLUMNS)}) IS NOT NULL")
    q["validate_requests"] = with_(RAW, COERCED, CLEAN, WIDE, REQ, REQ_ERR) + (
        f"SELECT {sel(req_cols, reqd)} FROM reqerr WHERE errors = ''")
    q["rejected_requests"] = with_(RAW, COERCED, CLEAN, WIDE, REQ, REQ_ERR) + (
        "SELECT facility_id, errors FROM reqerr WHERE errors <> ''")
    q["clip_to_bounds"] = with_(RAW, COERCED, CLEAN, WIDE, REQ) + (
        "SELECT " + ", ".join(ID_COLUMNS + [r(_clip(c), c) for c in MEASURE_FEATURES]) + " FROM req")
    q["score_csv"] = with_(RAW, COERCED, CLEAN, WIDE, REQ) + f"SELECT {sel(req_cols, reqd)} FROM req"

    q["stratified_split"] = with_(*BASE_FEAT, SPLIT) + f"SELECT facility_id, {TARGET}, split FROM split"
    q["stratified_folds"] = with_(*BASE_FEAT, SPLIT) + (
        f"SELECT facility_id, {TARGET}, fold FROM split WHERE split = 'train'")
    q["sample_rows"] = with_(RAW, COERCED, CLEAN, WIDE, REQ) + (
        f"SELECT {sel(req_cols, reqd)} FROM req WHERE coalesce({', '.join(EXCESS_COLUMNS)}) IS NOT NULL "
        "ORDER BY md5(facility_id || ':42'), facility_id LIMIT 100")

    q["binary_metrics"] = with_(*BASE_FEAT, SCORED, _confusion("scored")) + (
        "SELECT tp, fp, fn, tn, " + r(ratio("tp", "tp + fp"), "precision") + ", "
        + r(ratio("tp", "tp + fn"), "recall") + ", " + r(ratio("2 * tp", "2 * tp + fp + fn"), "f1")
        + ", " + r("brier_score", "brier_score") + " FROM cm")
    q["roc_auc"] = with_(*BASE_FEAT, SCORED, _auc_sql("scored", [])) + "SELECT round(auc, 6) AS auc FROM auc"
    per = (f"per AS (SELECT {ratio('tp', 'tp + fp')} AS p1, {ratio('tp', 'tp + fn')} AS r1, "
           f"{ratio('2 * tp', '2 * tp + fp + fn')} AS f1_1, tp + fn AS s1, "
           f"{ratio('tn', 'tn + fn')} AS p0, {ratio('tn', 'tn + fp')} AS r0, "
           f"{ratio('2 * tn', '2 * tn + fn + fp')} AS f1_0, tn + fp AS s0, "
           f"{ratio('tp + tn', 'tp + fp + fn + tn')} AS acc, tp + fp + fn + tn AS n FROM cm)")
    w0, w1 = "(CAST(s0 AS DOUBLE) / n)", "(CAST(s1 AS DOUBLE) / n)"
    rows = [
        ("'Low Risk'", "p0", "r0", "f1_0", "s0"),
        ("'High Risk'", "p1", "r1", "f1_1", "s1"),
        ("'accuracy'", "NULL", "NULL", "acc", "n"),
        ("'macro avg'", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f1_0 + f1_1) / 2", "n"),
        ("'weighted avg'", f"p0 * {w0} + p1 * {w1}", f"r0 * {w0} + r1 * {w1}", f"f1_0 * {w0} + f1_1 * {w1}", "n"),
    ]
    q["classification_report"] = with_(*BASE_FEAT, SCORED, _confusion("scored"), per) + "\nUNION ALL\n".join(
        f"SELECT {a} AS class_name, {r(d(b))} AS precision, {r(d(c))} AS recall, {r(d(e))} AS f1, "
        f"CAST({s} AS BIGINT) AS support FROM per" for a, b, c, e, s in rows)
    band = lambda v: f"CASE WHEN {v} >= {d(0.75)} THEN 'good' WHEN {v} >= {d(0.5)} THEN 'fair' ELSE 'poor' END"
    mt = ("mt AS (SELECT 'auc' AS metric, auc AS value FROM auc UNION ALL "
          f"SELECT 'f1', {ratio('2 * tp', '2 * tp + fp + fn')} FROM cm UNION ALL "
          f"SELECT 'precision', {ratio('tp', 'tp + fp')} FROM cm UNION ALL "
          f"SELECT 'recall', {ratio('tp', 'tp + fn')} FROM cm UNION ALL "
          "SELECT 'brier_score', brier_score FROM cm)")
    q["metric_bands"] = with_(*BASE_FEAT, SCORED, _confusion("scored"), _auc_sql("scored", []), mt) + (
        f"SELECT metric, round(value, 6) AS value, {band('value')} AS band FROM mt")
    q["fold_auc"] = with_(*BASE_FEAT, SCORED, SPLIT, FOLD_SCORED, _auc_sql("fscored", ["fold"])) + (
        "SELECT fold, round(auc, 6) AS auc FROM auc")
    q["cv_summary"] = with_(*BASE_FEAT, SCORED, SPLIT, FOLD_SCORED, _auc_sql("fscored", ["fold"])) + (
        "SELECT count(*) AS n_folds, round(avg(auc), 6) AS cv_auc_mean, round(stddev_pop(auc), 6) AS cv_auc_std FROM auc")

    q["risk_level"] = with_(LOG) + f"SELECT id, round(risk_score, 6) AS risk_score, {tier('risk_score')} AS tier FROM log"
    q["recent_predictions"] = with_(LOG) + (
        "SELECT id, timestamp, facility_id, facility_name, state, round(risk_score, 6) AS risk_score, "
        "risk_level, model_version FROM log ORDER BY timestamp DESC, id DESC LIMIT 100")
    ok = "(CASE WHEN json_valid(input_features) THEN json_type(input_features) = 'OBJECT' ELSE false END)"
    q["parse_features"] = with_(LOG) + (
        f"SELECT id, {ok} AS parsed_ok, "
        f"round(CASE WHEN {ok} THEN CAST(json_extract(CASE WHEN json_valid(input_features) THEN input_features END, '$.k') AS DOUBLE) END, 6) AS k_value, "
        f"CASE WHEN NOT {ok} THEN input_features END AS raw_features FROM log")
    whole = "id % 97 <> 0"
    second = "round(1 - risk_score, 4)"
    q["decoded_features"] = with_(LOG) + (
        f"SELECT id, {whole} AS ok, CASE WHEN {whole} THEN state END AS site_state, "
        f"CASE WHEN {whole} THEN round({second}, 6) END AS second_score, "
        f"CASE WHEN {whole} AND id % 2 = 0 THEN round(risk_score, 6) END AS score, "
        f"CASE WHEN {whole} THEN facility_id END AS code, CASE WHEN {whole} THEN id % 3 = 0 END AS flag, "
        f"CASE WHEN NOT ({whole}) THEN '{{\"code\": \"' || facility_id END AS text FROM log")
    kinds = {"site": "object", "scores": "array", "code": "text", "flag": "boolean"}
    q["feature_profile"] = with_(LOG) + " UNION ALL ".join(
        [f"SELECT '{k}' AS key, '{kind}' AS kind, count(*) AS n, CAST(NULL AS DOUBLE) AS mean_value, "
         f"CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value FROM log WHERE {whole} HAVING count(*) > 0"
         for k, kind in kinds.items()]
        + ["SELECT 'score', 'number', count(*), round(avg(risk_score), 6), round(min(risk_score), 6), "
           f"round(max(risk_score), 6) FROM log WHERE {whole} AND id % 2 = 0 AND risk_score IS NOT NULL HAVING count(*) > 0"])
    q["score_series"] = with_(LOG) + (
        f"SELECT timestamp, round(risk_score, 6) AS risk_score, CAST(round(CAST(risk_score AS DECIMAL(20,10)) * 100, 1) AS DOUBLE) AS risk_pct, "
        f"{tier('risk_score')} AS band FROM log ORDER BY timestamp")
    q["log_round_trip"] = with_(LOG + ", twice AS (SELECT * FROM log UNION ALL SELECT * FROM log)") + (
        f"SELECT count(*) AS total, round(coalesce(round(avg(risk_score), 4), {d(0.0)}), 6) AS mean_risk_score, "
        "CAST(count_if(risk_level = 'high') AS BIGINT) AS high_count, "
        "CAST(count_if(risk_level = 'medium') AS BIGINT) AS medium_count, "
        "CAST(count_if(risk_level = 'low') AS BIGINT) AS low_count FROM twice")
    q["prediction_stats"] = with_(LOG) + (
        f"SELECT count(*) AS total, round(coalesce(round(avg(risk_score), 4), {d(0.0)}), 6) AS mean_risk_score, "
        "CAST(count_if(risk_level = 'high') AS BIGINT) AS high_count, "
        "CAST(count_if(risk_level = 'medium') AS BIGINT) AS medium_count, "
        "CAST(count_if(risk_level = 'low') AS BIGINT) AS low_count FROM log")
    dim = " UNION ALL ".join(f"SELECT '{t}' AS risk_level, CAST({i} AS INTEGER) AS tier_order"
                             for i, t in enumerate(TIERS))
    q["risk_distribution"] = with_(LOG, f"dim AS ({dim})",
                                   "cnt AS (SELECT risk_level, count(*) AS n FROM log GROUP BY risk_level)") + (
        "SELECT d.risk_level, d.tier_order, CAST(coalesce(c.n, 0) AS BIGINT) AS n "
        "FROM dim d LEFT JOIN cnt c ON d.risk_level = c.risk_level ORDER BY d.tier_order")
    q["state_risk"] = with_(LOG, "g AS (SELECT state, avg(risk_score) AS mean_risk, count(*) AS n FROM log "
                                 "WHERE state IS NOT NULL GROUP BY state)") + (
        "SELECT state, round(mean_risk, 6) AS mean_risk, n FROM (SELECT *, count(*) OVER () AS k FROM g) WHERE k >= 2")
    q["daily_risk"] = with_(LOG) + (
        "SELECT date_trunc('day', timestamp) AS window_start, date_trunc('day', timestamp) + INTERVAL 1 DAY AS window_end, "
        "count(*) AS n, round(avg(risk_score), 6) AS mean_risk_score, "
        "CAST(count_if(risk_level = 'high') AS BIGINT) AS high_count, "
        "CAST(count_if(risk_level = 'medium') AS BIGINT) AS medium_count, "
        "CAST(count_if(risk_level = 'low') AS BIGINT) AS low_count "
        "FROM log GROUP BY 1, 2")
    q["committed_log_states"] = with_(LOG, "g AS (SELECT state, avg(risk_score) AS mean_risk, count(*) AS n FROM log "
                                           "WHERE state IS NOT NULL GROUP BY state)") + (
        "SELECT state, n, round(mean_risk * n, 4) AS score_total FROM (SELECT *, count(*) OVER () AS k FROM g) WHERE k >= 2")
    for committed, same in (("stats", "prediction_stats"), ("history", "recent_predictions"), ("windows", "daily_risk")):
        q[f"committed_log_{committed}"] = q[same]
    q["batch_summary"] = with_(LOG) + (
        "SELECT CAST(timestamp AS DATE) AS log_date, count(*) AS total, "
        "CAST(count_if(risk_level = 'high') AS BIGINT) AS high_risk_count, "
        "round(round(avg(round(risk_score, 4)), 4), 6) AS mean_risk_score, "
        "count(*) - CAST(count_if(risk_level = 'high') AS BIGINT) AS low_medium_count FROM log GROUP BY 1")
    q["results_export"] = with_(LOG) + (
        'SELECT facility_id AS "Facility ID", facility_name AS "Hospital Name", '
        'round(risk_score, 6) AS "Risk Score", risk_level AS "Risk Level" FROM log')
    rs = f"(risk_score * {d(1.25)} - {d(0.05)})"
    q["normalise_scores"] = with_(LOG, f"x AS (SELECT id, facility_id, {rs} AS raw_score FROM log)",
                                  "g AS (SELECT facility_id, min(raw_score) AS lo, max(raw_score) AS hi FROM x GROUP BY facility_id)") + (
        f"SELECT x.id, x.facility_id, round(CASE WHEN g.lo < {d(0.0)} OR g.hi > {d(1.0)} "
        f"THEN 1.0 / (1.0 + exp(-x.raw_score)) ELSE x.raw_score END, 6) AS score "
        "FROM x JOIN g ON x.facility_id = g.facility_id")
    q.update(_model_queries())
    return q


def _json(cols: list[str]) -> str:
    """JSON object of the columns that are not NULL, as text."""
    return "'{' || concat_ws(',', " + ", ".join(f"""'"{c}":' || CAST({d(c)} AS VARCHAR)""" for c in cols) + ") || '}'"


def _model_queries() -> dict[str, str]:
    """Scores of the serving model, split gains and drift."""
    q: dict[str, str] = {}
    with open(SERVING_MODEL) as f:
        model = json.load(f)
    booster = Booster.from_json(json.dumps(model["booster"]))
    serving = _aggs(True)
    code = "CASE coalesce(state, 'Unknown') " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in model["vocabulary"].items()) + " ELSE -1 END"
    asm = (f"asm AS (SELECT {', '.join(ID_COLUMNS)}, {_json(MEASURE_FEATURES)} AS input_features, "
           + ", ".join([f"{d(c)} AS {c}" for c in MEASURE_FEATURES] + [f"{d(serving[c])} AS {c}" for c in AGGREGATE_FEATURES])
           + f", {d(code)} AS state_encoded FROM reqerr WHERE errors = '')")
    prob = f"prob AS (SELECT {', '.join(ID_COLUMNS)}, input_features, {probability_sql(booster)} AS p FROM asm)"
    sent = f"sent AS (SELECT {', '.join(ID_COLUMNS)}, {', '.join(r(c, c) for c in MEASURE_FEATURES)} FROM req)"
    base = with_(RAW, COERCED, CLEAN, WIDE, REQ, sent, REQ_ERR.replace("FROM req)", "FROM sent)"), asm, prob)
    ids, version = ", ".join(ID_COLUMNS), model["version"]
    q["score_batch"] = base + (f"SELECT {ids}, round(round(p, 4), 6) AS risk_score, {tier('p')} AS risk_level, "
                               f"'{version}' AS model_version FROM prob")
    q["batch_guard_summary"] = base + (
        f"SELECT count(*) AS total, CAST(count_if(p >= {d(0.65)}) AS BIGINT) AS high_risk_count, "
        "round(round(avg(round(p, 4)), 4), 6) AS mean_risk_score, "
        f"count(*) - CAST(count_if(p >= {d(0.65)}) AS BIGINT) AS low_medium_count FROM prob")
    q["prediction_log_rows"] = base + (
        f"SELECT {ids}, input_features, round(p, 6) AS risk_score, {tier('p')} AS risk_level, '{version}' AS model_version, "
        "'batch' AS source_id, CAST(1 AS BIGINT) AS batch_id FROM prob")
    q["features_json"] = with_(RAW, COERCED, CLEAN, WIDE, REQ, sent) + f"SELECT facility_id, {_json(MEASURE_FEATURES)} AS input_features FROM sent"

    from wardstat.plans.catalog import DRIFT_UNTIL, ROOT_CUTS, ROOT_PARAMS
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x, {d(0.5)} - {TARGET} AS g, {d(0.25)} AS h FROM feat" for c in EXCESS_COLUMNS)
    cuts = ", ".join(number_sql(c) for c in ROOT_CUTS)
    alpha, lam, least = (number_sql(ROOT_PARAMS[k]) for k in ("reg_alpha", "reg_lambda", "min_child_weight"))

    def score(g: str, h: str) -> str:
        t = f"greatest(abs({g}) - {alpha}, 0e0)"
        return f"{t} * {t} / ({h} + {lam})"
    q["root_splits"] = with_(
        *BASE_FEAT, f"long AS ({long})", f"cuts AS (SELECT unnest([{cuts}]) AS c)",
        "side AS (SELECT feature, c, miss, sum(g) AS g, sum(h) AS h, "
        "coalesce(sum(g) FILTER (x < c OR (miss AND x IS NULL)), 0e0) AS gl, "
        "coalesce(sum(h) FILTER (x < c OR (miss AND x IS NULL)), 0e0) AS hl "
        "FROM long, cuts, (SELECT unnest([false, true]) AS miss) GROUP BY feature, c, miss)",
        f"gains AS (SELECT feature, c, miss, {score('gl', 'hl')} + {score('(g - gl)', '(h - hl)')} - {score('g', 'h')} AS gain "
        f"FROM side WHERE hl >= {least} AND h - hl >= {least})") + (
        "SELECT feature, round(c, 6) AS threshold, miss AS missing_left, round(gain, 6) AS gain FROM gains "
        "QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, c, miss) = 1")

    bins = range(DRIFT_BINS)
    win = ("win AS (SELECT date_trunc('day', timestamp) AS window_start, date_trunc('day', timestamp) + INTERVAL 1 DAY AS window_end, "
           "count(*) AS n, " + ", ".join(f"count_if(b = {i}) AS c{i}" for i in bins)
           + f" FROM (SELECT *, greatest(0, least({DRIFT_BINS - 1}, CAST(floor(risk_score * {DRIFT_BINS}) AS INTEGER))) AS b "
             "FROM log WHERE risk_score IS NOT NULL) GROUP BY 1, 2)")
    ref = ("ref AS (SELECT sum(n) AS rn, " + ", ".join(f"sum(c{i}) AS r{i}" for i in bins)
           + f" FROM win WHERE window_end <= TIMESTAMP '{DRIFT_UNTIL}' HAVING sum(n) > 0)")
    share = [(f"greatest({d(f'c{i}')} / n, {DRIFT_FLOOR})", f"greatest({d(f'r{i}')} / rn, {DRIFT_FLOOR})") for i in bins]
    psi = " + ".join(f"({a} - {e}) * ln({a} / {e})" for a, e in share)
    gaps = ", ".join("abs(({}) / {} - ({}) / {})".format(
        " + ".join(d(f"c{j}") for j in range(i + 1)), "n", " + ".join(d(f"r{j}") for j in range(i + 1)), "rn") for i in bins)
    q["drift"] = with_(LOG, win, ref) + (
        f"SELECT window_start, window_end, n, round({psi}, 6) AS psi, round(greatest({gaps}), 6) AS ks FROM win, ref")
    return q


ORACLE_SQL = build()
