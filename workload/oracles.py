"""DuckDB SQL equivalents of the registered queries, over the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from fieldbook.functions import MISSING_TOKENS, UNKNOWN_LABEL
from fieldbook.learning.forest import poisson_steps
from fieldbook.learning.regression import FOREST_RATE
from fieldbook.operators.errors import BAND_LABELS, BAND_PROBS
from fieldbook.plans.survey import AREA, EDUCATION, OCCUPATION

from .bindings import KEYS, LABEL, NUMBERS, RAW_KEYS, RAW_TEXTS, SPLIT_YEARS

RAW = """
raw AS (
  SELECT concat(CAST(year(l_shipdate) AS VARCHAR), 'T', CAST(quarter(l_shipdate) AS VARCHAR)) AS period,
         CAST(l_orderkey AS VARCHAR) AS household, CAST(l_linenumber AS VARCHAR) AS person,
         CAST(quarter(o_orderdate) AS VARCHAR) AS src_quarter,
         CASE WHEN l_orderkey % 101 = 0 THEN 'NaN' WHEN l_orderkey % 103 = 0 THEN 'abc'
              ELSE concat(' ', CAST(CAST(l_quantity AS INT) + 5 AS VARCHAR), '.0 ') END AS age_txt,
         CASE WHEN l_orderkey % 11 = 0 THEN 'NA' WHEN l_orderkey % 13 = 0 THEN ''
              WHEN l_orderkey % 17 = 0 THEN NULL
              WHEN o_orderstatus = 'P' THEN '2' ELSE '1' END AS active_txt,
         CASE WHEN l_partkey % 31 = 0 THEN '9' WHEN l_returnflag = 'A' THEN '1'
              WHEN l_returnflag = 'N' THEN '2.0' ELSE '3.00' END AS job_code,
         CASE WHEN l_suppkey % 29 = 0 THEN '-5' WHEN l_suppkey % 23 = 0 THEN 'n/a'
              WHEN l_suppkey % 10 = 0 THEN concat(CAST(CAST(floor(l_extendedprice / 1000) AS INT) AS VARCHAR), ',',
                   lpad(CAST(CAST(floor(l_extendedprice) AS INT) % 1000 AS VARCHAR), 3, '0'))
              ELSE CAST(l_extendedprice AS VARCHAR) END AS pay_txt,
         CAST(CAST(l_suppkey % 40 AS INT) AS VARCHAR) AS years_txt,
         CASE WHEN l_partkey % 37 = 0 THEN '5.5'
              ELSE CAST(CAST(l_partkey % 13 AS INT) AS VARCHAR) END AS months_txt,
         CAST(CAST(l_partkey % 180 AS INT) AS VARCHAR) AS hours_txt,
         CASE WHEN l_partkey % 41 = 0 THEN NULL
              ELSE substring(o_orderpriority, 1, 1) END AS level_code,
         CASE WHEN l_linestatus = 'F' THEN '1.0' ELSE ' 2 ' END AS domain_code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def _quoted(values: Sequence[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _number(column: str) -> str:
    text = f"replace(trim({column}), ',', '')"
    return (
        f"CASE WHEN upper({text}) IN ({_quoted(MISSING_TOKENS)}) THEN NULL "
        f"ELSE try_cast({text} AS DOUBLE) END"
    )


def _code(column: str) -> str:
    return rf"regexp_replace(trim({column}), '\.0+$', '')"


def _label(code: str, labels: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{key}' THEN '{value}'" for key, value in labels.items())
    return f"CASE {code} {whens} ELSE '{UNKNOWN_LABEL}' END"


def _r(expression: str, digits: int = 4) -> str:
    """Rounded, with negative zero made plain."""
    return f"round({expression}, {digits}) + 0.0"


TYPED = f"""{RAW},
parsed AS (
  SELECT *, {_number('age_txt')} AS age, {_number('active_txt')} AS active,
         {_number('pay_txt')} AS pay, {_number('years_txt')} AS tenure_years,
         {_number('months_txt')} AS tenure_months, {_number('hours_txt')} AS hours,
         {_code('job_code')} AS job, {_code('level_code')} AS level,
         {_code('domain_code')} AS domain
  FROM raw
),
typed AS (
  SELECT *, {_label('job', OCCUPATION)} AS job_label,
         {_label('level', EDUCATION)} AS level_label,
         {_label('domain', AREA)} AS domain_label,
         tenure_years + tenure_months / 12.0 AS tenure
  FROM parsed
)"""


def _finite(column: str) -> str:
    return (
        f"{column} IS NOT NULL AND NOT isnan({column}) AND abs({column}) < CAST('inf' AS DOUBLE)"
    )


STEPS = [
    ("age finite and at least 15", f"{_finite('age')} AND age >= 15"),
    ("employed", "active = 1"),
    ("wage-earning job code", "job IN ('1', '2', '3', '4')"),
    ("pay finite and positive", f"{_finite('pay')} AND pay > 0"),
    (
        "tenure parts valid",
        f"{_finite('tenure_years')} AND {_finite('tenure_months')} AND tenure_years >= 0 "
        "AND tenure_months >= 0 AND tenure_months <= 11 AND tenure_months = floor(tenure_months)",
    ),
    ("tenure within age", "tenure <= age"),
    ("weekly hours in (0, 168]", f"{_finite('hours')} AND hours > 0 AND hours <= 168"),
]


def _upto(step: int) -> str:
    return " AND ".join(f"({predicate})" for _, predicate in STEPS[:step]) or "TRUE"


ELIGIBLE = _upto(len(STEPS))

_keys = ", ".join(RAW_KEYS)
ORACLES: dict[str, str] = {}

ORACLES["normalize_codes"] = f"WITH {TYPED} SELECT {_keys}, job, level, domain FROM typed"
ORACLES["parse_numeric"] = (
    f"WITH {TYPED} SELECT {_keys}, age, active, pay, tenure_years, tenure_months, hours FROM typed"
)
ORACLES["label_codes"] = (
    f"WITH {TYPED} SELECT {_keys}, job_label, level_label, domain_label FROM typed"
)
ORACLES["composite_duration"] = (
    f"WITH {TYPED} SELECT {_keys}, tenure_years, tenure_months, tenure FROM typed"
)
ORACLES["harmonize"] = (
    f"WITH {TYPED} SELECT * FROM typed"
)


def _canonical(columns: Sequence[str]) -> str:
    parts = ", ".join(
        f"CASE WHEN {c} IS NULL THEN '~' "
        f"ELSE concat(length(CAST({c} AS VARCHAR)), ':', {c}) END"
        for c in columns
    )
    return f"concat({parts})"


ORACLES["row_fingerprints"] = (
    f"WITH {RAW} SELECT {_keys}, sha256({_canonical(RAW_TEXTS)}) AS fingerprint FROM raw"
)
KEY_HASH = f"md5({_canonical([*KEYS, '42'])})"
ORACLES["seeded_key_hash"] = f"SELECT {', '.join(KEYS)}, {KEY_HASH} AS key_hash FROM lineitem"

# --- Filters, splits and periods --------------------------------------------------------

_counts = ", ".join(f"count(*) FILTER (WHERE {_upto(i)}) AS c{i}" for i in range(len(STEPS) + 1))
ORACLES["exclusion_funnel"] = (
    f"WITH {TYPED}, counts AS (SELECT {_counts} FROM typed) "
    + " UNION ALL ".join(
        f"SELECT {i} AS step, '{label}' AS criterion, c{max(i - 1, 0)} AS before, "
        f"c{max(i - 1, 0)} - c{i} AS excluded, c{i} AS after FROM counts"
        for i, label in enumerate(["input", *[label for label, _ in STEPS]])
    )
)
ORACLES["eligible_rows"] = (
    f"WITH {TYPED} SELECT {_keys}, age, pay, tenure, hours, job, level "
    f"FROM typed WHERE {ELIGIBLE}"
)


def _in_years(split: str) -> str:
    first, last = SPLIT_YEARS[split]
    return f"year(l_shipdate) BETWEEN {first} AND {last}"


ORACLES["split_rows"] = " UNION ALL ".join(
    f"SELECT '{split}' AS split, count(*) AS rows FROM lineitem WHERE {_in_years(split)}"
    for split in SPLIT_YEARS
) + " UNION ALL SELECT 'outside', count(*) FILTER (WHERE NOT coalesce(" + " OR ".join(
    f"({_in_years(split)})" for split in SPLIT_YEARS
) + ", FALSE)) FROM lineitem"
PERIOD = "concat(year(l_shipdate), 'T', quarter(l_shipdate))"
ORACLES["union_periods"] = f"""
SELECT {PERIOD} AS period, count(*) AS n, {_r('sum(l_quantity)', 2)} AS quantity,
       {_r(f'sum({LABEL})', 2)} AS price
FROM lineitem WHERE year(l_shipdate) BETWEEN 1995 AND 2001 GROUP BY 1"""

# --- Quality audits ---------------------------------------------------------------------

ORACLES["missingness"] = f"WITH {RAW} " + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {c} IS NULL OR upper(trim({c})) IN "
    f"({_quoted(MISSING_TOKENS)})) AS missing, "
    + _r(
        f"100.0 * count(*) FILTER (WHERE {c} IS NULL OR upper(trim({c})) IN "
        f"({_quoted(MISSING_TOKENS)})) / CAST(count(*) AS DOUBLE)"
    )
    + " AS missing_pct FROM raw"
    for c in [*RAW_KEYS, *RAW_TEXTS]
)
_BY_PERIOD = f"""{TYPED},
counts AS (
  SELECT period, count(*) AS before, count(*) FILTER (WHERE {ELIGIBLE}) AS after
  FROM typed GROUP BY period
)"""
_RETENTION = (
    "before, after, before - after AS excluded, "
    f"{_r('100.0 * after / CAST(before AS DOUBLE)')} AS retention_pct"
)
ORACLES["counts_by_period"] = f"WITH {_BY_PERIOD} SELECT period, {_RETENTION} FROM counts"
ORACLES["compare_period_counts"] = ORACLES["counts_by_period"]
ORACLES["retention_total"] = f"""
WITH {_BY_PERIOD}, total AS (
  SELECT CAST(sum(before) AS BIGINT) AS before, CAST(sum(after) AS BIGINT) AS after FROM counts
) SELECT {_RETENTION} FROM total"""


def _duplicates(source: str, keys: Sequence[str], payload: Sequence[str]) -> str:
    row = " , ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in payload)
    return f"""groups AS (
  SELECT count(*) AS n, count(DISTINCT row({row})) AS versions
  FROM {source} GROUP BY {', '.join(keys)} HAVING count(*) > 1
)
SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_involved,
       count(*) FILTER (WHERE versions = 1) AS exact_repeat_groups,
       count(*) FILTER (WHERE versions > 1) AS conflicting_groups
FROM groups"""


ORACLES["duplicate_keys"] = "WITH " + _duplicates(
    "lineitem",
    ["l_orderkey", "l_linenumber"],
    ["l_partkey", "l_suppkey", *NUMBERS, LABEL, "l_returnflag", "l_linestatus", "l_shipdate"],
)
ORACLES["duplicate_raw_keys"] = f"WITH {RAW}, " + _duplicates(
    "raw", RAW_KEYS, ["src_quarter", *RAW_TEXTS]
)
ORACLES["key_uniqueness"] = " UNION ALL ".join(
    f"SELECT '{name}' AS key_name, count(*) AS rows, count(DISTINCT row({', '.join(keys)})) "
    f"AS distinct_keys, count(*) = count(DISTINCT row({', '.join(keys)})) AS is_unique FROM lineitem"
    for name, keys in {"order_line": ["l_orderkey", "l_linenumber"], "full_key": KEYS}.items()
)
ORACLES["observed_codes"] = f"""
WITH {RAW} SELECT period, {_code('src_quarter')} AS src_quarter, count(*) AS n
FROM raw GROUP BY 1, 2"""

# --- Description ------------------------------------------------------------------------

PROFILED = [LABEL, *NUMBERS]


def _profile(column: str) -> str:
    return f"""
SELECT '{column}' AS variable, count({column}) AS n, {_r(f'avg({column})')} AS mean,
       {_r(f'quantile_disc({column}, 0.5)')} AS median, {_r(f'stddev_samp({column})')} AS std,
       {_r(f'min({column})')} AS min, {_r(f'quantile_disc({column}, 0.25)')} AS p25,
       {_r(f'quantile_disc({column}, 0.75)')} AS p75,
       {_r(f'quantile_disc({column}, 0.95)')} AS p95, {_r(f'max({column})')} AS max
FROM lineitem"""


ORACLES["numeric_profile"] = " UNION ALL ".join(_profile(c) for c in PROFILED)
ORACLES["skew_reading"] = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {_r(f'avg({c})')} AS mean, "
    f"{_r(f'quantile_disc({c}, 0.5)')} AS median, "
    f"CASE WHEN avg({c}) > quantile_disc({c}, 0.5) THEN 'positive' "
    f"WHEN avg({c}) < quantile_disc({c}, 0.5) THEN 'negative' ELSE 'symmetric' END AS skew "
    "FROM lineitem"
    for c in PROFILED
)
CATEGORIES = ["l_returnflag", "l_linestatus", "o_orderpriority"]
_joined = "lineitem JOIN orders ON l_orderkey = o_orderkey"
ORACLES["category_distribution"] = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS category, count(*) AS n, "
    f"{_r('100.0 * count(*) / CAST((SELECT count(*) FROM ' + _joined + ') AS DOUBLE)')} AS pct "
    f"FROM {_joined} GROUP BY {c}"
    for c in CATEGORIES
)
ORACLES["median_by_group"] = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS category, count(*) AS n, "
    f"{_r(f'quantile_disc({LABEL}, 0.5)')} AS median, {_r(f'avg({LABEL})')} AS mean "
    f"FROM {_joined} GROUP BY {c}"
    for c in CATEGORIES
)
ORACLES["period_summary"] = f"""
SELECT {PERIOD} AS period, count(*) AS n, {_r(f'quantile_disc({LABEL}, 0.5)')} AS median,
       {_r(f'avg({LABEL})')} AS mean
FROM lineitem GROUP BY 1"""
ORACLES["pearson_matrix"] = " UNION ALL ".join(
    f"SELECT '{x}' AS var_a, '{y}' AS var_b, "
    + (f"CAST(1.0 AS DOUBLE) AS r" if x == y else f"{_r(f'corr({x}, {y})')} AS r")
    + " FROM (SELECT "
    + (f"1)" if x == y else f"{x}, {y} FROM lineitem)")
    for x in PROFILED
    for y in PROFILED
)
ORACLES["correlation_rank"] = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {_r(f'corr({LABEL}, {c})')} AS r, "
    f"{_r(f'abs(corr({LABEL}, {c}))')} AS abs_r FROM lineitem"
    for c in NUMBERS
)


def _histogram(values: str, bins: int, edge: str, digits: int) -> str:
    return f"""
WITH v AS ({values}),
lim AS (SELECT min(x) AS lo, max(x) - min(x) AS span FROM v),
binned AS (
  SELECT least(CAST(floor((x - lo) / span * {bins}) AS BIGINT) + 1, {bins}) AS bin, count(*) AS n
  FROM v, lim GROUP BY 1
),
bins AS (SELECT CAST(range AS INT) AS bin FROM range(1, {bins + 1}))
SELECT bins.bin AS bin,
       {_r(edge.format(f'lo + (bins.bin - 1) * span / {bins}'), digits)} AS lower,
       {_r(edge.format(f'lo + bins.bin * span / {bins}'), digits)} AS upper,
       coalesce(binned.n, 0) AS n
FROM bins CROSS JOIN lim LEFT JOIN binned ON bins.bin = binned.bin"""


ORACLES["price_histogram"] = _histogram(f"SELECT {LABEL} AS x FROM lineitem", 45, "{}", 4)
ORACLES["price_log_histogram"] = _histogram(
    f"SELECT log10({LABEL}) AS x FROM lineitem WHERE {LABEL} > 0", 44, "pow(10.0, {})", 2
)
ORACLES["hash_sample"] = f"""
SELECT {', '.join(KEYS)}, {PERIOD} AS period, {LABEL} FROM lineitem
ORDER BY {KEY_HASH}, {', '.join(KEYS)} LIMIT 5000"""

# --- Metrics and error analytics --------------------------------------------------------

TRAINING = f"""
fit AS (
  SELECT avg({LABEL}) AS mean, regr_slope({LABEL}, l_quantity) AS slope,
         regr_intercept({LABEL}, l_quantity) AS intercept
  FROM lineitem WHERE {_in_years('train')}
),
segments AS (
  SELECT l_returnflag AS flag, l_linestatus AS status, avg({LABEL}) AS pred_segment
  FROM lineitem WHERE {_in_years('train')} GROUP BY 1, 2
)"""


def _scored(name: str, split: str) -> str:
    return f"""
{name} AS (
  SELECT {', '.join(KEYS)}, {PERIOD} AS period, {LABEL}, l_returnflag, o_orderpriority,
         fit.mean AS pred_mean, coalesce(pred_segment, fit.mean) AS pred_segment,
         fit.intercept + fit.slope * l_quantity AS pred_line
  FROM {_joined} CROSS JOIN fit
  LEFT JOIN segments ON flag = l_returnflag AND status = l_linestatus
  WHERE {_in_years(split)}
)"""


SCORED = f"{TRAINING}, {_scored('scored', 'test')}"
MODELS = {
    "mean_baseline": "pred_mean",
    "segment_mean": "pred_segment",
    "quantity_line": "pred_line",
}
TWO = {name: column for name, column in MODELS.items() if name != "mean_baseline"}


def _long(source: str, models: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{model}' AS model, {column} AS prediction, {LABEL} - {column} AS residual "
        f"FROM {source}"
        for model, column in models.items()
    )


def _metric_cte(name: str, source: str, models: dict[str, str]) -> str:
    return f"""
{name} AS (
  SELECT model, count(residual) AS n, avg(abs(residual)) AS mae,
         sqrt(avg(residual * residual)) AS rmse,
         1 - sum(residual * residual) / (var_pop({LABEL}) * count(*)) AS r2
  FROM ({_long(source, models)}) GROUP BY model
)"""


ORACLES["regression_metrics"] = f"""
WITH {SCORED}, {_metric_cte('metrics', 'scored', MODELS)}
SELECT model, n, {_r('mae')} AS mae, {_r('rmse')} AS rmse, {_r('r2')} AS r2 FROM metrics"""
_VALID = f"{TRAINING}, {_scored('valid', 'validation')}"
ORACLES["mean_baseline"] = f"""
WITH {_VALID}, {_metric_cte('metrics', 'valid', {'mean_baseline': 'pred_mean'})}
SELECT model, n, {_r('mae')} AS mae, {_r('rmse')} AS rmse, {_r('r2')} AS r2 FROM metrics"""
ORACLES["model_comparison"] = f"""
WITH {_VALID}, {_metric_cte('metrics', 'valid', MODELS)}
SELECT model, {_r('mae')} AS mae, {_r('rmse')} AS rmse, {_r('r2')} AS r2 FROM metrics"""
ORACLES["long_errors"] = f"""
WITH {SCORED}, stacked AS ({_long('scored', TWO)})
SELECT {', '.join(KEYS)}, {LABEL}, model, {_r('prediction')} AS prediction,
       {_r('residual')} AS residual, {_r('abs(residual)')} AS abs_error
FROM stacked"""

_DIRECTION = (
    "CASE WHEN mean_error > 0 THEN 'subestima' WHEN mean_error < 0 THEN 'sobreestima' "
    "WHEN mean_error = 0 THEN 'no presenta sesgo medio' END AS direction"
)
STACKED = f"{SCORED}, stacked AS ({_long('scored', TWO)})"


def _group_cte(name: str, column: str) -> str:
    return f"""
{name} AS (
  SELECT model, {column} AS grp, count(*) AS n, avg(abs(residual)) AS mae,
         avg(residual) AS mean_error, avg({LABEL}) AS mean_actual
  FROM stacked GROUP BY 1, 2
)"""


ORACLES["error_by_group"] = f"""
WITH {STACKED}, {_group_cte('g', 'o_orderpriority')}
SELECT model, 'o_orderpriority' AS variable, grp, n, {_r('mae')} AS mae,
       {_r('mean_error')} AS mean_error, {_r('mean_actual')} AS mean_actual, {_DIRECTION}
FROM g"""

_cut_names = [f"c{i}" for i in range(len(BAND_PROBS))]
CUTS = "cuts AS (SELECT " + ", ".join(
    f"quantile_disc({LABEL}, {p}) AS {c}" for p, c in zip(BAND_PROBS, _cut_names)
) + " FROM scored)"
_BAND = (
    "CASE "
    + " ".join(
        f"WHEN {LABEL} <= {c} THEN '{label}'" for c, label in zip(_cut_names, BAND_LABELS)
    )
    + f" ELSE '{BAND_LABELS[-1]}' END"
)
_UPPER = "CASE band " + " ".join(
    f"WHEN '{label}' THEN {c}" for c, label in zip(_cut_names, BAND_LABELS)
) + " END"
ORACLES["value_bands"] = f"""
WITH {SCORED}, {CUTS}, banded AS (SELECT *, {_BAND} AS band FROM scored CROSS JOIN cuts)
SELECT band, {', '.join(KEYS)}, {LABEL}, {_UPPER} AS upper FROM banded"""
BANDS = f"""{STACKED}, {CUTS},
banded AS (SELECT *, {_BAND} AS band FROM stacked CROSS JOIN cuts),
bands AS (
  SELECT model, band, count(*) AS n, avg({LABEL}) AS mean_actual,
         avg(prediction) AS mean_predicted, avg(abs(residual)) AS mae,
         avg(residual) AS mean_error,
         avg(CASE WHEN residual > 0 THEN 1.0 ELSE 0.0 END) AS underestimated_share,
         min({_UPPER}) AS upper
  FROM banded GROUP BY 1, 2
)"""
ORACLES["error_by_band"] = f"""
WITH {BANDS}
SELECT model, band, n, {_r('mean_actual')} AS mean_actual,
       {_r('mean_predicted')} AS mean_predicted, {_r('mae')} AS mae,
       {_r('mean_error')} AS mean_error, {_r('underestimated_share')} AS underestimated_share,
       {_r('upper')} AS upper, {_r('100 * mean_error / mean_actual')} AS mean_error_pct, {_DIRECTION}
FROM bands"""
ORACLES["residual_summary"] = f"""
WITH {STACKED}
SELECT model, count(*) AS n, {_r('avg(residual)')} AS mean_error, {_r('avg(abs(residual))')} AS mae,
       {_r('quantile_disc(residual, 0.5)')} AS median_residual,
       {_r('avg(CASE WHEN residual > 0 THEN 1.0 ELSE 0.0 END)')} AS underestimated_share
FROM stacked GROUP BY model"""
ORACLES["score_join"] = f"""
WITH {SCORED}
SELECT {', '.join(KEYS)}, l.{LABEL} AS {LABEL}, {_r('l.pred_segment')} AS pred_segment,
       {_r('r.pred_line')} AS pred_line
FROM scored l JOIN (SELECT {', '.join(KEYS)}, pred_line FROM scored) r
     USING ({', '.join(KEYS)})"""
ORACLES["row_conservation"] = f"""
WITH {SCORED}
SELECT 'eligible test' AS dataset, count(*) AS rows FROM lineitem WHERE {_in_years('test')}
UNION ALL SELECT 'predictions segment_mean', count(pred_segment) FROM scored
UNION ALL SELECT 'predictions quantity_line', count(pred_line) FROM scored
UNION ALL SELECT 'shared rows', count(*) FROM scored
UNION ALL SELECT 'distinct shared keys', count(DISTINCT row({', '.join(KEYS)})) FROM scored"""
SAMPLE = f"""sample AS (
  SELECT * FROM scored ORDER BY {KEY_HASH}, {', '.join(KEYS)} LIMIT 5000
)"""
ORACLES["comparison_sample"] = f"""
WITH {SCORED}, {SAMPLE}
SELECT {', '.join(KEYS)}, {LABEL}, {_r('pred_segment')} AS pred_segment,
       {_r('pred_line')} AS pred_line,
       {_r(f'{LABEL} - pred_segment')} AS residual_segment_mean,
       {_r(f'{LABEL} - pred_line')} AS residual_quantity_line
FROM sample"""

# --- Findings ---------------------------------------------------------------------------

TEST_METRICS = f"{SCORED}, {_metric_cte('metrics', 'scored', MODELS)}"
BOTH_METRICS = f"""{TRAINING}, {_scored('scored', 'test')}, {_scored('valid', 'validation')},
{_metric_cte('metrics', 'scored', MODELS)}, {_metric_cte('earlier', 'valid', MODELS)}"""


def _ranked(source: str, name: str) -> str:
    return (
        f"{name} AS (SELECT *, row_number() OVER (ORDER BY rmse, model) AS place "
        f"FROM {source} WHERE model <> 'mean_baseline')"
    )


ORACLES["winner_runner_up"] = f"""
WITH {TEST_METRICS}, {_ranked('metrics', 'ranked')}
SELECT w.model AS winner, {_r('w.rmse')} AS winner_rmse, {_r('w.r2')} AS winner_r2,
       s.model AS runner_up, {_r('s.rmse')} AS runner_up_rmse
FROM ranked w JOIN ranked s ON w.place = 1 AND s.place = 2"""
_BASE_RMSE = "(SELECT rmse FROM metrics WHERE model = 'mean_baseline')"
_GAIN = _r(f"100.0 * ({_BASE_RMSE} - rmse) / {_BASE_RMSE}")
ORACLES["baseline_gain"] = f"""
WITH {TEST_METRICS}
SELECT model, {_r('rmse')} AS rmse, {_GAIN} AS rmse_gain_pct FROM metrics"""
ORACLES["validation_to_test"] = f"""
WITH {BOTH_METRICS}
SELECT m.model AS model, m.n AS n, {_r('m.mae')} AS mae, {_r('m.rmse')} AS rmse,
       {_r('m.r2')} AS r2, {_r('e.mae')} AS mae_validation, {_r('e.rmse')} AS rmse_validation,
       {_r('e.r2')} AS r2_validation,
       {_r(f'100.0 * ({_BASE_RMSE} - m.rmse) / {_BASE_RMSE}')} AS rmse_gain_pct,
       {_r('m.rmse - e.rmse')} AS rmse_change
FROM metrics m LEFT JOIN earlier e ON m.model = e.model"""
ORACLES["winner_agreement"] = f"""
WITH {BOTH_METRICS}, {_ranked('metrics', 'now')}, {_ranked('earlier', 'before')}
SELECT before.model AS validation_winner, now.model AS test_winner,
       before.model = now.model AS agree
FROM now JOIN before ON now.place = 1 AND before.place = 1"""
GROUPS = f"{STACKED}, {_group_cte('g', 'o_orderpriority')}"
ORACLES["extreme_groups"] = f"""
WITH {GROUPS},
w AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mae DESC, grp) AS place FROM g),
u AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mean_error DESC, grp) AS place FROM g),
o AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mean_error, grp) AS place FROM g)
SELECT w.model AS model, w.grp AS worst_group, {_r('w.mae')} AS worst_mae, w.n AS worst_n,
       u.grp AS under_group, {_r('u.mean_error')} AS under_error,
       CASE WHEN u.mean_error > 0 THEN 'underestimated' ELSE 'no_group_underestimated' END AS under_reading,
       o.grp AS over_group, {_r('o.mean_error')} AS over_error,
       CASE WHEN o.mean_error < 0 THEN 'overestimated' ELSE 'no_group_overestimated' END AS over_reading
FROM w JOIN u ON w.model = u.model AND u.place = 1 JOIN o ON w.model = o.model AND o.place = 1
WHERE w.place = 1"""
ORACLES["scale_check"] = f"""
WITH {GROUPS},
a AS (SELECT grp, avg(mean_actual) AS mean_actual, avg(mae) AS mae FROM g GROUP BY grp),
hi AS (SELECT * FROM a ORDER BY mean_actual DESC, grp LIMIT 1),
er AS (SELECT * FROM a ORDER BY mae DESC, grp LIMIT 1)
SELECT hi.grp AS highest_actual_group, {_r('hi.mean_actual')} AS highest_actual,
       er.grp AS highest_mae_group, {_r('er.mae')} AS highest_mae, hi.grp = er.grp AS same_group
FROM hi CROSS JOIN er"""
ORACLES["tail_contrast"] = f"""
WITH {BANDS}
SELECT lo.model AS model, {_r('lo.mean_error')} AS low_mean_error,
       {_r('hi.mean_error')} AS high_mean_error, {_r('hi.mae')} AS high_mae,
       {_r('hi.underestimated_share')} AS high_underestimated_share
FROM bands lo JOIN bands hi ON lo.model = hi.model
WHERE lo.band = '{BAND_LABELS[0]}' AND hi.band = '{BAND_LABELS[-1]}'"""
ORACLES["winner_in_tail"] = f"""
WITH {BANDS}, {_metric_cte('metrics', 'scored', MODELS)}, {_ranked('metrics', 'ranked')}
SELECT b.model AS winner, b.band AS band, b.n AS n, {_r('b.mean_error')} AS mean_error,
       {_r('b.mae')} AS mae
FROM bands b JOIN ranked r ON b.model = r.model AND r.place = 1
WHERE b.band = '{BAND_LABELS[-1]}'"""
ORACLES["overall_extremes"] = f"""
WITH {BANDS}, {_group_cte('g', 'o_orderpriority')}, {_group_cte('f', 'l_returnflag')},
every AS (
  SELECT 'priority' AS dimension, model, grp, n, mae FROM g
  UNION ALL SELECT 'return_flag', model, grp, n, mae FROM f
  UNION ALL SELECT 'band', model, band, n, mae FROM bands
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY mae DESC, model, grp) AS place
  FROM every
)
SELECT dimension, model, grp, n, {_r('mae')} AS mae FROM placed WHERE place = 1"""
ORACLES["sample_tail_residual"] = f"""
WITH {SCORED}, {SAMPLE}, cut AS (SELECT quantile_cont({LABEL}, 0.9) AS c FROM sample),
stacked AS ({_long('sample', TWO)})
SELECT model, {_r('min(c)')} AS tail_from, {_r('avg(residual)')} AS mean_residual,
       {_r(f'avg(residual) FILTER (WHERE {LABEL} >= c)')} AS tail_mean_residual
FROM stacked CROSS JOIN cut GROUP BY model"""
ORACLES["wide_group_errors"] = f"""
WITH {GROUPS}
SELECT grp, n, """ + ", ".join(
    f"{_r(f'max(mae) FILTER (WHERE model = {chr(39)}{m}{chr(39)})')} AS {m}_mae, "
    f"{_r(f'max(mean_error) FILTER (WHERE model = {chr(39)}{m}{chr(39)})')} AS {m}_mean_error"
    for m in TWO
) + " FROM g GROUP BY grp, n"

ORACLES["linear_search_line"] = f"""
WITH {_VALID}, {_metric_cte('metrics', 'valid', {'mean_baseline': 'pred_mean', 'line': 'pred_line'})}
SELECT model, {_r('mae')} AS mae, {_r('rmse')} AS rmse, {_r('r2')} AS r2,
       CASE model WHEN 'line' THEN 'regParam=0.0, elasticNetParam=0.0' END AS configuration,
       CASE model WHEN 'line' THEN n END AS n
FROM metrics"""
ORACLES["final_line"] = f"""
WITH fit AS (
  SELECT avg({LABEL}) AS mean, regr_slope({LABEL}, l_quantity) AS slope,
         regr_intercept({LABEL}, l_quantity) AS intercept
  FROM lineitem WHERE {_in_years('train')} OR {_in_years('validation')})
SELECT {', '.join(KEYS)}, {PERIOD} AS period, {_r(LABEL)} AS {LABEL}, {_r('mean')} AS mean_baseline,
       {_r('intercept + slope * l_quantity')} AS line,
       {_r(f'{LABEL} - (intercept + slope * l_quantity)')} AS residual_line
FROM lineitem, fit WHERE {_in_years('test')}"""
ORACLES["forest_stump"] = f"""
WITH sums AS (
  SELECT l_discount, count(*) AS n, sum({LABEL}) AS s FROM lineitem GROUP BY 1),
sides AS (
  SELECT l_discount AS cut, sum(s) OVER w / sum(n) OVER w AS low,
         (sum(s) OVER () - sum(s) OVER w) / nullif(sum(n) OVER () - sum(n) OVER w, 0) AS high,
         sum(n) OVER w AS n_low, sum(n) OVER () - sum(n) OVER w AS n_high
  FROM sums WINDOW w AS (ORDER BY l_discount)),
best AS (
  -- The least squared error has the greatest between-sides sum of squares.
  SELECT * FROM sides WHERE n_high > 0
  ORDER BY n_low * low * low + n_high * high * high DESC LIMIT 1)
SELECT l_discount, {_r('CASE WHEN l_discount <= cut THEN low ELSE high END')} AS stump
FROM sums, best"""
ORACLES["segment_clusters"] = f"""
WITH spread AS (
  SELECT CASE WHEN l_returnflag = 'A' THEN 10000.0 ELSE 0.0 END + l_quantity AS spread FROM lineitem)
SELECT count(*) AS n, {_r('avg(spread)')} AS spread_mean,
       {_r('100.0 * count(*) / (SELECT count(*) FROM spread)')} AS pct,
       CASE WHEN avg(spread) > 5000 THEN 'Spread alto' ELSE 'Spread bajo' END AS description
FROM spread GROUP BY spread > 5000"""
ORACLES["linear_univariate"] = f"""
SELECT {_r(f'regr_slope({LABEL}, l_quantity)')} AS slope,
       {_r(f'regr_intercept({LABEL}, l_quantity)')} AS intercept
FROM lineitem"""


def _ranks(name: str, column: str) -> str:
    return f"""
{name} AS (
  SELECT {column} AS label, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS INT) AS place
  FROM {_joined} WHERE {_in_years('train')} GROUP BY {column}
)"""


_rank_names = [f"r{i}" for i in range(len(CATEGORIES))]
ORACLES["category_indices"] = (
    "WITH "
    + ", ".join(_ranks(name, column) for name, column in zip(_rank_names, CATEGORIES))
    + f" SELECT {', '.join(KEYS)}, "
    + ", ".join(
        f"coalesce({name}.place, (SELECT CAST(count(*) AS INT) FROM {name})) AS {column}_idx"
        for name, column in zip(_rank_names, CATEGORIES)
    )
    + f" FROM {_joined} "
    + " ".join(
        f"LEFT JOIN {name} ON {name}.label = {column}"
        for name, column in zip(_rank_names, CATEGORIES)
    )
    + f" WHERE {_in_years('test')}"
)


def _z(column: str) -> str:
    return f"({column} - avg({column}) OVER ()) / stddev_samp({column}) OVER ()"


ORACLES["standardized_features"] = (
    f"SELECT {', '.join(KEYS)}, "
    + ", ".join(f"{_r(_z(c))} AS {c}" for c in NUMBERS)
    + " FROM lineitem"
)
_dot = " + ".join(f"z.x{i} * s.y{i}" for i in range(len(PROFILED)))
ORACLES["segment_silhouette"] = f"""
WITH z AS (
  SELECT row_number() OVER () AS id, l_returnflag AS c,
         {', '.join(f'{_z(c)} AS x{i}' for i, c in enumerate(PROFILED))}
  FROM lineitem
),
q AS (SELECT *, {' + '.join(f'x{i} * x{i}' for i in range(len(PROFILED)))} AS xx FROM z),
s AS (
  SELECT c, count(*) AS n, sum(xx) AS psi,
         {', '.join(f'sum(x{i}) AS y{i}' for i in range(len(PROFILED)))}
  FROM q GROUP BY c
),
d AS (
  SELECT z.id AS id, z.c = s.c AS own, n,
         z.xx + s.psi / s.n - 2 * ({_dot}) / s.n AS mean_distance
  FROM q AS z CROSS JOIN s
),
p AS (
  SELECT id, max(CASE WHEN own THEN mean_distance * n / (n - 1) END) AS a,
         min(CASE WHEN NOT own THEN mean_distance END) AS b
  FROM d GROUP BY id
)
SELECT {_r('avg(CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END)')} AS silhouette
FROM p"""

# --- Sources, sketches and stored steps ---------------------------------------------------

ORACLES["contract_ingest"] = f"""
WITH {RAW}
SELECT run, period, concat('period=', period) AS source, count(*) AS rows, count(*) AS expected,
       CASE run WHEN 1 THEN 'converted' ELSE 'reused' END AS state
FROM raw, (SELECT unnest([1, 2]) AS run) GROUP BY run, period"""
ORACLES["ingested_periods"] = f"""
WITH {RAW}
SELECT period, concat('period=', period) AS source_file, CAST(left(period, 4) AS INT) AS file_year,
       CAST(right(period, 1) AS INT) AS calendar_quarter, count(*) AS n,
       count(DISTINCT household) AS households,
       count(*) FILTER (WHERE active_txt IS NULL) AS null_active,
       count(*) FILTER (WHERE active_txt = '') AS empty_active,
       CAST(sum(length(trim(pay_txt))) AS BIGINT) AS pay_length,
       count(*) FILTER (WHERE upper(trim(age_txt)) IN ({_quoted(MISSING_TOKENS)})) AS bad_age,
       count(*) FILTER (WHERE trim(domain_code) = '2') AS domain_two
FROM raw GROUP BY period"""

_SHARES = ["p01", "p25", "p50", "p75", "p95", "p99"]
ORACLES["sketched_profile_ranks"] = f"""
SELECT method, variable, share, (SELECT count(*) FROM lineitem) AS n, TRUE AS within
FROM (SELECT unnest(['stored sketches', 'one pass']) AS method),
     (SELECT unnest([{_quoted(PROFILED)}]) AS variable), (SELECT unnest([{_quoted(_SHARES)}]) AS share)"""
ORACLES["sketched_period_ranks"] = f"""
SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, share, count(*) AS n, TRUE AS within
FROM lineitem, (SELECT unnest([{_quoted(_SHARES)}]) AS share) GROUP BY 1, 2"""
ORACLES["stored_error_table"] = ORACLES["error_by_band"]
ORACLES["metric_consistency"] = f"""
WITH {STACKED}, found AS (
  SELECT model, avg(abs(residual)) AS stored,
         sum(greatest({LABEL}, prediction) - least({LABEL}, prediction)) / count(*) AS recomputed
  FROM stacked GROUP BY model)
SELECT model, {_r('stored')} AS stored, {_r('recomputed')} AS recomputed,
       abs(stored - recomputed) < 1e-6 AS agrees
FROM found"""
ORACLES["error_by_dimension"] = f"""
WITH {BANDS}, {_group_cte('g', 'o_orderpriority')}, {_group_cte('f', 'l_returnflag')},
every AS (
  SELECT 'priority' AS dimension, model, grp, n, mae, mean_error, mean_actual FROM g
  UNION ALL SELECT 'return_flag', model, grp, n, mae, mean_error, mean_actual FROM f
  UNION ALL SELECT 'band', model, band, n, mae, mean_error, mean_actual FROM bands)
SELECT dimension, model, grp, n, {_r('mae')} AS mae, {_r('mean_error')} AS mean_error,
       {_r('mean_actual')} AS mean_actual, {_DIRECTION} FROM every"""
ORACLES["tail_residual"] = f"""
WITH {STACKED}, cut AS (SELECT quantile_cont({LABEL}, 0.9) AS c FROM scored)
SELECT model, {_r('min(c)')} AS tail_from, {_r('avg(residual)')} AS mean_residual,
       {_r(f'avg(residual) FILTER (WHERE {LABEL} >= c)')} AS tail_mean_residual
FROM stacked CROSS JOIN cut GROUP BY model"""

# --- Fits -----------------------------------------------------------------------------------

ORACLES["reloaded_line"] = f"""
WITH fit AS (
  SELECT regr_slope({LABEL}, l_quantity) AS slope, regr_intercept({LABEL}, l_quantity) AS intercept
  FROM lineitem WHERE {_in_years('train')} OR {_in_years('validation')})
SELECT {', '.join(KEYS)}, {PERIOD} AS period, {_r(LABEL)} AS {LABEL},
       {_r('intercept + slope * l_quantity')} AS line
FROM lineitem, fit WHERE {_in_years('test')}"""

# A row's draws in a tree: how many cumulated Poisson probabilities its key's number reaches.
_DRAW = f"md5({_canonical([*KEYS, 't', '42'])})"
_UNIFORM = f"(CAST(concat('0x', substring({_DRAW}, 1, 13)) AS BIGINT) / 4503599627370496.0)"
_DRAWS = " + ".join(f"CAST(u >= {step!r}::DOUBLE AS INT)" for step in poisson_steps(FOREST_RATE))
ORACLES["forest_search_stumps"] = f"""
WITH drawn AS (
  SELECT t, l_discount, {LABEL}, {_UNIFORM} AS u
  FROM (SELECT *, unnest(range(5)) AS t FROM lineitem WHERE {_in_years('train')})),
weighed AS (
  SELECT t, l_discount, {LABEL}, {_DRAWS} AS weight FROM drawn
  UNION ALL SELECT -1, l_discount, {LABEL}, 1 FROM lineitem WHERE {_in_years('train')}),
sums AS (
  SELECT t, l_discount, sum(weight) AS n, sum(weight * {LABEL}) AS s FROM weighed GROUP BY t, l_discount),
sides AS (
  SELECT t, l_discount AS cut, sum(s) OVER w / sum(n) OVER w AS low,
         (sum(s) OVER e - sum(s) OVER w) / nullif(sum(n) OVER e - sum(n) OVER w, 0) AS high,
         sum(n) OVER w AS n_low, sum(n) OVER e - sum(n) OVER w AS n_high
  FROM sums WINDOW w AS (PARTITION BY t ORDER BY l_discount), e AS (PARTITION BY t)),
best AS (
  SELECT * FROM sides WHERE n_high > 0
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY n_low * low * low + n_high * high * high DESC) = 1),
stumps AS (
  SELECT t, l_discount, CASE WHEN l_discount <= cut THEN low ELSE high END AS value
  FROM best, (SELECT DISTINCT l_discount FROM lineitem)),
forests AS (
  SELECT trees, l_discount, avg(value) AS prediction
  FROM stumps, (SELECT unnest([1, 2, 5]) AS trees)
  WHERE CASE WHEN trees = 1 THEN t = -1 ELSE t BETWEEN 0 AND trees - 1 END GROUP BY trees, l_discount),
scored AS (
  SELECT trees, {LABEL}, prediction, {LABEL} - prediction AS residual
  FROM lineitem JOIN forests USING (l_discount) WHERE {_in_years('validation')})
SELECT concat('stumps_', trees) AS model, concat('numTrees=', trees, ', maxDepth=1') AS configuration,
       count(*) AS n, {_r('avg(abs(residual))')} AS mae, {_r('sqrt(avg(residual * residual))')} AS rmse,
       {_r(f'1 - sum(residual * residual) / (var_pop({LABEL}) * count(*))')} AS r2
FROM scored GROUP BY trees"""


def _silhouette(group: str, columns: Sequence[str]) -> str:
    """Mean silhouette of `far`, on z-scores, as a scalar query."""
    dots = " + ".join(f"z.x{i} * s.y{i}" for i in range(len(columns)))
    return f"""
z AS (SELECT row_number() OVER () AS id, {group} AS c,
             {', '.join(f'{_z(c)} AS x{i}' for i, c in enumerate(columns))} FROM far),
q AS (SELECT *, {' + '.join(f'x{i} * x{i}' for i in range(len(columns)))} AS xx FROM z),
s AS (SELECT c, count(*) AS n, sum(xx) AS psi,
             {', '.join(f'sum(x{i}) AS y{i}' for i in range(len(columns)))} FROM q GROUP BY c),
d AS (SELECT z.id AS id, z.c = s.c AS own, n, z.xx + s.psi / s.n - 2 * ({dots}) / s.n AS apart
      FROM q AS z CROSS JOIN s),
p AS (SELECT id, max(CASE WHEN own THEN apart * n / (n - 1) END) AS a, min(CASE WHEN NOT own THEN apart END) AS b
      FROM d GROUP BY id)"""


ORACLES["cluster_choice"] = f"""
WITH far AS (
  SELECT l_returnflag, f + l_quantity AS spread, f + 100 * l_tax AS drift
  FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 10000.0 ELSE 30000.0 END AS f FROM lineitem)),
{_silhouette('l_returnflag', ['spread', 'drift'])}
SELECT 'both' AS feature_set, CAST(3 AS INT) AS k,
       {_r('avg(CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END)')} AS silhouette,
       TRUE AS best_of_set, TRUE AS same_as_model
FROM p"""

_SEEN = f"{_in_years('train')} AND o_orderpriority <> '5-LOW'"
ORACLES["feature_slots"] = f"""
WITH flags AS (
  SELECT l_returnflag AS v, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS place
  FROM {_joined} WHERE {_SEEN} GROUP BY 1),
priorities AS (
  SELECT o_orderpriority AS v, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS place
  FROM {_joined} WHERE {_SEEN} GROUP BY 1)
SELECT {', '.join(KEYS)}, CAST(10 AS INT) AS width, l_quantity AS quantity, """ + ", ".join(
    [f"CAST(coalesce(f.place, 3) = {i} AS INT) AS flag_{i}" for i in range(4)]
    + [f"CAST(coalesce(p.place, 4) = {i} AS INT) AS priority_{i}" for i in range(5)]
) + f"""
FROM {_joined} LEFT JOIN flags f ON f.v = l_returnflag LEFT JOIN priorities p ON p.v = o_orderpriority
WHERE {_in_years('test')}"""
