"""DuckDB SQL of the queries in ``lifecycle``."""

from __future__ import annotations

from . import lifecycle as L
from . import oracles as O
from . import queries as Q

ORACLES: dict[str, str] = {}

ORACLES["score_table_nan"] = O.ORACLES["score_table_gaps"]

_NAN_SCORED = f"""scored AS ({O._scores('booking')}),
test AS (SELECT * REPLACE (CASE WHEN n_items <> 3 THEN fraud_probability END AS fraud_probability) FROM scored),
test_pred AS (SELECT *, CASE WHEN fraud_probability > 0.5 THEN 1 ELSE 0 END AS fraud_prediction FROM test
              WHERE fraud_probability IS NOT NULL)"""
ORACLES["evaluation_metrics_nan"] = O.ORACLES["evaluation_metrics"].replace(O.TEST_CTE, _NAN_SCORED)
ORACLES["percentiles_nan"] = f"SELECT event_type, {O._PCT} FROM events WHERE event_id % 7 <> 0 GROUP BY event_type"
ORACLES["psi_nan"] = O.ORACLES["psi_bins"].replace(
    "AND fraud_probability IS NOT NULL", "AND fraud_probability IS NOT NULL AND CAST(booking_id AS BIGINT) % 5 <> 0")

ORACLES["prediction_versions"] = f"""
WITH {O.BOOKING_CTE},
{O.PRED_CTE}
SELECT 'version 1' AS part, count(*) AS rows FROM pred
UNION ALL SELECT 'version 2', count(*) FROM pred WHERE risk_category <> 'LOW'
UNION ALL SELECT 'current ' || risk_category, count(*) FROM pred WHERE risk_category <> 'LOW' GROUP BY risk_category"""

MERGED_CTE = f"""merged AS (
  SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE cast(ts AS DATE) <> DATE '{L.REWRITTEN_DAY}'
  UNION ALL
  SELECT event_id, ts, user_id, CASE WHEN event_type = 'view' THEN '' ELSE event_type END,
         CASE WHEN event_id % 2 = 1 THEN value END, props FROM events WHERE cast(ts AS DATE) = DATE '{L.REWRITTEN_DAY}'
  UNION ALL
  SELECT event_id, ts + INTERVAL {L.APPENDED_DAYS_LATER} DAY, user_id, event_type, value, props
  FROM events WHERE event_type = 'error')"""

ORACLES["partition_extract"] = f"""
WITH {MERGED_CTE}
SELECT * FROM merged WHERE cast(ts AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-02-05' AND event_type <> 'click'"""


def _profile_rows() -> str:
    parts = []
    for name, kind in (("event_id", "num"), ("ts", "time"), ("user_id", "num"), ("event_type", "str"), ("value", "num"), ("props", "str")):
        empty = f"count_if({name} IS NULL OR {name} = '')" if kind == "str" else "NULL::BIGINT"
        pct = f"round({empty} * 100.0::DOUBLE / count(*), 2)" if kind == "str" else "NULL::DOUBLE"
        x = f"{name}::DOUBLE" if kind == "num" else "NULL::DOUBLE"
        parts.append(f"""SELECT '{name}' AS column_name, count(*) AS total_rows, count_if({name} IS NULL) AS nulls,
       round(count_if({name} IS NULL) * 100.0::DOUBLE / count(*), 2) AS null_pct, {empty} AS empties, {pct} AS empty_pct,
       count({x}) AS n_values, min({x}) AS lowest, max({x}) AS highest, round(avg({x}), 6) AS mean,
       round(stddev_samp({x}), 6) AS stddev FROM merged""")
    return "\nUNION ALL\n".join(parts)


ORACLES["incremental_profile"] = f"WITH {MERGED_CTE}\n{_profile_rows()}"
ORACLES["incremental_freshness"] = f"""
WITH {MERGED_CTE},
fresh AS ({O.ORACLES['daily_freshness'].replace('FROM events', 'FROM merged').replace(O.AS_OF, '2024-03-01')}),
shares AS (SELECT column_name, total_rows, null_pct FROM ({_profile_rows()}))
SELECT fresh.*, (SELECT max(total_rows) FROM shares) AS total_rows,
       (SELECT round(greatest(0, 100.0 - avg(null_pct)), 2) FROM shares) AS quality_score, 'Good' AS assessment
FROM fresh"""

ORACLES["percentile_sketches"] = """
SELECT event_type, count(value) AS n, true AS p50_within, true AS p95_within, true AS p99_within FROM events GROUP BY event_type"""
ORACLES["duplicate_sketches"] = f"""
SELECT *, true AS unique_within, true AS shared_within FROM ({O.ORACLES['row_profile']})"""

ORACLES["jsonl_rejects"] = f"""
WITH {O.BOOKING_CTE}
SELECT booking_id, n_items <> 3 AS accepted, CASE WHEN n_items <> 3 THEN CAST(fraud_flag AS BIGINT) END AS fraud_flag FROM booking"""
ORACLES["adhoc_sql_parameters"] = """
SELECT event_type, count(*) AS n, round(avg(value), 6) AS avg_value FROM events
WHERE value >= 10 AND props LIKE '{"k":%' GROUP BY event_type"""

GUESS_CTE = """guesses AS (
  SELECT o_orderpriority AS label,
         CASE WHEN substr(md5('p:' || cast(o_orderkey AS VARCHAR)), 1, 1) < 'a' THEN o_orderpriority
              WHEN substr(md5('p:' || cast(o_orderkey AS VARCHAR)), 1, 1) < 'f'
              THEN ['1-URGENT', '2-HIGH', '3-MEDIUM', '6-UNKNOWN'][o_orderkey % 4 + 1] END AS guess
  FROM orders)"""
ORACLES["confusion_cells"] = f"""
WITH {GUESS_CTE}
SELECT label, guess AS prediction, count(*) AS n FROM guesses WHERE guess IS NOT NULL GROUP BY ALL"""
ORACLES["multiclass_report"] = f"""
WITH {GUESS_CTE},
known AS (SELECT * FROM guesses WHERE label IS NOT NULL AND guess IS NOT NULL),
classes AS (SELECT label AS c FROM known UNION SELECT guess FROM known),
m AS (SELECT c, (SELECT count(*) FROM known WHERE label = c AND guess = c) AS hits,
             (SELECT count(*) FROM known WHERE label = c) AS support,
             (SELECT count(*) FROM known WHERE guess = c) AS predicted FROM classes),
r AS (SELECT *, coalesce(hits::DOUBLE / nullif(predicted, 0), 0) AS p, coalesce(hits::DOUBLE / nullif(support, 0), 0) AS r FROM m),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM r)
SELECT c AS class_label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score, support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hits)::DOUBLE / sum(support), 6), sum(support)::BIGINT FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::BIGINT FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
                 round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM f"""
ORACLES["multiclass_report_two"] = O.ORACLES["class_report"]

ORACLES["stream_accuracy_trend"] = f"""
WITH {O.BOOKING_CTE},
{O.TIMED_CTE},
j AS (SELECT t.*, CASE WHEN CAST(t.booking_id AS BIGINT) % 120 <= {L.LABEL_WITHIN_DAYS} THEN b.fraud_flag END AS fraud_flag
      FROM timed t JOIN booking b ON t.booking_id = b.booking_id)
SELECT date_trunc('month', booking_ts) AS period, count(*) AS n_predictions,
       count_if(fraud_flag IS NOT NULL) AS n_labelled, count_if(fraud_flag IS NULL) AS unlabelled,
       round(count_if(fraud_flag = fraud_prediction)::DOUBLE / nullif(count_if(fraud_flag IS NOT NULL), 0), 6) AS accuracy
FROM j GROUP BY 1"""
ORACLES["stream_scores_once"] = O.ORACLES["score_table"]

_DAY = 86400
ORACLES["stream_score_drift"] = f"""
WITH {O.BOOKING_CTE},
{O.TIMED_CTE},
b AS (SELECT CAST(least(greatest(floor(fraud_probability / 0.1), 0), 9) AS INTEGER) AS bin, booking_ts FROM timed
      WHERE fraud_probability IS NOT NULL),
starts AS (SELECT bin, booking_ts, (epoch(booking_ts)::BIGINT // {L.DRIFT_SLIDE_DAYS * _DAY} - k) * {L.DRIFT_SLIDE_DAYS * _DAY} AS s
           FROM b CROSS JOIN range({-(-L.DRIFT_WINDOW_DAYS // L.DRIFT_SLIDE_DAYS)}) AS r(k)),
h AS (SELECT s, bin, count(*) AS n FROM starts WHERE epoch(booking_ts) < s + {L.DRIFT_WINDOW_DAYS * _DAY} GROUP BY ALL),
base AS (SELECT bin, count(*) AS n_baseline FROM b WHERE year(booking_ts) = {Q.PSI_BASELINE} GROUP BY 1),
cells AS (SELECT w.s, x.bin, coalesce(h.n, 0) AS n, coalesce(base.n_baseline, 0) AS nb
          FROM (SELECT DISTINCT s FROM h) w CROSS JOIN range(10) AS x(bin)
          LEFT JOIN h ON h.s = w.s AND h.bin = x.bin LEFT JOIN base ON base.bin = x.bin),
shares AS (SELECT *, greatest(n::DOUBLE / sum(n) OVER (PARTITION BY s), 1e-6) AS a,
                  greatest(nb::DOUBLE / sum(nb) OVER (PARTITION BY s), 1e-6) AS e FROM cells)
SELECT make_timestamp(s * 1000000) AS window_start, make_timestamp((s + {L.DRIFT_WINDOW_DAYS * _DAY}) * 1000000) AS window_end,
       sum(n)::BIGINT AS n_current, round(sum((a - e) * ln(a / e)), 6) AS psi FROM shares GROUP BY s"""

ORACLES["explanation_checks"] = f"""
WITH {O.BOOKING_CTE},
{O.SPLIT_CTE}
SELECT member, count(*) AS n_rows, 0::BIGINT AS n_off FROM split CROSS JOIN (VALUES ('lr'), ('xgb'), ('lgb')) AS m(member)
WHERE split = 'test' GROUP BY member"""

ORACLES["evaluation_report_rows"] = f"""
WITH m AS ({O.ORACLES['evaluation_metrics']}),
r AS (SELECT class_label, precision, support, row_number() OVER (ORDER BY class_label) - 1 AS k FROM ({O.ORACLES['class_report']}))
SELECT 'fixed_score_ensemble' AS model_name, m.*, {', '.join(
    f"(SELECT {c} FROM r WHERE k = {k}) AS {c}_{k}" for k in range(5) for c in ("class_label", "precision", "support"))}
FROM m"""
ORACLES["performance_log"] = f"""
WITH m AS ({O.ORACLES['evaluation_metrics']}),
l AS (SELECT metric, value FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM m) ON COLUMNS(*) INTO NAME metric VALUE value))
SELECT 'fixed_score_ensemble' AS model_name, v AS version, '2024-02-01T00:00:00' AS timestamp, metric, value
FROM l CROSS JOIN (VALUES ('v1'), ('v2')) AS t(v)"""
ORACLES["table_schemas"] = "\nUNION ALL\n".join(
    f"SELECT table_name, (SELECT count(*) FROM {t}) AS row_count, count(*) OVER () AS column_count, "
    f"CAST(ordinal_position AS INTEGER) AS position, column_name AS name FROM information_schema.columns WHERE table_name = '{t}'"
    for t in ("orders", "lineitem", "events", "documents"))
