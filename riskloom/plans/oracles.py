"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code: plain SQL over the driver tables.
Column names equal the Spark query's, every computed column is aliased.
"""

from __future__ import annotations

from . import queries as Q

AS_OF = Q.AS_OF
SCORED_AT = Q.SCORED_AT

ORDERS_COLS = [("o_orderkey", "num"), ("o_custkey", "num"), ("o_orderstatus", "str"),
               ("o_totalprice", "num"), ("o_orderdate", "num"), ("o_orderpriority", "str")]

GAPS_CTE = """orders_gaps AS (
  SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
         CASE WHEN o_totalprice >= 5000 THEN o_totalprice END AS o_totalprice,
         o_orderdate,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS o_orderpriority
  FROM orders)"""

BOOKING_CTE = """li AS (
  SELECT l_orderkey, count(*) AS n_items, sum(l_quantity) AS qty_sum,
         round(avg(l_discount), 6) AS avg_discount, round(sum(l_extendedprice), 2) AS price_sum
  FROM lineitem GROUP BY l_orderkey),
booking AS (
  SELECT cast(o.o_orderkey AS VARCHAR) AS booking_id, o.o_totalprice AS total_price,
         li.n_items, li.qty_sum, li.avg_discount, li.price_sum,
         CAST(CASE WHEN (li.qty_sum > 130 AND li.avg_discount > 0.05)
                     <> (substr(md5('f:' || cast(o.o_orderkey AS VARCHAR)), 1, 1) = '0')
              THEN 1 ELSE 0 END AS INTEGER) AS fraud_flag
  FROM orders o JOIN li ON o.o_orderkey = li.l_orderkey)"""


def _quality_sql(source: str, cols) -> str:
    parts = ["count(*) AS total_rows"]
    pct = []
    for name, kind in cols:
        parts.append(f"count_if({name} IS NULL) AS {name}_nulls")
        parts.append(f"round(count_if({name} IS NULL) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS {name}_null_pct")
        pct.append(f"coalesce({name}_null_pct, 0)")
        if kind == "str":
            parts.append(f"count_if({name} IS NULL OR {name} = '') AS {name}_empty")
            parts.append(f"round(count_if({name} IS NULL OR {name} = '') * 100.0::DOUBLE / nullif(count(*), 0), 2) AS {name}_empty_pct")
    score = f"greatest(0, 100.0 - ({' + '.join(pct)}) / {len(pct)})"
    return f"""SELECT w.*, round({score}, 2) AS quality_score,
  CASE WHEN {score} >= 80 THEN 'Good' WHEN {score} >= 60 THEN 'Fair' ELSE 'Poor' END AS assessment
FROM (SELECT {', '.join(parts)} FROM {source}) w"""


ORACLES: dict[str, str] = {}

ORACLES["daily_counts"] = f"""
SELECT cast(ts AS DATE) AS date, count(*) AS row_count
FROM events
WHERE cast(ts AS DATE) >= DATE '{AS_OF}' - INTERVAL 30 DAY
GROUP BY cast(ts AS DATE)"""

ORACLES["daily_freshness"] = f"""
WITH daily AS (
  SELECT cast(ts AS DATE) AS date, count(*) AS row_count FROM events
  WHERE cast(ts AS DATE) >= DATE '{AS_OF}' - INTERVAL 30 DAY
  GROUP BY cast(ts AS DATE))
SELECT max(date) AS latest_date, min(date) AS earliest_date,
       round(avg(row_count), 6) AS avg_daily_rows,
       round(stddev_samp(row_count), 6) AS stddev_daily_rows,
       count(*) AS days_with_data,
       datediff('day', max(date), DATE '{AS_OF}') AS days_since_last_update,
       CASE WHEN datediff('day', max(date), DATE '{AS_OF}') IS NULL THEN 'No Data'
            WHEN datediff('day', max(date), DATE '{AS_OF}') = 0 THEN 'Current'
            WHEN datediff('day', max(date), DATE '{AS_OF}') <= 1 THEN 'Recent'
            WHEN datediff('day', max(date), DATE '{AS_OF}') <= 7 THEN 'Stale'
            ELSE 'Very Stale' END AS freshness_status
FROM daily"""

ORACLES["quality_report_orders"] = _quality_sql("orders", ORDERS_COLS)
ORACLES["quality_report_gaps"] = f"WITH {GAPS_CTE}\n" + _quality_sql("orders_gaps", ORDERS_COLS)

def _row_profile_sql(rows: str, ctes: str = "") -> str:
    return f"""
WITH {ctes} r AS ({rows}),
u AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM r))
SELECT count(*) AS total_rows, (SELECT n FROM u) AS unique_rows, count(*) - (SELECT n FROM u) AS duplicate_rows
FROM r"""


ORACLES["row_profile"] = _row_profile_sql("SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'P'")
ORACLES["row_profile_gaps"] = _row_profile_sql(
    "SELECT * FROM orders_gaps UNION ALL SELECT * FROM orders_gaps WHERE o_orderstatus IS NULL", GAPS_CTE + ",")

ORACLES["validation_gate"] = f"""
WITH {GAPS_CTE},
s AS (
  SELECT count(*) AS row_count,
         sum((o_orderkey IS NULL)::INT + (o_custkey IS NULL)::INT + (o_orderstatus IS NULL)::INT
             + (o_totalprice IS NULL)::INT + (o_orderdate IS NULL)::INT + (o_orderpriority IS NULL)::INT) AS null_cells
  FROM orders_gaps),
u AS (SELECT count(*) AS unique_rows FROM (SELECT DISTINCT * FROM orders_gaps))
SELECT row_count, round(null_cells::DOUBLE / nullif(row_count * 6, 0), 6) AS null_percentage,
       row_count - unique_rows AS duplicate_rows, 6 AS column_count,
       (row_count >= 1000 AND coalesce(null_cells::DOUBLE / nullif(row_count * 6, 0), 0) <= 0.1) AS is_valid
FROM s, u"""

ORACLES["null_drop"] = f"""
WITH {GAPS_CTE}
SELECT * FROM orders_gaps
WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL
  AND o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL"""

ORACLES["null_drop_report"] = f"""
WITH {GAPS_CTE}
SELECT count(*) AS initial_rows,
       count_if(NOT (o_orderkey IS NULL OR o_custkey IS NULL OR o_orderstatus IS NULL OR o_totalprice IS NULL
                     OR o_orderdate IS NULL OR o_orderpriority IS NULL)) AS rows_after_cleaning,
       count_if(o_orderkey IS NULL OR o_custkey IS NULL OR o_orderstatus IS NULL OR o_totalprice IS NULL
                OR o_orderdate IS NULL OR o_orderpriority IS NULL) AS removed_rows
FROM orders_gaps"""

ORACLES["booking"] = f"WITH {BOOKING_CTE}\nSELECT * FROM booking"


# ------------------------------------------------------ preparation / scoring

def _split_sql(src: str, key: str) -> str:
    """Test rows: the total rounded up; training rows shared among the classes
    by largest remainder; within a class the first by md5 of the key."""
    num, den = Q.TEST_SIZE_RATIO
    return f"""sizes AS (SELECT fraud_flag AS c, count(*)::HUGEINT AS n_c, (SELECT count(*) FROM {src})::HUGEINT AS n
               FROM {src} GROUP BY 1),
drawn AS (SELECT *, n - (n * {num} + {den} - 1) // {den} AS n_train FROM sizes),
shares AS (SELECT *, (n_train * n_c) // n AS whole, (n_train * n_c) % n AS rest FROM drawn),
quota AS (SELECT c, n_c - whole - CASE WHEN row_number() OVER (ORDER BY rest DESC, c NULLS FIRST)
                 <= n_train - sum(whole) OVER () THEN 1 ELSE 0 END AS n_test FROM shares),
split AS (
  SELECT s.*, CASE WHEN row_number() OVER (PARTITION BY fraud_flag
                                           ORDER BY md5('{Q.SPLIT_SEED}:' || coalesce({key}, '')), coalesce({key}, ''))
                        <= n_test THEN 'test' ELSE 'train' END AS split
  FROM {src} s JOIN quota q ON s.fraud_flag IS NOT DISTINCT FROM q.c)"""


SPLIT_CTE = _split_sql("booking", "booking_id")


def _scores(src: str) -> str:
    lr = "round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.04::DOUBLE * (qty_sum - 130) + 60.0::DOUBLE * (avg_discount - 0.05::DOUBLE)))), 6)"
    xgb = "round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.6::DOUBLE * (n_items - 5) + 30.0::DOUBLE * (avg_discount - 0.05::DOUBLE)))), 6)"
    lgb = "round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.00002::DOUBLE * (price_sum - 250000) + 0.02::DOUBLE * (qty_sum - 130)))), 6)"
    return f"""SELECT *, round((score_lr + score_xgb + score_lgb) / 3.0::DOUBLE, 6) AS fraud_probability
  FROM (SELECT *, {lr} AS score_lr, {xgb} AS score_xgb, {lgb} AS score_lgb FROM {src})"""


SCORED_CTE = f"scored AS ({_scores('booking')})"
TEST_CTE = f"""{SPLIT_CTE},
test AS ({_scores("(SELECT * EXCLUDE (split) FROM split WHERE split = 'test')")}),
test_pred AS (SELECT *, CAST(CASE WHEN fraud_probability > 0.5 THEN 1 ELSE 0 END AS BIGINT) AS fraud_prediction FROM test)"""

TIER = """CASE WHEN fraud_probability < 0.3 THEN 'LOW' WHEN fraud_probability < 0.7 THEN 'MEDIUM'
            WHEN fraud_probability IS NOT NULL THEN 'HIGH' END"""

PRED_CTE = f"""{SCORED_CTE},
pred AS (
  SELECT booking_id, fraud_probability,
         CAST(CASE WHEN fraud_probability > 0.5 THEN 1 ELSE 0 END AS BIGINT) AS fraud_prediction,
         {TIER} AS risk_category,
         TIMESTAMP '{SCORED_AT}' AS prediction_timestamp
  FROM scored)"""

ORACLES["class_balance"] = f"""
WITH {BOOKING_CTE}
SELECT count(*) AS total_samples, count_if(fraud_flag = 1) AS n_positive, count_if(fraud_flag = 0) AS n_negative,
       round(sum(fraud_flag)::DOUBLE / nullif(count(*), 0), 6) AS fraud_ratio,
       round(count_if(fraud_flag = 0)::DOUBLE / nullif(count_if(fraud_flag = 1), 0), 6) AS scale_pos_weight,
       round(count(*)::DOUBLE / nullif(2 * count_if(fraud_flag = 0), 0), 6) AS weight_negative,
       round(count(*)::DOUBLE / nullif(2 * count_if(fraud_flag = 1), 0), 6) AS weight_positive
FROM booking"""

ORACLES["stratified_split"] = f"WITH {BOOKING_CTE},\n{SPLIT_CTE}\nSELECT booking_id, fraud_flag, split FROM split"

ORACLES["dataset_profile"] = f"""
WITH {BOOKING_CTE},
{SPLIT_CTE}
SELECT count(*) AS total_samples, count_if(split = 'train') AS train_samples, count_if(split = 'test') AS test_samples,
       5 AS n_features, round(sum(fraud_flag)::DOUBLE / nullif(count(*), 0), 6) AS fraud_ratio
FROM split"""

ORACLES["soft_vote"] = f"""
WITH {BOOKING_CTE},
{SCORED_CTE}
SELECT booking_id, score_lr, score_xgb, score_lgb, fraud_probability FROM scored"""

ORACLES["score_table"] = f"WITH {BOOKING_CTE},\n{PRED_CTE}\nSELECT * FROM pred"

ORACLES["prediction_summary"] = f"""
WITH {BOOKING_CTE},
{PRED_CTE}
SELECT count(*) AS total_predictions, coalesce(sum(fraud_prediction), 0)::BIGINT AS fraud_predictions,
       count_if(risk_category = 'LOW') AS n_low, count_if(risk_category = 'MEDIUM') AS n_medium,
       count_if(risk_category = 'HIGH') AS n_high, round(avg(fraud_probability), 6) AS avg_fraud_probability
FROM pred"""

ORACLES["risk_tier_counts"] = f"""
WITH {BOOKING_CTE},
{PRED_CTE}
SELECT risk_category, count(*) AS n FROM pred GROUP BY risk_category"""

# ------------------------------------------------------------- evaluation

CONF_CTE = f"""{TEST_CTE},
conf AS (
  SELECT count_if(fraud_flag = 0 AND fraud_prediction = 0) AS true_negatives,
         count_if(fraud_flag = 0 AND fraud_prediction = 1) AS false_positives,
         count_if(fraud_flag = 1 AND fraud_prediction = 0) AS false_negatives,
         count_if(fraud_flag = 1 AND fraud_prediction = 1) AS true_positives
  FROM test_pred),
rates AS (
  SELECT *, coalesce(true_positives::DOUBLE / nullif(true_positives + false_positives, 0), 0) AS p1,
            coalesce(true_positives::DOUBLE / nullif(true_positives + false_negatives, 0), 0) AS r1,
            coalesce(true_negatives::DOUBLE / nullif(true_negatives + false_negatives, 0), 0) AS p0,
            coalesce(true_negatives::DOUBLE / nullif(true_negatives + false_positives, 0), 0) AS r0,
            true_negatives + false_positives AS s0, true_positives + false_negatives AS s1,
            (true_negatives + false_positives + false_negatives + true_positives) AS n
  FROM conf),
rates2 AS (
  SELECT *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1,
            coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
            (true_positives + true_negatives)::DOUBLE / nullif(n, 0) AS acc
  FROM rates)"""

ORACLES["confusion"] = f"""
WITH {BOOKING_CTE},
{CONF_CTE}
SELECT true_negatives, false_positives, false_negatives, true_positives,
       round(acc, 6) AS accuracy, round(p1, 6) AS precision, round(r1, 6) AS recall, round(f1, 6) AS f1_score
FROM rates2"""

ORACLES["class_report"] = f"""
WITH {BOOKING_CTE},
{CONF_CTE}
SELECT '0' AS class_label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, s0 AS support FROM rates2
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM rates2
UNION ALL SELECT 'accuracy', NULL, NULL, round(acc, 6), n FROM rates2
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM rates2
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / nullif(n, 0), 6), round((r0 * s0 + r1 * s1) / nullif(n, 0), 6),
                 round((f0 * s0 + f1 * s1) / nullif(n, 0), 6), n FROM rates2"""

ORACLES["business_impact"] = f"""
WITH {BOOKING_CTE},
{CONF_CTE}
SELECT true_negatives, false_positives, false_negatives, true_positives,
       true_positives * 1000.0::DOUBLE AS fraud_prevented_value, false_positives * 50.0::DOUBLE AS false_alarm_cost,
       false_negatives * 1000.0::DOUBLE AS missed_fraud_cost,
       true_positives * 1000.0::DOUBLE - false_positives * 50.0::DOUBLE - false_negatives * 1000.0::DOUBLE AS net_benefit
FROM conf"""


def _ranking_sql(src: str, label: str, score: str) -> str:
    """Exact AUC (ties half) and average precision from distinct-score counts."""
    return f"""g AS (SELECT {score} AS score, count_if({label} = 1) AS pos, count_if({label} = 0) AS neg
       FROM {src} WHERE {score} IS NOT NULL GROUP BY {score}),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cum_pos, sum(neg) OVER (ORDER BY score DESC) AS cum_neg,
             sum(pos) OVER () AS total_pos, sum(neg) OVER () AS total_neg FROM g)"""


ORACLES["auc_ap"] = f"""
WITH {BOOKING_CTE},
{TEST_CTE},
{_ranking_sql('test', 'fraud_flag', 'fraud_probability')}
SELECT round(sum(neg * (cum_pos - pos + pos / 2.0)) / nullif(max(total_pos) * max(total_neg), 0), 6) AS roc_auc,
       round(sum(CASE WHEN pos > 0 THEN pos * (cum_pos::DOUBLE / (cum_pos + cum_neg)) ELSE 0 END) / nullif(max(total_pos), 0), 6) AS pr_auc,
       coalesce(max(total_pos), 0)::BIGINT AS n_positive, coalesce(max(total_neg), 0)::BIGINT AS n_negative
FROM c"""

DOCS_CTE = """docs AS (SELECT l.doc_id, CAST(l.toxic AS INTEGER) AS label, CAST(d.n_chars AS DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

ORACLES["auc_ap_docs"] = f"""
WITH {DOCS_CTE},
{_ranking_sql('docs', 'label', 'score')}
SELECT round(sum(neg * (cum_pos - pos + pos / 2.0)) / nullif(max(total_pos) * max(total_neg), 0), 6) AS roc_auc,
       round(sum(CASE WHEN pos > 0 THEN pos * (cum_pos::DOUBLE / (cum_pos + cum_neg)) ELSE 0 END) / nullif(max(total_pos), 0), 6) AS pr_auc,
       coalesce(max(total_pos), 0)::BIGINT AS n_positive, coalesce(max(total_neg), 0)::BIGINT AS n_negative
FROM c"""

_ROC_SELECT = """, pts AS (
  SELECT *, lag(score) OVER (ORDER BY score DESC) AS prev_score,
         lead(pos) OVER (ORDER BY score DESC) AS next_pos, lead(neg) OVER (ORDER BY score DESC) AS next_neg FROM c)
SELECT score AS threshold, round(cum_neg::DOUBLE / nullif(total_neg, 0), 6) AS fpr,
       round(cum_pos::DOUBLE / nullif(total_pos, 0), 6) AS tpr FROM pts
WHERE prev_score IS NULL OR next_pos IS NULL OR NOT (next_pos = pos AND next_neg = neg)
UNION ALL SELECT 'Infinity'::DOUBLE, 0.0, 0.0 FROM c HAVING count(*) > 0"""

ORACLES["roc_curve"] = f"WITH {BOOKING_CTE},\n{TEST_CTE},\n{_ranking_sql('test', 'fraud_flag', 'fraud_probability')}{_ROC_SELECT}"
ORACLES["roc_curve_docs"] = f"WITH {DOCS_CTE},\n{_ranking_sql('docs', 'label', 'score')}{_ROC_SELECT}"

ORACLES["evaluation_metrics"] = f"""
WITH {BOOKING_CTE},
{CONF_CTE},
{_ranking_sql('test', 'fraud_flag', 'fraud_probability')},
rk AS (SELECT round(sum(neg * (cum_pos - pos + pos / 2.0)) / nullif(max(total_pos) * max(total_neg), 0), 6) AS roc_auc,
              round(sum(CASE WHEN pos > 0 THEN pos * (cum_pos::DOUBLE / (cum_pos + cum_neg)) ELSE 0 END) / nullif(max(total_pos), 0), 6) AS pr_auc
       FROM c)
SELECT rk.roc_auc, rk.pr_auc, round(acc, 6) AS accuracy, round(p1, 6) AS precision, round(r1, 6) AS recall,
       round(f1, 6) AS f1_score, true_negatives, false_positives, false_negatives, true_positives,
       true_positives * 1000.0::DOUBLE AS fraud_prevented_value, false_positives * 50.0::DOUBLE AS false_alarm_cost,
       false_negatives * 1000.0::DOUBLE AS missed_fraud_cost,
       true_positives * 1000.0::DOUBLE - false_positives * 50.0::DOUBLE - false_negatives * 1000.0::DOUBLE AS net_benefit
FROM rates2, rk"""


# ------------------------------------------------------------- importance

_FEATS = ["total_price", "n_items", "qty_sum", "avg_discount", "price_sum"]


def _importance_sql(src: str = "booking") -> str:
    a = []
    for f in _FEATS:
        x = f"{f}::DOUBLE"
        pos = f"avg(CASE WHEN fraud_flag = 1 THEN {x} END)"
        neg = f"avg(CASE WHEN fraud_flag = 0 THEN {x} END)"
        a += [f"abs(corr({x}, fraud_flag::DOUBLE)) AS {f}__lr",
              f"abs(({pos} - {neg}) / nullif(stddev_pop({x}), 0)) AS {f}__xgb",
              f"abs({pos} / nullif(avg({x}), 0) - 1) AS {f}__lgb"]
    longs = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f}__lr AS lr, {f}__xgb AS xgb, {f}__lgb AS lgb FROM a"
                               for f in _FEATS)
    return f"""a AS (SELECT {', '.join(a)} FROM {src}),
l AS ({longs}),
nrm AS (SELECT feature, lr / (sum(lr) OVER () + 1e-9) AS lr, xgb / (sum(xgb) OVER () + 1e-9) AS xgb,
               lgb / (sum(lgb) OVER () + 1e-9) AS lgb FROM l),
ranked AS (SELECT feature, round(lr, 6) AS lr, round(xgb, 6) AS xgb, round(lgb, 6) AS lgb,
                  round((lr + xgb + lgb) / 3, 6) AS avg_importance, (lr + xgb + lgb) / 3 AS raw FROM nrm)"""


IMP_CTE = _importance_sql()
ORACLES["importance_rank"] = f"WITH {BOOKING_CTE},\n{IMP_CTE}\nSELECT * EXCLUDE (raw) FROM ranked ORDER BY raw DESC, feature"
ORACLES["select_features"] = (f"WITH {BOOKING_CTE},\n{IMP_CTE}\nSELECT * EXCLUDE (raw) FROM ranked WHERE raw > {Q.IMPORTANCE_THRESHOLD}"
                              " ORDER BY raw DESC, feature")
ORACLES["top_features"] = f"WITH {BOOKING_CTE},\n{IMP_CTE}\nSELECT * EXCLUDE (raw) FROM ranked ORDER BY raw DESC, feature LIMIT 10"

ORACLES["run_metrics"] = f"""
WITH m AS ({ORACLES['evaluation_metrics']})
SELECT metric, value FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM m) ON COLUMNS(*) INTO NAME metric VALUE value)"""

# ------------------------------------------------------- extracts / views

_EXTRACT = f"""SELECT * FROM events
WHERE cast(ts AS DATE) >= DATE '{Q.EXTRACT_START}' AND cast(ts AS DATE) <= DATE '{Q.EXTRACT_END}'
  AND ({Q.EXTRACT_WHERE})"""
ORACLES["training_extract"] = _EXTRACT + "\nORDER BY ts DESC, event_id DESC"
ORACLES["training_extract_top"] = _EXTRACT + "\nORDER BY ts DESC, event_id DESC LIMIT 100"

ORACLES["training_view"] = f"""
WITH {BOOKING_CTE}
SELECT qty_sum, avg_discount, n_items, fraud_flag FROM booking WHERE qty_sum > 50"""

ORACLES["table_stats"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, "
    f"(SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS column_count FROM {t}"
    for t in Q.TABLE_NAMES)

ORACLES["adhoc_sql"] = Q.ADHOC_SQL

# ------------------------------------------------------------ monitoring

TIMED_CTE = f"""{PRED_CTE},
timed AS (SELECT p.*, o.o_orderdate AS booking_ts FROM pred p JOIN orders o ON p.booking_id = cast(o.o_orderkey AS VARCHAR))"""

ORACLES["accuracy_trend"] = f"""
WITH {BOOKING_CTE},
{TIMED_CTE},
j AS (SELECT t.*, b.fraud_flag FROM timed t LEFT JOIN booking b ON t.booking_id = b.booking_id)
SELECT date_trunc('month', booking_ts) AS period, count(*) AS n_predictions,
       count_if(fraud_flag IS NOT NULL) AS n_labelled, count_if(fraud_flag IS NULL) AS unlabelled,
       round(count_if(fraud_flag = fraud_prediction)::DOUBLE / nullif(count_if(fraud_flag IS NOT NULL), 0), 6) AS accuracy
FROM j GROUP BY 1"""

ORACLES["prediction_volume"] = f"""
WITH {BOOKING_CTE},
{TIMED_CTE}
SELECT date_trunc('month', booking_ts) AS period, count(*) AS n_predictions FROM timed GROUP BY 1"""

ORACLES["event_volume"] = "SELECT cast(ts AS DATE) AS period, count(*) AS n_predictions FROM events GROUP BY 1"

_PCT = ("round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, "
        "round(quantile_cont(value, 0.99), 6) AS p99, count(value) AS n")
ORACLES["value_percentiles"] = f"SELECT event_type, {_PCT} FROM events GROUP BY event_type"
ORACLES["value_percentiles_all"] = f"SELECT {_PCT} FROM events"
ORACLES["probability_percentiles"] = f"""
WITH {BOOKING_CTE},
{PRED_CTE}
SELECT risk_category, {_PCT.replace('value', 'fraud_probability')} FROM pred GROUP BY risk_category"""

ORACLES["error_rate"] = """
SELECT count(*) AS n_events, count_if(event_type = 'error') AS n_errors,
       round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS error_rate
FROM events"""
ORACLES["error_rate_daily"] = """
SELECT cast(ts AS DATE) AS date, count(*) AS n_events, count_if(event_type = 'error') AS n_errors,
       round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS error_rate
FROM events GROUP BY 1"""

PSI_CTE = f"""{TIMED_CTE},
t AS (SELECT *, year(booking_ts) AS year FROM timed),
c AS (SELECT CAST(least(greatest(floor((fraud_probability - 0.0) / 0.1), 0), 9) AS INTEGER) AS bin,
             count_if(year = {Q.PSI_BASELINE}) AS n_baseline, count_if(year = {Q.PSI_CURRENT}) AS n_current
      FROM t WHERE year IN ({Q.PSI_BASELINE}, {Q.PSI_CURRENT}) AND fraud_probability IS NOT NULL GROUP BY 1),
s AS (SELECT *, greatest(n_baseline::DOUBLE / sum(n_baseline) OVER (), 1e-6) AS e,
                greatest(n_current::DOUBLE / sum(n_current) OVER (), 1e-6) AS a FROM c),
bins AS (SELECT bin, n_baseline, n_current, round(e, 6) AS baseline_share, round(a, 6) AS current_share,
                round((a - e) * ln(a / e), 6) AS psi_contribution,
                (a - e) * ln(a / e) AS raw FROM s)"""
ORACLES["psi_bins"] = f"WITH {BOOKING_CTE},\n{PSI_CTE}\nSELECT * EXCLUDE (raw) FROM bins"
ORACLES["psi_total"] = f"WITH {BOOKING_CTE},\n{PSI_CTE}\nSELECT round(sum(raw), 6) AS psi, count(*) AS n_bins FROM bins"

# -------------------------------------------------------------- streaming

ORACLES["stream_scores"] = ORACLES["score_table"]

ORACLES["stream_daily_monitor"] = """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       count(*) AS n_events, count_if(event_type = 'error') AS n_errors,
       round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS error_rate
FROM events
GROUP BY 1, 2"""

# ------------------------------------------------- more table-health checks

DOC_COLS = [("doc_id", "num"), ("text", "str"), ("lang", "str"), ("source", "str"), ("n_chars", "num")]


def _column_profile_sql(source: str, cols) -> str:
    parts = []
    for name, kind in cols:
        if kind == "str":
            emp = f"count_if({name} IS NULL OR {name} = '')"
            e, ep = emp, f"round({emp} * 100.0::DOUBLE / nullif(count(*), 0), 2)"
        else:
            e, ep = "NULL::BIGINT", "NULL::DOUBLE"
        parts.append(f"SELECT '{name}' AS column_name, count(*) AS total_rows, count_if({name} IS NULL) AS nulls, "
                     f"round(count_if({name} IS NULL) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS null_pct, "
                     f"{e} AS empties, {ep} AS empty_pct FROM {source}")
    return "\nUNION ALL\n".join(parts)


ORACLES["daily_freshness_orders"] = (ORACLES["daily_freshness"]
                                     .replace("cast(ts AS DATE)", "cast(o_orderdate AS DATE)")
                                     .replace("FROM events", "FROM orders")
                                     .replace(AS_OF, Q.FRESHNESS_ORDERS_AS_OF))
ORACLES["column_profile_gaps"] = f"WITH {GAPS_CTE}\n" + _column_profile_sql("orders_gaps", ORDERS_COLS)
ORACLES["column_profile_documents"] = _column_profile_sql("documents", DOC_COLS)
ORACLES["quality_report_documents"] = _quality_sql("documents", DOC_COLS)
DOCS_TWICE = "SELECT * FROM documents UNION ALL SELECT * FROM documents WHERE lang = 'de'"
ORACLES["row_profile_documents"] = _row_profile_sql(DOCS_TWICE)
ORACLES["validation_gate_documents"] = f"""
WITH d AS ({DOCS_TWICE}),
s AS (SELECT count(*) AS row_count, sum((doc_id IS NULL)::INT + (text IS NULL)::INT + (lang IS NULL)::INT
                                        + (source IS NULL)::INT + (n_chars IS NULL)::INT) AS null_cells FROM d),
u AS (SELECT count(*) AS unique_rows FROM (SELECT DISTINCT * FROM d))
SELECT row_count, round(null_cells::DOUBLE / nullif(row_count * 5, 0), 6) AS null_percentage,
       row_count - unique_rows AS duplicate_rows, 5 AS column_count,
       (row_count >= 1000 AND coalesce(null_cells::DOUBLE / nullif(row_count * 5, 0), 0) <= 0.1) AS is_valid
FROM s, u"""

# ------------------------------------------------------- file round trips

ORACLES["csv_roundtrip"] = ORACLES["booking"]
ORACLES["jsonl_batch_scores"] = ORACLES["score_table"]
ORACLES["prediction_table_roundtrip"] = ORACLES["score_table"]
ORACLES["instance_scores"] = ORACLES["score_table"]


def _unpivot(stage: str, sql: str) -> str:
    return (f"SELECT '{stage}' AS stage, metric, value FROM "
            f"(UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM ({sql})) ON COLUMNS(*) INTO NAME metric VALUE value)")


_TRAIN_SPW = f"""WITH {BOOKING_CTE},
{SPLIT_CTE}
SELECT round(count_if(fraud_flag = 0)::DOUBLE / nullif(count_if(fraud_flag = 1), 0), 6) AS scale_pos_weight
FROM split WHERE split = 'train'"""
_TRAIN_NSEL = f"""WITH {BOOKING_CTE},
{SPLIT_CTE},
train AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'train'),
{_importance_sql('train')}
SELECT count(*) AS n_selected_features FROM ranked WHERE raw > {Q.IMPORTANCE_THRESHOLD}"""
ORACLES["stage_metrics"] = "\nUNION ALL\n".join([
    _unpivot("preprocess", ORACLES["dataset_profile"]),
    _unpivot("train", _TRAIN_SPW),
    _unpivot("train", _TRAIN_NSEL),
    _unpivot("evaluate", ORACLES["evaluation_metrics"]),
])

ORACLES["row_profile_documents_hashed"] = ORACLES["row_profile_documents"]

# ----------------------------------------- missing groups, keys and features

ORACLES["percentiles_null_group"] = (f"SELECT event_type, {_PCT} FROM (SELECT nullif(event_type, 'click') AS event_type, value "
                                     "FROM events) GROUP BY event_type")
ORACLES["auc_ap_ranges"] = f"""
WITH o AS (SELECT CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS label, o_totalprice / 7.0::DOUBLE AS score FROM orders),
{_ranking_sql('o', 'label', 'score')}
SELECT round(sum(neg * (cum_pos - pos + pos / 2.0)) / nullif(max(total_pos) * max(total_neg), 0), 6) AS roc_auc,
       round(sum(CASE WHEN pos > 0 THEN pos * (cum_pos::DOUBLE / (cum_pos + cum_neg)) ELSE 0 END) / nullif(max(total_pos), 0), 6) AS pr_auc,
       coalesce(max(total_pos), 0)::BIGINT AS n_positive, coalesce(max(total_neg), 0)::BIGINT AS n_negative
FROM c"""
ORACLES["score_table_gaps"] = f"""
WITH {BOOKING_CTE},
gaps AS (SELECT * REPLACE (CASE WHEN n_items <> 3 THEN qty_sum END AS qty_sum) FROM booking),
scored AS ({_scores('gaps')})
SELECT booking_id, fraud_probability,
       CAST(CASE WHEN fraud_probability > 0.5 THEN 1 WHEN fraud_probability IS NOT NULL THEN 0 END AS BIGINT) AS fraud_prediction,
       {TIER} AS risk_category, TIMESTAMP '{SCORED_AT}' AS prediction_timestamp
FROM scored"""
ORACLES["split_gaps"] = f"""
WITH {BOOKING_CTE},
keyed AS (SELECT fraud_flag, CASE WHEN n_items = 2 THEN NULL WHEN n_items <= 4 THEN substr(booking_id, 1, 1)
                                  ELSE booking_id END AS key FROM booking),
{_split_sql('keyed', 'key')}
SELECT fraud_flag, key, split, count(*) AS n FROM split GROUP BY ALL"""


def _feature_drift_sql() -> str:
    longs = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f}::DOUBLE AS x, year FROM t" for f in _FEATS)
    return f"""
WITH {BOOKING_CTE},
t AS (SELECT b.*, year(o.o_orderdate) AS year FROM booking b JOIN orders o ON b.booking_id = cast(o.o_orderkey AS VARCHAR)),
l AS (SELECT * FROM ({longs}) WHERE year IN ({Q.PSI_BASELINE}, {Q.PSI_CURRENT}) AND x IS NOT NULL),
edges AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM l WHERE year = {Q.PSI_BASELINE} GROUP BY 1),
cells AS (SELECT l.feature, coalesce(CASE WHEN hi > lo THEN least(greatest(floor((x - lo) / ((hi - lo) / 10)), 0), 9) END, 0) AS bin,
                 count_if(year = {Q.PSI_BASELINE}) AS nb, count_if(year = {Q.PSI_CURRENT}) AS nc
          FROM l LEFT JOIN edges USING (feature) GROUP BY 1, 2),
s AS (SELECT *, greatest(nb::DOUBLE / nullif(sum(nb) OVER (PARTITION BY feature), 0), 1e-6) AS e,
                greatest(nc::DOUBLE / nullif(sum(nc) OVER (PARTITION BY feature), 0), 1e-6) AS a FROM cells)
SELECT feature, round(CASE WHEN sum(nb) > 0 THEN sum((a - e) * ln(a / e)) END, 6) AS psi,
       sum(nb)::BIGINT AS n_baseline, sum(nc)::BIGINT AS n_current FROM s GROUP BY 1"""


ORACLES["feature_drift"] = _feature_drift_sql()

ORACLES["ensemble_checks"] = f"""
WITH {BOOKING_CTE},
{SPLIT_CTE}
SELECT count(*) AS n_scored, 0::BIGINT AS vote_differs, 0::BIGINT AS reload_differs,
       1.0::DOUBLE AS lr_total, 1.0::DOUBLE AS xgb_total, 1.0::DOUBLE AS lgb_total
FROM split WHERE split = 'test'"""
