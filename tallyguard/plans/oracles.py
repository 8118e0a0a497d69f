"""The same queries as plain SQL for a second engine."""

from __future__ import annotations


def _hash(text: str) -> str:
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN ({part}) / CAST({whole} AS DOUBLE) END"


TXNS = """
txns AS (
  SELECT event_id AS txn_id, user_id AS account_id, ts, value AS amount,
         event_type AS channel,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS device_k
  FROM events)"""

PREV = """
prev AS (
  SELECT *,
         lag(amount) OVER w AS prev_amount,
         (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS gap_seconds
  FROM txns WINDOW w AS (PARTITION BY account_id ORDER BY ts, txn_id))"""

LABELLED = f"""
labelled AS (
  SELECT *, CAST(CASE WHEN {_hash("CAST(txn_id AS VARCHAR)")} / 4294967296.0
    < 1 / (1 + exp(-(-4.0 + 0.03 * amount + 0.002 * coalesce(prev_amount, 0.0))))
    THEN 1 ELSE 0 END AS INTEGER) AS is_fraud
  FROM prev)"""

SCORED = """
scored AS (
  SELECT *, 1 / (1 + exp(-(-3.0 + 0.02 * amount + 0.004 * coalesce(prev_amount, 0.0)
    + 0.5 * CASE WHEN channel = 'purchase' THEN 1.0 ELSE 0.0 END))) AS p_fraud
  FROM labelled)"""

WITH_TXNS = f"WITH {TXNS}"
WITH_PREV = f"WITH {TXNS}, {PREV}"
WITH_LABEL = f"WITH {TXNS}, {PREV}, {LABELLED}"
WITH_SCORE = f"WITH {TXNS}, {PREV}, {LABELLED}, {SCORED}"

_SPANS = {"1h": "1 HOUR", "1d": "1 DAY", "7d": "7 DAY"}
_VELOCITY = ", ".join(
    f"count(*) OVER w_{s} AS n_{s}, round(sum(amount) OVER w_{s}, 9) AS sum_{s}, "
    f"round(avg(amount) OVER w_{s}, 9) AS avg_{s}"
    for s in _SPANS
)
_VELOCITY_WINDOWS = ", ".join(
    f"w_{s} AS (PARTITION BY account_id ORDER BY ts RANGE BETWEEN INTERVAL {length} "
    "PRECEDING AND CURRENT ROW)"
    for s, length in _SPANS.items()
)

HIST = """
hist AS (
  SELECT *, count(amount) OVER h AS hist_n, avg(amount) OVER h AS hist_mean,
         stddev_samp(amount) OVER h AS hist_sd
  FROM txns
  WINDOW h AS (PARTITION BY account_id ORDER BY ts, txn_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

_Z = "CASE WHEN hist_sd > 1e-9 THEN (amount - hist_mean) / hist_sd END"
_HISTORY = f"""hist_n, round(hist_mean, 9) AS hist_mean, round(hist_sd, 6) AS hist_sd,
  round({_Z}, 6) AS z_amount"""
_CALENDAR = """CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
  CAST(CASE WHEN hour(ts) < 6 THEN 1 ELSE 0 END AS INTEGER) AS is_night"""

_PREV_COLUMNS = "prev_amount, round(gap_seconds, 9) AS gap_seconds"

# Exact sums: whole units and units of 2^-52, both as integers.
_FINE = ", ".join(
    f"count(*) OVER w_{s} AS n_{s}, {{total}} AS sum_{s}, round({{bare}} / n_{s}, 9) AS avg_{s}".format(
        total=f"round(CAST(sum(u) OVER w_{s} AS DOUBLE) + CAST(sum(v) OVER w_{s} AS DOUBLE) / 4503599627370496.0, 9)",
        bare=f"(CAST(sum(u) OVER w_{s} AS DOUBLE) + CAST(sum(v) OVER w_{s} AS DOUBLE) / 4503599627370496.0)",
    )
    for s in _SPANS
)
_FINE_QUERY = f"""{WITH_TXNS}, fine AS (
  SELECT * REPLACE (amount / 7 AS amount) FROM txns),
units AS (
  SELECT *, CAST(round_even(amount, 0) AS HUGEINT) AS u,
         CAST(round_even((amount - round_even(amount, 0)) * 4503599627370496.0, 0) AS HUGEINT) AS v
  FROM fine)
SELECT txn_id, {_FINE} FROM units WINDOW {_VELOCITY_WINDOWS}"""

_PREV_QUERY = f"{WITH_PREV} SELECT txn_id, {_PREV_COLUMNS} FROM prev"
_VELOCITY_QUERY = f"{WITH_TXNS} SELECT txn_id, {_VELOCITY} FROM txns WINDOW {_VELOCITY_WINDOWS}"
_HISTORY_QUERY = f"{WITH_TXNS}, {HIST} SELECT txn_id, {_HISTORY}, {_CALENDAR} FROM hist"


def _report_line(column: str, as_text: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS rows, count(*) - count({column}) AS nulls,
      count(DISTINCT {column}) AS "distinct", {as_text.format(f"min({column})")} AS "min",
      {as_text.format(f"max({column})")} AS "max" FROM txns"""


_TEXT, _TIME = "CAST({} AS VARCHAR)", "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
_REPORT = " UNION ALL ".join(
    _report_line(c, _TIME if c == "ts" else _TEXT)
    for c in ("txn_id", "account_id", "ts", "amount", "channel", "device_k")
)


def _synth(tag: str) -> str:
    return _hash(f"'11:{tag}:' || CAST(txn_id AS VARCHAR)")


_SYNTH = f"""{WITH_TXNS}, twins AS (
  SELECT txn_id,
    CASE WHEN {_synth("hot")} / 4294967296.0 < 0.3 THEN 0
         ELSE {_synth("account")} % 200 + 1 END AS account_id,
    make_timestamp((1704067200 + {_synth("ts")} % 2592000) * 1000000) AS ts,
    greatest(0.01, round(-50.0 * ln(1.0 - CAST({_synth("amount")} AS DOUBLE) / 4294967296.0), 2)) AS amount,
    ['atm', 'card', 'online', 'pos', 'transfer'][{_synth("channel")} % 5 + 1] AS channel,
    CAST({_synth("device")} % 100 AS INTEGER) AS device_k
  FROM txns)
SELECT txn_id, CAST(account_id AS BIGINT) AS account_id, ts, amount, channel, device_k,
  CAST(CASE WHEN {_synth("fraud")} / 4294967296.0 < 1 / (1 + exp(-(-4.0 + 0.03 * amount)))
       THEN 1 ELSE 0 END AS INTEGER) AS is_fraud
FROM twins"""

_CLEAN = """
SELECT txn_id, account_id, ts, amount, coalesce(channel, 'unknown') AS channel,
       coalesce(device_k, -1) AS device_k
FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY ts DESC, account_id DESC,
        amount DESC, channel DESC NULLS LAST, device_k DESC NULLS LAST) AS rn
      FROM {source}
      WHERE txn_id IS NOT NULL AND account_id IS NOT NULL AND ts IS NOT NULL
        AND amount > 0 AND amount < CAST('inf' AS DOUBLE))
WHERE rn = 1"""

_LINES = """WITH lines AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS txn_id, l_suppkey AS account_id,
         CAST(l_shipdate AS TIMESTAMP) AS ts, l_extendedprice AS amount,
         l_returnflag AS channel, CAST(trunc(l_quantity) AS INTEGER) AS device_k
  FROM lineitem)"""

_FEATURES = f"""{WITH_PREV}, means AS (
  SELECT avg(prev_amount) AS m_prev, avg(gap_seconds) AS m_gap, avg(device_k) AS m_k,
         avg(amount) AS m_amount FROM prev),
filled AS (
  SELECT txn_id, channel, coalesce(amount, m_amount) AS amount,
         coalesce(prev_amount, m_prev) AS prev_amount,
         coalesce(gap_seconds, m_gap) AS gap_seconds,
         coalesce(CAST(device_k AS DOUBLE), m_k) AS device_k
  FROM prev, means),
spread AS (
  SELECT stddev_samp(amount) AS s_amount, stddev_samp(prev_amount) AS s_prev,
         stddev_samp(gap_seconds) AS s_gap, stddev_samp(device_k) AS s_k FROM filled),
kinds AS (
  SELECT channel, 1 / stddev_samp_kind AS kind FROM (
    SELECT c.channel,
           sqrt((n - n * n / CAST(total AS DOUBLE)) / (total - 1)) AS stddev_samp_kind
    FROM (SELECT channel, count(*) AS n FROM filled GROUP BY channel) c,
         (SELECT count(*) AS total FROM filled) t))
SELECT txn_id, f.channel, round(amount / s_amount, 6) AS f_amount,
       round(prev_amount / s_prev, 6) AS f_prev_amount,
       round(gap_seconds / s_gap, 6) AS f_gap_seconds,
       round(device_k / s_k, 6) AS f_device_k, round(kind, 6) AS f_kind
FROM filled f JOIN kinds USING (channel), spread"""

_CONFUSION_COUNTS = """
  SELECT count(*) FILTER (p_fraud >= {0} AND is_fraud = 1) AS tp,
         count(*) FILTER (p_fraud >= {0} AND is_fraud = 0) AS fp,
         count(*) FILTER (p_fraud < {0} AND is_fraud = 0) AS tn,
         count(*) FILTER (p_fraud < {0} AND is_fraud = 1) AS fn
  FROM scored"""

_CONFUSION = f"""{WITH_SCORE}, counts AS ({_CONFUSION_COUNTS.format(0.3)})
SELECT tp, fp, tn, fn, round({_ratio("tp", "(tp + fp)")}, 9) AS "precision",
       round({_ratio("tp", "(tp + fn)")}, 9) AS recall,
       round({_ratio("2 * tp", "(2 * tp + fp + fn)")}, 9) AS f1
FROM counts"""

_SWEEP = f"""{WITH_SCORE}, binned AS (
  SELECT b.bin, count(*) FILTER (is_fraud = 1) AS fraud, count(*) FILTER (is_fraud = 0) AS honest
  FROM (SELECT range AS bin FROM range(50)) b
  LEFT JOIN scored ON p_fraud >= b.bin / 50.0 AND (p_fraud < (b.bin + 1) / 50.0 OR b.bin = 49)
  GROUP BY 1),
swept AS (
  SELECT bin, CAST(sum(fraud) OVER (ORDER BY bin DESC) AS BIGINT) AS tp,
         CAST(sum(honest) OVER (ORDER BY bin DESC) AS BIGINT) AS fp,
         CAST(sum(fraud) OVER () AS BIGINT) AS p, CAST(sum(honest) OVER () AS BIGINT) AS n
  FROM binned)
SELECT bin, round(bin / 50.0, 9) AS threshold, tp, fp, p - tp AS fn, n - fp AS tn,
       round({_ratio("tp", "p")}, 9) AS tpr, round({_ratio("fp", "n")}, 9) AS fpr,
       round({_ratio("tp", "(tp + fp)")}, 9) AS "precision"
FROM swept"""

_AUC = f"""{WITH_SCORE}, coarse AS (SELECT is_fraud, round(p_fraud, 4) AS p FROM scored),
ranked AS (
  SELECT is_fraud, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS mid_rank
  FROM coarse),
totals AS (
  SELECT count(*) FILTER (is_fraud = 1) AS fraud, count(*) FILTER (is_fraud = 0) AS honest,
         CAST(sum(mid_rank) FILTER (is_fraud = 1) AS DOUBLE) AS ranks
  FROM ranked)
SELECT fraud, honest,
       round((ranks - fraud * (fraud + 1) / 2.0) / (CAST(fraud AS DOUBLE) * honest), 9) AS auc
FROM totals"""

_LOG_LOSS = f"""{WITH_SCORE}
SELECT count(*) AS rows,
  round(avg(-(is_fraud * ln(greatest(1e-15, least(1 - 1e-15, p_fraud)))
    + (1 - is_fraud) * ln(1 - greatest(1e-15, least(1 - 1e-15, p_fraud))))), 9) AS log_loss,
  round(avg((p_fraud - is_fraud) * (p_fraud - is_fraud)), 9) AS brier
FROM scored"""

# Every tenth score is NaN: no score.
_WITH_GAPS = WITH_SCORE.replace("scored AS (", "every AS (") + """, scored AS (
  SELECT * FROM every WHERE txn_id % 10 <> 0)"""
_CONFUSION_GAPS = f"""{WITH_SCORE}, counts AS (
  SELECT count(*) FILTER (p >= 0.3 AND is_fraud = 1) AS tp, count(*) FILTER (p >= 0.3 AND is_fraud = 0) AS fp,
         count(*) FILTER (NOT p >= 0.3 AND is_fraud = 0) AS tn, count(*) FILTER (NOT p >= 0.3 AND is_fraud = 1) AS fn
  FROM (SELECT is_fraud, CASE WHEN txn_id % 10 = 0 THEN -1 ELSE p_fraud END AS p FROM scored))
{_CONFUSION[_CONFUSION.index("SELECT tp, fp, tn, fn"):]}"""

_LOGGED = " UNION ALL ".join(
    f"""SELECT 'rule-{i}' AS run_id, 'rule' AS experiment,
  TIMESTAMP '2024-02-0{i} 00:00:00' AS started, '{threshold}' AS threshold,
  round({_ratio("tp", "(tp + fn)")}, 9) AS recall, CAST(tp + fp AS DOUBLE) AS flagged
FROM ({_CONFUSION_COUNTS.format(threshold)})"""
    for i, threshold in enumerate([0.1, 0.3, 0.5], start=1)
)

_RUNS = f"""{WITH_TXNS}, runs AS (
  SELECT 'run-' || account_id AS run_id, 'exp-' || (account_id % 7) AS experiment,
         min(ts) AS started, 'models/' || account_id AS model_path
  FROM txns GROUP BY account_id),
latest AS (
  SELECT 'run-' || account_id AS run_id, channel AS "key", amount AS "value"
  FROM (SELECT *, row_number() OVER (PARTITION BY account_id, channel
          ORDER BY date_trunc('day', ts) DESC, txn_id DESC, amount DESC) AS rn FROM txns)
  WHERE rn = 1)"""

_WINDOWS = f"""{WITH_TXNS}, mark AS (SELECT max(ts) - INTERVAL 1 HOUR AS watermark FROM txns),
days AS (
  SELECT account_id, date_trunc('day', ts) AS window_start, count(*) AS n,
         sum(CAST(amount AS DECIMAL(28, 8))) AS total
  FROM txns GROUP BY 1, 2)
SELECT account_id, CAST(window_start AS TIMESTAMP) AS window_start,
       CAST(window_start AS TIMESTAMP) + INTERVAL 1 DAY AS window_end, n,
       round(CAST(total AS DOUBLE), 9) AS total, round(CAST(total AS DOUBLE) / n, 9) AS average
FROM days, mark
WHERE CAST(window_start AS TIMESTAMP) + INTERVAL 1 DAY <= watermark"""

_ALL_FEATURES = f"""{WITH_TXNS}, {PREV}, {HIST.replace("FROM txns", "FROM prev")},
moving AS (SELECT *, {_VELOCITY} FROM hist WINDOW {_VELOCITY_WINDOWS})"""

_VELOCITY_NAMES = ", ".join(f"n_{s}, sum_{s}, avg_{s}" for s in _SPANS)

_SUSPICIOUS = f"""{WITH_TXNS}, good AS ({_CLEAN.format(source="txns")}),
{PREV.replace("FROM txns", "FROM good")}, {HIST.replace("FROM txns", "FROM prev")},
moving AS (
  SELECT *, count(*) OVER w AS n_1d, sum(amount) OVER w AS sum_1d, {_Z} AS z
  FROM hist WINDOW w AS (PARTITION BY account_id ORDER BY ts
    RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)),
rated AS (
  SELECT *, 1 / (1 + exp(-(-4.0 + 0.02 * amount + 0.004 * coalesce(prev_amount, 0.0)
    + 0.001 * sum_1d + 0.05 * n_1d + 0.3 * coalesce(z, 0.0)))) AS p
  FROM moving),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY p DESC, txn_id) AS rn
  FROM rated WHERE p >= 0.3)
SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(rn AS INTEGER) AS rank, txn_id, account_id, amount,
       n_1d, round(sum_1d, 9) AS sum_1d, round(z, 6) AS z_amount, round(p, 9) AS p_fraud
FROM ranked WHERE rn <= 5"""

_PREPARED = f"""{WITH_TXNS}, good AS ({_CLEAN.format(source="txns")}),
{PREV.replace("FROM txns", "FROM good")}, {LABELLED},
{HIST.replace("FROM txns", "FROM labelled")},
moving AS (SELECT *, {_VELOCITY} FROM hist WINDOW {_VELOCITY_WINDOWS})
SELECT strftime(ts, '%Y-%m-%d') AS day, txn_id, is_fraud, {_PREV_COLUMNS}, {_VELOCITY_NAMES},
       {_HISTORY}, {_CALENDAR}
FROM moving"""

ORACLES: dict[str, str] = {
    "suspicious_transactions": _SUSPICIOUS,
    "load_transactions": f"{WITH_TXNS} SELECT * FROM txns",
    "write_by_day": f"""{WITH_TXNS}
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows,
       CAST(sum(CAST(amount AS DECIMAL(28, 8))) AS DOUBLE) AS total
FROM txns GROUP BY 1""",
    "rename_korean": f"""{WITH_TXNS}
SELECT txn_id AS "거래번호", account_id AS "계좌번호", ts AS "거래일시", amount AS "거래금액",
       channel AS "거래유형", device_k FROM txns""",
    "synthesize": _SYNTH,
    "plant_fraud": f"{WITH_LABEL} SELECT txn_id, is_fraud FROM labelled",
    "quality_report": f"{WITH_TXNS} {_REPORT}",
    "clean_transactions": f"{WITH_TXNS} {_CLEAN.format(source='txns')}",
    "clean_repeated_keys": f"{_LINES} {_CLEAN.format(source='lines')}",
    "parse_props": """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.k') AS k_text FROM events""",
    "prev_features": _PREV_QUERY,
    "prev_features_hot": _PREV_QUERY,
    "velocity_features": _VELOCITY_QUERY,
    "velocity_features_hot": _VELOCITY_QUERY,
    "history_features": _HISTORY_QUERY,
    "history_features_hot": _HISTORY_QUERY,
    "account_features": f"""{_ALL_FEATURES}
SELECT txn_id, {_PREV_COLUMNS}, {_VELOCITY_NAMES}, {_HISTORY}, {_CALENDAR} FROM moving""",
    "train_test_split": f"""{WITH_TXNS}
SELECT txn_id, CASE WHEN {_hash("'split:' || CAST(txn_id AS VARCHAR)")} % 10000 >= 8000
       THEN 'test' ELSE 'train' END AS part FROM txns""",
    "class_weights": f"""{WITH_LABEL}, sizes AS (
  SELECT is_fraud, count(*) AS n FROM labelled GROUP BY 1)
SELECT txn_id, is_fraud,
       round((SELECT sum(n) FROM sizes) / ((SELECT count(*) FROM sizes) * CAST(n AS DOUBLE)), 9)
         AS class_weight
FROM labelled JOIN sizes USING (is_fraud)""",
    "feature_vectors": _FEATURES,
    "confusion": _CONFUSION,
    "threshold_sweep": _SWEEP,
    "confusion_gaps": _CONFUSION_GAPS,
    "threshold_sweep_gaps": _SWEEP.replace(WITH_SCORE, _WITH_GAPS),
    "log_loss_gaps": _LOG_LOSS.replace(WITH_SCORE, _WITH_GAPS),
    "auc_gaps": _AUC.replace(WITH_SCORE, _WITH_GAPS),
    "velocity_fine_amounts": _FINE_QUERY,
    "velocity_fine_amounts_hot": _FINE_QUERY,
    "prev_stream_bad_rows": _PREV_QUERY.replace(
        "FROM events)", "FROM events WHERE event_id % 11 <> 0 AND user_id % 13 <> 0)"
    ),
    "auc": _AUC,
    "log_loss": _LOG_LOSS,
    "log_runs": f"{WITH_SCORE} {_LOGGED}",
    "runs_table": f"""{_RUNS}
SELECT run_id, experiment, started, model_path, "key", "value"
FROM runs LEFT JOIN latest USING (run_id)""",
    "compare_runs": f"""{_RUNS}
SELECT r.run_id, experiment, started, model_path,
       CAST(CAST(substr(r.run_id, 5) AS BIGINT) % 2 AS VARCHAR) AS parity,
       c."value" AS click, p."value" AS purchase
FROM runs r
LEFT JOIN latest c ON c.run_id = r.run_id AND c."key" = 'click'
LEFT JOIN latest p ON p.run_id = r.run_id AND p."key" = 'purchase'""",
    "best_run": f"""{_RUNS}
SELECT run_id, experiment, started, model_path, purchase FROM (
  SELECT runs.*, "value" AS purchase, row_number() OVER (
    PARTITION BY experiment ORDER BY "value" DESC, started, run_id) AS rn
  FROM runs JOIN latest USING (run_id) WHERE "key" = 'purchase')
WHERE rn = 1""",
    "score_logistic": f"{WITH_SCORE} SELECT txn_id, is_fraud, round(p_fraud, 9) AS p_fraud FROM scored",
    "score_stream": f"""{WITH_TXNS}
SELECT txn_id, amount, round(1 / (1 + exp(-(-3.0 + 0.02 * amount
  + CASE WHEN channel = 'purchase' THEN 0.5 ELSE 0.0 END))), 9) AS p_fraud FROM txns""",
    "prev_stream": _PREV_QUERY,
    "velocity_stream": _WINDOWS,
    "prepare": _PREPARED,
    "alerts": f"""{WITH_SCORE}
SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(rn AS INTEGER) AS rank, txn_id, account_id,
       round(p_fraud, 9) AS p_fraud
FROM (SELECT *, row_number() OVER (PARTITION BY date_trunc('day', ts)
        ORDER BY p_fraud DESC, txn_id) AS rn FROM scored WHERE p_fraud >= 0.2)
WHERE rn <= 10""",
}

_PART = f"""{WITH_LABEL}, parts AS (
  SELECT *, {_hash("'split:' || CAST(txn_id AS VARCHAR)")} % 10000 >= 8000 AS held_out FROM labelled)"""
ORACLES |= {
    "alerts_gaps": ORACLES["alerts"].replace("WHERE p_fraud >= 0.2", "WHERE p_fraud >= 0.2 AND txn_id % 10 <> 0"),
    "korean_input": ORACLES["account_features"],
    "train_boosted": f"""{_PART}
SELECT CAST(count(*) FILTER (NOT held_out) AS INTEGER) AS train_rows, count(*) FILTER (held_out) AS test_rows,
       true AS ranks_well, 'amount' AS top_feature FROM parts""",
    "train_logistic_korean": f"""{_PART}
SELECT channel, count(*) AS rows, CAST(sum(is_fraud) AS BIGINT) AS expected_fraud
FROM parts WHERE NOT held_out GROUP BY channel""",
    "batch_score": "SELECT true AS same, count(*) AS rows FROM events",
    "prepare_train_score": """SELECT CAST(count(*) AS INTEGER) AS rows, 2 AS runs, 1 AS models, true AS at_most_k
FROM events""",
    "quality_report_approx": f"""SELECT * EXCLUDE ("distinct"), true AS near FROM ({ORACLES["quality_report"]})""",
}

ORACLES |= {
    "train_boosted2": f"""{_PART}
SELECT CAST(count(*) FILTER (NOT held_out) AS INTEGER) AS train_rows, count(*) FILTER (held_out) AS test_rows,
       true AS ranks_well, true AS calibrated, 'amount' AS top_feature FROM parts""",
    "log_runs_twice": f"SELECT *, 1 AS param_rows FROM ({ORACLES['log_runs']})",
    "score_stream_best": f"""{WITH_TXNS}
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows, count(*) AS equal_to_batch
FROM txns WHERE amount > 0 AND ts <= (SELECT max(ts) FROM txns WHERE amount > 0) - INTERVAL 1 HOUR GROUP BY day""",
}


def _released(lateness: str) -> str:
    """The features of the transactions that a watermark has passed when all input is read."""
    return f"""SELECT f.*, false AS late FROM ({ORACLES["account_features"]}) f
JOIN events e ON e.event_id = f.txn_id WHERE e.ts <= (SELECT max(ts) FROM events) - INTERVAL {lateness}"""


ORACLES |= {"account_stream": _released("1 HOUR"), "account_stream_out_of_order": _released("2 DAYS")}


def _best_split(node: str, rows: str) -> str:
    """CTEs of the best split of a set of rows, by the gain of second-order boosting."""
    return f"""{node}_sums AS (
  SELECT c.feature, c.name, c.edge, c.missing_left, sum(g) AS g, sum(h) AS h,
         coalesce(sum(g) FILTER (CASE WHEN f[c.feature] IS NULL THEN c.missing_left ELSE f[c.feature] < c.edge END), 0) AS gl,
         coalesce(sum(h) FILTER (CASE WHEN f[c.feature] IS NULL THEN c.missing_left ELSE f[c.feature] < c.edge END), 0) AS hl
  FROM ({rows}) r, cuts c GROUP BY ALL),
{node}_best AS (
  SELECT * FROM (
    SELECT *, g - gl AS gr, h - hl AS hr, (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) / 2 AS gain
    FROM {node}_sums WHERE hl >= 1 AND h - hl >= 1)
  WHERE gain > 0 ORDER BY round(gain, 9) DESC, feature, edge, missing_left DESC LIMIT 1)"""


def _splits() -> str:
    from tallyguard.plans.catalog import EDGES

    edges = ", ".join(f"({i}, '{name}', {edge}::DOUBLE)" for i, (name, found) in enumerate(EDGES.items(), start=1) for edge in [*found, "'Infinity'"])
    goes = "CASE WHEN f[b.feature] IS NULL THEN b.missing_left ELSE f[b.feature] < b.edge END"
    split = "SELECT '{0}' AS node, name AS feature, CASE WHEN edge < 'Infinity' THEN edge END AS below, missing_left, round(gain, 6) AS gain, round(g, 8) + 0.0 AS gradient, round(h, 8) AS hessian, NULL::DOUBLE AS value FROM {1}_best"
    leaf = "SELECT '{0}' AS node, NULL, NULL, NULL, NULL, round({2}, 8), round({3}, 8), round(-{2} / ({3} + 1) * 0.3, 6) FROM {1}_best"
    parts = [split.format("root", "n"), split.format("root-l", "l"), split.format("root-r", "r")]
    parts += [leaf.format(f"root-{a}-{b}", a, f"g{b}", f"h{b}") for a in "lr" for b in "lr"]
    # A side that nothing splits is a leaf.
    parts += [leaf.format(f"root-{a}", "n", f"g{a}", f"h{a}") + f" WHERE NOT EXISTS (SELECT 1 FROM {a}_best)" for a in "lr"]
    return f"""{WITH_LABEL}, share AS (SELECT avg(is_fraud) AS p FROM labelled),
known AS (SELECT [{", ".join(EDGES)}] AS f, p - is_fraud AS g, p * (1 - p) AS h FROM labelled, share),
cuts AS (SELECT * FROM (VALUES {edges}) AS e(feature, name, edge), (VALUES (true), (false)) AS s(missing_left)),
{_best_split("n", "SELECT * FROM known")},
{_best_split("l", f"SELECT k.* FROM known k, n_best b WHERE {goes}")},
{_best_split("r", f"SELECT k.* FROM known k, n_best b WHERE NOT {goes}")}
{" UNION ALL ".join(parts)}"""


ORACLES["boosted2_splits"] = _splits()
ORACLES["prepare_by_periods"] = ORACLES["prepare"]
ORACLES["encode_target"] = f"""{WITH_LABEL}, kinds AS (
  SELECT l.txn_id, l.is_fraud, l.account_id || '/' || extract(hour FROM l.ts) AS account_hour,
         {_hash("'fold:' || CAST(l.txn_id AS VARCHAR)")} % 4 AS fold FROM labelled l),
own AS (SELECT account_hour, fold, count(*) AS n, sum(is_fraud) AS y FROM kinds GROUP BY ALL),
every AS (SELECT account_hour, sum(n) AS n, sum(y) AS y FROM own GROUP BY ALL),
priors AS (SELECT fold, (SELECT sum(y) FROM own) - sum(y) AS y, (SELECT sum(n) FROM own) - sum(n) AS n FROM own GROUP BY fold)
SELECT txn_id, is_fraud, account_hour, round((e.y - o.y + 8.0::DOUBLE * (p.y / p.n)) / (e.n - o.n + 8.0::DOUBLE), 9) AS encoded
FROM kinds JOIN own o USING (account_hour, fold) JOIN every e USING (account_hour) JOIN priors p USING (fold)"""

_MIDDLE_DAYS = TXNS.rstrip()[:-1] + """
  WHERE date_trunc('day', ts) > (SELECT date_trunc('day', min(ts)) FROM events)
    AND date_trunc('day', ts) < (SELECT date_trunc('day', max(ts)) FROM events))"""
ORACLES["quality_report_days"] = f"""SELECT * EXCLUDE ("distinct"), true AS near, true AS median_near FROM (WITH {_MIDDLE_DAYS} {_REPORT})"""
ORACLES["alerts_stream"] = ORACLES["alerts"]
ORACLES["account_stream_hot"] = ORACLES["account_stream"]
