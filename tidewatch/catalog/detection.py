"""Queries for detectors, injection, evaluation, ensembles and thresholds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.catalog.fixtures import (
    LONG_SQL,
    SCORED_SQL,
    WIDE_COLUMNS,
    WIDE_SQL,
    long_series,
    scored_documents,
    table,
    wide_series,
)
from tidewatch.catalog.registry import query, r, rounded
from tidewatch.functions.hashing import hash_uniform
from tidewatch.operators import detect, ensemble, evaluate
from tidewatch.operators.inject import Drift, Intermittent, Spike, apply_plan, inject, random_plan
from tidewatch.plans.ordered import exact_quantile

KEYS = ["event_type", "event_id"]


def _frame(w: int) -> str:
    return f"(PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"


def threshold_sql(source: str, k: float = 3.0, c: str = "value") -> str:
    p = "OVER (PARTITION BY event_type)"
    return f"""SELECT *, coalesce({c} > avg({c}) {p} + {k} * stddev_samp({c}) {p}
      OR {c} < avg({c}) {p} - {k} * stddev_samp({c}) {p}, false) AS anomaly FROM ({source})"""


def moving_sql(source: str, w: int = 20, k: float = 2.5, c: str = "value") -> str:
    f = _frame(w)
    return f"""SELECT *, coalesce(CASE WHEN count({c}) OVER {f} = {w} THEN
      abs({c} - avg({c}) OVER {f}) > {k} * stddev_samp({c}) OVER {f} END, false) AS anomaly FROM ({source})"""


def robust_sql(source: str, w: int = 20, t: float = 3.0, c: str = "value") -> str:
    f = _frame(w)
    return f"""SELECT * EXCLUDE (off), abs(coalesce(CASE WHEN count(off) OVER {f} = {w} THEN
        0.6745 * off / (quantile_cont(abs(off), 0.5) OVER {f} + 1e-9) END, 0)) > {t} AS anomaly
      FROM (SELECT *, CASE WHEN count({c}) OVER {f} = {w} THEN {c} - quantile_cont({c}, 0.5) OVER {f} END AS off
        FROM ({source}))"""


@query("alert_rate_by_type", f"SELECT event_type, {r('avg(CAST(anomaly AS INTEGER))', 'anomaly_rate', 6)} FROM ({moving_sql(LONG_SQL)}) GROUP BY event_type")
def alert_rate(spark, sf):
    rows = detect.moving_average_detector(long_series(spark, sf), "value")
    return rounded(detect.anomaly_rate(rows, by=["event_type"]), ["event_type"], 6)


@query("threshold_bounds", f"SELECT event_type, {r('avg(value) - 3 * stddev_samp(value)', 'value_lower')}, {r('avg(value) + 3 * stddev_samp(value)', 'value_upper')} FROM events GROUP BY event_type")
def bounds(spark, sf):
    return rounded(detect.threshold_bounds(long_series(spark, sf)), ["event_type"])


@query("threshold_detector", f"SELECT event_type, event_id, anomaly FROM ({threshold_sql(LONG_SQL, 1.5)})")
def threshold(spark, sf):
    return detect.threshold_detector(long_series(spark, sf), "value", k=1.5).drop("ts", "value")


@query("moving_average_detector", f"SELECT event_type, event_id, anomaly FROM ({moving_sql(LONG_SQL)})")
def moving(spark, sf):
    return detect.moving_average_detector(long_series(spark, sf), "value").drop("ts", "value")


@query("robust_z_detector", f"SELECT event_type, event_id, anomaly FROM ({robust_sql(LONG_SQL)})")
def robust(spark, sf):
    return detect.robust_z_detector(long_series(spark, sf), "value").drop("ts", "value")


@query("robust_z_in_blocks", f"SELECT event_type, event_id, anomaly FROM ({robust_sql(LONG_SQL)})")
def robust_blocks(spark, sf):
    return detect.robust_z_detector(long_series(spark, sf, block_rows=600), "value").drop("ts", "value")


_BEYOND = " OR ".join(
    f"coalesce({c} > avg({c}) OVER () + 2 * stddev_samp({c}) OVER () OR {c} < avg({c}) OVER () - 2 * stddev_samp({c}) OVER (), false)"
    for c in WIDE_COLUMNS
)


@query("multi_sensor_label", f"SELECT strftime(hour, '%Y-%m-%d %H') AS hour, {_BEYOND} AS anomaly FROM ({WIDE_SQL})")
def multi(spark, sf):
    out = detect.multi_sensor_label(wide_series(spark, sf), k=2)
    return out.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "anomaly")


_DAY = "OVER (PARTITION BY date_trunc('day', ts))"


@query(
    "fallback_detector",
    f"""SELECT event_id, coalesce(value > avg(value) {_DAY} + 1.6 * stddev_pop(value) {_DAY}
      OR value < avg(value) {_DAY} - 1.6 * stddev_pop(value) {_DAY}, false) AS anomaly FROM events""",
)
def fallback(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day"))
    return detect.fallback_detector(df, ["value"], ["day"], k=1.6).select("event_id", "anomaly")


@query("anomaly_rate", f"SELECT event_type, {r('avg(CAST(anomaly AS INTEGER))', 'anomaly_rate', 6)} FROM ({threshold_sql(LONG_SQL, 1.5)}) GROUP BY event_type")
def rate_of_threshold(spark, sf):
    rows = detect.threshold_detector(long_series(spark, sf), "value", k=1.5)
    return rounded(detect.anomaly_rate(rows, by=["event_type"]), ["event_type"], 6)


@query(
    "series_statistics_on_rows",
    f"""SELECT event_type, event_id, {r('avg(value) OVER p', 'mean')}, {r('stddev_samp(value) OVER p', 'std')}
      FROM events WINDOW p AS (PARTITION BY event_type)""",
)
def statistics_on_rows(spark, sf):
    s = long_series(spark, sf)
    table_ = s.df.groupBy("event_type").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    return rounded(s.attach(s.df, table_).drop("ts", "value"), KEYS)


@query("label_balance", f"SELECT count(*) FILTER (WHERE toxic = 1) AS anomalies, count(*) FILTER (WHERE toxic = 0) AS normal, {r('count(*) FILTER (WHERE toxic = 0) / count(*) FILTER (WHERE toxic = 1)', 'positive_weight')} FROM labels")
def balance(spark, sf):
    return rounded(detect.label_balance(table(spark, sf, "labels"), "toxic"), [])


# Injection: positions are 0-based; deviations are those of the untouched series.
BASE_SQL = f"""SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS pos,
  count(*) OVER (PARTITION BY event_type) AS n, stddev_pop(value) OVER (PARTITION BY event_type) AS sd FROM ({LONG_SQL})"""


def _hash(i: int, name: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5(event_type || ':' || event_id || '|' || '{seed}:{i}:{name}'), 1, 8))::BIGINT / 4294967296.0)"


def _spike_sql(p: float, d: float, a: float) -> tuple[str, str]:
    mid, dur = f"floor(n * {p})", f"greatest(floor(n * {d}), 1)"
    inside = f"pos >= greatest({mid} - floor({dur} / 2), 0) AND pos < least(n, {mid} + floor({dur} / 2))"
    dist = f"(abs(pos - {mid}) / ({dur} / 2))"
    return f"({inside} AND abs(pos - {mid}) <= {dur} / 2)", f"{a} * (1 - {dist} * {dist})"


def _drift_sql(s: float, e: float, f: float) -> tuple[str, str]:
    a, b = f"floor(n * {s})", f"floor(n * {e})"
    return f"(pos >= {a} AND pos < {b})", f"{f} * (pos - {a}) / ({b} - {a})"


def _fault_sql(s: float, e: float, q: float, a: float, i: int = 0) -> tuple[str, str]:
    hit = f"(pos >= floor(n * {s}) AND pos < floor(n * {e}) AND {_hash(i, 'hit')} < {q})"
    return hit, f"(CASE WHEN {_hash(i, 'sign')} > 0.5 THEN 1 ELSE -1 END) * {a} * {_hash(i, 'size')}"


def injected_sql(hit: str, change: str) -> str:
    return f"""SELECT event_type, event_id, ts, value + CASE WHEN {hit} THEN {change} * sd ELSE 0 END AS value,
      {hit} AS value_anomaly FROM ({BASE_SQL})"""


def _inject_query(name: str, anomaly, sql: tuple[str, str], block_rows: int = 1_000_000):
    @query(name, f"SELECT event_type, event_id, {r('value', 'value')}, value_anomaly FROM ({injected_sql(*sql)})")
    def run(spark, sf):
        out = inject(long_series(spark, sf, block_rows=block_rows), [anomaly])
        return rounded(out.drop("ts"), KEYS)


_inject_query("inject_spike", Spike("value", 0.3, 0.05, 4.0), _spike_sql(0.3, 0.05, 4.0))
_inject_query("inject_drift", Drift("value", 0.6, 0.8, 2.0), _drift_sql(0.6, 0.8, 2.0), 800)
_inject_query("inject_intermittent", Intermittent("value", 0.3, 0.5, 0.3, 3.0), _fault_sql(0.3, 0.5, 0.3, 3.0))

PLAN = """{"anomalies": [
  {"type": "spike", "sensor": "value", "position_ratio": 0.3, "duration_ratio": 0.02, "amplitude_factor": 4.0},
  {"type": "drift", "sensor": "value", "start_ratio": 0.5, "end_ratio": 0.7, "drift_factor": 1.5}]}"""


def _plan_sql() -> str:
    hit1, change1 = _spike_sql(0.3, 0.02, 4.0)
    hit2, change2 = _drift_sql(0.5, 0.7, 1.5)
    return f"""WITH one AS (SELECT * EXCLUDE (value, sd), value + CASE WHEN {hit1} THEN {change1} * sd ELSE 0 END AS value,
        {hit1} AS first_hit FROM ({BASE_SQL})),
      two AS (SELECT *, stddev_pop(value) OVER (PARTITION BY event_type) AS sd FROM one)
      SELECT event_type, event_id, ts, value + CASE WHEN {hit2} THEN {change2} * sd ELSE 0 END AS value,
        first_hit OR {hit2} AS value_anomaly FROM two"""


@query("apply_anomaly_plan", f"SELECT event_type, event_id, {r('value', 'value')}, value_anomaly FROM ({_plan_sql()})")
def plan(spark, sf):
    return rounded(apply_plan(long_series(spark, sf), PLAN).drop("ts"), KEYS)


@query(
    "injected_truth",
    f"SELECT event_type, count(*) FILTER (WHERE value_anomaly) AS flagged FROM ({_plan_sql()}) GROUP BY event_type",
)
def truth(spark, sf):
    out = apply_plan(long_series(spark, sf), PLAN)
    return out.groupBy("event_type").agg(F.count_if("value_anomaly").alias("flagged"))


RANDOM_PLAN = random_plan(["value"], 4, seed=7)


def _anomaly_sql(i: int, a) -> tuple[str, str]:
    if isinstance(a, Spike):
        return _spike_sql(a.position_ratio, a.duration_ratio, a.amplitude_factor)
    if isinstance(a, Drift):
        return _drift_sql(a.start_ratio, a.end_ratio, a.drift_factor)
    return _fault_sql(a.start_ratio, a.end_ratio, a.frequency, a.amplitude_factor, i)


def _steps_sql(plan) -> str:
    """Anomalies one after the other, each scaled by the deviation its predecessor left."""
    steps = [f"s0 AS (SELECT *, false AS hit FROM ({BASE_SQL}))"]
    for i, a in enumerate(plan):
        hit, change = _anomaly_sql(i, a)
        steps.append(
            f"""s{i + 1} AS (SELECT * EXCLUDE (value, sd, hit, value2), value2 AS value, hit,
              stddev_pop(value2) OVER (PARTITION BY event_type) AS sd
              FROM (SELECT * EXCLUDE (hit), value + CASE WHEN {hit} THEN {change} * sd ELSE 0 END AS value2,
                hit OR {hit} AS hit FROM s{i}))"""
        )
    return f"WITH {', '.join(steps)} SELECT event_type, event_id, value, hit AS value_anomaly FROM s{len(plan)}"


@query("random_anomaly_plan", f"SELECT event_type, event_id, {r('value', 'value')}, value_anomaly FROM ({_steps_sql(RANDOM_PLAN)})")
def random_anomalies(spark, sf):
    return rounded(inject(long_series(spark, sf), RANDOM_PLAN).drop("ts"), KEYS)


_HIT = _spike_sql(0.3, 0.02, 4.0)
_SPIKED = injected_sql(*_HIT)
_DETECTORS = {
    "threshold": (detect.threshold_detector, {"k": 2.0}, threshold_sql(_SPIKED, 2.0)),
    "moving_average": (detect.moving_average_detector, {"window": 20, "k": 2.5}, moving_sql(_SPIKED)),
    "robust_z": (detect.robust_z_detector, {"window": 20, "t": 3.0}, robust_sql(_SPIKED)),
}


def _spiked(spark, sf):
    s = long_series(spark, sf)
    return s.with_df(inject(s, [Spike("value", 0.3, 0.02, 4.0)]))


def _counts_sql(name: str, i: int) -> str:
    rows = _DETECTORS[name][2]
    return f"""SELECT '{name}' AS detector, 'value' AS sensor, event_type, {i} AS listing,
      count(*) FILTER (WHERE anomaly AND value_anomaly) AS tp, count(*) FILTER (WHERE anomaly AND NOT value_anomaly) AS fp,
      count(*) FILTER (WHERE NOT anomaly AND value_anomaly) AS fn,
      count(*) FILTER (WHERE NOT anomaly AND NOT value_anomaly) AS tn FROM ({rows}) GROUP BY event_type"""


_RATES = """CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS recall,
  CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0 END AS f1"""
_COMPARED = "SELECT *, " + _RATES + " FROM (" + " UNION ALL ".join(_counts_sql(n, i) for i, n in enumerate(_DETECTORS)) + ")"
_RATE_CELLS = ", ".join(r(c, c) for c in ("precision", "recall", "f1"))


@query("evaluate_detector", f"SELECT detector, sensor, event_type, tp, fp, fn, tn, {_RATE_CELLS} FROM ({_COMPARED}) WHERE detector = 'moving_average'")
def evaluated(spark, sf):
    out = evaluate.evaluate_detector(
        _spiked(spark, sf), detect.moving_average_detector, {"value": "value_anomaly"}, "moving_average", window=20, k=2.5
    )
    return rounded(out, ["event_type"])


def _comparison(spark, sf):
    detectors = {n: (fn, args) for n, (fn, args, _) in _DETECTORS.items()}
    return evaluate.compare_detectors(_spiked(spark, sf), detectors, {"value": "value_anomaly"})


@query("compare_detectors", f"SELECT detector, sensor, event_type, CAST(listing AS INTEGER) AS listing, tp, fp, fn, tn, {_RATE_CELLS} FROM ({_COMPARED})")
def compared(spark, sf):
    return rounded(_comparison(spark, sf), ["event_type"])


@query("best_detector", f"""SELECT event_type, arg_max(detector, (round(f1, 9), -listing)) AS best_detector, {r('max(f1)', 'best_f1')}
  FROM ({_COMPARED}) GROUP BY event_type""")
def best(spark, sf):
    out = _comparison(spark, sf).withColumn("f1", F.round("f1", 9))
    return rounded(evaluate.best_detector(out, ["event_type"]), ["event_type"])


_PRED_SQL = f"SELECT *, CASE WHEN score > 1500 THEN 1 ELSE 0 END AS pred FROM ({SCORED_SQL})"


def _predicted(spark, sf):
    return scored_documents(spark, sf).withColumn("pred", (F.col("score") > 1500).cast("int"))


_COUNTS = """count(*) FILTER (WHERE pred = 1 AND toxic = 1) AS tp, count(*) FILTER (WHERE pred = 1 AND toxic = 0) AS fp,
  count(*) FILTER (WHERE pred = 0 AND toxic = 1) AS fn, count(*) FILTER (WHERE pred = 0 AND toxic = 0) AS tn"""


@query("confusion_counts", f"SELECT quality, {_COUNTS} FROM ({_PRED_SQL}) GROUP BY quality")
def confusion(spark, sf):
    return evaluate.confusion_counts(_predicted(spark, sf), "pred", "toxic", ["quality"])


@query("precision_recall_f1", f"SELECT quality, tp, fp, fn, tn, {_RATE_CELLS} FROM (SELECT *, {_RATES} FROM (SELECT quality, {_COUNTS} FROM ({_PRED_SQL}) GROUP BY quality))")
def rates(spark, sf):
    out = evaluate.with_rates(evaluate.confusion_counts(_predicted(spark, sf), "pred", "toxic", ["quality"]))
    return rounded(out, ["quality"])


@query("truth_join", f"SELECT m.event_type, m.event_id, m.anomaly, t.value_anomaly FROM ({moving_sql(LONG_SQL)}) m JOIN ({_SPIKED}) t ON m.event_id = t.event_id AND m.event_type = t.event_type")
def joined_truth(spark, sf):
    s = long_series(spark, sf)
    predictions = detect.moving_average_detector(s, "value").drop("value")
    tracked = inject(s, [Spike("value", 0.3, 0.02, 4.0)]).drop("value")
    return evaluate.truth_versus_prediction(predictions, tracked, s.identity).drop("ts")


_REPORT_SQL = f"""WITH rows AS ({_PRED_SQL}), classes AS (SELECT unnest([0, 1]) AS c),
  per AS (SELECT CAST(c AS VARCHAR) AS class, count(*) FILTER (WHERE toxic = c AND pred = c) AS hit,
      count(*) FILTER (WHERE toxic = c) AS support, count(*) FILTER (WHERE pred = c) AS named FROM rows, classes GROUP BY c),
  m AS (SELECT class, support, hit, CASE WHEN named > 0 THEN hit / named ELSE 0 END AS precision,
      CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall FROM per),
  f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m),
  t AS (SELECT class, precision, recall, f1, support FROM f
    UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f)
  SELECT class, {_RATE_CELLS}, support FROM t"""


@query("classification_report", _REPORT_SQL)
def report(spark, sf):
    return rounded(evaluate.classification_report(_predicted(spark, sf), "pred", "toxic"), [])


_CURVE_SQL = f"""SELECT score AS threshold, sum(toxic) AS p, count(*) - sum(toxic) AS q FROM ({SCORED_SQL}) GROUP BY score"""
_CUM_SQL = f"""SELECT threshold, p, q, sum(p) OVER (ORDER BY threshold DESC) AS cp, sum(q) OVER (ORDER BY threshold DESC) AS cq,
  sum(p) OVER () AS ap, sum(q) OVER () AS aq FROM ({_CURVE_SQL})"""


@query("roc_curve", f"SELECT threshold, {r('cq / aq', 'fpr')}, {r('cp / ap', 'tpr')} FROM ({_CUM_SQL})")
def roc(spark, sf):
    return rounded(evaluate.roc_curve(scored_documents(spark, sf), "score", "toxic"), ["threshold"])


@query("roc_curve_in_blocks", f"SELECT threshold, {r('cq / aq', 'fpr')}, {r('cp / ap', 'tpr')} FROM ({_CUM_SQL})")
def roc_blocks(spark, sf):
    out = evaluate.roc_curve(scored_documents(spark, sf), "score", "toxic", block_rows=50)
    return rounded(out, ["threshold"])


@query("roc_auc", f"SELECT {r('sum(q * (cp - p / 2)) / max(ap * aq)', 'roc_auc', 6)} FROM ({_CUM_SQL})")
def auc(spark, sf):
    return rounded(evaluate.roc_auc(scored_documents(spark, sf), "score", "toxic"), [], 6)


@query("pr_curve", f"SELECT threshold, {r('cp / (cp + cq)', 'precision')}, {r('cp / ap', 'recall')} FROM ({_CUM_SQL})")
def pr(spark, sf):
    return rounded(evaluate.pr_curve(scored_documents(spark, sf), "score", "toxic"), ["threshold"])


_SWEEP_SQL = f"""WITH s AS (SELECT toxic, (score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()) AS x FROM ({SCORED_SQL})),
  grid AS (SELECT unnest(range(0, 100)) / 99.0::DOUBLE AS threshold)
  SELECT threshold, 2 * tp / (2 * tp + fp + fn)::DOUBLE AS f1 FROM (SELECT threshold,
    count(*) FILTER (WHERE x > threshold AND toxic = 1) AS tp, count(*) FILTER (WHERE x > threshold AND toxic = 0) AS fp,
    count(*) FILTER (WHERE x <= threshold AND toxic = 1) AS fn FROM s, grid GROUP BY threshold)"""


@query("f1_sweep", f"SELECT {r('threshold', 'threshold', 6)}, {r('f1', 'f1')} FROM ({_SWEEP_SQL})")
def sweep(spark, sf):
    out = evaluate.f1_sweep(scored_documents(spark, sf), "score", "toxic")
    return rounded(rounded(out, ["threshold"]), ["f1"], 6)


@query("optimal_threshold", f"SELECT {r('arg_max(threshold, (f1, -threshold))', 'optimal_threshold')}, {r('max(f1)', 'optimal_f1')} FROM ({_SWEEP_SQL})")
def optimal(spark, sf):
    out = evaluate.f1_sweep(scored_documents(spark, sf), "score", "toxic")
    return rounded(evaluate.optimal_threshold(out), [])


@query(
    "evaluate_model",
    f"""SELECT model, metric, {r('"at"', '"at"')}, {r('value', 'value')} FROM (
      SELECT 'length' AS model, class || ' ' || m AS metric, NULL::DOUBLE AS "at", v AS value FROM (
        UNPIVOT (SELECT class, precision, recall, f1 FROM ({_REPORT_SQL})) ON precision, recall, f1 INTO NAME m VALUE v)
      UNION ALL SELECT 'length', m, NULL, v::DOUBLE FROM (UNPIVOT (SELECT {_COUNTS} FROM ({_PRED_SQL})) ON tp, fp, fn, tn INTO NAME m VALUE v)
      UNION ALL SELECT 'length', 'roc_auc', NULL, sum(q * (cp - p / 2)) / max(ap * aq) FROM ({_CUM_SQL})
      UNION ALL SELECT 'length', 'roc fpr', threshold, cq / aq FROM ({_CUM_SQL})
      UNION ALL SELECT 'length', 'roc tpr', threshold, cp / ap FROM ({_CUM_SQL})
      UNION ALL SELECT 'length', 'pr precision', threshold, cp / (cp + cq) FROM ({_CUM_SQL})
      UNION ALL SELECT 'length', 'pr recall', threshold, cp / ap FROM ({_CUM_SQL})
      UNION ALL SELECT 'length', 'sweep f1', threshold, f1 FROM ({_SWEEP_SQL})
      UNION ALL SELECT 'length', 'optimal_threshold', NULL, arg_max(threshold, (f1, -threshold)) FROM ({_SWEEP_SQL})
      UNION ALL SELECT 'length', 'optimal_f1', NULL, max(f1) FROM ({_SWEEP_SQL}))""",
)
def model_metrics(spark, sf):
    return rounded(evaluate.evaluate_model(_predicted(spark, sf), "length", "pred", "toxic", score="score"), [])


@query("train_test_split", "SELECT event_id, ('0x' || substr(md5(event_id || '|42'), 1, 8))::BIGINT / 4294967296.0 < 0.3 AS test FROM events")
def split(spark, sf):
    df = table(spark, sf, "events").select("event_id")
    train, test = evaluate.train_test_split(df, F.col("event_id").cast("string"))
    return train.withColumn("test", F.lit(False)).unionByName(test.withColumn("test", F.lit(True)))


@query("hash_uniform", "SELECT event_id, ('0x' || substr(md5(event_id || '|7'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM events")
def uniform(spark, sf):
    df = table(spark, sf, "events")
    return df.select("event_id", hash_uniform(F.col("event_id").cast("string"), 7).alias("u"))


@query("time_split", f"""SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id)
  > floor(count(*) OVER (PARTITION BY event_type) * 0.7::DOUBLE) AS test FROM ({LONG_SQL})""")
def by_time(spark, sf):
    train, test = evaluate.time_split(long_series(spark, sf))
    return train.select("event_id", F.lit(False).alias("test")).unionByName(test.select("event_id", F.lit(True).alias("test")))


@query("exact_quantile", f"SELECT event_type, {r('quantile_cont(value, 0.95)', 'p95')} FROM events GROUP BY event_type")
def quantile(spark, sf):
    df = table(spark, sf, "events").select("event_type", "value")
    return rounded(exact_quantile(df, "value", 0.95, ["event_type"], "p95", block_rows=400), ["event_type"])


# Model outputs by fixed rules of the value, one of each kind of model.
VOTES_SQL = """SELECT event_id, event_type, ts, value, CAST(value > 60 AS INTEGER) AS pred_isolation_forest,
  CAST(value > 40 AND event_id % 3 = 0 AS INTEGER) AS pred_random_forest,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(event_id % 4 = 0 AS INTEGER) END AS pred_lstm_autoencoder,
  value AS score_isolation_forest, value / 120 AS prob_random_forest, value * (event_id % 4 + 1) AS score_lstm_autoencoder
  FROM events"""
_MODELS = ["isolation_forest", "random_forest", "lstm_autoencoder"]
_THRESHOLDS = {"isolation_forest": 55.0, "lstm_autoencoder": 90.0}


def votes(spark, sf):
    df = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    v, i = F.col("value"), F.col("event_id")
    return df.select(
        "event_id", "event_type", "ts", "value",
        (v > 60).cast("int").alias("pred_isolation_forest"),
        ((v > 40) & (i % 3 == 0)).cast("int").alias("pred_random_forest"),
        F.when(i % 10 != 0, (i % 4 == 0).cast("int")).alias("pred_lstm_autoencoder"),
        v.alias("score_isolation_forest"), (v / 120).alias("prob_random_forest"),
        (v * (i % 4 + 1)).alias("score_lstm_autoencoder"),
    )


def _vote_sql(weights: dict[str, float]) -> str:
    said = " + ".join(f"coalesce(pred_{m}, 0) * {w}" for m, w in weights.items())
    there = " + ".join(f"CASE WHEN pred_{m} IS NULL THEN 0 ELSE {w} END" for m, w in weights.items())
    return f"SELECT event_id, CASE WHEN {said} > ({there}) / 2 THEN 1 ELSE 0 END AS ensemble FROM ({VOTES_SQL})"


@query("majority_vote", _vote_sql(dict.fromkeys(_MODELS, 1.0)))
def majority(spark, sf):
    return ensemble.combine(votes(spark, sf), "majority_vote").select("event_id", "ensemble")


@query("weighted_vote", _vote_sql({"isolation_forest": 1.0, "random_forest": 1.5, "lstm_autoencoder": 2.0}))
def weighted(spark, sf):
    return ensemble.combine(votes(spark, sf), "weighted_vote").select("event_id", "ensemble")


def _unit(c: str) -> str:
    return f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())"


@query(
    "max_probability",
    f"""SELECT event_id, CASE WHEN greatest(prob_random_forest, {_unit('score_isolation_forest')},
      {_unit('score_lstm_autoencoder')}) > 0.5 THEN 1 ELSE 0 END AS ensemble FROM ({VOTES_SQL})""",
)
def max_prob(spark, sf):
    return ensemble.combine(votes(spark, sf), "max_probability").select("event_id", "ensemble")


def _conf_sql(m: str, t: float) -> str:
    return f"(1 / (1 + exp(-5 * (score_{m} - {t}) / ({t} + 1e-10))))"


_CONF = {m: _conf_sql(m, t) for m, t in _THRESHOLDS.items()}


@query("confidence", "SELECT event_id, " + ", ".join(r(c, f"conf_{m}") for m, c in _CONF.items()) + ", "
       + r("(" + " + ".join(_CONF.values()) + ") / 2", "confidence") + f" FROM ({VOTES_SQL})")
def confidences(spark, sf):
    out = ensemble.mean_confidence(ensemble.with_confidence(votes(spark, sf), _THRESHOLDS))
    return rounded(out.select("event_id", *[f"conf_{m}" for m in _THRESHOLDS], "confidence"), ["event_id"])


_SPOKE = {m: f"CASE WHEN pred_{m} IS NULL THEN 0 ELSE {c} END" for m, c in _CONF.items()}


@query(
    "confidence_weighted",
    "SELECT event_id, CASE WHEN (" + " + ".join(f"coalesce(pred_{m}, 0) * {c}" for m, c in _SPOKE.items()) + ") / ("
    + " + ".join(_SPOKE.values()) + f") > 0.6 THEN 1 ELSE 0 END AS ensemble FROM ({VOTES_SQL})",
)
def confidence_weighted(spark, sf):
    rows = ensemble.with_confidence(votes(spark, sf), _THRESHOLDS)
    return ensemble.combine(rows, "confidence_weighted").select("event_id", "ensemble")


@query(
    "dynamic_thresholds",
    f"""SELECT event_type, 'lstm_autoencoder' AS model, {r('quantile_cont(score_lstm_autoencoder, 0.95)', 'threshold')}
      FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS k FROM ({VOTES_SQL}))
      WHERE k <= 100 GROUP BY event_type""",
)
def dynamic(spark, sf):
    s = long_series(spark, sf)
    out = ensemble.dynamic_thresholds(s.with_df(votes(spark, sf)), _MODELS, 100, 95.0)
    return rounded(out, ["event_type"])


_RATE_SQL = f"SELECT event_type, avg(pred_isolation_forest) AS rate FROM ({VOTES_SQL}) GROUP BY event_type"


@query("raised_thresholds", f"SELECT event_type, {r('CASE WHEN rate > 0.04 THEN 55 * 1.1 ELSE 55 END', 'threshold')} FROM ({_RATE_SQL})")
def raised(spark, sf):
    rate = detect.anomaly_rate(votes(spark, sf), "pred_isolation_forest", ["event_type"])
    table_ = rate.withColumn("threshold", F.lit(55.0))
    out = ensemble.raised_thresholds(table_, F.col("anomaly_rate"), limit=0.04)
    return rounded(out.select("event_type", "threshold"), ["event_type"])
