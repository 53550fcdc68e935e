"""Detector and model evaluation: A4-A6, V1-V7, K2-K4, J4.

Everything reduces to counts per group with map-side combine. Curves work on distinct scores, and their
running totals are computed in ordered blocks (see `plans.ordered`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.hashing import hash_uniform
from tidewatch.functions.scores import f1, f1_of, precision, ratio, recall, rescaled
from tidewatch.plans.ordered import running_totals
from tidewatch.plans.series import BLOCK_ROWS, Series

SWEEP_POINTS = 100


def _flag(c: str) -> Column:
    return F.coalesce(F.col(c).cast("int") == 1, F.lit(False))


def confusion_counts(
    df: DataFrame, predicted: str = "pred", truth: str = "truth", by: Iterable[str] = ()
) -> DataFrame:
    """True/false positives and negatives; a missing flag counts as negative."""
    p, t = _flag(predicted), _flag(truth)
    return df.groupBy(*by).agg(
        F.count_if(p & t).alias("tp"),
        F.count_if(p & ~t).alias("fp"),
        F.count_if(~p & t).alias("fn"),
        F.count_if(~p & ~t).alias("tn"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 beside the counts; 0 where undefined."""
    p, r = precision(F.col("tp"), F.col("fp")), recall(F.col("tp"), F.col("fn"))
    return counts.withColumns({"precision": p, "recall": r}).withColumn(
        "f1", f1_of(F.col("precision"), F.col("recall"))
    )


def truth_versus_prediction(
    predictions: DataFrame, truth: DataFrame, on: Iterable[str]
) -> DataFrame:
    """Detector output beside the tracked truth, matched by row identity."""
    return predictions.join(truth, list(on), "inner")


def classification_report(
    df: DataFrame, predicted: str = "pred", truth: str = "truth", by: Iterable[str] = ()
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro avg and weighted avg rows.

    The table of (truth, prediction) counts is tiny; all the rest is arithmetic on it.
    """
    by = list(by)
    pairs = df.groupBy(*by, F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = F.explode(
        F.array(
            F.struct(F.col("t").cast("string").alias("class"), F.lit(0).alias("side")),
            F.struct(F.col("p").cast("string").alias("class"), F.lit(1).alias("side")),
        )
    )
    per_class = (
        pairs.select(*by, "t", "p", "n", sides.alias("s"))
        .groupBy(*by, F.col("s.class").alias("class"))
        .agg(
            F.sum(F.when((F.col("s.side") == 0) & (F.col("t") == F.col("p")), F.col("n")).otherwise(0)).alias("hit"),
            F.sum(F.when(F.col("s.side") == 0, F.col("n")).otherwise(0)).alias("support"),
            F.sum(F.when(F.col("s.side") == 1, F.col("n")).otherwise(0)).alias("named"),
        )
        .withColumns(
            {
                "precision": ratio(F.col("hit"), F.col("named")),
                "recall": ratio(F.col("hit"), F.col("support")),
            }
        )
        .withColumn("f1", f1_of(F.col("precision"), F.col("recall")))
    )
    weight = F.col("support")

    def weighted(c: str) -> Column:
        return ratio(F.sum(F.col(c) * weight), F.sum(weight))

    accuracy = ratio(F.sum("hit"), F.sum("support"))
    names = ["precision", "recall", "f1"]
    rows = F.array(
        F.struct(
            F.lit("accuracy").alias("class"), *[F.col("_acc").alias(c) for c in names], F.col("_n").alias("support")
        ),
        F.struct(
            F.lit("macro avg").alias("class"), *[F.col(f"_m_{c}").alias(c) for c in names], F.col("_n").alias("support")
        ),
        F.struct(
            F.lit("weighted avg").alias("class"),
            *[F.col(f"_w_{c}").alias(c) for c in names],
            F.col("_n").alias("support"),
        ),
    )
    summary = (
        per_class.groupBy(*by)
        .agg(
            accuracy.alias("_acc"),
            F.sum("support").alias("_n"),
            *[F.avg(c).alias(f"_m_{c}") for c in names],
            *[weighted(c).alias(f"_w_{c}") for c in names],
        )
        .select(*by, F.explode(rows).alias("r"))
        .select(*by, "r.*")
    )
    return per_class.select(*by, "class", *names, "support").unionByName(summary)


def evaluate_detector(
    series: Series,
    detector: Callable[..., DataFrame],
    truth: dict[str, str],
    name: str | None = None,
    **parameters,
) -> DataFrame:
    """Run a detector over every sensor in `truth` (sensor -> truth column) and count hits.

    One row per (detector, sensor, series keys).
    """
    name = name or detector.__name__
    out: DataFrame | None = None
    for sensor, column in truth.items():
        rows = detector(series, sensor, flag="_pred", **parameters)
        counts = confusion_counts(rows, "_pred", column, series.keys).select(
            F.lit(name).alias("detector"), F.lit(sensor).alias("sensor"), "*"
        )
        out = counts if out is None else out.unionByName(counts)
    if out is None:
        raise ValueError("truth names no sensor")
    return with_rates(out)


def compare_detectors(
    series: Series, detectors: dict[str, tuple[Callable[..., DataFrame], dict]], truth: dict[str, str]
) -> DataFrame:
    """Several detectors side by side; `listing` keeps the order in which they were given."""
    out: DataFrame | None = None
    for i, (name, (detector, parameters)) in enumerate(detectors.items()):
        rows = evaluate_detector(series, detector, truth, name, **parameters)
        rows = rows.withColumn("listing", F.lit(i))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no detector given")
    return out


def best_detector(comparison: DataFrame, by: Iterable[str] = ("sensor",)) -> DataFrame:
    """Detector with the highest F1 per sensor; the one listed first wins a tie."""
    rank = F.struct(F.col("f1"), -F.col("listing"))
    return comparison.groupBy(*by).agg(
        F.max_by("detector", rank).alias("best_detector"), F.max("f1").alias("best_f1")
    )


def _score_counts(df: DataFrame, score: str, truth: str, by: list[str]) -> DataFrame:
    """Distinct scores with their positives and negatives; rows without a score are left out."""
    t = _flag(truth)
    known = df.filter(F.col(score).isNotNull())
    return known.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(t).alias("pos"), F.count_if(~t).alias("neg")
    )


def _cumulative(
    df: DataFrame, score: str, truth: str, by: list[str], block_rows: int
) -> tuple[DataFrame, list[str]]:
    """Counts of positives and negatives at or above every distinct score, with group totals."""
    group = by or ["_all"]
    if not by:
        df = df.withColumn("_all", F.lit(0))
    counts = _score_counts(df, score, truth, group)
    rising = counts.withColumn("_order", -F.col("threshold"))
    run = running_totals(rising, group, "_order", ["pos", "neg"], block_rows)
    totals = counts.groupBy(*group).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    return run.join(totals, group), group


def roc_curve(
    df: DataFrame, score: str, truth: str, by: Iterable[str] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(threshold, tpr, fpr) at every distinct score, predicting positive at or above it."""
    by = list(by)
    run, _ = _cumulative(df, score, truth, by, block_rows)
    return run.select(
        *by,
        "threshold",
        F.try_divide("cum_neg", "all_neg").alias("fpr"),
        F.try_divide("cum_pos", "all_pos").alias("tpr"),
    )


def pr_curve(
    df: DataFrame, score: str, truth: str, by: Iterable[str] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, predicting positive at or above it."""
    by = list(by)
    run, _ = _cumulative(df, score, truth, by, block_rows)
    return run.select(
        *by,
        "threshold",
        F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.try_divide("cum_pos", "all_pos").alias("recall"),
    )


def roc_auc(
    df: DataFrame, score: str, truth: str, by: Iterable[str] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Area under the ROC curve by trapezoids.

    The trapezoid of a score adds neg * (positives above it + half of its own), so each row's part needs only
    its own counts and running total: no look at the row before, and a plain sum at the end.
    """
    by = list(by)
    run, group = _cumulative(df, score, truth, by, block_rows)
    above = F.col("cum_pos") - F.col("pos")
    area = F.sum(F.col("neg").cast("double") * (above + F.col("pos") / 2.0))
    whole = F.max(F.col("all_pos").cast("double") * F.col("all_neg"))
    return run.groupBy(*group).agg(F.try_divide(area, whole).alias("roc_auc")).select(*by, "roc_auc")


def normalised_scores(
    df: DataFrame, score: str, by: Iterable[str] = (), name: str | None = None
) -> DataFrame:
    """Min-max normalised score within each group (the whole frame without `by`); 0.5 when flat."""
    by = list(by)
    if by:
        ends = df.groupBy(*by).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
        rows = df.join(ends, by, "left")
        cell = rescaled(F.col(score), F.col("_lo"), F.col("_hi"))
        return rows.withColumn(name or score, cell).drop("_lo", "_hi")
    lo, hi = df.agg(F.min(score), F.max(score)).first()
    return df.withColumn(name or score, rescaled(F.col(score), F.lit(lo), F.lit(hi)))


def f1_sweep(
    df: DataFrame,
    score: str,
    truth: str,
    by: Iterable[str] = (),
    points: int = SWEEP_POINTS,
    raw: bool = False,
) -> DataFrame:
    """F1 when predicting positive above each of `points` evenly spaced thresholds in [0, 1].

    Scores are min-max normalised first unless `raw`. Every row is put into the grid cell of the last
    threshold below its score and counted there; cumulative counts then run over at most points + 1 rows
    per group.
    """
    by = list(by)
    group = by or ["_all"]
    if not raw:
        df = normalised_scores(df, score, by)
    if not by:
        df = df.withColumn("_all", F.lit(0))
    t, s, last = _flag(truth), F.col(score), points - 1
    # Number of thresholds i / last that lie strictly below the score.
    guess = F.greatest(F.least(F.ceil(s * last), F.lit(points)), F.lit(0)).cast("int")
    below = F.when(F.lit(1.0) * guess / last < s, guess + 1).otherwise(guess)
    below = F.when((guess > 0) & ((guess - 1) / F.lit(float(last)) >= s), guess - 1).otherwise(below)
    cells = (
        df.filter(s.isNotNull())
        .groupBy(*group, F.least(below, F.lit(points)).alias("_above"))
        .agg(F.count_if(t).alias("pos"), F.count_if(~t).alias("neg"))
    )
    packed = cells.groupBy(*group).agg(
        F.collect_list(F.struct("_above", "pos", "neg")).alias("_cells"), F.sum("pos").alias("all_pos")
    )
    grid = packed.select(
        *group, "_cells", "all_pos", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("at")
    )
    zero = F.lit(0).cast("bigint")

    def above(field: str) -> Column:
        return F.aggregate(
            "_cells", zero, lambda acc, x: acc + F.when(x["_above"] > F.col("at"), x[field]).otherwise(zero)
        )

    counts = grid.select(
        *group,
        (F.col("at") / F.lit(float(last))).alias("threshold"),
        above("pos").alias("tp"),
        above("neg").alias("fp"),
        "all_pos",
    )
    fn = F.col("all_pos") - F.col("tp")
    return counts.select(*by, "threshold", f1(F.col("tp"), F.col("fp"), fn).alias("f1"))


def optimal_threshold(sweep: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """First threshold with the highest F1."""
    rank = F.struct(F.col("f1"), -F.col("threshold"))
    return sweep.groupBy(*by).agg(
        F.max_by("threshold", rank).alias("optimal_threshold"), F.max("f1").alias("optimal_f1")
    )


def train_test_split(
    df: DataFrame, key: Column | str, test_share: float = 0.3, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Random split decided by each row's key: the same rows on every run and any partitioning."""
    u = hash_uniform(key, seed)
    return df.filter(u >= test_share), df.filter(u < test_share)


def time_split(
    series: Series, test_share: float = 0.3
) -> tuple[DataFrame, DataFrame]:
    """The newest share of each series is the test set, so no window reaches across the cut."""
    counts = series.df.groupBy(*series.keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = series.transform_rows(lambda df, frames: df.withColumn("_at", frames.position()))
    rows = series.attach(rows, counts)
    late = F.col("_at") > F.floor(F.col("_n") * (1.0 - test_share))
    return rows.filter(~late).drop("_at", "_n"), rows.filter(late).drop("_at", "_n")


def evaluate_model(
    df: DataFrame,
    model: str,
    predicted: str,
    truth: str,
    score: str | None = None,
    probability: str | None = None,
) -> DataFrame:
    """All metrics of one model as (model, metric, at, value); a probability is preferred to a score.

    `at` is the class for report rows and the threshold for curve rows.
    """
    report = classification_report(df, predicted, truth)
    names = ["precision", "recall", "f1"]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in names]))
    out = report.select("class", pairs.alias("m")).select(
        F.concat_ws(" ", "class", "m.metric").alias("metric"),
        F.lit(None).cast("double").alias("at"),
        F.col("m.value").alias("value"),
    )

    def add(rows: DataFrame, values: dict[str, str], at: str | None) -> None:
        nonlocal out
        cells = [F.struct(F.lit(k).alias("metric"), F.col(v).cast("double").alias("value")) for k, v in values.items()]
        place = F.col(at) if at else F.lit(None).cast("double")
        out = out.unionByName(
            rows.select(place.alias("at"), F.explode(F.array(*cells)).alias("m")).select(
                F.col("m.metric").alias("metric"), "at", F.col("m.value").alias("value")
            )
        )

    add(confusion_counts(df, predicted, truth), {c: c for c in ("tp", "fp", "fn", "tn")}, None)
    ranked = probability or score
    if ranked:
        add(roc_auc(df, ranked, truth), {"roc_auc": "roc_auc"}, None)
        add(roc_curve(df, ranked, truth), {"roc fpr": "fpr", "roc tpr": "tpr"}, "threshold")
        curve = {"pr precision": "precision", "pr recall": "recall"}
        add(pr_curve(df, ranked, truth), curve, "threshold")
        sweep = f1_sweep(df, ranked, truth, raw=bool(probability))
        add(sweep, {"sweep f1": "f1"}, "threshold")
        best = {"optimal_threshold": "optimal_threshold", "optimal_f1": "optimal_f1"}
        add(optimal_threshold(sweep), best, None)
    return out.select(F.lit(model).alias("model"), "metric", "at", "value")


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    """The n features with the highest importance."""
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)
