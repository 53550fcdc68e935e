import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import SCHEMA, collected, frame, series
from tidewatch import load_series, numeric_columns
from tidewatch.plans.layout import BLOCK, arrange
from tidewatch.plans.ordered import exact_quantile, running_totals


def positions(s):
    return collected(s.transform_rows(lambda df, frames: df.withColumn("at", frames.position())))


def wanted(pdf):
    out = pdf.sort_values(["key", "ts", "id"])
    return out.assign(at=out.groupby("key").cumcount() + 1).sort_values(["key", "id"]).reset_index(drop=True)


@pytest.mark.parametrize("block", [7, 40, 1000])
def test_positions_do_not_depend_on_blocks(spark, block):
    pdf = pd.concat([frame(300, ["hot"]), frame(20, ["cold"], seed=2)])
    assert positions(series(spark, pdf, block))["at"].tolist() == wanted(pdf)["at"].tolist()


def test_a_burst_at_one_instant_is_split_by_its_tie(spark):
    pdf = frame(400, ["hot"])
    pdf.loc[50:350, "ts"] = pd.Timestamp("2024-03-01 00:10:00")
    pdf = pdf.sort_values("ts").reset_index(drop=True).assign(id=np.arange(400))
    s = series(spark, pdf, 25)
    assert positions(s)["at"].tolist() == wanted(pdf)["at"].tolist()
    rows, frames = arrange(s)
    assert frames.blocked
    assert rows.groupBy("key", BLOCK).count().agg(F.max("count")).first()[0] < 60


def burst(spark, kind):
    """20,000 rows of one series: crowded by one far instant, by one instant with text ties, or by repeated numbers."""
    n = 20_000
    if kind == "outlier":
        df = spark.range(n).selectExpr(
            "'hot' AS key", f"timestamp_micros(if(id = {n - 1}, 4000000000000000, 1700000000000000 + id * 1000)) AS ts", "id", "1.0 AS x"
        )
        return load_series(df, ["key"], "ts", "id", ["x"], 20)
    if kind == "text":
        df = spark.range(n).selectExpr("'hot' AS key", "timestamp'2024-03-01' AS ts", "concat('order-', lpad(id, 9, '0')) AS tie", "id", "1.0 AS x")
        return load_series(df, ["key"], "ts", "tie", ["x"], 500)
    df = spark.range(n).selectExpr("'hot' AS key", "double(if(id < 100, id - 200, id div 6000)) AS at_", "id", "1.0 AS x")
    return load_series(df, ["key"], "at_", "id", ["x"], 500)


@pytest.mark.parametrize("kind", ["outlier", "text", "numbers"])
def test_bursts_are_cut_until_they_fit(spark, kind):
    s = burst(spark, kind)
    rows, frames = arrange(s)
    assert frames.blocked
    assert rows.groupBy("key", BLOCK).count().agg(F.max("count")).first()[0] <= 2 * s.block_rows
    placed = s.transform_rows(lambda df, f: df.withColumn("at", f.position()))
    assert placed.where("at <> id + 1").count() == 0 and placed.count() == 20_000


def test_halo_reaches_over_blocks_smaller_than_itself(spark):
    pdf = frame(150, ["hot"])
    s = series(spark, pdf, 5)
    plan = lambda df, f: df.withColumn("n", F.count("x").over(f.between(-29, 12)))
    got = collected(s.transform_rows(plan, before=29, after=12))["n"].tolist()
    plain = collected(series(spark, pdf).transform_rows(plan, before=29, after=12))["n"].tolist()
    assert got == plain and len(got) == 150


def test_repartitioning_changes_nothing(spark):
    pdf = frame(120)
    s = series(spark, pdf, 30)
    again = load_series(s.df.repartition(13), ["key"], "ts", "id", ["x", "y"], 30)
    assert positions(s).equals(positions(again))


def test_duplicate_times_fall_back_on_the_tie(spark):
    pdf = frame(60)
    pdf["ts"] = pdf["ts"].dt.floor("h")
    assert positions(series(spark, pdf))["at"].tolist() == wanted(pdf)["at"].tolist()


def test_empty_and_single_row(spark):
    empty = spark.createDataFrame([], SCHEMA)
    s = load_series(empty, ["key"], "ts", "id", ["x"])
    assert s.profile().rows == 0
    assert s.transform_rows(lambda df, f: df.withColumn("at", f.position())).count() == 0
    one = frame(1, ["a"])
    assert positions(series(spark, one))["at"].tolist() == [1]


def test_load_series(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1.0), ("2024-01-01 00:01:00", float("nan"))], "timestamp string, t double")
    s = load_series(df)
    assert s.keys == ("series",) and s.values == ("t",)
    assert dict(s.df.dtypes)["timestamp"] == "timestamp"
    assert s.df.filter("t IS NULL").count() == 1
    with pytest.raises(ValueError, match="nothere"):
        load_series(df, values=["nothere"])
    assert numeric_columns(df) == ["t"]


@pytest.mark.parametrize("block", [10, 1000])
def test_running_totals(spark, block):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": ["a"] * 90 + ["b"] * 5, "v": rng.permutation(95) * 1.5, "n": rng.integers(1, 9, 95)})
    df = spark.createDataFrame(pdf)
    got = running_totals(df, ["g"], "v", ["n"], block).toPandas().sort_values(["g", "v"])
    want = pdf.sort_values(["g", "v"])
    assert got["cum_n"].tolist() == want.groupby("g")["n"].cumsum().tolist()


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_exact_quantile(spark, q):
    rng = np.random.default_rng(1)
    v = np.round(rng.normal(size=301), 1)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    for block in (20, 10_000):
        assert exact_quantile(df, "v", q, block_rows=block).first()[0] == pytest.approx(np.quantile(v, q))
