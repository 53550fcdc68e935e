import numpy as np
import pandas as pd
import pytest

from tests.helpers import close, collected, frame, series
from tidewatch.operators import missing, project
from tidewatch.operators.lags import lags
from tidewatch.operators.rolling import STATS, roll, roll_pairs
from tidewatch.plans.orderstats import WaveletMatrix, sliding


def rolled(pdf, column, w, stat):
    def one(x):
        win = x.rolling(w)
        calls = {"q25": lambda: win.quantile(0.25), "q75": lambda: win.quantile(0.75)}
        if stat == "iqr":
            return win.quantile(0.75) - win.quantile(0.25)
        return calls[stat]() if stat in calls else getattr(win, stat)()

    ordered = pdf.sort_values(["key", "ts", "id"])
    out = ordered.assign(r=ordered.groupby("key")[column].transform(one))
    return out.sort_values(["key", "id"])["r"].to_numpy()


@pytest.mark.parametrize("block", [37, 1_000_000])
def test_rolling_equals_pandas(spark, block):
    pdf = frame(150, gaps=0.05)
    sizes = [1, 2, 3, 7, 20, 60]
    got = collected(roll(series(spark, pdf, block), ["x"], sizes))
    for w in sizes:
        for stat in STATS:
            close(got[f"x_roll_{stat}_{w}"], rolled(pdf, "x", w, stat), 1e-6)


@pytest.mark.parametrize("block", [90, 1_000_000])
def test_long_windows_by_rank_equal_pandas(spark, block, monkeypatch):
    from tidewatch.operators import rolling

    monkeypatch.setattr(rolling, "LONG_WINDOW", 6)
    pdf = frame(260, gaps=0.01)
    pdf["x"] = pdf["x"].round(0)
    sizes = [3, 7, 64, 150]
    got = collected(roll(series(spark, pdf, block), ["x", "y"], sizes))
    for w in sizes:
        for column in ("x", "y"):
            for stat in ("median", "q25", "q75", "iqr", "min", "max", "mean"):
                close(got[f"{column}_roll_{stat}_{w}"], rolled(pdf, column, w, stat), 1e-6)
    assert collected(roll(series(spark, frame(5)), ["x"], [7])).filter(like="roll").isna().all().all()


def test_ranks_of_windows():
    rng = np.random.default_rng(4)
    for n, distinct in ((1, 1), (50, 3), (300, 200)):
        ranks = rng.integers(0, distinct, n)
        matrix = WaveletMatrix(ranks)
        low = rng.integers(0, n, 60)
        high = np.array([rng.integers(a, n) + 1 for a in low])
        for k in range(3):
            fits = high - low > k
            assert (matrix.kth(low[fits], high[fits], k) == [np.sort(ranks[a:b])[k] for a, b in zip(low[fits], high[fits])]).all()
    x = rng.normal(size=5000)
    x[rng.integers(0, 5000, 2)] = np.nan
    got = sliding(x, [1440], [0.5, 0.25])
    for q in (0.5, 0.25):
        want = pd.Series(x).rolling(1440).quantile(q)
        close(got[1440, q].filled(np.nan), want)


def test_constant_windows(spark):
    pdf = frame(30, ["a"]).assign(x=5.0)
    got = collected(roll(series(spark, pdf), ["x"], [10]))
    full = got.sort_values("ts").iloc[9:]
    assert set(full["x_roll_skew_10"]) == {0.0} and set(full["x_roll_kurt_10"]) == {-3.0}
    assert set(full["x_roll_std_10"]) == {0.0} and set(full["x_roll_iqr_10"]) == {0.0}


def test_series_shorter_than_the_window_stay_missing(spark):
    got = collected(roll(series(spark, frame(3)), ["x"], [5]))
    assert got.filter(like="roll").isna().all().all()


def test_pairs_equal_pandas_and_constants_give_null(spark):
    pdf = frame(120, gaps=0.03)
    got = collected(roll_pairs(series(spark, pdf), ["x", "y"], 20))
    ordered = pdf.sort_values(["key", "ts", "id"])
    cov = pd.concat([g["x"].rolling(20).cov(g["y"]) for _, g in ordered.groupby("key")])
    corr = pd.concat([g["x"].rolling(20).corr(g["y"]) for _, g in ordered.groupby("key")])
    want = ordered.assign(cov=cov, corr=corr).sort_values(["key", "id"])
    close(got["x_y_cov_20"], want["cov"])
    close(got["x_y_corr_20"], want["corr"])
    flat = collected(roll_pairs(series(spark, pdf.assign(x=5.0)), ["x", "y"], 20))
    assert flat["x_y_corr_20"].isna().all()


def test_unknown_names_are_errors(spark):
    s = series(spark, frame(5))
    with pytest.raises(ValueError, match="nope"):
        roll(s, ["nope"])
    with pytest.raises(ValueError, match="mode"):
        roll(s, ["x"], stats=["mode"])
    with pytest.raises(ValueError, match="a', 'b|a.*b"):
        project.select_features(s.df, ["a", "b"])
    with pytest.raises(ValueError):
        missing.handle_missing(s, "guess")
    with pytest.raises(ValueError):
        project.sensor_slice(s, "z")


@pytest.mark.parametrize("block", [33, 1_000_000])
def test_lags_equal_pandas(spark, block):
    pdf = frame(100, gaps=0.2)
    got = collected(lags(series(spark, pdf, block), ["x"], [1, 5]))
    ordered = pdf.sort_values(["key", "ts", "id"])
    by = ordered.groupby("key")["x"]
    for k in (1, 5):
        want = ordered.assign(
            lag=by.shift(k), diff=by.diff(k), pct=by.transform(lambda x: x.ffill() / x.ffill().shift(k) - 1)
        ).sort_values(["key", "id"])
        close(got[f"x_lag_{k}"], want["lag"])
        close(got[f"x_diff_{k}"], want["diff"])
        close(got[f"x_pct_change_{k}"], want["pct"])


@pytest.mark.parametrize("limit", [1, 5])
@pytest.mark.parametrize("block", [23, 1_000_000])
def test_fills_equal_pandas(spark, limit, block):
    pdf = frame(90, gaps=0.7, seed=5)
    s = series(spark, pdf, block)
    ordered = pdf.sort_values(["key", "ts", "id"])
    by = ordered.groupby("key")["x"]
    want = {
        "interpolate": by.transform(lambda x: x.reset_index(drop=True).interpolate(limit=limit).ffill().bfill().to_numpy()),
        "ffill": by.transform(lambda x: x.ffill(limit=limit).bfill()),
        "bfill": by.transform(lambda x: x.bfill(limit=limit).ffill()),
    }
    for method, values in want.items():
        got = collected(missing.handle_missing(s, method, limit, ["x"]))
        close(got["x"], ordered.assign(w=values).sort_values(["key", "id"])["w"])


def test_all_missing_stays_missing(spark):
    pdf = frame(10, ["a"]).assign(x=np.nan)
    assert collected(missing.interpolate(series(spark, pdf), ["x"]))["x"].isna().all()


def test_drop_incomplete_columns_and_count(spark):
    s = series(spark, frame(40, gaps=0.3))
    assert "x" not in missing.drop_incomplete_columns(s.df).columns
    assert missing.missing_count(s.df, ["x", "y"]).first()["y_missing"] == 0


def test_tail_and_recent(spark):
    pdf = frame(50)
    s = series(spark, pdf)
    got = collected(project.tail(s, 7))
    want = pdf.sort_values(["ts", "id"]).groupby("key").tail(7).sort_values(["key", "id"])
    assert got["id"].tolist() == want["id"].tolist()


def test_sequences_end_at_their_row(spark):
    pdf = frame(30, ["a"])
    for block in (11, 1000):
        got = project.sequences(series(spark, pdf, block), ["x", "y"], 10).orderBy("ts", "id").collect()
        ordered = pdf.sort_values(["ts", "id"])[["x", "y"]].to_numpy()
        assert len(got) == 21
        np.testing.assert_allclose(np.array(got[0]["sequence"]), ordered[:10])
        np.testing.assert_allclose(np.array(got[-1]["sequence"]), ordered[-10:])
