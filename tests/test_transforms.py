from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from tests.helpers import SCHEMA, close, collected, frame, series
from tidewatch import load_series
from tidewatch.operators.scale import fit_scaler, scale
from tidewatch.operators.seasonal import decompose
from tidewatch.operators.longspectrum import chirp, split
from tidewatch.operators.spectral import spectral_features, top_frequencies
from tidewatch.operators.wavelet import DB4_LOW, high_pass, wavelet_bands
from tidewatch.plans.profiles import fallback_features, full_features, stream_features


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0), (6.0, 5.0)], "a double, b double")
    a = np.array([1, 2, 6.0])
    got = [r["a"] for r in scale(df).collect() if r["a"] is not None]
    np.testing.assert_allclose(sorted(got), (a - a.mean()) / a.std())
    got = scale(df, method="minmax").collect()
    assert sorted(r["a"] for r in got if r["a"] is not None) == [0.0, 0.2, 1.0]
    assert {r["b"] for r in got} == {0.0}
    with pytest.raises(ValueError):
        fit_scaler(df, method="robust")


def moving_trend(x, p):
    w = np.r_[0.5, np.ones(p - 1), 0.5] / p if p % 2 == 0 else np.ones(p) / p
    out = np.full(len(x), np.nan)
    h = len(w) // 2
    for i in range(h, len(x) - h):
        out[i] = (w * x[i - h : i + h + 1]).sum()
    return out


@pytest.mark.parametrize("p", [2, 7, 12])
@pytest.mark.parametrize("model", ["additive", "multiplicative"])
@pytest.mark.parametrize("block", [31, 1_000_000])
def test_decompose(spark, p, model, block):
    pdf = frame(80, ["a"])
    pdf["x"] = 20 + np.sin(np.arange(80)) * 3 + pdf["x"] / 10
    got = collected(decompose(series(spark, pdf, block), ["x"], p, model)).sort_values(["ts", "id"])
    x = pdf.sort_values(["ts", "id"])["x"].to_numpy()
    trend = moving_trend(x, p)
    rest = x - trend if model == "additive" else x / trend
    means = np.array([np.nanmean(rest[k::p]) for k in range(p)])
    means = means - means.mean() if model == "additive" else means / means.mean()
    season = np.tile(means, 80 // p + 1)[:80]
    close(got["x_trend"], trend)
    close(got["x_seasonal"], season)
    close(got["x_residual"], x - trend - season if model == "additive" else x / trend / season)


def test_decompose_refuses_what_cannot_be_decomposed(spark):
    s = series(spark, frame(20, ["a"]))
    assert collected(decompose(s, ["x"], 12)).filter(regex="trend|seasonal|resid").isna().all().all()
    pdf = frame(60, ["a"]).assign(x=lambda d: d["x"] - 100)
    out = collected(decompose(series(spark, pdf), ["x"], 12, "multiplicative"))
    assert out["x_seasonal"].isna().all()
    with pytest.raises(ValueError):
        decompose(s, ["x"], 12, "mixed")


@pytest.mark.parametrize("block", [None, 32])
def test_spectrum(spark, block):
    pdf = frame(97, ["a"])
    got = spectral_features(series(spark, pdf, 20 if block else 1_000_000), ["x"], block).orderBy("block").collect()
    x = pdf.sort_values(["ts", "id"])["x"].to_numpy()
    parts = [x] if block is None else [x[i : i + block] for i in range(0, len(x), block)]
    assert len(got) == len(parts)
    for row, part in zip(got, parts):
        power = np.abs(np.fft.rfft(part)) ** 2
        freq = np.fft.rfftfreq(len(part))
        assert row["x_spectral_centroid"] == pytest.approx((freq * power).sum() / power.sum())
        assert row["x_dominant_freq"] == pytest.approx(freq[power.argmax()])
        total = row["x_low_freq_energy"] + row["x_mid_freq_energy"] + row["x_high_freq_energy"]
        assert total == pytest.approx(power.sum())


def test_lengths_split_into_factors_or_a_chirp():
    assert split(3600, 16) == (3600, 60, 60, False)
    assert split(97, 8) == (256, 16, 16, True) and split(97, 100) == (97, 1, 97, False)
    for n in range(1, 400):
        m, n1, n2, chirped = split(n, 8)
        assert n1 * n2 == m and (m >= 2 * n - 1 if chirped else m == n) and n2 <= max(8, 2 * m**0.5)
    t = np.array([0, 1, 5, 10**6 + 3, 3 * 10**9])
    want = [np.exp(1j * np.pi * float(Fraction(int(v) ** 2 % (2 * 7_000_000_001), 7_000_000_001))) for v in t]
    np.testing.assert_allclose(chirp(t, 7_000_000_001), want, atol=1e-12)


@pytest.mark.parametrize("n", [6, 97, 120, 202])
def test_spectrum_in_steps_equals_that_of_a_whole_array(spark, n):
    pdf = frame(n, ["a", "b"], gaps=0.1)
    pdf = pd.concat([pdf, frame(5, ["short"]), frame(n + 1, ["c"]).assign(x=7.0)])
    s = series(spark, pdf, 40)
    for dc in (True, False):
        whole, steps = (spectral_features(s, include_dc=dc, **more).toPandas().sort_values("key") for more in ({}, {"whole_rows": 5, "piece": 8}))
        assert list(whole.columns) == list(steps.columns) and (whole["rows"].to_numpy() == steps["rows"].to_numpy()).all()
        flat = [c for c in whole if c.startswith("x") and "entropy" not in c]
        close(whole[[c for c in whole if c.startswith("y")]], steps[[c for c in steps if c.startswith("y")]], 1e-6)
        close(whole[flat].iloc[:2], steps[flat].iloc[:2], 1e-6)
        a, b = (top_frequencies(s, "y", k=7, include_dc=dc, **more).orderBy("key", "rank").toPandas() for more in ({}, {"whole_rows": 5, "piece": 8}))
        assert (a[["key", "rank"]].to_numpy() == b[["key", "rank"]].to_numpy()).all()
        close(a[["freq", "magnitude"]], b[["freq", "magnitude"]], 1e-6)


def test_no_group_of_the_steps_holds_a_series(spark, monkeypatch):
    s = series(spark, frame(2400, ["a"]))
    seen = []
    from tidewatch.operators import longspectrum

    original = longspectrum.pinned
    monkeypatch.setattr(longspectrum, "pinned", lambda df: seen.append(df) or original(df))
    spectral_features(s, ["x"], whole_rows=100, piece=128).collect()
    plan = seen[0].collect()[0]
    assert plan["n1"] * plan["n2"] == 2400 and max(plan["n1"], plan["n2"]) <= 128


def test_spectrum_of_nothing(spark):
    flat = series(spark, frame(130, ["a"]).assign(x=0.0))
    for more in ({}, {"whole_rows": 5, "piece": 8}):
        row = spectral_features(flat, ["x"], **more).first()
        assert row["x_spectral_entropy"] is None and row["x_spectral_centroid"] is None and row["x_low_freq_energy"] == 0
    empty = series(spark, frame(5, ["a"]))
    assert spectral_features(empty.with_df(empty.df.limit(0)), ["x"]).count() == 0


def test_spectrum_without_the_constant_part(spark):
    pdf = frame(64, ["a"])
    pdf["x"] = 50 + np.cos(2 * np.pi * 8 * np.arange(64) / 64)
    s = series(spark, pdf.assign(ts=pd.date_range("2024-01-01", periods=64, freq="s")))
    assert spectral_features(s, ["x"]).first()["x_dominant_freq"] == 0.0
    assert spectral_features(s, ["x"], include_dc=False).first()["x_dominant_freq"] == pytest.approx(0.125)
    first = top_frequencies(s, "x", include_dc=False).filter("rank = 1").first()
    assert first["magnitude"] == pytest.approx(32.0)


def dwt(x):
    low, high = np.array(DB4_LOW), np.array(high_pass(DB4_LOW))
    n = len(x)
    at = lambda i: x[-1 - i] if i < 0 else x[2 * n - 1 - i] if i >= n else x[i]
    outs = range((n + 7) // 2)
    return tuple(np.array([sum(f[j] * at(2 * o + 1 - j) for j in range(8)) for o in outs]) for f in (low, high))


@pytest.mark.parametrize("n", [8, 9, 61, 64, 65, 100, 120])
def test_wavelet(spark, n):
    pdf = frame(n, ["a"])
    got = {r["band"]: r for r in wavelet_bands(series(spark, pdf, 16), ["x"]).collect()}
    x = np.zeros(1 << int(np.ceil(np.log2(n))))
    x[:n] = pdf.sort_values(["ts", "id"])["x"]
    for band in ("detail_3", "detail_2", "detail_1"):
        x, d = dwt(x)
        r = got[band]
        np.testing.assert_allclose(
            [r["energy"], r["mean"], r["std"], r["max"]], [(d**2).sum(), d.mean(), d.std(), np.abs(d).max()], atol=1e-9
        )
    assert got["approx"]["energy"] == pytest.approx((x**2).sum())


def test_wavelet_skips_short_series(spark):
    assert wavelet_bands(series(spark, frame(7)), ["x"]).count() == 0
    low = np.array(DB4_LOW)
    assert (low**2).sum() == pytest.approx(1.0) and low.sum() == pytest.approx(2**0.5)


def test_feature_sets_have_the_documented_size(spark):
    pdf = frame(1500, ["a"])
    pdf["u"], pdf["v"] = pdf["x"] * 2 + pdf["y"], pdf["y"] ** 2
    df = spark.createDataFrame(pdf, SCHEMA + ", u double, v double")
    s = load_series(df, ["key"], "ts", "id", ["x", "y", "u", "v"])
    features = lambda out: [c for c in out.columns if c not in s.identity]
    assert len(features(full_features(s, scale=False, fill=False))) == 340
    out = stream_features(s)
    assert len(features(out)) == 172
    assert out.filter(" OR ".join(f"`{c}` IS NULL" for c in features(out))).count() == 0
    assert len(features(fallback_features(s, ["x"]))) == 4 + 12 + 6


def test_small_groups_of_a_long_spectrum_come_in_bundles(spark, monkeypatch):
    from tidewatch.operators import longspectrum

    s = series(spark, frame(150, keys=("a", "b", "c")))
    found = spectral_features(s, ["x", "y"], whole_rows=100, piece=16)
    plan = found._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in plan.splitlines() if "FlatMapGroupsInArrow" in line]
    assert steps and all("[_bundle" in line for line in steps)
    # Many bundles, or one: the groups in them are the same.
    monkeypatch.setattr(longspectrum, "BUNDLE", 32)
    many = spectral_features(s, ["x", "y"], whole_rows=100, piece=16)
    a, b = (df.toPandas().sort_values("key").reset_index(drop=True) for df in (found, many))
    pd.testing.assert_frame_equal(a, b)
