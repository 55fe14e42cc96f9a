"""The grouped models on series whose answers are known."""

import numpy as np
import pytest

from panelwright.operators import models


def test_vector_forecast_continues_a_stable_system():
    r = np.random.default_rng(1)
    a, y = np.array([[0.5, 0.2], [0.1, 0.4]]), [np.array([1.0, -1.0])]
    for _ in range(400):
        y.append(a @ y[-1] + r.normal(0, 0.05, 2))
    centre, low, high, p = models.vector_forecast(np.array(y), 3, seed=1)
    want, x = [], y[-1]
    for _ in range(3):
        x = a @ x
        want.append(x)
    assert p >= 1 and centre.shape == (3, 2) and np.allclose(centre, want, atol=0.06)
    assert (low <= centre + 1e-9).all() and (high >= centre - 1e-9).all()


def test_residual_tests_by_hand(spark):
    r = np.random.default_rng(4)
    values = (3 + 2 * np.arange(12) + r.normal(0, 1, 12)).tolist()
    rows = [("a", "m", 2000 + i, v) for i, v in enumerate(values)] + [("b", "m", 2000 + i, 1.0 * i) for i in range(4)] + [("c", "m", 2000, None)]
    out = {x["entity"]: x for x in models.residual_tests(spark.createDataFrame(rows, "entity string, metric string, period int, value double")).collect()}
    x = np.arange(12)
    e = np.array(values) - np.polyval(np.polyfit(x, values, 1), x)
    rho = [(e[k:] * e[:-k]).sum() / (e**2).sum() for k in (1, 2, 3)]
    ljung = 12 * 14 * sum(p * p / (12 - k) for k, p in enumerate(rho, 1))
    skew, kurt = (e**3).mean() / (e**2).mean() ** 1.5, (e**4).mean() / (e**2).mean() ** 2
    assert out["a"]["ljung_box"] == pytest.approx(ljung) and out["a"]["jarque_bera"] == pytest.approx(12 / 6 * (skew**2 + (kurt - 3) ** 2 / 4))
    assert out["b"]["ljung_box"] is None and "c" not in out


def test_single_series_models():
    r = np.random.default_rng(7)
    line = 5 + 3.0 * np.arange(20)
    for model in (models.trend, models.holt):
        centre = model(line, 3)[0]
        assert np.allclose(centre, [65, 68, 71], atol=0.5), model
    walk, noise = np.cumsum(r.normal(0, 1, 300)), r.normal(0, 1, 300)
    assert models.unit_root(walk) and not models.unit_root(noise)
    y = [0.0]
    for e in r.normal(0, 0.1, 500):
        y.append(0.8 * y[-1] + e)
    centre = models.arima(np.array(y) + 10, 3)[0]
    assert np.allclose(centre, 10 + y[-1] * np.array([0.8, 0.64, 0.512]), atol=0.12)


def test_cointegrated_series_have_rank_one():
    r = np.random.default_rng(3)
    common = np.cumsum(r.normal(0, 1, 400))
    tied = np.column_stack([common + r.normal(0, 0.2, 400), 2 * common + r.normal(0, 0.2, 400)])
    apart = np.cumsum(r.normal(0, 1, (400, 2)), axis=0)
    assert models.johansen_rank(tied) == 1 and models.johansen_rank(apart) == 0


def test_error_correction_pulls_series_together():
    r = np.random.default_rng(3)
    common = np.cumsum(r.normal(0, 1, 400))
    y = np.column_stack([common + r.normal(0, 0.2, 400), 2 * common + r.normal(0, 0.2, 400)])
    assert models.vector_forecast(y, 3)[3] == 0
    rank, relations = models.cointegration(y)
    y[-1, 1] += 6  # the last level is off its relation: the forecast goes back to it
    centre, low, high = models.error_correction(y, 12, rank, relations)
    gap = lambda v: abs(2 * v[0] - v[1])
    assert rank == 1 and gap(centre[-1]) < 0.35 * gap(y[-1]) and (low <= high).all()


def test_ensemble_by_hand(spark):
    r = np.random.default_rng(9)
    series = {"a": np.exp(0.1 * np.arange(12) + r.normal(0, 0.05, 12)), "b": r.normal(0, 1, 7), "c": np.arange(1.0, 6.0)}
    rows = [(k, "m", 2000 + i, float(v)) for k, y in series.items() for i, v in enumerate(y)]
    out = models.ensemble(spark.createDataFrame(rows, "entity string, metric string, period int, value double").repartition(3), 3).collect()
    assert {x["entity"] for x in out} == {"a", "b"} and len(out) == 6
    for key in ("a", "b"):
        z = np.log(series[key]) if (series[key] > 0).all() else series[key]
        errors, weights, fits = [], [], []
        for f in models.MODELS.values():
            cuts = range(max(5, len(z) - 4), len(z))
            ahead = [f(z[:c], 1)[0][0] for c in cuts]
            errors += [z[c] - v for c, v in zip(cuts, ahead, strict=True)]
            weights.append(1 / max(np.mean([abs(z[c] - v) / max(abs(v) + abs(z[c]), 1e-12) for c, v in zip(cuts, ahead, strict=True)]), 1e-6))
            fits.append(f(z, 3))
        weights = np.array(weights) / sum(weights)
        centre = sum(w * f[0] for w, f in zip(weights, fits, strict=True))
        sigma = np.std(errors, ddof=1) if len(errors) > 5 else sum(w * f[1] for w, f in zip(weights, fits, strict=True))
        back = np.exp if key == "a" else (lambda v: v)
        for x in out:
            if x["entity"] == key:
                h = x["period"] - 2000 - len(z)
                width = 1.96 * sigma * np.sqrt(h + 1)
                assert np.allclose([x["value"], x["lo"], x["hi"]], [back(centre[h]), back(centre[h] - width), back(centre[h] + width)])
