"""Simulated ratios against the same draws row by row, and against their closed form."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from panelwright.operators import derived


def test_simulated_ratios(spark):
    rows = [(i, 100.0 + i, 4.0, 20.0 + i % 7, 0.5) for i in range(300)] + [(900, 5.0, 1.0, 0.0, 1.0), (901, None, 1.0, 2.0, 0.1), (902, -50.0, 0.1, 2.0, 0.1)]
    df = spark.createDataFrame(rows, "id long, a double, sa double, b double, sb double")
    out = derived.simulated_ratio(df.repartition(3), ["id"], draws=2000, rho=0.3)
    low, high = derived.delta_bounds(F.col("a"), F.col("sa"), F.col("b"), F.col("sb"), 0.3)
    found = {r["id"]: r for r in out.withColumn("low", low).withColumn("high", high).withColumn("seed", F.xxhash64("id", F.lit(42))).collect()}
    assert len(found) == len(rows)
    for i, a, sa, b, sb in rows[:300:37]:
        r = np.random.default_rng(found[i]["seed"] & (1 << 63) - 1)
        x, y = r.standard_normal(2000), r.standard_normal(2000)
        ratio = (a + sa * x) / (b + sb * (0.3 * x + np.sqrt(1 - 0.09) * y))
        ratio = ratio[np.abs(ratio - ratio.mean()) <= 5 * ratio.std()]
        assert np.allclose([found[i]["mc_value"], found[i]["mc_lo"], found[i]["mc_hi"]], [ratio.mean(), *np.percentile(ratio, [2.5, 97.5])])
        assert abs(found[i]["mc_lo"] - found[i]["low"]) < 0.1 and abs(found[i]["mc_hi"] - found[i]["high"]) < 0.1
    missing = lambda v: v is None or np.isnan(v)
    assert all(missing(found[i][c]) for i in (900, 901) for c in ("mc_value", "mc_lo", "mc_hi"))
    assert found[902]["mc_value"] == -25.0 and missing(found[902]["mc_lo"])


def test_drawn_ratios(spark):
    rows = [(i, 100.0 + i, 4.0, 20.0 + i % 7, 0.5) for i in range(20)] + [(900, 5.0, 1.0, 0.0, 1.0), (901, None, 1.0, 2.0, 0.1), (902, -50.0, 0.1, 2.0, 0.1)]
    df = spark.createDataFrame(rows, "id long, a double, sa double, b double, sb double")
    out = derived.drawn_ratio(df, ["id"], draws=500, rho=0.3)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    low, high = derived.delta_bounds(F.col("a"), F.col("sa"), F.col("b"), F.col("sb"), 0.3)
    found = {r["id"]: r for r in out.withColumn("low", low).withColumn("high", high).collect()}
    for i in range(20):
        text = [[hashlib.md5(f"{i}:42:{n}:{w}".encode()).hexdigest()[:13] for n in range(1, 501)] for w in (1, 2)]
        u, v = (np.array([(int(t, 16) + 0.5) / 2**52 for t in x]) for x in text)
        x, y = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v), np.sqrt(-2 * np.log(u)) * np.sin(2 * np.pi * v)
        _, a, sa, b, sb = rows[i]
        ratio = (a + sa * x) / (b + sb * (0.3 * x + np.sqrt(1 - 0.09) * y))
        ratio = ratio[np.abs(ratio - ratio.mean()) <= 5 * ratio.std()]
        assert np.allclose([found[i]["mc_value"], found[i]["mc_lo"], found[i]["mc_hi"]], [ratio.mean(), *np.percentile(ratio, [2.5, 97.5])])
        assert abs(found[i]["mc_lo"] - found[i]["low"]) < 0.15 and abs(found[i]["mc_hi"] - found[i]["high"]) < 0.15
    assert all(found[i][c] is None for i in (900, 901) for c in ("mc_value", "mc_lo", "mc_hi"))
    assert found[902]["mc_value"] == -25.0 and found[902]["mc_lo"] is None
