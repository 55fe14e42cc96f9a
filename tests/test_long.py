"""Check suites, chunked folds, levels, regressions, selection, versions, calendars and features: odd rows, and plans."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import calendar, checks, levels, ordered, regression, selection, versions
from panelwright.operators import check_suite as cs
from panelwright.session import kept
from panelwright.sources import features


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# checks


def panel(spark):
    rows = [(f"e{i}", "m", 2000 + t, float(10 * i + t)) for i in range(6) for t in range(5)]
    rows += [("e1", "m", 2001, 11.0), ("e2", "m", 2002, None), (None, "m", 2003, -4.0), ("e5", "n", 2000, 1e9)]
    return spark.createDataFrame(rows, "entity string, metric string, period int, value double")


def test_suite_gives_what_single_checks_give(spark):
    df, series = panel(spark), ["entity", "metric"]
    s = cs.Suite().step("last", series, "period", F.col("value"))
    s = cs.negatives(cs.duplicates(cs.nulls(s, series), [*series, "period"]), series)
    s = cs.bounds(s, [*series, "period"], F.col("value"), 0.0, 50.0, checks.WARNING)
    s = cs.change(s, "yearly_change", [*series, "period"], F.col("value"), F.col("last"), -5, 10, scale=100.0, severity=checks.WARNING)
    s = cs.horizon(s, series, 2004, F.col("period"))
    want = checks.all_of(
        checks.nulls(df, series), checks.duplicates(df, [*series, "period"]), checks.negatives(df, series), checks.bounds(df, [*series, "period"], 0.0, 50.0, severity=checks.WARNING),
        checks.yearly_change(df, series, -5, 10), checks.horizon(df, series, 2004),
    )
    found = s.run(df)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr) and found.columns == want.columns
    assert cs.Suite().row("none", [], F.col("value") > 1e12, F.col("value")).run(df).count() == 0
    assert s.run(df.limit(0)).count() == 0


def test_suite_scans_once_and_shuffles_once(spark, tmp_path):
    panel(spark).write.parquet(str(tmp_path / "p"))
    df, series = spark.read.parquet(str(tmp_path / "p")), ["entity", "metric"]
    s = cs.negatives(cs.horizon(cs.duplicates(cs.nulls(cs.Suite(), series), [*series, "period"]), ["metric"], 2004, F.col("period")), series)
    plan = plan_of(s.run(df)).split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_coverage_and_reconciliation_of_tagged_tables(spark):
    rows, parents = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0)], "k string, v double"), spark.createDataFrame([("a", 3.0), ("b", 4.0)], "k string, total double")
    every = cs.tagged(rows=rows, parents=parents, expected=spark.createDataFrame([("a",), ("c",)], "k string"))
    s = cs.reconciles(cs.coverage(cs.Suite(), ["k"], F.col("table") == "expected", F.col("table") == "rows"), ["k"], F.col("v"), F.col("total"), 0.01)
    assert sorted((r["check"], r["key"]) for r in s.run(every).collect()) == [("coverage", "c"), ("reconciles", "b")]


# folds


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_chunked_folds_equal_the_fold(spark, chunk):
    r = random.Random(chunk)
    rows = [(s, t, r.choice((0.0, -3.0, r.uniform(0.5, 40), r.uniform(9, 11))) if s != "calm" else 10 + r.uniform(-0.2, 0.2), start, -0.1, 0.25, 0, 0.01 if t % 2 else None) for s, start in (("calm", 10.0), ("wild", 5.0), ("below", -2.0), ("zero", 0.0)) for t in range(60)]
    df = spark.createDataFrame(rows, "s string, period int, value double, start double, low double, high double, base int, pg double")
    by = F.floor(F.col("period") / chunk)
    whole = ordered.growth_capped(df.drop("base", "pg"), ["s"], "start", "low", "high")
    cut = ordered.growth_capped_in_chunks(df.drop("base", "pg"), ["s"], "start", "low", "high", by)
    assert cut.columns == ["s", "period", "value", "adjusted"]
    a, b = ({(x["s"], x["period"]): x["adjusted"] for x in d.collect()} for d in (whole, cut))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) <= 1e-9 * max(1, abs(a[k])) for k in a)
    whole = ordered.growth_dampened(df, ["s"], "start", "base", "low", "high", "pg")
    cut = ordered.growth_dampened_in_chunks(df, ["s"], "start", "base", "low", "high", "pg", by)
    a, b = ({(x["s"], x["period"]): x["adjusted"] for x in d.collect()} for d in (whole, cut))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) <= 1e-9 * max(1, abs(a[k])) for k in a)


def test_chunked_fold_leaves_out_nulls_and_takes_empty_tables(spark):
    df = spark.createDataFrame([("a", 1, None, 1.0, -0.1, 0.1), ("a", 2, 5.0, 1.0, -0.1, 0.1)], "s string, period int, value double, start double, low double, high double")
    out = ordered.growth_capped_in_chunks(df, ["s"], "start", "low", "high", F.col("period"))
    assert [(x["period"], round(x["adjusted"], 9)) for x in out.collect()] == [(2, 1.1)]
    assert ordered.growth_capped_in_chunks(df.limit(0), ["s"], "start", "low", "high", F.col("period")).count() == 0


# levels


def test_reconciled_levels_add_up(spark):
    rows = [(["r"], 100.0), (["r", "a"], 30.0), (["r", "b"], 50.0), (["r", "a", "x"], 10.0), (["r", "a", "y"], 10.0), (["r", "b", "z"], 1.0), (["q", "c", "w"], 7.0), (["q", "c"], 14.0), (["s"], 5.0), (["s", "d"], 0.0)]
    df = spark.createDataFrame([(1, p, v, v * 2) for p, v in rows], "k int, path array<string>, value double, hi double")
    out = {tuple(r["path"]): (r["value"], r["hi"]) for r in levels.reconciled_levels(df, ["k"], ["value", "hi"]).collect()}
    assert len(out) == len(rows) and out["r",] == (100.0, 200.0) and out["s", "d"] == (0.0, 0.0)
    for parent in (("r",), ("r", "a"), ("r", "b"), ("q", "c")):
        assert abs(sum(v for p, (v, _) in out.items() if p[:-1] == parent) - out[parent][0]) < 1e-9
    assert abs(out["r", "a", "x"][1] - 2 * out["r", "a", "x"][0]) < 1e-9
    assert levels.reconciled_levels(df.limit(0), ["k"], ["value"]).count() == 0


def test_roll_up_of_all_levels_shuffles_once(spark):
    rows = [("r", f"n{i % 3}", i, float(i), 1.0 if i % 2 else None, "interpolated" if i == 4 else "observed") for i in range(12)]
    df = spark.createDataFrame(rows, "region string, nation string, leaf int, v double, w double, q string")
    path = {"leaf": ["region", "nation", "leaf"], "nation": ["region", "nation"], "region": ["region"], "all": []}
    out = levels.rolled_up(df, path, [], {"total": F.col("v")}, {"rate": (F.col("v"), F.col("w"))}, F.col("q"))
    found = {(r["level"], r["region"], r["nation"], r["leaf"]): (r["total"], r["rate"], r["quality"]) for r in out.collect()}
    assert len(found) == 12 + 3 + 1 + 1 and found["all", None, None, None] == (66.0, 6.0, "interpolated") == found["region", "r", None, None]
    assert found["nation", "r", "n1", None] == (22.0, 4.0, "interpolated") and found["leaf", "r", "n0", 0] == (0.0, None, "observed")
    assert plan_of(out).split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def filled_by_bisection(rows, target):
    held = sum(v or 0 for v, c in rows if not (v or 0) > 0)
    taking = [(v, c) for v, c in rows if (v or 0) > 0]
    low, high = 0.0, 1e9
    for _ in range(300):
        f = (low + high) / 2
        low, high = (f, high) if sum(min(f * v, c if c is not None else float("inf")) for v, c in taking) < target - held else (low, f)
    return [v if not (v or 0) > 0 else min(high * v, c if c is not None else float("inf")) for v, c in rows]


def test_water_filling_is_exact(spark):
    r = random.Random(6)
    groups = {g: [(r.choice((0.0, -2.0, None)) if r.random() < 0.1 else r.uniform(0.1, 100), None if r.random() < 0.2 else r.choice((0.0, r.uniform(0, 200), 50.0))) for _ in range(r.randint(1, 60))] for g in range(30)}
    groups |= {100: [(1.0, 2.0)] * 40, 101: [(1.0, None)], 102: [(5.0, 6.0), (5.0, 6.0)], 103: [(3.0, 1.0), (0.0, 5.0)], 104: [(2.0, 0.0), (3.0, None)]}
    targets = {g: sum(max(v or 0, 0) for v, _ in rows) * r.choice((0.3, 1.0, 1.2)) + 1 for g, rows in groups.items()} | {102: 500.0, 103: -1.0}
    df = spark.createDataFrame([(g, i, v, c, 2 * v if v is not None else None) for g, rows in groups.items() for i, (v, c) in enumerate(rows)], "g int, i int, value double, cap double, hi double")
    t = spark.createDataFrame(list(targets.items()), "g int, target double")
    found = {(x["g"], x["i"]): x for x in levels.filled_below_caps(df, t, ["g"], ["value", "hi"], "cap").collect()}
    for g, rows in groups.items():
        total = sum(c if c is not None else float("inf") for v, c in rows if (v or 0) > 0)
        want = [v for v, _ in rows] if targets[g] <= 0 else [v if not (v or 0) > 0 else c for v, c in rows] if total <= targets[g] - sum(v or 0 for v, _ in rows if not (v or 0) > 0) else filled_by_bisection(rows, targets[g])
        for i, w in enumerate(want):
            x = found[g, i]
            assert (x["value"] is None) == (w is None) and (w is None or abs(x["value"] - w) < 1e-6 * max(1.0, abs(w))), (g, i, x, w)
            if w is not None and targets[g] > 0 and rows[i][0] > 0 and rows[i][1] is not None:
                assert x["value"] <= rows[i][1] + 1e-9 and abs(x["hi"] - 2 * x["value"]) < 1e-6


# regressions


def test_coefficients_equal_numpy_and_parts_merge(spark):
    r = np.random.default_rng(3)
    rows = [(g, t, float(3 + 0.5 * t + (4 if t >= 6 else 0) - 2 * max(0, t - 9) + r.normal())) for g in range(4) for t in range(20)] + [(9, 1, 2.0), (8, 1, None)]
    df = spark.createDataFrame(rows, "g int, t int, y double")
    x = {"base": F.lit(1.0), "trend": F.col("t")} | regression.breaks(F.col("t"), {"step": 6}, {"ramp": 9})
    out = {f["g"]: f for f in regression.fitted(df, ["g"], x, F.col("y")).collect()}
    for g in range(4):
        t, y = np.arange(20.0), np.array([v for a, _, v in rows if a == g])
        design = np.column_stack([np.ones(20), t, t >= 6, np.maximum(0, t - 9)])
        b, rest, *_ = np.linalg.lstsq(design, y, rcond=None)
        assert np.allclose([out[g][n] for n in x], b, atol=1e-7) and abs(out[g]["sigma"] - (rest[0] / 16) ** 0.5) < 1e-7
    assert out[9]["n"] == 1 and out[9]["trend"] is None and out[9]["sigma"] is None and 8 not in out
    parts = regression.gram(df.where("t < 7"), ["g"], x, F.col("y")).unionByName(regression.gram(df.where("t >= 7"), ["g"], x, F.col("y")))
    whole = {s["g"]: s for s in regression.gram(df, ["g"], x, F.col("y")).collect()}
    for s in regression.merged(parts, ["g"], 4).collect():
        assert s["n"] == whole[s["g"]]["n"] and np.allclose(s["xtx"], whole[s["g"]]["xtx"]) and np.allclose(s["xty"], whole[s["g"]]["xty"])
    assert "Python" not in plan_of(regression.fitted(df, ["g"], x, F.col("y")))


def test_expanding_folds_equal_refits(spark):
    r = random.Random(2)
    y = [r.uniform(5, 9) for _ in range(15)]
    df = spark.createDataFrame([("a", t, v) for t, v in enumerate(y)] + [("b", 0, 1.0)], "s string, period int, value double")
    out = {e["period"]: e for e in regression.expanding_errors(df, ["s"], 4).collect()}
    assert sorted(out) == list(range(4, 15))
    for t, e in out.items():
        b, a = np.polyfit(range(t), y[:t], 1)
        for name, f in (("linear", a + b * t), ("flat", y[t - 1]), ("growth", y[t - 1] * (1 + statistics.mean(y[i] / y[i - 1] - 1 for i in range(1, t))))):
            assert abs(e[name] - abs(f - y[t]) / (abs(f) + abs(y[t]))) < 1e-9
    weights = regression.inverse_error_weights(regression.expanding_errors(df, ["s"], 4), ["s"], ["linear", "flat", "growth"]).first()
    assert weights["folds"] == 11 and abs(weights["linear"] + weights["flat"] + weights["growth"] - 1) < 1e-12


# selection


@pytest.mark.parametrize("direct", [3, 50, 10_000])
def test_exact_quantiles(spark, direct):
    r = random.Random(direct)
    groups = {"a": [r.gauss(0, 1) for _ in range(700)], "b": [5.0] * 300 + [6.0], "c": [1.5], "d": [10.0 ** r.randint(-300, 300) for _ in range(200)], "e": [float(r.randint(0, 3)) for _ in range(400)]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None), ("a", float("nan")), ("z", None)]
    found = {(x["g"], x["p"]): x["value"] for x in selection.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", [0.0, 0.02, 0.5, 0.9, 1.0], direct_rows=direct).collect()}
    assert {g for g, _ in found} == set(groups)
    for (g, p), v in found.items():
        want = float(np.quantile(groups[g], p))
        assert abs(v - want) <= 1e-9 * max(abs(want), 1e-300), (g, p)
    sketch = selection.sketched_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", [0.5])
    assert {x["g"] for x in sketch.collect()} >= set(groups)


# versions


def test_changed_keys_from_unequal_leaves_alone(spark):
    rows = [(i, f"v{i}") for i in range(0, 3000, 3)] + [(6, "twice"), (None, "no key"), (-7, "below")]
    after = [(i, "new" if i == 300 else v) for i, v in rows if i not in (900, 903)] + [(1, "added"), (6, "twice"), (None, "other")]
    a, b = (spark.createDataFrame(x, "k long, v string").withColumn("updated_at", F.current_timestamp()) for x in (rows, after))
    trees = [kept(versions.fingerprint_tree(t, "k", leaf_keys=10, fanout=4)) for t in (a, b.repartition(7))]
    leaves = versions.unequal_leaves(*trees, fanout=4)
    assert sorted((x["node"] for x in leaves.collect()), key=repr) == sorted([0, 30, 90, None], key=repr)
    found = {(x["k"], x["status"], x["rows_before"], x["rows_after"]) for x in versions.changed_keys(a, b, leaves, "k", leaf_keys=10).collect()}
    assert found == {(1, "added", 0, 1), (6, "changed", 2, 3), (300, "changed", 1, 1), (900, "removed", 1, 0), (903, "removed", 1, 0), (None, "changed", 1, 2)}
    same = versions.unequal_leaves(trees[0], trees[0], fanout=4)
    assert same.count() == 0 and versions.changed_keys(a, a, same, "k", leaf_keys=10).count() == 0


def test_deltas_equal_recomputation(spark):
    r = random.Random(1)
    old = [(r.randint(0, 5), r.choice("xyz"), r.randint(-9, 9)) for _ in range(200)]
    new = [(p, g, v + 1 if p == 2 else v) for p, g, v in old if p != 4] + [(9, "w", 5), (2, None, 3)]
    a, b = (spark.createDataFrame(x, "part int, g string, v long") for x in (old, new))
    parts = versions.changed_parts(versions.part_hashes(a, "part"), versions.part_hashes(b, "part"), "part")
    assert sorted(x["part"] for x in parts.collect()) == [2, 4, 9]
    moved = versions.signed(*(t.join(parts, "part", "left_semi") for t in (a, b)))
    sums = {"total": F.col("v")}
    now = versions.applied(versions.state(a, ["g"], sums), versions.state(moved, ["g"], sums, F.col("sign")), ["g"])
    assert sorted(map(tuple, now.collect()), key=repr) == sorted(map(tuple, versions.state(b, ["g"], sums).select(now.columns).collect()), key=repr)


# calendars and features


def test_months_add_up_and_gaps_are_bounded(spark):
    totals = spark.createDataFrame([("a", 2000, 120.0), ("a", 2001, 240.0), ("a", 2003, 12.0), ("b", 1999, -5.0)], "s string, period long, value double")
    months = calendar.spread_over_months(totals, ["s"], "A")
    back = {(x["s"], x["y"]): (x["t"], x["n"]) for x in months.groupBy("s", F.floor(F.col("month") / 12).alias("y")).agg(F.sum("value").alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    assert {k: (round(t, 9), n) for k, (t, n) in back.items()} == {("a", 2000): (120.0, 12), ("a", 2001): (240.0, 12), ("a", 2003): (12.0, 12), ("b", 1999): (-5.0, 12)}
    rising = [x["value"] for x in months.where("s = 'a' AND month < 2001 * 12").orderBy("month").collect()]
    assert rising[-1] > rising[0] and all(x["value"] == 1.0 for x in months.where("month >= 2003 * 12").collect())
    some = spark.createDataFrame([("a", 10, 1.0), ("a", 11, None), ("a", 15, 2.0)], "s string, month int, value double")
    out = [(x["month"], x["value"], x["data_quality"]) for x in calendar.carried(some, ["s"], 2).orderBy("month").collect()]
    assert out == [(10, 1.0, "observed"), (11, 1.0, "carried"), (12, 1.0, "carried"), (13, None, None), (14, None, None), (15, 2.0, "observed")]
    days = spark.sql("SELECT * FROM VALUES ('a', DATE'2020-01-03', 1.0D), ('a', DATE'2020-01-30', 2.0D), ('a', DATE'2020-01-31', null), ('a', DATE'2020-02-01', 3.0D) t(s, day, value)")
    assert sorted((x["month"] - 2020 * 12, x["value"]) for x in calendar.last_in_month(days, ["s"], "day").collect()) == [(0, 2.0), (1, 3.0)]


def test_features_keep_types_and_geometries(spark, tmp_path):
    text = '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"code":"A","n":5,"x":{"deep":[1]}},"geometry":{"type":"Polygon","coordinates":[[[0,1],[2,3.5]]]}},{"type":"Feature","properties":null,"geometry":null}]}'
    (tmp_path / "in.json").write_text(text)
    rows = features.read_features(spark, str(tmp_path / "in.json"))
    more = spark.createDataFrame([("A", {"n": 7.5, "m": 1.0}), ("B", {"m": 2.0})], "code string, attributes map<string,double>")
    features.write_features(features.with_attributes(rows, more, "code", "code"), str(tmp_path / "out"))
    again = features.read_features(spark, str(tmp_path / "out"), lines=True).selectExpr("to_json(properties) AS p", "to_json(geometry) AS g").collect()
    import json

    found = sorted((json.loads(x["p"]), json.loads(x["g"]) if x["g"] else None) for x in again if x["p"] != "{}")
    assert found == [({"code": "A", "x": {"deep": [1]}, "n": 7.5, "m": 1}, {"type": "Polygon", "coordinates": [[[0, 1], [2, 3.5]]]})] and len(again) == 2
    odd = spark.createDataFrame([("not json",), (None,), ('{"type":"Feature","properties":{"code":1}}',), ("[]",)], "value string")
    assert [x["c"] for x in features.parsed(odd, "value").select(features.property_text("code").alias("c")).collect()] == ["1"]
