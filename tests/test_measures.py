from __future__ import annotations

import itertools
import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionloom.operators import filters, inference
from ionloom.sources import regions


def brute_repeated(table):
    """F and the sphericity correction of a complete subjects x conditions table."""
    n, k = table.shape
    grand = table.mean()
    between, subjects = n * ((table.mean(0) - grand) ** 2).sum(), k * ((table.mean(1) - grand) ** 2).sum()
    rest = ((table - grand) ** 2).sum() - between - subjects
    s = np.cov(table.T)
    centre = np.eye(k) - 1 / k
    s = centre @ s @ centre
    return between / (k - 1) / (rest / ((k - 1) * (n - 1))), np.trace(s) ** 2 / ((k - 1) * (s * s).sum())


def test_repeated_measures_against_matrices(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for i, (n, k) in enumerate([(2, 2), (5, 3), (8, 4), (12, 5)]):
        cells = rng.normal(size=(n, k)) + np.arange(k) * 0.7 + rng.normal(size=(n, 1))
        want[i] = (n, k, *brute_repeated(cells))
        rows += [(i, s, c, float(cells[s, c])) for s in range(n) for c in range(k)]
        rows += [(i, 99, 0, 5.0)]  # a subject without the other conditions
    rows += [(50, 1, 1, 1.0), (51, 1, 1, 1.0), (51, 1, 2, 2.0), (52, None, 1, None)]
    rows += [(60, s, c, float(c)) for s in range(3) for c in range(2)]  # nothing varies within subjects
    got = {r.id: r for r in inference.repeated_measures(spark.createDataFrame(rows, "id int, subject int, condition int, value double")).collect()}
    assert got.keys() == {*want, 60}
    for i, (n, k, f, epsilon) in want.items():
        r = got[i]
        assert (r.n, r.k) == (n, k) and r.f == pytest.approx(f) and r.epsilon == pytest.approx(epsilon)
        assert r.df1 == pytest.approx(epsilon * (k - 1)) and r.df2 == pytest.approx(epsilon * (k - 1) * (n - 1)) and 0 < r.p < 1
    assert got[60].f is None and got[60].p is None


def test_repeated_measures_known_values(spark):
    """Two conditions are a paired t test: F = t^2, here t = 3 over 3 degrees of freedom, p = 0.0577 (0.05766889)."""
    rows = [(1, s, c, float(v)) for s, pair in enumerate([(0, 3), (0, 1), (0, 3), (0, 5)]) for c, v in enumerate(pair)]
    r = inference.repeated_measures(spark.createDataFrame(rows, "id int, subject int, condition int, value double")).first()
    t2 = 3.0**2 / (np.var([3, 1, 3, 5], ddof=1) / 4)
    assert r.f == pytest.approx(t2) and (r.df1, r.df2, r.epsilon) == (1, 3, 1)
    theta = np.arctan(np.sqrt(t2) / np.sqrt(3))
    assert r.p == pytest.approx(1 - 2 / np.pi * (theta + np.sin(theta) * np.cos(theta)))


def test_thresholds_against_all_combinations(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, rng.randint(0, 9)]) if rng.random() < 0.1 else rng.randint(0, 9), rng.random(), rng.random() < 0.3) for _ in range(400)]
    steps = {"a": [0, 3, 5, 9, 12], "b": [0.9, 0.1, 0.5, 0.5]}
    counts = filters.joint_counts(spark.createDataFrame(rows, "a int, b double, decoy boolean"), ["a", "b"], steps, F.col("decoy"))
    want = {}
    for a, b in itertools.product(set(steps["a"]), set(steps["b"])):
        held = [d for x, y, d in rows if x is not None and x >= a and y >= b]
        want[a, b] = (held.count(False), held.count(True))
    assert {(r.a, r.b): (r.targets, r.decoys) for r in counts.collect()} == want
    best = filters.best_thresholds(counts, ["a", "b"], 0.4).collect()
    fit = [(-t, d, a, b) for (a, b), (t, d) in want.items() if t and d <= 0.4 * t]
    assert [(-r.targets, r.decoys, r.a, r.b) for r in best] == ([min(fit)] if fit else [])
    assert filters.best_thresholds(counts, ["a", "b"], -1).collect() == []


def test_mass_errors_lose_their_runs_part(spark):
    rng = random.Random(3)
    rows = [(run, m := rng.uniform(400, 900), m * (1 + (shift + rng.uniform(-1, 1)) * 1e-6), rng.random() < 0.8) for run, shift in (("x", 5), ("y", -3)) for _ in range(150)] + [("z", 500.0, 500.001, False)]
    df = spark.createDataFrame(rows, "run string, theory double, mass double, sure boolean")
    got = filters.recalibrated(df, "run", "mass", "theory", F.col("sure")).collect()
    for run in "xy":
        assert abs(median(r.ppm_corrected for r in got if r.run == run and r.sure)) < 0.3
    assert [r.ppm_corrected == r.ppm for r in got if r.run == "z"] == [True]


def test_regions_are_read_from_their_blocks(spark, tmp_path):
    rng = random.Random(6)
    rows = [(rng.choice("aaab"), s := rng.randint(0, 5000), s + rng.choice([0, 5, 40]), i) for i in range(3000)] + [("a", 0, 6000, -1)]
    folder = f"file://{tmp_path}/x"
    index = regions.write_indexed(spark.createDataFrame(rows, "seqid string, start int, end int, i int"), folder, 200)
    assert index.agg(F.sum("n")).first()[0] == len(rows) and index.select("block").distinct().count() >= 12
    for seqid, lo, hi in [("a", 100, 160), ("b", 0, 9999), ("a", 4990, 5010), ("c", 1, 2), ("b", 9000, 9999)]:
        got = sorted(r.i for r in regions.read_region(spark, folder, seqid, lo, hi).collect())
        assert got == sorted(i for c, s, e, i in rows if c == seqid and s <= hi and e >= lo)
    assert len(regions.blocks_of(spark, folder, "a", 100, 160)) <= 3
    plan = regions.read_region(spark, folder, "a", 100, 160)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan or "PartitionFilters: [block" in plan  # other blocks aren't opened


def test_features_of_one_place_fill_several_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(regions, "RANGES", 2)  # fewer than the blocks
    rows = [("a", 5, 9, i) for i in range(1000)] + [("a", 100 + i, 100 + i, i) for i in range(1000)]
    folder = f"file://{tmp_path}/x"
    index = regions.write_indexed(spark.createDataFrame(rows, "seqid string, start int, end int, i int"), folder, 100)
    assert index.agg(F.max("n"), F.sum("n")).first()[:] == (100, 2000)
    assert sorted(r.i for r in regions.read_region(spark, folder, "a", 9, 9).collect()) == list(range(1000))
    assert [r.i for r in regions.read_region(spark, folder, "a", 1099, 1099).collect()] == [999]
