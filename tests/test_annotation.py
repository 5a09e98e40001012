from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionloom.operators import annotation


def test_match_segments_and_their_place(spark):
    rows = [("h", 10, "MK-VLAQ", "MK V+AQ")]
    segments = annotation.match_segments(spark.createDataFrame(rows, "hit string, query_from int, query_seq string, midline string"))
    got = sorted(map(tuple, segments.collect()))
    assert got == [("h", 1, 10, 11), ("h", 2, 12, 12), ("h", 3, 14, 15)]
    orfs = spark.createDataFrame([("h", "c", "-", 101, 190)], "hit string, contig string, strand string, orf_start long, orf_end long")
    placed = {r.segment: (r.start, r.end) for r in annotation.segments_on_genome(segments, orfs).collect()}
    assert placed[2] == (190 - 3 * 12 + 1, 190 - 3 * 11)


def test_components_of_samples_are_those_of_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 4))
    x[0, 1] = np.nan
    rows = [(i, f"s{j}", None if np.isnan(x[i, j]) else float(x[i, j])) for i in range(30) for j in range(4)]
    df = spark.createDataFrame(rows, "id int, sample string, value double")
    got = {(r["sample"], r.component): r.score for r in annotation.sample_components(df).collect()}
    y = x[1:] - x[1:].mean(axis=1, keepdims=True)
    _, s, v = np.linalg.svd(y, full_matrices=False)
    for c in range(2):
        mine = np.array([got[f"s{j}", c + 1] for j in range(4)])
        assert np.allclose(np.abs(mine), np.abs(v[c] * s[c]), atol=1e-8)


def test_linkage_methods(spark):
    points = {"a": 0.0, "b": 1.0, "c": 5.0, "d": 7.0}
    df = spark.createDataFrame([(0, s, v) for s, v in points.items()], "id int, sample string, value double")
    heights = {m: [round(h, 6) for _, _, h in annotation.linkage(df, m)] for m in ("single", "complete", "average")}
    assert heights == {"single": [1.0, 2.0, 4.0], "complete": [1.0, 2.0, 7.0], "average": [1.0, 2.0, 5.5]}


def test_sets_contrasts_and_empty_inputs(spark):
    entries = spark.createDataFrame([("p1", ["GO:1", ""]), ("p2", ["GO:1"]), (None, ["GO:2"]), ("p3", None)], "p string, t array<string>")
    assert [tuple(r) for r in annotation.gene_sets(entries, "p", F.col("t")).collect()] == [("GO:1", ["p1", "p2"], 2)]
    design = spark.createDataFrame([("s1", "a"), ("s2", "b"), ("s3", "a"), ("s4", None)], "sample string, level string")
    assert [tuple(r) for r in annotation.contrasts(design).collect()] == [("a", "b")]
    none = spark.createDataFrame([], "id int, sample string, value double")
    assert annotation.sample_components(none).collect() == [] and annotation.linkage(none) == []
    one = spark.createDataFrame([("s", "t", 1), ("s", "u", 1)], "sample string, taxon string, n int")
    assert annotation.abundance_coverage(one).first().ace == pytest.approx(2.0)
