from __future__ import annotations

import random
from collections import defaultdict
from statistics import median

import pytest
from pyspark.sql import functions as F

from ionloom.operators import ordered, relational


@pytest.mark.parametrize("buckets", [None, 1, 6])
def test_totals_with_text_ties_and_the_next_row(spark, buckets):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), 7 if rng.random() < 0.7 else rng.randint(0, 20), f"t{i:03d}", rng.randint(-3, 9)) for i in range(300)] + [("a", None, "x", 1)]
    df = spark.createDataFrame(rows, "k string, v int, tie string, x int")
    for down in (False, True):
        run = ordered.running_totals(df, "v", {"sum": df["x"]}, ("tie",), down, buckets, ("k",), "next").collect()
        for k in "ab":
            mine = sorted((r for r in rows if r[0] == k and r[1] is not None), key=lambda r: (-r[1] if down else r[1], r[2]))
            got = {r.tie: (r["sum"], r["next"]) for r in run if r.k == k}
            total = 0
            for i, r in enumerate(mine):
                total += r[3]
                assert got[r[2]] == (total, mine[i + 1][1] if i + 1 < len(mine) else None)
            assert len(got) == len(mine)


def test_hot_scores_and_names_are_split(spark):
    df = spark.createDataFrame([(1.0, f"acc{i:05d}") for i in range(2000)], "score double, acc string")
    dealt, several = ordered._dealt(df, [F.desc("score"), "acc"], 8)
    sizes = [r["count"] for r in dealt.groupBy("bucket_").count().collect()]
    assert several and len(sizes) == 8 and max(sizes) < 2 * 2000 / 8
    ranks = {r.acc: r["rank"] for r in ordered.row_numbers(df, "score", ("acc",), buckets=8).collect()}
    assert ranks == {f"acc{i:05d}": i + 1 for i in range(2000)}


@pytest.mark.parametrize("buckets", [None, 5])
def test_medians(spark, buckets):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1.5, 2.0, rng.random()])) for _ in range(400)] + [("c", None), ("d", 3.0), ("e", 1.0), ("e", 2.0)]
    held = defaultdict(list)
    for k, v in rows:
        if v is not None:
            held[k].append(v)
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.median for r in ordered.medians(df, "v", ("k",), buckets=buckets).collect()}
    assert got.keys() == held.keys() and all(abs(got[k] - median(x)) < 1e-12 for k, x in held.items())
    assert abs(ordered.medians(df, "v", buckets=buckets).first().median - median(x for v in held.values() for x in v)) < 1e-12
    assert [r.median for r in ordered.medians(df.where("k = 'c'"), "v").collect()] == [None]


def test_coverage_in_buckets(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(rng.choice("xy"), s := rng.randint(0, 100), s + rng.randint(0, 20), rng.randint(1, 4)) for _ in range(80)]
    monkeypatch.setattr(ordered, "WINDOW_ROWS", 20)
    got = relational.base_coverage(spark.createDataFrame(rows, "c string, start int, end int, value int"), "value", ["c"]).collect()
    cells = {(r.c, i): r.value for r in got for i in range(r.start, r.end + 1)}
    want = defaultdict(int)
    for c, s, e, v in rows:
        for i in range(s, e + 1):
            want[c, i] += v
    assert cells == want
