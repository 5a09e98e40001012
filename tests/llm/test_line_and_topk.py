from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from ionloom.llm import linededup, topk

DOC = "doc_id long, text string, key string, gone string, n_lines int"


def brute_lines(rows, least=20, docs=3):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: re.sub(r"^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$", "", line).translate(lower)
    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(-1 if doc is None else doc)
    keep = {k: max(v) for k, v in held.items() if len(k) >= least and len(v) >= docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if keep.get(key(x), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def test_lines_against_brute_force(spark):
    rng = random.Random(3)
    common = [f"a line that many documents share, number {i}" for i in range(12)] + ["Äußerst übliche Zeile é", "short one", "x" * 30]
    rows = [(i, "\n".join(rng.choice(common) if rng.random() < 0.4 else f"own line {i} {rng.random()}" for _ in range(rng.randint(1, 8)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, " \t" + common[0].upper() + "\r\v\n" + common[0]), (103, common[1]), (None, common[0]), (104, "long " * 40_000 + "\n" + common[2])]
    df = spark.createDataFrame([(d, t, "k", "g", 1) for d, t in rows], DOC)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in linededup.dedup_lines(df).collect()), key=str)
    assert got == brute_lines(rows)
    crowded = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in linededup.dedup_lines(df, max_bits=1 << 12).collect()), key=str)
    assert crowded == got  # a filter that is too small only lets more lines through to the exact count


def test_lines_of_no_rows_and_kept_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert linededup.dedup_lines(empty).collect() == []
    line = "the very same line in all of these documents"
    df = spark.createDataFrame([(i, f"{line}\nown {i}", "src", 1) for i in range(4)] + [(9, None, None, None)], "doc_id long, text string, source string, n_chars long")
    kept = {r.doc_id: r for r in linededup.with_kept_lines(df).collect()}
    assert kept[0].text == "own 0" and kept[0].n_chars == 5 and kept[0].source == "src"
    assert kept[3].text == f"{line}\nown 3" and kept[9].text is None
    clash = df.withColumn("gone_", F.lit("g")).withColumn("Held_By_", F.lit("h")).withColumn("key", F.lit("k"))
    again = {r.doc_id: r for r in linededup.with_kept_lines(clash).collect()}
    assert {i: r.text for i, r in again.items()} == {i: r.text for i, r in kept.items()} and (again[0].gone_, again[0].Held_By_, again[0].key) == ("g", "h", "k")


def brute_topk(rows, k, step):
    """Every row against every row of another id; the lists of rows that share an id are one."""
    valid = [(i, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in valid if i % step == 0}:
        scored = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), c) for i, own in valid if i == q for c, v in valid if c != q and len(v) == len(own))
        out += [(q, r, c, -s) for r, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_topk_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "TILE_QUERIES", 7)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(150)] + [(i, [0.25] * 6) for i in range(150, 230)]
    rows += [(300, None), (301, []), (302, [1.0, None] + [0.0] * 4), (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (7, [0.1] * 6), (7, [9.0] * 6), (10, [-3.0] * 6), (10, [0.1] * 6), (10, [0.1] * 6), (310, [1.0, 2.0]), (320, [0.5, 0.5])]
    df = spark.createDataFrame([(i, v, 1, "s") for i, v in rows], "vec_id long, embedding array<float>, rank int, shard string")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 10 == 0).collect())
    assert got == brute_topk(rows, 5, 10)


def test_topk_of_large_numbers_and_no_rows(spark):
    rows = [(i, [float(3_000_000 + i), -1e6]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") == 0).collect())
    assert got == [x for x in brute_topk(rows, 5, 1) if x[0] == 0]
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).collect() == []


def test_topk_of_an_id_that_many_rows_share(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 16)
    monkeypatch.setattr(topk, "TILE_QUERIES", 8)
    rng = random.Random(9)
    rows = [(50, [rng.uniform(-1, 1) for _ in range(4)]) for _ in range(60)] + [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert got == brute_topk(rows, 5, 50)


def test_topk_scores_beyond_a_long_are_the_ends_of_its_range(spark):
    rows = [(0, [3e16, 1.0]), (1, [3e16, 2.0]), (2, [-3e16, 2.0]), (3, [1.0, 5.0]), (4, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    exact = {i: s for q, _, i, s in brute_topk(rows, 5, 1) if q == 0}
    clip = lambda x: max(1 - 2**63, min(2**63 - 1, x))
    assert got == [(r, i, clip(exact[i])) for r, i in enumerate(sorted(exact, key=lambda i: (-clip(exact[i]), i)), 1)]


def test_many_null_ids_are_one_document_and_meet_their_own_verdicts(spark):
    line = "a line that the documents without an id share"
    rows = [(None, f"{line}\nown text of number {i}") for i in range(40)] + [(None, line), (None, line), (1, "nothing of it")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in linededup.dedup_lines(df).collect()), key=str)
    assert got == brute_lines(rows) and not any(r[2] for r in got)  # one document
    rows += [(2, line), (3, line + "\nand more")]
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_lines(rows) and sum(r[2] for r in got) == 43
    holders, repeated = linededup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    gone = linededup._gone(holders, repeated)
    assert gone.where("held_by_ IS NULL").count() == 41  # a row for each different text


def test_the_once_seen_filter_grows_with_the_keys(spark, monkeypatch):
    rows = [(i, "\n".join(f"line {i} {k} of its own, of some length" for k in range(60))) for i in range(300)] + [(900 + i, "a line that some documents share") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(linededup, "SLICE_BITS", 1 << 12)  # as many keys as one slice has bits fill it ten times over
    holders, repeated = linededup.repeated_lines(df)
    assert [r.key for r in repeated.collect()] == ["a line that some documents share"]
    assert holders.count() <= 3 + 0.01 * 18_000  # few suspects among keys seen once
    assert linededup.repeated_lines(df, max_bits=1)[0].count() <= 3 + 0.01 * 18_000  # by a join beyond the filter's bound
