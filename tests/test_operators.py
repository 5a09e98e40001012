from __future__ import annotations

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionloom.functions.sequences import RESIDUE_MASS, WATER
from ionloom.operators import matching, ordered, quant, relational, stats


def test_greedy_cover_is_the_walk_down_the_list(spark):
    rng = random.Random(1)
    for _ in range(3):
        evidence = {(f"p{rng.randint(0, 40)}", f"s{rng.randint(0, 60)}") for _ in range(150)}
        accs = sorted({a for a, _ in evidence})
        rng.shuffle(accs)
        seen, want = set(), []
        for rank, acc in enumerate(accs, 1):
            new = {s for a, s in evidence if a == acc} - seen
            if new:
                want.append((acc, rank, len(new)))
                seen |= new
        ranked = spark.createDataFrame([(a, i) for i, a in enumerate(accs, 1)], "acc string, rank long")
        got = quant.greedy_cover(ranked, spark.createDataFrame(list(evidence), "acc string, scan string"))
        assert sorted(map(tuple, got.collect()), key=lambda x: x[1]) == want


def test_running_totals_are_one_windows(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), float(rng.randint(0, 50)), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, v double, id long")
    got = {r.id: r["rank"] for r in ordered.row_numbers(df, "v", ("id",), buckets=7).collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == [i for _, _, i in sorted(rows, key=lambda x: (-x[1], x[2]))]
    inner = {r.id: r.n for r in ordered.row_numbers(df, "v", ("id",), "n", descending=False, buckets=5, within=("k",)).collect()}
    for k in "ab":
        mine = sorted((v, i) for kk, v, i in rows if kk == k)
        assert [inner[i] for _, i in mine] == list(range(1, len(mine) + 1))


def test_fdr_and_bh_against_loops(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(0, 30), rng.random() < 0.3) for i in range(300)]
    got = {r.score: (r.decoys, r.total) for r in relational.target_decoy_fdr(spark.createDataFrame(rows, "id int, score int, decoy boolean"), "score", F.col("decoy")).collect()}
    for s in {x[1] for x in rows}:
        above = [d for _, v, d in rows if v >= s]
        assert got[s] == (sum(above), len(above))
    p = [(i, round(rng.random() ** 3, 2)) for i in range(200)] + [(900, None)]
    adjusted = {r.id: r.adjusted for r in relational.benjamini_hochberg(spark.createDataFrame(p, "id int, p double"), "p", "id").collect()}
    known = sorted((v, i) for i, v in p if v is not None)
    least, want = 1.0, {}
    for rank in range(len(known), 0, -1):
        least = min(least, known[rank - 1][0] * len(known) / rank)
        want[known[rank - 1][1]] = least
    assert len(adjusted) == 200 and all(adjusted[i] == pytest.approx(v) for i, v in want.items())


def test_coverage_runs_against_counting(spark):
    rng = random.Random(4)
    rows = [("c", s := rng.randint(1, 60), s + rng.randint(0, 12), rng.randint(1, 5)) for _ in range(25)]
    runs = relational.base_coverage(spark.createDataFrame(rows, "contig string, start long, end long, v long"), "v", ["contig"]).collect()
    got = {p: r.value for r in runs for p in range(r.start, r.end + 1)}
    want = {}
    for _, a, b, v in rows:
        for p in range(a, b + 1):
            want[p] = want.get(p, 0) + v
    assert got == want


def test_overlaps_against_all_pairs(spark):
    rng = random.Random(5)
    make = lambda n: [(i, s := rng.randint(-50, 200), s + rng.randint(0, 90)) for i in range(n)]
    a, b = make(40), make(40)
    got = sorted((r.a_id, r.b_id) for r in relational.overlaps(spark.createDataFrame(a, "a_id int, a_start int, a_end int"), spark.createDataFrame(b, "b_id int, b_start int, b_end int"), 16).collect())
    assert got == sorted((i, j) for i, s, e in a for j, t, f in b if s <= f and t <= e)


def test_overlaps_lists_a_behind_each_b(spark):
    a, b = [(i, 1, 9) for i in range(30)], [(i, i % 7, 20) for i in range(40)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = relational.overlaps(spark.createDataFrame(a, "a_id int, a_start int, a_end int"), spark.createDataFrame(b, "b_id int, b_start int, b_end int"), 100).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r.a_id, r.b_id) for r in rows) == [(i, j) for i in range(30) for j in range(40)]
    assert sum(x.b_id != y.b_id for x, y in zip(rows, rows[1:], strict=False)) == 39  # each b stands in one run


def test_overlaps_pass_one_part_of_a_after_another(spark, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(relational, "HELD", 8)
    make = lambda n: [(i, rng.choice("xy"), s := rng.randint(-50, 200), s + rng.randint(-3, 90)) for i in range(n)]
    a, b = make(90), make(120)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = relational.overlaps(spark.createDataFrame(a, "a_id int, k string, a_start int, a_end int"), spark.createDataFrame(b, "b_id int, k string, b_start int, b_end int"), 64, ["k"], parts=11).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r.a_id, r.b_id) for r in rows) == sorted((i, j) for i, k, s, e in a for j, q, t, f in b if k == q and s <= e and t <= f and s <= f and t <= e)
    # any 40 rows hold few values of a, whatever the number of those that overlap
    assert max(len({r.a_id for r in rows[k : k + 40]}) for k in range(0, len(rows) - 40, 40)) <= 24


def test_match_all_and_coverage_against_scanning(spark):
    rng = random.Random(6)
    texts = [(i, "".join(rng.choice("AK") for _ in range(rng.randint(0, 60)))) for i in range(20)] + [(99, None), (98, "")]
    words = sorted({"".join(rng.choice("AK") for _ in range(rng.randint(1, 5))) for _ in range(12)}) + [""]
    hits = matching.match_all(spark.createDataFrame(texts, "text_id int, text string"), spark.createDataFrame([(w,) for w in words], "pattern string"), max_patterns=5)
    want = sorted((i, w, k + 1, k + len(w)) for i, t in texts if t for w in words if w for k in range(len(t)) if t.startswith(w, k))
    assert sorted(map(tuple, hits.collect())) == want
    covered = {r.text_id: r.covered for r in matching.covered(hits).collect()}
    assert covered == {i: n for i, t in texts if (n := len({p for x, _, a, b in want if x == i for p in range(a, b + 1)}))}


def test_symmetric_containment(spark):
    a = spark.createDataFrame([(1, "MABC"), (2, "XQQ")], "a_id int, a_seq string")
    b = spark.createDataFrame([(1, "GGABCGG"), (2, "MQ")], "b_id int, b_seq string")
    assert sorted(map(tuple, matching.contained_but_first(a, b).collect())) == [(1, 1), (2, 2)]


def frames_of(seq, min_codons):
    stops, out = {"TAA", "TAG", "TGA"}, set()
    rc = seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
    for strand, s in (("+", seq), ("-", rc)):
        for f in range(3):
            begin = f
            last = f + 3 * ((len(s) - f) // 3)
            for i in range(f, last, 3):
                if s[i : i + 3] in stops or i + 3 == last:
                    if i + 3 - begin >= 3 * min_codons:
                        a, b = begin + 1, i + 3
                        out.add((strand, *((a, b) if strand == "+" else (len(s) - b + 1, len(s) - a + 1)), s[begin : i + 3]))
                    begin = i + 3
    return out


def test_open_frames_against_scanning(spark):
    rng = random.Random(7)
    contigs = {f"c{i}": "".join(rng.choice("ACGT") for _ in range(n)) for i, n in enumerate((0, 2, 3, 10, 200, 301))}
    df = spark.createDataFrame(list(contigs.items()), "contig string, seq string")
    for chunk in (7, 64, 1000):
        got = matching.open_frames(df, 4, chunk).collect()
        for c, s in contigs.items():
            assert {(r.strand, r.start, r.end, r.seq) for r in got if r.contig == c} == frames_of(s, 4)


def test_open_frames_stay_in_their_row(spark, capfd):
    odd = "ACGTé𝛼" * 20 + "TAA" + "acg" * 30
    df = spark.createDataFrame([(None, "ATG" * 30), ("x", None), ("y", odd)], "contig string, seq string")
    frames = matching.open_frames(df, 4)
    frames.explain()
    assert "Exchange" not in capfd.readouterr().out  # no base moves
    got = frames.collect()
    assert {r.seq for r in got if r.contig is None} == {s for *_, s in frames_of("ATG" * 30, 4)}
    assert {(r.strand, r.start, r.end, r.seq) for r in got if r.contig == "y"} == frames_of(odd.upper(), 4)


def test_peptides_that_overlap_themselves_count_once(spark):
    texts = [(1, "ENLICHENLICHENLICHEN"), (2, "XENLICHENENLICHENLICHEN"), (3, "AAAAAAAAAAAA"), (4, None)]
    peptides = ["ENLICHEN", "AAAAA", "XEN", "WW", "L"]
    got = matching.unique_in_frames(spark.createDataFrame([(p,) for p in peptides], "pattern string"), spark.createDataFrame(texts, "text_id int, text string"))
    assert {r.pattern: r.n for r in got.collect()} == {p: sum(t.count(p) for _, t in texts if t) for p in peptides}


def test_contexts_take_one_pass(spark):
    import time

    texts = [(1, "AKPRRCD"), (2, ""), (None, "K"), (4, None)]
    got = sorted((tuple(r) for r in matching.cleaved_in_context(spark.createDataFrame(texts, "text_id int, text string")).collect()), key=str)
    assert got == [(1, 1, 4, None, "A", "R", "R"), (1, 5, 5, "R", "R", "R", "C"), (1, 6, 7, "R", "C", "D", None), (None, 1, 1, None, "K", "K", None)]
    begun = time.monotonic()
    assert matching.cleaved_in_context(spark.createDataFrame([(1, "AK" * 400_000)], "text_id int, text string")).count() == 400_000
    assert time.monotonic() - begun < 30  # by the square of the text it takes far longer


def test_variants_and_differences(spark):
    genome = spark.createDataFrame([("a", "ACGTACGT"), ("b", "TTTT")], "contig string, seq string")
    variants = spark.createDataFrame([("a", 2, "C", "GG"), ("a", 5, "ACG", "T"), ("a", 6, "C", "A")], "contig string, pos int, ref string, alt string")
    assert sorted(map(tuple, matching.apply_variants(genome, variants).collect())) == [("a", "AGGGTTT"), ("b", "TTTT")]
    diff = matching.alignment_differences(spark.createDataFrame([(1, "MKAV", "MRAL")], "pair int, query string, subject string"))
    assert sorted(map(tuple, diff.collect())) == [(1, 2, "K->R"), (1, 4, "V->L")]


def test_gap_sequences_against_all_sets(spark):
    from itertools import combinations_with_replacement

    gap = RESIDUE_MASS["G"] + RESIDUE_MASS["A"] + RESIDUE_MASS["S"]
    got = {r.residues for r in matching.gap_sequences(spark.createDataFrame([(1, gap)], "gap_id int, mass double"), 0.01, 3).collect()}
    letters = sorted(set("ARNDCEQGHLKMFPSTWYV"))
    want = {"".join(c) for k in (1, 2, 3) for c in combinations_with_replacement(letters, k) if abs(sum(RESIDUE_MASS[x] for x in c) - gap) <= 0.01}
    assert got == want and "AGS" in got


def test_tag_extension_against_all_spans(spark):
    rng = random.Random(9)
    mass = lambda s: sum(RESIDUE_MASS[x] + (57.021464 if x == "C" else 0) for x in s)
    protein = "M" + "".join(rng.choice("AGSKRPCLVDE") for _ in range(60))
    sites = [0, *(i + 1 for i in range(len(protein) - 1) if protein[i] in "KR" and protein[i + 1] != "P"), len(protein)]
    hits, want = [], []
    for k, (a, b) in enumerate((x, y) for x in sites for y in sites if y - x >= 6):
        start, length = a + 2, 3
        hits.append((k, protein, start, length, mass(protein[a:start]), mass(protein[start + length : b]), mass(protein[a:b]) + WATER))
        if sum(a < s < b for s in sites) <= 2:
            want.append((k, protein[a:b], a, b))
    df = spark.createDataFrame(hits, "hit_id int, protein string, start int, length int, n_gap double, c_gap double, mass double")
    got = sorted(map(tuple, matching.extend_tags(df, 0.01, 0.01).collect()))
    assert set(want) <= set(got) and all(sum(a < s < b for s in sites) <= 2 for _, _, a, b in got)


def test_cover_moves_no_evidence_to_drop_repeats(spark, monkeypatch):
    monkeypatch.setattr(quant, "materialize", lambda df, tag: df)
    evidence = spark.createDataFrame([("p", 1), ("p", 1), ("q", 1), ("q", 2), ("r", None)], "acc string, scan int")
    got = quant.greedy_cover(spark.createDataFrame([("q", 2), ("p", 1), ("r", 3)], "acc string, rank int"), evidence)
    assert sorted(map(tuple, got.collect())) == [("p", 1, 1), ("q", 2, 1), ("r", 3, 1)]
    assert "keys=[acc" not in got._jdf.queryExecution().executedPlan().toString()


def test_tags_in_a_text_of_many_sites(spark):
    protein, water = "AGK" * 100_000, WATER
    gap = RESIDUE_MASS["A"]
    mass = 2 * sum(RESIDUE_MASS[x] for x in "AGK") + water
    hits = [(k, protein, 3 * k + 1, 2, gap, mass - water - sum(RESIDUE_MASS[x] for x in "AGK"), mass) for k in (0, 40_000, 99_998)]
    df = spark.createDataFrame(hits, "hit_id int, protein string, start int, length int, n_gap double, c_gap double, mass double")
    began = time.time()
    assert sorted(map(tuple, matching.extend_tags(df, 0.01, 0.01).collect())) == [(k, "AGKAGK", 3 * k, 3 * k + 6) for k in (0, 40_000, 99_998)]
    assert time.time() - began < 12  # by the square of the sites it took far longer


def test_frameshift_and_start_types(spark):
    pairs = spark.createDataFrame([("x", "y")], "a string, b string")
    orfs = spark.createDataFrame([("x", "MAAACCCD"), ("y", "QQEEEFFFK")], "orf string, seq string")
    peptides = spark.createDataFrame([("ACCCEEEF", "x"), ("AAACCC", "x")], "peptide string, a string")
    assert [tuple(r) for r in matching.frameshift_peptides(pairs, peptides, orfs).collect()] == [("x", "y", "ACCCEEEF", "ACCC", "EEEF")]
    rows = [(0, None, 3, "A", "AAA", "A"), (1, 3, 3, "A", "AAA", "A"), (2, 4, 3, "A", "AAA", "M"), (3, 1, 3, "A", "AAA", "A"), (4, 9, 3, "A", "ATG", "M"), (5, 9, 3, "M", "AAA", "A"), (6, 9, 3, "A", "AAA", "K"), (7, 9, 3, "A", "AAA", "G")]
    df = spark.createDataFrame(rows, "i int, at int, ann int, first string, codon string, before string")
    kinds = [r.k for r in df.select("i", matching.start_type(F.col("first"), F.col("codon"), F.col("before"), F.col("at"), F.col("ann")).alias("k")).orderBy("i").collect()]
    assert kinds == ["unmapped", "annotated start", "annotated start, Met removed", "upstream of annotated start", "alternative start, Met removed", "alternative start", "tryptic internal", "non-tryptic internal"]
    codes = df.select("i", matching.evidence_code([(F.col("at") == 3, 1), (F.col("before") == "K", 2)], 13).alias("c")).orderBy("i")
    assert [r.c for r in codes.collect()] == [13, 1, 13, 13, 13, 13, 2, 13]


def test_tails():
    assert stats.t_tail(2.0, 10.0) == pytest.approx(0.07338803, abs=1e-7)
    assert stats.t_tail([0.0, 12.706205], [1.0, 1.0]) == pytest.approx([1.0, 0.05], abs=1e-6)
    assert stats.chi2_tail(5.991465, 2) == pytest.approx(0.05, abs=1e-6)
    # many at once, each with its own degrees of freedom, and beyond the range of floats
    assert stats.chi2_tail(np.array([5.991465, 3.841459, 0.0, 3000.0]), np.array([2.0, 1.0, 3.0, 2.0])) == pytest.approx([0.05, 0.05, 1.0, 0.0], abs=1e-6)
    for y in (0.3, 1.0, 4.0, 30.0):
        assert stats.trigamma_inverse(stats._trigamma(y)) == pytest.approx(y, rel=1e-6)
    assert stats._digamma(1.0) == pytest.approx(-0.5772156649)


def test_moderated_t_lies_between(spark):
    rng = np.random.default_rng(1)
    rows = [(i, g, float(rng.normal(0, math.exp(rng.normal(0, 0.4))) + (3 if i < 5 and g == "a" else 0))) for i in range(80) for g in "ab" for _ in range(4)]
    df = spark.createDataFrame(rows, "id int, grp string, value double")
    usual, shrunk = ({r.id: r for r in f(df, "a", "b").collect()} for f in (stats.t_test, stats.moderated_t))
    assert all(shrunk[i].df > usual[i].df and shrunk[i].log_fc == pytest.approx(usual[i].log_fc) for i in usual)
    assert np.std([abs(r.t) for r in shrunk.values()]) < np.std([abs(r.t) for r in usual.values()]) * 1.5


def test_imputation(spark):
    rows = [(i, s, None if (i, s) == (3, "b") else float(i * 10 + (5 if s == "b" else 0))) for i in range(10) for s in "abc"]
    df = spark.createDataFrame(rows, "id int, sample string, value double")
    filled = {(r.id, r.sample): r.value for r in stats.impute_nearest(df, 2).collect()}
    assert filled[3, "b"] == pytest.approx((25 + 45) / 2) and len(filled) == 30
    low = {(r.id, r.sample): r.value for r in stats.impute_low(df, 7).collect()}
    assert low[3, "b"] is not None and low[4, "b"] == 45.0


def test_nulls_and_empty_inputs(spark):
    none = spark.createDataFrame([], "acc string, sample string, scan string")
    proteins = spark.createDataFrame([], "acc string, length int, organism string")
    assert quant.ranked_proteins(none, proteins).collect() == []
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("a", None)], "k string, v int")
    assert [tuple(r) for r in relational.value_counts(rows, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in relational.joined_set(rows, "k", "v").collect()] == [("a", "2")]
    assert relational.split_targets(rows.withColumn("f", F.lit(None).cast("string")), "f")[0].count() == 3


def test_best_subjects_and_fallback(spark):
    hits = spark.createDataFrame([("q", "s1", 5.0), ("q", "s1", 9.0), ("q", "s2", 9.0), ("q", "s3", 7.0)], "q string, s string, score double")
    ranks = {(r.s, r.score): (r.alignment_rank, r.hsp_rank) for r in relational.ranked_hits(hits, "q", "s", "score").collect()}
    assert ranks == {("s1", 9.0): (1, 1), ("s1", 5.0): (1, 2), ("s2", 9.0): (2, 1), ("s3", 7.0): (3, 1)}
    cut = relational.subject_cutoff(hits.withColumn("o", F.monotonically_increasing_id()), "q", "s", [F.asc("o")], 2)
    assert cut.count() == 3


def test_nearest_neighbours_over_all_features(spark, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(stats, "BLOCK_FEATURES", 20, raising=False)
    table = {i: [rng.choice([None, rng.uniform(0, 9), rng.uniform(0, 9) + 1000 * (i % 2)]) for _ in range(5)] for i in range(700)}
    table[700] = [None] * 5
    df = spark.createDataFrame([(i, f"s{j}", v) for i, row in table.items() for j, v in enumerate(row)], "id long, sample string, value double")
    got = {(r.id, r.sample): r.value for r in stats.impute_nearest(df, 3).collect()}
    assert len(got) == 701 * 5 and all(got[700, f"s{j}"] is None for j in range(5))

    def far(a, b):
        gaps = [(x - y) ** 2 for x, y in zip(a, b, strict=True) if x is not None and y is not None]
        return sum(gaps) / len(gaps) if gaps else None

    for i in range(0, 700, 7):
        order = sorted((d, o) for o, row in table.items() if o != i and (d := far(table[i], row)) is not None)
        for j, v in enumerate(table[i]):
            near = [table[o][j] for _, o in order if table[o][j] is not None][:3]
            want = v if v is not None else sum(near) / len(near) if near else None
            assert got[i, f"s{j}"] == (want if want is None else pytest.approx(want)), (i, j)
