from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ionloom.functions import sequences
from ionloom.operators import inference, relational, stats

A = {"a": [8.88, 9.12, 9.04, 8.98, 9.00, 9.08, 9.01, 8.85, 9.06, 8.99], "b": [8.88, 8.95, 9.29, 9.44, 9.15, 9.58, 8.36, 9.18, 8.67, 9.05], "c": [8.95, 9.12, 8.95, 8.85, 9.03, 8.84, 9.07, 8.98, 8.86, 8.98]}
H = {"x": [24.5, 23.5, 26.4, 27.1, 29.9], "y": [28.4, 34.2, 29.5, 32.2, 30.1], "z": [26.1, 28.3, 24.3, 26.2, 27.8]}


def long(spark, groups):
    rows = [(1, g, v) for g, values in groups.items() for v in values] + [(2, "a", None), (3, "a", 1.0), (3, "b", 1.0), (None, "a", 2.0)]
    return spark.createDataFrame(rows, "id long, grp string, value double")


def of(df, key=1):
    return next(r for r in df.collect() if r.id == key)


def test_equal_variances(spark):
    df = long(spark, A)
    assert of(inference.bartlett(df)).p == pytest.approx(1.1254782518834628e-05, rel=1e-6)
    assert of(inference.fligner(df)).p == pytest.approx(0.00450826080004775, rel=1e-6)


def test_groups(spark):
    df = long(spark, H)
    own = of(inference.anova(df))  # with two degrees of freedom above, the tail has a closed form
    assert (own.df1, own.df2) == (2, 12) and own.p == pytest.approx((12 / (12 + 2 * own.f)) ** 6)
    got = {(r.a, r.b): (round(r["diff"], 2), round(r.p, 3)) for r in inference.tukey(df).collect() if r.id == 1}
    assert got == {("x", "y"): (-4.6, 0.014), ("x", "z"): (-0.26, 0.98), ("y", "z"): (4.34, 0.02)}
    whole = inference.anova(long(spark, {"x": H["x"], "y": H["y"]}))
    t = of(stats.t_test(long(spark, {"x": H["x"], "y": H["y"]}), "x", "y"))
    assert of(whole).f == pytest.approx(t.t**2) and of(whole).p == pytest.approx(float(stats.t_tail(t.t, t.df)))


def test_one_sided_and_threshold(spark):
    df = long(spark, {"x": H["x"], "y": H["y"]})
    flat = of(inference.threshold_test(df, "x", "y", 0.0))
    t = of(stats.t_test(df, "x", "y"))
    assert flat.p == pytest.approx(float(stats.t_tail(t.t, t.df))) and of(inference.threshold_test(df, "x", "y", 4.0)).p > flat.p
    values = spark.createDataFrame([(i, float(i % 7)) for i in range(60)] + [(3, 0.5), (99, None)], "member long, value double")
    sets = spark.createDataFrame([("s", i) for i in range(5, 60, 7)] + [("t", 1), ("s", 5)], "term string, member long")
    got = {r.term: r for r in inference.enrichment_test(values, sets).collect()}
    assert set(got) == {"s"} and got["s"].n == 8 and got["s"].p_up < 0.001 and got["s"].p_up + got["s"].p_down == pytest.approx(1)


def test_draws_do_not_hang_on_partitions(spark):
    rows = spark.range(200).select(F.col("id"), F.lit("s").alias("sample"), F.when(F.col("id") % 3 > 0, F.col("id") * 1.0).alias("value"))
    draw = lambda df: sorted((r.id, r.value) for r in stats.impute_low(df, 7).collect())
    assert draw(rows.repartition(7)) == draw(rows.coalesce(1)) and len({v for i, v in draw(rows) if i % 3 == 0}) == 67


def test_context_and_codons(spark):
    row = spark.range(1).select(
        sequences.context(F.lit("MKAR"), F.lit(1), F.lit(2)).alias("a"), sequences.context(F.lit("MKAR"), F.lit(3), F.lit(4)).alias("b"),
        sequences.previous_codon(F.lit("AAATTTCCC"), F.lit("+"), F.lit(4), F.lit(6)).alias("p"), sequences.previous_codon(F.lit("AAATTTCCC"), F.lit("-"), F.lit(4), F.lit(6)).alias("m"),
        sequences.previous_codon(F.lit("AAATTTCCC"), F.lit("+"), F.lit(3), F.lit(6)).alias("none"), sequences.previous_codon(F.lit("AAATTTCCC"), F.lit("-"), F.lit(4), F.lit(8)).alias("short"),
        sequences.without_stops(F.lit("MK*A**")).alias("s"),
    ).first()
    assert (row.a.before, row.a.first, row.a.last, row.a.after) == (None, "M", "K", "A") and (row.b.before, row.b.after) == ("K", None)
    assert (row.p, row.m, row.none, row.short, row.s) == ("AAA", "GGG", None, None, "MK*A")


def test_jaccard_and_taxa(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "b"), (3, "c"), (1, "a"), (None, "a")], "key long, grp string")
    assert {(r.a, r.b): (r.shared, r.percent) for r in relational.jaccard_percent(df).collect()} == {("a", "b"): (1, pytest.approx(100 / 3)), ("b", "c"): (1, 50.0)}
    taxa = spark.createDataFrame([(1, "no rank"), (2, "genus"), (3, None)], "taxon long, taxon_rank string")
    hits = spark.createDataFrame([("p", 1), ("q", 2), ("r", 3), ("s", None)], "peptide string, taxon long")
    assert [r.peptide for r in relational.with_ranked_taxon(hits, taxa).collect()] == ["q"]


def test_ranks_of_one_hot_score(spark):
    from ionloom.operators.ordered import row_numbers, running_totals

    rows = [(i, 5.0 if i % 4 else float(i % 11)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, score double").repartition(5)
    for descending in (True, False):
        got = {r.id: r["rank"] for r in row_numbers(df, "score", ("id",), descending=descending).collect()}
        order = sorted(rows, key=lambda r: (-r[1] if descending else r[1], r[0]))
        assert got == {i: k for k, (i, _) in enumerate(order, 1)}
    held = running_totals(df, "score", {"t": F.lit(1)}, ("id",))
    assert held.agg(F.max("t")).first()[0] == 3000


def test_text_ids_with_a_common_beginning(spark):
    df = spark.createDataFrame([(f"prefix_that_is_long_{i:03d}",) for i in (5, 3, 9, 3, 100, 42)], "k string")
    assert {r.k[-3:]: r.n for r in relational.dense_ids(df, "k", "n").collect()} == {"003": 1, "005": 2, "009": 3, "042": 4, "100": 5}


def test_variants_across_chunks(spark, monkeypatch):
    from ionloom.operators import matching

    monkeypatch.setattr(matching, "CHUNK", 4)
    genome = spark.createDataFrame([("a", "ACGTACGTACGT"), ("b", "TTTT"), ("c", "ACGT")], "contig string, seq string")
    edits = [("a", 1, "A", "GG"), ("a", 4, "TAC", ""), ("a", 6, "C", "T"), ("a", 12, "T", "TTA"), ("c", 2, "CGT", "X")]
    got = {r.contig: r.seq for r in matching.apply_variants(genome, spark.createDataFrame(edits, "contig string, pos int, ref string, alt string")).collect()}
    assert got == {"a": "GGCG" + "GTACG" + "TTA", "b": "TTTT", "c": "AX"}


def test_combined_table_of_odd_rows(spark):
    from ionloom.plans import metaproteomics

    mapping = spark.createDataFrame([(1, "MA", "+", "GTG"), (2, "MA", "+", "ATG"), (1, "K", "-", None), (1, None, "+", "ATG")], "orf long, peptide string, cluster_specific string, first_codon string")
    classes = metaproteomics.peptide_classes(mapping)
    by = {r.peptide: r for r in classes.collect()}
    assert by["MA"].paralogous and by["MA"].non_atg_start and by["MA"].n_orfs == 2 and not by["K"].specific and by["K"].non_specific
    members = spark.createDataFrame([(7, "MA"), (7, "K"), (8, "Z")], "group_id long, peptide string")
    evidence = spark.createDataFrame([("MA", "s1", "_MA_"), ("MA", "s2", "_MA_"), ("K", "s3", "_K_")], "peptide string, sample string, modified string")
    design = spark.createDataFrame([("s1", "x"), ("s2", "x"), ("s3", "y")], "sample string, strain string")
    groups, strains = metaproteomics.combined_groups(members, evidence, design, classes)
    assert {r.group_id: (r.specific_peptides, r.paralogous, r.one_strain_peptides) for r in groups.collect()} == {7: ("MA", "+", "MA"), 8: ("", "-", "")}
    assert {(r.group_id, r.strain): (r.n_samples, r.peptides) for r in strains.collect()} == {(7, "x"): (2, "_MA_"), (7, "y"): (1, "_K_")}


def test_combined_table_without_the_pairs_of_its_rows(spark):
    import re

    from ionloom.plans import metaproteomics

    # 300 groups hold a peptide with 400 equal observations: its groups must meet what it shows, not each observation
    members = spark.createDataFrame([(g, p) for g in range(300) for p in ("K", "R", None)] + [(None, "K")], "group_id long, peptide string")
    evidence = spark.createDataFrame([("K", f"s{k % 2}", f"K_{k % 3}") for k in range(400)] + [("R", "s1", None), ("R", "s9", "x")], "peptide string, sample string, modified string")
    design = spark.createDataFrame([("s0", "x"), ("s1", "y")], "sample string, strain string")
    classes = spark.createDataFrame([("K", True, False, True), ("R", True, False, False)], "peptide string, specific boolean, non_specific boolean, paralogous boolean")
    groups, strains = metaproteomics.combined_groups(members, evidence, design, classes)
    assert {tuple(r)[1:] for r in groups.where("group_id IS NOT NULL").collect()} == {("K;R", "K", "+", "R")}
    assert sorted(map(tuple, strains.where("group_id IS NULL OR group_id = 7").collect()), key=str) == sorted([(7, "x", 1, "K_0;K_1;K_2"), (7, "y", 1, "K_0;K_1;K_2"), (None, "x", 1, "K_0;K_1;K_2"), (None, "y", 1, "K_0;K_1;K_2")], key=str)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"keys=\[[^]]*group_id[^]]*sample", plan(strains)) and not re.search(r"keys=\[[^]]*group_id[^]]*\], functions=\[[^]]*collect_set", plan(groups))


def test_strains_of_odd_modified_peptides(spark):
    import random

    from ionloom.plans import metaproteomics

    rng = random.Random(9)
    odd = ["", "a;b", "a\nb", "a!", "a", "ab", 'a"', "é", "𝛼;", "a" * 70, "a" * 70 + "b", None]
    evidence = [(p, rng.choice(["s1", "s2", "s3", "s4", None]), rng.choice(odd) if p in "xy" else f"{p}_{rng.randint(1, 4)}") for p in ["x", "y", "K", "KK", "K_", "M", "Z"] for _ in range(12)] + [("W", "s3", None), ("V", "s1", "")]
    members = [(g, p) for g in range(6) for p in ["x", "y", "K", "KK", "K_", "M", "Z", "W", "V", "Q"] if rng.random() < 0.5] + [(99, "W"), (98, "V"), (None, "K")]
    strain = {"s1": 1, "s2": 1, "s3": 2, "s4": None}
    want = {}
    for g, p in set(members):
        for q, s, m in evidence:
            if q == p and s in strain:
                samples, values = want.setdefault((g, strain[s]), (set(), set()))
                samples.add(s)
                values |= {m} - {None}
    classes = spark.createDataFrame([], "peptide string, specific boolean, non_specific boolean, paralogous boolean")
    design = spark.createDataFrame(list(strain.items()), "sample string, strain int")
    _, got = metaproteomics.combined_groups(spark.createDataFrame(members, "group_id long, peptide string"), spark.createDataFrame(evidence, "peptide string, sample string, modified string"), design, classes)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert {(r.group_id, r.strain): (r.n_samples, r.peptides) for r in got.collect()} == {k: (len(n), ";".join(sorted(v))) for k, (n, v) in want.items()}
    assert plan.count("Exchange hashpartitioning(group_id") == 1 and "Exchange hashpartitioning(sample" not in plan and plan.count("Exchange hashpartitioning(peptide") == 2


def test_contrasts_of_two_groups_are_the_moderated_t(spark):
    import random

    rng = random.Random(4)
    rows = [(i, f"s{k}", "a" if k < 4 else "b", rng.gauss(i % 3 if k < 4 else 0, 1 + i % 5 / 4)) for i in range(60) for k in range(9) if (i + k) % 11] + [(99, "s0", "a", 1.0), (98, "s1", "a", None)]
    df = spark.createDataFrame(rows, "id long, sample string, grp string, value double")
    design = spark.createDataFrame([(f"s{k}", [1.0, 0.0] if k < 4 else [0.0, 1.0]) for k in range(9)], "sample string, x array<double>")
    want = {r.id: r for r in stats.moderated_t(df, "a", "b").collect()}
    got = {r.id: r for r in inference.moderated_contrasts(df, design, {"a-b": [1.0, -1.0]}).collect()}
    assert set(got) == set(want) and len(got) == 60
    for i, r in got.items():
        assert r.log_fc == pytest.approx(want[i].log_fc) and r.t == pytest.approx(want[i].t) and r.df == pytest.approx(want[i].df) and 0 <= r.p <= 1
    three = spark.createDataFrame([(f"s{k}", [1.0, float(k), float(k % 2)]) for k in range(9)], "sample string, x array<double>")
    both = inference.moderated_contrasts(df, three, {"slope": [0.0, 1.0, 0.0], "parity": [0.0, 0.0, 1.0]}).collect()
    assert {r.contrast for r in both} == {"slope", "parity"} and len(both) == 120
    assert inference.moderated_contrasts(df.limit(0), design, {"a-b": [1.0, -1.0]}).collect() == []


def test_linkages(spark):
    from ionloom.operators import annotation

    points = {"a": (0.0, 0.0), "b": (1.0, 0.0), "c": (5.0, 0.0), "d": (5.0, 2.0), "e": (9.0, 9.0)}
    df = spark.createDataFrame([(k, s, p[k]) for s, p in points.items() for k in (0, 1)], "id long, sample string, value double")
    heights = {m: [round(h, 6) for _, _, h in annotation.linkage(df, m)] for m in annotation.LINKAGES}
    assert all(h[:2] == [1.0, 2.0] for h in heights.values())
    assert heights["single"][2:] == [4.0, round(65**0.5, 6)] and heights["complete"][2:] == [round(29**0.5, 6), round(162**0.5, 6)]
    assert heights["centroid"][2] == round((4.5**2 + 1) ** 0.5, 6) and heights["ward"][2] == round((2 * (4.5**2 + 1)) ** 0.5, 6)
    assert heights["median"][2] == heights["centroid"][2] and heights["weighted"][2] == heights["average"][2]
    assert 0.8 < annotation.cophenetic_correlation(df) <= 1


def test_ranks_by_key_in_parts_that_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(stats, "WINDOW_ROWS", 50)
    df = spark.range(2000).selectExpr("id % 97 AS id", "CAST(id * 7919 % 31 AS DOUBLE) AS x", "CAST(id * 104729 % 1009 AS DOUBLE) AS y")
    got = stats.correlations(df)
    assert "hashpartitioning(id" in (plan := got._jdf.queryExecution().executedPlan().toString()) and ", 41)" in plan  # 4 shuffle partitions are set
    want = df.toPandas().groupby("id")[["x", "y"]].corr("spearman")["x"].unstack()["y"]
    assert {r.id: r.spearman for r in got.collect()} == pytest.approx(want.to_dict())
