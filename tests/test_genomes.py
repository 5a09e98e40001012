from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ionloom import catalog, catalog_genomes
from ionloom.functions.sequences import CODONS, START_CODONS
from ionloom.operators import matching, seeds, startsites, variants

AMINO = "ACDEFGHIKLMNPQRSTVWY"


def test_patterns_across_pieces_and_odd_letters(spark, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(seeds, "PIECE", 16)
    texts = [(i, "".join(rng.choice("abé𝛼") for _ in range(rng.randint(0, 90)))) for i in range(25)] + [(90, None), (91, ""), (92, "ab" * 600)]
    words = {t[k : k + n] for _, t in texts if t for n in (1, 2, 3, 11, 12, 13, 40) for k in (0, 5) if len(t[k : k + n]) == n} | {"absent" * 3, "zz", "b" * 50}
    df = spark.createDataFrame(texts, "text_id int, text string")
    patterns = spark.createDataFrame([(w,) for w in words] + [(None,), ("",), ("ab",)], "pattern string")
    want = sorted((i, w, k + 1, k + len(w)) for i, t in texts if t for w in words for k in range(len(t)) if t.startswith(w, k))
    assert sorted(map(tuple, matching.match_all(df, patterns).collect())) == want
    assert sorted(map(tuple, matching.match_all(df, patterns, max_patterns=0).collect())) == want  # a shuffled index
    assert matching.match_all(df, patterns.limit(0)).collect() == []


def test_seeds_lie_alike_on_both_sides_of_an_edge(monkeypatch):
    text = "".join(random.Random(4).choice("ab") for _ in range(500))
    whole = seeds.seeds_of(text, 4, 5)
    monkeypatch.setattr(seeds, "LETTERS", 37)
    parts = seeds.seeds_of(text, 4, 5)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()


def full_alignment(a: str, b: str) -> int:
    """The score of the best local alignment, cell by cell."""
    table, most = seeds.score_table(), 0
    above, gap = [0] * (len(b) + 1), [-(10**9)] * (len(b) + 1)
    for x in a:
        row, left = [0], -(10**9)
        for j, y in enumerate(b, 1):
            gap[j] = max(above[j] - seeds.OPEN - seeds.EXTEND, gap[j] - seeds.EXTEND)
            left = max(row[-1] - seeds.OPEN - seeds.EXTEND, left - seeds.EXTEND)
            row.append(max(0, above[j - 1] + int(table[ord(x), ord(y)]), gap[j], left))
        most, above = max(most, *row), row
    return most


def changed(rng, text, rate):
    out = []
    for c in text:
        x = rng.random()
        out.append(rng.choice(AMINO) if x < rate else "" if x < 1.1 * rate else c + rng.choice(AMINO) if x < 1.2 * rate else c)
    return "".join(out)


def test_similar_sequences_against_full_alignment(spark, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(seeds, "PIECE", 64)
    random_text = lambda n: "".join(rng.choice(AMINO) for _ in range(n))
    base = [random_text(100) for _ in range(5)]
    subjects = [(100 + j, random_text(rng.randint(0, 90)) + changed(rng, rng.choice(base)[rng.randint(0, 30) :], rng.choice([0, 0.05, 0.1, 0.2])) + random_text(rng.randint(0, 300))) for j in range(25)]
    queries = [*enumerate(base), (50, None), (51, "")]
    found = seeds.similar(spark.createDataFrame(queries, "query_id int, query string"), spark.createDataFrame([*subjects, (900, None), (901, ""), (902, "AC")], "subject_id int, subject string"))
    got = {(r.query_id, r.subject_id): r for r in found.collect()}
    exact = {(i, j): full_alignment(a, b) for i, a in enumerate(base) for j, b in subjects}
    assert all(r.score == exact[k] for k, r in got.items())
    wanted = [k for k, v in exact.items() if v >= 60]
    assert sum(k in got for k in wanted) >= 0.9 * len(wanted)
    text = dict(subjects)
    for (i, j), r in got.items():  # the place is where the score is
        assert full_alignment(base[i][r.query_start - 1 : r.query_end], text[j][r.subject_start - 1 : r.subject_end]) == r.score
        assert 0 < r.expected < 1e-3 and r.bits > 0


def test_pairs_below_the_least_score_are_scored_alone(monkeypatch):
    rng = random.Random(7)
    random_text = lambda n: "".join(rng.choice(AMINO + "é") for _ in range(n))
    table, queries, subjects, centre = seeds.score_table(), [], [], []
    for _ in range(300):
        queries.append(random_text(rng.randint(1, 60)))
        subjects.append(random_text(rng.randint(0, 30)) + changed(rng, queries[-1], rng.choice([0, 0.1, 0.3, 1])) + random_text(rng.randint(1, 30)))
        centre.append(rng.randint(-70, 100))
    for band in (0, 5, 32):
        assert seeds._scores(queries, subjects, centre, band, table).tolist() == seeds._aligned(queries, subjects, centre, band, table)[:, 0].tolist()
    aligned, found = [], seeds._aligned
    monkeypatch.setattr(seeds, "_aligned", lambda q, *rest: aligned.extend(q) or found(q, *rest))
    batch = pa.record_batch({"query_id": range(300), "subject_id": range(300), "query": queries, "subject": subjects, "centre": centre, "first": [1] * 300})
    rows = [r for out in seeds._extend(32, 60)(iter([batch])) for r in out.to_pylist()]
    assert 0 < len(rows) == len(aligned) < 300 and min(r["score"] for r in rows) >= 60


def test_letters_are_counted_as_code_points(spark):
    rate, letters = seeds.letter_statistics(spark.createDataFrame([("ADC",), ("é𝛼FHI",), (None,), ("",)], "subject string"))
    assert letters == 8 and rate == seeds.decay(seeds.score_table(), dict.fromkeys("ACDFHI", 1 / 6))


def test_similar_sequences_of_nothing(spark):
    none = spark.createDataFrame([], "query_id int, query string"), spark.createDataFrame([], "subject_id int, subject string")
    assert seeds.similar(*none).collect() == []


@pytest.mark.parametrize(
    ("seq", "peptide", "acetylated", "kind", "site"),
    [
        ("AAAATGGCTGCTTAA", "MAA", True, "acetylated initiator", 1),
        ("GTGATGGCTGCTTAA", "MAA", True, "two possible starts", None),
        ("GCTATGGCTGCTTAA", "MAA", False, "initiator behind no cut", 1),
        ("AAAGTGGCTGCTTAA", "MAA", False, "initiator at another codon", 1),
        ("GCTATGGCTGCTTAA", "AA", False, "initiator removed", 1),
        ("GCTGCAGCTGATTAA", "AD", True, "acetylated behind no cut", None),
        ("AAAGCAGATGCTTAA", "ADA", True, "acetylated elsewhere", None),
        ("GCTGCAGCTGATTAA", "AD", False, "no cut before", None),
        ("AAAATGGCTGCTTAA", "MAA", False, "possible start behind a cut", None),
        ("AAAGCAGATGCTTAA", "ADA", None, "behind a cut", None),
        ("GCTGCAGATGCTTAA", "MAAD", False, "no cut before", None),  # M before the frame's first residue
    ],
)
def test_every_kind_of_start(spark, seq, peptide, acetylated, kind, site):
    frames = spark.createDataFrame([("o", "+", 11, 10 + len(seq), seq)], "orf string, strand string, start long, end long, seq string")
    peptides = spark.createDataFrame([("o", peptide, acetylated), ("o", "WWW", False), ("x", "AA", False)], "orf string, peptide string, acetylated boolean")
    rows, _ = startsites.start_sites(frames, peptides, spark.createDataFrame([], "orf string, annotated int"))
    assert [(r.kind, r.site, r.relation) for r in rows.collect()] == [(kind, site, "no annotation")]


def test_forms_that_peptides_call_for(spark):
    #       0   1   2   3   4   5   6   7   8
    plus = "GCTGTGGCTGATGCTAAAATGGCTGATTAA"
    frames = spark.createDataFrame([("a", "+", 1, len(plus), plus), ("b", "-", 101, 100 + len(plus), plus), ("c", "+", 1, len(plus), plus)], "orf string, strand string, start long, end long, seq string")
    peptides = spark.createDataFrame([("a", "DA", False), ("b", "MAD", True), ("c", "AV", False)], "orf string, peptide string, acetylated boolean")
    annotated = spark.createDataFrame([("a", 6), ("b", 6), ("c", 6)], "orf string, annotated int")
    _, forms = startsites.start_sites(frames, peptides, annotated)
    got = sorted((r.orf, r.form, r.at, r.relation, r.codon, r.start, r.end, r.protein) for r in forms.collect())
    assert got == [
        ("a", "inferred", 1, "upstream", "GTG", 4, 30, "MADAKMAD"),
        ("a", "otherwise", 3, "upstream", "", 10, 30, "DAKMAD"),
        ("b", "shown", 1, "upstream", "GTG", 101, 127, "MADAKMAD"),  # M stands for any residue, and the first place counts
        ("c", "inferred", 0, "upstream", "", 1, 30, "AVADAKMAD"),
        ("c", "otherwise", 0, "upstream", "", 1, 30, "AVADAKMAD"),
    ]


def test_sites_need_no_shuffle(spark, capfd):
    rng = random.Random(3)
    frames = [(f"o{k}", "+-"[k % 2], 1, 300, "".join(rng.choice("ACGT") for _ in range(300))) for k in range(40)] + [(None, "+", 1, 3, "ATG")]
    protein = lambda s: "".join(CODONS[s[i : i + 3]] for i in range(0, len(s) - 2, 3))
    peptides = [(o, "M" * (k % 2) + protein(s)[k : k + 4], k % 3 == 0) for o, _, _, _, s in frames if o for k in (0, 3, 20, 50)]
    peptides = [(o, p, any(x == (o, p, True) for x in peptides)) for o, p in dict.fromkeys((o, p) for o, p, _ in peptides)]
    df = spark.createDataFrame(frames, "orf string, strand string, start long, end long, seq string")
    long = spark.createDataFrame(peptides, "orf string, peptide string, acetylated boolean")
    annotated = spark.createDataFrame([(f"o{k}", k) for k in range(0, 40, 2)], "orf string, annotated int")
    held = [(*f, [(p, a) for o, p, a in peptides if o == f[0]], int(f[0][1:]) if f[0] and int(f[0][1:]) % 2 == 0 else None) for f in frames]
    inside = spark.createDataFrame(held, "orf string, strand string, start long, end long, seq string, peptides array<struct<peptide:string,acetylated:boolean>>, annotated int")
    for a, b in zip(startsites.start_sites(df, long, annotated), startsites.sites_in_frames(inside), strict=True):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) != []
        b.explain()
        assert "Exchange" not in capfd.readouterr().out


def test_sites_of_contigs_are_those_of_their_frames(spark):
    rng = random.Random(8)
    contigs = [(k, "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 900)))) for k in range(30)] + [(98, "ACGTé𝛼nTAAacg" * 20), (99, None), (None, "ATG" * 30)]
    df = spark.createDataFrame(contigs, "contig long, seq string")
    frames = matching.open_frames(df, 20).where("contig IS NOT NULL").collect()
    held = []
    for f in frames:
        protein = "".join(CODONS.get(f.seq[i : i + 3], "X") for i in range(0, len(f.seq), 3))
        held.append((f"{f.contig}{f.strand}{f.start}:{f.end}", f.strand, f.start, f.end, f.seq, list(catalog_genomes._named_peptides(protein).items()), protein.find("M") if "M" in protein else None))
    inside = spark.createDataFrame(held, "orf string, strand string, start int, end int, seq string, peptides array<struct<peptide:string,acetylated:boolean>>, annotated int")
    got = startsites.sites_in_contigs(df, 20, catalog_genomes._named_peptides)
    for a, b in zip(got, startsites.sites_in_frames(inside), strict=True):
        assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect())) != []


def test_start_sites_read_codons_once(spark):
    for name in ("start_site_forms", "start_site_peptides", "six_frame"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "regexp" not in plan and "transform(" not in plan and "Exchange" not in plan


def brute_impact(seq, pos, ref, alt, strand, start, end):
    flip = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA")) if strand == "-" else s
    if pos < start or pos + len(ref) - 1 > end:
        return "crosses an end", None, None
    if seq[pos - 1 : pos - 1 + len(ref)] != ref:
        return "other reference", None, None
    cds = flip(seq[start - 1 : end])
    new = flip(seq[start - 1 : pos - 1] + alt + seq[pos - 1 + len(ref) : end])
    at = pos - start if strand == "+" else end - pos - len(ref) + 1
    a, b = at // 3 * 3, (at + len(ref) - 1) // 3 * 3 + 3
    protein = lambda s: "".join(CODONS[s[i : i + 3]] for i in range(0, len(s) - 2, 3))
    old, changed_ = cds[a:b], new[a : b + len(alt) - len(ref)]
    x, y = protein(old), protein(changed_)
    if (len(alt) - len(ref)) % 3:
        kind = "frameshift"
    elif a == 0 and old[:3] in START_CODONS and changed_[:3] not in START_CODONS:
        kind = "start lost"
    elif ("*" in x) != ("*" in y):
        kind = "stop lost" if "*" in x else "stop gained"
    elif x == y:
        kind = "synonymous"
    else:
        kind = "insertion" if len(alt) > len(ref) else "deletion" if len(alt) < len(ref) else "missense"
    return kind, x, y


def test_coding_impact_against_whole_sequences(spark, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(seeds, "PIECE", 32)
    monkeypatch.setattr(variants, "NEAR", 16)
    seq = {c: "".join(rng.choice("ACGT") for _ in range(400)) for c in "xy"}
    changes = []
    for _ in range(250):
        c, pos, n = rng.choice("xy"), rng.randint(1, 395), rng.randint(1, 5)
        ref = seq[c][pos - 1 : pos - 1 + n] if rng.random() < 0.9 else "".join(rng.choice("ACGT") for _ in range(n))
        changes.append((c, pos, ref, "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 1, n, n + 3, 2])))))
    changes = list({(c, p, r): (c, p, r, a) for c, p, r, a in changes}.values())
    features = [(c, f"{c}{k}", rng.choice("+-"), s := 1 + rng.randint(0, 200), s + 3 * rng.randint(1, 60) - 1) for c in "xy" for k in range(4)]
    got = variants.coding_impact(spark.createDataFrame(list(seq.items()), "contig string, seq string"), spark.createDataFrame(changes, "contig string, pos int, ref string, alt string"), spark.createDataFrame(features, "contig string, feature string, strand string, start int, end int"))
    rows = {(r.contig, r.pos, r.ref, r.feature): r for r in got.collect()}
    want = {(c, p, r, f): brute_impact(seq[c], p, r, a, strand, s, e) for c, p, r, a in changes for d, f, strand, s, e in features if c == d and p <= e and p + len(r) - 1 >= s}
    assert {k: r.kind for k, r in rows.items()} == {k: v[0] for k, v in want.items()}
    assert all((r.ref_residues, r.alt_residues) == want[k][1:] for k, r in rows.items() if r.kind not in ("crosses an end", "other reference"))
    assert {r.kind for r in rows.values()} >= {"frameshift", "missense", "synonymous", "stop gained", "insertion", "deletion", "crosses an end", "other reference"}


def test_features_move_as_bases_do(spark, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(variants, "BIN", 16)
    changes, features, want = [], [], {}
    for c in "xyz":
        place, at, moved = {}, 1, 0
        while at <= 300:
            place[at] = at + moved
            n = rng.choice([0, 0, 0, 1, 2, 30]) if c != "z" else 0
            if n:  # a variant: its first base has a place, the others don't
                alt = rng.randint(0, 4)
                changes.append((c, at, "A" * n, "C" * alt))
                moved += alt - n
            at += max(n, 1)
        for k in range(20):
            s = rng.randint(1, 200)
            e = s + rng.randint(0, 90)
            features.append((c, k, s, e))
            want[c, k] = (place.get(s), place[e + 1] - 1 if e + 1 in place else None)
    got = variants.moved_features(spark.createDataFrame(features, "contig string, feature int, start int, end int"), spark.createDataFrame(changes, "contig string, pos int, ref string, alt string"))
    assert {(r.contig, r.feature): (r.new_start, r.new_end) for r in got.collect()} == want


def test_parts_that_masks_leave(spark):
    features = spark.createDataFrame([(1, 1, 10), (1, 5, 8), (2, 1, 5), (3, 4, 4), (1, 1, 10)], "text_id int, start int, end int")
    masks = spark.createDataFrame([(1, 3, 4), (1, 4, 8), (1, 10, 40), (2, -3, 9), (1, 9, 7)], "text_id int, m_start int, m_end int")
    assert sorted(map(tuple, variants.without_spans(features, masks).collect())) == [(1, 1, 10, 1, 2), (1, 1, 10, 9, 9), (3, 4, 4, 4, 4)]
    hits = spark.createDataFrame([(1, "p", 1, 2), (1, "p", 2, 3), (2, "q", 2, 3), (9, "r", 1, 1)], "text_id int, pattern string, start int, end int")
    assert sorted(map(tuple, variants.masked_counts(hits, masks).collect())) == [("p", 2, 1), ("q", 1, 0), ("r", 1, 1)]


def counted(spark, df, name):
    """``df`` and how often its rows were made."""
    made = spark.sparkContext.accumulator(0)

    def one(x):
        made.add(1)
        return x

    return df.withColumn(name, F.udf(one, df.schema[name].dataType)(F.col(name))), made


def test_variants_and_features_are_made_once(spark):
    changes, n = counted(spark, spark.createDataFrame([("x", 5, "A", "CC"), ("x", 9, "AG", "T")], "contig string, pos int, ref string, alt string"), "alt")
    features, m = counted(spark, spark.createDataFrame([("x", "f", "+", 1, 12)], "contig string, feature string, strand string, start int, end int"), "end")
    assert [(r.new_start, r.new_end) for r in variants.moved_features(features.drop("strand"), changes).collect()] == [(1, 12)]
    assert (n.value, m.value) == (2, 1)
    contigs = spark.createDataFrame([("x", "ATGCATGCAGCATGC")], "contig string, seq string")
    assert {r.pos for r in variants.coding_impact(contigs, changes, features).collect()} == {5, 9}
    assert n.value == 4


def test_variants_of_a_text_are_cut_in_one_pass(spark):
    _, changes, _ = catalog_genomes._variants(spark, "/root/testdata/sf0.001")
    assert "substring(seq, ((61" not in changes._jdf.queryExecution().optimizedPlan().toString()


def test_few_patterns_move_no_text(spark, monkeypatch):
    rng = random.Random(12)
    texts = [(i, "".join(rng.choice("aé𝛼") for _ in range(200))) for i in range(5)]
    words = sorted({t[k : k + n] for _, t in texts for n in (1, 7, 12, 30) for k in (0, 31, 90)})
    patterns = spark.createDataFrame([(w,) for w in words], "pattern string")
    monkeypatch.setattr(seeds, "LETTERS", 37)  # edges inside each text, and many blocks of rows
    hits = matching.match_all(spark.createDataFrame(texts, "text_id int, text string"), patterns)
    assert sorted(map(tuple, hits.collect())) == sorted((i, w, k + 1, k + len(w)) for i, t in texts for w in words for k in range(len(t)) if t.startswith(w, k))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
