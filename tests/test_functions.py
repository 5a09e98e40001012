from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ionloom.functions import ids, numeric, sequences


@pytest.fixture(scope="module")
def one(spark):
    def evaluate(column):
        return spark.range(1).select(column.alias("x")).first().x

    return evaluate


L = F.lit


@pytest.mark.parametrize(("column", "want"), [
    (lambda: ids.parse_ids(L("sp|P1|A_X;REV__sp|P2|B_Y;Z")), "P1;REV__P2;Z"),
    (lambda: ids.species_mnemonics(L("sp|P1|ABC_MOUSE;tr|P2|X_HUMAN;Z;sp|P3|D_HUMAN")), "HUMAN;MOUSE;Undefined"),
    (lambda: ids.organism(L("x y OS=Homo sapiens OX=9606 GN=A")), "Homo sapiens"),
    (lambda: ids.organism(L("x OS=Mus musculus")), "Mus musculus"),
    (lambda: ids.organism(L("x y")), "Unspecified"),
    (lambda: ids.header_value(L("x y OS=a b GN=rpoB PE=1"), "GN"), "rpoB"),
    (lambda: ids.header_value(L("x y"), "GN"), None),
    (lambda: ids.protein_name(L("sp|P|N Some long name OS=q")), "Some long name"),
    (lambda: ids.ordered_unique(L("b; a;b;;c")), ["b", "a", "c"]),
    (lambda: ids.sorted_unique(L("b; a;b;;c")), ["a", "b", "c"]),
    (lambda: ids.leading(L("b;a")), "b"),
    (lambda: ids.base_orf(L("x_recno_12.3")), "x_recno_12.0"),
    (lambda: ids.orf_fields(L("asm_c|asm_c_recno_4.0|(-)10:90"))["start"], 10),
    (lambda: ids.orf_fields(L("nothing"))["start"], None),
    (lambda: ids.group_label(L(7), L("P1")), "P1 (Protein group 7)"),
    (lambda: ids.group_label(L(7), L("P1;P2")), "P1;... (Protein group 7)"),
    (lambda: ids.il_equivalent(L("IIL")), "LLL"),
    (lambda: ids.bare_peptide(L("_(ac)M(ox)AK_")), "MAK"),
    (lambda: ids.is_acetylated(L("_(ac)MK_")), True),
    (lambda: ids.is_oxidised(L("_MK_")), False),
    (lambda: ids.strip_character(L("--A-B-"), "-"), "A-B"),
    (lambda: ids.clean_field(L("a.b c/d")), "a_b_c_d"),
    (lambda: ids.attributes(L("ID=x;Name=y;")), {"ID": "x", "Name": "y"}),
    (lambda: ids.terms(L("GO:1|KEGG: 2|GO:3"), "GO:"), ["GO:1", "GO:3"]),
    (lambda: ids.ec_numbers(L("KEGG: 00010+1.1.1.1|2.7.1.-|1.1.1.1")), ["1.1.1.1", "2.7.1.-"]),
    (lambda: ids.url_quoted(L("a b;c")), "a%20b%3Bc"),
    (lambda: ids.flag(L(None).cast("string")), False),
    (lambda: ids.flag(L("+")), True),
    (lambda: numeric.measured(L(0.0)), None),
    (lambda: numeric.measured(L(float("nan"))), None),
    (lambda: numeric.half_even(L(0.125), 2), 0.12),
    (lambda: numeric.cigar_end(L(0), L("5S10M2I3D")), 13),
    (lambda: numeric.log2_or_null(L(0.0)), None),
    (lambda: sequences.occurrences(L("AAKAAKAA"), L("AAKAA")), [1, 4]),
    (lambda: sequences.occurrences(L("AA"), L("AAA")), []),
    (lambda: sequences.tryptic_peptides(L("MKRPAKLLRPGGKPR"), 1, 99), ["MK", "RPAK", "LLRPGGKPR"]),
    (lambda: sequences.missed_cleavages(L("AAK")), 0),
    (lambda: sequences.missed_cleavages(L("AAKC")), 1),
    (lambda: sequences.missed_cleavages(L("AAKP")), 0),
    (lambda: sequences.missed_cleavages(L("AAK"), False), 1),
    (lambda: sequences.missed_cleavages(L("AAKC"), False), 1),
    (lambda: sequences.valid_cleavage(L("K"), L("A"), L("K"), L("A")), True),
    (lambda: sequences.valid_cleavage(L("K"), L("P"), L("K"), L("A")), False),
    (lambda: sequences.valid_cleavage(L("K"), L("P"), L("K"), L("A"), "Trypsin, no P rule"), True),
    (lambda: sequences.valid_cleavage(L("G"), L("A"), L("K"), L("A"), specificity="semi-specific"), True),
    (lambda: sequences.valid_cleavage(L("G"), L("A"), L("G"), L("A"), specificity="unspecific"), True),
    (lambda: sequences.valid_cleavage(L(""), L("A"), L("G"), L(""), "Whole protein"), True),
    (lambda: sequences.reverse_complement(L("ATGCC")), "GGCAT"),
    (lambda: sequences.frame(L("AATGCCT"), 1), "ATGCCT"),
    (lambda: sequences.translate(L("ATGAAATAGNNN")), "MK*X"),
    (lambda: sequences.translate_from_start(L("GTGAAATAG")), "MK"),
    (lambda: sequences.to_genome(L("+"), L(101), L(130), L(1), L(2))["start"], 104),
    (lambda: sequences.to_genome(L("-"), L(101), L(130), L(1), L(2))["end"], 127),
])
def test_expressions(one, column, want):
    assert one(column()) == want


def test_masses(one):
    assert one(sequences.peptide_mass(L("GG"))) == pytest.approx(132.0535, abs=1e-3)
    assert one(sequences.peptide_mass(L("C"))) == pytest.approx(103.00919 + 57.021464 + 18.010565)
    assert one(sequences.peptide_mass(L("GX"))) == float("inf")
    assert one(numeric.neutral_mass(L(500.0), L(2))) == pytest.approx(997.9854)


def test_natural_order(spark):
    names = ["a10", "a9", "b1", "a09x", "a100"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.n for r in df.orderBy(ids.natural_key("n"), "n").collect()] == ["a9", "a09x", "a10", "a100", "b1"]
