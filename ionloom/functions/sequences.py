"""Sequence expressions: digestion, masses, frames, codons and coordinates, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Monoisotopic residue masses in Da, of water, and of carbamidomethyl on C.
RESIDUE_MASS = {
    "A": 71.037114, "R": 156.101111, "N": 114.042927, "D": 115.026943, "C": 103.009185, "E": 129.042593, "Q": 128.05858, "G": 57.021464,
    "H": 137.058912, "I": 113.084064, "L": 113.084064, "K": 128.09496, "M": 131.04049, "F": 147.068414, "P": 97.05276, "S": 87.03203,
    "T": 101.04768, "W": 186.07931, "Y": 163.06333, "V": 99.06841, "U": 150.95363, "O": 237.147735, "J": 113.084064,
}
WATER, CARBAMIDOMETHYL = 18.010565, 57.021464
#: Where trypsin cuts: after K or R, not before P.
TRYPSIN_SITE = r"(?<=[RK])(?=[^P])"
#: The standard genetic code by codon in TCAG order (tables 1 and 11 translate alike), and table 11's start codons.
_BASES = "TCAG"
_AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {a + b + c: _AMINO[16 * i + 4 * j + k] for i, a in enumerate(_BASES) for j, b in enumerate(_BASES) for k, c in enumerate(_BASES)}
START_CODONS, STOP_CODONS = ("TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"), ("TAA", "TAG", "TGA")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_map(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def cut_starts(text: Column, lookahead: Column, begins: Column) -> Column:
    """1-based starts of all matches of a lookahead pattern: the running lengths of the pieces that it cuts the text into.
    ``begins`` says whether the text itself begins with a match."""
    step = lambda a, x: F.struct((a["at"] + F.length(x)).alias("at"), F.concat(a["starts"], F.array(a["at"])).alias("starts"))
    first = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(F.split(text, lookahead), first, step, lambda a: a["starts"])
    return F.when(begins, starts).otherwise(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))))


def occurrences(text: Column | str, pattern: Column | str) -> Column:
    """1-based starts of all occurrences, overlapping ones included, in one pass over the text."""
    text, pattern = _col(text), _col(pattern)
    found = cut_starts(text, F.concat(F.lit(r"(?=\Q"), pattern, F.lit(r"\E)")), text.startswith(pattern))
    return F.when(F.length(pattern) > 0, found).otherwise(F.array().cast("array<int>"))


def tryptic_peptides(protein: Column | str, shortest: int = 7, longest: int = 30) -> Column:
    """The fully cleaved peptides within a range of lengths."""
    pieces = F.split(_col(protein), TRYPSIN_SITE)
    return F.filter(pieces, lambda p: (F.length(p) >= shortest) & (F.length(p) <= longest))


def missed_cleavages(peptide: Column | str, respects_proline: bool = True) -> Column:
    """Cut sites inside a peptide. Without the proline rule a cut at the end counts too, as cleavage tools of this kind do."""
    pattern = TRYPSIN_SITE if respects_proline else r"(?<=[RK])"
    peptide = _col(peptide)
    inner = F.size(F.split(peptide, pattern)) - 1
    if respects_proline:
        return inner
    return F.length(F.regexp_replace(peptide, "[^RK]", "")).cast("int")


def valid_cleavage(before: Column | str, first: Column | str, last: Column | str, after: Column | str, enzyme: str = "Trypsin", specificity: str = "specific") -> Column:
    """Whether a peptide's ends are those an enzyme makes; empty neighbours are the protein's ends.

    specific asks for both ends, semi-specific for one, unspecific for none.
    """
    before, first, last, after = map(_col, (before, first, last, after))
    if specificity == "unspecific":
        return F.lit(True)
    if enzyme == "Whole protein":
        left, right = before == "", after == ""
    else:
        cut = before.isin("K", "R")
        left = (before == "") | (cut & (first != "P") if enzyme == "Trypsin" else cut)
        right = (after == "") | last.isin("K", "R")
    return left & right if specificity == "specific" else left | right


def peptide_mass(peptide: Column | str, fixed_c: float = CARBAMIDOMETHYL, n_term: float = 0.0, c_term: float = 0.0) -> Column:
    """Monoisotopic mass; infinite where a residue has no mass (X, Z, B)."""
    masses = _literal_map(RESIDUE_MASS)
    residues = F.filter(F.split(_col(peptide), ""), lambda r: r != "")
    each = lambda r: F.coalesce(F.try_element_at(masses, r), F.lit(float("inf"))) + F.when(r == "C", F.lit(fixed_c)).otherwise(F.lit(0.0))
    return F.aggregate(residues, F.lit(WATER + n_term + c_term), lambda s, r: s + each(r))


def reverse_complement(nucleotides: Column | str) -> Column:
    return F.reverse(F.translate(_col(nucleotides), "ACGTacgt", "TGCAtgca"))


def frame(nucleotides: Column | str, offset: int) -> Column:
    """The sequence from ``offset`` on, cut to whole codons."""
    rest = F.substring(_col(nucleotides), offset + 1, 2**31 - 1)
    return F.substring(rest, F.lit(1), (F.floor(F.length(rest) / 3) * 3).cast("int"))


def codons(nucleotides: Column | str) -> Column:
    """The whole codons of a sequence, in order."""
    return F.regexp_extract_all(F.upper(_col(nucleotides)), F.lit("(...)"), F.lit(1))


def translate(nucleotides: Column | str) -> Column:
    """The amino acids of the whole codons; codons with other letters give X."""
    code = _literal_map(CODONS)
    return F.array_join(F.transform(codons(nucleotides), lambda c: F.coalesce(F.try_element_at(code, c), F.lit("X"))), "")


def translate_from_start(nucleotides: Column | str) -> Column:
    """As ``translate``, with M for a leading start codon and without a final stop."""
    nucleotides = _col(nucleotides)
    protein = translate(nucleotides)
    met = F.when(F.upper(F.substring(nucleotides, 1, 3)).isin(*START_CODONS), F.concat(F.lit("M"), F.substring(protein, 2, 2**31 - 1))).otherwise(protein)
    return F.regexp_replace(met, r"\*$", "")


def to_genome(strand: Column | str, orf_start: Column | str, orf_end: Column | str, aa_index: Column | str, n_residues: Column | str) -> Column:
    """(start, end) on the genome of residues ``aa_index`` (from 0) on in an open reading frame, 1-based and closed."""
    strand, orf_start, orf_end, at, n = map(_col, (strand, orf_start, orf_end, aa_index, n_residues))
    plus = F.struct((orf_start + 3 * at).alias("start"), (orf_start + 3 * (at + n) - 1).alias("end"))
    minus = F.struct((orf_end - 3 * (at + n) + 1).alias("start"), (orf_end - 3 * at).alias("end"))
    return F.when(strand == "+", plus).otherwise(minus)


def context(seq: Column | str, start: Column, end: Column) -> Column:
    """(start, end, before, first, last, after): a closed 1-based span of a sequence and the residues around it, null at its ends."""
    at = lambda i: F.nullif(F.substring(_col(seq), i, F.lit(1)), F.lit(""))
    before = F.when(start > 1, at(start - 1))
    return F.struct(start.alias("start"), end.alias("end"), before.alias("before"), at(start).alias("first"), at(end).alias("last"), at(end + 1).alias("after"))


def previous_codon(contig: Column | str, strand: Column | str, start: Column, end: Column) -> Column:
    """The codon before a closed 1-based span of a contig, read along the strand; null where the contig doesn't hold it."""
    plus, minus = F.when(start > 3, F.substring(_col(contig), start - 3, F.lit(3))), F.substring(_col(contig), end + 1, F.lit(3))
    codon = F.when(_col(strand) == "-", reverse_complement(minus)).otherwise(plus)
    return F.when(F.length(codon) == 3, codon)


def agrees_with_precursor(sequence: Column | str, precursor: Column | str, ppm: float) -> Column:
    """Whether a sequence's mass is within ``ppm`` of its precursor's."""
    mass = _col(precursor)
    return F.abs(peptide_mass(sequence) - mass) / mass * 1e6 <= ppm


def without_stops(seq: Column | str) -> Column:
    """A sequence without the stops behind it."""
    return F.rtrim(_col(seq), F.lit("*"))
