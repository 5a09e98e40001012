"""Identifier and header expressions: every function returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def id_list(cell: Column | str, sep: str = ";") -> Column:
    """The entries of a delimited cell, trimmed, without empty ones; null stays null."""
    return F.filter(F.transform(F.split(_col(cell), sep), lambda x: F.trim(x)), lambda x: x != "")


def accession(entry: Column | str) -> Column:
    """The second of ``a|b|c``, with a reversed entry's prefix kept; an entry without bars is itself."""
    entry = _col(entry)
    parts = F.split(entry, r"\|")
    inner = F.when(F.size(parts) >= 2, F.get(parts, F.lit(1))).otherwise(entry)
    return F.when(entry.startswith("REV__") & (F.size(parts) >= 2), F.concat(F.lit("REV__"), inner)).otherwise(inner)


def parse_ids(cell: Column | str) -> Column:
    """``sp|P1|A_X;REV__sp|P2|B_Y;Z`` becomes ``P1;REV__P2;Z``."""
    return F.array_join(F.transform(id_list(cell), lambda x: accession(x)), ";")


def species_mnemonics(cell: Column | str) -> Column:
    """The species codes of ``sp|P|NAME_SPECIES`` entries, distinct and sorted; other entries are Undefined."""

    def one(entry: Column) -> Column:
        found = F.regexp_extract(entry, r"(?:sp|tr)\|[^|]*\|[^_\s]*_(\w+)", 1)
        return F.when(found == "", F.lit("Undefined")).otherwise(found)

    return F.array_join(F.array_sort(F.array_distinct(F.transform(id_list(cell), lambda x: one(x)))), ";")


def ordered_unique(cell: Column | str) -> Column:
    """Distinct entries in their order."""
    return F.array_distinct(id_list(cell))


def sorted_unique(cell: Column | str) -> Column:
    """Distinct entries, sorted."""
    return F.array_sort(F.array_distinct(id_list(cell)))


def leading(cell: Column | str) -> Column:
    """The first entry."""
    return F.get(id_list(cell), F.lit(0))


def base_orf(orf: Column | str) -> Column:
    """``x_recno_12.3`` becomes ``x_recno_12.0``: the longest form of an open reading frame."""
    return F.regexp_replace(_col(orf), r"(_recno_\d+)\.\d+", "$1.0")


def orf_fields(orf: Column | str) -> Column:
    """The struct (contig, orf, strand, start, end) of ``asm_contig|asm_contig_recno_N.k|(+)10:90``."""
    orf = _col(orf)
    part = lambda k: F.regexp_extract(orf, r"^([^|]*)\|([^|]*)\|\(([-+])\)(\d+):(\d+)", k)
    return F.struct(part(1).alias("contig"), part(2).alias("orf"), part(3).alias("strand"), part(4).try_cast("bigint").alias("start"), part(5).try_cast("bigint").alias("end"))


def organism(description: Column | str) -> Column:
    """What follows ``OS=`` up to the next ``key=``; Unspecified without it."""
    found = F.trim(F.regexp_extract(_col(description), r"OS=(.*?)(?:\s[A-Za-z]+=.*)?$", 1))
    return F.when(found == "", F.lit("Unspecified")).otherwise(found)


def header_value(description: Column | str, key: str) -> Column:
    """The value of ``key=`` in a sequence header, null without it."""
    found = F.trim(F.regexp_extract(_col(description), rf"(?:^|\s){key}=(.*?)(?:\s[A-Za-z]+=.*)?$", 1))
    return F.when(found != "", found)


def protein_name(description: Column | str) -> Column:
    """The words between a header's identifier and its first ``key=``."""
    return F.trim(F.regexp_extract(_col(description), r"^\S*\s*(.*?)(?:\s[A-Za-z]+=.*)?$", 1))


def group_label(group_id: Column | str, members: Column | str) -> Column:
    """``lead;... (Protein group 7)``: how reports name a group."""
    ids = id_list(members)
    more = F.when(F.size(ids) > 1, F.lit(";...")).otherwise(F.lit(""))
    return F.concat(F.get(ids, F.lit(0)), more, F.lit(" (Protein group "), _col(group_id).cast("string"), F.lit(")"))


def il_equivalent(peptide: Column | str) -> Column:
    """Isoleucine and leucine weigh the same, so I becomes L."""
    return F.translate(_col(peptide), "I", "L")


def bare_peptide(modified: Column | str) -> Column:
    """The upper-case residues of a modified sequence."""
    return F.regexp_replace(_col(modified), "[^A-Z]", "")


def is_acetylated(modified: Column | str) -> Column:
    return F.contains(_col(modified), F.lit("_(ac)"))


def is_oxidised(modified: Column | str) -> Column:
    return F.contains(_col(modified), F.lit("M(ox)"))


def strip_character(text: Column | str, character: str) -> Column:
    """Without the character at both ends."""
    return F.trim(_col(text), F.lit(character))


def ungapped(aligned: Column | str) -> Column:
    return F.translate(_col(aligned), "-", "")


def clean_field(name: Column | str) -> Column:
    """Dots, spaces, slashes and brackets become underscores."""
    return F.regexp_replace(_col(name), r"[.\s/\\()\[\]]+", "_")


def attributes(cell: Column | str) -> Column:
    """The map of a feature's ``k=v;`` attributes."""
    return F.str_to_map(F.rtrim(_col(cell), F.lit(";")), F.lit(";"), F.lit("="))


def terms(cell: Column | str, prefix: str, sep: str = r"\|") -> Column:
    """The entries of a bar-delimited cell that begin with ``prefix`` (GO:, KEGG:, Reactome:, MetaCyc:)."""
    return F.filter(F.transform(F.split(_col(cell), sep), lambda x: F.trim(x)), lambda x: x.startswith(prefix))


def ec_numbers(cell: Column | str) -> Column:
    return F.array_distinct(F.regexp_extract_all(_col(cell), F.lit(r"(\d+\.\d+\.\d+\.[\d-]+)"), F.lit(1)))


def url_quoted(text: Column | str) -> Column:
    """Percent-encoded, spaces as %20."""
    return F.replace(F.url_encode(_col(text)), F.lit("+"), F.lit("%20"))


def natural_key(name: Column | str, width: int = 12) -> Column:
    """A sort key under which 9 precedes 10: every run of digits is padded."""
    padded = F.regexp_replace(_col(name), r"(\d+)", "0" * width + "$1")
    return F.regexp_replace(padded, rf"0*(\d{{{width}}})(?!\d)", "$1")


def flag(cell: Column | str) -> Column:
    """``+`` is true; null, empty and ``-`` are false."""
    return F.coalesce(_col(cell) == "+", F.lit(False))
