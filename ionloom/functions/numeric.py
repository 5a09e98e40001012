"""Numeric expressions with the null rules of search results: 0 and NaN are missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mass of a proton in Da, a fixed value.
PROTON = 1.007276


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def measured(x: Column | str) -> Column:
    """The value, null where it is missing: null, NaN or 0."""
    x = _col(x).cast("double")
    return F.when(~F.isnan(x) & (x != 0), x)


def log2_or_null(x: Column | str) -> Column:
    x = _col(x)
    return F.when(x > 0, F.log2(x))


def neg_log10(x: Column | str) -> Column:
    x = _col(x)
    return F.when(x > 0, -F.log10(x))


def half_even(x: Column | str, places: int) -> Column:
    """Rounded half to even."""
    return F.bround(_col(x), places)


def neutral_mass(mz: Column | str, charge: Column | str) -> Column:
    """Mass of the uncharged precursor, to four places."""
    return F.bround(_col(mz) * _col(charge) - F.lit(PROTON) * _col(charge), 4)


def cigar_end(start: Column | str, cigar: Column | str) -> Column:
    """Where an alignment ends on the reference: its matches and deletions count."""
    lengths = F.regexp_extract_all(_col(cigar), F.lit(r"(\d+)[MD]"), F.lit(1))
    return F.aggregate(lengths, _col(start).cast("bigint"), lambda s, n: s + n.cast("bigint"))
