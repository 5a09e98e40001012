"""Abundance: spectral counts, NSAF, organism probabilities and the parsimonious ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionloom.operators.ordered import row_numbers, running_totals
from ionloom.storage import materialize

#: Places to which scores are rounded before they rank, so that the order doesn't hang on the order of float sums.
PLACES = 12


def spectral_counts(evidence: DataFrame) -> DataFrame:
    """(acc, sample, msms): distinct scans of each protein in each sample of ``evidence`` (acc, sample, scan)."""
    return evidence.groupBy("acc", "sample").agg(F.count_distinct("scan").alias("msms"))


def saf(counts: DataFrame, proteins: DataFrame) -> DataFrame:
    """Spectral counts over protein length; ``proteins`` is (acc, length, ...)."""
    return counts.join(proteins.select("acc", "length"), "acc").withColumn("saf", F.try_divide(F.col("msms"), F.col("length")))


def nsaf(safs: DataFrame) -> DataFrame:
    """SAF over the sample's total, and the sum over samples: (acc, summed_nsaf)."""
    total = safs.groupBy("sample").agg(F.sum("saf").alias("total"))
    return safs.join(total, "sample").groupBy("acc").agg(F.round(F.sum(F.col("saf") / F.col("total")), PLACES).alias("summed_nsaf"))


def greedy_cover(ranked: DataFrame, evidence: DataFrame) -> DataFrame:
    """The proteins that, taken in order of ``rank``, each add a scan: exactly those that are the first of some scan.

    ``ranked`` is (acc, rank); the walk down the list that this stands for needs no order here: a scan is new to the
    best-ranked protein that has it, so one min per scan decides, for which repeated rows need not go. Returns (acc, rank, new_scans).
    """
    ranked = materialize(ranked, "rank-order")
    held = evidence.select("acc", "scan").join(ranked, "acc")
    first = held.groupBy("scan").agg(F.min("rank").alias("rank"))
    return ranked.join(first.groupBy("rank").agg(F.count("*").alias("new_scans")), "rank").select("acc", "rank", "new_scans")


def with_rank(df: DataFrame, score: str, key: str = "acc") -> DataFrame:
    """1-based rank by falling score, ties by key."""
    return row_numbers(df, score, (key,))


def organism_prob(scored: DataFrame, retained: DataFrame, proteins: DataFrame) -> DataFrame:
    """Each protein's share of all NSAF times its organism's share among the retained proteins; an organism without a
    retained protein has share 0."""
    named = scored.join(proteins.select("acc", "organism"), "acc")
    total = named.agg(F.sum("summed_nsaf").alias("all_nsaf"))
    kept = named.join(retained.select("acc"), "acc", "left_semi")
    kept_total = kept.agg(F.sum("summed_nsaf").alias("kept_nsaf"))
    by_organism = kept.groupBy("organism").agg(F.sum("summed_nsaf").alias("organism_nsaf"))
    joined = named.join(by_organism, "organism", "left").crossJoin(F.broadcast(total)).crossJoin(F.broadcast(kept_total))  # one row each
    protein = F.round(F.col("summed_nsaf") / F.col("all_nsaf"), PLACES)
    organism = F.round(F.coalesce(F.col("organism_nsaf"), F.lit(0.0)) / F.col("kept_nsaf"), PLACES)
    out = joined.select("acc", "organism", "summed_nsaf", protein.alias("protein_prob"), organism.alias("organism_prob"))
    return out.withColumn("combined_prob", F.round(F.col("protein_prob") * F.col("organism_prob"), PLACES))


def ranked_proteins(evidence: DataFrame, proteins: DataFrame) -> DataFrame:
    """The whole ranking: NSAF, cover, organism probability, cover again by the combined probability."""
    scans = materialize(evidence.select("acc", "sample", "scan").distinct(), "rank-scans")  # each is read several times
    scored = materialize(nsaf(saf(spectral_counts(scans), proteins)), "rank-scored")
    first = materialize(greedy_cover(with_rank(scored, "summed_nsaf").select("acc", "rank"), scans), "rank-first")
    second = materialize(with_rank(organism_prob(scored, first, proteins), "combined_prob"), "rank-second")
    return second.join(greedy_cover(second.select("acc", "rank"), scans).select("acc", "new_scans"), "acc")


def cumulative_coverage(covered: DataFrame) -> DataFrame:
    """Running number and percentage of scans explained down the ranking; one row for each value of the running number."""
    total = covered.agg(F.sum("new_scans").alias("all_scans"))
    run = running_totals(covered, "rank", {"scans": F.col("new_scans")})
    return run.crossJoin(F.broadcast(total)).select("acc", "rank", "scans", F.round(100 * F.col("scans") / F.col("all_scans"), 6).alias("percent"))


def shared_and_unique(peptides: DataFrame) -> DataFrame:
    """Per accession: spectral counts of all its peptides and of those that no other accession has. ``peptides`` is
    (acc, peptide, scans)."""
    owners = peptides.groupBy("peptide").agg(F.count_distinct("acc").alias("owners"))
    joined = peptides.join(owners, "peptide")
    return joined.groupBy("acc").agg(F.sum("scans").alias("all_scans"), F.coalesce(F.sum(F.when(F.col("owners") == 1, F.col("scans"))), F.lit(0)).cast("bigint").alias("unique_scans"))


def median_of_peptides(peptides: DataFrame) -> DataFrame:
    """Protein quantity by group: the median over complete peptides in each sample, then the mean over the samples.

    ``peptides`` is (acc, peptide, sample, level, value) with nulls for missing values; a peptide with a missing value
    in any sample is left out."""
    complete = peptides.groupBy("acc", "peptide").agg(F.count("value").alias("seen"), F.count("*").alias("asked")).where("seen = asked").select("acc", "peptide")
    per_sample = peptides.join(complete, ["acc", "peptide"]).groupBy("acc", "sample", "level").agg(F.median("value").alias("value"), F.count_distinct("peptide").alias("n_peptides"))
    return per_sample.groupBy("acc", "level").agg(F.avg("value").alias("value"), F.max("n_peptides").alias("n_peptides"))


def observable_ratio(counts: DataFrame, observable: DataFrame) -> DataFrame:
    """Spectral count over the number of observable peptides: ``observable`` is (acc, n_observable)."""
    return counts.join(observable, "acc").withColumn("ratio", F.try_divide(F.col("msms"), F.col("n_observable")))
