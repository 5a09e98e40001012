"""Gene sets, domains, alignment segments, contrasts, diversity and sample-level summaries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ionloom.functions import sequences
from ionloom.operators.stats import average_ranks, group_moments


def gene_sets(entries: DataFrame, id_col: str, terms: Column, least: int = 1) -> DataFrame:
    """(term, members, n): for each term of an array column the sorted distinct ids that carry it."""
    long = entries.select(F.col(id_col).alias("member"), F.explode(terms).alias("term")).where((F.col("term") != "") & F.col("member").isNotNull())
    sets = long.groupBy("term").agg(F.array_sort(F.collect_set("member")).alias("members"))
    return sets.withColumn("n", F.size("members")).where(F.col("n") >= least)


def contrasts(design: DataFrame) -> DataFrame:
    """(treated, control): every ordered pair of levels, by name; ``design`` is (sample, level) and small."""
    levels = design.where(F.col("level").isNotNull()).select("level").distinct()
    return levels.select(F.col("level").alias("treated")).crossJoin(F.broadcast(levels.select(F.col("level").alias("control")))).where("treated < control")


def domains_in_proteoforms(domains: DataFrame, proteoforms: DataFrame) -> DataFrame:
    """Domains (protein, start, end, name) of each proteoform (protein, form, aa_start), with ``excluded`` where the
    domain begins before the proteoform does."""
    return domains.join(proteoforms, "protein").select("protein", "form", "name", "start", "end", (F.col("start") < F.col("aa_start")).alias("excluded"))


def match_segments(alignments: DataFrame) -> DataFrame:
    """Runs of identical residues of each alignment: (hit, segment, query_start, query_end), 1-based and closed.

    ``alignments`` is (hit, query_from, query_seq, midline); a gap in the query takes no query position, and a segment
    ends at every position whose midline isn't the residue itself."""
    cells = alignments.select("hit", "query_from", F.posexplode(F.arrays_zip(F.split("query_seq", "").alias("q"), F.split("midline", "").alias("m"))).alias("at", "c")).select("hit", "query_from", "at", "c.q", "c.m").where("q <> ''")
    along = Window.partitionBy("hit").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumn("place", F.col("query_from") - 1 + F.sum(F.when(F.col("q") != "-", 1).otherwise(0)).over(along))
    same = (F.col("q") == F.col("m")) & (F.col("q") != "-")
    runs = placed.withColumn("breaks", F.sum(F.when(same, 0).otherwise(1)).over(along)).where(same)
    segments = runs.groupBy("hit", "breaks").agg(F.min("place").alias("query_start"), F.max("place").alias("query_end"))
    number = F.row_number().over(Window.partitionBy("hit").orderBy("query_start"))
    return segments.select("hit", number.alias("segment"), "query_start", "query_end")


def segments_on_genome(segments: DataFrame, orfs: DataFrame) -> DataFrame:
    """Segments with genome coordinates; ``orfs`` is (hit, contig, strand, orf_start, orf_end)."""
    at = sequences.to_genome("strand", "orf_start", "orf_end", F.col("query_start") - 1, F.col("query_end") - F.col("query_start") + 1)
    return segments.join(orfs, "hit").select("hit", "segment", "contig", "strand", at.alias("g")).select("hit", "segment", "contig", "strand", "g.start", "g.end")


def concatenated_tags(tags: DataFrame) -> DataFrame:
    """(scanid, sequences): the distinct tags of a scan, sorted and joined."""
    return tags.groupBy("scanid").agg(F.array_join(F.array_sort(F.collect_set("sequence")), ";").alias("sequences"))


def abundance_coverage(counts: DataFrame, rare: int = 10) -> DataFrame:
    """(sample, ace): the published abundance-based coverage estimate of richness from (sample, taxon, n)."""
    seen = counts.where(F.col("n") > 0)
    is_rare = F.col("n") <= rare
    parts = seen.groupBy("sample").agg(
        F.count_if(~is_rare).alias("abundant"), F.count_if(is_rare).alias("s"), F.coalesce(F.sum(F.when(is_rare, F.col("n"))), F.lit(0)).alias("total"),
        F.count_if(F.col("n") == 1).alias("f1"), F.coalesce(F.sum(F.when(is_rare, F.col("n") * (F.col("n") - 1))), F.lit(0)).alias("pairs"),
    )
    c = 1 - F.try_divide(F.col("f1"), F.col("total"))
    spread = F.greatest(F.lit(0.0), F.col("s") / F.nullif(c, F.lit(0.0)) * F.try_divide(F.col("pairs"), F.col("total") * (F.col("total") - 1)) - 1)
    ace = F.col("abundant") + F.col("s") / F.nullif(c, F.lit(0.0)) + F.col("f1") / F.nullif(c, F.lit(0.0)) * F.coalesce(spread, F.lit(0.0))
    return parts.select("sample", F.coalesce(ace, (F.col("abundant") + F.col("s")).cast("double")).alias("ace"))


def dunn(long: DataFrame) -> DataFrame:
    """(id, a, b, z) for each pair of groups of (id, grp, value), corrected for ties."""
    ranked = average_ranks(long.where(F.col("value").isNotNull()), ["id"], "value", "r")
    groups = ranked.groupBy("id", "grp").agg(F.avg("r").alias("mean"), F.count("*").alias("n"))
    ties = ranked.groupBy("id", "value").agg(F.count("*").alias("t")).groupBy("id").agg(F.sum(F.col("t") ** 3 - F.col("t")).alias("ties"), F.sum("t").alias("all"))
    side = lambda s: groups.select("id", F.col("grp").alias(s), F.col("mean").alias(f"m{s}"), F.col("n").alias(f"n{s}"))
    pairs = side("a").join(side("b"), "id").where("a < b").join(ties, "id")
    n = F.col("all")
    spread = (n * (n + 1) / 12 - F.col("ties") / (12 * (n - 1))) * (1 / F.col("na") + 1 / F.col("nb"))
    return pairs.select("id", "a", "b", F.try_divide(F.col("ma") - F.col("mb"), F.sqrt(spread)).alias("z"))


def threshold_t(long: DataFrame, treated: str, control: str, least: float) -> DataFrame:
    """(id, log_fc, t): how far a difference exceeds ``least``, in standard errors; 0 where it doesn't."""
    m = group_moments(long, treated, control).where("n_a >= 2 AND n_b >= 2")
    df = F.col("n_a") + F.col("n_b") - 2
    error = F.sqrt(((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")) / df * (1 / F.col("n_a") + 1 / F.col("n_b")))
    diff = F.col("mean_a") - F.col("mean_b")
    return m.select("id", diff.alias("log_fc"), (F.signum(diff) * F.greatest(F.lit(0.0), F.try_divide(F.abs(diff) - least, error))).alias("t"))


def sample_components(long: DataFrame, k: int = 2) -> DataFrame:
    """(sample, component, score) of a principal component analysis of samples over complete features.

    Spark sums the products of sample pairs over all features; only that square of the number of samples is decomposed."""
    n = long.select(F.count_distinct("sample").alias("n"))
    whole = long.where(F.col("value").isNotNull()).groupBy("id").agg(F.avg("value").alias("level"), F.count("*").alias("own")).crossJoin(F.broadcast(n)).where("own = n").select("id", "level")
    centred = long.join(whole, "id").select("id", "sample", (F.col("value") - F.col("level")).alias("x"))
    other = centred.select("id", F.col("sample").alias("other"), F.col("x").alias("y"))
    products = centred.join(other, "id").groupBy("sample", "other").agg(F.sum(F.col("x") * F.col("y")).alias("p")).collect()  # samples squared
    names = sorted({r["sample"] for r in products})
    place = {s: i for i, s in enumerate(names)}
    gram = np.zeros((len(names), len(names)))
    for r in products:
        gram[place[r["sample"]], place[r["other"]]] = r.p
    values, vectors = np.linalg.eigh(gram) if names else (np.zeros(0), np.zeros((0, 0)))
    rows = []
    for c, j in enumerate(np.argsort(-values)[:k], 1):
        vector = vectors[:, j] * (1 if vectors[np.argmax(np.abs(vectors[:, j])), j] >= 0 else -1)
        rows += [(s, c, float(v)) for s, v in zip(names, vector * np.sqrt(max(0.0, values[j])), strict=True)]
    kind = long.schema["sample"].dataType.simpleString()
    return long.sparkSession.createDataFrame(rows, f"sample {kind}, component int, score double")


#: The published update of distances when groups i and j merge, as functions of the sizes of i, j and another group k: the
#: weights of the distances (i, k), (j, k), (i, j) and of |(i, k) - (j, k)|. The last three work on squared distances.
LINKAGES = {
    "single": lambda i, j, k: (0.5, 0.5, 0.0, -0.5),
    "complete": lambda i, j, k: (0.5, 0.5, 0.0, 0.5),
    "average": lambda i, j, k: (i / (i + j), j / (i + j), 0.0, 0.0),
    "weighted": lambda i, j, k: (0.5, 0.5, 0.0, 0.0),
    "centroid": lambda i, j, k: (i / (i + j), j / (i + j), -i * j / (i + j) ** 2, 0.0),
    "median": lambda i, j, k: (0.5, 0.5, -0.25, 0.0),
    "ward": lambda i, j, k: ((i + k) / (i + j + k), (j + k) / (i + j + k), -k / (i + j + k), 0.0),
}
_SQUARED = ("centroid", "median", "ward")


def sample_distances(long: DataFrame) -> dict[tuple, float]:
    """Euclidean distances of samples over complete features, by pairs in order; summed in Spark, samples squared come back."""
    n = long.select(F.count_distinct("sample").alias("n"))
    whole = long.where(F.col("value").isNotNull()).groupBy("id").agg(F.count("*").alias("own")).crossJoin(F.broadcast(n)).where("own = n").select("id")
    kept = long.join(whole, "id", "left_semi")
    pairs = kept.join(kept.select("id", F.col("sample").alias("other"), F.col("value").alias("y")), "id").where("sample < other")
    return {(r["sample"], r["other"]): r.d for r in pairs.groupBy("sample", "other").agg(F.sqrt(F.sum((F.col("value") - F.col("y")) ** 2)).alias("d")).collect()}


def linkage(long: DataFrame, method: str = "average") -> list[tuple[list, list, float]]:
    """Merges (left members, right members, height) of a clustering of samples by one of LINKAGES; the few samples merge here."""
    return _merges(sample_distances(long), method)


def _merges(far: dict[tuple, float], method: str) -> list[tuple[list, list, float]]:
    power = 2 if method in _SQUARED else 1
    groups = {k: [s] for k, s in enumerate(sorted({s for p in far for s in p}))}
    at = {s[0]: k for k, s in groups.items()}
    between = {(at[a], at[b]): d**power for (a, b), d in far.items()}
    merges, new = [], len(groups)
    while len(groups) > 1:
        height, i, j = min((d, i, j) for (i, j), d in between.items())
        merges.append((groups[i], groups[j], max(0.0, height) ** (1 / power)))
        for k in [k for k in groups if k not in (i, j)]:
            a, b, c, e = LINKAGES[method](len(groups[i]), len(groups[j]), len(groups[k]))
            left, right = between[min(i, k), max(i, k)], between[min(j, k), max(j, k)]
            between[k, new] = a * left + b * right + c * height + e * abs(left - right)
        groups[new] = sorted(groups[i] + groups[j])
        del groups[i], groups[j]
        between = {p: d for p, d in between.items() if not {i, j} & set(p)}
        new += 1
    return merges


def cophenetic_correlation(long: DataFrame, method: str = "average") -> float:
    """How well the heights at which samples meet follow their distances; nan with fewer than three samples."""
    far = sample_distances(long)
    met = {(min(x, y), max(x, y)): h for a, b, h in _merges(far, method) for x in a for y in b}
    pairs = sorted(far)
    return float(np.corrcoef([far[p] for p in pairs], [met[p] for p in pairs])[0, 1]) if len(pairs) > 2 else float("nan")


def significant_summary(results: DataFrame, p: str, cut: float = 0.05) -> DataFrame:
    """(direction, n, text): how many rows are significant, by the sign of their change."""
    rows = results.where(F.col(p) < cut).select(F.when(F.col("log_fc") > 0, "up").otherwise("down").alias("direction"))
    return rows.groupBy("direction").agg(F.count("*").alias("n")).select("direction", "n", F.format_string("%d %s at p < %s", "n", "direction", F.lit(str(cut))).alias("text"))
