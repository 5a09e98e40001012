"""Filters, joins, roll-ups, sets and windows over search results."""

from __future__ import annotations

from functools import reduce
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ionloom.operators.ordered import row_numbers, running_min, running_totals
from ionloom.storage import materialize


def split_targets(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """(targets, decoys): rows whose flag isn't ``+``, null included, and those whose flag is."""
    decoy = F.col(flag).eqNullSafe(F.lit("+"))
    return df.where(~decoy), df.where(decoy)


def replicate_support(df: DataFrame, flags: list[Column], more_than: int) -> DataFrame:
    """Rows for which more than so many of the flags hold; a null flag doesn't."""
    return df.where(reduce(lambda a, b: a + b, (F.coalesce(f.cast("int"), F.lit(0)) for f in flags)) > more_than)


def seen_in_several(df: DataFrame, key: str, where: str, more_than: int = 1) -> DataFrame:
    """Rows whose key occurs in more than so many values of ``where``; null keys never."""
    keys = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(where).alias("places_")).where(F.col("places_") > more_than).select(key)
    return df.join(keys, key, "left_semi")


def valid_values(measures: DataFrame, groups: DataFrame, minimum: float) -> DataFrame:
    """The ids with strictly more than ``minimum`` of a group's samples measured in every group.

    ``measures`` is (id, sample, value), ``groups`` is (sample, level)."""
    size = groups.groupBy("level").agg(F.count("*").alias("size"))
    levels = groups.select(F.count_distinct("level").alias("levels"))
    seen = measures.where(F.col("value").isNotNull()).join(groups, "sample").groupBy("id", "level").agg(F.count("*").alias("seen"))
    enough = seen.join(size, "level").where(F.col("seen") > minimum * F.col("size")).groupBy("id").agg(F.count("*").alias("good"))
    return enough.crossJoin(F.broadcast(levels)).where("good = levels").select("id")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key; the order must end in a tie-break."""
    return df.withColumn("place_", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place_") <= n).drop("place_")


def ranked_hits(hits: DataFrame, query: str, subject: str, score: str) -> DataFrame:
    """Alignment rank of each subject in its query by best score, and rank of the hit within the alignment."""
    best = hits.groupBy(query, subject).agg(F.max(score).alias("best_"))
    ranked = best.withColumn("alignment_rank", F.row_number().over(Window.partitionBy(query).orderBy(F.desc("best_"), subject)))
    joined = hits.join(ranked.drop("best_"), [query, subject])
    return joined.withColumn("hsp_rank", F.row_number().over(Window.partitionBy(query, subject).orderBy(F.desc(score), *(c for c in hits.columns if c not in (query, subject, score)))))


def subject_cutoff(hits: DataFrame, query: str, subject: str, order: list[Column], cutoff: int) -> DataFrame:
    """Hits of a query before its (cutoff + 1)-th change of subject in the given order."""
    over = Window.partitionBy(query).orderBy(*order)
    changed = F.when(F.col(subject).eqNullSafe(F.lag(subject).over(over)), 0).otherwise(1)
    return hits.withColumn("change_", changed).withColumn("runs_", F.sum("change_").over(over)).where(F.col("runs_") <= cutoff).drop("change_", "runs_")


def explode_join(groups: DataFrame, group_id: str, members: str, lookup: DataFrame, key: str, value: str, sep: str = ";") -> DataFrame:
    """Members of a delimited cell, looked up, and back to one ordered list for each group: (group_id, values)."""
    rows = groups.select(group_id, F.posexplode(F.split(members, sep)).alias("place_", "member_"))
    found = rows.join(lookup.select(F.col(key).alias("member_"), F.col(value).alias("found_")), "member_")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place_", "found_"))), lambda x: x["found_"])
    return found.groupBy(group_id).agg(F.array_join(F.array_distinct(ordered), sep).alias("values"))


def either_form_join(left: DataFrame, right: DataFrame, full: str, part: str, key: str) -> DataFrame:
    """Rows of both sides that agree on the whole id or on its middle part: two equi-joins, so no row meets all others."""
    a = left.join(right, left[full] == right[key])
    b = left.join(right, left[part] == right[key])
    return a.union(b).distinct()


def reciprocal(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """The pairs that occur in both directions, each once with a < b."""
    seen = pairs.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct()
    back = seen.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return seen.intersect(back).where("a < b")


def with_fallback(keys: DataFrame, sources: list[DataFrame], key: str) -> DataFrame:
    """Each key with the row of the first source that has it; ``source`` is that source's place, null for no hit.
    The sources share their columns and have at most one row for each key."""
    tagged = reduce(DataFrame.unionByName, (s.withColumn("source", F.lit(i)) for i, s in enumerate(sources)))
    best = top_per_key(tagged, [key], [F.col("source").asc()])
    return keys.join(best, key, "left")


def shared_reference_pairs(hits: DataFrame, aligned: DataFrame) -> DataFrame:
    """Pairs (a < b, ref) that share a reference but don't align to each other; ``aligned`` is (a, b) in any direction.

    Pairs of one reference are made here by design: they are the result. References with very many holders belong to
    repeats and should be filtered before."""
    left, right = hits.select(F.col("id").alias("a"), "ref").distinct(), hits.select(F.col("id").alias("b"), "ref").distinct()
    both = left.join(right, "ref").where("a < b")
    known = aligned.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return both.join(known, ["a", "b"], "left_anti").select("a", "b", "ref")


#: Intervals of ``a`` that ``overlaps`` holds together; files repeat such a part for each of ``b``, so it is short.
HELD = 128


def overlaps(a: DataFrame, b: DataFrame, bin_size: int, on: list[str] | None = None, parts: int = 0) -> DataFrame:
    """Pairs of closed intervals that overlap: ``a`` (a_id, a_start, a_end), ``b`` (b_id, b_start, b_end) and shared keys.

    Both sides are dealt into bins, so the join is an equi-join on bin and keys; a pair counts in the first bin they share.
    Where places are dense the pairs are most of what is moved, and they are the result. ``a``, which should be the side
    with fewer rows, is held in parts of a bin, by end: all of ``b``, by start, pass one part before the next, so that a
    file repeats few values of ``a`` in the same order, and each of ``b`` in a run. ``parts``, if more than the session's
    shuffle partitions, deals the bins into so many, as a file's dictionary ends at some 130,000 values.
    """
    keys = [*(on or []), "bin_"]
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / bin_size), F.floor(F.col(hi) / bin_size)))
    dealt = lambda df: df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(*keys)
    left = dealt(a.where("a_start <= a_end").withColumn("bin_", bins("a_start", "a_end")))
    right = dealt(b.where("b_start <= b_end").withColumn("bin_", bins("b_start", "b_end"))).sortWithinPartitions(*keys, "b_start")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("a_start") >= F.col("bin_") * bin_size, "a_end"))
    own = F.struct(*(c for c in a.columns if c not in keys)).alias("x_")
    held = left.select(*keys, own, F.floor((place - 1) / HELD).alias("part_"))
    ends = [f("x_." + c).alias(n) for f, c, n in ((F.min, "a_start", "s0_"), (F.max, "a_start", "s1_"), (F.min, "a_end", "e0_"), (F.max, "a_end", "e1_"))]
    held = held.groupBy(*keys, "part_").agg(F.collect_list("x_").alias("held_"), *ends)
    lo = F.col("bin_") * bin_size  # the first bin that two intervals share is that in which the later of them begins
    near = held.join(right, keys).where((F.col("s0_") <= F.col("b_end")) & (F.col("b_start") <= F.col("e1_")))
    whole = (F.col("s1_") <= F.col("b_end")) & (F.col("b_start") <= F.col("e0_")) & ((F.col("b_start") >= lo) | (F.col("s0_") >= lo))
    near = near.select(*(on or []), *(c for c in b.columns if c not in keys), lo.alias("lo_"), whole.alias("whole_"), F.explode("held_").alias("x_")).select("*", "x_.*")
    met = near.where(F.col("whole_") | ((F.col("a_start") <= F.col("b_end")) & (F.col("b_start") <= F.col("a_end")) & ((F.col("b_start") >= F.col("lo_")) | (F.col("a_start") >= F.col("lo_")))))
    return met.select(*(on or []), *(c for c in (*a.columns, *b.columns) if c not in keys))


def value_counts(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key)


def joined_set(df: DataFrame, key: str, value: str, sep: str = ";") -> DataFrame:
    """Distinct values of a key, sorted and joined; null keys and values are left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(F.col(value).cast("string"))), sep).alias("values"))


def rank_rollup(df: DataFrame, ranks: list[str], measures: list[str], least: int = 1) -> DataFrame:
    """Sums of the measures and the number of rows by every taxon of every rank, in one pass over the unpivoted ranks."""
    pairs = F.explode(F.array(*(F.struct(F.lit(r).alias("rank"), F.col(r).cast("string").alias("taxon")) for r in ranks)))
    long = df.select(*measures, pairs.alias("t")).select(*measures, "t.rank", "t.taxon").where(F.col("taxon").isNotNull())
    sums = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    return long.groupBy("rank", "taxon").agg(F.count("*").alias("peptide_count"), *sums).where(F.col("peptide_count") >= least)


def term_sums(df: DataFrame, terms: Column, measures: list[str]) -> DataFrame:
    """Sums by term; a row counts in full for each of its distinct terms."""
    long = df.select(*measures, F.explode(F.array_distinct(terms)).alias("term")).where(F.col("term") != "")
    return long.groupBy("term").agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures), F.count("*").alias("n"))


def base_coverage(features: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Summed value at every coordinate that changes it: (keys, start, end, value) runs of constant coverage.

    A feature is two events, plus its value at start and minus it after end, so the cost follows the number of features,
    not their length. ``features`` is (keys, start, end, value)."""
    plus = features.select(*keys, F.col("start").alias("at"), F.col(value).alias("change"), F.lit(1).alias("open"))
    minus = features.select(*keys, (F.col("end") + 1).alias("at"), (-F.col(value)).alias("change"), F.lit(-1).alias("open"))
    events = plus.union(minus).groupBy(*keys, "at").agg(F.sum("change").alias("change"), F.sum("open").alias("open"))
    sums = running_totals(events.where(F.col("at").isNotNull()), "at", {"value": F.col("change"), "held": F.col("open")}, within=tuple(keys), following="next_")
    levels = sums.select(*keys, F.col("at").alias("start"), (F.col("next_") - 1).alias("end"), "value", "held")
    return levels.where(F.col("held") > 0).drop("held")


def membership_regions(df: DataFrame, key: str, group: str, groups: list) -> DataFrame:
    """Venn regions: how many keys are in exactly each combination of the groups; bit i stands for groups[i]."""
    bit = reduce(lambda a, b: a + b, (F.max(F.when(F.col(group) == F.lit(g), F.lit(1 << i)).otherwise(F.lit(0))) for i, g in enumerate(groups)))
    return df.groupBy(key).agg(bit.alias("mask")).where(F.col("mask") > 0).groupBy("mask").agg(F.count("*").alias("n"))


def exclusive_to(df: DataFrame, key: str, group: str, value) -> DataFrame:
    """Keys of one group that no other group has."""
    own = df.where(F.col(group) == F.lit(value)).select(key).distinct()
    return own.join(df.where(F.col(group) != F.lit(value)).select(key).distinct(), key, "left_anti")


def common_to_all(df: DataFrame, key: str, group: str) -> DataFrame:
    """Keys that every group has."""
    n = df.select(F.count_distinct(group).alias("groups_"))
    return df.groupBy(key).agg(F.count_distinct(group).alias("own_")).crossJoin(F.broadcast(n)).where("own_ = groups_").select(key)


def target_decoy_fdr(df: DataFrame, score: str, decoy: Column) -> DataFrame:
    """Percentage of decoys among the rows of at least this score, by distinct score.

    Scores are counted first, so the running sums go over distinct scores, not rows."""
    by_score = df.where(F.col(score).isNotNull()).groupBy(score).agg(F.count("*").alias("n_"), F.count_if(decoy).alias("d_"))
    run = running_totals(by_score, score, {"decoys": F.col("d_"), "total": F.col("n_")}, descending=True)
    return run.select(score, "decoys", "total").withColumn("fdr", F.round(100 * F.col("decoys") / F.col("total"), 6))


def benjamini_hochberg(df: DataFrame, p: str, key: str) -> DataFrame:
    """``df`` with ``adjusted``: the least p * n / rank over this and all larger p, at most 1; null p take no part."""
    tested = df.where(F.col(p).isNotNull())
    by_p = tested.groupBy(p).agg(F.count("*").alias("n_"))
    total = tested.agg(F.count("*").alias("m_"))
    ranked = running_totals(by_p, p, {"rank_": F.col("n_")}).crossJoin(F.broadcast(total)).withColumn("raw_", F.col(p) * F.col("m_") / F.col("rank_"))
    adjusted = running_min(ranked, p, "raw_", "adjusted", descending=True).select(p, F.least(F.lit(1.0), "adjusted").alias("adjusted"))
    return tested.join(adjusted, p).select(key, p, "adjusted")


def fill_forward(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    over = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(over))


def dense_ids(df: DataFrame, key: str, name: str) -> DataFrame:
    """1-based ids of the distinct keys in their order; only the distinct keys pass the one ordered task."""
    ids = df.select(key).where(F.col(key).isNotNull()).distinct()
    numeric = isinstance(df.schema[key].dataType, NumericType)
    if numeric:
        return df.join(row_numbers(ids, key, (), name, descending=False), key)
    ids = materialize(ids, "dense-ids")
    ends = ids.agg(F.min(key), F.max(key)).first()
    same = len(commonprefix([x or "" for x in ends]))  # what all keys begin with tells none of them apart
    head = F.conv(F.rpad(F.substring(F.hex(F.substring(key, same + 1, 6)), 1, 12), 12, "0"), 16, 10).cast("double")
    ids = row_numbers(ids.withColumn("head_", head), "head_", (key,), name, descending=False).drop("head_")
    return df.join(ids, key)


def repeated_flag(df: DataFrame, keys: list[str], name: str = "repeated") -> DataFrame:
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*keys)) > 1)


def running_offset(variants: DataFrame, keys: list[str]) -> DataFrame:
    """How far each variant (pos, ref, alt) and those before it shift the coordinates behind it."""
    along = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return variants.withColumn("offset", F.sum(F.length("alt") - F.length("ref")).over(along).cast("bigint"))


def best_mapped(peptides: DataFrame, lineages: DataFrame, target: Column) -> DataFrame:
    """Of each peptide group's entries those with most peptides, of these those whose lineage overlaps the target most;
    ties stay. ``peptides`` is (grp, entry, peptide), ``lineages`` is (entry, lineage array)."""
    counts = peptides.groupBy("grp", "entry").agg(F.count_distinct("peptide").alias("n_peptides"))
    most = counts.withColumn("r_", F.rank().over(Window.partitionBy("grp").orderBy(F.desc("n_peptides")))).where("r_ = 1").drop("r_")
    near = most.join(lineages, "entry").withColumn("overlap", F.size(F.array_intersect("lineage", target)))
    return near.withColumn("r_", F.rank().over(Window.partitionBy("grp").orderBy(F.desc("overlap")))).where("r_ = 1").select("grp", "entry", "n_peptides", "overlap")


def _sent_if_small(counts: DataFrame, rows: int = 500_000) -> DataFrame:
    """A written table of counts, broadcast if it has at most so many rows (some 20 MB)."""
    held = materialize(counts, "counts")
    return F.broadcast(held) if held.count() <= rows else held


def taxon_scores(hits: DataFrame) -> DataFrame:
    """The best hit of each query by organism share * accession share * match share, ties to the smaller accession.
    ``hits`` is (query, acc, organism, score)."""
    n = hits.agg(F.count("*").alias("n_"))
    organism = _sent_if_small(hits.groupBy("organism").agg(F.count("*").alias("o_")))  # organisms are skewed, so that hits shouldn't move by them
    acc = _sent_if_small(hits.groupBy("acc").agg(F.count("*").alias("a_")))
    match = hits.groupBy("query").agg(F.sum("score").alias("m_"))
    joined = hits.join(organism, "organism").join(acc, "acc").join(match, "query").crossJoin(F.broadcast(n))
    weight = F.round(F.col("o_") * F.col("a_") * F.col("score") / F.col("m_"), 8)  # orders as the product of the shares does
    best = top_per_key(joined.withColumn("weight_", weight).where(F.col("m_") > 0), ["query"], [F.desc("weight_"), F.asc("acc"), F.desc("score")])
    best = best.withColumn("prob", F.col("weight_") / (F.col("n_") * F.col("n_")))
    return best.select("query", "acc", "organism", "prob")


def with_ranked_taxon(hits: DataFrame, taxa: DataFrame) -> DataFrame:
    """The hits whose taxon has a rank; ``taxa`` is (taxon, taxon_rank)."""
    return hits.join(taxa.where(F.col("taxon_rank") != "no rank").select("taxon"), "taxon", "left_semi")


def jaccard_percent(df: DataFrame) -> DataFrame:
    """(a, b, shared, percent): for each two groups (a < b) that share a key how many they share, and of how many.

    ``df`` is (key, grp); a key makes one pair for each two of its groups, so groups should be few."""
    seen = df.where(F.col("key").isNotNull() & F.col("grp").isNotNull()).groupBy("key").agg(F.array_sort(F.collect_set("grp")).alias("own"))
    pairs = F.flatten(F.transform("own", lambda a, i: F.transform(F.slice("own", i + 2, F.size("own")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    shared = seen.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("shared"))
    sizes = seen.select(F.explode("own").alias("grp")).groupBy("grp").agg(F.count("*").alias("n"))
    both = shared.join(sizes.select(F.col("grp").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("grp").alias("b"), F.col("n").alias("nb")), "b")
    return both.select("a", "b", "shared", (100 * F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("percent"))


def large_features(long: DataFrame, share: float) -> DataFrame:
    """The rows (id, grp, value) of ids whose values sum up to at least ``share`` of all."""
    own = long.groupBy("id").agg(F.sum("value").alias("own_"))
    whole = own.agg(F.sum("own_").alias("all_"))
    return long.join(own.crossJoin(F.broadcast(whole)).where(F.col("own_") >= share * F.col("all_")).select("id"), "id", "left_semi")  # one row
