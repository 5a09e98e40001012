"""What sequence variants do to coding sequences: codons and residues that change, and where features lie afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ionloom.functions import sequences
from ionloom.functions.sequences import START_CODONS
from ionloom.operators import seeds
from ionloom.operators.relational import overlaps
from ionloom.operators.seeds import pieces, spans
from ionloom.storage import materialize

#: Bases of a bin in which variants meet features, and in which shifts are added up.
BIN = 1 << 16
#: Bases of a bin of the join of variants with features, which are short.
NEAR = 1 << 11


def coding_impact(contigs: DataFrame, variants: DataFrame, features: DataFrame) -> DataFrame:
    """(contig, pos, ref, alt, feature, codon, ref_codons, alt_codons, ref_residues, alt_residues, kind) for each variant in
    each coding feature that it touches.

    ``contigs`` is (contig, seq), ``variants`` (contig, pos, ref, alt) with 1-based pos and non-empty ref, ``features``
    (contig, feature, strand, start, end), 1-based and closed, read in codons from the strand's first base. ``codon`` is the
    first codon touched, from 1; codons and residues are those from the first to the last one touched, before and after the
    variant alone, the bases along the strand. Kinds, the first that holds: ``crosses an end`` of the feature (without
    codons), ``other reference`` (the contig has other bases), ``frameshift``, ``start lost``, ``stop gained``, ``stop
    lost``, ``synonymous``, ``insertion``, ``deletion``, ``missense``. Variants meet features by bins, and only the bases of
    the codons touched are fetched, from the contig's pieces."""
    size = F.length("ref").cast("long")
    a = variants.where("ref <> ''").select("contig", F.col("pos").cast("long").alias("a_start"), (F.col("pos") + size - 1).alias("a_end"), "ref", F.coalesce("alt", F.lit("")).alias("alt"))
    b = features.select("contig", "feature", "strand", F.col("start").cast("long").alias("b_start"), F.col("end").cast("long").alias("b_end"))
    met = overlaps(a, b, NEAR, ["contig"])
    plus = F.col("strand") == "+"
    inside = (F.col("a_start") >= F.col("b_start")) & (F.col("a_end") <= F.col("b_end"))
    offset = F.when(plus, F.col("a_start") - F.col("b_start")).otherwise(F.col("b_end") - F.col("a_end"))
    met = materialize(met.withColumn("inside", inside).withColumn("offset", offset).withColumn("c0", F.floor(F.col("offset") / 3)).withColumn("c1", F.floor((F.col("offset") + size - 1) / 3)), "impact-met")
    lo = F.when(plus, F.col("b_start") + 3 * F.col("c0")).otherwise(F.greatest(F.col("b_end") - 3 * F.col("c1") - 2, F.col("b_start")))
    hi = F.when(plus, F.least(F.col("b_start") + 3 * F.col("c1") + 2, F.col("b_end"))).otherwise(F.col("b_end") - 3 * F.col("c0"))
    keys = ["contig", "a_start", "a_end", "ref", "alt", "feature", "strand", "offset", "c0"]
    asked = met.where("inside").withColumn("from", lo).withColumn("bases", hi - lo + 1).select(*keys, "from", "bases")
    parts, across = pieces(contigs, "contig", "seq"), F.expr(f"(from - 1) DIV {seeds.PIECE} <> (from + bases - 2) DIV {seeds.PIECE}")
    cells = lambda rows: spans(rows, parts, "contig", "from", F.col("bases"))
    several = cells(asked.where(across)).groupBy(*keys, "from").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "held"))), lambda x: x["held"]), "").alias("held"))  # the variant's own codons
    joined = cells(asked.where(~across)).select(*keys, "held").unionByName(several.select(*keys, "held"))
    along = lambda c: F.when(F.col("strand") == "+", F.upper(c)).otherwise(sequences.reverse_complement(F.upper(c)))
    rows = joined.select(*keys, along(F.col("held")).alias("ref_codons"), along(F.col("ref")).alias("r"), along(F.col("alt")).alias("t"), (F.col("offset") - 3 * F.col("c0")).cast("int").alias("at"))
    changed = F.expr("concat(left(ref_codons, at), t, substring(ref_codons, at + length(r) + 1))")
    rows = rows.withColumn("alt_codons", changed).withColumn("ref_residues", sequences.translate("ref_codons")).withColumn("alt_residues", sequences.translate("alt_codons"))
    grown = F.length("alt") - F.length("ref")
    before, after = F.col("ref_residues"), F.col("alt_residues")
    kind = (
        F.when(F.expr("substring(ref_codons, at + 1, length(r)) <> r"), "other reference")
        .when(grown % 3 != 0, "frameshift")
        .when((F.col("c0") == 0) & F.expr("left(ref_codons, 3)").isin(*START_CODONS) & ~F.expr("left(alt_codons, 3)").isin(*START_CODONS), "start lost")
        .when(after.contains("*") & ~before.contains("*"), "stop gained")
        .when(before.contains("*") & ~after.contains("*"), "stop lost")
        .when(before == after, "synonymous")
        .when(grown > 0, "insertion")
        .when(grown < 0, "deletion")
        .otherwise("missense")
    )
    names = ["contig", F.col("a_start").alias("pos"), "ref", "alt", "feature"]
    found = rows.select(*names, (F.col("c0") + 1).alias("codon"), "ref_codons", "alt_codons", "ref_residues", "alt_residues", kind.alias("kind"))
    none = F.lit(None).cast("string")
    crossing = met.where("NOT inside").select(*names, F.lit(None).cast("long").alias("codon"), *(none.alias(c) for c in ("ref_codons", "alt_codons", "ref_residues", "alt_residues")), F.lit("crosses an end").alias("kind"))
    return found.unionByName(crossing)


def moved_features(features: DataFrame, variants: DataFrame) -> DataFrame:
    """``features`` (contig, feature, start, end) with ``new_start`` and ``new_end``, where they lie once all ``variants``
    (contig, pos, ref, alt), none overlapping another, are applied: null where the bound is a replaced base behind a
    variant's first one, which has no place of its own.

    The old-to-new map is piecewise: a bound moves by the lengths that the variants before it add. A variant is one event,
    behind its first base: where it reaches beyond a bound the bound has no place, and else it counts in full. Events and
    bounds are written once; shifts are added up by bin, over the bins of a contig, and then inside the bin, so that no task
    holds a contig."""
    size = F.length("ref").cast("long")
    old = F.col("pos").cast("long")
    events = variants.select("contig", (old + F.least(size, F.lit(1))).alias("at"), (F.length("alt") - F.length("ref")).cast("long").alias("shift"), (old + size).alias("reach"))
    # a closed end is the base behind it, less one
    bounds = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("start").cast("long").alias("at")), F.struct(F.lit(1).alias("side"), (F.col("end") + 1).cast("long").alias("at"))))
    asked = features.select("contig", "feature", "start", "end", bounds.alias("b")).select("contig", "feature", "start", "end", "b.side", "b.at")
    rows = materialize(events.unionByName(asked, allowMissingColumns=True).withColumn("bin", F.floor(F.col("at") / BIN)), "moved-rows")
    totals = rows.groupBy("contig", "bin").agg(F.sum("shift").alias("shift"), F.max("reach").alias("reach"))
    before = Window.partitionBy("contig").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # a row for each bin
    base = totals.select("contig", "bin", F.sum("shift").over(before).alias("base_shift"), F.max("reach").over(before).alias("base_reach"))
    inside = Window.partitionBy("contig", "bin").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    run = rows.withColumn("s", F.sum("shift").over(inside)).withColumn("r", F.max("reach").over(inside)).where("side IS NOT NULL").join(base, ["contig", "bin"])
    zero = F.lit(0).cast("long")
    moved = F.col("at") + F.coalesce("s", zero) + F.coalesce("base_shift", zero)
    placed = run.withColumn("new", F.when(F.coalesce(F.greatest("r", "base_reach"), zero) <= F.col("at"), moved))
    side = lambda k, less: F.max(F.when(F.col("side") == k, F.col("new") - less))
    return placed.groupBy("contig", "feature", "start", "end").agg(side(0, 0).alias("new_start"), side(1, 1).alias("new_end"))


def without_spans(features: DataFrame, masks: DataFrame) -> DataFrame:
    """(text_id, start, end, part_start, part_end): what of every feature (text_id, start, end) no mask (text_id, m_start,
    m_end) covers, in maximal parts; all closed. A feature wholly under masks has no row.

    Masks meet features by bins, and a feature's masks are laid out in order: a part lies between the furthest end so far
    and the next mask's start."""
    a = features.where("start <= end").select("text_id", F.col("start").alias("a_start"), F.col("end").alias("a_end")).distinct()
    b = masks.select("text_id", F.col("m_start").alias("b_start"), F.col("m_end").alias("b_end"))
    met = overlaps(a, b, NEAR, ["text_id"]).select("text_id", "a_start", "a_end", "b_start", "b_end").distinct()
    stop = a.select("text_id", "a_start", "a_end", (F.col("a_end") + 1).alias("b_start"), (F.col("a_end") + 1).alias("b_end"))
    along = Window.partitionBy("text_id", "a_start", "a_end").orderBy("b_start", "b_end").rowsBetween(Window.unboundedPreceding, -1)
    laid = met.unionByName(stop).withColumn("from", F.greatest(F.col("a_start"), F.coalesce(F.max("b_end").over(along) + 1, F.col("a_start"))))
    free = laid.where("from <= b_start - 1")
    return free.select("text_id", F.col("a_start").alias("start"), F.col("a_end").alias("end"), F.col("from").alias("part_start"), (F.col("b_start") - 1).alias("part_end"))


def masked_counts(hits: DataFrame, masks: DataFrame) -> DataFrame:
    """(pattern, n, n_left): how often each pattern of ``hits`` (text_id, pattern, start, end) occurs, and how often outside
    of all masks (text_id, m_start, m_end); a pattern with n_left 0 is gone once the masks are applied. Hits, which are
    read twice, are written once."""
    a = materialize(hits.select("text_id", "pattern", F.col("start").alias("a_start"), F.col("end").alias("a_end")), "masked-hits")
    b = masks.select("text_id", F.col("m_start").alias("b_start"), F.col("m_end").alias("b_end"))
    keys = ["text_id", "pattern", "a_start", "a_end"]
    under = overlaps(a, b, NEAR, ["text_id"]).select(*keys).distinct()
    gone = under.groupBy("pattern").agg(F.count("*").alias("gone"))
    return a.groupBy("pattern").agg(F.count("*").alias("n")).join(gone, "pattern", "left").select("pattern", "n", (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n_left"))
