"""Choice of score thresholds for identifications, by joint cumulative counts, and correction of mass errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ionloom.operators.ordered import medians
from ionloom.storage import materialize


def joint_counts(rows: DataFrame, scores: list[str], steps: dict[str, list[float]], decoy: Column) -> DataFrame:
    """(one column for each score, targets, decoys): how many targets and decoys reach all of a combination of thresholds,
    for every combination of ``steps``.

    Rows are counted once by the steps that they reach, map-side first. The counts then add up along one score after the
    other, so the work beyond the one pass over the rows is the number of combinations, whatever the rows. A null score
    reaches no threshold."""
    cuts = {s: sorted(set(steps[s])) for s in scores}
    reached_by = lambda value, steps: F.size(F.filter(F.array(*(F.lit(float(c)) for c in steps)), lambda c: c <= value))
    place = {s: reached_by(F.col(s), cuts[s]) for s in scores}
    known = rows.where(" AND ".join(f"{s} IS NOT NULL" for s in scores))
    cells = known.select(*(place[s].alias(s) for s in scores), F.coalesce(decoy, F.lit(False)).alias("decoy_")).groupBy(*scores).agg(F.count_if(~F.col("decoy_")).alias("targets"), F.count_if(F.col("decoy_")).alias("decoys"))
    grid = rows.sparkSession.range(0, 1, 1, 1)
    for s in scores:  # every combination of the places, one for each threshold and none
        grid = grid.withColumn(s, F.explode(F.sequence(F.lit(0), F.lit(len(cuts[s])))))
    full = grid.drop("id").join(cells, scores, "left").na.fill(0, ["targets", "decoys"])
    for s in scores:
        above = Window.partitionBy(*(o for o in scores if o != s)).orderBy(F.desc(s)).rowsBetween(Window.unboundedPreceding, 0)
        full = full.withColumns({c: F.sum(c).over(above) for c in ("targets", "decoys")})
    reached = full.where(" AND ".join(f"{s} > 0" for s in scores))
    value = lambda s: F.get(F.array(*(F.lit(float(c)) for c in cuts[s])), F.col(s) - 1).alias(s)
    return reached.select(*(value(s) for s in scores), "targets", "decoys")


def best_thresholds(counts: DataFrame, scores: list[str], most: float) -> DataFrame:
    """The combination with the most targets whose decoys are at most ``most`` of them: of equal ones that with fewer
    decoys, then the lowest thresholds in the order of ``scores``. No row if none does."""
    fit = counts.where((F.col("targets") > 0) & (F.col("decoys") <= most * F.col("targets")))
    order = F.struct((-F.col("targets")).alias("t"), F.col("decoys").alias("d"), *(F.col(s) for s in scores))
    best = fit.agg(F.min(order).alias("b")).where("b IS NOT NULL")
    return best.select(*(F.col(f"b.{s}") for s in scores), (-F.col("b.t")).alias("targets"), F.col("b.d").alias("decoys"))


def recalibrated(rows: DataFrame, run: str, mass: str, theoretical: str, trusted: Column, width: float = 100.0) -> DataFrame:
    """``rows`` with ``ppm``, the mass error in millionths, and ``ppm_corrected``, without the run's systematic part: the
    exact median error of the run's trusted rows in the same ``width`` of mass, or of the whole run where that has none."""
    error = (F.col(mass) - F.col(theoretical)) / F.col(theoretical) * 1e6
    held = rows.withColumn("ppm", error).withColumn("bin_", F.floor(F.col(theoretical) / width))
    good = materialize(held.where(trusted).select(run, "bin_", "ppm"), "recalibrate")
    near = medians(good, "ppm", (run, "bin_"), "near_").select(F.col(run).alias("near_run_"), F.col("bin_").alias("near_bin_"), "near_")
    whole = medians(good, "ppm", (run,), "whole_").select(F.col(run).alias("whole_run_"), "whole_")
    met = held.join(near, (F.col(run) == F.col("near_run_")) & (F.col("bin_") == F.col("near_bin_")), "left").join(whole, F.col(run) == F.col("whole_run_"), "left")
    return met.withColumn("ppm_corrected", F.col("ppm") - F.coalesce("near_", "whole_", F.lit(0.0))).select(*rows.columns, "ppm", "ppm_corrected")
