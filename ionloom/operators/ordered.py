"""Ranks, running totals and exact medians over a whole table, without bringing it into one task.

The table is written once and counted. Up to ``WINDOW_ROWS`` rows are one bucket, for which plain windows are right. More
are dealt by range of the order column and the ties, whatever their types, into buckets of about that many rows, so that
neither a frequent value nor a frequent key fills one. A window inside each bucket plus the totals of the buckets before
it, a row each, gives what one window over everything would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ionloom.storage import materialize

#: Rows of a bucket, about.
WINDOW_ROWS = 200_000


def _dealt(df: DataFrame, order: list[Column], buckets: int | None) -> tuple[DataFrame, bool]:
    """(the written table with bucket_, in the order of reading; whether there are several)."""
    held = materialize(df, "ordered")
    n = buckets or 1 + held.count() // WINDOW_ROWS
    if n == 1:
        return held.withColumn("bucket_", F.lit(0)), False
    return materialize(held.repartitionByRange(n, *order).withColumn("bucket_", F.spark_partition_id()), "ordered-ranges"), True


def running_totals(df: DataFrame, by: str, totals: dict[str, Column], ties: tuple[str, ...] = (), descending: bool = False, buckets: int | None = None, within: tuple[str, ...] = (), following: str | None = None) -> DataFrame:
    """``df`` with running sums, by ``by`` and then ``ties``; each of ``totals`` names the sum of a column expression.
    (by, ties) must be unique; rows whose ``by`` is null are left out. ``within`` starts the sums anew for each of its values.
    ``following`` names a column for the ``by`` of the next row, null for the last."""
    order = [F.desc(by) if descending else F.asc(by), *ties]
    held, several = _dealt(df.where(F.col(by).isNotNull()).withColumns({f"{n}_x_": e for n, e in totals.items()}), order, buckets)
    inside = Window.partitionBy(*within, "bucket_").orderBy(*order)
    sums = inside.rowsBetween(Window.unboundedPreceding, 0)
    run = held.withColumns({n: F.sum(f"{n}_x_").over(sums) for n in totals})
    if following:
        run = run.withColumn(following, F.lead(by).over(inside))
    names = [*totals, *([following] if following else [])]
    if not several:
        return run.select(*df.columns, *names)
    first = F.max(by) if descending else F.min(by)
    own = held.groupBy(F.col("bucket_").alias("b_"), *(F.col(w).alias(f"{w}_w_") for w in within)).agg(*(F.sum(f"{n}_x_").alias(f"{n}_s_") for n in totals), first.alias("first_"))
    along = Window.partitionBy(*(f"{w}_w_" for w in within)).orderBy("b_")  # over the buckets alone
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    before = own.select("b_", *(f"{w}_w_" for w in within), *(F.coalesce(F.sum(f"{n}_s_").over(earlier), F.lit(0)).alias(f"{n}_o_") for n in totals), F.lead("first_").over(along).alias("then_"))
    same = F.col("bucket_") == F.col("b_")
    for w in within:
        same &= F.col(w).eqNullSafe(F.col(f"{w}_w_"))
    run = run.join(before if within else F.broadcast(before), same)  # a row for each bucket
    out = [(F.col(n) + F.col(f"{n}_o_")).alias(n) for n in totals]
    if following:
        out.append(F.coalesce(following, "then_").alias(following))
    return run.select(*df.columns, *out)


def row_numbers(df: DataFrame, by: str, ties: tuple[str, ...], name: str = "rank", descending: bool = True, buckets: int | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with 1-based positions by ``by`` and then the unique ``ties``."""
    return running_totals(df, by, {name: F.lit(1).cast("bigint")}, ties, descending, buckets, within)


def running_min(df: DataFrame, by: str, value: str, name: str, descending: bool = False, buckets: int | None = None) -> DataFrame:
    """``df`` with the least ``value`` so far in the order of the unique ``by``."""
    order = [F.desc(by) if descending else F.asc(by)]
    held, several = _dealt(df.where(F.col(by).isNotNull()), order, buckets)
    run = held.withColumn(name, F.min(value).over(Window.partitionBy("bucket_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    if not several:
        return run.select(*df.columns, name)
    least = held.groupBy(F.col("bucket_").alias("b_")).agg(F.min(value).alias("m_"))
    over = Window.orderBy("b_").rowsBetween(Window.unboundedPreceding, -1)  # over the buckets alone
    before = least.select("b_", F.min("m_").over(over).alias("o_"))
    run = run.join(F.broadcast(before), held["bucket_"] == before["b_"])
    return run.select(*df.columns, F.least(name, F.coalesce("o_", name)).alias(name))


def medians(df: DataFrame, value: str, keys: tuple[str, ...] = (), name: str = "median", buckets: int | None = None) -> DataFrame:
    """(keys, ``name``): the exact median of the non-null values of each key. Equal values are counted map-side first, and
    the counts' running totals find the middle, so that no task holds a key's values. Without keys there is one row, null
    where there are no values; a key without values has none."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("v_")).agg(F.count("*").alias("n_"))
    run = materialize(running_totals(counts, "v_", {"upto_": F.col("n_")}, buckets=buckets, within=keys), "ordered-counts")
    sizes = run.groupBy(*(F.col(k).alias(f"{k}_k_") for k in keys)).agg(F.sum("n_").alias("all_"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{k}_k_"))
    both = run.join(F.broadcast(sizes) if not keys else sizes, same)
    middle = lambda less: F.min(F.when(F.col("upto_") >= F.floor((F.col("all_") + less) / 2), F.col("v_")))
    return both.groupBy(*keys).agg(((middle(1) + middle(2)) / 2).alias(name))
