"""Features sorted by place in blocks with an index, so that a region is read from the blocks that hold it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Features of a block, about.
BLOCK_ROWS = 50_000
#: Ranges that features are dealt into, at most: Spark samples some 300 features of each for the driver.
RANGES = 1_000


def write_indexed(features: DataFrame, folder: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Write ``features`` (seqid, start, end and more) below ``folder`` in compressed blocks of neighbouring features, and
    the index of the blocks: (block, seqid, low, high, n), the least start and the greatest end of each seqid in each block.

    Features are dealt by range of (seqid, start, end), so a hot seqid fills many, and each range is cut into blocks by
    place in its order, so that neither the number of blocks nor features of the same place set a range's size alone."""
    blocks = max(1, -(-features.count() // block_rows))
    dealt = features.repartitionByRange(min(blocks, RANGES), "seqid", "start", "end").sortWithinPartitions("seqid", "start", "end")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # in the range
    numbered = dealt.withColumn("block", F.spark_partition_id().cast("long") * blocks + F.floor(place / block_rows))
    numbered.write.partitionBy("block").parquet(f"{folder}/blocks")
    held = features.sparkSession.read.parquet(f"{folder}/blocks")
    index = held.groupBy("block", "seqid").agg(F.min("start").alias("low"), F.max("end").alias("high"), F.count("*").alias("n"))
    index.coalesce(1).write.parquet(f"{folder}/index")  # a row for each seqid of a block
    return features.sparkSession.read.parquet(f"{folder}/index")


def blocks_of(spark: SparkSession, folder: str, seqid: str, start: int, end: int) -> list[int]:
    """The blocks that may hold a feature of the region, from the index alone."""
    index = spark.read.parquet(f"{folder}/index").where((F.col("seqid") == F.lit(seqid)) & (F.col("low") <= end) & (F.col("high") >= start))
    return sorted(r.block for r in index.select("block").collect())  # the region's own blocks


def read_region(spark: SparkSession, folder: str, seqid: str, start: int, end: int) -> DataFrame:
    """The features that overlap [start, end], in order; only the blocks that the index names are opened."""
    wanted = blocks_of(spark, folder, seqid, start, end)
    if wanted:  # their folders alone are listed
        held = spark.read.option("basePath", f"{folder}/blocks").parquet(*(f"{folder}/blocks/block={b}" for b in wanted)).where(F.col("block").isin(wanted))
    else:
        held = spark.read.parquet(f"{folder}/blocks").where(F.lit(False))
    rows = held.where((F.col("seqid") == F.lit(seqid)) & (F.col("start") <= end) & (F.col("end") >= start))
    return rows.drop("block").orderBy("start", "end")
