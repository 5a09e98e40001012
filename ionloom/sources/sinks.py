"""Writers: FASTA, GFF3, wiggle tracks, chunks and idempotent appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_fasta(records: DataFrame, path: str, per_file: int | None = None, without: str | None = None) -> None:
    """Records (id, description, seq) as FASTA; ``per_file`` bounds the records of a file, ``without`` drops sequences
    that hold a residue."""
    kept = records.where(~F.contains("seq", F.lit(without))) if without else records
    rest = F.regexp_replace("description", r"^\S*\s*", "")
    head = F.when(F.coalesce(F.length(rest), F.lit(0)) > 0, F.concat_ws(" ", "id", rest)).otherwise(F.col("id"))
    writer = kept.select(F.concat(F.lit(">"), head, F.lit("\n"), F.col("seq")).alias("value")).write.mode("overwrite")
    (writer.option("maxRecordsPerFile", per_file) if per_file else writer).text(path)


def write_by_group(records: DataFrame, path: str, group: str, parts: int) -> None:
    """Records as FASTA with all of a group in one of ``parts`` shares."""
    shared = records.repartition(parts, group)
    shared.select(F.concat(F.lit(">"), "id", F.lit("\n"), F.col("seq")).alias("value")).write.mode("overwrite").text(path)


def gff3_lines(features: DataFrame) -> DataFrame:
    """One GFF3 line for each feature (the nine columns, attributes as a map), missing cells as dots, keys in order."""
    pairs = F.transform(F.array_sort(F.map_entries("attributes")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    columns = [cell(c) for c in ("seqid", "source", "type", "start", "end", "score", "strand", "phase")]
    return features.select("seqid", "start", "end", F.concat_ws("\t", *columns, F.concat(F.array_join(pairs, ";"), F.lit(";"))).alias("value"))


def write_gff3(features: DataFrame, path: str) -> None:
    """GFF3 files sorted by contig, start and end over all files, ready for indexing."""
    gff3_lines(features).orderBy("seqid", "start", "end", "value").select("value").write.mode("overwrite").text(path)


def split_by_type(features: DataFrame) -> DataFrame:
    """Features with ``track``, their type, each with its parent's row once in the child's track."""
    ident, parent = F.try_element_at("attributes", F.lit("ID")), F.try_element_at("attributes", F.lit("Parent"))
    children = features.where(parent.isNotNull()).select(parent.alias("parent_id"), F.col("type").alias("track")).distinct()
    above = features.withColumn("own_id", ident).join(children, F.col("own_id") == F.col("parent_id")).select("track", *features.columns)
    return above.unionByName(features.select(F.col("type").alias("track"), *features.columns))


def wiggle_lines(coverage: DataFrame) -> DataFrame:
    """(contig, place, value): a variableStep head for each contig and a line for each position of (contig, start, end, value) runs."""
    points = coverage.select("contig", F.explode(F.sequence("start", "end")).alias("place"), F.col("value").alias("v"))
    lines = points.select("contig", "place", F.concat_ws(" ", F.col("place").cast("string"), F.col("v").cast("string")).alias("value"))
    heads = coverage.select("contig").distinct().select("contig", F.lit(0).cast("bigint").alias("place"), F.concat(F.lit("variableStep chrom="), F.col("contig").cast("string")).alias("value"))
    return heads.unionByName(lines)


def write_wiggle(coverage: DataFrame, path: str) -> None:
    """Tracks partitioned by contig, each in order of position."""
    ordered = wiggle_lines(coverage).repartition("contig").sortWithinPartitions("contig", "place")
    ordered.select("contig", "value").write.mode("overwrite").partitionBy("contig").text(path)


def replace_files(rows: DataFrame, path: str, file_col: str = "file") -> None:
    """Append rows of source files to a table so that writing a file again replaces its rows: only its partition is rewritten."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(file_col).parquet(path)


def wide_table(long: DataFrame, id_col: str, column: str, value: str, names: list[str], prefix: str) -> DataFrame:
    """The long table with one column for each of the given names."""
    wide = long.groupBy(id_col).pivot(column, names).agg(F.first(value))
    return wide.select(id_col, *(F.col(f"`{n}`").alias(f"{prefix}{n}") for n in names))


def exported_list(values: Column, sep: str = ";") -> Column:
    """A set as a cell: sorted, distinct, joined."""
    return F.array_join(F.array_sort(F.array_distinct(values)), sep)
