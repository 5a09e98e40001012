"""Sequence, feature, variant and alignment files as DataFrames, read by Spark's own readers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ionloom.functions import ids, numeric, sequences

GFF3 = "seqid string, source string, type string, start bigint, end bigint, score string, strand string, phase string, attributes string"
DOMAINS = "protein string, md5 string, length int, analysis string, signature string, signature_description string, start int, stop int, score string, status string, date string, interpro string, interpro_description string, go string, pathways string"


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(id, description, seq) of FASTA files, plain or gzipped; a record may hold any number of lines."""
    records = spark.read.option("lineSep", "\n>").text(path)
    clean = F.regexp_replace(F.regexp_replace("value", r"^\s*>", ""), "\r", "")
    lines = F.split(clean, "\n")
    head = F.get(lines, F.lit(0))
    seq = F.regexp_replace(F.array_join(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), ""), r"\s", "")
    return records.where(F.trim("value") != "").select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), head.alias("description"), seq.alias("seq"))


def fasta_table(spark: SparkSession, path: str, shortest: int = 20) -> DataFrame:
    """Open reading frames of a FASTA file with the fields of their ids and their translations of at least ``shortest`` residues."""
    table = read_fasta(spark, path).select("id", "description", "seq", ids.orf_fields("id").alias("f"), sequences.translate_from_start("seq").alias("translation"))
    return table.select("id", "description", "seq", "f.contig", "f.strand", "f.start", "f.end", "translation").where(F.length("translation") >= shortest)


def sniff_separator(spark: SparkSession, path: str) -> str:
    """The separator that occurs most in the first line: tab, semicolon, bar or comma."""
    head = spark.read.text(path).limit(1).collect()
    line = head[0].value if head else ""
    return max("\t;|,", key=lambda s: (line.count(s), -"\t;|,".index(s)))


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str | None = None, with_file: bool = False) -> DataFrame:
    """A delimited file or folder with a header, its separator found in the first line unless given; columns are strings
    without a schema. ``with_file`` adds the file's name."""
    reader = spark.read.option("header", True).option("sep", sep or sniff_separator(spark, path)).option("enforceSchema", False)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.select("*", F.col("_metadata.file_name").alias("file")) if with_file else df


def scan_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is wanted; the keys' size decides how Spark joins."""
    return table.join(keys.select(key).distinct(), key, "left_semi")


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    """GFF3 features with their attributes as a map; comments and embedded sequences are left out."""
    rows = spark.read.schema(GFF3).option("sep", "\t").option("comment", "#").option("mode", "DROPMALFORMED").option("quote", "").csv(path)
    return rows.where(F.col("start").isNotNull()).withColumn("attributes", ids.attributes("attributes"))


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """A domain table of 15 columns; ``-`` is missing, terms are arrays."""
    rows = spark.read.schema(DOMAINS).option("sep", "\t").option("quote", "").csv(path)
    rows = rows.select(*(F.nullif(c, F.lit("-")).alias(c) if kind == "string" else F.col(c) for c, kind in rows.dtypes))
    return rows.withColumn("go", F.split("go", r"\|")).withColumn("pathways", F.split("pathways", r"\|"))


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """(contig, pos, id, ref, alts) of a VCF file."""
    parts = F.split("value", "\t")
    at = lambda i: F.get(parts, F.lit(i))
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return rows.select(at(0).alias("contig"), at(1).cast("bigint").alias("pos"), at(2).alias("id"), at(3).alias("ref"), F.split(at(4), ",").alias("alts"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """(name, reference, strand, start, end, cigar, seq): mapped reads, 1-based and closed; unmapped ones have no place."""
    parts = F.split("value", "\t")
    at = lambda i: F.get(parts, F.lit(i))
    rows = spark.read.text(path).where(~F.col("value").startswith("@") & (F.trim("value") != ""))
    flag = at(1).cast("int")
    mapped = flag.bitwiseAND(4) == 0
    start = at(3).cast("bigint")
    return rows.select(
        at(0).alias("name"), F.when(mapped, at(2)).alias("reference"), F.when(mapped, F.when(flag.bitwiseAND(16) != 0, "-").otherwise("+")).alias("strand"),
        F.when(mapped, start).alias("start"), F.when(mapped, numeric.cigar_end(start - 1, at(5))).alias("end"), at(5).alias("cigar"), at(9).alias("seq"),
    )


def read_direct_tags(spark: SparkSession, path: str, sample: str, header_lines: int = 25) -> DataFrame:
    """Sequence tags of a tag file: an S row sets the scan of the T rows behind it; a 0 in a tag is an O.

    A file is one unit, since its rows depend on the row before; many files are many tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for text in pdf["value"]:
                scan = None
                for line in text.splitlines()[header_lines:]:
                    cells = line.split("\t")
                    if cells[0] == "S" and len(cells) > 1:
                        scan = cells[1]
                    elif cells[0] == "T" and scan is not None and len(cells) > 3:
                        rows.append((f"{sample}.{scan}", cells[1].replace("0", "O"), round(float(cells[2]), 4), round(float(cells[3]), 4), scan, sample))
            yield pd.DataFrame(rows, columns=["scanid", "sequence", "ngap", "cgap", "scan", "sample"])

    whole = spark.read.text(path, wholetext=True)
    return whole.mapInPandas(run, "scanid string, sequence string, ngap double, cgap double, scan string, sample string").withColumn("tag", tag_text())


def tag_text():
    """``ngap,sequence,cgap`` without gaps of zero."""
    part = lambda c: F.when(F.col(c) != 0, F.col(c).cast("string"))
    return F.concat_ws(",", part("ngap"), F.col("sequence"), part("cgap"))


def read_novor(spark: SparkSession, path: str, sample: str, peptide: str = "peptide", scan: str = "scanNum") -> DataFrame:
    """Full-length de novo peptides as tags without gaps; modifications in brackets are dropped."""
    rows = read_delimited(spark, path, sep=",")
    clean = F.regexp_replace(F.col(peptide), r"\([^)]*\)|\[[^\]]*\]", "")
    tags = rows.select(F.concat_ws(".", F.lit(sample), F.trim(scan)).alias("scanid"), F.trim(clean).alias("sequence"), F.lit(0.0).alias("ngap"), F.lit(0.0).alias("cgap"), F.trim(scan).alias("scan"), F.lit(sample).alias("sample"))
    return tags.withColumn("tag", tag_text())


def read_pepnovo(spark: SparkSession, path: str, sample: str) -> DataFrame:
    """Ranked tags of blocks that begin with ``>>``; a block with an error message is left out."""
    blocks = spark.read.option("lineSep", ">>").text(path).where(F.trim("value") != "")
    blocks = blocks.where(~F.col("value").contains("#Problem") & ~F.col("value").contains("# No solutions"))
    lines = blocks.select(F.regexp_extract("value", r"^\s*\S+\s+(\S+)", 1).alias("scan"), F.explode(F.split("value", "\n")).alias("line")).where(F.col("line").rlike(r"^\d+\t"))
    cell = lambda i: F.get(F.split("line", "\t"), F.lit(i))
    tags = lines.select(F.concat_ws(".", F.lit(sample), "scan").alias("scanid"), F.trim(cell(7)).alias("sequence"), F.bround(cell(3).cast("double"), 4).alias("ngap"), F.bround(cell(4).cast("double"), 4).alias("cgap"), "scan", F.lit(sample).alias("sample"), cell(0).cast("int").alias("rank"))
    return tags.withColumn("tag", tag_text())


def read_mapped_tags(spark: SparkSession, path: str) -> DataFrame:
    """(tag, peptide, accession, position) of a mapping file without a header; the tag itself may hold commas."""
    parts = F.split("value", ",")
    n = F.size(parts)
    back = lambda i: F.element_at(parts, -i)
    rows = spark.read.text(path).where(n >= 4)
    return rows.select(F.array_join(F.slice(parts, F.lit(1), n - 3), ",").alias("tag"), back(3).alias("peptide"), back(2).alias("accession"), back(1).cast("int").alias("position"))


def read_blast_xml(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of BLAST XML, one row for each hsp, with the rank of the hit's subject and of the hsp in it."""
    text = lambda name: f"{name} string"
    hsp = "struct<" + ",".join(f"`Hsp_{c}`:string" for c in ("num", "bit-score", "score", "evalue", "query-from", "query-to", "hit-from", "hit-to", "query-frame", "hit-frame", "identity", "positive", "gaps", "align-len", "qseq", "hseq", "midline")) + ">"
    hit = f"struct<Hit_num:string,Hit_id:string,Hit_def:string,Hit_accession:string,Hit_len:string,Hit_hsps:struct<Hsp:array<{hsp}>>>"
    schema = ", ".join([text("`Iteration_query-ID`"), text("`Iteration_query-def`"), text("`Iteration_query-len`"), f"Iteration_hits struct<Hit:array<{hit}>>"])
    rows = spark.read.format("xml").option("rowTag", "Iteration").schema(schema).load(path)
    hits = rows.select(F.col("Iteration_query-def").alias("query"), F.col("Iteration_query-len").cast("int").alias("query_length"), F.explode("Iteration_hits.Hit").alias("h"))
    flat = hits.select("query", "query_length", F.col("h.Hit_def").alias("subject"), F.col("h.Hit_len").cast("int").alias("subject_length"), F.explode("h.Hit_hsps.Hsp").alias("p"))
    number = lambda c, kind="int": F.col(f"p.`Hsp_{c}`").cast(kind)
    return flat.select(
        "query", "query_length", "subject", "subject_length", number("score", "double").alias("score"), number("bit-score", "double").alias("bits"), number("evalue", "double").alias("evalue"),
        number("query-from").alias("query_start"), number("query-to").alias("query_end"), number("hit-from").alias("subject_start"), number("hit-to").alias("subject_end"),
        number("identity").alias("identities"), number("positive").alias("positives"), number("gaps").alias("gaps"), number("align-len").alias("align_length"), F.col("p.Hsp_qseq").alias("query_seq"), F.col("p.Hsp_hseq").alias("subject_seq"),
    )


def read_mzidentml(spark: SparkSession, path: str) -> DataFrame:
    """(spectrum, rank, charge, mz, peptide_ref, passes) of the identifications of an mzIdentML file."""
    item = "struct<_rank:int,_chargeState:int,_experimentalMassToCharge:double,_calculatedMassToCharge:double,_peptide_ref:string,_passThreshold:string>"
    rows = spark.read.format("xml").option("rowTag", "SpectrumIdentificationResult").schema(f"_spectrumID string, SpectrumIdentificationItem array<{item}>").load(path)
    flat = rows.select(F.col("_spectrumID").alias("spectrum"), F.explode("SpectrumIdentificationItem").alias("i"))
    return flat.select("spectrum", F.col("i._rank").alias("rank"), F.col("i._chargeState").alias("charge"), F.col("i._experimentalMassToCharge").alias("mz"), F.col("i._peptide_ref").alias("peptide_ref"), (F.col("i._passThreshold") == "true").alias("passes"))


def id_maps(triples: DataFrame) -> DataFrame:
    """(acc, names): for each accession a map from a name to its sorted distinct values; ``triples`` is (acc, name, value)."""
    values = triples.groupBy("acc", "name").agg(F.array_sort(F.collect_set("value")).alias("values"))
    return values.groupBy("acc").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "values")))).alias("names"))


def unpivot_measures(wide: DataFrame, id_col: str, families: dict[str, str]) -> DataFrame:
    """(id, sample, measure, value): the columns of each family, a measure's name and its column prefix, as rows; 0 is missing."""
    cells = [F.struct(F.lit(c[len(prefix) :]).alias("sample"), F.lit(name).alias("measure"), numeric.measured(F.col(f"`{c}`")).alias("value")) for name, prefix in families.items() for c in wide.columns if c.startswith(prefix)]
    return wide.select(F.col(id_col).alias("id"), F.explode(F.array(*cells)).alias("m")).select("id", "m.sample", "m.measure", "m.value")
