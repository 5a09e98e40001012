"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's docs.

Every stage judges rows, whatever their doc_ids: null and repeated ids are kept apart by a row number of the stage's own,
but for line dedup, where rows of one doc_id are one document and a null one is smaller than any other. A null or empty
text has no letter and goes in the first stage; very long ones are read whole. Of rows with equal texts the one with the
smallest doc_id stays, a null one only if there is no other, and of equal ids any one. No rows give no rows. Extra columns
pass through all stages but the last, whatever their names.

A stage's result is written before the next stage is called. That one then deletes the temporary tables of the stages
before it, but for those that its docs still read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.llm import decontam, langid, linededup, ngram_join, sptok
from ionloom.llm.common import free_name, id_filter, materialize, maybe_in
from ionloom.llm.queries import PIECE_MODEL
from ionloom.storage import recorded, release

#: Words of a shingle and Jaccard percentage of the near-duplicate stage; op7's query has its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80

#: A text of this many letters whose cosine with every language is below the least is in none of them.
LETTERS, LEAST_SCORE = 200, 0.1


#: Temporary tables of the stages called so far.
_tables: list[str] = []

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _freeing(stage: Stage) -> Stage:
    """The stage, which first deletes what those before it have left."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _tables[:] = release(spark, _tables, docs)
        with recorded() as made:
            out = stage(spark, docs, sf_dir)
        _tables.extend(made)
        return out

    return run_stage


def _numbered(docs: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``docs`` with a number for every row, written so that it stays the row's, and the number's name."""
    row = free_name(docs, "row_")
    return materialize(docs.withColumn(row, F.monotonically_increasing_id()), tag), row


def _without(rows: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """The numbered rows that aren't among the numbers ``gone``, as documents again."""
    other = free_name(rows, "gone_")
    return rows.join(gone.select(F.col("row_").alias(other)), F.col(row) == F.col(other), "left_anti").drop(row)


@_freeing
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and long texts that are like no language of the labelled documents."""
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.keep_known(docs, model, LETTERS, LEAST_SCORE)


@_freeing
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the largest doc_id only; texts and n_chars change, no document goes."""
    return linededup.with_kept_lines(docs)


@_freeing
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows that links connect, one with the smallest doc_id stays, a null one only if there is no other."""
    rows, row = _numbered(docs, "pipeline-rows")
    linked = ngram_join.link_components(rows.select(F.col(row).alias("doc_id"), "text"), n=NEAR_WORDS, percent=NEAR_PERCENT)
    others = materialize(linked.where("doc_id <> component_id").select(F.col("doc_id").alias("row_"), F.col("component_id").alias("group_")), "pipeline-groups")
    members = materialize(others.union(others.select(F.col("group_").alias("row_"), "group_").distinct()), "pipeline-members")
    judged = id_filter(members, "row_")  # only documents that it may hold move to be judged
    near = maybe_in(rows, row, judged)
    ids = near.select(F.col(row).alias("id_row_"), F.col("doc_id").cast("long").alias("id_"))
    named = materialize(members.join(ids, F.col("row_") == F.col("id_row_")).select("row_", "group_", "id_"), "pipeline-named")
    stays = named.groupBy("group_").agg(F.min(F.struct(F.col("id_").isNull(), F.col("id_"), F.col("row_"))).alias("least")).select(F.col("least.row_").alias("stays_"))
    copies = materialize(named.join(stays, F.col("row_") == F.col("stays_"), "left_anti").select("row_"), "pipeline-copies")
    return maybe_in(rows, row, judged, wanted=False).drop(row).unionByName(_without(near, row, copies))


@_freeing
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the rows whose text holds a passage like a benchmark item."""
    rows, row = _numbered(docs, "pipeline-rows")
    found = decontam.matches(rows.select(F.col(row).alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(rows, row, found.select(F.col("doc_id").alias("row_")).distinct())


@_freeing
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text that is left, with counts and digests."""
    return sptok.encode(docs, PIECE_MODEL, digests=True, with_ids=True)


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", encode),
]

#: Language profiles and SentencePiece ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
