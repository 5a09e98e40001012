"""Resampling of documents by their importance for a target distribution, over hashed runs of words.

Features of a text are all runs of 1 to ``size`` consecutive words, words being runs of letters and digits with A-Z
lower-cased (all that is not ASCII belongs to words), and fall into buckets by their crc32. The gain of a bucket is the
log ratio of its smoothed shares in the target and in all documents; a document's weight is the mean gain of its features.
Weight plus Gumbel noise from the document's id is its score, and the highest scores are a draw without replacement.

Texts of more than ``CHUNK_BYTES`` are cut at word boundaries into chunks that are dealt to all tasks. A chunk owns the
features that start at its own words and carries the ``size`` - 1 words behind them, so that each feature is counted once.
Chunk counts add up to the corpus counts (one number for each bucket, added up in every task first) and chunk weights to
those of the document. Gains are as many numbers as there are buckets, whatever the input, and are broadcast. The highest
scores are ranked by range, with the counts of the ranges before each one, so no task holds all scores.

Gains, weights and scores are whole thousandths, floors of doubles. A null text has no features and weight 0. Repeated
rows are documents each; a null doc_id makes noise as an empty string and comes last among equal scores, rows that are
equal in score and id in any order. No documents give no rows; an empty target leaves only the smoothing. Extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ionloom.llm.common import bounded_batches, chunks, materialize

#: Bytes of a chunk of a long text, and different words whose checksums a task keeps.
CHUNK_BYTES, KEPT_WORDS = 1 << 15, 1 << 20
_WORD = bytes(range(48, 58)) + bytes(range(97, 123))
#: A-Z to a-z, and every ASCII character that is in no word to a space.
_FOLDED = bytes(c if c >= 128 or c in _WORD else c + 32 if 65 <= c < 91 else 32 for c in range(256))
#: Bytes up to which the shift of a checksum over so many bytes has a table.
_TABLED = 64


def _shift_tables() -> np.ndarray:
    """What each byte of a crc32 becomes behind n more bytes: crc(a + b) is the shifted crc(a), exclusive-or crc(b)."""
    out = np.zeros((_TABLED, 4, 256), np.uint32)
    for n in range(_TABLED):
        bare = zlib.crc32(bytes(n))
        for k in range(4):
            out[n, k] = [zlib.crc32(bytes(n), v << (8 * k)) ^ bare for v in range(256)]
    return out


class _Checksums(dict):
    """Numbers of words, each with its crc32, that of a space and the word, and the length of the two."""

    def __init__(self) -> None:
        self.alone, self.behind, self.length = (np.zeros(1 << 12, k) for k in (np.uint32, np.uint32, np.int64))
        self.words: list[bytes] = []
        self.tables = _shift_tables()

    def __missing__(self, word: bytes) -> int:
        at = len(self.words)
        if at == len(self.alone):
            self.alone, self.behind, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.alone, self.behind, self.length))
        self.alone[at], self.behind[at], self.length[at] = zlib.crc32(word), zlib.crc32(b" " + word), len(word) + 1
        self.words.append(word)
        self[word] = at
        return at

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.words) > KEPT_WORDS:
            self.clear()
            self.words.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def longer(self, crc: np.ndarray, next_word: np.ndarray) -> np.ndarray:
        """The checksums of the runs that end in ``crc``, each with a space and the next word behind it."""
        n = self.length[next_word]
        at = np.minimum(n, _TABLED - 1)
        out = self.behind[next_word]
        for k in range(4):
            out = out ^ self.tables[at, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
        for i in np.flatnonzero(n >= _TABLED).tolist():
            out[i] = zlib.crc32(b" " + self.words[next_word[i]], int(crc[i]))
        return out


def _features(sums: _Checksums, texts: list[bytes], carried: list[bytes] | None, size: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words owned by each text, number of the text and bucket of each feature that starts at one of them)."""
    words: list[bytes] = []
    own, all_of = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        mine = text.split()
        own[i] = len(mine)
        words += mine
        if carried is not None:
            words += carried[i].split()
        all_of[i] = len(words)
    number = sums.numbers(words)
    text = np.repeat(np.arange(len(texts)), np.diff(all_of, prepend=0))
    end, begin = all_of[text], (all_of - np.diff(all_of, prepend=0))[text]
    place = np.arange(len(words))
    start = place[place - begin < own[text]] if len(words) else place
    crc, docs, found = sums.alone[number[start]], [], []
    for k in range(size):
        if k:
            more = start + k < end[start]
            start, crc = start[more], crc[more]
            crc = sums.longer(crc, number[start + k])
        docs.append(text[start])
        found.append(crc % np.uint32(buckets))
    return own, np.concatenate(docs), np.concatenate(found).astype(np.int64)


def _pieces(size: int):
    """The chunks of long texts: their own words and those that they carry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
            for row, doc, value in zip(rows, ids, batch.column("text"), strict=True):
                text, at, part = (value.as_py() or "").encode().translate(_FOLDED), 0, 0
                while at < len(text):
                    stop = text.find(b" ", at + CHUNK_BYTES)
                    stop = len(text) if stop < 0 else stop
                    carry, end = [], stop
                    while len(carry) < size - 1 and end < len(text):  # the next words, however many spaces lie between
                        until = text.find(b" ", end)
                        until = len(text) if until < 0 else until
                        if until > end:
                            carry.append(text[end:until])
                        end = until + 1
                    yield pa.record_batch({"row": pa.array([row], pa.int64()), "doc_id": pa.array([doc], pa.int64()), "part": pa.array([part], pa.int64()), "own": pa.array([text[at:stop]], pa.binary()), "carry": pa.array([b" ".join(carry)], pa.binary())})
                    at, part = stop, part + 1

    return run


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes], list[bytes] | None]]:
    """Slices of a batch of whole texts or of chunks, as folded texts and what they carry."""
    if "own" in batch.schema.names:
        for start, stop, own in chunks(batch, "own"):
            yield start, stop, own, batch.column("carry").slice(start, stop - start).to_pylist()
    else:
        for start, stop, texts in chunks(batch, "text"):
            yield start, stop, [(t or b"").translate(_FOLDED) for t in texts], None


def _count(size: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, total = _Checksums(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, texts, carried in _texts(batch):
                total += np.bincount(_features(sums, texts, carried, size, buckets)[2], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch({"bucket": held, "n": total[held]})

    return run


def _weigh(size: int, buckets: int, gains):
    """(row, doc_id, words, features and sum of their gains) for each text or chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, gain = _Checksums(), np.array(gains.value, np.float64)
        for batch in batches:
            rows, ids = batch.column("row"), batch.column("doc_id")
            for start, stop, texts, carried in _texts(batch):
                own, text, bucket = _features(sums, texts, carried, size, buckets)
                n = np.bincount(text, minlength=len(texts))
                total = np.bincount(text, weights=gain[bucket], minlength=len(texts))  # whole numbers, exact in doubles
                yield pa.record_batch({"row": rows.slice(start, stop - start), "doc_id": ids.slice(start, stop - start), "n_words": own, "n_features": n.astype(np.int64), "total": np.rint(total).astype(np.int64)})

    return run


def _cut(df: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(texts that are one chunk, chunks of the others, dealt to all tasks), each with doc_id and the number of its row,
    which follows from the scan's partitions and so stays the row's if a task is repeated."""
    text = F.col("text").cast("string")
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > CHUNK_BYTES
    pieces = rows.where(long).mapInArrow(_pieces(size), "row long, doc_id long, part long, own binary, carry binary")
    return rows.where(~long), pieces.repartition("row", "part").select("row", "doc_id", "own", "carry")


def bucket_counts(df: DataFrame, size: int, buckets: int) -> list[int]:
    """How many features of all texts fall into each bucket."""
    docs = df.select("text").withColumn("doc_id", F.lit(None))
    whole, pieces = (part.mapInArrow(_count(size, buckets), "bucket long, n long") for part in _cut(docs, size))
    out = [0] * buckets
    for r in whole.unionByName(pieces).groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row for each bucket
        out[r.bucket] = r.n
    return out


def bucket_gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln) of the ratio of each bucket's smoothed shares in the target and in the source."""
    k, s, t = len(source), float(sum(source)), float(sum(target))
    return [math.floor(1000 * math.log((b + 1.0) * (s + k) / ((a + 1.0) * (t + k)))) for a, b in zip(source, target, strict=True)]


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise in whole thousandths from the id alone, so that a draw is the same wherever it is made."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def _ranked(df: DataFrame, first: int) -> DataFrame:
    """``df`` with the rank by falling score and rising doc_id, null beyond ``first``."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    dealt = materialize(df.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "resample-ranges")
    sizes = dealt.groupBy(F.col("range").alias("of")).agg(F.count("*").alias("n"))
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each range
    starts = sizes.select("of", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)).cast("long") + F.col("before")
    ranked = dealt.join(F.broadcast(starts), F.col("range") == F.col("of")).withColumn("rank", place)
    return ranked.withColumn("rank", F.when(F.col("rank") <= first, F.col("rank"))).drop("range", "of", "before")


def resample(df: DataFrame, target: DataFrame, size: int = 2, buckets: int = 10_000, least_words: int = 20, percent: int = 25, seed: int = 7) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank for every row of ``df``; the rank is null for those not drawn.
    Of the N rows with at least ``least_words`` words, floor(``percent`` * N / 100) are drawn."""
    spark = df.sparkSession
    bounded_batches(spark)
    gains = spark.sparkContext.broadcast(bucket_gains(bucket_counts(df, size, buckets), bucket_counts(target, size, buckets)))
    sums = "row long, doc_id long, n_words long, n_features long, total long"
    whole, pieces = (part.mapInArrow(_weigh(size, buckets, gains), sums) for part in _cut(df, size))
    added = whole.unionByName(pieces.groupBy("row", "doc_id").agg(*(F.sum(c).alias(c) for c in ("n_words", "n_features", "total"))))
    weight = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(F.lit(0).cast("long"))
    scored = added.select("row", "doc_id", "n_words", "n_features", weight.alias("weight"))
    scored = materialize(scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "resample-scores")
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return _ranked(scored.where(enough), drawn).unionByName(rest).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
