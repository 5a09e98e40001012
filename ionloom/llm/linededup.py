"""Line de-duplication with two Bloom filters, one for hashes seen once and one for hashes seen twice.

Lines are split at \n; a line's key is the line stripped of ASCII white space with A-Z lower-cased. Keys of at least
``min_chars`` code points in at least ``min_docs`` documents lose all their lines but those of the largest doc_id that
holds them. Every task sends the 64-bit hashes of its keys to the owner of their slice, whose once-seen filter finds those
that come again; there are as many slices as the keys of the text can fill, so this filter is as sparse at any size. The
hashes seen again, which repeated keys alone make many of, form the twice-seen filter, which is broadcast up to
``max_bits``; of more, lines meet them in a join on the hash. A line whose hash isn't among them is in one document only
and stays where it is; the others, the suspects, shuffle with their whole keys, so that a false positive costs a shuffled
line and never changes a result. Hot keys are counted map-side first, and the join that sends a verdict back to the
holders of a key is one that Spark can split. Only texts whose doc_id may have lost a line move to meet the verdicts.

A null or empty text is one empty line. Rows that repeat a doc_id count as one document; a null doc_id is a document
smaller than any other. Ties can't occur, as doc_ids order the holders. No rows give no rows. Extra columns are ignored
by ``dedup_lines`` and kept by ``with_kept_lines``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionloom.llm.common import FILTER_BITS, SPACE, bounded_batches, free_name, id_filter, materialize, maybe_in, membership, mix

#: Bits of a slice of the once-seen filter, bits for each key that the text may hold, and probes for a key.
SLICE_BITS, KEY_BITS, PROBES = 1 << 22, 16, 4
#: Bits at most of the twice-seen filter, which goes to every task (32 MB), and bits for each of its hashes.
MAX_BITS, HASH_BITS = FILTER_BITS, 12


def keys_of(text: bytes | None, min_chars: int) -> list[bytes | None]:
    """The key of each line, or None where the line is too short to be judged."""
    out = []
    for line in (text or b"").split(b"\n"):
        key = line.strip(SPACE).lower()  # of bytes: A-Z only
        out.append(key if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars) else None)
    return out


def _hash(key: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little")


def _probes(h: np.ndarray, bits: int) -> np.ndarray:
    """PROBES positions below ``bits`` for each hash."""
    second = mix(h) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((h >> np.uint64(8))[None, :] + steps * second[None, :]) & np.uint64(bits - 1)


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _hashes(min_chars: int, slices: int):
    """(slice, h, twice) of the keys of all texts, each once for 512 texts; ``twice`` where several of these hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                found: list[int] = []
                for text in _texts(batch.slice(at, 512)):
                    found += {_hash(k) for k in keys_of(text, min_chars) if k is not None}
                h, seen = np.unique(np.array(found, np.uint64), return_counts=True)
                yield pa.record_batch({"slice": (h % np.uint64(slices)).astype(np.int64), "h": h.view(np.int64), "twice": seen > 1})

    return run


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes that the once-seen filter of their slice has met before, or that come as seen twice."""
    once: dict[int, np.ndarray] = {}
    for batch in batches:
        slices, hashes, more = batch.column("slice").to_numpy(), batch.column("h").to_numpy().view(np.uint64), batch.column("twice").to_numpy(zero_copy_only=False)
        for k in np.unique(slices).tolist():
            own = slices == k
            h, seen = np.unique(hashes[own], return_counts=True)
            known = once.setdefault(k, np.zeros(SLICE_BITS, bool))
            at = _probes(h, SLICE_BITS)
            hit = known[at].all(axis=0) | (seen > 1)
            hit[np.searchsorted(h, hashes[own][more[own]])] = True
            known[at.ravel()] = True
            yield pa.record_batch({"h": h[hit].view(np.int64)})


def _lines(min_chars: int, held=None):
    """(doc_id, part, key, h) of the different keys of every text, or of those whose hash the filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may_hold = None if held is None else membership(held)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                owner, keys = [], []
                for i, text in enumerate(_texts(rows)):
                    own = {k for k in keys_of(text, min_chars) if k is not None}
                    owner += [i] * len(own)
                    keys += own
                h = np.array([_hash(k) for k in keys], np.uint64).view(np.int64)
                hit = np.arange(len(h)) if may_hold is None or not len(h) else np.flatnonzero(may_hold(h))
                of = pa.array(np.array(owner, np.int64)[hit], pa.int64())
                columns = {c: rows.column(c).take(of) for c in ("doc_id", "part")}
                yield pa.record_batch(columns | {"key": pa.array([keys[i].decode("utf-8", "replace") for i in hit.tolist()], pa.string()), "h": h[hit]})

    return run


def _apply(min_chars: int, unheld=None):
    """What is left of texts without the keys in ``gone``, or of those whose doc_id the filter ``unheld`` surely doesn't hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may_hold = None if unheld is None else membership(unheld)
        for batch in batches:
            if may_hold is not None:
                ids = batch.column("doc_id")
                batch = batch.filter(pa.array(~(may_hold(ids.fill_null(0).to_numpy()) | ids.is_null().to_numpy(zero_copy_only=False))))
            lost = [None] * batch.num_rows if may_hold is not None else batch.column("gone").to_pylist()
            out = {"doc_id": [], "n_lines": [], "n_dropped": [], "kept": []}
            for doc, text, gone in zip(batch.column("doc_id").to_pylist(), _texts(batch), lost, strict=True):
                lines = (text or b"").split(b"\n")
                kept = lines
                if gone:
                    drop = {k.encode() for k in gone}
                    kept = [line for line, key in zip(lines, keys_of(text, min_chars), strict=True) if key is None or key not in drop]
                out["doc_id"].append(doc)
                out["n_lines"].append(len(lines))
                out["n_dropped"].append(len(lines) - len(kept))
                out["kept"].append(b"\n".join(kept).decode("utf-8", "replace"))
            yield pa.record_batch({"doc_id": pa.array(out["doc_id"], pa.int64()), "n_lines": pa.array(out["n_lines"], pa.int64()), "n_dropped": pa.array(out["n_dropped"], pa.int64()), "kept": pa.array(out["kept"], pa.string())})

    return run


def _part(doc_id: Column, text: Column) -> Column:
    """What tells the texts of null doc_ids apart, which are one document."""
    return F.when(doc_id.isNull(), F.coalesce(F.xxhash64(text), F.lit(0))).otherwise(F.lit(0).cast("long"))


def repeated_lines(df: DataFrame, min_chars: int = 20, min_docs: int = 3, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(holders, repeated): the suspected (doc_id, part, key), and of their keys those in ``min_docs`` documents with the
    doc_id that keeps them (key, n_docs, keep)."""
    bounded_batches(df.sparkSession)
    id_, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    docs = df.select(id_.alias("doc_id"), _part(id_, text).alias("part"), text.alias("text"))
    bytes_ = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number
    slices = 1 + bytes_ * KEY_BITS // ((min_chars + 1) * SLICE_BITS)  # no text holds more keys than that many
    hashes = docs.select("text").mapInArrow(_hashes(min_chars, slices), "slice long, h long, twice boolean")
    again = materialize(hashes.repartition(slices, "slice").mapInArrow(_again, "h long").distinct(), "linededup-again")
    if HASH_BITS * again.count() <= max_bits:
        suspects = docs.mapInArrow(_lines(min_chars, id_filter(again, "h")), "doc_id long, part long, key string, h long")
    else:
        suspects = docs.mapInArrow(_lines(min_chars), "doc_id long, part long, key string, h long").join(again, "h", "left_semi")
    holders = materialize(suspects.select("doc_id", "part", "key").distinct(), "linededup")
    count = F.count("doc_id") + F.max(F.col("doc_id").isNull().cast("long"))
    repeated = holders.groupBy("key").agg(count.alias("n_docs"), F.max("doc_id").alias("keep")).where(F.col("n_docs") >= min_docs)
    return holders, materialize(repeated, "linededup-keys")  # a table of its own, so that Spark may split the hot keys of the join with it


def _gone(holders: DataFrame, repeated: DataFrame, holder: str = "held_by_", part: str = "part_", keys: str = "gone_") -> DataFrame:
    """(held_by_, part_, gone_), or other names: the keys that a doc_id, or one text of the null doc_id, loses."""
    lost = holders.join(repeated.select("key", "keep"), "key").where(~F.col("doc_id").eqNullSafe(F.col("keep")))
    return materialize(lost.groupBy(F.col("doc_id").alias(holder), F.col("part").alias(part)).agg(F.collect_set("key").alias(keys)), "linededup-gone")


def dedup_lines(df: DataFrame, min_chars: int = 20, min_docs: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped, kept (the remaining lines joined by \\n) for every row of ``df``."""
    gone = _gone(*repeated_lines(df, min_chars, min_docs, max_bits))
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = id_filter(gone.select("held_by_").distinct(), "held_by_")
    moved = maybe_in(docs, "doc_id", held)
    same = F.col("doc_id").eqNullSafe(F.col("held_by_")) & (_part(F.col("doc_id"), F.col("text")) == F.col("part_"))
    joined = moved.join(gone, same, "left").select("doc_id", "text", F.col("gone_").alias("gone"))
    result = "doc_id long, n_lines long, n_dropped long, kept string"
    return docs.mapInArrow(_apply(min_chars, held), result).unionByName(joined.mapInArrow(_apply(min_chars), result))


def _rewrite(min_chars: int, names: list[str], keys: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c) for c in names}
            texts = batch.column("text").to_pylist()
            sizes = batch.column("n_chars").to_pylist() if "n_chars" in names else None
            for i, gone in enumerate(batch.column(keys).to_pylist()):
                if not gone:
                    continue
                raw, drop = (texts[i] or "").encode(), {k.encode() for k in gone}
                kept = [line for line, key in zip(raw.split(b"\n"), keys_of(raw, min_chars), strict=True) if key is None or key not in drop]
                texts[i] = b"\n".join(kept).decode("utf-8", "replace")
                if sizes is not None:
                    sizes[i] = len(texts[i])
            columns["text"] = pa.array(texts, pa.string())
            if sizes is not None:
                columns["n_chars"] = pa.array(sizes, batch.column("n_chars").type)
            yield pa.record_batch(columns)

    return run


def with_kept_lines(df: DataFrame, min_chars: int = 20, min_docs: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``df``, all columns, with the lines dropped from text and n_chars set to what is left of it. A text
    that loses no line stays as it is, null included."""
    holder, part, keys = free_name(df, "held_by_"), free_name(df, "part_"), free_name(df, "gone_")
    gone = _gone(*repeated_lines(df, min_chars, min_docs, max_bits), holder, part, keys)
    number = free_name(df, "number_")
    docs = df.withColumn(number, F.col("doc_id").cast("long"))
    held = id_filter(gone.select(holder).distinct(), holder)
    moved = maybe_in(docs, number, held)
    text = F.col("text").cast("string")
    joined = moved.join(gone.hint("merge"), F.col(number).eqNullSafe(F.col(holder)) & (_part(F.col(number), text) == F.col(part)), "left").drop(holder, part, number)
    return maybe_in(docs, number, held, wanted=False).drop(number).unionByName(joined.mapInArrow(_rewrite(min_chars, df.columns, keys), df.schema))
