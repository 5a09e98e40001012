"""Substring de-duplication by seed and extend.

Words are runs of anything but ASCII white space, unchanged. A window is ``length`` consecutive words of one document; it
repeats if its words also occur in a document with a smaller doc_id. Of every window the least hash among its grams of
``SEED`` words, the leftmost of equal ones, is its anchor, so that equal windows have equal anchors at equal places and
neighbouring windows mostly share theirs: some two words in nine begin an anchor.

1. Anchors are counted by hash, map-side first; those of two documents or more are shared. A Bloom filter of bounded
   size takes them to the texts: what it lets through too much is found to be of one document later, so it costs rows
   and never a result.
2. A shared anchor is extended both ways as far as the windows reach that chose it, which is a stretch of at most
   2 * ``length`` - ``SEED`` words; longer repeats are chains of stretches. Documents meet on (anchor, stretch) in an
   aggregation, not in pairs: where a smaller document has the same stretch, all of it repeats.
3. Where a document is the first with its stretch, but the anchor has others, the stretch agrees with them in part. Only
   there single windows are compared, once for each different stretch instead of once for each document.
4. Stretches and windows that repeat are merged into maximal repeats, which are at least ``length`` words long.

Hot passages are single rows after the map-side sums, and the joins that take a verdict back to their holders are between
written tables, which Spark may split. Texts move only if the filter of documents with a repeat may hold theirs. Anchors,
stretches and windows are known by 64 bits within 64 bits.

A null text has no words. Rows that repeat a doc_id are each a document but no repeats of each other; a null doc_id is
smaller than any other, so such rows lose nothing and make others lose. Equal windows of one document don't repeat by
themselves. No rows give no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionloom.llm.common import CHUNK_BYTES, bounded_batches, chunks, id_filter, materialize, membership, mix, powers, word_hashes

#: Words of a seed and of a window.
SEED, LENGTH = 6, 13
#: Smaller than any doc_id: what a null one counts as.
NO_ID = -(2**63)
_next_space = re.compile(rb"[\x20\x09-\x0D]").search


def _hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and numbers of words; a text above CHUNK_BYTES is read in pieces that end at white space."""
    if len(texts) != 1 or len(texts[0] or b"") <= 2 * CHUNK_BYTES:
        return word_hashes(texts, fold=False)
    text, at, parts = texts[0], 0, []
    while at < len(text):
        found = _next_space(text, at + CHUNK_BYTES)
        stop = found.start() if found else len(text)
        parts.append(word_hashes([text[at:stop]], fold=False)[0])
        at = stop
    h = np.concatenate(parts)
    return h, np.array([len(h)])


def _stretch(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of the words [start, stop) from the running sums."""
    return mix((sums[stop] - sums[start]) * powers(len(sums))[1][start] + (stop - start).astype(np.uint64))


def anchored(texts: list[bytes | None], length: int) -> tuple[np.ndarray, ...] | None:
    """For each anchor of each text, in order: number of the text, hash of the anchor, hash of its stretch, first window
    (counted in words of the text), number of windows, and then the hashes of all windows one after another. None if no
    text has a window."""
    seed, (h, n) = min(SEED, length), _hashes(texts)
    doc, start = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
    place = np.arange(len(h) - length + 1)
    whole = doc[: len(place)] == doc[length - 1 :] if len(place) else np.zeros(0, bool)
    if not whole.any():
        return None
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(len(h) + 1)[0][: len(h)], out=sums[1:])
    gram = _stretch(sums, np.arange(len(h) - seed + 1), np.arange(seed, len(h) + 1))
    least, width = np.arange(len(gram)), 1
    while width < length - seed + 1:  # the place of the least of ever more grams, the leftmost of equal ones
        step = min(width, length - seed + 1 - width)
        left, right = least[:-step], least[step:]
        least, width = np.where(gram[right] < gram[left], right, left), width + step
    window = place[whole]
    anchor = least[window]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)]))
    size = np.diff(np.append(first, len(window)))
    begin, text = window[first], doc[window[first]]
    stretch = _stretch(sums, begin, begin + size - 1 + length)
    return text, gram[anchor[first]], stretch, begin - start[text], size, _stretch(sums, window, window + length)


def _seeds(length: int):
    """(h, doc): the different anchors of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc").to_numpy()
            for start, stop, texts in chunks(batch, "text"):
                found = anchored(texts, length)
                if found is not None:
                    order = np.lexsort((found[1], found[0]))
                    text, h = found[0][order], found[1][order]
                    new = np.concatenate([[True], (text[1:] != text[:-1]) | (h[1:] != h[:-1])])
                    yield pa.record_batch({"h": h[new].view(np.int64), "doc": ids[start:stop][text[new]]})

    return run


def _stretches(length: int, held):
    """The stretches of the anchors that the filter may hold, with the hashes of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may_hold = membership(held)
        for batch in batches:
            ids, keys = batch.column("doc").to_numpy(), batch.column("key").to_numpy()
            for start, stop, texts in chunks(batch, "text"):
                found = anchored(texts, length)
                if found is None:
                    continue
                text, h, stretch, begin, size, windows = found
                hit = may_hold(h.view(np.int64))
                offsets = np.concatenate([[0], np.cumsum(size[hit] * 8)]).astype(np.int32)
                own = pa.Array.from_buffers(pa.binary(), int(hit.sum()), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(windows[np.repeat(hit, size)].tobytes())])
                yield pa.record_batch({"h": h[hit].view(np.int64), "stretch": stretch[hit].view(np.int64), "doc": ids[start:stop][text[hit]], "key": keys[start:stop][text[hit]], "begin": begin[hit].astype(np.int64), "size": size[hit].astype(np.int32), "windows": own})

    return run


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window."""
    for batch in batches:
        size = batch.column("size").to_numpy()
        row = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(row)) - (np.cumsum(size) - size)[row]
        hashes = np.frombuffer(b"".join(batch.column("windows").to_pylist()), np.int64)
        columns = {c: batch.column(c).take(pa.array(row)) for c in ("h", "doc", "key")}
        yield pa.record_batch(columns | {"window": hashes, "begin": batch.column("begin").to_numpy()[row] + at})


def _known(df: DataFrame) -> DataFrame:
    """doc_id, text, doc (a null id as NO_ID) and a key of the text: what repeats in a row follows from doc and text alone."""
    text = F.col("text").cast("string")
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("key"))


def repeats(df: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, key, begin, size): the pieces of the maximal repeats, each ``size`` windows from word ``begin`` on, of the
    documents with id ``doc`` and the text whose xxhash64 is ``key``; pieces may overlap and may be named twice."""
    bounded_batches(df.sparkSession)
    docs = _known(df)
    seeds = docs.select("doc", "text").mapInArrow(_seeds(length), "h long, doc long")
    spread = seeds.groupBy("h").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    shared = materialize(spread.where(F.col("least") < F.col("most")).select("h"), "substring-anchors")
    held = id_filter(shared, "h")
    found = docs.select("doc", "key", "text").mapInArrow(_stretches(length, held), "h long, stretch long, doc long, key long, begin long, size int, windows binary")
    found = materialize(found, "substring-stretches")
    firsts = materialize(found.groupBy("h", "stretch").agg(F.min("doc").alias("first")), "substring-firsts")
    judged = found.join(firsts, ["h", "stretch"])
    own = F.col("first") == F.col("doc")
    judged = materialize(judged.select("doc", "key", "begin", "size", own.alias("own"), F.when(own, F.col("h")).alias("h"), F.when(own, F.col("windows")).alias("windows")), "substring-judged")
    several = firsts.groupBy(F.col("h").alias("several")).agg(F.min("first").alias("least"), F.max("first").alias("most")).where(F.col("least") < F.col("most"))
    several = materialize(several.select("several"), "substring-several")
    partly = judged.where("own").join(several, F.col("h") == F.col("several"), "left_semi")
    windows = materialize(partly.select("h", "doc", "key", "begin", "size", "windows").mapInArrow(_split, "h long, doc long, key long, window long, begin long"), "substring-windows")
    earliest = materialize(windows.groupBy("h", "window").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where(F.col("least") < F.col("most")).select("h", "window", "least"), "substring-earliest")
    later = windows.join(earliest, ["h", "window"]).where(F.col("least") < F.col("doc")).select("doc", "key", "begin", F.lit(1).alias("size"))
    return judged.where(~F.col("own")).select("doc", "key", "begin", "size").unionByName(later)


def _covered(pieces: list[int] | None, length: int) -> list[tuple[int, int]]:
    """Maximal repeats [start, stop) in words, from the packed pieces."""
    out: list[tuple[int, int]] = []
    for piece in sorted(pieces or []):
        start, stop = piece >> 16, (piece >> 16) + (piece & 0xFFFF) - 1 + length
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


_RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,stop:long>>, kept string"


def _cut(length: int, unheld=None):
    """Rows of _RESULT from texts with their pieces, or for those whose document the filter ``unheld`` surely doesn't hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may_hold = None if unheld is None else membership(unheld)
        for batch in batches:
            if may_hold is not None:
                batch = batch.filter(pa.array(~may_hold(batch.column("doc").to_numpy())))
            ids = batch.column("doc_id")
            for start, stop, texts in chunks(batch, "text"):
                pieces = [None] * len(texts) if may_hold is not None else batch.column("pieces").slice(start, stop - start).to_pylist()
                n, removed, spans, kept = [], [], [], []
                for text, own in zip(texts, pieces, strict=True):
                    words = (text or b"").split()
                    covered = _covered(own, length)
                    n.append(len(words))
                    if covered:
                        left = np.ones(len(words), bool)
                        for a, b in covered:
                            left[a:b] = False
                        words = list(compress(words, left.tolist()))
                    removed.append(n[-1] - len(words))
                    spans.append([{"start": a, "stop": b} for a, b in covered])
                    kept.append(b" ".join(words).decode("utf-8", "replace"))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                yield pa.record_batch({"doc_id": ids.slice(start, stop - start), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.string())})

    return run


def remove_repeats(df: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, spans (the maximal repeats, [start, stop) in words) and kept (the other words, joined
    by one space) for every row of ``df``."""
    if not 1 <= length < 1 << 15:
        raise ValueError("a window has from 1 to 32767 words")
    found = repeats(df, length)
    packed = found.select("doc", "key", F.shiftleft("begin", 16).bitwiseOR(F.col("size").cast("long")).alias("piece"))
    pieces = packed.groupBy(F.col("doc").alias("of_doc"), F.col("key").alias("of_key")).agg(F.collect_set("piece").alias("pieces"))  # of one text
    pieces = materialize(pieces, "substring-pieces")
    held = id_filter(pieces.select("of_doc").distinct(), "of_doc")
    docs = _known(df)
    whole = docs.select("doc_id", "text", "doc").mapInArrow(_cut(length, held), _RESULT)

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may_hold = membership(held)
        for batch in batches:
            yield batch.filter(pa.array(may_hold(batch.column("doc").to_numpy())))

    moved = docs.mapInArrow(touched, docs.schema)
    joined = moved.join(pieces, (F.col("doc") == F.col("of_doc")) & (F.col("key") == F.col("of_key")), "left").select("doc_id", "text", "pieces")
    return whole.unionByName(joined.mapInArrow(_cut(length), _RESULT))
