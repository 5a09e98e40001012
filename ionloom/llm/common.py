"""What the corpus operators share: written tables that cut lineage, free names, id filters and small array helpers."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.storage import materialize, shared_dir, temporary  # noqa: F401  (the operators' own names for them)

#: Bytes of text that a Python worker turns into arrays at once.
CHUNK_BYTES = 1 << 20
#: ASCII white space, the set [\x20\x09-\x0D] of the contracts; bytes.split() splits on just these.
SPACE = b" \t\n\x0b\x0c\r"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as make it no column of ``df`` (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded_batches(spark: SparkSession) -> None:
    """Let the batches that go to Python hold about 8 MB, however long the rows, unless the session says otherwise.

    The setting stays in the session: Spark reads it when a plan runs, which is after the operator has returned the plan.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(8 << 20))


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """Slices (start, stop, texts as bytes) of a batch of about ``limit`` bytes of text and at most ``rows`` texts; one
    longer text is a slice of its own."""
    texts, start, held = [], 0, 0
    values = batch.column(column).cast(pa.large_binary())
    for i, value in enumerate(values):
        text = value.as_py()
        texts.append(text)
        held += len(text or b"") + 16
        if held >= limit or len(texts) >= rows:
            yield start, i + 1, texts
            texts, start, held = [], i + 1, 0
    if texts:
        yield start, start + len(texts), texts


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_EXACT = np.random.Generator(np.random.PCG64(41)).integers(0, 2**64, 256, dtype=np.uint64)
_BYTE = _EXACT.copy()
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash like a-z
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE)] = True
_BASE = 0x2545F4914F6CDD1D
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first ``n`` powers, at least, of the base of the polynomial hashes and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(max(n, 3 << 19), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def word_hashes(texts: list[bytes | None], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words, number of words of each text): words are runs of anything but ASCII white space, A-Z
    lower-cased if ``fold``. A word's hash is a polynomial over random values of its bytes, found for all words at once
    from running sums."""
    raw = np.frombuffer(b"\n".join([*(t or b"" for t in texts), b""]), np.uint8)
    n = len(raw)
    powers(n + 1)
    space = _IS_SPACE[raw]
    before = np.concatenate([[True], space[:-1]])
    start, stop = np.flatnonzero(before & ~space), np.flatnonzero(space & ~before)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_BYTE if fold else _EXACT)[raw] * _powers[0][:n], out=sums[1:])
    h = mix((sums[stop] - sums[start]) * _powers[1][start] + (stop - start).astype(np.uint64))
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    return h, np.diff(np.searchsorted(start, ends), prepend=0)


#: Bits of an id filter at most (32 MB in every task), slices in which it is built, and probes for an id.
FILTER_BITS, FILTER_SLICES, FILTER_PROBES = 1 << 28, 64, 3


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    h = mix(ids.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    steps = np.arange(FILTER_PROBES, dtype=np.uint64)[:, None]
    inside = np.uint64(bits // FILTER_SLICES)
    own = (h % np.uint64(FILTER_SLICES)) * inside
    return own[None, :] + (((h >> np.uint64(8))[None, :] + steps * (mix(h) | np.uint64(1))[None, :]) % inside)


def id_filter(ids: DataFrame, column: str):
    """A Bloom filter of the non-null ids, broadcast; its size follows their number up to FILTER_BITS, beyond which it
    lets more strangers through."""
    spark = ids.sparkSession
    held = ids.select(F.col(column).cast("long").alias("id")).where(F.col("id").isNotNull())
    bits = 1 << 16
    while bits < min(FILTER_BITS, 12 * held.count()):
        bits *= 2

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("id").to_numpy()
            first = (_places(found, bits)[0] // np.uint64(bits // FILTER_SLICES)).astype(np.int32)
            yield pa.record_batch({"slice": first, "id": batch.column("id")})

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = bits // FILTER_SLICES
        for batch in batches:
            places, own = _places(batch.column("id").to_numpy(), bits), batch.column("slice").to_numpy()
            for k in np.unique(own).tolist():
                held.setdefault(k, np.zeros(size, bool))[(places[:, own == k].ravel() - np.uint64(k * size)).astype(np.int64)] = True
        yield pa.record_batch({"slice": pa.array(list(held), pa.int32()), "bits": pa.array([zlib.compress(np.packbits(v).tobytes(), 1) for v in held.values()], pa.binary())})

    rows = held.mapInArrow(slices, "slice int, id long").repartition(FILTER_SLICES, "slice").mapInArrow(build, "slice int, bits binary").collect()  # FILTER_BITS at most
    return spark.sparkContext.broadcast((bits, {r.slice: bytes(r.bits) for r in rows}))


def membership(held):
    """A function from ids (long) to whether the broadcast filter may hold each; unpacks the filter once."""
    bits, parts = held.value
    size = bits // FILTER_SLICES // 8
    flat = np.zeros(bits // 8, np.uint8)
    for k, v in parts.items():
        flat[k * size : (k + 1) * size] = np.frombuffer(zlib.decompress(v), np.uint8)

    def may_hold(ids: np.ndarray) -> np.ndarray:
        places = _places(ids, bits)
        return ((flat[places >> np.uint64(3)] >> (np.uint8(7) - (places & np.uint64(7)).astype(np.uint8))) & 1).all(axis=0)

    return may_hold


def maybe_in(df: DataFrame, column: str, held, wanted: bool = True) -> DataFrame:
    """The rows whose id the filter may hold, or with ``wanted`` false those whose id it surely doesn't; a null id may be held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may_hold = membership(held)
        for batch in batches:
            ids = batch.column(column).cast(pa.int64())
            hit = may_hold(ids.fill_null(0).to_numpy()) | ids.is_null().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit == wanted))

    return df.mapInArrow(run, df.schema)
