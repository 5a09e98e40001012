"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. An n-gram is the elementwise product (binding) of its letters'
vectors, each rotated by its distance from the n-gram's end (permutation). A text is the sum (bundling) of its n-grams'
vectors, a language the sum of its labelled texts, and a text belongs to the language of largest cosine. Bundles hold
integers, so prototypes are the same however Spark groups the partial sums.

Texts are lower-cased; runs of anything but letters become one space, and a space frames the text. A null text or one
without a letter gets ``und`` and score 0. Ties go to the label first in order. Labels that are null teach nothing;
without a single labelled text every text is ``und``. Very many different letters cost time, not memory. Rows are judged one by one, repeated ones alike; no rows give no
rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionloom.llm.common import bounded_batches, chunks

#: Length of the vectors, letters in an n-gram, and the seed of the letters' vectors.
DIM, GRAM, SEED = 1024, 3, 20250
UNKNOWN = "und"
#: n-gram codes, or texts times n-grams, up to which a chunk's n-grams are counted in a table instead of by a sort.
_TABLE = 1 << 23
#: n-grams whose vectors, and texts whose counts of them, are held at once (16 MB and 4 MB); texts of one chunk.
_GRAMS, _ROWS, _TEXTS = 4096, 256, 2048


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(maxsize=65536)
def _letter_vector(code: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, DIM, dtype=np.int8) * np.int8(2) - np.int8(1)


def gram_vector(codes: tuple[int, ...]) -> np.ndarray:
    """The bound vector of one n-gram, given by its code points."""
    return gram_vectors(np.array([codes]))[0]


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """The bound vectors of n-grams, a row of code points each."""
    used, place = np.unique(codes, return_inverse=True)
    letters = np.array([_letter_vector(c) for c in used.tolist()])
    place, out = place.reshape(codes.shape), np.ones((len(codes), DIM), np.int8)
    for k in range(codes.shape[1]):  # rotated by the distance from the end
        out *= np.roll(letters, codes.shape[1] - 1 - k, axis=1)[place[:, k]]
    return out


def counts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, n-gram and count of every pair that occurs, by document; the n-grams' code points). Texts without a
    letter have no n-grams."""
    raws = [(t or b"").decode("utf-8", "replace").lower().encode("utf-32-le", "replace") for t in texts]
    sizes = [len(r) // 4 + 2 for r in raws]
    pad = b" \0\0\0"
    code = np.frombuffer(b"".join(pad + r + pad for r in raws), np.uint32)
    doc = np.repeat(np.arange(len(texts)), sizes)
    letter = _letters()[code]
    has = np.zeros(len(texts), bool)
    has[doc[letter]] = True
    keep = letter | np.concatenate([[True], letter[:-1] | (doc[1:] != doc[:-1])])
    code, doc = np.where(letter, code, 32)[keep], doc[keep]
    alphabet, small = np.unique(code, return_inverse=True)
    n, size = len(code) - GRAM + 1, len(alphabet)
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, np.zeros((0, GRAM), np.uint32)
    gram = np.zeros(n, np.int64)
    for k in range(GRAM):
        gram = gram * size + small[k : k + n]
    inside = (doc[:n] == doc[GRAM - 1 :]) & has[doc[:n]]
    gram, doc = gram[inside], doc[:n][inside]
    if size**GRAM <= _TABLE:
        present = np.flatnonzero(np.bincount(gram, minlength=size**GRAM))
        number = np.zeros(size**GRAM, np.int64)
        number[present] = np.arange(len(present))
        gram = number[gram]
    else:
        present, gram = np.unique(gram, return_inverse=True)
    if not len(present):
        return none, none, none, np.zeros((0, GRAM), np.uint32)
    if len(texts) * len(present) <= _TABLE:
        held = np.bincount(doc * len(present) + gram, minlength=len(texts) * len(present))
        pair = np.flatnonzero(held)
        found = held[pair]
    else:
        pair, found = np.unique(doc * len(present) + gram, return_counts=True)
    codes = np.stack([alphabet[present // size**k % size] for k in range(GRAM - 1, -1, -1)], axis=1)
    return pair // len(present), pair % len(present), found, codes


def bundles(texts: list[bytes | None]) -> np.ndarray:
    """One integer vector for each text, zero where the text has no letter.

    The n-grams are taken a few thousand at a time and the texts a few hundred, so what is held at once is bounded
    whatever the letters: a block of counts, a block of vectors and the bundles themselves.
    """
    doc, gram, found, codes = counts(texts)
    out = np.zeros((len(texts), DIM), np.float64)
    by = np.argsort(gram, kind="stable")
    doc, gram, found = doc[by], gram[by], found[by]
    edges = np.searchsorted(gram, np.arange(0, len(codes) + _GRAMS, _GRAMS))
    for k, at in enumerate(range(0, len(codes), _GRAMS)):
        vectors = gram_vectors(codes[at : at + _GRAMS]).astype(np.float32)
        own = slice(edges[k], edges[k + 1])
        rows, place = np.unique(doc[own], return_inverse=True)
        for begin in range(0, len(rows), _ROWS):
            part = (place >= begin) & (place < begin + _ROWS)
            block = np.zeros((min(_ROWS, len(rows) - begin), len(vectors)), np.float32)
            block[place[part] - begin, gram[own][part] - at] = found[own][part]
            out[rows[begin : begin + _ROWS]] += block @ vectors  # sums below 2**24 are exact in single precision
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        labels = batch.column("lang")
        for start, stop, texts in chunks(batch, "text", rows=_TEXTS):
            vectors = bundles(texts)
            own = np.array(labels.slice(start, stop - start).to_pylist())
            for label in np.unique(own).tolist():
                total[label] = total.get(label, 0) + vectors[own == label].sum(axis=0)
    rows = [(label, i, int(v)) for label, vector in total.items() for i, v in enumerate(vector.tolist())]
    yield pa.record_batch({"lang": pa.array([r[0] for r in rows], pa.string()), "i": pa.array([r[1] for r in rows], pa.int32()), "v": pa.array([r[2] for r in rows], pa.int64())})


def train(df: DataFrame, max_langs: int = 1000) -> dict[str, list[int]]:
    """Prototype by label, learnt from all rows of ``df`` with a label. Partial sums leave the tasks, DIM numbers for each
    label; the driver gets the prototypes alone, of at most ``max_langs`` labels (more are an error)."""
    bounded_batches(df.sparkSession)
    labelled = df.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    summed = labelled.mapInArrow(_sums, "lang string, i int, v long").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    rows = summed.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("v")).orderBy("lang").take(max_langs + 1)
    if len(rows) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    return {r.lang: list(r.v) for r in rows if any(r.v)}


def _predict(model, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(model.value)
        units = np.array([model.value[x] for x in names], np.float64).reshape(len(names), DIM)
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        for batch in batches:
            for start, stop, texts in chunks(batch, "text", rows=_TEXTS):
                vectors = bundles(texts)
                length = np.linalg.norm(vectors, axis=1)
                known = (length > 0) & bool(names)
                best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
                if names:
                    cosine = vectors @ units.T / np.where(length > 0, length, 1)[:, None]
                    best, score = cosine.argmax(axis=1), np.clip(cosine.max(axis=1), 0, 1)
                labels = [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                yield pa.record_batch({key: batch.column(key).slice(start, stop - start), "lang_pred": pa.array(labels, pa.string()), "score": pa.array(np.where(known, score, 0.0), pa.float64())})

    return run


def identify(df: DataFrame, model: dict[str, list[int]]) -> DataFrame:
    """doc_id, lang_pred and score (the cosine with the language's prototype, at least 0) for every whole text."""
    bounded_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_predict(sent, "doc_id"), "doc_id long, lang_pred string, score double")


def _known_rows(model, letters: int, least: float):
    judge = _predict(model, "row_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            numbered = pa.record_batch({"row_": pa.array(range(batch.num_rows), pa.int64()), "text": texts})
            judged = pa.Table.from_batches(judge(iter([numbered]))) if batch.num_rows else None
            if judged is None:
                continue
            known = [
                label != UNKNOWN and (score >= least or _n_letters(text, letters) < letters)
                for label, score, text in zip(judged["lang_pred"].to_pylist(), judged["score"].to_pylist(), texts, strict=True)
            ]
            yield batch.filter(pa.array(known, pa.bool_()))

    return run


def _n_letters(text: pa.Scalar, enough: int) -> int:
    """Letters of a text, counted up to ``enough``."""
    found = 0
    for c in text.as_py() or "":
        found += c.isalpha()
        if found >= enough:
            break
    return found


def keep_known(df: DataFrame, model: dict[str, list[int]], letters: int = 200, least: float = 0.2) -> DataFrame:
    """The rows of ``df``, all columns, without those whose text has no letter and those of at least ``letters`` letters
    whose score is below ``least``. A short text's score says little, so short ones stay; without a prototype all are ``und``
    and go."""
    bounded_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)
    return df.mapInArrow(_known_rows(sent, letters, least), df.schema)


def held_out(doc_id: Column) -> Column:
    """Documents that no prototype learns from: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
