"""Spelling variants: words one edit apart, by a symmetric-delete join, and the frequent form that each one stands for.

Words are maximal runs of ``LETTERS`` with A-Z lower-cased. So that spelling mistakes occur in every table, a run of a
document may lose a code point: of the crc32 h of ``<doc_id>:<run>`` in UTF-8, if ``EVERY`` divides it, the one at h
modulo the run's length. What has at least ``least_chars`` code points and occurs at least ``least_n`` times is a word.

Every word emits itself and its different single deletions as 64-bit keys, all found from running sums of a polynomial
hash, so that a word of n code points costs n + 1 numbers however long it is. Words meet in an equi-join on the keys.
Words one insertion, deletion or replacement apart share exactly one key; others that share one (as with two letters
exchanged) fail the exact distance. A key of n code points is shared by at most 1 + (n + 1) * alphabet words, with 90
letters here, so no key grows with the corpus. Words of up to ``SHORT`` code points take their text along, pairs with a
longer one fetch it by two more joins.

A word's form is its near word of largest n (ties: the smallest in code-point order) if that is at least ``times`` its
own n. A form has ``times`` the count, so chains are as long as the logarithm of the largest count, and roots follow from
joins of the pointers with themselves, each of which doubles the way.

A null text has no words; a null doc_id counts as an empty string before the colon. Repeated rows count each. No rows
give no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionloom.llm.common import bounded_batches, materialize, mix, powers

#: The letters of words; a run in every so many loses a code point; words whose text travels with their keys; different
#: words that a task counts before it sends them on, and code points whose keys it finds at once.
LETTERS, EVERY, SHORT, HELD_WORDS, KEY_CHARS = "A-Za-zÀ-ÿ", 31, 64, 200_000, 1 << 18


def _runs(least_chars: int):
    """(word, n) of all texts, added up in every task; runs too short to become a word are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held = re.compile(f"[{LETTERS}]{{{least_chars},}}").findall, Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                own = Counter(find((text.as_py() or "").encode().lower().decode()))  # of bytes: A-Z only
                begin = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), begin)
                    if h % EVERY == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_chars:
                            continue
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield pa.record_batch({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
                    held.clear()
        if held:
            yield pa.record_batch({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

    return run


def words(df: DataFrame, least_chars: int = 7, least_n: int = 2) -> DataFrame:
    """(word, n): the words of all texts with their counts."""
    bounded_batches(df.sparkSession)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = docs.mapInArrow(_runs(least_chars), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_n)


def deletion_keys(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word in ``found``, key): every word's own key and those of its different single deletions."""
    size = np.array([len(w) for w in found], np.int64)
    chars = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32)
    power, back = powers(len(chars) + 2)
    sums = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(mix(chars.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * power[: len(chars)], out=sums[1:])
    stop, word = np.cumsum(size), np.repeat(np.arange(len(size)), size)
    start = stop - size
    own = mix((sums[stop] - sums[start]) * back[start] + size.astype(np.uint64))
    at = np.flatnonzero(np.concatenate([[True], (chars[1:] != chars[:-1]) | (word[1:] != word[:-1])])) if len(chars) else np.zeros(0, np.int64)
    of = word[at]  # of equal neighbours only the first is deleted
    rest = (sums[at] - sums[start[of]]) * back[start[of]] + (sums[stop[of]] - sums[at + 1]) * back[start[of] + 1]
    return np.concatenate([np.arange(len(size)), of]), np.concatenate([own, mix(rest + (size[of] - 1).astype(np.uint64))])


def _keys(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, start, held = batch.column("word").to_pylist(), 0, 0
            for i, word in enumerate(found):
                held += len(word)
                if held >= KEY_CHARS or i + 1 == len(found):
                    place, key = deletion_keys(found[start : i + 1])
                    part = batch.slice(start, i + 1 - start)
                    for at in range(0, len(key), KEY_CHARS):
                        take = pa.array(place[at : at + KEY_CHARS])
                        yield pa.record_batch({"key": key[at : at + KEY_CHARS].view(np.int64)} | {c: part.column(c).take(take) for c in columns})
                    start, held = i + 1, 0

    return run


def _sharing(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs of different words that share a key, as columns a_* and b_*."""
    kinds = dict(rows.dtypes)
    keys = rows.select("word", *(c for c in columns if c != "word")).mapInArrow(_keys(columns), "key long, " + ", ".join(f"{c} {kinds[c]}" for c in columns))
    left = keys.select("key", *(F.col(c).alias(f"a_{c}") for c in columns))
    right = keys.select("key", *(F.col(c).alias(f"b_{c}") for c in columns))
    return left.join(right, "key").where(F.col(f"a_{columns[0]}") < F.col(f"b_{columns[0]}"))


def near_words(counted: DataFrame, short: int = SHORT) -> DataFrame:
    """(a, a_n, b, b_n): the pairs of words of ``counted`` (word, n) that are one edit apart, each once."""
    one = F.levenshtein("a_word", "b_word", 1) == 1
    size = F.length("word")
    brief = _sharing(counted.where(size <= short), ["word", "n"]).where(one).select(F.col("a_word").alias("a"), "a_n", F.col("b_word").alias("b"), "b_n")
    long = materialize(counted.where(size >= short).withColumn("id", F.monotonically_increasing_id()), "spelling-long")
    met = _sharing(long.select("id", "word"), ["id"]).select("a_id", "b_id").distinct()
    for side in "ab":
        met = met.join(long.select(F.col("id").alias(f"{side}_id"), F.col("word").alias(f"{side}_word"), F.col("n").alias(f"{side}_n")), f"{side}_id")
    beyond = (F.length("a_word") > short) | (F.length("b_word") > short)
    return brief.unionByName(met.where(beyond & one).select(F.col("a_word").alias("a"), "a_n", F.col("b_word").alias("b"), "b_n"))


def roots(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(word, root) for every row of ``forms`` (word, form): where the forms lead; a form that is no word of the table is
    an end, and there are no circles."""
    led = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(max_rounds):
        step = led.select(F.col("word").alias("from"), F.col("root").alias("to"))
        further = led.join(step, led["root"] == step["from"], "left").select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved"))
        further = materialize(further, "spelling-roots")
        led = further.select("word", "root")
        if further.where("moved").isEmpty():
            return led
    raise RuntimeError("the forms did not end")


def variants(df: DataFrame, least_chars: int = 7, least_n: int = 2, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the texts."""
    counted = materialize(words(df, least_chars, least_n), "spelling-words")
    near = materialize(near_words(counted), "spelling-near")
    both = near.union(near.select("b", "b_n", "a", "a_n")).toDF("near_of", "own_n", "other", "other_n")
    better = F.when(F.col("other_n") >= times * F.col("own_n"), F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("word")))
    by_word = materialize(both.groupBy("near_of").agg(F.count("*").alias("n_near"), F.min(better).alias("best")), "spelling-forms")
    ends = roots(by_word.where("best IS NOT NULL").select(F.col("near_of").alias("word"), F.col("best.word").alias("form"))).withColumnRenamed("word", "led")
    out = counted.join(by_word, F.col("word") == F.col("near_of"), "left").join(ends, F.col("word") == F.col("led"), "left")
    return out.select("word", F.col("best.word").alias("form"), F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), (-F.col("best.rank")).alias("form_n"))
