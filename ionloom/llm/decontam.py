"""Benchmark decontamination by SimHash, DataFrame and SQL functions only.

Texts are lower-cased and split into words, runs of letters and digits; a shingle is the hash of ``SHINGLE`` words, and a
shorter text is one shingle. Item-sized windows of a document get a 64-bit SimHash. Of all windows, those are left out
that can't be the answer: a window of n shingles needs a certain number of shingles that items of size n hold, and one
that begins with a shingle that none of them holds is no better than the next one. So windows begin at such a shingle or
end the text (a text shorter than the item is one window), and hold enough of them; nothing else is asked of their order
or place. The fingerprints meet those of the items of the same size in BLOCKS blocks of bits: two fingerprints within
RADIUS bits differ in at most BLOCK_RADIUS bits of at least one block, so the items are filed under every value that near,
and no fingerprint within RADIUS is missed. Of the pairs found, those stay whose exact weighted shingle similarity (shared
shingles over all, each as often as it occurs) reaches ``percent``. RADIUS is no proof for similar texts: at a similarity
of just 0.8 fingerprints differ in 10 bits on average, with a standard deviation of 3; the tests measure the recall there.

The texts are read twice: once for the places of items' shingles, of which only numbers move, and once for the windows of
the texts that have some. In between a text is known by its doc_id and a 128-bit hash.

A null or empty text has no words and matches nothing, in documents and items alike. Repeated items each match; rows that
repeat a doc_id add to that id's matches. Ties can't occur, since every match is a row. No rows give no rows. Extra
columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionloom.llm.common import materialize

#: Words of a shingle; blocks of a 64-bit fingerprint; bits in which a block may differ, and so all 64.
SHINGLE, BLOCKS, BLOCK_RADIUS = 5, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Rows of an item table up to which it is broadcast (some 40 MB); larger ones are joined by shuffles.
BROADCAST_ROWS = 1_000_000
#: What the second half of a text's hash starts with.
SALT = "the other half"

_WORDS = r"split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ')), ' ')"
_GRAMS = f"""CASE WHEN size(words) >= {SHINGLE}
  THEN transform(sequence(0, size(words) - {SHINGLE}), i -> xxhash64({", ".join(f"get(words, i + {k})" for k in range(SHINGLE))}))
  ELSE array(xxhash64(words)) END"""
# Bit b of a SimHash is the majority of bit b over the shingles, each as often as it occurs.
_SIMHASH = """aggregate(sequence(0, 63), 0L, (f, b) -> f | IF(
  2 * aggregate(grams, 0, (s, h) -> s + CAST(shiftrightunsigned(h, b) & 1 AS INT)) > size(grams), shiftleft(1L, b), 0L))"""
_BLOCKS = f"transform(sequence(0, {BLOCKS - 1}), j -> CAST(shiftrightunsigned(print, j * {64 // BLOCKS}) & {(1 << 64 // BLOCKS) - 1} AS INT))"
# The starts of windows of n shingles that begin at one of the sorted places ``at`` or at ``last`` and hold ``need`` of them.
_STARTS = """concat(filter(at, (x, i) -> x < last AND get(at, i + need - 1) < x + n),
  IF(size(at) >= need AND get(at, size(at) - need) >= last, array(last), CAST(array() AS ARRAY<INT>)))"""
_SHARED = """CASE WHEN size(array_distinct(grams)) = size(grams) AND size(array_distinct(item_grams)) = size(item_grams)
  THEN size(array_intersect(grams, item_grams))
  ELSE aggregate(array_distinct(grams), 0, (s, x) -> s + least(size(filter(grams, y -> y = x)), size(filter(item_grams, y -> y = x)))) END"""


def _near_values() -> list[int]:
    """The bit patterns by which two values of a block within BLOCK_RADIUS differ."""
    bits = [1 << b for b in range(64 // BLOCKS)]
    return [sum(c) for k in range(BLOCK_RADIUS + 1) for c in combinations(bits, k)]


def with_grams(texts: DataFrame, *columns: str) -> DataFrame:
    """The columns, and the shingles (grams) of every text that has words, in order."""
    words = texts.select(*columns, F.expr(_WORDS).alias("words"))
    return words.select(*columns, F.expr(_GRAMS).alias("grams"), (F.expr("words[0]") != "").alias("filled")).where("filled").drop("filled")


def matches(df: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, item_id and similarity (the largest over the document's windows) of every pair that reaches ``percent``."""
    # written tables between the steps keep each step's expressions out of the filters and join conditions of the one before
    listed = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    items = materialize(with_grams(listed, "item_id"), "decontam-items").withColumn("n", F.size("grams"))
    n_items, n_shingles = items.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    sent = lambda side, rows: F.broadcast(side) if rows <= BROADCAST_ROWS else side

    anchors = items.select("n", F.explode_outer("grams").alias("anchor")).distinct()
    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    texts = texts.select("*", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(SALT), "text").alias("k2"))
    placed = with_grams(texts, "doc_id", "k1", "k2").select("doc_id", "k1", "k2", F.size("grams").alias("size"), F.posexplode_outer("grams").alias("pos", "h"))
    hits = placed.join(sent(anchors, n_shingles), placed["h"] == anchors["anchor"])
    # rows that repeat an id and its text add nothing, so a set, which is formed before the shuffle, holds all there is to know
    places = hits.groupBy("doc_id", "k1", "k2", "n", "size").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    last, need = F.greatest(F.lit(0), F.col("size") - F.col("n")), F.expr(f"CAST(({percent} * (least(size, n) + n) + {99 + percent}) div {100 + percent} AS INT)")
    places = materialize(places.select("doc_id", "k1", "k2", "n", "at", last.alias("last"), F.greatest(need, F.lit(1)).alias("need")), "decontam-places")
    starts = places.select("doc_id", "k1", "k2", "n", F.expr(_STARTS).alias("starts")).where(F.size("starts") > 0)
    starts = starts.groupBy(F.col("doc_id").alias("d_"), F.col("k1").alias("k1_"), F.col("k2").alias("k2_")).agg(F.collect_list(F.struct("n", "starts")).alias("wanted"))
    starts = materialize(starts, "decontam-starts")

    n_texts, n_starts = starts.agg(F.count("*"), F.coalesce(F.sum(F.aggregate("wanted", F.lit(0), lambda n, w: n + F.size(w["starts"]))), F.lit(0))).first()
    holders = texts.join(sent(starts, n_texts + n_starts), (texts["k1"] == starts["k1_"]) & (texts["k2"] == starts["k2_"]) & texts["doc_id"].eqNullSafe(starts["d_"]))
    windows = with_grams(holders, "doc_id", "wanted").select("doc_id", "grams", F.inline_outer("wanted")).select("doc_id", "grams", "n", F.explode_outer("starts").alias("start"))
    windows = materialize(windows.select("doc_id", "n", F.slice("grams", F.col("start") + 1, F.col("n")).alias("grams")).distinct(), "decontam-windows")
    windows = materialize(windows.withColumn("print", F.expr(_SIMHASH)), "decontam-prints")

    prints = materialize(items.withColumn("print", F.expr(_SIMHASH)), "decontam-items")
    nearby = _near_values()
    filed = prints.select("item_id", F.col("n").alias("item_n"), F.col("print").alias("item_print"), F.posexplode(F.expr(_BLOCKS)).alias("item_block", "v"))
    filed = filed.withColumn("differ", F.explode(F.array(*(F.lit(m) for m in nearby)))).withColumn("item_value", F.col("differ").bitwiseXOR(F.col("v"))).drop("differ", "v")
    looked_up = windows.select("doc_id", "n", "grams", "print", F.posexplode(F.expr(_BLOCKS)).alias("block", "value"))
    same_block = (F.col("n") == F.col("item_n")) & (F.col("block") == F.col("item_block")) & (F.col("value") == F.col("item_value"))
    met = looked_up.join(sent(filed, n_items * BLOCKS * len(nearby)), same_block)
    near = met.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS).select("doc_id", "item_id", "item_print", "grams").distinct()
    full = prints.select(F.col("item_id").alias("i_"), F.col("print").alias("p_"), F.col("grams").alias("item_grams"))
    near = near.join(sent(full, n_shingles), (near["item_print"] == full["p_"]) & near["item_id"].eqNullSafe(full["i_"]))

    shared = near.select("doc_id", "item_id", F.expr(_SHARED).alias("shared"), (F.size("grams") + F.size("item_grams")).alias("sizes"))
    alike = shared.where(100 * F.col("shared") >= percent * (F.col("sizes") - F.col("shared")))
    return alike.groupBy("doc_id", "item_id").agg(F.max(F.col("shared") / (F.col("sizes") - F.col("shared"))).alias("similarity"))
