"""Exact top-k inner-product search: tiled matrix products of query tiles and row shards, partial selection in every
tile, and a tree that merges the per-query lists.

Rows whose vector is null, empty or holds a null or non-finite component take no part, neither as query nor as candidate;
nor do rows without an id. Every other row is a candidate and, if selected, a query of its own: rows that repeat an id
are each listed, and not with rows of the query's own id. Queries of one id share one list of the k best of all their
products with rows, so that a result has one row for each query_id and rank. Vectors of different lengths have no
product, so a query meets the candidates of its own length. Scores are exact; one beyond the range of a long becomes that
range's end. No rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ionloom.llm.common import bounded_batches, materialize

#: Rows of a shard, queries of a tile, bytes of either as 8-byte integers, and lists merged by one node of the tree.
SHARD_ROWS, TILE_QUERIES, BLOCK_BYTES, FAN_IN = 4096, 1024, 32 << 20, 16
#: The score of what takes no part; real ones are larger.
_NONE = -(2**63)


def quantise(vector: Column, scale: int = 256) -> Column:
    """Component x becomes floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def _select(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the columns of the k largest scores, ties to the smaller column."""
    k = min(k, scores.shape[1])
    if scores.shape[1] > 4 * k:  # everything that ties with the k-th score stays until the ordered choice
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        rows, cols = np.nonzero(scores >= least[:, None])
    else:
        rows, cols = np.divmod(np.arange(scores.size), scores.shape[1])
    order = np.lexsort((cols, scores[rows, cols]))[::-1]  # falling scores; not their negatives, as the least long has none
    order = order[np.lexsort((cols[order], np.cumsum(np.concatenate([[False], scores[rows, cols][order][1:] != scores[rows, cols][order][:-1]])), rows[order]))]
    rows, cols = rows[order], cols[order]
    first = np.searchsorted(rows, np.arange(scores.shape[0]))
    near = np.arange(rows.size) - first[rows] < k
    return rows[near], cols[near]


def _product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products; by BLAS where doubles hold every partial sum exactly, by unbounded integers where longs don't."""
    most = lambda a: max(int(a.max(initial=0)), -int(a.min(initial=0)))
    bound = most(left) * most(right) * left.shape[1]
    if bound < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if bound < 2**63:
        return left.astype(np.int64) @ right.astype(np.int64).T
    exact = left.astype(object) @ right.astype(object).T
    return np.minimum(np.maximum(exact, _NONE + 1), 2**63 - 1).astype(np.int64)


def _pack(rows: pa.Table) -> pa.Table:
    """The rows of one block as one row: ids in order, and the vectors in the smallest integers that hold them."""
    ids = rows["vec_id"].to_numpy()
    flat = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= flat.min() and flat.max() <= np.iinfo(k).max)
    return pa.table({"dim": rows["dim"][:1], "block": rows["block"][:1], "ids": [ids[order].astype("<i8").tobytes()], "vectors": [flat[order].astype(kind).tobytes()], "kind": [kind]})


def _tiles(k: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                (q_id, q_vec), (r_id, r_vec) = ((np.frombuffer(row[s + "ids"], "<i8"), np.frombuffer(row[s + "vectors"], row[s + "kind"]).reshape(-1, row["dim"])) for s in ("q_", ""))
                out = {"query_id": [], "vec_id": [], "score": []}
                for at in range(0, len(q_id), 256):
                    ids = q_id[at : at + 256]
                    scores = _product(q_vec[at : at + 256], r_vec)
                    scores[ids[:, None] == r_id[None, :]] = _NONE
                    i, j = _select(scores, k)
                    keep = scores[i, j] > _NONE
                    i, j = i[keep], j[keep]
                    for name, values in (("query_id", ids[i]), ("vec_id", r_id[j]), ("score", scores[i, j])):
                        out[name].append(values)
                n = sum(len(x) for x in out["score"])
                lists = {"tile": pa.array(np.full(n, row["tile"]), pa.int64()), "list_id": pa.array(np.full(n, row["shard"]), pa.int64())}
                yield pa.record_batch({c: pa.array(np.concatenate(v), pa.int64()) for c, v in out.items()} | lists)

    return run


def top_k(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """The ``k`` rows of largest integer inner product for each row that ``is_query`` (a predicate on ``vec_id``) selects.

    Returns query_id, rank (from 1), vec_id, score. Every query meets every row but its own once: queries are packed into
    tiles, rows into shards, both of bounded size, and a (tile, shard) pair is one matrix product. A pair keeps at most k
    rows for each query; the lists of a tile's queries merge in a tree of bounded fan-in, so no task holds all lists of
    a query. Rows are dealt by a number of their own, so an id that many rows share is spread like any other.
    """
    bounded_batches(df.sparkSession)
    vector = F.col(vector_col)
    valid = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("raw")).where(
        F.col("vec_id").isNotNull() & (F.size("raw") > 0) & ~F.exists("raw", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    )
    rows = valid.select("vec_id", quantise(F.col("raw"), scale).alias("vector"), F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows.withColumn("dim", F.size("vector")), "topk-rows")
    n, n_queries, dim = rows.select(F.count("*"), F.count_if(is_query), F.coalesce(F.max("dim"), F.lit(1))).first()
    most = max(1, BLOCK_BYTES // (8 * dim))
    shards, tiles = max(1, math.ceil(n / min(SHARD_ROWS, most))), max(1, math.ceil(n_queries / min(TILE_QUERIES, most)))
    packed = lambda part, count: part.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(count))).groupBy("dim", "block").applyInArrow(_pack, "dim int, block long, ids binary, vectors binary, kind string")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<long>"))
    held = materialize(packed(rows, shards), "topk-shards").select("dim", F.col("block").alias("shard"), "ids", "vectors", "kind", every(tiles).alias("tile"))
    asked = materialize(packed(rows.where(is_query), tiles), "topk-tiles")
    asked = asked.select(F.col("dim").alias("q_dim"), F.col("block").alias("q_tile"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.col("kind").alias("q_kind"), every(shards).alias("q_shard"))
    pairs = held.join(asked, (held["dim"] == asked["q_dim"]) & (held["shard"] == asked["q_shard"]) & (held["tile"] == asked["q_tile"]))
    lists = pairs.select("dim", "shard", "tile", "ids", "vectors", "kind", "q_ids", "q_vectors", "q_kind").mapInArrow(_tiles(k), "query_id long, vec_id long, score long, tile long, list_id long")
    lists = materialize(lists, "topk-lists")
    least = F.sort_array(F.collect_list(F.struct("score", (-F.col("vec_id")).alias("down"))), asc=False)
    while shards > 1:  # each level merges FAN_IN lists of at most k rows for each query row of the tile
        shards = math.ceil(shards / FAN_IN)
        merged = lists.groupBy("query_id", "tile", F.floor(F.col("list_id") / FAN_IN).alias("list_id")).agg(F.slice(least, 1, k).alias("best"))
        lists = merged.select("query_id", "tile", "list_id", F.inline("best")).select("query_id", (-F.col("down")).alias("vec_id"), "score", "tile", "list_id")
    # a query_id has several tiles only if rows repeat it; Spark limits the groups before it shuffles them
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
