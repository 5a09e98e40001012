"""N-gram Jaccard join of whole documents by prefix trees, as components of linked documents.

A document's set holds the 64-bit hashes of its distinct n-word shingles (words are runs of anything but ASCII white
space, A-Z lower-cased; a shorter text is one shingle). Two documents link when 100 * |intersection| >= percent * |union|.

1. One global order of shingles: rare before frequent, by their counts over all documents, then by hash. Tasks send the
   different shingles of a chunk of documents to the slices that count them, one entry for each of few documents or one
   for many; an answer comes back for those that other documents hold as well. Shingles of one document alone come
   first in the order, and no answer is needed for them. Slices grow in number with the input.
2. Linked sets share a shingle among the first |x| - ceil(percent * |x| / 100) + 1 of each, and their sizes are within
   percent of each other. Documents that chain together by such shingles and sizes, first within a task and then, one row
   for each task and shingle, across tasks, form a family; no link leaves a family. Most documents are a family alone.
3. The sets of the other families go, each once, into blocks of bounded size. A block stores its sets in a prefix tree,
   frequent shingles first, and probes it with each set: the overlap with a path is counted once for all sets below it,
   a subtree ends where even its longest remainder can't reach the needed overlap, and so does one whose sets are all
   linked with the probe already. Only components matter, so this skips no link between different components.
4. Families of several blocks: one set for each component of a block meets in further rounds of blocks; then all sets
   outside of a family's main component are probed against every block of it, which makes the result exact.

A null text, or one without words, has an empty set, links with nothing, and its component_id is its own doc_id. Repeated
rows are each a row of the result; equal sets are one node. A null doc_id is never the smallest id unless a component has
no other. No rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionloom.llm.common import bounded_batches, chunks, id_filter, materialize, maybe_in, mix, word_hashes
from ionloom.llm.graph import components

#: Slices in which shingles are counted at least, bytes of text for each, and documents of a chunk up to which a shingle
#: is sent for each of them. A chunk (LOCAL_BYTES) sends a row to each slice, so beyond some terabytes both should grow
#: with the executors' memory: a task holds some 12 bytes for each byte of either.
SLICES, SLICE_BYTES, SENT_EACH = 64, 16 << 20, 8
#: Sets and shingles of a block, about; bytes of text of which a task forms its own families at once.
BLOCK_SETS, BLOCK_SHINGLES, LOCAL_BYTES = 128, 400_000, 8 << 20
#: Rounds in which the heads of blocks meet; what they leave apart is for the exact probes.
HEAD_ROUNDS = 3
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes | None], n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    flat, size = word_hashes(texts)
    out, at = [], 0
    if len(flat) >= n:
        rolled = np.zeros(len(flat) - n + 1, np.uint64)
        for k in range(n):
            rolled = rolled * _PRIME + flat[k : k + len(rolled)]
        rolled = mix(rolled)
    for length in size.tolist():
        if length >= n:
            out.append(np.unique(rolled[at : at + length - n + 1]))
        elif length:
            whole = np.array([length], np.uint64)
            for h in flat[at : at + length]:
                whole = whole * _PRIME + h
            out.append(mix(whole ^ np.uint64(0x5DEECE66D)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += length
    return out


def _token(h: np.ndarray, slices: int) -> np.ndarray:
    """What stands for a shingle in the order: its slice and 32 more bits."""
    return ((h >> np.uint64(40)) % np.uint64(slices) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


def _digest(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


#: Rows between the steps of the count: tokens of one chunk and slice with the document of the chunk that holds each, and
#: the count or level of each; slice -1 is the chunk's own table of documents, with the tokens that many of them hold.
SENT = "chunk long, slice int, tokens binary, docs binary, counts binary, ids array<long>, nodes array<long>, sizes array<long>"
#: Documents of a chunk, so that two bytes number them, and what stands for many of them.
CHUNK_DOCS, CHUNK_ROWS, _MANY = 65_000, 8192, 65_535


def _packed(numbers: np.ndarray) -> bytes:
    """Document numbers, as the steps from one to the next."""
    return zlib.compress(np.diff(numbers.astype(np.uint16), prepend=np.uint16(0)).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.uint16), dtype=np.uint16)


def _row(chunk: int, slice_: int, tokens: np.ndarray, docs: np.ndarray, counts: np.ndarray, ids=None, nodes=None, sizes=None) -> pa.RecordBatch:
    long = pa.list_(pa.int64())
    return pa.record_batch({
        "chunk": pa.array([chunk], pa.int64()), "slice": pa.array([slice_], pa.int32()), "tokens": pa.array([tokens.tobytes()], pa.binary()), "docs": pa.array([_packed(docs)], pa.binary()),
        "counts": pa.array([counts.tobytes()], pa.binary()), "ids": pa.array([ids], long), "nodes": pa.array([nodes], long), "sizes": pa.array([sizes], long),
    })


def _chunk_rows(ids: list, sets: list[np.ndarray], nodes: list[int], chunk: int, slices: int) -> Iterator[pa.RecordBatch]:
    """What one chunk of documents sends to the slices, and its own table. Equal sets are sent once."""
    first = {k: i for i, k in reversed(list(enumerate(nodes)))}
    sent = [i for i, k in enumerate(nodes) if first[k] == i and len(sets[i])]
    token = _token(np.concatenate([sets[i] for i in sent]), slices) if sent else np.zeros(0, np.uint64)
    doc = np.repeat(np.array(sent, np.uint16), [len(sets[i]) for i in sent]) if sent else np.zeros(0, np.uint16)
    order = np.argsort(token, kind="stable")
    token, doc = token[order], doc[order]
    del order
    begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
    length = np.diff(begin, append=len(token))
    many = np.repeat(length > SENT_EACH, length)
    hot, held = begin[length > SENT_EACH], length[length > SENT_EACH].astype(np.uint32)
    yield _row(chunk, -1, token[hot], doc[many], held, ids, nodes, [len(x) for x in sets])
    token = np.concatenate([token[~many], token[hot]])
    doc = np.concatenate([doc[~many], np.full(len(hot), _MANY, np.uint16)])
    counts = np.concatenate([np.ones(len(token) - len(hot), np.uint32), held])
    order = np.lexsort((doc, token >> np.uint64(32)))
    token, doc, counts = token[order], doc[order], counts[order]
    edge = np.searchsorted(token >> np.uint64(32), np.arange(slices + 1))
    for k in np.flatnonzero(np.diff(edge)).tolist():
        own = slice(edge[k], edge[k + 1])
        yield _row(chunk, k, token[own].astype("<u4"), doc[own], counts[own] if doc[edge[k + 1] - 1] == _MANY else np.zeros(0, np.uint32))


def _send(n: int, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, nodes, held, chunk = [], [], [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, stop, texts in chunks(batch, "text", rows=CHUNK_ROWS):
                ids += batch.column("doc_id").slice(start, stop - start).to_pylist()
                new = shingle_sets(texts, n)
                sets += new
                nodes += [_digest(s) for s in new]
                held += sum(len(t or b"") for t in texts)
                if held >= LOCAL_BYTES or len(ids) > CHUNK_DOCS - CHUNK_ROWS:
                    yield from _chunk_rows(ids, sets, nodes, chunk, slices)
                    ids, sets, nodes, held, chunk = [], [], [], 0, chunk + 1
        if ids:
            yield from _chunk_rows(ids, sets, nodes, chunk, slices)

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts the tokens of one slice after the other; rows come sorted by slice. Tokens that occur once get no answer,
    the others their level, the logarithm of the count in eighths of a power of two."""
    now, held = None, []

    def reply() -> Iterator[pa.RecordBatch]:
        tokens = [np.frombuffer(r["tokens"], "<u4") for r in held]
        counts = [np.frombuffer(r["counts"], "<u4") if r["counts"] else np.ones(len(t), np.uint32) for r, t in zip(held, tokens, strict=True)]
        flat, count = np.concatenate(tokens), np.concatenate(counts).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        begin = np.flatnonzero(np.concatenate([[True], flat[order][1:] != flat[order][:-1]]))
        total = np.add.reduceat(count[order], begin)
        level = np.empty(len(flat), np.uint8)
        level[order] = np.repeat(np.where(total > 1, np.rint(8 * np.log2(total)), 0).astype(np.uint8), np.diff(begin, append=len(flat)))
        at = 0
        for r, t in zip(held, tokens, strict=True):
            own = level[at : at + len(t)]
            at += len(t)
            keep = own > 0
            if keep.any():
                yield _row(r["chunk"], r["slice"], t[keep], _unpacked(r["docs"])[keep], own[keep])

    for batch in batches:
        for r in batch.to_pylist():
            if r["slice"] != now:
                if held:
                    yield from reply()
                now, held = r["slice"], []
            held.append(r)
    if held:
        yield from reply()


def _prefixes(rows: list[dict], percent: int) -> tuple[list, list[tuple[int, int, np.ndarray]]]:
    """(ids, (node, size, tokens of the prefix) of each document) of one chunk: of the leading shingles in the global order
    that any linked set shares one of, those that other documents hold."""
    own = next(r for r in rows if r["slice"] == -1)
    tokens, docs, levels = [], [], []
    known_token, known_level = [], []
    for r in rows:
        if r["slice"] < 0:
            continue
        t = np.frombuffer(r["tokens"], "<u4").astype(np.uint64) | (np.uint64(r["slice"]) << np.uint64(32))
        d, v = _unpacked(r["docs"]), np.frombuffer(r["counts"], np.uint8)
        many = d == _MANY
        tokens.append(t[~many])
        docs.append(d[~many])
        levels.append(v[~many])
        known_token.append(t[many])
        known_level.append(v[many])
    hot = np.frombuffer(own["tokens"], np.uint64)
    if len(hot):
        names, values = np.concatenate(known_token), np.concatenate(known_level)
        by = np.argsort(names)
        held = np.frombuffer(own["counts"], np.uint32)
        tokens.append(np.repeat(hot, held))
        docs.append(_unpacked(own["docs"]))
        levels.append(np.repeat(values[by][np.searchsorted(names[by], hot)], held))
    sizes = np.array(own["sizes"], np.int64)
    empty = np.zeros(0, np.uint64)
    prefix = {}
    if tokens:
        t, d, v = np.concatenate(tokens), np.concatenate(docs).astype(np.int64), np.concatenate(levels)
        order = np.lexsort((t, v, d))
        t, d, v = t[order], d[order], v[order]
        begin = np.searchsorted(d, np.arange(len(sizes)))
        shared = np.bincount(d, minlength=len(sizes))
        need = -(-percent * sizes // 100)
        take = (sizes - need + 1) - (sizes - shared)  # the shingles of no other document come first
        for i in np.flatnonzero((take > 0) & (sizes > 0)).tolist():
            end = begin[i] + min(int(take[i]), int(shared[i]))
            while end < begin[i] + shared[i] and t[end] == t[end - 1]:  # shingles of one token have no order
                end += 1
            prefix[own["nodes"][i]] = t[begin[i] : end]
    return own["ids"], [(k, int(n), prefix.get(k, empty)) for k, n in zip(own["nodes"], sizes.tolist(), strict=True)]


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _families(ids: list, sets: list[tuple[int, int, np.ndarray]], percent: int, base: int) -> pa.RecordBatch:
    """One row for each document: its node, its size, the number of its family in this task (from ``base`` on), and on one
    row of the family the tokens of the shingles with the range of sizes by which the family may chain to others."""
    size = np.array([n for _, n, _ in sets], np.int64)
    filled = [i for i, (_, n, _) in enumerate(sets) if n]
    parent = list(range(len(sets)))
    w = np.concatenate([sets[i][2] for i in filled]) if filled else np.zeros(0, np.uint64)
    doc = np.repeat(np.array(filled, np.int64), [len(sets[i][2]) for i in filled]) if filled else np.zeros(0, np.int64)
    order = np.lexsort((size[doc], w))
    w, doc = w[order], doc[order]
    length = size[doc]
    chained = (w[1:] == w[:-1]) & (percent * length[1:] <= 100 * length[:-1])
    pairs = np.unique(doc[:-1][chained] * len(sets) + doc[1:][chained])
    for i, j in zip(*(x.tolist() for x in np.divmod(pairs, max(1, len(sets)))), strict=True):
        a, b = _find(parent, i), _find(parent, j)
        parent[max(a, b)] = min(a, b)
    root = [_find(parent, i) for i in range(len(sets))]
    first = np.flatnonzero(np.concatenate([[True], ~chained])) if len(w) else np.zeros(0, np.int64)
    last = np.concatenate([first[1:], [len(w)]])[: len(first)] - 1
    of = np.array(root, np.int64)[doc[first]] if len(w) else np.zeros(0, np.int64)
    by = np.argsort(of, kind="stable")
    begin, end = np.searchsorted(of[by], np.arange(len(sets))), np.searchsorted(of[by], np.arange(len(sets)), side="right")
    take = lambda values: pa.array([values[by[a:b]] if b > a else None for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.list_(pa.int64()))
    return pa.record_batch({
        "doc_id": pa.array(ids, pa.int64()), "node": pa.array([k for k, _, _ in sets], pa.int64()), "n": pa.array(size), "root": pa.array([base + r for r in root], pa.int64()),
        "w": take(w.astype(np.int64)[first]), "range": take((length[first] << 32) + length[last]),
    })


def _index(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held = TaskContext.get().partitionId() << 32, []

        def index() -> Iterator[pa.RecordBatch]:
            nonlocal base
            ids, sets = _prefixes(held, percent)
            yield _families(ids, sets, percent, base)
            base += len(ids)

        for batch in batches:
            for r in batch.to_pylist():
                if held and r["chunk"] != held[0]["chunk"]:
                    yield from index()
                    held = []
                held.append(r)
        if held:
            yield from index()

    return run


def _chains(percent: int):
    """Edges between families whose rows of one shingle chain by size; rows come sorted by shingle and smallest size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, root, most = None, 0, 0
        for batch in batches:
            w, r, sizes = (batch.column(c).to_numpy() for c in ("w", "root", "range"))
            lo, hi = sizes >> 32, sizes & 0xFFFFFFFF
            alone = np.ones(len(w), bool)  # a shingle of one row only chains nothing
            if len(w) > 1:
                same = w[1:] == w[:-1]
                alone[1:] &= ~same
                alone[:-1] &= ~same
            alone[:1] = alone[-1:] = False
            out: list[tuple[int, int]] = []
            keep = ~alone
            for key, node, low, high in zip(w[keep].tolist(), r[keep].tolist(), lo[keep].tolist(), hi[keep].tolist(), strict=True):
                if key == now and percent * low <= 100 * most:
                    if node != root:
                        out.append((root, node))
                    most = max(most, high)
                else:
                    now, root, most = key, node, high
            pairs = np.unique(np.array(out, np.int64).reshape(-1, 2), axis=0)
            yield pa.record_batch({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return run


class Trie:
    """A path-compressed prefix tree over sets of small integers whose order is frequent first.

    A node is (begin, end, first, last, shortest, longest, children): the tokens [begin, end) of set ``first`` continue
    the path, sets first..last lie below, with these lengths.
    """

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets = sets
        self.length = [len(s) for s in sets]
        self.root = self._node(0, len(sets), 0)

    def _node(self, first: int, stop: int, depth: int) -> tuple:
        a, b = self.sets[first], self.sets[stop - 1]
        if stop - first == 1:
            return depth, len(a), first, stop, len(a), len(a), ()
        shared = min(len(a), len(b))
        differ = np.flatnonzero(a[depth:shared] != b[depth:shared])
        end = depth + int(differ[0]) if len(differ) else shared
        children, at = [], first
        while at < stop:
            to = at + 1
            own = self.sets[at][end] if self.length[at] > end else None
            while to < stop and own is not None and self.sets[to][end] == own:
                to += 1
            children.append(self._node(at, to, end))
            at = to
        below = self.length[first:stop]
        return depth, end, first, stop, min(below), max(below), tuple(children)

    def probe(self, tokens: np.ndarray, inside: np.ndarray, n: int, percent: int, skip) -> Iterator[int]:
        """The sets that link with a set of ``n`` tokens, of which ``tokens`` occur in the tree (``inside`` is scratch:
        a zero for every token). ``skip(first, stop)`` says whether sets first..stop need no look."""
        inside[tokens] = 1
        after = len(tokens) - np.cumsum(inside)  # tokens of the probe beyond each token
        todo = [(self.root, 0)]
        while todo:
            (begin, end, first, stop, shortest, longest, children), overlap = todo.pop()
            if 100 * longest < percent * n or percent * shortest > 100 * n or skip(first, stop):
                continue
            path = self.sets[first]
            if end > begin:
                overlap += int(inside[path[begin:end]].sum())
            rest = int(after[path[end - 1]]) if end else len(tokens)
            if (100 + percent) * (overlap + min(longest - end, rest)) < percent * (n + shortest):
                continue
            if children:
                todo += [(child, overlap) for child in children]
            elif (100 + percent) * overlap >= percent * (n + longest):
                yield first
        inside[tokens] = 0


def _trie_of(sets: list[np.ndarray]) -> tuple[Trie, np.ndarray, np.ndarray, np.ndarray]:
    """(tree, its place of each input set, sorted distinct shingles, their ranks by falling frequency)."""
    known, number, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(known), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(known))
    split = np.split(np.sort(rank[number] + np.repeat(np.arange(len(sets)), [len(s) for s in sets]) * len(known)), np.cumsum([len(s) for s in sets])[:-1])
    ranked = [s - i * len(known) for i, s in enumerate(split)]
    order = sorted(range(len(sets)), key=lambda i: ranked[i].astype(">u4").tobytes())  # their lexicographic order
    return Trie([ranked[i] for i in order]), np.array(order), known, rank


def link_block(nodes: list[int], sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the node that stands for its component in this block."""
    tree, order, known, _ = _trie_of(sets)
    label = np.arange(len(order))
    inside = np.zeros(len(known), np.int32)
    for i, own in enumerate(tree.sets):
        skip = lambda first, stop: first >= i or bool((label[first : min(stop, i)] == label[i]).all())  # noqa: B023, E731
        for j in tree.probe(own, inside, len(own), percent, skip):
            label[label == label[i]] = label[j]
    out = [0] * len(nodes)
    for place, i in enumerate(order.tolist()):
        out[i] = nodes[order[label[place]]]
    return out


def _runs(batches: Iterator[pa.RecordBatch], n: int, keys: tuple[str, ...], stream: str | None = None) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Runs of rows with equal keys in sorted batches, columns as lists, with the sets of their texts. A text that isn't
    the node's, under a repeated doc_id, is left out, and so is a node that a run has already. Runs in which the column
    ``stream`` is true come in pieces."""
    now, held = None, None
    for batch in batches:
        for start, stop, texts in chunks(batch, "text"):
            part = batch.slice(start, stop - start)
            columns = {c: part.column(c).to_pylist() for c in part.schema.names if c != "text"}
            for i, s in enumerate(shingle_sets(texts, n)):
                key = tuple(columns[k][i] for k in keys)
                if key != now or stream and columns[stream][i] and len(held["node"]) >= BLOCK_SETS:
                    if held and held["node"]:
                        yield now, held
                    now, held, seen = key, {c: [] for c in (*columns, "shingles")}, set()
                node = columns["node"][i]
                if node in seen or _digest(s) != node:
                    continue
                seen.add(node)
                for c, v in columns.items():
                    held[c].append(v[i])
                held["shingles"].append(s)
    if held and held["node"]:
        yield now, held


def _link_blocks(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, n, ("family", "block")):
            first = link_block(rows["node"], rows["shingles"], percent)
            yield pa.record_batch({"a": pa.array(rows["node"], pa.int64()), "b": pa.array(first, pa.int64())})

    return run


def _probe_blocks(n: int, percent: int):
    """Links between the outer sets of a family and the sets of one of its blocks, which come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = tree = order = known = rank = inside = nodes = label = None
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for (family, block, is_outer), rows in _runs(batches, n, ("family", "block", "outer"), "outer"):
            if not is_outer:
                tree, order, known, rank = _trie_of(rows["shingles"])
                nodes, label = [rows["node"][i] for i in order.tolist()], np.array([rows["label"][i] for i in order.tolist()], np.int64)
                inside, parent, now = np.zeros(len(known), np.int32), {}, (family, block)
                continue
            if now != (family, block):
                continue
            out: list[tuple[int, int]] = []
            for node, mine, s in zip(rows["node"], rows["label"], rows["shingles"], strict=True):
                place = np.minimum(np.searchsorted(known, s), len(known) - 1)
                tokens = np.sort(rank[place[known[place] == s]])
                skip = lambda first, stop: bool((label[first:stop] == find(mine)).all())  # noqa: B023, E731
                for j in tree.probe(tokens, inside, len(s), percent, skip):
                    theirs, own = int(label[j]), find(mine)
                    if theirs != own:
                        out.append((nodes[j], node))
                        label[label == theirs] = own
                        parent[theirs] = own
            yield pa.record_batch({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def _dealt(nodes: DataFrame, percent: int, level: int = 0) -> DataFrame:
    """The rows (family, node, n) with block and blocks. A family that fits makes one block; a larger one is cut into
    classes of size, each a step of ``percent``, and those by hash into as many blocks as they need."""
    step = F.floor(F.log(F.col("n")) / F.lit(math.log(100 / percent))).alias("step")
    held = nodes.withColumn("step", step)
    need = lambda: F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    large = held.groupBy(F.col("family").alias("f")).agg(need().alias("blocks")).where(F.col("blocks") > 1)
    steps = held.groupBy(F.col("family").alias("sf"), F.col("step").alias("ss")).agg(need().alias("parts"))
    size = materialize(steps.join(large, steps["sf"] == large["f"]).select("sf", "ss", "parts", "blocks"), "ngram-sizes")
    dealt = held.join(size, (held["family"] == size["sf"]) & (held["step"] == size["ss"]), "left")
    block = F.shiftleft("step", 32) + F.pmod(F.xxhash64("node", F.lit(level)), "parts")
    return dealt.select(*nodes.columns, F.coalesce("blocks", F.lit(1)).alias("blocks"), F.coalesce(block, F.lit(0)).alias("block"))


def _linked(blocks: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): every set's node and the node that stands for its component in its block."""
    rows = blocks.select("family", "block", "node", "text").repartition("family", "block").sortWithinPartitions("family", "block")
    return materialize(rows.mapInArrow(_link_blocks(n, percent), "a long, b long"), "ngram-links")


def link_components(df: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) for every row (doc_id, text) of ``df``."""
    spark = df.sparkSession
    bounded_batches(spark)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = max(SLICES, math.ceil(size / SLICE_BYTES))
    asked = materialize(docs.mapInArrow(_send(n, slices), SENT), "ngram-sent")  # chunks keep their numbers
    answers = asked.where("slice >= 0").repartition(slices, "slice").sortWithinPartitions("slice").mapInArrow(_answer, SENT)
    chunked = answers.unionByName(asked.where("slice < 0")).repartition("chunk").sortWithinPartitions("chunk", "slice")
    index = materialize(chunked.mapInArrow(_index(percent), "doc_id long, node long, n long, root long, w array<long>, range array<long>"), "ngram-index")

    tokens = index.where(F.col("w").isNotNull()).select("root", F.explode(F.arrays_zip("w", "range")).alias("t")).select("root", "t.w", "t.range")
    edges = tokens.repartition(F.col("w")).sortWithinPartitions("w", "range").mapInArrow(_chains(percent), "a long, b long")
    families = components(edges)
    docs_of = index.where(F.col("n") > 0).select("doc_id", "node", "n", "root")
    labelled = docs_of.join(families, docs_of["root"] == families["node"], "left").select("doc_id", docs_of["node"], "n", F.coalesce("label", "root").alias("family"))
    distinct = materialize(labelled.groupBy("family", "node").agg(F.min("doc_id").alias("id"), F.first("n").alias("n")), "ngram-nodes")
    several = materialize(distinct.groupBy(F.col("family").alias("f")).agg(F.count("*").alias("c")).where(F.col("c") > 1).select("f"), "ngram-families")
    wanted = materialize(_dealt(distinct.join(several, distinct["family"] == several["f"], "left_semi"), percent), "ngram-wanted")

    near = maybe_in(docs, "doc_id", id_filter(wanted, "id"))  # few other texts move
    texts = materialize(near.join(wanted.hint("merge"), near["doc_id"].eqNullSafe(wanted["id"])).select("family", "block", "blocks", "node", "n", "text"), "ngram-texts")
    found = [_linked(texts, n, percent)]
    large = rest = texts.where(F.col("blocks") > 1)
    for level in range(1, HEAD_ROUNDS + 1):  # one set for each component of a block goes on
        if rest.isEmpty():
            break
        heads = found[-1].where(F.col("a") == F.col("b")).select("a")
        sets = rest.select("family", "node", "n").distinct()
        marked = sets.join(heads, sets["node"] == heads["a"], "left").select("family", "node", "n", F.col("a").isNotNull().alias("head"))
        shrinks = marked.groupBy(F.col("family").alias("sf")).agg(F.count_if("head").alias("heads"), F.count("*").alias("all")).where("2 * heads <= all").select("sf")
        chosen = marked.where("head").join(shrinks, F.col("family") == F.col("sf"), "left_semi").drop("head")
        dealt = materialize(_dealt(materialize(chosen, "ngram-heads"), percent, level), "ngram-heads")
        again = dealt.select(F.col("family").alias("f_"), F.col("node").alias("n_"), F.col("block").alias("to_"), F.col("blocks").alias("of_"))
        rest = rest.join(again, (rest["family"] == again["f_"]) & (rest["node"] == again["n_"])).select("family", F.col("to_").alias("block"), F.col("of_").alias("blocks"), "node", "n", "text")
        found.append(_linked(rest, n, percent))
        rest = rest.where(F.col("blocks") > 1)
    union = found[0]
    for more in found[1:]:
        union = union.union(more)
    if len(found) > 1:
        union = union.union(_cross_links(large, union, n, percent))
    labels = components(union)
    nodes = index.select("doc_id", F.col("node").alias("of"), "n")
    named = nodes.join(labels, nodes["of"] == labels["node"], "left").select("doc_id", "n", F.coalesce("label", "of").alias("label"))
    named = materialize(named, "ngram-labels")
    least = materialize(named.where(F.col("n") > 0).groupBy(F.col("label").alias("l")).agg(F.min("doc_id").alias("least"), F.count("*").alias("c")).where(F.col("c") > 1), "ngram-least")
    own = F.when(F.col("n") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id"))
    return named.join(least, named["label"] == least["l"], "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _cross_links(large: DataFrame, links: DataFrame, n: int, percent: int) -> DataFrame:
    """The links between different blocks of a family that the components so far don't hold."""
    labels = components(links)
    nodes = large.select("family", "node", "n", "block").distinct()
    named = materialize(nodes.join(labels.select(F.col("node").alias("of"), "label"), nodes["node"] == F.col("of"), "left").select("family", "node", "n", "block", F.coalesce("label", "node").alias("label")), "ngram-named")
    counts = named.groupBy("family", "label").agg(F.count("*").alias("c"))
    main = materialize(counts.groupBy(F.col("family").alias("f")).agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("n_labels")).where(F.col("n_labels") > 1), "ngram-main")
    open_ = named.join(main, named["family"] == main["f"])
    inner = open_.select("family", "block", F.lit(False).alias("outer"), "node", "label")
    sizes = materialize(open_.groupBy(F.col("family").alias("bf"), F.col("block").alias("to")).agg(F.min("n").alias("least"), F.max("n").alias("most")), "ngram-ranges")
    apart = open_.where(F.col("label") != F.col("main")).select("family", "node", "n", "label")
    in_range = (F.col("family") == F.col("bf")) & (100 * F.col("most") >= percent * F.col("n")) & (percent * F.col("least") <= 100 * F.col("n"))
    outer = apart.join(sizes, in_range).select("family", F.col("to").alias("block"), F.lit(True).alias("outer"), "node", "label")
    asked = materialize(inner.unionByName(outer), "ngram-asked")
    texts = large.select(F.col("family").alias("f_"), F.col("node").alias("n_"), "text")
    both = asked.join(texts, (asked["family"] == texts["f_"]) & (asked["node"] == texts["n_"])).select("family", "block", "outer", "node", "label", "text")
    dealt = both.repartition("family", "block").sortWithinPartitions("family", "block", "outer")
    return materialize(dealt.mapInArrow(_probe_blocks(n, percent), "a long, b long"), "ngram-cross")
