"""Search by seeds: exact occurrences of many patterns, and similarity between sequences, as equi-joins on k-mers.

Of every ``width`` consecutive k-mers of a sequence the one with the least hash is a seed, the leftmost of equal ones. A
stretch of ``k + width - 1`` letters has the same seed wherever it stands, so sequences that share such a stretch meet on
it, while only some 2 in ``width + 1`` places become rows. Letters are code points; sequences are read in bounded pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionloom.storage import materialize

#: k-mer and window of patterns of K + WIDTH - 1 letters or more; shorter patterns are seeds themselves.
K, WIDTH = 8, 5
#: Letters of a sequence that a task turns into seeds at once, and of a piece of a text that candidates are checked in.
LETTERS, PIECE = 1 << 20, 1024
#: Letters of all patterns that tasks hold themselves, at most.
SENT_LETTERS = 1 << 20
_BASE, _MIX = np.uint64(0x2545F4914F6CDD1D), np.uint64(0xFF51AFD7ED558CCD)


def kmer_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every run of ``k`` letters."""
    h = np.zeros(max(0, len(codes) - k + 1), np.uint64)
    for j in range(k):
        h = h * _BASE + codes[j : j + len(h)].astype(np.uint64) + np.uint64(1)
    h ^= h >> np.uint64(32)
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def seeds_of(text: str, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places from 0, hashes) of the seeds of a text."""
    codes, places, hashes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), [], []
    for at in range(0, max(0, len(codes) - k - width + 2), LETTERS):
        h = kmer_hashes(codes[at : at + LETTERS + k + width - 2], k)
        least, reach = np.arange(len(h)), 1
        while reach < width:
            step = min(reach, width - reach)
            left, right = least[:-step], least[step:]
            least, reach = np.where(h[right] < h[left], right, left), reach + step
        new = np.unique(least)
        places.append(new + at)
        hashes.append(h[new])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)  # windows on both sides of an edge may agree
    return place, np.concatenate(hashes)[first]


def seed_rows(df: DataFrame, name: str, text: str, k: int, width: int) -> DataFrame:
    """(``name``, place from 1, seed) for the seeds of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, seeds, held = [], [], [], 0
            for i, value in enumerate(batch.column("letters_")):
                place, seed = seeds_of(value.as_py() or "", k, width)
                rows.append(np.full(len(place), i))
                places.append(place + 1)
                seeds.append(seed.view(np.int64))
                held += len(place)
                if held > LETTERS or i + 1 == batch.num_rows:
                    yield pa.record_batch({name: batch.column(name).take(pa.array(np.concatenate(rows))), "place": np.concatenate(places), "seed": np.concatenate(seeds)})
                    rows, places, seeds, held = [], [], [], 0

    kind = df.schema[name].dataType.simpleString()
    return df.select(name, F.col(text).alias("letters_")).mapInArrow(run, f"{name} {kind}, place long, seed long")


def pieces(df: DataFrame, name: str, text: str) -> DataFrame:
    """(``name``, i, part): the texts in pieces of PIECE letters, cut in one pass."""
    return df.select(name, F.posexplode(F.expr(f"regexp_extract_all({text}, '(?s)(.{{1,{PIECE}}})', 1)")).alias("i", "part"))


def spans(found: DataFrame, parts: DataFrame, name: str, start: str, length: Column) -> DataFrame:
    """``found`` with a row for each piece that the span of ``length`` letters from ``start`` (from 1) touches: lo and hi
    (from 1) in the text, and the piece's letters between them as ``held``."""
    wide = found.withColumn("stop_", F.col(start) + length - 1).withColumn("i", F.explode(F.expr(f"sequence(CAST(({start} - 1) DIV {PIECE} AS INT), CAST((stop_ - 1) DIV {PIECE} AS INT))")))
    met = wide.join(parts, [name, "i"])
    lo, hi = F.greatest(F.col(start), F.col("i") * PIECE + 1), F.least(F.col("stop_"), (F.col("i") + 1) * PIECE)
    return met.withColumn("lo", lo).withColumn("hi", hi).withColumn("held", F.substring("part", (F.col("lo") - F.col("i") * PIECE).cast("int"), (F.col("hi") - F.col("lo") + 1).cast("int"))).drop("part")


def _scanned(texts: DataFrame, patterns: list[str]) -> DataFrame:
    """Occurrences of a few patterns, whose letters every task holds, in one pass over each text.

    A pattern is known by its first K + WIDTH - 1 letters, or by all of fewer. The hashes of a text's runs of each such
    length, each grown from the one before, meet those of the patterns, and what meets is compared letter by letter."""
    longest = K + WIDTH - 1
    by_head: dict[int, dict[int, dict[int, set[str]]]] = {}  # length of the head, its hash, pattern's length
    for p in patterns:
        codes = np.frombuffer(p.encode("utf-32-le", "replace"), np.uint32)
        n = min(len(codes), longest)
        by_head.setdefault(n, {}).setdefault(int(_runs(codes, {n})[n][0]), {}).setdefault(len(codes), set()).add(p)
    known = {}
    for n, heads in by_head.items():
        bits = np.zeros(1 << 16, bool)
        hashes = np.array(sorted(heads), np.uint64)
        bits[hashes >> np.uint64(48)] = True
        known[n] = bits, hashes
    kind = texts.schema["text_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, starts, ends = [], [], [], []
            for i, value in enumerate(batch.column("text")):
                text = value.as_py() or ""
                codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
                for at in range(0, len(codes), LETTERS):
                    for n, h in _runs(codes[at : at + LETTERS + longest - 1], set(known)).items():
                        bits, hashes = known[n]
                        h = h[:LETTERS]
                        near = np.flatnonzero(bits[h >> np.uint64(48)])
                        near = near[np.isin(h[near], hashes)]
                        for place, seed in zip((near + at).tolist(), h[near].tolist(), strict=True):
                            for size, held in by_head[n][seed].items():
                                word = text[place : place + size]
                                if word in held:
                                    rows.append(i)
                                    found.append(word)
                                    starts.append(place + 1)
                                    ends.append(place + size)
                        if len(rows) > LETTERS:
                            yield pa.record_batch([batch.column("text_id").take(pa.array(rows, pa.int64())), pa.array(found, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names)
                            rows, found, starts, ends = [], [], [], []
            yield pa.record_batch([batch.column("text_id").take(pa.array(rows, pa.int64())), pa.array(found, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names)

    names = ["text_id", "pattern", "start", "end"]
    return texts.select("text_id", "text").mapInArrow(run, f"text_id {kind}, pattern string, start long, end long")


def _runs(codes: np.ndarray, lengths: set[int]) -> dict[int, np.ndarray]:
    """64-bit hashes of all runs of each of ``lengths``."""
    h, out = np.zeros(len(codes), np.uint64), {}
    plus = codes.astype(np.uint64) + np.uint64(1)
    for j in range(min(max(lengths), len(codes))):
        h = h[: len(codes) - j] * _BASE + plus[j:]
        if j + 1 in lengths:
            mixed = (h ^ (h >> np.uint64(32))) * _MIX
            out[j + 1] = mixed ^ (mixed >> np.uint64(29))
    return out


def find_patterns(texts: DataFrame, patterns: DataFrame, sent: int = 10_000) -> DataFrame:
    """Every occurrence, overlapping ones included, of every pattern: (text_id, pattern, start, end), 1-based and closed.

    ``texts`` is (text_id, text), where an id names one text, ``patterns`` is (pattern). A pattern files the one of its
    seeds that is rarest in the texts, so that a frequent k-mer finds only the patterns that have nothing else; the
    texts' seeds meet the index in an equi-join, and what meets is checked letter by letter in the pieces of the text that
    it lies in. An index of at most ``sent`` rows, which are counted, is broadcast; a larger one is shuffled. At most
    ``sent`` patterns of at most SENT_LETTERS letters in all go to the tasks themselves, and one pass over the texts finds
    them where they stand: no seed and no text moves. Null and empty texts and patterns have no occurrences."""
    held = materialize(patterns.select("pattern").where("pattern <> ''").distinct().withColumn("size", F.length("pattern")), "patterns")
    n, letters = held.agg(F.count("*"), F.sum("size")).first()
    if 0 < n <= sent and letters <= SENT_LETTERS:
        return _scanned(texts, [r.pattern for r in held.select("pattern").collect()])  # at most sent rows and SENT_LETTERS letters
    lengths = [r.size for r in held.where(F.col("size") < K + WIDTH - 1).select("size").distinct().collect()]  # fewer than K + WIDTH - 1
    near = None
    for k, width, own in [(K, WIDTH, held.where(F.col("size") >= K + WIDTH - 1)), *((n, 1, held.where(F.col("size") == n)) for n in sorted(lengths))]:
        index = materialize(seed_rows(own, "pattern", "pattern", k, width).withColumnRenamed("place", "offset"), "patterns-seeds")
        rows = index.count()
        if not rows:
            continue
        by_size = (lambda df: F.broadcast(df)) if rows <= sent else (lambda df: df)
        found = seed_rows(texts, "text_id", "text", k, width)
        if width > 1:
            seen = found.join(by_size(index.select("seed").distinct()), "seed").groupBy("seed").agg(F.count("*").alias("seen"))
            # what no text has is not found, but stays the pattern's rarest
            best = index.join(seen, "seed", "left").groupBy("pattern").agg(F.min(F.struct(F.coalesce("seen", F.lit(0)), "offset", "seed")).alias("best"))
            index = materialize(best.select("pattern", "best.offset", "best.seed"), "patterns-rarest")
        met = found.join(by_size(index), "seed").select("text_id", (F.col("place") - F.col("offset") + 1).alias("start"), "pattern")
        near = met if near is None else near.union(met)
    if near is None:
        return texts.select("text_id").withColumns({"pattern": F.lit(""), "start": F.lit(0).cast("long"), "end": F.lit(0).cast("long")}).limit(0)
    size = F.length("pattern").cast("long")
    cells = spans(near.where("start > 0"), pieces(texts, "text_id", "text"), "text_id", "start", size)
    same = F.col("held") == F.substring("pattern", (F.col("lo") - F.col("start") + 1).cast("int"), (F.col("hi") - F.col("lo") + 1).cast("int"))
    asked = (F.floor((F.col("start") + size - 2) / PIECE) - F.floor((F.col("start") - 1) / PIECE) + 1).alias("asked")
    whole = cells.select("text_id", "pattern", "start", asked, same.alias("same"))
    single = whole.where("asked = 1 AND same").select("text_id", "pattern", "start")
    several = whole.where("asked > 1").groupBy("text_id", "pattern", "start", "asked").agg(F.count_if("same").alias("n")).where("n = asked").select("text_id", "pattern", "start")
    return single.union(several).select("text_id", "pattern", "start", (F.col("start") + size - 1).alias("end"))


# ---- similarity ----

#: Residues that often stand for each other; and what an alignment scores for the same residue, for one of
#: the same group, for any other, for opening a gap and for each residue in it.
GROUPS = ("AGPST", "C", "DENQ", "FWY", "HKR", "ILMV")
SAME, ALIKE, OTHER, OPEN, EXTEND = 5, 1, -3, 9, 2
#: k-mer and window of the seeds of similarity, diagonals that count as one, and residues beside a seed's diagonal that an
#: alignment may reach.
SIMILAR_K, SIMILAR_WIDTH, DIAGONALS, BAND = 5, 4, 16, 32
#: Pairs that are aligned at once, pairs that are scored at once, and their cells at most.
PAIRS, SCORED, CELLS = 64, 256, 1 << 22
#: The constant of the expected number of chance hits, for scores without gaps.
CHANCE = 0.1


def score_table(groups: tuple[str, ...] = GROUPS, same: int = SAME, alike: int = ALIKE, other: int = OTHER) -> np.ndarray:
    """Scores of two letters by their codes below 128."""
    of = np.arange(128) + 128
    for g, letters in enumerate(groups):
        of[[ord(c) for c in letters]] = g
    table = np.where(of[:, None] == of[None, :], alike, other)
    np.fill_diagonal(table, same)
    return table.astype(np.int64)


def decay(table: np.ndarray, share: dict[str, float]) -> float:
    """The lambda for which the expected exp(lambda * score) of two random letters is 1, by bisection."""
    codes = [ord(c) for c in share]
    p = np.array(list(share.values()))
    scores, weight = table[np.ix_(codes, codes)], p[:, None] * p[None, :]
    if (scores * weight).sum() >= 0 or scores.max() <= 0:
        raise ValueError("random letters must score below zero on average, and some pair above it")
    low, high = 0.0, 1.0
    while (weight * np.exp(high * scores)).sum() < 1:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (weight * np.exp(middle * scores)).sum() < 1 else (low, middle)
    return (low + high) / 2


def _aligned(queries: list[str], subjects: list[str], centre: list[int], band: int, table: np.ndarray) -> np.ndarray:
    """(score, first and last residue of query and subject, from 0) of the best local alignment of each pair within
    ``band`` diagonals of its centre (subject place minus query place). Of equal scores the earliest start in the query,
    then in the subject, and then the first end in the query and the subject is taken.

    All pairs advance a query residue at a time over their bands; a cell is a score above the places where it began, so
    that the maximum carries the start along."""
    n, w = len(queries), 2 * band + 1
    rows = max(len(q) for q in queries)
    q = np.full((n, rows), 127, np.int64)
    for i, x in enumerate(queries):
        q[i, : len(x)] = np.frombuffer(x.encode("ascii", "replace"), np.uint8) & 127
    length = np.array([len(x) for x in subjects])
    s = np.full((n, length.max() + 2 * rows + 2 * w), 127, np.int64)  # padding on both sides of each subject
    pad = rows + w
    for i, x in enumerate(subjects):
        s[i, pad : pad + len(x)] = np.frombuffer(x.encode("ascii", "replace"), np.uint8) & 127
    table = table.copy()
    table[127, :] = table[:, 127] = -(1 << 20)  # padding and unknown letters end alignments
    one, lane = np.int64(1) << 40, np.arange(w)
    none = -(np.int64(1) << 60)
    mask, pair = (np.int64(1) << 20) - 1, np.arange(n)[:, None]
    held, gap = np.full((n, w + 1), none), np.full((n, w + 1), none)  # the row before, with a lane beyond the band
    best, end = np.full(n, np.int64(0)), np.zeros((n, 2), np.int64)
    base = np.array(centre)[:, None] - band + lane[None, :]
    for i in range(rows):
        at = base + i  # subject places of the lanes
        start = ((mask - i) << 20) | (mask - np.clip(at, 0, mask))
        match = table[q[:, i][:, None], s[pair, np.clip(at + pad, 0, s.shape[1] - 1)]] * one
        diagonal = np.maximum(held[:, :w], start) + match
        gap = np.maximum(held[:, 1:] - (OPEN + EXTEND) * one, gap[:, 1:] - EXTEND * one)  # a residue of the query alone
        here = np.maximum(diagonal, gap)
        run = np.maximum.accumulate(here + EXTEND * lane * one, axis=1)  # residues of the subject alone
        across = np.concatenate([np.full((n, 1), none), run[:, :-1] - (OPEN + EXTEND * lane[1:]) * one], axis=1)
        here = np.maximum(here, across)
        here = np.where(here >= one, here, none)
        top = here.max(axis=1)
        better = (top >> 40 > best >> 40) | ((top >> 40 == best >> 40) & (top > best))
        if better.any():
            place = here.argmax(axis=1)
            best = np.where(better, top, best)
            end[better] = np.stack([np.full(n, i), at[np.arange(n), place]], axis=1)[better]
        held = np.concatenate([here, np.full((n, 1), none)], axis=1)
        gap = np.concatenate([gap, np.full((n, 1), none)], axis=1)
    return np.stack([best >> 40, mask - ((best >> 20) & mask), end[:, 0], mask - (best & mask), end[:, 1]], axis=1)


def _scores(queries: list[str], subjects: list[str], centre: list[int], band: int, table: np.ndarray) -> np.ndarray:
    """The score of the best local alignment of each pair, as ``_aligned`` finds it, without its place.

    A cell below zero begins anew, so no place has to be carried and small integers do; each subject is laid so that its
    band at a query's residue is the same slice for all pairs."""
    n, w, rows = len(queries), 2 * band + 1, max(len(q) for q in queries)
    q, s = np.full((n, rows), 127, np.int64), np.full((n, rows + w), 127, np.int64)
    for i, (x, y, c) in enumerate(zip(queries, subjects, centre, strict=True)):
        q[i, : len(x)] = np.frombuffer(x.encode("ascii", "replace"), np.uint8) & 127
        low = c - band  # the subject's place in column 0
        reach = np.frombuffer(y.encode("ascii", "replace"), np.uint8)[max(low, 0) : max(low + rows + w, 0)] & 127
        s[i, max(-low, 0) : max(-low, 0) + len(reach)] = reach
    table = table.astype(np.int32)
    table[127, :] = table[:, 127] = -(1 << 20)
    flat, lane = table.ravel(), (EXTEND * np.arange(w)).astype(np.int32)
    held, gap, best = np.zeros((n, w + 1), np.int32), np.zeros((n, w + 1), np.int32), np.zeros((n, w), np.int32)
    for i in range(rows):
        here = held[:, :w] + flat.take(s[:, i : i + w] + 128 * q[:, i : i + 1])
        gap[:, :w] = np.maximum(held[:, 1:] - (OPEN + EXTEND), gap[:, 1:] - EXTEND)
        np.maximum(here, gap[:, :w], out=here)
        run = np.maximum.accumulate(here + lane, axis=1)
        np.maximum(here[:, 1:], run[:, :-1] - lane[1:] - OPEN, out=here[:, 1:])
        np.maximum(here, 0, out=held[:, :w])
        np.maximum(best, here, out=best)
    return best.max(axis=1)


def _extend(band: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = score_table()
        for batch in batches:
            query, part, centre = batch.column("query").to_pylist(), batch.column("subject").to_pylist(), batch.column("centre").to_pylist()

            def groups(order: list[int], most: int) -> Iterator[tuple[list[int], tuple]]:
                order = sorted(order, key=lambda i: len(query[i]))  # pairs of like length together
                while order:
                    take, size = [], 0
                    while order and len(take) < most and (not take or (size := max(size, len(part[order[-1]]) + 2 * len(query[order[-1]]))) * (len(take) + 1) <= CELLS):
                        take.append(order.pop())
                    yield take, ([query[i] for i in take], [part[i] for i in take], [centre[i] for i in take], band, table)

            enough = [i for take, pairs in groups(range(len(query)), SCORED) for i, score in zip(take, _scores(*pairs), strict=True) if score >= least]
            for take, pairs in groups(enough, PAIRS):  # few of all
                found = _aligned(*pairs)
                good = np.flatnonzero(found[:, 0] >= least)
                rows = pa.array(np.array(take)[good], pa.int64())
                first = batch.column("first").take(rows).to_numpy(zero_copy_only=False)
                out = {c: batch.column(c).take(rows) for c in ("query_id", "subject_id")}
                score, q0, q1, s0, s1 = (found[good, k] for k in range(5))
                yield pa.record_batch(out | {"score": score, "query_start": q0 + 1, "query_end": q1 + 1, "subject_start": s0 + first, "subject_end": s1 + first})

    return run


def similar(queries: DataFrame, subjects: DataFrame, least: int = 60, k: int = SIMILAR_K, width: int = SIMILAR_WIDTH, band: int = BAND, hits: int = 2) -> DataFrame:
    """The best local alignment of every query with every subject that shares ``hits`` seeds with it near one diagonal:
    (query_id, subject_id, score, query_start, query_end, subject_start, subject_end, bits, expected), places from 1.

    ``queries`` is (query_id, query), ``subjects`` is (subject_id, subject), of upper-case residues, an id naming one
    sequence. Seeds meet in an equi-join and are counted by query, subject and group of neighbouring diagonals before any
    sequence moves; a seed lies in two overlapping groups, so that hits of two diagonals less than half a group apart
    meet in one. Only the part of the subject that the query's band can reach is fetched, from its pieces, and aligned
    with affine gaps. Alignments of less than ``least`` go. ``bits`` and ``expected`` follow from the letters' shares in
    the subjects: the number of such scores by chance is CHANCE * query letters * subject letters * exp(-lambda * score).
    Sequences of a seed's window or less have no hits; null ones none either."""
    half = DIAGONALS // 2
    left = seed_rows(queries, "query_id", "query", k, width).withColumnRenamed("place", "q")
    right = seed_rows(subjects, "subject_id", "subject", k, width).withColumnRenamed("place", "s")
    diagonal = F.col("s") - F.col("q")
    met = left.join(right, "seed").select("query_id", "subject_id", "q", "s", F.explode(F.array(F.floor(diagonal / half), F.floor(diagonal / half) - 1)).alias("group"))
    counted = met.groupBy("query_id", "subject_id", "group").agg(F.count("*").alias("n"), F.min(diagonal).alias("low"), F.max(diagonal).alias("high")).where(F.col("n") >= hits)
    ask = materialize(counted.select("query_id", "subject_id", F.floor((F.col("low") + F.col("high")) / 2).alias("centre")).distinct(), "similar-asked")
    named = ask.join(queries.select("query_id", "query"), "query_id").withColumn("size", F.length("query").cast("long"))
    sizes = subjects.select("subject_id", F.length("subject").cast("long").alias("n_s"))
    first = F.greatest(F.col("centre") - band + 1, F.lit(1))
    last = F.least(F.col("centre") + F.col("size") + band, F.col("n_s"))
    asked = named.join(sizes, "subject_id").withColumn("first", first).withColumn("reach", last - first + 1).where("reach > 0")
    cells = spans(asked.select("query_id", "subject_id", "centre", "first", "reach"), pieces(subjects, "subject_id", "subject"), "subject_id", "first", F.col("reach"))
    whole = cells.groupBy("query_id", "subject_id", "centre", "first").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "held"))), lambda x: x["held"]), "").alias("part"))  # what one query can reach
    ready = whole.join(queries.select("query_id", "query"), "query_id").select("query_id", "subject_id", "query", F.col("part").alias("subject"), (F.col("centre") - F.col("first") + 1).alias("centre"), "first")
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((queries, "query_id"), (subjects, "subject_id"))}
    found = ready.mapInArrow(_extend(band, least), f"query_id {kinds['query_id']}, subject_id {kinds['subject_id']}, score long, query_start long, query_end long, subject_start long, subject_end long")
    order = F.struct((-F.col("score")).alias("rank"), F.col("query_start"), F.col("subject_start"), F.col("query_end"), F.col("subject_end"))
    best = found.groupBy("query_id", "subject_id").agg(F.min(order).alias("b"))
    names = ["query_start", "subject_start", "query_end", "subject_end"]
    best = best.select("query_id", "subject_id", (-F.col("b.rank")).alias("score"), *(F.col(f"b.{n}") for n in names))
    rate, letters = letter_statistics(subjects)
    score, size = F.col("score"), F.length("query")
    chance = F.lit(CHANCE) * size * F.lit(float(letters)) * F.exp(-F.lit(rate) * score)
    bits = (F.lit(rate) * score - F.log(F.lit(CHANCE))) / F.log(F.lit(2.0))
    return best.join(queries.select("query_id", "query"), "query_id").select("query_id", "subject_id", "score", "query_start", "query_end", "subject_start", "subject_end", bits.alias("bits"), chance.alias("expected"))


def letter_statistics(subjects: DataFrame) -> tuple[float, int]:
    """(lambda, number of letters) of the subjects, counted in one pass over each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(256, np.int64)
        for batch in batches:
            for value in batch.column("subject"):
                seen += np.bincount(np.frombuffer((value.as_py() or "").encode(), np.uint8), minlength=256)
        yield pa.record_batch({"byte": np.arange(256), "n": seen})

    counts = {r.byte: r.n for r in subjects.select("subject").mapInArrow(run, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()}  # 256 at most
    letters = {c: counts[ord(c)] for c in "".join(GROUPS) if counts.get(ord(c))}
    total = sum(letters.values())
    if not total:
        return math.log(2), 0
    return decay(score_table(), {c: n / total for c, n in letters.items()}), sum(n for byte, n in counts.items() if byte & 0xC0 != 0x80)  # code points
