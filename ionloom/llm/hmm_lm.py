"""A hidden Markov language model over word tokens, trained by Baum-Welch across partitions.

Tokens are the words of a text, runs of anything but ASCII white space with A-Z lower-cased, and one end. Latent states
emit symbols: each of the at most ``SENT_WORDS`` most frequent words is one, the end is one, and the other words share
``CLASSES`` by their hash. A class emits its words by their smoothed counts, so the model that every task needs has a
bounded size while the counts hold every word of the corpus: P(text) = sum over state paths of prod A * B(symbol | state),
times prod P(word | symbol), which is 1 for a word of its own and else (c + 1) / (N_class + V_class + 1); the last unit is
for all words of the class that training didn't see.

Expected counts leave the tasks as whole multiples of 2**-16, so their sums don't depend on how Spark groups them.
Training reads every whole training document in every round. Texts are dealt into segments of ``SEGMENT`` tokens that
advance together; for texts of several segments each one's transfer matrix (from the state before it to that behind it) is
found first, so that every segment begins with the forward and ends with the backward state of the whole text, and the
counts are those of whole texts.
Rounds end when one has gained less than ``LEAST_GAIN`` in log10 probability a token, and after ``ROUNDS``. Scoring runs
the scaled forward recursion over whole texts. Counts of frequent words travel to the tasks as a table of bounded size,
those of all others are joined.

A null text is an empty one, which is the end alone. Repeated rows are scored and counted each. Without a training
document N = V = 0 and the model is uniform. No rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionloom.llm.common import CHUNK_BYTES, bounded_batches, chunks, materialize, mix, word_hashes

#: Latent states, word classes, rounds of Baum-Welch at most and the gain below which they end, tokens of a segment, and
#: bytes of text that advance together.
STATES, CLASSES, ROUNDS, LEAST_GAIN, SEGMENT, BATCH_BYTES = 8, 4096, 6, 0.004, 256, 4 << 20
#: Words whose counts are sent to every task, at most, and which are symbols of their own.
SENT_WORDS = 1 << 16
_UNIT = 1 << 16
#: The hash that stands for the end of a text.
END = np.uint64(0x9D39247E33776D41)


@dataclass
class Model:
    """start (states), move (states x states) and emit (states x symbols) probabilities; the sorted hashes of the words that
    are symbols of their own; and what log10 P(word | symbol) subtracts from log10(c + 1)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    within: np.ndarray
    heads: np.ndarray

    def symbols(self, h: np.ndarray) -> np.ndarray:
        return symbols_of(h, self.emit.shape[1] - 1 - len(self.heads), self.heads)


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, number of tokens of each text)."""
    parts, sizes, at = [], [], 0
    while at < len(texts):  # in pieces of bounded size, for the sums over their bytes
        stop, held = at, 0
        while stop < len(texts) and (stop == at or held + len(texts[stop] or b"") <= CHUNK_BYTES):
            held += len(texts[stop] or b"")
            stop += 1
        words, size = word_hashes(texts[at:stop])
        out = np.full(len(words) + len(size), END, np.uint64)
        inside = np.ones(len(out), bool)
        inside[np.cumsum(size + 1) - 1] = False
        out[inside] = words
        parts.append(out)
        sizes.append(size + 1)
        at = stop
    return np.concatenate(parts), np.concatenate(sizes)


def class_of(h: np.ndarray, classes: int) -> np.ndarray:
    return np.where(h == END, classes, (mix(h) % np.uint64(classes)).astype(np.int64))


def symbols_of(h: np.ndarray, classes: int, heads: np.ndarray) -> np.ndarray:
    """Classes, then the end, then the heads."""
    out = class_of(h, classes)
    if len(heads):
        place = np.minimum(np.searchsorted(heads, h), len(heads) - 1)
        out = np.where(heads[place] == h, classes + 1 + place, out)
    return out


def _first_model(states: int, share: np.ndarray, classes: int) -> Model:
    """Where Baum-Welch begins: sticky states that disagree at random about the symbols."""
    noise = np.random.Generator(np.random.PCG64(7)).gamma(2.0, size=(states, len(share)))
    noise[:, classes] = 1
    emit = share * noise
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True), np.zeros(len(share)), np.zeros(0, np.uint64))


def _layout(length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences in falling length: (their order, where each begins among the tokens, how many are still running at each step)."""
    order = np.argsort(-length, kind="stable")
    running = np.searchsorted(-length[order], -np.arange(1, int(length.max(initial=0)) + 1), side="right")
    return order, (np.cumsum(length) - length)[order], running


def _edges(obs: np.ndarray, begin: np.ndarray, length: np.ndarray, parts: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """For every segment of texts of several segments the forward state before it and the backward state behind it, each
    up to a factor. ``parts`` is the number of segments of each text; the segments lie in the order of the texts."""
    states = len(model.start)
    by_symbol, move = np.ascontiguousarray(model.emit.T.astype(np.float32)), model.move.astype(np.float32)
    opening = np.zeros(len(begin), bool)
    opening[np.cumsum(parts) - parts] = True
    order, _, running = _layout(length)
    at, first = begin[order], opening[order]
    transfer = np.zeros((len(begin), states, states), np.float32)
    held = None
    for t, n in enumerate(running.tolist()):
        b = by_symbol[obs[at[:n] + t]]
        if t == 0:
            held = np.where(first[:, None, None], np.eye(states, dtype=np.float32), move) * b[:, None, :]
        else:
            transfer[order[n : len(held)]] = held[n:]
            held = (held[:n].reshape(-1, states) @ move).reshape(n, states, states) * b[:, None, :]
        if t % 4 == 3:
            held /= held.sum(axis=(1, 2), keepdims=True)
    transfer[order[: len(held)]] = held
    transfer /= transfer.sum(axis=(1, 2), keepdims=True)
    before, behind = np.ones((len(begin), states), np.float32), np.ones((len(begin), states), np.float32)
    start = np.cumsum(parts) - parts
    state = np.repeat(model.start.astype(np.float32)[None, :], len(parts), axis=0)
    for k in range(int(parts.max())):
        live = np.flatnonzero(parts > k)
        own = start[live] + k
        before[own] = state[live]
        after = np.einsum("ni,nij->nj", state[live], transfer[own])
        state[live] = after / after.sum(axis=1, keepdims=True)
    state = np.ones((len(parts), states), np.float32)
    for k in range(int(parts.max())):
        live = np.flatnonzero(parts > k)
        own = start[live] + parts[live] - 1 - k
        behind[own] = state[live]
        ahead = np.einsum("nij,nj->ni", transfer[own], state[live])
        state[live] = ahead / ahead.sum(axis=1, keepdims=True)
    return before, behind


def expectations(obs: np.ndarray, length: np.ndarray, model: Model, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts (start, move, emit) over whole sequences, and the natural log of their probability."""
    states, n_symbols = model.emit.shape
    parts = -(-length // segment)
    of = np.repeat(np.arange(len(length)), parts)
    place = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = (np.cumsum(length) - length)[of] + place * segment
    size = np.minimum(segment, length[of] - place * segment)
    opening = place == 0
    by_symbol, move = np.ascontiguousarray(model.emit.T.astype(np.float32)), model.move.astype(np.float32)
    lead = np.repeat(model.start.astype(np.float32)[None, :], len(of), axis=0)
    behind = np.ones((len(of), states), np.float32)
    several = parts[of] > 1
    if several.any():
        before, behind[several] = _edges(obs, begin[several], size[several], parts[parts > 1], model)
        lead[several] = np.where(opening[several][:, None], before, before @ move)

    order, _, running = _layout(size)
    steps, at = running.tolist(), begin[order]
    alphas, weights, scales = [], [], []
    alpha = lead[order]
    for t, n in enumerate(steps):
        b = by_symbol[obs[at[:n] + t]]
        alpha = (alpha if t == 0 else alpha[:n] @ move) * b
        scale = alpha.sum(axis=1, keepdims=True)
        alpha = alpha / scale
        alphas.append(alpha)
        weights.append(b)
        scales.append(scale)
    total = sum(float(np.log(x, dtype=np.float64).sum()) for x in scales)
    ends = np.empty((len(of), states), np.float32)
    xi, gammas = np.zeros((states, states)), [None] * len(alphas)
    beta, behind = np.zeros((0, states), np.float32), behind[order]
    for t in range(len(alphas) - 1, -1, -1):
        n, m = len(alphas[t]), len(beta)
        new = np.empty((n, states), np.float32)
        if m:
            inner = weights[t + 1] * beta / scales[t + 1]
            xi += alphas[t][:m].T @ inner
            new[:m] = inner @ move.T
        if m < n:  # segments that end here
            ends[m:n] = alphas[t][m:]
            new[m:] = behind[m:n] / (alphas[t][m:] * behind[m:n]).sum(axis=1, keepdims=True)
        beta = new
        gammas[t] = alphas[t] * beta
    back = np.empty(len(of), np.int64)
    back[order] = np.arange(len(of))
    later = np.flatnonzero(~opening)  # the moves from one segment to the next
    inner = (weights[0] * beta / scales[0])[back[later]]
    xi += ends[back[later - 1]].T @ inner
    seen = np.concatenate([obs[at[:n] + t] for t, n in enumerate(steps)])
    gamma = np.concatenate(gammas)
    emit = np.stack([np.bincount(seen, weights=gamma[:, k], minlength=n_symbols) for k in range(states)])
    return gammas[0][opening[order]].sum(axis=0, dtype=np.float64), xi * model.move, emit, total


def log_likelihood(obs: np.ndarray, length: np.ndarray, model: Model) -> np.ndarray:
    """Natural log of each whole sequence's probability, by the forward recursion, scaled at every eighth step."""
    order, begin, running = _layout(length)
    by_class = np.ascontiguousarray(model.emit.T)
    total, alpha = np.zeros(len(length)), None
    steps = running.tolist()
    for t, n in enumerate(steps):
        b = by_class[obs[begin[:n] + t]]
        alpha = model.start * b if t == 0 else alpha[:n] @ model.move * b
        after = steps[t + 1] if t + 1 < len(steps) else 0
        if t % 8 == 7:
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            total[:n] += np.log(scale)
        if after < n:  # these end here
            total[after:n] += np.log(alpha[after:].sum(axis=1))
    out = np.empty(len(length))
    out[order] = total
    return out


def _expect(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        states, n_symbols = model.emit.shape
        total, gained, n = np.zeros((states, 1 + states + n_symbols), np.int64), 0, 0
        for batch in batches:
            for _, _, texts in chunks(batch, "text", BATCH_BYTES):
                h, size = tokens(texts)
                start, move, emit, log = expectations(model.symbols(h), size, model)
                total += np.rint(np.concatenate([start[:, None], move, emit], axis=1) * _UNIT).astype(np.int64)
                gained, n = gained + round(log * _UNIT), n + len(h)
        parts = [zlib.compress(row.tobytes(), 1) for row in total] + [np.array([gained, n], np.int64).tobytes()]
        yield pa.record_batch({"state": pa.array(range(states + 1), pa.int32()), "counts": pa.array(parts, pa.binary())})

    return run


def _sum_counts(states: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for state, counts in zip(batch.column("state").to_pylist(), batch.column("counts"), strict=True):
                raw = counts.as_py()
                total[state] = total.get(state, 0) + np.frombuffer(zlib.decompress(raw) if state < states else raw, np.int64)
        yield pa.record_batch({"state": pa.array(list(total), pa.int32()), "counts": pa.array([v.tobytes() for v in total.values()], pa.binary())})

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held, size = [], 0
        for _, _, texts in [*chunks(batch, "text"), (0, 0, None)]:
            if texts is not None:
                held.append(tokens(texts)[0])
                size += len(held[-1])
            if held and (texts is None or size > 4_000_000):
                h, c = np.unique(np.concatenate(held), return_counts=True)
                yield pa.record_batch({"h": h.view(np.int64), "c": c.astype(np.int64), "class": class_of(h, CLASSES)})
                held, size = [], 0


def count_words(train: DataFrame) -> DataFrame:
    """(h, class, c): the training count of every distinct token, by its hash."""
    bounded_batches(train.sparkSession)
    return materialize(train.select("text").mapInArrow(_count, "h long, c long, class long").groupBy("h", "class").agg(F.sum("c").alias("c")), "lm-counts")


def frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(sorted hashes, counts) of the most frequent tokens, at most SENT_WORDS of them, and the count at which they begin."""
    sizes = {r.size: r.words for r in counts.groupBy(F.floor(F.log2("c")).alias("size")).agg(F.count("*").alias("words")).collect()}  # 64 rows at most
    least, held = 64, 0
    while least and held + sizes.get(least - 1, 0) <= SENT_WORDS:
        least -= 1
        held += sizes.get(least, 0)
    bound = 2 ** min(least, 62)
    rows = counts.where(F.col("c") >= F.lit(bound)).select("h", "c").collect()  # SENT_WORDS rows at most
    heads = np.array([r.h for r in rows], np.int64).view(np.uint64)
    by = np.argsort(heads)
    return heads[by], np.array([r.c for r in rows], np.float64)[by], bound


def fit(train: DataFrame, counts: DataFrame, states: int = STATES, rounds: int = ROUNDS, least_gain: float = LEAST_GAIN) -> Model:
    """Baum-Welch over all rows of ``train``; ``counts`` are its word counts."""
    bounded_batches(train.sparkSession)
    context = train.sparkSession.sparkContext
    heads, known, bound = frequent(counts)
    own = heads != END
    heads, known = heads[own], known[own]
    share, within = np.ones(CLASSES + 1 + len(heads)), np.zeros(CLASSES + 1 + len(heads))
    shared = counts.where((F.col("c") < F.lit(bound)) | (F.col("class") == CLASSES))
    for r in shared.groupBy("class").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():  # CLASSES + 1 rows at most
        share[r["class"]] += r.n
        within[r["class"]] = math.log10(r.n + r.v + (r["class"] < CLASSES))
    share[CLASSES + 1 :] += known
    within[CLASSES + 1 :] = np.log10(known + 1)
    share /= share.sum()
    model = _first_model(states, share, CLASSES)
    model.within, model.heads = within, heads
    last = -math.inf
    for _ in range(rounds):
        sent = context.broadcast(model)
        parts = train.select("text").mapInArrow(_expect(sent), "state int, counts binary").repartition(states + 1, "state").mapInArrow(_sum_counts(states), "state int, counts binary")
        rows = {r.state: np.frombuffer(bytes(r.counts), np.int64) for r in parts.collect()}  # a row for each state, and one
        if len(rows) <= states or not rows[states][1]:
            break
        total = np.stack([rows[k] for k in range(states)]) / _UNIT
        start, move, emit = total[:, 0] + 1, total[:, 1 : 1 + states] + 1, total[:, 1 + states :] + states * share
        model = Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True), within, heads)
        mean = rows[states][0] / _UNIT / math.log(10) / rows[states][1]  # of the model before this round
        if mean - last < least_gain:
            break
        last = mean
    return model


def _score(sent, known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        heads, counts = known.value
        for batch in batches:
            for start, stop, texts in chunks(batch, "text", 2 * BATCH_BYTES):
                h, size = tokens(texts)
                obs = model.symbols(h)
                edge = np.cumsum(size) - size
                score = log_likelihood(obs, size, model) / math.log(10) - np.add.reduceat(model.within[obs], edge)
                place = np.minimum(np.searchsorted(heads, h), max(0, len(heads) - 1))
                hit = heads[place] == h if len(heads) else np.zeros(len(h), bool)
                c = np.where(hit, counts[place], 0) if len(heads) else np.zeros(len(h))
                doc = np.repeat(np.arange(len(size)), size)[~hit]
                rare = h[~hit]
                by = np.lexsort((rare, doc))
                doc, rare = doc[by], rare[by]
                new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (rare[1:] != rare[:-1])])) if len(doc) else np.zeros(0, np.int64)
                tf = np.diff(new, append=len(doc))
                cut = np.searchsorted(doc[new], np.arange(len(size) + 1)).astype(np.int32)
                tails = pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays([pa.array(rare[new].view(np.int64)), pa.array(tf)], ["h", "tf"]))
                yield pa.record_batch({
                    "row": batch.column("row").slice(start, stop - start), "doc_id": batch.column("doc_id").slice(start, stop - start), "n_tokens": pa.array(size), "score": pa.array(score),
                    "known": pa.array(np.add.reduceat(hit.astype(np.int64), edge)), "logs": pa.array(np.add.reduceat(np.log10(c + 1), edge)), "tail": tails,
                })

    return run


def score(df: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (both log10) for every row (doc_id, text) of ``df``."""
    bounded_batches(df.sparkSession)
    context = df.sparkSession.sparkContext
    docs = df.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n, v = (x or 0 for x in counts.agg(F.sum("c"), F.count("*")).first())
    heads, times, bound = frequent(counts)
    known = context.broadcast((heads, times))
    scored = docs.mapInArrow(_score(context.broadcast(model), known), "row long, doc_id long, n_tokens long, score double, known long, logs double, tail array<struct<h:long,tf:long>>")
    scored = materialize(scored, "lm-scored")  # rows keep their numbers from here on
    rare = counts.where(F.col("c") < F.lit(bound)).select(F.col("h").alias("word"), "c")
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.h", "t.tf")
    summed = tail.join(rare, tail["h"] == rare["word"]).groupBy(F.col("row").alias("of")).agg(F.sum("tf").alias("more"), F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("more_logs"))
    joined = scored.drop("tail").join(summed, scored["row"] == summed["of"], "left")
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    return joined.select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"), (F.col("score") + logs).alias("score"),
    )


def held_out(doc_id: Column) -> Column:
    """Documents that training doesn't read: CRC-32 of the id as text leaves 2 when divided by 7."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))
