from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from ionloom.llm import hmm_lm, langid, sptok
from ionloom.llm.common import word_hashes

MODEL = public_tokenizers.path("piece_bpe_32k.model")
EN = "the quick brown fox and the lazy dog were on their way to the river with other animals "
DE = "der schnelle braune Fuchs und der faule Hund waren mit anderen Tieren auf dem Weg zum Fluss "


def labelled(spark):
    rows = [(i, EN[i % 20 :] * 3, "en") for i in range(12)] + [(i, DE[i % 20 :] * 3, "de") for i in range(12, 24)]
    rows += [(30, None, "en"), (31, "", None), (32, "12 ### --", "de"), (33, "Der Hund und der Fuchs", None), (34, "the river and the dog", None), (34, "the river and the dog", None), (35, DE * 4000, None)]
    return spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")


def test_languages(spark):
    df = labelled(spark)
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(df, langid.train(df)).collect()]
    by = {d: (p, s) for d, p, s in got}
    assert len(got) == df.count() and all(0 <= s <= 1 for _, _, s in got)
    assert by[30] == by[31] == by[32] == ("und", 0.0)
    assert by[33][0] == "de" and by[34][0] == "en" and by[35][0] == "de" and by[0][0] == "en" and by[20][0] == "de"
    assert len([1 for d, _, _ in got if d == 34]) == 2
    assert langid.identify(df, {}).where("lang_pred <> 'und'").count() == 0
    assert langid.identify(df.limit(0), langid.train(df.limit(0))).count() == 0


def test_language_bundles_are_the_sums_of_their_grams():
    text = "Ab  c-ab"
    vectors = langid.bundles([text.encode()])[0]
    padded = " ab c ab "
    want = sum(langid.gram_vector(tuple(map(ord, padded[i : i + 3]))).astype(int) for i in range(len(padded) - 2))
    assert (vectors == want).all()


def brute_languages(rows):
    """(doc_id, language, cosine) by adding up one n-gram at a time."""

    @lru_cache(maxsize=None)
    def bound(gram):
        out = np.ones(langid.DIM, np.int64)
        for place, letter in enumerate(reversed(gram)):
            out *= np.roll(langid._letter_vector(ord(letter)), place)
        return out

    def bundle(text):
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        padded = f" {' '.join(words)} " if words else ""
        grams = Counter(padded[i : i + 3] for i in range(len(padded) - 2))
        return sum((n * bound(g) for g, n in grams.items()), np.zeros(langid.DIM, np.int64))

    vectors = [bundle(t) for _, t, _ in rows]
    own = {}
    for v, (_, _, lang) in zip(vectors, rows, strict=True):
        if lang is not None and v.any():
            own[lang] = own.get(lang, 0) + v
    out = []
    for v, (doc, _, _) in zip(vectors, rows, strict=True):
        cosines = {k: float(v @ own[k]) / math.sqrt(float(v @ v) * float(own[k] @ own[k])) for k in sorted(own)} if v.any() else {}
        best = max(cosines, key=cosines.get) if cosines else "und"
        out.append((doc, best, round(min(1.0, max(0.0, cosines.get(best, 0.0))), 9)))
    return sorted(out)


def test_languages_of_a_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(r.doc_id + 1000, r.text, r.lang) for r in labelled(spark).collect() if r.doc_id != 35] + [(2000, "漢字の文", "ja"), (2001, "字の漢字", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.identify(df, langid.train(df)).collect())
    assert got == brute_languages(rows)


def test_short_texts_of_many_letters_need_little_memory():
    import tracemalloc

    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9FFF, 20))).encode() for _ in range(1500)]
    batch = pa.record_batch({"text": pa.array([t.decode() for t in texts])})
    tracemalloc.start()
    for _, _, part in langid.chunks(batch, "text", rows=langid._TEXTS):
        assert len(langid.bundles(part)) == len(part) <= langid._TEXTS
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20


def test_keep_known_keeps_columns_and_short_texts(spark):
    df = labelled(spark)
    kept = langid.keep_known(df.union(spark.createDataFrame([(50, "ξένη γλώσσα " * 60, None, "x", 0.5)], df.schema)), langid.train(df))
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == df.columns and {30, 31, 32, 50}.isdisjoint(ids) and {0, 12, 33, 34, 35} <= ids


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    judged = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out(F.col("doc_id")))
    right, n = judged.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 100 and right > 0.98


TEXTS = ["", " ", "  two  spaces ", "Hello world", "a▁b", "日本語 😀 テスト", "\x00\x01", "tab\tnew\nline", "ﬁ ligature", "x" * 5000, "é" * 300]


def test_sentencepiece_is_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate([*TEXTS, None])], "doc_id long, text string, ids int")
    for r in sptok.encode(df, MODEL).collect():
        text = ([*TEXTS, None][r.doc_id]) or ""
        ids = model.encode(text, add_bos=True, add_eos=True)
        assert list(r.ids) == ids and r.decoded == model.decode(ids) and bytes(r.ids_le) == struct.pack(f"<{len(ids)}I", *ids)
        raw = text.encode()
        assert b"".join(raw[a:b] for a, b in zip(r.begins, r.ends, strict=True)) == raw and r.n_bytes_spanned == len(raw)
        assert r.spans_sha256 == hashlib.sha256(struct.pack(f"<{2 * len(ids)}Q", *r.begins, *r.ends)).hexdigest()
    for r in sptok.encode(df, MODEL, digests=True).collect():
        ids = model.encode(([*TEXTS, None][r.doc_id]) or "", add_bos=True, add_eos=True)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    assert sptok.encode(df.limit(0), MODEL).collect() == []


class Spec:
    add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces, precompiled_charsmap = True, True, True, b""


def trie(keys: dict[bytes, bytes]) -> bytes:
    """A double-array trie for a test, one unit for each node, children at offset XOR byte."""
    values, at = b"", {}
    for k, v in keys.items():
        at[k] = len(values)
        values += v + b"\0"
    units, used, nodes = [0] * 4096, {0}, {}
    prefixes = sorted({k[:i] for k in keys for i in range(len(k) + 1)}, key=len)
    nodes[b""] = 0
    for p in prefixes:
        below = sorted({k[len(p)] for k in keys if k.startswith(p) and len(k) > len(p)})
        wanted = [0, *below] if p in keys else below
        if not wanted:
            continue
        place = nodes[p]
        offset = next(o for o in range(1, 1024) if all((place ^ o ^ b) not in used and (place ^ o ^ b) < 4096 for b in wanted))
        label = p[-1] if p else 0
        units[place] = (units[place] & 0xFF) | (offset << 10) | ((1 << 8) if p in keys else 0) | label
        for b in wanted:
            spot = place ^ offset ^ b
            used.add(spot)
            if b == 0 and p in keys:
                units[spot] = at[p] | 0x80000000
            else:
                nodes[p + bytes([b])] = spot
                units[spot] = b
    blob = struct.pack("<4096I", *units)
    return struct.pack("<I", len(blob)) + blob + values


def test_normaliser_takes_the_longest_prefix_and_records_its_source():
    class Mapped(Spec):
        precompiled_charsmap = trie({"ﬁ".encode(): b"fi", b"A": b"a", b"AB": b"xyz"})

    normal, source = sptok.Normaliser(Mapped)("  ﬁA AB ".encode())
    assert normal == "▁fia▁xyz".encode()
    assert source[3:8].tolist() == [2, 2, 5, 6, 6] and source.tolist()[-4:-1] == [7, 7, 7] and len(source) == len(normal) + 1
    assert sptok.Normaliser(Mapped)(b"   ")[0] == b""


@given(st.text(st.one_of(st.sampled_from(list("  \n▁aeihnorst.,é漢<0xs>/")), st.characters(codec="utf-8"))))
@settings(max_examples=400, deadline=None)
def test_merges_are_the_library_s(text):
    coder = sptok.encoder(MODEL)
    normal, source = coder.normaliser(text.encode())
    ids = coder.ids(text.encode(), normal)
    assert coder.merges and ids == coder.model.encode(text, add_bos=True, add_eos=True)
    begins, ends = coder.spans(text.encode(), np.array(ids), normal, source)
    assert b"".join(text.encode()[a:b] for a, b in zip(begins, ends, strict=True)) == text.encode()


def test_merges_of_real_and_long_texts(spark):
    coder = sptok.encoder(MODEL)
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in [*texts, "漢字かな交じり文" * 3000, "abcdefgh" * 5000, " " * 3000 + "x"]:
        assert coder.ids(text.encode(), coder.normaliser(text.encode())[0]) == coder.model.encode(text, add_bos=True, add_eos=True)


def test_spans_of_a_model_with_a_character_map(spark, tmp_path):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=MODEL).serialized_model_proto())
    proto.normalizer_spec.precompiled_charsmap = trie({"ﬁ".encode(): b"fi", b"A": b"a", b"AB": b"xyz", b"\t": b" "})
    proto.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "mapped.model"
    path.write_bytes(proto.SerializeToString())
    model = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["the ﬁsh", "  A  river\tAB end  ", "ABA ﬁﬁ", "", "   ", "plain words"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in sptok.encode(df, str(path)).collect():
        text = texts[r.doc_id]
        assert list(r.ids) == model.encode(text, add_bos=True, add_eos=True)
        want = [(p.begin, p.end) for p in model.encode(text, return_type="proto").pieces]
        assert list(zip(r.begins, r.ends, strict=True))[1:-1] == want, text


def brute_score(words, c, model):
    """log10 probability of one text, token by token, from the model's arrays and the training counts."""
    heads = {int(h): i for i, h in enumerate(model.heads)}
    n_classes = model.emit.shape[1] - 1 - len(heads)
    hashes = hmm_lm.tokens([" ".join(w for w in words if w).encode()])[0]
    known = Counter()
    for w, n in c.items():
        h = hmm_lm.END if w is None else hmm_lm.tokens([w.encode()])[0][0]
        if int(h) not in heads:
            k = int(hmm_lm.class_of(np.array([h]), n_classes)[0])
            known[k, "n"] += n
            known[k, "v"] += 1
    total, state = 0.0, None
    for w, h in zip(words, hashes, strict=True):
        k = n_classes + 1 + heads[int(h)] if int(h) in heads else int(hmm_lm.class_of(np.array([h]), n_classes)[0])
        state = (model.start if state is None else state @ model.move) * model.emit[:, k]
        total += math.log10(state.sum())
        state = state / state.sum()
        if int(h) not in heads:
            total += math.log10((c[w] + 1) / (known[k, "n"] + known[k, "v"] + (k < n_classes)))
    return total


def test_hmm_counts_and_base_against_brute_force(spark):
    texts = {0: "the cat sat", 1: "THE dog", 2: None, 3: "", 4: "cat cat cat bird", 5: "unseen words here the", 6: "the " * 3000, 8: "dog cat"}
    rows = [(i, t) for i, t in texts.items()] + [(8, "dog cat")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, c int")
    train = df.where("doc_id <> 5")
    counts = hmm_lm.count_words(train)
    model = hmm_lm.fit(train, counts, states=3, rounds=2)
    got = hmm_lm.score(df, counts, model).collect()
    split = lambda t: [*(t or "").lower().split(), None]
    c = Counter(w for i, t in rows if i != 5 for w in split(t))
    n, v = sum(c.values()), len(c)
    assert len(got) == len(rows)
    for r in got:
        words = split(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(c[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words))
        assert r.score == pytest.approx(brute_score(words, c, model), rel=1e-6)
    same = [r.score for r in got if r.doc_id == 8]
    assert same[0] == pytest.approx(same[1])
    none = hmm_lm.score(df, hmm_lm.count_words(train.limit(0)), hmm_lm.fit(train.limit(0), hmm_lm.count_words(train.limit(0)))).collect()
    assert {r.train_tokens for r in none} == {0} and {r.n_known for r in none} == {0} and all(math.isfinite(r.score) for r in none)
    assert hmm_lm.score(df.limit(0), counts, hmm_lm.fit(train, counts, rounds=1)).collect() == []


def test_frequent_and_joined_counts_agree(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = hmm_lm.count_words(docs)
    model = hmm_lm.fit(docs, counts, states=2, rounds=1)
    sent = {r.doc_id: (r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in hmm_lm.score(docs, counts, model).collect()}
    monkeypatch.setattr(hmm_lm, "SENT_WORDS", 10)
    assert sent == {r.doc_id: (r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in hmm_lm.score(docs, counts, model).collect()}


def paths(obs, model):
    """(likelihood, expected starts, moves and emissions) by summing over all state paths."""
    from itertools import product

    k, total = len(model.start), 0.0
    start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros(model.emit.shape)
    for path in product(range(k), repeat=len(obs)):
        p = model.start[path[0]] * model.emit[path[0], obs[0]]
        for a, b, o in zip(path, path[1:], obs[1:], strict=False):
            p *= model.move[a, b] * model.emit[b, o]
        total += p
        start[path[0]] += p
        for a, b in zip(path, path[1:], strict=False):
            move[a, b] += p
        for s, o in zip(path, obs, strict=True):
            emit[s, o] += p
    return total, start / total, move / total, emit / total


def test_forward_and_baum_welch_against_all_paths():
    rng = np.random.default_rng(2)
    draw = lambda *s: (lambda x: x / x.sum(axis=-1, keepdims=True))(rng.random(s))
    none = np.zeros(0, np.uint64)
    model = hmm_lm.Model(draw(3), draw(3, 3), draw(3, 5), np.zeros(5), none)
    length = np.array([4, 1, 6])
    obs = rng.integers(0, 5, length.sum())
    parts = np.split(obs, np.cumsum(length)[:-1])
    want = [paths(p.tolist(), model) for p in parts]
    assert np.allclose(hmm_lm.log_likelihood(obs, length, model), np.log([w[0] for w in want]))
    for block in (100, 4, 2, 1):  # whole texts, however few tokens are held at once
        start, move, emit, total = hmm_lm.expectations(obs, length, model, block)
        assert np.allclose(start, sum(w[1] for w in want), atol=1e-5) and np.allclose(move, sum(w[2] for w in want), atol=1e-5) and np.allclose(emit, sum(w[3] for w in want), atol=1e-5)
        assert total == pytest.approx(sum(math.log(w[0]) for w in want), abs=1e-4)


def test_states_tell_frequent_words_apart():
    words = hmm_lm.tokens([b"a b c d"])[0][:4]
    heads = np.sort(words[:2])
    model = hmm_lm.Model(np.ones(1), np.ones((1, 1)), np.ones((1, 7 + 1 + 2)), np.zeros(10), heads)
    got = model.symbols(np.concatenate([words, [hmm_lm.END]]))
    assert set(got[:2].tolist()) == {8, 9} and got[4] == 7 and (got[2:4] < 7).all()


def test_held_out_texts_gain_over_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = docs.where(~hmm_lm.held_out(F.col("doc_id")))
    counts = hmm_lm.count_words(train)
    scored = hmm_lm.score(docs.where(hmm_lm.held_out(F.col("doc_id"))), counts, hmm_lm.fit(train, counts))
    gain = scored.agg((F.sum("score") - F.sum("base_score")) / F.sum("n_tokens")).first()[0]
    print("held-out gain", gain)
    assert gain > 0.13


def test_probabilities_of_all_short_texts_sum_to_one():
    """Over words of a known vocabulary, unseen ones as one symbol a class, texts of up to two words and longer ones add up."""
    rng = np.random.default_rng(3)
    emit = rng.random((2, 4))
    emit /= emit.sum(axis=1, keepdims=True)
    model = hmm_lm.Model(np.array([0.3, 0.7]), np.array([[0.6, 0.4], [0.1, 0.9]]), emit, np.zeros(4), np.zeros(0, np.uint64))
    end = 3
    ended = sum(math.exp(hmm_lm.log_likelihood(np.array([*w, end]), np.array([len(w) + 1]), model)[0]) for w in [()] + [(a,) for a in range(3)] + [(a, b) for a in range(3) for b in range(3)])
    running = sum(math.exp(hmm_lm.log_likelihood(np.array([a, b, c]), np.array([3]), model)[0]) for a in range(3) for b in range(3) for c in range(3))
    assert ended + running == pytest.approx(1)


def test_held_out_rule(spark):
    ids = spark.range(200)
    got = {r.id for r in ids.where(hmm_lm.held_out(F.col("id"))).collect()}
    assert got == {i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2}


def test_word_hashes():
    texts = ["One two\tTHREE", None, "", "two  one\x0bé É", "a" * 400 + " a"]
    h, size = word_hashes([t.encode() if t is not None else None for t in texts])
    words = [w for t in texts for w in (t or "").encode().lower().split()]
    assert len(h) == len(words) and size.tolist() == [3, 0, 0, 4, 2]
    assert len(set(zip(words, h.tolist(), strict=True))) == len(set(words)) == len(set(h.tolist()))
