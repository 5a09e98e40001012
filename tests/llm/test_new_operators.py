from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionloom.llm import resample, spelling, substring_dedup

DOC = "doc_id long, text string, h long, key string, Begin int, word string"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, 1, "k", 2, "w") for d, t in rows], DOC)


# --- spelling ---------------------------------------------------------------------------------------------------------


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, least_chars=7, least_n=2, times=10):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_n}
    form, near = {}, {}
    for w, n in words.items():
        others = [v for v in words if one_edit(v, w)]
        near[w] = len(others)
        best = min(others, key=lambda v: (-words[v], v), default=None)
        best = min((v for v in others if words[v] == words[best]), default=None) if best else None
        form[w] = best if best and words[best] >= times * n else None
    out = []
    for w, n in words.items():
        root = w
        while form.get(root):
            root = form[root]
        out.append((w, form[w], root, n, near[w], words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def found_variants(df, **how):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df, **how).collect()), key=str)


def test_variants_against_brute_force(spark):
    rng = random.Random(5)
    base = ["anomaly", "banality", "cardinal", "Überfluß", "élégante", "aabbaabb", "mississippi"]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(base[: 1 + i % len(base)])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abñ") + w[k:], w[:k] + rng.choice("abÑ") + w[k + 1 :], w.upper(), w[:k] + w[k : k + 2][::-1] + w[k + 2 :]])
            words.append(w)
        rows.append((i, rng.choice([" ", "\n", "-", "1"]).join(words)))
    long = "".join(rng.choice("abcdefgh") for _ in range(300))
    rows += [(900, f"{long} {long} {long[:150] + long[151:]}"), (901, f"{long[:150] + long[151:]} {long[:5]}z{long[6:]}"), (902, f"{long[:5]}z{long[6:]}")]
    rows += [(905, " ".join(["x" * 63, "x" * 64, "x" * 65, "x" * 66] * 2))]
    rows += [(903, None), (904, ""), (None, "anomaly anomalx anomalx"), (7, rows[7][1]), (7, rows[7][1])]
    df = documents(spark, rows)
    want = brute_variants(rows)
    assert found_variants(df) == want
    assert any(r[1] for r in want)
    assert found_variants(df, times=2) == brute_variants(rows, times=2)  # longer chains
    assert found_variants(df, least_chars=3, least_n=1) == brute_variants(rows, 3, 1)


def test_chains_of_forms_and_no_words(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w12"), ("y", "z")], "word string, form string")
    got = {r.word: r.root for r in spelling.roots(chain).collect()}
    assert got == {**{f"w{i}": "w13" for i in range(13)}, "x": "w13", "y": "z"}
    assert spelling.variants(documents(spark, [])).collect() == []
    assert spelling.variants(documents(spark, [(1, None), (2, "too few of it")])).collect() == []


def test_a_pair_shares_one_key():
    rng = random.Random(8)
    made = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(300)})
    place, key = spelling.deletion_keys(made)
    held = defaultdict(Counter)
    for p, k in zip(place.tolist(), key.tolist()):
        held[made[p]][k] += 1
    for w in made:
        assert max(held[w].values()) == 1
        assert len(held[w]) == 1 + len({w[:i] + w[i + 1 :] for i in range(len(w))})
    for a in made:
        for b in made:
            if one_edit(a, b):
                assert len(held[a].keys() & held[b].keys()) == 1


# --- substring dedup --------------------------------------------------------------------------------------------------


def brute_repeats(rows, length=13):
    words = [(-(2**63) if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    least = {}
    for d, w in words:
        for i in range(len(w) - length + 1):
            g = tuple(w[i : i + length])
            least[g] = min(least.get(g, d), d)
    out = []
    for (doc, _), (d, w) in zip(rows, words, strict=True):
        gone = {j for i in range(len(w) - length + 1) if least[tuple(w[i : i + length])] < d for j in range(i, i + length)}
        spans = []
        for j in sorted(gone):
            if spans and spans[-1][1] == j:
                spans[-1] = (spans[-1][0], j + 1)
            else:
                spans.append((j, j + 1))
        out.append((doc, len(w), len(gone), tuple(spans), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def found_repeats(df, length=13):
    return sorted(((r.doc_id, r.n_words, r.n_removed, tuple((s.start, s.stop) for s in r.spans), r.kept) for r in substring_dedup.remove_repeats(df, length).collect()), key=str)


def passages(rng):
    shared = [" ".join(f"p{k}w{rng.randint(0, 30)}" for _ in range(rng.randint(11, 40))) for k in range(6)]
    rows = []
    for i in range(90):
        parts = []
        for _ in range(rng.randint(0, 4)):
            text = rng.choice(shared).split() if rng.random() < 0.6 else [f"own{rng.randint(0, 4)}" for _ in range(rng.randint(1, 30))]
            if rng.random() < 0.4:
                text[rng.randrange(len(text))] = f"changed{rng.randint(0, 3)}"
            if rng.random() < 0.3:
                text = text[rng.randint(0, 5) :]
            parts.append((" " if rng.random() < 0.9 else " ").join(text))
        rows.append((rng.randint(0, 70), rng.choice([" ", "\n\t", "  "]).join(parts)))
    rows += [(500, "same " * 60), (501, "same " * 20 + "other " + "same " * 30), (502, "Same " * 20), (503, None), (504, ""), (505, " \t ")]
    return rows + [(None, shared[0]), (None, shared[0] + " tail"), (506, shared[0]), rows[3], rows[3]]


@pytest.mark.parametrize("length", [13, 1, 5, 6, 20])
def test_repeats_against_brute_force(spark, length):
    rows = passages(random.Random(length))
    want = brute_repeats(rows, length)
    assert any(r[2] for r in want)
    assert found_repeats(documents(spark, rows), length) == want


def test_repeats_of_long_texts_and_no_rows(spark):
    rng = random.Random(2)
    long = " ".join(f"w{rng.randint(0, 5000)}" for _ in range(400_000))  # several pieces
    middle = " ".join(long.split()[200_000:200_300])
    rows = [(2, long), (1, f"before {middle} behind"), (3, long[:100_000])]
    assert found_repeats(documents(spark, rows)) == brute_repeats(rows)
    assert found_repeats(documents(spark, [])) == []


def test_a_filter_that_holds_all_changes_nothing(spark, monkeypatch):
    rows = passages(random.Random(4))
    monkeypatch.setattr(substring_dedup, "membership", lambda held: lambda ids: np.ones(len(ids), bool))
    assert found_repeats(documents(spark, rows)) == brute_repeats(rows)


# --- resampling -------------------------------------------------------------------------------------------------------


def brute_features(text, size=2):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
    return w, [zlib.crc32(" ".join(w[i : i + k]).encode()) for k in range(1, size + 1) for i in range(len(w) - k + 1)]


def brute_sample(rows, target, size=2, buckets=10_000, least=20, percent=25):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(c % buckets for c in brute_features(text, size)[1])
    for text in target:
        t.update(c % buckets for c in brute_features(text, size)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)]
    out = []
    for doc, text in rows:
        w, f = brute_features(text, size)
        weight = sum(gain[c % buckets] for c in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = {id(r): i + 1 for i, r in enumerate(order[: percent * len(order) // 100])}
    return sorted(((*r, rank.get(id(r))) for r in out), key=str)


def found_sample(spark, df, target, **how):
    goal = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, row string")
    return sorted((tuple(r) for r in resample.resample(df, goal, **how).collect()), key=str)


def sample_rows(rng, n=150):
    words = ["alpha", "Beta", "gamma", "été", "日本", "x1", "42", "w" * 70, "z" * 200, "_"]
    rows = [(rng.randint(0, 100), rng.choice([" ", ". ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for _ in range(n)]
    rows += [(200, None), (201, ""), (202, " ., "), (None, "alpha beta " * 30), (None, "alpha beta " * 30)]
    return rows


@pytest.mark.parametrize("size", [1, 2, 3])
def test_sample_against_brute_force(spark, monkeypatch, size):
    rng = random.Random(size)
    rows, target = sample_rows(rng), ["alpha gamma", None, "", "été 42 alpha gamma"]
    assert found_sample(spark, documents(spark, rows), target, size=size) == brute_sample(rows, target, size)
    monkeypatch.setattr(resample, "CHUNK_BYTES", 16)
    chunked = resample.resample(documents(spark, rows), documents(spark, [(i, t) for i, t in enumerate(target)]), size=size)
    assert sorted((tuple(r) for r in chunked.collect()), key=str) == brute_sample(rows, target, size)


def test_chunks_own_each_feature_once(spark):
    rng = random.Random(1)
    rows = [(1, " ".join(rng.choice(["one", "two", "three", ".", "four", "x" * 40_000]) for _ in range(60_000 if i else 30))) for i in range(2)]
    target = ["one two"]
    assert found_sample(spark, documents(spark, rows), target, size=3) == brute_sample(rows, target, 3)


def test_sample_of_no_rows_and_no_target(spark):
    assert found_sample(spark, documents(spark, []), ["a b"]) == []
    rows = sample_rows(random.Random(9), 40)
    assert found_sample(spark, documents(spark, rows), []) == brute_sample(rows, [])
    same = [(i, "alpha beta gamma " * 10) for i in range(50)] * 2  # equal weights, repeated ids
    got = found_sample(spark, documents(spark, same), ["alpha"])
    assert sorted(r[5] for r in got if r[5]) == list(range(1, 26)) and [r[:5] for r in got] == [r[:5] for r in brute_sample(same, ["alpha"])]


def test_words_are_counted_across_tasks(spark):
    rows = [(i, "lantern lantern") for i in range(40)]
    df = documents(spark, rows).repartition(7, F.col("doc_id"))
    assert found_variants(df) == brute_variants(rows)
