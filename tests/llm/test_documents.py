from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ionloom.llm import decontam, graph, license_scan, ngram_join


def shingles(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def brute_components(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    small = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return sorted(((d, len(sets[i]), small[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def documents(seed: int, families: int, copies: int):
    """Families of edited copies, some chained by many edits, some that only share a passage."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randint(0, 400))
    passage = [word() for _ in range(30)]
    rows, i = [], 0
    for _ in range(families):
        base = [word() for _ in range(rng.randint(20, 90))] + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                base = text  # the next copies drift away from the first
            rows.append((i, " ".join(text)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("block", "seed"), [(256, 1), (3, 2), (5, 3)])
def test_components_against_brute_force(spark, monkeypatch, block, seed):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    monkeypatch.setattr(ngram_join, "LOCAL_BYTES", 6000)
    rows = documents(seed, 25, 14)
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "two words"), (904, "TWO\x0bwords"), (905, "two words more"), (906, "w " * 30_000), (907, rows[0][1]), (None, rows[0][1])]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n long, label string").repartition(5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link_components(df).collect()), key=str)
    assert got == brute_components(rows)


def test_components_of_repeated_ids_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(5, text), (5, "other text entirely of six"), (3, text), (5, text)], "doc_id long, text string")
    assert sorted(tuple(r) for r in ngram_join.link_components(df).collect()) == [(3, 37, 3), (5, 2, 5), (5, 37, 3), (5, 37, 3)]
    assert ngram_join.link_components(df.limit(0)).collect() == []


def test_graph_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(30)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)] + [(7, 7)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    for a, b in edges:
        assert got[a] == got[b] if a != b else True
    assert len(set(got.values())) == len({find(n) for n in got})
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_matches(docs, items, percent=80):
    norm = lambda t: [w for w in re.sub(r"[\W_]+", " ", (t or "").lower()).split(" ") if w]
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
    out = {}
    for d, t in docs:
        g = grams(norm(t))
        for i, x in items:
            h = grams(norm(x))
            if not h or not g:
                continue
            for s in range(max(1, len(g) - len(h) + 1)):
                win = g[s : s + len(h)]
                a, b = Counter(win), Counter(h)
                shared = sum((a & b).values())
                if 100 * shared >= percent * (len(win) + len(h) - shared):
                    sim = shared / (len(win) + len(h) - shared)
                    out[d, i] = max(out.get((d, i), 0), round(sim, 9))
    return out


def test_decontamination_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("klmnop") + str(rng.randint(0, 300))
    items = [(i, " ".join(word() for _ in range(rng.choice([12, 25, 40])))) for i in range(12)]
    items += [(20, "short item"), (21, None), (22, ""), (23, "again and again and again and again and again and again and again"), (0, items[0][1])]
    docs = []
    for i in range(60):
        text = [word() for _ in range(rng.randint(0, 120))]
        passage = rng.choice(items[:12])[1].split(" ")
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(passage))
            passage[k : k + 1] = rng.choice([[], [word()], [passage[k], word()]])
        at = rng.randint(0, len(text))
        docs.append((i, ", ".join(text[:at]) + " . " + " ".join(passage).upper() + "\n" + " ".join(text[at:])))
    docs += [(70, None), (71, ""), (72, "...!"), (73, "Short ITEM."), (74, items[13][1] if items[13][1] else "x"), (75, items[15][1]), (76, "z " * 30_000 + items[2][1]), (None, items[1][1]), (77, items[1][1]), (77, items[3][1])]
    df = spark.createDataFrame([(d, t, 1, "p") for d, t in docs], "doc_id long, text string, n int, print string")
    bench = spark.createDataFrame([(i, t, "e") for i, t in items], "item_id long, text string, extra string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontam.matches(df, bench).collect()}
    want = brute_matches(docs, items)
    assert {k: v for k, v in want.items() if v >= 0.8} == got and len(got) > 20
    assert decontam.matches(df.limit(0), bench).collect() == [] and decontam.matches(df, bench.limit(0)).collect() == []
    unbounded = {(r.doc_id, r.item_id) for r in decontam.matches(df, bench).collect()}
    assert unbounded == set(got)


def test_decontamination_finds_moved_parts(spark):
    words = lambda k, n: " ".join(f"{k}x{i}" for i in range(n))
    a, b = words("a", 60), words("b", 60)
    texts = {0: f"{words('c', 200)} {a} {b} {words('d', 200)}", 1: f"{words('c', 200)} {b} {a} {words('d', 200)}", 2: f"{b} {a}", 3: f"{a} {words('e', 60)}", 4: f"{words('f', 9)} {b} {a} {words('g', 3)}"}
    items = [(1, f"{a} {b}"), (2, f"{words('e', 9)} {a}"), (3, f"{b[: len(b) // 2]} {a}")]
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontam.matches(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute_matches(texts.items(), items) and {(0, 1), (1, 1), (2, 1), (4, 1)} <= set(got)


def test_decontamination_recall_at_the_limit(spark):
    """Edited passages whose similarity is just above 0.8: all are found, which the fingerprints' radius doesn't prove."""
    rng = random.Random(11)
    items, docs = [], []
    for i in range(300):
        n = (13, 22, 40)[i % 3]
        words = [f"i{i}w{k}" for k in range(n + 4)]
        items.append((i, " ".join(words)))
        text = list(words)
        text[-1 if rng.random() < 0.5 else 0] = "edited"
        far = 2 if n >= 40 else 1
        for k in range(1, far + (n == 22)):
            text[-1 - k if text[-1] == "edited" else k] = f"more{k}"
        docs.append((i, " ".join([f"d{i}w{k}" for k in range(30)] + text + [f"e{i}w{k}" for k in range(30)])))
    want = {k for k, v in brute_matches_own(docs, items).items() if v >= 0.8}
    got = {(r.doc_id, r.item_id) for r in decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and len(want) == 300


def brute_matches_own(docs, items):
    """Each document against the item of its number."""
    out = {}
    for d, i in zip(docs, items, strict=True):
        out |= brute_matches([d], [i])
    return out


def test_decontamination_with_shuffled_item_tables(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    sent = sorted(map(tuple, decontam.matches(docs, bench).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert sent == sorted(map(tuple, decontam.matches(docs, bench).collect()))


def test_decontamination_plan_has_no_python(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontam.matches(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


MIT = """Some text before.

MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""


def test_licences(spark):
    texts = {
        0: MIT, 1: "A.\nLicensed under the Apache License, Version 2.0.\nMore text.", 2: "text. This work is licensed under the GNU General Public License, version 3. tail", 3: None, 4: "", 5: "All rights reserved.",
        6: "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", 7: "The MIT License is mentioned here only", 8: "word " * 50_000 + ". Licensed under CC BY 4.0.",
        9: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    }
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()] + [(6, texts[6], "y", 2)], "doc_id long, text string, rule string, known int")
    got = Counter((r.doc_id, r.licence, r.rule) for r in license_scan.scan(df).collect())
    assert got == Counter({
        (0, "MIT", "mit_name+mit_grant+mit_notice"): 1, (1, "Apache-2.0", "apache_short"): 1, (2, "GPL-3.0", "gpl3_work"): 1,
        (6, "MIT", "mit_release"): 2, (6, "CC-BY-NC-4.0", "ccbync_short"): 2, (8, "CC-BY-4.0", "ccby_short"): 1,
    })
    assert license_scan.scan(df.limit(0)).collect() == []
    own = license_scan.scan(df, {"all": "All rights reserved."}, {"none": [["all"]]})
    assert [tuple(r) for r in own.collect()] == [(5, "none", "all", 1)]


HEADERS = {
    "GPL-2.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Apache-2.0": """Copyright 2020 Somebody
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "MIT": MIT,
}
HEADERS["GPL-3.0"] = HEADERS["GPL-2.0"].replace("Foundation; either version 2", "Foundation, either version 3")
HEADERS["LGPL-3.0"] = HEADERS["GPL-3.0"].replace("General", "Lesser General")
HEADERS["AGPL-3.0"] = HEADERS["GPL-3.0"].replace("General", "Affero General")
HEADERS["LGPL-2.1"] = HEADERS["GPL-2.0"].replace("General", "Lesser General").replace("program is free software:", "library is free software;").replace("version 2 ", "version 2.1 ")


def test_wrapped_notices_and_comments(spark):
    import textwrap

    for name, rules in license_scan.RULES.items():  # every rule of the others as sentences, wrapped
        HEADERS.setdefault(name, "\n".join(textwrap.fill(license_scan.SENTENCES[x], 50) for x in rules[0]))
    rows, want = [], set()
    for k, lead in enumerate(("", " * ", "// ", "# ", "dnl ", ";; ", "-- ")):
        for i, (name, text) in enumerate(HEADERS.items()):
            rows.append((100 * k + i, "/*\n" * (k == 1) + "\n".join((lead + line).rstrip() for line in text.split("\n")) + "\n */" * (k == 1)))
            want.add((100 * k + i, name))
    got = {(r.doc_id, r.licence) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
    whole = {(r.doc_id, r.rule) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (2, "apache_named+apache_comply+apache_copy+apache_asis+apache_see") in whole


BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""


def test_longest_rule_wins_and_gaps_are_bounded(spark):
    gap = lambda n: MIT.replace("The above copyright", " ".join(f"Unknown sentence {i}." for i in range(n)) + " The above copyright")
    two = BSD3[: BSD3.index("3. Neither")]
    listed = lambda t: t.replace("1. ", " * ").replace("2. ", " * ").replace("3. ", " * ")
    texts = [BSD3, two, f"{BSD3}\n\nLicensed under CC BY-SA 3.0.\n{two}", gap(2), gap(500), "\n".join("# " + x for x in listed(BSD3).split("\n")), listed(two), f"{MIT}\nReleased under the MIT License.\n"]
    got = defaultdict(set)
    for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        got[r.doc_id].add(r.licence)
    assert got == {0: {"BSD-3-Clause"}, 1: {"BSD-2-Clause"}, 2: {"BSD-3-Clause", "CC-BY-SA-3.0", "BSD-2-Clause"}, 3: {"MIT"}, 5: {"BSD-3-Clause"}, 6: {"BSD-2-Clause"}, 7: {"MIT"}}
    assert len(license_scan.RULES) >= 40


def test_licences_against_brute_force(spark):
    """Random sequences of sentences against a plain walk over them."""
    rng = random.Random(3)
    names = list(license_scan.SENTENCES)
    whole = [n for n in names if len(license_scan.split_known(license_scan.SENTENCES[n])) == 1]
    rules = [(k, r) for k, options in license_scan.RULES.items() for r in options if set(r) <= set(whole)]
    docs, want = [], Counter()
    for i in range(80):
        seq = []
        for _ in range(rng.randint(0, 4)):
            seq += rng.choice(rules)[1][: rng.randint(1, 5)] + ["?"] * rng.choice([0, 1, 3, 4, 9])
        docs.append((i, " ".join("Some other words here." if n == "?" else license_scan.SENTENCES[n].rstrip(".:;,") + "." for n in seq)))
        known = [(s, license_scan.split_known(license_scan.SENTENCES[n])[0]) for s, n in enumerate(seq) if n != "?"]
        spans = []
        for k, r in rules:
            forms = [license_scan.split_known(license_scan.SENTENCES[n])[0] for n in r]
            for at in range(len(known) - len(r) + 1):
                part = known[at : at + len(r)]
                if [f for _, f in part] == forms and all(b[0] - a[0] <= 4 for a, b in zip(part, part[1:], strict=False)):
                    spans.append((at, at + len(r), k, "+".join(r)))
        best = {}
        for a, b, k, r in spans:
            if not any(c <= a and b <= d and d - c > b - a for c, d, _, _ in spans) and b - a > best.get(k, (0, ""))[0]:
                best[k] = (b - a, r)
        want.update((i, k, r, len(known)) for k, (_, r) in best.items())
    got = Counter(tuple(r) for r in license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "licence", "rule", "n_sentences").collect())
    assert got == want and len(want) > 60


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    state = docs
    before = {r.doc_id: r for r in docs.collect()}
    state = pipeline.STAGES[0][1](spark, docs, source)
    assert state.columns == docs.columns
    known = {r.doc_id for r in state.collect()}
    assert known == {i for i, r in before.items() if re.search(r"[^\W\d_]", r.text or "")}
    from tests.llm.test_line_and_topk import brute_lines

    lined = {r.doc_id: r for r in pipeline.STAGES[1][1](spark, state, source).collect()}
    rows = [(i, before[i].text) for i in known]
    assert {i: r.text for i, r in lined.items()} == {d: t for d, _, _, t in brute_lines(rows)}
    assert all(r.n_chars == len(r.text) or r.text == before[i].text for i, r in lined.items())
    frame = spark.createDataFrame(list(lined.values()), docs.schema)
    near = {r.doc_id for r in pipeline.STAGES[2][1](spark, frame, source).collect()}
    assert near == {d for d, _, c in brute_components([(i, r.text) for i, r in lined.items()]) if d == c}
    left = pipeline.STAGES[3][1](spark, frame.where(F.col("doc_id").isin(*near)), source)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{source}/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute_matches([(i, lined[i].text) for i in near], bench)}
    assert {r.doc_id for r in left.collect()} == near - leaks and leaks
    whole = {r.doc_id: r for r in pipeline.run(spark, source).collect()}
    assert set(whole) == near - leaks and all(len(r.ids) == r.n_tokens for r in whole.values())


def test_pipeline_on_odd_rows(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(1, "a few words that make a text here", "en", "s", 33, "x"), (1, "a few words that make a text here", "en", "s", 33, "y"), (2, None, None, None, None, None), (3, "", "en", "s", 0, "x"), (None, "other words of a text without an id", "en", "s", 35, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, gone_ string")
    docs = docs.withColumn("row_", F.lit(1)).withColumn("HELD_by_", F.lit(2)).withColumn("id_", F.lit("i")).withColumn("copy", F.lit(None).cast("string"))
    names = docs.columns
    spark.createDataFrame([(1, "words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == names
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "None"]
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0).select("doc_id", "text", "lang", "source", "n_chars"), str(tmp_path)).collect() == []


def brute_near(rows):
    """The ids that are the smallest of their component at 5 words and 0.8."""
    sets = {d: shingles(t, 5) for d, t in rows}
    label = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            shared = len(sets[a] & sets[b])
            if a < b and label[a] != label[b] and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((label[a], label[b]))
                label = {d: low if x == high else x for d, x in label.items()}
    return {d for d, x in label.items() if d == x}


def test_pipeline_near_copies_of_one_changed_word(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = []
    for k, n in enumerate((45, 48, 49, 50, 51, 52, 53, 60)):
        words = [f"k{k}w{i}" for i in range(n)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[: n // 2], "changed", *words[n // 2 + 1 :]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()}
    assert got == brute_near(rows) and not {5, 7, 9, 11} & got and {1, 3} < got


def test_pipeline_drops_rows_not_ids(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    text = lambda k: " ".join(f"{k}w{i}" for i in range(30))
    rows = [(1, text("a")), (None, text("a")), (None, text("b")), (2, text("c")), (2, text("a")), (None, text("d")), (None, text("d")), (3, text("e")), (3, text("f")), (None, text("f"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.createDataFrame([(1, text("e")), (2, text("b"))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    near = Counter(tuple(r) for r in pipeline.near_duplicates(spark, docs, str(tmp_path)).collect())
    assert near == Counter([(1, text("a")), (None, text("b")), (2, text("c")), (None, text("d")), (3, text("e")), (3, text("f"))])
    left = Counter(tuple(r) for r in pipeline.decontaminate(spark, docs, str(tmp_path)).collect())
    assert left == Counter(r for r in rows if r[1] not in (text("e"), text("b")))


def test_digest_of_sets_is_stable():
    assert ngram_join._digest(ngram_join.shingle_sets([b"A b c d e"], 4)[0]) == ngram_join._digest(ngram_join.shingle_sets([b"x", b"a  B\nc d e"], 4)[1])
    assert hashlib.blake2b(b"").digest()


def test_licences_in_texts_without_a_stop(spark):
    many = "\n".join(f"The list item number {i} of a long list that never ends" for i in range(400_000))
    rows = [(1, many), (2, "\n".join(["The MIT License (MIT)"] + ["The list item"] * 600 + ["Released under the", "MIT License"])), (3, "THE MIT LICENSE " * 200_000)]
    got = {(r.doc_id, r.licence) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(2, "MIT")}
