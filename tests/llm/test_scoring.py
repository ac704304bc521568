"""Quality rules, toxicity, perplexity and licences."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import licenses, perplexity, quality_rules, toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"


def prose(words, size, seed):
    return " ".join(random.Random(seed).choices(words, k=size))


COMMON = ["".join(random.Random(i).choices("aeinorst", k=5)) for i in range(400)]


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_base_counts(spark):
    texts = ["", None, " \n\t", "a b c a b c a b c", "a a a a a", "x\n y\nx\n\n x\n", "é😀 #*$ %&|<> \x0b z", "one two three\nfour one two three", "a b a b", "w " * 30_000, *[prose(["a", "b", "c", "d"], n, n) for n in range(3, 60, 5)]]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).selectExpr("*", "5 AS kept", "6 AS _words")
    got = quality_rules.quality(docs, spark.createDataFrame([], LABELS)).collect()
    assert {r.doc_id: tuple(r[c] for c in quality_rules.BASE) for r in got} == {i: base_counts(t) for i, t in enumerate(texts)}
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed) for r in got)
    assert got[0]._words == 6


def test_ratios_and_verdicts(spark):
    few = COMMON[:30]
    junk = [w + "%%%" for w in few]
    rows = [(i, prose(junk if i % 5 == 0 else few, 300, i), "en", "s", 0) for i in range(150)]
    docs, labels = spark.createDataFrame([*rows, rows[1]], DOCS), spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(0, 150, 2)] + [(None, 1, 0), (2, 0, 0)], LABELS)
    judged = quality_rules.quality(docs, labels)
    assert {(r.doc_id % 5 > 0, r.kept) for r in judged.collect()} == {(True, True), (False, False)}
    assert judged.where("kept").select("doc_id").count() == 121  # a filter must not undo the steps
    trusted = [r.doc_id for r in quality_rules.trusted_ids(labels).collect()]
    assert 2 not in trusted and None not in trusted and len(quality_rules.trusted_ids(labels, 7).collect()) == 7
    ratios = np.array(quality_rules.log_ratios(docs, quality_rules.trusted_ids(labels), buckets=64).first().ratios)
    from pyspark.sql import functions as F
    hashed = {w: h for w, h in spark.createDataFrame([(w,) for w in [*few, *junk]], "w string").select("w", F.xxhash64("w")).collect()}
    pairs = {p for _, t, *_ in rows for p in zip(t.split(), t.split()[1:])}
    both = {(a, b): h % 64 for a, b, h in spark.createDataFrame([(a, b, hashed[a], hashed[b]) for a, b in pairs], "a string, b string, x bigint, y bigint").select("a", "b", F.xxhash64("x", "y")).collect()}
    raw, target = np.zeros(64), np.zeros(64)
    for d, t, *_ in [*rows, rows[1]]:
        words = t.split()
        for k in [*(hashed[w] % 64 for w in words), *(both[p] for p in zip(words, words[1:]))]:
            raw[k] += 1
            target[k] += d in trusted
    share = raw / raw.sum()
    want = np.log((target + 4 * 64 * share) / (target.sum() + 4 * 64)) - np.log(share)
    assert np.allclose(ratios, want)


def test_quality_of_an_empty_table(spark):
    assert quality_rules.quality(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="module")
def insulted(spark):
    insults = ["grubnik", "zlomek", "vrakot", "pahmuz"]
    rows = []
    for i in range(400):
        words = random.Random(i).choices(COMMON, k=80)
        if i % 4 == 0:
            for k in range(4):
                words[random.Random(i + k).randrange(80)] = insults[(i // 4 + k) % 4]
        rows.append((i, " ".join(words), "en", "s", 0))
    return rows


def test_toxicity_on_held_out_rows(spark, insulted):
    docs = spark.createDataFrame(insulted, DOCS).selectExpr("*", "7 AS score", "1 AS _text")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], LABELS)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == 400 and all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    wrong = [i for i, r in got.items() if r.held_out and r.predicted != (i % 4 == 0)]
    assert len(wrong) <= 3
    turned = labels.selectExpr("doc_id", "quality", "CASE WHEN pmod(crc32(CAST(doc_id AS string)), 4) = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs, turned).collect()}
    assert again == {i: r.score for i, r in got.items()}  # labels of held-out rows are never read


def test_odd_toxicity_tables(spark, insulted):
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], LABELS)
    odd = [(900, None, None, None, None), (901, "", "en", "s", 0), (None, "grubnik " * 50_000, "en", "s", 0), (902, " ", "", "", 0)]
    model = toxicity.train(spark.createDataFrame(insulted, DOCS), labels)
    got = {r.doc_id: r for r in toxicity.with_toxicity(spark.createDataFrame(odd, DOCS), model).collect()}
    assert got[900].score == got[901].score == got[902].score < 0.3 < got[None].score and got[None].held_out is False
    for some in (labels.where("toxic = 0"), labels.limit(0)):
        assert {r.score for r in toxicity.toxicity(spark.createDataFrame(insulted[:9], DOCS), some).collect()} == {0.0}
    assert toxicity.toxicity(spark.createDataFrame([], DOCS), labels).collect() == []


def kneser_ney(counts, gram):
    """Probability of a gram's last byte by the textbook, for one language."""
    tables = {4: counts}
    for n in (3, 2, 1):
        tables[n] = Counter(g[-n:] for g in tables[n + 1])

    def off(n):
        m = [sum(c == k for c in tables[n].values()) for k in range(5)]
        y = m[1] / (m[1] + 2 * m[2]) if m[1] + m[2] else 0.5
        return [0.0, *(min(float(k), max(0.05, k - (k + 1) * y * m[k + 1] / m[k] if m[k] else 0.5 * k)) for k in (1, 2, 3))]

    p = 1 / perplexity.VOCABULARY
    for n in (1, 2, 3, 4):
        d, tail = off(n), gram[-n:]
        same = [c for g, c in tables[n].items() if g[:-1] == tail[:-1]]
        if same:
            own = tables[n].get(tail, 0)
            p = (own - d[min(own, 3)] + sum(d[min(c, 3)] for c in same) * p) / sum(same)
    return p


def test_perplexity_by_the_textbook(spark, monkeypatch):
    monkeypatch.setattr(perplexity, "BLOCK_BYTES", 40)  # workers import their own; whole and split blocks agree below
    folded = perplexity._Block()
    for i in range(5):
        folded.add(i, "x", i % 2 == 0, b"abcabd" * i)
        folded.fold()
    whole = perplexity._Block()
    for i in range(5):
        whole.add(i, "x", i % 2 == 0, b"abcabd" * i)
    a, b = folded.row(0), whole.row(0)
    assert a[:6] == b[:6] and a[8].tolist() == b[8].tolist() and a[9].tolist() == b[9].tolist() and a[7] == [1] * 5
    rows = [(1, "abcabcabd", "x", "s", 0), (2, "abcé", "x", "s", 0), (3, "zzz", "x", "s", 0), (4, "", "x", "s", 0), (5, None, None, "s", 0), (5, "abcabcabd", "x", "s", 0), (None, "q" * 300, "y", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "0 AS bits", "1 AS block")
    from pyspark.sql import functions as F
    got = perplexity.with_perplexity(docs, trusted=F.col("text").startswith("abc")).collect()
    grams = lambda t: [(b"\2\2\2" + t.encode() + b"\3")[i:i + 4] for i in range(len(t.encode()) + 1)]
    counts = Counter(g for _, t, *_ in rows if (t or "").startswith("abc") for g in grams(t))
    assert len(got) == len(rows)
    for r in got:
        text = {1: "abcabcabd", 2: "abcé", 3: "zzz", 4: ""}.get(r.doc_id)
        if text is not None:
            bits = np.mean([-np.log2(kneser_ney(counts, g)) for g in grams(text)])
            assert r.perplexity == pytest.approx(2 ** bits, rel=1e-5)
    by = {r.doc_id: r for r in got}
    assert by[None].perplexity == pytest.approx(257, rel=1e-5) and by[None].kept and by[None].threshold is None
    assert by[1].kept and not by[3].kept
    assert perplexity.with_perplexity(docs.limit(0)).collect() == []


def test_blocks_meet_their_answers_without_a_shuffle_of_texts(spark, monkeypatch):
    """Only the answers are dealt by block, and repeated rows in many blocks are scored alike."""
    monkeypatch.setattr(perplexity, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(perplexity, "CHUNK_BYTES", 1000)
    rows = [(i, "some plain text about nothing " * (1 + i % 40), "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = perplexity.scored(docs, F.lit(True))
        plan = scored._jdf.queryExecution().executedPlan().toString()
        got = scored.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sum("Exchange hashpartitioning(block" in line for line in plan.splitlines()) == 1
    assert sorted((r.doc_id, r.n_bytes) for r in got) == [(i, len(t)) for i, t, _ in rows]
    assert len({round(r.bits, 9) for r in got}) == 40
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("cadenza_")]


def test_licences(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/c.py", "code"), (3, "a/b/d.py", f"x\n{gpl}\ny"), (4, "a/b/COPYING", gpl), (5, "a/b/e.py", None), (6, "a/x.py", ""),
        (7, "z.py", "licensed nonsense about anything else " * 3), (8, None, mit), (9, None, None), (10, "ab/q.py", "code"), (11, "a/b/k/LICENSE", "nothing"), (12, "a/b/k/f", "word " * 50_000 + "\n" + mit),
        (13, "a/b/k/g", "x"), (14, "a/b/k/g", "x"),
    ]
    files = spark.createDataFrame(rows, "fid bigint, path string, text string").selectExpr("*", "'q' AS license", "1 AS w")
    got = {r.fid: (r.license, r.origin, r.from_dir) for r in licenses.scan(files, licenses.template_table(spark)).collect()}
    assert got == {
        1: ("MIT", "own", None), 2: ("GPL-3.0", "inherited", "a/b"), 3: ("GPL-3.0", "own", None), 4: ("GPL-3.0", "own", None), 5: ("GPL-3.0", "inherited", "a/b"),
        6: ("MIT", "inherited", "a"), 7: (None, "none", None), 8: ("MIT", "own", None), 9: (None, "none", None), 10: (None, "none", None),
        11: ("GPL-3.0", "inherited", "a/b"), 12: ("MIT", "own", None), 13: ("GPL-3.0", "inherited", "a/b"), 14: ("GPL-3.0", "inherited", "a/b"),
    }
    assert licenses.scan(files.limit(0), licenses.template_table(spark)).collect() == []


@pytest.mark.parametrize("text,want", [
    ("Copyright 2019 Example Corp. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Copyright (c) 2021 Jane Doe. All rights reserved.", "Proprietary"), ("// All rights\n// reserved.", "Proprietary"),
    ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("/* SPDX-License-Identifier: GPL-3.0-or-later */", "GPL-3.0"), ("SPDX-License-Identifier: ISC", None),
    ("plain words " * 30 + "Released under the MIT License. " + "more words " * 30, "MIT"),
    (" * Use of this source\n * code is governed by\n * a BSD-style\n * license.", "BSD-3-Clause"),
    ("Permission is hereby granted,\nfree of charge, to any person obtaining a copy of\nthis software and associated documentation files", "MIT"),
    ("The council gave its permission to build", None), ("", None), (None, None), ("all", None), ("komm mit mit mit mit", None), ("the " * 30 + "it " * 30, None), ("of all rights that they have", None),
    ("in source and binary forms, with or without modification, are permitted", "BSD-3-Clause"),
    ("Creative Commons Attribution 4.0 International", "CC-BY-4.0"), ("CC BY 4.0", "CC-BY-4.0"), ("see CC BY-NC 4.0 here", "CC-BY-NC-4.0"),
    ("Mozilla Public License Version 2.0", "MPL-2.0"), ("under the GNU General Public License version 2 or later", "GPL-2.0"),
])
def test_licences_anywhere(text, want):
    found = licenses.Matcher(licenses.TEMPLATES).best(text)
    assert (found and found[1]) == want


def test_licence_scores_do_not_depend_on_the_corpus(spark):
    header = "Copyright 2019 Example Corp. Licensed under the Apache License, Version 2.0."
    rows = [(0, "a/b.py", header), *((i, f"c/{i}.py", "Released under the MIT License.") for i in range(1, 500))]
    scores = []
    for n in (1, 500):
        files = spark.createDataFrame(rows[:n], "fid bigint, path string, text string")
        scores += [(r.license, r.score) for r in licenses.scan(files, licenses.template_table(spark)).where("fid = 0").collect()]
    assert scores[0] == scores[1] and scores[0][0] == "Apache-2.0" and scores[0][1] > 0.99


def test_bounds_skip_no_window():
    """Every window of every template, by the formula, against the search by bounds."""
    rng, matcher = random.Random(5), licenses.Matcher(licenses.TEMPLATES)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in licenses.TOKEN.findall(t.lower())}) + ["alpha", "beta", "gamma"]
    tf = lambda words: {w: 1 + math.log(n) for w, n in Counter(words).items()}
    for _ in range(300):
        _, told = rng.choice(licenses.TEMPLATES)
        words = [w if rng.random() < 0.7 else rng.choice(vocabulary) for w in licenses.TOKEN.findall(told.lower())]
        words = rng.choices(vocabulary, k=rng.randrange(6)) + words + rng.choices(vocabulary, k=rng.randrange(6))
        found = []
        for name, width, unit, needed in matcher.templates:
            for i in range(max(len(words) - width, 0) + 1):
                window = {w: n * matcher.idf.get(w, matcher.unknown) for w, n in tf(words[i:i + width]).items()}
                norm = math.sqrt(sum(v * v for v in window.values()))
                cosine = sum(v * unit.get(w, 0.0) for w, v in window.items()) / norm
                cover = sum(unit.get(w, 0.0) ** 2 for w in window)
                found += [(cosine, name)] if cosine >= needed and cover >= licenses.COVER else []
        got = matcher.best(" ".join(words))
        assert (got is None) == (not found)
        if got:
            top = max(c for c, _ in found)
            assert -got[0] == pytest.approx(top) and got[1] in {n for c, n in found if c > top - 1e-9}


def test_licences_of_null_and_repeated_ids(spark):
    rows = [(1, "a/x", "Released under the MIT License."), (1, "b/y", "plain"), (None, "c/LICENSE", "Released under the MIT License."), (None, "c/z", "plain")]
    files = spark.createDataFrame(rows, "fid bigint, path string, text string")
    got = {r.path: (r.license, r.origin) for r in licenses.scan(files, licenses.template_table(spark)).collect()}
    assert got == {"a/x": ("MIT", "own"), "b/y": (None, "none"), "c/LICENSE": ("MIT", "own"), "c/z": ("MIT", "inherited")}
