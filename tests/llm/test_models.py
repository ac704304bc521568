"""Language identification, vector codes and source divergence."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import divergence, language, vector_codes

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VECTORS = "vec_id bigint, embedding array<float>, label int"


# Source divergence

def share(count, size):
    return 1 + 10**9 * (count + 1) // size


def audited(rows, top=200):
    """Brute force from the definition: {(lang, source, part, rank): (item, value)}."""
    rows = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source, *_ in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in rows:
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = {}
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        total = Counter()
        for c in groups.values():
            total.update(c)
        size = {s: sum(c[t] for t in kept) + len(kept) for s, c in groups.items()}
        whole = sum(total[t] for t in kept) + len(kept)
        for s, c in groups.items():
            pairs = [(-sum((share(c[t], size[s]) - (q := share(o[t], size[b]))) ** 2 // q for t in kept), b.encode()) for b, o in groups.items() if b != s]
            terms = [(-((share(c[t], size[s]) - q) ** 2 // q), t.encode()) for t in kept if c[t] and share(c[t], size[s]) > (q := share(total[t], whole))]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out.update({(lang, s, part, i + 1): (item.decode(), -v) for i, (v, item) in enumerate(found)})
    return out


def corpus(n, sources, seed=0):
    rng = random.Random(seed)
    words = ["The", "été", "a", "Ça", "x1y", "naïve", "日本", *("".join(rng.choices("abcé", k=3)) for _ in range(60))]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 40))), rng.choice(["en", "en", "fr", None]), rng.choice(sources), 0) for i in range(n)]
    return [*rows, rows[0], rows[0], (None, None, "de", "alone", 0), (-1, "", "en", None, 0), (-2, "z " * 50_000, "en", sources[0], 0), (-3, "q", "it", "p", 0), (-4, "r", "it", "o", 0)]


@pytest.mark.parametrize("block, cell_terms, spill", [(64, 4096, 400_000), (3, 5, 50), (1, 1000, 7)])
def test_divergence_follows_definition(spark, monkeypatch, block, cell_terms, spill):
    rows = corpus(150, [f"s{i}" for i in range(9)])
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS term", "'x' AS item", "2 AS v")
    kept = divergence.stripes(docs).cache()
    sizes = divergence.group_sizes(docs, kept)
    monkeypatch.setattr(divergence, "SPILL_CELLS", spill)
    got = {(r.lang, r.source, "pair", r["rank"]): (r.item, r.value) for r in divergence.pair_values(kept, sizes, block, cell_terms).collect()}
    got |= {(r.lang, r.source, "term", r["rank"]): (r.item, r.value) for r in divergence.term_values(kept, sizes).collect()}
    assert got == audited(rows)
    assert ("de", "alone", "pair", 1) not in got and got["it", "p", "pair", 1] == ("o", 0)


def test_divergence_whole_operator(spark):
    rows = corpus(40, ["a", "b"], 1)
    found = divergence.divergences(spark.createDataFrame(rows, DOCS), top=5)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {(r.lang, r.source, r.part, r["rank"]): (r.item, r.value) for r in found.collect()} == audited(rows, 5)
    assert divergence.divergences(spark.createDataFrame([], DOCS)).count() == 0


def test_folds_and_merges_add_up(monkeypatch):
    """Stripes that went out in several folds, cut into any batches, merge to what one fold has."""
    import pyarrow as pa
    monkeypatch.setattr(divergence, "SPILL_CELLS", 9)
    rng = random.Random(3)
    rows = [("l", f"s{rng.randrange(4)}", " ".join(rng.choices("abcdefgh", k=6)).encode()) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["lang", "source", "text"])
    folds = [r for b in divergence._folded(iter([batch])) for r in b.to_pylist()]
    folds.sort(key=lambda r: (r["lang"], r["term"]))
    want = defaultdict(Counter)
    for _, source, text in rows:
        for t in text.split():
            want[t][source] += 1
    for size in (1, 2, 7, 1000):
        parts = [pa.RecordBatch.from_pylist(folds[i:i + size]).select(divergence.STRIPE_NAMES) for i in range(0, len(folds), size)]
        merged = [r for b in divergence._merged(0)(iter(parts)) for r in b.to_pylist()]
        assert {r["term"]: dict(zip(r["sources"], r["counts"])) for r in merged} == want and len(merged) == len(want)
        assert {r["term"]: r["docs"] for r in merged} == {t: sum(t in x.split() for _, _, x in rows) for t in want}


def test_shares_of_large_counts():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 10**rng.randrange(1, 16)) for _ in range(300)]
    counts = [rng.randrange(0, s) for s in sizes]
    got = divergence._shares(np.array(counts), np.array(sizes))
    assert got.tolist() == [share(c, s) for c, s in zip(counts, sizes)]


# Vector codes

def coded(rows, parts=16, entries=64, rounds=2):
    """Plain full-scan rounds in Python integers."""
    rows = sorted((r for r in rows if r[1] and all(v is not None and math.isfinite(v) for v in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    numbers = [[math.floor(256 * float(np.float32(v))) for v in r[1]] for r in rows]
    size = len(numbers[0]) // parts
    cut = [[n[p * size:(p + 1) * size] for p in range(parts)] for n in numbers]
    books = [[cut[e][p] for e in range(min(entries, len(cut)))] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], e)), i) for i, e in enumerate(books[p])) for p in range(parts)] for x in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [x[p] for x, f in zip(cut, found) if f[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    labels = Counter()
    for r, e in zip(rows, errors):
        labels[r[2]] += e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted((str(r[0]), "".join(f"{i:02x}" for _, i in f), e, labels[r[2]], digest) for r, f, e in zip(rows, found, errors))


def vectors(n, dim, seed, scale=1.0):
    rng = random.Random(seed)
    some = [[scale * float(np.float32(rng.choice([-0.5, -0.25, 0.0, 0.125, 1.0]) + rng.choice([0, 0.01]))) for _ in range(dim)] for _ in range(n // 2)]
    rows = [(i, rng.choice(some), rng.choice([0, 1, 1, 1, None])) for i in range(n)]
    bad = [(n, None, 1), (n + 1, [float("nan")] * dim, 1), (n + 2, [None] * dim, 1), (n + 3, [float("inf")] * dim, 2), (n + 4, [], 1)]
    return [*rows, *bad, rows[3]]


@pytest.mark.parametrize("n, dim, entries, rounds, scale", [(200, 32, 8, 2, 1.0), (30, 16, 64, 3, 1.0), (60, 64, 5, 6, 1.0), (80, 32, 9, 2, 30_000.0)])
def test_codes_follow_full_scans(spark, n, dim, entries, rounds, scale):
    rows = vectors(n, dim, n, scale)
    table = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS code", "3 AS numbers")
    codes = vector_codes.compressed(table, entries=entries, rounds=rounds)
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.with_label_error(codes).collect())
    assert got == coded(rows, entries=entries, rounds=rounds)


def test_codes_of_odd_tables(spark):
    empty = vector_codes.compressed(spark.createDataFrame([], VECTORS))
    assert vector_codes.with_label_error(empty).collect() == [] and empty.digest() == hashlib.sha256(b"").hexdigest()
    mixed = [(None, [9.0] * 16, 1), (5, [1.0] * 32, 1), (3, [0.5] * 17, 1), (4, [2.0] * 16, None), (6, [1e30] * 16, None)]
    found = vector_codes.with_label_error(vector_codes.compressed(spark.createDataFrame(mixed, VECTORS), rounds=0)).collect()
    assert {r.vec_id for r in found} == {4, 6, None} and {r.error for r in found} == {0}  # length of the smallest usable id
    assert {r.vec_id: r.code for r in found} == {4: "00" * 16, 6: "01" * 16, None: "02" * 16}
    with pytest.raises(ValueError):
        vector_codes.compressed(spark.createDataFrame([], VECTORS), entries=300)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3)), min_size=1, max_size=30),
       st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3)), min_size=1, max_size=6), st.data())
def test_active_entries_equal_full_scans(points, entries, data):
    x, before = np.array(points), np.array(entries)
    after = before.copy()
    for e in range(len(before)):
        if data.draw(st.booleans()):
            after[e] = data.draw(st.tuples(st.integers(-3, 3), st.integers(-3, 3)))
    code, distance = vector_codes._scan(x, before)
    got = vector_codes.reassigned(x, code, distance, after, (after != before).any(axis=1))
    want = vector_codes._scan(x, after)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


# Language identification

SMALL = language.Pieces({p: i for i, p in enumerate(["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca"])}, tuple(range(10, 266)), 266)


def segmentations(text, pieces):
    """All ways to cut a marked unit into pieces; a character that is none stands for its bytes."""
    if not text:
        yield ()
    for n in range(1, len(text) + 1):
        head = text[:n]
        if head in pieces.numbers:
            own = (pieces.numbers[head],)
        elif n == 1:
            own = tuple(pieces.byte[b] for b in head.encode())
        else:
            continue
        for rest in segmentations(text[n:], pieces):
            yield own + rest


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    probabilities = rng.random((SMALL.size, 3))
    probabilities /= probabilities.sum(axis=0)
    units = ["a", "abc", "abcabca", "é", "aéb", "b" * 9, "日a"]
    lattice = language.Lattice(units, SMALL)
    want = [[sum(math.prod(probabilities[i, k] for i in s) for s in segmentations("▁" + u, SMALL)) for k in range(3)] for u in units]
    assert np.allclose(np.exp(lattice.scores(np.log(probabilities))), want, rtol=1e-10)


def test_expected_counts_follow_posteriors():
    rng = np.random.default_rng(2)
    probabilities = rng.random((SMALL.size, 2))
    probabilities /= probabilities.sum(axis=0)
    units, lang, n = ["abc", "cab", "éa", "abcab"], np.array([0, 1, 1, 0]), np.array([2.0, 1.0, 5.0, 3.0])
    want = np.zeros((SMALL.size, 2))
    for u, k, c in zip(units, lang, n):
        ways = [(s, math.prod(probabilities[i, k] for i in s)) for s in segmentations("▁" + u, SMALL)]
        for s, p in ways:
            for i in s:
                want[i, k] += c * p / sum(q for _, q in ways)
    assert np.allclose(language.Lattice(units, SMALL).expected(np.log(probabilities), lang, n), want)


def test_training_and_decisions_by_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    say = {"x": ["abc", "ab", "cab"], "y": ["bcb", "cc", "ca"], "": ["é", "aé"]}
    rows = [(i, " ".join(rng.choices(say[k], k=rng.randrange(1, 9))) + "!" * (i % 3), k, "s", 0) for i in range(90) for k in [rng.choice(list(say))]]
    rows += [(100, None, "x", "s", 0), (101, "12 _ 3", "y", "s", 0), (102, "", None, "s", 0), (103, "ABC ab", None, "s", 0), (None, "cc ca", "y", "s", 0), rows[4]]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 3 == 1
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'mine' AS lang_pred", "7 AS _own", "8 AS unit")
    monkeypatch.setattr(language.Pieces, "read", classmethod(lambda cls, path: SMALL))
    model = language.train(docs, "any", shared=3.0)
    taught = [r for r in rows if r[2] is not None and not held(r[0])]
    names = sorted({r[2] for r in taught})
    assert list(model.languages) == names
    logs = np.full((SMALL.size, len(names)), -math.log(SMALL.size))
    for _ in range(language.ROUNDS):
        counts = np.zeros(logs.shape)
        for _, text, lang, *_ in taught:
            for u in re.findall(r"[^\W\d_]+", (text or "").lower()):
                ways = [(s, math.exp(sum(logs[i, names.index(lang)] for i in s))) for s in segmentations("▁" + u, SMALL)]
                for s, p in ways:
                    for i in s:
                        counts[i, names.index(lang)] += p / sum(q for _, q in ways)
        every = counts.sum(axis=1) + language.FLOOR
        mixed = counts + 3.0 * (every / every.sum())[:, None]
        logs = np.log(mixed / mixed.sum(axis=0))
    assert np.allclose(model.logs, logs)
    got = language.identified(docs, model).collect()
    assert len(got) == len(rows) and got[0]._own == 7 and got[0].unit == 8
    for r in got:
        units = re.findall(r"[^\W\d_]+", (r.text or "").lower())
        likely = [math.log(sum(x[2] == k for x in taught) / len(taught)) + sum(
            math.log(sum(math.exp(sum(logs[i, j] for i in s)) for s in segmentations("▁" + u, SMALL))) for u in units) for j, k in enumerate(names)]
        assert r.held_out == held(r.doc_id)
        if units:
            assert r.lang_pred == names[likely.index(max(likely))]
            assert r.score == pytest.approx(1 / sum(math.exp(v - max(likely)) for v in likely))
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)


def test_long_units_and_untrained_models(spark):
    assert language.units_of("Ab" * 40 + " é1x_Y") == ["ab" * 16, "ab" * 16, "ab" * 8, "é", "x", "y"]
    docs = spark.createDataFrame([(1, "some words", None, "s", 0), (2, None, None, "s", 0)], DOCS)
    model = language.train(docs)
    assert {(r.lang_pred, r.score) for r in language.identified(docs, model).collect()} == {("und", 0.0)}
    empty = spark.createDataFrame([], DOCS)
    assert language.identified(empty, language.train(empty)).count() == 0
    taught = spark.createDataFrame([(i, t, k, "s", 0) for i, (t, k) in enumerate(itertools.product(["the cat and the dog"], ["en"]))] + [
        (10, "der Hund und die Katze", "de", "s", 0), (12, "le chat et le chien", "fr", "s", 0)], DOCS)
    model = language.train(taught)
    long = spark.createDataFrame([(1, "the dog and " * 30_000, None, "s", 0), (2, "und" * 50_000, None, "s", 0), (3, "日本語" * 2_000, None, "s", 0)], DOCS)
    found = {r.doc_id: r for r in language.identified(long, model).collect()}
    assert found[1].lang_pred == "en" and 0.99 < found[1].score <= 1 and all(0 <= r.score <= 1 for r in found.values())


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identified(docs, language.train(docs)).where("held_out").selectExpr("lang = lang_pred AS ok").collect()
    assert sum(r.ok for r in found) >= 0.98 * len(found) and len(found) > 200
