"""Near duplicates of documents and vectors against brute force."""

import random

import numpy as np
import pytest

from cadenza.llm import graph, minhash, vector_dedup


def groups(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(1)
    chain = [(i, i + 1) for i in range(300)]
    random.shuffle(chain)
    star = [(1000, 1000 + i) for i in range(1, 200)]
    edges = [*chain, *star, (5, 5), (2001, 2000), (2000, 2001)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == groups({n for e in edges for n in e}, edges)
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows):
    sets = {d: shingles(t) for d, t in rows}
    ids = sorted(d for d in sets if sets[d])
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    where = groups(list(sets), pairs)
    return {d: (len(sets[d]), where[d]) for d in sets}


def test_documents(spark):
    random.seed(2)
    word = lambda: "".join(random.choices("abcdefgh", k=4))
    rows, number = [], 0

    def add(text):
        nonlocal number
        number += 7
        rows.append((number, text))

    base = [word() for _ in range(150)]
    for _ in range(60):  # a crowd of near copies, more than a region holds
        copy = list(base)
        copy[random.randrange(150)] = word()
        add(" ".join(copy))
    passage = [word() for _ in range(60)]
    for _ in range(45):  # texts that only share a passage
        add(" ".join([*passage, *(word() for _ in range(40))]))
    for at in range(20, 60, 4):  # around the threshold
        copy = list(base)
        for i in range(0, at // 4):
            copy[i * 14 % 150] = word()
        add(" ".join(copy))
    for text in ("one two", "ONE  two\n", "É a", "é a", "", None, " \n", "a b c d e", "a b c d e f", "x " * 20_000, "x " * 9):
        add(text)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'c' AS node", "1 AS k1").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == {d: (n, c, c == d) for d, (n, c) in expected(rows).items()}


def crowd(number, planted):
    """Texts around one passage at 0.849 of each other, just below the threshold, and pairs among them at 0.88."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=8))
    passage = [word() for _ in range(150)]
    tails = [[word() for _ in range(13)] for _ in range(number)]
    ids = rng.sample(range(number), 2 * planted)
    pairs = [tuple(sorted(ids[i:i + 2])) for i in range(0, 2 * planted, 2)]
    for a, b in pairs:
        tails[b][:3] = tails[a][:3]
    return [(i, " ".join([*passage, *tail])) for i, tail in enumerate(tails)], pairs


def test_pairs_in_a_crowd_below_the_threshold(spark):
    rows, pairs = crowd(800, 80)
    sets = [shingles(t) for _, t in rows[:40]]
    assert max(len(a & b) / len(a | b) for i, a in enumerate(sets) for b in sets[:i]) < 0.89
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)).collect()}
    assert got == groups(range(800), pairs)


@pytest.mark.parametrize(("limit", "levels"), [(4096, 1), (50, len(minhash.DEPTHS))])
def test_crowds_go_deeper_only_above_the_limit(spark, monkeypatch, limit, levels):
    """A crowd within the limit is compared in all pairs at the first level; a larger one at the last, with the same groups."""
    rows, pairs = crowd(300, 30)
    depths, level = [], minhash.candidates
    monkeypatch.setattr(minhash, "CROWD", limit)
    monkeypatch.setattr(minhash, "NUMBERED", 5000)
    monkeypatch.setattr(minhash, "candidates", lambda classes, depth, percent: depths.append(depth) or level(classes, depth, percent))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == groups(range(300), pairs)
    assert depths == list(minhash.DEPTHS[:levels])


def test_cells_of_a_crowd(spark):
    """Small blocks: the same links, whether or not groups have blocks of their own."""
    rows, pairs = crowd(300, 20)
    texts = spark.createDataFrame(rows, "doc_id bigint, t string")
    members = spark.range(300).selectExpr("id AS node", "explode(array(id % 2, 2)) AS region", "IF(id >= 290, 290L, id) AS group")
    for block in (7, 400):
        found = [tuple(r) for r in minhash.crowd_links(members, texts, block=block).collect()]
        assert groups(range(300), found) == groups(range(300), [(a, b) for a, b in pairs if a < 290 or b < 290 or block > 10])


def test_odd_document_tables(spark):
    same = "a b c d e f g"
    docs = spark.createDataFrame([(3, same), (3, same), (None, same), (9, same)], "doc_id bigint, text string")
    got = sorted(((r.doc_id or 0), r.component_id or 0, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == [(0, 0, True), (3, 3, True), (3, 3, True), (9, 3, False)]
    assert minhash.near_duplicates(docs.limit(0)).collect() == []


def test_more_orders_at_depth():
    assert [len(minhash.orders(d)) for d in (4, 8)] == [16, 37]
    assert all(len(set(p)) == 8 and max(p) <= minhash.HASHES for p in minhash.orders(8))


@pytest.mark.parametrize("block", [vector_dedup.BLOCK, 7])
def test_vectors(spark, block):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(30, 64))
    rows = [(i, [float(x) for x in rng.normal(size=64)], i % 3) for i in range(60)]
    for i in range(90):
        near = centers[i % 3 if i < 60 else i % 30] + rng.normal(size=64) * 0.03
        rows.append((100 + i, [float(np.float32(x)) for x in near], i % 2))
    rows += [(300, rows[70][1], rows[70][2]), (301, [3 * x for x in rows[70][1]], rows[70][2])]
    odd = [
        (400, None, 1), (401, [0.0] * 64, 1), (402, [float("nan")] * 64, 1), (403, [float("inf")] + [0.0] * 63, 1), (404, [1.0, None], 1),
        (405, rows[0][1], None), (406, [], 1), (None, rows[0][1], 0), (407, [1.0, 2.0], 1), (408, [2.0, 4.0], 1), (409, rows[0][1], 0), (409, rows[0][1], 0),
    ]
    vectors = spark.createDataFrame([*rows, *odd], "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 AS node", "2 AS rows")
    got = [r for r in vector_dedup.near_duplicate_vectors(vectors, block=block).collect()]
    usable = [(v, np.array(e, np.float32).astype(float), label) for v, e, label in [*rows, *odd] if v is not None and label is not None and e and None not in e and np.isfinite(e).all() and any(e)]
    links, pairs = {}, []
    for i, (a, x, p) in enumerate(usable):
        for b, y, q in usable[i + 1:]:
            if p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
                pairs.append((a, b))
    where = groups({v for v, _, _ in [*rows, *odd] if v is not None}, pairs)
    links[409] = 2  # the row with id 0, and the other row of its own id
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        **{v: (links.get(v, 0), c, c == v) for v, c in where.items()}, None: (0, None, True)}
    assert len(got) == len(rows) + len(odd)
    assert vector_dedup.near_duplicate_vectors(vectors.limit(0)).collect() == []
