"""The pipeline's stages, each against plain Python on its own input."""

import random
from collections import defaultdict

import corpus_pipeline
import pytest
from test_duplicates import expected, groups, shingles
from test_packing_and_html import TOKENIZER, valid
from test_scoring import base_counts

WORDS = ["".join(random.Random(i).choices("aeinorst", k=5)) for i in range(30)]
INSULTS = ["grubnik", "zlomek", "vrakot"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = []
    for i in range(240):
        words = random.Random(i).choices(WORDS, k=120)
        if i % 6 == 0:
            words = [w + "%%%" for w in words]
        elif i % 6 == 1:
            for k in range(6):
                words[random.Random(i + k).randrange(120)] = INSULTS[(i + k) % 3]
        rows.append((i, " ".join(words), "en", f"src{i % 3}", 0))
    rows += [(500 + i, rows[2 + 6 * i][1], "de", None, 1) for i in range(4)]
    rows += [(510 + i, rows[3][1] + f" tail{i}", None, "src0", None) for i in range(4)]
    rows += [(520, None, None, None, None), (521, "", "en", "s", 0), (522, "short text", "en", "s", 0), (3, rows[3][1], "en", "src0", 0), (None, rows[9][1], "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 6 != 0), int(i % 6 == 1)) for i in range(240)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(corpus_pipeline.stored(stage(spark, kept[-1], tables), "test-stage"))
    assert all(k.columns == docs.columns for k in kept[:4])
    raw, clean, calm, single, packed = (k.collect() for k in kept)

    def fails(r):
        n, _, _, _, repeated = base_counts(r.text)
        return n < 50 or 100 * repeated > 50 * n

    assert sorted(str(r) for r in clean) == sorted(str(r) for r in raw if not fails(r) and "%%%" not in r.text)
    assert sorted(str(r) for r in calm) == sorted(str(r) for r in clean if not any(w in r.text for w in INSULTS))
    groups = expected([(r.doc_id, r.text) for r in calm if r.doc_id is not None])
    assert sorted(r.doc_id for r in single if r.doc_id is not None) == sorted({c for _, c in groups.values()})
    assert sum(r.doc_id is None for r in single) == sum(r.doc_id is None for r in calm) == 1
    lengths = defaultdict(int)
    for r in packed:
        lengths[r.doc_id] += r.length
    assert lengths == {r.doc_id: len(TOKENIZER.encode(r.text, add_special_tokens=False).ids) + 1 for r in single}
    assert valid(packed, 2048) <= sum(lengths.values()) / 2048 * 1.05 + 1
    again = corpus_pipeline.run(spark, tables)
    assert sorted((r.doc_id or -1, r.piece, r.ids_crc32) for r in again.collect()) == sorted((r.doc_id or -1, r.piece, r.ids_crc32) for r in packed)


def test_empty_tables(spark, tables, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_duplicates_from_a_similarity_of_080(spark, tmp_path):
    """Copies at 0.80 and 0.84 go, one at 0.79 stays; by brute force at 80."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    rows = []
    for k in range(0, 24, 3):
        base = [word() for _ in range(150)]
        rows.append((k, " ".join(base)))
        for j, changed in ((1, 13), (2, 17)):  # words at the end, so each costs one shingle
            rows.append((k + j, " ".join([*base[:-changed], *(word() for _ in range(changed))])))
    sets = {i: shingles(t) for i, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(pairs) == 8
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(groups(sets, pairs).values()))
