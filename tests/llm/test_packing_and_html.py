"""Packing against the tokenizer itself and lower bounds; main texts of pages."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadenza.llm import html_text, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
CACHE = packing.TokenCache(PATH)
PARTS = st.lists(st.sampled_from([*"ab éßªµ.,'’\n\t\r1|<>%·ā&*　日", "'s", "  ", "word", "été", "<|endoftext|>", "​", "\x1c"]), max_size=14).map("".join)


@settings(max_examples=600, deadline=None)
@given(st.lists(PARTS, min_size=1, max_size=4))
def test_cached_ids_are_those_of_whole_texts(texts):
    got = [np.frombuffer(b, "<u4").tolist() for b in CACHE.encode(texts)]
    assert got == [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_fills_sequences(lengths):
    parent, offset, load = packing.best_fit(np.array(lengths, np.int64), 40)
    places = defaultdict(list)
    for size, home, at in zip(lengths, parent, offset, strict=True):
        places[home].append((at, size))
    for home, parts in places.items():
        parts.sort()
        assert [a for a, _ in parts] == [sum(s for _, s in parts[:i]) for i in range(len(parts))]
        assert sum(s for _, s in parts) == load[home] <= 40
    assert sum(2 * load[h] <= 40 for h in places) <= 1  # else two of them would have been one


def valid(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(bins)


@pytest.mark.parametrize("items", [packing.ITEMS, 40])
def test_documents(spark, items):
    random.seed(4)
    texts = [" ".join(random.choices(["the", "Ending", "été", "x1", "a.\nB"], k=random.choice([0, 1, 5, 20, 60, 300]))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate([*texts, None, "word " * 5000, "word " * 5000])] + [(7, "again"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'u' AS uid", "1 AS length").repartition(6)
    pieces = packing.stored(packing.tokenized(docs, capacity=256).selectExpr("*", "monotonically_increasing_id() AS uid"), "test-pieces")
    got = packing.placed(pieces, 256, items=items).collect()
    at_once = len(set(packing.best_fit(np.array([r.length for r in got]), 256)[0].tolist()))
    assert valid(got, 256) <= (1.02 if items > 1000 else 1.1) * at_once + 1
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for i, text in rows:
        if i == 7:
            continue
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(by[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and sum(r.length for r in parts) == len(ids)
        assert all(r.length == 256 for r in parts[1:]) and (len(parts) == 1) == (len(ids) <= 256)
        assert [r.ids_crc32 for r in parts] == [zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in parts]
    assert len(by[7]) == 2


def test_sequences_hold_the_tokens(spark):
    docs = spark.createDataFrame([(i, "some words here " * (i % 9)) for i in range(60)], "doc_id bigint, text string")
    placement = packing.packed(docs, capacity=64)
    held = {r.sequence_id: r.ids for r in packing.sequences(docs, placement, capacity=64).collect()}
    whole = {r.doc_id: [*TOKENIZER.encode(r.text, add_special_tokens=False).ids, 0] for r in docs.collect()}
    for r in placement.collect():
        assert held[r.sequence_id][r.offset:r.offset + r.length] == whole[r.doc_id][r.start:r.start + r.length]
    assert packing.packed(docs.limit(0)).collect() == []


PAGE = (
    '<html><head><title>T</title><style>p{{}}</style></head><body><nav><a>Home</a></nav><div class="ad">Buy</div>'
    "<article><h1>{title}</h1><p>One &amp; {title}<p>Two&nbsp;<b>bold\n text</b><ul><li>a<li>b</ul><aside>side</aside>"
    '<section class="comments"><p>no</p></section></article><footer>&copy; x</footer>'
)


def text_of(html):
    return "\n".join(t for t, _ in html_text.parse(html)[1])


@pytest.mark.parametrize("html,want", [
    (PAGE.format(title="Hi"), "Hi\nOne & Hi\nTwo bold text\na\nb"),
    ("", ""), (None, ""), ("just text", "just text"), ("<p>a</p>b<p>c", "a\nb\nc"), ("a<br>b", "a b"),
    ('<article><p>x<script>var t="</p>";</script>y</p></article><p>out</p>', "xy"),
    ("<article><p>cut &am", "cut &am"), ("<p>1 &lt; 2 &#x41;&eacute;", "1 < 2 Aé"), ("<!-- <p>no</p> --><p>yes", "yes"),
    ('<main><form><p>in</p></form><p>kept</p><div id="cookie-banner">c</div></main>', "kept"),
    ("<p>a</div></p></i>b", "a\nb"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ('<p class="x>y" title=\'<p>\'>z', "z"),
    ("<", "<"), ("<p>a < b</p>", "a < b"), ("<div hidden>h</div><p>v", "v"),
])
def test_parse(html, want):
    assert text_of(html) == want


def test_style_trees(spark):
    notice = '<div class="b{n}"><p>Read our terms before you go on.</p></div>'
    rows = [(i, "http://h.example/%d" % i, f"<body>{notice.format(n=7)}<div class=t1><p>Story number {i} goes here.</p></div>") for i in range(9)]
    rows += [(100 + i, u, rows[0][2]) for i, u in enumerate(["http://other.example/", None, "no url"])]
    rows += [(200, "http://h.example/x", None), (201, "http://h.example/y", "<p>" + "long " * 50_000), (3, "http://h.example/3", rows[3][2]), (None, "http://copy.example/a", "<article><p>same</p></article>")]
    rows += [(300 + i, "http://copy.example/%d" % i, "<article><p>same</p></article>") for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS host", "2 AS low")
    got = defaultdict(list)
    for r in html_text.main_text(pages).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert all(got[i] == [f"Story number {i} goes here."] * (2 if i == 3 else 1) for i in range(9))
    assert all(got[100 + i] == ["Read our terms before you go on.\nStory number 0 goes here."] for i in range(3))
    assert got[200] == [""] and len(got[201][0]) == 5 * 50_000 - 1
    assert got[None] == ["same"] and all(got[300 + i] == ["same"] for i in range(8))
    assert html_text.main_text(pages.limit(0)).collect() == []


def test_copies_are_no_evidence(spark):
    """A page of many copies keeps its text, and so do the other pages of its host; a true notice still goes."""
    page = lambda host, i, body: (i, f"http://{host}.example/{i}", f"<body>{body}")
    story = lambda i: f"<div class=content><p>Story {i} goes here.</p></div>"
    inside = lambda i, n: f"<div class=strip><p>Day {n}</p></div><article><div class=content><p>Story {i}</p></div></article>"
    notice = "<div class=terms><p>Read our terms.</p></div>"
    rows = [page("one", i, story(0)) for i in range(4)]
    rows += [page("hot", 100 + i, notice + story(max(0, i - 90))) for i in range(100)]
    rows += [page("main", 300 + i, inside(max(0, i - 90), i)) for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    assert got == {
        **{i: "Story 0 goes here." for i in range(4)}, **{100 + i: f"Story {max(0, i - 90)} goes here." for i in range(100)},
        **{300 + i: f"Story {max(0, i - 90)}" for i in range(100)}}
