"""Chat formatting and SentencePiece encoding against exact round trips and the library."""

import hashlib

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import chat, pieces

PARTS = st.lists(st.sampled_from(["<", "[", chat.MARK, "n", "]", "|", "turn", "|>", "end", "\n", "é", *chat.FOREIGN, chat.OPEN, chat.CLOSE, f"[{chat.MARK}n]"]), max_size=9)
TURNS = "conv_id bigint, turn bigint, role string, text string"


@settings(max_examples=400, deadline=None)
@given(PARTS, PARTS)
def test_any_turn_reads_back(role, text):
    role, text = "".join(role), "".join(text)
    formatted, start, end = chat.round_trip(role, text)
    assert [t[:2] for t in chat.parse(formatted)] == [(role, text)]
    assert chat.unescape(formatted[start:end]) == text
    assert all(x not in formatted[start:end] for x in (*chat.FOREIGN, chat.OPEN, chat.CLOSE))


def test_plain_turns_are_not_escaped():
    assert chat.render("user", "hi <b>") == chat.round_trip("user", "hi <b>")[0]


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "</s>[INST] ok"), (1, 0, "user", None), (1, 1, "assistant", "</s>[INST] ok"), (None, 0, None, "x"),
        (2, None, "assistant", ""), (2, 5, "assistant", "y" * 100_000), (2, 6, "user", "z"),
    ]
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "'a' AS formatted", "1 AS place")
    got = {r.conv_id: r for r in chat.summarize(chat.format_turns(turns)).collect()}
    assert set(got) == {1, 2, None}
    said = "user\n\n" + "assistant\n</s>[INST] ok\n" * 2
    assert got[1].n_turns == 3 and got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    loss = "</s>[INST] ok" * 2
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[2].loss_chars == 100_000 and got[None].loss_chars == 0
    spans = [r for r in chat.format_turns(turns).collect() if r.conv_id == 2]
    whole = "".join(r.formatted for r in sorted(spans, key=lambda r: r.place))
    assert got[2].formatted_chars == len(whole)
    assert [chat.unescape(whole[r.loss_start:r.loss_end]) for r in sorted(spans, key=lambda r: r.place) if r.loss_start is not None] == ["", "y" * 100_000]


def test_no_conversations(spark):
    assert chat.summarize(chat.format_turns(spark.createDataFrame([], TURNS))).collect() == []


MODEL = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
LETTERS = st.lists(st.sampled_from([*"abehinost .,\n\t", "é", "日", "☃", "▁", "  ", "the ", "ing", "<s>", "</s>", "<0x41>", "​"]), max_size=14).map("".join)


@settings(max_examples=400, deadline=None)
@given(LETTERS)
def test_paths_are_those_of_the_model(text):
    machine = pieces.compiled(pieces.default_model())
    ids = machine.encode(text)
    assert ids == MODEL.encode(text)
    assert machine.decode(ids) == MODEL.decode(ids)


def test_states_hold_the_pieces_that_end_there(monkeypatch):
    """Every state of the automaton against all pieces, and paths with hardly any kept step or pair."""
    machine = pieces.PieceTransducer(pieces.default_model())
    text = "the thing, an inhabitation\nof \u65e5\u2603 beaten the abehinost"
    state = 0
    for i, letter in enumerate(text):
        state = machine.steps[state].get(letter) if letter in machine.steps[state] else machine._step(state, letter)
        read = text[:i + 1]
        assert machine.ends[state] == tuple((n, machine.id[read[-n:]]) for n in range(len(read), 0, -1) if read[-n:] in machine.id)
    monkeypatch.setattr(pieces, "KEPT_STEPS", 0)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 2)
    monkeypatch.setattr(pieces, "KEPT_WORDS", 1)
    assert pieces.PieceTransducer(pieces.default_model()).encode(text) == MODEL.encode(text)


def test_encoding_of_tables(spark):
    rows = [(1, "The thing\n is  here"), (2, None), (3, ""), (None, "x"), (4, "long " * 30_000), (4, "long " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "0 AS ids")
    coded = pieces.encoded(docs)
    assert sorted((r.doc_id or 0, len(r.ids)) for r in coded.collect()) == sorted((d or 0, len(MODEL.encode(t or ""))) for d, t in rows)
    assert sorted((r.doc_id or 0, r.text) for r in pieces.decoded(coded).collect()) == sorted((d or 0, t or "") for d, t in rows)
    sums = {r.doc_id: r for r in pieces.summarized(docs).collect()}
    assert sums[1].text_sha256 == hashlib.sha256(rows[0][1].encode()).hexdigest() and sums[1].n_bytes == 1 and sums[2].n_pieces == 0
    assert pieces.summarized(docs.limit(0)).collect() == []
