"""SentencePiece encoding and decoding as a shortest path through a weighted finite-state transducer.

The transducer is compiled once from a model file: a normaliser (a space becomes the word mark, with one more in front of
the text), one arc per piece from its characters to its id, one chain of byte arcs per character that no piece covers,
and, behind them, an acceptor over neighbouring pieces. In the tropical semiring a path's weight is the sum of its arcs'
weights; a pair of neighbours weighs nothing if the model would leave it as it is, and infinitely much if it would merge
across it. Under a merge model exactly one path of any prefix is finite, so the composition with a text is walked from
left to right with one live state per place: the piece in which the shortest path of that prefix ends. Which pieces end at
a place is one state of an automaton over all pieces (trie with failure links), so a place costs a step and a few pairs.

Pair weights come from the model's own merge rule on the two pieces' characters, and are kept once known. No piece holds
a word mark behind another character (checked when compiling), so nothing can merge across the start of a word: the
paths of the words, one after another, are the path of the text, and words are kept once known as well.

Decoding runs the transducer backwards: ids to characters and bytes, marks to spaces, without the one in front.

Texts are encoded whole, batch by batch, on the executors, without a shuffle; caches are bounded. Defined cases: a null
or empty text has no pieces and decodes to the empty text. Repeated rows are encoded alike. Extra columns are not carried.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
KEPT_PAIRS = 1_200_000
KEPT_WORDS = 800_000
#: Steps over failure links that are kept, beside those of the trie.
KEPT_STEPS = 400_000
#: States that are no piece: the start of a word, a character outside the pieces, and a place that no path reaches.
START, OUTSIDE, DEAD = -1, -2, -3
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class _Words(dict):
    """Ids of words, computed once each."""

    def __init__(self, path):
        self.path = path

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= KEPT_WORDS:
            self.clear()
        ids = self[word] = self.path(word)
        return ids


class PieceTransducer:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.piece = [model.id_to_piece(i) for i in range(size)]
        self.id = {self.piece[i]: i for i in plain}
        self.rank = {self.piece[i]: -model.get_score(i) for i in plain}
        self.byte = {int(self.piece[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.unknown = model.unk_id()
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece reaches over the start of a word")
        self.raw = [bytes([self.byte_of[i]]) if i in self.byte_of else p.encode() for i, p in enumerate(self.piece)]
        self.is_byte = np.array([i in self.byte_of for i in range(size)])
        self.pairs: dict[int, bool] = {}
        self.words = _Words(self.path)
        self._compile()

    def _compile(self) -> None:
        """Trie of the pieces, with the longest other state that each state ends in, and the pieces that end there, longest first."""
        self.steps: list[dict[str, int]] = [{}]
        own: dict[int, int] = {}
        for piece, number in self.id.items():
            state = 0
            for letter in piece:
                after = self.steps[state].get(letter)
                if after is None:
                    after = self.steps[state][letter] = len(self.steps)
                    self.steps.append({})
                state = after
            own[state] = number
        self.fail = [0] * len(self.steps)
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(self.steps)
        self.kept = 0
        queue = deque([(0, 0)])
        while queue:
            state, depth = queue.popleft()
            self.ends[state] = (((depth, own[state]),) if state in own else ()) + self.ends[self.fail[state]]
            for letter, after in self.steps[state].items():
                back = self.fail[state]
                while back and letter not in self.steps[back]:
                    back = self.fail[back]
                self.fail[after] = self.steps[back].get(letter, 0) if state else 0
                queue.append((after, depth + 1))

    def _step(self, state: int, letter: str) -> int:
        """The state behind one that has no own step for the letter."""
        back = state
        while back and letter not in self.steps[back]:
            back = self.fail[back]
        after = self.steps[back].get(letter, 0)
        if self.kept < KEPT_STEPS:
            self.kept += 1
            self.steps[state][letter] = after
        return after

    def merged(self, text: str) -> list[str]:
        """The model's merge rule on the characters of a short string: the best-ranked neighbours first, then leftmost."""
        parts, rank = list(text), self.rank.get
        while True:
            best, place = None, -1
            for i in range(len(parts) - 1):
                found = rank(parts[i] + parts[i + 1])
                if found is not None and (best is None or found < best):
                    best, place = found, i
            if place < 0:
                return parts
            parts[place:place + 2] = [parts[place] + parts[place + 1]]

    def free(self, left: int, right: int) -> bool:
        """Whether the pair acceptor lets two neighbouring states pass at no weight. Nothing merges with what is no piece."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        parts = [self.piece[i] for i in (left, right) if i >= 0]
        known = self.pairs[left << 24 | right] = self.merged("".join(parts)) == parts
        return known

    def path(self, word: str) -> tuple[int, ...]:
        """Ids along the shortest path of a word."""
        live, state = [START], 0
        steps, ends, pairs = self.steps, self.ends, self.pairs.get
        for end, letter in enumerate(word, 1):
            after = steps[state].get(letter)
            state = self._step(state, letter) if after is None else after
            for size, piece in ends[state]:
                before = live[end - size]
                if before == DEAD:
                    continue
                passes = pairs(before << 24 | piece)
                if passes or passes is None and self.free(before, piece):
                    live.append(piece)
                    break
            else:
                live.append(OUTSIDE if live[-1] != DEAD and letter not in self.id else DEAD)
        ids: list[int] = []
        end = len(word)
        while end:
            piece = live[end]
            if piece >= 0:
                ids.append(piece)
                end -= len(self.piece[piece])
                continue
            end -= 1
            if self.byte:
                ids += [self.byte[b] for b in reversed(word[end].encode("utf-8", "replace"))]
            else:
                ids.append(self.unknown)
        return tuple(reversed(ids))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        return list(chain.from_iterable(map(self.words.__getitem__, WORD.findall(MARK + text.replace(" ", MARK)))))

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text.removeprefix(" ")


#: One per Python worker, kept from task to task.
_COMPILED: dict[str, PieceTransducer] = {}


def compiled(path: str) -> PieceTransducer:
    return _COMPILED.get(path) or _COMPILED.setdefault(path, PieceTransducer(path))


def default_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def encoded(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """doc_id and the piece ids of each text."""
    path = model or default_model()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(path)
        for batch in batches:
            ids = [machine.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text")).mapInArrow(rows, "doc_id bigint, ids array<int>")


def decoded(coded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and the text of each row of ids."""
    path = model or default_model()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(path)
        for batch in batches:
            texts = [machine.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(rows, "doc_id bigint, text string")


def summarized(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """Encoding and decoding of each text in one pass: doc_id, n_pieces, n_bytes (fallback), ids_crc32, text_sha256 of the decoded text."""
    path = model or default_model()
    names = ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "text_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(path)
        for batch in batches:
            out = []
            for doc, value in zip(batch.column(0), batch.column(1), strict=True):
                ids = machine.encode(value.as_py())
                coded = np.array(ids, "<u4")
                fallback = int(machine.is_byte[coded].sum())
                digest = hashlib.sha256(machine.decode(ids).encode("utf-8", "replace")).hexdigest()
                out.append((doc.as_py(), len(ids), fallback, zlib.crc32(coded.tobytes()), digest))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text")).mapInArrow(
        rows, "doc_id bigint, n_pieces bigint, n_bytes bigint, ids_crc32 bigint, text_sha256 string")
