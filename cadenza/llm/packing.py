"""Best-fit packing of tokenized documents into sequences, by hierarchical residual packing.

* **Pieces.** A document is its token ids and an end id. Longer documents are cut into pieces of the capacity; the
  first piece takes the remainder, so all others fill a sequence of their own.
* **Local round.** Pieces are dealt to tasks of about ``items`` pieces, and each task packs its own by best fit in
  decreasing order: the next piece goes where it leaves the least room.
* **Tree.** Sequences with at most ``waste`` free places are done, and so are those that no other open sequence fits
  into. The rest, as items of their present length, are dealt to fewer tasks and packed by best fit again, until one
  task has seen all that is left, or until a round no longer makes them fewer.
* **Placement.** A round gives one row per merged sequence (child, parent, offset). These tables shrink from round to
  round; they are composed from the last to the first and joined to the pieces once.

Only ids and lengths are shuffled, never texts or tokens. A task sees at most about ``items`` rows in any round.
Tokenizing caches words: a text falls into parts at single spaces between other characters, where the tokenizer's own
pattern always splits, so ids equal those of the whole text.

Defined cases: a null or empty text is the end id alone. Rows that repeat an id are packed row by row. Ties go by row.
An empty table gives an empty result. Extra columns are not carried.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadenza.llm.common import stored

CAPACITY = 2048
END_ID = 0
WASTE = 8
ITEMS = 50_000
FANIN = 8
CACHED = 500_000
BATCH_CHARS = 1 << 19
UNSAFE = re.compile(r" \s|\s |^ | $")
#: Words below this character are letters in every edition of Unicode.
LATIN = "\u0250"
#: Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
SPACE_LETTER = chr(BYTE_LETTERS[ord(" ")])
SIMPLE = re.compile(r"([^\W\d_]*)([!-/:-@\[-`{-~]*)")
LOOSE_LINES = re.compile(r"\s\n|\n\s|^\n|\n$")
SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class TokenCache:
    """Little-endian 32-bit token ids of texts, with the ids of each part of a text kept for the next one.

    A part that is a word, with or without punctuation behind it, goes straight to the tokenizer's model, in the
    alphabet of its byte-level vocabulary, and so do the lines of a part; anything else takes the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.feed = self._whole("\n")

    def _whole(self, part: str) -> bytes:
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str, lead: str) -> bytes:
        coded = (lead + word).encode().decode("latin-1").translate(BYTE_LETTERS) if not word.isascii() else SPACE_LETTER + word if lead else word
        tokens = self.model.tokenize(coded)
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def _part(self, part: str, lead: str) -> bytes:
        if part.isalpha() and (part.isascii() or max(part) < LATIN):
            return self._word(part, lead)
        word, marks = SIMPLE.match(part).groups()
        if word and marks and len(word) + len(marks) == len(part) and (word.isascii() or max(word) < LATIN):
            ends = self.marks.get(marks)
            if ends is None:
                ends = self._whole(marks)
                if len(self.marks) < CACHED:
                    self.marks[marks] = ends
            known = self.later.get(word) if lead else self.first.get(word)
            return (known or self._word(word, lead)) + ends
        if "\n" in part and not LOOSE_LINES.search(part):
            before, *after = part.split("\n")
            return self._part(before, lead) + b"".join(self.feed + (self.first.get(x) or self._part(x, "")) for x in after)
        return self._whole(lead + part)

    def _learn(self, known: dict[str, bytes], parts: set[str], lead: str) -> None:
        missing = parts.difference(known)
        if len(known) + len(missing) > CACHED:
            known.clear()
            missing = parts
        for part in missing:
            known[part] = self._part(part, lead)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [SAFE_SPACE.split(t) if UNSAFE.search(t) else t.split(" ") for t in texts]
        self._learn(self.first, {parts[0] for parts in split}, "")
        self._learn(self.later, {p for parts in split for p in parts[1:]}, " ")
        later = self.later.__getitem__
        return [self.first[parts[0]] + b"".join(map(later, parts[1:])) for parts in split]


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of about BATCH_CHARS characters, each with its first row."""
    begin, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= BATCH_CHARS:
            yield begin, held
            begin, held, size = i + 1, [], 0
    if held:
        yield begin, held


#: One per Python worker, kept from task to task.
_CACHES: dict[str, TokenCache] = {}


def _cut(path: str, capacity: int, with_ids: bool):
    end = np.array([END_ID], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _CACHES.get(path) or _CACHES.setdefault(path, TokenCache(path))
        for batch in batches:
            docs = batch.column(0)
            for begin, texts in _chunks(batch.column(1)):
                rows: list[tuple] = []
                for i, coded in enumerate(cache.encode(texts)):
                    coded += end
                    total = len(coded) // 4
                    start, piece = 0, 0
                    while start < total:
                        length = ((total - 1) % capacity + 1) if piece == 0 else capacity
                        own = coded[4 * start:4 * (start + length)]
                        rows.append((begin + i, piece, start, length, zlib.crc32(own), own))
                        start, piece = start + length, piece + 1
                place, number, starts, lengths, sums, ids = zip(*rows, strict=True)
                columns = [docs.take(pa.array(place)), pa.array(number, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return pieces


def tokenized(docs: DataFrame, text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids themselves if asked for."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    return docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text")).mapInArrow(
        _cut(path, capacity, with_ids), schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit in decreasing order: for each item its sequence (the row of its first item) and offset; loads by row.

    Open sequences are kept by their room; which rooms exist is a bit mask, so the least sufficient one is found at once.
    """
    parent, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    load = np.zeros(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            home = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, home = capacity, i
        parent[i], offset[i] = home, capacity - room
        load[home] = capacity - room + size
        room -= size
        if room:
            if not rooms[room]:
                mask |= 1 << room
            rooms[room].append(home)
    return parent, offset, load


def _packed(capacity: int):
    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)  # a task's share of the items, of bounded size
        if held:
            items = pd.concat(held).sort_values("item", ignore_index=True)
            parent, offset, load = best_fit(items["length"].to_numpy(), capacity)
            ids = items["item"].to_numpy()
            yield pd.DataFrame({"item": ids, "parent": ids[parent], "offset": offset, "load": load[parent]})

    return packed


def _round(items: DataFrame, tasks: int, number: int, capacity: int) -> DataFrame:
    dealt = items.repartition(tasks, F.xxhash64(F.lit(number), "item"))
    return stored(dealt.mapInPandas(_packed(capacity), "item bigint, parent bigint, offset bigint, load bigint"), f"pack-{number}")


def placed(pieces: DataFrame, capacity: int = CAPACITY, waste: int = WASTE, items: int = ITEMS, fanin: int = FANIN) -> DataFrame:
    """Pieces with their sequence and offset. ``pieces`` has ``uid`` (distinct) and ``length``."""
    left = pieces.where(F.col("length") < capacity).select(F.col("uid").alias("item"), "length")
    count, number, rounds = left.count(), 0, []
    tasks = -(-count // items)
    while count:
        done = _round(left, tasks, number, capacity)
        rounds.append(done)
        heads = done.where("item = parent").select("item", F.col("load").alias("length"))
        open_ = heads.where(F.col("length") < capacity - waste)
        fewest = open_.agg(F.min("length")).first()[0]
        if tasks == 1 or fewest is None:
            break
        left = open_.where(F.col("length") <= capacity - fewest)
        before, count = count, left.count()
        if number and count > 0.9 * before:
            break
        tasks, number = max(-(-tasks // fanin), -(-count // items)), number + 1
    if not rounds:
        return pieces.withColumns({"sequence_id": F.col("uid"), "offset": F.lit(0).cast("bigint")})
    known = rounds[-1].select("item", "parent", "offset")
    for earlier in reversed(rounds[:-1]):
        above = known.select(F.col("item").alias("parent"), F.col("parent").alias("top"), F.col("offset").alias("shift"))
        known = earlier.join(above, "parent", "left").select(
            "item", F.coalesce("top", "parent").alias("parent"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))
    homes = known.select(F.col("item").alias("uid"), "parent", "offset")
    return pieces.join(homes, "uid", "left").withColumns({
        "sequence_id": F.coalesce("parent", "uid"), "offset": F.coalesce("offset", F.lit(0)).cast("bigint")}).drop("parent")


def packed(docs: DataFrame, text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(tokenized(docs, text, tokenizer, capacity).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    return placed(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, placement: DataFrame, text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids. Needs distinct document ids; a sequence is at most ``capacity`` ids."""
    coded = tokenized(docs, text, tokenizer, capacity, with_ids=True).select("doc_id", "piece", "ids")
    at = placement.select("doc_id", "piece", "sequence_id", "offset")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return at.join(coded, ["doc_id", "piece"]).groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
