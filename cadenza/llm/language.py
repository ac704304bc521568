"""Language identification by unigram piece models, with every segmentation of a word counted.

* **Units.** A text is its runs of letters, lower-cased, cut after ``UNIT`` letters; each unit gets the word mark in
  front. Units are independent, so the probability of a text is the product over its units.
* **Vocabulary.** The pieces of a fixed public model file, which the driver reads and ships. A character that is no piece
  itself is the chain of the byte pieces of its UTF-8 form.
* **Scoring.** A language gives each piece a probability. The forward algorithm runs over the lattice of all pieces of a
  unit and sums the probabilities of all its segmentations, for all languages at once, in logarithms. Distinct units of a
  batch are walked together; a bounded table keeps what is known.
* **Training.** Units of training documents are counted per language, folded in each partition, summed by (language,
  unit) and stored. Forward and backward passes over these distinct units give expected counts of pieces, ``ROUNDS``
  times, from equal probabilities on. Counts are mixed with those of all languages and with a floor, so no piece is
  impossible anywhere. A model has languages * pieces numbers at any corpus size; the driver sees no more.
* **Decision.** Prior (share of training documents) times probability of the text, over all learned languages; the score
  is the posterior of the best one.

Held out, and never trained on: rows whose crc32 of the id as text leaves remainder 1 by 3. Only text and language of the
other rows are learned from.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and so is everything if no language was
learned. Rows without a language are not learned from; an empty language name is one. A null id is not held out. Very
long texts are read whole, and a long run of letters counts as several units. Equal posteriors: the smaller name.
Repeated rows count as often as they occur and are judged alike. Extra columns pass through, except those named like
the results, which are replaced. Empty tables give empty results.
"""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored

MARK = "▁"
GAP = "\0"
OPEN, NONE = -1, -2
UNIT = 32
UNITS = re.compile(r"[^\W\d_]{1,%d}" % UNIT)
ROUNDS = 2
SHARED = 200.0
FLOOR = 0.5
UNKNOWN_LANGUAGE = "und"
SPILL_UNITS = 400_000
KNOWN_NUMBERS = 4_000_000
TEXTS = 256
LATTICE_UNITS = 20_000
RESULT = ["held_out", "lang_pred", "score"]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


@dataclass(frozen=True)
class Trie:
    """Steps from node to node, as sorted keys of (node, symbol); symbol 0 is any character that no piece has."""

    symbols: np.ndarray
    width: int
    keys: np.ndarray
    children: np.ndarray
    whole: np.ndarray

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next nodes, and whether there is one."""
        wanted = nodes * self.width + symbols
        place = np.searchsorted(self.keys, wanted)
        return self.children[place], self.keys[place] == wanted


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: piece to number, and the numbers of the 256 byte pieces (or of the unknown piece)."""

    numbers: dict[str, int]
    byte: tuple[int, ...]
    size: int

    @classmethod
    def read(cls, path: str) -> Pieces:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        byte = [model.unk_id()] * 256
        for i in range(size):
            if model.is_byte(i):
                byte[int(model.id_to_piece(i)[3:5], 16)] = i
        return cls({model.id_to_piece(i): i for i in plain}, tuple(byte), size)

    @cached_property
    def trie(self) -> Trie:
        """Every beginning of a piece as a node, with the piece's number where it is a whole one."""
        nodes = {"": 0}
        plain = [p for p in self.numbers if GAP not in p]
        for begin in sorted({p[:n] for p in plain for n in range(1, len(p) + 1)}):  # parents come first
            nodes[begin] = len(nodes)
        letters = sorted(set().union(*plain))
        symbols = np.zeros(sys.maxunicode + 1, np.int64)
        symbols[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        steps = [(nodes[b[:-1]] * (len(letters) + 1) + symbols[ord(b[-1])], node) for b, node in nodes.items() if b]
        keys, children = np.array([*sorted(steps), (np.iinfo(np.int64).max, 0)], np.int64).T  # the end is never found
        whole = np.array([self.numbers.get(b, OPEN) for b in nodes], np.int64)
        return Trie(symbols, len(letters) + 1, keys.copy(), children.copy(), whole)


class Lattice:
    """All segmentations of some units: an arc per piece that fits, from its start to its end in its unit."""

    def __init__(self, units: list[str], pieces: Pieces):
        text = "".join([MARK + u + GAP for u in units])  # no piece has a gap, so none reaches over one
        self.lengths = np.array([len(u) + 1 for u in units], np.int64)
        first = np.cumsum(self.lengths + 1) - self.lengths - 1
        unit = np.repeat(np.arange(len(units)), self.lengths)
        at = np.arange(len(unit)) + unit
        trie = pieces.trie
        symbols = trie.symbols[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        arcs, node, n = [], np.zeros(len(at), np.int64), 0
        while len(at):
            node, on = trie.step(node, symbols[at + n])  # the gap ends every walk
            n += 1
            found = np.where(on, trie.whole[node], NONE)
            if n == 1:
                odd = np.flatnonzero(found < 0)
                chains = [text[i].encode("utf-8", "surrogatepass") for i in at[odd].tolist()]
                found[odd] = [pieces.byte[c[0]] for c in chains]
                more = [(arc, pieces.byte[b]) for arc, c in zip(odd.tolist(), chains, strict=True) for b in c[1:]]
                self.more_arc, self.more_piece = np.array(more, np.int64).reshape(-1, 2).T
            whole = found >= 0
            start = at[whole] - first[unit[whole]]
            arcs.append((unit[whole], start, start + n, found[whole]))
            unit, at, node = unit[on], at[on], node[on]
        self.unit, self.start, self.end, self.piece = (np.concatenate(c) for c in zip(*arcs, strict=True))

    def weights(self, logs: np.ndarray) -> np.ndarray:
        """Per arc what ``logs`` has for its piece, byte chains added up. ``logs``: pieces by languages."""
        found = logs[self.piece]
        np.add.at(found, self.more_arc, logs[self.more_piece])
        return found

    def _sums(self, weights: np.ndarray, source: np.ndarray, target: np.ndarray, backward: bool) -> np.ndarray:
        """Per unit and place the log of the sum over all paths that lead there from one end."""
        width = int(self.lengths.max()) + 1
        total = np.full((len(self.lengths), width, weights.shape[1]), -np.inf)
        rows = np.arange(len(self.lengths))
        total[rows, self.lengths if backward else 0] = 0.0
        order = np.lexsort((self.unit, -target if backward else target))
        at = target[order]
        for arcs in np.split(order, np.flatnonzero(at[1:] != at[:-1]) + 1):
            reach = total[self.unit[arcs], source[arcs]] + weights[arcs]
            units = self.unit[arcs]
            heads = np.flatnonzero(np.concatenate([[True], units[1:] != units[:-1]]))
            total[units[heads], target[arcs[0]]] = np.logaddexp.reduceat(reach, heads, axis=0)
        return total

    def forward(self, weights: np.ndarray) -> np.ndarray:
        return self._sums(weights, self.start, self.end, False)

    def scores(self, logs: np.ndarray) -> np.ndarray:
        """Log probability of each unit in each language."""
        ahead = self.forward(self.weights(logs))
        return ahead[np.arange(len(self.lengths)), self.lengths]

    def expected(self, logs: np.ndarray, language: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (pieces by languages) by units of known language that occur ``counts`` times."""
        weights = self.weights(logs)[np.arange(len(self.unit)), language[self.unit]][:, None]
        ahead, behind = self.forward(weights), self._sums(weights, self.end, self.start, True)
        whole = ahead[np.arange(len(self.lengths)), self.lengths, 0]
        on = ahead[self.unit, self.start, 0] + weights[:, 0] + behind[self.unit, self.end, 0] - whole[self.unit]
        uses = np.exp(on) * counts[self.unit]
        found = np.zeros(logs.shape)
        np.add.at(found, (self.piece, language[self.unit]), uses)
        np.add.at(found, (self.more_piece, language[self.unit[self.more_arc]]), uses[self.more_arc])
        return found


@dataclass(frozen=True)
class LanguageModel:
    pieces: Pieces
    languages: tuple[str, ...]
    logs: np.ndarray
    prior: np.ndarray


def units_of(text: str | None) -> list[str]:
    return UNITS.findall(text.lower()) if text else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, unit, n), folded up to ``SPILL_UNITS`` distinct units at a time."""
    held: dict[str, Counter] = defaultdict(Counter)

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), len(counts)), pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                ["lang", "unit", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held[lang].update(units_of(text))
            if sum(map(len, held.values())) > SPILL_UNITS:
                yield from out()
    yield from out()


def _expectations(pieces: Pieces, languages: tuple[str, ...], logs: np.ndarray):
    def expectations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {name: i for i, name in enumerate(languages)}
        found = np.zeros(logs.shape)
        for batch in batches:
            for at in range(0, batch.num_rows, LATTICE_UNITS):
                lang, units, n = (c.to_pylist() for c in batch.slice(at, LATTICE_UNITS).columns)
                found += Lattice(units, pieces).expected(logs, np.array([number[x] for x in lang]), np.array(n, float))
        piece, language = np.nonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(language), pa.array(found[piece, language])], ["piece", "language", "n"])

    return expectations


def _probabilities(counts: np.ndarray, shared: float, floor: float) -> np.ndarray:
    """Logs of expected counts (pieces by languages), mixed with ``shared`` counts dealt as in all languages."""
    every = counts.sum(axis=1) + floor
    mixed = counts + shared * (every / every.sum())[:, None]
    return np.log(mixed / mixed.sum(axis=0))


def train(
    docs: DataFrame, path: str | None = None, text: str = "text", rounds: int = ROUNDS, shared: float = SHARED, floor: float = FLOOR,
) -> LanguageModel:
    """Model of the documents that are not held out; ``path`` is a piece model file."""
    pieces = Pieces.read(path or public_tokenizers.path("piece_bpe_32k.model"))
    rows = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", F.col(text).alias("text"))
    documents = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(documents))
    prior = np.log(np.array([documents[x] for x in languages], float) / max(sum(documents.values()), 1))
    logs = np.full((pieces.size, len(languages)), -np.log(pieces.size))
    if not languages:
        return LanguageModel(pieces, languages, logs, prior)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folded = rows.where(F.col("text").isNotNull()).mapInArrow(_counted, "lang string, unit string, n bigint")
    units = stored(folded.repartition(parts, "lang", "unit").groupBy("lang", "unit").agg(F.sum("n").alias("n")), "language-units")
    for _ in range(rounds):
        uses = units.mapInArrow(_expectations(pieces, languages, logs), "piece bigint, language bigint, n double")
        counts = np.zeros(logs.shape)
        summed = uses.groupBy("piece", "language").agg(F.sum("n").alias("n")).toArrow()  # at most as many rows as a model has numbers
        counts[summed["piece"].to_numpy(), summed["language"].to_numpy()] = summed["n"].to_numpy()
        logs = _probabilities(counts, shared, floor)
    return LanguageModel(pieces, languages, logs, prior)


def judged(model: LanguageModel, text: Column) -> Column:
    """Struct of the most likely language of a text and its posterior."""
    pieces, languages, logs, prior = model.pieces, model.languages, model.logs, model.prior
    room = max(KNOWN_NUMBERS // max(len(languages), 1), LATTICE_UNITS)

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        places: dict[str, int] = {}
        table = np.zeros((0, len(languages)))
        for texts in batches:
            found = []
            for at in range(0, len(texts), TEXTS):
                documents = [units_of(t) for t in texts.iloc[at:at + TEXTS]]
                if not languages:
                    found += [(UNKNOWN_LANGUAGE, 0.0)] * len(documents)
                    continue
                if len(places) > room:
                    places, table = {}, table[:0]
                fresh = list(set(chain.from_iterable(documents)).difference(places))
                places.update(zip(fresh, range(len(table), len(table) + len(fresh))))
                table = np.concatenate([table, *(
                    Lattice(fresh[i:i + LATTICE_UNITS], pieces).scores(logs) for i in range(0, len(fresh), LATTICE_UNITS))])
                found += [_best(table[np.fromiter(map(places.__getitem__, units), np.int64, len(units))], prior, languages) for units in documents]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    return judge(text)


def _best(scores: np.ndarray, prior: np.ndarray, languages: tuple[str, ...]) -> tuple[str, float]:
    if not len(scores):
        return UNKNOWN_LANGUAGE, 0.0
    likely = prior + scores.sum(axis=0)
    best = int(likely.argmax())
    return languages[best], float(1 / np.exp(likely - likely[best]).sum())


def identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Documents with ``held_out``, ``lang_pred`` and ``score``."""
    own = docs.drop(*[c for c in RESULT if c != text])
    packed = own.select("doc_id", F.struct(*own.columns).alias("_own"), judged(model, F.col(text)).alias("_j"))
    return packed.select("_own.*", held_out(F.col("doc_id")).alias("held_out"), "_j.lang_pred", "_j.score")
