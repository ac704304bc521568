"""Vector code compression: product codebooks trained by active-entry Lloyd rounds, in whole numbers.

* **Numbers.** A component x becomes floor(``SCALE`` * x); a vector is cut into ``parts`` equal parts, each with its own
  codebook, which starts as that part of the vectors with the smallest ids.
* **State.** Each round's table holds, per vector, its numbers, the entry assigned to each part and the exact squared
  distance to it. It is written to the shared folder, so a lost executor costs one round at most.
* **Active entries.** After an update, entries that did not change are still. A part whose assigned entry is still has
  an exact stored distance: no still entry can beat it now if none did before, so it is compared with the moved entries
  only. It changes to one that is nearer, or as near with a lower index. A part whose entry moved is compared with all.
  Both give the entry a full scan would, ties included.
* **Update.** Tasks add up counts and sums per part, entry and position, at most parts * entries * part length rows each;
  the driver sees their totals, as many numbers as a codebook has, at any number of vectors.

Nothing is shuffled but those sums and, in ``with_label_error``, the labels with their partial sums.

Defined cases: vectors that are null or empty or hold null or non-finite components are dropped, and so are those of
another length than the vector with the smallest id has among those whose length the parts divide. Numbers beyond
``LIMIT`` are cut to it. Null ids come last in the order of ids; equal ids are ordered by their vectors. Fewer vectors
than entries give as many entries. Equal entries: the lower index wins. Repeated rows are coded row by row. Extra
columns are not carried. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from cadenza.llm.common import stored

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
LIMIT = 1 << 26
#: Up to this size products of numbers are exact as doubles, which multiply faster.
EXACT = 1 << 22


@dataclass(frozen=True)
class Codes:
    """``vectors`` (vec_id, label, numbers, code, distances) and ``codebooks`` as [part][entry][position]."""

    vectors: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and position, as decimals with commas between."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def whole_numbers(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS) -> DataFrame:
    """vec_id, label, numbers of the vectors that can be coded, all of one length."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    number = lambda v: F.floor(F.greatest(F.least(v.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")
    usable = x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0) & finite
    kept = vectors.where(F.coalesce(usable, F.lit(False))).select(
        "vec_id", "label", F.transform(x, number).alias("numbers"))
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "numbers").select(F.size("numbers").alias("n")).first()
    return kept.where(F.size("numbers") == (first.n if first else 0))


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries."""
    top = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if top <= EXACT and x.shape[1] <= 64 else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


def _scan(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry, the lowest of equally near ones, and its distance."""
    d = _distances(x, entries)
    code = d.argmin(1)
    return code, d[np.arange(len(x)), code]


def reassigned(
    x: np.ndarray, code: np.ndarray, distance: np.ndarray, entries: np.ndarray, moved: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """One part of many vectors after entries moved: full scans only where the assigned entry did."""
    code, distance = code.copy(), distance.copy()
    lost = moved[code]
    if lost.any():
        code[lost], distance[lost] = _scan(x[lost], entries)
    still, active = np.flatnonzero(~lost), np.flatnonzero(moved)
    if len(still) and len(active):
        near, d = _scan(x[still], entries[active])
        near = active[near]
        better = (d < distance[still]) | ((d == distance[still]) & (near < code[still]))
        code[still[better]], distance[still[better]] = near[better], d[better]
    return code, distance


def _numbers(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(rows, -1)


def _codes(column: pa.Array, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(rows, -1)


def _assigned(codebooks: np.ndarray, moved: np.ndarray | None):
    """Tables without codes (``moved`` is None) or with them to tables with codes for these codebooks."""
    parts, _, length = codebooks.shape

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _numbers(batch.column(2), n).astype(np.int64).reshape(n, parts, length)
            if moved is None:
                found = [_scan(x[:, p], codebooks[p]) for p in range(parts)]
            else:
                code, distance = _codes(batch.column(3), n), _numbers(batch.column(4), n)
                found = [reassigned(x[:, p], code[:, p].astype(np.int64), distance[:, p], codebooks[p], moved[p]) for p in range(parts)]
            codes = np.stack([c for c, _ in found], 1).astype(np.uint8)
            distances = np.stack([d for _, d in found], 1)
            ends = pa.array(np.arange(n + 1) * parts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.ListArray.from_arrays(ends, pa.array(distances.ravel()))],
                ["vec_id", "label", "numbers", "code", "distances"])

    return assigned


def _sums(parts: int, entries: int, length: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(parts * entries, np.int64), np.zeros((length, parts * entries), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _numbers(batch.column(0), n).reshape(n, parts, length)
            cell = (_codes(batch.column(1), n).astype(np.int64) + np.arange(parts) * entries).ravel()
            counts += np.bincount(cell, minlength=parts * entries)
            for k in range(length):
                totals[k] += np.bincount(cell, weights=x[:, :, k].ravel(), minlength=parts * entries).astype(np.int64)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.tile(used, length)), pa.array(np.repeat(np.arange(length), len(used))),
             pa.array(np.tile(counts[used], length)), pa.array(totals[:, used].ravel())], ["cell", "position", "rows", "total"])

    return sums


def updated(state: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Each entry the floored mean of its parts; entries without any stay."""
    parts, entries, length = codebooks.shape
    folded = state.select("numbers", "code").mapInArrow(_sums(parts, entries, length), "cell bigint, position bigint, rows bigint, total bigint")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    fresh = codebooks.copy()
    for row in folded.groupBy("cell", "position").agg(whole("rows"), whole("total")).collect():
        fresh[row.cell // entries, row.cell % entries, row.position] = int(row.total) // int(row.rows)
    return fresh


def compressed(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codes:
    """Codes of all vectors after ``rounds`` rounds of training on all of them."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte per part: 1 to 256 entries")
    kept = stored(whole_numbers(vectors, vector, parts), "code-numbers")
    coded = StructType([*kept.schema.fields, StructField("code", BinaryType()), StructField("distances", ArrayType(LongType()))])
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "numbers").limit(entries).select("numbers").collect()
    if not first:
        return Codes(kept.sparkSession.createDataFrame([], coded), np.zeros((parts, 0, 0), np.int64))
    codebooks = np.array([r.numbers for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    state = stored(kept.mapInArrow(_assigned(codebooks, None), coded), "code-state")
    for _ in range(rounds):
        fresh = updated(state, codebooks)
        moved = (fresh != codebooks).any(axis=2)
        codebooks = fresh
        state = stored(state.mapInArrow(_assigned(codebooks, moved), coded), "code-state")
    return Codes(state, codebooks)


def with_label_error(codes: Codes) -> DataFrame:
    """vec_id, code (two hex digits per part), error (squared distance), label_error, codebooks_sha256."""
    error = F.aggregate("distances", F.lit(0).cast("bigint"), lambda a, x: a + x)
    own = codes.vectors.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), error.alias("error"))
    labels = own.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return own.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))
