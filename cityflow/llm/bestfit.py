"""Best-fit-decreasing packing of token sequences, certified by lower bounds and repacked.

1. Every partition encodes its documents, cuts what exceeds the capacity into pieces of full length,
   and packs the pieces best-fit decreasing. Nothing is shuffled.
2. Dual feasible functions bound the sequences that any packing needs: such a function f maps lengths
   to shares of a sequence so that whatever fits into one sequence has shares of at most 1 in all, so
   the sum of f over all pieces is a lower bound. Sums are additive, over partitions too.
3. A partition whose count equals its bound is certified, and opens its emptiest sequence only; one
   with a gap opens all its sequences with room. Full sequences are final. The opened pieces of all
   partitions are exchanged, dealt evenly to as few partitions as hold them, and packed again, until
   that was one partition or a round saves no sequence. So the partial sequence that every partition
   ends with is packed again too. ``MOST_ROUNDS`` bounds the effort; it drops nothing.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each; no rows
give no sequences; further columns are ignored.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.bpe import ID, codec
from cityflow.llm.common import columns_of, saved

CAPACITY = 2048
END_ID = 0
PIECES_PER_TASK = 20_000
MOST_ROUNDS = 12

PIECE = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
PLACED = PIECE.append(pa.field("sequence_id", pa.int64())).append(pa.field("offset", pa.int64())).append(
    pa.field("open", pa.bool_())
)
_PLACED_DDL = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint, open boolean"
)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of every piece, and the fill of every sequence.

    Sequences wait in stacks by their room; the bits of one integer say which stacks hold any, so the
    smallest sufficient room is its lowest bit from the wanted length on.
    """
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fill: list[int] = []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            k = waiting[room].pop()
            if not waiting[room]:
                rooms &= ~(1 << room)
        else:
            room, k = capacity, len(fill)
            fill.append(0)
        sequence[i], offset[i] = k, fill[k]
        fill[k] += length
        if room > length:
            waiting[room - length].append(k)
            rooms |= 1 << (room - length)
    return sequence, offset, np.array(fill, np.int64)


def bound_sums(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Sums of dual feasible functions over pieces given as counts by length (index 0 to capacity).

    The functions: the identity; for thresholds t up to half, lengths over capacity - t count whole,
    those below t not at all, the rest by their share; and the rounding functions of parameter k,
    which give floor((k + 1) x) / k shares unless (k + 1) x is whole, for a length of share x.
    Whole numbers are kept as integers in units of 1 / capacity, shares of k as exact fractions.
    """
    length = np.arange(capacity + 1)
    sums = [int(counts @ length) / capacity]
    for t in np.unique(np.linspace(1, capacity // 2, 64, dtype=np.int64)):
        value = np.where(length > capacity - t, capacity, np.where(length < t, 0, length))
        sums.append(int(counts @ value) / capacity)
    for k in range(1, 33):
        whole = (k + 1) * length % capacity == 0
        value = np.where(whole, length * k, (k + 1) * length // capacity * capacity)
        sums.append(int(counts @ value) / (capacity * k))
    return np.array(sums)


def least_sequences(sums: np.ndarray) -> int:
    return max(0, math.ceil(float(sums.max(initial=0.0)) - 1e-9))


def pieces_of(batch: pa.RecordBatch, path: str, capacity: int) -> Iterator[tuple]:
    """(doc_id, piece, start, length, checksum) of the documents of a batch."""
    tokenizer, end = codec(path), np.array([END_ID], ID).tobytes()
    step = capacity * ID.itemsize
    for doc_id, text in zip(*columns_of(batch, "doc_id", "text")):
        ids = tokenizer.encode(text) + end
        for number, at in enumerate(range(0, len(ids), step)):
            part = ids[at : at + step]
            yield doc_id, number, number * capacity, len(part) // ID.itemsize, zlib.crc32(part)


def _placed(rows: list[np.ndarray | pa.Array], lengths: np.ndarray, capacity: int, round_number: int) -> Iterator[pa.RecordBatch]:
    """Pack the pieces of one partition; mark the sequences that are to be opened."""
    if not len(lengths):
        return
    sequence, offset, fill = best_fit_decreasing(lengths, capacity)
    least = least_sequences(bound_sums(np.bincount(lengths, minlength=capacity + 1), capacity))
    opened = fill < capacity
    if len(fill) == least:
        opened &= np.arange(len(fill)) == int(fill.argmin())
    first = round_number << 54 | TaskContext.get().partitionId() << 30
    table = pa.table(
        [*rows, pa.array(sequence + first), pa.array(offset), pa.array(opened[sequence])], schema=PLACED
    )
    yield from table.to_batches(max_chunksize=10_000)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of the rows of ``docs`` (doc_id, text): where its tokens lie."""

    def encode_and_pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = []
        for batch in batches:
            if found := list(pieces_of(batch, path, capacity)):
                tables.append(pa.table([pa.array(c, f.type) for c, f in zip(zip(*found), PIECE)], schema=PIECE))
        yield from packed(tables, 0)

    def packed(tables: list[pa.Table], round_number: int) -> Iterator[pa.RecordBatch]:
        if tables:
            rows = pa.concat_tables(tables)
            yield from _placed(rows.columns, rows["length"].to_numpy(), capacity, round_number)

    def repack(round_number: int):
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from packed([pa.Table.from_batches([b]).cast(PIECE) for b in batches if b.num_rows], round_number)

        return apply

    first = docs.selectExpr("CAST(doc_id AS bigint) doc_id", "text").mapInArrow(encode_and_pack, _PLACED_DDL)
    placed, parts, finished = saved(first, "bestfit-0"), 0, []
    for round_number in range(1, MOST_ROUNDS + 1):
        finished.append(placed.filter("NOT open"))
        placed = placed.filter("open")
        # the first piece of a sequence stands for it
        pieces, sequences = placed.agg(F.count("*"), F.count_if(F.col("offset") == 0)).first()
        if sequences <= 1 or parts == 1:
            break
        parts = math.ceil(pieces / PIECES_PER_TASK)
        again = placed.select(*PIECE.names).repartition(parts).mapInArrow(repack(round_number), _PLACED_DDL)
        placed = saved(again, f"bestfit-{round_number}")
        if placed.filter("offset = 0").count() >= sequences:
            break
    for rows in finished:
        placed = placed.unionByName(rows)
    return placed.drop("open")


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """Sequences of a packing, and the lower bound of any packing of its pieces.

    The pieces come to the driver as counts by length, at most ``capacity`` rows.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in packed.groupBy("length").count().collect():
        counts[length] = n
    return packed.select("sequence_id").distinct().count(), least_sequences(bound_sums(counts, capacity))
