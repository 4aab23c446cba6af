"""Token ids in packed binary rows.

Documents are encoded, closed with an end id, and cut into pieces of at most ``CAPACITY`` tokens; every
piece is kept, so nothing is lost. The pieces of a window of a partition (``WINDOW`` tokens) are packed
best-fit decreasing. A segment tree over room sizes finds the fullest row with enough room in
logarithmic time. A window is written when it is full, so memory does not depend on a partition's size.

A row of the result is a row of the id matrix: ``ids`` holds exactly ``CAPACITY`` little-endian unsigned
integers (16 bits where the vocabulary allows, else 32), padded behind ``n_tokens``. ``cu_seqlens`` are the
cumulative segment lengths from 0, as variable-length attention takes them; ``position_resets`` the places
where positions start at 0 again; ``segments`` say which piece of which document each segment is.

Defined cases: a null or empty text is the end id alone; repeated rows are written each; no rows give no
rows; further columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.bpe import ID, codec
from cityflow.llm.common import columns_of

CAPACITY = 2048
WINDOW = 1 << 22
END_ID = 49407

_SEGMENT = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32())])
_ROW = pa.schema(
    [
        ("row_id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int32()), ("cu_seqlens", pa.list_(pa.int32())),
        ("position_resets", pa.list_(pa.int32())), ("segments", pa.list_(_SEGMENT)),
    ]
)
_DDL = (
    "row_id bigint, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
    "segments array<struct<doc_id: bigint, piece: int, start: bigint, length: int>>"
)


class RoomTree:
    """Rows by the room they have left. A node of the tree counts the rows below it."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The room and a row of the smallest room that is ``need`` or more."""
        node = need + self.width
        if not self.count[node]:
            # up to the first ancestor with something on its right, then down on the left
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node <<= 1
                node += not self.count[node]
        room = node - self.width
        self._change(room, -1)
        return room, self.rows[room].pop()


def packed(lengths: list[int], capacity: int) -> list[list[int]]:
    """The pieces of every row, best-fit decreasing."""
    rows: list[list[int]] = []
    rooms = RoomTree(capacity)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[i])
        if found is None:
            room, row = capacity, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(i)
        if room > lengths[i]:
            rooms.add(room - lengths[i], row)
    return rows


def write_rows(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """The rows of the packed id matrix over the rows of ``docs`` (doc_id, text)."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = codec(path)
        kind = np.dtype("<u2" if max(end_id, *tokenizer.token_bytes) < 1 << 16 else "<u4")
        pieces: list[tuple] = []
        held, next_row = 0, TaskContext.get().partitionId() << 33
        width, end = capacity * kind.itemsize, np.array([end_id], kind).tobytes()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal pieces, held, next_row
            nonlocal pieces, held, next_row
            rows = packed([p[3] for p in pieces], capacity)
            order = [i for members in rows for i in members]
            doc_ids, numbers, starts, lengths, _ = zip(*(pieces[i] for i in order)) if order else ((),) * 5
            sizes = [len(members) for members in rows]
            first = np.cumsum([0, *sizes])
            ends = [np.cumsum([0, *lengths[a:b]]) for a, b in zip(first.tolist(), first[1:].tolist())]
            segments = pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip((doc_ids, numbers, starts, lengths), _SEGMENT)], fields=list(_SEGMENT)
            )

            def lists(parts: list[np.ndarray]) -> pa.ListArray:
                offsets = pa.array(np.cumsum([0, *map(len, parts)]), pa.int32())
                return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*parts, []]).astype(np.int32)))

            table = pa.Table.from_arrays(
                [
                    pa.array(range(next_row, next_row + len(rows)), pa.int64()),
                    pa.array([b"".join([pieces[i][4] for i in members]).ljust(width, b"\0") for members in rows], pa.binary()),
                    pa.array([e[-1] for e in ends], pa.int32()),
                    lists(ends),
                    lists([e[:-1] for e in ends]),
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), segments),
                ],
                schema=_ROW,
            )
            pieces, held, next_row = [], 0, next_row + len(rows)
            yield from table.to_batches(max_chunksize=2000)

        for batch in batches:
            for doc_id, text in zip(*columns_of(batch, "doc_id", "text")):
                ids = np.frombuffer(tokenizer.encode(text), ID).astype(kind).tobytes() + end
                for number, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    length = len(part) // kind.itemsize
                    pieces.append((doc_id, number, number * capacity, length, part))
                    held += length
                    if held >= window:
                        yield from flush()
        yield from flush()

    return docs.selectExpr("CAST(doc_id AS bigint) doc_id", "text").mapInArrow(apply, _DDL)


def restored(rows: DataFrame, itemsize: int = 2) -> DataFrame:
    """doc_id, piece, start and ids of every segment, cut out of the matrix rows again."""
    return rows.select("ids", "cu_seqlens", F.posexplode("segments").alias("k", "s")).selectExpr(
        "s.doc_id", "s.piece", "s.start", f"substring(ids, cu_seqlens[k] * {itemsize} + 1, s.length * {itemsize}) AS ids"
    )
