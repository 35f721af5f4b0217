"""Packing of documents into training sequences of a fixed capacity.

Two packers share the way blocks are formed. A task tokenizes its documents
and packs them in blocks of about ``BLOCK_TOKENS`` ids, so memory is bounded,
nothing is shuffled, and a hot source or a long document is cut up like any
other. Block borders cost less than one sequence each. A task that runs again
reads the same rows and gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from demandloom.llm.common import texts_of
from demandloom.llm.tokens import END_ID, default_path, word_ids

CAPACITY = 2048
BLOCK_TOKENS = 1 << 21


@dataclass
class Piece:
    """Ids start to start + length of the block's document number doc, at the offset of a sequence."""

    doc: int
    start: int
    length: int
    sequence: int = -1
    offset: int = -1


# --- cost-balanced ------------------------------------------------------------------------


def cost(length, linear: float = 1.0, quadratic: float = 1.0 / 1024):
    """Estimated work on a segment: the layers grow with its length, attention with the square."""
    return linear * length + quadratic * length * length


def balance(lengths: list[int], capacity: int = CAPACITY) -> list[Piece]:
    """Assign documents in descending order to the cheapest sequence that has room for them.

    There are as many sequences as the ids need at least. Documents longer than
    a sequence are cut into full ones first. What finds no room whole is cut
    over the cheapest sequences with room left, so only one sequence's worth of
    padding is left in all.
    """
    pieces = [Piece(d, s, min(capacity, n - s)) for d, n in enumerate(lengths) for s in range(0, n, capacity)]
    pieces.sort(key=lambda p: (-p.length, p.doc, p.start))
    total = -(-sum(lengths) // capacity)
    spent, room = np.zeros(total), np.full(total, capacity, np.int64)
    out: list[Piece] = []

    def put(piece: Piece, sequence: int) -> None:
        piece.sequence, piece.offset = sequence, int(capacity - room[sequence])
        room[sequence] -= piece.length
        spent[sequence] += cost(piece.length)
        out.append(piece)

    for piece in pieces:
        open_ = np.where(room >= piece.length, spent, np.inf)
        best = int(open_.argmin())
        if open_[best] < np.inf:
            put(piece, best)
            continue
        start, left = piece.start, piece.length
        while left:
            best = int(np.where(room > 0, spent, np.inf).argmin())
            part = min(left, int(room[best]))
            put(Piece(piece.doc, start, part), best)
            start, left = start + part, left - part
    return out


# --- best fit decreasing ------------------------------------------------------------------


class CapacityTree:
    """A segment tree over room sizes 0 to capacity; finds the least room that is large enough in log time."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: dict[int, list[int]] = {}

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def push(self, room: int, sequence: int) -> None:
        self.open.setdefault(room, []).append(sequence)
        self._add(room, 1)

    def pop(self, least: int) -> tuple[int, int] | None:
        """Take out a sequence with the smallest room of at least this much; None if there is none."""
        at = least + self.size
        if not self.count[at]:
            # Up to the first right sibling that holds something, then down to its leftmost leaf.
            while at > 1 and not (at % 2 == 0 and self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[Piece]:
    """Best fit decreasing. Only documents longer than a sequence are split, into full sequences and a rest."""
    pieces = [Piece(d, s, min(capacity, n - s)) for d, n in enumerate(lengths) for s in range(0, n, capacity)]
    pieces.sort(key=lambda p: (-p.length, p.doc, p.start))
    tree, sequences = CapacityTree(capacity), 0
    for piece in pieces:
        found = tree.pop(piece.length)
        room, piece.sequence = found or (capacity, sequences)
        sequences += found is None
        piece.offset = capacity - room
        if room > piece.length:
            tree.push(room - piece.length, piece.sequence)
    return pieces


# --- on Spark -----------------------------------------------------------------------------

Packer = Callable[[list[int]], list[Piece]]
#: doc ids, ids of every document, pieces, number of the block's first sequence -> rows
Writer = Callable[[list, list[np.ndarray], list[Piece], int], pa.RecordBatch]


def _pack(docs: DataFrame, schema: str, packer: Packer, writer: Writer, path: str, block_tokens: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        # A task's sequences are numbered from its own range; 2**33 sequences a task are out of reach.
        first = TaskContext.get().partitionId() << 33
        names, ids, held = [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal names, ids, held, first
            pieces = packer([len(i) for i in ids])
            rows = writer(names, ids, pieces, first)
            first += max(p.sequence for p in pieces) + 1
            names, ids, held = [], [], 0
            return rows

        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                one = np.append(encoder.encode(text), np.uint16(END_ID))
                names.append(name)
                ids.append(one)
                held += len(one)
                if held >= block_tokens:
                    yield block()
        if names:
            yield block()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_cost double")


def pack_balanced(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                  block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece of a document, packed by estimated cost.

    ids_crc32 is over the piece's ids as little-endian unsigned 32-bit integers;
    sequence_cost is the estimate for its whole sequence. Null text is the empty
    text: one piece with the end id. Null doc_id and repeated rows are packed
    like others. An empty table gives no rows.
    """

    def write(names: list, ids: list[np.ndarray], pieces: list[Piece], first: int) -> pa.RecordBatch:
        whole = np.zeros(max(p.sequence for p in pieces) + 1)
        np.add.at(whole, [p.sequence for p in pieces], [cost(p.length) for p in pieces])
        return pa.RecordBatch.from_arrays([
            pa.array([names[p.doc] for p in pieces], pa.int64()),
            pa.array([p.start for p in pieces], pa.int64()),
            pa.array([p.length for p in pieces], pa.int64()),
            pa.array([zlib.crc32(ids[p.doc][p.start:p.start + p.length].astype("<u4").tobytes()) for p in pieces], pa.int64()),
            pa.array([len(ids[p.doc]) for p in pieces], pa.int64()),
            pa.array([first + p.sequence for p in pieces], pa.int64()),
            pa.array([p.offset for p in pieces], pa.int64()),
            pa.array([whole[p.sequence] for p in pieces], pa.float64()),
        ], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_cost"])

    return _pack(docs, PIECES, lambda n: balance(n, capacity), write, path or default_path(), block_tokens)


ROWS = ("sequence_id long, n_tokens int, input_ids binary, cu_seqlens array<int>, position_ids binary, "
        "doc_ids array<long>, doc_starts array<long>")


def pack_matrices(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                  block_tokens: int = BLOCK_TOKENS, pad: int = 0) -> DataFrame:
    """One row per packed sequence, by best fit decreasing.

    input_ids and position_ids are rows of the id matrix: ``capacity``
    little-endian 16-bit unsigned integers each, padded with ``pad`` and 0.
    cu_seqlens are the segments' cumulative lengths from 0; positions start
    again at 0 with each segment. doc_ids and doc_starts say which ids of which
    document a segment holds, so every document can be put together again. Null
    and repeated rows as in ``pack_balanced``.
    """
    if capacity > 65535:
        raise ValueError("positions are written in 16 bits")

    def write(names: list, ids: list[np.ndarray], pieces: list[Piece], first: int) -> pa.RecordBatch:
        n = max(p.sequence for p in pieces) + 1
        matrix, positions = np.full((n, capacity), pad, "<u2"), np.zeros((n, capacity), "<u2")
        steps = np.arange(capacity, dtype="<u2")
        ends, owners, starts = [[0] for _ in range(n)], [[] for _ in range(n)], [[] for _ in range(n)]
        for p in sorted(pieces, key=lambda p: (p.sequence, p.offset)):
            matrix[p.sequence, p.offset:p.offset + p.length] = ids[p.doc][p.start:p.start + p.length]
            positions[p.sequence, p.offset:p.offset + p.length] = steps[:p.length]
            ends[p.sequence].append(p.offset + p.length)
            owners[p.sequence].append(names[p.doc])
            starts[p.sequence].append(p.start)
        return pa.RecordBatch.from_arrays([
            pa.array(range(first, first + n), pa.int64()),
            pa.array([e[-1] for e in ends], pa.int32()),
            pa.array([r.tobytes() for r in matrix], pa.binary()),
            pa.array(ends, pa.list_(pa.int32())),
            pa.array([r.tobytes() for r in positions], pa.binary()),
            pa.array(owners, pa.list_(pa.int64())),
            pa.array(starts, pa.list_(pa.int64())),
        ], ["sequence_id", "n_tokens", "input_ids", "cu_seqlens", "position_ids", "doc_ids", "doc_starts"])

    return _pack(docs, ROWS, lambda n: best_fit(n, capacity), write, path or default_path(), block_tokens)
