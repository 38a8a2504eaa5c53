"""Packed token-id matrices as binary output (operator 8).

Documents become token ids, overlong ones are split without loss, and each task packs its pieces block by
block: best fit decreasing, where a segment tree over the capacities finds the fullest row that still has
room. A block is one shard: an id matrix, the cumulative segment lengths over its rows, the places where
positions start again at 0, and the index of its segments. Nothing is shuffled; a block bounds the memory.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import materialize, partition_id, read_table
from .tokens import id_and_text, piece_cutter

MAX_LEN = 2048
#: Ids of one shard, about.
SHARD_IDS = 500_000
#: Fills the rows behind their last segment.
PAD_ID = 0

SHARDS = (
    "shard long, n_rows int, max_len int, id_bytes int, ids binary, cu_seqlens array<int>, resets array<int>,"
    " doc_ids array<long>, starts array<long>, doc_tokens array<long>, rows array<int>, offsets array<int>, lengths array<int>"
)


class CapacityTree:
    """Rows by room left; the least room of at least ``n`` is found in logarithmic time."""

    def __init__(self, most: int):
        self.size = 1
        while self.size <= most:
            self.size *= 2
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, row: int):
        self.rows[room].append(row)
        node = room + self.size
        while node:
            self.count[node] += 1
            node //= 2

    def take(self, room: int) -> int:
        node = room + self.size
        while node:
            self.count[node] -= 1
            node //= 2
        return self.rows[room].pop()

    def least(self, n: int) -> int | None:
        """The least room of at least ``n`` that any row has."""
        node = n + self.size
        if self.count[node]:
            return n
        while node > 1:
            # To the right of the path upwards, then to the left downwards.
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def best_fit_decreasing(lengths: list[int], max_len: int) -> tuple[list[tuple[int, int]], int]:
    """(row, offset) of every piece, and the number of rows. Equal lengths keep their order."""
    tree, places, n = CapacityTree(max_len), [(0, 0)] * len(lengths), 0
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        room = tree.least(lengths[k])
        if room is None:
            row, room, n = n, max_len, n + 1
        else:
            row = tree.take(room)
        places[k] = (row, max_len - room)
        tree.add(room - lengths[k], row)
    return places, n


def _shard(number: int, pieces: list[tuple], max_len: int, id_type: str) -> tuple:
    places, n = best_fit_decreasing([p[2] for p in pieces], max_len)
    matrix = np.full((n, max_len), PAD_ID, id_type)
    order = sorted(range(len(pieces)), key=places.__getitem__)
    filled = [0] * n
    ends, resets = [0], []
    for at, k in enumerate(order):
        (row, offset), length = places[k], pieces[k][2]
        matrix[row, offset:offset + length] = np.frombuffer(pieces[k][4], "<u4")
        resets.append(row * max_len + offset)
        ends.append(row * max_len + offset + length)
        filled[row] = offset + length
        if filled[row] < max_len and (at + 1 == len(order) or places[order[at + 1]][0] != row):
            ends.append((row + 1) * max_len)  # the padding is a segment of its own
    column = lambda c: [pieces[k][c] for k in order]
    return (
        number, n, max_len, matrix.itemsize, matrix.tobytes(), ends, resets, column(0), column(1), column(3),
        [places[k][0] for k in order], [places[k][1] for k in order], column(2),
    )


def packed_shards(docs: DataFrame, max_len: int = MAX_LEN, tokenizer: str | None = None, shard_ids: int = SHARD_IDS, id_type: str = "<u2") -> DataFrame:
    """Shards of all documents, one row each (see SHARDS); every id lies in exactly one segment.

    ``cu_seqlens`` runs over the flattened matrix, padding being segments of its own; ``resets`` are the flat
    places where a segment and so its positions begin. Null and empty texts are one segment with the end id.
    An empty table gives no shard. Repeated rows are written as often as they occur. Only doc_id and text are
    read. ``id_type`` must hold the tokenizer's ids.
    """
    cut = piece_cutter(max_len, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = partition_id() << 33, [], 0

        def out():
            row = _shard(number, held, max_len, id_type)
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), ints, ints, longs, longs, longs, ints, ints, ints]
            names = [c.split()[0] for c in SHARDS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        # Cut and packed by one worker, one batch of pieces at a time.
        for batch in cut(batches):
            for piece in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "ids"))):
                held.append(piece)
                n += piece[2]
                if n >= shard_ids:
                    yield out()
                    number, held, n = number + 1, [], 0
        if held:
            yield out()

    return id_and_text(docs).mapInArrow(run, SHARDS)


def read_shard(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id matrix, cumulative segment lengths, position matrix) of a shard row."""
    ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").reshape(row["n_rows"], row["max_len"])
    ends = np.asarray(row["cu_seqlens"], np.int64)
    positions = np.arange(ids.size) - np.repeat(ends[:-1], np.diff(ends))
    return ids, ends, positions.reshape(ids.shape)


def segments(shards: DataFrame) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids_crc32, shard, row, offset: every segment, its ids read from the matrices.

    The checksum is that of little-endian unsigned 32-bit ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = read_shard(row)[0].astype("<u4")
                crc = [zlib.crc32(ids[r, o:o + n].tobytes()) for r, o, n in zip(row["rows"], row["offsets"], row["lengths"])]
                columns = {
                    "doc_id": row["doc_ids"], "start": row["starts"], "length": row["lengths"], "doc_tokens": row["doc_tokens"], "ids_crc32": crc,
                    "shard": [row["shard"]] * len(crc), "row": row["rows"], "offset": row["offsets"],
                }
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in columns.values()], names=list(columns))

    return shards.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, shard long, row long, offset long")


def op8_token_output(spark, sf_dir):
    return segments(materialize(packed_shards(read_table(spark, sf_dir, "documents")), "op8-shards"))
