"""Sequence packing by shortest-pack-first over the length histogram (operator 1).

The driver sees only the histogram of piece lengths (at most ``max_len`` rows). Lengths are placed from the
longest to the shortest: a length goes into the packs with the most room left, all packs of equal filling at
once, and into new packs only when it fits nowhere. Packs that were filled alike are consecutive sequence ids,
so every step of the placement is one slot: the pieces of that length with ranks [rank, rank + count) go to
the sequences [sequence, sequence + count) at one offset. The documents then look up their slot by rank.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, read_table
from .tokens import document_pieces

MAX_LEN = 2048
#: Pieces that one ranking task counts through, about.
RANK_ROWS = 5_000


def shortest_pack_first(histogram: dict[int, int], max_len: int) -> list[tuple[int, int, int, int, int]]:
    """(length, rank, count, sequence, offset) slots for ``histogram[length]`` pieces of each length.

    Ranks count the pieces of one length from 0. The work and the number of slots depend on the number of
    different lengths and fillings, not on the number of pieces.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> [(first sequence, how many)]
    slots, next_sequence = [], 0
    for length in sorted((n for n, c in histogram.items() if c), reverse=True):
        rank, left, free = 0, histogram[length], max_len
        while left:
            while free >= length and not room.get(free):
                free -= 1
            if free < length:
                # No pack has room: each new pack takes one piece; later lengths fill it up.
                slots.append((length, rank, left, next_sequence, 0))
                room[max_len - length].append((next_sequence, left))
                next_sequence += left
                rank, left = rank + left, 0
                break
            first, many = room[free].pop()
            take = min(many, left)
            if take < many:
                room[free].append((first + take, many - take))
            slots.append((length, rank, take, first, max_len - free))
            room[free - length].append((first, take))
            rank, left = rank + take, left - take
    return slots


def ranked(pieces: DataFrame, n_rows: int) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, … within each length, by hash bucket and then (doc_id, start).

    A length that a third of all pieces have is dealt over the buckets too; only the bucket counts meet.
    """
    buckets = max(1, n_rows // RANK_ROWS)
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int"))
    within = spread.withColumn("nth", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start")) - 1)
    counts = spread.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return within.join(offsets, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("nth")).drop("base", "nth", "bucket")


def pack(pieces: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """``pieces`` (doc_id, start, length, …) with sequence_id and offset: gapless within each sequence.

    ``pieces`` is read several times and should be a table. No pieces give no sequences. Pieces of equal
    length are interchangeable; repeated rows are pieces of their own.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(length > max_len or length < 1 for length in histogram):
        raise ValueError(f"pieces must have 1 to {max_len} tokens")
    slots = shortest_pack_first(histogram, max_len)
    table = np.array(sorted((a, b, s, o) for a, b, _, s, o in slots), dtype="i8").reshape(-1, 4)
    # One number orders (length, rank): the slot of a piece is the last one that starts at or before it.
    total = sum(histogram.values()) + 1
    starts = table[:, 0] * total + table[:, 1]
    spark = pieces.sparkSession
    # Its size depends on max_len alone, not on the data.
    shared = spark.sparkContext.broadcast((starts, table))
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset", "rank")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, table = shared.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy(zero_copy_only=False)
            slot = np.searchsorted(starts, length * total + rank, side="right") - 1
            sequence = table[slot, 2] + rank - table[slot, 1]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(table[slot, 3])], names=[*names, "sequence_id", "offset"])

    rows = ranked(pieces.select(*names), total - 1).select(*names, "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*names).schema.fields)
    return rows.mapInArrow(place, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, max_len: int = MAX_LEN, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents with a checksum of their ids, placed in sequences of at most ``max_len`` ids.

    Null and empty texts are one piece with the end id alone; a document of n ids longer than ``max_len`` is cut
    every ``max_len`` ids, so each id lies in exactly one piece. An empty table gives no rows. Repeated rows
    are packed as often as they occur. Columns other than doc_id and text are not read.
    """
    pieces = document_pieces(docs, max_len, tokenizer).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
    )
    return pack(materialize(pieces, "op1-pieces"), max_len)


def op1_packing(spark, sf_dir):
    return pack_documents(read_table(spark, sf_dir, "documents"))
