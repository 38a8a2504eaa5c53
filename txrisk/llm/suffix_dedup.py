"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort of suffixes (operator 7).

A byte goes if some string of ``min_len`` bytes that covers it also starts anywhere else. Every such string
(window) has one anchor: the least of its ``gram``-byte hashes. Neighbouring windows with one anchor form a
stretch, and equal windows have equal anchors at equal distance, so only stretches whose anchor gram occurs
again can hold repeats; stretches that are equal as a whole repeat altogether. What remains, different
stretches around one gram, is sorted as suffixes that start at the anchor: sorted runs are exchanged
front-coded (common prefix with the one before, and the rest), each range is combined by a loser tree that
never compares a known common prefix again, and the common prefixes of the merged order cut it into groups of
one gram, in which the windows are compared.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, packed, read_table, text_bytes, unpacked

MIN_LEN = 400
#: Bytes of an anchor gram.
GRAM = 96
#: Stretches that one range of the merge holds, about, and of a front-coded block.
RANGE_ROWS = 20_000
BLOCK_ROWS = 2_000
#: Windows of a long text that are looked at together.
CHUNK = 1 << 21

_U = np.uint64
_MAX = np.iinfo(np.uint64).max
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 256, dtype=np.uint64)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, as many as were ever needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, 2 * len(self.up)) - 1
            one = np.ones(1, np.uint64)
            self.up = np.concatenate([one, np.cumprod(np.full(m, _U(_BASE)))])
            self.down = np.concatenate([one, np.cumprod(np.full(m, _U(pow(_BASE, -1, 2**64))))])
        return self.up[:n], self.down[:n]


_powers = _Powers()


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all strings of ``width`` bytes."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=total[1:])
    h = (total[width:] - total[:-width]) * down[: len(data) - width + 1]
    h ^= h >> _U(32)
    return h * _U(0xD6E8FEB86659FD93)


def stretches(text: bytes, min_len: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, windows, anchor - start, anchor's gram hash) of the maximal runs of windows with one anchor.

    The anchor of a window is its gram with the least hash, the last of equals; long texts go in chunks.
    """
    whole = np.frombuffer(text, np.uint8)
    for base in range(0, len(whole) - min_len + 1, CHUNK):
        data = whole[base:base + CHUNK + min_len - 1]
        n = len(data) - min_len + 1
        span = min_len - gram + 1
        h = rolling(data, gram)
        # The place stands in the low bits, counted down: of equal hashes the last wins.
        key = (h >> _U(32) << _U(32)) | (_U(0xFFFFFFFF) - np.arange(len(h), dtype=np.uint64))
        key = np.concatenate([key, np.full(-len(key) % span, _MAX, np.uint64)]).reshape(-1, span)
        # Sliding minimum: the rest of one block and the head of the next.
        head = np.minimum.accumulate(key, axis=1).ravel()
        rest = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
        low = np.minimum(rest[:n], head[span - 1:span - 1 + n])
        anchor = (_U(0xFFFFFFFF) - (low & _U(0xFFFFFFFF))).astype(np.int64)
        start = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        windows = np.diff(np.append(start, n))
        yield start + base, windows, anchor[start] - start, h[anchor[start]].astype(np.int64)


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    i, n = known, min(len(a), len(b))
    while i < n and a[i:i + 32] == b[i:i + 32]:
        i += 32
    i = min(i, n)
    while i < n and a[i] == b[i]:
        i += 1
    return i


def front_code(ordered: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """(common prefix with the string before, rest) of sorted strings."""
    before = b""
    for s in ordered:
        k = common_prefix(before, s)
        yield k, s[k:]
        before = s


class LoserTree:
    """Merge of front-coded runs. Every string knows its common prefix with the last one given out, so two
    strings are compared only beyond it, and not at all when these prefixes differ."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes, object]]]):
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        n = self.size
        self.text: list[bytes | None] = [None] * n
        self.item: list = [None] * n
        self.shared = [0] * n
        for i in range(len(runs)):
            self._advance(i, first=True)
        self.loser = [0] * n
        self.top = self._build(1)

    def _advance(self, i: int, first: bool = False):
        step = next(self.runs[i], None)
        if step is None:
            self.text[i], self.shared[i] = None, -1
            return
        k, rest, self.item[i] = step
        self.text[i] = rest if first else self.text[i][:k] + rest
        self.shared[i] = 0 if first else k

    def _play(self, i: int, j: int) -> tuple[int, int]:
        """(winner, loser); an ended run always loses, of equal strings the earlier run's wins."""
        a, b = self.shared[i], self.shared[j]
        if self.text[i] is None or self.text[j] is None:
            return (j, i) if self.text[i] is None else (i, j)
        if a != b:
            return (i, j) if a > b else (j, i)
        x, y = self.text[i], self.text[j]
        k = common_prefix(x, y, a)
        less = k == len(x) and (k < len(y) or i < j) if k in (len(x), len(y)) else x[k] < y[k]
        win, lose = (i, j) if less else (j, i)
        self.shared[lose] = k
        return win, lose

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        win, self.loser[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return win

    def __iter__(self) -> Iterator[tuple[int, bytes, object]]:
        """(common prefix with the string before, string, item) in order."""
        while self.text[self.top] is not None:
            i = self.top
            yield self.shared[i], self.text[i], self.item[i]
            self._advance(i)
            node = (i + self.size) // 2
            while node:
                i, self.loser[node] = self._play(i, self.loser[node])
                node //= 2
            self.top = i


def window_hashes(parts: list[bytes], min_len: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of each part, and where each part's begin."""
    hashes = [rolling(np.frombuffer(p, np.uint8), min_len) for p in parts]
    return np.concatenate(hashes), np.cumsum([0] + [len(h) for h in hashes])


def repeated(hashes: np.ndarray) -> np.ndarray:
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    out = np.zeros(len(hashes), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def intervals(marked: np.ndarray) -> list[tuple[int, int]]:
    """[first, last] of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, key, text bytes: the key tells rows apart that share an id."""
    text = text_bytes("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("key"), text.alias("text"))


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def stretch_table(rows: DataFrame, min_len: int, gram: int) -> DataFrame:
    """key, start, windows, lead, gram, content: all stretches; ``content`` is the hash of a stretch's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                view = memoryview(text)
                for start, windows, lead, grams in stretches(text, min_len, gram):
                    ends = (start + windows + min_len - 1).tolist()
                    content = np.array([digest(view[a:b]) for a, b in zip(start.tolist(), ends)], np.uint64).astype(np.int64)
                    yield _batch({
                        "key": pa.array(np.full(len(start), key, np.int64)), "start": pa.array(start), "windows": pa.array(windows.astype(np.int32)),
                        "lead": pa.array(lead.astype(np.int32)), "gram": pa.array(grams), "content": pa.array(content),
                    })

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= 50_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return rows.select("key", "text").mapInArrow(joined, "key long, start long, windows int, lead int, gram long, content long")


def stretch_bytes(rows: DataFrame, wanted: DataFrame, min_len: int) -> DataFrame:
    """``wanted`` (key, start, windows, lead, gram, content, n) with the stretches' bytes."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("start", "windows", "lead", "gram", "content", "n")).alias("list"))
    # Repeated rows have the same text: one of them is enough.
    one = packed(rows.select("key", "text")).join(lists, "key").dropDuplicates(["key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = unpacked(text.as_py())
                out += [(key, w["start"], w["lead"], w["content"], w["n"], text[w["start"]:w["start"] + w["windows"] + min_len - 1]) for w in wanted]
            types = {"key": pa.int64(), "start": pa.int64(), "lead": pa.int32(), "content": pa.int64(), "n": pa.int64(), "bytes": pa.binary()}
            yield _batch({c: pa.array([r[k] for r in out], t) for k, (c, t) in enumerate(types.items())})

    return one.select("key", "text", "list").mapInArrow(run, "key long, start long, lead int, content long, n long, bytes binary")


def splitters(sample: list[bytes], ranges: int, gram: int) -> list[bytes]:
    """Borders between ranges, at the start of a gram's group if one border at most lies in it."""
    sample = sorted(sample)
    cuts: list[bytes] = []
    for k in range(1, ranges):
        if sample:
            s = sample[len(sample) * k // ranges]
            short = s[:gram]
            cuts.append(s if cuts and cuts[-1][:gram] == short else short)
    return sorted(set(cuts))


_BLOCKS = "range int, run long, seq int, shared array<int>, rests array<binary>, heads array<binary>, keys array<long>, starts array<long>, counts array<long>"


def sorted_runs(stretches_: DataFrame, cuts: list[bytes]) -> DataFrame:
    """Each task's suffixes, sorted, cut at the range borders and front-coded in blocks."""
    from .common import partition_id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            rows = []
            for key, start, lead, n, data in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("key", "start", "lead", "n", "bytes"))):
                rows.append((data[lead:], data[:lead], key, start, n))
            rows.sort()
            for place, group in groupby(rows, key=lambda r: bisect_right(cuts, r[0])):
                group, out = list(group), []
                coded = front_code(r[0] for r in group)
                for seq, a in enumerate(range(0, len(group), BLOCK_ROWS)):
                    part = group[a:a + BLOCK_ROWS]
                    shared, rests = zip(*(next(coded) for _ in part))
                    out.append((place, partition_id() << 32 | number, seq, list(shared), list(rests), *(list(c) for c in list(zip(*part))[1:])))
                types = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.binary()), *[pa.list_(pa.int64())] * 3]
                names = [c.split()[0] for c in _BLOCKS.split(", ")]
                yield _batch({c: pa.array([r[k] for r in out], t) for k, (c, t) in enumerate(zip(names, types))})
            number += 1

    return stretches_.mapInArrow(run, _BLOCKS)


def merged_ranges(runs: DataFrame, cuts: list[bytes], min_len: int, gram: int) -> DataFrame:
    """key, first, last, hash: marked windows as [first, last], or, for groups that a border cuts, each window's hash.

    A range is merged whole, and groups of one gram are decided there. Only a border that is longer than a gram
    cuts a group, one that is too large for a range; its windows are counted by hash in one more exchange.
    """
    cut_grams = {c[:gram] for c in cuts if len(c) > gram}
    rows = runs.repartition(len(cuts) + 1, "range").sortWithinPartitions("range", "run", "seq")

    def unpack(blocks) -> Iterator[tuple[int, bytes, object]]:
        for b in blocks:
            yield from zip(b["shared"], b["rests"], zip(b["heads"], b["keys"], b["starts"], b["counts"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (row for batch in batches for row in batch.to_pylist())
        for _, of_range in groupby(blocks, key=lambda b: b["range"]):
            runs = [unpack(list(g)) for _, g in groupby(of_range, key=lambda b: b["run"])]
            group, of_gram = [], b""
            for shared, suffix, (head, key, start, n) in LoserTree(runs):
                if group and shared < gram:
                    yield from decide(group, of_gram in cut_grams)
                    group = []
                group.append((head + suffix, key, start, n))
                of_gram = suffix[:gram]
            if group:
                yield from decide(group, of_gram in cut_grams)

    def decide(group, is_cut) -> Iterator[pa.RecordBatch]:
        if len(group) < 2 and not is_cut:
            return
        hashes, begin = window_hashes([g[0] for g in group], min_len)
        if is_cut:
            for k, (_, key, start, n) in enumerate(group):
                h = hashes[begin[k]:begin[k + 1]].astype(np.int64)
                at = start + np.arange(len(h))
                yield _batch({"key": pa.array(np.full(len(h), key)), "first": pa.array(at), "last": pa.array(at), "hash": pa.array(h)})
            return
        marked = repeated(hashes)
        # Stretches that occur more than once are covered already.
        out = [(key, start + a, start + b) for k, (_, key, start, n) in enumerate(group) if n == 1 for a, b in intervals(marked[begin[k]:begin[k + 1]])]
        if out:
            key, first, last = (pa.array(list(c), pa.int64()) for c in zip(*out))
            yield _batch({"key": key, "first": first, "last": last, "hash": pa.nulls(len(out), pa.int64())})

    return rows.mapInArrow(run, "key long, first long, last long, hash long")


def repeated_spans(rows: DataFrame, min_len: int = MIN_LEN, gram: int = GRAM, range_rows: int = RANGE_ROWS) -> DataFrame:
    """key, begin, end: byte spans that windows which occur elsewhere cover; they may overlap."""
    table = materialize(stretch_table(rows, min_len, gram), "op7-stretches")
    # Both sides of a hot gram are counted before they are shuffled.
    grams = table.groupBy("gram").agg(F.count("*").alias("n"), (F.min("content") != F.max("content")).alias("mixed")).where("n > 1")
    again = materialize(table.join(grams.select("gram", "mixed"), "gram"), "op7-repeated")
    counted = again.groupBy("gram", "content").agg(
        F.count("*").alias("n"), F.first("mixed").alias("mixed"), F.min(F.struct("key", "start", "windows", "lead")).alias("one"),
    )
    counted = materialize(counted, "op7-contents")
    whole = again.join(counted.where("n > 1").select("gram", "content"), ["gram", "content"])
    spans = whole.select("key", F.col("start").alias("begin"), (F.col("start") + F.col("windows") + (min_len - 1)).alias("end"))

    mixed = counted.where("mixed").select("one.*", "gram", "content", "n")
    parts = materialize(stretch_bytes(rows, mixed, min_len), "op7-bytes")
    total = parts.count()
    ranges = 1 + total // range_rows
    suffix = F.expr("substring(bytes, lead + 1)")
    sample = parts.where(F.pmod(F.xxhash64("content"), F.lit(max(1, total // (50 * ranges)))) == 0).select(suffix.alias("s")).collect() if ranges > 1 else []
    cuts = splitters([bytes(r["s"]) for r in sample], ranges, gram)
    found = materialize(merged_ranges(sorted_runs(parts, cuts), cuts, min_len, gram), "op7-windows")
    # The windows of groups that a border cuts, by their hash.
    border = found.where("hash is not null")
    twice = border.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    windows = found.where("hash is null").select("key", "first", "last").unionByName(border.join(twice, "hash").select("key", "first", "last"))
    return spans.unionByName(windows.select("key", F.col("first").alias("begin"), (F.col("last") + min_len).alias("end")))


def remove_repeats(docs: DataFrame, min_len: int = MIN_LEN, gram: int = GRAM, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: one row per input row; ``kept`` holds the remaining bytes.

    Null texts count as empty; texts shorter than ``min_len`` keep every byte. Repeated rows are copies of each
    other and lose all that is long enough. An empty table gives an empty result; other columns are not read.
    """
    rows = _rows(docs)
    spans = repeated_spans(rows, min_len, gram, range_rows)
    lists = spans.groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    joined = packed(rows).join(lists, "key", "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = unpacked(text.as_py())
                kept, at, removed, n = [], 0, 0, 0
                end = -1
                for s in sorted((s["begin"], s["end"]) for s in spans or ()):
                    if s[0] > end:
                        n += 1
                        kept.append(text[at:s[0]])
                        removed += s[1] - s[0]
                    else:
                        removed += max(0, s[1] - end)
                    end = max(end, s[1])
                    at = end
                kept.append(text[at:])
                out.append((doc, len(text), removed, n, b"".join(kept)))
            types = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept": pa.binary()}
            yield _batch({c: pa.array([r[k] for r in out], t) for k, (c, t) in enumerate(types.items())})

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op7_suffix_dedup(spark, sf_dir):
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
