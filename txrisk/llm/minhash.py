"""Near-duplicate groups by fast similarity sketching, banding and exact verification (operator 10).

Every document's shingle set gets a sketch whose coordinates are all filled by rounds of hashed bin placement.
Bands of coordinates are bucket keys. Equal sets are one class from the start. In each bucket the smallest id
is the leader, and all documents that share a leader form a group, so that every two documents of one bucket
are in a common group. A group is cut into blocks of bounded size and each pair of blocks is one piece of
work, which intersects the full sets and hands on a spanning forest of the links, never all pairs. The links
of all groups are then joined to components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, packed, read_table, releasing, text_bytes, unpacked
from .components import components

#: Words of a shingle and coordinates of a sketch.
SHINGLE = 5
COORDINATES = 255
#: Links are intersection : union of at least this many hundredths.
LINK_PERCENT = 85
#: Chance that a pair right at the threshold shares no band, at most.
MISS = 1e-7
#: Documents of a block.
BLOCK = 256
#: Words whose hash one worker remembers; a memory bound, it changes no result.
CACHE_WORDS = 150_000
#: Columns of the incidence matrix multiplied at a time, and shingles sketched at a time.
CHUNK_KEYS = 1 << 13
SKETCH_KEYS = 1 << 20

_U = np.uint64
_MAX = np.iinfo(np.uint64).max
_SEED = 0x9E3779B97F4A7C15


def _odd(k: int) -> np.uint64:
    return _U((_SEED * (2 * k + 1)) % 2**64 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every bit of the result depends on every bit of ``x``."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Shingles:
    """Sets of 64-bit shingle keys of lower-cased texts; words are hashed once."""

    def __init__(self, size: int = SHINGLE):
        import xxhash

        self.size, self.hash, self.known = size, xxhash.xxh3_64_intdigest, {}

    def __call__(self, text: bytes) -> np.ndarray:
        """Sorted distinct keys; a text of fewer words is one shingle, one without words has none."""
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = self.hash(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(self.size, len(words))
        n = len(words) - k + 1
        keys = np.full(n, k, np.uint64)
        for j in range(k):
            keys += mix(h[j:n + j]) * _odd(j) if j == 0 else h[j:n + j] * _odd(j)
        return np.unique(mix(keys))


def bands(threshold: float, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Rows of a band: as many as keep the chance to miss a pair at the threshold below ``miss``."""
    rows = 1
    while (1 - threshold ** (rows + 1)) ** (coordinates // (rows + 1)) <= miss:
        rows += 1
    return rows


def sketches(sets: list[np.ndarray], size: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketches, one row of ``size`` values per set; equal coordinates estimate the similarity.

    Round r throws every key of a set into one bin: a hashed bin in the first ``size`` rounds, bin r - size in
    the next ``size``. A bin keeps the least (round, hash) that it ever gets. A set takes part until all its
    bins are filled: after one round or a few for most, after 2 * size at the latest, so no coordinate of a
    set with any key stays empty. Empty sets have empty rows.
    """
    lengths = np.array([len(s) for s in sets], np.int64)
    keys = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), lengths)
    best = np.full(len(sets) * size, _MAX, np.uint64)
    for r in range(2 * size):
        h = mix(keys + _U(_SEED * (r + 1) % 2**64))
        # The round stands in the leading bits: an earlier round always wins.
        value = (h >> _U(12)) | (_U(r) << _U(52))
        bins = (mix(h) % _U(size)).astype(np.int64) if r < size else np.full(len(keys), r - size)
        np.minimum.at(best, owner * size + bins, value)
        open_sets = (best.reshape(-1, size) == _MAX).any(axis=1)
        stay = open_sets[owner]
        if not stay.any():
            break
        if not stay.all():
            keys, owner = keys[stay], owner[stay]
    return best.reshape(-1, size)


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band, different for different bands."""
    n = sketch.shape[1] // rows
    part = sketch[:, : n * rows].reshape(len(sketch), n, rows)
    key = np.broadcast_to(mix(np.arange(n, dtype=np.uint64) + _U(_SEED)), (len(sketch), n)).copy()
    for j in range(rows):
        key = mix(key + part[:, :, j] * _odd(j))
    return key.astype(np.int64)


def sketch_table(docs: DataFrame, threshold: float, shingle: int = SHINGLE, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, digest (null for an empty set), bands: one row per input row."""
    rows = bands(threshold, coordinates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingles(shingle)  # one per partition: its words go with it
        for batch in batches:
            ids, sets, total = [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = make(text.as_py())
                ids.append(i)
                sets.append(s)
                total += len(s)
                if total >= SKETCH_KEYS:
                    yield out(ids, sets)
                    ids, sets, total = [], [], 0
            if ids:
                yield out(ids, sets)

    def out(ids, sets):
        keys = band_keys(sketches(sets, coordinates), rows)
        digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * keys.shape[1], pa.int32()), pa.array(keys.ravel()))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), lists],
            names=["doc_id", "n_shingles", "digest", "bands"],
        )

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text"))
    return rows_in.mapInArrow(releasing(run), "doc_id long, n_shingles long, digest binary, bands array<long>")


def linked_pairs(sets: list[np.ndarray], left: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the first ``left`` sets and the rest, or among all if left is 0.

    Intersections are counted in full: keys of at least two sets as columns of an incidence matrix, multiplied
    in chunks; a few sets are intersected one by one.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    parent = list(range(n))
    forest = []

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def tie(a, b):
        a2, b2 = root(a), root(b)
        if a2 != b2:
            parent[max(a2, b2)] = min(a2, b2)
            forest.append((a, b))

    def test(shared, union):
        return 100 * shared >= percent * union

    if n <= 6:
        for a in range(n):
            for b in range(max(a + 1, left), n):
                if left and a >= left or root(a) == root(b) or 100 * min(size[a], size[b]) < percent * max(size[a], size[b]):
                    continue
                shared = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if test(shared, size[a] + size[b] - shared):
                    tie(a, b)
        return forest
    keys = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] >= 2
    column, owner = column[often], owner[often]
    if not len(column):
        return forest
    column = np.cumsum(np.concatenate([[True], column[1:] != column[:-1]])) - 1
    a, b = (left, n - left) if left else (n, n)
    shared = np.zeros((a, b), np.float64)
    for start in range(0, int(column[-1]) + 1, CHUNK_KEYS):
        lo, hi = np.searchsorted(column, [start, start + CHUNK_KEYS])
        m = np.zeros((n, min(CHUNK_KEYS, int(column[-1]) + 1 - start)), np.float32)
        m[owner[lo:hi], column[lo:hi] - start] = 1
        shared += m[:a] @ m[left:].T
    union = size[:a, None] + size[None, left:] - shared
    for x, y in np.argwhere(test(shared, union)).tolist():
        if x != y + left:
            tie(x, y + left)
    return forest


def links(docs: DataFrame, table: DataFrame, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """a, b: a spanning forest of all links between classes, which the smallest ids of equal sets stand for."""
    reps = table.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "bands")).alias("rep"))
    reps = materialize(reps.select("rep.*"), "op10-classes")
    keys = reps.select("doc_id", F.explode("bands").alias("band"))
    buckets = keys.groupBy("band").agg(F.min("doc_id").alias("leader"), F.count("*").alias("n")).where("n > 1").select("band", "leader")
    groups = materialize(keys.join(buckets, "band").select("leader", "doc_id").distinct(), "op10-groups")
    blocks = groups.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks"))
    member = groups.join(blocks, "leader").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("n_blocks")).cast("int"))
    # Each pair of a group's blocks is one piece of work; most groups are one block.
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    work = member.withColumn("other", other).select("doc_id", "leader", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    needed = groups.select(F.col("doc_id").alias("__id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), text_bytes("text").alias("text"))
    # Both sides grow with the data: always a merge join, of texts that are compressed first.
    texts = packed(texts).join(needed.hint("merge"), "__id")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingles(shingle)
        for batch in batches:
            sets = pa.array([make(unpacked(t.as_py())).tobytes() for t in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], names=["__id", "keys"])

    sets = texts.mapInArrow(releasing(to_sets), "__id long, keys binary")
    rows = work.join(sets, F.col("doc_id") == F.col("__id")).select("leader", "i", "j", "block", "doc_id", "keys")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "leader", "i", "j").sortWithinPartitions("leader", "i", "j", "block", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                columns = [batch.column(k).to_pylist() for k in range(5)]
                for k, row in enumerate(zip(*columns)):
                    yield row, batch.column(5)[k]

        for (_, i, j), group in groupby(stream(), key=lambda r: r[0][:3]):
            ids, sets, left = [], [], 0
            for (_, _, _, block, doc), keys in group:
                ids.append(doc)
                sets.append(np.frombuffer(keys.as_py(), np.uint64))
                left += i != j and block == i
            if i != j and (not left or left == len(ids)):
                continue
            pairs = linked_pairs(sets, left, percent)
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in pairs]), pa.array([ids[b] for _, b in pairs])], names=["a", "b"])

    return rows.mapInArrow(releasing(run), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = LINK_PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row.

    Null texts count as empty; texts without words have an empty set, are linked with nothing and are their own
    component. Equal sets are one class, named by its smallest id; classes named alike, where ids repeat, are
    one node. A row without an id takes the component of its set, or null. An empty table gives an empty
    result; other columns are not read.
    """
    table = materialize(sketch_table(docs, percent / 100, shingle), "op10-sketches")
    pairs = materialize(links(docs, table, percent, shingle).distinct(), "op10-links")
    label = components(pairs)
    classes = table.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = classes.join(label, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("component", "rep").alias("component"))
    out = table.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def keep_one_of_each(docs: DataFrame, percent: int) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, and rows without an id, with all columns."""
    judged = near_duplicates(docs, percent).where("doc_id is not null")
    # Where ids repeat, an id stays if any of its rows does.
    gone = judged.groupBy(F.col("doc_id").alias("__id")).agg(F.max("kept").alias("kept")).where("not kept").select("__id")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__id"], "left_anti")


def op10_minhash(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {SHINGLE} THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - {SHINGLE - 2}), lambda i: array_to_string(words[i:i + {SHINGLE - 1}], ' ')) END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= {LINK_PERCENT} * (x.n + y.n - common)
), reach AS (
  SELECT a AS doc_id, a AS seen FROM link UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON r.seen = l.a
), c AS (
  SELECT doc_id, min(seen) AS component FROM reach GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, w.doc_id) AS component_id, w.doc_id = coalesce(c.component, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id
"""
