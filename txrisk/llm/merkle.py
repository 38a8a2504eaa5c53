"""Merkle manifest of a dataset as a SHA midstate tree (operator 11).

Leaves are SHA-256 digests of framed fields, in id order within their group; every three neighbours become their
parent, and the groups' roots become the dataset's root in the same way. A child takes exactly one block of
SHA-256, so the state of the hash before each child slot is eight words: every parent keeps a copy of them.
To test a replaced leaf, its parent's matching state is resumed with the replacement and the right siblings only;
left siblings are never hashed again.

Positions come from a range sort with offsets per partition; then ``CHUNK_LEVELS`` levels at a time are built in
rows of 3**CHUNK_LEVELS nodes, so a group of any size takes a few steps, and no task or driver holds a group. Going
down, every node hands its path (states and siblings of all levels above) to the row below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, read_table

#: Levels that one row of nodes spans, and the nodes of a full row.
CHUNK_LEVELS = 5
CHUNK = 3**CHUNK_LEVELS
#: Rows of nodes whose paths a worker holds at a time.
ROWS_AT_ONCE = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ---------------------------------------------------------------- SHA-256 over many messages at once
def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(x: int) -> int:
    lo, hi = 0, 1 << (x.bit_length() // 3 + 1)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if mid**3 <= x else (lo, mid - 1)
    return lo


# The first 32 bits of the fractions of the primes' square and cube roots.
_START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
_ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> n) | (x << (32 - n))


def _schedule(words: np.ndarray) -> np.ndarray:
    """(16, n) words of a block -> (64, n) words of its rounds, round constants added."""
    w = np.empty((64, words.shape[1]), np.uint32)
    w[:16] = words
    for t in range(16, 64):
        a, b = w[t - 15], w[t - 2]
        w[t] = w[t - 16] + (_turn(a, 7) ^ _turn(a, 18) ^ (a >> 3)) + w[t - 7] + (_turn(b, 17) ^ _turn(b, 19) ^ (b >> 10))
    return w + _ROUND[:, None]


def absorb(states: np.ndarray, rounds: np.ndarray) -> np.ndarray:
    """The states (n, 8) after one more block each, given as its schedule (64, n) or (64, 1)."""
    a, b, c, d, e, f, g, h = first = np.ascontiguousarray(states.T)
    for w in rounds:
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + w
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return (first + np.stack([a, b, c, d, e, f, g, h])).T


def _padding(blocks: int) -> np.ndarray:
    words = np.zeros((16, 1), np.uint32)
    words[0], words[15] = 0x80000000, 512 * blocks
    return _schedule(words)


_LAST = {n: _padding(n) for n in (1, 2, 3)}
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def child_block(digests: np.ndarray) -> np.ndarray:
    """The schedule of the block that a child's digest (n, 32), as lowercase hex text, fills."""
    text = np.empty((len(digests), 64), np.uint8)
    text[:, 0::2], text[:, 1::2] = _HEX[digests >> 4], _HEX[digests & 15]
    return _schedule(text.view(">u4").astype(np.uint32).T)


def finish(states: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of hashes whose state has taken ``counts`` children."""
    out = np.empty((len(states), 8), ">u4")
    for n, last in _LAST.items():
        at = np.flatnonzero(counts == n)
        if len(at):
            out[at] = absorb(states[at], last)
    return out.view(np.uint8).reshape(-1, 32)


# ---------------------------------------------------------------- rows of nodes
def levels_left(m):
    """Levels until ``m`` neighbours are one node."""
    n = 0
    while m > 1:
        m, n = -(-m // 3), n + 1
    return n


def grow(nodes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parents of several rows of nodes: their digests (p, 32), kept states (p, 3, 8) before each slot, and sizes."""
    up = -(-sizes // 3)
    parents = np.arange(up.sum()) - np.repeat(np.cumsum(up) - up, up)
    first = np.repeat(np.cumsum(sizes) - sizes, up) + 3 * parents
    counts = np.minimum(3, np.repeat(sizes, up) - 3 * parents)
    states = np.empty((len(first), 3, 8), np.uint32)
    now = np.broadcast_to(_START, (len(first), 8)).copy()
    for slot in range(3):
        states[:, slot] = now
        at = np.flatnonzero(counts > slot)
        if len(at):
            now[at] = absorb(now[at], child_block(nodes[first[at] + slot]))
    return finish(now, counts), states, up


#: One level of a path: the slot, the children of the parent, the state before the slot, the other children.
RECORD = np.dtype([("slot", "u1"), ("count", "u1"), ("state", ">u4", 8), ("others", "u1", (2, 32))])


def row_paths(nodes: np.ndarray, inner: np.ndarray, states: np.ndarray, levels: int, above: np.ndarray) -> np.ndarray:
    """(n, all levels) records of every node of a row, from what the row keeps and the path of its own node."""
    n = len(nodes)
    out = np.empty((n, levels + len(above)), RECORD)
    here = np.arange(n)
    at = kept = 0
    for j in range(levels):
        parent, slot = here // 3, here % 3
        size = len(nodes)
        count = np.minimum(3, size - 3 * parent)
        r = out[:, j]
        r["slot"], r["count"], r["state"] = slot, count, states[kept + parent, slot]
        for k, shift in enumerate(((1, 0, 0), (2, 2, 1))):
            other = 3 * parent + np.array(shift)[slot]
            r["others"][:, k] = nodes[np.minimum(other, size - 1)]
        up = -(-size // 3)
        nodes, at, kept, here = inner[at:at + up], at + up, kept + up, parent
    out[:, levels:] = above
    return out


def fold(digests: np.ndarray, paths: np.ndarray) -> np.ndarray:
    """Roots (n, 32) that replaced digests (n, 32) lead to along their paths (n, levels)."""
    for j in range(paths.shape[1]):
        r = paths[:, j]
        slot, count = r["slot"].astype(int), r["count"].astype(int)
        states = absorb(r["state"].astype(np.uint32), child_block(digests))
        for k in (1, 2):
            at = np.flatnonzero(slot + k < count)
            if len(at):
                # Right siblings: the last one or two of the others.
                states[at] = absorb(states[at], child_block(r["others"][at, slot[at] + k - 1]))
        digests = finish(states, count)
    return digests


def sibling_digest(path: np.ndarray) -> str:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    keep = np.arange(2) < path["count"][:, None] - 1
    return hashlib.sha256(path["others"][keep].tobytes().hex().encode()).hexdigest()


def _bytes32(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(-1, 32)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of nodes (last column: array of digests) -> the same with nodes as bytes, and node, inner, states."""
    for batch in batches:
        names, columns = batch.schema.names[:-1], batch.columns[:-1]
        lists = [b"".join(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
        left = np.array([min(CHUNK_LEVELS, levels_left(m)) for m in batch.column("m").to_pylist()], int)
        node: list = list(lists)
        inner, states = [[] for _ in lists], [[] for _ in lists]
        for levels in np.unique(left[left > 0]):
            rows = np.flatnonzero(left == levels)
            nodes = _bytes32(b"".join(lists[i] for i in rows))
            sizes = np.array([len(lists[i]) // 32 for i in rows])
            for _ in range(levels):
                nodes, kept, sizes = grow(nodes, sizes)
                cut = np.cumsum(sizes)[:-1]
                for i, a, b in zip(rows, np.split(nodes, cut), np.split(kept, cut)):
                    inner[i].append(a.tobytes())
                    states[i].append(b.astype("<u4").tobytes())
            for i, a in zip(rows, nodes):
                node[i] = a.tobytes()
        more = [lists, node, [b"".join(x) for x in inner], [b"".join(x) for x in states]]
        yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.binary()) for x in more)], names=[*names, "nodes", "node", "inner", "states"])


def _row(batch: pa.RecordBatch, i: int) -> np.ndarray:
    """Paths of all nodes of one row."""
    m, path, nodes, inner, states = (batch.column(c)[i].as_py() for c in ("m", "path", "nodes", "inner", "states"))
    levels = min(CHUNK_LEVELS, levels_left(m))
    return row_paths(_bytes32(nodes), _bytes32(inner), np.frombuffer(states, "<u4").reshape(-1, 3, 8), levels, np.frombuffer(path, RECORD))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A path for every node of a row."""
    for batch in batches:
        for i in range(batch.num_rows):
            paths = _row(batch, i)
            n, idx = len(paths), batch.column("idx")[i].as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("grp")[i].as_py()] * n, batch.schema.field("grp").type), pa.array(np.arange(n) + idx * CHUNK),
                 pa.array([p.tobytes() for p in paths], pa.binary())],
                names=["grp", "idx", "path"],
            )


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, leaf, subroot, proof_sha256, folded of every leaf."""
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS_AT_ONCE):
            rows = range(a, min(a + ROWS_AT_ONCE, batch.num_rows))
            paths = [_row(batch, i) for i in rows]
            changed = [_bytes32(b"".join(batch.column("changed")[i].as_py())) for i in rows]
            folded: list = [None] * len(paths)
            depth = np.array([p.shape[1] for p in paths])
            for levels in np.unique(depth):
                at = np.flatnonzero(depth == levels)
                some = fold(np.concatenate([changed[k] for k in at]), np.concatenate([paths[k] for k in at]))
                for k, part in zip(at, np.split(some, np.cumsum([len(paths[k]) for k in at])[:-1])):
                    folded[k] = part
            ids, leaf, subroot, proof, root = [], [], [], [], []
            for k, i in enumerate(rows):
                ids += batch.column("ids")[i].as_py()
                leaf += [x.tobytes() for x in _bytes32(batch.column("nodes")[i].as_py())]
                subroot += [batch.column("subroot")[i].as_py()] * len(paths[k])
                proof += [sibling_digest(p) for p in paths[k]]
                root += [x.tobytes() for x in folded[k]]
            columns = [pa.array(ids, pa.int64()), pa.array(leaf, pa.binary()), pa.array(subroot, pa.binary()), pa.array(proof), pa.array(root, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "leaf", "subroot", "proof_sha256", "folded"])


# ---------------------------------------------------------------- the tree on Spark
@dataclass
class Tree:
    """Steps of rows of nodes from the leaves up, and grp, node (the root) of every group."""

    steps: list[DataFrame]
    roots: DataFrame


def positions(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with pos (0, 1, ... in ``order`` within its grp) and m (rows of that group).

    A range sort numbers the rows of each partition; a group's offsets in its partitions are sums over one row
    per partition and group, so a group of any size is spread over as many partitions as it fills.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in ["grp", *order]]
    number = F.monotonically_increasing_id()
    placed = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("nr", number)
    placed = materialize(placed.select("*", F.shiftright("nr", 33).alias("part")), name)
    runs = placed.groupBy("grp", "part").agg(F.min("nr").alias("head"), F.count("*").alias("n"))
    w = Window.partitionBy("grp")
    before = F.sum("n").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    runs = runs.select(F.col("grp").alias("g"), F.col("part").alias("p"), (before - F.col("head")).alias("shift"), F.sum("n").over(w).alias("m"))
    both = placed.join(runs, placed["grp"].eqNullSafe(runs["g"]) & (placed["part"] == runs["p"]))
    return both.select(*rows.columns, (F.col("nr") + F.col("shift")).alias("pos"), "m")


def tree(placed: DataFrame, payload: dict[str, Column], name: str) -> Tree:
    """Rows grp, pos, m, node -> the tree of every group; ``payload``: arrays that leaves' rows keep besides."""
    steps, roots = [], None
    row = F.sort_array(F.collect_list(F.struct("pos", "node", *[c for c in placed.columns if c not in ("grp", "pos", "m", "node")])))
    while True:
        grouped = placed.groupBy("grp", F.expr(f"pos div {CHUNK}").alias("idx"), "m").agg(row.alias("row"))
        grouped = grouped.select("grp", "idx", "m", *[c.alias(k) for k, c in payload.items()], F.col("row.node").alias("nodes"))
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in grouped.schema.fields[:-1]]
        schema = ", ".join([*fields, "nodes binary", "node binary", "inner binary", "states binary"])
        step = materialize(grouped.mapInArrow(_build, schema), f"{name}{len(steps) + 1}")
        steps.append(step)
        done = step.where(F.col("m") <= CHUNK).select("grp", "node")
        roots = done if roots is None else roots.unionByName(done)
        placed = step.where(F.col("m") > CHUNK).select("grp", F.col("idx").alias("pos"), F.expr(f"(m + {CHUNK - 1}) div {CHUNK}").alias("m"), "node")
        if placed.isEmpty():
            return Tree(steps, roots)
        payload, row = {}, F.sort_array(F.collect_list(F.struct("pos", "node")))


def with_paths(built: Tree, root_paths: DataFrame) -> DataFrame:
    """The leaves' rows of a tree with the path of each row's node; ``root_paths``: grp, path of the roots."""
    above = None
    for k in range(len(built.steps) - 1, -1, -1):
        step = built.steps[k]
        top = step.where(F.col("m") <= CHUNK).select("grp").join(
            root_paths.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g"))).select("grp", F.lit(0).cast("long").alias("idx"), "path")
        paths = top if above is None else top.unionByName(above)
        paths = paths.select(F.col("grp").alias("g"), F.col("idx").alias("i"), "path")
        step = step.join(paths, F.col("grp").eqNullSafe(F.col("g")) & (F.col("idx") == F.col("i"))).drop("g", "i")
        if k == 0:
            return step
        kind = step.schema["grp"].dataType.simpleString()
        above = materialize(step.mapInArrow(_paths, f"grp {kind}, idx long, path binary"), "op11-paths")


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def record_digest(*values: Column) -> Column:
    """SHA-256 of the framed values, as bytes."""
    return F.unhex(F.sha2(F.concat(*[framed(v) for v in values]).cast("binary"), 256))


def manifest_proofs(leaves: DataFrame) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root: one row per row of ``leaves`` (grp, id, node, changed).

    ``node`` is the leaf's digest, ``changed`` the digest that is tested in its place along the original tree;
    digests come out as lowercase hex. Leaves ascend by id within their group, a null id first, and equal ids by
    digest, so repeated rows are neighbours and each has a place of its own. A null group is the first group. An
    empty table gives an empty result.
    """
    placed = positions(leaves, ["id", "node", "changed"], "op11-leaves")
    groups = tree(placed, {"ids": F.col("row.id"), "changed": F.col("row.changed")}, "op11-tree")
    # The groups' roots are the leaves of one more tree.
    tops = groups.roots.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "node")
    tops = tree(positions(tops, ["name"], "op11-roots"), {"names": F.col("row.name")}, "op11-top")
    first = tops.roots.first()
    root = first["node"] if first else b""
    nothing = tops.roots.select("grp", F.lit("").cast("binary").alias("path"))
    # The leaves' rows of the top tree: a path for every group's root.
    rows = with_paths(tops, nothing)
    paths = rows.mapInArrow(_paths, "grp int, idx long, path binary")
    names = rows.select(F.col("idx").alias("row"), F.posexplode("names").alias("k", "name")).select((F.col("row") * CHUNK + F.col("k")).alias("n"), "name")
    by_group = materialize(paths.join(names, F.col("idx") == F.col("n")).select(F.col("name").alias("grp"), "path"), "op11-group-paths")
    rows = with_paths(groups, by_group)
    subroots = groups.roots.select(F.col("grp").alias("g"), F.col("node").alias("subroot"))
    rows = rows.join(subroots, F.col("grp").eqNullSafe(F.col("g"))).drop("grp", "g", "node")
    proven = rows.mapInArrow(_prove, "id long, leaf binary, subroot binary, proof_sha256 string, folded binary")
    text = lambda c: F.lower(F.hex(c))
    return proven.select(
        "id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), F.lit(root.hex()).alias("root"), "proof_sha256", text("folded").alias("folded_root")
    )


def op11_merkle(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    doc_id, source, lang, n_chars, text = (F.col(c) for c in FIELDS)
    tampered = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(2)) == 0
    node = record_digest(doc_id, source, lang, n_chars, text)
    changed = F.when(tampered, record_digest(doc_id, source, lang, n_chars, F.replace(text, F.lit("\n"), F.lit("")))).otherwise(node)
    leaves = docs.select(source.cast("string").alias("grp"), doc_id.cast("long").alias("id"), node.alias("node"), changed.alias("changed"))
    return manifest_proofs(leaves).withColumnRenamed("id", "doc_id").withColumn("verified", F.col("folded_root") == F.col("root"))


_FRAME = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_CHANGED = "CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"

ORACLE_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: list_reduce([xor(c, b)] || list_transform(range(8), lambda i: i::BIGINT), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
  FROM documents
), t AS (
  SELECT doc_id, source, sha256({" || ".join(_FRAME.format(c) for c in FIELDS)}) AS leaf,
         sha256({" || ".join(_FRAME.format(c) for c in FIELDS[:-1])} || {_FRAME.format("(" + _CHANGED + ")")}) AS changed
  FROM d
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS pos, count(*) OVER (PARTITION BY source) AS m FROM t
), tree AS (
  SELECT source, 0 AS level, pos, leaf AS digest, m FROM leaves
  UNION ALL
  SELECT source, any_value(level) + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(m) + 2) // 3 FROM tree WHERE m > 1 GROUP BY source, pos // 3
), subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS m FROM tree WHERE m = 1
), top AS (
  SELECT 0 AS level, pos, subroot AS digest, m FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(m) + 2) // 3 FROM top WHERE m > 1 GROUP BY pos // 3
), climb AS (
  SELECT source, pos AS leaf_pos, 0 AS level, pos, m, changed AS now, '' AS proof FROM leaves
  UNION ALL
  SELECT c.source, c.leaf_pos, any_value(c.level) + 1, any_value(c.pos) // 3, (any_value(c.m) + 2) // 3,
         sha256(string_agg(CASE WHEN t.pos = c.pos THEN c.now ELSE t.digest END, '' ORDER BY t.pos)),
         any_value(c.proof) || coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (WHERE t.pos <> c.pos), '')
  FROM climb c JOIN tree t ON t.source IS NOT DISTINCT FROM c.source AND t.level = c.level AND t.pos // 3 = c.pos // 3
  WHERE c.m > 1 GROUP BY c.source, c.leaf_pos
), up AS (
  SELECT c.source, c.leaf_pos, 0 AS level, s.pos, s.m, c.now, c.proof FROM climb c JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source WHERE c.m = 1
  UNION ALL
  SELECT c.source, c.leaf_pos, any_value(c.level) + 1, any_value(c.pos) // 3, (any_value(c.m) + 2) // 3,
         sha256(string_agg(CASE WHEN t.pos = c.pos THEN c.now ELSE t.digest END, '' ORDER BY t.pos)),
         any_value(c.proof) || coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (WHERE t.pos <> c.pos), '')
  FROM up c JOIN top t ON t.level = c.level AND t.pos // 3 = c.pos // 3
  WHERE c.m > 1 GROUP BY c.source, c.leaf_pos
)
SELECT l.doc_id, l.leaf, s.subroot, r.digest AS root, sha256(u.proof) AS proof_sha256, u.now AS folded_root, u.now = r.digest AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
JOIN up u ON u.source IS NOT DISTINCT FROM l.source AND u.leaf_pos = l.pos AND u.m = 1
CROSS JOIN (SELECT digest FROM top WHERE m = 1) r
"""
