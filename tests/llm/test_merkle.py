import hashlib
import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(groups):
    """Per (group, k): leaf, subroot, root, proof, folded for groups {name: [(id, leaf, changed)]} in order."""

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([sha(*last[i:i + 3]) for i in range(0, len(last), 3)])
        return levels

    def path(levels, k):
        for nodes in levels[:-1]:
            a = k - k % 3
            yield [nodes[i] if i != k else None for i in range(a, min(a + 3, len(nodes)))]
            k //= 3

    trees = {g: climb([x[1] for x in rows]) for g, rows in groups.items()}
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    top = climb([trees[g][-1][0] for g in names])
    out = []
    for g, rows in groups.items():
        for k, (i, leaf, changed) in enumerate(rows):
            steps = [*path(trees[g], k), *path(top, names.index(g))]
            now = changed
            for step in steps:
                now = sha(*[now if x is None else x for x in step])
            out.append((i, leaf, trees[g][-1][0], top[-1][0], sha(*[x for step in steps for x in step if x]), now))
    return out


def test_states_resume_like_hashlib():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 243, 244):
        nodes = r.integers(0, 256, (n, 32), dtype=np.uint8)
        up, states, sizes = merkle.grow(nodes, np.array([n]))
        assert sizes.tolist() == [-(-n // 3)]
        for p, digest in enumerate(up):
            children = [x.tobytes().hex() for x in nodes[3 * p:3 * p + 3]]
            assert sha(*children) == digest.tobytes().hex()
            for slot in range(len(children)):
                # The kept state, the replacement and the right siblings alone give the parent of the replaced child.
                new = r.integers(0, 256, (1, 32), dtype=np.uint8)
                state = merkle.absorb(states[p:p + 1, slot], merkle.child_block(new))
                for c in nodes[3 * p + slot + 1:3 * p + len(children)]:
                    state = merkle.absorb(state, merkle.child_block(c[None]))
                want = sha(*children[:slot], new[0].tobytes().hex(), *children[slot + 1:])
                assert merkle.finish(state, np.array([len(children)]))[0].tobytes().hex() == want


def test_proofs_equal_brute_force(spark):
    # Groups of one row of nodes, of several, and of more than one step.
    sizes = {None: 1, "": 2, "b": 3, "é": 28, "a": 1300, "Z": 243, "y": 244}
    rows, groups = [], {}
    for g, n in sizes.items():
        groups[g] = []
        for k in range(n):
            leaf = sha(f"{g} {k}")
            changed = leaf if k % 2 else sha(f"changed {g} {k}")
            groups[g].append((k, leaf, changed))
            rows.append((g, k, bytes.fromhex(leaf), bytes.fromhex(changed)))
    leaves = spark.createDataFrame(rows[::-1], "grp string, id long, node binary, changed binary").repartition(5)
    got = sorted(tuple(r) for r in merkle.manifest_proofs(leaves).collect())
    assert got == sorted(brute(groups))
    assert merkle.manifest_proofs(leaves.limit(0)).count() == 0


def test_op11_equals_sql_on_odd_rows(spark, tmp_path):
    rows = [(i, f"text {i}\nline" if i % 3 else (None if i % 2 else ""), None if i % 5 == 0 else "en", ["s", None, "t\n", "", "é"][i % 5 if i < 40 else 0], i if i % 4 else None) for i in range(900)]
    rows += [(3, "text 3\nline", "en", "é", 3)] * 2
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
    docs = spark.createDataFrame(rows, schema).withColumn("grp", F.lit("x")).withColumn("node", F.lit(1)).withColumn("pos", F.lit(2))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    out = merkle.op11_merkle(spark, str(tmp_path))
    want = con.execute(merkle.ORACLE_SQL)
    order = [[d[0] for d in want.description].index(c) for c in out.columns]
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted(tuple(r[k] for k in order) for r in want.fetchall())
    for r in got:
        i = r[0]
        changed = zlib.crc32(str(i).encode()) % 2 == 0 and i % 3 != 0
        assert r[-1] is not changed
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert merkle.op11_merkle(spark, f"{tmp_path}/none").count() == 0
