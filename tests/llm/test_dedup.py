import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from txrisk.llm import minhash as M
from txrisk.llm.components import components
from txrisk.llm.exact_dedup import exact_dedup, keep_first_copies

from .conftest import plain_rows


def test_exact_dedup_equals_brute_force(spark, edge_docs):
    groups = defaultdict(list)
    for i, t in plain_rows(edge_docs):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i is None, i or 0, i))
    want = []
    for norm, rows in groups.items():
        rows.sort()
        sha = hashlib.sha256(norm.encode()).hexdigest()
        want += [(str(r[3]), str(rows[0][3]), len(rows), k == 0, sha) for k, r in enumerate(rows)]
    got = [(str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup(edge_docs).collect()]
    assert sorted(got) == sorted(want)


def test_exact_dedup_group_over_many_partitions(spark):
    # One text has most rows, so that its run goes on over several partitions.
    texts = ["copy"] * 700 + [f"text {k}" for k in range(100)] + ["c o p y"] * 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    rows = exact_dedup(docs).collect()
    assert len(rows) == len(texts) and sum(r["kept"] for r in rows) == 101
    assert {(r["keep_id"], r["group_size"]) for r in rows if r["group_size"] > 1} == {(800, 750)}


def test_exact_stage_keeps_columns(spark, edge_docs):
    kept = keep_first_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len({re.sub(r"[\x20\x09-\x0D]", "", t) for _, t in plain_rows(edge_docs)})
    assert exact_dedup(edge_docs.limit(0)).count() == 0


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if x]
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows]
    names = {}
    for i, s in sets:
        if i is not None and s:
            names[frozenset(s)] = min(i, names.get(frozenset(s), i))
    classes = [(i, s) for s, i in names.items()]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(classes):
        for j, t in classes[a + 1:]:
            if 100 * len(s & t) >= percent * len(s | t):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sets, lambda i, s: root(names[frozenset(s)]) if s else i


def check_near(docs, percent):
    rows = plain_rows(docs)
    sets, root = brute_components(rows, percent)
    want = sorted((i, len(s), root(i, s), i == root(i, s)) for i, s in sets if i is not None)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in M.near_duplicates(docs, percent).collect()]
    assert sorted(g for g in got if g[0] is not None) == want
    assert len(got) == len(rows)


def test_near_duplicates_edge_cases(spark, edge_docs):
    check_near(edge_docs, 85)
    assert M.near_duplicates(edge_docs.limit(0)).count() == 0


@pytest.mark.parametrize("percent,block", [(85, 256), (80, 8)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, percent, block):
    monkeypatch.setattr(M, "BLOCK", block)
    r = random.Random(percent)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(6):
        base = [r.choice(words) for _ in range(r.choice([7, 60, 200]))]
        for _ in range(25):
            t = list(base)
            for _ in range(r.randint(0, max(1, len(t) // 25))):
                t[r.randrange(len(t))] = r.choice(words)
            rows.append((len(rows), " ".join(t)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check_near(docs, percent)


def test_sketch_is_filled_and_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 5000):
        s = M.sketches([rng.integers(0, 2**63, n).astype(np.uint64)])
        assert (s != M._MAX).all()
    a, b = (np.unique(rng.integers(0, 2**63, 2000).astype(np.uint64)) for _ in range(2))
    for share in (0.5, 0.9):
        k = int(2000 * share)
        x, y = a, np.unique(np.concatenate([a[:k], b[: 2000 - k]]))
        true = k / (4000 - k)
        s = M.sketches([x, y], 1000)
        assert abs((s[0] == s[1]).mean() - true) < 0.06
    assert (M.sketches([np.zeros(0, np.uint64)]) == M._MAX).all()


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, 150), (150, 120), (150, 130), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(k, k) == 0 for k in range(21)) and {got.get(k, k) for k in (100, 120, 130, 150)} == {100}
