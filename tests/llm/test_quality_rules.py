import random
import re

import numpy as np
from pyspark.sql import functions as F

from txrisk.llm import quality_rules as Q

from .conftest import SF


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for starts in windows.values() if len(starts) > 1 for i in starts for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_equal_brute_force(spark, edge_docs):
    r = random.Random(5)
    texts = [" ".join(r.choice("abc") for _ in range(r.randint(0, 60))) + r.choice(["", "\n", "\r\n x", " #| é\x1c"]) * r.randint(0, 3) for _ in range(300)]
    for t in texts:
        assert Q.text_statistics(t)[:5] == brute_counts(t), t
    rows = Q.statistics(edge_docs).select(*Q.COUNTS).collect()
    want = [brute_counts(x["text"]) for x in edge_docs.select("text").collect()]
    assert sorted(map(tuple, rows)) == sorted(want)


def test_rules_cover_what_separates_and_nothing_else():
    r = np.random.default_rng(2)
    n = 4000
    x = {"a": r.random(n), "b": r.random(n), "c": r.integers(0, 3, n).astype(float)}
    bad = ((x["a"] > 0.8) & (x["b"] <= 0.4)) | (x["c"] > 1.5) & (x["b"] > 0.9)
    rules = Q.cover(x, bad, r.random(n) < 1 / 3)
    hit = np.zeros(n, bool)
    for tests in rules.rules:
        hit |= Q._holds(list(tests), x, n)
    assert (hit & bad).sum() >= 0.97 * bad.sum() and (hit & ~bad).sum() <= 0.01 * n
    # Labels by chance, or of one kind, teach nothing.
    assert Q.cover(x, r.random(n) < 0.1, r.random(n) < 1 / 3).rules == ()
    assert Q.cover(x, np.zeros(n, bool), r.random(n) < 1 / 3).rules == () and Q.cover({"a": np.zeros(0)}, np.zeros(0, bool), np.zeros(0, bool)).rules == ()


def test_expression_decides_as_the_list(spark):
    x = {"a": np.array([0.0, 0.5, 1.0, 2.0]), "b": np.array([1.0, 1.0, 0.0, 0.0])}
    rules = Q.DecisionList(((Q.Bound("a", True, 0.7), Q.Bound("b", False, 0.5)), (Q.Bound("a", False, 0.25),)))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x["a"], x["b"])], "a double, b double")
    assert [r[0] for r in df.select(rules.rule()).collect()] == [2, None, 1, 1]
    assert rules.lines()[0] == "1: a > 0.7 and b <= 0.5"
    assert df.select(Q.DecisionList(()).rule().alias("r")).where("r is not null").count() == 0


def test_judged_edge_rows(spark, edge_docs):
    labels = spark.createDataFrame([(1, 0, 0), (9, None, 0), (None, 1, 0), (12, 1, 0), (12, 0, 1)], "doc_id long, quality int, toxic int")
    out = Q.judge(edge_docs, labels)
    assert out.count() == edge_docs.count() and out.where("kept and (base_failed or rule is not null)").count() == 0
    got = {(r["doc_id"], r["n_words"]): r["kept"] for r in out.collect()}
    assert got[(1, 0)] is False and got[(9, 120)] is True and got[(7, 60_000)] is True
    assert Q.judge(edge_docs.limit(0), labels).count() == 0 and Q.judge(edge_docs, labels.limit(0)).where("rule is not null").count() == 0
    kept = Q.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.where("doc_id = 1").count() == 0


def test_held_out_labels(spark):
    sf = SF.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 1
    out = Q.judge(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels.where(~held)).join(labels, "doc_id").where(held)
    low, good = out.where("quality = 0"), out.where("quality = 1 and not base_failed")
    assert low.where("not kept").count() >= 0.97 * low.count() and good.where("kept").count() >= 0.995 * good.count()
