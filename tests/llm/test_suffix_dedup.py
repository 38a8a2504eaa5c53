import hashlib
import random

import pytest
from pyspark.sql import functions as F

from txrisk.llm import suffix_dedup as S


def brute(texts, n):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d, b in enumerate(data):
        for i in range(len(b) - n + 1):
            seen.setdefault(b[i:i + n], []).append((d, i))
    gone = [bytearray(len(b)) for b in data]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i:i + n] = b"\1" * n
    out = []
    for b, g in zip(data, gone):
        runs = sum(1 for i in range(len(g)) if g[i] and (i == 0 or not g[i - 1]))
        kept = bytes(x for x, y in zip(b, g) if not y)
        out.append((len(b), sum(g), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcé") for _ in range(r.randint(1, 6)))
    passages = [" ".join(word() for _ in range(r.randint(6, 30))) for _ in range(6)]
    texts = [None, "", "ab", "x" * 100, "ab" * 60, "ab" * 60]
    for _ in range(n):
        parts = [" ".join(word() for _ in range(r.randint(1, 25)))]
        for p in r.sample(passages, r.randint(0, 3)):
            a = r.randint(0, 10)
            parts += [p[a:a + r.randint(5, 200)], " ".join(word() for _ in range(r.randint(1, 10)))]
        texts.append(" ".join(parts))
    return texts + texts[10:14]


@pytest.mark.parametrize("seed,range_rows", [(1, 10**6), (2, 40), (3, 7)])
def test_equals_brute_force(spark, seed, range_rows):
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string").repartition(5)
    out = S.remove_repeats(docs, min_len=24, gram=8, range_rows=range_rows)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["h"]) for r in out.withColumn("h", F.sha2("kept", 256)).collect()}
    want = brute(texts, 24)
    assert [got[i] for i in range(len(texts))] == want


def test_stretches_cover_every_window_in_chunks(monkeypatch):
    text = "".join(random.Random(4).choice("ab ") for _ in range(1000)).encode()
    for chunk in (64, 1 << 21):
        monkeypatch.setattr(S, "CHUNK", chunk)
        seen = []
        for start, windows, lead, _ in S.stretches(text, 24, 8):
            seen += [a + k for a, n in zip(start.tolist(), windows.tolist()) for k in range(n)]
            assert (lead >= windows - 1).all() and (lead + 8 <= 24 + windows - 1).all()
        assert seen == list(range(len(text) - 23))


def test_loser_tree_merges_front_coded_runs():
    r = random.Random(5)
    for _ in range(50):
        runs = [sorted(bytes(r.choice(b"ab") for _ in range(r.randint(0, 9))) for _ in range(r.randint(0, 8))) for _ in range(r.randint(1, 9))]
        merged = list(S.LoserTree([iter([(k, rest, None) for k, rest in S.front_code(run)]) for run in runs]))
        assert [m[1] for m in merged] == sorted(x for run in runs for x in run)
        for a, b in zip(merged, merged[1:]):
            assert b[0] == S.common_prefix(a[1], b[1])


def test_null_ids_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "ab" * 40), (None, None), (1, "q" * 23), (1, "r" * 24)], "doc_id long, text string")
    rows = S.remove_repeats(docs, min_len=24, gram=8).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in rows) == [(0, 0, 0), (23, 0, 0), (24, 0, 0), (80, 80, 1)]
    assert S.remove_repeats(docs.limit(0), min_len=24, gram=8).count() == 0


@pytest.mark.parametrize("range_rows", [20_000, 40])
def test_passages_of_known_length_at_production_settings(spark, range_rows):
    """With 400 bytes and grams of 96: shared passages of 350 and 399 bytes stay, those of 400 and 450 go, whole."""
    r = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzé"
    word = lambda: "".join(r.choice(letters) for _ in range(r.randint(2, 9)))
    filler = lambda: " ".join(word() for _ in range(r.randint(5, 60)))

    def passage(n):
        text = b""
        while len(text) < n:
            text += (word() + " ").encode()
        text = text[:n]
        while True:
            try:
                text.decode()
                return text.decode()
            except UnicodeDecodeError:
                text = text[:-2] + b"x" * 2

    lengths = [350, 399, 400, 450, 2000]
    passages = {n: passage(n) for n in lengths}
    assert all(len(p.encode()) == n for n, p in passages.items())
    # A mark of its own next to every copy, so that no shared string is longer than the passage.
    texts, held = [], []
    for i in range(150):
        n = lengths[i % 5] if i < 100 else None
        mark = chr(65 + i // 5)
        texts.append(f"{filler()} {i}{mark}" + (passages[n] if n else filler()) + f"{mark}{i} {filler()}")
        held.append(n)
    texts += [texts[120]] * 3 + [None, "", "#" * 399, "~" * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {x["doc_id"]: x for x in S.remove_repeats(docs, range_rows=range_rows).collect()}
    for i, (n_bytes, removed, spans, digest) in enumerate(brute(texts, 400)):
        x = got[i]
        assert (x["n_bytes"], x["n_removed"], x["n_spans"], hashlib.sha256(bytes(x["kept"])).hexdigest()) == (n_bytes, removed, spans, digest)
    for i, n in enumerate(held[:100]):
        assert got[i]["n_removed"] == (n if n >= 400 else 0)
