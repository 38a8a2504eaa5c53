import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from txrisk.llm import decontaminate, lm_score, toxicity

from .conftest import SF, plain_rows

BAD = ["grumble", "slurry", "vexnot"]


def sentences(seed, n):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("the", "re", "in", "on", "ha", "st") for b in ("ti", "er", "and", "ou", "es")]
    out = []
    for k in range(n):
        s = [[r.choice(words) for _ in range(r.randint(3, 12))] for _ in range(r.randint(1, 8))]
        if k % 4 == 0:
            s[r.randrange(len(s))].insert(1, r.choice(BAD) + r.choice(["", "ing", "ed"]))
        out.append((k, ". ".join(" ".join(x) for x in s) + ".", int(k % 4 == 0)))
    return out


def test_toxicity_finds_held_out_documents_and_sentences(spark, edge_docs):
    rows = sentences(1, 400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scored = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [(i, t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(scored[i]["predicted"] == y for i, _, y in held) / len(held) >= 0.95
    found = [(t[s["start"]:s["end"]]) for i, t, y in held if y and scored[i]["predicted"] for s in scored[i]["spans"]]
    assert found and all(any(b in x for b in BAD) for x in found)
    # Odd rows: every one scored, no text no score.
    odd = toxicity.score(edge_docs, model).collect()
    assert len(odd) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    kept = toxicity.keep_inoffensive(edge_docs, labels.limit(0))
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    assert toxicity.score(edge_docs.limit(0), model).count() == 0


def test_noisy_or_and_sentences():
    m = toxicity.Model({"=bad": 4.0}, -2.0)
    z = m.sentences("Good one. Bad, bad! next\nline")
    assert np.allclose(z, [-2.0, 6.0, -2.0, -2.0])
    p = 1 / (1 + np.exp(-z))
    assert math.isclose(toxicity.noisy_or(z), 1 - np.prod(1 - p))
    text = "Good one. Bad, bad! next\nline"
    assert [text[s["start"]:s["end"]] for s in m.spans(text)] == ["Bad, bad!"]
    assert toxicity.noisy_or(m.sentences(" \n ")) == 0.0


def test_length_alone_is_not_toxic(spark):
    rows = sentences(1, 400)
    clean = [s + "." for _, t, y in rows if not y for s in t.split(".") if s.strip()]
    long_text = "\n".join(clean[k % len(clean)] for k in range(100_000))
    model = toxicity.fit_sentences([t for _, t, _ in rows], [y for _, _, y in rows])
    assert model.score(long_text) < 0.1
    assert model.score(long_text + "\nthe grumble ended.") >= 0.5
    # Weak sentences don't add up, causes do; without any toxic label no text is toxic.
    weak = toxicity.Model({"=bad": 6.0, "=odd": 1.0}, -5.0)
    assert weak.score("odd one.\n" * 100_000) < 0.1 < 0.9 < weak.score("bad one. " * 5)
    assert toxicity.fit_sentences(["a. b."], [0]).score(long_text) == 0.0


def test_long_labelled_texts_are_fitted(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit_sentences", lambda texts, labels: seen.append(sorted(map(len, texts))))
    ids = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5][:12]
    docs = spark.createDataFrame([(k, "word " * (40_000 if n == 3 else 10)) for n, k in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, n % 2) for n, k in enumerate(ids)], "doc_id long, toxic int")
    toxicity.fit(docs, labels)
    assert seen == [[50] * 11 + [200_000]]
    # Bounded by characters in all, not by the length of one text.
    monkeypatch.setattr(toxicity, "FIT_CHARS", 200)
    toxicity.fit(docs, labels)
    assert seen[1] == [50] * 4


def brute_base(rows):
    tokens = lambda t: [w for w in re.split(rb"[\x20\x09-\x0D]+", t.encode().lower()) if w] + [b""]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return sorted(
        (str(i), h, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6))
        for (i, t), h in zip(rows, held) for w in [tokens(t)]
    )


def lm_rows(df):
    return sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in df.collect())


@pytest.mark.parametrize("frequent", [lm_score.FREQUENT, 3])
def test_language_model_base_equals_brute_force(spark, edge_docs, monkeypatch, frequent):
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    monkeypatch.setattr(lm_score, "STEPS", 20)
    assert lm_rows(lm_score.score(edge_docs)) == brute_base(plain_rows(edge_docs))
    if frequent == 3:
        assert lm_score.score(edge_docs.limit(0)).count() == 0


def test_language_model_beats_word_frequencies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r for r in lm_score.score(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.97 * sum(r["base_score"] for r in rows)
    assert sum(r["score"] > r["base_score"] for r in rows) > 0.9 * len(rows)


def test_class_probabilities_are_normalised():
    rng = np.random.default_rng(0)
    codes = np.unique(rng.integers(0, lm_score.CLASSES**3, 500))
    table = lm_score.train(codes, np.ones(len(codes), np.int64), steps=5).log10_table()
    assert np.allclose((10.0 ** table.astype(float)).sum(axis=1), 1, atol=1e-3)
    # Within a class: all words and one place for unseen ones sum to 1.
    c = lm_score.Classes({}, {b"xx": 5}, np.full(lm_score.CLASSES, 10.0), np.full(lm_score.CLASSES, 3.0), {})
    assert math.isclose(sum(10 ** float(c.within(np.array([5]), np.array([n]))[0]) for n in (5, 4, 1, 0)), 1.0)


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            s = decontaminate.MATCH if x == y else decontaminate.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + decontaminate.GAP, h[i, j - 1] + decontaminate.GAP)
    return h.max()


def test_alignment_equals_full_matrix():
    r = random.Random(2)
    for _ in range(300):
        a, b = ([r.randint(1, 4) for _ in range(r.randint(1, 12))] for _ in range(2))
        score, start, end = decontaminate.align(np.array(a), np.array(b))
        assert score == smith_waterman(a, b)
        assert 0 <= start <= end <= len(b)
        if score:
            assert smith_waterman(a, b[start:end]) == score


def test_decontamination_finds_copies_and_leaves_clean_texts(spark, edge_docs):
    r = random.Random(7)
    words = [f"w{k}" for k in range(500)]
    items = [[r.choice(words) for _ in range(r.randint(12, 40))] for _ in range(20)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(98, None), (99, ""), (97, "tiny"), (0, " ".join(items[0]))], "item_id long, text string")
    rows, want = [], set()
    for k in range(200):
        text = [r.choice(words) for _ in range(80)]
        if k % 5 == 0:
            i = r.randrange(len(items))
            copy = [w for w in items[i] if r.random() > 0.07]
            if k % 10 == 0:
                copy = [w if r.random() > 0.1 else "changed" for w in copy]
            text[40:40] = [copy[0].upper() + ",", *copy[1:]]
            want.add((k, i))
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = decontaminate.contaminated(docs, bench).collect()
    assert {(x["doc_id"], x["item_id"]) for x in got} == want and len(got) == len(want)
    kept = decontaminate.keep_uncontaminated(docs, bench)
    assert {x["doc_id"] for x in kept.collect()} == {k for k, _ in rows} - {k for k, _ in want}
    assert decontaminate.contaminated(edge_docs, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_hot_partial_copies_are_found_beside_a_whole_copy(spark):
    r = random.Random(4)
    item = [f"w{k}" for k in range(40)]
    noise = lambda n: [f"n{r.randrange(300)}" for _ in range(n)]
    texts = [noise(30) + item[:20] + noise(30) for _ in range(60)] + [noise(20) + item + noise(5)]
    # Every third word differs, and every word has another one after it: no three words in a row are left.
    texts += [noise(9) + [w if k % 3 else "other" for k, w in enumerate(item)] + noise(9), noise(9) + [x for w in item for x in (w, "so")]]
    clean = [noise(30) + item[:17] + noise(30), r.sample(item, 16) + noise(40)]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts + clean)], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(0, " ".join(item)), (1, "w3 gone"), (2, "w3 w5 gone w7")], "item_id long, text string")
    got = decontaminate.contaminated(docs, bench).collect()
    assert {(x["doc_id"], x["item_id"]) for x in got} == {(k, 0) for k in range(len(texts))}
    assert {x["doc_id"] for x in decontaminate.keep_uncontaminated(docs, bench).collect()} == {len(texts), len(texts) + 1}


def test_places_lose_no_alignment():
    r = random.Random(5)
    for _ in range(400):
        words = [r.choice("abcdefghijkl") for _ in range(r.randint(1, 14))]
        text = [r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(0, 90))]
        copy = [x for w in words for x in ([w], [], ["z"], [w, "y"], [w])[r.randrange(5)]]
        text[len(text) // 2:len(text) // 2] = copy
        index = decontaminate.Index([(7, " ".join(words))])
        best, least = smith_waterman(words, text), index.least(decontaminate.MIN_SCORE)[0]
        got = decontaminate.matches(index, " ".join(text))
        assert [(g[0], g[1] * 2 * len(words)) for g in got] == ([(7, pytest.approx(best))] if best >= least else [])


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 30)
    bench = spark.createDataFrame([(k, " ".join(f"i{k}x{j}" for j in range(15))) for k in range(8)], "item_id long, text string")
    docs = spark.createDataFrame([(k, "so it goes " + " ".join(f"i{k}x{j}" for j in range(15))) for k in range(8)], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["start_word"], r["end_word"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(k, k, 3, 18) for k in range(8)}
