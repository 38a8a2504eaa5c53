"""Scores of a log-bilinear language model trained by noise-contrastive estimation (operator 3).

Tokens are lower-cased words and one end per document. The model predicts a token's class from the classes of
the two tokens before: the frequent words are classes of their own, all others are classed by their last two
bytes. A context vector is the sum of one vector per context position, a class scores its product with the
class vector plus a bias, and a softmax over all classes normalises; within a class, words follow their
add-one counts with one place for unseen words. Word counts and class trigrams are counted over all training
documents; the class trigrams, at most CLASSES ** 3 numbers, are all that the driver trains on. Every batch of
contexts is normalised by one matrix product. Counts of rare words reach the scores through a join, so no
vocabulary has to fit anywhere.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, partition_id, read_table, text_bytes

#: Classes of the model: the end, frequent words, last bytes, and the rest.
CLASSES = 160
HEAD = 79
TAILS = 79
END, OTHER = 0, CLASSES - 1
#: Words whose counts go along to the tasks; the counts of all others are joined.
FREQUENT = 100_000
#: Training: vector length, steps, contexts a step, noise classes a step.
DIMENSION = 24
STEPS = 1_500
BATCH = 4_096
NOISE = 64
#: Words that one worker counts or remembers at a time; a memory bound, it changes no result.
COUNT_WORDS = 300_000
MEMO_WORDS = 500_000


def held_out() -> Column:
    """The contract's fold: crc32 of the id as text, modulo 7, is 2. A null id is in no fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def tail_of(word: bytes) -> bytes:
    return word[-2:]


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def vocabulary(texts: DataFrame) -> DataFrame:
    """word, c: how often each token occurs; the empty word is the end."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out():
            b = _batch({"word": pa.array(list(seen), pa.binary()), "c": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return b

        for batch in batches:
            for text in batch.column(0):
                seen.update(words_of(text.as_py()))
                seen[b""] += 1
                if len(seen) > COUNT_WORDS:
                    yield out()
        yield out()

    return texts.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Classes:
    """Class of every word, tokens and distinct words of every class, counts of the frequent words."""

    head: dict[bytes, int]
    tails: dict[bytes, int]
    tokens: np.ndarray
    distinct: np.ndarray
    frequent: dict[bytes, int]

    def of(self, word: bytes) -> int:
        if not word:
            return END
        k = self.head.get(word)
        return self.tails.get(tail_of(word), OTHER) if k is None else k

    def within(self, k: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 of a word's probability in its class, from its count; the end and frequent words are alone there."""
        alone = (k == END) | ((k >= 1) & (k <= len(self.head)))
        return np.where(alone, 0.0, np.log10((count + 1.0) / (self.tokens[k] + self.distinct[k] + 1.0)))


def word_classes(vocab: DataFrame) -> Classes:
    # The least count that at most FREQUENT words reach, by steps of an eighth of an octave: no global sort.
    words = vocab.where("length(word) > 0").withColumn("step", F.floor(8 * F.log2("c")).cast("int"))
    steps, reached = sorted(((r["step"], r["n"]) for r in words.groupBy("step").agg(F.count("*").alias("n")).collect()), reverse=True), 0
    least = steps[0][0] if steps else 0
    for step, n in steps:
        reached += n
        if reached > FREQUENT:
            break
        least = step
    top = words.where(F.col("step") >= least).select("word", "c").toArrow()
    pairs = sorted(zip(top.column("word").to_pylist(), top.column("c").to_pylist()), key=lambda p: (-p[1], p[0]))
    frequent = dict(pairs[:max(FREQUENT, HEAD)])
    head = {w: k + 1 for k, w in enumerate(list(frequent)[:HEAD])}

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, distinct = Counter(), Counter()
        for batch in batches:
            for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word and word not in head:
                    tokens[tail_of(word)] += c
                    distinct[tail_of(word)] += 1
        names = list(tokens)
        yield _batch({"tail": pa.array(names, pa.binary()), "c": pa.array([tokens[t] for t in names], pa.int64()), "v": pa.array([distinct[t] for t in names], pa.int64())})

    # At most 256 + 256 ** 2 last bytes.
    rows = vocab.mapInArrow(tails, "tail binary, c long, v long").groupBy("tail").agg(F.sum("c").alias("c"), F.sum("v").alias("v")).collect()
    rows.sort(key=lambda r: (-r["c"], bytes(r["tail"])))
    tail_class = {bytes(r["tail"]): HEAD + 1 + k for k, r in enumerate(rows[:TAILS])}
    tokens, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rows:
        k = tail_class.get(bytes(r["tail"]), OTHER)
        tokens[k] += r["c"]
        distinct[k] += r["v"]
    ends = vocab.where("length(word) = 0").first()
    frequent[b""] = int(ends["c"]) if ends else 0
    return Classes(head, tail_class, tokens, distinct, frequent)


def class_trigrams(texts: DataFrame, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """(code, count) of all class trigrams; a text is preceded by two ends."""
    shared = texts.sparkSession.sparkContext.broadcast(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(shared.value, None)
        seen = np.zeros(CLASSES**3, np.int32)
        for batch in batches:
            for text in batch.column(0):
                at = memo.numbers(words_of(text.as_py()))
                np.add.at(seen, trigram_codes(memo.classes[at]), 1)
        at = np.flatnonzero(seen)
        yield _batch({"code": pa.array(at), "n": pa.array(seen[at].astype(np.int64))})

    rows = texts.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    code, n = (rows.column(c).to_numpy() for c in ("code", "n"))
    order = np.argsort(code)
    return code[order], n[order]


def trigram_codes(k: np.ndarray) -> np.ndarray:
    before = np.concatenate([[END, END], k]).astype(np.int64)
    return (before[:-2] * CLASSES + before[1:-1]) * CLASSES + before[2:]


class Memo:
    """Numbers of words met by one worker, with their classes and, for frequent words, their log10 scores."""

    def __init__(self, classes: Classes, totals: tuple[int, int] | None):
        self.c, self.totals = classes, totals
        self.reset()

    def reset(self):
        self.index: dict[bytes, int] = {}
        self.classes = np.zeros(1 << 16, np.int64)
        self.base, self.inner, self.rare = np.zeros(1 << 16), np.zeros(1 << 16), np.zeros(1 << 16, bool)

    def _learn(self, words: list[bytes]):
        start = len(self.index)
        while start + len(words) > len(self.classes):
            for name in ("classes", "base", "inner", "rare"):
                a = getattr(self, name)
                setattr(self, name, np.concatenate([a, np.zeros_like(a)]))
        self.index.update((w, start + i) for i, w in enumerate(words))
        part = slice(start, start + len(words))
        k = np.array([self.c.of(w) for w in words], np.int64)
        self.classes[part] = k
        if self.totals is not None:
            n, v = self.totals
            count = np.array([self.c.frequent.get(w, -1) for w in words], float)
            self.rare[part] = count < 0
            count = np.maximum(count, 0)
            self.base[part] = np.log10((count + 1) / (n + v + 1))
            self.inner[part] = self.c.within(k, count)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words and the end."""
        if len(self.index) > MEMO_WORDS:
            self.reset()
        words = [*words, b""]
        new = set(words).difference(self.index)
        if new:
            self._learn(sorted(new))
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))


@dataclass
class LogBilinear:
    """Vectors of the classes at the two context positions and as predictions, and biases."""

    first: np.ndarray
    second: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def log10_table(self) -> np.ndarray:
        """Normalised log10 probabilities of every class after every pair of classes, by context code and class."""
        n = len(self.bias)
        out = np.empty((n * n, n), np.float32)
        for a in range(n):
            s = (self.first[a] + self.second) @ self.output.T + self.bias
            s -= s.max(axis=1, keepdims=True)
            s -= np.log(np.exp(s).sum(axis=1, keepdims=True))
            out[a * n:(a + 1) * n] = s / np.log(10)
        return out


def train(codes: np.ndarray, counts: np.ndarray, n: int = CLASSES, steps: int = STEPS, seed: int = 1) -> LogBilinear:
    """Noise-contrastive estimation on counted trigrams: classes drawn from the class frequencies are the noise."""
    rng = np.random.default_rng(seed)
    total = np.bincount(codes % n, weights=counts, minlength=n) + 0.5
    noise = total / total.sum()
    model = LogBilinear(
        rng.normal(0, 0.1, (n, DIMENSION)), rng.normal(0, 0.1, (n, DIMENSION)), rng.normal(0, 0.1, (n, DIMENSION)), np.log(noise),
    )
    if not len(codes):
        return model
    params = [model.first, model.second, model.output, model.bias]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    cumulated, noise_cumulated = np.cumsum(counts), np.cumsum(noise)
    log_noise = np.log(noise) + np.log(NOISE)
    for t in range(1, steps + 1):
        pick = codes[np.searchsorted(cumulated, rng.integers(0, cumulated[-1], BATCH), side="right")]
        a, b, w = pick // n // n, pick // n % n, pick % n
        z = np.minimum(np.searchsorted(noise_cumulated, rng.random(NOISE)), n - 1)
        context = model.first[a] + model.second[b]
        # Real tokens should be told from the noise, and each context meets the same drawn noise.
        real = 1 / (1 + np.exp((context * model.output[w]).sum(1) + model.bias[w] - log_noise[w]))
        fake = 1 / (1 + np.exp(-(context @ model.output[z].T + model.bias[z] - log_noise[z])))
        g_context = real[:, None] * model.output[w] - fake @ model.output[z]
        spread = lambda rows, values: _sum_rows(rows, values, n)
        g = [
            spread(a, g_context), spread(b, g_context),
            spread(w, real[:, None] * context) - spread(z, fake.T @ context),
            np.bincount(w, weights=real, minlength=n) - np.bincount(z, weights=fake.sum(0), minlength=n),
        ]
        rate = 0.03 * (1 - t / (steps + 1)) + 0.001
        for k, p in enumerate(params):
            step = g[k] / BATCH
            m1[k] = 0.9 * m1[k] + 0.1 * step
            m2[k] = 0.99 * m2[k] + 0.01 * step * step
            p += rate * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.99**t)) + 1e-8)
    return model


def _sum_rows(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    order = np.argsort(rows, kind="stable")
    first = np.flatnonzero(np.diff(rows[order], prepend=-1))
    out = np.zeros((n, values.shape[1]))
    out[rows[order][first]] = np.add.reduceat(values[order], first)
    return out


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per input row.

    Null texts count as empty: their only token is the end. Rows without an id train and are scored. Repeated
    rows count as often as they occur. Without training documents every token has base score 0 and the model is
    nearly uniform over its classes. An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_bytes("text").alias("text"))
    texts = rows.where("not held_out").select("text")
    vocab = materialize(vocabulary(texts), "op3-vocabulary")
    totals = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = int(totals["n"]), int(totals["v"])
    classes = word_classes(vocab)
    model = train(*class_trigrams(texts, classes))
    shared = spark.sparkContext.broadcast((classes, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, model = shared.value
        memo, table, key = Memo(classes, (n, v)), model.log10_table().ravel(), partition_id() << 33
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for doc, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = words_of(text.as_py())
                at = memo.numbers(words)
                rare = memo.rare[at]
                often = at[~rare]
                k = memo.classes[at]
                found = Counter([words[i] for i in np.flatnonzero(rare).tolist()])
                row = (
                    key, doc, held, len(at), int((~rare).sum()) if n else 0, float(memo.base[often].sum()),
                    float(table[trigram_codes(k)].sum(dtype=np.float64) + memo.inner[often].sum()), list(found), list(found.values()),
                )
                key += 1
                for column, value in zip(out, row):
                    column.append(value)
            types = {
                "key": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_often": pa.int64(),
                "base": pa.float64(), "model": pa.float64(), "words": pa.list_(pa.binary()), "times": pa.list_(pa.int32()),
            }
            yield _batch({c: pa.array(x, t) for x, (c, t) in zip(out, types.items())})

    part = materialize(rows.mapInArrow(
        run, "key long, doc_id long, held_out boolean, n_tokens long, n_often long, base double, model double, words array<binary>, times array<int>",
    ), "op3-scores")
    # Rare words of the texts meet their counts; words without any have none.
    tails = part.select("key", F.explode(F.arrays_zip("words", "times")).alias("w")).select("key", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    met = tails.join(vocab, "word", "left").select("key", "word", "times", F.coalesce("c", F.lit(0)).alias("c"))
    sums = class_scores(met, shared, n, v).groupBy("key").agg(F.sum("known").alias("known"), F.sum("base").alias("more_base"), F.sum("model").alias("more_model"))
    zero = F.lit(0.0)
    return part.join(sums, "key", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_often") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("more_model", zero)).alias("score"),
    )


def class_scores(met: DataFrame, shared, n: int, v: int) -> DataFrame:
    """key, known, base, model: partial sums of the rare words' scores from their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value[0]
        for batch in batches:
            times = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            count = batch.column(3).to_numpy(zero_copy_only=False)
            k = np.array([classes.of(w) for w in batch.column(1).to_pylist()], np.int64)
            yield _batch({
                "key": batch.column(0),
                "known": pa.array(np.where(count > 0, times, 0).astype(np.int64)),
                "base": pa.array(times * np.log10((count + 1.0) / (n + v + 1.0))),
                "model": pa.array(times * classes.within(k, count)),
            })

    return met.mapInArrow(run, "key long, known long, base double, model double")


def op3_lm_score(spark, sf_dir):
    return score(read_table(spark, sf_dir, "documents"))
