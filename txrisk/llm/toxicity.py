"""Toxicity by multiple-instance learning (operator 6).

A document is a bag of sentences and only the bag has a label. Each sentence gets a logistic score from its
words and their beginnings; the document's score is the noisy-or of its sentences, each counted by what it has
above the bias, so that sentences without any weighted word add nothing, however many there are. The weights
are trained through the noisy-or, so the sentences that carry a label are found without sentence labels, and
scoring returns them as spans.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, releasing

#: Labelled documents that the model is fitted on, about, and their characters in all: whole texts of any length,
#: fewer where they are long. Scoring reads every row in full.
FIT_ROWS = 8_000
FIT_CHARS = 24_000_000
#: Chance of the label without any cause in the text; fitting only.
LEAK = 0.01
#: Logit of a sentence without any weighted word.
BIAS = -5.0
#: Pull of every weight towards 0, so that words which met the label by chance lose theirs.
SPARSE = 0.2
#: Score above the bias from which sentences add up in the noisy-or.
COUNTS = 0.3
#: Documents of the fitting sample in which a feature must occur.
MIN_DOCS = 3
STEPS = 120
#: Words whose weight one worker remembers; a memory bound, it changes no score.
CACHE_WORDS = 150_000

_BREAK = " \x00. "
_STRIP = ".,;:!?\"'()[]{}<>*#$%&|"
_ENDS = (".", "!", "?")


def features(word: str) -> list[str]:
    """A word without its punctuation, and its beginnings of four and five letters."""
    w = word.strip(_STRIP).lower()
    if not w:
        return []
    return ["=" + w] + [str(n) + w[:n] for n in (4, 5) if len(w) > n]


@dataclass
class Model:
    """Weights of features, a sentence's bias; features without a weight count 0."""

    weights: dict[str, float]
    bias: float
    index: dict[str, int] = field(default_factory=dict)

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "index": {}}

    def reset(self):
        self.index = {}
        self.word_weight = np.zeros(1 << 16)
        self.word_ends = np.zeros(1 << 16, bool)

    def _learn(self, words: set[str]):
        for w in words:
            at = self.index[w] = len(self.index)
            if at >= len(self.word_weight):
                self.word_weight = np.concatenate([self.word_weight, np.zeros_like(self.word_weight)])
                self.word_ends = np.concatenate([self.word_ends, np.zeros_like(self.word_ends)])
            self.word_weight[at] = sum(self.weights.get(f, 0.0) for f in features(w))
            self.word_ends[at] = w[-1] in _ENDS

    def sentences(self, text: str) -> np.ndarray:
        """Logits of the text's sentences; a sentence ends with . ! ? at the end of a word, or with its line."""
        words = text.replace("\n", _BREAK).split()
        if not words:
            return np.zeros(0)
        if not self.index or len(self.index) > CACHE_WORDS:
            self.reset()
        new = set(words).difference(self.index)
        if new:
            self._learn(new)
        at = np.fromiter(map(self.index.__getitem__, words), "i8", len(words))
        ends = self.word_ends[at]
        # A line break ends the sentence of the word before it and is no word itself.
        broken = at == self.index.get(_BREAK.strip(), -1)
        ends[:-1] |= broken[1:]
        at, ends = at[~broken], ends[~broken]
        if not len(at):
            return np.zeros(0)
        ends[-1] = False
        starts = np.concatenate([[0], np.flatnonzero(ends) + 1])
        return self.bias + np.add.reduceat(self.word_weight[at], starts)

    def score(self, text: str) -> float:
        """The noisy-or of what the sentences have above the bias; weak ones count by the strongest of them only.

        So a clean text scores the same however long it is. A bias that alone is toxic (all labels were) counts in full.
        """
        z = self.sentences(text)
        if self.bias >= 0 or not len(z):
            return noisy_or(z)
        above = np.logaddexp(0.0, z) - np.logaddexp(0.0, self.bias)
        strong = above[above >= -np.log1p(-COUNTS)]
        return float(-np.expm1(-(strong.sum() if len(strong) else max(above.max(), 0.0))))

    def spans(self, text: str) -> list[dict]:
        """Character spans and scores of the sentences with a score of 0.5 or more."""
        found, start, end, z, has = [], None, None, self.bias, False

        def close():
            if has and z >= 0:
                found.append({"start": start, "end": end, "score": float(1 / (1 + np.exp(-z)))})

        for m in re.finditer(r"\n|[^\s]+", text):
            word = m.group()
            if word == "\n":
                close()
                z, has = self.bias, False
                continue
            if not has:
                start, has = m.start(), True
            end = m.end()
            z += sum(self.weights.get(f, 0.0) for f in features(word))
            if word[-1] in _ENDS:
                close()
                z, has = self.bias, False
        close()
        return found


def noisy_or(logits: np.ndarray) -> float:
    return float(-np.expm1(-np.logaddexp(0.0, logits).sum()))


def fit_sentences(texts: list[str], labels: list[int], steps: int = STEPS, min_docs: int = MIN_DOCS) -> Model:
    """Maximise the likelihood of the documents' labels under the noisy-or of their sentences (Adam, numpy)."""
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        # One class only: its smoothed rate for every sentence.
        rate = (y.sum() + 0.5) / (len(y) + 1.0)
        return Model({}, float(np.log(rate / (1 - rate))) - 3.0)
    vocab: dict[str, int] = {}
    doc_tokens, doc_sentences, sentence_doc = [], [], []
    for d, text in enumerate(texts):
        token, sentence = [], []
        for line in text.split("\n"):
            words: set[str] = set()
            for w in [*line.split(), None]:
                if w is not None:
                    words.add(w)
                if words and (w is None or w[-1] in _ENDS):
                    token += [vocab.setdefault(x, len(vocab)) for x in sorted(words)]
                    sentence += [len(sentence_doc)] * len(words)
                    sentence_doc.append(d)
                    words = set()
        doc_tokens.append(np.array(token, "i4"))
        doc_sentences.append(np.array(sentence, "i4"))
    token, token_sentence, sentence_doc = np.concatenate(doc_tokens), np.concatenate(doc_sentences), np.array(sentence_doc, "i4")
    del doc_sentences
    n_words = len(vocab)
    feature_id: dict[str, int] = {}
    f_word, f_id = array("i"), array("i")
    for w, k in vocab.items():
        for f in features(w):
            f_word.append(k)
            f_id.append(feature_id.setdefault(f, len(feature_id)))
    f_word, f_id = np.array(f_word, "i4"), np.array(f_id, "i4")
    names = list(feature_id)
    del vocab, feature_id
    # Documents of each class in which a feature occurs, one document at a time. A word's features are
    # neighbours in f_id, from first[word] on.
    first = np.searchsorted(f_word, np.arange(n_words + 1))
    in_pos, in_all = np.zeros(len(names)), np.zeros(len(names))
    for d, words in enumerate(doc_tokens):
        words = np.unique(words)
        n_of = first[words + 1] - first[words]
        at = np.repeat(first[words] - (np.cumsum(n_of) - n_of), n_of) + np.arange(n_of.sum())
        seen = np.unique(f_id[at])
        in_all[seen] += 1
        in_pos[seen] += y[d]
    del doc_tokens
    odds = np.log((in_pos + 0.1) / (y.sum() + 0.2)) - np.log((in_all - in_pos + 0.1) / ((1 - y).sum() + 0.2))
    # Start from shrunken log odds; only features seen often enough, and more often with the label, get a weight.
    live = (in_all >= min_docs) & (odds > 1.0)
    w = np.where(live, 0.5 * odds * in_all / (in_all + 5.0), 0.0)
    # Sentences without a cause add nothing, so nothing in the data could set their bias.
    bias = BIAS
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = bias + np.bincount(token_sentence, weights=np.bincount(f_word, weights=w[f_id], minlength=n_words)[token], minlength=len(sentence_doc))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        above = np.bincount(sentence_doc, weights=np.logaddexp(0, z) - np.logaddexp(0, bias), minlength=len(y))
        pull = (1 - y / (1 - (1 - LEAK) * np.exp(-above)))[sentence_doc]
        gz = p * pull
        g = np.bincount(f_id, weights=np.bincount(token, weights=gz[token_sentence], minlength=n_words)[f_word], minlength=len(w)) + 0.02 * w + SPARSE
        g = np.where(live, g, 0.0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 / (1 - 0.9**t)
        w -= step * m / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        w = np.maximum(w, 0.0)
    return Model({names[i]: float(w[i]) for i in np.flatnonzero(w > 0.01)}, float(bias))


def held_out(id_col: str = "doc_id") -> Column:
    """The contract's fold: crc32 of the id as text, modulo 5, is 0. A null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model from at most about ``rows`` labelled documents outside the held-out fold, taken by the hash of their id.

    Texts are taken whole, whatever their length, in the order of that hash until FIT_CHARS characters are reached;
    only a document that is longer than that by itself teaches nothing. Labels of one document are merged by their
    maximum; null labels and null ids teach nothing.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("__toxic"))
    n = known.count()
    share = min(1.0, rows / max(n, 1))
    known = known.where(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < int(share * 1_000_000))
    text = F.coalesce(F.col("text"), F.lit(""))
    bags = docs.select(F.col("doc_id").alias("__doc"), text.alias("__text"))
    # About ``rows`` rows of numbers: how long each document is, with the rows that repeat its id.
    sizes = bags.select("__doc", F.char_length("__text").alias("__chars")).join(known, F.col("__doc") == F.col("__id")).groupBy("__id").agg(
        F.max("__toxic").alias("__toxic"), F.sum("__chars").alias("__chars"), F.xxhash64("__id").alias("__hash")
    )
    fits = sorted((r["__hash"], r["__id"], r["__toxic"], r["__chars"]) for r in sizes.where(F.col("__chars") <= FIT_CHARS).collect())
    taken = np.searchsorted(np.cumsum([chars for *_, chars in fits]), FIT_CHARS, "right")
    chosen = docs.sparkSession.createDataFrame([(i, y) for _, i, y, _ in fits[:taken]], known.schema)
    sample = bags.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select("__doc", "__text", "__toxic").limit(rows + rows // 4).toArrow()
    bags = sorted(zip(*(sample.column(c).to_pylist() for c in ("__doc", "__text", "__toxic"))))
    del sample
    return fit_sentences([t for _, t, _ in bags], [int(y > 0) for _, _, y in bags])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted, spans: every document's noisy-or and its offending sentences.

    A null, empty or blank text has no sentence: score 0, no span. Repeated rows are scored as often as they occur.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        model.reset()
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                s = model.score(text)
                scores.append(s)
                spans.append(model.spans(text) if s >= 0.5 else [])
            predicted = [int(s >= 0.5) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(predicted, pa.int32()), pa.array(spans, span)],
                names=["doc_id", "score", "predicted", "spans"],
            )
        model.reset()  # a worker that goes on with other work shouldn't hold the words

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        releasing(run), "doc_id long, score double, predicted int, spans array<struct<start: long, end: long, score: double>>",
    )


def op6_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "spans")


def keep_inoffensive(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the model doesn't predict to be toxic, with all their columns."""
    model = fit(docs, labels)

    @releasing
    def judge(batches):
        model.reset()
        for texts in batches:
            yield texts.map(lambda t: model.score(t or "") >= 0.5).astype(bool)
        model.reset()

    @F.pandas_udf("boolean")
    def offends(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from judge(batches)

    return docs.where(~offends(F.coalesce(F.col("text").cast("string"), F.lit(""))))
