"""Benchmark decontamination by word seeds and Smith-Waterman alignment (operator 5).

The words of the test items are looked up in every training text. A text can only reach an item's score where
enough of the item's words stand close enough together; every such place is found (the bounds below lose none)
and a local alignment of the item with the words there scores copies that were cut, edited or reworded, however
often the same words occur elsewhere in the corpus. The test items go to the tasks in blocks of bounded size, so
each block scans the corpus once, whatever the number of items.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, releasing

#: An alignment must be worth so many fitting words in a row (the whole item, if it is shorter): one or two
#: common words are no copy of a short item. Items of seven words and more need more than this anyway.
GRAM = 3
#: Alignment: a word that fits, one that differs, one that is missing or added.
MATCH, MISMATCH, GAP = 2.0, -1.0, -1.0
#: Share of the item's best possible score from which a text counts as contaminated.
MIN_SCORE = 0.45
#: Words of test items that one block holds, about.
BLOCK_WORDS = 1_000_000
#: Words whose number one worker remembers; a memory bound, it changes no result.
CACHE_WORDS = 150_000

_STRIP = ".,;:!?\"'()[]{}<>*#$%&|«»“”„‘’¿¡…-–—_/\\"


def plain(word: str) -> str:
    """A lower-case word without the punctuation around it; punctuation alone stays."""
    return word.strip(_STRIP) or word


def tokens(text: str) -> list[str]:
    return [plain(w) for w in text.lower().split()]


class Index:
    """Test items of one block: word numbers (0: in no item), and for every word the items that have it, how often."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item_ids, self.words, vocab = [], [], {}
        for item, text in items:
            w = tokens(text)
            if w:
                self.item_ids.append(item)
                self.words.append(np.array([vocab.setdefault(x, len(vocab) + 1) for x in w], np.int64))
        self.vocab = vocab
        self.base = len(vocab) + 1
        lengths = np.array([len(w) for w in self.words], np.int64)
        pairs = np.concatenate([np.zeros(0, np.int64), *self.words]) * max(len(self.words), 1) + np.repeat(np.arange(len(lengths)), lengths)
        pairs, self.times = np.unique(pairs, return_counts=True)
        self.items = pairs % max(len(self.words), 1)
        self.first = np.searchsorted(pairs // max(len(self.words), 1), np.arange(self.base + 1))
        self.lengths = lengths
        self.bags = [np.unique(w, return_counts=True) for w in self.words]
        self.known: dict[str, int] = {}

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def grams(self, numbers: np.ndarray) -> np.ndarray:
        """Keys of the grams at every place; a gram with a word of no item is -1; a shorter text is one gram."""
        n = min(GRAM, len(numbers))
        key, whole = np.zeros(len(numbers) - n + 1, np.int64), np.ones(len(numbers) - n + 1, bool)
        for j in range(n):
            part = numbers[j:len(numbers) - n + 1 + j]
            # Numbers stay below 2**21 in a block, so three fit a key.
            key, whole = key * self.base + part, whole & (part > 0)
        return np.where(whole, key, -1)

    def numbers(self, text: str) -> np.ndarray:
        words = text.lower().split()
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = self.vocab.get(plain(w), 0)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def covered(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How many words of each item can fit, at most, where these distinct words occur so often."""
        n = self.first[words + 1] - self.first[words]
        at = np.repeat(self.first[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.items[at], weights=np.minimum(self.times[at], np.repeat(counts, n)), minlength=len(self.words))

    def least(self, min_score: float) -> np.ndarray:
        """The score each item needs."""
        return np.maximum(min_score * MATCH * self.lengths, MATCH * np.minimum(GRAM, self.lengths))


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman score with linear gaps, and the aligned words [start, end) of the text.

    Of equal scores the earliest end counts. Rows go over the item; the best of all gaps within a row is a
    running maximum. Starts are carried along with the scores.
    """
    n = len(text)
    ramp = -GAP * np.arange(n + 1)
    before, start_before = np.zeros(n + 1), np.arange(n + 1)
    best, best_start, best_end = 0.0, 0, 0
    for w in item:
        fit = np.where(text == w, MATCH, MISMATCH)
        diagonal, up = before[:-1] + fit, before[1:] + GAP
        row, start = np.zeros(n + 1), np.arange(n + 1)
        row[1:] = np.maximum(diagonal, up)
        start[1:] = np.where(diagonal >= up, start_before[:-1], start_before[1:])
        low = row <= 0
        row[low], start[low] = 0.0, np.arange(n + 1)[low]
        # Gaps in the item: the best earlier cell minus its distance.
        shifted = row + ramp
        run = np.maximum.accumulate(shifted)
        first = np.maximum.accumulate(np.where(shifted == run, np.arange(n + 1), 0))
        gain = run - ramp
        better = gain > row
        row, start = np.where(better, gain, row), np.where(better, start[first], start)
        k = int(row.argmax())
        if row[k] > best:
            best, best_start, best_end = float(row[k]), int(start[k]), k
        before, start_before = row, start
    return best, best_start, best_end


def places(hits: np.ndarray, length: int, least: float) -> Iterator[tuple[int, int]]:
    """Where in a text an alignment can reach the score; ``hits`` are the places of the item's words.

    An alignment gains MATCH at most for a word of the item and loses -MISMATCH or -GAP (equal) for any other, so only runs of
    hits that one such sum can span matter. It never spans more than length + (MATCH * length - least) words,
    so long runs are cut into pieces that overlap by as much.
    """
    worth = np.arange(len(hits)) * int(MATCH - MISMATCH) - hits
    low = np.minimum.accumulate(worth)
    if (worth - low).max(initial=0) + MATCH < least:
        return
    reach = np.maximum.accumulate(worth[::-1])[::-1] - low + MATCH >= least
    edge = np.flatnonzero(np.diff(np.concatenate([[False], reach, [False]])))
    span = int(length + MATCH * length - least) + 1
    for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()):
        lo, end = int(hits[i]), int(hits[j - 1]) + 1
        while True:
            hi = min(end, lo + 4 * span)
            yield lo, hi
            if hi == end:
                break
            lo = hi - span


def matches(index: Index, text: str, min_score: float = MIN_SCORE) -> list[tuple[int, float, int, int, int]]:
    """(item_id, score, seeds, start, end) of the items that align with the text, best place of each."""
    numbers = index.numbers(text)
    at = np.flatnonzero(numbers)
    if not len(at):
        return []
    held = numbers[at]
    least = index.least(min_score)
    can = MATCH * index.covered(*np.unique(held, return_counts=True)) >= least
    found: dict[int, tuple] = {}
    own = np.zeros(index.base, np.int64)
    for i in np.flatnonzero(can).tolist():
        item = index.words[i]
        top = MATCH * len(item)
        words, times = index.bags[i]
        own[words] = times
        for lo, hi in places(at[own[held] > 0], len(item), least[i]):
            part = numbers[lo:hi]
            # No alignment scores more than the words of the item that the place holds.
            have, n = np.unique(part[own[part] > 0], return_counts=True)
            if MATCH * np.minimum(n, own[have]).sum() < least[i]:
                continue
            score, start, end = align(item, part)
            if score < least[i]:
                continue
            seeds = int(np.isin(index.grams(part[start:end]), index.grams(item)).sum()) if end - start >= min(GRAM, len(item)) else 0
            row = (index.item_ids[i], score / top, seeds, lo + start, lo + end)
            if row[0] not in found or row[1] > found[row[0]][1]:
                found[row[0]] = row
        own[words] = 0
    return list(found.values())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _blocks(texts: DataFrame, benchmark: DataFrame) -> Iterator:
    """Broadcasts of the indexes, one per block of test items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n_blocks = 1 + words // BLOCK_WORDS
    for k in range(n_blocks):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == k).collect()
        index = Index(sorted(((r["item_id"], r["text"]) for r in block), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        if index.words:
            yield texts.sparkSession.sparkContext.broadcast(index)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, item_id, score, seeds, start_word, end_word: the best place of each item in each text that holds it.

    ``score`` is the alignment's share of the item's best score, 1 for a whole copy; ``seeds`` counts the item's
    three-word grams among the aligned words (none where every third word differs); words are counted from 0,
    the end excluded. Items of up to six words need three fitting words in a row, or all if they are fewer. Texts that hold no item give no row. Null and empty texts and items match nothing; items
    that share an id give their best match; repeated rows of documents give repeated rows. Either table may be
    empty. Only doc_id, item_id and text are read.
    """
    texts = _texts(docs)
    schema = "doc_id long, item_id long, score double, seeds long, start_word long, end_word long"
    out = []
    for shared in _blocks(texts, benchmark):

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows = [(doc.as_py(), *m) for doc, text in zip(batch.column(0), batch.column(1)) for m in matches(index, text.as_py(), min_score)]
                columns = list(zip(*rows)) if rows else [[]] * 6
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["doc_id", "item_id", "score", "seeds", "start_word", "end_word"])
            index.known.clear()

        out.append(texts.mapInArrow(releasing(scan), schema))
    return reduce(DataFrame.unionByName, out) if out else docs.sparkSession.createDataFrame([], schema)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""
    out = docs
    for shared in _blocks(_texts(docs), benchmark):
        out = out.where(~_holds(shared, min_score)(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return out


def _holds(shared, min_score: float):
    @releasing
    def judge(batches):
        index = shared.value
        for texts in batches:
            yield texts.map(lambda t: bool(matches(index, t, min_score))).astype(bool)
        index.known.clear()  # a worker that goes on with other work shouldn't hold the words

    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from judge(batches)

    return holds


def op5_decontaminate(spark, sf_dir):
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
