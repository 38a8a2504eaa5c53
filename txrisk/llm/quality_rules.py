"""Document quality by a learned decision list (operator 12).

Every text becomes a row of statistics. From the labelled rows, sequential covering learns an ordered list of
rules against low quality: a rule is grown, one threshold test at a time, by information gain on two thirds of
the rows, pruned on the other third, and what it covers leaves the rows before the next rule is grown. The list
is emitted as one conditional expression over the statistics, which Spark evaluates inside its generated code.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, read_table

#: Words of a window that counts as repeated, and the limits of the fixed rules.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: Labelled rows that the list is learnt from, at most (those with the least hashes of their id).
FIT_ROWS = 20_000
#: A rule must cover so many low-quality rows, and be right on this share of the rows it covers.
MIN_COVER = 5
MIN_PRECISION = 0.9
#: A condition must add so much information (bits) to be worth a test.
MIN_GAIN = 5.0

#: The characters that the contract counts as symbols, and its white space.
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"

_CAPITALS = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_lines", "n_distinct", "n_capitals", "n_digits", "n_marks", "n_stops", "longest"]
_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS + _MORE)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found at least twice in the text; equal windows are numbered exactly."""
    if len(words) <= window:
        return 0
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    name, span = ids, 1
    while span < window:
        # Equal strings of 2 * span words (or the whole window) are equal pairs of strings of span words.
        step = min(span, window - span)
        _, name, n = np.unique(name[:-step] * (name.max() + 1) + name[step:], return_inverse=True, return_counts=True)
        if n.max() == 1:
            return 0
        span += step
    again = np.flatnonzero(n[name] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[again] += 1
    np.subtract.at(edges, again + window, 1)
    return int((np.cumsum(edges) > 0).sum())


def text_statistics(text: str) -> tuple[int, ...]:
    """COUNTS and _MORE of one text."""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), len(set(words)), len(raw) - len(raw.translate(None, _CAPITALS)), len(raw) - len(raw.translate(None, _DIGITS)),
        raw.count(b"!") + raw.count(b"?"), raw.count(b"."), max(map(len, words), default=0),
    )


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *COUNTS, *_MORE]
    for batch in batches:
        rows = [text_statistics(t.as_py() or "") for t in batch.column(1)]
        columns = list(zip(*rows)) if rows else [[]] * (len(names) - 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), pa.int64()) for c in columns)], names=names)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the contract and further ones: one row per row of ``docs``; a null text has no words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_statistics, _SCHEMA)


def _share(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def features() -> dict[str, Column]:
    """What rules may test, by name: shares, so that they hold for texts of any length, and the length itself."""
    return {
        "length": F.col("n_words").cast("double"),
        "chars_per_word": _share("word_chars", "n_words"),
        "symbols_per_word": _share("n_symbols", "n_words"),
        "duplicate_lines": _share("n_dup_lines", "n_lines"),
        "repeated_words": _share("n_repeat_words", "n_words"),
        "words_per_line": _share("n_words", "n_lines"),
        "distinct_words": _share("n_distinct", "n_words"),
        "capitals": _share("n_capitals", "word_chars"),
        "digits": _share("n_digits", "word_chars"),
        "marks_per_word": _share("n_marks", "n_words"),
        "stops_per_word": _share("n_stops", "n_words"),
        "longest_word": F.col("longest").cast("double"),
    }


@dataclass(frozen=True)
class Bound:
    """``feature <= limit``, or ``feature > limit``."""

    feature: str
    above: bool
    limit: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.limit) if self.above else value <= F.lit(self.limit)

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        value = x[self.feature]
        return value > self.limit if self.above else value <= self.limit

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.limit:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Conjunctions against low quality, in order: the first that holds decides, and texts that none fits are good."""

    rules: tuple[tuple[Bound, ...], ...]

    def rule(self) -> Column:
        """The number of the first rule that holds, from 1; null where none does."""
        out = None
        for k, tests in enumerate(self.rules):
            fits = tests[0].column()
            for t in tests[1:]:
                fits = fits & t.column()
            out = F.when(fits, k + 1) if out is None else out.when(fits, k + 1)
        return F.lit(None).cast("int") if out is None else out

    def lines(self) -> list[str]:
        return [f"{k + 1}: {' and '.join(map(str, tests))}" for k, tests in enumerate(self.rules)]


def _best_test(x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Bound | None]:
    """The test with the most information gained about ``bad`` rows; ties go to the first feature and least limit."""
    n_bad, n = bad.sum(), len(bad)
    before = np.log2(n_bad / n)
    best, found = 0.0, None
    for name, value in x.items():
        order = np.argsort(value, kind="stable")
        v, below_bad = value[order], np.cumsum(bad[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        limits = (v[cut] + v[cut + 1]) / 2
        limits = np.where(limits < v[cut + 1], limits, v[cut])  # neighbours may have no number between them
        for above in (False, True):
            covered = n - cut - 1 if above else cut + 1
            hit = n_bad - below_bad[cut] if above else below_bad[cut]
            gain = np.zeros(len(cut))
            some = hit > 0
            gain[some] = hit[some] * (np.log2(hit[some] / covered[some]) - before)
            k = int(np.argmax(gain))
            if gain[k] > best + 1e-9:
                best, found = float(gain[k]), Bound(name, above, float(limits[k]))
    return best, found


def _take(x: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[rows] for k, v in x.items()}


def _holds(tests: list[Bound], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for t in tests:
        out &= t.holds(x)
    return out


def cover(x: dict[str, np.ndarray], bad: np.ndarray, pruning: np.ndarray, min_cover: int = MIN_COVER, min_precision: float = MIN_PRECISION) -> DecisionList:
    """Sequential covering: rules grown on rows that are not ``pruning``, pruned on those that are.

    A grown rule loses its last tests while that raises (right - wrong) / covered on the pruning rows. The list
    ends when the next rule covers fewer than ``min_cover`` low-quality rows in all, or is right on less than
    ``min_precision`` of the rows it covers. Without rows of both kinds it is empty.
    """
    rules: list[tuple[Bound, ...]] = []
    left = np.ones(len(bad), bool)
    while True:
        grow, prune = np.flatnonzero(left & ~pruning), np.flatnonzero(left & pruning)
        tests: list[Bound] = []
        gx, gb = _take(x, grow), bad[grow]
        while 0 < gb.sum() < len(gb):
            gain, test = _best_test(gx, gb)
            if test is None or gain < MIN_GAIN:
                break
            tests.append(test)
            keep = np.flatnonzero(test.holds(gx))
            gx, gb = _take(gx, keep), gb[keep]
        px, pb = _take(x, prune), bad[prune]

        def worth(n):
            hit = _holds(tests[:n], px, len(pb))
            return ((pb & hit).sum() - (~pb & hit).sum()) / max(1, hit.sum())

        # The shortest of the best prefixes.
        size = max(range(1, len(tests) + 1), key=lambda n: (worth(n), -n), default=0)
        hit = _holds(tests[:size], x, len(bad)) & left
        if not size or (hit & bad).sum() < min_cover or (hit & bad).sum() < min_precision * hit.sum():
            return DecisionList(tuple(rules))
        rules.append(tuple(tests[:size]))
        left &= ~hit


def learn(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DecisionList:
    """The decision list from rows of :func:`statistics` with ``labels`` (doc_id, quality; 0 is low).

    Rows that the fixed rules reject teach nothing, nor do null labels. Beyond ``fit_rows`` labelled rows, those
    with the least hashes of their id are taken, so the same rows are learnt from however they are stored; a third
    of them, by another hash, is for pruning. The driver holds these rows' numbers only.
    """
    judged = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.min("quality").alias("__quality"))
    rows = stats.where(~base_failed()).join(judged, F.col("doc_id") == F.col("__id"))
    columns = features()
    sample = rows.select(
        F.xxhash64("doc_id").alias("__hash"), *[c.alias(k) for k, c in columns.items()], (F.col("__quality") == 0).alias("__bad"),
        (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0).alias("__prune"),
    ).orderBy("__hash", *columns).limit(fit_rows).toArrow()
    x = {k: sample.column(k).to_numpy() for k in columns}
    flags = [sample.column(k).to_numpy(zero_copy_only=False).astype(bool) for k in ("__bad", "__prune")]
    return cover(x, *flags)


def base_failed() -> Column:
    """The fixed rules: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, the counts, base_failed, rule (number of the learnt rule that rejects the text, or null), kept.

    One row per row of ``docs``. A null, empty or blank text has no words and fails; repeated rows and ids are
    each judged by their own text; labels of a repeated id count as low if any is. Without labels of both kinds
    only the fixed rules decide. An empty table gives an empty result; other columns are not read. Texts are
    read once: the statistics are written and read again.
    """
    stats = materialize(statistics(docs), "op12-statistics")
    rules = learn(stats, labels, fit_rows)
    named = stats.select("doc_id", *COUNTS, base_failed().alias("base_failed"), *[c.alias(k) for k, c in features().items()])
    return named.select("doc_id", *COUNTS, "base_failed", rules.rule().alias("rule")).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` whose id :func:`judge` keeps (for repeated ids: all of whose rows it keeps), all columns."""
    kept = judge(docs, labels, fit_rows).groupBy(F.col("doc_id").alias("__id")).agg(F.min("kept").alias("__kept")).where("__kept").select("__id")
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["__id"]), "left_semi")


def op12_quality_rules(spark, sf_dir):
    return judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
