"""Exact, reproducible stratified splits and samples.

Sizes follow scikit-learn's rules (test = ceil(n * test_size); per-class
quotas by floor + largest remainder of the train share), but the random
permutation is replaced by the order of md5(seed:key), so the same rows
are chosen for any partitioning of the input. Ties between equal
remainders go to the smaller class label instead of a random one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions import hash_key
from txrisk.operators.selection import at_or_before, rank_cutoffs
from txrisk.plans.persist import materialize, passes_over
from txrisk.schema import KEY, TARGET

H = "_h"


MAX_CLASSES = 1000  # a guard: more values are an error, nothing is dropped


def approximate_mode(class_counts: dict, n_draws: int) -> dict:
    """Per-class draws proportional to counts: floor, then largest remainders."""
    total = sum(class_counts.values())
    cont = {c: n * n_draws / total for c, n in class_counts.items()}
    floored = {c: int(math.floor(v)) for c, v in cont.items()}
    need = n_draws - sum(floored.values())
    order = sorted(class_counts, key=lambda c: (-(cont[c] - floored[c]), c))
    for c in order[:need]:
        floored[c] += 1
    return floored


def split_quotas(class_counts: dict, test_size: float) -> tuple[dict, dict]:
    """(train, test) rows per class of one stratified split."""
    n = sum(class_counts.values())
    n_test = int(math.ceil(test_size * n))
    train = approximate_mode(class_counts, n - n_test)
    return train, {c: class_counts[c] - train[c] for c in class_counts}


def _class_counts(df: DataFrame, label: str) -> dict:
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()  # one row per class
    if any(r[label] is None for r in rows):
        raise ValueError(f"label column '{label}' has NULLs")
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"label column '{label}' has more than {MAX_CLASSES} values: not a class label")
    return {r[label]: int(r["count"]) for r in rows}


def _with_hash(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn(H, hash_key(seed, F.col(key)))


def _assign(df: DataFrame, label: str, key: str, cuts_by_class: dict, names: list[str], col: str) -> DataFrame:
    """names[i] for rows up to the i-th cutoff of their class, names[-1] after the last."""
    expr = None
    for c, cuts in cuts_by_class.items():
        in_class = F.col(label) == F.lit(c)
        for cut, name in zip(cuts, names):
            if cut is None:
                continue
            cond = in_class & at_or_before(H, key, cut)
            expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = F.lit(names[-1])
    return df.withColumn(col, last if expr is None else expr.otherwise(last))


def _cutoffs(df, label, key, ranks_by_class, counts=None):
    """ranks_by_class: {class: [end rank (exclusive) of each leading part]} -> cutoff rows."""
    targets = [(c, r - 1) for c, ranks in ranks_by_class.items() for r in ranks if r > 0]
    found = {}
    if targets:
        with passes_over(df.select(label, key, H)) as data:
            found = rank_cutoffs(data, H, key, label, targets, max(counts.values()) if counts else None)
    return {c: [found.get((c, r - 1)) if r > 0 else None for r in ranks] for c, ranks in ranks_by_class.items()}


def stratified_split(
    df: DataFrame, test_size: float = 0.2, val_size: float = 0.15, seed: int = 42,
    label: str = TARGET, key: str = KEY, col: str = "split", write: str | None = None,
) -> DataFrame:
    """Column ``split`` in {train, val, test} with exact stratified sizes.

    test = ceil(n * test_size); then val = ceil(n' * val_size / (1 - test_size))
    of the remaining n' rows, both stratified by ``label``. With ``write`` the rows are written once under that
    name together with their hash, so the passes over the splits that follow compare a stored number instead of
    computing it again for every row and comparison.
    """
    if write:
        df = materialize(_with_hash(df, key, seed), write)
    counts = _class_counts(df, label)
    _, test_q = split_quotas(counts, test_size)
    rest = {c: counts[c] - test_q[c] for c in counts}
    val_ratio = val_size / (1 - test_size)
    _, val_q = split_quotas(rest, val_ratio) if val_size > 0 else (rest, {c: 0 for c in rest})
    hashed = df if write else _with_hash(df, key, seed)
    cuts = _cutoffs(hashed, label, key, {c: [test_q[c], test_q[c] + val_q[c]] for c in counts}, counts)
    return _assign(hashed, label, key, cuts, ["test", "val", "train"], col).drop(H)


def holdout(
    train: DataFrame, size: float = 0.15, seed: int = 42, label: str = TARGET, key: str = KEY, col: str = "part",
) -> DataFrame:
    """E5: column ``part`` in {fit, holdout}: an exact stratified share of the training rows for tuning.

    The rows are ordered by another hash than the split, so the holdout is no prefix of it.
    """
    parts = stratified_split(train, size, 0.0, seed + 1, label, key, col)
    return parts.withColumn(col, F.when(F.col(col) == "test", "holdout").otherwise("fit"))


def split_report(split_df: DataFrame, label: str = TARGET, col: str = "split") -> DataFrame:
    """E1 report: rows, positives, positive rate and share of all rows per split."""
    g = split_df.groupBy(col).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == 1).alias("n_fraud"),
        F.avg(F.col(label).cast("double")).alias("fraud_rate"),
    )
    from pyspark.sql import Window

    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))  # <= 3 rows


def stratified_subsample(df: DataFrame, n: int, seed: int = 42, label: str = TARGET, key: str = KEY) -> DataFrame:
    """Exactly n rows keeping class shares; everything when n >= rows."""
    counts = _class_counts(df, label)
    if n >= sum(counts.values()):
        return df
    quota = approximate_mode(counts, n)
    hashed = _with_hash(df, key, seed)
    cuts = _cutoffs(hashed, label, key, {c: [quota[c]] for c in counts}, counts)
    keep = None
    for c, (cut,) in cuts.items():
        if cut is None:
            continue
        cond = (F.col(label) == F.lit(c)) & at_or_before(H, key, cut)
        keep = cond if keep is None else keep | cond
    return hashed.filter(keep if keep is not None else F.lit(False)).drop(H)


def kfold_allocation(class_counts: dict, k: int) -> dict:
    """Rows per (class, fold) as scikit-learn's StratifiedKFold allocates them.

    The sorted label array is dealt round-robin to the k folds.
    """
    alloc, start = {}, 0
    for c in sorted(class_counts):
        end = start + class_counts[c]
        # positions j in [start, end) with j % k == i
        alloc[c] = [len(range(start + ((i - start) % k), end, k)) for i in range(k)]
        start = end
    return alloc


def stratified_kfold(df: DataFrame, k: int = 5, seed: int = 42, label: str = TARGET, key: str = KEY, col: str = "fold") -> DataFrame:
    """Fold number 0..k-1 per row; each class spread over folds by the allocation above."""
    if k < 2:
        raise ValueError("k must be at least 2")
    counts = _class_counts(df, label)
    alloc = kfold_allocation(counts, k)
    ends = {c: [sum(alloc[c][: i + 1]) for i in range(k - 1)] for c in counts}
    hashed = _with_hash(df, key, seed)
    cuts = _cutoffs(hashed, label, key, ends, counts)
    out = _assign(hashed, label, key, cuts, [str(i) for i in range(k)], col)
    return out.withColumn(col, F.col(col).cast("int")).drop(H)


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str = KEY) -> DataFrame:
    """Exactly min(n, rows) rows without replacement, the first n in hash order."""
    hashed = _with_hash(df, key, seed)
    total = hashed.count()
    if n >= total:
        return df
    if n <= 0:
        return df.limit(0)
    with passes_over(hashed.select(key, H)) as data:
        cut = rank_cutoffs(data, H, key, None, [(None, n - 1)], total)[(None, n - 1)]
    return hashed.filter(at_or_before(H, key, cut)).drop(H)


def union_splits(split_df: DataFrame, parts=("train", "val"), col: str = "split") -> DataFrame:
    """G1: rows of the given splits together (duplicates kept), as one DataFrame."""
    frames = [split_df.filter(F.col(col) == p) for p in parts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
