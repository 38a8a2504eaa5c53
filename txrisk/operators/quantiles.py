"""Exact quantiles without a single-buffer aggregate (building block P1).

Spark's ``percentile`` keeps every distinct value of a group in one
buffer, which does not survive billions of rows. Here an order statistic
of rank k is found by narrowing a value bracket:

1. ``percentile_approx`` (bounded-memory sketch, merged map-side) brackets
   the target rank,
2. one counting aggregate verifies the bracket (rows below it, rows and
   approximate distinct values inside it),
3. once the bracket holds few distinct values, ``groupBy(value).count()``
   over the bracket rows is collected (its size is checked first) and the
   exact rank is read off.

Brackets that hold too many distinct values are narrowed again with a
sketch restricted to the bracket. Every step is one distributed aggregate
for all requested quantiles together; nothing is collected whose size has
not been checked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions import chunked_aggregates
from txrisk.plans.persist import passes_over

ACCURACY = 10000
COLLECT_LIMIT = 20000  # distinct values per target
COLLECT_TOTAL = 200000  # distinct values per collect job


@dataclass
class _Target:
    col: str
    k0: int  # 0-based ranks among non-null values: the bracket must hold both
    k1: int
    inside: int  # rows in the bracket (starts as all non-null rows)
    lo: float | None = None  # bracket, inclusive; None = unbounded
    hi: float | None = None
    below: int = 0  # non-null rows < lo
    distinct: int | None = None  # approx. distinct values in the bracket; None = unknown
    margin: float = 2.0 / ACCURACY
    values: tuple | None = None
    done: bool = False

    def small(self) -> bool:
        return self.distinct is not None and self.distinct <= COLLECT_LIMIT

    def probs(self) -> tuple[float, float]:
        q_lo = (self.k0 - self.below + 0.5) / self.inside - self.margin
        q_hi = (self.k1 - self.below + 0.5) / self.inside + self.margin
        return max(0.0, q_lo), min(1.0, q_hi)


def _in_bracket(c, lo, hi):
    cond = c.isNotNull()
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return cond


def _sketch(df: DataFrame, targets: list[tuple[int, _Target]]) -> dict[int, tuple]:
    """One sketch per column for unbounded brackets (first round), one per target otherwise."""
    exprs, plan = [], []
    shared: dict[str, list[float]] = {}
    for i, t in targets:
        if t.lo is None and t.hi is None and t.below == 0:
            shared.setdefault(t.col, [])
            shared[t.col].extend(t.probs())
    by_col = {}
    if shared:
        # First round: one sketch per column for all probabilities.
        cols = list(shared)
        probs = sorted({p for ps in shared.values() for p in ps})
        rows = chunked_aggregates(df, [{"q": F.percentile_approx(F.col(c).cast("double"), probs, ACCURACY)} for c in cols])
        by_col = {c: dict(zip(probs, r["q"])) for c, r in zip(cols, rows)}
    for i, t in targets:
        if t.col in shared and t.lo is None and t.hi is None and t.below == 0:
            continue
        c = F.col(t.col)
        q_lo, q_hi = t.probs()
        masked = F.when(_in_bracket(c, t.lo, t.hi), c.cast("double"))
        exprs.append(F.percentile_approx(masked, [q_lo, q_hi], ACCURACY).alias(f"t_{i}"))
    row = df.agg(*exprs).first() if exprs else None
    out = {}
    for i, t in targets:
        q_lo, q_hi = t.probs()
        if t.col in by_col and t.lo is None and t.hi is None and t.below == 0:
            lo_v, hi_v = by_col[t.col][q_lo], by_col[t.col][q_hi]
        else:
            lo_v, hi_v = row[f"t_{i}"]
        # Where the sketch range reaches the end of the bracket, keep that side of it.
        out[i] = (t.lo if q_lo <= 0.0 else lo_v, t.hi if q_hi >= 1.0 else hi_v)
    return out


def _narrow(df: DataFrame, targets: list[tuple[int, _Target]]) -> None:
    """Sketch inside each bracket, then verify the new brackets with exact counts."""
    proposals = _sketch(df, targets)
    counts = _bracket_counts(df, [(i, t.col, *proposals[i]) for i, t in targets])
    row = {}
    for i, _ in targets:
        row[f"b{i}"], row[f"n{i}"] = counts[i]
    verified = []
    for i, t in targets:
        lo, hi = proposals[i]
        below, inside = int(row[f"b{i}"]), int(row[f"n{i}"])
        if below <= t.k0 and t.k1 < below + inside:
            t.lo, t.hi, t.below, t.inside = lo, hi, below, inside
            # A bracket with few rows has few distinct values; count distinct only for big ones.
            t.distinct = inside if inside <= COLLECT_LIMIT else None
            if lo is not None and lo == hi:
                t.values, t.done = (lo, lo), True
            elif t.distinct is None:
                verified.append((i, t))
        else:
            # Outside the sketch's error bound: keep the verified bracket, widen the margin.
            t.margin *= 8.0
    if verified:
        row = df.agg(
            *[F.approx_count_distinct(F.when(_in_bracket(F.col(t.col), t.lo, t.hi), F.col(t.col))).alias(f"d{i}") for i, t in verified]
        ).first()
        for i, t in verified:
            t.distinct = int(row[f"d{i}"])


def _bracket_counts(df: DataFrame, brackets) -> dict[int, tuple[int, int]]:
    """{target: (rows below lo, rows in [lo, hi])}."""
    items = []
    for _, c, lo, hi in brackets:
        x = F.col(c).cast("double")
        items.append({"below": F.count_if(x < F.lit(lo)) if lo is not None else F.count_if(F.lit(False)), "inside": F.count_if(_in_bracket(x, lo, hi))})
    return {i: (int(r["below"]), int(r["inside"])) for (i, *_), r in zip(brackets, chunked_aggregates(df, items))}


def _collect(df: DataFrame, targets: list[tuple[int, _Target]]) -> None:
    inside: dict[str, Column] = {}
    for _, t in targets:
        cond = _in_bracket(F.col(t.col).cast("double"), t.lo, t.hi)
        inside[t.col] = inside[t.col] | cond if t.col in inside else cond
    cols = list(inside)
    # Only rows with a value in some bracket, and only those values of them, are taken apart.
    values = [F.when(inside[c], F.struct(F.lit(k).alias("ci"), F.col(c).cast("double").alias("x"))) for k, c in enumerate(cols)]
    hit = reduce(lambda a, b: a | b, (F.coalesce(cond, F.lit(False)) for cond in inside.values()))
    long = df.where(hit).select(F.explode(F.array_compact(F.array(*values))).alias("v")).select("v.*")
    grouped = long.groupBy("ci", "x").count()
    # Size checked before: the brackets hold at most COLLECT_TOTAL distinct values together.
    by_col: dict[int, list[tuple[float, int]]] = {}
    for r in grouped.collect():
        by_col.setdefault(int(r["ci"]), []).append((float(r["x"]), int(r["count"])))
    for i, t in targets:
        vals = sorted(v for v in by_col.get(cols.index(t.col), []) if (t.lo is None or v[0] >= t.lo) and (t.hi is None or v[0] <= t.hi))
        found = {}
        acc = t.below
        for v, n in vals:
            for k in (t.k0, t.k1):
                if k not in found and acc + n > k:
                    found[k] = v
            acc += n
        if len(found) == 2 or (t.k0 == t.k1 and found):
            t.values, t.done = (found[t.k0], found[t.k1]), True
        else:  # approximate distinct count was off; narrow again
            t.distinct = None


def order_statistics(df: DataFrame, requests: list[tuple[str, int, int]], counts: dict[str, int]) -> list[tuple | None]:
    """Exact values at the 0-based ranks (k0, k1) among the non-null values of each column."""
    targets = [_Target(col=c, k0=k0, k1=k1, inside=counts[c]) for c, k0, k1 in requests]
    for t in targets:
        if counts[t.col] == 0:
            t.done = True
    # Every round narrows the brackets; a bracket of one value is done, so this ends.
    while True:
        open_t = [(i, t) for i, t in enumerate(targets) if not t.done]
        if not open_t:
            break
        wide = [(i, t) for i, t in open_t if not t.small()]
        if wide:
            _narrow(df, wide)
        ready = [(i, t) for i, t in enumerate(targets) if not t.done and t.small()]
        batch, size = [], 0
        for i, t in ready:  # bound what one collect brings to the driver
            if batch and size + t.distinct > COLLECT_TOTAL:
                _collect(df, batch)
                batch, size = [], 0
            batch.append((i, t))
            size += t.distinct
        if batch:
            _collect(df, batch)
    return [t.values for t in targets]


def interpolate(v0: float, v1: float, frac: float) -> float:
    """Linear interpolation as NumPy/pandas do it (the 'linear' method)."""
    diff = v1 - v0
    if frac >= 0.5:
        return v1 - diff * (1.0 - frac)
    return v0 + diff * frac


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], counts: dict[str, int] | None = None):
    """{(col, p): value} with linear interpolation at (n-1)p over non-null values.

    ``counts`` (non-null counts per column) can be passed when already known.
    Columns without values give None.
    """
    with passes_over(df.select(*cols)) as data:
        return _exact_quantiles(data, cols, probs, counts)


def _exact_quantiles(df: DataFrame, cols, probs, counts):
    if counts is None:
        counts = {c: int(r["n"]) for c, r in zip(cols, chunked_aggregates(df, [{"n": F.count(c)} for c in cols]))}
    requests, plan = [], {}
    for c in cols:
        n = counts[c]
        for p in probs:
            if n == 0:
                plan[(c, p)] = None
                continue
            pos = (n - 1) * p
            k0 = int(math.floor(pos))
            k1 = min(k0 + 1, n - 1)
            plan[(c, p)] = ((c, k0, k1), pos - k0)
            requests.append((c, k0, k1))
    uniq = list(dict.fromkeys(requests))
    found = dict(zip(uniq, order_statistics(df, uniq, counts))) if uniq else {}
    out = {}
    for key, spec in plan.items():
        if spec is None:
            out[key] = None
            continue
        req, frac = spec
        v0, v1 = found[req]
        out[key] = interpolate(v0, v1, frac)
    return out
