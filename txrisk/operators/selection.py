"""Exact order statistics in a hash order (building block P2).

Rows get a 60-bit key ``h`` from md5(seed:key). Exact stratified splits,
folds and samples only need, per class, the row at a few given ranks of
the order (h, key): rows before that row go to one side. Those rows are
found by a radix select:

* pass 1: ``groupBy(class, h >> 44).count()`` - at most classes x 65536
  rows, collected (size fixed by the parameters, not the data);
* the bucket holding each target rank is narrowed with further 16-bit
  passes over only the rows inside it until it holds few rows, which are
  then collected and sorted.

The assignment itself is then a map-only projection with literals: no
window over a whole class (which would put all rows of the big class into
one task) and no global sort.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

H_BITS = 60
STEP_BITS = 16
ROW_LIMIT = 20_000  # rows of one refined bucket collected to the driver
FIRST_BUCKET_ROWS = 2048  # aim of the first pass: rows per bucket


def _bits(width: int) -> int:
    return max(0, (width - 1).bit_length())


def rank_cutoffs(
    df: DataFrame, h: str, key: str, group: str | None, targets: list[tuple[object, int]], max_group_rows: int | None = None
):
    """{(group_value, k): (h, key)} of the row at 0-based rank k of its group in (h, key) order.

    ``targets`` ranks must be < the group's row count. The first pass uses
    about max_group_rows / FIRST_BUCKET_ROWS buckets (at most 2^16).
    """
    gcol = F.col(group) if group else F.lit(0)
    if max_group_rows is None:
        max_group_rows = max(targets, key=lambda t: t[1])[1] + 1
    bits = min(STEP_BITS, max(1, math.ceil(math.log2(max(2, max_group_rows / FIRST_BUCKET_ROWS)))))
    first_shift = H_BITS - bits
    counts = (
        df.groupBy(gcol.alias("g"), F.shiftright(F.col(h), first_shift).alias("b")).count().collect()
    )  # <= groups x 2^16 rows
    per_group: dict[object, list[tuple[int, int]]] = {}
    for r in counts:
        per_group.setdefault(r["g"], []).append((int(r["b"]), int(r["count"])))
    for g in per_group:
        per_group[g].sort()

    state = {}  # target -> [lo, hi, below, inside]
    for g, k in targets:
        gv = g if group else 0
        acc = 0
        for b, n in per_group.get(gv, []):
            if acc + n > k:
                lo = b << first_shift
                state[(g, k)] = [lo, lo + (1 << first_shift) - 1, acc, n]
                break
            acc += n
        else:
            raise ValueError(f"rank {k} is beyond the size of group {g!r}")

    result = {}
    while state:
        small = {t: s for t, s in state.items() if s[3] <= ROW_LIMIT}
        wide = {t: s for t, s in state.items() if s[3] > ROW_LIMIT}
        if small:
            rows = _rows_in_ranges(df, h, key, gcol, small, bool(group))
            for i, (t, (lo, hi, below, _)) in enumerate(small.items()):
                if any(k is None for _, k in rows.get(i, [])):
                    raise ValueError("keys must not be NULL")
                ordered = sorted(rows.get(i, []))
                result[t] = ordered[t[1] - below]
                del state[t]
        for (g, _), (lo, hi, _, n) in wide.items():
            if lo == hi:
                raise ValueError(f"{n} rows of group {g!r} share one hash: keys must be unique and not NULL")
        if wide:
            subs = _sub_counts(df, h, gcol, wide, bool(group))
            for i, (t, (lo, hi, below, _)) in enumerate(wide.items()):
                shift = max(0, _bits(hi - lo + 1) - STEP_BITS)
                acc = below
                for sb, n in sorted(subs.get(i, [])):
                    if acc + n > t[1]:
                        nlo = lo + (sb << shift)
                        state[t] = [nlo, min(hi, nlo + (1 << shift) - 1), acc, n]
                        break
                    acc += n
    return result


def _places(ranges: dict, group: bool) -> tuple[int, dict]:
    """(bits of a range, {(group, number of the range): places of its targets}).

    All open ranges are cells of one grid (every round refines them alike), so a row's range is its leading bits.
    """
    shift = _bits(max(hi - lo + 1 for lo, hi, *_ in ranges.values()))
    places: dict[tuple, list[int]] = {}
    for i, ((g, _), (lo, _, _, _)) in enumerate(ranges.items()):
        places.setdefault((g if group else 0, lo >> shift), []).append(i)
    return shift, places


def _in_places(df: DataFrame, h: str, gcol: Column, shift: int, places: dict) -> DataFrame:
    """The rows of these ranges: a set lookup of the leading bits per group, however many targets there are."""
    cond = F.lit(False)
    for g in {g for g, _ in places}:
        cond = cond | (gcol.eqNullSafe(F.lit(g)) & F.shiftright(F.col(h), shift).isin([n for x, n in places if x == g]))
    return df.where(cond)


def _rows_in_ranges(df, h, key, gcol, ranges, group):
    shift, places = _places(ranges, group)
    out: dict[int, list] = {}
    # Each range holds at most ROW_LIMIT rows (counted before).
    for r in _in_places(df, h, gcol, shift, places).select(gcol.alias("g"), F.col(h).alias("h"), F.col(key).alias("k")).collect():
        for i in places[(r["g"], r["h"] >> shift)]:
            out.setdefault(i, []).append((int(r["h"]), r["k"]))
    return out


def _sub_counts(df, h, gcol, ranges, group):
    shift, places = _places(ranges, group)
    fine = max(0, shift - STEP_BITS)
    grouped = _in_places(df, h, gcol, shift, places).groupBy(gcol.alias("g"), F.shiftright(F.col(h), fine).alias("s")).count()
    out: dict[int, list] = {}
    for r in grouped.collect():  # <= ranges x 2^16 rows
        s = int(r["s"])
        for i in places[(r["g"], s >> (shift - fine))]:
            out.setdefault(i, []).append((s - ((s >> (shift - fine)) << (shift - fine)), int(r["count"])))
    return out


def at_or_before(h: str, key: str, cutoff) -> Column:
    """(h, key) <= cutoff in lexicographic order."""
    ch, ck = cutoff
    return (F.col(h) < F.lit(ch)) | ((F.col(h) == F.lit(ch)) & (F.col(key) <= F.lit(ck)))
