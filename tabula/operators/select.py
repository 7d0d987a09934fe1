"""Exact order statistics without a global sort.

Whole numbers: ``kth_smallest`` narrows a value range with counting passes; each pass splits
the current range into ``fanout`` equal-width buckets and aggregates count/min/max per
bucket (map-side partial aggregation, at most ``fanout`` groups reach the driver), and the
bucket holding rank k becomes the next range, so 60-bit keys take seven passes at most.

Floating numbers: a mergeable quantile summary gives two values around the wanted rank, one
more pass counts what lies below and between them, and the values between are the next
range. Only the order of the values matters, so infinities and spreads of any size cost
nothing extra. A pass that narrows nothing is followed by one that halves the range of
the remaining bit patterns, which bounds the passes in any case.

Once a range holds at most ``max_collect`` rows (shared by all columns of a call), or a
single value, the answer is read directly. Only the columns asked for are read per pass.
"""

from __future__ import annotations

import bisect
import math
import struct
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FRACTIONAL = (T.DoubleType, T.FloatType)
_EXACT_SPAN = 2**53


@dataclass(frozen=True)
class Rank:
    """The k-th smallest value, how many rows lie strictly below / equal to it, the
    rank that was resolved, and the number of non-null values. ``value`` is None when
    the resolved rank falls outside 1..total."""

    value: object
    n_less: int
    n_equal: int
    k: int = 0
    total: int = 0


def _values(df: DataFrame, col: str) -> DataFrame:
    v = F.col(col)
    dtype = df.schema[col].dataType
    keep = v.isNotNull() & ~F.isnan(v) if isinstance(dtype, _FRACTIONAL) else v.isNotNull()
    return df.select(v.alias("_v")).where(keep)


def count_values(df: DataFrame, col: str) -> tuple[int, object, object]:
    """(count, min, max) of the non-null, non-NaN values of ``col`` in one pass."""
    row = _values(df, col).agg(F.count("*"), F.min("_v"), F.max("_v")).first()
    return int(row[0]), row[1], row[2]


def _histogram(part: DataFrame, lo, hi, fanout: int) -> list:
    """count/min/max per equal-width bucket of [lo, hi] (monotone bucket function)."""
    if hi - lo < _EXACT_SPAN:
        offset = (F.col("_v") - F.lit(lo)).cast("double")
        width = float((hi - lo) / fanout)
    else:
        offset = F.col("_v").cast("double") - F.lit(float(lo))
        width = float(hi) / fanout - float(lo) / fanout
    if not (width > 0 and math.isfinite(width)):
        width = math.ulp(float(lo))
    bucket = F.least(F.floor(offset / F.lit(width)), F.lit(fanout - 1)).cast("int")
    return sorted(
        part.groupBy(bucket.alias("_b"))
        .agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        .collect()
    )


def _bits(x: float) -> int:
    """Whole number in the order of the doubles (negative zero next to zero)."""
    (n,) = struct.unpack("<q", struct.pack("<d", x))
    return n if n >= 0 else -(n + 2**63) - 1


def _double(n: int) -> float:
    return struct.unpack("<d", struct.pack("<q", n if n >= 0 else -(n + 1) - 2**63))[0]


@dataclass
class _Open:
    """A search that goes on: the closed range that holds the value, rows in it, rows below it,
    the wanted rank among the rows of the range, and whether to halve the range next."""

    lo: float
    hi: float
    count: int
    below: int
    rank: int
    halve: bool = False


def _double_ranks(frame: DataFrame, ranks: dict[str, int], stats: dict, accuracy: int, max_collect: int) -> dict:
    """{column: (value, rows below it, rows equal to it)} of the given 1-based ranks in columns of
    doubles without NaN; ``stats`` has (count, min, max) per column."""
    open_ = {c: _Open(float(stats[c][1]), float(stats[c][2]), int(stats[c][0]), 0, k) for c, k in ranks.items()}
    share, done = max(1, max_collect // max(1, len(ranks))), {}
    inside = lambda c, s: (F.col(c) >= F.lit(s.lo)) & (F.col(c) <= F.lit(s.hi))
    while open_:
        for c in [c for c, s in open_.items() if s.lo == s.hi]:
            s = open_.pop(c)
            done[c] = (s.lo, s.below, s.count)
        small = [c for c, s in open_.items() if s.count <= share]
        if small:
            pairs = F.array(*[F.when(inside(c, open_[c]), F.struct(F.lit(c).alias("c"), F.col(c).alias("v"))) for c in small])
            got: dict = {c: [] for c in small}
            for r in frame.select(F.explode(pairs).alias("p")).where("p is not null").select("p.c", "p.v").collect():
                got[r["c"]].append(r["v"])
            for c in small:
                s, vals = open_.pop(c), sorted(got[c])
                x = vals[s.rank - 1]
                first = bisect.bisect_left(vals, x)
                done[c] = (x, s.below + first, bisect.bisect_right(vals, x) - first)
        if not open_:
            break
        names = list(open_)
        pivots = {}
        asked = [c for c in names if not open_[c].halve]
        if asked:
            around = []
            for i, c in enumerate(asked):
                s = open_[c]
                low, high = (min(1.0, max(0.0, s.rank / s.count + d)) for d in (-2 / accuracy, 2 / accuracy))
                around.append(F.percentile_approx(F.when(inside(c, s), F.col(c)), [low, high], accuracy).alias(f"_{i}"))
            row = frame.agg(*around).first()
            pivots = {c: tuple(row[f"_{i}"]) for i, c in enumerate(asked)}
        for c in names:
            if c not in pivots:
                middle = _double((_bits(open_[c].lo) + _bits(open_[c].hi)) // 2)
                pivots[c] = (middle, middle)
        counts = []
        for i, c in enumerate(names):
            here, v, (a, b) = inside(c, open_[c]), F.col(c), pivots[c]
            for j, part in enumerate((v < F.lit(a), (v >= F.lit(a)) & (v <= F.lit(b)), v > F.lit(b))):
                own = F.when(here & part, v)
                counts += [F.count(own).alias(f"n{i}_{j}"), F.min(own).alias(f"lo{i}_{j}"), F.max(own).alias(f"hi{i}_{j}")]
        row = frame.agg(*counts).first()
        for i, c in enumerate(names):
            s = open_[c]
            rank, below = s.rank, s.below
            for j in range(3):
                n = int(row[f"n{i}_{j}"])
                if rank <= n:
                    open_[c] = _Open(row[f"lo{i}_{j}"], row[f"hi{i}_{j}"], n, below, rank, halve=n > s.count // 2)
                    break
                rank, below = rank - n, below + n
    return done


def kth_smallest(
    df: DataFrame,
    col: str,
    k,
    *,
    fanout: int = 1024,
    max_collect: int = 50_000,
    stats: tuple[int, object, object] | None = None,
    bounds: tuple | None = None,
) -> Rank:
    """Exact k-th smallest (1-based) non-null value of a numeric column.

    ``k`` may be a function of the row count; with known value ``bounds`` (lo, hi)
    the first histogram pass also counts the rows, so no separate count is needed.
    """
    values = _values(df, col)
    if isinstance(df.schema[col].dataType, _FRACTIONAL):
        n, lo, hi = stats or count_values(df, col)
        k = int(k(n)) if callable(k) else int(k)
        if not 1 <= k <= n:
            if stats is None:
                raise ValueError(f"rank {k} outside 1..{n}")
            return Rank(None, min(max(k, 0), n), 0, k, n)
        wide = values.select(F.col("_v").cast("double").alias("v"))
        value, less, equal = _double_ranks(wide, {"v": k}, {"v": (n, lo, hi)}, fanout, max_collect)["v"]
        return Rank(value, less, equal, k, n)
    buckets = None
    if stats is not None:
        n, lo, hi = stats
    elif bounds is not None:
        lo, hi = bounds
        buckets = _histogram(values, lo, hi, fanout)
        n = sum(int(b["n"]) for b in buckets)
    else:
        n, lo, hi = count_values(df, col)
    k = int(k(n)) if callable(k) else int(k)
    if not 1 <= k <= n:
        if stats is None and bounds is None:
            raise ValueError(f"rank {k} outside 1..{n}")
        return Rank(None, min(max(k, 0), n), 0, k, n)
    below = 0  # rows strictly below the current range
    count = n
    rank = k
    while True:
        if buckets is None:
            if lo == hi:
                return Rank(lo, below, count, k, n)
            part = values.where((F.col("_v") >= F.lit(lo)) & (F.col("_v") <= F.lit(hi)))
            if count <= max_collect:
                vals = sorted(r[0] for r in part.collect())
                v = vals[rank - 1]
                first = bisect.bisect_left(vals, v)
                return Rank(v, below + first, bisect.bisect_right(vals, v) - first, k, n)
            buckets = _histogram(part, lo, hi, fanout)
        for b in buckets:
            if rank <= b["n"]:
                if b["n"] == count and b["lo"] == lo and b["hi"] == hi and lo != hi:
                    raise RuntimeError("order statistic search made no progress")
                lo, hi, count = b["lo"], b["hi"], int(b["n"])
                break
            rank -= b["n"]
            below += b["n"]
        buckets = None


def exact_median(df: DataFrame, col: str, **kw) -> float | None:
    """Exact median (mean of the middle pair for even counts) of non-null values."""
    stats = count_values(df, col)
    n = stats[0]
    if n == 0:
        return None
    low = kth_smallest(df, col, (n + 1) // 2, stats=stats, **kw)
    if n % 2 == 1:
        return float(low.value)
    upper_rank = n // 2 + 1
    if upper_rank <= low.n_less + low.n_equal:
        return float(low.value)
    nxt = _values(df, col).where(F.col("_v") > F.lit(low.value)).agg(F.min("_v")).first()[0]
    return (float(low.value) + float(nxt)) / 2.0


def exact_medians(df: DataFrame, cols, *, fanout: int = 10_000, max_collect: int = 50_000) -> dict:
    """Exact medians of several columns with shared passes (values read as double).

    Every pass is one aggregation over all columns, so the pass count does not grow with
    their number, and ``max_collect`` values at most reach the driver for all of them.
    """
    cols = list(cols)
    if not cols:
        return {}
    frame = df.select(*[
        F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(cols)
    ])
    names = frame.columns
    row = frame.agg(*[f(c).alias(f"{t}{c}") for c in names for t, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    stats = {c: (int(row[f"n{c}"]), row[f"lo{c}"], row[f"hi{c}"]) for c in names}
    ranks = {c: (stats[c][0] + 1) // 2 for c in names if stats[c][0]}
    low = _double_ranks(frame, ranks, stats, fanout, max_collect)
    # even counts: the upper middle value, for all columns needing it in one pass
    need = [c for c, (_, less, equal) in low.items() if stats[c][0] % 2 == 0 and stats[c][0] // 2 + 1 > less + equal]
    above = {}
    if need:
        row = frame.agg(*[F.min(F.when(F.col(c) > F.lit(low[c][0]), F.col(c))).alias(c) for c in need]).first()
        above = {c: row[c] for c in need}

    def middle(c: str) -> float | None:
        if c not in low:
            return None
        x = float(low[c][0])
        return x if c not in above else (x + float(above[c])) / 2.0

    return {col: middle(c) for col, c in zip(cols, names)}
