"""Exact order statistics without gathering a column in one task.

Spark's ``percentile`` keeps every distinct value of a group in one buffer, which
is fine for a bounded column and impossible for an unbounded one. Beyond
``DIRECT_ROWS`` values the wanted ranks are bracketed instead: a mergeable sketch
proposes two cut values, an exact count decides which side of them each rank lies
on, and the bracket shrinks by a factor of hundreds per round until few values
are left. Counts, not the sketch, decide, so the result is exact. Cuts are values of
the column (KLL sketches keep items, whole numbers as such), so every round passes at
least one value and a heavy tie ends the search. Sketches merge in two levels, so that
no task receives one from every partition of a large table. The driver only ever holds bracket ends
and counts.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import batches
from .numeric import with_intervals

DIRECT_ROWS = 200_000
GATHER_ROWS = 20_000
SPREAD_ROWS = 2_000_000  # of all intervals that are gathered together
INTERVALS = 2048  # of equal shares; narrower where needed
SKETCH_K = 4096
GROUPS = 256  # of partitions whose sketches are merged first
MARGIN = 0.002  # beyond the sketch's own rank error
WIDTH = 40  # aggregate expressions per job
WHOLE = ("tinyint", "smallint", "int", "bigint")
SKETCHES = {
    False: (F.kll_sketch_agg_double, F.kll_merge_agg_double, F.kll_sketch_get_quantile_double),
    True: (F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint, F.kll_sketch_get_quantile_bigint),
}
COLUMNS = 32  # columns persisted at the same time


@dataclass
class _Bracket:
    column: int
    rank: int
    inside: int
    below: int = 0
    low: object = None
    high: object = None
    value: object = None
    found: bool = False

    @property
    def key(self):
        return (self.column, self.low, self.high)


def _within(value: Column, low, high) -> Column:
    condition = value.isNotNull()
    if low is not None:
        condition = condition & (value > F.lit(low))
    if high is not None:
        condition = condition & (value < F.lit(high))
    return condition


def _grouped(brackets):
    groups: dict = {}
    for b in brackets:
        groups.setdefault(b.key, []).append(b)
    return list(groups.items())


def _shares(b: _Bracket) -> tuple[float, float]:
    """Two probabilities around the wanted rank; neighbouring ranks get the same pair."""
    centre = round((b.rank - b.below + 0.5) / b.inside, 5)
    return max(0.0, centre - MARGIN), min(1.0, centre + MARGIN)


def _propose(narrow: DataFrame, active: list[_Bracket]) -> list[tuple]:
    """(condition, value, low cut, high cut, brackets): one sketch per distinct bracket."""
    proposals = []
    parted = narrow.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    kinds = dict(narrow.dtypes)
    for part in batches(_grouped(active), WIDTH):
        exprs, merges, reads, wanted = [], [], [], []
        for i, ((column, low, high), members) in enumerate(part):
            v = F.col(f"v{column}")
            sketch, merge, read = SKETCHES[kinds[f"v{column}"] in WHOLE]
            pairs = sorted({_shares(b) for b in members})
            wanted.append((v, _within(v, low, high), pairs, members))
            flat = [p for pair in pairs for p in pair]
            exprs.append(sketch(F.when(wanted[-1][1], v), SKETCH_K).alias(f"c{i}"))
            merges.append(merge(f"c{i}", SKETCH_K).alias(f"c{i}"))
            reads.append(read(f"c{i}", F.array(*[F.lit(p) for p in flat])).alias(f"c{i}"))
        cut_rows = parted.groupBy("_group").agg(*exprs).agg(*merges).select(*reads).first()
        for (v, inside, pairs, members), cuts in zip(wanted, cut_rows):
            for k, pair in enumerate(pairs):
                near = [b for b in members if _shares(b) == pair]
                proposals.append((inside, v, cuts[2 * k], cuts[2 * k + 1], near))
    return proposals


def _narrow(narrow: DataFrame, active: list[_Bracket]) -> None:
    """Counts on each side of the proposed cuts and moves every bracket to its rank's side."""
    for part in batches(_propose(narrow, active), WIDTH):
        exprs = []
        for i, (inside, v, a, z, _) in enumerate(part):
            exprs += [
                F.count_if(inside & (v < F.lit(a))).alias(f"l{i}"),
                F.count_if(inside & (v == F.lit(a))).alias(f"a{i}"),
                F.count_if(inside & (v > F.lit(a)) & (v < F.lit(z))).alias(f"m{i}"),
                F.count_if(inside & (v == F.lit(z))).alias(f"z{i}"),
            ]
        counts = narrow.agg(*exprs).first()
        for i, (_, _, a, z, near) in enumerate(part):
            less, at_a, middle, at_z = counts[4 * i : 4 * i + 4]
            _move(near, a, z, less, at_a, middle, 0 if a == z else at_z)


def _move(near: list[_Bracket], a, z, less: int, at_a: int, middle: int, at_z: int) -> None:
    for b in near:
        offset = b.rank - b.below
        if offset < less:
            b.high, b.inside = a, less
        elif offset < less + at_a:
            b.value, b.found = a, True
        elif offset < less + at_a + middle:
            b.low, b.high, b.below, b.inside = a, z, b.below + less + at_a, middle
        elif offset < less + at_a + middle + at_z:
            b.value, b.found = z, True
        else:
            passed = less + at_a + middle + at_z
            b.low, b.below, b.inside = z, b.below + passed, b.inside - passed


def _reader(values: Column):
    return lambda position: F.get(values, position)


def _gather(narrow: DataFrame, rest: list[_Bracket]) -> None:
    for part in batches(_grouped(rest), WIDTH):
        exprs = []
        for i, ((column, low, high), members) in enumerate(part):
            v = F.col(f"v{column}")
            ordered = F.sort_array(F.collect_list(F.when(_within(v, low, high), v)))
            picks = F.array(*[F.lit(b.rank - b.below) for b in members])
            exprs.append(F.transform(picks, _reader(ordered)).alias(f"g{i}"))
        row = narrow.agg(*exprs).first()
        for i, (_, members) in enumerate(part):
            for b, value in zip(members, row[i]):
                b.value, b.found = value, True


def _solve(
    narrow: DataFrame, names: list[str], ranks: dict[str, list[int]], counts: dict[str, int]
) -> dict[str, list]:
    """Values at the wanted ranks; column ``v<i>`` of ``narrow`` holds ``names[i]``."""
    brackets = [_Bracket(i, r, counts[n]) for i, n in enumerate(names) for r in ranks.get(n, [])]
    active = [b for b in brackets if b.inside > GATHER_ROWS]
    while active:
        before = [b.inside for b in active]
        _narrow(narrow, active)
        if any(b.inside >= n and not b.found for b, n in zip(active, before)):
            raise RuntimeError("a rank search made no progress")
        active = [b for b in active if not b.found and b.inside > GATHER_ROWS]
    rest = [b for b in brackets if not b.found]
    if rest:
        _gather(narrow, rest)
    out: dict[str, list] = {n: [] for n in names}
    for b in brackets:
        out[names[b.column]].append(b.value)
    return out


def _counts(narrow: DataFrame, names: list[str]) -> dict[str, int]:
    counts: dict[str, int] = {}
    for part in batches(list(enumerate(names)), 200):
        row = narrow.agg(*[F.count(f"v{i}").alias(f"n{i}") for i, _ in part]).first()
        counts.update({n: c for (_, n), c in zip(part, row)})
    return counts


def kth_values(
    df: DataFrame,
    values: dict[str, Column],
    ranks: dict[str, list[int]],
    counts: dict[str, int] | None = None,
    persist: bool = True,
) -> dict[str, list]:
    """The values at 0-based ``ranks`` of each named expression; NULLs are ignored.

    The passes read only these expressions, persisted so that joins above them run
    once. Turn ``persist`` off when ``df`` is cheap to read again.
    """
    names = list(values)
    narrow = df.select(*[values[n].alias(f"v{i}") for i, n in enumerate(names)])
    if persist:
        narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _solve(narrow, names, ranks, counts or _counts(narrow, names))
    finally:
        if persist:
            narrow.unpersist()


def _positions(shares: list[float], n: int) -> list[tuple[float, int, int]]:
    exact = [p * (n - 1) for p in shares]
    return [(x, math.floor(x), math.ceil(x)) for x in exact]


def exact_quantiles(
    df: DataFrame, values: dict[str, Column], shares: list[float]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several expressions; NULL for empty ones."""
    result: dict[str, list[float | None]] = {}
    for part in batches(list(values), COLUMNS):
        result.update(_quantiles(df, {n: values[n] for n in part}, shares))
    return result


def _quantiles(
    df: DataFrame, values: dict[str, Column], shares: list[float]
) -> dict[str, list[float | None]]:
    names = list(values)
    narrow = df.select(*[values[n].cast("double").alias(f"v{i}") for i, n in enumerate(names)])
    narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = _counts(narrow, names)
        result: dict[str, list[float | None]] = {n: [None] * len(shares) for n in names}
        small = [(i, n) for i, n in enumerate(names) if 0 < counts[n] <= DIRECT_ROWS]
        if small:
            most = max(counts[n] for _, n in small)
            for part in batches(small, max(1, min(WIDTH, 4_000_000 // most))):
                row = narrow.agg(*[F.percentile(f"v{i}", list(shares)).alias(f"q{i}") for i, _ in part]).first()
                result.update({n: list(q) for (_, n), q in zip(part, row)})
        places = {n: _positions(shares, counts[n]) for n in names if counts[n] > DIRECT_ROWS}
        if places:
            ranks = {n: sorted({r for _, a, z in at for r in (a, z)}) for n, at in places.items()}
            found = _solve(narrow, names, ranks, counts)
            for n, at in places.items():
                value = dict(zip(ranks[n], found[n]))
                result[n] = [
                    value[a] if a == z else (z - x) * value[a] + (x - a) * value[z] for x, a, z in at
                ]
        return result
    finally:
        narrow.unpersist()


class Intervals:
    """Rows of a column of numbers counted between cuts, for many ranks and distances from one count.

    A row falls in its interval by halving, however many ranks are wanted. Values are gathered from wanted intervals
    only, each with its number of rows; while those hold too many, they are split and all rows counted again. Cuts go beside
    the ends of an interval too, so that ties come to be intervals of one value, which need no gathering.
    """

    def __init__(self, df: DataFrame, column: str):
        self.df = df.select(F.col(column).cast("double").alias("v"))
        sketch, merge, read = SKETCHES[False]
        parted = self.df.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
        shares = F.array(*[F.lit(i / INTERVALS) for i in range(1, INTERVALS)])
        merged = parted.groupBy("_group").agg(sketch("v", SKETCH_K).alias("c")).agg(merge("c", SKETCH_K).alias("c"))
        self._count(set(merged.select(read("c", shares)).first()[0]))

    def _placed(self) -> DataFrame:
        return with_intervals(self.df, {"_bin": (F.col("v"), self.cuts)})

    def _count(self, cuts: set[float]) -> None:
        self.cuts = sorted(c for c in cuts if math.isfinite(c))
        found = self._placed().groupBy("_bin").agg(F.count(F.lit(1)), F.min("v"), F.max("v")).collect()
        columns = zip(*sorted(tuple(r) for r in found))
        self.bins, self.rows, self.low, self.high = (np.array(c) for c in columns)

    def _split(self, at: np.ndarray) -> None:
        shares = [i / 64 for i in range(1, 64)]
        inside = self._placed().filter(F.col("_bin").isin([float(b) for b in self.bins[at]]))
        finer = inside.groupBy("_bin").agg(F.percentile_approx("v", shares, 1000)).collect()
        ends = {float(x) for x in self.low[at]} | {math.nextafter(x, -math.inf) for x in self.high[at]}
        self._count({*self.cuts, *ends, *(x for _, own in finer for x in own)})

    def gather(self, wanted: Callable[[], np.ndarray]) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Reads (values, rows) of intervals; ``wanted`` are their places, asked again when intervals are split."""
        while True:
            at = wanted()
            many = at[self.low[at] < self.high[at]]
            if self.rows[many].sum() <= SPREAD_ROWS:
                break
            self._split(many)
        values, rows = self.low[at[self.low[at] == self.high[at]]], self.rows[at[self.low[at] == self.high[at]]]
        if len(many):
            inside = self._placed().filter(F.col("_bin").isin([float(b) for b in self.bins[many]]))
            found = inside.groupBy("v").agg(F.count(F.lit(1)).alias("n")).toArrow()
            values = np.concatenate([values, found.column("v").to_numpy()])
            rows = np.concatenate([rows, found.column("n").to_numpy()])
        order = np.argsort(values, kind="stable")
        values, rows = values[order], rows[order]
        numbers = np.searchsorted(self.cuts, values, side="left")

        def read(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            own = np.isin(numbers, self.bins[places])
            return values[own], rows[own]

        return read

    def at_ranks(self, ranks: list[int]) -> list[float]:
        """The values at 0-based ranks."""
        def places(rank):
            return np.searchsorted(np.cumsum(self.rows), rank, side="right")

        read = self.gather(lambda: np.unique(places(np.array(ranks))))
        out = []
        for r in ranks:
            i = int(places(r))
            values, rows = read(np.array([i]))
            inside = r - int(self.rows[:i].sum())
            out.append(float(values[np.searchsorted(np.cumsum(rows), inside, side="right")]))
        return out

    def quantiles(self, shares: list[float]) -> list[float]:
        """Linearly interpolated quantiles."""
        places = _positions(shares, int(self.rows.sum()))
        ranks = sorted({r for _, a, z in places for r in (a, z)})
        value = dict(zip(ranks, self.at_ranks(ranks)))
        return [value[a] if a == z else (z - x) * value[a] + (x - a) * value[z] for x, a, z in places]

    def _around(self, point: float, k: int) -> tuple[int, np.ndarray]:
        """(rows surely nearer than the k-th nearest, places of the intervals that may hold it)."""
        left, right = np.abs(self.low - point), np.abs(self.high - point)
        near = np.where((self.low <= point) & (point <= self.high), 0.0, np.minimum(left, right))
        far = np.maximum(left, right)

        def reached(ends):
            order = np.argsort(ends, kind="stable")
            return ends[order][np.searchsorted(np.cumsum(self.rows[order]), k, side="left")]

        least, most = reached(near), reached(far)
        return int(self.rows[far < least].sum()), np.flatnonzero((far >= least) & (near <= most))

    def kth_distances(self, points: list[float], k: int) -> list[float]:
        """The distance of each point to its k-th nearest row."""
        read = self.gather(lambda: np.unique(np.concatenate([self._around(p, k)[1] for p in points])))
        out = []
        for p in points:
            below, places = self._around(p, k)
            values, rows = read(places)
            distance = np.abs(values - p)
            order = np.argsort(distance, kind="stable")
            out.append(float(distance[order][np.searchsorted(np.cumsum(rows[order]), k - below, side="left")]))
        return out
