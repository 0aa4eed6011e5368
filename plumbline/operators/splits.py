"""Quantile bins, exact stratified splits, folds and seeded samples."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FIT, TARGET, default
from ..functions.columns import as_double, col, id_hash
from ..functions.order_stats import exact_quantiles, kth_values
from ..functions.ranking import global_rank

BOTTOM_K = 10_000  # keys that a task may hold


def quantile_edges(df: DataFrame, target: str, bins: int = FIT.strata) -> list[float]:
    shares = [i / bins for i in range(bins + 1)]
    edges = exact_quantiles(df, {"y": as_double(df, target)}, shares)["y"]
    return sorted({e for e in edges if e is not None})


def bin_column(df: DataFrame, target: str, edges: list[float]) -> Column:
    """Right-closed bins between interpolated quantile edges; equal edges are merged."""
    y = as_double(df, target)
    code = F.lit(0)
    for inner in edges[1:-1]:
        code = code + F.when(y > F.lit(inner), 1).otherwise(0)
    return F.when(y.isNotNull(), code)


def quantile_bins(df: DataFrame, target: str = TARGET, bins: int = FIT.strata, name: str = "bin") -> DataFrame:
    return df.withColumn(name, bin_column(df, target, quantile_edges(df, target, bins)))


def seeded_order(id_cols: Sequence[str], seed: int) -> list[Column]:
    """Two independent hashes of the id; together a total order for unique ids."""
    return [id_hash(id_cols, seed), id_hash(id_cols, seed + 1)]


def first_k(
    df: DataFrame,
    order: Sequence[Column],
    wanted: dict[int, tuple[Column, int]],
    apply_to: Sequence[Column] | None = None,
) -> Column:
    """Predicate of the first ``k`` rows of each group in ``order``, without sorting.

    ``wanted`` maps a group label to (membership, k). The k-th key of every group is
    found by exact order statistics, so the selection is a filter: no window and no
    group is ever held in one task. Ties move on to the next key. ``apply_to`` gives
    the order keys as expressions of the frame to filter, when ``df`` holds them
    under other names.
    """
    targets = default(apply_to, order)
    picked = F.lit(False)
    open_groups = {}
    row = df.agg(*[F.count_if(m).alias(f"n{g}") for g, (m, _) in wanted.items()]).first()
    sizes = {g: row[f"n{g}"] for g in wanted}
    for g, (member, k) in wanted.items():
        if k >= sizes[g]:
            picked = picked | member
        elif k > 0:
            open_groups[g] = (member, member, k)
    for level, (key, target) in enumerate(zip(order, targets)):
        if not open_groups:
            break
        cuts = kth_values(
            df,
            {g: F.when(member, key) for g, (member, _, _) in open_groups.items()},
            {g: [k - 1] for g, (_, _, k) in open_groups.items()},
            sizes,
            persist=False,
        )
        tests = []
        for g, (member, _, _) in open_groups.items():
            cut = F.lit(cuts[g][0])
            tests += [
                F.count_if(member & (key < cut)).alias(f"l{g}"),
                F.count_if(member & (key == cut)).alias(f"e{g}"),
            ]
        counted = df.agg(*tests).first()
        remaining = {}
        for g, (member, scope, k) in open_groups.items():
            cut = F.lit(cuts[g][0])
            below, equal = counted[f"l{g}"], counted[f"e{g}"]
            if below + equal <= k or level == len(order) - 1:
                picked = picked | (scope & (target <= cut))
            else:
                picked = picked | (scope & (target < cut))
                remaining[g] = (member & (key == cut), scope & (target == cut), k - below)
                sizes[g] = equal
        open_groups = remaining
    return picked


def stratum_quotas(counts: dict[int, int], test_size: float) -> dict[int, int]:
    """Proportional quotas: floors, then one more by largest remainder."""
    total = sum(counts.values())
    draws = math.ceil(total * test_size)
    exact = {b: draws * n / total for b, n in counts.items()}
    quotas = {b: math.floor(x) for b, x in exact.items()}
    spare = draws - sum(quotas.values())
    for b in sorted(exact, key=lambda b: (quotas[b] - exact[b], b))[:spare]:
        quotas[b] += 1
    return quotas


def mark_split(
    df: DataFrame,
    id_cols: Sequence[str],
    target: str = TARGET,
    test_size: float | None = None,
    seed: int | None = None,
    order: Sequence[Column] | None = None,
    name: str = "split",
) -> DataFrame:
    """Adds ``train`` / ``test``, drawn proportionally from quantile bins of the target."""
    test_size, seed = default(test_size, FIT.test_size), default(seed, FIT.seed)
    order = default(order, seeded_order(id_cols, seed))
    keys = [F.col(f"_o{i}") for i in range(len(order))]
    # the passes below read only the target and the order keys
    base = df.select(col(target), *[o.alias(f"_o{i}") for i, o in enumerate(order)])
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        code = bin_column(df, target, quantile_edges(base, target))
        counts = {r[0]: r[1] for r in base.groupBy(code.alias("bin")).count().collect() if r[0] is not None}
        members = {
            b: (F.coalesce(code == b, F.lit(False)), k) for b, k in stratum_quotas(counts, test_size).items()
        }
        in_test = first_k(base, keys, members, order)
    finally:
        base.unpersist()
    return df.withColumn(name, F.when(in_test, F.lit("test")).otherwise(F.lit("train")))


def stratified_split(
    df: DataFrame,
    id_cols: Sequence[str],
    target: str = TARGET,
    test_size: float | None = None,
    seed: int | None = None,
    order: Sequence[Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    marked = mark_split(df, id_cols, target, test_size, seed, order, "_split")
    return (
        marked.filter("_split = 'train'").drop("_split"),
        marked.filter("_split = 'test'").drop("_split"),
    )


def assign_folds(
    df: DataFrame,
    id_cols: Sequence[str],
    folds: int | None = None,
    seed: int | None = None,
    key: Column | None = None,
    name: str = "fold",
) -> DataFrame:
    """Shuffled folds as a projection: the fold is a function of the row id and the seed."""
    folds, seed = default(folds, FIT.folds), default(seed, FIT.seed)
    key = default(key, id_hash(id_cols, seed))
    return df.withColumn(name, F.pmod(key, F.lit(folds)).cast("int"))


def contiguous_folds(
    df: DataFrame, id_cols: Sequence[str], folds: int | None = None, name: str = "fold"
) -> DataFrame:
    """Unshuffled folds: consecutive blocks of rows in id order, sizes differing by one at most."""
    folds = default(folds, FIT.folds)
    ranked = global_rank(df, [col(c) for c in id_cols], "_rank")
    n = ranked.count()
    size, longer = divmod(n, folds)
    edge = longer * (size + 1)
    rank = F.col("_rank")
    late = F.lit(longer) + F.floor((rank - edge) / F.lit(max(size, 1)))
    early = F.floor(rank / F.lit(size + 1))
    return ranked.withColumn(name, F.when(rank < edge, early).otherwise(late).cast("int")).drop("_rank")


def sample_n(
    df: DataFrame,
    n: int,
    id_cols: Sequence[str],
    seed: int | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Exactly ``n`` rows without replacement, the first ones in ``order``, or all rows when there are fewer.

    The last order key of the sample is found first; rows before it are a filter, and as many of the rows equal to it in
    all keys join them as are wanted still. Nothing depends on the size of the sample but the way to that key.
    """
    order = default(order, seeded_order(id_cols, default(seed, FIT.seed)))
    if n <= 0:
        return df.limit(0)
    keys = df.select(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    found = smallest_keys(keys, n) if n <= BOTTOM_K else _searched_keys(keys, n)
    if found is None:
        return df
    cut, before = found
    less, equal = _beside(order, cut)
    return df.filter(less).unionByName(df.filter(equal).limit(n - before))


def _beside(order: Sequence[Column], cut: Sequence) -> tuple[Column, Column]:
    """Conditions of the keys before and at a cut; nulls come first."""
    less, equal = F.lit(False), F.lit(True)
    for key, value in zip(order, cut):
        if value is None:
            equal = equal & key.isNull()
            continue
        before = key.isNull() | (key < F.lit(value))
        less, equal = less | (equal & before), equal & key.isNotNull() & (key == F.lit(value))
    return F.coalesce(less, F.lit(False)), equal


def smallest_keys(keys: DataFrame, n: int) -> tuple[tuple, int] | None:
    """(the n-th key, how many are before it), or nothing for fewer than n rows: one pass over the keys.

    Every task keeps its n smallest; those of a group of tasks are merged before the groups are.
    """
    names = keys.columns
    flagged = keys.select(*[x for c in names for x in (F.col(c).isNotNull().cast("int").alias(f"{c}_set"), F.col(c))])
    sort_keys = [(c, "ascending") for c in flagged.columns]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in parts:
            own = pa.Table.from_batches([part])
            held = own if held is None else pa.concat_tables([held, own])
            if held.num_rows > n:
                held = held.take(pc.select_k_unstable(held, n, sort_keys))
        if held is not None:
            yield from held.combine_chunks().to_batches()

    first = flagged.mapInArrow(run, flagged.schema)
    tasks = keys.sparkSession.sparkContext.defaultParallelism
    merged = first.repartition(tasks).mapInArrow(run, flagged.schema).select(*names)
    rows = merged.orderBy(*[F.col(c).asc_nulls_first() for c in names]).limit(n)
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    last, total = counted.agg(F.max(F.struct(*names, "_n")), F.sum("_n")).first()
    if last is None or total < n:
        return None
    return tuple(last[c] for c in names), n - last["_n"]


def _searched_keys(keys: DataFrame, n: int) -> tuple[tuple, int] | None:
    """The same by exact order statistics, key by key, for samples that one task should not hold."""
    keys = keys.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if keys.count() < n:
            return None
        scope, before, cut = F.lit(True), 0, []
        for name in keys.columns:
            key = F.col(name)
            nulls, size = keys.agg(F.count_if(scope & key.isNull()), F.count_if(scope & key.isNotNull())).first()
            if n - before <= nulls:
                cut.append(None)
                scope = scope & key.isNull()
                continue
            before += nulls
            value = kth_values(keys, {0: F.when(scope, key)}, {0: [n - before - 1]}, {0: size}, persist=False)[0][0]
            before += keys.agg(F.count_if(scope & (key < F.lit(value)))).first()[0]
            cut.append(value)
            scope = scope & (key == F.lit(value))
        return tuple(cut), before
    finally:
        keys.unpersist()
