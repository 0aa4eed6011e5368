"""Which words set the sources of a language apart.

Tasks count the terms of each group (a language's source): how often each occurs, and in how many documents. A document
is in one group, so the documents of a language that have a term are the sum over its groups. Counts of a term meet once,
by term and language, where rare terms go and the language's own count is known.

A source's share p of a term and another's share q give floor((p - q)^2 / q). The sum over all kept terms, for each pair
of sources, is split: terms that neither or only one of them has depend on few numbers, and only terms that both have
are looked at one by one, folded inside tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, Scratch, batches, bounded, small_batches, utf8

# lower-cases A-Z and leaves a-z and what is not ASCII; the bytes of [\x00-\x40\x5B-\x60\x7B-\x7F] become spaces
TERM_BYTES = bytes(LOWER[i] if i > 127 or chr(i).isalpha() else 32 for i in range(256))
SCALE = 1_000_000_000
PAIRS = 1 << 20  # pairs of sources folded at once
COUNTED_BYTES = 16 << 20
HELD_ROWS = 1 << 20  # counts that a task holds before they go on


def _summed(held: list[pa.Table]) -> pa.Table:
    made = pa.concat_tables(held).group_by(["g", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return made.select(["g", "term", "n_sum", "docs_sum"]).rename_columns(["g", "term", "n", "docs"]).combine_chunks()


def _terms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the terms of each group of rows, and of the rows that have them; a term may come again."""
    held: list[pa.Table] = []

    def passed() -> Iterator[pa.RecordBatch]:
        yield from (t.set_column(1, "term", t.column("term").cast(pa.string())) for x in held for t in x.to_batches(max_chunksize=100_000))
        held.clear()

    for part in parts:
        for start, texts in batches(part.column("text"), COUNTED_BYTES):
            terms, counts, sizes = [], [], []
            for text in texts:
                own = Counter(text.translate(TERM_BYTES).split())
                terms.extend(own)
                counts.extend(own.values())
                sizes.append(len(own))
            each = pa.array(np.repeat(np.arange(start, start + len(texts)), sizes))
            n = pa.array(counts, pa.int64())
            held.append(_summed([pa.table({"g": part.column("g").take(each), "term": pa.array(terms, pa.binary()), "n": n,
                                           "docs": pa.array(np.ones(len(n), np.int64))})]))
            if sum(map(len, held)) >= HELD_ROWS:
                held[:] = [_summed(held)]
                if len(held[0]) >= HELD_ROWS // 2:
                    yield from passed()
    if len(held) > 1:
        held[:] = [_summed(held)]
    yield from passed()


def group_numbers(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(g, l, lang, source): a number for each lang and source of docs, and one for each lang."""
    found = scratch.put(docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct(), "groups")
    numbered = found.withColumn("g", F.monotonically_increasing_id())  # of the rows of written files
    return scratch.put(numbered.select("g", F.min("g").over(Window.partitionBy("lang")).alias("l"), "lang", "source"), "numbers")


def kept_terms(docs: DataFrame, groups: DataFrame, least_docs: int = 3) -> DataFrame:
    """(l, g, term, n, all_n, once) of docs (text, lang, source): counts of terms in at least `least_docs` documents of the language.

    all_n is the term's count in the language; once marks one row of each language's term.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")), utf8(F.col("text")).alias("text"))
    numbered = rows.join(bounded(groups), ["lang", "source"]).select("g", "text")
    counted = numbered.mapInArrow(_terms, "g long, term string, n long, docs long").join(bounded(groups.select("g", "l")), "g")
    # tasks have summed them already, so they are dealt out as they are
    each = counted.repartition("term", "l").groupBy("term", "l", "g").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    language = Window.partitionBy("term", "l")
    return each.select(
        "l", "g", "term", "n", F.sum("n").over(language).alias("all_n"), F.sum("docs").over(language).alias("docs"),
        (F.min("g").over(language) == F.col("g")).alias("once")).where(F.col("docs") >= least_docs).drop("docs")


def _share(count: str, total: str, kept: str) -> str:
    """1 + floor(SCALE * (count + 1) / (total + kept)), exact at any size."""
    return f"1 + ({SCALE} * cast({count} + 1 as decimal(20,0))) div cast({total} + {kept} as decimal(20,0))"


def _distance(p: str, q: str) -> str:
    return f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})"


def _folded(l: int, g: np.ndarray, p: np.ndarray, p0: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """What the shares of terms that both sources have add to those of absent terms, summed by pair of sources."""
    left, right = left[left != right], right[left != right]
    f = lambda a, b: (a - b) * (a - b) // b
    value = f(p[left], p[right]) - f(p[left], p0[right]) - f(p0[left], p[right]) + f(p0[left], p0[right])
    order = np.lexsort((g[right], g[left]))
    one, other = g[left][order], g[right][order]
    at = np.flatnonzero((np.diff(one, prepend=-1) != 0) | (np.diff(other, prepend=-1) != 0))
    sums = np.add.reduceat(value[order], at) if len(at) else value
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), l)), pa.array(one[at]), pa.array(other[at]), pa.array(sums)],
                                      names=["l", "g", "other", "value"])


def _all_pairs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all ordered pairs inside each of the lists that follow one another."""
    fan = np.repeat(sizes, sizes)
    left = np.repeat(np.arange(len(fan)), fan)
    within = np.arange(len(left)) - np.repeat(np.cumsum(fan) - fan, fan)
    return left, within + np.repeat(np.repeat(np.cumsum(sizes) - sizes, sizes), fan)


def _both(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}
    room: Counter = Counter()

    def flushed(l: int) -> pa.RecordBatch:
        own = held.pop(l)
        room.pop(l)
        left, right = _all_pairs(np.array([len(x[0]) for x in own]))
        return _folded(l, *(np.concatenate(x) for x in zip(*own)), left, right)

    for part in parts:
        lists = part.column("sources")
        columns = [lists.values.field(k).to_numpy(zero_copy_only=False) for k in ("g", "p", "p0")]
        at = lists.offsets.to_numpy()
        for i, l in enumerate(part.column("l").to_pylist()):
            own = tuple(c[at[i] : at[i + 1]] for c in columns)
            n = len(own[0])
            if n * n > PAIRS:  # very many sources: some left sides at a time
                for a in range(0, n, max(1, PAIRS // n)):
                    some = np.arange(a, min(n, a + max(1, PAIRS // n)))
                    yield _folded(l, *own, np.repeat(some, n), np.tile(np.arange(n), len(some)))
                continue
            held.setdefault(l, []).append(own)
            room[l] += n * n
            if room[l] > PAIRS:
                yield flushed(l)
    for l in list(held):
        yield flushed(l)


def _pair_values(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(l, g, other, value): the sum over all kept terms for each ordered pair of sources of a language."""
    left = groups.select("l", "g", "p0", "own", "kept")
    right = groups.select("l", F.col("g").alias("other"), F.col("p0").alias("q0"), F.col("own").alias("others"))
    absent = left.join(right, "l").where("g <> other").select("l", "g", "other", F.expr(
        f"if(kept = 0, 0L, (kept - own - others) * ({_distance('p0', 'q0')}))").alias("value"))
    shapes = shares.groupBy("l", "g", "p").agg(F.count("*").alias("times"))
    one = shapes.join(right, "l").where("g <> other").select("l", "g", "other", F.expr(f"times * ({_distance('p', 'q0')})").alias("value"))
    other = shapes.select("l", F.col("g").alias("other"), F.col("p").alias("q"), "times").join(left, "l").where("g <> other").select(
        "l", "g", "other", F.expr(f"times * ({_distance('p0', 'q')})").alias("value"))
    lists = shares.groupBy("l", "term").agg(F.collect_list(F.struct("g", "p", "p0")).alias("sources")).where(F.size("sources") > 1)
    both = lists.select("l", "sources").mapInArrow(_both, "l long, g long, other long, value long")
    return absent.union(one).union(other).union(both).groupBy("l", "g", "other").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, least_docs: int = 3, terms_each: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs (text, lang, source).

    Part `pair` ranks the other sources of the language by their distance over all kept terms, part `term` the first
    `terms_each` terms that the source uses more than its language. Null text, lang and source are ''; every row is a
    document of its own, whatever its id; a group without terms has shares of absent terms only, and a language
    without kept terms has pairs of value 0. Ties go to the least item by its bytes. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    numbers = group_numbers(docs, scratch)
    counts = scratch.put(kept_terms(docs, numbers, least_docs), "counts")
    totals = counts.groupBy("g").agg(F.sum("n").alias("total"), F.count("*").alias("own"), F.count_if("once").alias("firsts"))
    language = Window.partitionBy("l")
    groups = numbers.join(totals, "g", "left").na.fill(0, ["total", "own", "firsts"]).select(
        "l", "g", "lang", "source", "total", "own", F.sum("firsts").over(language).alias("kept"), F.sum("total").over(language).alias("all_total"))
    groups = scratch.put(groups.withColumn("p0", F.expr(f"if(kept = 0, null, {_share('0', 'total', 'kept')})")), "totals")
    shares = scratch.put(counts.join(bounded(groups.select("g", "p0", "total", "kept", "all_total")), "g").select(
        "l", "g", "term", "p0", F.expr(_share("n", "total", "kept")).alias("p"), F.expr(_share("all_n", "all_total", "kept")).alias("q")), "shares")
    scratch.drop("counts")
    named = groups.select("g", "lang", "source")
    pairs = _pair_values(groups, shares).join(named, "g").join(
        named.select(F.col("g").alias("other"), F.col("source").alias("item")), "other")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    inner = Window.partitionBy("g").orderBy(F.desc("value"), "item")
    telling = shares.where("p > q").select("g", F.col("term").alias("item"), F.expr(_distance("p", "q")).alias("value"))
    first = telling.withColumn("rank", F.row_number().over(inner)).where(F.col("rank") <= terms_each)
    return ranked.union(first.join(named, "g").select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
