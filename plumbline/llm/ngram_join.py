"""Exact n-gram Jaccard join with filters under several global token orders.

A document is the set of its distinct word n-grams, as 64-bit hashes. Two documents of Jaccard similarity t or more
share a token among the first n - ceil(t n) + 1 of each under ANY global order of the tokens. Three orders are used:

* order 1 takes slices of the hash space first and, inside a slice, rare tokens first. Only the slices that hold a
  document's prefix are counted, and a token of one document only needs no partner, so few tokens reach the join;
* orders 2 and 3 are other hashes. A candidate must share a prefix token under each of them before it is verified.

Documents of equal sets are one class and only its smallest id goes on. Tokens of few documents give candidate pairs.
A token of many documents gives none: its documents meet the one with fewest rare tokens (the pivot) in blocks, and
links that follow from being near the pivot are not looked for again, so a group of m documents yields at most
m edges for each pair of blocks instead of m * m pairs. Every link is kept up to connection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    BATCH_BYTES,
    VISIBLE,
    batches,
    bounded,
    fraction,
    kept_by,
    list_values,
    long_lists,
    mixed,
    sequence_hashes,
    settled,
    small_batches,
    temporary_tables,
    utf8,
    words_of,
)
from .components import connected_components

SLICES = (0.22, 0.5)  # ends of the first slices of the hash space; the second is the sign bit
PAIR_GROUP = 12  # a token of more documents is handled by pivot and blocks
BLOCK_TOKENS = 2_000_000  # tokens of one block; two blocks meet in one task
ORDERS = (np.uint64(0xA5A5F00DCAFE1234), np.uint64(0x1357BEEF2468ACE1))


def prefix_length(n: np.ndarray | int, percent: int):
    """How many first tokens of a set of n must hold a shared one: n - ceil(n percent / 100) + 1."""
    return n - (n * percent + 99) // 100 + 1


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct k-word shingles of each text; a shorter text is one shingle, one without words none."""
    _, _, _, words, first = words_of(texts, VISIBLE)
    runs = sequence_hashes(words, k)
    out = []
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if b - a >= k:
            out.append(np.unique(runs[a : b - k + 1]))
        elif b > a:
            out.append(sequence_hashes(words[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _signatures(k: int, percent: int):
    """Each text's set size, set digest, and the lowest slices of its set that hold its prefix."""
    ends = [fraction(x) for x in SLICES]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by("ngram_join")
        for part in parts:
            for start, texts in batches(part.column(1)):
                sets = shingle_sets(texts, k)
                sizes = np.array([len(s) for s in sets], np.int64)
                need = prefix_length(sizes, percent)
                cuts = np.array([[*np.searchsorted(s, ends), len(s)] for s in sets], np.int64).reshape(-1, 3)
                level = np.minimum((cuts < need[:, None]).sum(axis=1), 2)
                held = cuts[np.arange(len(sets)), level]
                with np.errstate(over="ignore"):
                    digests = [mixed(np.stack([s.sum(), (mixed(s ^ ORDERS[0]) * s).sum()])) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).slice(start, len(texts)),
                        pa.array(sizes),
                        pa.array([d[0] for d in digests], pa.uint64()).view(pa.int64()),
                        pa.array([d[1] for d in digests], pa.uint64()).view(pa.int64()),
                        pa.array(cuts[:, 0]),
                        pa.array(np.where(level >= 1, cuts[:, 1], cuts[:, 0])),
                        long_lists([s[:h] for s, h in zip(sets, held)]),
                    ],
                    names=["doc_id", "n", "d1", "d2", "m0", "m1", "tokens"],
                )

    return run


SIGNATURE = "doc_id long, n long, d1 long, d2 long, m0 long, m1 long, tokens array<long>"


def _sets(k: int, percent: int):
    """Each text's whole set, and its prefixes under orders 2 and 3."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by("ngram_join")
        for part in parts:
            for start, texts in batches(part.column(1)):
                sets = shingle_sets(texts, k)
                prefixes = [
                    [s[np.argpartition(mixed(s ^ o), p - 1)[:p]] if len(s) else s for s in sets for p in
                     (int(prefix_length(len(s), percent)),)]
                    for o in ORDERS
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).slice(start, len(texts)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        long_lists(sets),
                        *(long_lists(p) for p in prefixes),
                    ],
                    names=["doc_id", "n", "tokens", "second", "third"],
                )

    return run


def shared_prefixes(signatures: DataFrame, percent: int) -> DataFrame:
    """(token, doc_id, n, plain): prefix tokens under order 1 that other documents hold too.

    plain is the share of the counted slice that no other document holds; the least marks a pivot.
    """
    tokens = signatures.select("doc_id", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    cut = int(fraction(SLICES[0]))
    # hashes are unsigned: the upper half of their space is negative here
    level = F.when(F.col("token") < 0, 2).when(F.col("token") < cut, 0).otherwise(1)
    held = (
        tokens.join(counts, "token")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct(level.alias("level"), "df", "token"))).alias("held"))
    )
    need = F.expr(f"n - floor((n * {percent} + 99) / 100) + 1")
    per_level = [F.expr(f"size(filter(held, x -> x.level = {c}))") for c in (0, 1)]
    alone0 = F.col("m0") - per_level[0]
    alone1 = F.col("m1") - F.col("m0") - per_level[1]
    alone2 = F.col("counted") - F.col("m1") - (F.size("held") - per_level[0] - per_level[1])
    place = (
        signatures.select("doc_id", "n", "m0", "m1", F.size("tokens").alias("counted")).join(held, "doc_id")
        .withColumns({"need": need, "alone0": alone0, "alone1": alone0 + alone1, "alone2": alone0 + alone1 + alone2})
        .select("doc_id", "n", "need", "alone0", "alone1", "alone2",
                (F.col("alone2") / F.col("counted")).alias("plain"), F.posexplode("held").alias("i", "x"))
    )
    before = F.when(F.col("x.level") == 0, F.col("alone0")).when(F.col("x.level") == 1, F.col("alone1")).otherwise(
        F.col("alone2"))
    return place.where(F.col("i") + before < F.col("need")).select(F.col("x.token").alias("token"), "doc_id", "n", "plain")


def _cold_pairs(rows: DataFrame, percent: int) -> DataFrame:
    groups = rows.groupBy("token").agg(F.array_sort(F.collect_list(F.struct("n", "doc_id"))).alias("g"))
    first = groups.select(F.posexplode("g").alias("i", "x"), "g")
    return (
        first.select("x", F.explode(F.expr("slice(g, i + 2, size(g))")).alias("y"))
        .where(F.col("x.n") * 100 >= F.col("y.n") * percent)
        .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))
        .distinct()
    )


def _verify_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("doc_id").alias("a"), F.col("second").alias("a2"), F.col("third").alias("a3"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("second").alias("b2"), F.col("third").alias("b3"))
    passed = settled(
        pairs.join(left, "a").join(right, "b")
        .where(F.arrays_overlap("a2", "b2") & F.arrays_overlap("a3", "b3")).select("a", "b"), "passed")
    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return (
        passed.join(left, "a").join(right, "b").withColumn("both", both)
        .where(F.col("both") * 100 >= percent * (F.size("ta") + F.size("tb") - F.col("both"))).select("a", "b")
    )


def block_edges(ids: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], pivot: int, percent: int) -> list:
    """Edges that connect all linked documents of two blocks as far as pairs across them (or within one) go.

    Those near the pivot are joined to it. By the triangle inequality of the Jaccard distance, another document can
    only be linked to those whose distance from the pivot differs by less than the limit.
    """
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    sizes = np.array([len(s) for s in sets])

    def overlaps(s: np.ndarray) -> np.ndarray:
        a, b = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
        lengths = b - a
        at = np.repeat(a - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        return np.bincount(owner[at], minlength=len(sets))

    def linked(x: int, both: np.ndarray) -> np.ndarray:
        return 100 * both >= percent * (sizes[x] + sizes - both)

    centre = int(np.flatnonzero(ids == pivot)[0])
    both = overlaps(sets[centre])
    distance = 1 - both / (sizes[centre] + sizes - both)
    near = linked(centre, both)
    edges = [(int(pivot), int(i)) for i in ids[near] if i != pivot]
    limit = 1 - percent / 100 + 1e-9
    across = len(np.unique(blocks[ids != pivot])) > 1
    for x in np.flatnonzero(~near):
        other = (np.abs(distance - distance[x]) <= limit) & (np.minimum(sizes, sizes[x]) * 100 >=
                                                             percent * np.maximum(sizes, sizes[x]))
        other[x] = False
        if across:
            other &= (blocks != blocks[x])
        if not other.any():
            continue
        hits = np.flatnonzero(linked(x, overlaps(sets[x])) & other)
        in_ball = near[hits]
        if in_ball.any():
            edges.append((int(pivot), int(ids[x])))
        edges += [(int(ids[x]), int(ids[y])) for y in hits[~in_ball] if across or y > x]
    return edges


def _blocks(percent: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids = group.column("doc_id").to_numpy()
        pivot = group.column("pivot")[0].as_py()
        keep = np.sort(np.unique(ids, return_index=True)[1])  # the pivot comes with every block
        sets = list_values(group.column("tokens").chunk(0))
        edges = block_edges(ids[keep], group.column("block").to_numpy()[keep], [sets[i] for i in keep], pivot, percent)
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return run


def _hot_edges(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """members: (pivot, doc_id); the pivot is one of them."""
    weights = members.join(sets.select("doc_id", "n"), "doc_id").groupBy("pivot").agg(
        F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("k"))
    block = F.pmod(F.xxhash64("doc_id"), F.col("k")).cast("int")
    placed = members.join(weights, "pivot").withColumn("block", block)
    # block i goes to every pair of blocks that it is part of
    pair = F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.struct(
        F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j")))
    spread = placed.where("doc_id <> pivot").select("pivot", "doc_id", "block", F.explode(pair).alias("p"))
    heads = weights.select("pivot", F.col("pivot").alias("doc_id"), F.lit(-1).alias("block"), F.explode(F.expr(
        "flatten(transform(sequence(0, k - 1), i -> transform(sequence(i, k - 1), j -> struct(i as i, j as j))))"
    )).alias("p"))
    rows = spread.unionByName(heads).join(sets.select("doc_id", "tokens"), "doc_id")
    return rows.select("pivot", "p.i", "p.j", "doc_id", "block", "tokens").groupBy("pivot", "i", "j").applyInArrow(
        _blocks(percent), "a long, b long")


def jaccard_classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs (doc_id, text).

    component_id is the smallest doc_id reachable by links of similarity percent / 100 or more. Null, empty and
    wordless texts have no shingles and stand alone; texts of fewer than k words have one. Rows that repeat a doc_id
    share its component; rows without an id follow their text. An empty table gives no rows.
    """
    small_batches(docs.sparkSession, BATCH_BYTES)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"))
    signatures = settled(texts.mapInArrow(_signatures(k, percent), SIGNATURE), "signatures")
    classes = signatures.where("n > 0 and doc_id is not null").groupBy("d1", "d2", "n").agg(
        F.min("doc_id").alias("class_id"))
    labelled = settled(
        signatures.select("doc_id", "n", "d1", "d2").join(classes, ["d1", "d2", "n"], "left")
        .select("doc_id", "n", F.coalesce("class_id", "doc_id").alias("class_id")), "labelled")
    # the token lists stay where they are: what is left out of them is short and joins as ids
    words = labelled.where("n > 0 and doc_id is not null")
    again = settled(words.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id"), "again")
    out = settled(words.where("doc_id <> class_id").select("doc_id").union(again).distinct(), "copies")
    held = signatures.where("n > 0 and doc_id is not null")
    repeated = held.join(bounded(again), "doc_id", "left_semi").join(classes, ["d1", "d2", "n"]).where(
        "doc_id = class_id").dropDuplicates(["doc_id", "d1", "d2"])
    firsts = held.join(bounded(out), "doc_id", "left_anti").unionByName(repeated.select(held.columns))
    rows = settled(shared_prefixes(firsts, percent), "prefixes")
    sizes = rows.groupBy("token").agg(F.count("*").alias("g"), F.min(F.struct("plain", "doc_id")).alias("best")).where("g > 1")
    rows = settled(rows.join(sizes, "token").select("token", "doc_id", "n", "g", F.col("best.doc_id").alias("pivot")), "groups")
    pairs = settled(_cold_pairs(rows.where(F.col("g") <= PAIR_GROUP), percent), "pairs")
    members = settled(rows.where(F.col("g") > PAIR_GROUP).select("pivot", "doc_id").distinct(), "members")
    wanted = settled(
        pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).union(members.select("doc_id")).distinct(), "wanted")
    sets = settled(
        texts.join(bounded(wanted), "doc_id", "left_semi").select("doc_id", "text")
        .mapInArrow(_sets(k, percent), "doc_id long, n long, tokens array<long>, second array<long>, third array<long>"),
        "sets")
    edges = _verify_pairs(pairs, sets, percent).union(_hot_edges(members, sets, percent))
    found = connected_components(edges.toDF("a", "b"), "links")
    named = labelled.join(found, F.col("class_id") == F.col("node"), "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "class_id").alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs without those whose component has a smaller doc_id, and without repeated rows of an id.

    Texts stay where they are: only the ids that go, and rows of ids that repeat, are joined or shuffled.
    """
    with temporary_tables(docs.sparkSession) as kept:
        named = kept(jaccard_classes(docs, k, percent).where("doc_id is not null").select("doc_id", "component_id"), "named")
    again = settled(named.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id"), "again")
    gone = settled(named.where("doc_id <> component_id").select("doc_id").union(again).distinct(), "gone")
    heads = named.join(bounded(again), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("c")).where("c = doc_id")
    ids = docs.where("doc_id is not null")
    first = ids.join(bounded(settled(heads.select("doc_id"), "heads")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return docs.where("doc_id is null").unionByName(ids.join(bounded(gone), "doc_id", "left_anti").select(docs.columns)).unionByName(
        first.select(docs.columns))
