"""Removal of word sequences that occur earlier, by suffix trees of groups of suffixes with a common prefix.

Only stretches that may repeat reach the trees. A window of `length` words is keyed by the least hash of its short word
runs, so equal windows have equal keys, and neighbouring windows of one key are one snippet. Snippets whose key occurs
once hold no repeat. Equal snippets meet in a partial aggregate: all but the first lose all their windows.

What remains, the first snippets of keys with several different ones, is cut into suffixes. The prefix that groups them
is as long as it has to be: suffixes are counted by their first words, and a prefix of too many suffixes for a task's
memory is made longer. Each group is one suffix tree; its internal nodes of `length` words are windows that repeat, and
all their leaves but the earliest are removed. A prefix of the full length needs no tree: it is such a node by itself,
of any number of leaves, whose earliest one a partial aggregate finds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (SLICE_BYTES, VISIBLE, Scratch, batches, bounded, number_sums, prefix_sums, sequence_hashes, small_batches,
                     span_hashes, utf8)
from .suffix_dedup import sliding_minimum

GRAM = 8  # words hashed for the key of a window
BLOCK = 4  # words of a letter of the trees
GROUP = 1 << 16  # suffixes of one tree
PLACE_BITS = np.uint64(24)
MOST_WORDS = 1 << 23  # taken at once, so that places fit their bits
LAST = (1 << 63) - 1  # null ids come last


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of joined texts, and the first word of each text and the end."""
    found, firsts, count = [], [], 0
    for piece, own in _slices(texts):
        data = np.frombuffer(piece, np.uint8)
        mask = np.zeros(len(data) + 2, np.int8)
        mask[1:-1] = VISIBLE[data]
        edges = np.diff(mask)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        found.append(span_hashes(prefix_sums(data), starts, ends))
        firsts.append(np.searchsorted(starts, own) + count)
        count += len(starts)
    return np.concatenate(found), np.append(np.concatenate(firsts), count)


def _slices(texts: list[bytes]):
    """(bytes, starts of texts in them): long texts in slices that end at white space."""
    joined = b" ".join(texts)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    at = 0
    while at == 0 or at < len(joined):
        end = at + SLICE_BYTES
        while end < len(joined) and joined[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield joined[at:end], begins[(begins >= at) & ((begins < end) | (end >= len(joined)))] - at
        at = end


def snippets(words: np.ndarray, firsts: np.ndarray, length: int):
    """(text, key, digest, first window from the text's start, windows) of runs of windows of one key."""
    gram = min(GRAM, length)
    sizes = np.diff(firsts)
    counts = np.maximum(sizes - length + 1, 0)
    if not counts.sum():
        return [np.zeros(0, np.int64)] * 5
    out = []
    for a in range(0, max(1, len(words) - length + 1), MOST_WORDS - length + 1):
        own = words[a : a + MOST_WORDS]
        text = np.repeat(np.arange(len(sizes)), counts)
        starts = np.arange(len(text)) + np.repeat(firsts[:-1] - (np.cumsum(counts) - counts), counts)
        here = (starts >= a) & (starts + length <= a + len(own))
        text, starts = text[here], starts[here] - a
        if not len(text):
            continue
        hashes = sequence_hashes(own, gram)
        keyed = (hashes >> PLACE_BITS << PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        place = (sliding_minimum(keyed, length - gram + 1)[starts] & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
        last = np.concatenate([first[1:], [len(text)]]) - 1
        digest = span_hashes(number_sums(own), starts[first], starts[last] + length)
        row = text[first]
        out.append((row, hashes[place[first]], digest, starts[first] + a - firsts[row], last - first + 1))
    return [np.concatenate(x) for x in zip(*out)]


def _found(length: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start, texts in batches(part.column("text")):
                row, key, digest, low, windows = snippets(*word_hashes(texts), length)
                if not len(row):
                    continue
                order = np.argsort(row, kind="stable")
                each, at = np.unique(row[order], return_index=True)
                offsets = pa.array(np.append(at, len(row)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in
                         (key.view(np.int64), digest.view(np.int64), low.astype(np.int32), windows.astype(np.int32))]
                take = pa.array(each + start)
                yield pa.RecordBatch.from_arrays([part.column("doc").take(take), part.column("tag").take(take), *lists],
                                                 names=["doc", "tag", "key", "digest", "low", "windows"])

    return run


def block_sizes(length: int) -> list[int]:
    return [BLOCK] * (length // BLOCK) + ([length % BLOCK] if length % BLOCK else [])


def _suffixes(length: int):
    """Each wanted window as the letters of a suffix: hashes of its blocks of words."""
    sizes = block_sizes(length)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                words, _ = word_hashes([part.column("text")[i].as_buffer().to_pybytes()])
                wanted = part.column("wanted")[i].values
                lows, windows = (wanted.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("low", "windows"))
                starts = np.unique(np.repeat(lows - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum()))
                hashed = {n: sequence_hashes(words, n).view(np.int64) for n in set(sizes)}
                shifts = np.cumsum([0, *sizes])[:-1]
                for a in range(0, len(starts), 100_000):
                    some = starts[a : a + 100_000]
                    same = pa.array(np.full(len(some), i))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc").take(same), part.column("tag").take(same), pa.array(some.astype(np.int32)),
                         *(pa.array(hashed[n][some + shift]) for n, shift in zip(sizes, shifts))],
                        names=["doc", "tag", "start", *(f"b{k}" for k in range(len(sizes)))])

    return run


def suffix_tree(letters: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(order of the leaves, for each depth the first and last leaf of the internal nodes there) of suffixes of equal depth.

    A node is a run of leaves with a common prefix of its depth; it is left out where a deeper one has the same leaves.
    """
    order = np.lexsort(letters[::-1])
    common = np.zeros(max(len(order) - 1, 0), np.int64)  # of neighbours
    going = np.ones(len(common), bool)
    for own in letters:
        going &= own[order[1:]] == own[order[:-1]]
        common += going
    nodes = []
    for depth in range(1, len(letters) + 1):
        edges = np.diff(np.concatenate([[0], (common >= depth).astype(np.int8), [0]]))
        first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if depth < len(letters) and len(first):
            branching = np.minimum.reduceat(np.append(common, 0), np.stack([first, last], 1).ravel())[::2] == depth
            first, last = first[branching], last[branching]
        nodes.append((first, last))
    return order, nodes


def _trees(depth: int):
    """The windows of a bucket of groups that occur earlier."""
    def run(group: pa.Table) -> pa.Table:
        doc, tag, start = (group.column(c).to_numpy() for c in ("doc", "tag", "start"))
        letters = [group.column(f"b{k}").to_numpy() for k in range(depth)]
        order, nodes = suffix_tree(letters)
        first, last = nodes[-1]
        sizes = last - first + 1
        leaf = order[np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        node = np.repeat(np.arange(len(first)), sizes)
        ranked = np.lexsort((tag[leaf], start[leaf], doc[leaf], node))
        leaf, node = leaf[ranked], node[ranked]
        earliest = leaf[np.cumsum(sizes) - sizes][node] if len(node) else leaf
        later = leaf[(doc[leaf] != doc[earliest]) | (start[leaf] != start[earliest]) | (tag[leaf] != tag[earliest])]
        return pa.table({"doc": pa.array(doc[later]), "tag": pa.array(tag[later]), "start": pa.array(start[later])})

    return run


def earlier_windows(suffixes: DataFrame, depth: int, scratch: Scratch) -> DataFrame:
    """(doc, tag, start) of suffixes (doc, tag, start, b0, b1, ...) whose letters all occur earlier."""
    letters = [f"b{k}" for k in range(depth)]
    # the prefix of a suffix is made longer as long as too many begin with it
    grown, prefix = suffixes, F.lit(1)
    for k in range(1, depth + 1):
        hot = scratch.put(grown.where(prefix == k).groupBy(letters[:k]).agg(F.count("*").alias("c")).where(F.col("c") > GROUP).select(
            *letters[:k], F.lit(True).alias(f"hot{k}")), f"hot{k}")
        if hot.isEmpty():
            break
        grown = grown.join(bounded(hot), letters[:k], "left")
        prefix = F.when(F.col(f"hot{k}").isNotNull(), k + 1).otherwise(prefix)
    grown = grown.withColumn("prefix", prefix)
    own = F.xxhash64("prefix", *(F.when(F.col("prefix") > k, F.col(c)) for k, c in enumerate(letters)))
    buckets = max(1, suffixes.count() // GROUP)
    small = grown.where(F.col("prefix") <= depth).select("doc", "tag", "start", *letters, F.pmod(own, F.lit(buckets)).alias("bucket"))
    found = small.groupBy("bucket").applyInArrow(_trees(depth), "doc long, tag long, start int")
    whole = grown.where(F.col("prefix") > depth)
    first = whole.groupBy(letters).agg(F.min(F.struct("doc", "start", "tag")).alias("first"))
    later = whole.join(first, letters).where(F.struct("doc", "start", "tag") > F.col("first")).select("doc", "tag", "start")
    return found.union(later)


def earlier_ranges(texts: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """(doc, tag, ranges of words) to remove from texts (doc, tag, text)."""
    found = scratch.put(texts.mapInArrow(
        _found(length), "doc long, tag long, key array<long>, digest array<long>, low array<int>, windows array<int>"), "found")
    each = found.select("doc", "tag", F.explode(F.arrays_zip("key", "digest", "low", "windows")).alias("x")).select(
        "doc", "tag", "x.key", "x.digest", "x.low", "x.windows")
    often = scratch.put(each.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "often")
    live = scratch.put(each.join(often, "key"), "live")
    scratch.drop("found", "often")
    place = F.struct("doc", "low", "tag")
    distinct = scratch.put(live.groupBy("key", "digest").agg(
        F.count("*").alias("times"), F.min(place).alias("first"), F.first("windows").alias("windows")), "distinct")
    firsts = distinct.where("times > 1").select("key", "digest", "first")
    copies = scratch.put(live.join(firsts, ["key", "digest"]).where(place > F.col("first")).select(
        "doc", "tag", F.col("low").alias("a"), (F.col("low") + F.col("windows") - 1 + length).alias("b")), "copies")
    scratch.drop("live")
    several = distinct.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    wanted = scratch.put(distinct.join(several, "key").select("first.doc", "first.tag", F.struct("first.low", "windows").alias("x")).groupBy(
        "doc", "tag").agg(F.collect_list("x").alias("wanted")), "wanted")
    depth = len(block_sizes(length))
    suffixes = scratch.put(texts.join(wanted, ["doc", "tag"]).mapInArrow(
        _suffixes(length), "doc long, tag long, start int, " + ", ".join(f"b{k} long" for k in range(depth))), "suffixes")
    later = earlier_windows(suffixes, depth, scratch).select("doc", "tag", F.col("start").alias("a"), (F.col("start") + length).alias("b"))
    ranges = scratch.put(copies.union(later).groupBy("doc", "tag").agg(F.collect_list(F.struct("a", "b")).alias("ranges")), "ranges")
    scratch.drop("distinct", "copies", "wanted", "suffixes")
    return ranges


def remaining(words: list[bytes], ranges: list[dict] | None) -> list[bytes]:
    """The words outside all ranges."""
    if not ranges:
        return words
    left, at = [], 0
    for r in sorted(ranges, key=lambda r: r["a"]):
        left += words[at : r["a"]]
        at = max(at, r["b"])
    return left + words[at:]


def _cut(with_text: bool):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for i in range(part.num_rows):
                words = part.column("text")[i].as_buffer().to_pybytes().split()  # at ASCII white space only
                left = remaining(words, part.column("ranges")[i].as_py())
                kept = b" ".join(left)
                rows.append((len(words), len(words) - len(left), kept.decode() if with_text else hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                names=["row", "n_words", "n_removed", "kept"])

    return run


def cut_rows(docs: DataFrame, length: int, with_text: bool) -> DataFrame:
    """(row, n_words, n_removed, kept): all columns of docs but the text are in `row`; kept is the text or its SHA-256."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "prefix-trees")
    text = utf8(F.col("text"))
    keyed = {"doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), "tag": F.xxhash64(text), "text": text}
    ranges = earlier_ranges(docs.select(*(c.alias(k) for k, c in keyed.items())), length, scratch)
    rows = docs.select(F.struct(*(c for c in docs.columns if c != "text")).alias("row"), *(c.alias(k) for k, c in keyed.items()))
    asked = rows.join(ranges, ["doc", "tag"], "left").select("row", "text", "ranges")
    return asked.mapInArrow(_cut(with_text), f"row {asked.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept string")


def remove_earlier(docs: DataFrame, length: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for each row of docs (doc_id, text).

    Removed is each word of a window of `length` words that also starts earlier: in a smaller doc_id, or earlier in the
    same one. Null texts are empty, null ids come last. Equal rows are one document and get equal results; other rows of
    one id are in the order of their starts, then of a hash of the text. An empty table gives no rows.
    """
    return cut_rows(docs.select("doc_id", "text"), length, False).select(
        "row.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def without_earlier(docs: DataFrame, length: int = 20) -> DataFrame:
    """The rows of docs with the text cut to its kept words, joined by one space; n_chars, if there is such a column, is renewed."""
    made = cut_rows(docs, length, True)
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return made.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
