"""Removal of byte strings that occur more than once, by two-stage suffix sorting inside content-keyed buckets.

Each window of `length` bytes is keyed by the least hash of its k-byte strings, so equal windows of any documents have
equal keys; neighbouring windows of one key are one run. Only keys that occur twice are looked at again: the bytes of
their runs are reduced to distinct snippets, and snippets of one key are sorted together. Suffixes smaller than their
successors are sorted directly, the rest are induced from them by one scan over the buckets of first bytes, and
neighbours in that order with a common prefix of `length` bytes are repeats.

Copies of a whole text are one class: all its windows repeat, and one copy stands for it elsewhere. A key of very many
distinct snippets is not gathered: its windows are narrowed by the content they share and then counted by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, batches, kept_by, mixed, prefix_sums, settled, small_batches, span_hashes, utf8

GRAM = 32  # bytes hashed for the key of a window
BUCKET_BYTES = 1 << 19
PART_BYTES = 1 << 19  # of a long text that are looked at together
HOT_SNIPPETS = 5000  # distinct snippets of one key that are still sorted in one task
NARROW = 8  # windows that are told apart together at first
BROADCAST_ITEMS = 100_000
SORTED = 1 << 14  # suffixes whose first bytes are copied at once
PLACE_BITS = np.uint64(24)
SEPARATOR = 255  # no byte of UTF-8


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def window_runs(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int):
    """(text, key, first window, last window) of each run of windows of one key, in places of `data`."""
    gram = min(GRAM, length)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none.view(np.uint64), none, none
    at = np.arange(len(data) - gram + 1)
    hashes = span_hashes(prefix_sums(data), at, at + gram)
    keyed = (hashes >> PLACE_BITS << PLACE_BITS) | at.astype(np.uint64)
    least = sliding_minimum(keyed, length - gram + 1)
    text = np.repeat(np.arange(len(begins)), np.maximum(ends - begins - length + 1, 0))
    if not len(text):
        return none, none.view(np.uint64), none, none
    counts = np.maximum(ends - begins - length + 1, 0)
    starts = np.arange(len(text)) + np.repeat(begins - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    place = (least[starts] & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(text)]]) - 1
    return text[first], hashes[place[first]], starts[first], starts[last]


def _pieces_of(texts: list[bytes], length: int, most: int = PART_BYTES):
    """Joined texts; a long one in overlapping parts, so that the arrays of a part are small and places fit their bits."""
    most = max(most, 2 * length)
    for i, t in enumerate(texts):
        if len(t) <= most:
            continue
        for a in range(0, len(t) - length + 1, most - length + 1):
            yield [i], [a], t[a : a + most], np.array([0]), np.array([min(len(t) - a, most)])
    short = [i for i, t in enumerate(texts) if length <= len(t) <= most]
    group, size = [], 0
    for i in [*short, None]:
        if i is None or size + len(texts[i]) > most:
            if group:
                sizes = np.array([len(texts[j]) for j in group])
                begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                yield group, [0] * len(group), b"".join(texts[j] for j in group), begins, begins + sizes
            group, size = [], 0
        if i is not None:
            group.append(i)
            size += len(texts[i])


def _anchors(length: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by("suffix_dedup")
        for part in parts:
            for start, texts in batches(part.column("text")):
                found = []
                for rows, shifts, joined, begins, ends in _pieces_of(texts, length):
                    t, key, lo, hi = window_runs(np.frombuffer(joined, np.uint8), begins, ends, length)
                    back = np.array(shifts)[t] - begins[t] if len(t) else t
                    found.append((np.array(rows)[t], key, lo + back, hi + back))
                if not found:
                    continue
                row, key, lo, hi = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(row, kind="stable")
                row = row[order]
                each, at = np.unique(row, return_index=True)
                offsets = pa.array(np.append(at, len(row)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in
                         (key.view(np.int64), lo.astype(np.int32), hi.astype(np.int32))]
                take = pa.array(each + start)
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), *lists],
                                                 names=["doc_id", "key", "hashes", "lows", "highs"])

    return run


def _snippets(length: int):
    """The bytes of each wanted run."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                text = part.column("text")[i].as_buffer().to_pybytes()
                runs = part.column("runs")[i].as_py()
                for a in range(0, len(runs), 2000):
                    some = runs[a : a + 2000]
                    own = [text[r["low"] : r["high"] + length] for r in some]
                    digests = [int.from_bytes(hashlib.blake2b(s, digest_size=8).digest(), "little", signed=True) for s in own]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part.column("key")[i].as_py()] * len(some), pa.binary()),
                            pa.array([r["low"] for r in some], pa.int32()),
                            pa.array([r["hash"] for r in some], pa.int64()),
                            pa.array(digests, pa.int64()),
                            pa.array(own, pa.binary()),
                        ],
                        names=["key", "low", "hash", "digest", "snippet"],
                    )

    return run


def in_order(starts: np.ndarray, padded: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of `padded` in order of their first `depth` bytes, equal ones as given.

    Many are dealt out by two bytes, again and again, so that the bytes of few are copied to be compared.
    """
    parts, left = [np.zeros(0, np.int64)], [(starts, 0)]
    while left:
        some, at = left.pop()
        if at >= depth:
            parts.append(some)
        elif len(some) <= SORTED:
            keys = np.lib.stride_tricks.sliding_window_view(padded, depth - at)[some + at]
            parts.append(some[np.argsort(keys.view(f"S{depth - at}").ravel(), kind="stable")])
        else:
            two = padded[some + at].astype(np.uint16) << 8
            if at + 1 < depth:
                two |= padded[some + at + 1]
            order = np.argsort(two, kind="stable")
            some, two = some[order], two[order]
            ends = np.append(np.flatnonzero(np.diff(two)) + 1, len(some))
            dealt, a = [], 0
            while a < len(some):
                one = np.searchsorted(ends, a, "right")
                last = max(one, np.searchsorted(ends, a + SORTED, "right") - 1)
                dealt.append((some[a : ends[last]], at + 2 if last == one else at))
                a = ends[last]
            left.extend(reversed(dealt))
    return np.concatenate(parts)


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of `data` in order of their first `depth` bytes, by two-stage sorting.

    A suffix smaller than its successor is sorted directly. Any other follows its successor in the scan, which
    visits suffixes in their final order, so it is put at the next free place of its first byte's bucket.
    """
    n = len(data)
    change = np.zeros(n, np.int8)
    change[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    change[-1] = -1  # the empty suffix is the least
    at = np.where(change != 0, np.arange(n), n)
    rising = change[np.minimum.accumulate(at[::-1])[::-1]] > 0
    small = np.flatnonzero(rising)
    padded = np.concatenate([data, np.zeros(depth, np.uint8)])  # nothing is the least
    small = in_order(small, padded, depth)
    ends = np.searchsorted(data[small], np.arange(257))
    queued: list[list[np.ndarray]] = [[] for _ in range(256)]
    queued[data[-1]].append(np.array([n - 1]))
    out = []

    def induce(block: np.ndarray, byte: int) -> np.ndarray:
        before = block[block > 0] - 1
        before = before[~rising[before]]
        own = data[before]
        same, rest = before[own == byte], before[own != byte]
        if len(rest):
            own = data[rest]
            order = np.argsort(own, kind="stable")
            rest, own = rest[order], own[order]
            cuts = np.flatnonzero(np.diff(own)) + 1
            for part in np.split(rest, cuts):
                queued[data[part[0]]].append(part)
        return same

    for byte in range(256):
        wave = np.concatenate(queued[byte]) if queued[byte] else np.zeros(0, np.int64)
        while len(wave):
            out.append(wave)
            wave = induce(wave, byte)
        direct = small[ends[byte] : ends[byte + 1]]
        if len(direct):
            out.append(direct)
            induce(direct, byte)
    return np.concatenate(out)


def repeated_windows(snippets: list[bytes], length: int) -> np.ndarray:
    """For each byte of the joined snippets (a separator after each): does a window that repeats start there?"""
    data = np.frombuffer(b"".join(s + b"\xff" for s in snippets), np.uint8)
    sizes = np.array([len(s) + 1 for s in snippets])
    stops = np.cumsum(sizes)
    room = np.repeat(stops - 1, sizes) - np.arange(len(data))
    order = suffix_order(data, length)
    order = order[room[order] >= length]
    one, two = order[:-1], order[1:]
    for offset in range(length):  # common prefixes of neighbours, as far as they matter
        same = data[one + offset] == data[two + offset]
        if not same.all():
            one, two = one[same], two[same]
    out = np.zeros(len(data), bool)
    out[one] = out[two] = True
    return out


def _ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


def _bucket(length: int):
    def run(group: pa.Table) -> pa.Table:
        snippets = group.column("snippet").to_pylist()
        flags = repeated_windows(snippets, length)
        at, out = 0, ([], [], [])
        for i, s in enumerate(snippets):
            a, b = _ranges(flags[at : at + len(s)])
            at += len(s) + 1
            out[0].extend([i] * len(a))
            out[1].append(a)
            out[2].append(b)
        take = pa.array(out[0], pa.int64())
        number = lambda x: pa.array(np.concatenate(x).astype(np.int32) if x else [], pa.int32())
        return pa.table({"hash": group.column("hash").take(take), "digest": group.column("digest").take(take),
                         "a": number(out[1]), "b": number(out[2])})

    return run


def _window_keys(length: int, step: int):
    """Splits runs of windows into groups of `step` places from the key's own place; keyed by what a group shares."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                text = np.frombuffer(part.column("snippet")[i].as_buffer(), np.uint8)
                first, last = part.column("first")[i].as_py(), part.column("last")[i].as_py()
                # the k-byte string of the key is at one place of every window's content
                windows = np.arange(first, last + 1)
                spans = span_hashes(prefix_sums(text), np.arange(len(text) - min(GRAM, length) + 1),
                                    np.arange(len(text) - min(GRAM, length) + 1) + min(GRAM, length))
                key = np.uint64(part.column("hash")[i].as_py() & (2**64 - 1))
                place = int(np.flatnonzero(spans == key)[0])
                group = (place - windows + len(text) * step) // step
                cuts = np.flatnonzero(np.diff(group)) + 1
                lows = windows[np.concatenate([[0], cuts])].astype(np.int64)
                highs = windows[np.concatenate([cuts - 1, [len(windows) - 1]])].astype(np.int64)
                number = (place - lows + len(text) * step) // step - len(text)
                a, b = place - number * step, place - (number + 1) * step + 1 + length
                shared = span_hashes(prefix_sums(text), a, b)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("hash").slice(i, 1).take(pa.array(np.zeros(len(lows), np.int64))),
                        part.column("digest").slice(i, 1).take(pa.array(np.zeros(len(lows), np.int64))),
                        pa.array(lows.astype(np.int32)),
                        pa.array(highs.astype(np.int32)),
                        pa.array(mixed(shared ^ number.astype(np.uint64)).view(np.int64)),
                    ],
                    names=["hash", "digest", "a", "b", "shared"],
                )

    return run


def _narrowed(rows: DataFrame, length: int, step: int, name: str) -> DataFrame:
    keyed = settled(rows.mapInArrow(_window_keys(length, step), "hash long, digest long, a int, b int, shared long"), name)
    often = keyed.groupBy("hash", "shared").agg(F.count("*").alias("c")).where("c > 1")
    return keyed.join(often, ["hash", "shared"]).select("hash", "digest", "a", "b")


def _hot_ranges(hot: DataFrame, length: int) -> DataFrame:
    """Repeated windows among snippets (hash, digest, snippet) of keys that have very many."""
    rows = hot.withColumns({"first": F.lit(0), "last": F.length("snippet") - length})
    near = _narrowed(rows, length, NARROW, "narrow")
    rows = near.join(hot, ["hash", "digest"]).select("hash", "digest", "snippet", F.col("a").alias("first"),
                                                     F.col("b").alias("last"))
    return _narrowed(rows, length, 1, "windows")


def repeats(texts: DataFrame, length: int) -> DataFrame:
    """(key, whole, ranges) of texts (doc_id, key, text): what to remove from the texts of that key.

    whole says that the text has copies; ranges has the first and last start of repeated windows.
    """
    found = settled(
        texts.where(F.length("text") >= length).mapInArrow(
            _anchors(length), "doc_id long, key binary, hashes array<long>, lows array<int>, highs array<int>"), "anchors")
    classes = settled(found.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("head")), "classes")
    copied = classes.where("copies > 1")
    heads = found.join(copied, "key", "left").where("copies is null or doc_id <=> head")
    runs = heads.select("doc_id", "key", F.explode(F.arrays_zip("hashes", "lows", "highs")).alias("x")).select(
        "doc_id", "key", F.col("x.hashes").alias("hash"), F.col("x.lows").alias("low"), F.col("x.highs").alias("high"))
    often = runs.groupBy("hash").agg(F.count("*").alias("c")).where("c > 1").select("hash")
    wanted = settled(
        runs.join(often, "hash").groupBy("doc_id", "key").agg(F.collect_list(F.struct("hash", "low", "high")).alias("runs")),
        "runs")
    many = wanted.agg(F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()[0]
    side = F.broadcast(wanted) if many <= BROADCAST_ITEMS else wanted
    alias = side.select(F.col("doc_id").alias("head"), "key", "runs")
    snippets = settled(
        texts.where(F.length("text") >= length).join(alias, "key").where("doc_id <=> head").select("key", "text", "runs")
        .mapInArrow(_snippets(length), "key binary, low int, hash long, digest long, snippet binary"), "snippets")
    # copies of a snippet meet in a partial aggregate: all their windows repeat
    distinct = settled(
        snippets.groupBy("hash", "digest").agg(F.count("*").alias("times"), F.first("snippet").alias("snippet")), "distinct")
    sizes = distinct.groupBy("hash").agg(F.count("*").alias("g")).where("g > 1")
    several = distinct.join(sizes, "hash")
    volume = distinct.agg(F.coalesce(F.sum(F.length("snippet")), F.lit(0))).first()[0]
    buckets = max(1, volume // BUCKET_BYTES)
    sorted_ = several.where(F.col("g") <= HOT_SNIPPETS).select(
        F.pmod(F.xxhash64("hash"), F.lit(buckets)).alias("bucket"), "hash", "digest", "snippet")
    cold = sorted_.groupBy("bucket").applyInArrow(_bucket(length), "hash long, digest long, a int, b int")
    hot = _hot_ranges(several.where(F.col("g") > HOT_SNIPPETS).select("hash", "digest", "snippet"), length)
    whole = distinct.where("times > 1").select("hash", "digest", F.lit(0).alias("a"),
                                               (F.length("snippet") - length).alias("b"))
    ranges = settled(cold.union(hot).union(whole), "ranges")
    removed = snippets.select("key", "low", "hash", "digest").join(ranges, ["hash", "digest"]).groupBy("key").agg(
        F.collect_list(F.struct((F.col("low") + F.col("a")).alias("a"), (F.col("low") + F.col("b")).alias("b"))).alias("ranges"))
    return settled(
        removed.join(copied.select("key", F.lit(True).alias("whole")), "key", "full").select(
            "key", F.coalesce("whole", F.lit(False)).alias("whole"), "ranges"), "removed")


def remaining(text: bytes, whole: bool, ranges: list, length: int) -> tuple[bytes, int]:
    """What is left of a text, and how many runs of bytes were removed."""
    if whole and len(text) >= length:
        return b"", 1
    if not ranges:
        return text, 0
    ranges = sorted((r["a"], r["b"] + length) for r in ranges)
    left, at, spans = [], 0, 0
    start, end = ranges[0]
    for a, b in [*ranges[1:], (len(text) + 1, 0)]:
        if a > end:
            left.append(text[at:start])
            at, spans = end, spans + 1
            start, end = a, b
        else:
            end = max(end, b)
    return b"".join(left) + text[at:], spans


def _cut(length: int, with_text: bool):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for i in range(part.num_rows):
                text = part.column("text")[i].as_buffer().to_pybytes()
                left, spans = remaining(text, bool(part.column("whole")[i].as_py()), part.column("ranges")[i].as_py(), length)
                # a cut inside a character leaves bytes that are no text
                last = left.decode("utf-8", "ignore") if with_text else hashlib.sha256(left).hexdigest()
                rows.append((len(text), len(text) - len(left), spans, last))
            columns = list(zip(*rows)) or [()] * 4
            arrays = [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.string())]
            names = ["row", "n_bytes", "n_removed", "n_spans", "kept" if with_text else "kept_sha256"]
            yield pa.RecordBatch.from_arrays([part.column("row"), *arrays], names=names)

    return run


def cut_rows(docs: DataFrame, length: int, with_text: bool) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept or kept_sha256): all columns of docs but the text are in `row`."""
    small_batches(docs.sparkSession, BATCH_BYTES)
    binary = utf8(F.col("text"))
    key = F.unhex(F.md5(binary))
    removed = repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), binary.alias("text")), length)
    items = removed.agg(F.coalesce(F.sum(F.coalesce(F.size("ranges"), F.lit(0)) + 1), F.lit(0))).first()[0]
    side = F.broadcast(removed) if items <= BROADCAST_ITEMS else removed
    rows = docs.select(F.struct(*(c for c in docs.columns if c != "text")).alias("row"), key.alias("key"), binary.alias("text"))
    asked = rows.join(side, "key", "left").select("row", "text", "whole", "ranges")
    kind = asked.schema["row"].dataType.simpleString()
    last = "kept string" if with_text else "kept_sha256 string"
    return asked.mapInArrow(_cut(length, with_text), f"row {kind}, n_bytes long, n_removed long, n_spans long, {last}")


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of docs (doc_id, text).

    Removed is each byte of a `length`-byte string that also starts elsewhere, in the same or another row, judged on
    the input. Null is empty; shorter texts are kept; repeated rows are copies of each other and lose all their bytes.
    Repeated or null ids are told apart by their text. An empty table gives no rows.
    """
    return cut_rows(docs.select("doc_id", "text"), length, False).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """The rows of docs with repeated strings cut out of the text; n_chars, if there is such a column, is renewed.

    A text that is removed altogether becomes empty, and its row stays.
    """
    made = cut_rows(docs, length, True)
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return made.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
