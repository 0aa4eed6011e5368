"""Best-fit packing of token pieces with exact-complement hashing.

Only lengths decide who shares a sequence, so the plan is made on the histogram of lengths, which has at most one
entry per length whatever the size of the corpus. Longest first, the gap of a piece is looked up among the available
single lengths, sums of two and sums of three; a combination that fills it exactly is used as often as its counts
allow, and what is left is packed best fit. The plan is a list of patterns with multiplicities. Pieces find their
place by their rank among pieces of the same length, counted in salted groups so that a common length is no hot key.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import kept_by, settled, small_batches

TOKENIZER = "byte_bpe_50k.json"
CACHED_WORDS = 600_000
GROUP_ROWS = 50_000
_BREAK = re.compile(r" (?=\S)")
_STRAY = re.compile(r" (?!\S)")  # a space that no visible character follows
# letters, signs but the apostrophe, a line break before a visible character, and letters and signs again: a unit each
_UNITS = re.compile(r"( ?[^\W\d_]+)([!-&(-/:-@[-^`{-~]+)(?:(\n)([^\W\d_]+)([!-&(-/:-@[-^`{-~]+)?)?")


class WordCache:
    """Ids of texts by a byte-level BPE whose words never span a space before a visible character."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile(f"({'|'.join(map(re.escape, added))})") if added else None

    def words(self, text: str) -> list[str]:
        """Parts whose ids are those of the text; an added token, such as <|endoftext|>, is a part of its own."""
        if self.added and self.added.search(text):
            return [w for i, x in enumerate(self.added.split(text)) if x for w in ([x] if i % 2 else self._words(x))]
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if "\0" not in text and not _STRAY.search(text):
            return text.replace(" ", "\0 ").split("\0")
        at = [0, *(m.start() for m in _BREAK.finditer(text)), len(text)]
        return [text[a:b] for a, b in zip(at, at[1:])]

    def learn(self, words: list[str]) -> None:
        """Ids of new words; one of letters only is a single unit of the model, which then needs no pre-tokenizer.

        Words of letters and signs are joined from such units, whose ids are kept like those of words.
        """
        known, rest = self.known, []
        for w in words:
            if (w[1:] if w[:1] == " " else w).isalpha():
                known[w] = self._unit(w)
            elif units := _units(w):
                ids = b""
                for unit in units:
                    own = known.get(unit)
                    if own is None:
                        own = known[unit] = self._unit(unit)
                    ids += own
                known[w] = ids
            else:
                rest.append(w)
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            known[w] = _packed(e.ids)

    def _unit(self, unit: str) -> bytes:
        letters = unit.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return _packed([t.id for t in self.tokenizer.model.tokenize(letters)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit numbers."""
        split = [self.words(t) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        self.learn(list(set().union(*split).difference(self.known)))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def _units(word: str) -> list[str] | None:
    """What the pre-tokenizer makes of a word of letters and signs; nothing for other words."""
    found = _UNITS.fullmatch(word)
    if not found:
        return None
    first, signs, line, second, more = found.groups()
    if not (first[1:] if first[0] == " " else first).isalpha() or not (second or "a").isalpha():  # numbers that are no digits
        return None
    return [u for u in (first, signs, line, second, more) if u]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a visible character: itself, or the next free one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)}


_BYTE_LETTERS = _byte_letters()


def _tokenizer(path: str | None) -> WordCache:
    kept = kept_by("packing")
    if path not in kept:
        import os

        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept[path] = WordCache(path or public_tokenizers.path(TOKENIZER))
    return kept[path]


def piece_lengths(n: int, length: int) -> list[int]:
    """Whole documents up to `length`; longer ones in full pieces after what is over."""
    if n <= length:
        return [n]
    return [n % length] * bool(n % length) + [length] * (n // length)


def _pieces(length: int, path: str | None, with_ids: bool):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(path)
        for part in parts:
            texts = part.column(1).to_pylist()
            for a in range(0, len(texts), 200):
                out = []
                for i, ids in enumerate(words.encode([t or "" for t in texts[a : a + 200]])):
                    ids += b"\0\0\0\0"
                    start = 0
                    for k, n in enumerate(piece_lengths(len(ids) // 4, length)):
                        own = ids[4 * start : 4 * (start + n)]
                        row = (i, k, start, n, zlib.crc32(own))
                        out.append((*row, np.frombuffer(own, "<u4").astype(np.int32)) if with_ids else row)
                        start += n
                at = np.array([r[0] for r in out])
                columns = [
                    part.column(0).slice(a, 200).take(pa.array(at)),
                    pa.array([r[1] for r in out], pa.int32()),
                    pa.array([r[2] for r in out], pa.int64()),
                    pa.array([r[3] for r in out], pa.int64()),
                    pa.array([r[4] for r in out], pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([r[5] for r in out], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _consume(counts: np.ndarray, items: tuple[int, ...]) -> int:
    """How often the multiset of lengths is available; takes it."""
    lengths, need = np.unique(items, return_counts=True)
    times = int((counts[lengths] // need).min())
    counts[lengths] -= times * need
    return times


def _complements(counts: np.ndarray, gap: int) -> Iterator[tuple[int, ...]]:
    """Combinations of one, two or three available lengths that sum to the gap, larger parts first."""
    if counts[gap]:
        yield (gap,)
    there = counts[: gap + 1] > 0
    large = np.arange(gap - 1, (gap - 1) // 2, -1)
    for b in large[there[large] & there[gap - large]]:
        yield int(b), int(gap - b)
    # an index of the sums of two lengths; a third length looks its complement up
    some = np.flatnonzero(there)
    pairs = np.zeros(gap + 1, bool)
    for b in some:
        pairs[b + some[some <= gap - b]] = True
    for a in some[::-1]:
        if a < gap and counts[a] and pairs[gap - a]:
            rest = gap - a
            b = np.arange(min(rest - 1, a), (rest - 1) // 2, -1)
            for x in b[(counts[b] > 0) & (counts[rest - b] > 0)]:
                yield int(a), int(x), int(rest - x)


def packing_plan(histogram: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) for {piece length: count}."""
    counts = np.zeros(length + 1, np.int64)
    for n, c in histogram.items():
        counts[n] = c
    plan = []
    if counts[length]:
        plan.append(((length,), int(counts[length])))
        counts[length] = 0
    for a in range(length - 1, 0, -1):
        while counts[a]:
            before = counts[a]
            for rest in _complements(counts, length - a):
                times = _consume(counts, (a, *rest))
                if times:
                    plan.append(((a, *rest), times))
                if not counts[a]:
                    break
            if counts[a] == before:
                break
    # best fit, longest first: open[g] has the patterns whose gap is g
    open_: dict[int, list] = {}
    gaps = np.zeros(length + 1, np.int64)

    def put(items: tuple[int, ...], times: int) -> None:
        gap = length - sum(items)
        open_.setdefault(gap, []).append((items, times))
        gaps[gap] += times

    for n in range(length - 1, 0, -1):
        left = int(counts[n])
        while left:
            fits = np.flatnonzero(gaps[n:])
            if len(fits):
                gap = int(fits[0]) + n
                items, times = open_[gap].pop()
                used = min(times, left)
                gaps[gap] -= times
                if times > used:
                    put(items, times - used)
                put((*items, n), used)
                left -= used
            else:
                each = min(length // n, left)
                put((n,) * each, left // each)
                left -= left // each * each
    return plan + [p for gap in sorted(open_) for p in open_[gap]]


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each place of each pattern: the ranks, among pieces of its length, that take it."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for items, times in plan:
        offset = 0
        for n in items:
            rows.append((n, used.get(n, 0), base, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        base += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "rank", "sequence", "offset"), columns))


def _placed(slots: dict[str, np.ndarray]):
    bounds = {int(n): np.searchsorted(slots["length"], [n, n + 1]) for n in np.unique(slots["length"])}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lengths = part.column("length").to_numpy()
            ranks = part.column("rank").to_numpy()
            at = np.zeros(len(lengths), np.int64)
            for n in np.unique(lengths):
                a, b = bounds[int(n)]
                own = lengths == n
                at[own] = a + np.searchsorted(slots["rank"][a:b], ranks[own], "right") - 1
            sequence = slots["sequence"][at] + ranks - slots["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in part.schema.names if c != "rank"]
                + [pa.array(sequence), pa.array(slots["offset"][at])],
                names=[c for c in part.schema.names if c != "rank"] + ["sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, length: int = 2048, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Packs docs (doc_id, text) into sequences of at most `length` tokens; one row per piece.

    A document is its ids, in which the string of an added token is that token, and a closing id 0, so null and empty texts are one piece of one token. Repeated rows are
    packed as often as they come. Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the ids
    if asked for; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = settled(texts.mapInArrow(_pieces(length, path, with_ids), schema), "pieces")
    groups = F.lit(max(1, pieces.count() // GROUP_ROWS))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), groups))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("c"))
    histogram = {r["length"]: r["c"] for r in sizes.groupBy("length").agg(F.sum("c").alias("c")).collect()}
    before = sizes.select("length", "salt", F.coalesce(F.sum("c").over(
        W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("own", own).join(before, ["length", "salt"]).withColumn(
        "rank", F.col("before") + F.col("own")).select(*pieces.columns, "rank")
    return ranked.mapInArrow(_placed(_slots(packing_plan(histogram, length))), schema + ", sequence_id long, offset long")


def sequences(docs: DataFrame, length: int = 2048, path: str | None = None) -> DataFrame:
    """The packed sequences themselves: sequence_id, input_ids, and the doc_id and length of each part."""
    parts = pack(docs, length, path, with_ids=True)
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return parts.groupBy("sequence_id").agg(rows.alias("x")).select(
        "sequence_id", F.flatten("x.ids").alias("input_ids"), F.col("x.doc_id").alias("doc_ids"),
        F.col("x.length").alias("lengths"))
