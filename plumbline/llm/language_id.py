"""Language identification by cross-parsing entropy with suffix automata.

For each language an automaton of a bounded sample of its labelled text accepts exactly the strings that occur there.
A text is parsed greedily: the longest match from where the last one ended is a phrase. The more the text is like a
language, the fewer phrases it takes; phrases * log2(sample) / length estimates the cross entropy, and the least wins.
The automata are transition tables, so that many texts advance by one character at a time in step. A long text is
parsed in lanes of a fixed length, which adds at most one phrase per lane, for every language alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded, kept_by, settled, small_batches

SAMPLE_ROWS = 96  # labelled rows of a language that its automaton is fitted on
SAMPLE_CHARS = 256  # of each of these rows, from a seeded place
ALPHABET = 64  # most frequent letters of the samples; the space is 0 and any other letter the last
LANE = 1024
LAST_LETTERS = 0x40000  # planes 0 to 3 hold all letters
SCORE_SCALE = 24.0  # how sharply a difference of entropy (relative) decides the score


class SuffixAutomaton:
    """All substrings of a sequence of small numbers."""

    def __init__(self, symbols):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for c in symbols:
            state = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = state
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                if self.length[p] + 1 == self.length[q]:
                    self.link[state] = q
                else:
                    twin = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.length.append(self.length[p] + 1)
                    self.link.append(self.link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = twin
                        p = self.link[p]
                    self.link[q] = self.link[state] = twin
            last = state

    def table(self, symbols: int) -> np.ndarray:
        """next state * symbols * 2 + (1 if a phrase ends before this symbol), for state * symbols + symbol."""
        unknown = len(self.next)  # a state after a symbol that the sample lacks: nothing extends it
        root = np.full(symbols, unknown, np.int64)
        for c, t in self.next[0].items():
            root[c] = t
        out = np.tile(root * symbols * 2 + 1, (len(self.next) + 1, 1))
        out[0] = root * symbols * 2
        for s, moves in enumerate(self.next):
            for c, t in moves.items():
                out[s, c] = t * symbols * 2
        return out.ravel().astype(np.int32)


class LanguageModel:
    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        folded = {k: [fold_text(t) for t in v] for k, v in samples.items()}
        points, counts = np.unique(np.concatenate([np.zeros(0, np.uint32), *(x for v in folded.values() for x in v)]),
                                   return_counts=True)
        common = points[np.argsort(-counts, kind="stable")]
        common = common[common != 32][: ALPHABET - 2]
        self.codes = np.full(0x10000, ALPHABET - 1, np.uint8)
        self.codes[32] = 0
        self.codes[common] = np.arange(1, len(common) + 1)
        self.tables, self.scale = [], []
        for k in self.languages:
            text = np.concatenate([np.append(self.encode(x), 0) for x in folded[k]] or [np.zeros(1, np.uint8)])
            self.tables.append(SuffixAutomaton(text.tolist()).table(ALPHABET))
            self.scale.append(np.log2(len(text) + 1))

    def encode(self, points: np.ndarray) -> np.ndarray:
        return self.codes[np.minimum(points, 0xFFFF)]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text under each language."""
        flat = np.concatenate([np.zeros(0, np.uint8), *texts])
        sizes = np.array([len(t) for t in texts])
        lanes = -(-sizes // LANE)
        owner = np.repeat(np.arange(len(texts)), lanes)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        start = np.repeat(begin - LANE * np.concatenate([[0], np.cumsum(lanes)[:-1]]), lanes) + LANE * np.arange(lanes.sum())
        length = np.minimum(LANE, np.repeat(begin + sizes, lanes) - start)
        order = np.argsort(-length, kind="stable")
        owner, start, length = owner[order], start[order], length[order]
        active = np.searchsorted(-length, -np.arange(1, LANE + 1), "right")
        symbols = np.zeros((LANE, len(start)), np.int32)
        for i in range(LANE):
            if not active[i]:
                break
            symbols[i, : active[i]] = flat[start[: active[i]] + i]
        out = np.zeros((len(texts), len(self.languages)))
        for k, table in enumerate(self.tables):
            state = np.zeros(len(start), np.int32)
            ended = np.zeros(len(start), np.int32)
            for i in range(LANE):
                n = active[i]
                if not n:
                    break
                step = table[(state[:n] >> 1) + symbols[i, :n]]
                ended[:n] += step & 1
                state[:n] = step
            out[:, k] = np.bincount(owner, ended + 1, len(texts))
        return out


def fold_text(text: str) -> np.ndarray:
    """Code points of a text in lower case, with each run of anything but letters as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letters = LETTER[np.minimum(points, len(LETTER) - 1)]
    points = np.where(letters, points, np.uint32(32))
    keep = letters.copy()
    keep[1:] |= letters[:-1]
    return points[keep]


def _letter_table() -> np.ndarray:
    """Which code points are letters; there are none from LAST_LETTERS on, whose place stands for all that follow."""
    out = np.zeros(LAST_LETTERS + 1, bool)
    for i in (*range(0xD800), *range(0xE000, LAST_LETTERS)):
        out[i] = chr(i).isalpha()
    return out


LETTER = _letter_table()


def sample_texts(docs: DataFrame, labelled, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """Up to `rows` excerpts of `chars` characters for each language of the rows where `labelled` holds.

    Texts and places are drawn by hashes of the text, so reruns agree, and copies of a text are one. A first cut by a
    hash bound leaves about four times the texts wanted, so that no large group is ranked.
    """
    there = docs.where(labelled & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = settled(there.select("lang", F.xxhash64("text").alias("hash")).distinct().groupBy("lang").agg(
        F.count("*").alias("c")), "languages")
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    cut = there.select("lang", "text", draw.alias("draw")).join(bounded(counts), "lang").where(
        F.col("draw") <= F.lit(float(1 << 40)) * 4 * rows / F.col("c"))
    at = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - chars, F.lit(0)) + 1) + 1
    parts = cut.select("lang", "draw", F.xxhash64("text").alias("hash"), F.substring("text", at.cast("int"), F.lit(chars)).alias("part"))
    ranked = parts.groupBy("lang", "hash").agg(F.min("draw").alias("draw"), F.min("part").alias("part")).withColumn(
        "r", F.row_number().over(W.partitionBy("lang").orderBy("draw", "part"))).where(F.col("r") <= rows)
    out: dict[str, list[str]] = {}
    for r in ranked.orderBy("lang", "r").collect():
        out.setdefault(r["lang"], []).append(r["part"])
    return out


def _predict(model: LanguageModel):
    languages = np.array([*model.languages, "und"], object)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by("language_id")
        for part in parts:
            names = [c for c in part.schema.names if c != "text"]
            best, score = [], []
            texts = part.column("text")
            held, size = [], 0
            for i in range(len(texts)):
                held.append(model.encode(fold_text(texts[i].as_py() or "")))
                size += len(held[-1])
                if size > 1 << 21 or i == len(texts) - 1:
                    lengths = np.array([int((t > 0).sum()) for t in held])
                    if model.languages:
                        bits = model.phrases(held) * model.scale / np.maximum(lengths, 1)[:, None]
                        order = bits.argmin(axis=1)
                        relative = bits / np.maximum(bits.min(axis=1, keepdims=True), 1e-9) - 1
                        chance = 1 / np.exp(-SCORE_SCALE * relative).sum(axis=1)
                        order[lengths == 0] = len(model.languages)
                        chance[lengths == 0] = 0
                    else:
                        order, chance = np.zeros(len(held), int), np.zeros(len(held))
                    best.append(languages[order])
                    score.append(chance)
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in names]
                + [pa.array(np.concatenate(best) if best else [], pa.string()),
                   pa.array(np.concatenate(score) if score else [], pa.float64())],
                names=[*names, "lang_pred", "score"],
            )

    return run


def predicted(docs: DataFrame, labelled=None, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(row, lang_pred, score): every column of docs in `row`, whatever its name."""
    small_batches(docs.sparkSession)
    model = LanguageModel(sample_texts(docs, F.lit(True) if labelled is None else labelled, rows, chars))
    asked = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    kind = asked.schema["row"].dataType.simpleString()
    return asked.mapInArrow(_predict(model), f"row {kind}, lang_pred string, score double")


def identify(docs: DataFrame, labelled=None, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of docs (doc_id, text, lang).

    The automata are fitted on rows where `labelled` holds (all, if none is given) and lang is not null; lang takes no
    part in a prediction. A null text, or one without letters, is `und` with score 0, and so is every text if there
    are no labelled rows. Ties go to the first language by code point. Repeated rows get equal results.
    """
    texts = docs.select("doc_id", "text", "lang")
    return predicted(texts, labelled, rows, chars).select("row.doc_id", "lang_pred", "score")


def known_language(docs: DataFrame, labelled=None) -> DataFrame:
    """The rows of docs whose text has a language; those without letters go."""
    return predicted(docs, labelled).where("lang_pred <> 'und'").select("row.*")
