"""Toxicity of texts whose words may be disguised, by a noisy channel and a lexicon learned from labels.

A disguised word is a lattice: each character is kept, replaced by the letter it stands for, dropped, or merged with
its repetitions; a run of spaced characters may also end a word after each of them. Viterbi decoding under a character trigram model, counted over the whole corpus, finds the likeliest
word. The score is a calibrated sum of the log-odds of the telling words and word beginnings that the restored text
holds. They are chosen and calibrated on distinct texts, and evidence for them is counted in distinct contexts, so that
copies of a text count once.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, batches, bounded, settled, small_batches, utf8

# what a character may stand for (fixed values of the channel)
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "*": "aeiou", "#": "h",
}
COST = {"keep": 0.0, "swap": 1.0, "merge": 0.7, "mask": 2.0}  # negative log probabilities
DROP = {**dict.fromkeys(".,;:-_'\"", 1.0), **dict.fromkeys("*#%&", 6.0)}  # of a character put in
DROP_OTHER = 14.0
SYMBOLS = 64
BEAM = 64
FREQUENT = 100_000  # features of toxic texts up to which clean texts are counted for these only; beyond, all are, and joined
LEAST_DOCS, LEAST_CONTEXTS, LEAST_Z, LEAST_WEIGHT = 5, 5, 4.0, 2.0
LEAST_ODDS = 2.0  # how much likelier distinct toxic texts hold a telling feature; z alone grows with the sample
STEP = 0.25  # bins of the evidence that the calibration is fitted on
CACHED_TOKENS = 500_000
COUNTED = 500_000  # features that a task counts before it passes them on


def symbols(points: np.ndarray) -> np.ndarray:
    """0 for what is no letter, 1 to 26 for a-z, and a fixed hash of the code point for other letters."""
    out = np.zeros(len(points), np.int64)
    ascii_ = (points >= 97) & (points <= 122)
    out[ascii_] = points[ascii_] - 96
    other = points >= 0xAA
    out[other] = 27 + points[other].astype(np.int64) * 2654435761 % (1 << 32) % (SYMBOLS - 27)
    return out


def _trigrams(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SYMBOLS**3, np.int64)
    for part in parts:
        for _, texts in batches(part.column(0)):
            joined = b"\n".join(texts).decode("utf-8", "replace").lower()
            points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
            s = np.concatenate([[0, 0], symbols(points), [0]])
            s = s[np.concatenate([[True, True], (s[2:] > 0) | (s[1:-1] > 0)])]
            if len(s) > 2:
                counts += np.bincount(s[:-2] * SYMBOLS**2 + s[1:-1] * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["gram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Costs (negative log probabilities) of each symbol after two others, over all texts."""
    rows = docs.select(utf8(F.col("text")).alias("text")).mapInArrow(_trigrams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(SYMBOLS**3)
    for r in rows:
        counts[r["gram"]] = r["n"]
    counts = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pairs, ones = counts.sum(axis=0), counts.sum(axis=(0, 1))
    p1 = (ones + 1) / (ones.sum() + SYMBOLS)
    p2 = (pairs + 8 * p1) / (pairs.sum(axis=1, keepdims=True) + 8)
    p3 = (counts + 8 * p2) / (counts.sum(axis=2, keepdims=True) + 8)
    return -np.log(p3).astype(np.float32)


@lru_cache(maxsize=4096)
def _symbol(c: str) -> int:
    return int(symbols(np.array([ord(c)], np.uint32))[0])


def decode(token: str, costs: list[float], spaced: bool = False) -> str:
    """The likeliest word behind a lower-case token, and no letters if it is none; costs are the model's, flat.

    The characters of a spaced run may be several words, which are returned with spaces between them.
    """
    states: dict = {(0, 0, ""): (0.0, None)}  # two last symbols and the last character: cost, letters so far as links
    before = ""
    for c in token:
        ways = [(c, COST["keep"], _symbol(c))] if c.isalpha() else [("", DROP.get(c, DROP_OTHER), 0)]
        ways += [(x, COST["mask"] if c == "*" else COST["swap"], _symbol(x)) for x in STANDS_FOR.get(c, "")]
        if before == c:
            ways.append(("", COST["merge"], 0))
        before = c
        new: dict = {}
        for key, (cost, word) in states.items():
            starts = [(key[0], key[1], cost, word)]
            if spaced and key[1]:
                starts.append((0, 0, cost + costs[(key[0] * SYMBOLS + key[1]) * SYMBOLS], (word, " ")))
            for k, (a, b, so_far, letters) in enumerate(starts):
                for x, extra, s in ways:
                    if x:
                        own, total = (b, s, x), so_far + extra + costs[(a * SYMBOLS + b) * SYMBOLS + s]
                    elif k:
                        continue  # a word ends before a letter only
                    else:
                        own, total = key, so_far + extra
                    if own not in new or total < new[own][0]:
                        new[own] = (total, (letters, x) if x else letters)
        if len(new) > BEAM:
            new = dict(sorted(new.items(), key=lambda y: (y[1][0], y[0]))[:BEAM])
        states = new
    word = min((cost + costs[(a * SYMBOLS + b) * SYMBOLS], (a, b, last), i, word) for i, ((a, b, last), (cost, word)) in enumerate(states.items()))[3]
    out = []
    while word:
        word, x = word
        out.append(x)
    return "".join(reversed(out))


_TRIPLED = re.compile(r"(.)\1\1")
_EDGES = ".,;:!?\"'()[]{}-_/&%*#"


def restored(raw: str, costs: list[float]) -> tuple[str, ...]:
    """The words that a lower-case token may stand for: without the signs around it, and with those that may be letters.

    A run of single characters, with spaces between them, is read as one word and as several.
    """
    if " " in raw:
        run = raw.replace(" ", "")
        return tuple(dict.fromkeys([*restored(run, costs), *decode(run, costs, True).split()]))
    if raw.isalpha() and not _TRIPLED.search(raw):
        return (raw,)
    plain = raw.strip(_EDGES)
    own = [plain, raw] if any(c in STANDS_FOR for c in raw[: raw.find(plain)] + raw[raw.find(plain) + len(plain) :]) else [plain]
    words = []
    for x in own if plain else [raw]:
        if x.isalpha() and not _TRIPLED.search(x):
            words.append(x)
        elif any(c.isalpha() or c in STANDS_FOR for c in x):
            words.append(decode(x, costs))
    return tuple(dict.fromkeys(w for w in words if w))


def features(word: str) -> tuple[str, ...]:
    """The word, and its beginnings of four and five letters."""
    n = len(word)
    return (word,) if n < 5 else (word, "^" + word[:4]) if n < 6 else (word, "^" + word[:4], "^" + word[:5])


_DOUBLED = re.compile(r"(.)\1")


class Beginnings(dict):
    """Whether a token of these first four characters may stand for a word with a wanted feature.

    The channel keeps a letter or merges it with its repetitions, so four letters, none of them doubled, begin every
    word of the token and all its features.
    """

    def __init__(self, wanted):
        super().__init__()
        self.wanted = {f.removeprefix("^")[:4] for f in wanted}

    def __missing__(self, begin: str) -> bool:
        fixed = len(begin) == 4 and begin.isalpha() and not _DOUBLED.search(begin)
        self[begin] = may = not fixed or begin in self.wanted
        return may


class Restorer:
    """Restored words of texts, as far as one of their features is wanted (all, if nothing is said), or these features.

    What a token stands for is kept, up to a bound; it is all that a text's other tokens cost. Tokens whose beginning
    rules out every wanted feature are not looked up.
    """

    def __init__(self, costs: np.ndarray, wanted=None, as_features: bool = False):
        self.costs, self.wanted, self.as_features = costs.ravel().tolist(), wanted, as_features
        self.begins = None if wanted is None else Beginnings(wanted)
        self.known: dict[str, tuple[str, ...]] = {}

    def learn(self, raws) -> None:
        wanted = self.wanted
        for raw in raws:
            words = restored(raw, self.costs)
            if self.as_features:
                words = tuple(f for w in words for f in features(w) if wanted is None or f in wanted)
            elif wanted is not None and words:
                words = tuple(w for w in words if not wanted.isdisjoint(features(w)))
            self.known[raw] = words

    def spaced(self, tokens: list[str]) -> list[tuple[int, int, str]]:
        """(first, end, characters with spaces between) of three or more single characters in a row."""
        if list(map(len, tokens)).count(1) < 3:
            return []
        at = [i for i, t in enumerate(tokens) if len(t) == 1]
        runs, a = [], 0
        while a < len(at):
            b = a
            while b + 1 < len(at) and at[b + 1] == at[b] + 1:
                b += 1
            if b - a >= 2:
                runs.append((at[a], at[b] + 1, " ".join(tokens[at[a] : at[b] + 1])))
            a = b + 1
        return runs

    def words(self, tokens: list[str]) -> set[str]:
        own = {*tokens, *(run for _, _, run in self.spaced(tokens))}
        if self.begins is not None:
            begins = self.begins
            if len(begins) >= CACHED_TOKENS:
                begins.clear()
            own = {t for t in own if begins[t[:4]]}
        if len(self.known) >= CACHED_TOKENS:
            self.known.clear()
        self.learn(own.difference(self.known))
        return set().union(*map(self.known.__getitem__, own))


def tokens_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _counted(costs: np.ndarray, wanted: frozenset | None):
    """(feature, toxic, fold, texts) of distinct texts (text, toxic, fold, rows), summed over many of a task's texts.

    Each of the equal rows of a text counts as its share.
    """

    def summed(counts: dict) -> Iterator[pa.RecordBatch]:
        for (toxic, fold, rows), own in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(own), pa.string()), pa.array([toxic] * len(own), pa.int32()),
                 pa.array([fold] * len(own), pa.int32()), pa.array(np.array(list(own.values()), float) / rows)],
                names=["feature", "toxic", "fold", "n"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(costs, wanted, as_features=True)
        counts: dict = {}
        for part in parts:
            for text, toxic, fold, rows in zip(*(part.column(c).to_pylist() for c in ("text", "toxic", "fold", "rows"))):
                counts.setdefault((toxic, fold, rows), Counter()).update(restorer.words(tokens_of(text)))
            if sum(map(len, counts.values())) >= COUNTED:
                yield from summed(counts)
                counts = {}
        yield from summed(counts)

    return run


def _contexts(costs: np.ndarray, wanted: frozenset):
    """(feature, toxic, fold, context) of the wanted features in training texts."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(costs, wanted)
        for part in parts:
            rows = set()
            for text, toxic, fold in zip(*(part.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                tokens = tokens_of(text)
                if not restorer.words(tokens):
                    continue
                runs = restorer.spaced(tokens)
                telling = {t: {f for w in found for f in features(w) if f in wanted}
                           for t in {*tokens, *(t for _, _, t in runs)} if (found := restorer.known.get(t))}
                for i, j, t in [*((i, i + 1, t) for i, t in enumerate(tokens) if t in telling), *runs]:
                    if t in telling:
                        around = zlib.crc32(" ".join([*tokens[max(0, i - 1) : i], "|", *tokens[j : j + 1]]).encode())
                        rows.update((f, toxic, fold, around) for f in telling[t])
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["feature", "toxic", "fold", "context"])

    return run


def evidence(words: set[str], weights: dict[str, float]) -> tuple[float, float]:
    """The weight of the most telling word, and the sum of the others; a word counts by its strongest feature."""
    own = [max(weights.get(f, 0.0) for f in features(w)) for w in words]
    most = max(own, default=0.0)
    return most, min(sum(own) - most, 4 * most)


def _evidence(costs: np.ndarray, weights: list[dict[str, float]]):
    """(toxic, rows, most, more) in bins, of distinct texts, each under the weights of the other fold."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(costs, weights[0].keys() | weights[1].keys())
        for part in parts:
            found = [evidence(restorer.words(tokens_of(t)), weights[f])
                     for t, f in zip(part.column("text").to_pylist(), part.column("fold").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic"), part.column("rows"), *(pa.array([round(x[i] / STEP) for x in found], pa.int32()) for i in (0, 1))],
                names=["toxic", "rows", "most", "more"])

    return run


def calibrated(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Intercept and slopes of a logistic regression of y on the columns of x with counts n, slightly shrunk."""
    design = np.column_stack([np.ones(len(x)), x])
    beta, penalty = np.zeros(design.shape[1]), np.full(design.shape[1], 0.1)
    penalty[0] = 1e-3
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (n * (y - p)) - penalty * beta
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
    return beta


class ToxicityModel:
    def __init__(self, costs: np.ndarray, intercept: float, slopes: tuple[float, float], weights: dict[str, float]):
        self.costs, self.intercept, self.slopes, self.weights = costs, intercept, slopes, weights

    def log_odds(self, words: set[str]) -> float:
        most, more = evidence(words, self.weights)
        return self.intercept + self.slopes[0] * most + self.slopes[1] * more


def fit(docs: DataFrame, labels: DataFrame, labelled) -> ToxicityModel:
    """Fits on the rows of docs where `labelled` holds and labels (doc_id, toxic) has a label.

    Weights are fitted on all of them, and on each of two folds for the other, so that the evidence that calibrates
    the score comes from texts that did not choose the lexicon.
    """
    costs = character_model(docs)
    marks = settled(labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")), "labels")
    side = F.broadcast(marks) if marks.count() <= BROADCAST_ROWS else marks
    texts = docs.where(labelled & (F.length("text") > 0)).select("doc_id", "text", F.xxhash64("text").alias("hash"))
    fold = F.pmod("hash", F.lit(2)).cast("int").alias("fold")
    # of the documents with the same text and label, one stands for all; its own rows may repeat
    copies = texts.select("doc_id", "hash").join(side, "doc_id").groupBy("hash", "toxic", "doc_id").agg(F.count("*").alias("rows"))
    firsts = settled(copies.groupBy("hash", "toxic").agg(
        F.min(F.struct("doc_id", "rows")).alias("x"), F.sum("rows").alias("all")).select("hash", "toxic", "x.*", "all"), "texts")
    distinct = texts.join(bounded(firsts.drop("all")), ["doc_id", "hash"]).select("text", "toxic", fold, "rows")
    n, unique = np.zeros((2, 2)), np.zeros((2, 2))  # rows and distinct texts by toxic, fold
    for r in firsts.groupBy("toxic", fold).agg(F.sum("all").alias("n"), F.count("*").alias("u")).collect():
        n[r["toxic"], r["fold"]], unique[r["toxic"], r["fold"]] = r["n"], r["u"]
    if not n.sum():
        return ToxicityModel(costs, -10.0, (0.0, 0.0), {})
    prior = math.log((n[1].sum() + 0.5) / (n[0].sum() + 0.5))
    if not n.all():
        return ToxicityModel(costs, prior, (0.0, 0.0), {})
    totals = {"all": unique.sum(axis=1), 0: unique[:, 1], 1: unique[:, 0]}  # what the weights for a fold are fitted on
    # a telling feature is frequent in toxic texts; only such are counted in the many others
    kinds = "feature string, toxic int, fold int, n double"
    whole = lambda f: F.round(F.sum(F.when(F.col("fold") == f, F.col("n")).otherwise(0.0))).cast("long")
    often = settled(
        distinct.where("toxic = 1").mapInArrow(_counted(costs, None), kinds).groupBy("feature").agg(
            *(whole(f).alias(f"n1{f}") for f in (0, 1)))
        .where(F.greatest("n10", "n11") >= LEAST_DOCS), "often")
    few = often.count() <= FREQUENT
    candidates = frozenset(r["feature"] for r in often.select("feature").collect()) if few else None
    clean_counts = distinct.where("toxic = 0").mapInArrow(_counted(costs, candidates), kinds).groupBy("feature").agg(
        *(whole(f).alias(f"n0{f}") for f in (0, 1)))
    counts = settled(often.join(clean_counts, "feature", "left").fillna(0), "features")
    chosen = {}
    for part, of in (("all", ("0", "1")), (0, ("1",)), (1, ("0",))):
        clean, toxic = totals[part]
        a, c = (sum((F.col(f"n{t}{f}") for f in of), F.lit(0)) for t in (1, 0))
        share = (a + c) / (clean + toxic)
        z = (a / toxic - c / clean) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / toxic + 1 / clean))
        odds = ((a + 0.5) / (toxic + 1)) / ((c + 1.0) / (clean + 1))
        telling = counts.where((a >= LEAST_DOCS) & (z >= LEAST_Z) & (odds >= LEAST_ODDS))
        chosen[part] = {r["feature"] for r in telling.select("feature").collect()}
    wanted = frozenset().union(*chosen.values())
    seen = distinct.mapInArrow(_contexts(costs, wanted), "feature string, toxic int, fold int, context long").distinct()
    rows = seen.groupBy("feature", "toxic", "fold").agg(F.count("*").alias("n")).collect()
    weights: dict = {part: {} for part in totals}
    for part in totals:
        own: dict = {}
        for r in rows:
            if r["feature"] in chosen[part] and part in ("all", 1 - r["fold"]):
                own.setdefault(r["feature"], [0, 0])[r["toxic"]] += r["n"]
        for f, (c, a) in own.items():
            weight = math.log((a + 0.5) / (totals[part][1] + 1)) - math.log((c + 1.0) / (totals[part][0] + 1))
            if a >= LEAST_CONTEXTS and weight >= LEAST_WEIGHT:
                weights[part][f] = weight
    bins = distinct.mapInArrow(_evidence(costs, [weights[0], weights[1]]), "toxic int, rows long, most int, more int").groupBy(
        "toxic", "most", "more").agg(F.sum(1 / F.col("rows")).alias("n")).collect()
    most, more, y, k = (np.array([r[c] for r in bins], float) for c in ("most", "more", "toxic", "n"))
    beta = calibrated(np.stack([most, more], axis=1) * STEP, y, k)
    return ToxicityModel(costs, float(beta[0]), (max(float(beta[1]), 0.0), max(float(beta[2]), 0.0)), weights["all"])


def _scored(model: ToxicityModel):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.costs, model.weights.keys())
        for part in parts:
            odds = [model.log_odds(restorer.words(tokens_of(t))) for t in part.column("text").to_pylist()]
            score = 1 / (1 + np.exp(-np.clip(np.array(odds, float), -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, labelled=None) -> DataFrame:
    """(doc_id, score, predicted) for each row of docs (doc_id, text).

    labels (doc_id, toxic) are learned from where `labelled` holds (everywhere, if none is given); a document with
    several labels counts as toxic if one says so, and other values are no labels. Null and empty texts hold no evidence;
    without labels every score is near 0, and with one label only it is that label's share. The character model is counted over all texts. Repeated rows get equal scores.
    """
    small_batches(docs.sparkSession)
    model = fit(docs, labels, F.lit(True) if labelled is None else labelled)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(_scored(model), f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
