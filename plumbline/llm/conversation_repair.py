"""Conversations brought into the form system?, (user, assistant)+ at the least cost, by scalar big-integer weights.

The weight of a way to edit a conversation is one integer: its high digits are the cost, its low digits, of fixed width,
are the letters of the edits from the first on, with zeros after the last. The least integer over the paths of a graph
of (row, state of the form) is then the cheapest repair and, among equally cheap ones, the one whose letters come first.
Going back one row moves the letters one digit down, which loses a zero.

A conversation of any length is cut into pieces of rows that follow one another in a global sort. Pieces are reduced to
the costs between states; these give what the rest of a conversation costs after each piece, which is all that a piece
has to know to find its letters for each state it may start in. Inserted rows belong to the piece of the row after
them, so the letters of a piece end with a row and no piece's letters begin another choice of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, small_batches

PIECE = 1024  # rows
LETTERS = " DIKR"  # digits of the edits in order of ASCII; zero is the padding
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
BITS = 3  # of a digit
INSERT_COST, REROLE_COST, DELETE_COST, TRUNCATED_COST = 2, 2, 3, 1
FAR = 1 << 60

LONGS, NAMES = T.ArrayType(T.LongType()), T.ArrayType(T.StringType())
BEST = T.StructType([T.StructField("letters", NAMES), T.StructField("states", LONGS)])
AUDIT = T.StructType([T.StructField("audit", T.StringType()), T.StructField("cost", T.LongType())])

# States: nothing yet, after system, after user, after assistant.
STATES = range(4)
NEXT_ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}  # whom an inserted or renamed row is from
AFTER = {"user": 2, "assistant": 3}
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LAST_INSERTS = (0, 2, 1, 0)  # rows to add after the last one

VISIBLE = r"[^\x20\x09-\x0D]"


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with seeded faults: some dropped, emptied, without their ends, repeated, renamed.

    Null roles and texts become one space; null ids and turns count as one space in the seed only.
    """
    blank = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(named.cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _row_edits(symbol: str, state: int):
    """(cost, letter, next state) of what may be done with a row; x must go, capitals are truncated."""
    yield DELETE_COST, DELETE, state
    if symbol != "x":
        more = TRUNCATED_COST if symbol.isupper() else 0
        if (state, symbol.lower()) in KEPT:
            yield more, KEEP, KEPT[state, symbol.lower()]
        yield REROLE_COST + more, REROLE, AFTER[NEXT_ROLE[state]]


EDITS = {s: [list(_row_edits(s, q)) for q in STATES] for s in "xsuaoSUAO"}
INSERTED = [AFTER[NEXT_ROLE[q]] for q in STATES]


def piece_letters(symbols: str, rest: list[int]) -> tuple[list[str], list[int]]:
    """For each state before the rows, the letters of their best edits and the state after them, if `rest` is what follows costs."""
    width = BITS * 3 * len(symbols)  # at most two rows are inserted before each
    low = (1 << width) - 1
    top = width - BITS

    def put(cost: int, letter: int, value: int) -> int:
        return ((cost + (value >> width)) << width) + (letter << top) + ((value & low) >> BITS)

    after = [c << width for c in rest]
    for symbol in reversed(symbols):
        best = [min(put(c, letter, after[q]) for c, letter, q in EDITS[symbol][s]) for s in STATES]
        after = best
        for _ in range(2):
            after = [min(best[s], put(INSERT_COST, INSERT, after[INSERTED[s]])) for s in STATES]
    letters, states = [], []
    for state in STATES:
        own, at, digits = [], 0, after[state] & low
        while at < len(symbols):
            letter = digits >> top
            digits = (digits << BITS) & low
            own.append(LETTERS[letter])
            if letter == INSERT:
                state = INSERTED[state]
            else:
                state = next(q for _, x, q in EDITS[symbols[at]][state] if x == letter)
                at += 1
        letters.append("".join(own))
        states.append(state)
    return letters, states


def piece_costs(symbols: str) -> list[int]:
    """Least cost from each state before the rows to each state after them, row by row of the table."""
    out = []
    for start in STATES:
        now = [0 if q == start else FAR for q in STATES]
        for symbol in symbols:
            for _ in range(2):
                for q in STATES:
                    now[INSERTED[q]] = min(now[INSERTED[q]], now[q] + INSERT_COST)
            then = [FAR] * 4
            for q in STATES:
                for c, _, to in EDITS[symbol][q]:
                    then[to] = min(then[to], now[q] + c)
            now = then
        out += now
    return out


@F.udf(LONGS)
def _costs(symbols):
    return piece_costs(symbols)


@F.udf(T.ArrayType(LONGS))
def _rests(costs):
    """What all that follows each piece costs, by the state after the piece."""
    rest = [INSERT_COST * n for n in LAST_INSERTS]
    out = []
    for own in reversed(costs):
        out.append(rest)
        rest = [min(own[4 * s + q] + rest[q] for q in STATES) for s in STATES]
    return out[::-1]


@F.udf(BEST)
def _letters(symbols, rest):
    return piece_letters(symbols, rest)


@F.udf(AUDIT)
def _audit(pieces, cost):
    state, out = 0, []
    for p in pieces:
        out.append(p["letters"][state])
        state = p["states"][state]
    return "".join(out) + LETTERS[INSERT] * LAST_INSERTS[state], cost


def _same(a: DataFrame, b: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Joins on keys that may be null."""
    named = b.select(*(F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in b.columns))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return a.join(named, on, how).drop(*(f"_{k}" for k in keys))


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("o")


def _plain(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation in rows (conv_id, turn, role, text).

    Rows are taken by turn, nulls first, then role and text. A row is blank, else the duplicate of an earlier one, else
    truncated. A role whose initial is not s, u or a fits nowhere. Null ids are one conversation.
    """
    scratch = Scratch(rows.sparkSession, "repair")
    small_batches(rows.sparkSession)
    order = ["conv_id", "turn", "role", "text", "salt"]
    last = F.regexp_extract("text", rf"({VISIBLE})[\x20\x09-\x0D]*\z", 1)
    # copies of a row are spread by a number of their own
    light = scratch.put(
        _plain(rows).withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv_id", "turn", _initial(F.col("role")).alias("initial"), last.alias("last"),
            F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")).alias("key"),
            F.monotonically_increasing_id().alias("place")), "light")
    again = scratch.put(light.groupBy("conv_id", "key").agg(F.min("place").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"), "again")
    fault = F.when(F.col("last") == "", "blank").when(F.col("place") > F.col("first"), "duplicate").when(
        ~F.col("last").isin(".", "!", "?"), "truncated").otherwise("")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    coded = _same(light, again, ["conv_id", "key"]).withColumn("fault", fault).withColumn("symbol", symbol)
    # a piece is some of the rows that follow one another in one part of the sort
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    block = part * F.lit(1 << 33) + F.floor(within / PIECE)
    listed = F.array_sort(F.collect_list(F.struct("place", "symbol", "initial")))
    text = lambda c: F.array_join(F.transform("listed", lambda x: x[c]), "")
    pieces = scratch.put(
        coded.groupBy("conv_id", block.alias("piece")).agg(
            listed.alias("listed"), *(F.sum((F.col("fault") == f).cast("long")).alias(f) for f in ("blank", "duplicate", "truncated"))
        ).select("conv_id", "piece", text("symbol").alias("symbols"), text("initial").alias("initials"), "blank", "duplicate", "truncated"), "pieces")
    by_piece = F.array_sort(F.collect_list(F.struct("piece", "costs")))
    rests = pieces.select("conv_id", "piece", _costs("symbols").alias("costs")).groupBy("conv_id").agg(by_piece.alias("own")).select(
        "conv_id", F.arrays_zip(F.col("own.piece").alias("piece"), _rests(F.col("own.costs")).alias("rest")).alias("own"),
    ).select("conv_id", F.explode("own").alias("own")).select("conv_id", F.col("own.piece").alias("piece"), F.col("own.rest").alias("rest"))
    rests = scratch.put(rests, "rests")
    done = _same(pieces, rests, ["conv_id", "piece"]).withColumn("best", _letters("symbols", "rest"))
    illegal = lambda s: F.length(s) - 1 - sum(_pairs(s, x) for x in ("su", "ua", "au"))
    ends = F.concat(F.substring("initials", 1, 1), F.substring("initials", -1, 1))
    between = F.array_join(F.transform("own", lambda x: x["ends"]), "")
    # every second pair of the joined ends lies between two pieces
    seams = F.expr("aggregate(sequence(1, size(own)), 0L, (n, i) -> n + if(i < size(own) and substring(between, 2 * i, 2) not in ('su', 'ua', 'au'), 1, 0))")
    folded = done.select("conv_id", "piece", "best", "rest", ends.alias("ends"), illegal("initials").alias("inside"), "blank", "duplicate", "truncated",
                         _costs("symbols").alias("costs")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("piece", "best", "ends", "costs", "rest"))).alias("own"),
        *(F.sum(c).alias(c) for c in ("inside", "blank", "duplicate", "truncated")))
    first = F.col("own")[0]
    cost = F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: first["costs"][q] + first["rest"][q]))
    folded = folded.withColumn("between", between).withColumn("illegal", F.col("inside") + seams).withColumn(
        "found", _audit(F.transform("own", lambda x: x["best"]), cost))
    turns = light.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    return _same(folded.select("conv_id", "blank", "duplicate", "truncated", "illegal", F.col("found.cost").alias("cost"),
                               F.col("found.audit").alias("audit")), turns, ["conv_id"]).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _pairs(text, pair: str) -> Column:
    """How often two given letters, which differ, follow one another."""
    text = F.col(text)
    return ((F.length(text) - F.length(F.replace(text, F.lit(pair), F.lit("")))) / 2).cast("long")


def replayed(state: int, letters: Iterator[str], rows: Iterator[tuple[str, str]]) -> Iterator[tuple[bool, str, str]]:
    """(is it a given row, role, text) of the conversation after its edits."""
    for letter in letters:
        if letter == "I":
            role, text, given = NEXT_ROLE[state], "", False
        else:
            role, text = next(rows)
            given = True
            if letter == "D":
                continue
            role = NEXT_ROLE[state] if letter == "R" else role
        state = AFTER[NEXT_ROLE[state]] if letter in "IR" else KEPT[state, role[:1]]
        yield given, role, text


def _stream(emit):
    """Follows sorted rows: a row of kind 0 with the letters of a conversation, then its rows of kind 1."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for part in parts for r in zip(*(part.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text"))))
        yield from emit(rows)

    return run


def _conversations(rows):
    """(conv_id, letters, rows of it) one after another; the rows have to be read before the next conversation."""
    head = next(rows, None)
    while head is not None:
        following = []

        def own(following=following):
            for r in rows:
                if r[1] == 0:
                    following.append(r)
                    return
                yield r

        left = own()
        yield head[0], head[4], left
        for _ in left:
            pass
        head = following[0] if following else None


def _digests(rows):
    ids, hashes = [], []
    for conv, letters, own in _conversations(rows):
        hasher, joint = hashlib.sha256(), b""
        for _, role, text in replayed(0, iter(letters), ((r[3], r[4]) for r in own)):
            hasher.update(joint + f"{role}:{text}".encode())
            joint = b"\n"
        ids.append(conv)
        hashes.append(hasher.hexdigest())
        if len(ids) == 1000:
            yield _batch(["conv_id", "repaired_sha256"], [ids, hashes], [pa.int64(), pa.string()])
            ids, hashes = [], []
    yield _batch(["conv_id", "repaired_sha256"], [ids, hashes], [pa.int64(), pa.string()])


def _batch(names, columns, types):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


REPAIRED = ["conv_id", "position", "turn", "role", "text"]


def _repaired(rows):
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    out = []
    for conv, letters, own in _conversations(rows):
        turns = []

        def noted(own=own, turns=turns):
            for r in own:
                turns[:] = [r[2]]
                yield r[3], r[4]

        for i, (given, role, text) in enumerate(replayed(0, iter(letters), noted())):
            out.append((conv, i, turns[0] if given else None, role, text))
            if len(out) == 1000:
                yield _batch(REPAIRED, zip(*out), types)
                out = []
    if out:
        yield _batch(REPAIRED, zip(*out), types)


def _in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of each conversation after its letters; texts stream through, they are not gathered."""
    none = F.lit(None)
    heads = found.select("conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"), F.col("audit").alias("text"))
    each = _plain(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text")
    return heads.union(each).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, position, turn, role, text) of rows after the edits in found (conv_id, audit); inserted rows have no turn."""
    return _in_order(rows, found).mapInArrow(_stream(_repaired), "conv_id long, position long, turn long, role string, text string")


def repair_digests(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of conversations: what is wrong in its rows, how they are repaired, and a digest of the result.

    Conversations without rows have zeros, no edits and the digest of nothing. A digest reads a conversation in one
    stream, as SHA-256 has to; nothing else gathers one.
    """
    scratch = Scratch(rows.sparkSession, "digests")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    found = scratch.put(_same(conversations.select("conv_id").distinct(), audits(rows), ["conv_id"]).select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit")), "found")
    hashes = _in_order(rows, found).mapInArrow(_stream(_digests), "conv_id long, repaired_sha256 string")
    return _same(found, hashes, ["conv_id"])
