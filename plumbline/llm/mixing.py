"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks, in DataFrame functions only.

Targets are weights scaled until no source exceeds its limit. The blocks of the mix go to sources by highest quotients
target / (2 k - 1), a source's blocks go to its shards the same way by shard size, and inside a shard seeded draws say
which blocks are taken, and which twice. A shard holds a bounded number of words, so a source of any size is split, and
quotients near the cut are the only ones listed: all seats above a divisor that gives too few are known at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import settled

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words, for the mix
REPEATS = 2  # times a document may be used
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 18
WORDS = r"[^\x20\x09-\x0D]+"


def draw(seed: str, kind: str, *columns: str) -> Column:
    """A seeded order of rows that any engine can compute; nulls are left out."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.lit(kind), *(F.col(c).cast("string") for c in columns)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) of sizes (source, size): share * all, split by weight, none above repeats * own.

    Sources by code point, null last, take the weights in turn. A source is at its limit when its limit per weight is
    below the level at which the rest share what remains, which is settled by one pass in the order of that ratio.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    kinds = F.array(*(F.lit(float(w)) for w in weights))
    ranked = totals.withColumn("weight", F.element_at(kinds, (turn % len(weights) + 1).cast("int"))).withColumn(
        "limit", F.col("source_size") * float(repeats))
    order = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    capped = ranked.withColumns({
        "spent": F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
        "gone": F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        "budget": F.least(F.sum("source_size").over(whole) * share, F.sum("limit").over(whole)),
        "all_weight": F.sum("weight").over(whole),
    })
    level = F.col("budget") - F.col("spent")
    level = level / (F.col("all_weight") - F.col("gone"))  # if this source and all after it share the rest
    free = capped.withColumn("level", F.when(F.col("limit") > level * F.col("weight"), level))
    final = F.first("level", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return free.withColumn("final", final).select(
        "source", "source_size", F.least("limit", F.coalesce(F.col("final") * F.col("weight"), F.col("limit"))).alias("target"))


def apportion(votes: DataFrame, group: list[str], key: str, vote: str, seats: str) -> DataFrame:
    """Adds `quota`: Sainte-Lague shares of `seats` (one number per group) by `vote`, ties to the smaller key.

    With n rows, rounding vote / d with d = V / (seats - n / 2) gives seats that are surely won, and the divisor for
    seats + n / 2 bounds what can be won, so at most 2 n quotients of a group are ranked.
    """
    per = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    bounds = votes.withColumns({"__n": F.count("*").over(per), "__v": F.sum(vote).over(per).cast("double")})
    share = F.when(F.col("__v") > 0, F.col(vote) / F.col("__v")).otherwise(0.0)
    sure = F.floor(F.greatest(F.col(seats) - F.col("__n") / 2 - 1, F.lit(0.0)) * share + 0.499999)
    most = F.floor((F.col(seats) + F.col("__n") / 2 + 1) * share + 0.500001)
    bounds = bounds.withColumns({"__sure": sure.cast("long"), "__most": most.cast("long")}).withColumn(
        "__left", F.col(seats) - F.sum("__sure").over(per))
    tried = bounds.where("__most > __sure").select(
        *group, key, F.col(vote).alias("__vote"), "__left",
        F.explode(F.sequence(F.col("__sure") + 1, F.col("__most"))).alias("__k"))
    best = (W.partitionBy(*group) if group else W.partitionBy(F.lit(0))).orderBy(
        (F.col("__vote") / (2 * F.col("__k") - 1)).desc(), F.col(key).asc_nulls_last(), "__k")
    won = tried.withColumn("__r", F.row_number().over(best)).where("__r <= __left").groupBy(*group, key).agg(
        F.count("*").alias("__won"))
    mine = won.select(*(F.col(c).alias(f"__{c}") for c in (*group, key)), "__won")
    return bounds.join(mine, same(*((c, f"__{c}") for c in (*group, key))), "left").select(
        *votes.columns, (F.col("__sure") + F.coalesce("__won", F.lit(0))).alias("quota"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words of each text; null has none."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"))


def same(*pairs: tuple[str, str]) -> Column:
    """Equality of columns where nulls are equal."""
    out = F.lit(True)
    for a, b in pairs:
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def placed_documents(sizes: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """Documents that have words, in seeded order on the word streams of their shards; `end` is where one ends."""
    shards = F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1))
    number = F.conv(F.substring(draw(seed, "shard", "doc_id", "size"), 1, 8), 16, 10).cast("long")
    known = targets.select(F.col("source").alias("__s"), "source_size")
    placed = sizes.where("size > 0").join(known, same(("source", "__s"))).select(
        "doc_id", "source", "size", F.pmod(number, shards).alias("shard"))
    stream = W.partitionBy("source", "shard").orderBy(draw(seed, "place", "doc_id"), "doc_id", "size")
    return placed.withColumn("end", F.sum("size").over(stream.rowsBetween(W.unboundedPreceding, 0)))


def block_takes(placed: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """(source, shard, block, times): how often each block of a shard is taken, if it is."""
    lengths = placed.groupBy("source", "shard").agg(F.max("end").alias("words"))
    blocks = targets.withColumn("mix", F.round(F.sum("target").over(W.partitionBy(F.lit(0))) / BLOCK_WORDS).cast("long"))
    shares = apportion(blocks, [], "source", "target", "mix").select(F.col("source").alias("__s"), F.col("quota").alias("seats"))
    of_shard = apportion(lengths.join(shares, same(("source", "__s"))).drop("__s"), ["source"], "shard", "words", "seats")
    many = F.ceil(F.col("words") / BLOCK_WORDS).cast("long")
    listed = of_shard.select(
        "source", "shard", many.alias("blocks"), F.least(F.col("quota"), REPEATS * many).alias("quota"),
        F.explode(F.sequence(F.lit(0).cast("long"), many - 1)).alias("block"))
    rank = F.row_number().over(W.partitionBy("source", "shard").orderBy(draw(seed, "block", "shard", "block"), "block"))
    taken = F.floor(F.col("quota") / F.col("blocks")) + (rank <= F.col("quota") % F.col("blocks")).cast("long")
    return listed.withColumn("times", taken).where("times > 0").select("source", "shard", "block", "times")


def taken_spans(placed: DataFrame, takes: DataFrame) -> DataFrame:
    """Of each placed document: words first to last (excluded) that a block takes, and how often."""
    begin = F.col("end") - F.col("size")
    cut = placed.select("doc_id", "source", "size", "shard", "end", F.explode(F.sequence(
        F.floor(begin / BLOCK_WORDS), F.floor((F.col("end") - 1) / BLOCK_WORDS))).alias("block"))
    named = takes.select(F.col("source").alias("__s"), F.col("shard").alias("__h"), F.col("block").alias("__b"), "times")
    return cut.join(named, same(("source", "__s")) & (F.col("shard") == F.col("__h")) & (F.col("block") == F.col("__b"))).select(
        "doc_id", "source", "size", "shard", "end",
        F.greatest(F.col("block") * BLOCK_WORDS - begin, F.lit(0)).alias("first"),
        F.least((F.col("block") + 1) * BLOCK_WORDS - begin, F.col("size")).alias("last"), "times")


def mixture(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of docs (doc_id, source, text).

    size counts words; a null or empty text has none and nothing is taken of it. taken counts the words of the
    document that the mix takes, at most twice each. A null source is a source of its own, the last. Repeated rows are
    rows of their own, and reruns agree up to the order of rows equal in id, source and size. An empty table gives no rows.
    """
    sizes = settled(sized(docs), "sizes")
    targets = settled(source_targets(sizes), "targets")
    placed = settled(placed_documents(sizes, targets, seed), "places")
    spans = taken_spans(placed, block_takes(placed, targets, seed))
    sums = spans.groupBy("source", "shard", "end").agg(F.sum((F.col("last") - F.col("first")) * F.col("times")).alias("taken"))
    sums = sums.select(F.col("source").alias("__s"), F.col("shard").alias("__h"), F.col("end").alias("__e"), "taken")
    with_words = placed.join(sums, same(("source", "__s"), ("shard", "__h"), ("end", "__e")), "left").select(
        "doc_id", "source", "size", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    rows = with_words.union(sizes.where("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken")))
    named = targets.select(F.col("source").alias("__s"), "source_size", "target")
    return rows.join(named, same(("source", "__s"))).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself, with the columns of docs: each document cut down to the words that are taken of it.

    A document whose words are partly taken twice comes as two rows. White space before a taken word stays, and
    n_chars, if there is such a column, is that of the new text. Rows equal in id, source and size are cut alike.
    """
    sizes = settled(sized(docs), "sizes")
    targets = settled(source_targets(sizes), "targets")
    placed = settled(placed_documents(sizes, targets, seed), "places")
    spans = taken_spans(placed, block_takes(placed, targets, seed))
    parts = spans.groupBy("doc_id", "source", "size", "shard", "end").agg(
        F.array_sort(F.collect_list(F.struct("first", "last", "times"))).alias("__parts"))
    one = parts.groupBy("doc_id", "source", "size").agg(F.min_by("__parts", "end").alias("__parts"))
    one = one.select(F.col("doc_id").alias("__d"), F.col("source").alias("__s"), F.col("size").alias("__n"), "__parts",
                     F.explode(F.sequence(F.lit(1), F.lit(REPEATS))).alias("__turn"))
    one = one.withColumn("__parts", F.expr("filter(__parts, x -> x.times >= __turn)")).where(F.size("__parts") > 0)
    asked = docs.withColumn("__size", F.regexp_count("text", F.lit(WORDS)).cast("long"))
    found = asked.join(one, same(("doc_id", "__d"), ("source", "__s")) & (F.col("__size") == F.col("__n")))
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORDS), F.lit(0))
    # the words are an argument of a function, and the one text a generated row: both are found once
    text = F.transform(F.array(words), lambda own: F.array_join(F.flatten(F.transform("__parts", lambda x: F.slice(
        own, (x["first"] + 1).cast("int"), (x["last"] - x["first"]).cast("int")))), ""))
    made = found.select(*(c for c in docs.columns if c != "text"), F.explode(text).alias("text"))
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return made.select(docs.columns)
