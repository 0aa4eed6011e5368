"""License scans by diagonal voting.

All rolling word k-grams of all texts meet the k-grams of the templates in a join. A match of word i of a text with word
j of a template votes for the diagonal i - j; a template that occurs as it is puts all its votes on one diagonal, and
words put in or left out move the rest to a neighbouring one. Diagonals that are close, and whose votes are close in the
text, are merged to a span, and a span is verified on its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, LETTERS, batches, long_lists, sequence_hashes, settled, small_batches, utf8, words_of

K = 3
NEAR = 4  # diagonals apart that still belong to one span
GAP = 12  # words of the text between votes of one span
VOTES = 0.5  # share of a template's k-grams that a span must hold to be verified
VERIFIED = 0.7  # share of a template's words that the span's words must hold, in order

# words that label a text wherever they stand together (fixed values)
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}
# further labels of this scan: opening or telling words of licences
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
    "with the license you may obtain a copy of the license at",
    "gpl-3": "licensed under the gnu general public license version 3",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "all-rights-reserved": "all rights reserved",
    "unlicense": "this is free and unencumbered software released into the public domain",
}


def template_grams(spark, templates: list[tuple[int, str]], k: int) -> DataFrame:
    """(hash, template, place) of each k-gram of the templates: as many rows as the templates have words."""
    rows = []
    for i, text in templates:
        _, _, _, words, _ = words_of([text.encode()], LETTERS)
        rows += [(int(h), i, j) for j, h in enumerate(sequence_hashes(words, k).view(np.int64))]
    return spark.createDataFrame(rows, "hash long, template int, place int")


def _grams(k: int):
    """Each text's number and the hashes of its rolling k-grams, from its first word on."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start, texts in batches(part.column("text")):
                _, _, _, words, first = words_of(texts, LETTERS)
                runs = sequence_hashes(words, k)
                own = [runs[a : max(a, b - k + 1)] for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays([part.column("key").slice(start, len(texts)), long_lists(own)],
                                                 names=["key", "hashes"])

    return run


def votes(texts: DataFrame, grams: DataFrame, k: int) -> DataFrame:
    """(key, template, diagonal, n, low, high): votes of each diagonal and the words between which they were cast."""
    hashes = texts.mapInArrow(_grams(k), "key binary, hashes array<long>")
    cast = hashes.select("key", F.posexplode("hashes").alias("word", "hash")).join(F.broadcast(grams), "hash")
    # copies of a text cast the same votes, which count once
    own = cast.select("key", "template", (F.col("word") - F.col("place")).alias("diagonal"), "word").distinct()
    return own.groupBy("key", "template", "diagonal").agg(
        F.count("*").alias("n"), F.min("word").alias("low"), F.max("word").alias("high"))


def spans(diagonals: DataFrame) -> DataFrame:
    """(key, template, low, high, n): diagonals merged with neighbours that are near in the template and the text.

    Stretches of text without a gap come first. In each, diagonals follow one another in the order of their offset, so
    that a stray one, of words that the template repeats, does not stand between two neighbours. A text's diagonals of
    one template are as many as its matches, and a text fits into a task.
    """
    order = W.partitionBy("key", "template").orderBy("low", "diagonal")
    apart = F.col("low") > F.max("high").over(order.rowsBetween(W.unboundedPreceding, -1)) + GAP
    placed = diagonals.withColumn("stretch", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order))
    near = W.partitionBy("key", "template", "stretch").orderBy("diagonal")
    fresh = F.col("diagonal") - F.lag("diagonal").over(near) > NEAR
    marked = placed.withColumn("span", F.sum(F.coalesce(fresh, F.lit(True)).cast("int")).over(near))
    return marked.groupBy("key", "template", "stretch", "span").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))


def covered(own: list[bytes], template: list[bytes]) -> float:
    """Share of the template's words that occur in order among the span's."""
    blocks = SequenceMatcher(None, own, template, autojunk=False).get_matching_blocks()
    return sum(b.size for b in blocks) / max(len(template), 1)


def _verified(k: int, templates: list[tuple[str, list[bytes], bool]]):
    """Checks spans on the words of their text; one row per text with the results of all of them."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            marks = part.column("marks").to_pylist()
            for start, texts in batches(part.column("text")):
                data, starts, ends, _, first = words_of(texts, LETTERS)
                for i in range(len(texts)):
                    n, base, labels, base_labels, score = int(first[i + 1] - first[i]), [], set(), set(), 0.0
                    word = lambda j, at=first[i]: data[starts[at + j] : ends[at + j]].tobytes()
                    for m in marks[start + i] or ():
                        label, wanted, exact = templates[m["template"]]
                        if exact:
                            if m["low"] + len(wanted) <= n and [word(m["low"] + j) for j in range(len(wanted))] == wanted:
                                base.append(m["low"])
                                base_labels.add(label)
                                score = 1.0
                        else:
                            a, b = max(0, m["low"] - NEAR), min(n, m["high"] + k + NEAR)
                            share = covered([word(j) for j in range(a, b)], wanted)
                            if share >= VERIFIED:
                                labels.add(label)
                                score = max(score, share)
                    out.append((n, len(base), min(base, default=None), max(base, default=None),
                                ",".join(sorted(base_labels)), ",".join(sorted(labels | base_labels)), min(score, 1.0)))
            columns = list(zip(*out)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of docs (doc_id, text).

    n_base counts the places where a phrase's words stand consecutively, and first_word and last_word are the least and
    greatest of them, null if there are none. labels adds those of templates found by voting; score is 1 with a phrase,
    else the greatest share of a verified template, else 0. Null and empty texts have no words and no labels.
    Repeated rows get equal results. An empty table gives no rows. Phrases have at least k words.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = [(label, t.encode().split(), True) for label, t in sorted(phrases.items())]
    known += [(label, t.encode().split(), False) for label, t in sorted(templates.items())]
    grams = template_grams(spark, [(i, b" ".join(w).decode()) for i, (_, w, _) in enumerate(known)], K)
    binary = utf8(F.col("text"))
    texts = docs.select("doc_id", F.unhex(F.md5(binary)).alias("key"), binary.alias("text"))
    found = settled(votes(texts, grams, K), "diagonals")
    exact = [i for i, (_, w, e) in enumerate(known) if e]
    sizes = F.array(*(F.lit(max(1, len(w) - K + 1)) for _, w, _ in known))
    size = F.element_at(sizes, F.col("template") + 1)
    whole = found.where(F.col("template").isin(exact) & (F.col("n") == size)).select(
        "key", F.struct("template", F.col("diagonal").alias("low"), F.col("high")).alias("mark"))
    merged = spans(found.where(~F.col("template").isin(exact))).where(F.col("n") >= F.ceil(size * VOTES)).select(
        "key", F.struct("template", "low", "high").alias("mark"))
    marks = settled(whole.union(merged).groupBy("key").agg(F.collect_set("mark").alias("marks")), "marks")
    found = marks.agg(F.count("*"), F.coalesce(F.sum(F.size("marks")), F.lit(0))).first()
    side = F.broadcast(marks) if sum(found) <= BROADCAST_ROWS // 4 else marks
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.join(side, "key", "left").select("doc_id", "text", "marks").mapInArrow(
        _verified(K, known), f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double")
