import gc
import tracemalloc
import weakref
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import components, license_scan, ngram_join, packing, suffix_dedup, warc

from . import cases


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    found = {r.node: r.component for r in components.connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


@pytest.mark.parametrize("k, percent, group", [(4, 85, 12), (5, 80, 2)])
def test_jaccard_classes_equal_brute_force(docs, rows, monkeypatch, k, percent, group):
    monkeypatch.setattr(ngram_join, "PAIR_GROUP", group)  # small: pivots and blocks; large: pairs
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 2000)
    want = cases.components([r for r in rows if r[0] is not None], k, percent)
    got = ngram_join.jaccard_classes(docs, k, percent).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert {(r.doc_id, r.n_shingles) for r in got} == {(i, len(cases.sets(t, k))) for i, t in rows}


def test_block_edges_connect_what_is_linked():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 60, 200, dtype=np.uint64))
    sets = [base]
    for _ in range(60):
        own = base.copy()
        at = rng.choice(len(own), rng.integers(1, 45), replace=False)
        own[at] = rng.integers(0, 1 << 60, len(at), dtype=np.uint64)
        sets.append(np.unique(own))
    ids = np.arange(len(sets))

    def roots(edges):
        parent = list(range(len(sets)))
        for a, b in edges * len(sets):
            parent[a] = parent[b] = min(parent[a], parent[b])
        return parent

    both = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    true = [(i, j) for i in ids for j in ids if i < j and 100 * both[i][j] >= 85 * (len(sets[i]) + len(sets[j]) - both[i][j])]
    found = ngram_join.block_edges(ids, np.zeros(len(ids), int), sets, 0, 85)
    assert roots(found) == roots(true) and len(found) < len(true)


def test_one_of_each_keeps_columns_and_heads(docs, rows, empty):
    kept = ngram_join.one_of_each(docs, 5, 80)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    want = cases.components([r for r in rows if r[0] is not None], 5, 80)
    assert sorted(i for i in ids if i is not None) == sorted(i for i, c in want.items() if i == c)
    assert ngram_join.one_of_each(empty, 5, 80).count() == 0


@pytest.mark.parametrize("hot", [5000, 1])
def test_remove_repeats_equals_brute_force(docs, rows, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_SNIPPETS", hot)
    got = suffix_dedup.remove_repeats(docs, 200).collect()
    want = cases.repeats_removed([t for _, t in rows], 200)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(
        (i, *w) for (i, _), w in zip(rows, want))


def test_suffix_order_is_sorted():
    rng = np.random.default_rng(1)
    for data in (rng.integers(97, 99, 400), np.full(300, 97), rng.integers(0, 255, 500), np.arange(200), np.arange(200)[::-1]):
        data = data.astype(np.uint8)
        text = data.tobytes()
        order = suffix_dedup.suffix_order(data, 64)
        assert sorted(order) == list(range(len(data)))
        plain = [text[i : i + 64] for i in order]
        assert plain == sorted(plain)


def test_without_repeats_keeps_rows_and_columns(docs, empty):
    cut = suffix_dedup.without_repeats(docs, 200)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert cut.where("n_chars <> length(text)").count() == 0
    assert suffix_dedup.without_repeats(empty, 200).count() == 0
    assert suffix_dedup.remove_repeats(empty, 200).count() == 0


def plain_scan(text):
    own = cases.words(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    places, labels = [], set()
    for label, phrase in license_scan.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(own) - len(p) + 1) if own[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_scan_equals_brute_force(spark, docs, rows, empty):
    grant = license_scan.TEMPLATES["mit"].split()
    extra = [
        (900, "Licensed under the Apache License, Version 2.0. under THE mit-license; CC BY-NC cc by nc cc by nc"),
        (901, "under the mit under the mit license license version 2 apache license version"),
        (902, "filler " * 30 + " ".join(grant)),
        (903, "filler " * 30 + " ".join(w for i, w in enumerate(grant) if i % 9)),
        (904, "permission is hereby granted to nobody"),
        (905, "permission is hereby granted to nobody"),
    ]
    asked = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = license_scan.scan_licenses(asked).collect()
    base = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)
    assert base == Counter((i, *plain_scan(t)) for i, t in rows + extra)
    labels = {r.doc_id: r.labels for r in got}
    assert labels[900] == "apache-2,cc-by-nc,mit" and labels[902] == labels[903] == "mit" and labels[904] == labels[905] == ""
    assert all(0 <= r.score <= 1 for r in got)
    assert license_scan.scan_licenses(empty).count() == 0


def test_licenses_with_inserted_words_keep_their_labels(spark):
    rng = np.random.default_rng(6)
    rows = []
    for label, template in license_scan.TEMPLATES.items():
        own = template.split()
        places = [[i] for i in range(len(own) + 1)] + [sorted(rng.integers(0, len(own) + 1, 2)) for _ in range(40)]
        for some in places:
            words = list(own)
            for i in reversed(some):
                words.insert(int(i), "zzword")
            rows.append((len(rows), " ".join(words), label))
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    got = {r.doc_id: set(r.labels.split(",")) for r in license_scan.scan_licenses(df, phrases={}).collect()}
    lost = [(label, text) for i, text, label in rows if label not in got[i] and len(text.split()) > 12]
    assert not lost, (len(lost), lost[:3])


def test_all_character_references_are_decoded(spark):
    text = ("&copy; 2024 &middot; &Eacute;t&eacute; &hellip; &#x27;q&#X1F600; &#128512; &#1114111; &#0000065; &#150; &amp;lt; &lt;b&gt; "
            "&NotEqualTilde; &nosuch; &amp; a&b; &#99999999; &#xD800; &nbsp;.")
    want = ("© 2024 · Été … 'q😀 😀 \U0010ffff A – &lt; <b> ≂̸ &nosuch; & a&b; \ufffd \ufffd  .")
    df = spark.createDataFrame([(text,), ("plain",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(warc.decoded(F.col("t"))).collect()] == [want, "plain", None, ""]
    page = spark.createDataFrame([(1, "u", "<title>A &copy;</title><a href='/x&#x27;'>l</a><footer>&copy; me</footer>")], "page_id long, url string, html string")
    meta, text = (r.block for r in warc.derivatives(warc.responses(page)).orderBy(F.desc("warc_type")).collect())
    assert "title: A ©" in meta and "outlink: /x' " in meta and text.endswith("© me")


def test_added_tokens_in_texts_are_tokens():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    plain, words = Tokenizer.from_file(path), packing.WordCache(path)
    texts = ["page.<|endoftext|> next", "<|endoftext|>", "a  <|endoftext|>  b <|endoftext|><|endoftext|>c\n", "<|endoftext|", "one two"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in want[0]
    assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(texts)] == want


def test_words_of_letters_and_signs_need_no_pre_tokenizer(monkeypatch):
    """They are joined from units of the model, and the ids are those of the whole text."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    words = packing.WordCache(public_tokenizers.path(packing.TOKENIZER))
    whole = words.tokenizer
    plain = ["Erbe, wenn: ja.\nÜber! x+++", " (no) end.", "süß###.\nNeu; a\0b, c"]
    odd = ["a½b. c", "x²!\nY", "it's. don't!", "a.\n\nb", "a.\n b", "a.\nb's", "é.x", "x@\n", "a_b,", "q .", "<|endoftext|>.\nA. b", "a.b.c", "  "]
    for text in plain + odd:
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    asked = []
    monkeypatch.setattr(words, "tokenizer", type("Seen", (), {
        "model": whole.model, "encode_batch_fast": lambda self, rest, **_: asked.extend(rest) or []})())
    words.learn([" erben,", "wohl.\nDann", "gut!"])
    assert asked == []


def test_anchors_of_a_long_text_need_little_memory():
    text = np.random.default_rng(8).integers(97, 123, 3_000_000).astype(np.uint8).tobytes()
    part = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([b"k"]), pa.array([text])], names=["doc_id", "key", "text"])
    tracemalloc.start()
    found = list(suffix_dedup._anchors(200)(iter([part])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    lows, highs = (np.concatenate([b.column(c).values.to_numpy() for b in found]) for c in ("lows", "highs"))
    windows = np.sort(np.concatenate([np.arange(a, b + 1) for a, b in zip(lows, highs)]))
    assert np.array_equal(windows, np.arange(len(text) - 199))  # each window once, whatever the parts


def test_parts_of_a_long_text_are_compared(spark):
    rng = np.random.default_rng(9)
    base = "".join(map(chr, rng.integers(97, 123, suffix_dedup.PART_BYTES * 2 + 5000)))
    at = suffix_dedup.PART_BYTES - 150  # across the end of a part
    docs = spark.createDataFrame([(1, base), (2, "x" + base[at : at + 400] + "y")], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(docs, 200).collect()}
    assert got == {1: (400, 1), 2: (400, 1)}


def test_workers_let_go_of_the_tokenizer_when_another_operator_begins():
    words = weakref.ref(packing._tokenizer(None))
    assert packing._tokenizer(None) is words()
    list(suffix_dedup._anchors(200)(iter([])))
    gc.collect()
    assert words() is None


@pytest.mark.parametrize("most", [1 << 14, 8])
def test_suffixes_are_ordered_in_little_memory(monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "SORTED", most)
    rng = np.random.default_rng(10)
    word = rng.integers(97, 123, 60)
    for data in (rng.integers(97, 99, 500), np.tile(word, 9), np.tile([97, 98], 300), rng.integers(0, 256, 400), np.array([5])):
        data = data.astype(np.uint8)
        for depth in (1, 2, 3, 20):
            order = suffix_dedup.suffix_order(data, depth)
            assert sorted(order) == list(range(len(data)))
            shown = [data[i : i + depth].tobytes() for i in order]
            assert shown == sorted(shown)
    if most > 8:
        data = rng.integers(97, 123, 1 << 20).astype(np.uint8)
        tracemalloc.start()
        suffix_dedup.suffix_order(data, 200)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 64 << 20


@pytest.mark.parametrize("operator", ["suffix_dedup", "ngram_join"])
def test_texts_reach_tasks_in_small_batches(spark, operator):
    docs = spark.createDataFrame([(i, f"{i} " + "word " * 40_000) for i in range(40)], "doc_id long, text string").coalesce(1)
    module = {"suffix_dedup": suffix_dedup, "ngram_join": ngram_join}[operator]
    made = module.remove_repeats(docs) if operator == "suffix_dedup" else module.jaccard_classes(docs, 5, 80)
    sizes = docs.mapInArrow(lambda parts: (pa.RecordBatch.from_arrays([pa.array([p.nbytes])], names=["n"]) for p in parts), "n long")
    assert made.count() == 40 and max(r.n for r in sizes.collect()) < 4 << 20
