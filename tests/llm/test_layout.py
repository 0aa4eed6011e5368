import base64
import gzip
import hashlib
import os
import zlib
from collections import Counter, defaultdict

import __spark_entry__ as entry
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plumbline.llm import mixing, packing, warc

from . import cases


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é日1.'\n\t  <|>", max_size=30), max_size=6))
def test_word_cache_equals_the_tokenizer(texts):
    words = packing.WordCache(public_tokenizers.path("byte_bpe_50k.json"))
    for text, ids in zip(texts, words.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50)))
def test_plan_uses_every_piece_once(histogram):
    plan = packing.packing_plan(histogram, 64)
    used = Counter()
    for items, times in plan:
        assert sum(items) <= 64 and times > 0
        for n in items:
            used[n] += times
    assert used == Counter(histogram)
    total, bins = sum(n * c for n, c in histogram.items()), sum(t for _, t in plan)
    assert -(-total // 64) <= bins <= 2 * total / 64 + 1


def test_complements_fill_exactly():
    for histogram in ({40: 3, 24: 3}, {40: 2, 20: 2, 4: 2}, {30: 1, 20: 1, 10: 1, 4: 1}):
        plan = packing.packing_plan(histogram, 64)
        assert all(sum(items) == 64 for items, _ in plan)


def test_packing_is_whole_and_gapless(docs, rows, empty, tokenizer):
    got = packing.pack(docs, 512).collect()
    want = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        start = 0
        for k, n in enumerate(packing.piece_lengths(len(ids), 512)):
            own = np.array(ids[start : start + n], "<u4").tobytes()
            want[i, k, start, n, zlib.crc32(own)] += 1
            start += n
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    parts = defaultdict(list)
    for r in got:
        parts[r.sequence_id].append((r.offset, r.length))
    for own in parts.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 512
    assert len(parts) <= 1.1 * sum(r.length for r in got) / 512 + 1
    assert packing.pack(empty, 512).count() == 0


def test_sequences_hold_the_ids(docs, rows, tokenizer):
    tokens = Counter(x for _, t in rows for x in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
    got = packing.sequences(docs, 512).collect()
    assert Counter(x for r in got for x in r.input_ids) == tokens
    assert all(len(r.input_ids) == sum(r.lengths) <= 512 for r in got)


def filled(sizes, weights=(3, 1, 2)):
    """Targets by resharing the excess until none is above twice the size."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        level = rest / max(sum(w[s] for s in names if s not in full), 1e-9)
        more = {s for s in names if s not in full and level * w[s] >= 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in full else level * w[s] for s in names}
        full |= more


def test_mixture_follows_targets(docs, rows, empty):
    got = mixing.mixture(docs).collect()
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect() if r.doc_id is not None}
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(cases.words(t))) for i, t in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    sizes, taken = Counter(), Counter()
    for r in docs.select("source", "text").collect():
        sizes[r.source] += len(cases.words(r.text))
    want = filled(dict(sizes))
    for r in got:
        if r.doc_id is not None:
            assert r.target == pytest.approx(want[source[r.doc_id]]) and r.source_size == sizes[source[r.doc_id]]
            taken[source[r.doc_id]] += r.taken
    for s, n in want.items():
        assert abs(taken[s] - n) <= 0.02 * n + 400  # rows without an id are left out of this sum
    again = mixing.mixture(docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.mixture(empty).count() == 0


def test_apportionment_is_by_highest_quotients(spark):
    rng = np.random.default_rng(2)
    votes = [(g, k, float(v)) for g in range(6) for k, v in enumerate(rng.integers(0, 1000, 1 + 3 * g))]
    for seats in (0, 1, 7, 100, 5000):
        df = spark.createDataFrame([(*v, seats) for v in votes], "g int, k int, v double, seats long")
        got = {(r.g, r.k): r.quota for r in mixing.apportion(df, ["g"], "k", "v", "seats").collect()}
        for g in range(6):
            own = [(k, v) for h, k, v in votes if h == g]
            if not sum(v for _, v in own):
                continue
            best = sorted(((-v / (2 * j - 1), k) for k, v in own for j in range(1, seats + 1)))[:seats]
            assert Counter({k: got[g, k] for k, _ in own if got[g, k]}) == Counter(k for _, k in best)


def test_mixed_documents_hold_what_was_taken(docs):
    asked = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    want = {r.doc_id: r.taken for r in mixing.mixture(asked).collect() if r.taken}
    made = mixing.mixed_documents(asked)
    assert made.columns == docs.columns
    got = Counter()
    for r in made.select("doc_id", "text", "n_chars").collect():
        got[r.doc_id] += len(cases.words(r.text))
        assert r.n_chars == len(r.text)
    assert got == Counter(want)


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([
        (1, "http://a.example/x", "<html><title>A &amp; B</title><p>One&nbsp;two<br>three &#8364; &lt;b&gt;<script>no()</script>"
                                  "<a href='/l?a=1&amp;b=2'>link</a></p></html>"),
        (2, None, None), (3, "http://b.example/", ""), (3, "http://b.example/", ""), (None, "u", "<p>x"),
    ], "page_id long, url string, html string")
    records = warc.derivatives(warc.responses(pages))
    rows = records.collect()
    assert len(rows) == 10
    conversion = {r.target_uri: r.block for r in rows if r.warc_type == "conversion"}
    assert conversion["http://a.example/x"] == "A & B\nOne two\nthree € <b>link" and conversion[None] == ""
    fields = next(r.block for r in rows if r.warc_type == "metadata" and r.target_uri == "http://a.example/x")
    assert "outlink: /l?a=1&b=2 L a/@href\r\n" in fields and "title: A & B\r\n" in fields
    path = str(tmp_path / "warc")
    warc.write_warc(records, path)
    data = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(f"{path}/*.gz").collect())
    parsed = []
    while data:
        head, _, data = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        assert data[n : n + 4] == b"\r\n\r\n"
        digest = base64.b32encode(hashlib.sha1(data[:n]).digest()).decode()
        assert fields["WARC-Block-Digest"] == f"sha1:{digest}"
        parsed.append((fields["WARC-Record-ID"], fields["WARC-Refers-To"], fields["WARC-Type"]))
        data = data[n + 4 :]
    assert Counter(parsed) == Counter((r.record_id, r.refers_to, r.warc_type) for r in rows)
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


def test_pipeline_stages(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "suffix-array dedup", "mixing sources", "best-fit packing"]
    now, sizes = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "").persist()
        assert now.columns == docs.columns
        sizes.append(now.count())
    assert docs.count() > sizes[0] > sizes[1] == sizes[2]
    assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() >= sizes[3]


def test_pipeline_is_registered():
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert os.path.exists(corpus_pipeline.__file__)
    assert corpus_pipeline.ORACLE_SQL is None
