import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from plumbline.llm import language_id, toxicity

SF = "/root/testdata/sf0.01"


def remainder(n):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def test_automaton_accepts_exactly_the_substrings():
    text = [1, 2, 1, 1, 2, 3, 1, 2, 1]
    automaton = language_id.SuffixAutomaton(text)

    def accepts(s):
        state = 0
        for c in s:
            if c not in automaton.next[state]:
                return False
            state = automaton.next[state][c]
        return True

    there = {tuple(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)}
    for n in range(1, 5):
        for s in np.ndindex(*(4,) * n):
            assert accepts(s) == (tuple(s) in there)


def test_phrases_equal_a_greedy_parse():
    model = language_id.LanguageModel({"a": ["banana bandana"], "b": ["cabbage cab"]})
    samples = {"a": "banana bandana", "b": "cabbage cab"}
    for text in ("banana cab", "ab", "bandanas", "zzz"):
        encoded = model.encode(language_id.fold_text(text))
        for k, own in enumerate(model.languages):
            known = model.encode(language_id.fold_text(samples[own])).tolist() + [0]
            have = {tuple(known[i:j]) for i in range(len(known)) for j in range(i + 1, len(known) + 1)}
            n, i, s = 0, 0, encoded.tolist()
            while i < len(s):
                j = i + 1
                while j < len(s) and tuple(s[i : j + 1]) in have:
                    j += 1
                n, i = n + 1, j
            assert model.phrases([encoded])[0, k] == n


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language_id.identify(docs, labelled=remainder(4) != 2).join(docs.select("doc_id", "lang"), "doc_id")
    right, rows = found.where(remainder(4) == 2).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert rows > 200 and right > 0.97


def test_language_of_odd_rows(docs, empty):
    got = language_id.identify(docs)
    assert got.count() == docs.count()
    by = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for i, r in by.items():
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, text[i] or "")))
        assert 0 <= r.score <= 1
    kept = language_id.known_language(docs)
    assert kept.columns == docs.columns
    assert kept.count() == got.where("lang_pred <> 'und'").count()
    assert language_id.identify(empty).count() == 0


def test_channel_restores_words():
    # a flat model that favours the word's letters
    flat = np.full((toxicity.SYMBOLS,) * 3, 5.0, np.float32)
    word = [0, 0, *(ord(c) - 96 for c in "idiot"), 0]
    for a, b, c in zip(word, word[1:], word[2:]):
        flat[a, b, c] = 0.1
    for disguise in ("1d10t", "i.d.i.o.t", "idiiiot", "!d!ot", "id*ot", "idiot"):
        assert toxicity.decode(disguise, flat.ravel().tolist()) == "idiot"
    assert toxicity.Restorer(flat).words("so i d i o t there".split()) >= {"idiot", "so", "there"}


def test_toxicity_of_held_out_rows(spark):
    sf = SF.replace("0.01", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = toxicity.score_toxicity(docs, labels, labelled=remainder(5) != 0).join(labels, "doc_id").where(remainder(5) == 0)
    t = {(r.toxic, r.predicted): r.n for r in found.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    assert t[1, 1] / (t[1, 1] + t.get((1, 0), 0)) > 0.85
    assert t.get((0, 1), 0) / t[0, 0] < 0.01


def test_toxicity_of_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(50)] + [(None, 1), (3, 7), (4, None)], "doc_id long, toxic int")
    for marks in (labels, labels.limit(0), labels.where("toxic = 0")):
        got = toxicity.score_toxicity(docs, marks).collect()
        assert len(got) == docs.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert toxicity.score_toxicity(empty, labels).count() == 0


def likely(*words):
    """A character model that favours the given words."""
    flat = np.full((toxicity.SYMBOLS,) * 3, 5.0, np.float32)
    for w in words:
        path = [0, 0, *(ord(c) - 96 for c in w), 0]
        for a, b, c in zip(path, path[1:], path[2:]):
            flat[a, b, c] = 0.1
    return flat


def test_tokens_without_plain_letters_are_decoded():
    def words(text, *known):
        return toxicity.Restorer(likely(*known)).words(text.split())

    assert words("@$$", "ass") == words("455", "ass") == {"ass"}
    assert words("$#!7", "shit") == {"shit"}
    assert "moo" in words("m**", "moo") and "idiot" in words("!diot", "idiot")  # masks at the ends
    assert "idiot" in words("**idiot**!", "idiot")
    assert words("st" + "u" * 60 + "pid", "stupid") == {"stupid"}
    assert words("." * 30 + "s." + "." * 30 + "t.u.p.i.d", "stupid") == {"stupid"}
    assert words("... -- ?", "idiot") == set()


def test_spaced_runs_hold_several_words():
    restorer = toxicity.Restorer(likely("a", "stupid", "idiot"))
    assert restorer.words("a s t u p i d".split()) >= {"a", "stupid"}
    assert restorer.words("s t u p i d 1 d 1 0 t".split()) >= {"stupid", "idiot"}
    assert restorer.words(" ".join("stupid" * 12).split()) >= {"stupid"}


def marked(spark, texts):
    """docs and labels of (text, toxic)."""
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, x) for i, (_, x) in enumerate(texts)], "doc_id long, toxic int")


def test_rare_telling_words_are_kept_beside_frequent_ones(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FREQUENT", 3)
    monkeypatch.setattr(toxicity, "FEATURES", 1, raising=False)
    rng = np.random.default_rng(5)
    common = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnr"]
    telling = ["zorbu", "quimp", "yexil"]

    def text(i, *more):
        return " ".join([*rng.choice(common, 12), *more, *rng.choice(common, 12)])

    docs, labels = marked(spark, [(text(i), 0) for i in range(900)] + [(text(i, telling[i % 3]), 1) for i in range(90)])
    model = toxicity.fit(docs, labels, F.lit(True))
    assert set(telling) <= set(model.weights) and not set(common) & set(model.weights)


def test_copies_of_a_clean_text_count_once(spark):
    rng = np.random.default_rng(6)
    common = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnr"]

    def text(*more):
        return " ".join([*rng.choice(common, 12), *more, *rng.choice(common, 12)])

    copied = text("zorbu")
    docs, labels = marked(spark, [(text(), 0) for _ in range(900)] + [(copied, 0)] * 3000 + [(text("zorbu"), 1) for _ in range(90)])
    found = toxicity.score_toxicity(docs.union(docs.where("doc_id = 900")), labels)
    assert found.where("doc_id >= 3900 and predicted = 1").count() > 0
    model = toxicity.fit(docs, labels, F.lit(True))
    assert model.weights["zorbu"] > 2


def test_copies_are_one_of_the_sampled_texts(spark):
    few = [("xx", f"{w} prose") for w in ("moru", "tabel")]
    rows = [(i, t, lang) for i, (lang, t) in enumerate([few[0]] * 3000 + [few[1]] * 3000 + [("yy", f"word{i:x} other") for i in range(600)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.sample_texts(docs, F.lit(True))
    assert sorted(got["xx"]) == ["moru prose", "tabel prose"] and len(got["yy"]) == len(set(got["yy"])) == 96


def test_signs_above_the_first_plane_are_no_letters(spark, docs):
    assert len(language_id.fold_text("😀😀 🎉 \U0010ffff")) == 0 and len(language_id.fold_text("𝒜 𠀀")) == 3
    asked = docs.select("doc_id", "text", "lang").union(spark.createDataFrame([(9000, "😀😀 🎉", None)], "doc_id long, text string, lang string"))
    found = language_id.identify(asked, labelled=F.lit(True)).where("doc_id = 9000").first()
    assert found.lang_pred == "und"


def test_tokens_that_cannot_hold_a_wanted_feature_are_not_decoded(monkeypatch):
    text = "morning! house$$$ hoUse. sttupid $tupid st*pid s.t.u.p.i.d stuuupid! i d i o t moon m**n goodbye! stup1d, st".lower().split()
    costs = likely("stupid", "idiot", "moon", "good")
    every = toxicity.Restorer(costs).words(text)
    asked = []
    decode = toxicity.decode
    monkeypatch.setattr(toxicity, "decode", lambda token, *more: asked.append(token) or decode(token, *more))
    for wanted in ({"stupid"}, {"^stup", "idiot"}, {"moon", "st"}, {"^good"}, {"absent"}):
        found = toxicity.Restorer(costs, wanted).words(text)
        assert found == {w for w in every if not wanted.isdisjoint(toxicity.features(w))}
    assert "st*pid" in asked and not {"morning!", "house$$$"} & set(asked)


def test_features_are_counted_over_many_batches():
    part = pa.RecordBatch.from_arrays(
        [pa.array(["moon good", "moon", None]), pa.array([0, 0, 0], pa.int32()), pa.array([1, 1, 1], pa.int32()), pa.array([1, 2, 1])],
        names=["text", "toxic", "fold", "rows"])
    out = [r for b in toxicity._counted(likely("moon"), frozenset({"moon", "good"}))(iter([part] * 50)) for r in b.to_pylist()]
    total = {}
    for r in out:
        total[r["feature"], r["toxic"], r["fold"]] = total.get((r["feature"], r["toxic"], r["fold"]), 0) + r["n"]
    assert total == {("moon", 0, 1): 75, ("good", 0, 1): 50} and len(out) < 10
