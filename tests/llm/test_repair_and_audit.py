import hashlib
import heapq
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import conversation_repair, divergence, prefix_trees

from . import cases

ROWS = "conv_id long, turn long, role string, text string, size long, audit string"


def conversations(spark):
    rng = np.random.default_rng(3)
    roles, texts = ["user", "assistant", "user", "assistant", "system", "tool", "", None], ["Hi.", "No end", "Well?", "", " \n", None, "Ja!  ", "a.b"]
    rows = []
    for c in range(160):
        for t in range(int(rng.integers(1, 6))):
            rows.append((c, None if rng.random() < 0.05 else int(t + rng.integers(0, 2)), roles[rng.integers(0, 8)], texts[rng.integers(0, 8)]))
    rows += [(500, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(6)] + [rows[0]] * 3 + [(None, 1, "user", "Hi."), (None, None, None, None)]
    return spark.createDataFrame([(*r, 1, "K") for r in rows], ROWS).repartition(5), rows


def cheapest(symbols):
    """(cost, letters) by a search of all edits in order of cost and letters."""
    heap = [(0, "", 0, "")]
    while True:
        cost, letters, i, form = heapq.heappop(heap)
        if i == len(symbols) and re.fullmatch("(s?(ua)+)?", form):
            return cost, letters
        moves = [(2, "I", i, form + "u"), (2, "I", i, form + "a")]
        if i < len(symbols):
            gone, initial, cut = symbols[i]
            moves.append((3, "D", i + 1, form))
            if not gone:
                moves += [(cut, "K", i + 1, form + initial), (2 + cut, "R", i + 1, form + "u"), (2 + cut, "R", i + 1, form + "a")]
        for more, letter, j, f in moves:
            if re.fullmatch("s?(ua)*u?", f):
                heapq.heappush(heap, (cost + more, letters + letter, j, f))


def repaired(rows):
    """What the query returns for the damaged rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, symbols, counts = set(), [], Counter()
    for _, _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        symbols.append((fault in ("blank", "duplicate"), role[:1] or " ", int(fault == "truncated")))
    pairs = [a[1] + b[1] for a, b in zip(symbols, symbols[1:])]
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = cheapest(symbols)
    given, form, lines = iter(rows), "", []
    for letter in audit:
        follow = "assistant" if form.endswith("u") else "user"
        if letter == "I":
            role, text = follow, ""
        else:
            _, _, role, text = next(given)
            if letter == "D":
                continue
            role = follow if letter == "R" else role
        form += role[0]
        lines.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", form)
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.mark.parametrize("piece", [1024, 2])
def test_repairs_equal_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(conversation_repair, "PIECE", piece)
    df, rows = conversations(spark)
    hurt = conversation_repair.damaged(df)
    got = conversation_repair.repair_digests(hurt, df).collect()
    own = defaultdict(list)
    for r in hurt.collect():
        own[r.conv_id].append(tuple(r))
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        assert tuple(r)[1:] == repaired(own[r.conv_id]), r.conv_id
    assert conversation_repair.repair_digests(hurt.limit(0), df.limit(0)).count() == 0
    assert {tuple(r)[1:] for r in conversation_repair.repair_digests(hurt.limit(0), df).collect()} == {
        (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_rows_follow_the_form(spark):
    df, _ = conversations(spark)
    made = conversation_repair.repaired_rows(df, conversation_repair.audits(df)).collect()
    own = defaultdict(dict)
    for r in made:
        own[r.conv_id][r.position] = r
    for c, rows in own.items():
        assert sorted(rows) == list(range(len(rows)))
        assert re.fullmatch("s?(ua)+", "".join(rows[i].role[0] for i in sorted(rows))), c


def test_pieces_of_a_long_conversation():
    rng = np.random.default_rng(0)
    symbols = "".join(rng.choice(list("xsuaoSUAO"), 300))
    end = [2 * n for n in conversation_repair.LAST_INSERTS]
    whole, states = conversation_repair.piece_letters(symbols, end)
    cost = [min(c + e for c, e in zip(conversation_repair.piece_costs(symbols)[4 * s : 4 * s + 4], end)) for s in range(4)]
    value = {"D": 3, "I": 2, "R": 2, "K": 0}
    for s in range(4):
        rows = iter(symbols)
        paid = 0
        for letter in whole[s]:
            symbol = next(rows) if letter != "I" else ""
            paid += value[letter] + (letter in "KR" and symbol.isupper())
        assert paid + end[states[s]] == cost[s]


def earlier_removed(rows, length):
    """(words, removed, digest) of (doc_id, text), null ids last."""
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    key = [cases.np.inf if i is None else i for i, _ in rows]
    first = {}
    for k, w in zip(key, split):
        for s in range(len(w) - length + 1):
            own = tuple(w[s : s + length])
            first[own] = min(first.get(own, (k, s)), (k, s))
    out = []
    for k, w in zip(key, split):
        gone = np.zeros(len(w), bool)
        for s in range(len(w) - length + 1):
            if (k, s) > first[tuple(w[s : s + length])]:
                gone[s : s + length] = True
        left = [x for x, g in zip(w, gone) if not g]
        out.append((len(w), int(gone.sum()), hashlib.sha256(b" ".join(left)).hexdigest()))
    return out


@pytest.mark.parametrize("group, length", [(1 << 16, 20), (3, 20), (3, 7)])
def test_earlier_windows_equal_brute_force(spark, docs, monkeypatch, group, length):
    monkeypatch.setattr(prefix_trees, "GROUP", group)
    loop = " ".join(["one two three"] * 60)
    extra = [(700 + i, t) for i, t in enumerate([loop, loop + " four", cases.prose(9, 30) + " " + loop, "word " * 25, "Word " + "word " * 25])]
    asked = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string")).persist()
    rows = [tuple(r) for r in asked.collect()]
    got = prefix_trees.remove_earlier(asked, length).collect()
    want = earlier_removed(rows, length)
    assert sum(w[1] for w in want) > 1000
    assert Counter(map(tuple, got)) == Counter((i, *w) for (i, _), w in zip(rows, want))


def test_kept_words_and_columns(docs, empty):
    kept = prefix_trees.without_earlier(docs, 20)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert kept.where("n_chars <> length(text)").count() == 0
    assert prefix_trees.without_earlier(empty, 20).count() == prefix_trees.remove_earlier(empty, 20).count() == 0


def test_words_of_slices(monkeypatch):
    texts = [b"", b"one  two\n", b"", cases.prose(2, 500).encode(), b"x" * 300, b"  ", "é b c".encode(), b""]
    whole = prefix_trees.word_hashes(texts)
    assert np.diff(whole[1]).tolist() == [len(t.split()) for t in texts]
    monkeypatch.setattr(prefix_trees, "SLICE_BYTES", 64)
    assert all((a == b).all() for a, b in zip(prefix_trees.word_hashes(texts), whole))
    monkeypatch.setattr(prefix_trees, "MOST_WORDS", 40)
    text = [cases.prose(2, 500).encode()]
    rows = list(zip(*prefix_trees.snippets(*prefix_trees.word_hashes(text), 20)))
    assert [w for r in rows for w in range(r[3], r[3] + r[4])] == list(range(481))


def test_nodes_of_a_suffix_tree():
    rng = np.random.default_rng(1)
    letters = [rng.integers(0, 2, 40) for _ in range(4)]
    order, nodes = prefix_trees.suffix_tree(letters)
    paths = [tuple(own[i] for own in letters) for i in order]
    assert paths == sorted(paths)
    for depth, (first, last) in enumerate(nodes, 1):
        want = Counter(p[:depth] for p in paths)
        more = Counter(p[: depth + 1] for p in paths)
        if depth < 4:
            want = {p: c for p, c in want.items() if c > 1 and max(n for q, n in more.items() if q[:depth] == p) < c}
        else:
            want = {p: c for p, c in want.items() if c > 1}
        assert {paths[a][:depth]: b - a + 1 for a, b in zip(first, last)} == want


def audited(rows, least_docs, terms_each):
    """The rows of the audit of (text, lang, source)."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in ((a or "", b or "", c or "") for a, b, c in rows):
        own = Counter(term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)))
        groups.add((lang, source))
        counts[lang, source].update(own)
        docs[lang].update(own.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, c in docs[lang].items() if c >= least_docs]
        sources = [s for g, s in groups if g == lang]
        count = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        count[None] = {t: sum(count[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (c + 1) // (sum(own.values()) + len(kept)) for t, c in own.items()} for s, own in count.items()}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s]
            telling = [(-((p[s][t] - p[None][t]) ** 2 // p[None][t]), t.encode()) for t in kept if count[s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", telling, terms_each)):
                out += [(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(sorted(found)[:most], 1)]
    return out


@pytest.mark.parametrize("least, pairs", [(3, 1 << 20), (2, 4)])
def test_divergence_equals_brute_force(spark, docs, empty, monkeypatch, least, pairs):
    monkeypatch.setattr(divergence, "PAIRS", pairs)
    extra = [(800 + i, t, "xx", f"q{i % 3}") for i, t in enumerate([
        "rare, Rare. RARE; foo", "rare foo-foo", "(rare) foo bar", "once", None, "1 2 3", "straße Straße ÄRGER's ärger"])]
    asked = docs.select("doc_id", "text", "lang", "source").union(spark.createDataFrame(extra, "doc_id long, text string, lang string, source string"))
    rows = [tuple(r)[1:] for r in asked.collect()]
    got = divergence.source_divergence(asked, least_docs=least, terms_each=20).collect()
    assert Counter((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in got) == Counter(audited(rows, least, 20))
    assert divergence.source_divergence(empty).count() == 0


def test_dense_and_sparse_sums_agree():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 6, 30)
    left, right = divergence._all_pairs(sizes)
    at = np.cumsum(sizes) - sizes
    want = [(a + x, a + y) for a, n in zip(at, sizes) for x, y in itertools.product(range(n), repeat=2)]
    assert sorted(zip(left.tolist(), right.tolist())) == sorted((int(a), int(b)) for a, b in want)


def test_a_task_counts_each_term_once(monkeypatch):
    texts = [b"Rare, rare. (RARE) x1y", b"rare \xc3\x89t\xc3\xa9!", b"", b"-- 12 x", b"foo_foo@x"] * 3
    part = pa.RecordBatch.from_arrays([pa.array([1, 1, 1, 2, 2] * 3), pa.array(texts)], names=["g", "text"])
    empty = pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.binary())], names=["g", "text"])
    want = {(1, "rare"): (24, 12), (1, "x"): (6, 6), (1, "y"): (6, 6), (1, "Ét\xe9"): (6, 6), (2, "x"): (12, 12), (2, "foo"): (12, 6)}
    for held in (1 << 20, 1):
        monkeypatch.setattr(divergence, "HELD_ROWS", held)
        rows = [tuple(r.values()) for b in divergence._terms(iter([part, empty, part])) for r in b.to_pylist()]
        sums = defaultdict(lambda: (0, 0))
        for g, term, n, docs in rows:
            sums[g, term] = (sums[g, term][0] + n, sums[g, term][1] + docs)
        assert sums == want
        assert held == 1 or len(rows) == len(want)


def test_terms_in_more_than_three_documents(spark):
    rows = [(i, f"all{'' if i else ' none'} {'some' * (i % 2)}", "xx", f"q{i % 3}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = divergence.source_divergence(docs, least_docs=5, terms_each=20).collect()
    assert Counter((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in got) == Counter(audited([r[1:] for r in rows], 5, 20))
