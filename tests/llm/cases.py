"""Small documents with every odd case, and plain versions of the operators."""

import hashlib
import re

import numpy as np

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, size long, lang_pred string, "
          "score double, `key` binary, token long, target double")


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def prose(seed, n, vocabulary=4000):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{int(i):x}o" for i in rng.integers(0, vocabulary, n))


def documents(spark):
    """doc_id, text, lang, source, n_chars, and columns whose names operators might use themselves."""
    base = prose(1, 300).split()
    near = [" ".join(w if j % 97 != i else f"x{i}" for j, w in enumerate(base)) for i in range(30)]
    shared = prose(2, 60)
    texts = [
        *near, *[prose(3, 80)] * 5, *(f"{prose(10 + i, 50)} {shared} {prose(50 + i, 40)}" for i in range(12)),
        None, None, "", "   \n\t ", "one two", "one two", "Ein Straße, déjà vu", "!!! ??? 123", "a" * 900, "ab" * 700,
        prose(4, 20000), "日本語 のテキスト です", "x\x00y z\x00w",
    ]
    rows = [(i, t, "en" if i % 3 else None, None if i % 11 == 0 else f"s{i % 4}") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, near[5], "en", "s1"), (None, None, None, None)]
    full = [(*r, len(r[1] or ""), "r", 1, "p", 0.5, b"k", 7, 1.5) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def sets(text, k):
    w = words(text)
    if len(w) >= k:
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def components(rows, k, percent):
    """{doc_id: smallest id reachable} of (doc_id, text), each id once."""
    own = {i: sets(t, k) for i, t in rows}
    parent = {i: i for i in own}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(own)
    for i in ids:
        for j in ids:
            both = len(own[i] & own[j])
            if i < j and both and 100 * both >= percent * (len(own[i]) + len(own[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def repeats_removed(texts, length):
    """(bytes, removed, spans, sha256 of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for t in data:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in data:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        left = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), len(t) - len(left), int((np.diff(gone.astype(int), prepend=0) == 1).sum()),
                    hashlib.sha256(left).hexdigest()))
    return out
