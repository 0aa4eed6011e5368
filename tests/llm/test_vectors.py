import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import ann, exact_search, vectors


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8)) * rng.choice([0.5, 1, 3], 600)[:, None]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(700 + i, rows[20][1]) for i in range(40)]  # copies
    odd = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [math.nan] * 8, [math.inf] + [1.0] * 7, [1.0, 2.0]]
    rows += [(800 + i, v) for i, v in enumerate(odd)] + [rows[40], (None, rows[0][1])]
    return spark.createDataFrame([(*r, 1, 0) for r in rows], "vec_id long, embedding array<double>, rank int, shard int").repartition(3)


def plain(table, step, k, scale=None):
    """{query: [(vec_id, score)]} by brute force; scale: whole numbers, in which zero vectors take part."""
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    rows = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    rows = [(i, [math.floor(scale * x) for x in v] if scale else v) for i, v in rows]
    rows = rows if scale else [r for r in rows if any(r[1])]
    out = {}
    for q, v in {i: v for i, v in rows if i % step == 0}.items():
        own = [(i, sum(a * b for a, b in zip(v, w))) for i, w in rows if i != q and len(w) == len(v)]
        out[q] = sorted(own, key=lambda x: (-round(x[1], 9), x[0]))[:k]
    return out


def by_query(found):
    out = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


@pytest.fixture(autouse=True)
def small_groups(monkeypatch):
    for module in (ann, exact_search):
        monkeypatch.setattr(module, "SHARD_ROWS", 200)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 16)


def test_factor_one_is_exact(table):
    got, want = by_query(ann.nearest(table, F.col("vec_id") % 20 == 0, 20, 1.0)), plain(table, 20, 20)
    want = {q: v for q, v in want.items() if v}
    assert got.keys() == want.keys()
    for q, best in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in best]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in best])


def test_larger_factor_keeps_recall(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    exact = by_query(ann.nearest(e, F.col("vec_id") % 20 == 0, 20, 1.0))
    got = by_query(ann.nearest(e, F.col("vec_id") % 20 == 0, 20, ann.FACTOR))
    shared = [len({i for i, _ in got[q]} & {i for i, _ in own}) / len(own) for q, own in exact.items()]
    assert np.mean(shared) >= 0.9


def test_best_products_equal_brute_force(table):
    got, want = by_query(exact_search.best_products(table, F.col("vec_id") % 50 == 0, 5)), plain(table, 50, 5, 256)
    assert got == {q: v for q, v in want.items() if v}


@pytest.mark.parametrize("scale", [40.0, 3e9])
def test_bucket_search_with_unequal_lengths(scale):
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(900, 6)) * np.exp(rng.normal(size=(900, 1))) * scale / 30)
    x[5:400:7] = x[5]
    q, r, s = exact_search.search_bucket(x[:40], x, 6)
    whole = [[int(v) for v in row] for row in x]
    for i in range(40):
        score = [sum(a * b for a, b in zip(whole[i], w)) for w in whole]
        best = sorted(range(900), key=lambda j: (-score[j], j))[:6]
        assert [int(j) for j in r[q == i]] == best and [int(v) for v in s[q == i]] == [score[j] for j in best]


def test_no_vectors(table):
    assert ann.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert exact_search.best_products(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert ann.nearest(table, F.lit(False)).count() == 0


def repeated(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("times", [2, 30])
def test_repeated_query_rows_take_no_places(spark, times):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(1, 60)]
    rows += [(0, [9.0, 9.0, 9.0, 9.0])] * times + [(0, [8.0, 9.0, 9.0, 7.0 + i]) for i in reversed(range(times))] + [rows[3]] * 3  # the least is the query
    table = repeated(spark, rows)
    got, want = by_query(exact_search.best_products(table, F.col("vec_id") == 0, 5)), plain(table, 1000, 5, 256)
    assert len(got[0]) == 5 and [s for _, s in got[0]] == [s for _, s in want[0]]
    table = repeated(spark, [r for r in rows if r[0]] + [(0, rows[-1][1])] * times)
    got, want = by_query(ann.nearest(table, F.col("vec_id") == 0, 20, 1.0)), plain(table, 1000, 20)
    assert [i for i, _ in got[0]] == [i for i, _ in want[0]]


def test_equal_vectors_come_in_order_of_ids(spark):
    rng = np.random.default_rng(9)
    same = [float(x) for x in rng.normal(size=4)]
    rows = [(1000 - i, same) for i in range(150)] + [(i, [float(x) / 9 for x in rng.normal(size=4)]) for i in range(40)]
    got = by_query(ann.nearest(repeated(spark, rows), F.col("vec_id") == 1000, 20, 1.0))
    assert [i for i, _ in got[1000]] == list(range(851, 871))
