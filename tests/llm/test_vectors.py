"""Whitening and nearest neighbours against NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import nearest, whitening
from tessera.llm.common import table

SF = "/root/testdata/sf0.01"
VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("n", T.StringType()),
    T.StructField("distance", T.StringType()), T.StructField("size", T.StringType()),
])


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "x", "x") for i, v in rows], VECTORS)


def check_whitened(got, rows, components=32, weights="counts"):
    """``rows``: (id, x vector) of one length."""
    x = np.array([v for _, v in rows], np.int64)
    if weights == "one":
        x = np.unique(x, axis=0)
    n, s = len(x), x.sum(axis=0)
    d = x - s / n
    cov = d.T @ d / n
    value, axis = np.linalg.eigh(cov)
    value, axis = value[::-1], axis[:, ::-1]
    k = min(components, x.shape[1])
    assert len(got) == k * len(rows)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    for i, v in rows:
        whole = sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s, strict=True))
        for c in range(1, k + 1):
            r = by[i][c]
            assert r["n"] == n and r["deviation"] == whole and math.isclose(r["explained"], value[c - 1] / np.trace(cov), rel_tol=1e-9)
            assert r["identity_error"] == got[0]["identity_error"] <= 1e-9
    for c in range(1, k + 1):
        mine = np.array([by[i][c]["whitened"] for i, _ in rows])
        want = (np.array([v for _, v in rows]) - s / n) @ axis[:, c - 1] / np.sqrt(value[c - 1])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-7


def test_whitening_of_the_table(spark):
    got = whitening.op13_whitening(spark, SF).collect()
    rows = table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    check_whitened(got, [(r[0], [math.floor(64 * c) + 1_000_000 for c in r[1]]) for r in rows])


def test_whitening_with_copies_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 3)) * [900, 5, 0.1]  # keys of one, two and more bytes
    rows = [(i, base[i % 60] if i < 60 or i % 2 else base[0]) for i in range(200)]
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [float("nan")] * 3), (904, [float("inf"), 0, 0])]
    other = [(1000 + i, rng.normal(size=2)) for i in range(10)]
    df = frame(spark, rows + odd + other).repartition(4)
    x = lambda part: [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in part]
    for weights in ("counts", "one"):
        got = whitening.whiten(df, weights=weights).collect()
        check_whitened([r for r in got if r["vec_id"] < 900], x(rows), weights=weights)
        check_whitened([r for r in got if r["vec_id"] >= 1000], x(other), weights=weights)
        assert not {r["vec_id"] for r in got} & {i for i, _ in odd}


def test_whitening_without_spread_and_without_rows(spark):
    flat = whitening.whiten(frame(spark, [(i, [1.0, float(i % 2), 5.0]) for i in range(6)])).collect()
    assert len(flat) == 18
    for r in flat:
        assert (r["whitened"] is None) == (r["component"] > 1) and r["identity_error"] < 1e-9
    same = whitening.whiten(frame(spark, [(1, [2.0]), (1, [2.0]), (None, [2.0])])).collect()
    assert [(r["whitened"], r["deviation"], r["n"], r["identity_error"]) for r in same] == [(None, 0, 3, None)] * 3
    assert whitening.whiten(frame(spark, [])).collect() == []


def test_wide_entries_stay_exact(spark):
    rows = [(0, [2.0**40 + 1]), (1, [-(2.0**40)]), (2, [0.0])]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame(spark, rows)).collect()}
    x = [64 * (2**40 + 1), -64 * 2**40, 0]
    want = [(3 * a - sum(x)) ** 2 for a in x]
    assert got == {i: w if w < 2**63 else None for i, w in enumerate(want)}


def test_keys_have_the_least_width():
    y = np.array([[1, -128], [127, 0], [128, 0], [-32769, 5], [2**31, 0]])
    keys = whitening.pack(y)
    assert [len(k) for k in keys] == [3, 3, 5, 9, 17] and (whitening.unpack(keys, 2) == y).all()


def brute(rows, asks, k=10):
    """Of each query its candidates by distance and id."""
    out = {}
    for q, v in rows:
        if asks(q):
            near = sorted((math.dist(v, w), i) for i, w in rows if i != q and len(w) == len(v))
            out[q] = near[:k]
    return out


def test_hilbert_curve_is_continuous():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    place = nearest.hilbert(cells, 3)
    assert sorted(place) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_nearest_of_the_table(spark):
    rows = [(r[0], list(r[1])) for r in table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    want = brute(rows, lambda i: i % 100 == 0)
    got = {}
    for r in nearest.op12_shifted_curves(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [i for _, i in got[q]] == [i for _, i in near]
        assert all(math.isclose(a, b, rel_tol=1e-14) for (a, _), (b, _) in zip(got[q], near, strict=True))


def test_nearest_in_clusters_with_copies(spark):
    """Narrow windows suffice where vectors have neighbours; ties by id."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(150, 16)) * 5
    rows = [(i, centres[i % 150] + rng.normal(size=16) * 0.1) for i in range(3000)]
    rows += [(5000 + i, centres[0]) for i in range(400)]  # one vector many times
    odd = [(9000, None), (9100, [0.0] * 16), (9200, [float("nan")] * 16), (None, centres[1]), (9300, []), (9400, [1.0, 2.0]), (9500, [2.0, 1.0]), (9600, [None] * 16)]
    df = frame(spark, rows + odd).repartition(6)
    got = {}
    for r in nearest.nearest(df, F.col("vec_id") % 100 == 0, window=32).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
        assert r["recall"] >= 0.93
    want = brute([(i, list(v)) for i, v in rows] + [(9400, [1.0, 2.0]), (9500, [2.0, 1.0])], lambda i: i % 100 == 0)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in near} & {i for i, _ in got[q].values()}) for q, near in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert got[9400] == {1: (9500, math.sqrt(2))}
    assert [got[5000][i][0] for i in range(1, 11)] == list(range(5001, 5011)) and [got[5300][i][0] for i in (1, 10)] == [5000, 5009]


def test_nearest_of_few_rows(spark):
    few = nearest.nearest(frame(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (7, [3.0, 0.0])])).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in few) == [(0, 1, 7), (0, 1, 7), (7, 1, 0), (7, 2, 0)]
    assert nearest.nearest(frame(spark, [])).collect() == [] and nearest.nearest(frame(spark, [(0, [1.0])])).collect() == []
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, []), weights="two")
