"""Substring dedup against a plain search of every window."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import exchange as ex
from tessera.llm import substrings
from tessera.llm.substrings import WINDOW, Block, dedup_substrings, equal_runs, factors, needed, phrase_hashes, without_duplicates


def plain(rows, window):
    least = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, ws in split:
        if i is not None:
            for a in range(len(ws) - window + 1):
                k = tuple(ws[a : a + window])
                least[k] = min(i, least.get(k, i))
    out = []
    for i, ws in split:
        gone = set()
        if i is not None:
            for a in range(len(ws) - window + 1):
                if least[tuple(ws[a : a + window])] < i:
                    gone.update(range(a, a + window))
        kept = [w for k, w in enumerate(ws) if k not in gone]
        out.append((i, len(ws), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def got(df):
    return sorted(map(str, (tuple(r) for r in df.select("row.doc_id", "out.n_words", "out.n_removed", "out.kept_sha256").collect())))


@pytest.fixture(scope="module")
def shared_rows(odd_rows):
    passage = " ".join(f"p{i}" for i in range(60))
    other = " ".join(f"o{i}" for i in range(55))
    mixed = [(200 + i, f"start{i} {passage} middle{i} {other} end{i}") for i in range(8)]
    joint = [(300, f"{passage} {other}"), (150, f"{other} {passage}"), (301, " ".join(passage.split()[5:]) + " " + " ".join(other.split()[:49]))]
    looped = [(400, " ".join(["again"] * 200)), (401, " ".join(["again"] * 70)), (400, passage), (None, passage)]
    return odd_rows + mixed + joint + looped


@pytest.mark.parametrize("window", [50, 12, 3])
def test_against_plain_search(spark, make_docs, shared_rows, window):
    assert got(dedup_substrings(make_docs(shared_rows).repartition(4), window)) == sorted(map(str, plain(shared_rows, window)))


def test_random_words(spark, make_docs):
    rng = np.random.default_rng(3)
    rows = [(int(i), " ".join(f"w{x}" for x in rng.integers(0, 3, rng.integers(0, 120)))) for i in rng.permutation(60)]
    assert got(dedup_substrings(make_docs(rows).repartition(3), 8)) == sorted(map(str, plain(rows, 8)))


def test_texts_lose_their_duplicates(spark, make_docs, shared_rows):
    docs = make_docs(shared_rows)
    left = without_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len(shared_rows)
    want = sorted(map(str, ((i, d) for i, _, _, d in plain(shared_rows, 50))))
    assert sorted(str((r["doc_id"], hashlib.sha256(b" ".join((r["text"] or "").encode().split())).hexdigest())) for r in left.collect()) == want
    by_text = {r["text"]: r for r in left.collect()}
    assert "double  spaces \n and\r\nlines " in by_text  # texts that lose nothing stay as they are


def test_factors_name_their_source(spark, make_docs, shared_rows):
    out = dedup_substrings(make_docs(shared_rows), with_factors=True).select("row.doc_id", "out.*").collect()
    of = {r["doc_id"]: r for r in out}
    assert [(f["length"], f["source"]) for f in of[201]["factors"]] == [(60, 150), (55, 150)]
    assert of[2]["factors"] == []


def test_factors_are_greedy_and_may_overlap():
    """Phrases 3 to 5 lie in one text in a row, 6 in another, 9 elsewhere."""
    here, doc = np.array([3, 4, 5, 6, 9]), np.zeros(5, int)
    start, length, first = factors(here, doc, np.array([7, 7, 7, 8, 8]), np.array([10, 11, 12, 40, 43]), 4)
    assert start.tolist() == [3, 6, 9] and length.tolist() == [6, 4, 4] and first.tolist() == [0, 3, 4]


def test_few_factors_hold_the_words_of_all():
    rng = np.random.default_rng(6)
    for _ in range(200):
        here = np.flatnonzero(rng.random(300) < rng.choice([0.05, 0.5, 1]))
        found = factors(here, here // 150, rng.integers(0, 3, len(here)), np.arange(len(here)) * rng.integers(1, 3, len(here)), 10)
        start, length, _ = needed(*found)
        words = [set().union(*(range(a, a + n) for a, n in zip(*x, strict=True))) for x in (found[:2], (start, length))]
        assert words[0] == words[1] and len(start) <= 2 * len(words[0]) / 10 + 1
    assert all(len(x) == 0 for x in needed(*(np.empty(0, np.int64),) * 3))


def test_repeated_words_make_few_factors(spark, make_docs):
    """Every phrase of a word that is repeated has the same earliest place."""
    rows = [(1, " ".join(["x y"] * 30)), (2, " ".join(["x y"] * 500))]
    out = {r["row"]["doc_id"]: r["out"] for r in dedup_substrings(make_docs(rows), with_factors=True).collect()}
    assert out[2]["n_removed"] == 1000 and len(out[2]["factors"]) <= 1 + 2 * 1000 // 50
    assert got(dedup_substrings(make_docs(rows))) == sorted(map(str, plain(rows, 50)))


def test_words_decide_and_not_hashes():
    words = b"a b c d e f g h".split()
    assert equal_runs(words, 1, b"b c d e".split(), 2) == [(1, 4)]
    assert equal_runs(words, 1, b"b c X e f g".split(), 2) == [(1, 2), (4, 3)]
    assert equal_runs(words, 1, b"b X d X f".split(), 2) == []


def test_removal_comes_from_the_factors(spark, make_docs, shared_rows, monkeypatch):
    """Without factors nothing is removed; with words that differ neither."""
    monkeypatch.setattr(substrings, "factors", lambda here, *rest: (here[:0],) * 3)
    assert {r["out"]["n_removed"] for r in dedup_substrings(make_docs(shared_rows)).collect()} == {0}


def test_empty(spark, make_docs):
    assert dedup_substrings(make_docs([])).collect() == []


def test_phrase_hashes_tell_phrases_apart():
    h = np.random.default_rng(4).integers(0, 1 << 63, 500, dtype=np.uint64)
    h = np.concatenate((h, h[100:200]))
    p = phrase_hashes(h, 50)
    assert (p[500:551] == p[100:151]).all() and len(np.unique(p)) == len(p) - 51


def test_packing():
    rng = np.random.default_rng(5)
    for n in (0, 1, 1000):
        keys = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        assert (ex.unpack_keys(ex.pack_keys(keys)) == keys).all()
        for top in (1, 1 << 10, 1 << 62):
            x = rng.integers(-top, top, n)
            assert (ex.unpack_ints(ex.pack_ints(x)) == x).all()
    ends = np.array([np.iinfo(np.int64).min // 2, np.iinfo(np.int64).max // 2])
    assert (ex.unpack_ints(ex.pack_ints(ends)) == ends).all()


def test_anchors_are_even_over_the_buckets():
    text = " ".join(f"word{i}" for i in range(40_000))
    rows = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["doc_id", "text"])
    keys = np.unique(Block(rows, 0, 1, WINDOW).anchors())
    sizes = np.bincount((keys // np.uint64(ex._span(8))).astype(int))
    assert sizes.max() < 1.3 * sizes.mean()
