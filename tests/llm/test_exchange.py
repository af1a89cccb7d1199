"""The exchange of keys against dictionaries."""

import time

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import exchange as ex


def exchanged(asked, join, kind=7):
    """What ``answer`` does, without Spark."""
    seen = {}

    class Told:
        def groupBy(self, _):
            return self

        def applyInArrow(self, run, _):
            whole = pa.Table.from_batches(asked)
            for b in set(whole.column("bucket").to_pylist()):
                seen[b] = run(whole.filter(pa.compute.equal(whole.column("bucket"), b)))
            return self

    ex.answer(Told(), kind, join)
    return pa.concat_tables(seen.values())


@pytest.mark.parametrize("buckets", [1, 3, 8, 1000, 100_000])
def test_counts_of_blocks(buckets):
    rng = np.random.default_rng(buckets)
    pool = np.concatenate((rng.integers(0, 1 << 64, 3000, np.uint64), np.array([0, 1, (1 << 64) - 1], np.uint64)))
    blocks = {}
    for block in range(6):
        keys = np.unique(rng.choice(pool, 2000 if block else 5))
        blocks[block] = keys, rng.integers(-5, 1 << (8 * block + 1), len(keys)), rng.integers(0, 3, len(keys))
    blocks[6] = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    asked = [ex.requests(b, k, [x, y], buckets) for b, (k, x, y) in blocks.items()]
    assert all(len(set(a.column("bucket").to_pylist())) == a.num_rows for a in asked)
    told = exchanged(asked, lambda known, new: [np.add.reduceat(known[0], new), np.maximum.reduceat(known[1], new)])
    total, most = {}, {}
    for k, x, y in blocks.values():
        for key, a, b in zip(k.tolist(), x.tolist(), y.tolist(), strict=True):
            total[key], most[key] = total.get(key, 0) + a, max(most.get(key, 0), b)
    for b, (k, _, _) in blocks.items():
        got = ex.replies(told.filter(pa.compute.equal(told.column("block"), b)), 7, 2, len(k))
        assert got[0].tolist() == [total[x] for x in k.tolist()] and got[1].tolist() == [most[x] for x in k.tolist()]


def test_cost_follows_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 1_000_000, np.uint64))
    ones = np.ones(len(keys), np.int64)
    ex.requests(0, keys[:1000], [ones[:1000]], 100)
    took = {}
    for buckets in (100, 100_000, 10_000_000):
        start = time.process_time()
        made = ex.requests(0, keys, [ones], buckets)
        took[buckets] = time.process_time() - start
        assert made.nbytes < 60 * len(keys)
    assert took[100_000] < 1 and took[10_000_000] < 3  # a fraction of that on a free machine


def test_words_of_a_slice():
    """Arrow 23 misreads slices of strings that were made large."""
    texts = [f"Ab{i} É {'x' * (i % 50)} Cd\n{i}" for i in range(4000)] + [None, ""]
    whole = pa.array(texts)
    for at, n in ((0, 10), (500, 500), (3990, 12)):
        number, offsets, words = ex.split_words(whole.slice(at, n), lower=True)
        words = words.to_pylist()
        got = [[words[x] for x in number[a:z]] for a, z in zip(offsets, offsets[1:], strict=False)]
        assert got == [[w.replace("A", "a").replace("C", "c") for w in (t or "").split()] for t in texts[at : at + n]]
        assert ex.count_words(whole.slice(at, n)).tolist() == [len((t or "").split()) for t in texts[at : at + n]]
    odd = ["a", "", "b c", None, " d ", "\t\n", "e", "\x0bf\x1cg h"]
    assert ex.count_words(pa.array(odd)).tolist() == [len((t or "").encode().split()) for t in odd]
    assert ex.count_words(pa.array([], pa.string())).tolist() == [] and ex.count_words(pa.array([None], pa.string())).tolist() == [0]
