"""Deleted interpolation against a plain model over dictionaries."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import lm


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def fold(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5


class Plain:
    """Counts in dictionaries, and the same rules for weights."""

    def __init__(self, rows, order):
        self.order = order
        train = [self.padded(t) for i, t in rows if fold(i) != 1]
        kept = [self.padded(t) for i, t in rows if fold(i) not in (1, 2)]
        gone = [self.padded(t) for i, t in rows if fold(i) == 2]
        self.count, self.n = self.counts(train)
        self.words = sum(1 for g, c in self.count.items() if len(g) == 1 and g[0] != "<s>")
        self.uniform = 1 / (self.words + 1)
        count, n = self.counts(kept)
        cells = Counter()
        for seq in gone:
            for at in range(order - 1, len(seq)):
                bucket, p = self.estimates(seq, at, count, n)
                cells[bucket, tuple(lm._bins(np.array(p), self.uniform).tolist())] += 1
        keys = sorted(cells)
        self.weights = lm.learn_weights(np.array([k[0] for k in keys]), np.array([k[1] for k in keys]), np.array([cells[k] for k in keys], float)) if keys else {}

    def padded(self, text):
        return ["<s>"] * (self.order - 1) + tokens(text)

    def counts(self, seqs):
        count, n = Counter(), 0
        for seq in seqs:
            n += len(seq) - self.order + 1
            for k in range(1, self.order + 1):
                count.update(tuple(seq[i : i + k]) for i in range(len(seq) - k + 1))
        return count, n

    def estimates(self, seq, at, count, n):
        p, bucket = [count[(seq[at],)] / max(n, 1)], 0
        for k in range(2, self.order + 1):
            seen = count[tuple(seq[at - k + 1 : at])]
            p.append(count[tuple(seq[at - k + 1 : at + 1])] / seen if seen else 0.0)
            if seen:
                bucket = (k - 1) * 64 + int(math.log2(seen))
        return bucket, p

    def score(self, text):
        seq, total, base, known = self.padded(text), 0.0, 0.0, 0
        for at in range(self.order - 1, len(seq)):
            bucket, p = self.estimates(seq, at, self.count, self.n)
            w = lm._weights(self.weights, np.array([bucket]), self.order)[0]
            total += math.log10(w[0] * self.uniform + float(np.dot(w[1:], p)))
            c = self.count[(seq[at],)]
            known += c > 0
            base += math.log10((c + 0.5) / (self.n + 0.5 * (self.words + 1)))
        return len(seq) - self.order + 1, known, self.n, base, total


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_dictionaries(spark, make_docs, odd_rows, order):
    rng = np.random.default_rng(6)
    rows = [r for r in odd_rows if len(r[1] or "") < 5000]
    rows += [(1000 + i, " ".join(f"W{x}" for x in np.minimum(rng.geometric(0.1, rng.integers(0, 60)), 40))) for i in range(120)]
    plain = Plain(rows, order)
    got = lm.score(make_docs(rows).repartition(3), order).collect()
    assert len(got) == len(rows)
    want = sorted(((str(i), fold(i) == 1, *plain.score(t)) for i, t in rows), key=lambda r: (r[0], r[2], r[5]))
    have = sorted(((str(r["doc_id"]), *tuple(r)[1:]) for r in got), key=lambda r: (r[0], r[2], r[5]))
    for a, b in zip(have, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in rows) > 0.9 * sum(r["base_score"] for r in rows)


def test_estimates_of_a_context_add_up():
    """Over the vocabulary and one unknown word a context's estimates sum to 1."""
    rows = [(i, t) for i, t in enumerate(["a b a c", "a b b", "c a b", "b", "a a a", "c c b a", "a b c a b c", "b a"] * 4)]
    plain = Plain([*rows, (10**6, "a")], 2)
    total = 0.0
    for w in [b"a", b"b", b"c", None, b"unknown"]:
        seq = ["<s>", w]
        bucket, p = plain.estimates(seq, 1, plain.count, plain.n)
        weight = lm._weights(plain.weights, np.array([bucket]), 2)[0]
        total += weight[0] * plain.uniform + float(np.dot(weight[1:], p))
    assert total == pytest.approx(1.0)


def test_empty_and_untrained(spark, make_docs):
    assert lm.score(make_docs([])).collect() == []
    held = next(i for i in range(100) if fold(i) == 1)
    (r,) = lm.score(make_docs([(held, "never seen")])).collect()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)
