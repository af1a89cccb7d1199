"""Language-model scoring with deleted interpolation.

The model mixes maximum-likelihood estimates of n-grams of all orders and a
uniform estimate over the vocabulary and one unknown word. The weights depend
on how often the context was seen: a bucket is the length of the longest
context that occurs in training and the binary logarithm of its count. They
are learned by expectation-maximisation on tokens of training documents that
were deleted from the counts (fold ``DELETED`` of the id's hash); the model
then uses the counts of all training documents.

For the weights, a held-out token is no more than its bucket and its
estimates' ratios to the uniform one. These are gathered in a histogram with
``STEPS`` steps per octave, whose size depends on the model's order alone, and
the iterations run on that. Counts themselves cover the whole corpus and stay
with the executors: blocks of documents ask for the counts of their distinct
n-grams (``exchange``), keyed by 62-bit hashes.

Defined cases: a null or empty text is its end token alone; ids are hashed as
text, a null id as the empty text, and rows of equal id are kept; without
training documents all estimates are uniform; an empty table gives an empty
result; other columns are left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import exchange as ex
from tessera.llm.common import in_blocks, materialise, table, trim

ORDER = 2
FOLDS, HELD_OUT, DELETED = 5, 1, 2
BLOCK = 4 << 20
STEPS = 8
ITERATIONS = 60
BUCKET_KEYS = 1_000_000
COUNTS = 1
# Marks that no word can be: they hold a blank.
_START, _END = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"start of text", b"end of text"))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def folds(ids: pa.Array) -> np.ndarray:
    """Fold of each id, by the hash of its text."""
    return np.array([zlib.crc32(b"" if x is None else str(x).encode()) % FOLDS for x in ids.to_pylist()], np.int64)


class Grams:
    """N-grams of all orders of a block's documents. A document is ``order -
    1`` start marks, its words and an end mark, all documents end to end."""

    def __init__(self, ids: pa.Array, texts: pa.Array, order: int):
        number, offsets, words = ex.split_words(texts, lower=True)
        fold = folds(ids)
        self.held_out, self.order = fold == HELD_OUT, order
        self.tokens = np.diff(offsets) + 1
        size = self.tokens + order - 1
        self.ends = np.cumsum(size)
        starts = self.ends - size
        n = int(size.sum())
        inner = np.arange(n) - np.repeat(starts, size)  # place in the document
        hashes = np.full(n, _START)
        word = inner >= order - 1
        word[self.ends - 1] = False
        if len(number):
            hashes[word] = ex.word_hashes(words)[number]
        hashes[self.ends - 1] = _END
        train, deleted = np.repeat(~self.held_out, size), np.repeat(fold == DELETED, size)
        self.predicted = np.flatnonzero(inner >= order - 1)
        self.deleted = deleted[self.predicted]
        keys, self.at = [], []
        gram, total = ex.mix(hashes), 0
        for k in range(1, order + 1):
            if k > 1:
                gram = np.concatenate((np.zeros(1, np.uint64), ex.mix(gram[:-1] * _ODD + hashes[1:])))
            there = np.flatnonzero(inner >= k - 1)
            key = (gram[there] & ~np.uint64(3)) | np.uint64(min(k, 3))
            if k == 1:
                key = np.where(inner[there] < order - 1, key & ~np.uint64(3), key)  # the start mark is no token
            place = np.full(n, -1)
            place[there] = total + np.arange(len(there))
            self.at.append(place)
            keys.append(key)
            total += len(there)
        del gram, hashes, number, words, word
        self._there = np.concatenate([np.flatnonzero(a >= 0) for a in self.at])
        every = np.concatenate(keys)
        del keys
        # Distinct keys by hash; only these are sorted.
        code, distinct = pd.factorize(every)
        del every
        rank = np.argsort(distinct)
        self.keys = distinct[rank]
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        self.inverse = place[code]
        self._train, self._deleted = train, deleted

    def counts(self) -> list[np.ndarray]:
        """Per distinct n-gram: how often in training documents that stay, and
        in those that are deleted."""
        stays, goes = (self._train & ~self._deleted)[self._there], (self._train & self._deleted)[self._there]
        return [np.bincount(self.inverse[x], minlength=len(self.keys)) for x in (stays, goes)]

    def estimates(self, count: np.ndarray, n: int, which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For predicted tokens (those of mask ``which``): the bucket, the
        estimates of orders 1 and up (0 where the context is new), and the
        token's own count."""
        spot = self.predicted if which is None else self.predicted[which]
        c = [count[self.inverse[a[spot]]] for a in self.at]
        context = [count[self.inverse[a[spot - 1]]] for a in self.at[:-1]]
        p = [c[0] / max(n, 1), *[np.divide(x, y, out=np.zeros(len(spot)), where=y > 0) for x, y in zip(c[1:], context, strict=True)]]
        level, seen = np.zeros(len(spot), np.int64), np.zeros(len(spot), np.int64)
        for k, x in enumerate(context, 1):
            there = x > 0
            level[there] = k
            seen[there] = np.log2(x[there]).astype(np.int64)
        return level * 64 + seen, np.stack(p, axis=1), c[0]


def _bins(p: np.ndarray, uniform: float) -> np.ndarray:
    """Steps of an octave above or below the uniform estimate; least value for
    an estimate of zero."""
    out = np.full(p.shape, -(1 << 15), np.int64)
    there = p > 0
    out[there] = np.rint(np.log2(p[there] / uniform) * STEPS).astype(np.int64)
    return out


def learn_weights(bucket: np.ndarray, bins: np.ndarray, count: np.ndarray, iterations: int = ITERATIONS) -> dict[int, np.ndarray]:
    """Mixture weights (uniform first) per bucket by expectation-maximisation
    over a histogram. A bucket starts from the weights of its level's buckets
    together, which also count as ten tokens of evidence."""
    ratio = np.where(bins > -(1 << 15), 2.0 ** (np.maximum(bins, -200 * STEPS) / STEPS), 0.0)
    p = np.concatenate((np.ones((len(ratio), 1)), ratio), axis=1)

    def run(rows: np.ndarray, weights: np.ndarray, prior: float) -> np.ndarray:
        first = weights
        for _ in range(iterations):
            part = p[rows] * weights
            part *= (count[rows] / part.sum(axis=1))[:, None]
            weights = part.sum(axis=0) + prior * first
            weights /= weights.sum()
        return weights

    out = {}
    even = np.full(p.shape[1], 1 / p.shape[1])
    for level in np.unique(bucket // 64):
        base = run(bucket // 64 == level, even, 0.0)
        base = np.maximum(base, 1e-9) / np.maximum(base, 1e-9).sum()
        out[int(level) * 64 - 1] = base  # for buckets that were never seen
        for b in np.unique(bucket[bucket // 64 == level]):
            out[int(b)] = run(bucket == b, base, 10.0)
    return out


def _weights(table: dict[int, np.ndarray], bucket: np.ndarray, order: int) -> np.ndarray:
    out = np.empty((len(bucket), order + 1))
    for b in np.unique(bucket):
        level = int(b) // 64
        w = table.get(int(b), table.get(level * 64 - 1))
        if w is None:  # no held-out token had a context of this length
            w = np.where(np.arange(order + 1) <= level + 1, 1.0, 0.0)
            w = w / w.sum()
        out[bucket == b] = w
    return out


def score(
    docs: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score`` (logarithms to base 10)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(in_blocks(batches, BLOCK)):
            fold, tokens = folds(batch.column(0)), ex.count_words(batch.column(1)) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + i]), pa.array([int(tokens.sum())]), pa.array([int(tokens[fold != HELD_OUT].sum())]),
                    pa.array([int(tokens[fold == DELETED].sum())]), pa.array([ex.pack_rows(batch)], pa.binary()),
                ],
                ["block", "tokens", "train", "deleted", "rows"],
            )

    blocks = materialise(rows.mapInArrow(cut, "block long, tokens long, train long, deleted long, rows binary"), "lm-blocks")
    tokens, train, deleted = ex.total(blocks, "tokens", "train", "deleted")
    buckets = ex.bucket_count(order * tokens, BUCKET_KEYS)
    bodies = blocks.select("block", "rows")

    def open_block(data: bytes) -> tuple[pa.RecordBatch, Grams]:
        batch = ex.unpack_rows(data)
        return batch, Grams(batch.column(0), batch.column(1), order)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0), batch.column(1), strict=True):
                grams = open_block(data.as_py())[1]
                keys, counts = grams.keys, grams.counts()
                del grams
                yield ex.requests(block.as_py(), keys, counts, buckets)
                del keys, counts
                trim()

    def add(known: list[np.ndarray], new: np.ndarray) -> list[np.ndarray]:
        return [np.add.reduceat(x, new) for x in known]

    def words(keys: np.ndarray, joined: list[np.ndarray]) -> int:
        return int((((keys & np.uint64(3)) == 1) & (joined[0] + joined[1] > 0)).sum())

    told = materialise(ex.answer(bodies.mapInArrow(ask, ex.REQUEST), COUNTS, add, words), "lm-counts")
    distinct = ex.tallied(told)
    uniform = 1 / (distinct + 1)

    def histogram(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["bucket", *[f"b{k}" for k in range(1, order + 1)], "n"]
        found = np.empty((0, order + 2), np.int64)
        if left.num_rows:
            grams = open_block(left.column("rows")[0].as_py())[1]
            stays, _ = ex.replies(right, COUNTS, 2, len(grams.keys))
            if grams.deleted.any():
                bucket, p, _ = grams.estimates(stays, train - deleted, grams.deleted)
                cells, n = np.unique(np.column_stack((bucket, _bins(p, uniform))), axis=0, return_counts=True)
                found = np.column_stack((cells, n))
            del grams
            trim()
        return pa.table({name: pa.array(found[:, i]) for i, name in enumerate(names)})

    fields = ["bucket", *[f"b{k}" for k in range(1, order + 1)]]
    cells = ex.per_block(bodies, told, histogram, ", ".join(f"{f} long" for f in [*fields, "n"]))
    cells = np.array([tuple(r) for r in cells.groupBy(*fields).agg(F.sum("n").alias("n")).collect()], np.int64).reshape(-1, order + 2)
    cells = cells[np.lexsort(cells.T[::-1])]
    weights = spark.sparkContext.broadcast(learn_weights(cells[:, 0], cells[:, 1:-1], cells[:, -1].astype(float)) if len(cells) else {})

    out = pa.schema([
        ("doc_id", rows_type(docs, id_col)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return out.empty_table()
        batch, grams = open_block(left.column("rows")[0].as_py())
        stays, goes = ex.replies(right, COUNTS, 2, len(grams.keys))
        bucket, p, c = grams.estimates(stays + goes, train)
        w = _weights(weights.value, bucket, order)
        mixed = np.log10(w[:, 0] * uniform + (w[:, 1:] * p).sum(axis=1) if train else np.full(len(c), uniform))
        base = np.log10((c + 0.5) / (train + 0.5 * (distinct + 1)))
        first = np.cumsum(grams.tokens) - grams.tokens
        n = len(grams.tokens)
        columns = [
            batch.column(0), pa.array(grams.held_out), pa.array(grams.tokens), pa.array(np.add.reduceat(c > 0, first, dtype=np.int64)),
            pa.array(np.full(n, train)), pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(mixed, first)),
        ]
        made = pa.table(columns, schema=out)
        del grams, bucket, p, c, w, mixed, base, stays, goes
        trim()
        return made

    id_type = docs.schema[id_col].dataType.simpleString()
    return ex.per_block(
        bodies, told, finish,
        f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def rows_type(docs: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[column].dataType)


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
