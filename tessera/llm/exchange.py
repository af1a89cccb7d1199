"""Counts and least values of keys over a whole corpus, asked for by blocks.

Documents are handled in blocks of bounded size. A block sends each distinct
key once, with what it knows of it; keys go to buckets by range of their
64-bit hash, a bucket joins what all blocks know and answers each block in the
order of its keys. A key that fills a third of the corpus is one entry per
block, and the buckets are as many as the number of keys asks for, so neither
side grows with one key or with the input.

A row holds what one block asks of one bucket, and only buckets that it has
keys of get one. Long rows are compressed one by one, column by column. Where
buckets are so many that rows are short, the bytes of all rows are made at
once and cut, a key and its values side by side, so that the cost follows the
number of keys and not that of the buckets.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_KEYS = 500_000

TALLY = -1  # the block number of tallies

LONG = 64  # keys of a row, on average, from which rows are compressed one by one

# `first` is the least key of the bucket, as a signed number; `shape` has the
# widths of a short row's entries, and is empty for a long one.
REQUEST = "bucket int, block long, first long, shape binary, keys binary, known binary"
REPLY = "block long, kind int, bucket int, shape binary, reply binary"
_REQUEST = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("shape", pa.binary()), ("keys", pa.binary()), ("known", pa.binary())])


def _plain(column: pa.Array) -> pa.Array:
    """A string column without nulls, large and not a slice."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if column.offset:  # Arrow lower-cases slices of large strings wrongly
        column = pa.concat_arrays([column, column.slice(0, 0)])
    return column


def split_words(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """ASCII white-space words of a string column, end to end: a number for
    each word, where each row's words start (and the last end), and the
    words that the numbers stand for. Null has no words."""
    column = _plain(column)
    split = pc.ascii_split_whitespace(pc.ascii_lower(column) if lower else column)
    coded = split.flatten().dictionary_encode()
    number, offsets = coded.indices.to_numpy().astype(np.int64), split.offsets.to_numpy().astype(np.int64)
    empty = pc.index(coded.dictionary, "").as_py()  # before the first or behind the last white space
    if empty >= 0:
        kept = number != empty
        offsets = np.concatenate(([0], np.cumsum(kept)))[offsets]
        number = number[kept]
    return number, offsets, coded.dictionary


def count_words(column: pa.Array) -> np.ndarray:
    """How many ASCII white-space words each row has."""
    column = _plain(column)
    if not len(column):
        return np.empty(0, np.int64)
    _, offsets, data = column.buffers()
    edge = np.frombuffer(offsets, np.int64)[: len(column) + 1]
    text = np.frombuffer(data, np.uint8)[edge[0] : edge[-1]] if data is not None else np.empty(0, np.uint8)
    blank = (text == 0x20) | ((text >= 0x09) & (text <= 0x0D))
    begins = ~blank
    begins[1:] &= blank[:-1]
    first = (edge[:-1] - edge[0])[np.diff(edge) > 0]  # words do not run across rows
    begins[first] = ~blank[first]
    return np.diff(np.concatenate(([0], np.cumsum(begins)))[edge - edge[0]])


def word_hashes(words: pa.Array) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x) for x in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pack_ints(values: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes of the least width."""
    low = int(values.min()) if len(values) else 0
    spread = values.astype(np.int64) - low
    top = int(spread.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - (w == 8)))
    return struct.pack("<qB", low, width) + zstandard.ZstdCompressor(level=1).compress(spread.astype(f"<u{width}").tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    low, width = struct.unpack_from("<qB", data)
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[9:]), f"<u{width}").astype(np.int64) + low


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys as differences of the least width."""
    step = np.diff(keys, prepend=keys[:1]) if len(keys) else keys
    width = max(1, (int(step.max()).bit_length() + 7) // 8) if len(keys) else 1
    raw = np.ascontiguousarray(step.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    return struct.pack("<QB", int(keys[0]) if len(keys) else 0, width) + raw.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    first, width = struct.unpack_from("<QB", data)
    raw = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64) + np.uint64(first)


def _span(buckets: int) -> int:
    """Keys that a bucket's range covers."""
    return -(-(1 << 64) // buckets)


def _width(values: np.ndarray) -> int:
    return max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1


def _bytes(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of each value, a row each."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]


def _whole(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, : raw.shape[1]] = raw
    return wide.view("<u8").ravel()


def _slices(raw: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Rows of bytes as one binary value for each start."""
    offsets = np.concatenate((starts, [len(raw)])).astype(np.int64) * raw.shape[1]
    data = pa.py_buffer(np.ascontiguousarray(raw).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), data]).cast(pa.binary())


class _Values:
    """Columns of whole numbers as short rows: their least value (or 0) and
    width make the shape, the bytes of an entry lie side by side."""

    @staticmethod
    def pack(columns: list[np.ndarray], starts: np.ndarray) -> tuple[bytes, pa.Array]:
        shape, raw = [], []
        for x in columns:
            x = x.astype(np.int64)
            low = min(0, int(x.min())) if len(x) else 0
            width = _width((x - low).astype(np.uint64))
            shape.append(struct.pack("<qB", low, width))
            raw.append(_bytes(x - low, width))
        return b"".join(shape), _slices(np.concatenate(raw, axis=1) if raw else np.empty((0, 1), np.uint8), starts)

    @staticmethod
    def unpack(shape: bytes, data: bytes) -> list[np.ndarray]:
        columns = [struct.unpack_from("<qB", shape, at) for at in range(0, len(shape), 9)]
        raw = np.frombuffer(data, np.uint8).reshape(-1, sum(w for _, w in columns))
        out, at = [], 0
        for low, width in columns:
            out.append(_whole(raw[:, at : at + width]).astype(np.int64) + low)
            at += width
        return out

    @staticmethod
    def entry(shape: bytes) -> int:
        """Bytes of an entry."""
        return sum(shape[8::9])


def _long_values(columns: list[np.ndarray], starts: np.ndarray, stops: np.ndarray) -> list[bytes]:
    out = []
    for a, z in zip(starts.tolist(), stops.tolist(), strict=True):
        parts = [pack_ints(x[a:z]) for x in columns]
        out.append(struct.pack(f"<B{len(parts)}I", len(parts), *map(len, parts)) + b"".join(parts))
    return out


def no_requests() -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in _REQUEST], schema=_REQUEST)


def requests(block: int, keys: np.ndarray, known: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """Rows that ask the buckets for ``keys`` (sorted, distinct), with an
    array of whole numbers known for them each."""
    if not len(keys):
        return no_requests()
    span = _span(buckets)
    bucket = (keys // np.uint64(span)).astype(np.int64) if span < 1 << 64 else np.zeros(len(keys), np.int64)
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    stops = np.concatenate((starts[1:], [len(keys)]))
    first = bucket[starts].astype(np.uint64) * np.uint64(span % (1 << 64))
    n = len(starts)
    if len(keys) >= LONG * n:
        shape = [b""] * n
        packed = pa.array([pack_keys(keys[a:z]) for a, z in zip(starts.tolist(), stops.tolist(), strict=True)], pa.binary())
        values = pa.array(_long_values(known, starts, stops), pa.binary())
    else:
        step = np.diff(keys, prepend=keys[:1])
        step[starts] = keys[starts] - first
        width = _width(step)
        packed = _slices(_bytes(step, width), starts)
        of, values = _Values.pack(known, starts)
        shape = [bytes((width,)) + of] * n
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[starts], pa.int32()), pa.array(np.full(n, block, np.int64)), pa.array(first.view(np.int64)), pa.array(shape, pa.binary()), packed, values],
        schema=_REQUEST,
    )


def _long_known(data: bytes) -> list[np.ndarray]:
    n = data[0]
    sizes = struct.unpack_from(f"<{n}I", data, 1)
    out, at = [], 1 + 4 * n
    for size in sizes:
        out.append(unpack_ints(data[at : at + size]))
        at += size
    return out


def _by_shape(shapes: list[bytes]) -> dict[bytes, list[int]]:
    by: dict[bytes, list[int]] = {}
    for i, shape in enumerate(shapes):
        by.setdefault(shape, []).append(i)
    return by


def _gather(size: np.ndarray, parts: list[tuple[list[int], list[np.ndarray]]], columns: int, kind: type) -> list[np.ndarray]:
    """Columns of all rows in their order, from groups of rows."""
    start = np.cumsum(size) - size
    out = [np.empty(int(size.sum()), kind) for _ in range(columns)]
    for rows, found in parts:
        n = size[rows]
        spot = np.repeat(start[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        for x, y in zip(out, found, strict=True):
            x[spot] = y
    return out


def _asked(bucket: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Number of keys of each request, all keys, and what is known of them."""
    first = bucket.column("first").to_numpy().view(np.uint64)
    shapes, keys, known = (bucket.column(c).to_pylist() for c in ("shape", "keys", "known"))
    size, parts, values = np.zeros(len(keys), np.int64), [], []
    for shape, rows in _by_shape(shapes).items():
        if not shape:
            mine = [unpack_keys(keys[i]) for i in rows]
            size[rows] = [len(x) for x in mine]
            parts.append((rows, [np.concatenate(mine)]))
            values.append((rows, [np.concatenate(x) for x in zip(*[_long_known(known[i]) for i in rows], strict=True)]))
            continue
        width = shape[0]
        n = np.array([len(keys[i]) for i in rows]) // width
        size[rows] = n
        step = _whole(np.frombuffer(b"".join([keys[i] for i in rows]), np.uint8).reshape(-1, width))
        total = np.cumsum(step, dtype=np.uint64)
        begin = np.cumsum(n) - n
        parts.append((rows, [total + np.repeat(first[rows] - (total[begin] - step[begin]), n)]))
        values.append((rows, _Values.unpack(shape[1:], b"".join([known[i] for i in rows]))))
    (every,) = _gather(size, parts, 1, np.uint64)
    return size, every, _gather(size, values, len(values[0][1]), np.int64)


def answer(
    asked: DataFrame, kind: int, join: Callable[[list[np.ndarray], np.ndarray], list[np.ndarray]],
    tally: Callable[[np.ndarray, list[np.ndarray]], int] | None = None,
) -> DataFrame:
    """Replies to ``asked`` (``REQUEST``). ``join`` gets what all blocks know
    of a bucket's keys, sorted by key, with the places where a new key starts,
    and returns arrays with an entry per distinct key; each block is sent
    those entries for its keys. ``tally`` makes a number of a bucket's distinct
    keys and their entries, see ``tallied``."""

    def run(bucket: pa.Table) -> pa.Table:
        blocks, buckets = bucket.column("block").to_pylist(), bucket.column("bucket").to_pylist()
        size, every, known = _asked(bucket)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        starts = np.flatnonzero(new)
        joined = join([k[order] for k in known], starts)
        place = np.empty(len(every), np.int64)
        place[order] = np.cumsum(new) - 1
        begin = np.cumsum(size) - size
        if len(every) >= LONG * len(size):
            shape, told = b"", _long_values([x[place] for x in joined], begin, begin + size)
        else:
            shape, told = _Values.pack([x[place] for x in joined], begin)
            told = told.to_pylist()
        if tally:
            blocks.append(TALLY)
            buckets.append(buckets[0])
            told.append(struct.pack("<q", tally(ranked[starts], joined)))
        return pa.table({
            "block": pa.array(blocks, pa.int64()), "kind": pa.array([kind] * len(blocks), pa.int32()), "bucket": pa.array(buckets, pa.int32()),
            "shape": pa.array([shape] * len(blocks), pa.binary()), "reply": pa.array(told, pa.binary()),
        })

    return asked.groupBy("bucket").applyInArrow(run, REPLY)


def tallied(told: DataFrame) -> int:
    """Sum of the tallies: one number per bucket comes to the driver."""
    return sum(struct.unpack("<q", r["reply"])[0] for r in told.where(F.col("block") == TALLY).select("reply").toLocalIterator())


def replies(rows: pa.Table, kind: int, n: int, keys: int) -> list[np.ndarray]:
    """A block's replies of a kind, joined in the order of its keys: ``n``
    arrays with an entry for each of ``keys`` keys."""
    mine = rows.filter(pc.equal(rows.column("kind"), kind)).sort_by("bucket")
    shapes, told = mine.column("shape").to_pylist(), mine.column("reply").to_pylist()
    size, parts = np.zeros(len(told), np.int64), []
    for shape, at in _by_shape(shapes).items():
        if shape:
            size[at] = np.array([len(told[i]) for i in at]) // _Values.entry(shape)
            parts.append((at, _Values.unpack(shape, b"".join([told[i] for i in at]))))
        else:
            found = [_long_known(told[i]) for i in at]
            size[at] = [len(x[0]) for x in found]
            parts.append((at, [np.concatenate(x) for x in zip(*found, strict=True)]))
    out = _gather(size, parts, n, np.int64)
    if any(len(x) != keys for x in out):
        raise ValueError("replies and keys differ in number")
    return out


def pack_rows(batch: pa.RecordBatch) -> bytes:
    """A batch as compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_rows(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_all().combine_chunks().to_batches()[0]


def bucket_count(keys: int, each: int = BUCKET_KEYS) -> int:
    return max(8, -(-keys // each))


def per_block(blocks: DataFrame, told: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """``run`` on every block and the replies to it."""
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)


def total(df: DataFrame, *columns: str) -> list[int]:
    return [int(x or 0) for x in df.agg(*[F.sum(c) for c in columns]).first()]
