"""Token counts of records in packed blocks.

In long form, a row for each token of each record, weights cost a shuffle of
all rows by token (to look up the IDF) and one by record (for the norm). Here
records lie in blocks, rows of an id in one of them, that hold their counts as
compressed arrays and each distinct token once. A block asks for its distinct
tokens only, and what is made of a record (weights, norm, unit weights, rests)
is made inside its block. ``meet`` brings the other side's postings to the
blocks, so that the postings of the packed side are never rows of a table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import in_blocks, ship, trim
from tessera.operators.cells import Run
from tessera.plans.joins import lookup_join
from tessera.plans.stored import indexed

# Bytes of token lists in a block.
BLOCK_BYTES = 32 << 20

# Postings of the other side that meet a block in one task.
MEETING_POSTINGS = 1_000_000

_ARRAYS = ("record", "length", "held", "code", "n")
_PACKED = pa.schema([("tokens", pa.list_(pa.string())), ("df", pa.list_(pa.int32())), ("postings", pa.int64()), ("ids", pa.binary()), *[(x, pa.binary()) for x in _ARRAYS]])
_SCHEMA = "tokens array<string>, df array<int>, postings long, ids binary, " + ", ".join(f"{x} binary" for x in _ARRAYS)


def _squeeze(values: np.ndarray) -> bytes:
    """32-bit numbers as compressed planes of bytes."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _stretch(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _pack_ids(ids: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([ids], ["id"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack_ids(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_all().combine_chunks().to_batches()[0].column(0)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Places where a new key starts, of sorted keys."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))


def _counted(ids: pa.Array, lists: pa.Array) -> pa.RecordBatch:
    """The packed block of some records' token lists. Rows of an id that are
    equally long count together, as groups by (id, token, length) do."""
    length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(lists.flatten())
    tokens, v = coded.dictionary, max(1, len(coded.dictionary))
    code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    key = np.repeat(np.arange(len(length)) * v, length) + code
    key = np.sort(key[code >= 0])
    start = _starts(key)
    n, key = np.diff(np.append(start, len(key))), key[start]
    df = np.bincount(key % v, minlength=len(tokens))

    named = pc.dictionary_encode(ids, null_encoding="encode")
    no = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    record, size = no, length
    if len(named.dictionary) < len(ids):
        both = np.stack((no, length), axis=1)
        groups, of = np.unique(both, axis=0, return_inverse=True)
        record, size = groups[:, 0], groups[:, 1]
        key = of.ravel()[key // v] * v + key % v
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        start = _starts(key)
        n, key = np.add.reduceat(n, start) if len(n) else n, key[start]
    group, code = key // v, key % v
    held = np.bincount(group, minlength=len(record))
    step = np.diff(code, prepend=0)
    first = _starts(group)
    step[first] = code[first]
    arrays = {"record": record, "length": size, "held": held, "code": step, "n": n}
    return pa.RecordBatch.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array([0, len(tokens)], pa.int32()), tokens.cast(pa.string())),
            pa.ListArray.from_arrays(pa.array([0, len(df)], pa.int32()), pa.array(df, pa.int32())),
            pa.array([len(n)], pa.int64()), pa.array([_pack_ids(named.dictionary)], pa.binary()), *[pa.array([_squeeze(arrays[x])], pa.binary()) for x in _ARRAYS],
        ],
        schema=_PACKED,
    )


def _whole_ids(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted ids, cut anew where an id ends."""
    rest: pa.RecordBatch | None = None
    for block in blocks:
        held = pa.Table.from_batches([block] if rest is None else [rest, block]).combine_chunks().to_batches()[0]
        ids = held.column("id")
        last = ids[len(ids) - 1]
        other = ids.is_valid() if not last.is_valid else pc.fill_null(pc.not_equal(ids, last), True)
        cut = int(np.flatnonzero(np.append(True, other.to_numpy(zero_copy_only=False)))[-1])
        if cut:
            yield held.slice(0, cut)
        rest = held.slice(cut)
    if rest is not None:
        yield rest


@dataclass(frozen=True)
class Packed:
    """Token counts of one side: ``frame`` has a row for each block, numbered
    from 0 in ``block``."""

    frame: DataFrame
    id_type: T.DataType
    n_records: int  # different ids that are not null
    n_blocks: int
    postings: int

    def frequencies(self) -> DataFrame:
        """(token, n): rows that hold the token, a row for each block."""
        return self.frame.select(F.explode(F.arrays_zip("tokens", "df")).alias("e")).select(
            F.col("e.tokens").alias("token"), F.col("e.df").cast("bigint").alias("n")
        )


def packed(tokens: DataFrame, name: str) -> Packed:
    """(id, tokens) in packed blocks, stored. Rows are dealt out by their id
    only if an id comes more than once."""
    ship(tokens.sparkSession)
    ids = tokens.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("distinct")).first()
    repeats = ids["n"] != ids["distinct"]
    rows = tokens.select("id", "tokens")
    if repeats:
        rows = rows.repartition("id").sortWithinPartitions("id")
    limit = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = in_blocks((b for b in batches if b.num_rows), limit)
        for block in _whole_ids(blocks) if repeats else blocks:
            yield _counted(block.column("id"), block.column("tokens"))
        trim()

    frame = indexed(rows.mapInArrow(run, _SCHEMA), "block", name)
    made = frame.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("postings"), F.lit(0)).alias("postings")).first()
    return Packed(frame, tokens.schema["id"].dataType, ids["distinct"], made["blocks"], made["postings"])


def _weighed(row: pa.Table, told: pa.Table, names: Sequence[str], values: Sequence[str], meets: str | None) -> tuple[pa.Array, pa.Array, dict[str, np.ndarray]]:
    """Ids, tokens and ``values`` of a block's postings, those whose token
    has rows in ``meets`` (all without it). Tokens without an IDF have none."""
    tokens = row.column("tokens").chunk(0).flatten()
    ids = _unpack_ids(row.column("ids")[0].as_py())
    record, length, held, code, n = (_stretch(row.column(x)[0].as_py()) for x in _ARRAYS)
    group = np.repeat(np.arange(len(held)), held)
    total = np.cumsum(code)
    begin = np.cumsum(held) - held
    some = held > 0
    before = np.zeros(len(held), np.int64)
    before[some] = total[begin[some]] - code[begin[some]]
    code = total - before[group]

    place = told.column("place").to_numpy()
    v = len(tokens)
    of = {x: np.zeros(v, told.column(x).to_numpy().dtype) for x in ("idf", *names)}
    known = np.zeros(v, bool)
    known[place] = True
    for x in of:
        of[x][place] = told.column(x).to_numpy()
    if not known.all():
        kept = known[code]
        group, code, n = group[kept], code[kept], n[kept]
    record = record[group]
    made = {x: of[x] for x in names}
    weight = n / length[group] * of["idf"][code]
    out = {"weight": weight}
    if {"norm", "unit", "rest"} & set(values):
        out["norm"] = np.sqrt(np.bincount(record, weight * weight, len(ids)))[record]
        out["unit"] = np.divide(weight, out["norm"], out=np.full(len(weight), np.nan), where=out["norm"] != 0)
    if "rest" in values:
        rarity = np.empty(v, np.int64)
        by_token = pc.sort_indices(tokens).to_numpy()
        rarity[by_token] = np.arange(v)
        rarity[np.lexsort((rarity, sum(made[x] for x in names)))] = np.arange(v)
        order = np.argsort(record * max(1, v) + rarity[code], kind="stable")[::-1]
        from_end = np.cumsum(np.nan_to_num(out["unit"][order]).astype(np.longdouble) ** 2)
        start = _starts(record[order])
        sizes = np.diff(np.append(start, len(order)))
        from_end -= np.repeat(np.concatenate(([0], from_end))[start], sizes) if len(order) else 0
        out["rest"] = np.empty(len(order))
        out["rest"][order] = np.sqrt(np.maximum(from_end, 0)).astype(np.float64)
    if meets:
        kept = made[meets][code] > 0
        record, code, out = record[kept], code[kept], {k: x[kept] for k, x in out.items()}
    out |= {x: made[x][code] for x in names if x in values}
    return ids.take(pa.array(record)), tokens.take(pa.array(code)), {k: out[k] for k in values}


def _column(x: np.ndarray) -> pa.Array:
    return pa.array(x, from_pandas=True)


@dataclass(frozen=True)
class Weights:
    """tf * idf of packed counts. ``told`` (asker, place, idf, df_0, ...) is
    what the blocks were told of their distinct tokens."""

    counts: Packed
    told: DataFrame
    names: tuple[str, ...]

    def _fields(self, values: Sequence[str]) -> list[T.StructField]:
        return [T.StructField(x, T.LongType() if x in self.names else T.DoubleType()) for x in values]

    def rows(self, *values: str, meets: str | None = None) -> DataFrame:
        """(id, token, values) in long form, of tokens with rows in ``meets``.
        Values are ``weight``, ``norm``, ``unit``, ``rest`` and the document
        frequencies."""
        names = self.names

        def run(block: pa.Table, told: pa.Table) -> pa.Table:
            if not block.num_rows:
                return empty
            ids, tokens, out = _weighed(block, told, names, values, meets)
            return pa.table([ids, tokens, *[_column(out[x]) for x in values]], names=["id", "token", *values])

        schema = T.StructType([T.StructField("id", self.counts.id_type), T.StructField("token", T.StringType()), *self._fields(values)])
        empty = _empty(schema)
        return self.counts.frame.groupBy("block").cogroup(self.told.groupBy("asker")).applyInArrow(run, schema)

    def token_sums(self, value: str, name: str, meets: str) -> DataFrame:
        """(token, ``name``): sums of ``value`` by token, added up in blocks first."""
        names = self.names

        def run(block: pa.Table, told: pa.Table) -> pa.Table:
            if not block.num_rows:
                return empty
            _, tokens, out = _weighed(block, told, names, [value], meets)
            coded = pc.dictionary_encode(tokens)
            there = ~np.isnan(out[value])
            sums = np.bincount(coded.indices.to_numpy()[there], out[value][there], len(coded.dictionary))
            return pa.table([coded.dictionary, pa.array(sums.astype(np.float64))], names=["token", "s"])

        schema = T.StructType([T.StructField("token", T.StringType()), T.StructField("s", T.DoubleType())])
        empty = _empty(schema)
        parts = self.counts.frame.groupBy("block").cogroup(self.told.groupBy("asker")).applyInArrow(run, schema)
        return parts.groupBy("token").agg(F.sum("s").alias(name))

    def meet(self, other: DataFrame, postings: int, values: Sequence[str], run: Run, schema: T.StructType) -> DataFrame:
        """What ``run`` makes of the cells of a block join with ``other``
        (b_id, token, values), which has about so many ``postings``: a block
        of records and a part of the other side's. The other side is copied to
        all blocks, and the packed side to as many tasks as there are parts."""
        names, parts = self.names, max(1, -(-postings // MEETING_POSTINGS))

        def cell(block: pa.Table, met: pa.Table) -> pa.Table:
            if not block.num_rows:
                return empty
            own = pc.is_valid(met.column("place"))
            ids, tokens, out = _weighed(block, met.filter(own), names, values, "df_1")
            mine = pa.table([ids, tokens, *[_column(out[x]) for x in values]], names=["a_id", "token", *values])
            return run(mine, met.filter(pc.invert(own)).select(["b_id", "token", *values]))

        def every(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n > 1 else F.lit(0)

        empty = _empty(schema)
        part = F.pmod(F.xxhash64("b_id"), F.lit(parts)).cast("int")
        told = self.told.withColumn("part", every(parts))
        others = other.withColumn("_asker", every(self.counts.n_blocks)).withColumn("part", part).withColumn("asker", F.col("_asker").cast("bigint")).drop("_asker")
        met = told.unionByName(others, allowMissingColumns=True)
        blocks = self.counts.frame.withColumn("part", every(parts))
        return blocks.groupBy("block", "part").cogroup(met.groupBy("asker", "part")).applyInArrow(cell, schema)


def _empty(schema: T.StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema).empty_table()


def weights(counts: Packed, idf: DataFrame) -> Weights:
    """Weights of ``counts`` by the IDF of their tokens; a block is told those
    of its distinct tokens."""
    names = tuple(c for c in idf.columns if c.startswith("df_"))
    # A name and a column of its own: both sides of a join come from these blocks.
    asked = counts.frame.select(F.col("block").alias("asker"), F.posexplode("tokens").alias("place", "token"))
    told = lookup_join(asked, idf.select("token", "idf", *names), "token").select("asker", "place", "idf", *names)
    return Weights(counts, told, names)
