"""Approximate nearest neighbours over shifted space-filling curves.

Every curve projects the vectors on a few random directions of its own, shifts
them by a random part of the range and orders them by their place on a Hilbert
curve. The order is made by a range partitioning of keys alone; the rows of a
partition and the counts of those before it give each vector its rank. Ranks
cut the order in blocks, a query visits all blocks that its window of ranks
touches, and meets every vector there in full. The best of all curves' windows
are merged and ranked by exact distances.

One turn is a number of curves. After each, recall is audited: a bounded sample
of the query vectors is compared with all vectors. Until it reaches the target
another turn follows, with new curves and a window twice as wide; a window as
wide as the table finds everything, so the turns end.

Equal vectors are one node, which knows its least ids, as many as a result can
need. So thousands of copies neither fill a window nor are met in pairs, and
ties between them are broken exactly. In a block at most its own 2,048 vectors
are held, while the queries stream past.

Distances are Euclidean, in double precision, of the original vectors.

Defined cases: rows whose vector is null, empty, zero or holds null or
non-finite entries, or whose id is null, take no part; vectors of unlike length
are no candidates for each other; rows that repeat id and vector count once, an
id with several vectors asks once with each, and no row of the query's own id
is its candidate; fewer than ten candidates are all returned; distances beyond
double's range are infinite; empty tables give empty results; other columns
are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialise, ship, table
from tessera.llm.vectors import by_length

NEAREST = 10
CURVES = 8  # of a turn
WINDOW = 1024  # ranks to either side, in the first turn
AXES = 8
BITS = 7  # of an axis; AXES * BITS must fit a long
BLOCK = 2048
AUDIT = 256
RECALL = 0.93

FOUND = "asker binary, node binary, least long, distance double"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of the cells (rows of whole numbers below
    2^bits): the reflections and exchanges of each level of the curve are
    undone from the coarsest on, then the Gray code is decoded."""
    x = [c.astype(np.int64) for c in cells.T]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i, axis in enumerate(x):
            upper = (axis >> level & 1).astype(bool)
            swap = np.where(upper, 0, (x[0] ^ axis) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = axis ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= (x[-1] >> level & 1) * ((1 << level) - 1)
    place = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            place = place << 1 | ((axis ^ flip) >> level & 1)
    return place


def coded(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id``, node (a 128-bit hash of the entries), length and entries of
    each row that takes part; single precision entries stay so."""
    kind = "<f4" if isinstance(rows.schema[vec_col].dataType.elementType, T.FloatType) else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, v in by_length(batch.column(1)):
                some = v.any(axis=1)
                at, v = at[some], v[some] + 0.0  # no negative zeros
                if len(at):
                    vec = [x.tobytes() for x in v.astype(kind)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(at)), pa.array([xxhash.xxh3_128_digest(x) for x in vec], pa.binary()),
                            pa.array(np.full(len(at), v.shape[1], np.int32)), pa.array(vec, pa.binary()),
                        ],
                        ["vec_id", "node", "size", "vec"],
                    )

    taking = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v")).where("vec_id IS NOT NULL")
    return taking.mapInArrow(run, "vec_id long, node binary, size int, vec binary")


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors of ``size`` entries; the bytes tell the precision."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, "<f4" if len(joined) == 4 * size * len(column) else "<f8").reshape(len(column), size).astype(np.float64)


def _sized(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    size = batch.column("size").to_numpy()
    for n in np.unique(size).tolist():
        yield n, batch.filter(pa.array(size == n))


def _draw(curve: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and shifts of a curve."""
    rng = np.random.Generator(np.random.PCG64([curve, size]))
    return rng.standard_normal((size, AXES)) / np.sqrt(size), rng.uniform(0, 1, AXES)


def _scales(nodes: DataFrame, curves: range) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Mean and deviation of the vectors on each direction, by curve and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for n, mine in _sized(batch):
                v = _matrix(mine.column("vec"), n)
                for curve in curves:
                    y = v @ _draw(curve, n)[0]
                    made = np.stack([np.full(AXES, len(v), float), y.sum(axis=0), (y * y).sum(axis=0)])
                    total[curve, n] = total.get((curve, n), 0) + made
        for (curve, n), made in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([curve] * AXES), pa.array([n] * AXES), pa.array(range(AXES)), *(pa.array(x) for x in made)], ["curve", "size", "axis", "n", "s", "ss"]
            )

    parts = nodes.select("size", "vec").mapInArrow(run, "curve long, size long, axis long, n double, s double, ss double")
    found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for r in parts.groupBy("curve", "size", "axis").agg(*(F.sum(c).alias(c) for c in ("n", "s", "ss"))).collect():
        mean, spread = found.setdefault((r["curve"], r["size"]), (np.zeros(AXES), np.ones(AXES)))
        mean[r["axis"]] = r["s"] / r["n"]
        spread[r["axis"]] = np.sqrt(max(0.0, r["ss"] / r["n"] - mean[r["axis"]] ** 2)) or 1.0
    return found


def _ranks(nodes: DataFrame, curves: range) -> DataFrame:
    """``curve``, ``size``, ``node``, ``place`` from 0 among the vectors of one length on
    the curve, and their number ``total``."""
    scales = _scales(nodes, curves)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, mine in _sized(batch):
                v = _matrix(mine.column("vec"), n)
                for curve in curves:
                    direction, shift = _draw(curve, n)
                    mean, spread = scales[curve, n]
                    # Three deviations to either side and a shift of one at most; what is beyond lies in the outmost cells.
                    at = np.nan_to_num(((v @ direction - mean) / spread + 3) / 7 + shift / 7)
                    cells = np.clip(at * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(v), curve)), mine.column("size"), pa.array(hilbert(cells, BITS)), mine.column("node")], ["curve", "size", "key", "node"]
                    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part)), pa.array(np.arange(done, done + n)), *(batch.column(c) for c in ("curve", "size", "node"))], ["part", "at", "curve", "size", "node"]
            )
            done += n

    order = ["curve", "size", "key", "node"]
    keys = nodes.select("node", "size", "vec").mapInArrow(keyed, "curve long, size int, key long, node binary")
    ordered = keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(placed, "part long, at long, curve long, size int, node binary")
    ordered = materialise(ordered, "ordered")
    # One row for each partition, and for each curve and length that begins in it.
    runs = ordered.groupBy("part", "curve", "size").agg(F.count("*").alias("rows"), F.min("at").alias("from")).orderBy("part", "from").collect()
    total: dict[tuple[int, int], int] = {}
    for r in runs:
        total[r["curve"], r["size"]] = total.get((r["curve"], r["size"]), 0) + r["rows"]
    before, begins = dict.fromkeys(total, 0), []
    for r in runs:
        own = r["curve"], r["size"]
        begins.append((r["part"], *own, before[own] - r["from"], total[own]))
        before[own] += r["rows"]
    begins = nodes.sparkSession.createDataFrame(begins, "part long, curve long, size int, begin long, total long")
    return ordered.join(F.broadcast(begins), ["part", "curve", "size"]).select("curve", "size", "node", (F.col("at") + F.col("begin")).alias("place"), "total")


def _closest(asked: np.ndarray, known: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For some queries after others: their numbers, the numbers of their ``k``
    nearest (ties to the least id) and the distances."""
    step = max(1, (8 << 20) // (8 * known.size))
    for a in range(0, len(asked), step):
        with np.errstate(over="ignore"):
            apart = np.sqrt(((asked[a : a + step, None] - known[None]) ** 2).sum(axis=2))
        order = np.lexsort((np.broadcast_to(least, apart.shape), apart))[:, :k]
        rows = np.repeat(np.arange(len(apart)), order.shape[1])
        yield a + rows, order.ravel(), apart[rows, order.ravel()]


def _search(nodes: DataFrame, ranks: DataFrame, window: int, k: int) -> DataFrame:
    """The ``k`` nearest that each query meets in each block, as ``FOUND``."""
    first = F.greatest(F.lit(0), F.least(F.col("place") - window, F.col("total") - 1 - 2 * window))
    last = F.least(F.col("total") - 1, first + 2 * window)
    cell = lambda place: F.floor(place / BLOCK).cast("long")
    visits = F.transform(F.sequence(cell(first), cell(last)), lambda b: F.struct(b.alias("block"), F.lit(True).alias("asks")))
    stays = F.array(F.struct(cell(F.col("place")).alias("block"), F.lit(False).alias("asks")))
    met = ranks.join(nodes, ["node", "size"]).select(
        "curve", "size", "node", "least", "vec", F.explode(F.when(F.col("asks"), F.concat(stays, visits)).otherwise(stays)).alias("visit")
    )
    met = met.select("curve", "size", "visit.block", "visit.asks", "node", "least", "vec")
    block = ["curve", "size", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, known = None, [], None
        for batch in batches:
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            sort = np.stack([*(batch.column(c).to_numpy().astype(np.int64) for c in block), asks.astype(np.int64)])
            cuts = np.flatnonzero((sort[:, 1:] != sort[:, :-1]).any(axis=0)) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True) if batch.num_rows else ():
                part = batch.slice(a, z - a)
                if at != (here := tuple(sort[:3, a].tolist())):
                    at, held, known = here, [], None
                if not asks[a]:
                    held.append(part.select(["node", "least", "vec"]))
                    continue
                if known is None:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    known = (whole.column("node").chunk(0), whole.column("least").to_numpy(), _matrix(whole.column("vec").chunk(0), at[1]))
                for who, near, apart in _closest(_matrix(part.column("vec"), at[1]), known[2], known[1], k):
                    yield pa.RecordBatch.from_arrays(
                        [part.column("node").take(pa.array(who)), known[0].take(pa.array(near)), pa.array(known[1][near]), pa.array(apart)], ["asker", "node", "least", "distance"]
                    )

    return met.repartition(*block).sortWithinPartitions(*block, "asks").mapInArrow(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest distinct nodes of each query."""
    each = found.groupBy("asker", "node").agg(F.min("least").alias("least"), F.min("distance").alias("distance"))
    place = F.row_number().over(Window.partitionBy("asker").orderBy("distance", "least"))
    return each.withColumn("place", place).where(F.col("place") <= k).drop("place")


def _sample(nodes: DataFrame, audit: int, k: int) -> dict[bytes, list[float]]:
    """Of ``audit`` query vectors the distances of their ``k`` nearest, from all vectors."""
    some = nodes.where("asks").orderBy(F.xxhash64("node"), "node").limit(audit).select("node", "size", "vec").collect()
    asked = {n: ([bytes(r["node"]) for r in some if r["size"] == n], pa.array([bytes(r["vec"]) for r in some if r["size"] == n], pa.binary())) for n in {r["size"] for r in some}}
    shared = nodes.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, mine in _sized(batch):
                if n in shared.value:
                    names, vec = shared.value[n]
                    v = _matrix(mine.column("vec"), n)
                    for a in range(0, len(v), BLOCK):
                        for who, _, apart in _closest(_matrix(vec, n), v[a : a + BLOCK], mine.column("least").to_numpy()[a : a + BLOCK], k):
                            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in who.tolist()], pa.binary()), pa.array(apart)], ["asker", "distance"])

    all_of = nodes.select("size", "least", "vec").mapInArrow(run, "asker binary, distance double")
    place = F.row_number().over(Window.partitionBy("asker").orderBy("distance"))
    true: dict[bytes, list[float]] = {}
    for r in all_of.withColumn("place", place).where(F.col("place") <= k).collect():
        true.setdefault(bytes(r["asker"]), []).append(r["distance"])
    return true


def _recall(best: DataFrame, true: dict[bytes, list[float]]) -> float:
    """Share of the audited queries' nearest that were found, itself apart."""
    if not true:
        return 1.0
    asked = best.sparkSession.createDataFrame([(bytearray(x),) for x in true], "asker binary")
    met: dict[bytes, int] = {}
    for r in best.join(F.broadcast(asked), "asker").collect():
        key = bytes(r["asker"])
        met[key] = met.get(key, 0) + (r["distance"] <= max(true[key]))
    wanted = sum(len(x) - 1 for x in true.values())
    return sum(max(0, min(met.get(k, 0), len(x)) - 1) for k, x in true.items()) / wanted if wanted else 1.0


def nearest(
    rows: DataFrame, asks: Column | None = None, k: int = NEAREST, id_col: str = "vec_id", vec_col: str = "embedding",
    curves: int = CURVES, window: int = WINDOW, recall: float = RECALL, audit: int = AUDIT,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (distance) of the
    ``k`` nearest rows of each query (the rows of which ``asks``, a condition
    on ``vec_id``, holds; else all), and ``recall``, the audited share."""
    ship(rows.sparkSession)
    asks = F.lit(True) if asks is None else asks
    of = materialise(coded(rows, id_col, vec_col).withColumn("asks", F.coalesce(asks, F.lit(False))), "vectors")
    nodes = of.groupBy("node", "size").agg(F.min("vec_id").alias("least"), F.max("asks").alias("asks"), F.first("vec").alias("vec"))
    nodes = materialise(nodes, "nodes")
    true = _sample(nodes, audit, k + 1)
    best, turn, reached = None, 0, 0.0
    n = nodes.count()
    while True:
        ranks = _ranks(nodes, range(turn * curves, (turn + 1) * curves))
        found = _search(nodes, ranks, window << turn, k + 1)
        best = materialise(_best(found if best is None else best.union(found), k + 1), "best")
        reached = _recall(best, true)
        if reached >= recall or window << turn >= n:
            break
        turn += 1
    # Of a node no more than its k + 1 least ids can be among the nearest.
    ids = of.select("node", "vec_id").distinct()
    few = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    ids = materialise(ids.withColumn("place", few).where(F.col("place") <= k + 1).select("node", "vec_id"), "ids")
    near = best.join(ids, "node").select("asker", "vec_id", "distance")
    near = near.withColumn("place", F.row_number().over(Window.partitionBy("asker").orderBy("distance", "vec_id"))).where(F.col("place") <= k + 1)
    near = materialise(near.drop("place"), "near")
    asking = of.where("asks").select(F.col("vec_id").alias("query_id"), F.col("node").alias("asker")).distinct()
    pairs = asking.join(near, "asker").where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "asker").orderBy("distance", "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("distance").alias("score"), F.lit(reached).alias("recall")
    )


def op12_shifted_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
