"""Embedding near-duplicates by NN-descent.

Vectors of one direction are one node. Lists of nearest nodes start from blocks of nodes
with equal signs under random hyperplanes (several draws; a block that is too
large is dealt out by hash, anew in each draw) and are refined by joins of
neighbours with neighbours: around each node, its neighbours and those that
name it meet and every one keeps the best it meets. A list that is saturated,
its last entry still being a link, is enlarged for the next round. Links at or
above the threshold are the edges of the graph.

Lists cannot hold all links of a dense group, so they do not decide which are
found. Once there are components, blocks of as many draws as make a pair at the
threshold meet with the chance ``RECALL`` are searched for links between
different components, and here no block is dealt out: one that is too large is
cut in tiles, and all pairs of tiles meet but those inside one component. At
the end each component is compared in full, tile by tile, and gives every node
the exact number of its links without listing pairs.

Recall is audited against brute force: nodes are drawn by how many links were
found, those without any too, and the share of true links found is taken by
node and by link for each range of true numbers of links. The least of these
shares counts, so a dense group cannot hide losses of small ones. While it is
too low, or no audited node has a link, another round of new draws follows;
after ``rounds`` of them a recall that is too low is an error, and one without
evidence (hardly any vector has a link) is null.

Cosines of links are taken in double precision; lists use single precision.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are their own components; vectors of unlike
length do not link; rows of equal id are kept, a null id is never the least of
a component; empty tables give empty results; other columns are left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise, ship, table
from tessera.llm.components import components
from tessera.plans.joins import lookup_join

THRESHOLD = 0.9
LIST = 10
MOST = 40  # entries of a list, which bounds what meets in a join
BLOCK = 512
DRAWS = 8
JOINS = 2
ROUNDS = 4
RECALL = 0.98
AUDIT = 1000
TILE = 2048

NODES = "vec_id long, node long, size int, vec binary"
LINKS = "a long, b long, cos float"


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of single or double precision vectors of one length."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def nodes(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Each row's id, node (null if its vector is none) and unit vector as
    double precision bytes. The node is a hash of the vector's direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, vec = [], [], []
            for x in batch.column(1).to_pylist():
                v = None if x is None or None in x else np.array(x, np.float64)
                top = 0.0 if v is None or not len(v) or not np.isfinite(v).all() else float(np.abs(v).max())
                if not top:
                    node.append(None)
                    size.append(None)
                    vec.append(None)
                    continue
                v = v / top  # so that no square over- or underflows
                node.append(xxhash.xxh64_intdigest(v.tobytes()) - (1 << 63))
                size.append(len(v))
                vec.append((v / np.linalg.norm(v)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(node, pa.int64()), pa.array(size, pa.int32()), pa.array(vec, pa.binary())], ["vec_id", "node", "size", "vec"]
            )

    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v")).mapInArrow(run, NODES)


def _groups(df: DataFrame, run: Callable[[list[np.ndarray], np.ndarray], list[tuple]], schema: str, names: list[str]) -> DataFrame:
    """``run`` on each group of rows of one ``key``: node numbers, vectors."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            key = part.column("key").to_numpy()
            whole = int(np.searchsorted(key, key[-1]))
            held = part.slice(whole)
            if whole:
                yield from cut(part.slice(0, whole), key[:whole])
        if held is not None:
            yield from cut(held, held.column("key").to_numpy())

    def cut(part: pa.Table, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        others = [part.column(c).to_numpy() for c in part.column_names[1:-1]]
        vec = part.column(part.num_columns - 1).to_pylist()
        out = []
        for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if z - a > 1:
                v = np.frombuffer(b"".join(vec[a:z]), np.float64).reshape(z - a, -1)
                out += run([x[a:z] for x in others], v)
        if out:
            cols = [np.concatenate(x) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

    return df.repartition("key").sortWithinPartitions("key").mapInArrow(each, schema)


def _best(node: np.ndarray, v: np.ndarray, k: int, threshold: float) -> list[tuple]:
    """Every node's ``k`` best in a group, and a star of links for each of the
    group's components."""
    cos = v @ v.T
    np.fill_diagonal(cos, -2)
    k = min(k, len(node) - 1)
    top = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    who = np.repeat(np.arange(len(node)), k)
    return [(node[who], node[top.ravel()], cos[who, top.ravel()].astype(np.float32)), *_stars(node, cos >= threshold)]


def _stars(node: np.ndarray, near: np.ndarray) -> list[tuple]:
    """A star of links for each component of a group."""
    out = []
    left = np.flatnonzero(near.any(axis=1))
    while len(left):
        root, edge, left = left[0], left[:1], left[1:]
        while len(edge) and len(left):
            met = near[np.ix_(edge, left)].any(axis=0)
            edge, left = left[met], left[~met]
            # Links of a star: marked by a cosine above any other.
            out.append((np.full(len(edge), node[root]), node[edge], np.full(len(edge), 2, np.float32)))
    return out


def _bits(count: int) -> int:
    """Hyperplanes of a draw."""
    return max(0, int(np.ceil(np.log2(max(1, count / BLOCK)))) + 1)


def _draws(bits: int, threshold: float) -> int:
    """Draws after which two nodes at the threshold have met in a block with
    the chance ``RECALL``."""
    meet = max(1e-9, (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** bits)
    return 1 if meet >= RECALL else int(np.ceil(np.log(1 - RECALL) / np.log1p(-meet)))


def _keyed(vectors: DataFrame, bits: int, first: int, draws: int) -> DataFrame:
    """``key`` of each node's block in ``draws`` draws, beside its columns."""
    rest = [c for c in vectors.columns if c not in ("size", "vec")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column("size").to_numpy()
            for n in np.unique(size):
                mine = batch.filter(pa.array(size == n))
                v = _vectors(mine.column("vec"))
                for draw in range(first, first + draws):
                    planes = np.random.Generator(np.random.PCG64([draw, int(n)])).standard_normal((int(n), bits))
                    code = ((v @ planes > 0) << np.arange(bits)).sum(axis=1) if bits else np.zeros(len(v), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(v), draw)), pa.array(code.astype(np.int64)), *[mine.column(c) for c in ("size", *rest, "vec")]],
                        ["draw", "code", "size", *rest, "vec"],
                    )

    schema = "draw long, code long, size int, " + "".join(f"{c} long, " for c in rest) + "vec binary"
    keyed = vectors.select("size", *rest, "vec").mapInArrow(run, schema)
    return keyed.select(F.xxhash64("size", "draw", "code").alias("key"), *rest, "vec")


def _blocks(vectors: DataFrame, bits: int, first: int, draws: int) -> DataFrame:
    """Nodes in blocks of equal signs under random hyperplanes, ``draws``
    times; a block of more than two times ``BLOCK`` is dealt out by hash."""
    keyed = _keyed(vectors.select("node", "size", "vec"), bits, first, draws)
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"))
    parts = F.when(F.col("n") > 2 * BLOCK, F.ceil(F.col("n") / BLOCK)).otherwise(1)
    return lookup_join(keyed, sizes, "key").select(F.xxhash64("key", F.pmod(F.xxhash64("node", "key"), parts)).alias("key"), "node", "vec")


def _borders(placed: DataFrame, bits: int, first: int, draws: int, threshold: float, small: bool) -> DataFrame:
    """Links between different components (``c``) in the blocks of ``draws``
    draws. A block of more than two times ``BLOCK`` is cut in tiles, those of
    a component that fills a tile apart from the others; all tiles of a block
    meet but two of one component. Other blocks are left out unless ``small``."""
    keyed = _keyed(placed.select("node", "c", "size", "vec"), bits, first, draws)
    byc = keyed.groupBy("key", "c").agg(F.count("*").alias("m"))
    heavy = F.col("m") > BLOCK
    large = byc.groupBy("key").agg(F.sum("m").alias("n"), F.sum(F.when(~heavy, F.col("m"))).alias("others")).where(F.col("n") > 2 * BLOCK)
    cut = lookup_join(byc, large, "key").select(
        "key", "c", heavy.alias("heavy"), F.when(heavy, F.col("c")).otherwise(F.lit(0)).alias("kind"),
        F.ceil(F.when(heavy, F.col("m")).otherwise(F.col("others")) / BLOCK).cast("int").alias("parts"),
    )
    cut = materialise(cut, "cut")
    kinds = cut.select("key", F.struct("heavy", "kind").alias("kind"), "parts").distinct()
    pairs = kinds.join(kinds.select("key", F.col("kind").alias("kind2"), F.col("parts").alias("parts2")), "key").where(
        "kind < kind2 OR (kind = kind2 AND NOT kind.heavy)"
    )
    pairs = pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = pairs.withColumn("j", F.explode(F.sequence(F.when(F.col("kind") == F.col("kind2"), F.col("i")).otherwise(F.lit(0)), F.col("parts2") - 1)))
    pairs = pairs.withColumn("group", F.xxhash64("key", "kind", "i", "kind2", "j"))
    tiles = pairs.select("key", "kind", F.col("i").alias("tile"), "group").union(
        pairs.where("kind < kind2 OR i < j").select("key", F.col("kind2").alias("kind"), F.col("j").alias("tile"), "group")
    ).select("key", F.col("kind.heavy").alias("heavy"), F.col("kind.kind").alias("kind"), "tile", "group")
    known = keyed.join(cut, ["key", "c"], "left" if small else "inner")
    met = (
        known.where("parts IS NOT NULL").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .join(tiles, ["key", "heavy", "kind", "tile"]).select(F.col("group").alias("key"), "node", "c", "vec")
    )
    if small:
        met = met.union(known.where("parts IS NULL").select("key", "node", "c", "vec"))

    def run(cols: list[np.ndarray], v: np.ndarray) -> list[tuple]:
        node, c = cols
        return [x[:2] for x in _stars(node, (v @ v.T >= threshold) & (c[:, None] != c[None, :]))]

    return _groups(met, run, "a long, b long", ["a", "b"])


def _top(found: DataFrame, length: DataFrame | None) -> DataFrame:
    """Lists: the best distinct entries of each node, ``LIST`` or the enlarged
    length that ``length`` gives for some nodes."""
    best = found.where("a != b").groupBy("a", "b").agg(F.max("cos").alias("cos"))
    ranked = best.withColumn("place", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cos"), "b"))).where(F.col("place") <= MOST)
    if length is None:
        return ranked.where(F.col("place") <= LIST).drop("place")
    return ranked.join(length, "a", "left").where(F.col("place") <= F.coalesce("k", F.lit(LIST))).drop("place", "k")


def _enlarged(lists: DataFrame, threshold: float) -> DataFrame:
    """New list lengths, twice the old one, of nodes whose last entry is a link."""
    last = lists.groupBy("a").agg(F.count("*").alias("n"), F.min("cos").alias("least"))
    return last.where((F.col("least") >= threshold) & (F.col("n") >= LIST)).select("a", F.least(F.lit(MOST), 2 * F.col("n")).alias("k"))


def _join(lists: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """Neighbours of neighbours: around each node meet its list, the best of
    those that list it, and itself."""
    back = lists.select(F.col("b").alias("a"), F.col("a").alias("b"), "cos")
    back = back.withColumn("place", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cos"), "b"))).where(F.col("place") <= LIST)
    meet = (
        lists.select("a", "b").union(back.select("a", "b")).union(lists.select("a", F.col("a").alias("b"))).distinct()
        .select(F.col("a").alias("key"), F.col("b").alias("node"))
    )
    rows = meet.join(vectors.select("node", "vec"), "node").select("key", "node", "vec")
    return _groups(rows, lambda other, v: _best(other[0], v, 4, threshold), LINKS, ["a", "b", "cos"])


def _tiles(members: DataFrame, threshold: float) -> DataFrame:
    """Exact number of links of every node inside its component. Components
    (``c``, ``total`` nodes) larger than ``TILE`` are cut in tiles, and each
    pair of tiles is a group of its own."""
    n = F.ceil(F.col("total") / F.lit(TILE)).cast("int")
    mine = F.pmod(F.xxhash64("node"), n).cast("int")
    dealt = members.select("c", "node", "copies", "vec", mine.alias("i"), F.explode(F.sequence(F.lit(0), n - 1)).alias("j"))
    key = F.xxhash64("c", F.least("i", "j"), F.greatest("i", "j"))
    dealt = dealt.select(key.alias("key"), "node", F.col("copies").cast("long").alias("copies"), "i", (F.col("i") == F.col("j")).cast("int").alias("same"), "vec")

    def run(cols: list[np.ndarray], v: np.ndarray) -> list[tuple]:
        node, copies, tile, same = cols
        links = np.zeros(len(node), np.int64)
        for a in range(0, len(node), 1024):
            near = v[a : a + 1024] @ v.T >= threshold
            if not same.any():
                near &= tile[a : a + 1024, None] != tile[None, :]
            near[np.arange(len(near)), a + np.arange(len(near))] = False
            links[a : a + 1024] = near @ copies
        return [(node, links)]

    return _groups(dealt, run, "node long, links long", ["node", "links"]).groupBy("node").agg(F.sum("links").alias("links"))


def _rank(links: Column) -> Column:
    """Range of a number of links: 0, 1 to 3, 4 to 15, 16 to 63, ..."""
    return F.when(links > 0, F.floor(F.log(4.0, links.cast("double")) + 1e-9) + 1).otherwise(0).cast("int")


def _audit(vectors: DataFrame, counted: DataFrame, threshold: float, queries: int, turn: int = 0) -> float | None:
    """Least share of their true links that sampled nodes were found to have,
    over ranges of the true number, each by node and by link. About
    ``queries`` nodes are drawn of those without found links and as many of
    all others, in equal numbers of each range of the found number; a node
    counts as the nodes it stands for. Null if no node of a sample has links."""
    base = vectors.join(counted, "node", "left").withColumn("links", F.coalesce("links", F.lit(0)))
    base = base.select("node", "size", "vec", "links", _rank(F.col("links")).alias("rank"))
    numbers = {r["rank"]: r["count"] for r in base.groupBy("rank").count().collect()}
    each = -(-queries // max(1, len(numbers) - (0 in numbers)))
    rate = {k: min(1.0, (each if k else queries) / n) for k, n in numbers.items()}
    if not rate:
        return 1.0
    chance = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 40)) / float(1 << 40)
    wanted_rate = F.lit(0.0)
    for k, x in rate.items():
        wanted_rate = F.when(F.col("rank") == k, F.lit(x)).otherwise(wanted_rate)
    some = base.where(chance < wanted_rate).collect()
    by_size = {n: ([r["node"] for r in some if r["size"] == n], np.stack([np.frombuffer(r["vec"], np.float64) for r in some if r["size"] == n])) for n in {r["size"] for r in some}}
    shared = vectors.sparkSession.sparkContext.broadcast(by_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, node, copies = (batch.column(i).to_numpy() for i in (1, 0, 3))
            for n, (asked, matrix) in shared.value.items():
                mine = np.flatnonzero(size == n)
                if not len(mine):
                    continue
                # A cosine that is the threshold but for rounding may be either.
                near = matrix @ _vectors(batch.column(2).take(pa.array(mine))).T >= threshold + 1e-12
                near &= np.array(asked)[:, None] != node[mine][None, :]
                yield pa.RecordBatch.from_arrays([pa.array(asked, pa.int64()), pa.array(near @ copies[mine].astype(np.int64))], ["node", "links"])

    sums = vectors.select("node", "size", "vec", "copies").mapInArrow(run, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    wanted = {r["node"]: r["links"] for r in sums.where("links > 0").collect()}
    strata: dict[int, list[tuple[float, int, int]]] = {}
    for r in some:
        if true := wanted.get(r["node"]):
            strata.setdefault((true.bit_length() + 1) // 2, []).append((1 / rate[r["rank"]], min(true, r["links"]), true))
    shares = [1.0] if len(some) == sum(numbers.values()) else []
    for rows in strata.values():
        weight, found, true = (np.array(x, float) for x in zip(*rows, strict=True))
        shares += [float(weight @ (found / true) / weight.sum()), float(weight @ found / (weight @ true))]
    return min(shares, default=None)


def near_duplicates(
    rows: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding", draws: int = DRAWS, rounds: int = ROUNDS, audit: int = AUDIT
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other vectors linked
    directly), ``component_id`` (least id that links reach), ``kept`` and
    ``recall`` (of the last audit)."""
    ship(rows.sparkSession)
    of = materialise(nodes(rows, id_col, vec_col), "vectors")
    vectors = of.where("node IS NOT NULL").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("size").alias("size"), F.first("vec").alias("vec")
    )
    vectors = materialise(vectors.select("node", "size", "vec", "copies", "least"), "nodes")
    bits = _bits(vectors.count())
    enough = max(draws, _draws(bits, threshold))
    lists = length = links = recall = None
    for turn in range(rounds):
        found = _groups(
            _blocks(vectors, bits, turn * enough, draws), lambda other, v: _best(other[0], v, LIST, threshold), LINKS, ["a", "b", "cos"]
        )
        found = materialise(found, "met")
        for step in range(JOINS + 1):
            stars = found.where(F.col("cos") > 1.5).select("a", "b")
            links = stars if links is None else links.union(stars)
            fresh = found.where(F.col("cos") <= 1.5)
            lists = materialise(_top(fresh if lists is None else lists.union(fresh), length), "lists")
            length = _enlarged(lists, threshold)
            if step < JOINS:
                found = materialise(_join(lists, vectors, threshold), "met")
        links = materialise(links.distinct(), "links")
        reached = components(links)
        placed = vectors.select("node", "size", "vec").join(reached, "node", "left")
        placed = materialise(placed.select("node", "size", "vec", F.coalesce("component", "node").alias("c")), "placed")
        new = 0
        for first in range(0, enough, draws):  # a few draws at a time, for their copies of the vectors
            border = _borders(placed, bits, turn * enough + first, min(draws, enough - first), threshold, first > 0)
            border = materialise(border.distinct(), "borders")
            new += border.count()
            links = links.union(border)
        if new:
            links = materialise(links.distinct(), "links")
            reached = components(links)
        members = reached.withColumnRenamed("component", "c").join(vectors, "node")
        sizes = members.groupBy("c").agg(F.count("*").alias("total"), F.min("least").alias("component_id"))
        members = materialise(lookup_join(members, sizes, "c"), "members")
        counted = materialise(_tiles(members, threshold), "counted")
        recall = _audit(vectors, counted, threshold, audit, turn)
        if recall is not None and recall >= RECALL:
            break
    if recall is not None and recall < RECALL:
        raise RuntimeError(f"recall {recall:.4f} of the links is below {RECALL} after {rounds} rounds")
    named = vectors.select("node", "copies", "least").join(members.select("node", "component_id"), "node", "left").join(counted, "node", "left")
    named = named.select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")
    )
    return of.select("vec_id", "node").join(named, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))).withColumn("recall", F.lit(recall).cast("double"))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
