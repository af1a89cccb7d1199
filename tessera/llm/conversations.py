"""Prefix trie of conversations, with totals of every subtree.

A node is a distinct sequence of first turns (role and text). It is named by a
128-bit hash of the sequence, made turn by turn: a polynomial over digests of
the turns, modulo the prime 2^127 - 1. Hashes of pieces of a conversation can
be put together, so a conversation of any length is hashed by many tasks: turns
are range-partitioned in order, every partition numbers and hashes its runs,
and a run that goes on in the next partition hands on its length and hash (a
row for each partition passes through the driver). Texts themselves are never
shuffled, only their digests and lengths.

A trie of prefixes has long unary chains and very broad nodes. Totals of
subtrees come from parallel tree contraction (``contraction.py``).

``ends_sha256`` is a hash of a list that may hold a third of all ids. The ids
are sorted by range, joined to pieces of bounded length by many tasks, and
hashed piece by piece in a stream; no task holds the list.

Defined cases: null role and text are empty; turns are ordered by turn, null
first, equal ones by a digest of role and text; rows without conv_id are left
out; the remainder of a negative conv_id is that of a floor division; an empty
table has no root; other columns are left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, ship, table, utf8
from tessera.llm.contraction import subtree_totals

PRIME = (1 << 127) - 1
BASE = 0x2545F4914F6CDD1D9E3779B97F4A7C15 % PRIME
ROOT = 0x6A09E667F3BCC908BB67AE8584CAA73B % PRIME  # hash of no turns
STEP = 5  # conversations take their first turns from the one before with an id divisible by it
MOST = 9  # of a conversation fewer than so many first turns are taken
PIECE = 1 << 16


def _named(x: int) -> bytes:
    return x.to_bytes(16, "big")


def digests(rows: DataFrame) -> DataFrame:
    """``conv``, ``turn``, a digest of role and text, and the text's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            role, text = utf8(batch.column(2)), utf8(batch.column(3))
            made = [hashlib.blake2b(len(r).to_bytes(8, "big") + r + t, digest_size=16).digest() for r, t in zip(role, text, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made, pa.binary()), pa.array([len(t) for t in text], pa.int64())], ["conv", "turn", "digest", "size"]
            )

    whole = rows.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string"), F.col("text").cast("string"))
    return whole.where("conv IS NOT NULL").mapInArrow(run, "conv long, turn long, digest binary, size long")


def _runs(turns: DataFrame, order: list[str], name: str) -> DataFrame:
    """The turns of each conversation in ``order``: ``conv``, ``depth`` from 1,
    ``node`` and ``parent`` (hashes of the turns so far, with and without this
    one), ``digest``, ``size`` and ``last``."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, depth, state = TaskContext.get().partitionId(), None, 0, ROOT
        for batch in batches:
            depths, nodes, parents = [], [], []
            for conv, digest in zip(batch.column("conv").to_pylist(), batch.column("digest").to_pylist(), strict=True):
                if conv != at:
                    at, depth, state = conv, 0, ROOT
                parents.append(_named(state))
                depth, state = depth + 1, (state * BASE + int.from_bytes(digest, "big")) % PRIME
                depths.append(depth)
                nodes.append(_named(state))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(batch.num_rows, part)), batch.column("conv"), pa.array(depths, pa.int64()), pa.array(nodes, pa.binary()), pa.array(parents, pa.binary()), batch.column("digest"), batch.column("size")],
                ["part", "conv", "depth", "node", "parent", "digest", "size"],
            )

    schema = "conv long, depth long, node binary, parent binary, digest binary, size long"
    ranged = turns.repartitionByRange("conv", *order).sortWithinPartitions("conv", *order)
    pieces = materialise(ranged.select("conv", "digest", "size").mapInArrow(local, f"part long, {schema}"), name)
    ends = pieces.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "depth", "node")).alias("end")).orderBy("part").collect()
    carried: dict[int, tuple[int, int, int]] = {}  # by partition: conversation, length and hash that reach it
    goes_on: set[tuple[int, int]] = set()
    state: tuple[int, int, int] | None = None
    for r in ends:
        if state and state[0] == r["first"]:
            carried[r["part"]] = state
        end, depth, node = r["end"]["conv"], r["end"]["depth"], int.from_bytes(r["end"]["node"], "big")
        if r["part"] in carried and end == r["first"]:
            depth, node = state[1] + depth, (node + (state[2] - ROOT) * pow(BASE, depth, PRIME)) % PRIME
        state = end, depth, node
    for a, b in zip(ends, ends[1:], strict=False):
        if a["end"]["conv"] == b["first"]:
            goes_on.add((a["part"], b["first"]))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, conv, depth = (batch.column(c).to_numpy() for c in ("part", "conv", "depth"))
            node, parent = batch.column("node"), batch.column("parent")
            depth = depth.copy()
            for p in np.unique(part).tolist():
                if p not in carried:
                    continue
                owner, before, state = carried[p]
                at = np.flatnonzero((part == p) & (conv == owner))
                nodes, parents = node.to_pylist(), parent.to_pylist()
                for i in at.tolist():
                    shift = (state - ROOT) * pow(BASE, int(depth[i]) - 1, PRIME)
                    parents[i] = _named((int.from_bytes(parents[i], "big") + shift) % PRIME)
                    nodes[i] = _named((int.from_bytes(nodes[i], "big") + shift * BASE) % PRIME)
                    depth[i] += before
                node, parent = pa.array(nodes, pa.binary()), pa.array(parents, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(depth), node, parent, batch.column("digest"), batch.column("size")], ["conv", "depth", "node", "parent", "digest", "size"])

    return pieces.mapInArrow(whole, schema) if carried else pieces.drop("part")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All ids (``conv``), and the rebuilt conversations' turns as of ``_runs``:
    first ones from the conversation before whose id is divisible by five."""
    turns = digests(rows)
    placed = materialise(_runs(turns, ["turn", "digest"], "turns").select("conv", (F.col("depth") - 1).alias("place"), "digest", "size"), "placed")
    ids = materialise(placed.where("place = 0").select("conv"), "ids")
    taken = (F.crc32(F.col("conv").cast("string").cast("binary")) % MOST).alias("taken")
    own = placed.select("*", taken).where("place >= taken").drop("taken")
    # At most eight turns of a conversation are given, to five at most.
    wants = ids.select("conv", taken, F.expr(f"try_subtract(conv, pmod(conv, {STEP}L))").alias("source"))
    given = placed.where(F.col("place") < MOST - 1).where(F.pmod("conv", F.lit(STEP)) == 0).withColumnRenamed("conv", "source")
    given = wants.join(given, "source").where("place < taken").select("conv", "place", "digest", "size")
    return ids, materialise(_runs(own.union(given), ["place"], "rebuilt"), "prefixes")


def _joined_ids(ends: DataFrame) -> DataFrame:
    """``node`` and the SHA-256 of its ids (``conv``), ascending and joined by commas."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, held, size = None, 0, [], 0
        for batch in batches:
            out = []
            for node, conv in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist(), strict=True):
                if node != at or size >= PIECE:
                    if held:
                        out.append((at, first, ",".join(held)))
                    at, first, held, size = node, conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], schema=_PIECES)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (at, first, ",".join(held))], schema=_PIECES)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            out = []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if node != at:
                    if at is not None:
                        out.append((at, state.hexdigest()))
                    at, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["node", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    ranged = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    cut = ranged.mapInArrow(pieces, "node binary, first long, ids string")
    return cut.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


_PIECES = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])


def prefix_trie(rows: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (least member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256`` and the node's hash, ``node``."""
    ship(rows.sparkSession)
    ids, turns = rebuilt(rows)
    root = F.lit(_named(ROOT))
    nodes = turns.groupBy("node").agg(
        F.min("conv").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.count("*").alias("n_convs"), F.min("size").alias("size")
    )
    top = ids.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = top.select(root.alias("node"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"), "n_convs", F.lit(0).cast("long").alias("size"))
    nodes = materialise(nodes.union(top), "nodes")
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = materialise(nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie")
    totals = subtree_totals(
        nodes.select(
            "node", "parent", F.col("n_children").alias("kids"),
            (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
        ),
        ["n_leaves", "saved_tokens"],
    )
    deepest = turns.groupBy("conv").agg(F.max(F.struct("depth", "node")).alias("end")).select("conv", "end.node")
    ends = ids.join(deepest, "conv", "left").select(F.coalesce("node", root).alias("node"), "conv")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = materialise(nodes.join(above, "parent", "left"), "named")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return named.join(totals, "node").join(_joined_ids(ends), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256"), "node"
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
