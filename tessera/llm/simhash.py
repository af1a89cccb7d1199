"""SimHash near-duplicates, compared at the anchor points of a covering code.

A fingerprint is cut into as many parts as make one part of any linked pair
differ in two bits at most. The anchors of a part are the words of a Hamming
code of the greatest length ``2^r - 1`` that fits, with the left-over bits as
they are: covering radius 1. Two values at distance 2 have a value halfway, one
bit from both, and that value's anchor lies within 1 + 1 bits of both; so every
part is sent to all anchors within the covering radius plus half the part's
threshold (17 of a 32-bit part at most), and pairs are compared per anchor.

Equal fingerprints are one row throughout. An anchor with more than ``hot``
fingerprints is cut again by anchors of the other parts' bits, and what is
still larger into tiles of bounded size, each pair of tiles a group of its own,
so no task holds more than two tiles and no pair is lost. A group gives the
links of a star for each of its components, not its pairs.

Defined cases: a null or empty text, or one without words, has fingerprint
zero and links like any other; a null id takes part in its component but is
never its least; rows of equal id are kept; empty tables give empty results;
other columns are left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, only, table, trim, utf8
from tessera.llm.components import components
from tessera.llm.exchange import mix
from tessera.plans.joins import lookup_join

SEED = 42
WORDS = 4
MAX_BITS = 4
HOT = 8192


def fingerprint(text: bytes, size: int = WORDS) -> int:
    """The SimHash of a text: a bit is set if over half the shingles' hashes
    have it."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - size + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):
        h = np.array([digest(line[x:y], SEED) for x, y in zip(starts[a : a + (1 << 16)], ends[a : a + (1 << 16)], strict=True)], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's 64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("simhash")
        for batch in batches:
            fps = np.array([fingerprint(x, words) for x in utf8(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
            del batch
        trim()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _near_codewords(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All anchors within distance 2 of ``width``-bit values: which value, and
    the anchor. Bit ``i`` of the coded bits stands at position ``i + 1``."""
    length = 1
    while 2 * length + 1 <= width:
        length = 2 * length + 1
    one = np.uint64(1)
    syndrome = np.zeros(len(x), np.int64)
    for i in range(length):
        syndrome ^= np.where((x >> np.uint64(i)) & one, i + 1, 0)
    spare = [one << np.uint64(i) for i in range(length, width)]
    who, anchor = [], []

    def put(index: np.ndarray, values: np.ndarray) -> None:
        who.append(index)
        anchor.append(values)

    off = np.flatnonzero(syndrome)
    on = np.flatnonzero(syndrome == 0)
    near = x.copy()
    near[off] ^= one << (syndrome[off] - 1).astype(np.uint64)
    every = np.arange(len(x))
    put(every, near)
    for a, bit in enumerate(spare):
        put(every, near ^ bit)
        for other in spare[:a]:
            put(on, x[on] ^ bit ^ other)
    s = syndrome[off]
    for i in range(1, length + 1):  # flip positions i and j with i xor j = syndrome
        j = s ^ i
        ok = i < j
        put(off[ok], x[off][ok] ^ (one << np.uint64(i - 1)) ^ (one << (j[ok] - 1).astype(np.uint64)))
    return np.concatenate(who), np.concatenate(anchor)


def anchors(x: np.ndarray, width: int, max_bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Parts of ``width``-bit values (first bit, bits), and for each part which
    value goes to which anchor."""
    parts = max(1, -(-(max_bits + 1) // 3))
    cuts = [width * i // parts for i in range(parts + 1)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        part = (x >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
        yield a, b - a, *_near_codewords(part, b - a)


def _keys(max_bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for first, _, who, anchor in anchors(fp, 64, max_bits):
                key = mix(mix(anchor) + np.uint64(first + 1))
                yield _rows(key, fp[who], np.full(len(who), first))

    return run


def _rows(key: np.ndarray, fp: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(first.astype(np.int32))], ["key", "fp", "first"])


KEYED = "key long, fp long, first int"


def _rekey(max_bits: int) -> Callable:
    """Cut a hot anchor by the anchors of the bits outside its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = max(1, -(-(max_bits + 1) // 3))
        cuts = [64 * i // parts for i in range(parts + 1)]
        for batch in batches:
            key, fp = (batch.column(i).to_numpy().view(np.uint64) for i in range(2))
            first = batch.column(2).to_numpy()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                mine = first == a
                low = fp[mine] & np.uint64((1 << a) - 1)
                rest = low | ((fp[mine] >> np.uint64(b)) << np.uint64(a) if b < 64 else np.uint64(0))
                width = 64 - (b - a)
                if not width or not mine.any():
                    yield _rows(key[mine], fp[mine], first[mine])
                    continue
                for at, _, who, anchor in anchors(rest, width, max_bits):
                    yield _rows(mix(mix(key[mine][who] + np.uint64(at + 1)) ^ anchor), fp[mine][who], first[mine][who])

    return run


def _group_links(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A star of links for each component of one group."""
    left = np.sort(fp)
    a, b = [], []
    while len(left) > 1:
        root, left = left[0], left[1:]
        edge = np.array([root], np.uint64)
        while len(edge) and len(left):
            step = edge[:256]
            edge = edge[256:]
            near = (np.bitwise_count(left[None, :] ^ step[:, None]) <= max_bits).any(axis=0)
            found, left = left[near], left[~near]
            a.append(np.full(len(found), root))
            b.append(found)
            edge = np.concatenate((edge, found))
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, np.uint64), np.empty(0, np.uint64))


def _links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the groups of sorted keys."""
    cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.diff(cut)
    a, b = [], []
    two = cut[:-1][size == 2]
    near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits
    a.append(np.minimum(fp[two], fp[two + 1])[near])
    b.append(np.maximum(fp[two], fp[two + 1])[near])
    for at, n in zip(cut[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
        x, y = _group_links(fp[at : at + n], max_bits)
        a.append(x)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def _compare(keyed: DataFrame, max_bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate((held_key, batch.column(0).to_numpy()))
            fp = np.concatenate((held_fp, batch.column(1).to_numpy().view(np.uint64)))
            whole = int(np.searchsorted(key, key[-1]))
            held_key, held_fp = key[whole:], fp[whole:]
            if whole:
                yield _pair_rows(*_links(key[:whole], fp[:whole], max_bits))
        if len(held_key):
            yield _pair_rows(*_links(held_key, held_fp, max_bits))

    return keyed.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def _pair_rows(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack((a, b), 1), axis=0) if len(a) else np.empty((0, 2), np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in range(2)], ["a", "b"])


def _split(keyed: DataFrame, hot: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of anchors with at most ``hot`` rows, and the others with their
    anchor's number of rows (none: no such anchor)."""
    large = materialise(keyed.groupBy("key").count().where(F.col("count") > hot), "hot-anchors")
    if large.isEmpty():
        return keyed, None
    return keyed.join(large, "key", "left_anti"), keyed.join(large, "key")


def links(distinct: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """Links (``a``, ``b``) that connect all fingerprints (column ``fp``, each
    once) which differ in at most ``max_bits`` bits. Parts of any linked pair
    differ in two bits at most for up to 17 bits in all."""
    if not 0 <= max_bits <= 17:
        raise ValueError("max_bits must be between 0 and 17")
    keyed = materialise(distinct.select("fp").mapInArrow(_keys(max_bits), KEYED), "anchors")
    few, many = _split(keyed, hot)
    found = _compare(few, max_bits)
    if many is not None:
        again = materialise(many.select("key", "fp", "first").mapInArrow(_rekey(max_bits), KEYED).distinct(), "anchors-again")
        few, many = _split(again, hot)
        found = found.union(_compare(few, max_bits))
        if many is not None:
            tiles = F.ceil(F.col("count") / F.lit(hot // 2)).cast("int")
            mine = F.pmod(F.xxhash64("fp"), tiles).cast("int")
            tiled = many.select("key", "fp", mine.alias("i"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("j"))
            # Tile pairs (i, j); a tile with itself is part of each of its pairs.
            pair = F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j"))
            found = found.union(_compare(tiled.where("i != j").select(pair.alias("key"), "fp"), max_bits))
    return found


def near_duplicates(
    docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the least id that links reach."""
    rows = materialise(fingerprints(docs, words, id_col, text_col), "fingerprints")
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    reached = components(links(classes, max_bits, hot))
    of = classes.join(reached, classes.fp == reached.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("c"))
    of = materialise(of, "class-components")
    named = lookup_join(of, of.groupBy("c").agg(F.min("least").alias("component_id")), "c").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one kept per component, that of the least id; ids
    must be distinct, rows without an id are kept."""
    found = near_duplicates(docs, words, max_bits, id_col, text_col)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs[id_col] == F.col("__gone"), "left_anti")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
