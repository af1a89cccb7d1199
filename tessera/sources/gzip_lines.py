"""Lines of gzip files by several tasks a file.

A gzip stream as such must be read from its start. But many writers (log
rotation, block gzip, ``cat`` of compressed parts) make files of many members,
each a stream of its own. Ranges of such a file are given to separate tasks: a
task looks for the first member that begins in its range and reads on until
the first that does not. A member is recognised by its header and proven by its
checksum. Lines that run across ranges are put together from their pieces.

Executors open the files themselves, so paths must be ones that Arrow can open
(local or shared folders, object stores, HDFS); a file of one member is one
task's work, as with ``read_text_lines``."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.plans.stored import stored

SPLIT_BYTES = 64 << 20
READ_BYTES = 1 << 20

# Tasks that read ranges, at most; with more ranges a task reads several, one after the other.
MOST_TASKS = 256

# The first bytes of a gzip member (deflate), and the flag bits that must be zero.
MAGIC = b"\x1f\x8b\x08"
RESERVED = 0xE0

_PIECES = "file string, start long, place int, closed boolean, text binary"


def _open(path: str):
    if path.startswith("file:"):
        path = re.sub(r"^file:/+", "/", path)
    where, name = fs.FileSystem.from_uri(path) if re.match(r"\w+://", path) else (fs.LocalFileSystem(), path)
    return where.open_input_file(name)


def _member(file, at: int) -> Iterator[bytes]:
    """Text of the member that begins at ``at``, piece by piece, and at last
    where the next one begins; an error if there is no whole member."""
    stream, pos = zlib.decompressobj(wbits=31), at
    while not stream.eof:
        raw = file.read_at(READ_BYTES, pos)
        if not raw:
            raise zlib.error("the member is cut off")
        pos += len(raw)
        yield stream.decompress(raw)
    yield pos - len(stream.unused_data)


def _is_member(file, at: int) -> bool:
    try:
        for _ in _member(file, at):
            pass
    except zlib.error:
        return False
    return True


def _first_member(file, start: int, end: int) -> int | None:
    """Where the first member in a range begins."""
    if start == 0:
        return 0
    for a in range(start, end, READ_BYTES):
        raw = file.read_at(min(READ_BYTES, end - a) + 3, a)
        at = raw.find(MAGIC)
        while at >= 0:
            if at + 3 < len(raw) and not raw[at + 3] & RESERVED and a + at < end and _is_member(file, a + at):
                return a + at
            at = raw.find(MAGIC, at + 1)
    return None


def _run(file, size: int, start: int, end: int) -> Iterator[bytes]:
    """Text of all members that begin in a range."""
    at = _first_member(file, start, end)
    while at is not None and at < min(end, size):
        for piece in _member(file, at):
            if isinstance(piece, int):
                at = piece
            else:
                yield piece


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, size, start, end in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            with _open(path) as file:
                held, place = b"", 0
                for piece in _run(file, size, start, end):
                    *lines, held = (held + piece).split(b"\n")
                    if lines:
                        n = len(lines)
                        yield _rows(path, start, range(place, place + n), [True] * n, lines)
                        place += n
                yield _rows(path, start, [place], [False], [held])


def _rows(path: str, start: int, places, closed: list[bool], text: list[bytes]) -> pa.RecordBatch:
    n = len(text)
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * n), pa.array([start] * n), pa.array(places, pa.int32()), pa.array(closed), pa.array(text, pa.binary())],
        ["file", "start", "place", "closed", "text"],
    )


def read_gzip_lines(spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines of gzip files as a ``value`` column. A line ends at a line feed (a
    carriage return before it is cut) or at the end of a file.

    A range gives whole lines at once. Its first and last piece wait for their
    neighbours: pieces of one line are those from one line feed to the next,
    two and one for each range that has none."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"))  # contents are not read
    ranges = files.where("size > 0").withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(split_bytes).cast("bigint"))))
    ranges = ranges.withColumn("end", F.col("start") + split_bytes)
    # A task for each range, by a number of its own: as rows ranges are so small that Spark would put all into one task.
    n = files.agg(F.sum(F.ceil(F.col("size") / F.lit(split_bytes)))).first()[0] or 1
    cut = stored(ranges.repartition(min(n, MOST_TASKS), "path", "start").mapInArrow(_cut, _PIECES), "gzip-lines")
    # Dealt out anew: a split of the stored lines holds far more text than its bytes tell.
    whole = cut.where("closed AND place > 0").repartition("start", "place").select("text")
    edges = cut.where("NOT closed OR place = 0")
    # A line's number within the file's edges: how many line feeds are before it.
    in_file = Window.partitionBy("file").orderBy("start", "place")
    number = F.coalesce(F.sum(F.col("closed").cast("int")).over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = edges.withColumn("line", number).groupBy("file", "line").agg(
        F.sort_array(F.collect_list(F.struct("start", "place", "text"))).alias("pieces"), F.max("closed").alias("closed")
    )
    joined = lines.select(F.aggregate("pieces", F.lit(b""), lambda text, piece: F.concat(text, piece["text"])).alias("text"), "closed")
    rest = joined.where("closed OR length(text) > 0").select("text")  # nothing follows a last line feed
    return whole.union(rest).select(F.regexp_replace(F.col("text").cast("string"), "\r$", "").alias("value"))
