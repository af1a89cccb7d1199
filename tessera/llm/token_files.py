"""Token files: ids of documents in independent zstandard frames with a
trailing seek table, so that a reader decompresses only what it asks for.

Layout of a file, all integers little-endian:

* data frames, each a zstandard frame of its own over ``FRAME_IDS`` unsigned
  32-bit ids (the last may hold fewer); documents run across frames;
* a skippable frame with the document index: per document its id (signed 64
  bit), whether the id is null (8 bit) and the position after its last id in
  this file (unsigned 64 bit), as three arrays behind the number of documents;
* a skippable frame with the seek table: per frame its compressed size, its
  decompressed size and the low 32 bits of the XXH64 of its decompressed
  bytes; then the number of frames, a descriptor byte and the closing magic
  number. The index frame is listed with a decompressed size of zero.

Documents go to files by ranges of their id and lie in ascending order in
them, and files are numbered in that order. A task writes its file under a
name of its own attempt and returns it in a row; only files named by the
stored manifest belong to the data set, so repeated or lost attempts leave at
most an unused file behind.

Defined cases: a null or empty text has the end id alone; a null id sorts
first; rows of equal id are ordered by their text and kept; an empty table
makes no file and an empty result; other columns are left.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.chunks import ChunkEncoder
from tessera.llm.common import materialise, only, scratch, table

FRAME_IDS = 1 << 16
END_ID = 2
LEVEL = 3

# Fixed values of the zstandard and the seekable formats.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

MANIFEST = "part int, path string, docs long, ids long"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_ENCODERS: dict[str, ChunkEncoder] = {}

JOIN = 200
ROWS = 1000
PIECES = 2_000_000  # that a worker remembers the ids of


def _cutter(module, letter: str, digit: str, flags: int = 0) -> Callable[[str], list[str]]:
    """How a byte-level pre-tokenizer cuts a text (a fixed pattern), for the
    letters and digits of some characters."""
    pattern = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^\s{letter}{digit}]+|\s+(?!\S)|\s+"
    return module.compile(pattern, flags).findall


_CUT_ASCII = _cutter(re, "A-Za-z", "0-9", re.ASCII)
_CUT_ANY = _cutter(regex, r"\p{L}", r"\p{N}")
# Characters whose kind no version of Unicode changes.
_SETTLED = regex.compile(r"[\t\n\r\x20-\x7e\u00a1-\u024f]+")


def byte_bpe(path: str) -> ChunkEncoder:
    """Encoder over a ``tokenizers`` file, one for each worker. Texts are cut
    in chunks only for a byte-level BPE without a normalizer, and never those
    that hold the string of an added token."""
    only("token_files", _ENCODERS.clear)
    if path not in _ENCODERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        spec = json.loads(tokenizer.to_str())
        pre = spec["pre_tokenizer"] or {}
        plain = (
            spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
            and spec["truncation"] is None and spec["padding"] is None and spec["model"]["type"] == "BPE"
        )
        added = [x["content"] for x in spec["added_tokens"]]
        size = np.zeros(tokenizer.get_vocab_size(), np.int64)
        for token, number in tokenizer.get_vocab().items():
            size[number] = len(token)  # a character of a byte-level token is a byte

        def encode(texts: list[str]) -> list[bytes]:
            return [np.array(x.ids, "<u4").tobytes() for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        known: dict[str, bytes] = {}

        def after_space(words: list[str]) -> list[bytes]:
            """A word behind a space is cut as the pre-tokenizer does, for its
            pieces are encoded by themselves; many words share a piece. Letters
            alone are one piece."""
            flat: list[str] = []
            sizes = []
            for word in words:
                x = " " + word
                pieces = [x] if word.isalpha() else _CUT_ASCII(x) if x.isascii() else _CUT_ANY(x) if _SETTLED.fullmatch(x) else [x]
                flat += pieces
                sizes.append(len(pieces))
            ids = list(map(known.get, flat))
            missing = {x for x, found in zip(flat, ids, strict=True) if found is None}
            if missing:
                if len(known) + len(missing) > PIECES:
                    known.clear()
                behind = [x for x in missing if x[0] == " " and len(x) > 1]
                others = [x for x in missing if x[0] != " " or len(x) == 1]
                known.update(zip(behind, together(behind), strict=True))
                known.update(zip(others, encode(others) if others else [], strict=True))
                ids = [known[x] if found is None else found for x, found in zip(flat, ids, strict=True)]
            each = iter(ids)
            return [next(each) if n == 1 else b"".join(islice(each, n)) for n in sizes]

        def together(words: list[str]) -> list[bytes]:
            """Words that begin with a space are laid end to end and encoded in
            one go; the tokens' byte lengths tell the words apart again."""
            out = []
            for a in range(0, len(words), JOIN):
                some = words[a : a + JOIN]
                if any(x[-1].isspace() for x in some):
                    out += encode(some)
                    continue
                raw = encode(["".join(some)])[0]
                ends = np.concatenate(([0], np.cumsum(size[np.frombuffer(raw, "<u4")])))
                wanted = np.concatenate(([0], np.cumsum([len(x.encode()) for x in some])))
                cut = np.searchsorted(ends, wanted)
                if not np.array_equal(ends[np.minimum(cut, len(ends) - 1)], wanted):
                    raise ValueError("tokens run across words")
                cut = (4 * cut).tolist()
                out += [raw[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
            return out

        def whole(text: str) -> bool:
            return not plain or any(x in text for x in added)

        _ENCODERS[path] = ChunkEncoder(encode, after_space, whole)
    return _ENCODERS[path]


def store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, as executors see it."""
    if re.match(r"file:/", path):
        path = re.sub(r"^file:/+", "/", path)
    if re.match(r"\w+://", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class TokenFileWriter:
    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        self.out, self.frame = out, 4 * frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.seek: list[tuple[int, int, int]] = []
        self.held = bytearray()
        self.doc_ids: list[int] = []
        self.nulls: list[int] = []
        self.ends: list[int] = []
        self.ids = 0

    def _flush(self, raw: bytes) -> None:
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.seek.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        self.ids += len(ids) // 4
        self.ends.append(self.ids)
        self.held += ids
        if len(self.held) >= self.frame:
            cut = len(self.held) - len(self.held) % self.frame
            for i in range(0, cut, self.frame):
                self._flush(bytes(self.held[i : i + self.frame]))
            del self.held[:cut]

    def close(self) -> None:
        if self.held:
            self._flush(bytes(self.held))
        n = len(self.doc_ids)
        index = (
            struct.pack("<Q", n) + np.array(self.doc_ids, "<i8").tobytes()
            + np.array(self.nulls, "u1").tobytes() + np.array(self.ends, "<u8").tobytes()
        )
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        self.seek.append((8 + len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = b"".join(struct.pack("<III", *x) for x in self.seek)
        foot = struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + len(foot)) + table + foot)


class TokenFileReader:
    """Reads single documents or all of them; ``frames_read`` counts the
    frames that were decompressed."""

    def __init__(self, path: str):
        where, name = store(path)
        self.file = where.open_input_file(name)
        size = self.file.size()
        self.file.seek(size - 9)
        n, flag, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEK_MAGIC or not flag & CHECKSUM_FLAG:
            raise ValueError(f"{path} has no seek table with checksums")
        self.file.seek(size - 9 - 12 * n)
        seek = np.frombuffer(self.file.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.packed, self.raw, self.check = seek.T
        self.offset = np.cumsum(self.packed) - self.packed
        self.raw_start = np.cumsum(self.raw) - self.raw
        self.file.seek(int(self.offset[-1]) + 8)
        index = self.file.read(int(self.packed[-1]) - 8)
        (docs,) = struct.unpack_from("<Q", index)
        self.doc_ids = np.frombuffer(index, "<i8", docs, 8)
        self.nulls = np.frombuffer(index, "u1", docs, 8 + 8 * docs)
        self.ends = np.frombuffer(index, "<u8", docs, 8 + 9 * docs).astype(np.int64)
        self.zstd = zstandard.ZstdDecompressor()
        self.frames_read = 0

    def frame(self, k: int) -> bytes:
        self.file.seek(int(self.offset[k]))
        raw = self.zstd.decompress(self.file.read(int(self.packed[k])), max_output_size=int(self.raw[k]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.check[k]:
            raise ValueError(f"frame {k} does not match its checksum")
        self.frames_read += 1
        return raw

    def document(self, k: int) -> np.ndarray:
        """Ids of the file's k-th document, from the frames that hold them."""
        start, end = 4 * int(self.ends[k - 1]) if k else 0, 4 * int(self.ends[k])
        if start == end:
            return np.empty(0, "<u4")
        a = int(np.searchsorted(self.raw_start[:-1], start, side="right")) - 1
        b = int(np.searchsorted(self.raw_start[:-1], end, side="left"))
        raw = b"".join(self.frame(i) for i in range(a, b))
        return np.frombuffer(raw[start - int(self.raw_start[a]) : end - int(self.raw_start[a])], "<u4")

    def find(self, doc_id: int) -> list[int]:
        """Places of a document id in the file."""
        return np.flatnonzero((self.doc_ids == doc_id) & (self.nulls == 0)).tolist()

    def all(self) -> Iterator[tuple[int | None, bytes]]:
        """Every document in order; each frame is decompressed once."""
        held, frame, start = bytearray(), 0, 0
        for doc_id, null, end in zip(self.doc_ids.tolist(), self.nulls.tolist(), self.ends.tolist(), strict=True):
            size = 4 * (end - start)
            while len(held) < size:
                held += self.frame(frame)
                frame += 1
            yield None if null else doc_id, bytes(held[:size])
            del held[:size]
            start = end

    def close(self) -> None:
        self.file.close()


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
    frame_ids: int = FRAME_IDS, level: int = LEVEL,
) -> DataFrame:
    """Write token files under ``path`` and return their manifest (stored)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, out, name = byte_bpe(tokenizer), None, None, ""
        task = TaskContext.get()
        end = struct.pack("<I", end_id)
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                where, folder = store(path)
                where.create_dir(folder, recursive=True)
                name = f"tokens-{task.partitionId():06d}-{task.taskAttemptId()}.zst"
                out = where.open_output_stream(f"{folder}/{name}", compression=None)
                writer = TokenFileWriter(out, frame_ids, level)
            ids, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
            for a in range(0, len(texts), ROWS):
                for doc_id, tokens in zip(ids[a : a + ROWS], encoder.encode(texts[a : a + ROWS]), strict=True):
                    writer.add(doc_id, tokens + end)
        if writer is not None:
            writer.close()
            out.close()
            row = [[task.partitionId()], [f"{path}/{name}"], [len(writer.doc_ids)], [writer.ids]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["part", "path", "docs", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return materialise(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32``. One task reads one
    file; the files' own starts come from the manifest, a row per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, path, base in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                reader = TokenFileReader(path)
                n, ends = len(reader.doc_ids), reader.ends
                counts = np.diff(ends, prepend=0)
                crc = np.fromiter((zlib.crc32(raw) for _, raw in reader.all()), np.int64, n)
                cols = [
                    pa.array(reader.doc_ids, pa.int64(), mask=reader.nulls.astype(bool)),
                    pa.array(base + ends - counts), pa.array(counts), pa.array(crc),
                ]
                reader.close()
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32"])

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return files.repartitionByRange(max(1, manifest.count()), "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_tokens(write_tokens(docs, scratch(spark, "op2-tokens"), tokenizer_path("byte_bpe_50k.json")))
