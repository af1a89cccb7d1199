"""SentencePiece encoding with the original place of every piece, and decoding.

The text is normalised here, by longest-prefix matches of the model's compiled
character map (a double-array trie and a pool of replacements), and every byte
of the normalised text keeps the original byte span it came from. The library
gives the ids; their pieces, laid end to end, must be the normalised text, and
each piece takes the original span of its first to its last byte.

Defined cases: a null or empty text has no ids and decodes to the empty text;
a text of any length is encoded whole; equal rows give equal results row by
row; other columns are passed through; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.llm.chunks import ChunkEncoder
from tessera.llm.common import annotate, only, table
from tessera.llm.token_files import tokenizer_path

ROWS = 1000
MARK = "▁"  # stands for a space in pieces

OUT = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
    T.StructField("spans_crc32", T.LongType()),
])
PIECES = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("begin", T.ArrayType(T.IntegerType())),
    T.StructField("end", T.ArrayType(T.IntegerType())),
    T.StructField("decoded", T.StringType()),
])


class CharacterMap:
    """The compiled character map: a trie of byte strings, each with its
    replacement."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.pool = blob[4 + size :]

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that ``text`` has at ``at``."""
        if not self.units:
            return None
        found = None
        node = self._child(self.units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= self._child(unit)
            if unit >> 8 & 1:
                value = self.units[node] & 0x7FFFFFFF
                found = (i + 1 - at, self.pool[value : self.pool.index(b"\0", value)])
        return found


class Normalizer:
    """Normalised bytes of a text, and for each of them the original span."""

    def __init__(self, spec, symbols: list[bytes] = (), suffix: bool = False):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.space = MARK.encode() if spec.escape_whitespaces else b" "
        self.symbols, self.suffix = sorted(symbols, key=len, reverse=True), suffix
        self.plain = not (self.map.units or self.squeeze or self.symbols or suffix)

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        if not raw:
            return b"", np.empty(0, np.int64), np.empty(0, np.int64)
        return self._plain(raw) if self.plain else self._mapped(raw)

    def _plain(self, raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        codes = np.frombuffer(raw, np.uint8)
        begin = np.repeat(np.arange(len(codes)), np.where(codes == 32, len(self.space), 1))
        end = begin + 1
        if self.prefix:  # the first mark stands for no byte of the text
            none = np.zeros(len(self.space), np.int64)
            return self.space + raw.replace(b" ", self.space), np.concatenate((none, begin)), np.concatenate((none, end))
        return raw.replace(b" ", self.space), begin, end

    def _step(self, raw: bytes, at: int) -> tuple[int, bytes]:
        for symbol in self.symbols:
            if raw.startswith(symbol, at):
                return len(symbol), symbol
        if found := self.map.longest(raw, at):
            return found
        n = 1
        while at + n < len(raw) and raw[at + n] & 0xC0 == 0x80:
            n += 1
        return n, raw[at : at + n]

    def _mapped(self, raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        out, begin, end = bytearray(), [], []

        def put(piece: bytes, a: int, b: int) -> None:
            piece = piece.replace(b" ", self.space)
            out.extend(piece)
            begin.extend([a] * len(piece))
            end.extend([b] * len(piece))

        at = 0
        if self.squeeze:
            while at < len(raw) and (step := self._step(raw, at))[1] == b" ":
                at += step[0]
            if at == len(raw):
                return b"", np.empty(0, np.int64), np.empty(0, np.int64)
        if self.prefix and not self.suffix:
            put(b" ", at, at)
        after_space = self.squeeze
        while at < len(raw):
            n, piece = self._step(raw, at)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece, at, at + n)
                after_space = self.squeeze and piece.endswith(b" ")
            at += n
        if self.squeeze:
            while out.endswith(self.space):
                cut = len(out) - len(self.space)
                del out[cut:], begin[cut:], end[cut:]
        if self.prefix and self.suffix:
            put(b" ", len(raw), len(raw))
        return bytes(out), np.array(begin, np.int64), np.array(end, np.int64)


class Pieces:
    """A model file with its normaliser, piece lengths and chunk encoder."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        model.ParseFromString(self.lib.serialized_model_proto())
        kind = proto.ModelProto.SentencePiece
        self.bytes = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == kind.BYTE else p.piece.encode() for p in model.pieces
        ]
        self.size = np.array([len(x) for x in self.bytes], np.int64)
        self.decimal = [str(i) for i in range(len(self.bytes))]
        symbols = [p.piece.encode() for p in model.pieces if p.type == kind.USER_DEFINED]
        self.normalize = Normalizer(model.normalizer_spec, symbols, model.trainer_spec.treat_whitespace_as_suffix)
        # Chunks may be encoded alone if no piece holds a mark behind another character.
        inner = any(MARK in p.piece.lstrip(MARK) for p in model.pieces)
        self.cut = model.trainer_spec.model_type == proto.TrainerSpec.BPE and self.normalize.plain and self.normalize.prefix and not inner

    @cached_property
    def chunks(self) -> ChunkEncoder:
        def encode(texts: list[str]) -> list[bytes]:
            return [np.array(x, "<u4").tobytes() for x in self.lib.encode(texts, num_threads=1)]

        return ChunkEncoder(encode, encode, lambda text: not self.cut or MARK in text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, "<u4") for x in self.chunks.encode(texts)]

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Original UTF-8 byte span of every piece; checks that the pieces are
        the normalised text."""
        normal, begin, end = self.normalize(text.encode())
        if not len(ids):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pieces = [self.bytes[i] for i in ids.tolist()]
        size = self.size[ids]
        if b"".join(pieces) != normal:  # an unknown piece stands for other characters
            pieces = [p.surface.encode().replace(b" ", self.normalize.space) if p.id == self.lib.unk_id() else self.bytes[p.id] for p in self.lib.encode(text, out_type="immutable_proto").pieces]
            size = np.array([len(p) for p in pieces], np.int64)
            if b"".join(pieces) != normal:
                raise ValueError("pieces and normalised text differ")
        stop = np.cumsum(size)
        return begin[stop - size], end[stop - 1]


_MODELS: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model, one for each worker."""
    only("sentencepieces", _MODELS.clear)
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def _texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def encode_pieces(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """``row`` (the document's columns) and ``out`` (``PIECES``: ids, byte
    spans and decoded text) per document."""
    at = docs.columns.index(text_col)

    def run(rows: pa.StructArray) -> dict:
        texts, m = _texts(rows.field(at)), pieces(model)
        ids = m.encode(texts)
        spans = [m.spans(t, i) for t, i in zip(texts, ids, strict=True)]
        return {
            "ids": [x.tolist() for x in ids],
            "begin": [x.tolist() for x, _ in spans],
            "end": [x.tolist() for _, x in spans],
            "decoded": [m.lib.decode(x.tolist()) for x in ids],
        }

    return annotate(docs, run, PIECES)


def digest_pieces(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """``row`` and ``out`` (``OUT``): count and digests of ids, decoded text
    and spans of every document."""
    at = docs.columns.index(text_col)

    def run(rows: pa.StructArray) -> dict:
        m, out = pieces(model), {f.name: [] for f in OUT}
        texts = _texts(rows.field(at))
        for a in range(0, len(texts), ROWS):
            some = texts[a : a + ROWS]
            for text, ids in zip(some, m.encode(some), strict=True):
                begin, end = m.spans(text, ids)
                listed = ids.tolist()
                decimal = m.decimal
                out["n_tokens"].append(len(listed))
                out["ids_sha256"].append(hashlib.sha256(",".join([decimal[i] for i in listed]).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(m.lib.decode(listed).encode()).hexdigest())
                out["spans_crc32"].append(zlib.crc32(np.stack((begin, end), 1).astype("<u4").tobytes()))
        return out

    return annotate(docs, run, OUT)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest_pieces(docs, tokenizer_path("piece_bpe_32k.model")).select("row.doc_id", "out.*")
