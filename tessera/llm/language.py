"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An
n-gram binds the vectors of its letters, each permuted (rotated) by its place:
for a trigram abc it is rot2(a) * rot1(b) * c. A text bundles (adds up) the
vectors of its n-grams, a language those of all its texts; a text gets the
language whose prototype has the greatest cosine with it.

Letters are lower-cased; everything else is one blank between words, which
takes part as a letter of its own. The prototypes are sums of whole numbers,
so they do not depend on how rows are spread.

Defined cases: a null text or one without letters gets ``und`` with score 0;
rows without a language are never learned from; equal cosines go to the first
language by name; without any row to learn from every text gets ``und``; rows
of equal id are kept; empty tables give empty results; other columns are passed through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import annotate, in_blocks, table

DIM = 2048
N = 3
FOLDS = 5
UNKNOWN = "und"
_SHIFT = 21  # bits of a code point

OUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

MOST_LETTERS = 4096  # kept at once

_TURNED: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
_ALPHA: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _ALPHA[0]


def letter(code: int, dim: int) -> np.ndarray:
    """The random vector of a code point."""
    seed = zlib.crc32(f"letter {code}".encode())
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2, dim, np.int8) * 2 - 1


def _turned(codes: np.ndarray, n: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points in order, at least ``codes`` (distinct), and their vectors
    turned by 0 to ``n - 1`` places; kept for the next texts."""
    known, rows = _TURNED.get((n, dim), (np.empty(0, np.int64), np.empty((n, 0, dim), np.int8)))
    new = np.setdiff1d(codes, known)
    if len(new):
        if len(known) + len(new) > MOST_LETTERS:
            known, rows, new = known[:0], rows[:, :0], np.unique(codes)
        made = np.stack([letter(int(c), dim) for c in new])
        rows = np.concatenate((rows, np.stack([np.roll(made, k, axis=1) for k in range(n)])), axis=1)
        known = np.concatenate((known, new))
        order = np.argsort(known)
        known, rows = known[order], rows[:, order]
        _TURNED[n, dim] = known, rows
    return known, rows


def ngrams(text: str, n: int = N) -> np.ndarray:
    """Codes of all n-grams of a text: code points side by side, 0 the blank.
    N-grams that are mostly blank or span two words are left out."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.where(_is_letter()[codes], codes, 0)
    codes = np.concatenate(([0], codes, [0]))
    codes = codes[(codes != 0) | np.concatenate(([True], codes[:-1] != 0))]  # one blank at a time
    if len(codes) < n or not codes.any():
        return np.empty(0, np.int64)
    windows = [codes[i : len(codes) - n + 1 + i] for i in range(n)]
    inside = np.ones(len(windows[0]), bool)
    for w in windows[1:-1]:
        inside &= w != 0
    if n == 1:
        inside &= windows[0] != 0
    out = np.zeros(len(windows[0]), np.int64)
    for w in windows:
        out = (out << _SHIFT) | w
    return out[inside]


def vectors(grams: np.ndarray, n: int = N, dim: int = DIM) -> np.ndarray:
    """Bound vectors of n-gram codes, a row each."""
    places = [(grams >> (_SHIFT * (n - 1 - k))) & ((1 << _SHIFT) - 1) for k in range(n)]
    known, rows = _turned(np.unique(np.concatenate(places)), n, dim)
    out = rows[n - 1][np.searchsorted(known, places[0])]
    for k in range(1, n):
        out *= rows[n - 1 - k][np.searchsorted(known, places[k])]
    return out


def bundle(grams: np.ndarray, counts: np.ndarray, n: int = N, dim: int = DIM) -> np.ndarray:
    """Sum of the n-grams' vectors times their counts, in whole numbers (kept
    exactly: in single precision only where all sums are below 2^24)."""
    kind = np.float32 if counts.sum() < 1 << 24 else np.float64
    total = np.zeros(dim)
    for a in range(0, len(grams), 2048):
        total += counts[a : a + 2048].astype(kind) @ vectors(grams[a : a + 2048], n, dim).astype(kind)
    return total


def _texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def prototypes(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", n: int = N, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages and their bundled vectors. The result has a row per language;
    what reaches the driver is ``dim`` numbers for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches):
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = _texts(batch.column(1))
            for lang in sorted(set(langs)):
                grams = [ngrams(texts[i], n) for i in np.flatnonzero(langs == lang)]
                found, counts = np.unique(np.concatenate(grams), return_counts=True)
                total = bundle(found, counts, n, dim).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * dim), pa.array(np.arange(dim, dtype=np.int32)), pa.array(total)], ["lang", "at", "x"])

    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sums = known.mapInArrow(run, "lang string, at int, x long").groupBy("lang", "at").agg(F.sum("x").alias("x")).toPandas()
    langs = sorted(sums["lang"].unique())
    out = np.zeros((len(langs), dim))
    out[[langs.index(x) for x in sums["lang"]], sums["at"]] = sums["x"]
    return langs, out


def identify(docs: DataFrame, langs: list[str], model: np.ndarray, text_col: str = "text", n: int = N) -> DataFrame:
    """``row`` (the document's columns) and ``out`` (``OUT``: the language and
    its cosine, 0 if negative) per document."""
    dim, at = model.shape[1], docs.columns.index(text_col)
    norm = np.linalg.norm(model, axis=1, keepdims=True)
    shared = docs.sparkSession.sparkContext.broadcast((langs, (model / np.where(norm > 0, norm, 1)).T))

    def run(rows: pa.StructArray) -> dict:
        names, unit = shared.value
        pred, score = [], []
        for text in _texts(rows.field(at)):
            grams, counts = np.unique(ngrams(text, n), return_counts=True)
            best, cosine = UNKNOWN, 0.0
            if len(grams) and names:
                v = bundle(grams, counts, n, dim)
                cosines = v @ unit / max(np.linalg.norm(v), 1e-12)
                first = int(np.argmax(cosines))
                best, cosine = names[first], float(min(1.0, max(0.0, cosines[first])))
            pred.append(best)
            score.append(cosine)
        return {"lang_pred": pred, "score": score}

    return annotate(docs, run, OUT)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the number of folds; 0 without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS, F.lit(0))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, model = prototypes(docs.where(fold() != 0))
    rows = docs.select("doc_id", (fold() == 0).alias("held_out"), "text")
    return identify(rows, langs, model).select("row.doc_id", "row.held_out", "out.*")
