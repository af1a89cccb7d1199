"""Quality classifier by co-training.

Two views of a document: its text (words, beginnings of words, marks, and how
varied and how loud it is) and its page metadata (language, source, length,
layout). For each target (``quality`` and ``toxic``) a logistic regression per
view learns from labelled rows; over rounds each view labels the unlabelled
rows it is sure of for the other view's next fit. Both views are calibrated on
labelled rows held back from fitting, combined there, and all documents are
scored with the result.

Fitting happens on the driver over bounded samples: at most ``labelled`` rows
with labels, those with the least hash of their id, and about ``pool`` rows
without (one per class and stratum at least). Those are looked for among all
unlabelled documents: in every round the executors score each with both views,
and the surest of every class and stratum of language and source come to the
fit. Scoring reads every document whole and has no shuffle.

Defined cases: a null or empty text has its length and layout features only;
null metadata is a value of its own; labels of one id are merged (worst
quality, most toxic), a null label is left out for its target; a target with
one class only gets the share of that class as its probability; one without
labels has 0.5, rejects nothing and does not enter the score; without labels
every score is 0.5 and everything is kept; rows of equal id are kept; an empty table gives
an empty result; other columns are passed through.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import annotate, materialise, only, ship, table

LABELLED = 20_000
POOL = 10_000
ROUNDS = 3
SURE = 0.99
TEXT_BITS = 18
META_BITS = 12
EPOCHS = 8
BATCH = 256
STRATA = 1024  # at most, by hash of language and source
STEPS = 400  # at least so many, for small samples
RATE = 0.3
SPARSITY = 1e-3
REJECT = 0.5
TARGETS = ("quality", "toxic")

OUT = T.StructType([
    T.StructField("quality_score", T.DoubleType()),
    T.StructField("toxic_score", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("keep", T.BooleanType()),
])

# Words are runs of letters and of bytes beyond ASCII, marks runs of other visible ASCII characters.
_LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_VISIBLE = bytes(0x20 if c <= 0x20 or c >= 0x7F or chr(c).isalnum() or c == 0x5F else c for c in range(256))
_BEYOND_ASCII = re.compile(r"[^\x00-\x7f]+")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_STEMS = (4, 5)
CAPACITY = 500_000  # words that a worker remembers the features of


def _bucket(share: float) -> int:
    return min(20, int(20 * share))


def _number(name: str, bits: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) & ((1 << bits) - 1)


class _Remembered(dict):
    """Feature numbers of a word as bytes; made at the first question, and
    forgotten when there are too many."""

    def __init__(self, names: Callable[[str], list[str]]):
        self.names = names

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CAPACITY:
            self.clear()
        numbers = [_number(x, TEXT_BITS) for x in self.names(word.decode("utf-8", "surrogatepass"))]
        found = self[word] = np.array(numbers, "<i4").tobytes()
        return found


_OF_WORD = _Remembered(lambda w: [f"w {w}", *(f"b {w[:n]}" for n in _STEMS if len(w) >= n)])
_OF_MARK = _Remembered(lambda m: [f"m {m[:8]}"])


def _forget() -> None:
    _OF_WORD.clear()
    _OF_MARK.clear()


def marks_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_VISIBLE).split()


def _capitals(text: str) -> int:
    plain = text.encode("ascii", "ignore")
    n = len(plain) - len(plain.translate(None, _CAPITALS))
    return n + sum(map(str.isupper, "".join(_BEYOND_ASCII.findall(text)))) if len(plain) < len(text) else n


def _distinct(numbers: bytes) -> np.ndarray:
    """Distinct numbers, ascending."""
    row = np.sort(np.frombuffer(numbers, "<i4"))
    return row[np.concatenate((np.ones(min(1, len(row)), bool), row[1:] != row[:-1]))]


def text_features(text: str, marks: list[bytes] | None = None) -> np.ndarray:
    """Hashed features of the text view; ``marks`` if they are known."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    distinct = set(words)
    numbers = [*map(_OF_WORD.__getitem__, distinct), *map(_OF_MARK.__getitem__, set(marks_of(text) if marks is None else marks))]
    if words:
        names = (
            f"varied {_bucket(len(distinct) / len(words))} {min(10, len(words).bit_length())}",
            f"loud {_bucket(_capitals(text) / len(text))}",
            f"long {min(30, len(b''.join(words)) // len(words))}",
        )
        numbers.append(np.array([_number(x, TEXT_BITS) for x in names], "<i4").tobytes())
    return _distinct(b"".join(numbers))


def meta_features(text: str, lang: str | None, source: str | None, n_chars: int | None, marks: list[bytes] | None = None) -> np.ndarray:
    """Hashed features of the metadata view."""
    lines = text.split("\n")
    n = max(1, len(text))
    names = [
        f"lang {lang}", f"source {source}", f"chars {None if n_chars is None else int(n_chars).bit_length()}",
        f"lines {len(lines).bit_length()}", f"width {(n // len(lines)).bit_length()}",
        f"repeated {_bucket(1 - len(set(lines)) / len(lines))}",
        f"marks {_bucket(2 * len(b''.join(marks_of(text) if marks is None else marks)) / n)}",
        f"bars {_bucket(10 * text.count('|') / n)}",
        f"blanks {_bucket(text.count(' ') / n)}",
    ]
    return _distinct(np.array([_number(x, META_BITS) for x in names], "<i4").tobytes())


#: Sparse rows: an array of distinct feature numbers each.
Rows = list


def pack(row: np.ndarray) -> bytes:
    """Ascending feature numbers as steps of two bytes, or four where one is
    longer (then the number of bytes leaves a remainder of one)."""
    step = np.diff(row, prepend=0)
    return step.astype("<u2").tobytes() if not len(step) or step.max() < 1 << 16 else step.astype("<u4").tobytes() + b"4"


def unpack(data: bytes) -> np.ndarray:
    step = np.frombuffer(data[:-1], "<u4") if len(data) % 2 else np.frombuffer(data, "<u2")
    return np.cumsum(step, dtype=np.int32)


def sums(rows: Rows, weights: np.ndarray) -> np.ndarray:
    """Sum of each row's weights."""
    size = np.array([len(r) for r in rows], np.int64)
    out = np.zeros(len(rows))
    some = np.flatnonzero(size)
    if len(some):
        flat = weights[np.concatenate([rows[i] for i in some])]
        out[some] = np.add.reduceat(flat, np.cumsum(size[some]) - size[some])
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: Rows, y: np.ndarray, bits: int, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Sparse logistic regression: mini-batches, a step per feature that
    shrinks with its past gradients, and soft thresholds that leave features
    without evidence at zero."""
    n, rng = len(y), np.random.default_rng(7)
    weights = np.zeros(1 << bits)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if n else 0.5
    bias = float(np.log(share / (1 - share)))
    if not n or y.min() == y.max():
        return weights, bias
    # Features of one row alone tell nothing of others.
    seen = np.zeros(1 << bits, np.int32)
    for r in rows:
        seen[r] += 1
    used = np.flatnonzero(seen > 1)
    place = np.full(1 << bits, -1, np.int32)
    place[used] = np.arange(len(used))
    rows = [p[p >= 0] for p in (place[r] for r in rows)]
    w, past, bias_past = np.zeros(len(used)), np.full(len(used), 1e-3), 1e-3
    for _ in range(max(epochs, min(200, STEPS * BATCH // n))):
        order = rng.permutation(n)
        for a in range(0, n, BATCH):
            index = order[a : a + BATCH]
            part = [rows[i] for i in index]
            error = _sigmoid(sums(part, w) + bias) - y[index]
            grad = np.bincount(np.concatenate(part), np.repeat(error, [len(r) for r in part]), len(used)) / len(index)
            past += grad * grad
            rate = RATE / np.sqrt(past)
            w -= rate * grad
            w = np.sign(w) * np.maximum(0, np.abs(w) - rate * SPARSITY * (grad != 0))
            bias_past += error.mean() ** 2
            bias -= RATE * error.mean() / np.sqrt(bias_past)
    weights[used] = w
    return weights, bias


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a small dense logistic regression by Newton steps."""
    x = np.concatenate((x, np.ones((len(x), 1))), axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class View:
    weights: np.ndarray
    bias: float
    scale: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0]))

    def margin(self, rows: Rows) -> np.ndarray:
        """Calibrated log-odds."""
        return self.scale[0] * (sums(rows, self.weights) + self.bias) + self.scale[1]


@dataclass
class Model:
    """Both views of a target and the weights of their calibrated margins."""

    views: tuple[View, View]
    mix: np.ndarray

    def probability(self, text: Rows, meta: Rows) -> np.ndarray:
        margins = np.stack([v.margin(r) for v, r in zip(self.views, (text, meta), strict=True)], axis=1)
        return _sigmoid(np.clip(margins, -30, 30) @ self.mix[:2] + self.mix[2])


def _calibrated(rows: Rows, y: np.ndarray, bits: int, check: Rows, check_y: np.ndarray) -> View:
    view = View(*fit(rows, y, bits))
    if len(check_y) and check_y.min() != check_y.max():
        raw = np.clip(sums(check, view.weights) + view.bias, -30, 30)
        view.scale = logistic(raw[:, None], check_y)
    return view


class Team:
    """Both views of a target in training; every fifth labelled row is held
    back to calibrate and combine them."""

    def __init__(self, views: tuple[Rows, Rows], y: np.ndarray):
        held = np.arange(len(y)) % 5 == 4
        self.check, self.check_y = [[v[i] for i in np.flatnonzero(held)] for v in views], y[held]
        self.own, self.y = [[v[i] for i in np.flatnonzero(~held)] for v in views], y[~held]
        self.models = [self._fitted(i, [], []) for i in range(2)]
        self.given: list[list] = []

    def _fitted(self, view: int, rows: Rows, labels: list[float]) -> View:
        bits = (TEXT_BITS, META_BITS)[view]
        return _calibrated(self.own[view] + rows, np.concatenate((self.y, labels)), bits, self.check[view], self.check_y)

    def learn(self, picks: list[list[tuple]]) -> bool:
        """Fit each view anew with its picks: id, label, features. False if
        these picks were given before."""
        state = [[p[:2] for p in mine] for mine in picks]
        if state in self.given:
            return False
        self.given.append(state)
        self.models = [self._fitted(i, [p[2] for p in picks[i]], [p[1] for p in picks[i]]) for i in range(2)]
        return True

    def model(self) -> Model:
        mix = np.array([1.0, 0.0, 0.0])
        if len(self.check_y) and self.check_y.min() != self.check_y.max():
            margins = [m.margin(c) for m, c in zip(self.models, self.check, strict=True)]
            mix = logistic(np.clip(np.stack(margins, axis=1), -30, 30), self.check_y)
        return Model(tuple(self.models), mix)


def _sure(spare: DataFrame, models: list[list[View]], each: int, sure: float) -> list[list[list[tuple]]]:
    """For each target and view the ``each`` rows per class and stratum that
    the other view is surest of, with its label; a row both are sure of but
    disagree on goes to neither. Rows are ranked without their features, which
    are fetched for those chosen."""
    limit, shared = np.log(sure / (1 - sure)), spare.sparkSession.sparkContext.broadcast(models)
    spare = spare.withColumn("mark", F.xxhash64("text", "meta"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, set[tuple]] = {}
        for batch in batches:
            ids, ranks, cells, mark = (batch.column(c).to_pylist() for c in ("doc_id", "rank", "cell", "mark"))
            rows = [[unpack(x) for x in batch.column(c).to_pylist()] for c in ("text", "meta")]
            touched = set()
            for target, views in enumerate(shared.value):
                margins = [v.margin(r) for v, r in zip(views, rows, strict=True)]
                clear = [np.abs(m) >= limit for m in margins]
                agree = ~(clear[0] & clear[1] & ((margins[0] > 0) != (margins[1] > 0)))
                for view in range(2):
                    other = margins[1 - view]
                    for k in np.flatnonzero(clear[1 - view] & agree).tolist():
                        key = (target, view, float(other[k] > 0), cells[k])
                        touched.add(key)
                        best.setdefault(key, set()).add((-abs(float(other[k])), ranks[k], ids[k], mark[k]))
            for key in touched:
                if len(best[key]) > each:
                    best[key] = set(sorted(best[key])[:each])
        found = [(*key, *x) for key, mine in best.items() for x in mine]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*found, strict=True), arrow, strict=True)], arrow.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(SURE_ROWS)
    # A task sends at most `each` rows of a class and stratum.
    place = F.row_number().over(Window.partitionBy("target", "view", "label", "cell").orderBy("doubt", "rank", "doc_id"))
    # One row per id, however often it comes: the surest.
    met = spare.mapInArrow(run, SURE_ROWS)
    once = met.groupBy("target", "view", "doc_id").agg(F.min(F.struct("doubt", "label", "cell", "rank", "mark")).alias("of"))
    found = once.select("target", "view", "doc_id", "of.*").withColumn("place", place).where(F.col("place") <= each)
    chosen = materialise(found.select("target", "view", "doc_id", "label", "mark"), "sure")
    # At most `each` of every class and stratum for each target and view, so they are broadcast.
    fetched = spare.select("doc_id", "mark", "text", "meta").join(F.broadcast(chosen), ["doc_id", "mark"]).dropDuplicates(["target", "view", "doc_id"])
    picks: list[list[list[tuple]]] = [[[], []] for _ in models]
    for r in fetched.toLocalIterator():
        picks[r["target"]][r["view"]].append((r["doc_id"], r["label"], unpack(r["text" if r["view"] == 0 else "meta"])))
    for mine in picks:
        for p in mine:
            p.sort(key=lambda x: x[0])
    return picks


SURE_ROWS = T.StructType([
    T.StructField("target", T.IntegerType()), T.StructField("view", T.IntegerType()), T.StructField("label", T.DoubleType()),
    T.StructField("cell", T.IntegerType()), T.StructField("doubt", T.DoubleType()), T.StructField("rank", T.LongType()),
    T.StructField("doc_id", T.LongType()), T.StructField("mark", T.LongType()),
])
FEATURES = T.StructType([T.StructField("text", T.BinaryType()), T.StructField("meta", T.BinaryType())])


def _features(rows: pa.StructArray, at: dict[str, int | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    def column(name: str) -> list:
        return [None] * len(rows) if at[name] is None else rows.field(at[name]).to_pylist()

    only("quality", _forget)
    text, meta = [], []
    for one, *of in zip(*map(column, ("text", "lang", "source", "n_chars")), strict=True):
        one = one or ""
        marks = marks_of(one)  # of one text at a time
        text.append(text_features(one, marks))
        meta.append(meta_features(one, *of, marks))
    return text, meta


def _places(docs: DataFrame) -> dict[str, int | None]:
    return {c: docs.columns.index(c) if c in docs.columns else None for c in ("text", "lang", "source", "n_chars")}


def _featured(docs: DataFrame, rest: list[str]) -> DataFrame:
    """Features of both views (``text``, ``meta``) beside columns ``rest``."""
    at = _places(docs)

    def run(rows: pa.StructArray) -> dict:
        text, meta = _features(rows, at)
        return {"text": [pack(x) for x in text], "meta": [pack(x) for x in meta]}

    return annotate(docs, run, FEATURES).select(*[f"row.{c}" for c in rest], "out.text", "out.meta")


def _sample(docs: DataFrame) -> tuple[list[tuple], tuple[Rows, Rows]]:
    """Labels and features of a bounded sample on the driver, in the order of
    its ids."""
    kept = ["rank", "doc_id", *TARGETS]
    rows = _featured(docs, kept).select("rank", "doc_id", F.struct(*TARGETS, "text", "meta").alias("of"))
    # One row per id, however often it comes: the least.
    sample = materialise(rows.groupBy("rank", "doc_id").agg(F.min("of").alias("of")).select("rank", "doc_id", "of.*"), "sample")
    found = []
    for r in sample.toLocalIterator():  # a partition at a time
        found.append((tuple(r[c] for c in kept), *(unpack(r[v]) for v in ("text", "meta"))))
    found.sort(key=lambda r: r[0][:2])
    return [r[0] for r in found], ([r[1] for r in found], [r[2] for r in found])


def train(
    docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL, rounds: int = ROUNDS, sure: float = SURE
) -> dict[str, Model]:
    """A model per target: fits over bounded samples, picked from all rows."""
    ship(docs.sparkSession)
    rank = F.xxhash64(F.col("doc_id").cast("long"))
    merged = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("double").alias("quality"), F.max("toxic").cast("double").alias("toxic"))
        .where("quality IS NOT NULL OR toxic IS NOT NULL")
        .withColumn("rank", rank)
    )
    fields = [c for c in ("text", "lang", "source", "n_chars") if c in docs.columns]
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *fields)
    # At most `labelled` ids a target, of documents that are there, so they are broadcast.
    there = materialise(merged.join(own.select("doc_id"), "doc_id", "left_semi"), "labels")
    chosen = [there.where(F.col(t).isNotNull()).orderBy("rank", "doc_id").limit(labelled) for t in TARGETS]
    chosen = chosen[0].union(chosen[1]).distinct()
    known, views = _sample(own.join(F.broadcast(chosen), "doc_id").select("rank", "doc_id", *TARGETS, *fields))
    if not known:
        return {}
    teams = []
    targets = [t for i, t in enumerate(TARGETS) if any(r[2 + i] is not None for r in known)]
    for i in map(TARGETS.index, targets):
        mine = [k for k, r in enumerate(known) if r[2 + i] is not None]
        teams.append(Team(tuple([v[k] for k in mine] for v in views), np.array([known[k][2 + i] for k in mine], float)))
    if rounds:
        stratum = [F.col(c) for c in ("lang", "source") if c in fields]
        cell = F.pmod(F.xxhash64(*stratum), F.lit(STRATA)).cast("int") if stratum else F.lit(0)
        spare = own.where("doc_id IS NOT NULL").select("doc_id", rank.alias("rank"), cell.alias("cell"), *fields)
        # Packed features, shorter than the text, are what the anti join shuffles.
        spare = _featured(spare, ["doc_id", "rank", "cell"]).join(merged.select("doc_id"), "doc_id", "left_anti")
        spare = materialise(spare, "spare")
        strata = spare.select("cell").distinct().count()  # at most STRATA
        each = max(1, pool // (2 * len(TARGETS) * max(1, strata)))
    for _ in range(rounds):
        picks = _sure(spare, [t.models for t in teams], each, sure)
        if not any([t.learn(p) for t, p in zip(teams, picks, strict=True)]):
            break
    return {target: t.model() for target, t in zip(targets, teams, strict=True)}


def classify(docs: DataFrame, labels: DataFrame, reject: float = REJECT, **options) -> DataFrame:
    """``row`` (the document's columns) and ``out`` (``OUT``) per document."""
    models = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **options))
    at = _places(docs)

    def run(rows: pa.StructArray) -> dict:
        use = models.value
        if not use:
            half = np.full(len(rows), 0.5)
            return {"quality_score": half, "toxic_score": half, "score": half, "keep": np.ones(len(rows), bool)}
        text, meta = _features(rows, at)
        half = np.full(len(rows), 0.5)
        good, bad = (use[t].probability(text, meta) if t in use else half for t in TARGETS)
        score, keep = half, np.ones(len(rows), bool)
        if "quality" in use:
            score, keep = good, good > reject
        if "toxic" in use:
            score, keep = score * (1 - bad), keep & (bad < 1 - reject)
        return {"quality_score": good, "toxic_score": bad, "score": score, "keep": keep}

    return annotate(docs, run, OUT)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier does not reject."""
    return classify(docs, labels, **options).where("out.keep").select("row.*")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return classify(docs, table(spark, sf_dir, "labels")).select("row.doc_id", "out.*")
