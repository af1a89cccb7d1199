"""Benchmark decontamination with suffix arrays of the training text.

Documents are read in shards (blocks of rows inside a Spark task). Each shard
gets a suffix array over word numbers, and every suffix of every benchmark
item is binary-searched in it. There is no shuffle: a shard needs nothing but
the benchmark, which is handed out in chunks of bounded size.

The array is sparse: a suffix that leaves the benchmark's vocabulary before
the shortest window is over cannot hold a match, so only runs of benchmark
words of at least that length enter it. With a benchmark that shares its whole
vocabulary with the corpus this is the full suffix array.

A test suffix is found in a range of the array. Equal windows of the benchmark
are one, and ranges of windows of one length do not overlap, so what is made of
all ranges is no more than the array a few times over, however often text and
benchmark repeat themselves. Longest matches come from the array of shard and
benchmark together: that of a place is with the test suffix before or behind
it, and ranks over 1, 2, 4, ... words tell how far the two agree.

A benchmark of several chunks is searched chunk by chunk; what was found is
carried by a digest of the text, and the rows themselves are read once more at
the end.

Defined cases: a null or empty text has no words and is never contaminated;
null or empty items have no windows; rows of equal ``doc_id`` are judged row
by row; items of equal ``item_id`` count once; a null ``item_id`` is named
``null``; an empty benchmark leaves every document clean, an empty table gives
an empty result; other columns are passed through (``rows="row"``) or left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import in_blocks, materialise, only, table, utf8

WINDOW = 13
CHUNK_BYTES = 16 << 20

# Word bytes: digits, letters and all of UTF-8 beyond ASCII; the rest parts words.
_TABLE = bytes(
    (c + 32 if 0x41 <= c <= 0x5A else c) if (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0x80) else 0x20
    for c in range(256)
)

OUT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("longest_match", T.LongType()),
    T.StructField("longest_at", T.LongType()),
    T.StructField("longest_item", T.StringType()),
])
_STATE = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest_match", T.LongType()),
    T.StructField("longest_at", T.LongType()),
    T.StructField("longest_item", T.StringType()),
])


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def suffix_ranks(s: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Order of the suffixes of ``s`` by their first 1, 2, 4, ... symbols, and
    their ranks (equal ones share a rank), until ``depth`` symbols count or
    all differ (prefix doubling)."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    h = 1
    yield order, rank
    while h < depth and n > 1:
        nxt = np.full(n, -1, np.int64)
        nxt[: max(0, n - h)] = rank[h:]
        key = rank * (n + 1) + nxt + 1
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        rank, h = new, 2 * h
        yield order, rank
        if rank[order[-1]] == n - 1:
            break


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Start positions of ``s`` in the order of their suffixes, compared over
    at least ``depth`` symbols."""
    order = np.empty(0, np.int64)
    for order, _ in suffix_ranks(s, depth):  # noqa: B007
        pass
    return order


class Benchmark:
    """A chunk of items: vocabulary, word numbers, windows to search."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        flat: list[int] = []
        self.item: list[str] = []
        bases, sizes = [], []
        for name, text in items:
            ws = words(text)
            if not ws:
                continue
            self.item.append(name)
            bases.append(len(flat))
            sizes.append(len(ws))
            flat += [self.vocab.setdefault(x, len(self.vocab) + 1) for x in ws]
        self.words = np.array(flat, np.int64)
        base, size = np.array(bases, np.int64), np.array(sizes, np.int64)
        need = np.minimum(window, size)
        self.longest, self.shortest = int(size.max(initial=0)), int(need.min()) if len(need) else 0
        self.ends = base + size
        n = size - need + 1
        self.item_of = np.repeat(np.arange(len(n)), n)
        #: First word of every window, and its words.
        self.start = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        self.need = np.repeat(need, n)
        self._merge()

    def _merge(self) -> None:
        """Distinct windows: the first word of one of them, their words, and
        the set of items that have it; sets are numbered."""
        reps, needs, kinds = [], [], []
        names: dict[bytes, int] = {}
        self.sets: list[np.ndarray] = []
        for k in np.unique(self.need).tolist():
            mine = np.flatnonzero(self.need == k)
            grams = np.ascontiguousarray(self.words[self.start[mine][:, None] + np.arange(k)].astype("<u4"))
            _, first, which = np.unique(grams.view(f"V{4 * k}").ravel(), return_index=True, return_inverse=True)
            order = np.lexsort((self.item_of[mine], which.ravel()))
            held, item = which.ravel()[order], self.item_of[mine][order]
            new = np.concatenate(([True], (held[1:] != held[:-1]) | (item[1:] != item[:-1])))
            held, item = held[new], item[new]
            cut = np.concatenate((np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1]))), [len(held)]))
            for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                kind = names.setdefault(item[a:z].tobytes(), len(names))
                if kind == len(self.sets):
                    self.sets.append(item[a:z])
                kinds.append(kind)
            reps.append(self.start[mine][first])
            needs.append(np.full(len(first), k))
        empty = [np.empty(0, np.int64)]
        self.window_start, self.window_need = np.concatenate(reps or empty), np.concatenate(needs or empty)
        self.window_set = np.array(kinds, np.int64)


def _common(s: np.ndarray, at: np.ndarray, q: np.ndarray, start: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Equal symbols of ``s[at:]`` and ``q[start:]``, ``limit`` at most."""
    length = np.zeros(len(at), np.int64)
    live = np.flatnonzero((at < len(s)) & (limit > 0))
    while len(live):
        same = s[at[live] + length[live]] == q[start[live] + length[live]]
        live = live[same]
        length[live] += 1
        live = live[(length[live] < limit[live]) & (at[live] + length[live] < len(s))]
    return length


def _bound(s: np.ndarray, order: np.ndarray, bench: Benchmark, after: bool) -> np.ndarray:
    """For every window the first place in ``order`` whose suffix is not less
    (``after``: is greater) over the window's words: a binary search of all
    windows at once."""
    limit = bench.window_need
    lo, hi = np.zeros(len(limit), np.int64), np.full(len(limit), len(order), np.int64)
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            return lo
        mid = (lo[live] + hi[live]) // 2
        at, start, most = order[mid], bench.window_start[live], limit[live]
        same = _common(s, at, bench.words, start, most)
        whole = same >= most
        place = np.minimum(at + same, len(s) - 1)
        mine = np.where(at + same < len(s), s[place], -1)
        theirs = bench.words[np.minimum(start + same, len(bench.words) - 1)]
        right = np.where(whole, after, mine < theirs)
        lo[live] = np.where(right, mid + 1, lo[live])
        hi[live] = np.where(right, hi[live], mid)


def _spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ``n`` numbers from each start on, end to end."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class _Agreement:
    """How far places of a shard and test suffixes agree, from the ranks of
    the suffixes of both together over 1, 2, 4, ... words."""

    def __init__(self, runs: np.ndarray, stop: np.ndarray, bench: Benchmark):
        # Every separator differs from all others, so no match runs across one.
        both = np.concatenate((runs, [0], np.insert(bench.words, bench.ends, 0)))
        mark = np.concatenate((stop, [len(runs)], len(runs) + 1 + bench.ends + np.arange(len(bench.ends))))
        both[mark] = -1 - np.arange(len(mark))
        self.n, self.tests = len(both), len(runs) + 1 + bench.start + bench.item_of  # a separator for each item before
        self.levels, order = [], np.empty(0, np.int64)
        for order, rank in suffix_ranks(both, bench.longest + 1):  # noqa: B007
            self.levels.append(rank.astype(np.int32))
        self.at = np.empty(self.n, np.int64)
        self.at[order] = np.arange(self.n)

    def words(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        length = np.zeros(len(a), np.int64)
        for h in range(len(self.levels) - 1, -1, -1):
            there = np.flatnonzero((a + length < self.n) & (b + length < self.n))
            same = there[self.levels[h][a[there] + length[there]] == self.levels[h][b[there] + length[there]]]
            length[same] += 1 << h
        return length


class _Longest:
    """Longest matches of places with some of the test suffixes: each is with
    the one before or behind it in the order of all."""

    def __init__(self, agreement: _Agreement, places: np.ndarray, tests: np.ndarray, item: np.ndarray):
        by = np.argsort(agreement.at[tests], kind="stable")
        self.agreement, self.places, self.tests, self.item = agreement, places, tests[by], item[by]
        self.where = np.searchsorted(agreement.at[self.tests], agreement.at[places])
        before, behind = np.maximum(self.where - 1, 0), np.minimum(self.where, len(tests) - 1)
        self.full = np.maximum(agreement.words(places, self.tests[before]), agreement.words(places, self.tests[behind]))
        self.steps: np.ndarray | None = None

    def least_item(self, k: int) -> int:
        """The least item whose suffix has the match of the k-th place."""
        if self.steps is None:
            self.steps = self.agreement.words(self.tests[:-1], self.tests[1:])
        short = np.flatnonzero(self.steps < self.full[k])
        near = min(int(self.where[k]), len(self.tests) - 1)
        if self.agreement.words(self.places[k : k + 1], self.tests[near : near + 1])[0] < self.full[k]:
            near -= 1
        cut = int(np.searchsorted(short, near))
        low = int(short[cut - 1]) + 1 if cut else 0
        high = int(short[cut]) + 1 if cut < len(short) else len(self.tests)
        return int(self.item[low:high].min())


def search(docs: list[list[bytes]], bench: Benchmark) -> list[tuple[list[int], list[str], int, int, str | None]]:
    """Per document: hit word positions, items found, and the longest match
    (words, where it starts, whose it is; of equal ones the first place, then
    the first item)."""
    nothing: tuple[list[int], list[str], int, int, str | None] = ([], [], 0, -1, None)
    out = [nothing] * len(docs)
    if not bench.shortest:
        return out
    get = bench.vocab.get
    sizes = np.array([len(d) + 1 for d in docs], np.int64)
    s = np.zeros(int(sizes.sum()), np.int64)
    first = np.cumsum(sizes) - sizes
    for d, at in zip(docs, first.tolist(), strict=True):
        if d:
            s[at : at + len(d)] = [get(w, 0) for w in d]
    # Runs of benchmark words; those too short for any window are left out.
    known = s > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
    begin, stop = edge[::2], edge[1::2]
    keep = stop - begin >= bench.shortest
    begin, stop = begin[keep], stop[keep]
    if not len(begin):
        return out
    span = stop - begin + 1  # with one 0 after each run
    where = _spread(begin, span)
    runs = s[where]
    ends = np.cumsum(span) - 1
    runs[ends] = 0
    order = suffix_array(runs, bench.window)
    low, high = _bound(runs, order, bench, False), _bound(runs, order, bench, True)
    cover, begins, pairs = np.zeros(len(s) + 1, np.int64), {}, []
    for k in np.unique(bench.window_need[high > low]).tolist():
        met = np.flatnonzero((bench.window_need == k) & (high > low))
        n = high[met] - low[met]
        at = order[_spread(low[met], n)]  # ranges of one length share no place
        begins[k] = at
        spot = where[at]
        np.add.at(cover, spot, 1)
        np.add.at(cover, spot + k, -1)
        doc = np.searchsorted(first, spot, side="right") - 1
        pairs.append(np.unique(doc * len(bench.sets) + np.repeat(bench.window_set[met], n)))
    if not pairs:
        return out
    # Only runs with a hit take part in the search for the longest matches.
    run_of = np.repeat(np.arange(len(span)), span)
    alive = np.zeros(len(span), bool)
    alive[run_of[np.concatenate(list(begins.values()))]] = True
    kept = np.flatnonzero(alive[run_of])
    spot = where[kept]
    agreement = _Agreement(runs[kept], np.flatnonzero(np.isin(kept, ends)), bench)
    best: dict[int, tuple[int, int, int]] = {}
    for k, at in begins.items():
        mine = bench.need == k  # a match counts if it holds a whole window of its item
        found = _Longest(agreement, np.searchsorted(kept, at), agreement.tests[mine], bench.item_of[mine])
        doc = np.searchsorted(first, spot[found.places], side="right") - 1
        order = np.lexsort((spot[found.places], -found.full, doc))
        order = order[np.concatenate(([True], doc[order][1:] != doc[order][:-1]))]
        for i, d in zip(order.tolist(), doc[order].tolist(), strict=True):
            match = -int(found.full[i]), int(spot[found.places[i]]), found.least_item(i)
            best[d] = min(best.get(d, match), match)
    hits = np.cumsum(cover[:-1]) > 0
    sets = np.unique(np.concatenate(pairs))
    of_doc = sets // len(bench.sets)
    for d, (most, at, item) in best.items():
        a = int(first[d])
        hit = np.flatnonzero(hits[a : a + int(sizes[d])])
        mine = sets[np.searchsorted(of_doc, d) : np.searchsorted(of_doc, d, side="right")] % len(bench.sets)
        items = np.unique(np.concatenate([bench.sets[i] for i in mine.tolist()]))
        out[d] = (hit.tolist(), sorted({bench.item[i] for i in items.tolist()}), -most, at - a, bench.item[item])
    return out


def _chunks(bench: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> list[DataFrame]:
    """The benchmark in chunks of about ``chunk_bytes`` of text: as many as
    its measured size asks for, items dealt by hash of the id and the text."""
    rows = bench.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-int(total) // chunk_bytes))
    if n == 1:
        return [rows]
    return [rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) for i in range(n)]


def find_contamination(
    docs: DataFrame,
    bench: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``row`` (the document's columns) and ``out`` (``OUT``) per document.

    The benchmark goes to the tasks chunk by chunk. When it needs more than
    one, each chunk's search returns what it found beside a digest of the
    text (equal texts are found alike), and the rows are joined with all
    of it in the end; the rows themselves are never rewritten."""
    from pyspark.sql.pandas.types import to_arrow_schema

    state_arrow, out_arrow = to_arrow_schema(_STATE), to_arrow_schema(OUT)
    text_at = docs.columns.index(text_col)
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    chunks = _chunks(bench, item_col, item_text_col, chunk_bytes)
    if len(chunks) == 1:
        shared = _shared(chunks[0])

        def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, state in _states(batches, shared.value, window, text_at):
                yield pa.RecordBatch.from_arrays([rows, pa.array([_result(x) for x in state], pa.struct(list(out_arrow)))], ["row", "out"])

        return df.mapInArrow(once, T.StructType([T.StructField("row", docs.schema), T.StructField("out", OUT)]))

    digest = F.sha2(F.coalesce(F.col(f"row.`{text_col}`").cast("binary"), F.lit(b"")), 256)
    found = None
    for chunk in chunks:
        shared = _shared(chunk)

        def some(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for rows, state in _states(batches, shared.value, window, 0):
                met = [i for i, x in enumerate(state) if x["hit"]]
                if met:
                    yield pa.RecordBatch.from_arrays(
                        [rows.field(1).take(pa.array(met)), pa.array([state[i] for i in met], pa.struct(list(state_arrow)))], ["digest", "state"]
                    )

        texts = df.select(F.struct(F.col(f"row.`{text_col}`").alias("text"), digest.alias("digest")).alias("row"))
        part = texts.mapInArrow(some, T.StructType([T.StructField("digest", T.StringType()), T.StructField("state", _STATE)]))
        # A text that many rows have is found once.
        part = materialise(part.groupBy("digest").agg(F.first("state").alias("state")), "contamination")
        found = part if found is None else found.union(part)
    found = materialise(found.groupBy("digest").agg(F.collect_list("state").alias("states")), "contamination")  # one of each chunk
    joined = df.withColumn("digest", digest).join(found, "digest", "left").select("row", "states")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = batch.column(0), []
            for text, states in zip(utf8(rows.field(text_at)), batch.column(1).to_pylist(), strict=True):
                whole = {"n_words": len(words(text)), "hit": [], "items": [], "longest_match": 0, "longest_at": -1, "longest_item": None}
                for x in states or []:
                    whole["hit"], whole["items"] = sorted({*whole["hit"], *x["hit"]}), sorted({*whole["items"], *x["items"]})
                best = min(states or [whole], key=lambda x: (-x["longest_match"], x["longest_at"], x["longest_item"] or ""))
                whole.update((c, best[c]) for c in ("longest_match", "longest_at", "longest_item"))
                out.append(_result(whole))
            yield pa.RecordBatch.from_arrays([rows, pa.array(out, pa.struct(list(out_arrow)))], ["row", "out"])

    return joined.mapInArrow(merged, T.StructType([T.StructField("row", docs.schema), T.StructField("out", OUT)]))


def _shared(chunk: DataFrame) -> Broadcast:
    """The items of a chunk, sorted, for the tasks."""
    items = sorted(("null" if r[0] is None else r[0], bytes(r[1] or b"")) for r in chunk.toLocalIterator())
    return chunk.sparkSession.sparkContext.broadcast(items)


def _states(batches: Iterator[pa.RecordBatch], items: list[tuple[str, bytes]], window: int, text_at: int) -> Iterator[tuple[pa.StructArray, list[dict]]]:
    """Blocks of rows (the first column) and what the chunk's search found."""
    only("decontaminate")
    chunk = Benchmark(items, window)
    for batch in in_blocks(batches):
        rows = batch.column(0)
        texts = [words(x) for x in utf8(rows.field(text_at))]
        yield rows, [
            {"n_words": len(ws), "hit": hit, "items": names, "longest_match": most, "longest_at": at, "longest_item": item}
            for ws, (hit, names, most, at, item) in zip(texts, search(texts, chunk), strict=True)
        ]


def _result(x: dict) -> dict:
    names = sorted(x["items"])
    return {
        "n_words": x["n_words"],
        "n_hit": len(x["hit"]),
        "n_items": len(names),
        "items_sha256": hashlib.sha256(",".join(names).encode()).hexdigest(),
        "contaminated": len(x["hit"]) > 0 and 20 * len(x["hit"]) >= x["n_words"],
        "longest_match": x["longest_match"],
        "longest_at": x["longest_at"],
        "longest_item": x["longest_item"],
    }


def decontaminate(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return find_contamination(docs, bench, **options).where(~F.col("out.contaminated")).select("row.*")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", *[f"out.{c}" for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")])


_WORDS = (
    "regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark),
bk AS (SELECT item_id, w, least({WINDOW}, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS key
       FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
sizes AS (SELECT DISTINCT k FROM bk),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS key
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes)),
found AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.key = bw.key),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
