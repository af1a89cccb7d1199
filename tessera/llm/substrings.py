"""Substring dedup by relative Lempel-Ziv parsing.

A document is cut greedily into factors, each a passage of reference text as
long as it goes on, and words inside sufficiently long factors are removed.
Reference text is all documents with a smaller id; which part of it a document
must meet is found through an index over all blocks of documents, for every
document against every block would be quadratic:

* the index has the phrases of ``window`` words of all blocks, in buckets by
  range of their hash. A phrase's entry is the first place that has it: of the
  document with the least id, its first. All phrases of a corpus would be as
  many as its words, so blocks first exchange anchors, the least hash of the
  short phrases inside a long one; equal long phrases have equal anchors, hence
  only those whose anchor occurs in two documents are indexed;
* a factor starts at the first phrase that has an earlier place and runs on
  while the places of its phrases run on in that reference text. Phrases across
  the end of a factor are looked up as any other, so the next factor may begin
  before it, and no passage hides at a boundary. Phrases of which each has its
  earliest place elsewhere (many near copies, a few words over and over) would
  make a factor for every word; of overlapping factors only as many are kept as
  hold all their words;
* each distinct passage that factors refer to is cut from its block once and
  sent to the blocks that need it, where factors are compared with it word by
  word. Only words inside ``window`` or more equal ones in a row are removed, so
  the hashes decide what is compared and nothing else.

A passage that a third of all documents hold is one entry of the index, is cut
once, and is sent once to each block of documents; the join that deals it out
is one that Spark can split.

Defined cases: a null or empty text has no words; a text shorter than the
window keeps all its words; a row without an id is neither reference nor
changed; rows of one id are no duplicates of each other; other columns are
passed through; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import exchange as ex
from tessera.llm.common import in_blocks, materialise, only, table, trim, utf8

WINDOW = 50
BLOCK = 8 << 20  # bytes of text in a block of documents
SHORT = 10  # words of the short phrases that anchors come from
_BASE = np.uint64(0x9E3779B97F4A7C13)  # 3 modulo 8: its powers differ in high bits
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C13, -1, 1 << 64))

OUT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_sha256", T.StringType()),
    T.StructField("kept_text", T.StringType()),
    T.StructField("factors", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("source", T.LongType()),
    ]))),
])
ANCHORS, PHRASES, PASSAGES = 1, 2, 3
CUT = "source long, start long, length long, words binary"


def phrase_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` words in a row, for each first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power = np.full(len(hashes), _BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * power, dtype=np.uint64)))
    back = np.full(n, _INVERSE)
    back[0] = 1
    return ex.mix((total[size:] - total[:n]) * np.multiply.accumulate(back))


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """Least of every ``size`` values in a row."""
    have = 1
    while 2 * have <= size:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (size - have)], x[size - have :]) if size > have else x


class Block:
    """Words and phrases of a block of documents."""

    def __init__(self, rows: pa.RecordBatch, id_at: int, text_at: int, window: int):
        self.rows, self.window = rows, window
        ids = rows.column(id_at)
        self.ids = np.array(ids.fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        self.known = np.array(ids.is_valid())
        number, self.offsets, words = ex.split_words(rows.column(text_at))
        self.hashes = ex.word_hashes(words)[number] if len(number) else np.empty(0, np.uint64)
        # First words of phrases inside one document that has an id.
        sizes = np.diff(self.offsets)
        n = np.where(self.known, np.maximum(0, sizes - window + 1), 0)
        ends = np.cumsum(n)
        self.first = np.repeat(self.offsets[:-1] - (ends - n), n) + np.arange(int(n.sum()))
        self.doc = np.repeat(np.arange(len(sizes)), n)
        self.doc_id = self.ids[self.doc]
        self.cut = np.concatenate(([0], ends))

    def anchors(self) -> np.ndarray:
        short = min(SHORT, self.window)
        if not len(self.first):
            return np.empty(0, np.uint64)
        # Least values crowd at the low end; mixed again they fill all buckets alike.
        return ex.mix(_least(phrase_hashes(self.hashes, short), self.window - short + 1)[self.first])

    def phrases(self) -> np.ndarray:
        return phrase_hashes(self.hashes, self.window)[self.first] if len(self.first) else np.empty(0, np.uint64)


def _span(keys: np.ndarray, ids: np.ndarray, places: bool = False) -> tuple[np.ndarray, ...]:
    """Distinct keys with their least and greatest document; with ``places``
    also the first entry that has both the key and the least document."""
    order = np.lexsort((ids, keys))
    ranked, mine = keys[order], ids[order]
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(ranked)), bool), ranked[1:] != ranked[:-1])))
    last = np.concatenate((new[1:], [len(ranked)])) - 1 if len(new) else new
    found = ranked[new], mine[new], mine[last]
    return (*found, order[new]) if places else found


def dedup_substrings(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, with_factors: bool = False
) -> DataFrame:
    """``row`` (the document's columns) and ``out`` (``OUT``) per document;
    ``kept_text`` and ``factors`` are null unless asked for."""
    docs = docs.withColumn(id_col, F.col(id_col).cast("long")) if docs.schema[id_col].dataType != T.LongType() else docs
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("substrings")
        part = TaskContext.get().partitionId()
        for i, rows in enumerate(in_blocks(batches, BLOCK)):
            block = Block(rows, id_at, text_at, window)
            anchors = block.anchors()
            change = np.flatnonzero(np.concatenate((np.ones(min(1, len(anchors)), bool), (anchors[1:] != anchors[:-1]) | (block.doc[1:] != block.doc[:-1]))))
            keys, low, high = _span(anchors[change], block.doc_id[change])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + i]), pa.array([len(keys)]), pa.array([len(block.first)]),
                    pa.array([ex.pack_keys(keys)]), pa.array([ex.pack_ints(low)]), pa.array([ex.pack_ints(high)]),
                    pa.array([ex.pack_rows(rows)], pa.binary()),
                ],
                ["block", "n_anchors", "n_phrases", "keys", "low", "high", "rows"],
            )
            del rows, block, anchors, change, keys, low, high
            trim()

    blocks = materialise(
        docs.mapInArrow(cut, "block long, n_anchors long, n_phrases long, keys binary, low binary, high binary, rows binary"), "blocks"
    )
    n_anchors, n_phrases = ex.total(blocks, "n_anchors", "n_phrases")
    few, many = ex.bucket_count(n_anchors), ex.bucket_count(n_phrases)

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, low, high in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                yield ex.requests(block, ex.unpack_keys(keys), [ex.unpack_ints(low), ex.unpack_ints(high)], few)

    def shared(known: list[np.ndarray], new: np.ndarray) -> list[np.ndarray]:
        return [(np.minimum.reduceat(known[0], new) < np.maximum.reduceat(known[1], new)).astype(np.int64)]

    asked = blocks.select("block", "keys", "low", "high").mapInArrow(ask_anchors, ex.REQUEST)
    told = materialise(ex.answer(asked, ANCHORS, shared), "anchor-replies")

    def opened(left: pa.Table, right: pa.Table) -> tuple[int, Block, np.ndarray, np.ndarray, np.ndarray]:
        """The block, its phrases that may be held elsewhere (places), their
        hashes, and the distinct ones."""
        block = Block(unpack_one(left, "rows"), id_at, text_at, window)
        anchors = block.anchors()
        keys = np.unique(anchors)
        (flag,) = ex.replies(right, ANCHORS, 1, len(keys))
        places = np.flatnonzero(flag[np.searchsorted(keys, anchors)]) if len(keys) else np.empty(0, np.int64)
        phrases = block.phrases()[places]
        return left.column("block")[0].as_py(), block, places, phrases, np.unique(phrases)

    def ask_phrases(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([ex.no_requests()])
        number, block, places, phrases, _ = opened(left, right)
        keys, low, _, at = _span(phrases, block.doc_id[places], places=True)
        known = [low, np.full(len(keys), number), block.first[places][at]]
        return pa.Table.from_batches([ex.requests(number, keys, known, many)])

    def earliest(known: list[np.ndarray], new: np.ndarray) -> list[np.ndarray]:
        """Of each phrase the least document, its block and place in that."""
        group = np.repeat(np.arange(len(new)), np.diff(np.concatenate((new, [len(known[0])]))))
        order = np.lexsort((known[2], known[1], known[0], group))[new]
        return [x[order] for x in known]

    bodies = blocks.select("block", "rows")
    anchored = told
    found = materialise(ex.answer(ex.per_block(bodies, anchored, ask_phrases, ex.REQUEST), PHRASES, earliest), "phrase-replies")
    both = anchored.union(found)

    def factor(left: pa.Table, right: pa.Table) -> pa.Table:
        """A block's factors: where they start in it, their words, and the
        block and place they are to be compared with."""
        rows = np.empty((0, 6), np.int64)
        if left.num_rows:
            number, block, places, phrases, keys = opened(left, right)
            low, source, place = ex.replies(right, PHRASES, 3, len(keys))
            if len(keys):
                spot = np.searchsorted(keys, phrases)
                held = low[spot] < block.doc_id[places]
                here, doc = block.first[places][held], block.doc[places][held]
                start, length, entry = needed(*factors(here, doc, source[spot][held], place[spot][held], window))
                rows = np.column_stack([np.full(len(start), number), start, length, *(x[spot][held][entry] for x in (source, place, low))])
        return pa.table({n: pa.array(rows[:, i]) for i, n in enumerate(("block", "at", "length", "source", "start", "doc"))})

    parsed = materialise(ex.per_block(bodies, both, factor, "block long, at long, length long, source long, start long, doc long"), "factors")
    asked = parsed.select("block", "source", "start", "length").distinct()
    wanted = materialise(asked.select("source", "start", "length").distinct(), "passages")

    def cut_passages(left: pa.Table, right: pa.Table) -> pa.Table:
        starts, lengths = (right.column(c).to_numpy() for c in ("start", "length"))
        out = []
        if left.num_rows and right.num_rows:
            texts = utf8(unpack_one(left, "rows").column(text_at))
            edge, cuts = 0, iter(np.argsort(starts, kind="stable").tolist())
            mine = next(cuts, None)
            for text in texts:
                words = text.split()
                while mine is not None and starts[mine] < edge + len(words):
                    a = int(starts[mine]) - edge
                    out.append((mine, b" ".join(words[a : a + int(lengths[mine])])))
                    mine = next(cuts, None)
                edge += len(words)
        which = pa.array([i for i, _ in out], pa.int64())
        packer = zstandard.ZstdCompressor(level=1)
        cols = [right.column(c).take(which).combine_chunks() for c in ("source", "start", "length")]
        return pa.table([*cols, pa.array([packer.compress(w) for _, w in out], pa.binary())], names=["source", "start", "length", "words"])

    by_source = bodies.withColumnRenamed("block", "source").groupBy("source").cogroup(wanted.groupBy("source"))
    passages = materialise(by_source.applyInArrow(cut_passages, CUT), "passage-words")
    sent = materialise(asked.join(passages, ["source", "start", "length"]), "passages-sent")

    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("out", OUT)])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    # Factors and the passages they are compared with, as one table beside the blocks.
    none = F.lit(None)
    evidence = parsed.select("block", "source", "start", "length", "at", "doc", none.cast("binary").alias("words")).union(
        sent.select("block", "source", "start", "length", none.cast("long"), none.cast("long"), "words")
    )

    def parse(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return arrow.empty_table()
        rows = unpack_one(left, "rows")
        opener = zstandard.ZstdDecompressor()
        passage, mine = {}, []
        for source, start, length, at, doc, words in zip(*[right.column(c).to_pylist() for c in ("source", "start", "length", "at", "doc", "words")], strict=True):
            if words is None:
                mine.append((at, (source, start, length), doc))
            else:
                passage[source, start, length] = words
        mine.sort()
        out, edge, k = [], 0, 0
        for raw in utf8(rows.column(text_at)):
            words = raw.split()
            spans = []
            while k < len(mine) and mine[k][0] < edge + len(words):
                at, named, doc = mine[k]
                reference = opener.decompress(passage[named]).split(b" ")
                spans += [(x, n, doc) for x, n in equal_runs(words, at - edge, reference, window)]
                k += 1
            edge += len(words)
            kept = words
            if spans:
                gone = np.zeros(len(words) + 1, np.int32)
                np.add.at(gone, [x for x, *_ in spans], 1)
                np.add.at(gone, [x + n for x, n, *_ in spans], -1)
                kept = [w for w, x in zip(words, (np.cumsum(gone[:-1]) > 0).tolist(), strict=True) if not x]
            line = b" ".join(kept)
            out.append({
                "n_words": len(words), "n_removed": len(words) - len(kept), "kept_sha256": hashlib.sha256(line).hexdigest(),
                "kept_text": (line if spans else raw).decode() if with_text else None,
                "factors": [{"start": x, "length": n, "source": s} for x, n, s in spans] if with_factors else None,
            })
        row = pa.StructArray.from_arrays([rows.column(i).cast(f.type) for i, f in enumerate(arrow.field("row").type)], fields=list(arrow.field("row").type))
        return pa.table([row, pa.array(out, arrow.field("out").type)], schema=arrow)

    return ex.per_block(bodies, evidence, parse, schema)


def unpack_one(blocks: pa.Table, column: str) -> pa.RecordBatch:
    return ex.unpack_rows(blocks.column(column)[0].as_py())


def factors(here: np.ndarray, doc: np.ndarray, source: np.ndarray, place: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy factors over the phrases (first words ``here``, ascending) that
    have an earlier place: start and words of each, and its first phrase. A
    factor goes on while the next phrase begins a word later in the document
    and in the reference text."""
    if not len(here):
        return here, here, here
    more = (here[1:] == here[:-1] + 1) & (doc[1:] == doc[:-1]) & (source[1:] == source[:-1]) & (place[1:] == place[:-1] + 1)
    first = np.flatnonzero(np.concatenate(([True], ~more)))
    last = np.concatenate((first[1:], [len(here)])) - 1
    return here[first], here[last] - here[first] + window, first


def needed(start: np.ndarray, length: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of factors (starts and ends ascend) as few as hold the same words: from
    each one on the last that begins in it or right behind it."""
    kept, starts, ends = [], start.tolist(), (start + length).tolist()
    at = 0
    while at < len(starts):
        kept.append(at)
        at = max(at + 1, bisect_right(starts, ends[at]) - 1)
    which = np.array(kept, np.int64)
    return start[which], length[which], first[which]


def equal_runs(words: list[bytes], at: int, passage: list[bytes], window: int) -> list[tuple[int, int]]:
    """Runs of at least ``window`` words from ``at`` on that equal the
    passage's: start and words."""
    if words[at : at + len(passage)] == passage:
        return [(at, len(passage))]
    out, begin = [], at
    for i, word in enumerate([*passage, None], at):
        if i >= len(words) or words[i] != word:
            if i - begin >= window:
                out.append((begin, i - begin))
            begin = i + 1
    return out


def without_duplicates(docs: DataFrame, **options) -> DataFrame:
    """All documents with duplicate spans cut from their text; a text that
    loses words is its kept words joined by one space, others stay as they
    are. ``n_chars``, if there, follows."""
    found = dedup_substrings(docs, with_text=True, **options)
    text = options.get("text_col", "text")
    cols = []
    for c in docs.columns:
        if c == text:
            cols.append(F.when(F.col(f"row.`{c}`").isNotNull(), F.col("out.kept_text")).alias(c))
        elif c == "n_chars":
            changed = F.length("out.kept_text").cast(docs.schema[c].dataType)
            cols.append(F.when(F.col("out.n_removed") > 0, changed).otherwise(F.col("row.n_chars")).alias(c))
        else:
            cols.append(F.col(f"row.`{c}`").alias(c))
    return found.select(*cols)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs).select("row.doc_id", "out.n_words", "out.n_removed", "out.kept_sha256")


SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS phrase
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
held AS (SELECT doc_id, i FROM p JOIN (SELECT phrase, min(doc_id) AS least FROM p GROUP BY phrase) USING (phrase)
         WHERE least < doc_id),
gone AS (SELECT doc_id, list(DISTINCT x) AS places
         FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS x FROM held) GROUP BY doc_id),
kept AS (SELECT doc_id, w, coalesce(len(places), 0) AS n_removed,
                CASE WHEN places IS NULL THEN w
                     ELSE [w[x] for x in range(1, len(w) + 1) if NOT list_contains(places, x)] END AS k
         FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept
"""
