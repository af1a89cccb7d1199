"""Pairs of records inside a cell of the block join.

``block_cells`` brings the postings ``(id, token, ...)`` of a block of records
of either side to one task. The functions here are what the task does with
them: token pairs are made by places in arrays, a slice of whole left records
at a time, and summed by pair, so they are never rows of a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Token pairs that are made at once (one left record may make more).
MET_AT_ONCE = 2_000_000


class Side:
    """One side's postings in a cell, in the order of their records."""

    def __init__(self, no: np.ndarray, token: np.ndarray, values: dict[str, np.ndarray], n: int):
        order = slice(None) if (no[1:] >= no[:-1]).all() else np.argsort(no, kind="stable")
        self.no, self.token, self.n = no[order], token[order], n
        self.values = {k: v[order] for k, v in values.items()}

    def only(self, kept: np.ndarray) -> Side:
        return Side(self.no[kept], self.token[kept], {k: v[kept] for k, v in self.values.items()}, self.n)


def _coded(*columns: pa.ChunkedArray) -> tuple[list[np.ndarray], pa.Array]:
    """Numbers that stand for the values of the columns, and the values; null is one."""
    whole = pa.chunked_array([x for c in columns for x in c.chunks], columns[0].type).combine_chunks()
    whole = pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole
    coded = pc.dictionary_encode(whole, null_encoding="encode")
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(number, np.cumsum([len(c) for c in columns])[:-1]), coded.dictionary


class Cell:
    """Both sides of a cell; ``left_by`` and ``right_by`` are the names of
    their ids, columns behind the token are values."""

    def __init__(self, left: pa.Table, right: pa.Table, left_by: str, right_by: str, values: Sequence[str] = ()):
        tokens, self.tokens = _coded(left.column("token"), right.column("token"))
        (a,), self.left_ids = _coded(left.column(left_by))
        (b,), self.right_ids = _coded(right.column(right_by))

        def of(side: pa.Table) -> dict[str, np.ndarray]:
            return {k: side.column(k).to_numpy() for k in values}

        self.left = Side(a, tokens[0], of(left), len(self.left_ids))
        self.right = Side(b, tokens[1], of(right), len(self.right_ids))

    def met(self, left: Side, right: Side) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For slices of left records: the first, the end, and the places of
        all postings of both sides that share a token."""
        each = np.bincount(right.token, minlength=len(self.tokens))
        begin, by_token = np.cumsum(each) - each, np.argsort(right.token, kind="stable")
        n = each[left.token]
        bound = np.searchsorted(left.no, np.arange(left.n + 1))
        work = np.concatenate(([0], np.cumsum(n)))[bound]
        first = 0
        while first < left.n:
            end = max(first + 1, int(np.searchsorted(work, work[first] + MET_AT_ONCE, "right")) - 1)
            mine = np.arange(bound[first], bound[end])
            m = n[mine]
            a = np.repeat(mine, m)
            place = np.arange(len(a)) - np.repeat(np.cumsum(m) - m, m)
            yield first, end, a, by_token[begin[left.token[a]] + place]
            first = end

    def pair(self, left: Side, right: Side, a: np.ndarray, b: np.ndarray, first: int) -> np.ndarray:
        """Numbers of pairs, from 0 for the first right record of ``first``."""
        return (left.no[a] - first) * right.n + right.no[b]

    def ids(self, first: int, pairs: np.ndarray) -> list[pa.Array]:
        return [self.left_ids.take(pa.array(first + pairs // self.right.n)), self.right_ids.take(pa.array(pairs % self.right.n))]

    def scored(self, left: Side, right: Side, value: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For slices of left records: the first, the pairs that share a token,
        and sums of products by number of pair."""
        for first, end, a, b in self.met(left, right):
            pair, size = self.pair(left, right, a, b, first), (end - first) * right.n
            total = np.bincount(pair, left.values[value][a] * right.values[value][b], size)
            yield first, np.flatnonzero(np.bincount(pair, minlength=size)), total


Run = Callable[[pa.Table, pa.Table], pa.Table]


def _table(parts: list[list[pa.Array]], left: pa.Table, right: pa.Table, by: tuple[str, str], more: dict[str, pa.DataType]) -> pa.Table:
    """The parts' rows: both ids, as they are typed in the inputs, and more."""
    schema = pa.schema([(by[0], left.schema.field(by[0]).type), (by[1], right.schema.field(by[1]).type), *more.items()])
    return pa.concat_tables([schema.empty_table(), *[pa.table([x.cast(f.type) for x, f in zip(p, schema, strict=True)], schema=schema) for p in parts]])


def summed(by: tuple[str, str], value: str, name: str) -> Run:
    """(ids, ``name``): sums of products of ``value`` over shared tokens."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            cell = Cell(left, right, *by, [value])
            for first, pairs, total in cell.scored(cell.left, cell.right, value):
                parts.append([*cell.ids(first, pairs), pa.array(total[pairs], from_pandas=True)])
        return _table(parts, left, right, by, {name: pa.float64()})

    return run


def listed(by: tuple[str, str], name: str) -> Run:
    """(ids, ``name``): the sorted shared tokens."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            cell = Cell(left, right, *by)
            n, order = len(cell.tokens), pc.sort_indices(cell.tokens)
            rank, in_order = np.empty(n, np.int64), cell.tokens.take(order)
            rank[order.to_numpy()] = np.arange(n)
            for first, _, a, b in cell.met(cell.left, cell.right):
                keys = np.sort(cell.pair(cell.left, cell.right, a, b, first) * n + rank[cell.left.token[a]])
                pair = keys // n
                new = np.flatnonzero(np.concatenate((np.ones(min(1, len(pair)), bool), pair[1:] != pair[:-1])))
                lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(pair)), pa.int32()), in_order.take(pa.array(keys % n)))
                parts.append([*cell.ids(first, pair[new]), lists])
        return _table(parts, left, right, by, {name: pa.list_(left.schema.field("token").type)})

    return run


def above(by: tuple[str, str], thresholds: Sequence[float], slack: float) -> Run:
    """(ids, threshold, similarity) of the pairs that can reach a threshold.

    Postings carry ``unit`` and ``rest``. Candidates come from the prefixes
    alone; only records that have one are scored."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            cell = Cell(left, right, *by, ["unit", "rest"])
            least = min(thresholds) - slack
            a_side, b_side = (x.only(x.values["rest"] >= least) for x in (cell.left, cell.right))
            found: list[list[np.ndarray]] = [[] for _ in thresholds]
            for first, end, a, b in cell.met(a_side, b_side):
                mine, other = a_side.values["rest"][a], b_side.values["rest"][b]
                pair = cell.pair(a_side, b_side, a, b, first)
                bound, weaker = mine * other, np.minimum(mine, other)
                for level, t in zip(found, thresholds, strict=True):
                    seen = np.zeros((end - first) * b_side.n, bool)
                    seen[pair[(bound >= t - slack) & (weaker >= t - slack)]] = True
                    level.append(np.flatnonzero(seen) + first * b_side.n)
            levels = [np.concatenate(x) for x in found]
            every = np.concatenate(levels)
            asked = [np.zeros(x.n, bool) for x in (cell.left, cell.right)]
            asked[0][every // cell.right.n] = asked[1][every % cell.right.n] = True
            a_side, b_side = (x.only(k[x.no]) for x, k in zip((cell.left, cell.right), asked, strict=True))
            for first, _, total in cell.scored(a_side, b_side, "unit"):
                begin = first * b_side.n
                for level, t in zip(levels, thresholds, strict=True):
                    x, z = np.searchsorted(level, [begin, begin + len(total)])
                    pairs = level[x:z] - begin
                    parts.append([*cell.ids(first, pairs), pa.array(np.full(len(pairs), t)), pa.array(total[pairs], from_pandas=True)])
        return _table(parts, left, right, by, {"threshold": pa.float64(), "similarity": pa.float64()})

    return run
