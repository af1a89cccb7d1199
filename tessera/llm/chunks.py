"""Encode each distinct chunk of a text once.

A text is cut before every single space that stands between two characters
that are no white space. Neither a byte-level pre-tokenizer nor a piece model
whose pieces hold no inner word mark makes a token across such a place, so the
ids of a text are those of its chunks, joined. The library encodes the chunks;
what it returned is kept for the next texts, in a store of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CAPACITY = 1_000_000

GROUP = 4_000_000  # characters that are in words at a time

_CUT = re.compile(r"(?<=\S)(?= \S)")
_BLANK_BEHIND = re.compile(r" (?:\s|\Z)")
_BLANK_BEFORE = re.compile(r"[^\S ] ")


class _Store:
    """Ids by chunk; when it would outgrow its capacity, all but those asked
    for just now are dropped."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], capacity: int):
        self.encode, self.capacity = encode, capacity
        self.known: dict[str, bytes] = {}

    def ids(self, wanted: list[str]) -> list[bytes]:
        """Ids of distinct chunks."""
        found = list(map(self.known.get, wanted))
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            chunks = [wanted[i] for i in missing]
            made = self.encode(chunks)
            if len(self.known) + len(missing) > self.capacity:
                # What is asked for again was often asked for before.
                self.known = {c: x for c, x in zip(wanted, found, strict=True) if x is not None}
            self.known.update(zip(chunks, made, strict=True))
            for i, x in zip(missing, made, strict=True):
                found[i] = x
        return found


class ChunkEncoder:
    """``encode_first`` encodes strings that begin a text, ``encode_rest``
    those that follow a space, given without it. Both return the ids as
    little-endian unsigned 32-bit integers. Texts of which ``whole`` is true
    are never cut."""

    def __init__(
        self,
        encode_first: Callable[[list[str]], list[bytes]],
        encode_rest: Callable[[list[str]], list[bytes]],
        whole: Callable[[str], bool],
        capacity: int = CAPACITY,
    ):
        self.whole, self.encode_first, self.encode_rest = whole, encode_first, encode_rest
        self.rest = _Store(encode_rest, capacity)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        out = [b""] * len(texts)
        cut, alone = [], []
        for i, text in enumerate(texts):
            if text:
                (alone if self.whole(text) else cut).append(i)
        if cut:
            for i, ids in zip(cut, self._cut([texts[i] for i in cut]), strict=True):
                out[i] = ids
        if alone:
            for i, ids in zip(alone, self.encode_first([texts[i] for i in alone]), strict=True):
                out[i] = ids
        return out

    def _cut(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        even = [i for i, text in enumerate(texts) if not _ragged(text)]
        if even:
            heads = [texts[i].partition(" ")[0] for i in even]
            for i, ids in zip(even, self.encode_first(heads), strict=True):
                out[i] = ids
            for group in _groups(even, heads, texts):
                for (i, _), ids in zip(group, self._behind_spaces([part for _, part in group]), strict=True):
                    out[i] += ids
        for i in set(range(len(texts))).difference(even):
            head, *tail = _CUT.split(texts[i])
            out[i] = b"".join([*self.encode_first([head]), *(self.encode_rest([x[1:] for x in tail]) if tail else [])])
        return out

    def _behind_spaces(self, parts: list[str]) -> Iterator[bytes]:
        """Ids of parts that begin with a space: Arrow numbers their words and
        lays out the ids by number, only distinct words are looked up."""
        words = pc.split_pattern(pa.array(parts, pa.large_string()), " ")
        coded = words.flatten().dictionary_encode()
        # The first is empty, before each part's first space. By way of numpy, as to_pylist makes a scalar of each.
        distinct = coded.dictionary[1:].to_numpy(zero_copy_only=False).tolist()
        ids = pa.array([b"", *self.rest.ids(distinct)], pa.large_binary()).take(coded.indices)
        _, at, data = ids.buffers()
        ends = np.frombuffer(at, np.int64)[words.offsets.to_numpy()].tolist()
        raw = memoryview(data or b"")
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield bytes(raw[a:b])


def _ragged(text: str) -> bool:
    """Whether a space stands beside other white space or at an end."""
    return text[0] == " " or _BLANK_BEHIND.search(text) is not None or _BLANK_BEFORE.search(text) is not None


def _groups(places: list[int], heads: list[str], texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """What follows the heads of texts, with their places, in groups of about
    ``GROUP`` characters; a longer text is cut before a space and so in several
    groups, in order."""
    group, size = [], 0
    for i, head in zip(places, heads, strict=True):
        at, text = len(head), texts[i]
        while at < len(text):
            end = text.find(" ", at + GROUP)
            part = text[at : end if end > 0 else len(text)]
            group.append((i, part))
            at, size = at + len(part), size + len(part)
            if size >= GROUP:
                yield group
                group, size = [], 0
    if group:
        yield group
