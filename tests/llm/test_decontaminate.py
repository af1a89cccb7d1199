"""Decontamination against a plain search of every window."""

import hashlib
import time

import numpy as np
import pytest

from tessera.llm.decontaminate import Benchmark, decontaminate, find_contamination, search, suffix_array, words

FIELDS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def plain(text, items, window=13):
    ws = words((text or "").encode())
    hit, names = set(), set()
    for name, item in items:
        iw = words((item or "").encode())
        k = min(window, len(iw))
        grams = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if iw else set()
        for i in range(len(ws) - k + 1):
            if tuple(ws[i : i + k]) in grams:
                hit.update(range(i, i + k))
                names.add("null" if name is None else str(name))
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(ws), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(ws)


@pytest.fixture(scope="module")
def items():
    a = " ".join(f"q{i}" for i in range(40))
    return [(1, a), (2, "short item"), (3, None), (4, "..."), (1, "again " + a), (None, "nameless one here"), (10, "short item"), (6, "r r r r r r r r r r r r r r r r r")]


@pytest.fixture(scope="module")
def rows(items):
    a = items[0][1]
    return [
        (1, a), (2, "x " * 500 + a), (3, "Short, ITEM!"), (4, None), (5, ""), (6, "r " * 40), (6, "r " * 40), (7, "nothing to see"),
        (None, "a nameless one here"), (8, " ".join(a.split()[:12])), (9, " ".join(a.split()[5:18]) + " " + "y " * 20), (10, "short y item " + "r " * 12),
    ]


@pytest.mark.parametrize("chunk_bytes", [1 << 24, 60])
def test_against_plain_search(spark, make_docs, rows, items, chunk_bytes):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find_contamination(make_docs(rows).repartition(2), bench, chunk_bytes=chunk_bytes).select("row.doc_id", "row.text", "out.*").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[f] for f in FIELDS) == plain(r["text"], items), r["text"]
    longest = {r["text"]: r["longest_match"] for r in got}
    assert longest[rows[0][1]] == 40


def test_clean_rows_keep_their_columns(spark, make_docs, rows, items):
    docs = make_docs(rows)
    left = decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(i) for i, t in rows if not plain(t, items)[4])


def test_empty_tables(spark, make_docs, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(make_docs(rows), none).count() == len(rows)
    assert find_contamination(make_docs([]), none).collect() == []


def test_suffix_array_is_sorted():
    s = np.random.default_rng(1).integers(0, 3, 300)
    order = suffix_array(s, 300)
    suffixes = [tuple(s[i:]) for i in order]
    assert suffixes == sorted(suffixes)


def test_random_texts():
    rng = np.random.default_rng(2)
    for _ in range(30):
        items = [(str(i), " ".join(f"w{x}" for x in rng.integers(0, 4, rng.integers(1, 12)))) for i in range(5)]
        docs = [" ".join(f"w{x}" for x in rng.integers(0, 6, rng.integers(0, 60))) for _ in range(6)]
        bench = Benchmark([(n, t.encode()) for n, t in items], 4)
        for text, found in zip(docs, search([words(t.encode()) for t in docs], bench), strict=True):
            want = plain(text, items, 4)
            assert (len(found[0]), len(found[1])) == want[1:3]
            assert found[2:] == longest(text, items, 4)


def longest(text, items, window):
    """Longest match by trying every pair of places: words, place, item."""
    ws, best = words(text.encode()), (0, -1, None)
    for name, item in items:
        iw = words(item.encode())
        k = min(window, len(iw))
        for i in range(len(iw) - k + 1 if iw else 0):
            for at in range(len(ws)):
                n = 0
                while at + n < len(ws) and i + n < len(iw) and ws[at + n] == iw[i + n]:
                    n += 1
                if n >= k and (-n, at, name) < (-best[0], best[1], best[2] or ""):
                    best = n, at, name
    return best


def test_repetitive_text_is_no_product():
    """Two hundred thousand equal words against an item of two thousand."""
    bench = Benchmark([("a", b"r " * 2000), ("b", b"r " * 20 + b"end"), ("c", b"r r")], 13)
    assert len(bench.window_start) == 3  # 13 equal words, with the end, and two words
    docs = [[b"r"] * 200_000, [b"r"] * 40 + [b"end"], [b"x"] * 100_000]
    start = time.process_time()
    one, two, none = search(docs, bench)
    assert time.process_time() - start < 5
    assert (len(one[0]), one[1:]) == (200_000, (["a", "b", "c"], 2000, 0, "a"))
    assert (len(two[0]), two[1:]) == (41, (["a", "b", "c"], 40, 0, "a"))
    assert none == ([], [], 0, -1, None)
