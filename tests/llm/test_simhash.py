"""SimHash and connected components against all pairs."""

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.components import components


def plain_fingerprint(text, size=4):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    shingles = [b" ".join(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, bits):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [least.get(find(i)) for i in range(len(fps))]


@pytest.mark.parametrize("bits,hot", [(4, simhash.HOT), (4, 4), (3, 2), (0, 3), (7, 5)])
def test_links_reach_what_all_pairs_reach(spark, bits, hot):
    simhash_rng = np.random.default_rng(bits + hot)
    base = simhash_rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = set(base.tolist())
    for x in base.tolist():
        for _ in range(25):
            flips = simhash_rng.choice(64, simhash_rng.integers(1, 9), replace=False)
            fps.add(x ^ int(sum(1 << int(f) for f in flips)))
    fps = sorted(fps)
    from tessera.llm.common import ship

    ship(spark)
    rows = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    reached = {r["node"]: r["component"] for r in components(simhash.links(rows, bits, hot)).collect()}
    signed = [int(np.uint64(x).view(np.int64)) for x in fps]
    got = [reached.get(x, x) for x in signed]
    want = plain_components(signed, fps, bits)
    assert got == want


def test_documents(spark, make_docs, odd_rows):
    rows = odd_rows + [(100 + i, f"shared text of many words number {i % 2} and more words to make it long " * 3) for i in range(6)]
    got = simhash.near_duplicates(make_docs(rows)).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    want = sorted(map(str, zip([i for i, _ in rows], [f"{f:016x}" for f in fps], plain_components([i for i, _ in rows], fps, 4), strict=True)))
    assert sorted(map(str, map(tuple, got))) == want


def test_one_document_of_a_group_stays(spark, make_docs):
    text = "the very same words over and over again in one text "
    docs = make_docs([(3, text), (1, text), (2, "something else that shares nothing with it"), (None, text)])
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "2", "None"]


def test_empty(spark, make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (5, 6), (6, 5), (9, 5), (None, 4)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, 6: 5, 9: 5}


def test_a_worker_drops_what_the_classifier_kept(spark):
    import pyarrow as pa

    from tessera.llm import quality, simhash

    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    texts = pa.StructArray.from_arrays([pa.array(["some plain words, here", None])], ["text"])
    quality._features(texts, {"text": 0, "lang": None, "source": None, "n_chars": None})
    assert quality._OF_WORD and quality._OF_MARK
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), texts.field(0)], ["doc_id", "text"])
    found = list(simhash.fingerprints(Rows())(iter([batch])))
    assert [x.column(0).to_pylist() for x in found] == [[1, 2]]
    assert not quality._OF_WORD and not quality._OF_MARK
