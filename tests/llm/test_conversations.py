"""Prefix trie and tree contraction against plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import types as T

from tessera.llm import conversations
from tessera.llm.common import ship, table
from tessera.llm.contraction import subtree_totals

SF = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("node", T.StringType()), T.StructField("depth", T.StringType()),
])


def plain(rows):
    """The result by dictionaries of whole sequences."""
    by = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.blake2b(len(role.encode()).to_bytes(8, "big") + role.encode() + text.encode(), digest_size=16).digest()
            by.setdefault(conv, []).append(((turn is not None, turn or 0, tie), (role, text)))
    by = {c: [x for _, x in sorted(v)] for c, v in by.items()}
    members, ends = {}, {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 9
        made = (by.get(c - c % 5, [])[:h]) + own[h:]
        for d in range(len(made) + 1):
            members.setdefault(tuple(made[:d]), []).append(c)
        ends.setdefault(tuple(made), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in kids.get(node, [])]
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        totals[node] = (sum(x for x, _ in below) or 1, saved + sum(x for _, x in below))
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(kids.get(node, [])), *totals[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def found(df):
    return sorted(tuple(-1 if x is None and c == "parent_conv_id" else x for x, c in zip(r, COLUMNS, strict=True)) for r in df.select(*COLUMNS).collect())


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(conversations.op11_prefix_trie(spark, SF)) == plain(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 16)
    same = [(c, t, "user", f"hello {t}") for c in range(200, 320) for t in range(3)]  # one sequence, many times
    long = [(1000 + i, t, "a", f"w{t % 7}" + "x" * (t == 0) * 50_000) for i in (0, 1) for t in range(300)]
    odd = [
        (7, None, None, "first"), (7, 0, "r", None), (7, 0, "r", None), (7, 0, "ro", "le"), (7, 0, "r", "ole"), (None, 1, "u", "lost"),
        (-3, 1, "u", "a"), (-5, 1, "u", "b"), (12, 5, "", ""), (9, 1, None, None), (2**62, 0, "u", "big"),
    ]
    rows = same + long + odd
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], TURNS).repartition(5)
    assert found(conversations.prefix_trie(df)) == plain(rows)
    assert conversations.prefix_trie(df.where("false")).collect() == []


def test_runs_over_partitions_are_whole(spark):
    """A conversation that many partitions share is hashed as one."""
    n = 5000
    df = spark.createDataFrame([(1, t, "r", f"t{t % 3}", "", "") for t in range(n)] + [(2, t, "r", f"t{t % 3}", "", "") for t in range(10)], TURNS)
    ship(spark)
    got = conversations._runs(conversations.digests(df), ["turn", "digest"], "test").collect()
    by = {(r["conv"], r["depth"]): bytes(r["node"]) for r in got}
    up = {(r["conv"], r["depth"]): bytes(r["parent"]) for r in got}
    assert len(by) == n + 10 and all(by[1, d] == by[2, d] for d in range(1, 11)) and len(set(by.values())) == n
    assert all(up[1, d] == by[1, d - 1] for d in range(2, n + 1))


@pytest.mark.parametrize("shape", ["chain", "star", "mixed"])
def test_contraction(spark, shape):
    import random

    rng = random.Random(shape)
    n = 150
    up = {0: None} | {i: {"chain": i - 1, "star": 0, "mixed": rng.choice([i - 1, i - 1, i - 1, rng.randrange(i)])}[shape] for i in range(1, n)}
    up |= {n: None}  # another tree
    kids = {i: sum(p == i for p in up.values()) for i in up}
    nodes = spark.createDataFrame([(i, p, kids[i], i, 1) for i, p in up.items()], "node long, parent long, kids long, x long, one long")
    want = {i: [i, 1] for i in up}
    for i in sorted(up, reverse=True):
        if up[i] is not None:
            want[up[i]] = [a + b for a, b in zip(want[up[i]], want[i], strict=True)]
    got = {r["node"]: [r["x"], r["one"]] for r in subtree_totals(nodes, ["x", "one"]).collect()}
    assert got == want


def test_a_circle_is_an_error(spark):
    nodes = spark.createDataFrame([(0, 1, 1, 1), (1, 0, 1, 1)], "node long, parent long, kids long, x long")
    with pytest.raises(ValueError, match="circle"):
        subtree_totals(nodes, ["x"])
