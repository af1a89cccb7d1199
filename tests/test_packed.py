"""Token counts in packed blocks: results of long rows, and what is shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import evaluation as ev
from tessera.operators import packed as pk
from tessera.operators import similarity as sm
from tessera.plans.catalog import Ctx
from tessera.plans.stored import CLEANUP, stored

PLAIN = [(i, f"t{i % 3} t{i % 5} t{i % 2} t{i % 2} x{i} y{i % 11}") for i in range(60)]
ODD = [*PLAIN, *PLAIN[:20], (3, "t1 t1 other"), (None, "t0 t1 lost"), (None, "t0 t1 lost"), (70, ""), (71, None), (72, "the of"), (73, "alone")]
B = [(100 + i, f"t{i % 4} x{i} y{i % 3} only{i}") for i in range(25)] + [(100, "t0 x0 y0 only0"), (130, None)]


def sides(spark, monkeypatch, rows, block_bytes):
    monkeypatch.setattr(pk, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(pk, "MEETING_POSTINGS", 30)
    a = spark.createDataFrame(rows, "id long, value string").repartition(3, F.length("value"))
    b = spark.createDataFrame(B, "id long, value string")
    held = [pk.packed(sm.record_tokens(x), "tokens") for x in (a, b)]
    idf = sm.inverse_document_frequency(held)
    return sm.er_weights(a, b), [sm.tfidf(sm.term_frequency_of(x), idf) for x in held], idf, held


def by_pair(df, value):
    return {(r.a_id, r.b_id): r[value] for r in df.collect()}


@pytest.mark.parametrize("rows,block_bytes", [(PLAIN, 300), (ODD, 300), (ODD, 1 << 20)])
def test_packed_equals_long_rows(spark, monkeypatch, rows, block_bytes):
    (a, b, idf), (pa_, pb), packed_idf, held = sides(spark, monkeypatch, rows, block_bytes)
    assert (held[0].n_blocks > 3) == (block_bytes == 300)
    assert sorted(map(tuple, packed_idf.collect())) == sorted(map(tuple, idf.collect()))
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    for values in (["weight", "df_0", "df_1"], ["norm", "unit"]):
        want, got = (sorted((tuple(r) for r in sm.long_form(sm.unit_weights(x), *values).collect()), key=order) for x in (a, pa_))
        assert [r[:2] for r in got] == [r[:2] for r in want] and [r[2:] for r in got] == [pytest.approx(r[2:], rel=1e-12) for r in want]
    want = by_pair(sm.similarities(a, b), "similarity")
    for blocks in (None, (4, 1)):
        assert by_pair(sm.similarities(pa_, pb, blocks=blocks), "similarity") == pytest.approx(want, rel=1e-12)
    assert by_pair(sm.dot_products(pa_, pb, blocks=(4, 1)), "dot") == pytest.approx(by_pair(sm.dot_products(a, b), "dot"), rel=1e-12)
    assert by_pair(sm.common_tokens(pa_, pb, blocks=(4, 1)), "tokens") == by_pair(sm.common_tokens(a, b, blocks=(4, 1)), "tokens")
    assert sm.similarity_total(pa_, pb).first().total == pytest.approx(sm.similarity_total(a, b).first().total, rel=1e-12)


def test_packed_thresholds_equal_long_rows(spark, monkeypatch):
    (a, b, _), (pa_, pb), _, _ = sides(spark, monkeypatch, PLAIN, 300)
    levels = [0.2, 0.7]

    def found(a, b, blocks):
        return {(r.threshold, r.a_id, r.b_id): r.similarity for r in sm.threshold_scores(a, b, levels, blocks=blocks).collect()}

    want = found(a, b, None)
    assert want and all(found(pa_, pb, blocks) == pytest.approx(want, rel=1e-12) for blocks in (None, (4, 1)))
    rests = {(r.id, r.token): r.rest for r in sm._rests(sm.unit_weights(a)).collect()}
    assert {(r.id, r.token): r.rest for r in pa_.rows("rest").collect()} == pytest.approx(rests, rel=1e-12)


def test_packed_sides_without_rows(spark, monkeypatch):
    (a, b, _), (pa_, pb), _, held = sides(spark, monkeypatch, [(1, ""), (2, None)], 300)
    assert held[0].n_records == 2 and sm.similarities(pa_, pb, blocks=(1, 1)).collect() == []
    (a, b, _), (pa_, pb), _, held = sides(spark, monkeypatch, PLAIN[:0], 300)
    assert held[0].n_blocks == 0 and sm.similarities(pa_, pb, blocks=(1, 1)).collect() == []
    assert sm.similarity_total(pa_, pb).first().total == 0


def test_rows_of_an_id_lie_in_one_block(spark, monkeypatch):
    _, _, _, (held, _) = sides(spark, monkeypatch, ODD * 2, 300)
    ids = [x.as_py() for r in held.frame.collect() for x in pk._unpack_ids(r.ids)]
    assert held.n_blocks > 3 and len(ids) == len(set(ids)) == len({i for i, _ in ODD})


@pytest.mark.parametrize("name", ["sims", "total", "thresholds"])
def test_pair_queries_shuffle_no_postings(spark, name):
    c = Ctx(spark, "/root/testdata/sf0.001")
    w_a, w_b, _ = c.paired
    blocks = (2, 1)
    df = {
        "sims": lambda: sm.similarities(w_a, w_b, blocks=blocks), "total": lambda: sm.similarity_total(w_a, w_b),
        "thresholds": lambda: sm.threshold_scores(w_a, w_b, [0.2, 0.5], blocks=blocks),
    }[name]()
    plan = df._jdf.queryExecution().executedPlan().toString()
    dealt = set(re.findall(r"Exchange hashpartitioning\(([a-z_]\w*)#\d+L?(?:, (\w+)#\d+)?, \d+\)", plan))
    # Blocks, what they are told, distinct tokens of blocks; no records and no pairs.
    allowed = {(x, y) for x in ("block", "asker") for y in ("", "part")} | {("token", "")}
    assert dealt <= allowed and dealt & {("block", ""), ("block", "part")}


def test_records_without_repeated_ids_stay_where_they_are(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pk, "indexed", lambda df, *more: seen.append(df) or indexed(df, *more))
    indexed = __import__("tessera.plans.stored", fromlist=["indexed"]).indexed
    for rows in (PLAIN, ODD):
        pk.packed(sm.record_tokens(spark.createDataFrame(rows, "id long, value string")), "tokens")
    assert ["Exchange" in df._jdf.queryExecution().executedPlan().toString() for df in seen] == [False, True]


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum("shuffle" in f.getName() for f in iter_files(blocks.getAllFiles()))

    def iter_files(found):
        it = found.iterator()
        while it.hasNext():
            yield it.next()

    before = spark.conf.get(CLEANUP, None)
    there = files()
    df = stored(spark.range(5000).groupBy((F.col("id") % 97).alias("k")).count(), "counts")
    assert files() <= there and df.count() == 97 and spark.conf.get(CLEANUP, None) == before


def test_gold_evaluation_of_packed_records(spark, monkeypatch):
    a = spark.createDataFrame(PLAIN, "id long, value string")
    b = spark.createDataFrame(B[:25], "id long, value string")
    gold = stored(spark.createDataFrame([(1, 101), (2, 102), (5, 124), (99, 100)], "a_id long, b_id long"), "gold")
    tok_a, tok_b = (pk.packed(sm.record_tokens(x), "tokens") for x in (a, b))
    idf = sm.inverse_document_frequency([tok_a, tok_b])
    w_a, w_b = sm.tfidf(tok_a, idf), sm.tfidf(tok_b, idf)
    got = ev.gold_evaluation(ev.gold_similarities(sm.record_tokens(a), sm.record_tokens(b), idf, gold), sm.similarity_total(w_a, w_b), a, b).first()
    la, lb, _ = sm.er_weights(a, b)
    score = by_pair(sm.similarities(la, lb), "similarity")
    mine = [score.get(p, 0.0) for p in ((1, 101), (2, 102), (5, 124), (99, 100))]
    assert got.n_true_duplicates == 4 and got.avg_sim_duplicates == pytest.approx(sum(mine) / 4)
    assert got.avg_sim_non_duplicates == pytest.approx((sum(score.values()) - sum(mine)) / (60 * 25 - 4))
