"""Joins of hot keys, numbering by ranges, pruned similarity joins, stored
tables: results against plain ones, and the plans that they promise."""

import datetime
import gzip
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import basic, cells, frequent
from tessera.operators import evaluation as ev
from tessera.operators import similarity as sm
from tessera.operators import weblog as wl
from tessera.plans.joins import block_pairs, block_shape, lookup_join
from tessera.plans.stored import ROW_BITS, stored
from tessera.sources import fixtures as fx
from tessera.sources import logstore
from tessera.sources import text as tx
from tessera.sources.tables import Tables

DATA = "/root/testdata/sf0.001"
SMALL = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which test data look large."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_join_splits_a_hot_key(small_partitions):
    spark = small_partitions
    rows = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 997).alias("k"), F.col("id").alias("v"))
    rows = rows.repartition(6, "v")
    lookup = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plain = rows.join(lookup, "k")
    safe = lookup_join(rows, lookup, "k")
    assert "skew=true" in final_plan(safe)
    assert safe.agg(F.sum("n"), F.count(F.lit(1))).first() == plain.agg(F.sum("n"), F.count(F.lit(1))).first()


def test_hot_token_is_split_in_tfidf(small_partitions):
    spark = small_partitions
    docs = spark.range(3000).select("id", F.concat(F.lit("common "), F.repeat(F.lit("common "), 1), F.concat(F.lit("w"), F.col("id") % 1500)).alias("value"))
    docs = docs.repartition(4, "id")
    tokens = sm.clustered_tokens(docs)
    weights = sm.tfidf(sm.term_frequency_of(tokens), sm.inverse_document_frequency([tokens, tokens.limit(0)]))
    assert "skew=true" in final_plan(weights)


def units(spark):
    t = Tables(spark, DATA)
    a, b = fx.records_a(t.documents), fx.records_b(t.benchmark)
    return sm.er_weights(a, b)[:2]


@pytest.mark.parametrize("least", [0.05, 0.3, 0.7])
def test_threshold_join_loses_no_pair(spark, least):
    a, b = units(spark)
    every = sm.similarities(a, b).collect()
    want = {(r.a_id, r.b_id): r.similarity for r in every if r.similarity >= least}
    got = {(r.a_id, r.b_id): r.similarity for r in sm.similarities(a, b, min_similarity=least).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    met = sm.threshold_candidates(sm.unit_weights(a), sm.unit_weights(b), least).count()
    assert len(want) <= met < len(every)


def test_threshold_join_with_negative_and_equal_weights(spark):
    rows = [(i, f"t{i % 3} t{i % 5} t{i % 2} x{i}") for i in range(40)]
    a = spark.createDataFrame(rows, "id long, value string")
    b = spark.createDataFrame([(100 + i, v) for i, v in rows[:25]], "id long, value string")
    wa, wb, _ = sm.er_weights(a, b)
    for least in (0.2, 0.999):
        want = {(r.a_id, r.b_id) for r in sm.similarities(wa, wb).collect() if r.similarity >= least}
        assert {(r.a_id, r.b_id) for r in sm.similarities(wa, wb, min_similarity=least).collect()} == want
    assert sm.scalable_similarity(a.limit(0), b, min_similarity=0.5).collect() == []


@pytest.mark.parametrize("blocks", [(1, 1), (3, 1), (4, 3)])
def test_block_join_equals_token_join(spark, blocks):
    a, b = units(spark)
    want = {(r.a_id, r.b_id): r.similarity for r in sm.similarities(a, b).collect()}
    got = {(r.a_id, r.b_id): r.similarity for r in sm.similarities(a, b, blocks=blocks).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    tokens = {(r.a_id, r.b_id): r.tokens for r in sm.common_tokens(a, b, blocks=blocks).collect()}
    assert tokens == {(r.a_id, r.b_id): r.tokens for r in sm.common_tokens(a, b).collect()}


def test_block_join_shuffles_each_side_once(spark):
    left = spark.range(2000).select(F.col("id").alias("l"), (F.col("id") % 50).alias("k"), F.lit(1.0).alias("value"))
    right = spark.range(300).select(F.col("id").alias("r"), (F.col("id") % 50).alias("k"), F.lit(2.0).alias("value"))
    pairs = block_pairs(left, right, "k", "l", "r", 4, 2, {"s": F.sum(F.col("left_value") * F.col("right_value"))})
    assert len(re.findall(r"Exchange hashpartitioning", final_plan(pairs).split("== Initial Plan ==")[0])) == 1
    assert pairs.count() == 2000 * 6 and pairs.agg(F.sum("s")).first()[0] == 2 * 2000 * 6


def test_block_shape():
    assert block_shape(0, 5, 100) == (1, 1) and block_shape(10_000, 200, 100_000) == (20, 1)
    rows, columns = block_shape(1000, 1000, 10_000)
    assert rows == columns == 10


def test_pair_blocks_follow_the_measured_pairs(spark):
    dense = spark.createDataFrame([(i, "a b c d e") for i in range(200)], "id long, value string")
    sparse = spark.createDataFrame([(i, f"a{i} b{i}") for i in range(200)], "id long, value string")
    for records, wanted in ((dense, True), (sparse, False)):
        tokens = sm.clustered_tokens(records)
        blocks = sm.pair_blocks(sm.inverse_document_frequency([tokens, tokens]), records, records, pairs_per_cell=1000)
        assert (blocks is not None) == wanted


def test_numbered_lines_bounds_every_range(spark, monkeypatch):
    """Two million rows, a third of them under one value."""
    n = 2_000_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"), "id")
    sizes = {}
    monkeypatch.setattr(tx, "indexed", lambda d, column, name: sizes.update(n=d.groupBy(F.spark_partition_id()).count().collect()) or indexed(d, column, name))
    indexed = __import__("tessera.plans.stored", fromlist=["indexed"]).indexed
    got = tx.numbered_lines(df, ["v", "id"], rows_per_range=250_000)
    assert max(r["count"] for r in sizes["n"]) <= 250_000
    first = got.orderBy("line_index").limit(12).collect()
    assert [r.line_index for r in first] == list(range(12)) and [(r.v, r.id) for r in first[:7]] == [(1, 1), (2, 2), (4, 4), (5, 5), (7, 0), (7, 3), (7, 6)]
    ends = got.agg(F.count_distinct("line_index"), F.min("line_index"), F.max("line_index")).first()
    assert tuple(ends) == (n, 0, n - 1)


@pytest.mark.parametrize("split", [1000, 1 << 20])
def test_file_lines_have_the_files_order(spark, tmp_path, split):
    files = {f"part-{i}.txt": [f"{i}:{j} " + "x" * (j % 37) for j in range(n)] for i, n in enumerate((300, 0, 1, 500))}
    for name, lines in files.items():
        (tmp_path / name).write_text("".join(x + "\n" for x in lines))
    with gzip.open(tmp_path / "part-9.txt.gz", "wt") as out:
        out.write("".join(f"z{j}\n" for j in range(50)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = tx.read_file_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(name, i, line) for name, lines in [*files.items(), ("part-9.txt.gz", [f"z{j}" for j in range(50)])] for i, line in enumerate(lines)]
    assert [(r.file.rsplit("/", 1)[1], r.line_no, r.value) for r in sorted(got, key=lambda r: r.line_index)] == want
    assert sorted(r.line_index for r in got) == list(range(len(want)))


def test_row_ids_hold_the_partition(spark):
    rows = spark.range(0, 100, 1, 4).select("id", F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("part")).collect()
    assert all(r.row >> ROW_BITS == r.part for r in rows)


def test_value_lists_join_to_whole_lists(spark):
    rows = [("hot", (i * 7919) % 5000) for i in range(5000)] + [("a", 3), ("a", 1), ("a", 3), (None, 5), ("b", None)]
    got = basic.value_lists(spark.createDataFrame(rows, "k string, v int").repartition(4), "k", "v", 128).collect()
    lists = {}
    for r in sorted(got, key=lambda r: r.segment):
        lists.setdefault(r.k, []).append(list(r["values"]))
    assert {k: sum(v, []) for k, v in lists.items()} == {"hot": list(range(5000)), "a": [1, 3, 3], None: [5]}
    assert [len(x) for x in lists["hot"]] == [128] * 39 + [8]


def test_frequent_top_is_proven_or_counted(spark):
    rows = [(w,) for i in range(40) for w in ["a"] * 8 + ["b"] * 8 + ["c"] * 2 + [f"rare{i}"]] + [(None,)] * 50
    skewed = spark.createDataFrame(rows, "w string")
    proven = frequent.proven_top(skewed, "w", 3, map_size=128)
    assert [tuple(r) for r in proven.collect()] == [("a", 320), ("b", 320), ("c", 80)]
    flat = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("w"))
    assert frequent.proven_top(flat, "w", 3, map_size=128) is None
    assert [tuple(r) for r in frequent.frequent_top(flat, "w", 3, map_size=128).collect()] == [("0", 3), ("1", 3), ("10", 3)]
    assert frequent.frequent_top(skewed.limit(0), "w", 3).collect() == []


def test_host_sketches_of_any_days(spark):
    day = datetime.datetime(2024, 5, 1)
    rows = [(f"h{(i * 31) % (500 * (d + 1))}", day + datetime.timedelta(days=d)) for d in range(4) for i in range(1500 * (d + 1))]
    access = spark.createDataFrame(rows, "host string, date_time timestamp_ntz")
    kept = wl.host_sketches(access)
    for first, last in ((0, 0), (1, 2), (0, 3)):
        bounds = [(day + datetime.timedelta(days=x)).date() for x in (first, last)]
        exact = len({h for h, t in rows if bounds[0] <= t.date() <= bounds[1]})
        got = wl.hosts_of_days(kept, *map(F.lit, bounds)).first()
        assert abs(got.unique_hosts - exact) <= 0.05 * exact and got.requests == sum(bounds[0] <= t.date() <= bounds[1] for _, t in rows)
    assert tuple(wl.hosts_of_days(kept.limit(0)).first()) == (0, 0)


def test_log_store_reads_and_replaces_days(spark, tmp_path):
    path = str(tmp_path / "days")
    start = datetime.datetime(2024, 5, 1)
    rows = [(f"h{i % 7}", start + datetime.timedelta(hours=i), i) for i in range(24 * 30)] + [("lost", None, -1)]
    log = spark.createDataFrame(rows, "host string, date_time timestamp_ntz, n long")
    logstore.store_days(log, path, rows_per_file=10)
    three = logstore.read_days(spark, path, datetime.date(2024, 5, 2), datetime.date(2024, 5, 4))
    assert three.count() == 72 and three.columns == ["host", "date_time", "n", "day"]
    assert {f.split("day=")[1][:10] for f in three.inputFiles()} >= {"2024-05-02"}
    plan = three._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and re.search(r"day#\d+ >= ", plan)
    scan = three.select("day").distinct().count()
    assert scan == 3
    assert logstore.read_days(spark, path).count() == 721
    mended = log.where(F.col("date_time") >= datetime.datetime(2024, 5, 30)).withColumn("host", F.lit("new"))
    logstore.store_days(mended, path)
    after = logstore.read_days(spark, path)
    assert after.count() == 721 and after.where("host = 'new'").count() == 24


def test_thresholds_in_cells_equal_token_joins(spark):
    rows = [(i, f"t{i % 3} t{i % 5} t{i % 2} x{i}") for i in range(40)]
    others = spark.createDataFrame([(100 + i, v) for i, v in rows[:25]], "id long, value string")
    a, b, _ = sm.er_weights(spark.createDataFrame(rows, "id long, value string"), others)
    levels = [0.2, 0.7]

    def found(blocks):
        rows = sm.threshold_scores(a, b, levels, blocks=blocks).collect()
        assert len({(r.threshold, r.a_id, r.b_id) for r in rows}) == len(rows)
        return {(r.threshold, r.a_id, r.b_id): r.similarity for r in rows}

    want = found(None)
    assert want and found((4, 3)) == pytest.approx(want, rel=1e-12)
    report = [tuple(r) for r in sm.threshold_report(a, b, levels, blocks=(4, 3)).collect()]
    assert report == [(t, sum(k[0] == t for k in want), sum(k[0] == t and s >= t for k, s in want.items())) for t in levels]
    assert [tuple(r) for r in sm.threshold_report(a.limit(0), b, levels, blocks=(4, 3)).collect()] == [(t, 0, 0) for t in levels]


def test_cells_in_slices(spark, monkeypatch):
    """Slices of single records, ids that come twice, and no copies of a side."""
    rows = [(i % 30, f"t{i % 3} t{i % 5} x{i % 7}") for i in range(60)]
    a = spark.createDataFrame(rows, "id long, value string")
    b = spark.createDataFrame([(100 + i, v) for i, v in rows[:25]], "id long, value string")
    wa, wb, _ = sm.er_weights(a, b)
    left, right = (w.select(F.col("id").alias(f"{s}_id"), "token", "weight").toArrow() for w, s in ((wa, "a"), (wb, "b")))
    monkeypatch.setattr(cells, "MET_AT_ONCE", 1)
    dots = cells.summed(("a_id", "b_id"), "weight", "dot")(left, right).to_pylist()
    assert {(r["a_id"], r["b_id"]): r["dot"] for r in dots} == pytest.approx({(r.a_id, r.b_id): r.dot for r in sm.dot_products(wa, wb).collect()})
    lists = cells.listed(("a_id", "b_id"), "tokens")(left, right).to_pylist()
    assert {(r["a_id"], r["b_id"]): r["tokens"] for r in lists} == {(r.a_id, r.b_id): r.tokens for r in sm.common_tokens(wa, wb).collect()}


def test_token_pairs_of_cells_are_no_rows(spark):
    """No shuffle of what the join makes."""
    a, b = units(spark)
    plan = final_plan(sm.dot_products(a, b, blocks=(4, 1))).split("== Initial Plan ==")[0]
    assert "FlatMapCoGroupsInArrow" in plan and "hashpartitioning(a_id" not in plan and "hashpartitioning(b_id" not in plan


def test_rests_look_back_only(spark):
    """A window that looks ahead costs the square of a vector's length."""
    a, _ = units(spark)
    assert "currentrow$(), unboundedfollowing" not in final_plan(sm._rests(sm.unit_weights(a))).lower()


def test_gold_is_broadcast_to_the_candidates(spark):
    rows = [(i, j, (i * j % 100) / 100) for i in range(40) for j in range(30)]
    sims = spark.createDataFrame(rows, "a_id long, b_id long, similarity double")
    gold = stored(spark.createDataFrame([(1, 2), (3, 4), (99, 5), (99, 5)], "a_id long, b_id long"), "gold")
    for df in (ev.non_duplicates(sims, gold), ev.scored_pairs(sims, gold)):
        assert "BroadcastHashJoin" in final_plan(df).split("== Initial Plan ==")[0] and "hashpartitioning(a_id" not in final_plan(df)
    sweep = {r.threshold: (r.tp, r.fp, r.fn) for r in ev.threshold_sweep(sims, gold).collect()}
    score = {(i, j): s for i, j, s in rows}
    assert sweep[0.0] == (4, len(rows) - 4, 0)
    for t in (0.02, 0.1, 0.5):
        fn = 2 + sum(score[p] < t for p in ((1, 2), (3, 4)))
        assert sweep[t] == (4 - fn, sum(int(s * 100) / 100 >= t for p, s in score.items() if p not in ((1, 2), (3, 4))), fn)


def test_rounding_of_scores(spark):
    from tessera.plans.catalog import pairs6

    values = [0.0, 1.0, 0.1234565, 0.12345649, 1e-7, 5e-7, 123456.7890125, 1e12 + 0.1234567, None]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    want = [r[0] for r in df.select(F.round("x", 6)).collect()]
    assert [r[0] for r in df.select(pairs6("x")).collect()] == want
