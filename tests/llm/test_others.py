"""Language, sharding, quality, embeddings and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import language, neighbours, quality, sharding
from tessera.llm.common import ship, table

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_texts(spark):
    rows = language.op9_language(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_cases(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    ship(spark)
    langs, model = language.prototypes(docs)
    assert langs == ["en"]
    got = language.identify(docs, langs, model).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        letters = any(c.isalpha() for c in r["row"]["text"] or "")
        assert r["out"]["lang_pred"] == ("en" if letters else "und") and r["row"]["score"] == 0.5
        assert letters or r["out"]["score"] == 0
    empty = language.prototypes(make_docs([]))
    assert empty[0] == [] and {r["out"]["lang_pred"] for r in language.identify(docs, *empty).collect()} == {"und"}


def test_bound_vectors_are_products_of_turned_letters():
    grams, counts = np.unique(language.ngrams("Abab!"), return_counts=True)
    assert counts.sum() == 4  # " ab", "aba", "bab", "ab "
    v = language.vectors(grams)
    a, b, blank = (language.letter(c, language.DIM) for c in (ord("a"), ord("b"), 0))
    want = {np.roll(blank, 2).tobytes(): 0}
    want = {(np.roll(x, 2) * np.roll(y, 1) * z).tobytes() for x, y, z in [(blank, a, b), (a, b, a), (b, a, b), (a, b, blank)]}
    assert {row.tobytes() for row in v} == want
    assert (language.bundle(grams, counts) == v.T.astype(float) @ counts).all()


def check_shards(rows, texts, shards):
    by_shard, of_text = {}, {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
        of_text.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert all(sorted(x["slot"] for x in v) == list(range(len(v))) for v in by_shard.values())
    assert all(len(v) == 1 for v in of_text.values())
    assert set(by_shard) <= set(range(shards))
    return {k: sum(x["size"] for x in v) for k, v in by_shard.items()}


@pytest.mark.parametrize("items,piece_rows", [(sharding.ITEMS, sharding.PIECE_ROWS), (50, 3)])
def test_shards_are_near_equal(spark, items, piece_rows):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = sharding.shard(docs, items=items, piece_rows=piece_rows).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 8, zlib.crc32(raw), "bytes")
    sizes = check_shards(rows, texts, 24)
    if items > 1000:
        assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) < 0.02 * max(sizes.values())


def test_sharding_cases(spark, make_docs, odd_rows):
    rows = sharding.shard(make_docs(odd_rows), shards=4, piece_rows=1).collect()
    assert len(rows) == len(odd_rows)
    assert sorted(r["size"] for r in rows) == sorted(len((t or "").encode()) + 8 for _, t in odd_rows)
    for s in {r["shard"] for r in rows}:
        mine = [r["slot"] for r in rows if r["shard"] == s]
        assert sorted(mine) == list(range(len(mine)))
    assert sharding.shard(make_docs([])).collect() == []
    (r,) = sharding.op10_sharding(spark, "/root/testdata/sf0.001").limit(1).collect()
    assert r["grown_shard"] is None


def test_a_group_of_most_rows_is_numbered_in_pieces(spark, make_docs):
    rows = [(i, "the same text") for i in range(300)] + [(1000 + i, f"text {i}") for i in range(30)]
    out = sharding.shard(make_docs(rows), shards=5, piece_rows=20).collect()
    sizes = check_shards(out, dict(rows), 5)
    assert len(sizes) == 5


def test_best_fit_takes_the_tightest_bin():
    rng = random.Random(1)
    for _ in range(40):
        capacity = 100
        sizes = sorted((rng.randint(1, 60) for _ in range(rng.randint(1, 60))), reverse=True)
        left, want = [], []
        for s in sizes:
            fits = [(c, i) for i, c in enumerate(left) if c >= s]
            if fits:
                i = min(fits)[1]
                left[i] -= s
            else:
                i = len(left)
                left.append(capacity - s)
            want.append(i)
        assert sharding.best_fit(sizes, capacity) == want
    assert sharding.best_fit([101], 100) is None and sharding.best_fit([60, 60], 100, 1) is None


def test_quality_keeps_clean_and_rejects_bad_documents(spark):
    data = "/root/testdata/sf0.1"
    docs, labels = table(spark, data, "documents"), table(spark, data, "labels")
    known = {r["doc_id"]: (r["quality"], r["toxic"]) for r in labels.collect()}
    train = labels.where("doc_id % 4 != 0")
    rows = quality.classify(docs, train).select("row.doc_id", "out.*").where("doc_id % 4 = 0").collect()
    kept = {k: [r["keep"] for r in rows if known.get(r["doc_id"]) == k] for k in ((1, 0), (0, 0), (1, 1))}
    assert np.mean(kept[1, 0]) > 0.95
    assert np.mean(kept[0, 0]) < 0.2 and np.mean(kept[1, 1]) < 0.25


def test_quality_cases(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs, none).count() == len(odd_rows)
    one = spark.createDataFrame([(2, 1, 0), (4, 1, 0), (None, 0, 0), (9, None, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, one).collect()
    assert len(out) == len(odd_rows) and all(r["out"]["keep"] for r in out)
    both = spark.createDataFrame([(2, 1, 0), (4, 0, 0), (11, 1, 1), (12, 0, 1), (13, 1, 0), (14, 0, 0)], "doc_id long, quality int, toxic int")
    left = quality.keep_good(docs, both)
    assert left.columns == docs.columns
    assert quality.classify(make_docs([]), both).collect() == []


def test_labels_of_one_target_each_and_of_unknown_ids(spark):
    rows = [(i, "fine words here" if i % 2 else "poor stuff there", "en", "good" if i % 2 else "bad", 100) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    schema = "doc_id long, quality int, toxic int"
    labels = [(i, i % 2, None) if i < 30 else (i, None, 1 - i % 2) for i in range(60)]
    elsewhere = [(1000 + i, 0, 1) for i in range(2000)]
    # The bound is on labels of documents that are there.
    out = quality.classify(df, spark.createDataFrame(labels + elsewhere, schema), labelled=60).collect()
    assert all(r["out"]["keep"] == (r["row"]["source"] == "good") for r in out)
    out = quality.classify(df, spark.createDataFrame(labels[:30], schema)).collect()
    assert all(r["out"]["keep"] == (r["row"]["source"] == "good") and r["out"]["toxic_score"] == 0.5 for r in out)


def test_a_word_of_unlabelled_documents_only_gets_a_weight(spark):
    """All unlabelled documents are searched for sure rows, and what they have
    in common is learnt though no labelled document has it."""
    rng = random.Random(5)

    def text(word):
        return " ".join(rng.choice("amber birch cedar delta ember fjord".split()) for _ in range(20)) + f" {word}"

    rows = [(i, text("plain"), "en", "good" if i % 2 else "bad", 100) for i in range(200)]
    rows += [(1000 + i, text("zebra" if i % 2 else "quartz"), "en", "good" if i % 2 else "bad", 100) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    view = quality.train(df, labels)["quality"].views[0]
    good, bad = (view.weights[zlib.crc32(x) & (1 << quality.TEXT_BITS) - 1] for x in (b"w zebra", b"w quartz"))
    assert good > 0.1 and bad < -0.1


def test_sure_rows_come_from_every_stratum(spark):
    weights = np.zeros(1 << quality.META_BITS)
    weights[[1, 2]] = 10, 8
    views = [quality.View(np.zeros(1 << quality.TEXT_BITS), 0.0), quality.View(weights, 0.0)]
    one, two = (quality.pack(np.array([x], np.int32)) for x in (1, 2))
    rows = [(i, i, 0, one, one) for i in range(3000)] + [(9000, 9000, 1, one, two), (9000, 9000, 1, one, two)]
    spare = spark.createDataFrame(rows, "doc_id long, rank long, cell int, text binary, meta binary")
    ((text, meta),) = quality._sure(spare, [views], 5, 0.99)
    assert [p[:2] for p in text] == [(i, 1.0) for i in [*range(5), 9000]] and meta == []


def test_features_are_packed_whole():
    for row in ([], [0], [5, 70_000, 70_001, 200_000], [1, 2, 3]):
        row = np.array(row, np.int32)
        assert (quality.unpack(quality.pack(row)) == row).all()
    assert quality._capitals("aBC É é ẞ 1") == 4


def test_exchange_equals_plain_co_training(spark):
    """Training and scores against a single loop over all rows in memory."""
    rng = random.Random(11)
    words = {0: "dull grey murk sludge".split(), 1: "bright clear lucid crisp".split()}
    both = "amber birch cedar delta ember fjord grove heath".split()
    rows = []
    for i in range(700):
        good = i % 2
        text = " ".join(rng.choice(both + words[good] * rng.randrange(3)) for _ in range(rng.randrange(5, 30)))
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice("ab") + ("x" if rng.random() < 0.7 else "yz"[good]), 10 ** rng.randrange(1, 5)))
    rows += rows[300:320]  # some twice
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    known = {i: (i % 2 if rng.random() < 0.9 else 1 - i % 2, int(rng.random() < 0.2)) for i in range(0, 700, 4)}
    labels = spark.createDataFrame([(i, *x) for i, x in known.items()], "doc_id long, quality int, toxic int")
    got = {r["row"]["doc_id"]: tuple(r["out"]) for r in quality.classify(df.repartition(5), labels, pool=60, sure=0.9).collect()}

    at = {r["doc_id"]: r for r in df.select("doc_id", F.xxhash64("doc_id").alias("rank"), F.pmod(F.xxhash64("lang", "source"), F.lit(quality.STRATA)).alias("cell")).collect()}
    views = {i: (quality.text_features(t), quality.meta_features(t, lang, source, n)) for i, t, lang, source, n in rows}
    order = sorted(known, key=lambda i: (at[i]["rank"], i))
    teams = [quality.Team(tuple([views[i][v] for i in order] for v in range(2)), np.array([known[i][t] for i in order], float)) for t in range(2)]
    spare = sorted({i for i, *_ in rows} - set(known))
    each = max(1, 60 // (4 * len({at[i]["cell"] for i in spare})))
    limit, rounds = np.log(0.9 / 0.1), 0
    for _ in range(quality.ROUNDS):
        picks = []
        for team in teams:
            margin = [m.margin([views[i][v] for i in spare]) for v, m in enumerate(team.models)]
            mine = [[], []]
            for v in range(2):
                best = {}
                for k, i in enumerate(spare):
                    mark, own = margin[1 - v][k], margin[v][k]
                    if abs(mark) >= limit and not (abs(own) >= limit and (own > 0) != (mark > 0)):
                        best.setdefault((mark > 0, at[i]["cell"]), []).append((-abs(mark), at[i]["rank"], i))
                chosen = sorted((i, float(label)) for (label, _), found in best.items() for _, _, i in sorted(found)[:each])
                mine[v] = [(i, label, views[i][v]) for i, label in chosen]
            picks.append(mine)
        rounds += any(any(mine) for mine in picks)
        if not any([t.learn(p) for t, p in zip(teams, picks, strict=True)]):
            break
    assert rounds
    models = [t.model() for t in teams]
    assert len(got) == 700
    for i, (good, bad, _, keep) in got.items():
        want = [float(m.probability([views[i][0]], [views[i][1]])[0]) for m in models]
        assert np.allclose([good, bad], want, rtol=1e-9) and keep == (want[0] > 0.5 and want[1] < 0.5)


def plain_links(ids, vectors, threshold=0.9):
    ok = [v is not None and None not in v and len(v) > 0 and np.isfinite(v).all() and np.any(v) for v in vectors]
    n, parent = [0] * len(ids), list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]):
                a, b = (np.array(v, float) / np.abs(v).max() for v in (vectors[i], vectors[j]))
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    n[i] += 1
                    n[j] += 1
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return sorted(str((x, n[i], least.get(find(i)), x is not None and least.get(find(i)) == x)) for i, x in enumerate(ids))


def test_embeddings_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = []
    for g, size in enumerate((1, 2, 3, 60, 25)):
        c = rng.standard_normal(16)
        rows += [(1000 * g + i, (c + rng.standard_normal(16) * 0.08).tolist()) for i in range(size)]
    rows += [(9000 + i, rng.standard_normal(16).tolist()) for i in range(150)]
    rows += [(9500, rows[0][1]), (9501, rows[0][1]), (2, rows[0][1]), (9502, [0.0] * 16), (9503, None), (9504, []), (9505, [None] + [1.0] * 15)]
    rows += [(9506, [float("nan")] * 16), (9507, [float("inf")] + [0.0] * 15), (9508, [1.0, 2.0]), (9509, [2.0, 4.1]), (None, rows[5][1]), (-7, [1e-200] * 16), (-8, [1e200] * 16)]
    rows = [(i, None if v is None else v) for i, v in rows]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, component_id string")
    out = neighbours.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(str, map(tuple, out))) == plain_links([i for i, _ in rows], [v for _, v in rows])
    monkeypatch.setattr(neighbours, "TILE", 7)
    again = neighbours.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(str, map(tuple, again))) == sorted(map(str, map(tuple, out)))


def unit_vectors(spark, vectors):
    rows = [(i, v.size, bytearray((v / np.linalg.norm(v)).tobytes()), 1, i) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "node long, size int, vec binary, copies long, least long")


def test_recall_of_small_groups_is_not_hidden_by_a_dense_one(spark):
    rng = np.random.default_rng(3)
    c = rng.standard_normal(32)
    some = [c + rng.standard_normal(32) * 0.02 for _ in range(700)]
    pairs = [v for _ in range(20) for x in [rng.standard_normal(32)] for v in (x, x + rng.standard_normal(32) * 0.02)]
    vectors = unit_vectors(spark, some + pairs)
    full = [(i, 699) for i in range(700)] + [(700 + i, 1) for i in range(40)]
    counted = spark.createDataFrame(full, "node long, links long")
    assert neighbours._audit(vectors, counted, 0.9, 5000) == 1
    lost = counted.where("node < 728")  # 14 of 20 pairs
    assert abs(neighbours._audit(vectors, lost, 0.9, 5000) - 0.7) < 1e-9


def test_an_audit_without_linked_nodes_is_no_evidence(spark):
    rng = np.random.default_rng(4)
    vectors = unit_vectors(spark, [rng.standard_normal(64) for _ in range(400)])
    none = spark.createDataFrame([], "node long, links long")
    assert neighbours._audit(vectors, none, 0.9, 20) is None
    assert neighbours._audit(vectors, none, 0.9, 400) == 1  # all nodes asked


def test_embeddings_end_with_an_error_where_recall_stays_low(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.standard_normal(16)
    df = spark.createDataFrame([(i, (x + rng.standard_normal(16) * 0.02).tolist()) for i in range(4)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "_audit", lambda *a: 0.5)
    with pytest.raises(RuntimeError, match="recall"):
        neighbours.near_duplicates(df, rounds=1)


def test_draws_follow_the_hyperplanes():
    for bits in (0, 1, 8, 17):
        meet = (1 - np.arccos(0.9) / np.pi) ** bits
        assert 1 - (1 - meet) ** neighbours._draws(bits, 0.9) >= neighbours.RECALL


def test_a_link_between_saturated_groups(spark, monkeypatch):
    """Two groups of near copies, far apart but for one member each."""
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(6)
    a, b = np.eye(24)[:2]

    def at(angle):
        return np.cos(angle) * a + np.sin(angle) * b

    rows = [at(x) + 0.01 * rng.standard_normal(24) for x in (0.0, 0.8) for _ in range(300)] + [at(0.2), at(0.63)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    out = neighbours.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(str, map(tuple, out))) == plain_links(list(range(len(rows))), rows)


def test_borders_of_a_block_that_is_too_large(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 8)
    a, b = np.eye(24)[:2]
    rng = np.random.default_rng(7)
    rows = [np.cos(x) * a + np.sin(x) * b + 0.001 * rng.standard_normal(24) for x in (0.0, 0.8) for _ in range(100)]
    rows += [np.cos(x) * a + np.sin(x) * b for x in (0.4, 0.42)]
    placed = unit_vectors(spark, rows).selectExpr("node", "size", "vec", "CASE WHEN node < 100 THEN 0 WHEN node < 200 THEN 100 ELSE node END AS c")
    met = neighbours._borders(placed, 0, 0, 1, 0.9, False).collect()
    of = [0 if i < 100 else 100 if i < 200 else i for i in range(202)]
    known, left = {0}, [{of[r["a"]], of[r["b"]]} for r in met]
    while any(known & x and x - known for x in left):
        known |= set().union(*[x for x in left if known & x])
    assert known == {0, 100, 200, 201}
    assert neighbours._borders(placed.withColumn("c", placed["node"] * 0), 0, 0, 1, 0.9, False).collect() == []


def test_embeddings_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.near_duplicates(df).collect() == []


def test_embeddings_table(spark):
    df = table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = df.collect()
    out = neighbours.near_duplicates(df).collect()
    assert sorted(str(tuple(r)[:4]) for r in out) == plain_links([r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_pipeline_stages(spark):
    """Every stage on its own input against the operator's plain rule."""
    from tests.llm.test_decontaminate import plain as contaminated
    from tests.llm.test_simhash import plain_components, plain_fingerprint
    from tests.llm.test_substrings import plain as removed

    data = "/root/testdata/sf0.001"
    docs = table(spark, data, "documents")
    columns, before = docs.columns, None
    items = [(r["item_id"], r["text"]) for r in table(spark, data, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        rows = {r["doc_id"]: r for r in docs.collect()}
        docs = corpus_pipeline.materialise(stage(spark, docs, data), "stage")
        after = {r["doc_id"]: r for r in docs.collect()}
        assert name == "sentencepiece encoding" or docs.columns == columns
        ids = sorted(rows)
        if name == "simhash near-dedup":
            reached = plain_components(ids, [plain_fingerprint(rows[i]["text"]) for i in ids], 4)
            assert sorted(after) == sorted(i for i, c in zip(ids, reached, strict=True) if i == c)
        elif name == "substring dedup":
            want = removed([(i, rows[i]["text"]) for i in ids], 50)
            assert [(i, len((after[i]["text"] or "").split())) for i in ids] == [(i, n - m) for i, n, m, _ in want]
        elif name == "benchmark decontamination":
            assert sorted(after) == [i for i in ids if not contaminated(rows[i]["text"], items)[4]]
        elif name == "sentencepiece encoding":
            assert sorted(after) == ids
        else:
            assert set(after) <= set(rows) and len(after) > 0.5 * len(rows)
        before = after
    assert before
