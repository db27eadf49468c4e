"""Mixing, sharding, the pipeline and the registered queries."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from lakeworks.llm import mixing, queries, sharding
from lakeworks.session import stored
from tests.llm.helpers import DOCS, corpus, rows_of, with_clashes, words
from tests.llm.test_dedup import near_brute_force
from tests.llm.test_text_scans import contamination_brute_force


# --------------------------------------------------------------------------- mixing


def mix_rows(n=400):
    rng = random.Random(12)
    rows, labels = [], []
    for k in range(n):
        poor = rng.random() < 0.3
        w = words(rng, rng.randint(10, 90))
        rows.append((k, " ".join(x + "###" for x in w) if poor else " ".join(w), "en", "s", 1))
        if k % 2:
            labels.append((k, int(not poor), int(rng.random() < 0.05)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_mix_matches_its_targets(spark):
    rows, labels = mix_rows()
    docs, labelled = spark.createDataFrame(rows, DOCS), mixing.label_domains(spark.createDataFrame(labels, LABELS), toxic=False)
    for weights in ({"good": 0.5, "poor": 0.5}, {"good": 9, "poor": 1}):
        out, fitted = mixing.mix_rates(with_clashes(docs), labelled, weights)
        got = out.collect()
        assert len(got) == len(rows) and all(r["rate"] >= 0 and r["copies"] >= 0 for r in got)
        assert all(abs(r["copies"] - r["rate"]) < 1 for r in got)
        tokens = np.array([r["n_tokens"] for r in got], float)
        p = np.array([r["posteriors"] for r in got])
        assert np.allclose(p.sum(axis=1), 1)
        totals = (tokens * np.array([r["rate"] for r in got])) @ p
        goal = np.array([weights[d] for d in fitted.domains]) / sum(weights.values()) * tokens.sum()
        assert np.allclose(totals, goal, rtol=0.05)
        assert np.allclose(totals / tokens.sum(), fitted.achieved, rtol=1e-6)


def test_rates_are_the_least_squares_solution(spark):
    """The descent against a long plain projected gradient over every document."""
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.4, 0.4, 0.4], 40)
    tokens = rng.integers(1, 500, 40).astype(float)
    cells = spark.createDataFrame([(float(t), [float(x) for x in q]) for t, q in zip(tokens, p)], "tokens double, p array<double>")
    weights = {"a": 0.97, "b": 0.02, "c": 0.01}  # so extreme that some rates are 0
    fitted = mixing.fit_rates(cells, list(weights), weights)
    got = np.array([r["x"] for r in cells.select(fitted.rate(F.col("p")).alias("x")).collect()])
    m, goal = tokens / tokens.sum(), np.array(list(weights.values()))
    scale = 1 / np.maximum(goal, 1e-3)

    def loss(r):
        e = (m * r) @ p - goal
        return (scale * e * e).sum() / 2 + mixing.RIDGE / 2 * (m * (r - 1) ** 2).sum()

    r, step = np.ones(40), 1 / (np.linalg.eigvalsh((p.T * m) @ p * np.sqrt(np.outer(scale, scale))).max() + 0.01)
    for _ in range(20_000):
        r = np.maximum(0, r - step * (p @ (scale * ((m * r) @ p - goal)) + mixing.RIDGE * (r - 1)))
    assert loss(got) <= loss(r) * 1.02 + 1e-5
    assert (got >= 0).all() and (r == 0).any()


def test_toxic_words_are_learned_in_every_language(spark):
    """Posteriors of rows that have no label, in languages whose insults no list could know."""
    rng = random.Random(21)
    alphabets = {"fr": "abcdeéèçlmnop", "ru": "абвгдежзиклмн", "el": "αβγδεζηθικλμν"}
    make = {g: lambda c=c: "".join(rng.choice(c) for _ in range(rng.randint(3, 7))) for g, c in alphabets.items()}
    usual = {g: [make[g]() for _ in range(300)] for g in alphabets}
    insults = {g: [make[g]() + "x" for _ in range(8)] for g in alphabets}
    rows, labels, truth = [], [], {}
    for k in range(900):
        g, toxic = rng.choice(list(alphabets)), rng.random() < 0.2
        w = rng.choices(usual[g], k=60)
        for _ in range(3 * toxic):
            w[rng.randrange(60)] = rng.choice(insults[g])
        rows.append((k, " ".join(w), g, "s", 1))
        truth[k] = g, toxic
        if k % 3:
            labels.append((k, 1, int(toxic)))
    labelled = mixing.label_domains(spark.createDataFrame(labels, LABELS))
    out, fitted = mixing.mix_rates(spark.createDataFrame(rows, DOCS), labelled, {"good": 0.9, "poor": 0.05, "toxic": 0.05})
    at = fitted.domains.index("toxic")
    for g in alphabets:
        held = [(r["posteriors"][at] > 0.5, truth[r["doc_id"]][1]) for r in out.collect() if r["doc_id"] % 3 == 0 and truth[r["doc_id"]][0] == g]
        found = [p for p, toxic in held if toxic]
        assert len(found) >= 8 and sum(found) >= 0.9 * len(found), g
        assert sum(p for p, toxic in held if not toxic) <= 1, g


def test_mix_edges(spark):
    labels = mixing.label_domains(spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1), (1, 1, 0)], LABELS))
    weights = {"good": 0.8, "poor": 0.1, "toxic": 0.1}
    rows = corpus(2, 10)
    out, _ = mixing.mix(with_clashes(spark.createDataFrame(rows, DOCS)), labels, weights)
    assert out.count() == len(rows) and "score" in out.columns
    assert {r["n_tokens"] for r in out.where("text is null").collect()} == {0}
    empty, fitted = mixing.mix_rates(spark.createDataFrame([], DOCS), labels, weights)
    assert empty.collect() == [] and fitted.achieved == [0.0] * 3
    out, _ = mixing.mix_rates(spark.createDataFrame(rows, DOCS), labels.where("false"), weights)
    assert out.count() == len(rows)


def kept_share(spark, rows, labels, weights):
    labelled = mixing.label_domains(spark.createDataFrame(labels, LABELS), toxic=False)
    out, fitted = mixing.mix_rates(spark.createDataFrame(rows, DOCS), labelled, weights, upsample=False)
    return out.where("copies > 0").count() / len(rows), fitted


def test_scarce_labels_do_not_shrink_the_corpus(spark):
    """A domain with no or few labelled rows; one long text holds most tokens."""
    rows, labels = mix_rows()
    rows.append((5000, " ".join(words(random.Random(5), 30_000)), "en", "s", 1))
    weights = {"good": 0.9, "poor": 0.1}
    good = [r for r in labels if r[1] == 1]
    poor = [r for r in labels if r[1] == 0]
    share, fitted = kept_share(spark, rows, good, weights)
    assert share > 0.95 and fitted.targets == [1.0, 0.0] and fitted.shortfall[1] == 0.0
    share, fitted = kept_share(spark, rows, good + poor[:3], weights)
    assert share > 0.9 and sum(fitted.targets) > 0.95
    share, fitted = kept_share(spark, rows, labels, {"good": 0.01, "poor": 0.99})  # good is scarce in the target
    assert share < 0.9 and fitted.shortfall[fitted.domains.index("poor")] > 0.1
    share, fitted = kept_share(spark, rows, [], weights)
    assert share == 1.0


def test_draws_of_null_and_repeated_ids(spark):
    """Rows at a rate below 1 are drawn apart: with null ids, equal texts included, and with one id for all texts."""
    rows, labels = mix_rows()
    same = "### " * 50
    for ids in ([None] * 400, [77_777] * 400):
        extra = [(i, same + (words(random.Random(n), 1)[0] if i else ""), "en", "s", 1) for n, i in enumerate(ids)]
        labelled = mixing.label_domains(spark.createDataFrame(labels, LABELS), toxic=False)
        out, _ = mixing.mix_rates(spark.createDataFrame(rows + extra, DOCS), labelled, {"good": 0.97, "poor": 0.03}, upsample=False)
        mine = out.where("doc_id IS NULL OR doc_id = 77777").collect()
        want, got = sum(min(1.0, r["rate"]) for r in mine), sum(r["copies"] > 0 for r in mine)
        assert len(mine) == 400 and 4 < want < 390
        assert abs(got - want) < 5 * (want * (1 - want / 400)) ** 0.5 + 20
    out, _ = mixing.mix_rates(spark.createDataFrame([(None, t, *r) for _, t, *r in rows], DOCS), labelled, {"good": 0.9, "poor": 0.1})
    assert out.count() == len(rows)


def test_native_operators_run_no_python(spark):
    from lakeworks.llm import exact_dedup, line_dedup

    rows, labels = mix_rows(30)
    docs = spark.createDataFrame(rows, DOCS)
    frames = [
        exact_dedup.exact_duplicates(docs),
        line_dedup.line_dedup(docs),
        mixing.mix(docs, mixing.label_domains(spark.createDataFrame(labels, LABELS)), {"good": 1, "poor": 1})[0],
    ]
    for df in frames:
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow", "ArrowEval"))


# --------------------------------------------------------------------------- sharding


def shard_of(key, weights):
    key = "null" if key is None else str(key)
    scores = []
    for s, w in enumerate(weights):
        u = (int(hashlib.md5(f"{key}/{s}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        scores.append((-w / math.log(u), -s))
    return -max(scores)[1]


def test_shards_brute_force(spark):
    rows = corpus(3, 200)
    weights = (1.0,) * 8
    got = sharding.assign_shards(with_clashes(spark.createDataFrame(rows, DOCS)), weights).collect()
    want = sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", shard_of(i, weights), shard_of(i, (*weights, 1.0))) for i, t, *_ in rows),
        key=repr,
    )
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got), key=repr) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8)  # only the new shard takes rows
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(spark.createDataFrame([], DOCS), weights).collect() == []


def test_slots_of_a_hot_id(spark):
    """Most rows without an id or with one id, texts equal or not, one very long: no part of a shard gets many of them."""
    rows = [(None if k % 2 else 7, None if k % 3 else f"text {k}", "en", "s", 1) for k in range(3000)]
    rows += [(8, "long " * 200_000, "en", "s", 1)]
    got = sharding.assign_shards(spark.createDataFrame(rows, DOCS).repartition(4), (1.0,) * 8).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("shard"), F.rand(1).alias("salt"))
    plan = sharding.with_slots(stored(hot, "hot"), "shard", [F.col("doc_id"), F.col("salt")], ["doc_id"])
    assert sorted(r["slot"] for r in plan.collect()) == list(range(3000))
    parts = F.pmod(F.xxhash64(F.col("doc_id"), F.col("salt")), F.lit(sharding.SLOT_PARTS))
    assert max(r["count"] for r in hot.groupBy(parts).count().collect()) < 30


def test_weights_share_rows_and_move_few(spark):
    ids = spark.range(20_000)
    weights = (1.0, 2.0, 0.0, 1.0)
    n = Counter(r["s"] for r in ids.select(sharding.rendezvous(F.col("id"), weights).alias("s")).collect())
    assert n[2] == 0 and abs(n[1] - 10_000) < 400 and abs(n[0] - 5_000) < 300
    both = ids.select(sharding.rendezvous(F.col("id"), weights).alias("a"), sharding.rendezvous(F.col("id"), (1.0, 3.0, 0.0, 1.0)).alias("b"))
    assert {r["b"] for r in both.where("a != b").collect()} == {1}  # a heavier shard only attracts


# --------------------------------------------------------------------------- pipeline


def write_tables(spark, folder, rows, items, labels):
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")


def test_pipeline_brute_force(spark, tmp_dir):
    from tests.llm.test_text_scans import contaminated_corpus, toxic_rows

    rows, labels = toxic_rows(500)
    extra, items = contaminated_corpus()
    rows = [(1000 + i, *r) for i, *r in rows] + extra
    labels = [(1000 + i, q, t) for i, q, t in labels]
    write_tables(spark, tmp_dir, rows, items, labels)
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tmp_dir)
        out.write.parquet(f"{tmp_dir}/out/{name}")
        before = [tuple(r)[:5] for r in docs.collect()]
        docs = spark.read.parquet(f"{tmp_dir}/out/{name}")
        after = [tuple(r)[:5] for r in docs.collect()]
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
        assert not Counter(after) - Counter(before)
        seen[name] = before, after
    before, after = seen["toxicity"]
    truth = {i: t for i, _, t in labels}
    gone = Counter(r[0] for r in before) - Counter(r[0] for r in after)
    assert sum(truth.get(i) == 1 for i in gone) > 0.95 * sum(t for t in truth.values())
    assert sum(truth.get(i) != 1 for i in gone) <= 3
    before, after = seen["near_dedup"]
    group = near_brute_force(before)
    assert Counter(r[0] for r in after if r[0] is not None) == Counter(i for i in group if group[i] == i)
    before, after = seen["decontamination"]
    clean = [r[0] for r in contamination_brute_force(before, items) if not r[4]]
    assert Counter(r[0] for r in after) == Counter(clean)
    before, after = seen["mixing"]
    assert len(after) >= 0.8 * len(before)
    before, after = seen["sharding"]
    assert Counter(before) == Counter(after)
    shards = defaultdict(list)
    for r in docs.collect():
        assert r["shard"] == shard_of(r["doc_id"], corpus_pipeline.SHARDS)
        shards[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    run = corpus_pipeline.run(spark, tmp_dir)
    assert Counter(r["doc_id"] for r in run.collect()) == Counter(r["doc_id"] for r in docs.collect())


def test_pipeline_stages_on_odd_tables(spark, tmp_dir):
    write_tables(spark, tmp_dir, [], [], [])
    for docs in (spark.createDataFrame([], DOCS), with_clashes(spark.createDataFrame(corpus(1, 6), DOCS))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, tmp_dir)
            assert [c for c in out.columns if c not in ("shard", "slot")] == [c for c in docs.columns if c not in ("shard", "slot")], name
            assert out.count() <= docs.count()


def test_every_operator_has_one_query():
    names = [n for n in E.queries() if n.startswith("op")]
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit())
    assert numbers == list(range(1, 14))
    assert "pipeline" in E.queries()
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_queries_match_their_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        return
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    for name, sql in queries.ORACLES.items():
        want = con.execute(sql).df()
        got = queries.QUERIES[name](spark, folder)
        assert sorted(got.columns) == sorted(want.columns)
        columns = sorted(want.columns)
        assert rows_of(got, *columns) == sorted((tuple(getattr(r, c) for c in columns) for r in want.itertuples()), key=repr), name
