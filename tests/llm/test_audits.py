"""Centroid clustering, source divergence and toxicity: hard rows, bounds, interactions, brute force."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ingestkit.llm import centroids, divergence, quality_classifier, toxicity
from ingestkit.llm.common import table, written

SF = "/root/testdata/sf0.001"

# 11 centroid clustering


def brute_clusters(rows: list[tuple[int | None, list[int]]], k: int, rounds: int):
    """Plain k-means in Python integers: [(vec_id, cluster, distance)] and the centroids."""
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"3:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] or 0, r[1]))
    cs = [list(r[1]) for r in order[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, x in rows:
            groups.setdefault(near(x)[1], []).append(x)
        for i, g in groups.items():
            cs[i] = [sum(col) // len(g) for col in zip(*g, strict=True)]
    return [(i, near(x)[1], near(x)[0]) for i, x in rows], cs


def vectors(spark, rows):
    schema = "vec_id long, embedding array<double>, x string, cluster string, distance string, pivots string"
    return spark.createDataFrame([(i, v, "x", "c", "d", "p") for i, v in rows], schema)


def floored(rows):
    return [(i, [math.floor(1024 * y) for y in v]) for i, v in rows]


def test_centroids_hard_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    good += [good[3], good[3], (3, [9.0, 9.0, 9.0, 9.0]), (None, [0.5, 0.5, -0.5, -1e-9]), (99, [0.0] * 4)]
    bad = [(100, None), (101, []), (102, [1.0] * 3), (103, [1.0] * 5), (104, [1.0, None, 1.0, 1.0]),
           (105, [float("nan")] * 4), (106, [1.0, float("inf"), 0.0, 0.0]), (107, [1.0, float("-inf"), 0.0, 0.0])]
    got = centroids.clusters(vectors(spark, good + bad), k=5, rounds=4, dim=4).collect()
    want, cs = brute_clusters(floored(good), 5, 4)
    assert Counter((r.vec_id, r.cluster, r.distance) for r in got) == Counter(want)
    inertia = Counter()
    for _, c, d in want:
        inertia[c] += d
    for r in got:
        assert r.cluster_inertia == inertia[r.cluster] and r.inertia == sum(inertia.values())
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cs[r.cluster])).encode()).hexdigest()


def test_centroids_few_equal_and_no_vectors(spark):
    same = [(i, [1.0, 2.0]) for i in range(4)]
    got = centroids.clusters(vectors(spark, same), k=8, dim=2).collect()
    assert [(r.cluster, r.distance) for r in got] == [(0, 0)] * 4  # ties: the smaller number
    none = centroids.clusters(vectors(spark, []), dim=2)
    assert none.count() == 0 and none.columns[:3] == ["vec_id", "cluster", "distance"]
    assert centroids.clusters(vectors(spark, [(1, None)]), dim=2).count() == 0


def test_centroids_refuse_what_a_long_cannot_hold(spark):
    with pytest.raises(Exception, match="component out of range"):
        centroids.clusters(vectors(spark, [(1, [1e30, 0.0])]), dim=2).collect()


def test_ptolemaic_bounds_never_pass_the_distance():
    rng = np.random.default_rng(1)
    for scale in (3, 1_000, centroids.LIMIT):
        x = rng.integers(-scale, scale, (300, 64))
        x[:50] = x[0]  # equal vectors, pivots and centroids among them
        c = np.concatenate((x[:4], rng.integers(-scale, scale, (6, 64))))
        pivots = centroids.Pivots.of(x[:60])
        low = pivots.bounds(pivots.distances(x), c)
        exact = np.sqrt(np.stack([centroids.squared(x, y) for y in c], 1).astype(float))
        assert (low <= exact * (1 + 1e-12)).all()
        cluster, best, _ = centroids.nearest(x, pivots.distances(x), c, pivots)
        brute = np.stack([centroids.squared(x, y) for y in c], 1)
        assert (cluster == brute.argmin(1)).all() and (best == brute.min(1)).all()


def test_bounds_prune_vectors_in_clusters():
    rng = np.random.default_rng(2)
    middles = rng.integers(-1000, 1000, (8, 64))
    x = np.repeat(middles, 50, 0) + rng.integers(-20, 20, (400, 64))
    pivots = centroids.Pivots.of(middles)
    _, _, checked = centroids.nearest(x, pivots.distances(x), middles, pivots)
    assert checked.mean() < 2


# 12 source divergence

WORDS = "alpha beta gamma delta naïve 漢字 don't x9y Ünder UPPER".split()


def divergence_rows():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(160):
        lang = [None, "", "en", "de"][i % 4]
        source = ["a", "b", None, "é", "a\u0000"[:1], "Z"][int(rng.integers(6))]
        rows.append((i, " ".join(rng.choice(WORDS, int(rng.integers(0, 30)))), lang, source))
    rows += [rows[0], rows[0], (500, None, "en", "none"), (501, "", "de", None), (502, "! 12 _", "xx", "a"),
             (503, "few words", "xx", "b"), (None, " ".join(WORDS * 4_000), "en", "a"), (504, "alone", "yy", "q")]
    return rows


def as_documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, term string, g int, p long, value string, n string"
    return spark.createDataFrame([(*r, "t", 1, 2, "v", "n") for r in rows], schema)


def by_sql(rows):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]).astype({"text": object}))
    return con.execute(divergence.ORACLE).fetchall()


def test_divergence_hard_rows(spark, monkeypatch):
    rows = divergence_rows()
    want = Counter(by_sql(rows))
    assert Counter(map(tuple, divergence.audit(as_documents(spark, rows)).collect())) == want
    monkeypatch.setattr(divergence, "BLOCK", 7)  # blocks, and steps inside a block, that cut every term's row
    monkeypatch.setattr(divergence, "COUNTED", 3)
    assert Counter(map(tuple, divergence.audit(as_documents(spark, rows)).collect())) == want


def test_divergence_empty_and_without_kept_terms(spark):
    assert divergence.audit(as_documents(spark, [])).count() == 0
    rows = [(1, "one", "en", "a"), (2, "two", "en", "b"), (3, None, "en", None), (4, "x", "fr", "a")]
    got = {tuple(r) for r in divergence.audit(as_documents(spark, rows)).collect()}
    assert got == {("en", s, "pair", o, 0, k + 1) for s in ("", "a", "b") for k, o in enumerate(x for x in ("", "a", "b") if x != s)}


def test_divergence_counts_beyond_a_long_product(spark):
    """Shares of counts whose product with the unit passes 64 bits are exact."""
    n, total, terms = 123_456_789_012_345, 987_654_321_098_765_432, 1_000_003
    df = spark.range(1).select(
        divergence._share(F.lit(n).cast("long"), F.lit(total).cast("decimal(38,0)"), F.lit(terms).cast("long")).alias("p")
    )
    assert df.first()["p"] == 1 + 10**9 * (n + 2) // (total + 2 * terms)


# 13 toxicity

TEXTS = "doc_id long, text string, lang string, source string, score string, row string, held_out string, x string"


def toxic_rows(n: int):
    """Insult and group words, toxic only for two of the four ways to put them together."""
    rng = np.random.default_rng(4)
    rows, marks = [], []
    for i in range(n):
        insult, group = rng.integers(2, size=2)
        words = ["vile" if insult else "grumpy", "birds" if group else "stones", *(f"w{k}" for k in rng.integers(0, 40, 6))]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(insult == group)))
    return rows, marks


def frames(spark, rows, marks):
    docs = spark.createDataFrame([(i, t, "en", "s", "a", "b", "c", "d") for i, t in rows], TEXTS)
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_toxicity_learns_interactions_that_no_sum_has():
    rows, marks = toxic_rows(3_000)
    known = toxicity.Features()
    x, y = [known.of(t) for _, t in rows], np.array([m[2] for m in marks])
    m = toxicity.fit_rows(x[:2_000], y[:2_000])
    assert ((m.scores(x[2_000:]) >= 0.5) == y[2_000:]).mean() > 0.97
    alone = toxicity.Model(m.bias, m.numbers, m.values, m.weights, np.zeros_like(m.factors))
    assert ((alone.scores(x[2_000:]) >= 0.5) == y[2_000:]).mean() < 0.7


def test_toxicity_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(6)
    n = 9
    m = toxicity.Model(0.3, np.arange(n, dtype=np.int32) * 7, rng.random(n), rng.normal(size=n), rng.normal(size=(n, toxicity.FACTORS)))
    x = m.numbers[[0, 2, 3, 8]]
    q = m.values[[0, 2, 3, 8]] / math.sqrt(sum(v * v for v in m.values[[0, 2, 3, 8]]))
    w, v = m.weights[[0, 2, 3, 8]], m.factors[[0, 2, 3, 8]]
    z = m.bias + sum(a * b for a, b in zip(w, q, strict=True))
    z += sum(float(v[i] @ v[j]) * q[i] * q[j] for i in range(4) for j in range(i))
    assert m.scores([np.append(x, 5)])[0] == pytest.approx(1 / (1 + math.exp(-z)))  # 5 is no number of the model
    assert m.scores([x[:0]])[0] == pytest.approx(1 / (1 + math.exp(-m.bias)))


def test_toxicity_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = toxicity.classify(docs, labels).join(labels, "doc_id").where("held_out")
    share = {r["toxic"]: r["share"] for r in got.groupBy("toxic").agg(F.avg("predicted").alias("share")).collect()}
    assert share[1] > 0.85 and share[0] < 0.01


def test_toxicity_hard_rows(spark):
    rows, marks = toxic_rows(400)
    long = " ".join(f"w{i % 977}" for i in range(40_000)) + " vile birds"
    rows += [(None, "vile birds"), (1_000, None), (1_001, ""), (1_002, long), (5, "another text of id 5"), rows[7], rows[7], (1_003, "漢字 naïve x")]
    marks += [(5, 1, 1), (5, 1, 0), (None, 1, 1), (1_000, 1, None), (1_002, None, 1), (77_777, 1, 1)]
    docs, labels = frames(spark, rows, marks)
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
    again = toxicity.classify(docs.repartition(7), labels.repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[1_000] == by_id[1_001]


def test_toxicity_without_rows_or_labels(spark):
    rows, marks = toxic_rows(20)
    docs, labels = frames(spark, rows, marks)
    assert toxicity.classify(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0.5}
    one = toxicity.classify(docs, labels.withColumn("toxic", F.lit(0))).collect()
    assert len({r.score for r in one}) == 1 and one[0].score < 0.5


def test_held_out_labels_change_nothing(spark):
    rows, marks = toxic_rows(200)
    held = [m for m in marks if zlib.crc32(str(m[0]).encode()) % 4 == 2]
    docs, labels = frames(spark, rows, marks)
    _, turned = frames(spark, rows, [(i, q, 1 - t if (i, q, t) in held else t) for i, q, t in marks])
    a, b = (sorted(map(tuple, toxicity.classify(docs, x).collect())) for x in (labels, turned))
    assert held and a == b


# 9 quality classifier: the whole fit again, dense and in plain Python


def plain_features(text: bytes) -> set[int]:
    out = set()
    for i in range(len(text) - 3):
        key = int.from_bytes(text[i : i + 4], "little")
        out.add((((key ^ key >> 15) * 2654435761) & 0xFFFFFFFF) >> (32 - quality_classifier.BITS))
    run = best = 0
    words = text.split()
    for a, b in zip([None, *words], words, strict=False):
        run = run + 1 if a == b else 0
        best = max(best, run)
    return out | {(1 << quality_classifier.BITS) + k for k in range(min(best, quality_classifier.RUN))}


def test_quality_fit_against_a_dense_one():
    rng = np.random.default_rng(12)
    texts, good = [], []
    for i in range(50):
        words = rng.choice(["plain", "prose", "of", "words", "with", "sense"] if i // 3 % 2 else ["buy", "buy", "now", "now", "$$$", "words"], 12)
        texts.append(" ".join(words).encode())
        good.append(i // 3 % 2)
    good = np.array(good)
    model = quality_classifier.fit_rows(texts, good)
    sets = [plain_features(t) for t in texts]
    place = np.empty(quality_classifier.FEATURES, np.int64)
    assert [set(quality_classifier.features(t, place).tolist()) for t in texts] == sets
    fit = [i for i in range(50) if i % quality_classifier.CURVE]
    ratio = {}
    for f in set().union(*(sets[i] for i in fit)):
        counts = [1 + sum(f in sets[i] for i in fit if good[i] == g) for g in (0, 1)]
        sizes = [2 + sum(good[i] == g for i in fit) for g in (0, 1)]
        ratio[f] = math.log(counts[1] / sizes[1]) - math.log(counts[0] / sizes[0])
    every = sorted(set().union(*sets))
    x = np.array([[ratio.get(f, math.log(good[fit].size - good[fit].sum() + 2) - math.log(good[fit].sum() + 2)) * (f in s) / math.sqrt(len(s)) for f in every] for s in sets])
    x1 = np.hstack((x, np.ones((50, 1))))  # the intercept is a feature that every row has
    sign, dual, w, order = 2 * good - 1, np.zeros(len(fit)), np.zeros(len(every) + 1), np.random.default_rng(0)
    for _ in range(quality_classifier.EPOCHS):
        most = 0.0
        for k in order.permutation(len(fit)):
            i = fit[k]
            new = min(max(dual[k] - (sign[i] * (w @ x1[i]) - 1) / (x1[i] @ x1[i]), 0), quality_classifier.COST)
            w += (new - dual[k]) * sign[i] * x1[i]
            most, dual[k] = max(most, abs(new - dual[k])), new
        if most < 1e-4:
            break
    margins = x1 @ w
    held = np.array([i for i in range(50) if i % quality_classifier.CURVE == 0])
    n1 = int(good[held].sum())
    target = np.where(good[held] == 1, (n1 + 1) / (n1 + 2), 1 / (len(held) - n1 + 2))
    p = 1 / (1 + np.exp(-(model.slope * margins[held] + model.offset)))
    assert abs((p - target).sum()) < 1e-4 and abs(((p - target) * margins[held]).sum()) < 1e-4  # the curve's slopes are zero
    scores = model.scores(pa.array(texts, pa.binary()))
    assert np.allclose(scores, 1 / (1 + np.exp(-(model.slope * margins + model.offset))), atol=1e-4)
    assert ((scores >= 0.5) == good).all()


# the pipeline's chain on hard rows


def test_pipeline_stages_on_hard_rows_and_none(spark):
    import corpus_pipeline as cp

    words = " ".join(f"word{i % 700}" for i in range(6_000))
    rows = [(1, "the same text of some plain words here", "en", "a", "x", "y"), (2, "the same text of some plain words here", "en", "b", "x", "y"),
            (2, "the same text of some plain words here", "en", "b", "x", "y"), (3, None, None, None, None, None), (4, "", "en", "a", "x", "y"),
            (None, "other words of a text without an id", "en", "a", "x", "y"), (None, None, None, None, "x", "y"),
            (5, words, "en", "b", "x", "y"), (6, words + " end", "en", None, "x", "y"), (7, "naïve 漢字 \U0001f600 　x\n\ty </s>", "fr", "c", "x", "y")]
    schema = "doc_id long, text string, lang string, source string, ids string, row_id string"
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = given = written(frame, "chain")
        for name, stage in cp.STAGES:
            before, docs = docs, written(stage(spark, docs, SF), name)
            if name != "byte_bpe":
                assert docs.columns == given.columns
                assert docs.exceptAll(before.unionByName(before)).isEmpty()  # rows come from the stage's own input
        assert docs.columns[:5] == ["doc_id", "lang", "source", "ids", "row_id"]
        digests = {r.text and hashlib.sha256(r.text.encode()).hexdigest() for r in before.collect()}
        assert {r.decoded_sha256 for r in docs.collect()} == digests
        if frame.isEmpty():
            assert docs.count() == 0
