"""Toxicity, co-trained quality and licences."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import EDGES, lowered

from tillcast.llm import cotrain, licenses, sparse, toxicity


def held_out(spark, train, score, label):
    """Results and labels of a quarter of the labelled documents, by a model of the others."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs, labels.where("doc_id % 4 != 0"))
    truth = {r["doc_id"]: r[label] for r in labels.where("doc_id % 4 = 0").collect()}
    return [(r, truth[r["doc_id"]]) for r in score(docs, model).collect() if r["doc_id"] in truth]


def test_toxicity_held_out(spark):
    rows = held_out(spark, toxicity.train, toxicity.score, "toxic")
    clean = [r["toxic"] for r, t in rows if t == 0]
    assert sum(clean) <= 0.02 * len(clean)
    assert sum(r["toxic"] for r, t in rows if t == 1) >= 0.8 * sum(t for _, t in rows)
    assert all(0 <= r["severity"] <= 2 and 0 <= r["grade"] <= 2 for r, _ in rows)
    means = [np.mean([r["severity"] for r, t in rows if t == k]) for k in (0, 1)]
    assert means[1] > 3 * means[0]


def test_quality_held_out(spark):
    rows = held_out(spark, cotrain.train, cotrain.score, "quality")
    good = [r["kept"] for r, t in rows if t == 1]
    poor = [r["kept"] for r, t in rows if t == 0]
    assert sum(good) >= 0.95 * len(good) and sum(poor) <= 0.3 * len(poor)


def test_ordinal_regression_recovers_order():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(3000, 2))
    at = 1.5 * x[:, 0] - x[:, 1] + draw.logistic(size=3000)
    grade = (at > 0.5).astype(int) + (at > 2)
    rows = sparse.Rows(3000, np.repeat(np.arange(3000), 2), np.tile([0, 1], 3000), x.ravel())
    weights, cuts = toxicity.fit_ordinal(rows, grade, 2)
    assert weights == pytest.approx([1.5, -1], abs=0.15) and cuts == pytest.approx([0.5, 2], abs=0.15)


def test_models_on_edges(spark, edges, empty, table):
    labels = spark.createDataFrame([(1, 0, 1), (4, 1, 0), (4, 1, 1), (None, 1, 1), (5, None, None), (99, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    nothing = labels.limit(0)
    for known in (labels, nothing, labels.where("toxic = 1")):
        model = toxicity.train(edges, known)
        assert toxicity.score(edges, model).count() == len(EDGES)
        kept = toxicity.without_toxic(edges, model)
        assert kept.columns == edges.columns and kept.schema == edges.schema
        assert cotrain.score(edges, cotrain.train(edges, known)).count() == len(EDGES)
    assert toxicity.without_toxic(edges, toxicity.train(edges, nothing)).count() == len(EDGES)
    assert cotrain.score(edges, cotrain.train(edges, nothing)).where("NOT kept").count() == 0
    trained = toxicity.train(table("documents"), table("labels"))
    assert toxicity.score(empty, trained).count() == 0 and toxicity.without_toxic(empty, trained).count() == 0
    same = toxicity.score(edges, trained).where("doc_id = 4").select("severity").distinct().count()
    assert same == 1
    assert toxicity.score(edges, toxicity.train(empty, labels)).where("toxic").count() == 0


def test_selection_is_the_chi_square_of_counts(spark):
    rows = [("bad a b", 1)] * 6 + [("bad b", 1), ("a b", 0)] + [("a c", 0)] * 6 + [(None, 0), ("", 1)]
    sample = spark.createDataFrame(rows, "text string, y int")
    features, ratios = sparse.select(sample, sparse.word_features(), 10)
    words = {w: sparse.word_features()(__import__("pyarrow").array([w]))[1][0] for w in ("bad", "a", "b", "c")}
    assert set(features.tolist()) == {words["bad"], words["b"], words["c"]}
    assert ratios[features.tolist().index(words["bad"])] > 0 > ratios[features.tolist().index(words["c"])]


def brute_licence(texts, templates):
    """The best cosine of each text's sentences, with dictionaries."""

    def plain(text):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[!-/:-@\[-`{-~]", " ", lowered(text)))

    own = [(name, plain(text)) for name, text in templates]
    vocabulary = {w for _, t in own for w in t}
    seen = Counter(w for text in texts for w in set(plain(text)) & vocabulary)
    other = math.log(len(texts) + 1) + 1

    def vector(tokens):
        weight = {w: math.log((len(texts) + 1) / (seen[w] + 1)) + 1 if w in vocabulary else other for w in tokens}
        counts = Counter(tokens)
        norm = math.sqrt(sum((n * weight[w]) ** 2 for w, n in counts.items()))
        return {w: n * weight[w] / norm for w, n in counts.items()}

    vectors = [(name, vector(t)) for name, t in own]
    out = []
    for text in texts:
        best = (0.0, None)
        for sentence in re.split(r"\n|(?<=[.!?])(?=[ \t\n\r])", text or ""):
            mine = vector(plain(sentence))
            for name, v in vectors:
                cosine = round(sum(x * v.get(w, 0) for w, x in mine.items()), 12)
                if cosine >= licenses.SIMILAR and (-cosine, name) < (-best[0], best[1] or "~"):
                    best = (cosine, name)
        out.append(best)
    return out


def test_own_licences_against_brute_force(table, make):
    rows = [(r["doc_id"], r["text"]) for r in table("documents").limit(400).collect()] + [
        (5000, "Licensed under CC BY 4.0."), (5001, "x. Released under the MIT Licence! All rights reserved."),
        (5002, None), (5003, ""), (5004, "..."),
    ]
    docs = make(rows).withColumnRenamed("value", "path")
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    for (doc_id, _), (cosine, name) in zip(rows, brute_licence([t for _, t in rows], licenses.TEMPLATES)):
        assert (got[doc_id]["licence"], round(got[doc_id]["similarity"], 9)) == (name, round(cosine, 9))
    assert any(r["licence"] for r in got.values())


def test_inheritance(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/b/c/x", "plain words"),
        ("a/b/LICENSE", "Licensed under the Apache License, Version 2.0."),
        ("a/b/y", "plain words"),
        ("a/z", None),
        ("ab/z", "plain words"),
        ("a/b/own", "many plain words stand around it here and there. Licensed under CC BY-NC 4.0."),
        ("top", "plain"),
        (None, "plain"),
    ]
    docs = spark.createDataFrame([(i, p, t, 1) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, own int")
    got = {r["path"]: (r["licence"], r["origin"], r["directory"]) for r in licenses.scan(docs).collect()}
    assert got == {
        "a/LICENSE": ("MIT", "own", None),
        "a/b/c/x": ("Apache-2.0", "inherited", "a/b"),
        "a/b/LICENSE": ("Apache-2.0", "own", None),
        "a/b/y": ("Apache-2.0", "inherited", "a/b"),
        "a/z": ("MIT", "inherited", "a"),
        "ab/z": (None, "none", None),
        "a/b/own": ("CC-BY-NC-4.0", "own", None),
        "top": (None, "none", None),
        None: (None, "none", None),
    }
    assert licenses.scan(docs.limit(0)).count() == 0


def test_samples_are_bounded_by_rows(spark):
    """One labelled id on thousands of rows is one row of the sample, whatever the order of rows."""
    text = F.concat_ws(" ", F.lit("some words"), F.col("id").cast("string"))
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), text.alias("text"))
    docs = docs.unionByName(spark.range(100, 140).select(F.col("id").alias("doc_id"), text.alias("text")))
    labels = docs.select("doc_id").distinct().select("doc_id", F.lit(1).alias("toxic"), F.lit(0).alias("quality"))
    rows = toxicity.labelled_sample(docs, labels, "toxic", 41).collect()
    assert len(rows) == 41 and [r["text"] for r in rows if r["doc_id"] == 7] == ["some words 0"]
    assert toxicity.labelled_sample(docs, labels, "toxic", 10).count() == 10
    assert cotrain._sample(docs.repartition(7), labels, 41).where("y >= 0").count() == 41


def test_every_unlabelled_document_takes_part(spark, table):
    """What is handed on is the surest of all documents without a label, whatever the bound of a fit."""
    docs, labels = table("documents"), table("labels")
    sample = cotrain._sample(docs, labels, 300)
    chosen, _ = sparse.select(sample, cotrain.OCCURRENCES, 500)
    pool = cotrain._pool(docs.unionByName(docs), labels, chosen)
    rows = docs.toPandas()
    known = set(labels.where("quality IS NOT NULL").toPandas().doc_id)
    free = rows[~rows.doc_id.isin(known)].drop_duplicates(["doc_id", "text", "source", "lang"])
    assert pool.count() == len(free) > 300

    known = cotrain._features(sample, chosen, "h", "y").toArrow().sort_by("h")
    *_, done = cotrain.co_train(known, pool, len(chosen), 300, 2)
    assert len(done) == 2
    got = cotrain.Features.read(pool.toArrow())
    rate, before = known["y"].to_numpy().mean(), np.full((2, len(free)), -1)
    for turn, exchange in enumerate(done):
        after = got.given(done[: turn + 1])
        assert (after[before >= 0] == before[before >= 0]).all()
        for view, (found, weights) in enumerate(zip(got.views, exchange.weights)):
            dense = np.zeros((len(free), len(weights) - 1))
            np.add.at(dense, (found.row, found.feature), found.value)
            odds = dense @ weights[:-1] + weights[-1]
            for value in (0, 1):
                own = odds if value else -odds
                could = (before[1 - view] < 0) & (1 / (1 + np.exp(-own)) >= cotrain.SURE)
                most = math.ceil(cotrain.SHARE * (rate if value else 1 - rate) * len(free))
                new = (before[1 - view] < 0) & (after[1 - view] == value)
                assert not (new & ~could).any()
                wanted = min(most, could.sum())
                bin_size = max(np.bincount(np.floor(cotrain.BINS * np.clip(own[could], 0, cotrain.UNITS)).astype(int)),
                               default=0)
                assert abs(new.sum() - wanted) <= 3 * math.sqrt(bin_size)
                if (could & ~new).any() and new.any():
                    assert min(own[new].min(), 40) >= min(own[could & ~new].max(), 40) - 1 / cotrain.BINS
        before = after
    assert (before >= 0).any()

    # Documents of a fit are bounded, and the same in any order of rows.
    drawn = [cotrain._drawn(p, done, [1.0, 1.0], 50) for p in (pool, pool.repartition(7))]
    for (one, y), (two, z) in zip(*drawn):
        assert one.count == two.count <= 50 and (y == z).all() and (one.feature == two.feature).all()


def test_bound_of_what_is_handed_on():
    assert cotrain.bound_of({}, 5) == (-1, 0.0, 0)
    assert cotrain.bound_of({200: 2, 300: 1}, 5) == (-1, 0.0, 3)
    assert cotrain.bound_of({200: 8, 300: 1, 250: 2}, 5) == (200, 0.25, 5)
    assert cotrain.bound_of({2560: 1000}, 5) == (2560, 0.005, 5)
