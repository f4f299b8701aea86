"""Quality: estimated accuracies on votes of known accuracy, edge cases, agreement with held-back labels."""

import random

import numpy as np

from flowline.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_estimates_accuracies_without_labels():
    chance = random.Random(4)
    right = (0.95, 0.9, 0.85, 0.8, 0.9, 0.7, 0.95, 0.97)
    patterns, truth = {}, []
    for _ in range(20_000):
        good = chance.random() < 0.7
        pattern = "".join(
            "-" if chance.random() < 0.2 else str(int(good if chance.random() < r else not good)) for r in right
        )
        patterns[pattern] = patterns.get(pattern, 0) + 1
        truth.append((pattern, good))
    model = quality.estimate(patterns)
    assert abs(model.good - 0.7) < 0.03
    assert np.allclose(list(model.accuracies().values()), right, atol=0.03)
    assert np.mean([(model.posterior(p) >= 0.5) == g for p, g in truth]) > 0.95


def test_nothing_to_estimate():
    model = quality.estimate({})
    assert model.posterior("01-01-01") == 0.5
    assert quality.train_linear([], np.zeros(0)) == ({}, 0.0)


def plain(chance, n=80):
    return " ".join(chance.choice("the of and river stone walked under many lights before noon".split()) + str(k % 7) for k in range(n)) + "."


def corpus():
    chance = random.Random(8)
    rows = [(i, plain(chance)) for i in range(200)]
    rows += [(1000 + i, " ".join(w + "$$$" for w in plain(chance).split())) for i in range(30)]
    rows += [(2000 + i, plain(chance).upper().replace(" ", "!! ")) for i in range(30)]
    rows += [(3000 + i, "same line again\n" * 30) for i in range(3)]
    rows += [(4000, None), (4001, ""), (None, plain(chance)), (5, rows[5][1]), (5, rows[5][1]), (4002, "🙂" * 50), (4003, "word " * 50_000)]
    return rows


def test_scores_planted_junk(spark):
    rows = corpus()
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as score", "'p' as pattern")
    model = quality.fit(documents)
    got = quality.score(documents, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score for r in got}
    assert all(by_id[i] >= 0.5 for i in range(200)) and by_id[None] >= 0.5
    assert all(s < 0.5 for i, s in by_id.items() if i is not None and 1000 <= i < 4000)
    assert by_id[4000] == by_id[4001] and by_id[4003] < 0.5
    kept = quality.of_quality(documents, model)
    assert kept.columns == documents.columns
    assert sorted(str(r[0]) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.score >= 0.5)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    model = quality.fit(none)
    assert quality.score(none, model).count() == 0 and quality.of_quality(none, model).count() == 0


def test_query_agrees_with_labels_it_never_saw(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = {r.doc_id: r.predicted for r in queries.op8_quality(spark, SF).collect()}
    assert len(got) == 1000
    assert sum(got[i] == q for i, q in labels.items()) >= 0.95 * len(labels)
    assert sum(got[i] for i, q in labels.items() if q) >= 0.98 * sum(labels.values())
