"""Pseudo-likelihood: gradients, scores against a plain loop, and what training makes of order."""

import random
import resource
from collections import Counter

import numpy as np
import pytest

from flowline.llm import pseudolikelihood as L
from flowline.llm import queries

SF = "/root/testdata/sf0.001"


def log_probabilities(p, windows):
    """Of the classes, as written down."""
    h = np.tanh(p["hidden"] + p["near"][windows].sum(1))
    z = h @ p["out"] + p["bias"]
    return h, z - np.log(np.exp(z).sum(1, keepdims=True))


def test_gradients_are_those_of_the_loss():
    chance = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in L.initial(3).items()}
    row, places, _ = L._joined([bytes(chance.integers(1, 6, 40).tolist())])
    windows, target = L._windows(row, places), row[places]
    loss = lambda q: -log_probabilities(q, windows)[1][np.arange(len(target)), target].mean()
    found = L.gradients(p, windows, target)
    for name in L.NAMES:
        for at in np.argwhere(np.abs(found[name]) > 1e-4)[:5]:
            near = []
            for step in (1e-5, -1e-5):
                moved = {**p, name: p[name].copy()}
                moved[name][tuple(at)] += step
                near.append(loss(moved))
            assert found[name][tuple(at)] == pytest.approx((near[0] - near[1]) / 2e-5, rel=1e-3, abs=1e-7)


def plain_score(p, classes):
    total = 0.0
    for at in range(len(classes)):
        h = p["hidden"].astype(float)
        for k, d in enumerate((-2, -1, 1, 2)):
            beside = classes[at + d] if 0 <= at + d < len(classes) else 0
            h = h + p["near"][k * L.CLASSES + beside]
        z = np.tanh(h) @ p["out"] + p["bias"]
        total += z[classes[at]] - np.log(np.exp(z).sum())
    return total


def test_scores_as_a_plain_loop(monkeypatch):
    chance = np.random.default_rng(5)
    documents = [bytes(chance.integers(0, L.CLASSES, n).tolist()) for n in (0, 1, 2, 3, 50, 0, 7)]
    p = L.initial(9)
    want = [plain_score(p, d) for d in documents]
    assert np.allclose(L.document_scores(p, documents), want, rtol=1e-4)
    monkeypatch.setattr(L, "SCORE_TOKENS", 4)
    assert np.allclose(L.document_scores(p, documents), want, rtol=1e-4)
    assert L.document_scores(p, [b"", b""]).tolist() == [0, 0]


def test_every_token_is_a_target_once(monkeypatch):
    documents = [bytes(range(1, n + 1)) for n in (1, 0, 2, 3, 1, 7, 50, 1)]
    seen = Counter()

    def spy(p, windows, target):
        seen.update(target.tolist())
        return {k: np.zeros_like(v) for k, v in p.items() if k in L.NAMES}

    monkeypatch.setattr(L, "gradients", spy)
    for number in range(L.ROUNDS):
        trainer = L.Trainer(L.initial())
        trainer.learn(documents[:3], number, L.ROUNDS)
        trainer.learn(documents[3:], number, L.ROUNDS)
    assert seen == Counter(c for d in documents for c in d)


def sentences(chance, n):
    return " ".join(f"{chance.choice(['the', 'a'])} {chance.choice(['dog', 'cat', 'hen'])} {chance.choice(['sees', 'hears'])} {chance.choice(['me', 'you'])} ." for _ in range(n))


def test_order_is_learned(spark):
    chance = random.Random(3)
    rows = [(i, sentences(chance, 40)) for i in range(300)]
    shuffled = sentences(chance, 40).split()
    chance.shuffle(shuffled)
    rows += [(1000, " ".join(shuffled)), (1001, "zq wx qy " * 30), (1002, None), (1003, " \n "), (None, sentences(chance, 5)), (5, rows[5][1])]
    rows += [(1004, sentences(chance, 8000))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as classes", "'n' as n_tokens")
    got = L.score(df).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    usual = [by_id[i].mean_log_likelihood for i in range(300)]
    assert by_id[1000].mean_log_likelihood < min(usual) - 0.3 and by_id[1001].mean_log_likelihood < min(usual) - 1
    assert abs(by_id[1004].mean_log_likelihood - np.mean(usual)) < 0.2
    assert (by_id[1002].n_tokens, by_id[1002].log_likelihood, by_id[1003].mean_log_likelihood) == (0, 0, 0)
    assert all(r.n_tokens == len((t or "").split()) for r, t in ((by_id[i], t) for i, t in rows))
    assert by_id[0].log_likelihood == pytest.approx(by_id[0].mean_log_likelihood * by_id[0].n_tokens)
    # Five choices, two of them certain: no model can do much better than these.
    assert -1.1 < np.mean(usual) < (2 * np.log(1 / 2) + np.log(1 / 3) + np.log(1 / 2)) / 5 + 0.15


def test_vocabulary_counts_all_words(spark):
    rows = [(i, f"common rare{i} common\tother{i % 3}\x0bend{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    counted = {r.word: r.n for r in L.count_words(df).collect()}
    assert counted == Counter(w for _, t in rows for w in t.encode().decode().replace("\x0b", " ").split())
    vocabulary = L.learn_vocabulary(df)
    assert vocabulary.own[0] == b"common" and len(vocabulary.own) == L.OWN
    assert np.allclose(np.exp(vocabulary.within.reshape(L.CLASSES, -1)).sum(1), 1, atol=1e-3)


def test_gradients_and_scores_with_known_words():
    chance = np.random.default_rng(2)
    first = np.minimum(np.arange(L.CLASSES - L.OWN), 6) * 2
    p = {k: v.astype(np.float64) for k, v in L.initial(4, first).items()}
    p["inner"] += chance.normal(0, 0.5, p["inner"].shape)
    p["inner_bias"] += chance.normal(0, 0.5, p["inner_bias"].shape)
    ids = [*range(L.OWN - 1, L.OWN + 9), *range(L.CLASSES, L.CLASSES + 12)]
    document = np.array(chance.choice(ids, 60), np.uint8).tobytes()
    row, places, _ = L._joined([document], L.CLASSES + 12)
    windows, target = L._windows(row, places, L.CLASSES + 12), row[places]
    loss = lambda q: -L.document_scores(q, [document])[0] / len(target)
    found = L.gradients(p, windows, target)
    for name in L.NAMES:
        for at in np.argwhere(np.abs(found[name]) > 1e-4)[:20:4]:
            near = []
            for step in (1e-5, -1e-5):
                moved = {**p, name: p[name].copy()}
                moved[name][tuple(at)] += step
                near.append(loss(moved))
            assert found[name][tuple(at)] == pytest.approx((near[0] - near[1]) / 2e-5, rel=1e-3, abs=1e-7)
    # The probabilities of all words the network tells apart make one.
    total = 0.0
    for k in range(L.CLASSES + 12):
        changed = np.frombuffer(document, np.uint8).copy()
        changed[30] = k
        at = slice(30, 31)
        h, z = L._hidden(p, windows[at]), log_probabilities(p, windows[at])[1]
        group = p["group"][changed[at]].astype(int)
        total += np.exp(z[0, group[0]] + sum(w[0, word[0]] for _, _, _, word, w in L._inner(p, h, changed[at], group)))
    assert total == pytest.approx(1)


def known_network(seed, wide=1.0):
    """A network in float64 with 9 known words in most classes of endings, none in some, and a document of its ids."""
    chance = np.random.default_rng(seed)
    first = np.minimum(np.arange(L.CLASSES - L.OWN), 20) * 9
    p = {k: v.astype(np.float64) for k, v in L.initial(seed, first).items()}
    for name, size in (("inner", 0.5), ("inner_bias", 0.5), ("out", 0.2), ("bias", 0.5)):
        p[name] = (p[name] + chance.normal(0, size, p[name].shape)) * wide
    return p, chance.integers(1, L.CLASSES + int(first[-1]), 400).astype(np.uint16)


@pytest.mark.parametrize("wide", [1, 60])
def test_gradients_in_any_order_and_with_large_weights(wide):
    p, ids = known_network(8, wide)
    assert L._bounded(L._weights(p)) == (wide == 1)
    row, places, _ = L._joined([ids.tobytes()], len(p["group"]))
    loss = lambda q: -L.document_scores(q, [ids.tobytes()])[0] / len(places)
    found = {k: v.copy() for k, v in L.gradients(p, L._windows(row, places, len(p["group"])), row[places]).items()}
    L.gradients(p, L._windows(row, places[:50], len(p["group"])), row[places[:50]])  # what a smaller step leaves behind
    shuffled = np.random.default_rng(1).permutation(places)
    again = L.gradients(p, L._windows(row, shuffled, len(p["group"])), row[shuffled])
    for name in L.NAMES:
        assert found[name].shape == p[name].shape and np.allclose(found[name], again[name], rtol=1e-9, atol=1e-12)
        for at in np.argwhere(np.abs(found[name]) > 1e-4)[:40:8]:
            near = []
            for step in (1e-6, -1e-6):
                moved = {**p, name: p[name].copy()}
                moved[name][tuple(at)] += step
                near.append(loss(moved))
            assert found[name][tuple(at)] == pytest.approx((near[0] - near[1]) / 2e-6, rel=1e-2, abs=1e-6)


def test_scores_with_known_words_as_a_plain_loop():
    for wide in (1, 60):
        p, ids = known_network(11, wide)
        want, n = 0.0, len(p["group"])
        for at in range(len(ids)):
            beside = [int(ids[at + d]) if 0 <= at + d < len(ids) else 0 for d in (-2, -1, 1, 2)]
            h, z = log_probabilities(p, np.array([[k * n + b for k, b in enumerate(beside)]]))
            group = int(p["group"][ids[at]])
            want += z[0, group]
            k = group - L.OWN - 1
            if k >= 0 and p["first"][k + 1] > p["first"][k]:
                rows = slice(int(p["first"][k]) + k, int(p["first"][k + 1]) + k + 1)
                own = p["inner"][rows] @ h[0] + p["inner_bias"][rows]
                word = max(int(ids[at]) - L.CLASSES - int(p["first"][k]) + 1, 0)
                want += own[word] - own.max() - np.log(np.exp(own - own.max()).sum())
        assert L.document_scores(p, [ids.tobytes()])[0] == pytest.approx(want)


def test_steps_use_their_memory_again():
    """Fresh memory is a page at a time that the system has to hand out, some 450 a step before."""
    p, _ = known_network(6)
    trainer = L.Trainer({k: v.astype(np.float32) if k in L.NAMES else v for k, v in p.items()})
    chance = np.random.default_rng(6)
    documents = [chance.integers(1, len(p["group"]), 6000).astype(np.uint16).tobytes() for _ in range(4)]
    trainer.learn(documents, 0, 1)
    pages = resource.getrusage(resource.RUSAGE_THREAD).ru_minflt
    for _ in range(3):
        trainer.learn(documents, 0, 1)
    steps = 3 * 24_000 / L.STEP_WINDOWS
    assert (resource.getrusage(resource.RUSAGE_THREAD).ru_minflt - pages) / steps < 150


def test_frequent_words_come_in_the_order_of_their_counts(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(2000) if i % (k % 7 + 1) == 0)) for i in range(40)]
    counted = L.cut_lineage(L.count_words(spark.createDataFrame(rows, "doc_id bigint, text string")), "word-counts")
    counts = list(L.vocabulary_of_counts(counted).frequent.values())
    assert len(set(counts)) > 3 and counts == sorted(counts, reverse=True)


def test_words_have_their_own_counts(spark, monkeypatch):
    """However many words there are, and whether their counts are broadcast or joined."""
    rows = [(i, " ".join(f"w{k}xq" for k in range(i % 40, 20_000, 40))) for i in range(80)] + [(80, "zzyxq zzyxq w7xq é z"), (81, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    other = spark.createDataFrame([(0, "nowherexq"), (1, "w9xq"), (2, "é"), (3, "zzyxq"), (4, "z")], "doc_id bigint, text string")
    got = {}
    for frequent in (1, 10**6):
        monkeypatch.setattr(L, "FREQUENT", frequent)
        counted = L.cut_lineage(L.count_words(df), "word-counts")
        vocabulary = L.vocabulary_of_counts(counted)
        assert len(vocabulary.known) == int((20_000 + 3) ** L.KNOWN_POWER) and vocabulary.within.size == 2 * L.CLASSES
        encoded = L.cut_lineage(L.encode(df.unionAll(other), vocabulary), "ids")
        rare = {r.row: r.rare for r in L.rare_sums(encoded, counted, vocabulary).collect()}
        got[frequent] = [r.within + rare.get(r.row, 0) for r in sorted(encoded.collect(), key=lambda r: r.row)]
        of = {w: L.class_of(w.encode()) for w in ("w9xq", "é", "zzyxq", "z", "nowherexq")}
        log = lambda w, n, of=of, v=vocabulary: np.log(n / (v.totals[of[w]] + v.kinds[of[w]] + 1))
        unseen, *seen = got[frequent][-5:]
        counts = {r.word: r.n for r in counted.collect()}
        words = {*vocabulary.own, *vocabulary.known}
        for w, found in zip(("w9xq", "é", "zzyxq", "z"), seen):
            assert found == pytest.approx(0 if w.encode() in words else log(w, counts[w]))
        k = vocabulary.kinds[of["nowherexq"]]
        assert unseen == pytest.approx(log("nowherexq", k + 1) - 10 * np.log(257)) and unseen < min(seen) - 20
        assert vocabulary.totals.sum() + sum(counts[w.decode()] for w in words) == sum(counts.values())
    assert np.allclose(got[1], got[10**6])


def test_empty_table(spark):
    assert L.score(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op10_lm_scores(spark, SF).collect()}
    assert got.keys() == docs.keys()
    assert all(r.n_tokens == len((docs[i] or "").encode().split()) and r.log_likelihood <= 0 for i, r in got.items())
