"""Runs of words against a search of every period, and the query against a plain version of its contract."""

import hashlib
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from flowline.llm import periodic, queries  # noqa: E402
from flowline.llm.repair import Grammar  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every period of a list of words, the smallest first."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            stop = at
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            if stop > at and stop + q - at >= max(6, 4 * q):
                best.setdefault((at, stop + q), q)
            at = stop + 1
    return sorted((a, b - a, q) for (a, b), q in best.items())


def plain_collapse(words, runs):
    dropped = {i for a, size, q in runs for i in range(a + q, a + size)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def flat_of(texts):
    flat, starts = [], []
    for number, words in enumerate(texts):
        starts.append(len(flat))
        flat += [*words, -1 - number]
    return np.array(flat, np.int64), starts


def random_words(draw):
    words = [draw.randrange(draw.choice([1, 2, 3, 5])) for _ in range(draw.choice([0, 1, 5, 6, 7, 20, 60, 150]))]
    for _ in range(draw.choice([0, 1, 3]) if len(words) > 4 else 0):
        start, period = draw.randrange(len(words)), draw.randrange(1, max(2, len(words) // 4))
        for i in range(start + period, min(len(words), start + draw.randrange(1, len(words)))):
            words[i] = words[i - period]
    return words


def test_runs_equal_a_search_of_every_period():
    draw = random.Random(3)
    for _ in range(400):
        texts = [random_words(draw) for _ in range(draw.choice([1, 3, 8]))]
        flat, starts = flat_of(texts)
        start, end, period = periodic.runs_of(flat)
        want = sorted((a + s, size, q) for s, words in zip(starts, texts) for a, size, q in plain_runs(words))
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == want


def test_grammar_derives_the_words():
    draw = random.Random(4)
    texts = [random_words(draw) for _ in range(30)]
    flat, _ = flat_of(texts)
    grammar = Grammar(flat)
    left, right = np.concatenate(grammar.left).tolist(), np.concatenate(grammar.right).tolist()

    def derive(symbol):
        at = symbol - grammar.terminals
        return [symbol] if at < 0 else derive(left[at]) + derive(right[at])

    for symbol, place in zip(grammar.symbols.tolist(), grammar.places.tolist()):
        if symbol >= 0:
            own = derive(symbol)
            assert own == flat[place : place + len(own)].tolist()
    symbol, place = grammar.derivations(np.ones(len(left), bool))
    for s, p in zip(symbol.tolist(), place.tolist()):
        own = derive(s + grammar.terminals)
        assert own == flat[p : p + len(own)].tolist()
    # What is left has hardly a pair twice, and a repeated passage is a tree of little depth.
    passage = list(range(1000))
    grammar = Grammar(flat_of([passage + [5000] + passage])[0])
    assert len(grammar.rounds) <= 12 and (grammar.symbols >= 0).sum() <= 5


def test_colliding_hashes_are_noticed(monkeypatch):
    equal, seeds = periodic._Hashes.equal, []

    class Bad(periodic._Hashes):
        def __init__(self, words, seed):
            super().__init__(words, seed)
            self.bad = seed < 2
            seeds.append(seed)

        def equal(self, at, shift, size):
            return np.ones(len(at), bool) if self.bad else equal(self, at, shift, size)

    monkeypatch.setattr(periodic, "_Hashes", Bad)
    words = [random.Random(i).randrange(2) for i in range(200)] + [2, 3] * 5
    start, end, period = periodic.runs_of(flat_of([words])[0])
    assert list(zip(start, end - start, period)) == plain_runs(words) and seeds == [0, 1, 2]


@pytest.mark.parametrize("words", [[0] * 300_000, [0, 1] * 100_000, list(range(500)) * 300, list(range(200_000)) * 2])
def test_long_texts(words):
    start, end, period = periodic.runs_of(flat_of([words])[0])
    times = len(words) / len(set(words))
    assert list(zip(start, end, period)) == ([(0, len(words), len(set(words)))] if times >= 4 else [])


def test_blocks_change_nothing(monkeypatch):
    flat, _ = flat_of([random_words(random.Random(i)) for i in range(40)])
    whole = [x.tolist() for x in periodic.runs_of(flat)]
    monkeypatch.setattr(periodic, "BLOCK", 3)
    assert [x.tolist() for x in periodic.runs_of(flat)] == whole


ODD = [
    (1, "a b a b a b a b"),
    (2, None),
    (3, ""),
    (4, " \t\n\r\x0b\x0c "),
    (5, "x " * 6),
    (5, "x " * 6),
    (None, "y y y y y y"),
    (6, "x x x x x"),
    (7, "u v w u v w u v w u v w \x1c"),
    (8, "p q r " * 20_000 + "end"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(i, t, "other", 1, 2) for i, t in ODD], "doc_id bigint, text string, TEXT string, runs int, n_words int"
    )
    found = periodic.find_runs(df).collect()
    want = []
    for number, text in ODD:
        words = periodic.WORD.findall(text or "")
        runs = [(0, 60_000, 3)] if number == 8 else plain_runs(words)
        want.append((number, len(words), runs, plain_collapse(words, runs)))
    got = [(r.doc_id, r.n_words, [tuple(run) for run in r.runs], r.collapsed) for r in found]
    key = lambda row: (row[0] is not None, row[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert periodic.find_runs(df.limit(0)).collect() == []


def contract(number, text):
    words = periodic.WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(number).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a, original = g % n, list(words)
        p = 1 + (n - a) // (3 + g % 8)
        for i in range(a, n):
            words[i] = original[a + (i - a) % p]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (
        number,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        digest("".join(f"{a},{size},{q}\n" for a, size, q in runs)),
        digest(plain_collapse(words, runs)),
    )


def test_query_equals_its_contract(spark):
    found = queries.op11_periodic_runs(spark, SF)
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(contract(r.doc_id, r.text) for r in documents)
    assert sorted(tuple(r) for r in found.collect()) == want
    assert any(row[1] for row in want)
